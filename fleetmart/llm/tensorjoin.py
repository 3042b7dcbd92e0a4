"""Near duplicates by MinHash with tensored banding.

Two texts are linked if the sets of their five-word shingles have a Jaccard similarity of at least 85 in 100. Method:

1. A set has two small collections of half keys, each of a few minimum hashes. A table's key is a pair of half keys, one from
   either collection. So COLLECTION squared tables of 2 WIDTH hashes each need 2 WIDTH COLLECTION minimum hashes only. A pair
   meets in a table if some half key agrees in both collections: at the threshold all but about 1 in 200,000 do.
2. Sets are dealt by the half keys of the first collection that some other set has, and carry those of the second: the tables
   of such a bucket are formed where it is read. The sets of a very large bucket are dealt by both.
3. Members that meet in a table are compared by a few bits of each of their minimum hashes, in blocks; those that look alike,
   far below the threshold, form crowds.
4. Inside each crowd all pairs are verified with their full sets, in blocks. Only one edge a text and block leaves a task.

Texts with equal sets are one set (64-bit hashes).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.components import components
from fleetmart.llm.groups import blocks, common_counts, grouped, linked, matching, matrix
from fleetmart.llm.staging import staged
from fleetmart.llm.textarrays import Chunk, chunks, mixed, runs, span_hashes
from fleetmart.operators.lookup import lookup_join

SHINGLE = 5
#: Linked if PERCENT of the union is shared.
PERCENT = 85
#: Half keys of either collection, and minimum hashes of each.
COLLECTION = 10
WIDTH = 2
HASHES = 2 * COLLECTION * WIDTH
#: Bits of each minimum hash in a signature, and hashes in each of its two numbers.
BITS = 3
FIELDS = HASHES // 2
#: Sets compared at once: by their signatures, and by their elements.
ALIKE_BLOCK = 512
#: Sets with one half key from which on they are dealt by pairs of half keys.
LARGE_BUCKET = 16_384
BLOCK = 512
#: Sets to be verified up to which their ids are broadcast (40 bytes each).
BROADCAST_SETS = 500_000
_ONE = np.uint64(1)


def plain_words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and for each row the first word's index (one more entry than rows).

    Words are the stretches without the characters 20 and 09 to 0D (hexadecimal); only A to Z are lower-cased.
    """
    cps = np.where((chunk.cps >= 65) & (chunk.cps <= 90), chunk.cps + 32, chunk.cps).astype(np.uint32)
    begin, end = runs((cps != 32) & ((cps < 9) | (cps > 13)), chunk.starts)
    return span_hashes(cps, begin, end), np.searchsorted(begin, chunk.starts)


def shingle_sets(chunk: Chunk, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different shingles of each row, ascending, and where each row's begin (one more entry than rows). A text
    with fewer words than size has one shingle of them all."""
    word, first = plain_words(chunk)
    count = np.diff(first)
    spans = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(count.size), spans)
    begin = np.arange(row.size) - np.repeat(np.cumsum(spans) - spans, spans) + first[row]
    value = span_hashes(word, begin, np.minimum(begin + size, first[row + 1]))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(row.size, bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return value[new], np.searchsorted(row[new], np.arange(count.size + 1))


def _multipliers() -> np.ndarray:
    return mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7)) | _ONE


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    multipliers = _multipliers()
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            value, first = shingle_sets(chunk)
            size = np.diff(first)
            some = np.flatnonzero(size)
            minima = np.empty((some.size, HASHES), np.uint32)
            node = np.empty(some.size, np.uint64)
            if some.size:
                for k, a in enumerate(multipliers):
                    minima[:, k] = np.minimum.reduceat(((value * a) >> np.uint64(32)).astype(np.uint32), first[some])
                node = mixed(np.add.reduceat(mixed(value * multipliers[0]), first[some]) + size[some].astype(np.uint64))
            nodes, sketches = [None] * size.size, [None] * size.size
            for k, i in enumerate(some.tolist()):
                nodes[i], sketches[i] = int(node[k].view(np.int64)), minima[k].tobytes()
            part = batch.slice(chunk.first, chunk.last - chunk.first)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(nodes, pa.int64()), pa.array(size), pa.array(sketches, pa.binary())],
                ["doc_id", "text_hash", "node", "n_shingles", "minima"])


def _half_keys(minima: np.ndarray) -> np.ndarray:
    """The half keys of each row of minimum hashes, those of the first collection before those of the second."""
    minima = minima.reshape(-1, 2 * COLLECTION, WIDTH)
    key = np.zeros(minima.shape[:2], np.uint64) + np.arange(1, 2 * COLLECTION + 1, dtype=np.uint64)
    for k in range(WIDTH):
        key = mixed(key * np.uint64(0x9FB21C651E98DF25) + minima[:, :, k].astype(np.uint64))
    return key


def _first_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each half key of the first collection."""
    for batch in batches:
        if batch.num_rows:
            key = np.ascontiguousarray(_half_keys(matrix(batch.column("minima"), HASHES))[:, :COLLECTION]).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(batch.column("node").to_numpy(), COLLECTION))], ["key", "node"])


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The half keys of the second collection, and the low bits of all minimum hashes, side by side in two numbers."""
    shift = (BITS * np.arange(FIELDS)).astype(np.uint64)
    for batch in batches:
        if batch.num_rows:
            minima = matrix(batch.column("minima"), HASHES)
            low = (minima & ((1 << BITS) - 1)).astype(np.uint64).reshape(-1, 2, FIELDS)
            both = (low << shift).sum(axis=2, dtype=np.uint64).view(np.int64)
            second = np.ascontiguousarray(_half_keys(minima)[:, COLLECTION:])
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array([x.tobytes() for x in second], pa.binary())],
                ["node", "sign0", "sign1", "second"])


def _second(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, COLLECTION)


def _table_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each table: the key of both collections."""
    for batch in batches:
        if batch.num_rows:
            first = batch.column("key").to_numpy().view(np.uint64)[:, None]
            key = mixed(first * np.uint64(0xD6E8FEB86659FD93) + _second(batch.column("second"))).ravel().view(np.int64)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), COLLECTION))
            yield pa.RecordBatch.from_arrays([pa.array(key), *(batch.column(c).take(rows) for c in ("node", "sign0", "sign1", "second"))],
                                             ["key", "node", "sign0", "sign1", "second"])


def _least_alike() -> float:
    """Equal fields of signatures from which on sets look alike: five standard deviations below the threshold."""
    share = PERCENT / 100
    share += (1 - share) / (1 << BITS)  # other hashes agree in these bits by chance
    return HASHES * share - 5 * math.sqrt(HASHES * share * (1 - share))


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect the members of a block that meet in a table and whose signatures are alike, each with the first of its
    local component."""
    lowest = np.uint64(sum(1 << (BITS * k) for k in range(FIELDS)))
    for table in grouped(batches, ["key", "i", "j"]):
        node = table.column("node").to_numpy()
        order = np.argsort(node)
        node, second = node[order], _second(table.column("second").combine_chunks())[order]
        meet = np.zeros((node.size, node.size), bool)
        for k in range(COLLECTION):
            meet |= second[:, k, None] == second[None, :, k]
        differ = np.zeros(meet.shape, np.uint8)
        for name in ("sign0", "sign1"):
            sign = table.column(name).to_numpy()[order].view(np.uint64)
            apart = sign[:, None] ^ sign[None, :]
            fields = apart.copy()
            for k in range(1, BITS):
                fields |= apart >> np.uint64(k)
            differ += np.bitwise_count(fields & lowest)
        first = linked(meet & (HASHES - differ >= _least_alike()))
        moved = np.flatnonzero(first != np.arange(node.size))
        if moved.size:
            yield pa.RecordBatch.from_arrays([pa.array(node[first[moved]]), pa.array(node[moved])], ["a", "b"])


def crowds(nodes: DataFrame) -> DataFrame:
    """(node, crowd): sets of which some pair may reach the threshold are of one crowd. Sets alone are left out.

    nodes: node (different, not null) and its minima.
    """
    rows = staged(nodes.mapInArrow(_first_keys, "key long, node long"))
    keys = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    carried = "node long, sign0 long, sign1 long, second binary"
    met = matching(rows, keys, "key").join(nodes.mapInArrow(_carried, carried), "node").select("key", "n", "node", "sign0", "sign1", "second")
    if (keys.agg(F.max("n")).first()[0] or 0) > LARGE_BUCKET:
        met = staged(met)
        tables = staged(met.where(F.col("n") > LARGE_BUCKET).mapInArrow(_table_keys, f"key long, {carried}"))
        sizes = staged(tables.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        met = met.where(F.col("n") <= LARGE_BUCKET).unionByName(matching(tables, sizes, "key"))
    alike = (blocks(met, "n", ["key"], ALIKE_BLOCK).select("key", "i", "j", "node", "sign0", "sign1", "second")
             .mapInArrow(_alike, "a long, b long"))
    # what a set is linked with is linked with the least of that: far fewer different edges, as buckets share their first members
    least = staged(alike.groupBy("b").agg(F.min("a").alias("a"), F.collect_set("a").alias("others")))
    edges = least.select("a", "b").union(least.select("a", F.explode("others").alias("b")).where("a <> b").distinct())
    return components(edges).select("node", F.col("root").alias("crowd"))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            value, first = shingle_sets(chunk)
            sets = [value[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            part = batch.slice(chunk.first, chunk.last - chunk.first)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("node", "crowd", "size")), pa.array(sets, pa.binary())],
                                             ["node", "crowd", "size", "shingles"])


def _links(percent: int):
    """Edges that connect the members of a block that are linked."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["crowd", "i", "j"]):
            node = table.column("node").to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
            size = np.array([s.size for s in sets])
            common = common_counts(sets)
            first = linked(100 * common >= percent * (size[:, None] + size[None, :] - common))
            moved = np.flatnonzero(first != np.arange(node.size))
            yield pa.RecordBatch.from_arrays([pa.array(node[first[moved]]), pa.array(node[moved])], ["a", "b"])

    return task


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """For each row of docs: doc_id, n_shingles, component_id and kept.

    docs: doc_id, text; other columns are ignored. percent is PERCENT or more. Words are the stretches without the characters
    20 and 09 to 0D, with A to Z in lower case; a text's set holds its different five-word shingles, with one to four words the
    sequence of all. Sets are linked if 100 times what they share is at least percent times their union. component_id is the
    smallest doc_id that links lead to, itself included; kept tells whether it is the row's own. A text that is null or without
    words has no shingles and no links. Rows without doc_id take part in links; their kept is null, and their component_id is
    null if no row they are linked with has one. Repeated rows are linked as any equal texts are. An empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    sketch = staged(texts.mapInArrow(_sketched, "doc_id long, text_hash long, node long, n_shingles long, minima binary"))
    own = staged(sketch.where("node IS NOT NULL").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_hash")).alias("shown")))
    nodes = staged(sketch.where("node IS NOT NULL").select("node", "minima").dropDuplicates(["node"]))
    member = staged(crowds(nodes))
    sizes = member.groupBy("crowd").agg(F.count(F.lit(1)).alias("size"))
    wanted = staged(lookup_join(member, sizes, ["crowd"]).join(own, "node")
                    .select("node", "crowd", "size", F.col("shown.doc_id").alias("shown_id"), F.col("shown.text_hash").alias("shown_hash")))
    picked = F.broadcast(wanted) if wanted.count() <= BROADCAST_SETS else wanted
    sets = (texts.join(picked, (F.col("text_hash") == F.col("shown_hash")) & F.col("doc_id").eqNullSafe(F.col("shown_id")))
            .select("node", "crowd", "size", "text").mapInArrow(_sets, "node long, crowd long, size long, shingles binary")
            .dropDuplicates(["node"]))
    edges = staged(blocks(sets, "size", ["crowd"], BLOCK).select("crowd", "i", "j", "node", "shingles").mapInArrow(_links(percent), "a long, b long"))
    rooted = staged(components(edges).join(own.select("node", "least_id"), "node"))
    named = lookup_join(rooted, rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), ["root"])
    copied = own.where("copies > 1").select("node", F.col("least_id").alias("component_id")).join(rooted, "node", "left_anti")
    known = staged(named.select("node", "component_id").unionByName(copied.select("node", "component_id")))
    rows = lookup_join(sketch.select("doc_id", "n_shingles", "node"), known.withColumn("known", F.lit(True)), ["node"])
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
