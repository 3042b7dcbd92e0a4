"""Similarity join of documents on word n-grams by chosen paths.

Two texts are linked if the sets of their five-word shingles have a Jaccard similarity of at least 0.8. Method:

1. A set is represented by minimum hashes; two sets agree in a coordinate with the probability of their similarity.
2. Chosen paths: a bucket is split on a few coordinates that a hash of its path picks, so all its members pick the same;
   members that share the value meet in a child bucket. About two children of a bucket hold a pair of the wanted similarity,
   so a pair stays together on some path with high probability, and dissimilar sets part. Runs are repeated until a pair
   at the threshold is missed with less than 1 - RECALL.
3. A bucket is no longer split when it is small, or would hardly shrink: the members of its children are counted before they
   are dealt. Its members are then compared by their hashes, in blocks of bounded size. Texts that look alike (with a margin far below the threshold) form candidate components.
4. Inside each component all pairs are verified with the exact sets, in blocks. Only link counts and one edge per text and
   block leave a task, never the pairs.

Equal texts are one text (64-bit hashes); copies are never expanded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.components import components
from fleetmart.llm.groups import blocks, common_counts, grouped, linked
from fleetmart.llm.staging import staged
from fleetmart.llm.textarrays import Chunk, chunks, mixed, span_hashes, words

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.9999
COORDINATES = 64
#: Children of a bucket in which a pair at the threshold is expected to meet again.
BRANCHES = 2.0
SMALL_BUCKET = 1024
#: A large bucket of which a child would keep this part is compared, not split.
STANDS = 0.6
DEEPEST = 12
#: Texts compared at once: by their minimum hashes, and by their sets.
ALIKE_BLOCK = 2048
BLOCK = 512
#: Candidate texts up to which their ids are broadcast (16 bytes each).
BROADCAST_TEXTS = 1_000_000
_ONE = np.uint64(1)


def shingles(chunk: Chunk, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each shingle of consecutive words; a text with fewer words than size has one shingle of them all."""
    _, _, word, first = words(chunk)
    count = np.diff(first)
    spans = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(count.size), spans)
    begin = np.arange(row.size) - np.repeat(np.cumsum(spans) - spans, spans) + first[row]
    end = np.minimum(begin + size, first[row + 1])
    return row, span_hashes(word, begin, end)


def runs_needed(recall: float, branches: float = BRANCHES) -> int:
    """Runs after which a pair at the threshold has met with the wanted probability, however deep the paths go."""
    stays = 0.5
    for _ in range(100):  # the chance that a branching line with so many expected children never ends
        stays = 1 - math.exp(-branches * stays)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - stays)))


def _minima(chunk: Chunk, multipliers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with shingles and their minimum hashes."""
    row, value = shingles(chunk)
    present, begin = np.unique(row, return_index=True)
    minima = np.empty((present.size, multipliers.size), np.uint32)
    if present.size:
        for k, a in enumerate(multipliers):
            minima[:, k] = np.minimum.reduceat(((value * a) >> np.uint64(32)).astype(np.uint32), begin)
    return present, minima


def _multipliers() -> np.ndarray:
    return mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | _ONE


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    multipliers = _multipliers()
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            present, minima = _minima(chunk, multipliers)
            rows = [None] * (chunk.last - chunk.first)
            for k, i in enumerate(present):
                rows[i] = minima[k].tobytes()
            part = batch.slice(chunk.first, chunk.last - chunk.first)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("node"), pa.array(rows, pa.binary())],
                                             ["doc_id", "node", "minima"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _children(path: np.ndarray, minima: np.ndarray, chance: float) -> tuple[np.ndarray, np.ndarray]:
    """Index of the member and path of each child bucket."""
    own = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))
    pick = mixed(path[:, None] ^ own[None, :])
    member, at = np.nonzero(pick < np.uint64(int(chance * 2.0 ** 64)))
    child = mixed(pick[member, at] + (minima[member, at].astype(np.uint64) + _ONE) * np.uint64(0xD1342543DE82EF95))
    return member, child


def _chance(similarity: float) -> float:
    return min(1.0, BRANCHES / (similarity * COORDINATES))


def _child_sizes(similarity: float):
    """Rows (first, size, child, n): members of the bucket in column path that would meet in a child, counted in each batch."""
    chance = _chance(similarity)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            member, child = _children(batch.column("path").to_numpy().view(np.uint64), _matrix(batch.column("minima")), chance)
            child, at, n = np.unique(child, return_index=True, return_counts=True)  # a child has one parent
            first, size = (batch.column(c).to_numpy()[member[at]] for c in ("first", "size"))
            yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(size), pa.array(child.view(np.int64)), pa.array(n)],
                                             ["first", "size", "child", "n"])

    return task


def _split(runs: int, similarity: float):
    """Rows (path, node) of child buckets. With runs, members of the root of each run; else of the bucket in column path."""
    chance = _chance(similarity)
    roots = mixed(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node, minima = batch.column("node").to_numpy(), _matrix(batch.column("minima"))
            for path in ([np.full(node.size, r, np.uint64) for r in roots] if runs else
                         [batch.column("path").to_numpy().view(np.uint64)]):
                member, child = _children(path, minima, chance)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(node[member])], ["path", "node"])

    return task


def _looks_alike(similarity: float):
    """Edges (a, b) from members of a bucket's block to the first member of their component by estimated similarity."""
    # five standard deviations below the threshold
    least = COORDINATES * similarity - 5 * math.sqrt(COORDINATES * similarity * (1 - similarity))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        for table in grouped(batches, ["path", "i", "j"]):
            node, minima = table.column("node").to_numpy(), _matrix(table.column("minima").combine_chunks())
            same = np.zeros((node.size, node.size), np.uint8)
            for k in range(COORDINATES):
                same += minima[:, k, None] == minima[None, :, k]
            first = linked(same >= least)
            moved = np.flatnonzero(first != np.arange(node.size))
            a.append(node[moved])
            b.append(node[first[moved]])
            if len(a) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return task


def candidates(nodes: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Edges (a, b) whose components hold every pair of nodes with the wanted similarity together, up to the recall.

    nodes: node (distinct, not null) and its minima.
    """
    frontier = staged(nodes.mapInArrow(_split(runs_needed(recall), similarity), "path long, node long"))
    found = None
    for level in range(1, DEEPEST + 1):
        # buckets with the same members are compared as one, named after the first path; a combined hash stands for the members.
        # To be split on they keep all their paths, as each may end without a child
        small = F.lit(level == DEEPEST) | (F.col("size") <= SMALL_BUCKET)
        buckets = (frontier.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("members"))
                   .where(F.col("size") > 1)
                   .groupBy("size", "members").agg(F.collect_list("path").alias("paths"))
                   .select("size", "paths", F.array_min("paths").alias("first"), small.alias("small")))
        kept = F.when(F.col("small"), F.array("first")).otherwise(F.col("paths"))
        held = staged(frontier.join(buckets.select(F.explode(kept).alias("path"), "first", "size", "small"), "path")
                      .join(nodes, "node"))
        compared, large = held.where("small"), held.where("NOT small")
        more = bool(large.limit(1).count())
        if more:
            counted = (large.select("path", "first", "size", "minima")
                       .mapInArrow(_child_sizes(similarity), "first long, size long, child long, n long")
                       .groupBy("first", "child").agg(F.sum("n").alias("n"), F.max("size").alias("size")))
            crowds = staged(counted.groupBy("first").agg((F.max("n") >= STANDS * F.max("size")).alias("stands")))
            told = large.join(crowds, "first", "left").withColumn("stands", F.coalesce("stands", F.lit(False)))
            compared = compared.unionByName(told.where("stands AND path = first").drop("stands"))
            split = told.where("NOT stands")
        edges = staged(blocks(compared.select("path", "node", "minima", "size"), "size", ["path"], ALIKE_BLOCK)
                       .select("path", "i", "j", "node", "minima").mapInArrow(_looks_alike(similarity), "a long, b long"))
        found = edges if found is None else found.union(edges)
        if not more:
            break
        frontier = staged(split.select("path", "node", "minima").mapInArrow(_split(0, similarity), "path long, node long"))
    return found


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            row, value = shingles(chunk)
            edges = np.searchsorted(row, np.arange(chunk.last - chunk.first + 1))
            sets = [np.unique(value[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:])]
            part = batch.slice(chunk.first, chunk.last - chunk.first)
            yield pa.RecordBatch.from_arrays([part.column("node"), part.column("component"), part.column("size"), pa.array(sets, pa.binary())],
                                             ["node", "component", "size", "shingles"])


def _verified(similarity: float):
    """For the texts of a block that have links: their number within it, and the first text of their local component."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["component", "i", "j"]):
            node, at = np.unique(table.column("node").to_numpy(), return_index=True)
            own = table.column("own").to_numpy()[at]
            held = table.column("shingles").to_pylist()
            sets = [np.frombuffer(held[k], np.uint64) for k in at]
            size = np.array([s.size for s in sets])
            common = common_counts(sets)
            alike = common >= similarity * (size[:, None] + size[None, :] - common) - 1e-9
            np.fill_diagonal(alike, False)
            if table.column("i")[0] != table.column("j")[0]:
                alike &= own[:, None] != own[None, :]
            links = alike.sum(axis=1)
            some = np.flatnonzero(links)
            if some.size:
                first = linked(alike)
                yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[first[some]]), pa.array(links[some])],
                                                 ["a", "b", "links"])

    return task


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per row of docs: doc_id, class_id (the smallest doc_id that links or equal texts connect it with), links
    (other texts with the wanted similarity to its own) and copies (documents with its very text).

    docs: doc_id, text; other columns are ignored. Words are runs of letters, marks, digits and underscores in lower case; a
    text with one to four words is one shingle. A text that is null or without words has no links and is a class of its
    own. Repeated rows are copies. A row without doc_id belongs to its class, which is named after the others; a class
    without any id has class_id null. An empty table gives no rows.
    """
    return classed(docs, similarity, recall).select("doc_id", "class_id", "links", "copies")


def classed(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """near_duplicates with two columns more: node, the hash of the row's text, and root, which tells the classes apart; root
    is null for a text that is null or without words."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("node", F.xxhash64("text"))
    sketch = staged(texts.mapInArrow(_sketched, "doc_id long, node long, minima binary"))
    worded = sketch.where(F.col("minima").isNotNull())
    own = staged(worded.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")))
    nodes = staged(worded.select("node", "minima").dropDuplicates(["node"]))
    member = components(candidates(nodes, similarity, recall))
    sizes = member.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    member = staged(member.join(sizes, "root").join(own, "node")
                    .select("node", F.col("root").alias("component"), "size", "first_id"))
    wanted = F.broadcast(member) if member.count() <= BROADCAST_TEXTS else member
    sets = (texts.join(wanted, "node").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
            .select("node", "component", "size", "text")
            .mapInArrow(_sets, "node long, component long, size long, shingles binary"))
    verified = staged(blocks(sets, "size", ["component"], BLOCK).select("component", "i", "j", "own", "node", "shingles")
                      .mapInArrow(_verified(similarity), "a long, b long, links long"))
    roots = components(verified.select("a", "b"))
    links = verified.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    placed = (own.join(roots, "node", "left").join(links, "node", "left")
              .select("node", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"),
                      "copies", "first_id"))
    placed = staged(placed)
    named = placed.groupBy("root").agg(F.min("first_id").alias("class_id"))
    classes = placed.join(named, "root").select("node", "root", "class_id", "links", "copies")
    wordless = sketch.where(F.col("minima").isNull()).select(
        "doc_id", "node", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("links"), F.lit(1).cast("long").alias("copies"))
    return (worded.select("doc_id", "node").join(classes, "node").select("doc_id", "node", "root", "class_id", "links", "copies")
            .unionByName(wordless))
