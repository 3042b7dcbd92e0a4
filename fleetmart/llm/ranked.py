"""Ranked lexical search: the highest-scoring documents of each item by an integer tf-idf score with length normalisation.

Method: documents are searched in shards. A shard holds, for each term of the items, a posting list ordered by document with the
term's impact in each, and over it a sparse table that answers where the greatest impact of any stretch stands (range-maximum
query). A search starts with the interval of all documents of the shard. The summed greatest impacts of an interval's stretches
bound the score of every document in it. The interval with the greatest bound is taken first: the document that holds its greatest
single impact is scored, and the rest falls into the intervals before and behind it, with bounds of their own. Short intervals are
scored as a whole. It ends when no interval's bound reaches the kth score so far.

Shards are made of rows as they come, so postings aren't shuffled; each task returns k documents an item. Items are read in
blocks with a bounded number of terms, which go to every task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.staging import staged
from fleetmart.llm.textarrays import Chunk, chunks, runs, span_hashes

RESULTS = 10
#: Terms of all items of a block together; they go to every task (8 bytes each, a few times).
BLOCK_TERMS = 50_000
#: Documents and postings of a shard, at most (rows come 1,024 at a time), and words of its bit maps.
SHARD_DOCUMENTS = 16_384
SHARD_POSTINGS = 2_000_000
SHARD_WORDS = 4_000_000
#: Intervals taken at once, from all items together, and postings from which on an interval is split.
AT_ONCE = 512
SHORT = 1024


def terms(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each term, and for each row the first term's index (one more entry than rows).

    Terms are the longest stretches of ASCII letters, digits and characters beyond ASCII; only A to Z are lower-cased.
    """
    cps = chunk.cps
    upper = (cps >= 65) & (cps <= 90)
    cps = np.where(upper, cps + 32, cps).astype(np.uint32)
    begin, end = runs((cps >= 128) | (cps >= 97) & (cps <= 122) | (cps >= 48) & (cps <= 57), chunk.starts)
    return span_hashes(cps, begin, end), np.searchsorted(begin, chunk.starts)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            value, first = terms(chunk)
            rows = [value[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            part = batch.slice(chunk.first, chunk.last - chunk.first)
            yield pa.RecordBatch.from_arrays([part.column("item_id"), pa.array(rows, pa.binary())], ["item_id", "terms"])


def _counted(known: np.ndarray) -> Callable:
    """For each document its number of terms, and the known ones it holds, as places in known, with their counts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                value, first = terms(chunk)
                number = np.diff(first)
                place = np.minimum(np.searchsorted(known, value), max(0, known.size - 1))
                held = np.flatnonzero(known[place] == value) if known.size else np.empty(0, np.int64)
                row = np.repeat(np.arange(number.size), number)[held]
                pair, count = np.unique(row * known.size + place[held], return_counts=True)
                edges = np.searchsorted(pair, np.arange(number.size + 1) * known.size)
                which = (pair % max(1, known.size)).astype(np.int32)
                count = count.astype(np.int32)
                part = batch.slice(chunk.first, chunk.last - chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(number),
                     *(pa.array([x[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()) for x in (which, count))],
                    ["doc_id", "n", "places", "counts"])

    return task


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place, n = np.unique(np.frombuffer(b"".join(batch.column("places").to_pylist()), np.int32), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(n)], ["place", "n"])


class Shard:
    """Posting lists of the known terms over documents in ascending order of doc_id, with sparse tables."""

    def __init__(self, known: int, ids: np.ndarray, document: np.ndarray, place: np.ndarray, impact: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        position = np.empty(ids.size, np.int64)
        position[order] = np.arange(ids.size)
        self.words = ids.size // 64 + 1
        key = place.astype(np.int64) * (self.words * 64) + position[document]
        order = np.argsort(key)
        key, self.impact = key[order], impact[order]
        #: document of each posting; a term's list is a stretch of these
        self.document = key % (self.words * 64)
        #: for each term and 64 documents: which of them hold it, and how many postings come before
        self.held = np.zeros(known * self.words, np.uint64)
        np.bitwise_or.at(self.held, key >> 6, np.uint64(1) << (key & 63).astype(np.uint64))
        count = np.bitwise_count(self.held)
        self.before = np.cumsum(count, dtype=np.int32) - count
        place = place[order]
        longest = int(np.bincount(place).max()) if place.size else 1
        self.greatest = np.empty((max(1, longest.bit_length()), key.size), np.int32)
        self.greatest[0] = np.arange(key.size)
        for level in range(1, self.greatest.shape[0]):
            half = 1 << (level - 1)
            a = self.greatest[level - 1]
            b = np.concatenate([a[half:], a[key.size - min(half, key.size):]])
            self.greatest[level] = np.where(self.impact[a] >= self.impact[b], a, b)

    def found(self, place: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first posting at or behind a document in each term's list, and whether it is that document's."""
        word = place * self.words + (document >> 6)
        bit = np.uint64(1) << (document & 63).astype(np.uint64)
        held = self.held[word]
        return self.before[word] + np.bitwise_count(held & (bit - np.uint64(1))), (held & bit) != 0

    def maxima(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where the greatest impact stands in each stretch of postings; none is empty."""
        level = np.frexp(end - begin)[1] - 1
        a, b = self.greatest[level, begin], self.greatest[level, end - (1 << level)]
        return np.where(self.impact[a] >= self.impact[b], a, b)

    def intervals(self, owner: np.ndarray, place: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple]:
        """(owner, bound, split, postings, place, begin, end) of the intervals whose stretches are given; owner ascends, one value
        for each interval. split is the document of the greatest impact."""
        some = end > begin
        owner, place, begin, end = owner[some], place[some], begin[some], end[some]
        if not owner.size:
            return []
        top = self.maxima(begin, end)
        value = self.impact[top]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        bound = np.add.reduceat(value, first)
        edges = np.append(first, owner.size)
        highest = np.flatnonzero(value == np.repeat(np.maximum.reduceat(value, first), np.diff(edges)))
        split = self.document[top[highest[np.searchsorted(highest, first)]]]
        postings = np.add.reduceat(end - begin, first)
        return [(o, s, t, n, place[a:b], begin[a:b], end[a:b]) for o, s, t, n, a, b in
                zip(owner[first].tolist(), bound.tolist(), split.tolist(), postings.tolist(), edges[:-1].tolist(), edges[1:].tolist())]

    def search(self, items: list[np.ndarray], best: list[list[tuple[int, int]]], k: int) -> None:
        """Bring the documents of this shard into the heaps (score, -doc_id) of the k best of each item."""
        if not self.document.size:
            return
        place = np.concatenate(items)
        owner = np.repeat(np.arange(len(items)), [x.size for x in items])
        begin, _ = self.found(place, np.zeros(place.size, np.int64))
        end, _ = self.found(place, np.full(place.size, self.ids.size))
        waiting: dict[int, list[tuple]] = {}
        number = 0
        for o, bound, *rest in self.intervals(owner, place, begin, end):
            waiting[o] = [(-bound, number, *rest)]
            number += 1
        while waiting:
            taken, short = [], []
            each = max(1, AT_ONCE // len(waiting))
            for item in list(waiting):
                heap = waiting[item]
                for _ in range(each):
                    if not heap:
                        break
                    bound, _, split, postings, *lists = heapq.heappop(heap)
                    if len(best[item]) == k and -bound < best[item][0][0]:  # nor does any other interval reach the kth score
                        heap.clear()
                        break
                    if postings <= SHORT:
                        short.append((item, *lists))
                    else:
                        taken.append((item, split, *lists))
                if not heap:
                    del waiting[item]
            if short:
                self._score_all(short, best, k)
            if taken:
                for item, bound, *rest in self._split(taken, best, k):
                    if len(best[item]) < k or bound >= best[item][0][0]:
                        heapq.heappush(waiting.setdefault(item, []), (-bound, number, *rest))
                        number += 1

    def _split(self, taken: list[tuple], best: list[list[tuple[int, int]]], k: int) -> Iterator[tuple]:
        """Score each interval's document of the greatest impact; the intervals before and behind it."""
        sizes = [x[2].size for x in taken]
        document = np.array([x[1] for x in taken])
        place, begin, end = (np.concatenate([x[i] for x in taken]) for i in (2, 3, 4))
        at, hit = self.found(place, np.repeat(document, sizes))
        first = np.cumsum([0, *sizes[:-1]])
        score = np.add.reduceat(np.where(hit, self.impact[np.minimum(at, self.impact.size - 1)], 0), first)
        for (item, *_), s, i in zip(taken, score.tolist(), self.ids[document].tolist()):
            _offer(best[item], s, i, k)
        owner = np.repeat(np.arange(len(taken)), sizes)
        for parts in ((begin, at), (at + hit, end)):
            for o, *rest in self.intervals(owner, place, *parts):
                yield taken[o][0], *rest

    def _score_all(self, short: list[tuple], best: list[list[tuple[int, int]]], k: int) -> None:
        documents = self.ids.size
        owner = np.repeat(np.arange(len(short)), [x[1].size for x in short])
        begin, end = (np.concatenate([x[i] for x in short]) for i in (2, 3))
        size = end - begin
        posting = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
        pair = np.repeat(owner, size) * documents + self.document[posting]
        order = np.argsort(pair)
        pair = pair[order]
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        pair, score = pair[first], np.add.reduceat(self.impact[posting[order]], first)
        least = np.array([best[x[0]][0][0] if len(best[x[0]]) == k else 1 for x in short])
        good = np.flatnonzero(score >= least[pair // documents])
        for o, s, i in zip((pair[good] // documents).tolist(), score[good].tolist(), self.ids[pair[good] % documents].tolist()):
            _offer(best[short[o][0]], s, i, k)


def _offer(heap: list[tuple[int, int]], score: int, doc_id: int, k: int) -> None:
    if score <= 0:
        return
    if len(heap) < k:
        heapq.heappush(heap, (score, -doc_id))
    elif (score, -doc_id) > heap[0]:
        heapq.heapreplace(heap, (score, -doc_id))


def _searched(items: list[np.ndarray], weight: np.ndarray, documents: int, total: int, k: int) -> Callable:
    """The k best documents of each item among those of a task, as number of the item, doc_id and score."""
    most = max(64, min(SHARD_DOCUMENTS, 64 * (SHARD_WORDS // max(1, weight.size))))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        held: list[tuple] = []
        rows, postings, step = 0, 0, min(most, 1024)
        for batch in batches:
            ids, n = batch.column("doc_id").to_numpy(), batch.column("n").to_numpy()
            for a in range(0, batch.num_rows, step):
                places, counts = (batch.column(c).slice(a, step).to_pylist() for c in ("places", "counts"))
                held.append((ids[a:a + step], n[a:a + step], np.array([len(x) // 4 for x in places]),
                             np.frombuffer(b"".join(places), np.int32), np.frombuffer(b"".join(counts), np.int32)))
                rows, postings = rows + len(places), postings + held[-1][3].size
                if rows >= most or postings >= SHARD_POSTINGS:
                    yield shard(held)
                    held, rows, postings = [], 0, 0
        if held:
            yield shard(held)

    def shard(held: list[tuple]) -> Shard:
        ids, n, sizes, place, count = (np.concatenate(x) for x in zip(*held))
        document = np.repeat(np.arange(ids.size), sizes)
        count = count.astype(np.int64)
        size = 10 + (90 * n.astype(np.int64) * documents) // max(1, total)
        impact = weight[place] * ((1_000_000_000 * count) // (1000 * count + 8 * size[document]))
        some = impact > 0
        return Shard(weight.size, ids, document[some], place[some], impact[some])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        for part in shards(batches):
            part.search(items, best, k)
        found = [(i, -negative, score) for i, heap in enumerate(best) for score, negative in heap]
        yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in (zip(*found) if found else ([], [], []))],
                                         ["item", "doc_id", "score"])

    return task


def weights(documents: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * f + 1))) for f in frequency.tolist()], np.int64)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = RESULTS) -> DataFrame:
    """The k documents with the highest scores above 0 for each item, all if fewer: item_id, rank (from 1), doc_id, score. Equal
    scores go by ascending doc_id.

    docs: doc_id, text; items: item_id, text; other columns are ignored. With N documents that hold a term, L terms in all of
    them, n in a document, df documents with a term and tf of it in one: w = floor(1000 ln((2N + 2) / (2df + 1))), m = 10 + 90nN
    div L, and a document's score is the sum of w (10^9 tf div (1000 tf + 8m)) over the item's different terms. A null or empty
    text has no terms. Every row of docs counts as a document, repeated ones and those without doc_id too; those without can't
    be found. Rows of items with the same item_id are one item with the terms of all; rows without item_id are left out. Empty
    tables give no rows. Terms are told apart by 64-bit hashes. The result is exact.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = staged(items.where(F.col("item_id").isNotNull())
                   .select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
                   .mapInArrow(_item_terms, "item_id long, terms binary"))
    size = asked.agg(F.sum(F.length("terms") / 8)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_TERMS))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for block in range(blocks):
        held: dict[int, list[np.ndarray]] = {}
        for r in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toLocalIterator():
            held.setdefault(r["item_id"], []).append(np.frombuffer(r["terms"], np.uint64))
        sets = {i: np.unique(np.concatenate(x)) for i, x in sorted(held.items())}
        known = np.unique(np.concatenate([np.empty(0, np.uint64), *sets.values()]))
        if known.size:
            found = found.union(_block(texts, sets, known, k))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")).cast("int")
    return found.select("item_id", rank.alias("rank"), "doc_id", "score").where(F.col("rank") <= k)


def _block(texts: DataFrame, sets: dict[int, np.ndarray], known: np.ndarray, k: int) -> DataFrame:
    spark = texts.sparkSession
    counted = staged(texts.mapInArrow(_counted(known), "doc_id long, n long, places binary, counts binary"))
    sums = counted.where("n > 0").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total")).first()
    frequency = np.zeros(known.size, np.int64)
    for r in (counted.select("places").mapInArrow(_frequencies, "place int, n long")
              .groupBy("place").agg(F.sum("n").alias("n")).toLocalIterator()):
        frequency[r["place"]] = r["n"]
    weight = weights(sums["documents"], frequency)
    items = [np.searchsorted(known, x) for x in sets.values()]
    best = (counted.where(F.col("doc_id").isNotNull() & (F.length("places") > 0))
            .mapInArrow(_searched(items, weight, sums["documents"], sums["total"] or 0, k), "item long, doc_id long, score long"))
    named = spark.createDataFrame([(n, i) for n, i in enumerate(sets)], "item long, item_id long")
    return best.join(F.broadcast(named), "item").select("item_id", "doc_id", "score")
