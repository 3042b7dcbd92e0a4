"""Toxicity by a chain of linear classifiers.

Method: categories are predicted one after the other. Each has a logistic model over the words and word beginnings that
tell its documents apart, and over the probabilities of the categories before it. In training those probabilities come from
models that did not see the document (out of fold), so a later model meets the same kind of input as in prediction.

Prediction is one pass without a shuffle over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.staging import staged
from fleetmart.llm.textarrays import Chunk, chunks, lower_table, mixed, span_hashes, words

#: Of each class of the last category about so many labelled documents are learned from, picked by a hash of their id.
LEARNED_PER_CLASS = 5_000
#: Beginnings of words that serve as features, in characters, besides whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
FEATURES = 4_096
LEAST_DOCUMENTS = 4
#: Standard errors by which a feature's frequency must differ between the classes.
LEAST_APART = 3.5
FOLDS = 3
STEPS = 250
RIDGE = 0.1
THRESHOLD = 0.4


def features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of every word and word beginning, as signed 64-bit values; a row may hold a feature repeatedly."""
    begin, end, whole, first = words(chunk)
    row = np.repeat(np.arange(chunk.last - chunk.first), np.diff(first))
    found, rows = [whole], [row]
    cps = lower_table()[chunk.cps]
    for k in BEGINNINGS:
        long = np.flatnonzero(end - begin >= k)
        found.append(mixed(span_hashes(cps, begin[long], begin[long] + k) + np.uint64(k)))
        rows.append(row[long])
    return np.concatenate(rows), np.concatenate(found).view(np.int64)


def _length(chunk: Chunk) -> np.ndarray:
    return np.log1p(np.diff(words(chunk)[3]))


def _counted(categories: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [batch.column(c).to_numpy(zero_copy_only=False) for c in categories]
            for chunk in chunks(batch.column("text")):
                row, feature = features(chunk)
                order = np.lexsort((row, feature))
                row, feature = row[order], feature[order]
                once = np.r_[True, (feature[1:] != feature[:-1]) | (row[1:] != row[:-1])][:row.size]
                row, feature = row[once] + chunk.first, feature[once]
                if not row.size:
                    continue
                own, begin = np.unique(feature, return_index=True)
                columns = [np.add.reduceat(np.ones(row.size, np.int64), begin)]
                columns += [np.add.reduceat(x[row].astype(np.int64), begin) for x in held]
                yield pa.RecordBatch.from_arrays([pa.array(own), *map(pa.array, columns)],
                                                 ["feature", "n", *(f"n_{k}" for k in range(len(categories)))])

    return task


def _pairs(chunk: Chunk, known: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and index of the known features that each row has, each once. common: a table that most others fail."""
    row, feature = features(chunk)
    likely = np.flatnonzero(common[feature.view(np.uint64) >> np.uint64(44)])
    row, feature = row[likely], feature[likely]
    at = np.minimum(np.searchsorted(known, feature), max(0, known.size - 1))
    hit = known[at] == feature if known.size else np.zeros(feature.size, bool)
    key = np.unique(row[hit] * np.int64(max(1, known.size)) + at[hit])
    return key // max(1, known.size), key % max(1, known.size)


def _common(known: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << 20, bool)
    table[known.view(np.uint64) >> np.uint64(44)] = True
    return table


def _matrix(known: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = _common(known)
        for batch in batches:
            lists, lengths = [], []
            for chunk in chunks(batch.column("text")):
                row, at = _pairs(chunk, known, common)
                edges = np.searchsorted(row, np.arange(chunk.last - chunk.first + 1))
                lists += [at[a:b].astype(np.int32) for a, b in zip(edges[:-1], edges[1:])]
                lengths.append(_length(chunk))
            names = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in names), pa.array(lists, pa.list_(pa.int32())),
                 pa.array(np.concatenate(lengths) if lengths else np.empty(0))], [*names, "used", "length"])

    return task


class _Rows:
    """Training rows: the indices of their features, and dense columns."""

    def __init__(self, used: list[np.ndarray], dense: np.ndarray, width: int):
        self.size = np.array([len(x) for x in used], np.int64)
        self.at = np.concatenate(used).astype(np.int64) if used else np.empty(0, np.int64)
        self.row = np.repeat(np.arange(len(used)), self.size)
        self.dense, self.width = dense, width

    def logits(self, w: np.ndarray) -> np.ndarray:
        """w: a weight per feature, one per dense column, a constant."""
        inner = np.bincount(self.row, w[self.at], minlength=self.size.size)
        return inner + self.dense @ w[self.width:-1] + w[-1]

    def gradient(self, error: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.at, error[self.row], minlength=self.width), error @ self.dense, [error.sum()]])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit(rows: _Rows, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic weights by full-batch steps of adapted size."""
    w = np.zeros(rows.width + rows.dense.shape[1] + 1)
    total = max(weight.sum(), 1e-9)
    share = np.clip((weight * y).sum() / total, 1e-4, 1 - 1e-4)
    w[-1] = np.log(share / (1 - share))
    m, v = np.zeros_like(w), np.zeros_like(w)
    ridge = np.full(w.size, RIDGE / total)
    ridge[-1] = 0
    for step in range(1, STEPS + 1):
        g = rows.gradient(weight * (_sigmoid(rows.logits(w)) - y)) / total + ridge * w
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return w


def _chain(categories: list[str], width: int):
    """Train the chain on one bounded group; rows of (category, weights)."""

    def task(data: pd.DataFrame) -> pd.DataFrame:
        data = data.sort_values(["doc_id", "length"], kind="stable", ignore_index=True)
        used = [np.asarray(x) for x in data["used"]]
        fold, weight = data["fold"].to_numpy(), data["weight"].to_numpy(float)
        dense = data["length"].to_numpy(float)[:, None]
        fitted = []
        for name in categories:
            y = data[name].to_numpy(float)
            fitted.append(_fit(_Rows(used, dense, width), y, weight))
            out = np.zeros(len(used))
            for k in range(FOLDS):
                own = np.flatnonzero(fold == k)
                rest = np.flatnonzero(fold != k)
                if own.size:
                    w = _fit(_Rows([used[i] for i in rest], dense[rest], width), y[rest], weight[rest])
                    out[own] = _sigmoid(_Rows([used[i] for i in own], dense[own], width).logits(w))
            dense = np.column_stack([dense, out])
        return pd.DataFrame({"category": range(len(categories)), "weights": [w.tolist() for w in fitted]})

    return task


class ChainModel:
    """Categories in the order of the chain, the features known, and weights per category: one per feature, for the length,
    for each earlier category's probability, and a constant."""

    def __init__(self, categories: list[str], known: np.ndarray, weights: list[np.ndarray]):
        self.categories, self.known, self.weights = categories, known, weights

    def probabilities(self, chunk: Chunk, common: np.ndarray) -> np.ndarray:
        row, at = _pairs(chunk, self.known, common)
        n, width = chunk.last - chunk.first, self.known.size
        dense = _length(chunk)[:, None]
        found = np.zeros((n, len(self.categories)))
        for k, w in enumerate(self.weights):
            found[:, k] = _sigmoid(np.bincount(row, w[at], minlength=n) + dense @ w[width:-1] + w[-1]) if width else (
                _sigmoid(dense @ w[:-1] + w[-1]))
            dense = np.column_stack([dense, found[:, k]])
        return found


def learn(docs: DataFrame, labels: DataFrame, categories: list[str], learned_per_class: int = LEARNED_PER_CLASS) -> ChainModel:
    """Fit the chain. labels: doc_id and a 0/1 column per category; the last category is what the sample is balanced by.

    Rows without an id, a label or a text are left out; of several labels of a document the highest counts. About
    learned_per_class documents of each class are learned from, weighted by the share of their class. Without rows every
    probability is 0.
    """
    spark, last = docs.sparkSession, categories[-1]
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("int").alias(c) for c in categories))
    usable = usable.na.drop().groupBy("doc_id").agg(*(F.max(c).alias(c) for c in categories))
    size = {r[last]: r["n"] for r in usable.groupBy(last).agg(F.count(F.lit(1)).alias("n")).collect()}
    nothing = ChainModel(categories, np.empty(0, np.int64), [np.r_[np.zeros(k + 1), -30.0] for k in range(len(categories))])
    if not size:
        return nothing
    rate = F.create_map(*[F.lit(x) for y, n in size.items() for x in (y, min(1.0, learned_per_class / n))])
    position = F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(1_000_000)) / F.lit(1_000_000)
    picked = (usable.where(position < rate[F.col(last)])
              .withColumn("weight", 1 / rate[F.col(last)])
              .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most about learned_per_class rows of each class
    sample = staged(texts.where(F.col("text").isNotNull()).join(F.broadcast(picked), "doc_id"))
    sums = ["n", *(f"n_{k}" for k in range(len(categories)))]
    counts = (sample.select("text", *categories).mapInArrow(_counted(categories), ", ".join(["feature long", *(f"{x} long" for x in sums)]))
              .groupBy("feature").agg(*(F.sum(x).alias(x) for x in sums)).where(F.col("n") >= LEAST_DOCUMENTS))
    totals = sample.agg(F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(f"n_{k}") for k, c in enumerate(categories))).first()
    if not totals["n"]:
        return nothing
    counts = staged(counts)
    known: set[int] = set()
    for k in range(len(categories)):
        ones, rest = totals[f"n_{k}"], totals["n"] - totals[f"n_{k}"]
        if ones and rest:
            share = F.col("n") / totals["n"]
            apart = F.abs(F.col(f"n_{k}") / ones - (F.col("n") - F.col(f"n_{k}")) / rest)
            told = (apart / F.sqrt(share * (1 - share) * (1 / ones + 1 / rest) + 1e-9)).alias("told")
            known |= {r["feature"] for r in counts.select("feature", told)
                      .where(F.col("told") >= LEAST_APART).orderBy(F.desc("told"), "feature").limit(FEATURES).collect()}
    features_known = np.array(sorted(known), np.int64)
    kept = "doc_id long, " + ", ".join(f"{c} int" for c in categories) + ", weight double, fold int, used array<int>, length double"
    rows = sample.select("doc_id", *categories, "weight", "fold", "text").mapInArrow(_matrix(features_known), kept)
    fitted = rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(
        _chain(categories, features_known.size), "category int, weights array<double>").collect()
    weights = [np.array(r["weights"]) for r in sorted(fitted, key=lambda r: r["category"])]
    return ChainModel(categories, features_known, weights)


def _scored(broadcast):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        common = _common(model.known)
        for batch in batches:
            found = [np.empty((0, len(model.categories)))]
            found += [model.probabilities(chunk, common) for chunk in chunks(batch.column("text"))]
            p = np.concatenate(found)
            p[~batch.column("text").is_valid().to_numpy(zero_copy_only=False)] = 0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(p[:, k]) for k in range(p.shape[1]))],
                                             ["doc_id", *(f"p_{c}" for c in model.categories)])

    return task


def score(docs: DataFrame, model: ChainModel) -> DataFrame:
    """The probability p_<category> of every category, for the whole text of every row.

    docs: doc_id, text; other columns are ignored. A null text has probability 0; an empty one that of a text without words.
    Equal texts get equal results, an empty table gives no rows.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _scored(broadcast), "doc_id long, " + ", ".join(f"p_{c} double" for c in model.categories))


def _cleaned(broadcast, threshold: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        common = _common(model.known)
        for batch in batches:
            keep = [np.zeros(0, bool)]
            keep += [model.probabilities(chunk, common)[:, -1] < threshold for chunk in chunks(batch.column("text"))]
            yield batch.filter(pa.array(np.concatenate(keep)))

    return task


def keep_clean(docs: DataFrame, model: ChainModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all columns, whose last category is less probable than the threshold."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_cleaned(broadcast, threshold), docs.schema)


def with_categories(labels: DataFrame) -> DataFrame:
    """The categories of the labels table in the order of the chain: low quality, then toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


CATEGORIES = ["low_quality", "toxic"]


def flag_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every document with the chain's probabilities and whether it is toxic."""
    model = learn(docs, with_categories(labels), CATEGORIES)
    return score(docs, model).withColumn("toxic", F.col("p_toxic") >= threshold)
