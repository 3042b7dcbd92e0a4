"""Language identification by mixture inference.

Method: each language has a distribution over hashed character trigrams, learned from labelled documents. A document is a
mixture of languages; expectation-maximisation finds the proportions under which its trigrams are most likely. Where more
than one language keeps a share, the set of languages is the one with the best likelihood less a penalty per language.
A flat background takes what no language explains.

Learning and prediction read text only; prediction is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.textarrays import Chunk, chunks, class_table, lower_table, mixed

CELLS = 1 << 16
UNKNOWN = "und"
#: About so many documents of each language are learned from, picked by a hash of their id.
DOCUMENTS_PER_LANGUAGE = 2_000
ROUNDS = 8
SET_ROUNDS = 12
#: Sets of up to so many languages are tried for every text whose set is open.
ALWAYS_TRIED = 4
#: A language's share from which it is considered for the set; as many languages as have it are tried.
LEAST_SHARE = 0.03
#: What one more language costs, in units of the logarithm of the number of trigrams.
PENALTY = 4.0
SCHEMA = "doc_id long, lang_pred string, score double, languages array<string>, proportions array<double>, unexplained double"


def trigrams(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and cell of each trigram, and whether each row has a letter. Runs of other characters count as one blank."""
    rows = chunk.last - chunk.first
    cps = np.insert(lower_table()[chunk.cps], chunk.starts, 32)
    starts = chunk.starts + np.arange(rows + 1)
    kind = class_table(r"\p{L}", r"\p{M}")[cps]
    letter = kind > 0
    row = np.repeat(np.arange(rows + 1), np.append(np.diff(starts), 1))
    has_letter = np.bincount(row[kind == 1], minlength=rows + 1)[:rows] > 0
    kept = np.flatnonzero(letter | np.r_[True, letter[:-1]])
    text, row, letter = np.where(letter, cps, 32)[kept].astype(np.uint64), row[kept], letter[kept]
    middle = np.flatnonzero(letter[1:-1]) + 1
    code = (text[middle - 1] << np.uint64(42)) | (text[middle] << np.uint64(21)) | text[middle + 1]
    return row[middle], (mixed(code) >> np.uint64(48)).astype(np.int64), has_letter


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        languages = batch.column("lang").to_pylist()
        names = sorted(set(languages))
        number = {name: k for k, name in enumerate(names)}
        for chunk in chunks(batch.column("text")):
            row, cell, _ = trigrams(chunk)
            own = np.array([number[x] for x in languages[chunk.first:chunk.last]])
            key, count = np.unique(own[row] * CELLS + cell, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in key // CELLS], pa.string()), pa.array(key % CELLS), pa.array(count)],
                ["lang", "cell", "n"])


class LanguageModel:
    """Languages in order and, for each trigram cell, the likelihood under each of them; the last column is the background."""

    def __init__(self, languages: list[str], likelihood: np.ndarray):
        self.languages, self.likelihood = languages, likelihood


def learn(docs: DataFrame, documents_per_language: int = DOCUMENTS_PER_LANGUAGE) -> LanguageModel:
    """Learn from text and lang; rows without either are left out.

    Of a language with more documents than the bound, those with the lowest hashes of doc_id are used, about as many as the
    bound. The model holds at most CELLS counts per language.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    found = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not found:
        return LanguageModel([], np.full((CELLS, 1), 1 / CELLS, np.float32))
    share = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], min(1.0, documents_per_language / r["n"]))])
    position = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("learn")), F.lit(1_000_000)) / F.lit(1_000_000)
    sample = usable.where(position < share[F.col("lang")])
    counts = (sample.select("lang", "text").mapInArrow(_counted, "lang string, cell long, n long")
              .groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(r["lang"] for r in found)
    table = np.full((CELLS, len(languages) + 1), 0.1)
    which = counts["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy(np.int64)
    table[counts["cell"].to_numpy(np.int64), which] += counts["n"].to_numpy(float)
    table[:, -1] = 1
    return LanguageModel(languages, (table / table.sum(axis=0)).astype(np.float32))


def _expect(p: np.ndarray, n: np.ndarray, begin: np.ndarray, size: np.ndarray, total: np.ndarray, share: np.ndarray,
            rounds: int) -> np.ndarray:
    """Shares after some rounds. p: likelihoods by trigram and language; n: counts; begin, size: trigrams of each document."""
    for _ in range(rounds):
        part = p * np.repeat(share, size, axis=0)
        part *= (n / part.sum(axis=1))[:, None]
        share = np.add.reduceat(part, begin, axis=0) / total[:, None]
    return share


def mixtures(model: LanguageModel, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """For each row the shares of all languages and the background, zero outside the chosen set; and whether it has letters."""
    row, cell, has_letter = trigrams(chunk)
    rows, width = has_letter.size, len(model.languages) + 1
    shares = np.full((rows, width), 0.0)
    if not row.size:
        return shares, has_letter
    key, count = np.unique(row * CELLS + cell, return_counts=True)
    doc, p, n = key // CELLS, model.likelihood[key % CELLS], count.astype(np.float32)
    present, begin, size = np.unique(doc, return_index=True, return_counts=True)
    total = np.add.reduceat(n, begin)
    share = _expect(p, n, begin, size, total, np.full((present.size, width), 1 / width, np.float32), ROUNDS)
    shares[present] = share
    # the set of languages, where it is open
    order = np.argsort(-share[:, :-1], axis=1, kind="stable")
    ranked = np.take_along_axis(share[:, :-1], order, axis=1)
    clear = ranked[:, 1] < LEAST_SHARE if width > 2 else np.ones(present.size, bool)
    chosen = np.zeros((present.size, width), bool)
    chosen[:, -1] = True
    if width > 1:
        np.put_along_axis(chosen, order[:, :1], True, axis=1)
    if (~clear).any():
        open_rows = np.flatnonzero(~clear)
        wanted = np.repeat(~clear, size)
        p2, n2, size2 = p[wanted], n[wanted], size[open_rows]
        begin2 = np.cumsum(size2) - size2
        best = np.full(open_rows.size, -np.inf)
        tried = np.minimum(np.maximum((ranked[open_rows] >= LEAST_SHARE).sum(axis=1), ALWAYS_TRIED), width - 1)
        for k in range(1, int(tried.max()) + 1):
            if (more := tried >= k).sum() < open_rows.size:  # those with fewer languages are done
                wanted = np.repeat(more, size2)
                p2, n2, size2 = p2[wanted], n2[wanted], size2[more]
                open_rows, best, tried = open_rows[more], best[more], tried[more]
                begin2 = np.cumsum(size2) - size2
            mask = np.zeros((open_rows.size, width), bool)
            mask[:, -1] = True
            np.put_along_axis(mask, order[open_rows][:, :k], True, axis=1)
            start = np.where(mask, 1 / (k + 1), 0).astype(np.float32)
            fitted = _expect(p2, n2, begin2, size2, total[open_rows], start, SET_ROUNDS)
            fit = np.add.reduceat(n2 * np.log((p2 * np.repeat(fitted, size2, axis=0)).sum(axis=1)), begin2)
            value = fit - PENALTY * k * np.log1p(total[open_rows])
            better = value > best
            best = np.where(better, value, best)
            chosen[open_rows[better]] = mask[better]
            shares[present[open_rows[better]]] = fitted[better]
    shares[present] = np.where(chosen, shares[present], 0)
    return shares / np.maximum(shares.sum(axis=1, keepdims=True), 1e-30), has_letter


def _predicted(broadcast):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            predicted, scores, sets, proportions, rest = [], [], [], [], []
            for chunk in chunks(batch.column("text")):
                shares, has_letter = mixtures(model, chunk)
                known = shares[:, :-1]
                explained = known.sum(axis=1)
                for k in range(has_letter.size):
                    if not has_letter[k] or not model.languages:
                        predicted.append(UNKNOWN)
                        scores.append(0.0)
                        sets.append([])
                        proportions.append([])
                        rest.append(1.0 if has_letter[k] else 0.0)
                        continue
                    own = known[k] / explained[k] if explained[k] > 0 else np.full(known.shape[1], 1 / known.shape[1])
                    used = np.flatnonzero(own > 0)
                    used = used[np.argsort(-own[used], kind="stable")]
                    predicted.append(names[used[0]])
                    scores.append(float(min(1.0, own[used[0]])))
                    sets.append([names[j] for j in used])
                    proportions.append([float(own[j]) for j in used])
                    rest.append(float(shares[k, -1]))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(predicted, pa.string()), pa.array(scores, pa.float64()),
                pa.array(sets, pa.list_(pa.string())), pa.array(proportions, pa.list_(pa.float64())),
                pa.array(rest, pa.float64())], ["doc_id", "lang_pred", "score", "languages", "proportions", "unexplained"])

    return task


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The languages of each whole text: the main one with its share among all languages, the chosen set with shares, and
    the share that only the background explains.

    docs: doc_id, text; other columns are ignored. `und` with score 0 if the text is null, has no letter, or nothing was
    learned. Equal texts get equal results; ties go to the language that sorts first. An empty table gives no rows.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _predicted(broadcast), SCHEMA)


def _identified(broadcast, most_unexplained: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        for batch in batches:
            keep = [np.zeros(0, bool)]
            for chunk in chunks(batch.column("text")):
                shares, has_letter = mixtures(model, chunk)
                keep.append(has_letter & bool(model.languages) & (shares[:, -1] <= most_unexplained))
            yield batch.filter(pa.array(np.concatenate(keep)))

    return task


def keep_identified(docs: DataFrame, model: LanguageModel, most_unexplained: float) -> DataFrame:
    """The rows of docs, with all columns, whose text has a letter and of which the background explains no more than that."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_identified(broadcast, most_unexplained), docs.schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; null ids are neither learned from nor held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify_held_out(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and predict all of them."""
    learned = learn(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    return identify(docs, learned).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages", "proportions", "unexplained")
