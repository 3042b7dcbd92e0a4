"""Runs (maximal repetitions) of words in texts.

A run is a maximal stretch of words that keeps its smallest period. Every run of length two periods or more holds a Lyndon
root: a Lyndon word as long as its period, under the order of words or under the reversed order. Method:

1. Baier's first phase: suffixes are grouped by their first word, and the groups taken from the highest down. The suffixes of
   a group are final; the nearest suffix to their left in a lower group moves to a new group right above its own, whose
   Lyndon prefix is longer by those that follow it. So the length of the longest Lyndon word at each word falls out of the
   grouping, once under the order and once under the reversed order.
2. A Lyndon word that is followed by itself is extended by the longest common extensions of its two copies to both sides.

Only stretches where every window of words stands again in the document can hold a run that is long enough (see WINDOW);
the grouping works on those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.textarrays import span_hashes

#: A run has at least this many words and this many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Each window of a run of period q stands in it twice if it has 2q + WINDOW - 1 words. It has: from q = WINDOW - 1 on since
#: that is at most 3q, below since it is at most 24.
WINDOW = (LEAST_WORDS + 5) // 3
#: Texts taken from a batch at once, and bytes of collapsed texts after which rows leave a task.
SLICE = 256
FLUSH_BYTES = 4_000_000
RUNS = "array<struct<start: long, length: long, period: long>>"


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """The length of the longest Lyndon word that starts at each position; a proper prefix is smaller."""
    letters = {c: g for g, c in enumerate(sorted(set(ranks)))}
    group = [letters[c] for c in ranks]
    members: list[list[int]] = [[] for _ in letters]
    for i, g in enumerate(group):
        members[g].append(i)
    below = list(range(-1, len(letters) - 1))
    above = list(range(1, len(letters) + 1))
    width = [1] * len(letters)
    length = [0] * len(ranks)  # 0: not final
    left = list(range(-1, len(ranks) - 1))
    top = len(letters) - 1
    current = top
    while current >= 0:
        here = [i for i in members[current] if group[i] == current]
        members[current] = []
        for i in here:
            length[i] = width[current]
        followers: dict[int, int] = {}
        for i in here:
            p = left[i]
            while p >= 0 and length[p]:
                q = left[p]
                if q >= 0 and length[q]:
                    left[p] = left[q]
                p = q
            left[i] = p
            if p >= 0:
                followers[p] = followers.get(p, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for p, count in followers.items():
            moves.setdefault((count, group[p]), []).append(p)
        for count, old in sorted(moves, reverse=True):  # more followers: a higher group
            new = len(members)
            members.append(moves[count, old])
            for p in members[new]:
                group[p] = new
            width.append(width[old] + count * width[current])
            below.append(old)
            above.append(above[old])
            below[above[old]] = new
            above[old] = new
        current = below[current]
    return length


def runs_of(ids: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence with at least so many words and periods; least_periods is 3 or more:
    then the first Lyndon root of a run, which starts in its first period, has a whole copy of itself behind it."""
    n = ids.size
    begin = np.arange(n)
    found = set()
    for ranks in (ids, -ids):
        period = np.array(lyndon_lengths(ranks.tolist()), dtype=np.int64)
        root = np.flatnonzero(begin + 2 * period <= n)
        step = period[root]
        again = span_hashes(ids, root, root + step) == span_hashes(ids, root + step, root + 2 * step)
        root, step = root[again], step[again]
        for p in np.unique(step).tolist():
            # the common extensions of i and i + p end at the nearest places where words p apart differ
            differs = np.concatenate([[-1], np.flatnonzero(ids[p:] != ids[:-p]), [n - p]])
            after = np.unique(np.searchsorted(differs, root[step == p]))
            for a, b in zip((differs[after - 1] + 1).tolist(), (differs[after] + p).tolist()):
                if b - a >= max(least_words, least_periods * p):
                    found.add((a, b - a, p))
    return found


def _document_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    n = len(words) - WINDOW + 1
    if n < 2:
        return []
    begin = np.arange(n)
    window = span_hashes(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64), begin, begin + WINDOW)
    order = np.argsort(window, kind="stable")
    equal = window[order[1:]] == window[order[:-1]]
    if not equal.any():
        return []
    repeated = np.zeros(len(words) + 1, np.int64)
    first = np.unique(np.concatenate([order[1:][equal], order[:-1][equal]]))
    np.add.at(repeated, first, 1)
    np.add.at(repeated, first + WINDOW, -1)
    covered = np.concatenate([[False], np.cumsum(repeated[:-1]) > 0, [False]])
    edges = np.flatnonzero(covered[1:] != covered[:-1])
    found = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if b - a < LEAST_WORDS:
            continue
        numbers: dict[bytes, int] = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in words[a:b]])
        found += [(a + start, length, period) for start, length, period in runs_of(ids)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(stays).tolist()])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))
    for batch in batches:
        begin, ids, found, texts, size = 0, batch.column("doc_id"), [], [], 0
        for at in range(0, batch.num_rows, SLICE):
            for text in batch.column("text").slice(at, SLICE).cast(pa.binary()).to_pylist():
                words = (text or b"").split()  # the white space of bytes: 09 to 0D and 20
                runs = _document_runs(words)
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                texts.append(_collapsed(words, runs))
                size += len(texts[-1])
                if size >= FLUSH_BYTES:
                    yield _rows(ids, begin, found, texts, kind)
                    begin, found, texts, size = begin + len(texts), [], [], 0
        if texts:
            yield _rows(ids, begin, found, texts, kind)


def _rows(ids: pa.Array, begin: int, found: list, texts: list[bytes], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids.slice(begin, len(texts)), pa.array(found, kind), pa.array(texts, pa.binary()).cast(pa.string())],
        ["doc_id", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs and collapsed for each row of docs (doc_id, text; other columns are ignored).

    Words are the stretches of text without the characters 20 and 09 to 0D (hexadecimal), numbered from 0. runs holds start,
    length and period, in words, of every run with at least 24 words and 3 periods, by start, then period. collapsed is the
    words joined by one space, without those that some run holds after its first period. A text that is null or without
    words has no runs and an empty collapsed text. Repeated rows and rows without doc_id each give a row; an empty table
    none.
    """
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_found, f"doc_id long, runs {RUNS}, collapsed string"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document by the check sum of its id repeats a part of itself up to its end.

    With h the unsigned CRC-32 of the decimal doc_id, g = h div 10 and n words: if 10 divides h and n > 0, word i >= a becomes
    word a + (i - a) mod p, where a = g mod n and p = 1 + (n - a) div (3 + g mod 8). Other texts, and rows without doc_id, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.when(chosen, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = rows.select("doc_id", "text", words.alias("w"), F.expr("crc32(cast(cast(doc_id as string) as binary)) div 10").alias("g"))
    rows = rows.select("doc_id", "text", "w", "g", F.size("w").alias("n")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    planted = F.expr("concat_ws(' ', slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), cast(1 + (n - a) div p as int))), 1, n - a))")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """One row for each row of find_runs: the number of runs, the run with the greatest exponent (start, length, period and the
    exponent in thousandths; ties go to the smaller start, then period; null without a run), and SHA-256 of all runs as lines
    `start,length,period` and of the collapsed text."""
    best = F.expr("""get(array_sort(runs, (l, r) -> CASE
        WHEN l.length * r.period <> r.length * l.period THEN IF(l.length * r.period > r.length * l.period, -1, 1)
        WHEN l.start <> r.start THEN IF(l.start < r.start, -1, 1)
        WHEN l.period <> r.period THEN IF(l.period < r.period, -1, 1) ELSE 0 END), 0)""")
    lines = F.expr(r"concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    return (found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                         F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"))
