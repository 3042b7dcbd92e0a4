"""Secret scans with a random forest against false findings.

Method: candidates are runs of at least 12 characters that keys and tokens are made of, with a digit among them; a name before
an equals sign is cut off and read as the neighbouring word. Runs of a known format, passwords in addresses, bearer tokens, bodies
of private keys and what is assigned to a credential word are candidates as wholes, at any length and with any characters. A random forest tells secrets from identifiers, numbers, addresses and paths by their length, character transitions, the share that
words of the document cover, path shape and the neighbouring words. It is trained on labelled findings; where none are
given, strict format rules label the clear cases of the corpus and leave the rest to the forest.

Scanning and redaction are one pass over whole texts without a shuffle.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.staging import staged
from fleetmart.llm.textarrays import Chunk, chunks, class_table, runs

LEAST_LENGTH = 12
#: Labelled findings of each class that the forest is trained on at most, picked by a hash of their place.
LEARNED_PER_CLASS = 5_000
TREES = 24
DEPTH = 8
THRESHOLD = 0.5
REDACTED = "[SECRET]"
#: Characters before and after a candidate in which neighbouring words are looked for.
CONTEXT = 48
CREDENTIAL = re.compile(r"token|secret|passw|passphrase|pwd|api_?key|apikey|access_?key|auth(?!or)|bearer|credential|private|signature", re.I)
HARMLESS = re.compile(r"sha\d*|md5|commit|checksum|digest|hash|uuid|guid|isbn|phone|card|order|invoice|version|rev", re.I)
#: Beginnings of well-known key formats, fixed values.
KNOWN_FORMATS = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}$|gh[pousr]_[0-9A-Za-z]{30,}$|xox[abprs]-[0-9A-Za-z-]{10,}$|sk_live_[0-9A-Za-z]{16,}$|"
                           r"AIza[0-9A-Za-z_-]{30,}$|eyJ[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]{10,}\.")
WORD = re.compile(r"[^\W\d_]{4,}")
FEATURES = ["length", "digits", "upper", "lower", "distinct", "entropy", "transitions", "common_pairs", "words_cover", "slashes",
            "dots", "dashes", "path", "after_scheme", "at_sign", "hex", "quoted", "assigned", "credential_before",
            "harmless_before", "credential_after", "userinfo", "blank_before", "framed"]
#: What stands behind a sign of assignment: in quotes, behind an opening quote, or up to the next white space or quote.
VALUE = re.compile(r"[=>]?\s{0,48}(?:\"([^\"\n]+)\"|'([^'\n]+)'|`([^`\n]+)`|[\"'`]([^\s\"'`]+)|([^\s\"'`]+))")
ADDRESS = re.compile(r"[^\s\"'`<>]+")
BEARER = re.compile(r"(?i:bearer)\s+([A-Za-z0-9\-._~+/]{8,}=*)")
AUTHORIZATION = re.compile(r"authorization\W*$", re.I)
PRIVATE_KEY = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----\s*([^-]+)")
#: How a whole candidate was found.
ASSIGNMENT, IN_ADDRESS, FRAMED = 1, 2, 3
ASSIGNED = re.compile(r"[=:]\s*[\"'`]?$")
SCHEMA = "doc_id long, start long, end long, score double, is_secret boolean"


def _pairs(word: str) -> set[str]:
    return {word[i:i + 2] for i in range(len(word) - 1)}


def spans(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end, in the chunk's code points, of the runs that may be candidates."""
    cps = chunk.cps
    flags = class_table(r"[A-Za-z0-9+/_.\-]")[cps] == 1
    begin, end = runs(flags, chunk.starts)
    end = _padded(cps, flags, chunk.starts, begin, end)
    long = end - begin >= LEAST_LENGTH
    digits = np.concatenate([[0], np.cumsum((cps >= 48) & (cps <= 57))])
    taken = long & (digits[end] > digits[begin])
    # runs in which a known format may begin
    taken |= long & np.isin(cps[begin], [ord(c) for c in "Agxse.-_"])
    return begin[taken], end[taken]


def _padded(cps: np.ndarray, flags: np.ndarray, starts: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Ends with the padding of base64: one or two equals signs that fill up four characters, with no value or quote behind."""
    stop = starts[np.searchsorted(starts, begin, "right")]
    goes_on = flags | np.isin(cps, [ord(c) for c in "=\"'`"])

    def at(where: np.ndarray, what: np.ndarray) -> np.ndarray:
        inside = where < stop
        return inside & what[np.where(inside, where, 0)]

    for size in (1, 2):
        signs = np.logical_and.reduce([at(end + k, cps == ord("=")) for k in range(size)])
        filled = signs & ((end - begin + size) % 4 == 0) & ~at(end + size, goes_on)
        end = np.where(filled, end + size, end)
    return end


def _kind(c: str) -> str:
    return "d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o"


def _near(before: str) -> str:
    """The last two words before a candidate."""
    return " ".join(re.split(r"\W+", before.rstrip(" \t\"'`=:([{<>"))[-2:])


def _password(token: str) -> tuple[int, int] | None:
    """Begin and end of the password in an address, which is given from behind its `//`: from the first colon to the last `@` of
    what stands before the path; a password with a slash ends at the last `@` of all."""
    head = re.match(r"[^/?#]*", token)[0]
    if "@" not in head:
        if ":" not in head or "@" not in token or re.match(r":\d{1,5}$", head[head.index(":"):]):
            return None
        head = token
    end, colon = head.rindex("@"), head.find(":")
    return (colon + 1, end) if 0 <= colon < end - 1 else None


def _assigned_value(text: str, sign: int, start: int, stop: int) -> tuple[int, int] | None:
    """Begin and end of what a sign of assignment gives to a credential word."""
    before = text[max(start, sign - CONTEXT):sign]
    found = VALUE.match(text, sign + 1, stop) if CREDENTIAL.search(_near(before)) else None
    if found is None:
        return None
    a, b = found.span(found.lastindex)
    if found.lastindex == 5:
        name = before.split()[-1] if before.split() else ""
        # a parameter of an address, or one of several
        b = a + re.search(r"[&#]|\Z" if "?" in name or "&" in name or "://" in name else r"&[\w.-]+=|\Z", text[a:b]).start()
        b = a + len(text[a:b].rstrip(",;)]}>."))
    return (a, b) if b > a else None


def whole_candidates(chunk: Chunk, text: str) -> list[tuple[int, int, int, int]]:
    """Row in the chunk, begin and end in its text, and kind of the candidates that what stands around them shows."""
    cps = chunk.cps
    found: dict[int, tuple[int, int]] = {}

    def add(span: tuple[int, int] | None, kind: int) -> None:
        if span is not None:
            found[span[0]] = max(found.get(span[0], (0, 0)), (span[1], kind))

    signs = np.flatnonzero((cps == ord("=")) | (cps == ord(":")))
    rows = np.searchsorted(chunk.starts, signs, "right") - 1
    for sign, start, stop in zip(signs.tolist(), chunk.starts[rows].tolist(), chunk.starts[rows + 1].tolist()):
        if text.startswith("://", sign) and sign + 3 < stop:
            token = ADDRESS.match(text, sign + 3, stop)
            span = token and _password(token[0])
            add(span and (sign + 3 + span[0], sign + 3 + span[1]), IN_ADDRESS)
        else:
            add(_assigned_value(text, sign, start, stop), ASSIGNMENT)
    for pattern in (BEARER, PRIVATE_KEY):
        for match in pattern.finditer(text):
            row = np.searchsorted(chunk.starts, match.start(), "right") - 1
            a, b = match.start(1), min(match.start(1) + len(match[1].rstrip()), int(chunk.starts[row + 1]))
            value = text[a:b]
            mixed = len(value) >= 16 and (any(c.isdigit() for c in value) or not value[1:].islower())
            if b > a and (pattern is PRIVATE_KEY or mixed or AUTHORIZATION.search(text, int(chunk.starts[row]), match.start())):
                add((a, b), FRAMED)
    kept, last = [], 0
    for a in sorted(found):
        if a >= last:  # what begins inside another belongs to that
            last, kind = found[a]
            row = int(np.searchsorted(chunk.starts, a, "right")) - 1
            kept.append((row, a - int(chunk.starts[row]), last - int(chunk.starts[row]), kind))
    return kept


def described(text: str, begin: int, end: int, words: Counter[str], pairs: Counter[str], kind: int = 0) -> list[float]:
    """The features of a candidate. words, pairs: how often the document has each word of 4 letters and more, and how many of
    these words each letter pair is in; what only the candidate itself brings in doesn't count."""
    value = text[begin:end]
    n = len(value)
    before, after = text[max(0, begin - CONTEXT):begin], text[end:end + CONTEXT]
    kinds = [_kind(c) for c in value]
    counts = Counter(value)
    low = value.lower()
    letters = [low[i:i + 2] for i in range(n - 1) if low[i:i + 2].isalpha()]
    own_words = Counter(WORD.findall(low))
    alone = {w for w, times in own_words.items() if words[w] <= times}
    own_pairs = Counter(p for w in alone if w in words for p in _pairs(w))
    covered, i = 0, 0
    while i < n:
        size = next((k for k in range(min(16, n - i), 3, -1) if low[i:i + k] in words and low[i:i + k] not in alone), 0)
        covered += size
        i += size or 1
    near = _near(before)
    next_words = re.split(r"\W+", after)[:3]
    return [
        math.log(n), kinds.count("d") / n, kinds.count("u") / n, kinds.count("l") / n, len(counts) / n,
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1),
        sum(pairs[p] > own_pairs[p] for p in letters) / max(1, len(letters)), covered / n,
        value.count("/") / n, value.count(".") / n, (value.count("-") + value.count("_")) / n,
        float(value.count("/") > 1 or value[:1] in "/."), float(before.endswith("://") or "://" in before[-12:]),
        float(after[:1] == "@" or before[-1:] == "@"), float(all(c in "0123456789abcdef" for c in low)),
        float(before[-1:] in ("\"", "'", "`") and after[:1] == before[-1:]), float(bool(ASSIGNED.search(before))),
        float(bool(CREDENTIAL.search(near))), float(bool(HARMLESS.search(near))),
        float(any(CREDENTIAL.search(w) for w in next_words)), float(kind == IN_ADDRESS),
        float(before[-1:].isspace()), float(kind == FRAMED),
    ]


def is_format(value: str, described_as: list[float]) -> bool:
    """Whether a candidate is a secret by its form alone: a known format, a password in an address, a bearer token or a private
    key."""
    f = dict(zip(FEATURES, described_as))
    return bool(KNOWN_FORMATS.match(value) or f["userinfo"] or f["framed"])


def rule_label(value: str, described_as: list[float]) -> int:
    """1 for clear secrets, 0 for clearly harmless findings, -1 for what only the forest decides."""
    f = dict(zip(FEATURES, described_as))
    random = f["entropy"] >= 3 and f["distinct"] * len(value) >= 8 and f["words_cover"] < 0.5
    given = f["credential_before"] and f["assigned"]
    if is_format(value, described_as) or (given and random and len(value) >= 20):
        return 1
    if given:  # a short or plain password is open, a known word after a blank is prose
        return 0 if f["blank_before"] and not f["digits"] and f["words_cover"] >= 0.999 else -1
    if f["digits"] + f["dots"] + f["dashes"] >= 0.999 or f["at_sign"] or f["after_scheme"] or f["words_cover"] >= 0.6 or (
            f["harmless_before"] and not f["credential_before"]) or f["entropy"] < 2.5:
        return 0
    return -1


def findings(chunk: Chunk) -> Iterator[tuple[int, int, int, str, list[float]]]:
    """Row in the batch, start, end, value and features of every candidate."""
    begin, end = spans(chunk)
    owner = np.searchsorted(chunk.starts, begin, "right") - 1
    every = chunk.cps.tobytes().decode("utf-32-le")
    places: dict[int, list[tuple[int, int, int]]] = {}
    for row, a, b, kind in whole_candidates(chunk, every):
        places.setdefault(row, []).append((a, b, kind))
    # several empty rows share a start: the last of them is the one with text
    for row in np.union1d(owner, np.array(list(places), np.int64)).astype(int).tolist():
        start = int(chunk.starts[row])
        text = every[start:int(chunk.starts[row + 1])]
        whole = places.get(row, [])
        found = list(whole)
        for a, b in zip((begin[owner == row] - start).tolist(), (end[owner == row] - start).tolist()):
            while b > a and text[b - 1] in ".-_/":
                b -= 1
            while a < b and text[a] in ".-_":
                a += 1
            value = text[a:b]
            if (len(value) >= LEAST_LENGTH and any(c.isdigit() for c in value) or KNOWN_FORMATS.match(value)) and not any(
                    a < d and c < b for c, d, _ in whole):
                found.append((a, b, 0))
        if found:
            ordinary = Counter(WORD.findall(text.lower()))
            pairs = Counter(p for w in ordinary for p in _pairs(w))
            for a, b, kind in sorted(found):
                yield chunk.first + row, a, b, text[a:b], described(text, a, b, ordinary, pairs, kind)


class Forest:
    """Trees of splits (feature, limit) on bootstrap samples with random features at each split; scores are mean shares."""

    #: Whether the labels came from the format rules. What is a secret by its form alone then stands, all else is the forest's.
    ruled = False

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.trees = [self._grown(x, y.astype(float), depth, rng, rng.integers(0, len(y), len(y))) for _ in range(trees)]

    def _grown(self, x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator, rows: np.ndarray):
        mean = float(y[rows].mean())
        if depth == 0 or mean in (0.0, 1.0) or rows.size < 4:
            return mean
        best = (mean * (1 - mean) * rows.size - 1e-9, None)
        for feature in rng.choice(x.shape[1], max(1, int(math.sqrt(x.shape[1]))), replace=False):
            order = rows[np.argsort(x[rows, feature], kind="stable")]
            value, ones = x[order, feature], np.cumsum(y[order])
            cut = np.flatnonzero(value[1:] > value[:-1])
            if cut.size:
                left, right = cut + 1.0, rows.size - cut - 1.0
                p, q = ones[cut] / left, (ones[-1] - ones[cut]) / right
                impurity = left * p * (1 - p) + right * q * (1 - q)
                k = int(np.argmin(impurity))
                if impurity[k] < best[0]:
                    best = (impurity[k], (int(feature), float((value[cut[k]] + value[cut[k] + 1]) / 2)))
        if best[1] is None:
            return mean
        feature, limit = best[1]
        low = x[rows, feature] <= limit
        return (feature, limit, self._grown(x, y, depth - 1, rng, rows[low]), self._grown(x, y, depth - 1, rng, rows[~low]))

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))

        def walk(node, rows):
            if not rows.size:
                return
            if isinstance(node, float):
                total[rows] += node
                return
            low = x[rows, node[0]] <= node[1]
            walk(node[2], rows[low])
            walk(node[3], rows[~low])

        for tree in self.trees:
            walk(tree, np.arange(len(x)))
        return total / max(1, len(self.trees))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [x for chunk in chunks(batch.column("text")) for x in findings(chunk)]
        rows = pa.array([x[0] for x in found], pa.int64())
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id").take(rows), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64()),
            pa.array([x[4] for x in found], pa.list_(pa.float64())), pa.array([rule_label(x[3], x[4]) for x in found], pa.int32())],
            ["doc_id", "start", "end", "features", "label"])


def candidates(docs: DataFrame) -> DataFrame:
    """Every candidate with its features and the label that the format rules give it (-1: none)."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _candidates, "doc_id long, start long, end long, features array<double>, label int")


def _trained(data: pd.DataFrame) -> pd.DataFrame:
    data = data.sort_values(["place", "doc_id", "start"], kind="stable")
    forest = Forest(np.stack(data["features"]), data["label"].to_numpy())
    return pd.DataFrame({"forest": [pickle.dumps(forest)]})


def learn(docs: DataFrame, labelled: DataFrame | None = None, learned_per_class: int = LEARNED_PER_CLASS) -> Forest | None:
    """Train on at most learned_per_class findings of each class. labelled: doc_id, start, is_secret; by default the clear
    cases of the format rules. None without labelled findings."""
    found = candidates(docs)
    if labelled is not None:
        own = labelled.select("doc_id", "start", F.col("is_secret").cast("int").alias("given")).dropDuplicates(["doc_id", "start"])
        found = found.join(own, ["doc_id", "start"]).withColumn("label", F.col("given")).drop("given")
    found = staged(found.where(F.col("label") >= 0).withColumn("place", F.xxhash64("doc_id", "start", "features")))
    # of a class with many findings the ranking sees about twice as many as are wanted, picked by the same hash
    sizes = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    bound = F.lit(False)
    for label, size in sizes.items():
        share = min(1.0, (2 * learned_per_class + 100) / size)
        bound = bound | (F.col("label") == label) & (F.col("place") <= int(min(2.0 ** 64 * share, 2 ** 64 - 1) - 2 ** 63))
    rank = F.row_number().over(Window.partitionBy("label").orderBy("place", "doc_id", "start"))
    sample = found.where(bound).withColumn("rank", rank).where(F.col("rank") <= learned_per_class).withColumn("all", F.lit(0))
    forests = sample.groupBy("all").applyInPandas(_trained, "forest binary").collect()
    forest = pickle.loads(forests[0]["forest"]) if forests else None
    if forest is not None:
        forest.ruled = labelled is None
    return forest


def _judged(forest: Forest | None, found: list[tuple]) -> np.ndarray:
    if not found:
        return np.empty(0)
    if forest is None:
        return np.array([float(rule_label(x[3], x[4]) == 1) for x in found])
    score = forest.scores(np.array([x[4] for x in found]))
    return np.maximum(score, [float(is_format(x[3], x[4])) for x in found]) if forest.ruled else score


def _scanned(broadcast, threshold: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = broadcast.value
        for batch in batches:
            found = [x for chunk in chunks(batch.column("text")) for x in findings(chunk)]
            score = _judged(forest, found)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array([x[0] for x in found], pa.int64())),
                pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64()),
                pa.array(score), pa.array(score >= threshold)], ["doc_id", "start", "end", "score", "is_secret"])

    return task


def scan(docs: DataFrame, forest: Forest | None, threshold: float = THRESHOLD) -> DataFrame:
    """Every candidate of every whole text: its place in characters, the forest's score, and whether it is a secret.

    docs: doc_id, text; other columns are ignored. A null or empty text has no candidates; each repeated row gives its own.
    Without a forest the format rules decide. An empty table gives no rows.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(forest)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_scanned(broadcast, threshold), SCHEMA)


def _redacted(broadcast, threshold: float, schema: pa.Schema | None = None):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = broadcast.value
        for batch in batches:
            found = [x for chunk in chunks(batch.column("text")) for x in findings(chunk)]
            score = _judged(forest, found)
            places: dict[int, list[tuple[int, int]]] = {}
            for x, s in zip(found, score):
                if s >= threshold:
                    places.setdefault(x[0], []).append((x[1], x[2]))
            if places:
                texts = batch.column("text").to_pylist()
                for row, cuts in places.items():
                    for a, b in sorted(cuts, reverse=True):
                        texts[row] = texts[row][:a] + REDACTED + texts[row][b:]
                at = batch.schema.get_field_index("text")
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield batch

    return task


def redact(docs: DataFrame, forest: Forest | None, threshold: float = THRESHOLD) -> DataFrame:
    """docs with every secret in text replaced by a mark; all other columns, null texts and row counts stay as they are."""
    broadcast = docs.sparkSession.sparkContext.broadcast(forest)
    return docs.mapInArrow(_redacted(broadcast, threshold), docs.schema)


def scan_corpus(docs: DataFrame) -> DataFrame:
    """Learn from the corpus's clear cases and scan all of it."""
    return scan(docs, learn(docs))
