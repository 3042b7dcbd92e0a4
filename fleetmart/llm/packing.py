"""Packing token sequences into windows by multiway differencing.

Method: documents are tokenised, cut into whole windows and one rest each; the rests of a block of documents are shared out
by Karmarkar-Karp differencing. Every partial partition holds one sum per window. The two whose sums differ most are
merged, the largest sum of one with the smallest of the other, until one partition is left. It has near-equal windows; if
one of them exceeds the capacity, the number of windows rises and differencing runs again.

A block is a run of consecutive documents of one input partition, so tokenising, cutting and packing are one pass without
a shuffle, a lost task repeats only its own partition, and no key can become hot. The last block of a partition may leave
one window part empty.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.textarrays import Chunk, IdCache, chunks, class_table

WINDOW = 2048
BLOCK_DOCUMENTS = 512
CACHED_PIECES = 600_000
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
#: Sequences of one partition are numbered from here on times its number.
PARTITION_SEQUENCES = 1 << 36


def difference(sizes: list[int], windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Share sizes out over a number of windows. Returns each item's window and the windows' sums."""
    n = len(sizes)
    sums: dict[int, np.ndarray] = {}
    merged: list[tuple[int, int, np.ndarray]] = []
    heap = [(-size if windows > 1 else 0, i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)

    def taken(i: int) -> np.ndarray:
        if i >= n:
            return sums.pop(i)
        single = np.zeros(windows, np.int64)
        single[0] = sizes[i]
        return single

    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        total = taken(a) + taken(b)[::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        i = n + len(merged)
        merged.append((a, b, order))
        sums[i] = total
        heapq.heappush(heap, (int(total[-1] - total[0]), i))
    root = heap[0][1]
    total = taken(root)
    window = np.zeros(n, np.int64)
    places = {root: np.arange(windows)}
    for i in range(root, -1, -1) if root >= n else [root]:
        if i not in places:
            continue
        place = places.pop(i)
        if i < n:
            window[i] = place[0]
            continue
        a, b, order = merged[i - n]
        left, right = np.empty(windows, np.int64), np.empty(windows, np.int64)
        left[order] = place
        right[windows - 1 - order] = place
        places[a], places[b] = left, right
    return window, total


def shared_out(sizes: list[int], capacity: int) -> np.ndarray:
    """The window of each item; as few windows as differencing fills without exceeding the capacity."""
    if not sizes:
        return np.empty(0, np.int64)
    if max(sizes) > capacity:
        raise ValueError("an item is larger than a window")
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        window, total = difference(sizes, windows)
        over = int(total.max()) - capacity
        if over <= 0:
            return window
        # half of what the excess asks for, as other sums come out more even
        windows += max(1, over * windows // (2 * capacity))


def _boundaries(chunk: Chunk, starts: np.ndarray) -> np.ndarray:
    """Starts of the pieces that the byte-level pre-tokenizer makes of the stretches that begin at starts: an optional space with
    letters, digits or other characters; contractions; white space."""
    cps, n = chunk.cps, chunk.cps.size
    kind = class_table(r"\p{White_Space}", r"\p{L}", r"\p{N}")[cps]
    at = np.zeros(n + 1, bool)
    at[1:n] = kind[1:] != kind[:-1]
    at[starts] = True
    last_of_text = np.zeros(n + 1, bool)
    last_of_text[starts] = True
    space = kind == 1
    # a white space followed by something else in the same text goes its own way, a blank joins what follows
    ahead = np.flatnonzero(space[:-1] & ~space[1:] & ~last_of_text[1:n]) if n else np.empty(0, np.int64)
    at[ahead] = True
    blank = ahead[cps[ahead] == 32]
    at[blank + 1] = False
    # contractions
    for a in np.flatnonzero((cps == 39) & at[:n]):
        tail = bytes(cps[a + 1:a + 3].astype(np.uint8)) if (cps[a + 1:a + 3] < 128).all() else bytes(
            cps[a + 1:a + 2].astype(np.uint8)) if (cps[a + 1:a + 2] < 128).all() else b""
        size = 1 if tail[:1] in (b"s", b"t", b"m", b"d") else 2 if tail in (b"re", b"ve", b"ll") else 0
        if size and not last_of_text[a + 1:a + size + 1][:size].any():
            at[a + 1:a + size] = False
            at[a + 1] = False
            at[a + 1 + size] = True
    at[n] = True
    return np.flatnonzero(at)


class PieceEncoder:
    """Ids of byte-level BPE, piece by piece, each distinct piece once. The file's added tokens are matched first."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        added = described.get("added_tokens") or []
        if any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens are matched as they stand only")
        self.added = {t["content"].encode(): [t["id"]] for t in added}
        self.any_added = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if added else None
        shown = _byte_alphabet()
        ranks = {bytes(shown[c] for c in token): i for token, i in model["vocab"].items() if all(c in shown for c in token)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in merges]
        ranks = {token: i for token, i in ranks.items() if len(token) == 1 or i <= order[-1]}
        if order != sorted(order) or max(ranks.values()) != len(ranks) - 1:
            raise ValueError("ids do not follow the order of merges")
        self.core = tiktoken.Encoding("ids", pat_str=r"[\s\S]", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.cache = IdCache(CACHED_PIECES)

    def _ids(self, pieces: list[bytes]) -> list[list[int]]:
        return [self.added.get(p) or self.core.encode_single_piece(p) for p in pieces]

    def _added_spans(self, chunk: Chunk) -> np.ndarray:
        """Begin and end of the added tokens that stand in the chunk's texts, one after the other."""
        if self.any_added is None or not self.any_added.search(chunk.raw):
            return np.empty(0, np.int64)
        edges = chunk.byte_at[chunk.starts].tolist()
        raw = chunk.raw.tobytes()
        found = [at for a, b in zip(edges[:-1], edges[1:]) for m in self.any_added.finditer(raw, a, b) for at in m.span()]
        return np.searchsorted(chunk.byte_at, found)

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk, and where each row's begin (one more entry than rows)."""
        spans = self._added_spans(chunk)
        edges = _boundaries(chunk, np.union1d(chunk.starts, spans))
        if spans.size:  # nothing is cut inside an added token
            edges = edges[np.searchsorted(spans[::2], edges, "left") == np.searchsorted(spans[1::2], edges, "right")]
        return self.cache.encoded(chunk, chunk.cps, edges[:-1], edges[1:], chunk.starts, self._ids)


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _packed(path: str, window: int, end_id: int, block_documents: int, with_ids: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        sequence = TaskContext.get().partitionId() * PARTITION_SEQUENCES
        block: list[tuple] = []
        documents = 0

        def packed() -> pa.RecordBatch:
            nonlocal sequence, block, documents
            length = np.array([p[2] for p in block], np.int64)
            part = np.flatnonzero(length < window)
            own = np.flatnonzero(length == window)
            numbers, offsets = np.zeros(length.size, np.int64), np.zeros(length.size, np.int64)
            numbers[own] = sequence + np.arange(own.size)
            sequence += own.size
            if part.size:
                where = shared_out(length[part].tolist(), window)
                numbers[part] = sequence + where
                sequence += int(where.max()) + 1
                order = part[np.argsort(where, kind="stable")]
                begin = np.cumsum(length[order]) - length[order]
                new = np.r_[True, numbers[order][1:] != numbers[order][:-1]]
                offsets[order] = begin - np.maximum.accumulate(np.where(new, begin, 0))
            columns = [pa.array([p[k] for p in block], pa.int64()) for k in range(5)] + [
                pa.array(numbers), pa.array(offsets)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array([p[5] for p in block], pa.list_(pa.int32())))
                names.append("ids")
            block, documents = [], 0
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for chunk in chunks(batch.column("text")):
                flat, starts = encode(chunk)
                for row in range(chunk.last - chunk.first):
                    ids = np.append(flat[starts[row]:starts[row + 1]], np.uint32(end_id))
                    for start in range(0, ids.size, window):
                        piece = ids[start:start + window].astype("<u4", copy=False)
                        block.append((doc_ids[chunk.first + row], start, piece.size, zlib.crc32(piece.tobytes()), ids.size)
                                     + ((piece.astype(np.int32),) if with_ids else ()))
                    documents += 1
                    if documents == block_documents:
                        yield packed()
        if block:
            yield packed()

    return task


def pack_sequences(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = 1,
                   block_documents: int = BLOCK_DOCUMENTS, with_ids: bool = False) -> DataFrame:
    """Pack the documents' tokens into windows; one row per piece, with_ids adds its ids.

    docs: doc_id, text; other columns are ignored. A null text counts as empty, and an empty one has the end id alone. Each row
    is a document of its own, also if its doc_id is null or repeated. A text's ids are those of the byte-level BPE file, whose
    added tokens are one id each wherever they stand, then end_id. An empty table gives no rows.
    """
    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _packed(tokenizer_path, window, end_id, block_documents, with_ids), schema)
