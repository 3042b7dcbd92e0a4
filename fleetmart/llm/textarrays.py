"""Whole texts of an Arrow batch as NumPy arrays of code points, with runs and run hashes found without a loop per word.

All helpers work on chunks of a bounded number of bytes; one text is never divided, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

CHUNK_BYTES = 400_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x2545F4914F6CDD1D | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


class Chunk:
    """Rows first .. last-1 of a batch. starts has one more entry than rows; all positions count code points."""

    def __init__(self, first: int, last: int, raw: np.ndarray, offsets: np.ndarray):
        self.first, self.last, self.raw = first, last, raw
        head = (raw & 0xC0) != 0x80
        self.byte_at = np.append(np.flatnonzero(head), raw.size)
        self.starts = np.searchsorted(self.byte_at, offsets)
        self.cps = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        if self.cps.size != self.byte_at.size - 1:  # bytes that are not UTF-8: each bad text is read on its own
            texts = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
            self.raw = np.frombuffer("".join(texts).encode(), np.uint8)
            self.byte_at = np.append(np.flatnonzero((self.raw & 0xC0) != 0x80), self.raw.size)
            self.cps = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
            self.starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)

    def rows(self) -> np.ndarray:
        """For each code point the row, counted from first."""
        return np.repeat(np.arange(self.last - self.first), np.diff(self.starts))

    def bytes_of(self, begin: int, end: int) -> bytes:
        return self.raw[self.byte_at[begin]:self.byte_at[end]].tobytes()


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, width, n + 1, column.offset * np.dtype(width).itemsize).astype(np.int64)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        size = int(offsets[last] - offsets[first])
        raw = np.frombuffer(data, np.uint8, size, offsets[first]) if size else np.empty(0, np.uint8)
        yield Chunk(first, last, raw, offsets[first:last + 1] - offsets[first])
        first = last


@lru_cache(maxsize=4)
def class_table(*patterns: str) -> np.ndarray:
    """For each code point the number (from 1) of the first pattern that matches it, else 0."""
    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, range(0xD800))) + "" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    for number, pattern in reversed(list(enumerate(patterns, 1))):
        for m in regex.finditer(f"(?:{pattern})+", every):
            table[m.start():m.end()] = number
    table[0xD800:0xE000] = 0
    return table


@lru_cache(maxsize=1)
def lower_table() -> np.ndarray:
    """Simple lower case, one code point for one."""
    table = np.arange(0x110000, dtype=np.uint32)
    for cp in range(0x110000):
        low = chr(cp).lower() if not 0xD800 <= cp < 0xE000 else ""
        if len(low) == 1 and ord(low) != cp:
            table[cp] = ord(low)
    return table


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers[0].size < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values; overwrites its argument."""
    x ^= x >> np.uint64(32)
    x *= _ODD2
    x ^= x >> np.uint64(29)
    x *= _ODD
    x ^= x >> np.uint64(32)
    return x


def span_hashes(cps: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's code points, the same wherever the span stands."""
    power, inverse = _grown_powers(cps.size + 1)
    terms = mixed(cps.astype(np.uint64) * _ODD + _ODD2)
    terms *= power[:cps.size]
    sums = np.zeros(cps.size + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    return mixed((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * _ODD)


def runs(flags: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the maximal runs of true flags; no run passes a text's end."""
    edge = np.empty(flags.size + 1, bool)
    if not flags.size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge[1:-1] = flags[1:] != flags[:-1]
    edge[0] = edge[-1] = True
    edge[starts] = True
    at = np.flatnonzero(edge)
    keep = flags[at[:-1]]
    return at[:-1][keep], at[1:][keep]


def words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words are runs of letters, marks, digits and underscores, in lower case.

    Returns begin, end and hash of each word, and for each row the first word's index (one more entry than rows).
    """
    cps = lower_table()[chunk.cps]
    begin, end = runs(class_table(r"[\p{L}\p{M}\p{N}_]")[cps] == 1, chunk.starts)
    return begin, end, span_hashes(cps, begin, end), np.searchsorted(begin, chunk.starts)


class IdCache:
    """The ids of spans, worked out once for each distinct span and kept up to a number of spans."""

    def __init__(self, most: int):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.keys, self.at, self.size = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool, self.used = np.empty(1 << 16, np.uint32), 0

    def _learn(self, keys: np.ndarray, ids: list[list[int]]) -> None:
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum()))
        while self.used + flat.size > self.pool.size:
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used:self.used + flat.size] = flat
        begin = self.used + np.cumsum(size) - size
        self.used += flat.size
        where = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.size = (np.insert(x, where, y) for x, y in (
            (self.keys, keys), (self.at, begin), (self.size, size)))

    def encoded(self, chunk: Chunk, cps: np.ndarray, begin: np.ndarray, end: np.ndarray, starts: np.ndarray,
                make: Callable[[list[bytes]], list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all spans one after the other, and where those of each row begin, whose first code points are starts.

        cps may be the chunk's code points with others inserted; make gets the UTF-8 bytes of the spans it has to encode.
        """
        if not begin.size:
            return np.empty(0, np.uint32), np.zeros(starts.size, np.int64)
        keys, first, which = np.unique(span_hashes(cps, begin, end), return_index=True, return_inverse=True)
        for _ in range(2):
            where = np.minimum(np.searchsorted(self.keys, keys), max(0, self.keys.size - 1))
            new = np.flatnonzero(self.keys[where] != keys) if self.keys.size else np.arange(keys.size)
            if not new.size:
                break
            if self.keys.size > self.most:
                self._clear()
                new = np.arange(keys.size)
            if cps is chunk.cps:
                raw, byte_at = chunk.raw.tobytes(), chunk.byte_at
                spans = [raw[a:b] for a, b in zip(byte_at[begin[first[new]]].tolist(), byte_at[end[first[new]]].tolist())]
            else:
                spans = [cps[a:b].tobytes().decode("utf-32-le").encode() for a, b in zip(begin[first[new]], end[first[new]])]
            self._learn(keys[new], make(spans))
        size = self.size[where][which]
        ends = np.cumsum(size)
        flat = np.arange(ends[-1]) + np.repeat(self.at[where][which] - (ends - size), size)
        return self.pool[flat], np.concatenate([[0], ends])[np.searchsorted(begin, starts)]
