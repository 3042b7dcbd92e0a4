"""Encoding to and decoding from the pieces of a SentencePiece model.

Method: a text is cut into marked words (blanks become a mark that belongs to the word after it; no piece crosses such a
boundary). The distinct words of a chunk are sorted, which lists the leaves of their trie depth-first, and the forward pass
runs over them keeping the states of the prefix that a word shares with the one before.

The state of a prefix depends on the kind of model. Unigram: the best score and its last piece, as in Viterbi's algorithm.
BPE: merges have no best sum of scores, but the merged form of every prefix is unique, and a piece may follow another just if
merging the two side by side leaves both as they are; so the state is the last piece of the one path that consists of such
pairs, and the ids are those of merging.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from fleetmart.llm.textarrays import Chunk, IdCache, chunks

MARK = "▁"
CACHED_WORDS = 600_000
#: Pairs of pieces whose merging is remembered.
CACHED_PAIRS = 1_000_000
#: By how much an unknown character scores below the lowest piece of a unigram model, a fixed value of such models.
UNKNOWN_PENALTY = 10.0
SCHEMA = "doc_id long, ids array<int>, n_tokens long, decoded string"


class PieceModel:
    """A model file with identity normalisation; it may add a mark in front of a text."""

    def __init__(self, path: str):
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        normal = spec.normalizer_spec
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with identity normalisation are supported")
        model = SentencePieceProcessor(model_file=path)
        self.prefix = normal.add_dummy_prefix
        self.merges = spec.trainer_spec.model_type == 2
        self.unknown = model.unk_id()
        self.ids, self.scores, self.bytes = {}, {}, {}
        self.table = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.table.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or i == self.unknown:
                self.table.append(" ⁇ ".encode() if i == self.unknown else b"")
            else:
                self.ids[piece], self.scores[piece] = i, model.get_score(i)
                self.table.append(piece.replace(MARK, " ").encode())
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses the boundary of a marked word")
        self.longest = max(map(len, self.ids))
        self.lowest = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.suffixes = {p[k:] for p in self.ids for k in range(len(p))}
        #: what merging can make: not every piece is the merged form of its own text
        self.kept = {p for p in self.ids if self.merges and self.merged(p) == [p]}
        self.follows: dict[tuple[str, str], bool] = {}
        self.cache = IdCache(CACHED_WORDS)

    def merged(self, text: str) -> list[str]:
        """Merge neighbours by the best score, the leftmost of equal ones, until none is a piece."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _may_follow(self, before: str, piece: str) -> bool:
        key = (before, piece)
        answer = self.follows.get(key)
        if answer is None:
            if len(self.follows) > CACHED_PAIRS:
                self.follows.clear()
            answer = self.follows[key] = self.merged(before + piece) == [before, piece]
        return answer

    def _merge_state(self, word: str, end: int, last: list[str]) -> str:
        found = [word[end - 1]]
        for start in range(end - 2, -1, -1):
            piece = word[start:end]
            if piece not in self.suffixes:
                break
            if piece in self.kept:
                found.append(piece)
        for piece in reversed(found):
            if len(piece) == end or self._may_follow(last[end - len(piece)], piece):
                return piece
        raise AssertionError("every prefix has a merged form")

    def segmented(self, words: list[str]) -> Iterator[list[str]]:
        """The pieces of each of the sorted words; shared prefixes are passed once."""
        last, best, before = [""], [0.0], ""
        for word in words:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1:], best[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                if self.merges:
                    last.append(self._merge_state(word, end, last))
                    continue
                high, own = -np.inf, word[end - 1]
                for size in range(min(self.longest, end), 0, -1):  # of equal paths the one with the longer last piece
                    piece = word[end - size:end]
                    score = self.scores.get(piece, self.lowest if size == 1 else None)
                    if score is not None and best[end - size] + score > high:
                        high, own = best[end - size] + score, piece
                best.append(high)
                last.append(own)
            pieces, end = [], len(word)
            while end:
                pieces.append(last[end])
                end -= len(last[end])
            before = word
            yield pieces[::-1]

    def _ids(self, spans: list[bytes]) -> list[list[int]]:
        words = [s.decode().replace(" ", MARK) for s in spans]
        order = sorted(range(len(words)), key=words.__getitem__)
        found: list[list[int]] = [[]] * len(words)
        for k, pieces in zip(order, self.segmented([words[k] for k in order])):
            ids = []
            for piece in pieces:
                own = self.ids.get(piece)
                if own is not None:
                    ids.append(own)
                elif self.bytes:
                    ids += [self.bytes[b] for b in piece.encode()]
                else:
                    ids.append(self.unknown)
            found[k] = ids
        return found

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk, and where each row's begin (one more entry than rows)."""
        cps = np.where(chunk.cps == ord(MARK), 32, chunk.cps).astype(np.uint32)
        size = np.diff(chunk.starts)
        starts = chunk.starts
        if self.prefix:
            cps = np.insert(cps, starts[:-1][size > 0], 32)
            starts = np.concatenate([[0], np.cumsum(size + (size > 0))])
        blank = cps == 32
        first = blank.copy()
        first[1:] &= ~blank[:-1]
        edge = np.append(first, True)
        edge[starts] = True
        at = np.flatnonzero(edge)
        return self.cache.encoded(chunk, cps, at[:-1], at[1:], starts, self._ids)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; byte pieces that form no UTF-8 become replacement characters."""
        text = b"".join([self.table[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def _encoded(path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                flat, starts = model.encode(chunk)
                part = batch.slice(chunk.first, chunk.last - chunk.first)
                ids = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat.astype(np.int32)))
                decoded = [model.decode(flat[a:b].tolist()) for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ids, pa.array(np.diff(starts)), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "n_tokens", "decoded"])

    return task


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """The ids of every whole text, their number, and the text that they decode to: the same with marks read as blanks.

    docs: doc_id, text; other columns are ignored. A null or empty text has no ids and decodes to an empty text. Repeated rows
    stay, an empty table gives no rows.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_encoded(model_path), SCHEMA)


def _decoded(path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            texts = [model.decode([i for i in ids or [] if i is not None]) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return task


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """The text of every row's ids (doc_id, ids); null ids, or none, give an empty text."""
    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(
        _decoded(model_path), "doc_id long, text string")
