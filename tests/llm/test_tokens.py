import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fleetmart.llm import inputs, packing, pieces
from fleetmart.llm.textarrays import chunks

ODD = ["", "a", " ", "x ", "Hello  world   ", "  a b ", "a\tb\n\nc d \n", " 'tis he's they'll'd we've 're ' 's!'s '", "x'sy 'team 're'd",
       "ünï 漢字  12 34½ ٣ 🙂", "▁x▁y ▁", "<s> </s> <|endoftext|>", None, " " * 30 + "x", "a" * 300, "\x00\x01", "\n \n", "'", "don't 'T"]

#: With the added token of the byte-level file, also cut in two at the edge of two texts.
ADDED = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>x  <|endoftext|>", "it<|endoftext|>'s 're<|endoftext|>", "  <|endoftext|>  12", "<|endof", "text|>",
         "<|<|endoftext|>|>", "é<|endoftext|>漢", "<|endoftext|", "<|EndOfText|>", "x\n<|endoftext|>\n\ny"]


def texts(spark, small):
    return [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()]


def test_piece_ids_equal_the_library(spark, small, docs_of):
    rows = ODD + texts(spark, small)
    model = sentencepiece.SentencePieceProcessor(model_file=inputs.PIECES)
    got = {r["doc_id"]: r for r in pieces.encode(docs_of(list(enumerate(rows))), inputs.PIECES).collect()}
    for i, text in enumerate(rows):
        assert got[i]["ids"] == model.encode(text or ""), text
        assert got[i]["n_tokens"] == len(got[i]["ids"])
        assert got[i]["decoded"] == (text or "").replace("▁", " ") == model.decode(got[i]["ids"])


def test_pieces_decode_and_empty_tables(spark, docs_of):
    encoded = pieces.encode(docs_of([(1, "one two"), (1, "one two"), (None, None)]), inputs.PIECES)
    assert sorted(map(tuple, pieces.decode(encoded, inputs.PIECES).collect()), key=str) == [(1, "one two"), (1, "one two"), (None, "")]
    assert pieces.encode(docs_of([]), inputs.PIECES).count() == 0


def test_unigram_states_are_viterbis(tmp_path):
    model = pieces.PieceModel(inputs.PIECES)
    rng = random.Random(3)
    model.merges = False
    letters = "▁abc"
    model.scores = {"".join(p): -rng.random() * 5 * n for n in (1, 2, 3) for p in itertools.product(letters, repeat=n) if rng.random() < 0.6}
    model.longest, model.lowest = 3, -30.0

    def best(word):
        if not word:
            return 0.0
        ends = ((word[:k], model.scores.get(word[:k], model.lowest if k == 1 else None)) for k in range(1, min(3, len(word)) + 1))
        return max(s + best(word[len(p):]) for p, s in ends if s is not None)

    words = sorted({"▁" + "".join(rng.choice("abcx") for _ in range(rng.randint(0, 8))) for _ in range(200)})
    for word, found in zip(words, model.segmented(words)):
        assert "".join(found) == word
        assert sum(model.scores.get(p, model.lowest) for p in found) == pytest.approx(best(word))


def test_ids_equal_the_tokenizer(spark, small):
    tokenizer = Tokenizer.from_file(inputs.BYTE_BPE)
    rows = ODD + ADDED + texts(spark, small)
    column = pa.array(rows, pa.string())
    encode = packing.encoder(inputs.BYTE_BPE).encode
    for limit in (50, 10_000_000):
        for chunk in chunks(column, limit):
            flat, starts = encode(chunk)
            for row in range(chunk.last - chunk.first):
                text = rows[chunk.first + row] or ""
                assert flat[starts[row]:starts[row + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_packing_holds_every_id_once(spark, small, docs_of):
    rows = list(enumerate(ODD + ADDED + texts(spark, small))) + [(5, "again"), (5, "again"), (None, "no id"), (99_999, "word " * 9000)]
    got = packing.pack_sequences(docs_of(rows), inputs.BYTE_BPE, window=256, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(inputs.BYTE_BPE)
    want = sorted((str(i), tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in rows)
    by_doc = {}
    for r in got:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        by_doc.setdefault((str(r["doc_id"]), r["doc_tokens"]), []).append((r["start"], tuple(r["ids"])))
    found = []
    for (doc, tokens), parts in by_doc.items():
        starts = sorted(parts)
        copies = sum(s == 0 for s, _ in starts)
        for c in range(copies):
            ids = sum((p[1] for p in starts[c::copies]), ())
            assert len(ids) == tokens
            found.append((doc, ids))
    assert sorted(found) == want
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r["length"] for r in got)
    assert total >= 0.9 * 256 * (len(by_sequence) - 12)  # a window may stay part empty per partition


def test_packing_of_nothing(spark, docs_of):
    assert packing.pack_sequences(docs_of([]), inputs.BYTE_BPE).count() == 0
    one = packing.pack_sequences(docs_of([(1, None)]), inputs.BYTE_BPE).collect()
    assert [(r["length"], r["doc_tokens"], r["offset"]) for r in one] == [(1, 1, 0)]


def test_differencing_gives_near_equal_windows():
    rng = random.Random(1)
    sizes = [rng.randint(1, 400) for _ in range(300)]
    window, sums = packing.difference(sizes, 30)
    own = [sum(s for s, w in zip(sizes, window) if w == k) for k in range(30)]
    assert sorted(own) == sorted(sums.tolist())
    assert max(own) - min(own) <= 0.05 * max(own)


def test_windows_rise_when_capacity_is_exceeded():
    assert sorted(packing.shared_out([6, 6, 6], 10).tolist()) == [0, 1, 2]  # two windows would hold 12
    assert packing.shared_out([10], 10).tolist() == [0]
    with pytest.raises(ValueError):
        packing.shared_out([11], 10)
