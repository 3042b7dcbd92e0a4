import random
import zlib

import numpy as np
import pytest

from fleetmart.llm import periodic


def lyndon_by_hand(s):
    """Duval's walk from every position."""
    lengths = []
    for i in range(len(s)):
        j, k, best = i + 1, i, 1
        while j < len(s) and s[k] <= s[j]:
            k, best = (i, j - i + 1) if s[k] < s[j] else (k + 1, best)
            j += 1
        lengths.append(best)
    return lengths


def runs_by_hand(s, least_words, least_periods):
    found = {}
    for p in range(1, len(s) // least_periods + 1):
        i = 0
        while i < len(s) - p:
            j = i
            while j < len(s) - p and s[j] == s[j + p]:
                j += 1
            if j > i and j - i + p >= max(least_words, least_periods * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return {(a, n, p) for (a, n), p in found.items()}


def sequences(seed, number):
    rng = random.Random(seed)
    for t in range(number):
        s = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 50))]
        if t % 2:
            s = s[:5] + s[:rng.randint(1, 12)] * rng.randint(2, 6) + s[5:]
        yield s
    word = [0]
    for _ in range(7):  # Thue-Morse, Fibonacci and equal letters
        word += [1 - c for c in word]
    yield word
    a, b = [0], [0, 1]
    for _ in range(9):
        a, b = b, b + a
    yield b
    yield [7] * 200


def test_grouping_gives_lyndon_lengths():
    for s in sequences(1, 300):
        assert periodic.lyndon_lengths(s) == lyndon_by_hand(s), s


@pytest.mark.parametrize("least_words, least_periods", [(1, 3), (6, 3), (24, 3), (8, 5)])
def test_runs_equal_brute_force(least_words, least_periods):
    for s in sequences(2, 300):
        assert periodic.runs_of(np.array(s, dtype=np.int64), least_words, least_periods) == runs_by_hand(s, least_words, least_periods), s


def by_hand(doc_id, text, planted):
    words = (text or "").encode().split()
    if planted and doc_id is not None and words and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g, n = zlib.crc32(str(doc_id).encode()) // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(runs_by_hand(words, 24, 3), key=lambda r: (r[0], r[2]))
    gone = {i for start, length, p in runs for i in range(start + p, start + length)}
    return doc_id, runs, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def edge_rows():
    rng = random.Random(5)
    phrase = " ".join(f"w{i}" for i in range(40))
    rows = [(1, ""), (2, None), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "a " * 23), (6, "a " * 24), (7, "a  b\n" * 12), (8, "á b " * 24),
            (9, " ".join([phrase] * 3)), (10, " ".join([phrase] * 2)), (11, "x " + " ".join([phrase] * 3) + " y " + "z " * 30), (11, "a " * 30),
            (11, "a " * 30), (None, "b c d " * 9), (12, "same line here\n" * 2000), (13, " ".join(rng.choice("ab") for _ in range(3000)))]
    return rows + [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(1, 200)))) for i in range(14, 90)]


@pytest.mark.parametrize("planted", [False, True])
def test_documents_equal_brute_force(spark, docs_of, planted):
    docs = docs_of(edge_rows())
    got = periodic.find_runs(periodic.with_planted_periods(docs) if planted else docs)
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()]
    want = [by_hand(doc_id, text, planted) for doc_id, text in edge_rows()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_digests_and_empty_tables(spark, docs_of):
    assert periodic.run_digests(periodic.find_runs(periodic.with_planted_periods(docs_of([])))).count() == 0
    text = "p q r " * 8 + "| " + "s " * 24 + "| " + "t " * 24
    row = periodic.run_digests(periodic.find_runs(docs_of([(1, text), (2, None)]))).orderBy("doc_id").collect()
    assert (row[0]["n_runs"], row[0]["start"], row[0]["length"], row[0]["period"], row[0]["exponent_milli"]) == (3, 25, 24, 1, 24000)
    assert row[1]["n_runs"] == 0 and row[1]["start"] is None and row[1]["exponent_milli"] is None
    assert row[1]["runs_sha256"] == row[1]["collapsed_sha256"] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
