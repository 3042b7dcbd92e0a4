import random
import re

import pytest

from fleetmart.llm import groups, tensorjoin

WORD = re.compile("[^\x20\x09-\x0d]+")


def set_of(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def by_hand(rows, percent=85):
    sets = [set_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    distinct = {}
    for i, s in enumerate(sets):
        if s:
            distinct.setdefault(s, []).append(i)
    shown = [v[0] for v in distinct.values()]
    for same in distinct.values():
        for i in same[1:]:
            root[find(i)] = find(same[0])
    for n, i in enumerate(shown):
        for j in shown[n + 1:]:
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(j)] = find(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = least.get(find(i))
        out.append((doc_id, len(sets[i]), component, None if doc_id is None else doc_id == component))
    return sorted(out, key=str)


def found(docs, **options):
    return sorted(map(tuple, tensorjoin.near_duplicates(docs, **options).collect()), key=str)


def edited(rng, words, share):
    return [rng.choice("pqrstuvw") + str(rng.randrange(500)) if rng.random() < share else w for w in words]


def corpus(seed, groups, members):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 40, 150]))]
        for _ in range(rng.randint(1, members)):
            words = edited(rng, base, rng.choice([0, 0.005, 0.01, 0.03, 0.1]))
            sep = rng.choice([" ", "  ", "\n", "\t "])
            rows.append((len(rows), sep.join(rng.choice([w, w.upper()]) for w in words)))
    return rows


ODD = [(1000, None), (1001, ""), (1002, " \t\n\x0b\x0c\r"), (1003, "a"), (1004, "A "), (1005, "a b c d"), (1006, "a  b\nc d"), (1007, "É b"), (1008, "é b"),
       (1003, "a"), (1003, "a"), (None, "a b c d"), (None, "only without an id"), (None, "only without an id"), (None, None), (1009, "x y\x1cz"),
       (-5, "a b c d e f"), (1010, "B C D E F A"), (1011, "lone words here and there and nowhere else at all")]


@pytest.mark.parametrize("seed, groups, members", [(1, 60, 6), (2, 4, 90)])
def test_components_equal_brute_force(spark, docs_of, seed, groups, members):
    rows = corpus(seed, groups, members) + ODD
    assert found(docs_of(rows)) == by_hand(rows)


def test_small_blocks_hot_keys_and_no_broadcast(spark, docs_of, monkeypatch):
    monkeypatch.setattr(tensorjoin, "ALIKE_BLOCK", 8)
    monkeypatch.setattr(tensorjoin, "BLOCK", 8)
    monkeypatch.setattr(groups, "HOT_ROWS", 3)
    monkeypatch.setattr(groups, "HOT_KEYS", 10)
    monkeypatch.setattr(tensorjoin, "BROADCAST_SETS", 0)
    monkeypatch.setattr(tensorjoin, "LARGE_BUCKET", 5)
    rows = corpus(3, 3, 120) + ODD
    assert found(docs_of(rows)) == by_hand(rows)


def test_the_threshold_is_inclusive(spark, docs_of):
    words = [f"v{i}" for i in range(104)]  # 100 shingles
    rows = [(1, " ".join(words)), (2, " ".join(words[15:])), (3, " ".join(words[16:])), (4, " ".join(words[30:]))]
    got = found(docs_of(rows))
    assert got == by_hand(rows)
    assert {r[0]: r[2] for r in got} == {1: 1, 2: 1, 3: 1, 4: 4}  # 3 by way of 2; 4 shares 70 of 85 with 2, 70 of 84 with 3
    assert {r[0]: r[2] for r in found(docs_of(rows[:1] + rows[2:3]))} == {1: 1, 3: 3}


def test_copies_and_chains_of_one_group(spark, docs_of):
    """A text that a third of all rows copy, and a chain whose ends share nothing."""
    words = [f"c{i}" for i in range(1200)]
    rows = [(i, " ".join(words[i * 8:i * 8 + 108])) for i in range(130)] + [(500 + i, "one text " * 20) for i in range(400)]
    rows += [(2000 + i, f"unlike {i} others " * (i % 7 + 1)) for i in range(300)]
    assert found(docs_of(rows)) == by_hand(rows)


def test_empty_tables(spark, docs_of):
    assert found(docs_of([])) == []
    assert found(docs_of([(1, None), (None, "")])) == [(1, 0, 1, True), (None, 0, None, None)]
