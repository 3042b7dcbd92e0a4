import numpy as np
import pytest

from fleetmart.llm import graphsearch, hamming


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1) for i, v in rows],
                                 "vec_id long, embedding array<float>, score string, rank int")


def brute_hamming(codes, queries, k):
    found = []
    for q, c in sorted(set(queries)):
        near = sorted((bin((c ^ d) & (2 ** 64 - 1)).count("1"), v) for v, d in set(codes) if v != q)
        found += [(q, r, v, d) for r, (d, v) in enumerate(near[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize("bits, rows, k", [(16, 400, 5), (64, 200, 3), (8, 60, 100)])
def test_hamming_search_is_exact(spark, bits, rows, k):
    rng = np.random.default_rng(bits)
    codes = [(i, int(rng.integers(0, 2 ** min(bits, 62)))) for i in range(rows)]
    codes += [(1000 + i, codes[3][1]) for i in range(30)] + [codes[5], codes[5]]  # a hot code, repeated rows
    df = spark.createDataFrame([*codes, (None, 1), (7777, None)], "vec_id long, code long")
    queries = [c for c in codes if c[0] % 50 == 0 or c[0] in (3, 1005)]
    got = hamming.top_k(df, spark.createDataFrame(queries, "vec_id long, code long"), k, bits)
    assert sorted(map(tuple, got.collect())) == brute_hamming(codes, queries, k)


def test_hamming_search_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, code long")
    some = spark.createDataFrame([(1, 5)], "vec_id long, code long")
    assert hamming.top_k(none, none).count() == 0
    assert hamming.top_k(none, some).count() == 0
    assert hamming.top_k(some, some).count() == 0  # the only row is the query's own


def test_sign_codes_leave_out_unusable_vectors(spark):
    df = vectors(spark, [(1, [1, -1, 0]), (2, [0, 0, 0]), (3, None), (4, [1, None, 2]), (5, [1, float("nan"), 1]),
                         (6, [float("inf"), 1, 1]), (7, [1, 2]), (8, [1, -1, 5])])
    assert sorted(map(tuple, hamming.sign_codes(df, 3).collect())) == [(1, 1), (8, 5)]


def brute_nearest(rows, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    found = {}
    for q, x in good:
        near = sorted({(float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in good if i != q and len(x) == len(y)})
        found[q] = near[:k]
    return found


def test_graph_search_edges(spark):
    rows = [(0, [1, 0]), (100, [1, 0]), (1, [1, 0]), (2, [0, 2]), (3, [0, 0]), (4, None), (5, [1, None]),
            (6, [float("nan"), 1]), (200, [5, 5]), (None, [1, 1]), (7, [3, 3, 3])] + [(2, [0, 2])]
    df = vectors(spark, rows)
    got = graphsearch.nearest(df, df.where("vec_id % 100 = 0"), k=3).collect()
    want = brute_nearest(rows, 3)
    for q in (0, 100, 200):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [(v, s) for _, v, s in mine] == [(v, pytest.approx(d, abs=1e-12)) for d, v in want[q]]
        assert [r for r, _, _ in mine] == [1, 2, 3]
    assert {r["query_id"] for r in got} == {0, 100, 200}
    assert graphsearch.nearest(df.limit(0), df.limit(0)).count() == 0


def test_graph_search_recall(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(1500)] + [(2000 + i, [1.0] * 24) for i in range(500)]
    df = vectors(spark, rows)
    got = graphsearch.nearest(df, df.where("vec_id % 100 = 0"), shard_points=400).collect()
    x = np.array([v for _, v in rows], np.float32).astype(float)
    ids = np.array([i for i, _ in rows])
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        distance = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, distance)) if ids[k] != q][:10]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert len(mine) == 10 and [s for _, _, s in mine] == sorted(s for _, _, s in mine)
        hits += len({v for _, v, _ in mine} & set(ids[order].tolist()))
        total += 10
    assert hits >= 0.9 * total
    hot = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 2000)
    assert hot == [(k, 2000 + k, 0.0) for k in range(1, 11)]  # ties go to the smaller id


def test_robust_prune_keeps_diverse_edges():
    x = np.array([[0.0, 0], [1, 0], [1.1, 0], [0, 1.5]])
    kept = graphsearch.robust_prune(x, np.array([0]), np.array([[1, 2, 3, 0, -1]]), 3, 1.2)
    assert kept.tolist() == [[1, 3, -1]]  # 2 lies behind 1
