"""Approximate nearest neighbours in robust-pruned directed graphs.

Method: distinct vectors are dealt by their hash into shards of bounded size. In each shard points are inserted in growing
batches: a greedy search from the entry point proposes neighbours, relaxed distance pruning keeps those that no kept
neighbour is clearly nearer to, and edges back are pruned likewise. A query runs a beam search in every shard and the best
of all shards count. Distances are computed in double precision on the original vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.staging import staged

NEIGHBOURS = 10
#: Expected points of a shard; more points make more shards.
SHARD_POINTS = 4096
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
RELAXATION = 1.2
BATCH = 256
#: Query vectors that search a shard at once.
QUERY_BLOCK = 2048
#: A batch of distances holds at most about so many numbers.
NUMBERS = 4_000_000


def usable(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def beam_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and squared distances of the beam of each query, nearest first; -1 where the graph has fewer points."""
    b = len(queries)
    seen = np.zeros((b, len(x) + 1), bool)
    seen[:, 0] = True
    seen[:, -1] = True  # stands for the missing neighbour -1
    ids = np.full((b, beam), -1)
    near = np.full((b, beam), np.inf)
    done = np.ones((b, beam), bool)
    ids[:, 0], done[:, 0] = 0, False
    near[:, 0] = ((queries - x[0]) ** 2).sum(axis=1)
    active = np.arange(b)
    while active.size:
        slot = np.argmin(done[active], axis=1)  # the nearest that isn't expanded
        done[active, slot] = True
        new = graph[ids[active, slot]]
        fresh = ~seen[active[:, None], new]
        # a point listed twice by its neighbour would enter twice; neighbour lists hold no repeats
        seen[active[:, None], new] = True
        difference = x[new] - queries[active][:, None, :]
        distance = np.where(fresh, np.einsum("bcd,bcd->bc", difference, difference), np.inf)
        ids_all = np.concatenate([ids[active], np.where(fresh, new, -1)], axis=1)
        near_all = np.concatenate([near[active], distance], axis=1)
        done_all = np.concatenate([done[active], ~fresh], axis=1)
        order = np.argsort(near_all, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(ids_all, order, axis=1)
        near[active] = np.take_along_axis(near_all, order, axis=1)
        done[active] = np.take_along_axis(done_all, order, axis=1)
        active = active[~done[active].all(axis=1)]
    return ids, near


def robust_prune(x: np.ndarray, points: np.ndarray, proposed: np.ndarray, degree: int, relaxation: float) -> np.ndarray:
    """For each point up to degree of its proposed neighbours (-1: none), nearest first, leaving out any that a kept one is
    nearer to by the relaxation."""
    kept = np.full((len(points), degree), -1)
    step = max(1, NUMBERS // max(1, proposed.shape[1] * max(proposed.shape[1], x.shape[1])))
    for a in range(0, len(points), step):
        point, other = points[a:a + step], np.sort(proposed[a:a + step], axis=1)
        other = np.where((other == point[:, None]) | np.c_[np.zeros(len(point), bool), other[:, 1:] == other[:, :-1]], -1, other)
        vectors = x[other]
        difference = vectors - x[point][:, None, :]
        distance = np.where(other >= 0, np.einsum("bcd,bcd->bc", difference, difference), np.inf)
        order = np.argsort(distance, axis=1, kind="stable")
        other, distance = np.take_along_axis(other, order, axis=1), np.take_along_axis(distance, order, axis=1)
        vectors = np.take_along_axis(vectors, order[:, :, None], axis=1)
        norm = np.einsum("bcd,bcd->bc", vectors, vectors)
        between = norm[:, :, None] + norm[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
        alive = np.isfinite(distance)
        row = np.arange(len(point))
        for k in range(degree):
            some = alive.any(axis=1)
            if not some.any():
                break
            pick = np.argmax(alive, axis=1)
            kept[a + row[some], k] = other[row[some], pick[some]]
            alive &= ~(relaxation ** 2 * between[row, pick] <= distance)
            alive[row, pick] = False
    return kept


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relaxation: float = RELAXATION) -> np.ndarray:
    """The neighbours of each point (-1: none). Searches enter at point 0."""
    n = len(x)
    graph = np.full((n, degree), -1)
    at, size = 1, 1
    while at < n:
        batch = np.arange(at, min(n, at + size))
        found, _ = beam_search(x, graph, x[batch], beam)
        graph[batch] = robust_prune(x, batch, found, degree, relaxation)
        # edges back
        source, slot = np.nonzero(graph[batch] >= 0)
        target, source = graph[batch][source, slot], batch[source]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        own, begin, count = np.unique(target, return_index=True, return_counts=True)
        lists = np.full((own.size, degree + int(count.max(initial=0))), -1)
        lists[:, :degree] = graph[own]
        lists[np.repeat(np.arange(own.size), count), degree + np.arange(target.size) - np.repeat(begin, count)] = source
        full = (lists >= 0).sum(axis=1) > degree
        graph[own[~full]] = -np.sort(-lists[~full], axis=1)[:, :degree]
        if full.any():
            graph[own[full]] = robust_prune(x, own[full], lists[full], degree, relaxation)
        at, size = at + batch.size, min(BATCH, size * 2)
    return graph


def _entry_first(x: np.ndarray) -> np.ndarray:
    """An order that starts with the point nearest the mean; the others stay as they are, dealt by a hash."""
    middle = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
    return np.r_[middle, np.delete(np.arange(len(x)), middle)]


def _indexed(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("deal", kind="stable", ignore_index=True)
    x = np.stack(part["embedding"]).astype(np.float64)
    order = _entry_first(x)
    part = part.iloc[order].reset_index(drop=True)
    part["position"] = np.arange(len(part))
    part["edges"] = list(build(x[order]).astype(np.int32))
    return part[["shard", "width", "position", "embedding", "vec_ids", "edges"]]


def _searched(k: int, beam: int):
    def task(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = {"embedding": [], "score": [], "vec_id": []}
        if len(index) and len(queries):
            index = index.sort_values("position", ignore_index=True)
            x = np.stack(index["embedding"]).astype(np.float64)
            graph = np.stack(index["edges"]).astype(np.int64)
            wanted = np.stack(queries["embedding"]).astype(np.float64)
            step = max(1, NUMBERS // (len(x) + 64 * x.shape[1]))
            for a in range(0, len(wanted), step):
                found, near = beam_search(x, graph, wanted[a:a + step], beam)
                for q, ids, distance in zip(range(a, a + step), found, np.sqrt(near)):
                    hits = [(d, v) for i, d in zip(ids[ids >= 0][:k + 1], distance) for v in index["vec_ids"].iat[i]]
                    for d, v in sorted(hits)[:k + 1]:
                        columns["embedding"].append(queries["embedding"].iat[q])
                        columns["score"].append(d)
                        columns["vec_id"].append(v)
        return pd.DataFrame({"embedding": pd.Series(columns["embedding"], dtype=object),
                             "score": pd.Series(columns["score"], dtype=float), "vec_id": pd.Series(columns["vec_id"], dtype="int64")})

    return task


def build_index(vectors: DataFrame, k: int = NEIGHBOURS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """The graphs as a table: shard, width, position in the shard, embedding, the k + 1 smallest vec_id of that vector, edges.

    More rows of one vector can't be among k neighbours besides the query's own row.
    """
    rows = vectors.where(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull()).groupBy("embedding", "vec_id").agg(F.count(F.lit(1)).alias("n"))
    first = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    points = staged(rows.withColumn("first", first).where(F.col("first") <= k + 1)
                    .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("vec_ids"))
                    .withColumn("deal", F.xxhash64("embedding")).withColumn("width", F.size("embedding")))
    shards = max(1, -(-points.count() // shard_points))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("deal"), F.lit(shards)).cast("int"))
    return staged(dealt.groupBy("shard", "width").applyInPandas(
        _indexed, "shard int, width int, position int, embedding array<float>, vec_ids array<long>, edges array<int>"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, beam: int = SEARCH_BEAM,
            shard_points: int = SHARD_POINTS) -> DataFrame:
    """The k nearest found for each query among all vectors but the rows with its own vec_id: query_id, rank from 1, vec_id,
    score (Euclidean distance), ties to the smaller vec_id; all candidates if fewer.

    vectors, queries: vec_id, embedding; other columns are ignored. Rows without vec_id, and vectors that are null, zero or
    hold null or non-finite components take no part; vectors meet vectors of their own length. Repeated rows count once.
    Empty tables give no rows.
    """
    index = build_index(vectors, k, shard_points)
    asked = queries.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast("array<float>").alias("embedding")).distinct()
    asked = staged(asked)
    distinct = staged(asked.select("embedding").distinct())
    blocks = max(1, -(-distinct.count() // QUERY_BLOCK))
    shards = index.select(F.col("shard").alias("own_shard"), F.col("width").alias("own_width")).distinct()
    placed = (distinct.withColumn("own_block", F.pmod(F.xxhash64("embedding"), F.lit(blocks)).cast("int"))
              .join(shards, F.size("embedding") == F.col("own_width")))
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = spread.groupBy("shard", "width", "block").cogroup(placed.groupBy("own_shard", "own_width", "own_block")).applyInPandas(
        _searched(k, beam), "embedding array<float>, score double, vec_id long")
    order = F.row_number().over(Window.partitionBy("embedding").orderBy("score", "vec_id"))
    best = found.withColumn("place", order).where(F.col("place") <= k + 1)
    answers = asked.join(best, "embedding").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")).cast("int")
    return answers.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
