"""Joins to the version of a dimension that is valid at some time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.expressions import instant
from ..session import cut_lineage
from .lookup import Step, any_null, fits_broadcast, prepare_lookup

VERSIONS_PER_KEY = 64
#: Versions and times of one key in one slice of time from which on the slice is cut where its times lie, and edges at most.
SLICE_ROWS = 100_000
MOST_EDGES = 1_000


def valid_at(dim: DataFrame, at: datetime | str, inclusive: bool = True) -> DataFrame:
    """Versions valid at one instant: a plain filter, at most one version per source id."""
    moment = instant(at)
    if inclusive:
        return dim.filter(moment.between(F.col("valid_from"), F.col("valid_to")))
    return dim.filter((F.col("valid_from") <= moment) & (moment < F.col("valid_to")))


def prepare_at_batch(base: DataFrame, dim: DataFrame, on: str, take: dict[str, str], at: datetime | str,
                     inclusive: bool = True) -> Step:
    """A step that looks up the version valid at the batch time; columns are NULL where the key has none.

    ``take`` maps result names to columns of the dimension; ``on`` is the column of the rows holding the source id.
    """
    versions = valid_at(dim, at, inclusive)
    lookup = versions.select(F.col("source_id").alias(on), *[F.col(c).alias(n) for n, c in take.items()])
    return prepare_lookup(base, lookup, [on])


def _covers(at: Column, start: Column, end: Column, inclusive: bool) -> Column:
    return (start <= at) & ((at <= end) if inclusive else (at < end))


def prepare_at_event(base: DataFrame, dim: DataFrame, on: str, take: dict[str, str], at: str,
                     inclusive: bool = True, grain: str = "DAY", strategy: str = "auto") -> Step:
    """A step that looks up the version valid at the time in column ``at`` of each row; NULL where there is none.

    The answer is the last version of the key that starts no later than the row's time, if it still covers that time;
    of versions with one start the one with the later end, then the greater values in ``take``. So versions that
    overlap, touch or start together give one answer, and empty versions (half-open, start equal to end) none,
    whichever way is taken. A dimension of checked size, with few versions per key, is broadcast. A larger one with few
    versions per key is looked up by key, all versions of a key in one row. Otherwise the distinct pairs of key and time in ``base`` are answered first: sorted together with the versions per key and
    time slice, each takes the last version before it, and the version a slice starts with is carried in from a summary
    of one row per key and slice. The rows then look up their answer. No row meets more than one version; a hot key
    shrinks to its distinct times, these are spread over slices, a slice with very many of them is cut at quantiles of its
    times, and a hot pair is split off by the lookup.
    """
    lasting = F.col("valid_from") <= F.col("valid_to") if inclusive else F.col("valid_from") < F.col("valid_to")
    versions = dim.filter(lasting).select(
        F.col("source_id").alias(on), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"),
        *[F.col(c).alias(n) for n, c in take.items()],
    )
    if strategy == "auto":
        most = F.max("n") <= VERSIONS_PER_KEY
        few = versions.groupBy(on).agg(F.count(F.lit(1)).alias("n")).agg(most).first()[0] is not False
        strategy = ("broadcast" if fits_broadcast(versions) else "listed") if few else "carry"
    if strategy == "carry":
        answers = cut_lineage(_answers(base, versions, on, at, list(take), inclusive, grain))
        return prepare_lookup(base, answers, [on, at])

    # A version counts up to the start of the next one; with equal starts only the last has any time left.
    following = F.lead("_from").over(Window.partitionBy(on).orderBy("_from", "_to", *take))
    apart = versions.withColumn("_next", following)
    if strategy == "listed":
        return _prepare_listed(base, apart, on, at, list(take), inclusive)

    def step(rows: DataFrame) -> DataFrame:
        moment = F.col(f"r.{at}").cast("timestamp_ntz")
        match = (F.col(f"r.{on}") == F.col(f"v.{on}")) & _covers(
            moment, F.col("v._from"), F.col("v._to"), inclusive) & (
            F.col("v._next").isNull() | (moment < F.col("v._next")))
        return rows.alias("r").join(F.broadcast(apart).alias("v"), match, "left").select(
            "r.*", *[f"v.{n}" for n in take])

    return step


def _prepare_listed(base: DataFrame, apart: DataFrame, on: str, at: str, take: list[str], inclusive: bool) -> Step:
    """The step for few versions per key: rows look up the versions of their key and pick one."""
    listed = cut_lineage(apart.groupBy(on).agg(F.collect_list(F.struct("_from", "_to", "_next", *take)).alias("_held")))
    find = prepare_lookup(base, listed, [on], counted=apart)

    def step(rows: DataFrame) -> DataFrame:
        moment = F.col(at).cast("timestamp_ntz")
        meant = F.filter("_held", lambda v: _covers(moment, v["_from"], v["_to"], inclusive) & (
            v["_next"].isNull() | (moment < v["_next"])))
        return find(rows).withColumn("_version", F.get(meant, F.lit(0))).select(
            *rows.columns, *[F.col(f"_version.{n}").alias(n) for n in take])

    return step


def _answers(base: DataFrame, versions: DataFrame, on: str, at: str, take: list[str], inclusive: bool,
             grain: str) -> DataFrame:
    points = base.filter(~any_null([on, at])).select(on, at).distinct().withColumn("_t", F.col(at).cast("timestamp_ntz"))
    payload = F.struct("_to", *take)
    starts = versions.select(on, F.col("_from").alias("_t"), payload.alias("_version"))
    both = starts.unionByName(points, allowMissingColumns=True)
    both = both.withColumn("_slice", F.date_trunc(grain, F.col("_t")).cast("timestamp_ntz")).withColumn("_cut", F.lit(0))
    newest = F.max_by("_version", F.when(F.col(at).isNull(), F.struct("_t", "_version"))).alias("_last")
    summary = cut_lineage(both.groupBy(on, "_slice", "_cut").agg(newest, F.count(F.lit(1)).alias("_n")))
    crowded = summary.filter(F.col("_n") > SLICE_ROWS).select(on, "_slice", "_n")
    if not crowded.isEmpty():
        both = _cut_slices(both, crowded, on)
        summary = both.groupBy(on, "_slice", "_cut").agg(newest)
    earlier = Window.partitionBy(on).orderBy("_slice", "_cut").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(on, "_slice", "_cut", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    # At equal times the start of a version, which has no point, sorts before the point it covers.
    running = Window.partitionBy(on, "_slice", "_cut").orderBy("_t", F.asc_nulls_first(at), "_version").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = both.withColumn("_here", F.last("_version", ignorenulls=True).over(running)).filter(F.col(at).isNotNull())
    found = placed.join(carried, [on, "_slice", "_cut"], "left").withColumn("_v", F.coalesce("_here", "_carried"))
    inside = (F.col("_t") <= F.col("_v._to")) if inclusive else (F.col("_t") < F.col("_v._to"))
    return found.filter(inside).select(on, at, *[F.col(f"_v.{n}").alias(n) for n in take])


def _cut_slices(both: DataFrame, crowded: DataFrame, on: str) -> DataFrame:
    """Rows with ``_cut``, their place among the quantiles of the times of their key and slice, if that is crowded. Equal times
    stay together. The edges are gathered in a bounded state per task and key; crowded slices are few, as each has very many
    rows, but their number is checked before they are broadcast."""
    held = F.broadcast(crowded) if fits_broadcast(crowded) else crowded
    parts = F.least(F.lit(MOST_EDGES), F.ceil(F.col("_n") / SLICE_ROWS)).cast("int")
    every = both.join(held, [on, "_slice"]).groupBy(on, "_slice").agg(
        F.percentile_approx("_t", [k / (MOST_EDGES + 1) for k in range(1, MOST_EDGES + 1)], 10 * MOST_EDGES).alias("_every"),
        F.max("_n").alias("_n"))
    step = F.greatest(F.lit(1), F.floor(F.lit(MOST_EDGES) / parts)).cast("int")
    edges = cut_lineage(every.select(on, "_slice", F.array_distinct(
        F.filter("_every", lambda e, i: (i + 1) % step == 0)).alias("_edges")))
    edges = F.broadcast(edges) if fits_broadcast(edges, max_rows=10_000) else edges
    place = F.coalesce(F.size(F.filter("_edges", lambda e: e <= F.col("_t"))), F.lit(0))
    return both.join(edges, [on, "_slice"], "left").withColumn("_cut", F.when(F.col("_edges").isNull(), F.lit(0)).otherwise(place)).drop("_edges")
