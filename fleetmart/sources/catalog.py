"""Source catalog: the tables and views of a source, exposed by name to DataFrame code and SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F


#: Tables that grow with the business; one task can't read them.
GROWING = ("customer", "rental_transaction", "payment", "maintenance")


def register(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Expose DataFrames as temporary views. A view adds no copy and no barrier: it is inlined into each query."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(prefix + name)


def parquet_tables(spark: SparkSession, root: str, names: list[str], suffix: str = ".parquet") -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{root.rstrip('/')}/{name}{suffix}") for name in names}


@dataclass(frozen=True)
class Split:
    """Parallel read of a remote table: ranges of an integer or date column."""

    column: str
    lower: str
    upper: str
    partitions: int


def even_predicates(extract: DataFrame, column: str, partitions: int) -> list[str]:
    """Conditions that part a remote table into reads of about equal weight, by the quantiles of an integer or date column in an
    extract made before. However the keys lie, and whatever came since, each row meets exactly one: the first takes rows
    without a value, too, the last all beyond the greatest edge. Repeated values may leave fewer parts."""
    shares = [k / partitions for k in range(1, partitions)]
    found = extract.agg(F.percentile_approx(column, shares, max(10_000, 100 * partitions))).first()[0] if shares else None
    edges = [str(e) if isinstance(e, int) else f"'{e}'" for e in sorted(set(found or []))]
    if not edges:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges[:-1], edges[1:])]
    return [f"{column} < {edges[0]} OR {column} IS NULL", *inner, f"{column} >= {edges[-1]}"]


def jdbc_options(url: str, table: str, properties: dict[str, str] | None = None, split: Split | None = None,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options. Filters and column lists reach the remote side through them; credentials come from the caller."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if split is not None:
        options |= {
            "partitionColumn": split.column, "lowerBound": split.lower, "upperBound": split.upper,
            "numPartitions": str(split.partitions),
        }
    return options


def jdbc_tables(spark: SparkSession, url: str, names: list[str], schema: str = "public",
                properties: dict[str, str] | None = None,
                splits: dict[str, Split | list[str]] | None = None) -> dict[str, DataFrame]:
    """The named tables and views of a remote schema. Tables that grow with the business need a split: without one a
    single task would read the whole table. A split is one by strides, or a list of conditions (``even_predicates``)."""
    missing = [name for name in names if name in GROWING and name not in (splits or {})]
    if missing:
        raise ValueError("pass a split for " + ", ".join(missing))

    def table(name: str) -> DataFrame:
        split = (splits or {}).get(name)
        if isinstance(split, list):
            options = jdbc_options(url, f"{schema}.{name}", properties)
            return spark.read.jdbc(options.pop("url"), options.pop("dbtable"), predicates=split, properties=options)
        return spark.read.format("jdbc").options(**jdbc_options(url, f"{schema}.{name}", properties, split)).load()

    return {name: table(name) for name in names}


def jdbc_names(spark: SparkSession, url: str, schema: str = "public",
               properties: dict[str, str] | None = None) -> list[str]:
    """All tables and views of a remote schema."""
    listing = f"(SELECT table_name FROM information_schema.tables WHERE table_schema = '{schema}') AS listing"
    names = spark.read.format("jdbc").options(**jdbc_options(url, listing, properties)).load()
    return sorted(row["table_name"] for row in names.collect())
