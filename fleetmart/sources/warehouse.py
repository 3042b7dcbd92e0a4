"""Star schema on Parquet with one commit per run.

Every table writes under ``<root>/<table>/<batch>``. A run becomes visible by one last write to ``<root>/_commits`` that
lists all folders readers use from then on; they take the newest list, so a failed run leaves no trace in any table, and
the list is as long as there are live folders, not as there were runs. A folder either adds to its part of a table or
replaces what that part held. One run writes at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from .. import schema as S

COMMIT = "commit long, table string, part string, replaces boolean, path string, rows long, top long"
PART = "part"
WHOLE = "all"


def live(entries: list[tuple]) -> list[tuple]:
    """Per table and part the last replacement and what was added since. Entries without rows only stand for a
    replacement or a greatest key, and go."""
    base: dict[tuple[str, str], int] = {}
    for commit, table, part, replaces, *_ in entries:
        if replaces:
            base[table, part] = max(commit, base.get((table, part), 0))
    return [e for e in entries if e[5] and e[0] >= base.get((e[1], e[2]), 0)]


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, tables: dict[str, S.Table] | None = None):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables or S.STAR | {S.REJECTS.name: S.REJECTS} | S.STATE | S.WAITING
        self._log: list[tuple] | None = None

    def _commits(self) -> list[tuple]:
        """The entries of the newest commit: all live folders, read once."""
        if self._log is None:
            try:
                every = self.spark.read.schema(f"{COMMIT}, at long").parquet(f"{self.root}/_commits")
                newest = every.agg(F.max("at")).first()[0]
                self._log = [tuple(r) for r in every.filter(F.col("at") == newest).drop("at").collect()]
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                self._log = []
        return self._log

    def last_commit(self) -> int:
        return max((commit for commit, *_ in self._commits()), default=0)

    def sizes(self, table: str) -> tuple[int, int]:
        """Rows of a table that its last replacement holds, and rows added since, taken from the commits."""
        held = [e for e in self._commits() if e[1] == table]
        return sum(e[5] for e in held if e[3]), sum(e[5] for e in held if not e[3])

    def highest(self, table: str) -> int:
        """Greatest surrogate key committed, taken from the commits instead of the data."""
        return max((top for _, name, *_, top in self._commits() if name == table), default=0)

    def read(self, table: str, parts: list[str] | None = None, pending: list[tuple] = ()) -> DataFrame:
        """Rows of a table, or of some parts: per part, the last replacement and what was added since.

        ``pending`` adds the entries of a run that is not committed yet.
        """
        declared = self.tables[table]
        entries = [e for e in (*self._commits(), *pending) if e[1] == table and (parts is None or e[2] in parts)]
        paths = sorted({e[4] for e in live(entries) if e[5]})
        if not paths:
            return declared.empty(self.spark)
        return self.spark.read.schema(declared.struct).parquet(*[f"{self.root}/{p}" for p in paths])

    def write(self, table: str, rows: DataFrame, commit: int, part: Column | None = None,
              replaces: bool = False, emptied: list[str] = (), even: bool = True) -> list[tuple]:
        """Write rows of a table by part; returns the entries to commit, none if there were no rows. Parts named in
        ``emptied`` that get no rows are replaced by nothing.

        Rows are rebalanced by part at run time: few files for a small part, several tasks for a large one; not if ``even`` is
        off, which saves moving very many rows of one part that come from tasks of about one size. Rows and
        greatest key of a table in one part are counted by the write itself, those of several parts from what it wrote.
        """
        declared = self.tables[table]
        folder = f"{table}/batch={commit}-{'replace' if replaces else 'add'}"
        laid = rows.select(*declared.names, (F.lit(WHOLE) if part is None else part).cast("string").alias(PART))
        laid = laid.hint("rebalance", PART) if even else laid
        key = declared.primary_key
        counters = [F.count(F.lit(1)).alias("rows"), F.max(key).cast("long").alias("top"), F.min(PART).alias("low"),
                    F.max(PART).alias("high")]
        seen = Observation()  # behind the rebalancing, so in the stage that writes: a task run again counts once
        laid.observe(seen, *counters).write.mode("overwrite").option("compression", "zstd").partitionBy(PART).parquet(f"{self.root}/{folder}")
        found = seen.get
        if not found["rows"]:
            written = []
        elif found["low"] == found["high"]:
            written = [(found["low"], found["rows"], found["top"])]
        else:
            stored = T.StructType([declared.struct[key], T.StructField(PART, T.StringType())])
            written = self.spark.read.schema(stored).parquet(f"{self.root}/{folder}").groupBy(PART).agg(
                *counters[:2]).orderBy(PART).collect()
        entries = [(commit, table, name, replaces, f"{folder}/{PART}={name}", rows, top) for name, rows, top in written]
        filled = {e[2] for e in entries}
        return entries + [(commit, table, p, True, "", 0, 0) for p in emptied if p not in filled]

    def commit(self, entries: list[tuple]) -> None:
        """Publish: a single file, written last. The greatest key of a table stays known when its rows are gone."""
        kept = live([*self._commits(), *entries])
        tops = {t: max((e[6] or 0 for e in (*self._commits(), *entries) if e[1] == t), default=0) for t in {e[1] for e in (*self._commits(), *entries)}}
        last = max((e[0] for e in entries), default=self.last_commit())
        # one entry of each table carries its greatest key
        kept += [(last, t, "", False, "", 0, top) for t, top in tops.items()]
        rows = self.spark.createDataFrame(kept, COMMIT)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_commits/at={last}")
        self._log = None
