"""Row counts of a run, collected while its tables are written.

A count is an observation on the very plan that a sink executes, so it costs no scan of its own. Observe
what a sink writes, not an input of a shuffle: Spark applies a result task's figures once, while a
map stage that is run again after a lost executor would count twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class RunMetrics:
    """Counts of the stages of one run, in the order in which they were watched."""

    def __init__(self):
        self._watched: list[tuple[str, list[str], Observation]] = []

    def watch(self, stage: str, df: DataFrame, **flags: Column) -> DataFrame:
        """``df`` with its rows counted when it is written; each flag counts the rows where it holds."""
        seen = Observation()
        self._watched.append((stage, list(flags), seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in flags.items()])

    def store(self, stage: str, df: DataFrame, path: str, partition_by: Sequence[str] = (), **flags: Column) -> DataFrame:
        """Write ``df`` as a new Parquet table, counting it, and return a reader of the table."""
        w = self.watch(stage, df, **flags).write
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def counts(self) -> dict[str, int]:
        """Rows per stage, and per ``stage.flag``. A plan that Spark proved empty reports nothing: 0 rows."""
        out: dict[str, int] = {}
        for stage, flags, seen in self._watched:
            got = seen.get
            out[stage] = int(got.get("rows") or 0)
            out |= {f"{stage}.{n}": int(got.get(n) or 0) for n in flags}
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """(stage, rows) as a table of literals: reading it scans nothing."""
        return spark.createDataFrame(list(self.counts().items()), "stage string, rows bigint")
