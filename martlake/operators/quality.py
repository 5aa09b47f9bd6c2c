"""Data-quality operators: strict casts with a quarantine, one-pass stage counts
and a per-table quality report. All are single aggregations or filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.operators.metrics import RunMetrics


def strict_cast(df: DataFrame, casts: Mapping[str, str], mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Cast ``casts`` (column -> type) where a null or unparsable value is an error.

    Returns ``(valid, quarantine)``. ``valid`` has the cast columns; ``quarantine``
    keeps the failing rows unchanged plus ``_error`` (the failing column names).
    ``mode="raise"`` fails the job on the first bad row instead (the reference's
    behaviour), via ``raise_error`` inside the plan.
    """
    checks = {c: F.col(c).try_cast(t) for c, t in casts.items()}
    tagged = df.withColumn("_error", _failed(checks))
    bad = F.size("_error") > 0
    if mode == "raise":
        msg = F.concat(F.lit("strict cast failed: "), F.array_join("_error", ","))
        valid = tagged.filter(F.when(bad, F.raise_error(msg)).otherwise(F.lit(True)))
    else:
        valid = tagged.filter(~bad)
    valid = valid.select(*[checks[c].alias(c) if c in checks else F.col(c) for c in df.columns])
    quarantine = tagged.filter(bad).withColumn("_error", F.array_join("_error", ","))
    return valid, quarantine


def _failed(checks: Mapping[str, Column]) -> Column:
    """Names of the columns whose checked value is null."""
    return F.array_compact(F.array(*[F.when(v.isNull(), F.lit(c)) for c, v in checks.items()]))


def split_sink(df: DataFrame, good: Column, path: str, metrics: RunMetrics | None = None,
               stage: str = "split") -> tuple[DataFrame, DataFrame]:
    """Write every row of ``df`` in one pass, into a table partitioned by whether ``good`` holds
    (null: no), and return readers of the two parts. Nothing is evaluated twice and nothing is dropped;
    ``metrics`` gets ``stage``, ``stage.accepted`` and ``stage.rejected``."""
    tagged = df.withColumn("_good", F.coalesce(good, F.lit(False)))
    flag = F.col("_good")
    whole = (metrics or RunMetrics()).store(stage, tagged, path, ["_good"], accepted=flag, rejected=~flag)
    return whole.filter(flag).drop("_good"), whole.filter(~flag).drop("_good")


def strict_cast_sink(df: DataFrame, casts: Mapping[str, str], path: str, metrics: RunMetrics | None = None,
                     stage: str = "cast") -> tuple[DataFrame, DataFrame]:
    """:func:`strict_cast` with both parts written in one pass: (valid, quarantine) as readers of the table at
    ``path``. It holds the rows as they came, so a quarantined row can be mended and loaded again."""
    tagged = df.withColumn("_error", F.array_join(_failed({c: F.col(c).try_cast(t) for c, t in casts.items()}), ","))
    good, bad = split_sink(tagged, F.col("_error") == "", path, metrics, stage)
    return good.select(*[F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns]), bad


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named stage as one small table (stage, rows).

    Each count is one aggregation over its own plan, which reads its inputs again. Where the
    stages are written anyway, :class:`martlake.operators.metrics.RunMetrics` counts them in that pass."""
    out = None
    for name, df in stages.items():
        c = df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(F.lit(name).alias("stage"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


def quality_report(df: DataFrame, table: str, key: Sequence[str], casts: Mapping[str, str] | None = None) -> DataFrame:
    """Rows (table, metric, value): total rows, rows with a null key part, rows
    whose key occurs more than once, and strict-cast failures per column
    (``bad_<column>``): a keyed aggregation (partial,
    so hot keys combine map-side) followed by a global one over its output."""
    key = list(key)
    null_key: Column = F.lit(False)
    for k in key:
        null_key = null_key | F.col(k).isNull()
    flags = [F.count(F.lit(1)).alias("_n"), F.max(null_key.cast("int")).alias("_null")]
    for c, t in (casts or {}).items():
        flags.append(F.count_if(F.col(c).try_cast(t).isNull()).alias(f"bad_{c}"))
    per_key = df.groupBy(*key).agg(*flags)  # partial aggregation; then one small global agg
    n = F.col("_n")
    aggs = [F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("_null") == 1, n)), F.lit(0)).cast("bigint").alias("null_key_rows"),
            F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).cast("bigint").alias("dup_key_rows")]
    for c in (casts or {}):
        aggs.append(F.coalesce(F.sum(f"bad_{c}"), F.lit(0)).cast("bigint").alias(f"bad_{c}"))
    wide = per_key.agg(*aggs).select(F.lit(table).alias("table"), "*")
    metrics = [c for c in wide.columns if c != "table"]
    return wide.unpivot(["table"], metrics, "metric", "value")
