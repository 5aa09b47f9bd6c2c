"""Snapshot-time operators: reconstructing dates from "days ago", daily last
values and day-over-day changes.

Scale notes
* The per-product maximum of "days ago" is a hash aggregate (partial, so a hot
  product is combined map-side) joined back on the product key; AQE turns the
  join into a broadcast only when the aggregate is measured small, and splits a
  skewed key otherwise. A ``max().over(partitionBy(product))`` window would put
  every row of a hot product into one task.
* The day-over-day ``lag`` runs on the daily table (one row per product and
  day), whose groups are bounded by the number of distinct days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions.exprs import minus_days


def last_updated(df: DataFrame, key: str, days: str, ref, out: str = "LastUpdated",
                 max_col: str = "_maxdays") -> DataFrame:
    """``out = ref - (max(days over key) - days)``; null days -> null.

    Adds the per-key maximum as ``max_col`` (kept for :func:`created_at`)."""
    m = df.groupBy(key).agg(F.max(days).alias(max_col))
    j = df.join(m, on=key, how="left")
    d = F.col(days).cast("double")
    return j.withColumn(out, minus_days(ref, F.col(max_col).cast("double") - d))


def created_at(df: DataFrame, days: str, last_col: str = "LastUpdated", out: str = "CreatedAt") -> DataFrame:
    """``out = last_col - days`` for rows with days; null otherwise."""
    return df.withColumn(out, minus_days(F.col(last_col), F.col(days).cast("double")))


def daily_last(df: DataFrame, key: str, ts: str, value: str, order: list,
               day_col: str = "Day", out: str | None = None) -> DataFrame:
    """Last ``value`` per (key, calendar day of ``ts``), last by ``order``.

    Rows whose ``ts`` is null have no day and are left out."""
    out = out or value
    day = F.to_date(F.col(ts))
    ordk = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{i}") for i, c in enumerate(order)])
    return (df.filter(F.col(ts).isNotNull())
              .groupBy(F.col(key), day.alias(day_col))
              .agg(F.max_by(F.col(value), ordk).alias(out)))


def day_change(daily: DataFrame, key: str, day_col: str, value: str,
               out: str = "QuantityFluctuation") -> DataFrame:
    """Change versus the previous observed day of the same key; the first day's
    change is the value itself; negative changes clip to 0."""
    w = Window.partitionBy(key).orderBy(day_col)
    prev = F.lag(value, 1).over(w)
    ch = F.greatest(F.coalesce(F.col(value) - prev, F.col(value)), F.lit(0))
    return daily.withColumn(out, ch.cast("bigint"))


def spread_day_change(rows: DataFrame, changes: DataFrame, key: str, ts: str, day_col: str,
                      change_col: str) -> DataFrame:
    """Give every row the change of its (key, day); rows without a day get 0."""
    r = rows.withColumn(day_col, F.to_date(F.col(ts)))
    c = changes.select(key, day_col, change_col)
    j = r.join(c, on=[key, day_col], how="left")
    return j.withColumn(change_col, F.coalesce(F.col(change_col), F.lit(0).cast("bigint")))
