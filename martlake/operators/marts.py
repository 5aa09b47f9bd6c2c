"""Reporting marts on the loaded tables: review summary per product, daily
price changes, KPI direction and heat levels.

Every day-over-day comparison runs on a daily table (one row per key and
day, built by a partial aggregation), so a window partition holds at most one
row per day of a key, however many raw rows the key has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HEAT_LEVELS = 5


def review_summary(detail: DataFrame) -> DataFrame:
    """Per product: review count, average rating, share of 5-star reviews and
    total upvotes (one hash aggregation)."""
    n = F.count(F.lit(1))
    return detail.groupBy("ProductID").agg(
        n.cast("bigint").alias("Reviews"),
        F.round(F.avg("Rating"), 4).alias("AvgRating"),
        F.round(F.count_if(F.col("Rating") == 5) / n, 4).alias("FiveStarShare"),
        F.sum("Upvote").cast("bigint").alias("Upvotes"),
    )


def daily_price(snapshots: DataFrame, key: str, ts: str, order: list, current: str, original: str) -> DataFrame:
    """Last (by ``order``) current/original price per key and day."""
    o = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{i}") for i, c in enumerate(order)])
    last = F.max_by(F.struct(F.col(current).alias("c"), F.col(original).alias("o")), o)
    d = (snapshots.filter(F.col(ts).isNotNull())
                  .groupBy(key, F.to_date(F.col(ts)).alias("Day")).agg(last.alias("_p")))
    return d.select(key, "Day", F.col("_p.c").alias("CurrentPrice"), F.col("_p.o").alias("OriginalPrice"))


def price_change(daily: DataFrame, key: str) -> DataFrame:
    """Change of the current price versus the previous observed day of the same
    key (null on the first day) and the discount off the original price.
    Values keep full precision; rounding is left to presentation."""
    w = Window.partitionBy(key).orderBy("Day")
    prev = F.lag("CurrentPrice", 1).over(w)
    cur, orig = F.col("CurrentPrice"), F.col("OriginalPrice")
    return daily.select(
        key, "Day", cur.alias("CurrentPrice"), prev.alias("PreviousPrice"), (cur - prev).alias("Change"),
        F.when(orig > 0, F.lit(1.0) - cur / orig).alias("Discount"))


def kpi_direction(daily: DataFrame, key: str, value: str, levels: int = HEAT_LEVELS) -> DataFrame:
    """Per key and day: direction versus the previous observed day (new / up /
    down / flat) and a heat level 1..``levels`` from the value's position in
    that day's range (min..max over all keys, a per-day aggregate joined back)."""
    w = Window.partitionBy(key).orderBy("Day")
    prev = F.lag(value, 1).over(w)
    v = F.col(value)
    direction = (F.when(prev.isNull(), F.lit("new")).when(v > prev, F.lit("up"))
                  .when(v < prev, F.lit("down")).otherwise(F.lit("flat")))
    d = daily.select(key, "Day", value, direction.alias("Direction"))
    rng = daily.groupBy("Day").agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    j = d.join(rng, "Day", "inner")
    lvl = F.lit(1) + F.floor(F.lit(levels) * (v - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + F.lit(1)))
    return j.select(key, "Day", value, "Direction", lvl.cast("int").alias("Heat"))
