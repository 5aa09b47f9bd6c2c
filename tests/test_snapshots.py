"""Snapshot dates, daily last values and day-over-day change (FIXTURES §C)."""

import datetime as dt

from pyspark.sql import functions as F

from martlake.functions.exprs import reference_time
from martlake.operators.snapshots import created_at, daily_last, day_change, last_updated, spread_day_change


def test_last_updated_and_created_at(spark):
    df = spark.createDataFrame([(1, 10, 1), (1, 3, 2), (1, None, 3)], "pid bigint, days bigint, _seq bigint")
    ref = reference_time("2002-01-01", 0)
    out = created_at(last_updated(df, "pid", "days", ref), "days")
    got = {r["_seq"]: (r["LastUpdated"], r["CreatedAt"]) for r in out.collect()}
    base = dt.datetime(2002, 1, 1)
    assert got[1] == (base, base - dt.timedelta(days=10))
    assert got[2] == (base - dt.timedelta(days=7), base - dt.timedelta(days=10))
    assert got[3] == (None, None)


def test_fluctuation_gap_same_day_and_null_date(spark):
    rows = [(1, "2024-01-01 08:00:00", 3, 1), (1, "2024-01-01 09:00:00", 5, 2),   # same day: last wins
            (1, "2024-01-02 10:00:00", 9, 3), (1, "2024-01-05 10:00:00", 7, 4),   # gap of days
            (1, "2024-01-06 10:00:00", 12, 5), (1, None, 4, 6)]
    df = spark.createDataFrame(rows, "pid bigint, ts string, q bigint, _seq bigint") \
              .withColumn("ts", F.to_timestamp("ts"))
    daily = daily_last(df, "pid", "ts", "q", ["ts", "_seq"])
    ch = day_change(daily, "pid", "Day", "q")
    got = sorted((str(r["Day"]), r["q"], r["QuantityFluctuation"]) for r in ch.collect())
    assert got == [("2024-01-01", 5, 5), ("2024-01-02", 9, 4), ("2024-01-05", 7, 0), ("2024-01-06", 12, 5)]
    spread = spread_day_change(df, ch, "pid", "ts", "Day", "QuantityFluctuation")
    by_seq = {r["_seq"]: r["QuantityFluctuation"] for r in spread.collect()}
    assert by_seq == {1: 5, 2: 5, 3: 4, 4: 0, 5: 5, 6: 0}
