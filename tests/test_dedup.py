"""Order-aware dedup rules, dense ids and strict casts (FIXTURES §C)."""

from pyspark.sql import functions as F

from conftest import rows
from martlake.operators.dedup import drop_marked_duplicates, earliest_dated, least_masked, priority_pick
from martlake.operators.order import dense_id, distinct_rows, keep_first
from martlake.operators.quality import quality_report, strict_cast


def test_seller_marked_duplicates(spark):
    df = spark.createDataFrame([
        (1, "https://x/nan.png", 1), (1, "https://x/a.png", 2),      # duplicate, one nan -> a.png
        (2, "https://x/nan", 3), (2, "https://x/nan2", 4),             # all nan -> seller vanishes
        (3, "https://x/nan", 5),                                       # single nan -> kept
        (0, "https://x/b.png", 6)], "id bigint, url string, _seq bigint")
    out = drop_marked_duplicates(df, "id", F.col("url").contains("nan"))
    assert rows(out.drop("_seq")) == [(0, "https://x/b.png"), (1, "https://x/a.png"), (3, "https://x/nan")]


def test_earliest_dated_and_priority(spark):
    df = spark.createDataFrame([
        (1, None, "a", 1), (1, None, "b", 2),                          # no dates -> first row
        (2, "2020-05-01", "x", 3), (2, "2020-01-01", "y", 4), (2, None, "z", 5),
        (3, "2020-01-01", "ab", 6), (3, "2020-01-01", "abc", 7), (3, None, "abcdef", 8)],
        "k bigint, d string, name string, _seq bigint")
    e = {r["k"]: r["name"] for r in earliest_dated(df, "k", "d").collect()}
    assert e == {1: "a", 2: "y", 3: "ab"}
    p = {r["k"]: r["name"] for r in priority_pick(df, "k", "d", "name").collect()}
    assert p == {1: "a", 2: "x", 3: "abc"}      # dated beats undated; longer name; then first


def test_least_masked_drops_null_keys(spark):
    df = spark.createDataFrame([
        (1, 1, "a **** b", 1), (1, 1, None, 2), (1, 1, "a * b", 3),
        (2, 1, "a ** b", 4), (2, 1, "a ** c", 5),
        (None, 1, "x", 6)], "p bigint, u bigint, text string, _seq bigint")
    out = least_masked(df, ["p", "u"], "text")
    assert rows(out.select("p", "u", "_seq")) == [(1, 1, 2), (2, 1, 4)]   # null text counts 0 stars


def test_keep_first_null_key_is_a_key(spark):
    df = spark.createDataFrame([(None, "a", 2), (None, "b", 1), (1, "c", 3)], "k bigint, v string, _seq bigint")
    assert rows(keep_first(df, ["k"], [F.col("_seq")])) == [(1, "c", 3), (None, "b", 1)]


def test_distinct_keeps_first_seq(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 2), (2, "x", 3)], "a bigint, b string, _seq bigint")
    assert rows(distinct_rows(df)) == [(1, None, 2), (2, "x", 3)]


def test_dense_id_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"))
    out = dense_id(df, ["v"], "rid", num_partitions=7).collect()
    assert sorted((r["rid"], r["v"]) for r in out) == [(i + 1, i) for i in range(5000)]


def test_strict_cast_quarantine(spark):
    df = spark.createDataFrame([("1", "2"), (None, "3"), ("x", None)], "a string, b string")
    valid, bad = strict_cast(df, {"a": "bigint", "b": "bigint"})
    assert rows(valid) == [(1, 2)]
    assert rows(bad.select("_error")) == [("a",), ("a,b",)]


def test_quality_report_counts(spark):
    df = spark.createDataFrame([(1, "5"), (1, "x"), (None, "2"), (2, None)], "k bigint, v string")
    got = {r["metric"]: r["value"] for r in quality_report(df, "t", ["k"], {"v": "bigint"}).collect()}
    assert got == {"rows": 4, "null_key_rows": 1, "dup_key_rows": 2, "bad_v": 2}
