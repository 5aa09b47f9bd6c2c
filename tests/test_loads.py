"""Whole loads, split sinks, run metrics, bucketed tables, ranks and ordered output."""

import re

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlake.operators import buckets as K
from martlake.operators.metrics import RunMetrics
from martlake.operators.quality import split_sink, strict_cast, strict_cast_sink
from martlake.operators.rank import ntile
from martlake.plans import catalog
from martlake.plans.loads import load_product
from martlake.sources import bindings as B
from martlake.sources.ordered import write_ordered


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text: str, column: str) -> int:
    """Distinct scans that read a column, in the first plan of the text (not its re-planned copies)."""
    return len(re.findall(rf"FileScan [^\n]*{column}", text.partition("== Initial Plan ==")[2] or text))


# ------------------------------------------------------------------ metrics, sinks
def test_metrics_count_what_is_written(spark, tmp_path):
    m = RunMetrics()
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k bigint, v string")
    back = m.store("t", df, str(tmp_path / "t"), known=F.col("v").isNotNull())
    m.store("none", df.filter("false"), str(tmp_path / "none"))
    assert rows(back) == rows(df)
    assert rows(m.table(spark)) == [("none", 0), ("t", 3), ("t.known", 2)]
    assert "Scan parquet" not in plan(m.table(spark)) and "FileScan" not in plan(m.table(spark))


def test_the_product_load_reads_its_inputs_once(spark, tmp_path):
    raw = B.raw_product(spark, SF_SMALL)
    tables, m = load_product(raw, str(tmp_path), B.AS_OF, B.PRODUCT_TZ_OFFSET_HOURS)
    counts = m.counts()
    assert counts["extracted"] == raw.count() and counts.keys() == {"extracted", "transformed", *tables}
    for name, df in tables.items():
        assert counts[name] == df.count() > 0
        assert "lineitem" not in plan(df)
    assert rows(tables["product"]) == rows(catalog.REGISTRY["product_dim"](spark, SF_SMALL))
    assert rows(tables["product_sale"]) == rows(catalog.REGISTRY["product_sale"](spark, SF_SMALL))


def test_the_product_load_numbers_and_dates_its_rows_once(spark, tmp_path, monkeypatch):
    from martlake.plans import loads, product
    calls = []
    for module, name in [(product, "dense_id"), (product, "daily_last"), (loads, "daily_last")]:
        monkeypatch.setattr(module, name, lambda *a, f=getattr(module, name), n=name, **k: calls.append(n) or f(*a, **k))
    raw = B.raw_product(spark, SF_SMALL)
    tables, _ = load_product(raw, str(tmp_path), B.AS_OF, B.PRODUCT_TZ_OFFSET_HOURS)
    assert sorted(calls) == ["daily_last", "dense_id"]
    for name in ("inventory", "pricing"):
        alone = catalog.REGISTRY[f"{name}_snapshot"](spark, SF_SMALL)
        assert tables[name].columns == alone.columns and rows(tables[name]) == rows(alone)


def test_split_sink_drops_nothing(spark, tmp_path):
    m = RunMetrics()
    df = spark.createDataFrame([(1, "7"), (2, "x"), (3, None), (4, "8")], "k bigint, v string")
    good, bad = split_sink(df, F.col("v") == "7", str(tmp_path / "s"), m, "s")
    assert rows(good) == [(1, "7")] and len(rows(bad)) == 3  # a null test is not a pass
    assert m.counts() == {"s": 4, "s.accepted": 1, "s.rejected": 3}
    valid, quarantine = strict_cast_sink(df, {"v": "bigint"}, str(tmp_path / "c"))
    want = strict_cast(df, {"v": "bigint"})
    assert rows(valid) == rows(want[0]) == [(1, 7), (4, 8)] and rows(quarantine) == rows(want[1])
    empty = split_sink(df.limit(0), F.lit(True), str(tmp_path / "e"))
    assert [x.collect() for x in empty] == [[], []]


# ------------------------------------------------------------------ one scan
@pytest.mark.parametrize("key", ["product_sale", "quantity_fluctuation", "product_dim", "daily_last_quantity"])
def test_the_fact_is_scanned_once(spark, key):
    assert scans(plan(catalog.REGISTRY[key](spark, SF_SMALL)), "l_shipdate") == 1


def test_nested_scores_need_no_regrouping(spark):
    """One shuffle, for the first row per review."""
    text = plan(catalog.REGISTRY["absa_nested"](spark, SF_SMALL))
    assert (text.partition("== Initial Plan ==")[2] or text).count("Exchange") == 1


# ------------------------------------------------------------------ buckets
def above(text: str, scan: str) -> list[str]:
    """Operators above the scan of a table whose line holds ``scan``, in the plan as first made."""
    lines = (text.partition("== Initial Plan ==")[2] or text).splitlines()
    found = []
    for i, line in enumerate(lines):
        if "FileScan" in line and scan in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for up in reversed(lines[:i]):
                d = len(up) - len(up.lstrip(" :+-"))
                if d < depth:
                    depth = d
                    found.append(up.strip(" :+-").split(" ")[0])
    return found


def test_append_distinct_shuffles_the_batch_only(spark, tmp_path):
    schema = "a bigint, b string"
    first = spark.createDataFrame([(i, None if i % 3 else f"x{i}") for i in range(200)] * 2, schema)
    t = K.open_distinct(spark, "t_append", str(tmp_path / "t"), first.schema, 6)
    K.append_distinct(t, first)
    assert K.rows_of(t, spark).count() == 200
    batch = spark.createDataFrame([(1, None), (1, "q"), (None, None), (None, None), (1, "q")], schema)
    unseen = K.unseen_rows(t, batch)
    assert "Bucketed: true" in plan(unseen)
    path = above(plan(unseen), "Bucketed: true")
    assert path and "ShuffledHashJoin" in path
    assert "Exchange" not in path[:path.index("ShuffledHashJoin") + 1]
    for _ in range(2):
        K.append_distinct(t, batch)
    assert K.rows_of(t, spark).count() == 202
    again = K.open_distinct(spark, "t_append_2", str(tmp_path / "t"), first.schema, 6)  # another session's name for it
    assert rows(K.rows_of(again, spark)) == rows(K.rows_of(t, spark))


def test_upsert_does_not_shuffle_the_stored_side(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        old = spark.createDataFrame([(i % 50, f"v{i}", "o", i) for i in range(100)] + [(None, "n", "o", 100)], "k bigint, v string, o string, _seq bigint")
        t = K.open_buckets(spark, "t_upsert", str(tmp_path / "t"), old.schema, ["k"], 6)
        t.append(old)
        new = spark.createDataFrame([(1, "new"), (1, None), (None, "m"), (70, None)], "k bigint, v string")
        got = K.upsert_buckets(t, new)
        assert "Exchange" not in above(plan(got), "t_upsert")
        from martlake.operators.merge import upsert
        assert rows(got) == rows(upsert(old, new, ["k"])[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ------------------------------------------------------------------ ranks
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=40), st.integers(1, 7))
def test_ntile_is_the_window_function(spark, data, n):
    from pyspark.sql import Window
    df = spark.createDataFrame([(*x, i) for i, x in enumerate(data)], "g string, v int, k int")
    want = df.withColumn("t", F.ntile(n).over(Window.partitionBy("g").orderBy("v", "k")))
    assert rows(ntile(df, n, ["g"], ["v", "k"], "t")) == rows(want)


# ------------------------------------------------------------------ ordered output
def test_files_are_in_global_order(spark, tmp_path):
    df = catalog.REGISTRY["product_sale"](spark, SF_SMALL)
    write_ordered(df, str(tmp_path / "o"), ["ProductID", "LastUpdated", "QuantitySold"], files=5)
    files = sorted((tmp_path / "o").glob("part-*"))
    assert len(files) == 5
    ranges = []
    for f in files:
        col = pq.ParquetFile(f).metadata.row_group(0).column(0)
        assert col.path_in_schema == "ProductID"
        ranges.append((col.statistics.min, col.statistics.max))
        got = [tuple(r.values()) for r in pq.read_table(f, columns=["ProductID", "LastUpdated"]).to_pylist()]
        key = [(p, t is not None, t or "") for p, t in got]
        assert key == sorted(key)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_purge_deletes_old_scratch_only(spark):
    import os
    from martlake.session import purge_scratch, scratch_path
    path = scratch_path(spark, "purge-me")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert purge_scratch(spark, 1.0) == 0 and os.path.isdir(local)
    os.utime(local, (1, 1))
    assert purge_scratch(spark, 1.0) >= 1 and not os.path.isdir(local)
