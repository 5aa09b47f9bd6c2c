"""Plan-shape checks: the order-aware rules stay partial hash aggregates (a hot
key is combined map-side), no window runs over raw rows of a key, scans read
only the columns a job uses, and the only explicit broadcast is bounded."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from martlake.operators.dedup import drop_marked_duplicates, least_masked
from martlake.operators.order import distinct_rows, keep_first
from martlake.operators.snapshots import last_updated


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(spark):
    data = [(k % 3 if k % 3 else 0, k, f"t{'*' * (k % 4)}", k) for k in range(300)]   # key 0 holds a third
    return spark.createDataFrame(data, "k bigint, v bigint, text string, _seq bigint")


def test_dedup_rules_are_partial_aggregates(spark):
    df = _rows(spark)
    for out in (keep_first(df, ["k"], [F.col("_seq")]), distinct_rows(df),
                drop_marked_duplicates(df, "k", F.col("text").contains("*")),
                least_masked(df, ["k", "v"], "text")):
        p = _plan(out)
        assert "partial_" in p and "Window" not in p, p


def test_per_key_max_is_aggregate_joined_back(spark):
    p = _plan(last_updated(_rows(spark), "k", "v", F.current_timestamp()))
    assert "partial_max" in p and "Window" not in p


def test_jobs_prune_columns_and_bound_broadcasts(spark):
    import __spark_entry__ as E
    qs = E.queries()
    p = _plan(qs["product_sale"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," in p
    assert "l_comment" not in p and "l_extendedprice" not in p
    for key in ("feedback_detail", "inventory_snapshot"):
        p = _plan(qs[key](spark, SF_SMALL))
        # the dense id's only single-partition step is the running sum over per-partition counts
        assert p.count("Exchange SinglePartition") == 1
