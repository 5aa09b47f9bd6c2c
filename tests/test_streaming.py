"""Incremental load with Structured Streaming: each landing file is merged
once; a second run over the same files adds nothing; upsert mode."""

from conftest import rows
from martlake.streaming.incremental import run_incremental


def test_append_distinct_incremental(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k bigint, v string")
    df.repartition(2).write.parquet(f"{base}/landing")
    for _ in range(2):
        run_incremental(spark, f"{base}/landing", df.schema, f"{base}/t", f"{base}/ck", max_files_per_trigger=1)
    assert rows(spark.read.parquet(f"{base}/t")) == [(1, "a"), (2, None), (3, "c")]
    # a new file arriving later: only its new rows are appended
    spark.createDataFrame([(3, "c"), (4, "d")], "k bigint, v string").write.mode("append").parquet(f"{base}/landing")
    run_incremental(spark, f"{base}/landing", df.schema, f"{base}/t", f"{base}/ck")
    assert rows(spark.read.parquet(f"{base}/t")) == [(1, "a"), (2, None), (3, "c"), (4, "d")]


def test_upsert_incremental(spark, tmp_path):
    base = str(tmp_path)
    schema = "k bigint, v string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(f"{base}/landing")
    run_incremental(spark, f"{base}/landing", spark.createDataFrame([], schema).schema, f"{base}/t", f"{base}/ck",
                    mode="upsert", keys=["k"])
    spark.createDataFrame([(2, None), (3, "c"), (1, "A")], schema).write.mode("append").parquet(f"{base}/landing")
    run_incremental(spark, f"{base}/landing", spark.createDataFrame([], schema).schema, f"{base}/t", f"{base}/ck",
                    mode="upsert", keys=["k"])
    assert rows(spark.read.parquet(f"{base}/t")) == [(1, "A"), (2, "b"), (3, "c")]


def test_partitioned_target_reads_and_rewrites_touched_partitions(spark, tmp_path):
    base = str(tmp_path)
    schema = "day string, k bigint, v string"
    st = spark.createDataFrame([], schema).schema
    spark.createDataFrame([("d1", 1, "a"), ("d1", 1, "a"), ("d2", 2, "b"), (None, 3, "c")], schema) \
         .write.parquet(f"{base}/landing")
    run_incremental(spark, f"{base}/landing", st, f"{base}/t", f"{base}/ck", partition_by=["day"])
    spark.createDataFrame([("d1", 1, "a"), ("d3", 4, "d"), (None, 3, "c")], schema) \
         .write.mode("append").parquet(f"{base}/landing")
    run_incremental(spark, f"{base}/landing", st, f"{base}/t", f"{base}/ck", partition_by=["day"])
    got = rows(spark.read.schema(st).parquet(f"{base}/t").select("day", "k", "v"))
    assert got == [("d1", 1, "a"), ("d2", 2, "b"), ("d3", 4, "d"), (None, 3, "c")]

    # keyed upsert over a partitioned target: untouched partitions are not rewritten
    t2 = f"{base}/u"
    spark.createDataFrame([("d1", 1, "a"), ("d2", 2, "b")], schema).write.parquet(f"{base}/l2")
    run_incremental(spark, f"{base}/l2", st, t2, f"{base}/ck2", mode="upsert", keys=["day", "k"],
                    partition_by=["day"])
    spark.createDataFrame([("d1", 1, None), ("d1", 5, "e")], schema).write.mode("append").parquet(f"{base}/l2")
    run_incremental(spark, f"{base}/l2", st, t2, f"{base}/ck2", mode="upsert", keys=["day", "k"],
                    partition_by=["day"])
    got = rows(spark.read.schema(st).parquet(t2).select("day", "k", "v"))
    assert got == [("d1", 1, "a"), ("d1", 5, "e"), ("d2", 2, "b")]


def test_merge_batch_reports_observed_counts(spark, tmp_path):
    from martlake.streaming.incremental import merge_batch
    t = str(tmp_path / "t")
    b1 = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k bigint, v string")
    assert merge_batch(b1, t) == {"written": 2}
    b2 = spark.createDataFrame([(2, "b"), (3, "c")], "k bigint, v string")
    assert merge_batch(b2, t) == {"written": 1}
    b3 = spark.createDataFrame([(3, None), (4, "d")], "k bigint, v string")
    assert merge_batch(b3, t, mode="upsert", keys=["k"]) == {"updated": 1, "inserted": 1, "kept": 2}
    assert rows(spark.read.parquet(t)) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_upsert_keeps_old_columns_and_skips_a_replay(spark, tmp_path):
    from martlake.streaming.incremental import merge_batch
    t = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "n", "z")], "k bigint, v string, extra string") \
         .coalesce(1).write.parquet(t)
    batch = spark.createDataFrame([(1, "A"), (None, "new"), (3, "c"), (3, "d")], "k bigint, v string")
    for _ in range(2):
        merge_batch(batch, t, mode="upsert", keys=["k"], batch_id="s-0")
    got = rows(spark.read.parquet(t).select("k", "v", "extra"))
    assert got == rows(spark.createDataFrame([(1, "A", "x"), (2, "b", "y"), (3, "c", None), (3, "d", None), (None, "n", "z"),
                                              (None, "new", None)], "k bigint, v string, extra string"))
