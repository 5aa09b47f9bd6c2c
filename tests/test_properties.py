"""Options and properties: seller strict suffix, epoch unit, refresh gate,
upsert idempotence, and results independent of the partition count."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from martlake.functions.exprs import lenient_timestamp
from martlake.operators.merge import upsert
from martlake.plans.product import SELLER_IMAGE_PREFIX, seller_dim
from martlake.plans.schedule import LISTING_REFRESH_DAYS, refresh_due


def test_seller_strict_suffix(spark):
    raw = spark.createDataFrame([
        (1, "a", "l", None, 1), (1, "a", "l", "banana.png", 2),        # marker row vs real URL with 'nan'
        (2, "b", "l", "nanny.png", 3), (2, "b", "l", "x.png", 4)],
        "seller_id bigint, seller_name string, seller_link string, seller_image_url string, _seq bigint")
    loose = {r["SellerID"]: r["ImageURL"] for r in seller_dim(raw).collect()}
    strict = {r["SellerID"]: r["ImageURL"] for r in seller_dim(raw, strict_suffix=True).collect()}
    assert loose == {2: SELLER_IMAGE_PREFIX + "x.png"}                 # seller 1 disappears
    assert strict == {1: SELLER_IMAGE_PREFIX + "banana.png", 2: SELLER_IMAGE_PREFIX + "nanny.png"}


def test_epoch_unit(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("1704164645",), ("junk",), (None,)], "t string")
    plain = [r[0] for r in df.select(lenient_timestamp("t")).collect()]
    secs = [r[0] for r in df.select(lenient_timestamp("t", numeric_unit="s")).collect()]
    ts = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert plain == [ts, None, None, None]
    assert secs == [ts, ts, None, None]


def test_refresh_gate():
    assert refresh_due("2024-03-01", LISTING_REFRESH_DAYS) and refresh_due(dt.date(2024, 3, 15), LISTING_REFRESH_DAYS)
    assert not refresh_due("2024-03-02 10:00:00", LISTING_REFRESH_DAYS)


def test_upsert_idempotent_with_unique_keys(spark):
    old = spark.range(0, 200).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("v"))
    new = spark.range(150, 300).select(F.col("id").alias("k"),
                                       F.when(F.col("id") % 3 == 0, None).otherwise(F.lit("n")).alias("v"))
    once, _ = upsert(old, new, ["k"])
    once = once.drop("_action")
    twice, _ = upsert(once, new, ["k"])
    assert rows(once) == rows(twice.drop("_action"))


def test_partition_count_invariance(spark):
    import __spark_entry__ as E
    qs = E.queries()
    keys = ["product_sale", "seller_dim", "feedback_detail", "user_dim", "category_dims", "upsert_category"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = {}
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out[n] = {k: rows(qs[k](spark, SF_SMALL)) for k in keys}
        for k in keys:
            assert out["1"][k] == out["7"][k], k
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_run_id_tags_id_tables(spark):
    from martlake.plans.feedback import history
    from martlake.plans.product import inventory_snapshot
    from martlake.sources import bindings as B
    inv = inventory_snapshot(B.raw_product(spark, SF_SMALL), B.AS_OF, run_id="2002-01-01#1")
    assert inv.columns[-1] == "RunID" and inv.filter(F.col("RunID") != "2002-01-01#1").count() == 0
    assert "RunID" not in history(B.raw_feedback(spark, SF_SMALL)).columns
