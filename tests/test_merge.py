"""Null-aware upsert, append-distinct, overwrite (FIXTURES §C)."""

from conftest import rows
from martlake.operators.merge import insert_distinct, new_rows, overwrite_table, upsert


def test_upsert_corner_cases(spark):
    old = spark.createDataFrame([
        (1, "a", "x", 1),        # matched, new value null -> old kept
        (2, "b", "y", 2),        # untouched
        (3, "c1", "z1", 3), (3, "c2", "z2", 4),   # duplicate old key -> last wins
        (None, "n", "w", 5)],    # null key: never matches, kept
        "id bigint, name string, only_old string, _seq bigint")
    new = spark.createDataFrame([
        (1, None, 10), (3, "C", 30), (3, "D", 31),   # duplicate new key: both emitted
        (4, "d", 40), (None, "m", 50)],              # insert; null key inserts too
        "id bigint, name string, extra bigint")
    result, counts = upsert(old, new, ["id"])
    got = rows(result.drop("_seq"))
    assert got == [
        (1, "a", "x", 10, "update"), (2, "b", "y", None, "keep"), (3, "C", "z2", 30, "update"),
        (3, "D", "z2", 31, "update"), (4, "d", None, 40, "insert"),
        (None, "m", None, 50, "insert"), (None, "n", "w", None, "keep")]
    c = counts.collect()[0]
    assert (c["updated"], c["inserted"], c["kept"]) == (3, 2, 2)


def test_insert_distinct_first_and_repeat(spark):
    inc = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a bigint, b string")
    first, c1 = insert_distinct(None, inc)
    assert first.count() == 3 and c1.collect()[0]["inserted"] == 3          # first load keeps duplicates
    second, c2 = insert_distinct(first, inc)
    r = c2.collect()[0]
    assert second.count() == 2 and (r["inserted"], r["removed_duplicates"]) == (-1, 4)
    assert new_rows(second, inc).count() == 0                               # nothing new, null-safe


def test_overwrite_own_input(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    df = spark.read.parquet(path)
    overwrite_table(df.selectExpr("id * 2 AS id"), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [0, 2, 4, 6, 8]


def test_overwrite_swaps_in_a_whole_table(spark, tmp_path):
    import pytest
    from martlake.operators.merge import overwrite_table, table_exists
    from pyspark.sql import functions as F
    plain = str(tmp_path / "a table")
    for path in (plain, f"file:{plain}", f"{plain}/"):
        overwrite_table(spark.range(5), path)
        overwrite_table(spark.read.parquet(path).filter("id < 4"), path)  # reads what it replaces
        assert spark.read.parquet(plain).count() == 4
    with pytest.raises(Exception):  # noqa: B017 - whatever the failing expression raises
        overwrite_table(spark.read.parquet(plain).select(F.raise_error(F.lit("x")).cast("long").alias("id")), plain)
    assert spark.read.parquet(plain).count() == 4
    (tmp_path / "a table").rename(tmp_path / ".a table.old")  # stopped between the renames
    assert table_exists(spark, plain) and spark.read.parquet(plain).count() == 4
    assert not table_exists(spark, str(tmp_path / "none"))
