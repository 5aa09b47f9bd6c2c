"""Loading operators: null-aware keyed upsert, append-distinct, first load, and
safe overwrite of a table that may be the job's own input."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.operators.order import SEQ, keep_first


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], seq: str = SEQ
           ) -> tuple[DataFrame, DataFrame]:
    """Null-aware keyed upsert. Returns ``(result, counts)``.

    * An incoming row whose key matches an existing row updates it: each
      incoming column overwrites the old value unless the new value is null;
      columns only in the existing table are kept.
    * Existing rows with a duplicated key collapse to the last one by ``seq``.
    * Duplicate incoming keys are each merged with the same existing row and
      all emitted. A null key never matches (plain ``=``).
    * Existing rows no incoming row matches are kept as they are.

    Plan: (incoming LEFT JOIN existing) for updates/inserts, plus (existing
    LEFT ANTI JOIN distinct incoming keys) for untouched rows. Both joins are
    ones AQE can split on a skewed key (a full outer join cannot be split).
    ``counts`` is one row (updated, inserted, kept).
    """
    keys = list(keys)
    has_seq = seq in existing.columns
    old_cols = [c for c in existing.columns if c != seq]
    new_cols = [c for c in incoming.columns if c != seq]
    key_ok = F.lit(True)
    for k in keys:
        key_ok = key_ok & F.col(k).isNotNull()
    old_valid = existing.filter(key_ok)
    old_valid = keep_first(old_valid, keys, [F.col(seq)], last=True) if has_seq else old_valid.dropDuplicates(keys)
    old_null = existing.filter(~key_ok)
    ktypes = {k: incoming.schema[k].dataType for k in keys}
    old = old_valid.select(*[(F.col(c).cast(ktypes[c]) if c in ktypes else F.col(c)).alias(f"_o_{c}")
                             for c in old_cols])
    new = incoming.select(*[F.col(c).alias(f"_n_{c}") for c in new_cols])

    cond = None
    for k in keys:
        c = F.col(f"_n_{k}") == F.col(f"_o_{k}")
        cond = c if cond is None else cond & c
    matched = new.join(old, cond, "left")
    hit = F.col(f"_o_{keys[0]}").isNotNull()
    out_cols = old_cols + [c for c in new_cols if c not in old_cols]

    def merged(c: str):
        if c in new_cols and c in old_cols:
            v = F.when(hit, F.coalesce(F.col(f"_n_{c}"), F.col(f"_o_{c}"))).otherwise(F.col(f"_n_{c}"))
        elif c in new_cols:
            v = F.col(f"_n_{c}")
        else:
            v = F.when(hit, F.col(f"_o_{c}"))
        return v.alias(c)
    up = matched.select(*[merged(c) for c in out_cols],
                        F.when(hit, F.lit("update")).otherwise(F.lit("insert")).alias("_action"))

    new_keys = incoming.select(*keys).filter(key_ok).distinct()
    untouched = old_valid.join(new_keys, on=keys, how="left_anti").unionByName(old_null)
    kept = untouched.select(*[(F.col(c) if c in old_cols else F.lit(None).cast(incoming.schema[c].dataType)).alias(c)
                              for c in out_cols], F.lit("keep").alias("_action"))
    result = up.unionByName(kept)
    counts = result.agg(F.count_if(F.col("_action") == "update").cast("bigint").alias("updated"),
                        F.count_if(F.col("_action") == "insert").cast("bigint").alias("inserted"),
                        F.count_if(F.col("_action") == "keep").cast("bigint").alias("kept"))
    return result, counts


def insert_distinct(existing: DataFrame | None, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Append-distinct. Returns ``(result, counts)``.

    First load (``existing`` is None): the incoming frame as is, duplicates kept.
    Otherwise: union by name (missing columns null) and distinct over all
    columns (nulls equal). ``counts``: inserted = result rows - existing rows,
    removed_duplicates = existing + incoming rows - result rows."""
    if existing is None:
        counts = incoming.agg(F.count(F.lit(1)).cast("bigint").alias("inserted"),
                              F.lit(0).cast("bigint").alias("removed_duplicates"))
        return incoming, counts
    union = existing.unionByName(incoming, allowMissingColumns=True)
    result = union.dropDuplicates()
    sizes = (existing.agg(F.count(F.lit(1)).alias("n")).select(F.lit("e").alias("m"), "n")
             .unionByName(incoming.agg(F.count(F.lit(1)).alias("n")).select(F.lit("i").alias("m"), "n"))
             .unionByName(result.agg(F.count(F.lit(1)).alias("n")).select(F.lit("r").alias("m"), "n")))
    size = {m: F.sum(F.when(F.col("m") == m, F.col("n"))) for m in ("e", "i", "r")}
    counts = sizes.agg((size["r"] - size["e"]).cast("bigint").alias("inserted"),
                       (size["e"] + size["i"] - size["r"]).cast("bigint").alias("removed_duplicates"))
    return result, counts


def new_rows(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows not already present (null-safe on every column)."""
    cols = [c for c in incoming.columns if c in existing.columns]
    if not cols:                      # nothing comparable: every row is new (never a keyless join)
        return incoming.dropDuplicates()
    cond = None
    for c in cols:
        x = incoming[c].eqNullSafe(existing[c])
        cond = x if cond is None else cond & x
    return incoming.join(existing, cond, "left_anti").dropDuplicates()


def _fs(spark, path: str):
    """(file system, path) of a table, whatever store and form its path has."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _beside(spark, path: str, what: str) -> str:
    """A hidden sibling of ``path`` (readers of the parent skip it)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{what}").toString()


def table_exists(spark, path: str) -> bool:
    """Whether a table is stored at ``path``; an overwrite that was cut off between its two
    renames is undone first. Storage errors are raised, not read as absence."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return True
    _, old = _fs(spark, _beside(spark, path, "old"))
    return fs.exists(old) and fs.rename(old, p)


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                    mark: str | None = None, **options) -> str:
    """Overwrite ``path``, also when ``df`` reads from it.

    The result is always written to a new sibling folder and only then takes the place of the
    old table by two renames, so a failed write leaves the old table as it was, and
    :func:`table_exists` mends a stop between the renames. With ``partition_by`` only the
    partitions present in ``df`` are replaced, each by the same swap: a stop between them leaves some old and some new
    (:mod:`martlake.operators.commit` changes them together). ``mark`` is the name of an empty
    file that is put into the new table before the swap, or after that of the last partition (readers skip
    names with an underscore)."""
    spark = df.sparkSession
    new = _beside(spark, path, f"new-{uuid.uuid4().hex}")
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(new)
    fs, source = _fs(spark, new)
    if partition_by and table_exists(spark, path):
        for part in _partitions(fs, source, len(partition_by)):
            own = "/".join(part.rstrip("/").split("/")[-len(partition_by):])
            _swap(spark, fs, part, f"{path.rstrip('/')}/{own}")
        fs.delete(source, True)
        if mark:
            fs.create(_fs(spark, f"{path.rstrip('/')}/{mark}")[1], True).close()
    else:
        if mark:
            fs.create(_fs(spark, f"{new}/{mark}")[1], True).close()
        table_exists(spark, path)
        _swap(spark, fs, new, path)
    return path


def _partitions(fs, root, depth: int) -> list[str]:
    """Folders of the partitions below ``root``."""
    found = [root]
    for _ in range(depth):
        found = [x.getPath() for f in found for x in fs.listStatus(f) if x.isDirectory()]
    return [f.toString() for f in found]


def _swap(spark, fs, new: str, path: str) -> None:
    _, source = _fs(spark, new)
    _, target = _fs(spark, path)
    _, old = _fs(spark, _beside(spark, path, "old"))
    if fs.exists(old):  # left by a stop after the second rename
        fs.delete(old, True)
    fs.mkdirs(target.getParent())
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"{path} can't be moved aside")
    if not fs.rename(source, target):
        fs.rename(old, target)
        raise OSError(f"{new} can't be moved to {path}")
    fs.delete(old, True)
