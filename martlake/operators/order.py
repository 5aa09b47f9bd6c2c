"""Order-aware primitives: keep-first/last by key, ordered distinct, dense ids.

Spark rows have no order, so every rule that the reference resolves by row
position takes an explicit order expression here (normally ending in ``_seq``).
All of them are partial aggregations (map-side combine) or range shuffles; none
is an unpartitioned window or a per-group Python function, so a hot key costs
one combined row per map task, not a third of the data in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions.exprs import col

SEQ = "_seq"


def _cols(cs) -> list[Column]:
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [col(c) for c in cs]


def asc_nulls_last(c) -> list[Column]:
    """Order components for ascending with nulls last (struct field order)."""
    c = col(c)
    return [c.isNull(), c]


def desc_nulls_last(c) -> list[Column]:
    """Order components for descending numeric order, nulls last."""
    c = col(c)
    return [c.isNull(), -c]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence, last: bool = False) -> DataFrame:
    """One row per key: the smallest (``last``: largest) by ``order``.

    Equivalent to sorting by ``order`` and keeping the first row of each key,
    with a null key being a key value of its own. Runs as ``min_by(struct(row), struct(order))`` with
    partial aggregation (a sort aggregate, since a struct buffer cannot be hashed in place).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordk = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_cols(order))])
    row = F.struct(*[F.col(c) for c in rest])
    pick = F.max_by(row, ordk) if last else F.min_by(row, ordk)
    out = df.groupBy(*keys).agg(pick.alias("_r"))
    return out.select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def distinct_rows(df: DataFrame, seq: str | None = SEQ) -> DataFrame:
    """Distinct over all columns but ``seq``, nulls equal; each survivor keeps
    the smallest ``seq`` of its duplicates (its first occurrence)."""
    if seq is None or seq not in df.columns:
        return df.dropDuplicates()
    cols = [c for c in df.columns if c != seq]
    return df.groupBy(*cols).agg(F.min(seq).alias(seq)).select(*df.columns)


def dense_id(df: DataFrame, order: Sequence, id_col: str, start: int = 1,
             num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = 1..N following ``order`` (which must be a total order).

    Distributed: range-partition on the order and sort inside partitions, tag
    every row with (partition, position), and cut lineage with a reliable
    checkpoint so the tags cannot change on recomputation (an executor loss or
    a re-planned read). Per-partition counts (one row per partition, a proven
    bound) give offsets by a running sum, broadcast back onto the rows.
    """
    oc = _cols(order)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *oc).sortWithinPartitions(*oc)
    tagged = ranged.select("*", F.spark_partition_id().alias("_pid"),
                           F.monotonically_increasing_id().alias("_mid"))
    tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_base"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select("_pid", "_base", (F.sum("_n").over(w) - F.col("_n")).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_pid")
    ident = (F.col("_off") + (F.col("_mid") - F.col("_base")) + F.lit(start)).cast("bigint")
    return out.select(ident.alias(id_col), *[F.col(c) for c in df.columns])


def tag_run(df: DataFrame, run_id: str | None, col_name: str = "RunID") -> DataFrame:
    """Add the run's id as a column (ordinal ids are dense over one run's whole
    batch; the run id tells runs apart). ``None`` leaves ``df`` unchanged."""
    return df if run_id is None else df.withColumn(col_name, F.lit(run_id))
