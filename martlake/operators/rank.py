"""Ranks within groups without a window over a group, so a group may hold any share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.operators.order import dense_id


def rank_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], rank: str = "_rank",
                  size: str = "_size") -> DataFrame:
    """Add each row's 0-based position within its group (``order`` must be total within it) and the group's size.

    The rows get dense ids in (group, order) order by a range shuffle, which cuts large groups; a group's least id and count
    are a pre-aggregated table of one row per group, joined back."""
    group = list(group)
    ids = dense_id(df, [*group, *order], "_id")
    first = ids.groupBy(*group).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias(size))
    joined = ids.join(first.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_first", size),
                      [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group])
    return joined.select(*[F.col(c) for c in df.columns], (F.col("_id") - F.col("_first")).alias(rank), F.col(size))


def ntile(df: DataFrame, n: int, group: Sequence[str], order: Sequence[str | Column], out: str = "Tile") -> DataFrame:
    """``ntile(n) over (partition by group order by order)``: tiles 1..n whose sizes differ by at most one, the larger first."""
    r, base, extra = F.col("_rank"), F.floor(F.col("_size") / n), F.col("_size") % n
    wide = extra * (base + 1)  # rows in the tiles that are one larger
    tile = F.when(r < wide, F.floor(r / (base + 1))).otherwise(extra + F.floor((r - wide) / F.greatest(base, F.lit(1))))
    return rank_in_group(df, group, order).withColumn(out, (tile + 1).cast("int")).drop("_rank", "_size")
