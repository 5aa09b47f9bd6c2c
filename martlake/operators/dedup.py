"""Entity-specific deduplication rules, each one aggregate with partial
aggregation (``min_by`` over a struct of the row, ordered by a struct of the
rule's priorities). No per-group Python, no window over a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.operators.order import SEQ, keep_first


def drop_marked_duplicates(df: DataFrame, key: str, marked, order=SEQ) -> DataFrame:
    """For keys occurring more than once, drop the rows where ``marked`` holds,
    then keep the first row per key by ``order``. A key that occurs once keeps
    its row even if marked; a duplicated key whose rows are all marked vanishes.

    One aggregation computes the key count, the first unmarked row and the first
    row, so no join back onto the rows is needed."""
    rest = [c for c in df.columns if c != key]
    row = F.struct(*[F.col(c) for c in rest])
    o = F.col(order) if isinstance(order, str) else order
    clean_o = F.when(~F.coalesce(marked, F.lit(False)), o)  # null order -> row ignored by min_by
    g = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(row, clean_o).alias("_clean"),
        F.min_by(row, o).alias("_any"),
    )
    pick = F.when(F.col("_n") == 1, F.col("_any")).otherwise(F.col("_clean"))
    g = g.select(key, pick.alias("_r")).filter(F.col("_r").isNotNull())
    return g.select(key, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def earliest_dated(df: DataFrame, key: str, date: str, seq: str = SEQ) -> DataFrame:
    """Per key: the row with the earliest non-null ``date``; when no row has a
    date, the first row. Ties on date go to the first row by ``seq``."""
    d = F.col(date)
    return keep_first(df, [key], [d.isNull(), d, F.col(seq)])


def priority_pick(df: DataFrame, key: str, date: str, name: str, seq: str = SEQ) -> DataFrame:
    """Per key, in priority order: a row with a date beats one without; then the
    longest name (null counts as length 0); then a non-null name; then first."""
    d, n = F.col(date), F.col(name)
    return keep_first(df, [key], [d.isNull(), -F.length(F.coalesce(n, F.lit(""))), n.isNull(), F.col(seq)])


def star_count(c) -> F.Column:
    """Number of '*' in the text; null text counts 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.length(c) - F.length(F.replace(c, F.lit("*"), F.lit(""))), F.lit(0))


def least_masked(df: DataFrame, keys: list[str], text: str, seq: str = SEQ) -> DataFrame:
    """Per key tuple, the row whose ``text`` has the fewest '*' (ties: first by
    ``seq``). Rows with a null in any key are dropped first (group keys)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return keep_first(df.filter(cond), keys, [star_count(text), F.col(seq)])
