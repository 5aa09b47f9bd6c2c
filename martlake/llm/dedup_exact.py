"""Exact deduplication with a heavy-hitter split, in DataFrame operations only.

A digest (SHA-256 of the UTF-8 text) stands for a text. A Misra-Gries summary, which Spark
keeps per partition and merges (``freqItems``), holds at most 1/support digests and
surely every digest of more than a ``support`` share of the rows. What it names is
counted exactly; the winners of those groups (a table of at most 1/support rows, so its size
is bounded whatever the input) are broadcast, and rows of frequent digests are settled where they
are read. No remaining digest has more than a ``support`` share of the rows, so they
go through an ordinary shuffle.

Defined cases: a null text is the empty text; rows with one doc_id and one text are each reported, with the same
marks, and counted in ``group_size`` (:func:`drop_exact_duplicates` keeps one of them); a null doc_id
loses to any other and stays only if its group has no other; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.session import scratch_path

SUPPORT = 0.001

_ID, _SHA, _KEEP, _SIZE, _N, _RANK = (f"__dedup_{x}" for x in ("id", "sha", "keep", "size", "n", "rank"))


def _digest(text_col: str):
    return F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256)


def _winners(ids: DataFrame, support: float) -> tuple[DataFrame, DataFrame]:
    """(winners of frequent digests, winners of the others) of a table (_SHA, _ID, _N)."""
    frequent = ids.freqItems([_SHA], support).select(F.explode(f"{_SHA}_freqItems").alias(_SHA))
    best = [F.max(_ID).alias(_KEEP), F.sum(_N).alias(_SIZE)]
    head = ids.join(F.broadcast(frequent), _SHA, "left_semi").groupBy(_SHA).agg(*best)
    tail = ids.join(F.broadcast(frequent), _SHA, "left_anti").groupBy(_SHA).agg(*best)
    return head, tail


def _split(rows: DataFrame, head: DataFrame, tail: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the winner of their group: of frequent digests map-side, of the others by shuffle."""
    settled = rows.join(F.broadcast(head), _SHA)
    others = rows.join(F.broadcast(head.select(_SHA)), _SHA, "left_anti").join(tail, _SHA)
    return settled, others


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the
    largest doc_id stays. The texts are read and hashed once, into a narrow table in the shared folder."""
    path = scratch_path(docs.sparkSession, f"dedup-digests-{uuid.uuid4().hex}")
    docs.select(_digest(text_col).alias(_SHA), F.col(id_col).alias(_ID), F.lit(1).alias(_N)).write.parquet(path)
    ids = docs.sparkSession.read.parquet(path)
    settled, others = _split(ids, *_winners(ids, support))
    return settled.unionByName(others).select(
        F.col(_ID).alias("doc_id"), F.col(_KEEP).alias("keep_id"), F.col(_SIZE).alias("group_size"),
        F.col(_ID).eqNullSafe(F.col(_KEEP)).alias("kept"), F.col(_SHA).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          support: float = SUPPORT) -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the largest doc_id;
    all columns as they were."""
    rows = docs.withColumn(_SHA, _digest(text_col)).withColumn(_ID, F.col(id_col))
    head, tail = _winners(rows.select(_SHA, _ID, F.lit(1).alias(_N)), support)
    one = Window.partitionBy(_SHA).orderBy(F.lit(1))
    out = None
    for part in _split(rows, head, tail):  # the filter leaves only repeated rows of a winner to the window
        part = (part.filter(F.col(_ID).eqNullSafe(F.col(_KEEP)))
                .withColumn(_RANK, F.row_number().over(one)).filter(F.col(_RANK) == 1).select(*docs.columns))
        out = part if out is None else out.unionByName(part)
    return out
