"""Incremental loads with Structured Streaming.

New landing files are picked up by a file-source stream; every micro-batch is
merged into the target table in ``foreachBatch``. The merge is idempotent, so
a micro-batch replayed after a failure (foreachBatch is at-least-once) adds
nothing twice:

* ``append-distinct``: only rows not yet in the target (null-safe anti join)
  are appended;
* ``upsert``: the keyed null-aware upsert writes a new table beside the target, swaps the two,
  and records the micro-batch in it; a recorded micro-batch is skipped;
* :func:`merge_committed` upserts into a table of :mod:`martlake.operators.commit`, where the new rows, all partitions
  that change and the record of the micro-batch become visible by one commit;
* :func:`append_buckets` is ``append-distinct`` into a table in buckets, which shuffles the micro-batch only.

Offsets and the list of processed files live in the stream checkpoint, which
must be on shared storage (by default under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martlake.operators.buckets import append_distinct, open_distinct
from martlake.operators.commit import commit, head, read_committed
from martlake.operators.merge import new_rows, overwrite_table, table_exists, upsert
from martlake.operators.order import SEQ


def _stored(spark: SparkSession, path: str, batch: StructType, parts: Sequence[str]) -> DataFrame | None:
    """The stored table in its own schema (partition columns in the batch's types, not guessed from folder
    names), with the order of its rows as ``_seq``; None if there is no table."""
    if not table_exists(spark, path):
        return None
    own = spark.read.parquet(path).schema
    own = StructType([batch[f.name] if f.name in parts else f for f in own.fields])
    order = F.struct("_metadata.file_modification_time", "_metadata.file_name", "_metadata.row_index")
    return spark.read.schema(own).parquet(path).withColumn(SEQ, order)


def touched_partitions(existing: DataFrame, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` in the partitions the batch writes to: a semi join on the partition
    columns, which Spark can turn into dynamic partition pruning. Null partition values match each other."""
    cols = list(partition_by)
    values = batch.select(*cols).distinct()
    null = F.lit(False)
    for c in cols:
        null = null | F.col(c).isNull()
    named = values.filter(null).select(*[F.col(c).alias(f"_p_{c}") for c in cols])
    same = F.lit(True)
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    return existing.join(values.dropna(), cols, "left_semi").unionByName(existing.filter(null).join(named, same, "left_semi"))


def merge_batch(batch: DataFrame, target: str, mode: str = "append-distinct",
                keys: Sequence[str] | None = None, partition_by: Sequence[str] | None = None,
                batch_id: str | None = None) -> dict:
    """Merge one micro-batch (or any batch) into the Parquet table ``target``.

    ``partition_by``: the target is partitioned by these columns and a batch
    only reads and rewrites the partitions it touches (for ``upsert`` they must
    be part of ``keys``, so a key never moves between partitions).

    ``batch_id``: recorded in the table by an upsert; a batch that the table has recorded is a replay
    and changes nothing (null keys match no row, so they would be stored twice).

    Returns the load counts, collected with ``DataFrame.observe`` while the
    write runs (no extra pass): ``written`` for appends; ``updated``,
    ``inserted`` and ``kept`` for an upsert."""
    spark = batch.sparkSession
    parts = list(partition_by or [])
    if mode == "upsert" and not set(parts) <= set(keys or []):
        raise ValueError("partition columns must be part of the upsert keys")
    mark = f"_batch-{batch_id}" if batch_id and mode == "upsert" else None
    existing = _stored(spark, target, batch.schema, parts)
    if mark and existing is not None and table_exists(spark, f"{target.rstrip('/')}/{mark}"):
        return {"updated": 0, "inserted": 0, "kept": 0}

    def append(df: DataFrame) -> dict:
        obs = Observation()
        w = df.observe(obs, F.count(F.lit(1)).alias("written")).write.mode("append")
        (w.partitionBy(*parts) if parts else w).parquet(target)
        return dict(obs.get)

    if existing is None and mark:
        overwrite_table(batch, target, partition_by=parts or None, mark=mark)
        return {"written": spark.read.parquet(target).count()}
    if existing is None:
        return append(batch.dropDuplicates() if mode == "append-distinct" else batch)
    if parts:
        existing = touched_partitions(existing, batch, parts)
    if mode == "append-distinct":
        return append(new_rows(existing.drop(SEQ), batch))
    if mode == "upsert":
        result, _ = upsert(existing, batch, list(keys or []))
        obs = Observation()
        act = F.col("_action")
        result = result.observe(obs, *[F.count_if(act == a).alias(n) for a, n in
                                       (("update", "updated"), ("insert", "inserted"), ("keep", "kept"))])
        overwrite_table(result.drop("_action"), target, partition_by=parts or None, mark=mark)
        return dict(obs.get)
    raise ValueError(f"unknown mode {mode!r}")


def _row_order():
    """The order of stored rows: by file, then place in it."""
    return F.struct("_metadata.file_modification_time", "_metadata.file_name", "_metadata.row_index")


def merge_committed(batch: DataFrame, target: str, keys: Sequence[str], stream: str, number: int,
                    partition_by: Sequence[str] = (), order: Sequence[str] = ()) -> dict:
    """Upsert micro-batch ``number`` of ``stream`` into the committed table ``target``: one commit holds the result and the
    mark, so a replay finds its mark and changes nothing, and a stop leaves both out.

    With ``partition_by`` (part of the keys) only the partitions that the batch names are read and replaced, all by that
    commit. Stored rows of one key collapse to the last by ``order`` (by file and place in it if not given). Returns the counts ``updated``, ``inserted`` and ``kept``, observed while the result is written."""
    spark, parts = batch.sparkSession, list(partition_by)
    if not set(parts) <= set(keys):
        raise ValueError("partition columns must be part of the upsert keys")
    base = head(spark, target)
    if base and base.marks.get(stream, -1) >= number:
        return {"updated": 0, "inserted": 0, "kept": 0}
    obs, act = Observation(), F.col("_action")
    if base is None:
        result = batch.withColumn("_action", F.lit("insert"))
    else:
        existing = read_committed(spark, target, base)
        seq = F.struct(*order) if order else _row_order() if base.folders else F.lit(0)
        existing = existing.withColumn(SEQ, seq)
        if parts:
            existing = touched_partitions(existing, batch, parts)
        result, _ = upsert(existing, batch, list(keys))
    result = result.observe(obs, *[F.count_if(act == a).alias(n) for a, n in
                                   (("update", "updated"), ("insert", "inserted"), ("keep", "kept"))])
    commit(result.drop("_action"), target, parts, replace=not parts, mark=(stream, number), base=base)
    return {n: int(obs.get.get(n) or 0) for n in ("updated", "inserted", "kept")}


def append_buckets(batch: DataFrame, target: str, buckets: int) -> None:
    """Append the rows of a micro-batch that the bucketed table at ``target`` does not have."""
    name = f"distinct_{hashlib.sha256(target.encode()).hexdigest()[:16]}"
    append_distinct(open_distinct(batch.sparkSession, name, target, batch.schema, buckets), batch)


def run_incremental(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str,
                    mode: str = "append-distinct", keys: Sequence[str] | None = None,
                    fmt: str = "parquet", max_files_per_trigger: int | None = None,
                    partition_by: Sequence[str] | None = None,
                    merge: Callable[[DataFrame, int], object] | None = None) -> None:
    """Process every landing file not processed before, then stop
    (``trigger(availableNow=True)``): a scheduled incremental load. ``merge`` takes each micro-batch and its
    number in place of :func:`merge_batch`; it must bear being called again with the same ones."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source)
    stream_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    q = (stream.writeStream
               .foreachBatch(merge or (lambda df, n: merge_batch(df, target, mode, keys, partition_by, f"{stream_id}-{n}")))
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True)
               .start())
    q.awaitTermination()
