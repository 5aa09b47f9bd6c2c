"""Tables stored in buckets of a key, so that a load shuffles its batch and not the table.

A bucketed table's rows of one key lie in files of one bucket, and Spark's joins and aggregations on that key read
the stored side where it lies. Such a table is known to a session by a catalog entry over its folder, which any later session can make
again (:func:`open_buckets`). Appends add files to each bucket."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martlake.operators.merge import upsert

DIGEST = "_digest"


@dataclass(frozen=True)
class Buckets:
    """A stored table: catalog name, folder, columns, key and number of buckets."""

    name: str
    path: str
    schema: StructType
    keys: tuple[str, ...]
    n: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def dealt(self, df: DataFrame) -> DataFrame:
        """``df`` dealt like the stored rows: one file per bucket when written, no further shuffle when joined."""
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).repartition(self.n, *self.keys)

    def append(self, df: DataFrame) -> None:
        self.dealt(df).write.insertInto(self.name)


def open_buckets(spark: SparkSession, name: str, path: str, schema: StructType, keys: Sequence[str], n: int) -> Buckets:
    """The table stored at ``path`` (created empty if there is none), by the name ``name`` in this session."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {n} BUCKETS LOCATION '{path}'")
    return Buckets(name, path, schema, tuple(keys), n)


def with_digest(df: DataFrame) -> DataFrame:
    """``df`` with a 64-bit digest of the whole row. Rows of equal digests are still compared column by column."""
    return df.withColumn(DIGEST, F.xxhash64(*[c for y in df.columns for c in (F.col(y), F.col(y).isNull())]))


def open_distinct(spark: SparkSession, name: str, path: str, schema: StructType, n: int) -> Buckets:
    """An append-distinct table: its rows with their digests, in buckets of the digest."""
    return open_buckets(spark, name, path, StructType(schema.fields + [StructType.fromDDL(f"{DIGEST} bigint").fields[0]]), [DIGEST], n)


def rows_of(table: Buckets, spark: SparkSession) -> DataFrame:
    return table.read(spark).drop(DIGEST)


def unseen_rows(table: Buckets, batch: DataFrame) -> DataFrame:
    """Distinct rows of ``batch`` (with digests) that the table does not have, nulls equal.

    The stored rows are read once, where they lie, against a hash table of the batch's digests, bucket by bucket; only the few that share a
    digest with the batch are compared in full. The batch is the only side that is shuffled."""
    new = table.dealt(with_digest(batch.dropDuplicates()))  # repeated rows are combined before they are dealt
    stored = table.read(batch.sparkSession)
    alike = stored.join(new.select(DIGEST).hint("shuffle_hash"), DIGEST, "left_semi")
    same = [new[c].eqNullSafe(alike[c]) for c in new.columns]
    return new.join(alike, same, "left_anti")


def append_distinct(table: Buckets, batch: DataFrame) -> None:
    """Append the rows of ``batch`` that the table does not have. Doing it again appends nothing."""
    unseen_rows(table, batch).write.insertInto(table.name)


def upsert_buckets(table: Buckets, incoming: DataFrame, seq: str = "_seq") -> DataFrame:
    """:func:`martlake.operators.merge.upsert` into a table in buckets of its keys: the result rows with ``_action``. Neither the
    collapse of stored duplicates nor the two joins shuffle the stored side. A load with a very frequent
    key should take the plain upsert, whose joins Spark can split."""
    result, _ = upsert(table.read(incoming.sparkSession), incoming, list(table.keys), seq)
    return result
