"""Tables written in global order: readers of a range open few files, and of those few row groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def write_ordered(df: DataFrame, path: str, order: Sequence[str | Column], files: int | None = None) -> None:
    """Write ``df`` to Parquet in the order of ``order``: file i holds only rows that do not come after those of file i + 1, and
    the rows of a file are sorted. Ranges come from a sample of the order columns, so a value that holds a
    third of the rows fills one file unless ``order`` goes on to columns that tell its rows apart."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.parquet(path)
