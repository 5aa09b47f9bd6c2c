"""Reading the landing tables (Parquet) with column pruning left to Catalyst."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; later selects/filters are pushed into the scan. The plan is the
    same for any input size and cluster: how a file is split is the file layout's matter."""
    return spark.read.parquet(table_path(sf_dir, name))
