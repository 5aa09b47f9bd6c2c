"""Warehouse CSV interchange: header row, RFC-4180 quoting (a quote inside a
field is doubled), fields may span lines, values are never trimmed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


def read_csv(spark: SparkSession, path: str, schema: StructType, na_values: str | None = None) -> DataFrame:
    """Read with an explicit schema (never inferred). A leading UTF-8 BOM is
    tolerated. ``na_values``: optional text to read as null (e.g. 'NA')."""
    r = spark.read.schema(schema).options(**CSV_OPTIONS)
    if na_values is not None:
        r = r.option("nullValue", na_values)
    return r.csv(path)


BOM = "\ufeff"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", bom: bool = True) -> str:
    """Write as header CSV (one file per partition; Spark writes in parallel), each file led by a UTF-8 byte-order mark
    unless ``bom`` is false: the mark goes before the first name of the header, which is what each file begins with."""
    if bom:
        df = df.toDF(BOM + df.columns[0], *df.columns[1:])
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return path
