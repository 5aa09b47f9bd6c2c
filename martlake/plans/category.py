"""Category flow: flattened 4-level rows -> repaired hierarchy -> 4 dimension
tables; listing rows -> ReferenceProduct; loads by upsert / append-distinct."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.operators.hierarchy import collapse_single_category, dimensions_long, fill_levels, split_dimensions
from martlake.operators.quality import strict_cast

LEVEL_CASTS = {"GroupID": "bigint", "MasterCategoryID": "bigint", "CategoryID": "bigint", "SubCategoryID": "bigint"}


def repaired_hierarchy(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Collapse single-category masters, fill missing levels, strict id casts.
    Returns (valid rows, quarantined rows)."""
    h = fill_levels(collapse_single_category(raw.drop("_seq") if "_seq" in raw.columns else raw))
    return strict_cast(h, LEVEL_CASTS)


def category_dimensions(raw: DataFrame) -> dict[str, DataFrame]:
    valid, _ = repaired_hierarchy(raw)
    return split_dimensions(valid)


def category_dimensions_long(raw: DataFrame) -> DataFrame:
    return dimensions_long(category_dimensions(raw))


REFERENCE_CASTS = {"ReferenceID": "bigint", "SubCategoryID": "bigint", "ProductID": "bigint"}


def reference_rows(listing: DataFrame) -> DataFrame:
    """Distinct (ReferenceID = sub-category id || product id as text, ids, brand), the ids not yet cast."""
    return listing.select(F.concat(F.col("sub_category_id").cast("string"), F.col("product_id").cast("string")).alias("ReferenceID"),
                          F.col("sub_category_id").alias("SubCategoryID"), F.col("product_id").alias("ProductID"),
                          F.col("brand_name").alias("BrandName")).distinct()


def reference_product(listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`reference_rows` with strict id casts. Returns (valid, quarantine)."""
    return strict_cast(reference_rows(listing), REFERENCE_CASTS)
