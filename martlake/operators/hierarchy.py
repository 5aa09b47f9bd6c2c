"""Category-hierarchy repair: collapse single-category masters, fill missing
levels downward, split into dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL_IDS = ["GroupID", "MasterCategoryID", "CategoryID", "SubCategoryID"]


def collapse_single_category(df: DataFrame, master: str = "MasterCategoryID", cat: str = "CategoryID",
                             cat_name: str = "CategoryName") -> DataFrame:
    """Masters with exactly one distinct non-null category lose that level:
    its id and name become null (the sub-category is untouched). A null master
    is never collapsed. The per-master count is an aggregate joined back on the
    master id (AQE broadcasts it when measured small)."""
    n = (df.filter(F.col(master).isNotNull())
           .groupBy(master).agg(F.countDistinct(cat).alias("_ncat")))
    j = df.join(n, on=master, how="left")
    single = F.coalesce(F.col("_ncat") == 1, F.lit(False))
    out = j.withColumn(cat, F.when(single, F.lit(None).cast(df.schema[cat].dataType)).otherwise(F.col(cat))) \
           .withColumn(cat_name, F.when(single, F.lit(None).cast("string")).otherwise(F.col(cat_name)))
    return out.select(*df.columns)


def fill_levels(df: DataFrame) -> DataFrame:
    """A missing category takes the master's id and name (isCategory 0); a
    missing sub-category then takes the (filled) category (isSubCategory 0)."""
    no_cat = F.col("CategoryID").isNull()
    cat_id = F.when(no_cat, F.col("MasterCategoryID")).otherwise(F.col("CategoryID"))
    cat_name = F.when(no_cat, F.col("MasterCategoryName")).otherwise(F.col("CategoryName"))
    no_sub = F.col("SubCategoryID").isNull()
    return df.select(
        *[c for c in df.columns if c not in ("CategoryID", "CategoryName", "SubCategoryID", "SubCategoryName")],
        cat_id.alias("CategoryID"), cat_name.alias("CategoryName"),
        F.when(no_cat, 0).otherwise(1).cast("int").alias("isCategory"),
        F.when(no_sub, cat_id).otherwise(F.col("SubCategoryID")).alias("SubCategoryID"),
        F.when(no_sub, cat_name).otherwise(F.col("SubCategoryName")).alias("SubCategoryName"),
        F.when(no_sub, 0).otherwise(1).cast("int").alias("isSubCategory"),
    )


def split_dimensions(df: DataFrame) -> dict[str, DataFrame]:
    """Four distinct dimension tables keyed by their level id."""
    return {
        "Group": df.select("GroupID", F.col("GroupName").alias("Name")).distinct(),
        "MasterCategory": df.select("MasterCategoryID", "GroupID",
                                    F.col("MasterCategoryName").alias("Name")).distinct(),
        "Category": df.select("CategoryID", "MasterCategoryID", F.col("CategoryName").alias("Name"),
                              "isCategory").distinct(),
        "SubCategory": df.select("SubCategoryID", "CategoryID", F.col("SubCategoryName").alias("Name"),
                                 "isSubCategory").distinct(),
    }


def dimensions_long(dims: dict[str, DataFrame]) -> DataFrame:
    """The four dimensions as one table (Dim, ID, ParentID, Name, Flag)."""
    spec = {"Group": ("GroupID", None, None), "MasterCategory": ("MasterCategoryID", "GroupID", None),
            "Category": ("CategoryID", "MasterCategoryID", "isCategory"),
            "SubCategory": ("SubCategoryID", "CategoryID", "isSubCategory")}
    out = None
    for name, (i, p, f) in spec.items():
        d = dims[name].select(
            F.lit(name).alias("Dim"), F.col(i).cast("bigint").alias("ID"),
            (F.col(p) if p else F.lit(None)).cast("bigint").alias("ParentID"), F.col("Name"),
            (F.col(f) if f else F.lit(None)).cast("int").alias("Flag"))
        out = d if out is None else out.unionByName(d)
    return out
