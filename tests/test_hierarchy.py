"""Category hierarchy repair (FIXTURES §C)."""

from conftest import rows
from martlake.plans.category import repaired_hierarchy

SCHEMA = ("GroupID bigint, GroupName string, MasterCategoryID bigint, MasterCategoryName string, "
          "CategoryID bigint, CategoryName string, SubCategoryID bigint, SubCategoryName string")


def test_collapse_fill_and_quarantine(spark):
    raw = spark.createDataFrame([
        (1, "G", 10, "M10", None, None, None, None),        # master with 0 categories
        (1, "G", 11, "M11", 111, "C111", None, None),       # master with 1 category -> collapsed
        (1, "G", 12, "M12", 121, "C121", 1211, "S1211"),    # master with 2 categories
        (1, "G", 12, "M12", 122, "C122", None, None),
        (1, "G", 13, "M13", 131, "C131", 1311, "S1311"),    # 1 category + real subcategory
        (1, "G", None, None, 141, "C141", None, None)],     # null master -> quarantine
        SCHEMA)
    valid, bad = repaired_hierarchy(raw)
    got = rows(valid.select("MasterCategoryID", "CategoryID", "isCategory", "SubCategoryID", "isSubCategory"))
    assert got == [(10, 10, 0, 10, 0), (11, 11, 0, 11, 0), (12, 121, 1, 1211, 1), (12, 122, 1, 122, 0),
                   (13, 13, 0, 1311, 1)]
    assert rows(bad.select("_error")) == [("MasterCategoryID",)]
