"""Oracle SQL for the category flow and the loaders."""

from martlake.oracle.sources import SQL as _SOURCES
from martlake.sources.bindings import (
    BROKEN_LISTING_SQL, CUSTOMER_BATCHES_SQL, CUSTOMER_SQL, LISTING_SQL, RAW_CATEGORY_SQL, SALES_LOADS_SQL, with_bindings,
)

_H = """
nc AS (SELECT MasterCategoryID, count(DISTINCT CategoryID) AS n FROM raw_category
       WHERE MasterCategoryID IS NOT NULL GROUP BY MasterCategoryID),
h1 AS (
  SELECT r.GroupID, r.GroupName, r.MasterCategoryID, r.MasterCategoryName,
         CASE WHEN nc.n = 1 THEN NULL ELSE r.CategoryID END AS CategoryID,
         CASE WHEN nc.n = 1 THEN NULL ELSE r.CategoryName END AS CategoryName,
         r.SubCategoryID, r.SubCategoryName
  FROM raw_category r LEFT JOIN nc ON r.MasterCategoryID = nc.MasterCategoryID),
h2 AS (
  SELECT GroupID, GroupName, MasterCategoryID, MasterCategoryName,
         coalesce(CategoryID, MasterCategoryID) AS CategoryID,
         CASE WHEN CategoryID IS NULL THEN MasterCategoryName ELSE CategoryName END AS CategoryName,
         CAST(CASE WHEN CategoryID IS NULL THEN 0 ELSE 1 END AS INTEGER) AS isCategory,
         coalesce(SubCategoryID, CategoryID, MasterCategoryID) AS SubCategoryID,
         CASE WHEN SubCategoryID IS NOT NULL THEN SubCategoryName
              WHEN CategoryID IS NULL THEN MasterCategoryName ELSE CategoryName END AS SubCategoryName,
         CAST(CASE WHEN SubCategoryID IS NULL THEN 0 ELSE 1 END AS INTEGER) AS isSubCategory
  FROM h1)
"""
_WC = with_bindings(RAW_CATEGORY_SQL, _H)
_REF = with_bindings(LISTING_SQL, """
ref AS (
  SELECT DISTINCT TRY_CAST(CAST(sub_category_id AS VARCHAR) || CAST(product_id AS VARCHAR) AS BIGINT) AS ReferenceID,
         sub_category_id AS SubCategoryID, product_id AS ProductID, brand_name AS BrandName
  FROM listing)""")

_DIMS = """
SELECT DISTINCT 'Group' AS Dim, CAST(GroupID AS BIGINT) AS ID, CAST(NULL AS BIGINT) AS ParentID, GroupName AS Name,
       CAST(NULL AS INTEGER) AS Flag FROM h2
UNION ALL
SELECT DISTINCT 'MasterCategory', MasterCategoryID, GroupID, MasterCategoryName, CAST(NULL AS INTEGER) FROM h2
UNION ALL
SELECT DISTINCT 'Category', CategoryID, MasterCategoryID, CategoryName, isCategory FROM h2
UNION ALL
SELECT DISTINCT 'SubCategory', SubCategoryID, CategoryID, SubCategoryName, isSubCategory FROM h2"""
# The load starts from the flattened tree; groups without a master are quarantined.
_LOADED = f"WITH tree AS ({_SOURCES['flatten_category_tree']}),\n{_H.strip().replace('raw_category', 'tree')}"
_BROKEN_REF = with_bindings(LISTING_SQL, BROKEN_LISTING_SQL, """
ref AS (
  SELECT DISTINCT CAST(sub_category_id AS VARCHAR) || CAST(product_id AS VARCHAR) AS txt,
         sub_category_id AS SubCategoryID, product_id AS ProductID, brand_name AS BrandName
  FROM broken_listing)""")


def _upserted(old: str, new: str, out: str) -> str:
    """CTE of a null-aware upsert of ``new`` into ``old``, whose keys are unique."""
    both = [f"CASE WHEN o.CustKey IS NULL THEN n.{c} ELSE coalesce(n.{c}, o.{c}) END AS {c}" for c in ("Name", "AcctBal", "Segment", "Source")]
    return f"""
{out} AS (
  SELECT n.CustKey, {', '.join(both)}, o.NationKey FROM {new} n LEFT JOIN {old} o ON n.CustKey = o.CustKey
  UNION ALL
  SELECT CustKey, Name, AcctBal, Segment, Source, NationKey FROM {old} x
  WHERE CustKey IS NULL OR NOT EXISTS (SELECT 1 FROM {new} n WHERE n.CustKey = x.CustKey))"""


_STREAMED = with_bindings(CUSTOMER_SQL, CUSTOMER_BATCHES_SQL, """
s0 AS (
  SELECT CustKey, Name, AcctBal, Segment, CAST(NULL AS VARCHAR) AS Source, NationKey FROM (
    SELECT *, row_number() OVER (PARTITION BY CustKey ORDER BY Name DESC) AS rn FROM customer_existing) WHERE rn = 1)""",
                          _upserted("s0", "batch_1", "s1"), _upserted("s1", "batch_2", "s2"), _upserted("s2", "batch_3", "s3"))

SQL = {
    "collapse_single_category": _WC + """
SELECT GroupID, GroupName, MasterCategoryID, MasterCategoryName, CategoryID, CategoryName, SubCategoryID,
       SubCategoryName FROM h1""",
    "fill_hierarchy": _WC + "SELECT * FROM h2",
    "category_dims": _WC + """
SELECT DISTINCT 'Group' AS Dim, CAST(GroupID AS BIGINT) AS ID, CAST(NULL AS BIGINT) AS ParentID, GroupName AS Name,
       CAST(NULL AS INTEGER) AS Flag FROM h2
UNION ALL
SELECT DISTINCT 'MasterCategory', MasterCategoryID, GroupID, MasterCategoryName, CAST(NULL AS INTEGER) FROM h2
UNION ALL
SELECT DISTINCT 'Category', CategoryID, MasterCategoryID, CategoryName, isCategory FROM h2
UNION ALL
SELECT DISTINCT 'SubCategory', SubCategoryID, CategoryID, SubCategoryName, isSubCategory FROM h2""",
    "upsert_category": with_bindings(CUSTOMER_SQL) + """
, ov AS (
  SELECT CustKey, Name, NationKey, AcctBal, Segment FROM (
    SELECT *, row_number() OVER (PARTITION BY CustKey ORDER BY s_copy DESC, s_k DESC) AS rn
    FROM customer_existing WHERE CustKey IS NOT NULL) WHERE rn = 1)
SELECT n.CustKey AS CustKey,
       CASE WHEN o.CustKey IS NULL THEN n.Name ELSE coalesce(n.Name, o.Name) END AS Name,
       o.NationKey AS NationKey,
       CASE WHEN o.CustKey IS NULL THEN n.AcctBal ELSE coalesce(n.AcctBal, o.AcctBal) END AS AcctBal,
       CASE WHEN o.CustKey IS NULL THEN n.Segment ELSE coalesce(n.Segment, o.Segment) END AS Segment,
       n.Source AS Source,
       CASE WHEN o.CustKey IS NULL THEN 'insert' ELSE 'update' END AS Action
FROM customer_incoming n LEFT JOIN ov o ON n.CustKey = o.CustKey
UNION ALL
SELECT CustKey, Name, NationKey, AcctBal, Segment, NULL, 'keep' FROM ov
WHERE CustKey NOT IN (SELECT CustKey FROM customer_incoming WHERE CustKey IS NOT NULL)
UNION ALL
SELECT CustKey, Name, NationKey, AcctBal, Segment, NULL, 'keep' FROM customer_existing WHERE CustKey IS NULL""",
    "insert_distinct": with_bindings(SALES_LOADS_SQL) + """
SELECT DISTINCT * FROM (SELECT * FROM load_1 UNION ALL SELECT * FROM load_2)""",
    "reference_product": _REF + """
SELECT * FROM ref WHERE ReferenceID IS NOT NULL AND SubCategoryID IS NOT NULL AND ProductID IS NOT NULL""",
    "first_load": with_bindings(SALES_LOADS_SQL) + "SELECT * FROM load_1",
    "category_load": _LOADED + _DIMS,
    "category_quarantine": """
SELECT p_partkey * 10 + 5 AS GroupID, 'E' || CAST(p_partkey * 10 + 5 AS VARCHAR) AS GroupName, CAST(NULL AS BIGINT) AS MasterCategoryID,
       'MasterCategoryID,CategoryID,SubCategoryID' AS Error FROM part WHERE p_partkey % 50 = 0""",
    "reference_load": _BROKEN_REF + """
SELECT CAST(txt AS BIGINT) AS ReferenceID, SubCategoryID, ProductID, BrandName FROM ref WHERE TRY_CAST(txt AS BIGINT) IS NOT NULL""",
    "reference_quarantine": _BROKEN_REF + """
SELECT txt AS ReferenceID, SubCategoryID, ProductID, BrandName,
       CASE WHEN ProductID IS NULL THEN 'ReferenceID,ProductID' ELSE 'ReferenceID' END AS Error
FROM ref WHERE TRY_CAST(txt AS BIGINT) IS NULL""",
    "streaming_upsert": _STREAMED + "SELECT CustKey, Name, NationKey, AcctBal, Segment, Source FROM s3",
    "brand_filter": _REF + """
SELECT * FROM ref WHERE ReferenceID IS NOT NULL AND SubCategoryID IS NOT NULL AND ProductID IS NOT NULL
  AND BrandName IN ('Brand#1', 'Brand#2', 'Brand#3')""",
}
SQL["upsert_bucketed"] = SQL["upsert_category"]
