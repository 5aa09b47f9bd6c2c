"""Oracle SQL for the landing sources: flattening a document built from a
binding must give back the binding's rows (plus the source's defaults)."""

from martlake.sources.bindings import RAW_CATEGORY_SQL, RAW_FEEDBACK_SQL, RAW_PRODUCT_SQL, with_bindings

SQL = {
    "flatten_category_tree": with_bindings(RAW_CATEGORY_SQL) + """
, g AS (SELECT DISTINCT GroupID, GroupName FROM raw_category WHERE GroupID IN (11, 21, 31, 41)),
m AS (SELECT DISTINCT GroupID, MasterCategoryID, MasterCategoryName FROM raw_category),
c AS (SELECT DISTINCT MasterCategoryID, CategoryID, CategoryName FROM raw_category WHERE CategoryID IS NOT NULL),
s AS (SELECT DISTINCT CategoryID, SubCategoryID, SubCategoryName FROM raw_category
      WHERE CategoryID IS NOT NULL AND SubCategoryID IS NOT NULL)
SELECT g.GroupID, g.GroupName, m.MasterCategoryID, m.MasterCategoryName, c.CategoryID, c.CategoryName,
       s.SubCategoryID, s.SubCategoryName
FROM g JOIN m ON g.GroupID = m.GroupID
LEFT JOIN c ON m.MasterCategoryID = c.MasterCategoryID
LEFT JOIN s ON c.CategoryID = s.CategoryID""",
    "flatten_listing": with_bindings(RAW_PRODUCT_SQL) + """
SELECT sub_category_id, product_id, brand_name FROM raw_product""",
    "flatten_product": with_bindings(RAW_PRODUCT_SQL) + """
SELECT product_id, product_name, product_url, pricing_current, pricing_original, product_image_url,
       inventory_status, inventory_type, created_date, quantity_sold, brand_id, brand_name, brand_slug,
       CASE WHEN seller_id = 0 THEN 0 ELSE seller_id END AS seller_id,
       CASE WHEN seller_id = 0 THEN '0' ELSE coalesce(seller_name, '0') END AS seller_name,
       CASE WHEN seller_id = 0 THEN '0' ELSE coalesce(seller_link, '0') END AS seller_link,
       CASE WHEN seller_id = 0 THEN '0' ELSE coalesce(seller_image_url, '0') END AS seller_image_url,
       CASE WHEN sub_category_id % 2 = 0 THEN product_id % 100 + 1000
            WHEN product_id % 3 <> 0 THEN sub_category_id END AS category_id,
       sub_category_id
FROM raw_product""",
    "leaf_category": with_bindings(RAW_PRODUCT_SQL) + """
SELECT product_id, CASE WHEN sub_category_id % 2 = 0 THEN product_id % 100 + 1000
                        WHEN product_id % 3 <> 0 THEN sub_category_id END AS category_id
FROM raw_product""",
    "flatten_reviews": with_bindings(RAW_FEEDBACK_SQL) + """
, st AS (
  SELECT ProductID, count(*) FILTER (WHERE review_rating = 1) AS s1, count(*) FILTER (WHERE review_rating = 2) AS s2,
         count(*) FILTER (WHERE review_rating = 3) AS s3, count(*) FILTER (WHERE review_rating = 4) AS s4,
         count(*) FILTER (WHERE review_rating = 5) AS s5, count(*) AS n
  FROM raw_feedback GROUP BY ProductID)
SELECT r.ProductID, st.s1 AS OneStarCount, st.s2 AS TwoStarCount, st.s3 AS ThreeStarCount,
       st.s4 AS FourStarCount, st.s5 AS FiveStarCount, st.n AS reviews_count, review_id, review_title,
       review_content, review_upvote, review_rating, review_created_at,
       CASE WHEN user_id = 0 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN user_id = 0 THEN NULL ELSE username END AS username,
       CASE WHEN user_id = 0 THEN NULL ELSE joined_time END AS joined_time,
       CASE WHEN user_id = 0 THEN 0 ELSE coalesce(total_reviews, 0) END AS total_reviews,
       CASE WHEN user_id = 0 THEN 0 ELSE coalesce(total_upvotes, 0) END AS total_upvotes
FROM raw_feedback r JOIN st ON r.ProductID = st.ProductID""",
    "csv_roundtrip": "SELECT doc_id, lang, text FROM documents",
}
