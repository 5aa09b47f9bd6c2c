"""Oracle SQL for the product flow."""

from martlake.sources.bindings import RAW_PRODUCT_SQL, with_bindings

REF = "TIMESTAMP '2002-01-01 07:00:00'"  # AS_OF + 7 h

_DATED = f"""
p AS (
  SELECT coalesce(product_id, 0) AS ProductID, coalesce(brand_id, 0) AS BrandID,
         coalesce(seller_id, 0) AS SellerID, coalesce(sub_category_id, 0) AS SubCategoryID,
         product_name AS Name, product_url AS URL, product_image_url AS ImageURL,
         CAST(created_date AS DOUBLE) AS CreatedDate, coalesce(quantity_sold, 0) AS QuantitySold,
         row_number() OVER (ORDER BY s_d, s_o, s_n, s_s, s_p) AS sq,
         inventory_status, inventory_type, pricing_current, pricing_original,
         brand_id, brand_name, brand_slug, seller_id, seller_name, seller_link, seller_image_url
  FROM raw_product),
pm AS (SELECT *, max(CreatedDate) OVER (PARTITION BY ProductID) AS mx FROM p),
pd AS (
  SELECT *,
    {REF} - to_microseconds(CAST(round((mx - CreatedDate) * 86400000000) AS BIGINT)) AS LastUpdated,
    CASE WHEN CreatedDate IS NULL THEN NULL
         ELSE {REF} - to_microseconds(CAST(round(mx * 86400000000) AS BIGINT)) END AS CreatedAt
  FROM pm),
clean AS (
  SELECT ProductID, BrandID, SellerID, SubCategoryID, Name, URL, ImageURL, CreatedDate, QuantitySold,
         LastUpdated, CreatedAt, min(sq) AS sq
  FROM pd
  GROUP BY ALL
  HAVING SellerID <> 0),
daily AS (
  SELECT ProductID, Day, QuantitySold FROM (
    SELECT ProductID, CAST(LastUpdated AS DATE) AS Day, QuantitySold,
           row_number() OVER (PARTITION BY ProductID, CAST(LastUpdated AS DATE) ORDER BY LastUpdated DESC, sq DESC) AS rn
    FROM clean WHERE LastUpdated IS NOT NULL) WHERE rn = 1),
fluct AS (
  SELECT ProductID, Day, QuantitySold,
         greatest(coalesce(QuantitySold - lag(QuantitySold) OVER (PARTITION BY ProductID ORDER BY Day), QuantitySold), 0)
           AS QuantityFluctuation
  FROM daily)
"""

_W = with_bindings(RAW_PRODUCT_SQL, _DATED)
TS = "'%Y-%m-%d %H:%M:%S'"

SQL = {
    "last_updated": _W + f"""
SELECT ProductID, SellerID, CreatedDate, strftime(LastUpdated, {TS}) AS LastUpdated FROM pd""",
    "created_at": _W + f"""
SELECT ProductID, SellerID, CreatedDate, strftime(CreatedAt, {TS}) AS CreatedAt FROM pd""",
    "product_clean": _W + f"""
SELECT ProductID, BrandID, SellerID, SubCategoryID, Name, URL, ImageURL, QuantitySold,
       strftime(LastUpdated, {TS}) AS LastUpdated, strftime(CreatedAt, {TS}) AS CreatedAt
FROM clean""",
    "daily_last_quantity": _W + """
SELECT ProductID, strftime(Day, '%Y-%m-%d') AS Day, QuantitySold FROM daily""",
    "quantity_fluctuation": _W + """
SELECT ProductID, strftime(Day, '%Y-%m-%d') AS Day, QuantitySold, QuantityFluctuation FROM fluct""",
    "product_sale": _W + """
SELECT c.ProductID, c.QuantitySold, coalesce(f.QuantityFluctuation, 0) AS QuantityFluctuation,
       strftime(c.LastUpdated, '%Y-%m-%d') AS LastUpdated
FROM clean c LEFT JOIN fluct f ON c.ProductID = f.ProductID AND CAST(c.LastUpdated AS DATE) = f.Day""",
    "product_dim": _W + f"""
SELECT ProductID, BrandID, SellerID, SubCategoryID, Name, URL, ImageURL, strftime(CreatedAt, {TS}) AS CreatedAt
FROM (SELECT *, row_number() OVER (PARTITION BY ProductID ORDER BY CreatedDate DESC NULLS LAST, sq) AS rn FROM clean)
WHERE rn = 1 AND CreatedAt IS NOT NULL""",
    "inventory_snapshot": _W + """
SELECT sq AS InventoryID, ProductID, inventory_status AS Status, inventory_type AS Type,
       '2002-01-01 07:00:00' AS LastUpdated
FROM p""",
    "pricing_snapshot": _W + """
SELECT sq AS PricingID, ProductID, coalesce(pricing_current, 0.0) AS CurrentPrice,
       coalesce(pricing_original, 0.0) AS OriginalPrice, '2002-01-01 07:00:00' AS LastUpdated
FROM p""",
    "brand_dim": _W + """
SELECT BrandID, Name, Slug FROM (
  SELECT brand_id AS BrandID, brand_name AS Name, brand_slug AS Slug,
         row_number() OVER (PARTITION BY brand_id ORDER BY sq) AS rn FROM p) WHERE rn = 1""",
    "seller_dim": _W + """
, s AS (
  SELECT coalesce(seller_id, 0) AS SellerID, seller_name AS Name, seller_link AS Link,
         CASE WHEN coalesce(seller_image_url, 'nan') LIKE 'http%' THEN coalesce(seller_image_url, 'nan')
              ELSE 'https://cdn.example.com/ts/seller/' || coalesce(seller_image_url, 'nan') END AS ImageURL, sq
  FROM p),
s2 AS (SELECT *, count(*) OVER (PARTITION BY SellerID) AS n FROM s),
s3 AS (SELECT * FROM s2 WHERE NOT (n > 1 AND contains(ImageURL, 'nan')))
SELECT SellerID, Name, Link, ImageURL FROM (
  SELECT *, row_number() OVER (PARTITION BY SellerID ORDER BY sq) AS rn FROM s3) WHERE rn = 1""",
    "distinct_rows": _W + f"""
, d AS (
  SELECT ProductID, BrandID, SellerID, SubCategoryID, Name, URL, ImageURL, min(sq) AS sq
  FROM p GROUP BY ALL)
SELECT d.ProductID, d.BrandID, d.SellerID, d.SubCategoryID, d.Name, d.URL, d.ImageURL,
       strftime(r.s_d, {TS}) AS FirstShipDate, r.s_o AS FirstOrderKey
FROM d JOIN (SELECT s_d, s_o, row_number() OVER (ORDER BY s_d, s_o, s_n, s_s, s_p) AS sq FROM raw_product) r
  ON d.sq = r.sq""",
    "dense_id": _W + """
SELECT row_number() OVER (ORDER BY s_d, s_o, s_n, s_s, s_p) AS RowID, product_id AS ProductID,
       seller_id AS SellerID, s_o AS OrderKey, s_n AS LineNumber
FROM raw_product""",
}
