"""Oracle SQL for the metrics, quality report, marts and the incremental load."""

from martlake.oracle.feedback import _BASE as _FB_BASE
from martlake.oracle.feedback import SQL as _FB
from martlake.oracle.product import _DATED
from martlake.oracle.product import SQL as _PRODUCT
from martlake.sources.bindings import RAW_FEEDBACK_SQL, RAW_PRODUCT_SQL, with_bindings

_P = with_bindings(RAW_PRODUCT_SQL, _DATED)
_PF = with_bindings(RAW_PRODUCT_SQL, RAW_FEEDBACK_SQL, _DATED, _FB_BASE)

_SELLER = """
s AS (
  SELECT coalesce(seller_id, 0) AS SellerID,
         CASE WHEN coalesce(seller_image_url, 'nan') LIKE 'http%' THEN coalesce(seller_image_url, 'nan')
              ELSE 'https://cdn.example.com/ts/seller/' || coalesce(seller_image_url, 'nan') END AS ImageURL
  FROM p),
s2 AS (SELECT *, count(*) OVER (PARTITION BY SellerID) AS n FROM s)
"""

_DETAIL = """
detail AS (
  SELECT ProductID, Upvote, Rating FROM (
    SELECT *, row_number() OVER (PARTITION BY GeneralFeedbackID ORDER BY ProductID, UserID, CreatedDate) AS rn
    FROM a6) WHERE rn = 1)
"""


def _quality(table: str, key: list[str], casts: dict[str, str]) -> str:
    """Long-format quality rows for one table (written as plain SQL)."""
    null_key = " OR ".join(f"{k} IS NULL" for k in key)
    bad = "".join(f", count_if(TRY_CAST({c} AS {t}) IS NULL) AS bad_{c}" for c, t in casts.items())
    keys = ", ".join(key)
    metrics = ["rows", "null_key_rows", "dup_key_rows"] + [f"bad_{c}" for c in casts]
    per_key = f"""(SELECT {keys}, count(*) AS n, max(CAST(({null_key}) AS INT)) AS nk{bad}
                  FROM {table} GROUP BY {keys})"""
    sums = ", ".join([
        "CAST(coalesce(sum(n), 0) AS BIGINT) AS \"rows\"",
        "CAST(coalesce(sum(CASE WHEN nk = 1 THEN n END), 0) AS BIGINT) AS null_key_rows",
        "CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS dup_key_rows",
    ] + [f"CAST(coalesce(sum(bad_{c}), 0) AS BIGINT) AS bad_{c}" for c in casts])
    agg = f"(SELECT {sums} FROM {per_key})"
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS \"table\", '{m}' AS metric, \"{m}\" AS value FROM {agg}" for m in metrics)


_DAILY_PRICE = """
dp AS (
  SELECT ProductID, Day, CurrentPrice, OriginalPrice FROM (
    SELECT product_id AS ProductID, CAST(s_d AS DATE) AS Day, pricing_current AS CurrentPrice,
           pricing_original AS OriginalPrice,
           row_number() OVER (PARTITION BY product_id, CAST(s_d AS DATE) ORDER BY s_d DESC, s_o DESC, s_n DESC,
                                                                          s_s DESC, s_p DESC) AS rn
    FROM raw_product WHERE s_d IS NOT NULL) WHERE rn = 1)
"""

SQL = {
    "run_metrics": _P + ", " + _SELLER + """
SELECT 'extracted' AS stage, CAST(count(*) AS BIGINT) AS "rows" FROM raw_product
UNION ALL SELECT 'transformed', count(*) FROM clean
UNION ALL SELECT 'daily', count(*) FROM daily
UNION ALL SELECT 'product_sale', count(*) FROM clean
UNION ALL SELECT 'inventory', count(*) FROM raw_product
UNION ALL SELECT 'pricing', count(*) FROM raw_product
UNION ALL SELECT 'brand', count(DISTINCT brand_id) FROM raw_product
UNION ALL SELECT 'product', count(*) FROM (
  SELECT *, row_number() OVER (PARTITION BY ProductID ORDER BY CreatedDate DESC NULLS LAST, sq) AS rn FROM clean)
  WHERE rn = 1 AND CreatedAt IS NOT NULL
UNION ALL SELECT 'seller', count(DISTINCT SellerID) FROM s2 WHERE NOT (n > 1 AND contains(ImageURL, 'nan'))""",
    "dq_report": with_bindings(RAW_PRODUCT_SQL, RAW_FEEDBACK_SQL) + "\n"
    + _quality("raw_feedback", ["review_id"],
               {"review_rating": "BIGINT", "review_created_at": "BIGINT", "joined_time": "TIMESTAMP"})
    + "\nUNION ALL\n"
    + _quality("raw_product", ["product_id", "seller_id"],
               {"created_date": "BIGINT", "quantity_sold": "BIGINT", "seller_image_url": "VARCHAR"}),
    "review_summary": _PF + ", " + _DETAIL + """
SELECT ProductID, CAST(count(*) AS BIGINT) AS Reviews, round(avg(Rating), 4) AS AvgRating,
       round(count_if(Rating = 5) / count(*), 4) AS FiveStarShare, CAST(sum(Upvote) AS BIGINT) AS Upvotes
FROM detail GROUP BY ProductID""",
    "price_change": with_bindings(RAW_PRODUCT_SQL, _DAILY_PRICE) + """
SELECT ProductID, strftime(Day, '%Y-%m-%d') AS Day, CurrentPrice, prev AS PreviousPrice,
       CurrentPrice - prev AS Change,
       CASE WHEN OriginalPrice > 0 THEN 1.0 - CurrentPrice / OriginalPrice END AS Discount
FROM (SELECT *, lag(CurrentPrice) OVER (PARTITION BY ProductID ORDER BY Day) AS prev FROM dp)""",
    "kpi_direction": _P + """
, k AS (SELECT *, lag(QuantitySold) OVER (PARTITION BY ProductID ORDER BY Day) AS prev,
               min(QuantitySold) OVER (PARTITION BY Day) AS lo, max(QuantitySold) OVER (PARTITION BY Day) AS hi
        FROM daily)
SELECT ProductID, strftime(Day, '%Y-%m-%d') AS Day, QuantitySold,
       CASE WHEN prev IS NULL THEN 'new' WHEN QuantitySold > prev THEN 'up'
            WHEN QuantitySold < prev THEN 'down' ELSE 'flat' END AS Direction,
       CAST(1 + floor(5.0 * CAST(QuantitySold - lo AS DOUBLE) / CAST(hi - lo + 1 AS DOUBLE)) AS INT) AS Heat
FROM k""",
    "kpi_heat": _P + """
SELECT ProductID, strftime(Day, '%Y-%m-%d') AS Day, QuantitySold,
       CAST(ntile(5) OVER (PARTITION BY Day ORDER BY QuantitySold, ProductID) AS INT) AS Heat FROM daily""",
    "ordered_sale": _PRODUCT["product_sale"],
    "incremental_bucketed": _FB["general_feedback"],
    # Every landing file merged once (append-distinct) = the distinct general-feedback rows.
    "incremental_upsert": _FB["general_feedback"],
}
