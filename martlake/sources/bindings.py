"""Bindings of the library's raw inputs to the driver's test tables.

The library consumes raw product snapshots, raw review rows, review text and
category rows. The test environment has TPC-H-like tables instead, so each raw
input is defined here as a deterministic projection of those tables, once as a
Spark DataFrame and once as DuckDB SQL (the independent oracle). Both
definitions must stay identical row for row.

Every raw frame carries ``_seq``: a struct that totally orders its rows. It
stands in for the row order that keep-first / keep-last rules depend on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.sources.tables import read_table

# Fixed values of the bindings (shared by the Spark and SQL definitions).
AS_OF = "2002-01-01 00:00:00"          # "now" of the run; after the last l_shipdate
AS_OF_DATE = "2002-01-01"
PRODUCT_TZ_OFFSET_HOURS = 7            # product tables: now + 7 h
FEEDBACK_TZ_OFFSET_HOURS = 0           # general feedback: now, no offset
LINE_ID_FACTOR = 1 << 31             # GeneralFeedbackID of a text = row id * factor + 4 * position + source


def _fmt_ts(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# ---------------------------------------------------------------- raw_product
def raw_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product snapshot per lineitem row; part supplies name and brand."""
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    k = F.col("l_orderkey")
    return j.select(
        F.col("l_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit("p/"), F.col("l_partkey").cast("string")).alias("product_url"),
        F.when(k % 37 != 0, F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("pricing_current"),
        F.when(k % 31 != 0, F.col("l_extendedprice")).alias("pricing_original"),
        F.concat(F.lit("img/"), F.col("l_partkey").cast("string")).alias("product_image_url"),
        F.col("l_linestatus").alias("inventory_status"),
        F.col("l_returnflag").alias("inventory_type"),
        F.when(k % 23 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.datediff(F.lit(AS_OF_DATE).cast("date"), F.to_date("l_shipdate")).cast("bigint"))
         .alias("created_date"),
        F.when(k % 29 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("l_quantity").cast("bigint")).alias("quantity_sold"),
        F.substring_index("p_brand", "#", -1).cast("bigint").alias("brand_id"),
        F.col("p_brand").alias("brand_name"),
        F.lower(F.regexp_replace("p_brand", "#", "-")).alias("brand_slug"),
        F.col("l_suppkey").alias("seller_id"),
        F.concat(F.lit("Seller "), F.col("l_suppkey").cast("string")).alias("seller_name"),
        F.concat(F.lit("s/"), F.col("l_suppkey").cast("string")).alias("seller_link"),
        F.when((F.col("l_suppkey") % 17 == 0) | (k % 5 == 0), F.lit(None).cast("string"))
         .when(F.col("l_suppkey") % 13 == 0, F.concat(F.lit("https://img.example.com/"), F.col("l_suppkey").cast("string"), F.lit(".png")))
         .otherwise(F.concat(F.lit("logo"), F.col("l_suppkey").cast("string"), F.lit(".png")))
         .alias("seller_image_url"),
        F.col("l_linenumber").cast("bigint").alias("sub_category_id"),
        F.struct(F.col("l_shipdate").alias("d"), F.col("l_orderkey").alias("o"),
                 F.col("l_linenumber").cast("bigint").alias("n"), F.col("l_suppkey").alias("s"),
                 F.col("l_partkey").alias("p")).alias("_seq"),
    )


RAW_PRODUCT_SQL = f"""
raw_product AS (
  SELECT
    l_partkey AS product_id,
    p_name AS product_name,
    'p/' || CAST(l_partkey AS VARCHAR) AS product_url,
    CASE WHEN l_orderkey % 37 <> 0 THEN l_extendedprice * (1.0 - l_discount) END AS pricing_current,
    CASE WHEN l_orderkey % 31 <> 0 THEN l_extendedprice END AS pricing_original,
    'img/' || CAST(l_partkey AS VARCHAR) AS product_image_url,
    l_linestatus AS inventory_status,
    l_returnflag AS inventory_type,
    CASE WHEN l_orderkey % 23 = 0 THEN NULL
         ELSE CAST(date_diff('day', CAST(l_shipdate AS DATE), DATE '{AS_OF_DATE}') AS BIGINT) END AS created_date,
    CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE CAST(trunc(l_quantity) AS BIGINT) END AS quantity_sold,
    CAST(split_part(p_brand, '#', 2) AS BIGINT) AS brand_id,
    p_brand AS brand_name,
    lower(replace(p_brand, '#', '-')) AS brand_slug,
    l_suppkey AS seller_id,
    'Seller ' || CAST(l_suppkey AS VARCHAR) AS seller_name,
    's/' || CAST(l_suppkey AS VARCHAR) AS seller_link,
    CASE WHEN l_suppkey % 17 = 0 OR l_orderkey % 5 = 0 THEN NULL
         WHEN l_suppkey % 13 = 0 THEN 'https://img.example.com/' || CAST(l_suppkey AS VARCHAR) || '.png'
         ELSE 'logo' || CAST(l_suppkey AS VARCHAR) || '.png' END AS seller_image_url,
    CAST(l_linenumber AS BIGINT) AS sub_category_id,
    l_shipdate AS s_d, l_orderkey AS s_o, CAST(l_linenumber AS BIGINT) AS s_n, l_suppkey AS s_s, l_partkey AS s_p
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


# --------------------------------------------------------------- raw_feedback
def raw_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review row per event; every 4th event also arrives a second time with
    a star-masked copy of its text (the crawler saw it twice)."""
    ev = read_table(spark, sf_dir, "events")
    e = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    base = ev.select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        k.alias("k"), F.lit(0).cast("bigint").alias("copy"))
    dup = (ev.filter(F.col("event_id") % 4 == 0)
             .select("event_id", "ts", "user_id", "event_type", "value", "props",
                     k.alias("k"), F.lit(1).cast("bigint").alias("copy")))
    u = base.unionByName(dup)
    content = F.when(F.col("copy") == 1, F.concat("event_type", F.lit(" **"), "props")) \
               .otherwise(F.concat("event_type", F.lit(" "), "props"))
    kk = F.col("k")
    return u.select(
        (e % 2000).alias("ProductID"),
        (kk % 3).alias("OneStarCount"),
        (kk % 5).alias("TwoStarCount"),
        (kk % 7).alias("ThreeStarCount"),
        (kk % 11).alias("FourStarCount"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("bigint")).otherwise(kk).alias("FiveStarCount"),
        F.when(F.col("event_type") == "signup", F.lit(None).cast("bigint")).otherwise(kk + 10).alias("reviews_count"),
        e.alias("review_id"),
        F.when(e % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("review_title"),
        content.alias("review_content"),
        kk.alias("review_upvote"),
        F.when(e % 97 == 0, F.lit(None).cast("bigint")).otherwise(F.lit(1) + e % 5).alias("review_rating"),
        F.when(e % 13 == 0, F.lit(None).cast("bigint")).otherwise(F.unix_timestamp("ts")).alias("review_created_at"),
        F.col("user_id"),
        F.when(e % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string"),
                             F.repeat(F.lit("x"), (e % 3).cast("int")))).alias("username"),
        F.when(e % 3 == 0, F.lit(None).cast("string")).otherwise(_fmt_ts(F.col("ts"))).alias("joined_time"),
        kk.alias("total_reviews"),
        F.floor("value").cast("bigint").alias("total_upvotes"),
        F.struct(e.alias("e"), F.col("copy").alias("c")).alias("_seq"),
    )


RAW_FEEDBACK_SQL = """
raw_feedback AS (
  WITH ev AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(0 AS BIGINT) AS copy FROM events
    UNION ALL
    SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(1 AS BIGINT) AS copy FROM events
    WHERE event_id % 4 = 0
  )
  SELECT
    event_id % 2000 AS ProductID,
    k % 3 AS OneStarCount, k % 5 AS TwoStarCount, k % 7 AS ThreeStarCount, k % 11 AS FourStarCount,
    CASE WHEN event_type = 'error' THEN NULL ELSE k END AS FiveStarCount,
    CASE WHEN event_type = 'signup' THEN NULL ELSE k + 10 END AS reviews_count,
    event_id AS review_id,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_type END AS review_title,
    CASE WHEN copy = 1 THEN event_type || ' **' || props ELSE event_type || ' ' || props END AS review_content,
    k AS review_upvote,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE 1 + event_id % 5 END AS review_rating,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) END AS review_created_at,
    user_id,
    CASE WHEN event_id % 11 = 0 THEN NULL
         ELSE 'user' || CAST(user_id AS VARCHAR) || repeat('x', CAST(event_id % 3 AS INTEGER)) END AS username,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS joined_time,
    k AS total_reviews,
    CAST(floor(value) AS BIGINT) AS total_upvotes,
    event_id AS s_e, copy AS s_c
  FROM ev
)"""


# ------------------------------------------------------------- raw_category
def raw_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened 4-level category rows (group, master, category, sub-category)
    derived from part, with ragged levels: some masters have 0, 1, 2 or 3
    categories, some rows have no sub-category."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    # ids are unique across levels (the last digit names the level)
    g = (F.col("p_partkey") % 5) * 10 + 1
    m = (F.col("p_partkey") % 500) * 10 + 2
    csize = F.col("p_size") % 4
    c = F.when(csize == 0, F.lit(None).cast("bigint")).otherwise(((F.col("p_partkey") % 500) * 10 + csize) * 10 + 3)
    s = F.when(F.col("p_partkey") % 7 == 0, F.lit(None).cast("bigint")).otherwise(F.col("p_partkey") * 10 + 4)
    return p.select(
        g.alias("GroupID"),
        F.concat(F.lit("G"), g.cast("string")).alias("GroupName"),
        m.alias("MasterCategoryID"),
        F.concat(F.lit("M"), m.cast("string")).alias("MasterCategoryName"),
        c.alias("CategoryID"),
        F.concat(F.lit("C"), c.cast("string")).alias("CategoryName"),
        s.alias("SubCategoryID"),
        F.concat(F.lit("S"), s.cast("string")).alias("SubCategoryName"),
        F.col("p_partkey").alias("_seq"),
    )


RAW_CATEGORY_SQL = """
raw_category AS (
  SELECT
    (p_partkey % 5) * 10 + 1 AS GroupID,
    'G' || CAST((p_partkey % 5) * 10 + 1 AS VARCHAR) AS GroupName,
    (p_partkey % 500) * 10 + 2 AS MasterCategoryID,
    'M' || CAST((p_partkey % 500) * 10 + 2 AS VARCHAR) AS MasterCategoryName,
    CASE WHEN p_size % 4 = 0 THEN NULL ELSE ((p_partkey % 500) * 10 + p_size % 4) * 10 + 3 END AS CategoryID,
    CASE WHEN p_size % 4 = 0 THEN NULL
         ELSE 'C' || CAST(((p_partkey % 500) * 10 + p_size % 4) * 10 + 3 AS VARCHAR) END AS CategoryName,
    CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_partkey * 10 + 4 END AS SubCategoryID,
    CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'S' || CAST(p_partkey * 10 + 4 AS VARCHAR) END AS SubCategoryName,
    p_partkey AS s_seq
  FROM part
)"""


# ------------------------------------------------------------------ raw_text
def review_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ABSA input (GeneralFeedbackID, ID, Content): every line of every document, every conversation turn and
    every page's HTML; nothing is dropped or truncated. ID is the source row's id, the last two bits of
    GeneralFeedbackID name the source.

    The tables hold no hashtags, phone numbers or opinions, so turns get some by their position: a shopper's
    words on a quality or a delivery, a hashtag, and the three spellings of a phone number."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    x = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    k = F.col("conv_id") + F.col("turn")
    said = F.concat(
        F.col("text"),
        F.when(k % 3 == 0, F.lit(" quality good, great")).when(k % 3 == 1, F.lit(" delivery bad, late")).otherwise(F.lit("")),
        F.when(k % 4 == 0, F.lit(" #thẻ")).otherwise(F.lit("")),
        F.when(k % 5 == 0, F.lit(" 0912345678")).when(k % 5 == 1, F.lit(" gọi+84912345678"))
         .when(k % 5 == 2, F.lit(" 84912345678.")).otherwise(F.lit("")))
    p = read_table(spark, sf_dir, "pages").select("page_id", "html")

    def rows(df, key: str, pos: Column, source: int, text: Column):
        gid = (F.col(key) * LINE_ID_FACTOR + pos * 4 + source).cast("bigint")
        return df.select(gid.alias("GeneralFeedbackID"), F.col(key).alias("ID"), text.alias("Content"), gid.alias("_seq"))

    return (rows(x, "doc_id", F.col("pos"), 0, F.col("line"))
            .unionByName(rows(c, "conv_id", F.col("turn"), 1, said))
            .unionByName(rows(p, "page_id", F.lit(0), 2, F.col("html"))))


REVIEW_TEXT_SQL = f"""
review_text AS (
  SELECT CAST(doc_id * {LINE_ID_FACTOR} + pos * 4 AS BIGINT) AS GeneralFeedbackID, doc_id AS ID, line AS Content
  FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
    FROM documents
  )
  UNION ALL
  SELECT CAST(conv_id * {LINE_ID_FACTOR} + turn * 4 + 1 AS BIGINT), conv_id,
         text || CASE (conv_id + turn) % 3 WHEN 0 THEN ' quality good, great' WHEN 1 THEN ' delivery bad, late' ELSE '' END
         || CASE WHEN (conv_id + turn) % 4 = 0 THEN ' #thẻ' ELSE '' END
         || CASE (conv_id + turn) % 5 WHEN 0 THEN ' 0912345678' WHEN 1 THEN ' gọi+84912345678' WHEN 2 THEN ' 84912345678.' ELSE '' END
  FROM conversations
  UNION ALL
  SELECT CAST(page_id * {LINE_ID_FACTOR} + 2 AS BIGINT), page_id, html FROM pages
)"""


def with_bindings(*ctes: str) -> str:
    """``WITH`` prefix for oracle SQL using the given binding CTEs."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# ------------------------------------------------------- load / merge inputs
def customer_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table before a load: every customer, plus a later re-written
    copy of every 10th customer (a duplicated key; the later copy wins)."""
    c = read_table(spark, sf_dir, "customer")
    base = c.select(F.col("c_custkey").alias("CustKey"), F.col("c_name").alias("Name"),
                    F.col("c_nationkey").cast("bigint").alias("NationKey"), F.col("c_acctbal").alias("AcctBal"),
                    F.col("c_mktsegment").alias("Segment"),
                    F.struct(F.lit(0).alias("copy"), F.col("c_custkey").alias("k")).alias("_seq"))
    again = c.filter(F.col("c_custkey") % 10 == 0).select(
        F.col("c_custkey").alias("CustKey"), F.concat(F.col("c_name"), F.lit(" (v2)")).alias("Name"),
        F.col("c_nationkey").cast("bigint").alias("NationKey"), F.col("c_acctbal").alias("AcctBal"),
        F.col("c_mktsegment").alias("Segment"),
        F.struct(F.lit(1).alias("copy"), F.col("c_custkey").alias("k")).alias("_seq"))
    return base.unionByName(again)


def customer_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load: every customer re-keyed to 2 x key (half the keys update stored
    rows, half are new), balance missing for every 3rd row (old value kept),
    every 11th key missing (never matches), every 7th row sent twice."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    key = F.when(k % 11 == 0, F.lit(None).cast("bigint")).otherwise(k * 2)
    one = c.select(key.alias("CustKey"), F.upper("c_name").alias("Name"),
                   F.when(k % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal") + 1.0).alias("AcctBal"),
                   F.col("c_mktsegment").alias("Segment"), F.lit("load-2").alias("Source"))
    two = c.filter(k % 7 == 0).select(key.alias("CustKey"), F.lower("c_name").alias("Name"),
                                      (F.col("c_acctbal") + 2.0).alias("AcctBal"), F.lit(None).cast("string").alias("Segment"),
                                      F.lit("load-2b").alias("Source"))
    return one.unionByName(two)


CUSTOMER_SQL = """
customer_existing AS (
  SELECT c_custkey AS CustKey, c_name AS Name, CAST(c_nationkey AS BIGINT) AS NationKey, c_acctbal AS AcctBal,
         c_mktsegment AS Segment, 0 AS s_copy, c_custkey AS s_k FROM customer
  UNION ALL
  SELECT c_custkey, c_name || ' (v2)', CAST(c_nationkey AS BIGINT), c_acctbal, c_mktsegment, 1, c_custkey
  FROM customer WHERE c_custkey % 10 = 0),
customer_incoming AS (
  SELECT CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey * 2 END AS CustKey, upper(c_name) AS Name,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal + 1.0 END AS AcctBal, c_mktsegment AS Segment,
         'load-2' AS Source FROM customer
  UNION ALL
  SELECT CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey * 2 END, lower(c_name), c_acctbal + 2.0,
         NULL, 'load-2b' FROM customer WHERE c_custkey % 7 = 0)"""


def sales_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two loads of (order, part, supplier, quantity) rows: the second repeats
    the rows with even line numbers exactly and changes the others."""
    li = read_table(spark, sf_dir, "lineitem")
    first = li.select(F.col("l_orderkey").alias("OrderKey"), F.col("l_partkey").alias("PartKey"),
                      F.col("l_suppkey").alias("SuppKey"), F.col("l_quantity").alias("Quantity"))
    second = li.select(F.col("l_orderkey").alias("OrderKey"), F.col("l_partkey").alias("PartKey"),
                       F.col("l_suppkey").alias("SuppKey"),
                       (F.col("l_quantity") + (F.col("l_linenumber") % 2).cast("double")).alias("Quantity"))
    return first, second


SALES_LOADS_SQL = """
load_1 AS (SELECT l_orderkey AS OrderKey, l_partkey AS PartKey, l_suppkey AS SuppKey, l_quantity AS Quantity
           FROM lineitem),
load_2 AS (SELECT l_orderkey AS OrderKey, l_partkey AS PartKey, l_suppkey AS SuppKey,
                  l_quantity + CAST(l_linenumber % 2 AS DOUBLE) AS Quantity FROM lineitem)"""


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows (sub_category_id, product_id, brand_name): one per lineitem."""
    li = read_table(spark, sf_dir, "lineitem").select("l_linenumber", "l_partkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    return j.select(F.col("l_linenumber").cast("bigint").alias("sub_category_id"),
                    F.col("l_partkey").alias("product_id"), F.col("p_brand").alias("brand_name"))


LISTING_SQL = """
listing AS (SELECT CAST(l_linenumber AS BIGINT) AS sub_category_id, l_partkey AS product_id, p_brand AS brand_name
            FROM lineitem JOIN part ON l_partkey = p_partkey)"""


# ------------------------------------------------------------ landing JSON
PAGE_SIZE = 20


def _paged(df: DataFrame, parent: str, seq: Column, page_size: int = PAGE_SIZE) -> DataFrame:
    """Assign rows of each parent to ceil(n / page_size) pages by a hash of the
    row's own order key, so every page holds about ``page_size`` rows even for
    a parent holding a third of the data."""
    n = df.groupBy(parent).agg(F.count(F.lit(1)).alias("_n"))
    j = df.join(n, parent, "inner")
    pages = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(page_size))).cast("bigint")
    return j.withColumn("_pages", pages).withColumn("page", F.pmod(F.xxhash64(seq), F.col("_pages")) + 1)


def category_landing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(menu, responses) as the crawler lands them: one menu document listing
    every group, and per parent id (group, master, category) response pages
    listing its children; a parent without children gets one empty page."""
    rc = raw_category(spark, sf_dir)
    groups = rc.select("GroupID", "GroupName").distinct()
    menu = groups.select(F.struct(F.concat(F.lit("/danh-muc/c"), F.col("GroupID").cast("string")).alias("link"),
                                  F.col("GroupName").alias("text")).alias("item")) \
                 .agg(F.collect_list("item").alias("items")) \
                 .select(F.to_json(F.struct(F.struct("items").alias("menu_block"))).alias("json"))
    edges = (rc.select(F.col("GroupID").alias("parent_id"), F.col("MasterCategoryID").alias("id"),
                       F.col("MasterCategoryName").alias("name"))
               .unionByName(rc.select(F.col("MasterCategoryID").alias("parent_id"), F.col("CategoryID").alias("id"),
                                      F.col("CategoryName").alias("name")))
               .unionByName(rc.filter(F.col("CategoryID").isNotNull())
                              .select(F.col("CategoryID").alias("parent_id"), F.col("SubCategoryID").alias("id"),
                                      F.col("SubCategoryName").alias("name"))))
    edges = edges.filter(F.col("parent_id").isNotNull()).distinct()
    child = edges.filter(F.col("id").isNotNull())
    paged = _paged(child, "parent_id", F.struct("id", "name"))
    full = (paged.groupBy("parent_id", "page")
                 .agg(F.sort_array(F.collect_list(F.struct("id", "name"))).alias("data")))
    empty = (edges.groupBy("parent_id").agg(F.count("id").alias("k")).filter(F.col("k") == 0)
                  .select("parent_id", F.lit(1).cast("bigint").alias("page"),
                          F.array().cast("array<struct<id:bigint,name:string>>").alias("data")))
    pages = full.unionByName(empty).select("parent_id", "page", F.to_json(F.struct("data")).alias("json"))
    return menu, pages


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing response pages (category_id, page, json) from the product rows."""
    rp = raw_product(spark, sf_dir).select(F.col("sub_category_id").alias("category_id"),
                                           F.col("product_id").alias("id"), "brand_name", "_seq")
    paged = _paged(rp, "category_id", F.col("_seq"))
    g = paged.groupBy("category_id", "page", "_pages").agg(F.collect_list(F.struct("id", "brand_name")).alias("data"))
    body = F.struct(F.struct(F.col("_pages").cast("int").alias("last_page")).alias("paging"), "data")
    return g.select("category_id", "page", F.to_json(body).alias("json"))


def product_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product response per snapshot, with the listing context
    (sub_category_id, brand_name) next to it."""
    r = raw_product(spark, sf_dir)
    seller = F.when(F.col("seller_id") != 0, F.struct(
        F.col("seller_id").alias("id"), F.col("seller_name").alias("name"),
        F.col("seller_link").alias("link"), F.col("seller_image_url").alias("logo")))
    crumbs = F.when(F.col("product_id") % 3 == 0, F.array(F.struct(F.lit(1).cast("bigint").alias("category_id")))) \
              .otherwise(F.array(F.struct(F.lit(1).cast("bigint").alias("category_id")),
                                 F.struct(F.col("sub_category_id").alias("category_id")),
                                 F.struct(F.col("product_id").alias("category_id"))))
    body = F.struct(
        F.col("product_id").alias("id"), F.col("product_name").alias("name"), F.col("product_url").alias("short_url"),
        F.col("pricing_current").alias("price"), F.col("pricing_original").alias("original_price"),
        F.col("product_image_url").alias("thumbnail_url"), "inventory_status", "inventory_type",
        F.col("created_date").alias("day_ago_created"), F.col("quantity_sold").alias("all_time_quantity_sold"),
        F.struct(F.col("brand_id").alias("id"), F.col("brand_name").alias("name"),
                 F.col("brand_slug").alias("slug")).alias("brand"),
        seller.alias("current_seller"),
        F.struct((F.col("product_id") % 100 + 1000).alias("id"),
                 (F.col("sub_category_id") % 2 == 0).alias("is_leaf")).alias("categories"),
        crumbs.alias("breadcrumbs"))
    return r.select("sub_category_id", "brand_name", F.to_json(body).alias("json"))


def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review response pages (product_id, page, json): product-level star counts
    (stars without reviews omitted) and review count on every page; a review
    whose author is user 0 has no author object."""
    rf = raw_feedback(spark, sf_dir)
    stats = rf.groupBy("ProductID").agg(
        *[F.count_if(F.col("review_rating") == i).alias(f"s{i}") for i in range(1, 6)],
        F.count(F.lit(1)).alias("n"))
    stars = F.map_filter(F.create_map(*[x for i in range(1, 6) for x in
                                        (F.lit(str(i)), F.struct(F.col(f"s{i}").cast("bigint").alias("count")))]),
                         lambda k, v: v["count"] > 0)
    author = F.when(F.col("user_id") != 0, F.struct(
        F.col("user_id").alias("id"), F.col("username").alias("name"), F.col("joined_time").alias("created_time"),
        F.struct(F.struct(F.col("total_reviews").alias("total_review"),
                          F.col("total_upvotes").alias("total_thank")).alias("summary")).alias("contribute_info")))
    review = F.struct(F.col("review_id").alias("id"), F.col("review_title").alias("title"),
                      F.col("review_content").alias("content"), F.col("review_upvote").alias("thank_count"),
                      F.col("review_rating").alias("rating"), F.col("review_created_at").alias("created_at"),
                      author.alias("created_by"))
    paged = _paged(rf.select("ProductID", review.alias("r"), "_seq"), "ProductID", F.col("_seq"))
    g = paged.groupBy("ProductID", "page", "_pages").agg(F.collect_list("r").alias("data"))
    g = g.join(stats, "ProductID", "inner")
    body = F.struct(F.struct(F.col("_pages").cast("int").alias("last_page")).alias("paging"),
                    stars.alias("stars"), F.col("n").cast("bigint").alias("reviews_count"), "data")
    return g.select(F.col("ProductID").alias("product_id"), "page", F.to_json(body).alias("json"))


# ------------------------------------------------------- rows that casts reject
def broken_category_landing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """:func:`category_landing` as a bad day leaves it: for every 50th part, one more group whose page lists nothing
    (its row has no master, so the id casts reject it)."""
    menu, pages = category_landing(spark, sf_dir)
    p = read_table(spark, sf_dir, "part").filter("p_partkey % 50 = 0")
    gid = F.col("p_partkey") * 10 + 5
    item = F.struct(F.concat(F.lit("/danh-muc/c"), gid.cast("string")).alias("link"), F.concat(F.lit("E"), gid.cast("string")).alias("text"))
    more = p.agg(F.collect_list(item).alias("items")).select(F.to_json(F.struct(F.struct("items").alias("menu_block"))).alias("json"))
    none = p.select(gid.cast("bigint").alias("parent_id"), F.lit(1).cast("bigint").alias("page"), F.lit('{"data":[]}').alias("json"))
    return menu.unionByName(more), pages.unionByName(none)


def broken_listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`listing_pages` and, for every 40th part, a page of a category whose id is so long that the
    reference id overflows, and one item without an id."""
    good = listing_pages(spark, sf_dir)
    p = read_table(spark, sf_dir, "part").filter("p_partkey % 40 = 0")
    items = F.array(F.struct(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand_name")),
                    F.struct(F.lit(None).cast("bigint").alias("id"), F.col("p_brand").alias("brand_name")))
    body = F.struct(F.struct(F.lit(1).alias("last_page")).alias("paging"), items.alias("data"))
    bad = p.select((F.lit(9000000000000000000) + F.col("p_partkey")).alias("category_id"), F.lit(1).cast("bigint").alias("page"),
                   F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))
    return good.unionByName(bad)


BROKEN_LISTING_SQL = """
broken_listing AS (
  SELECT * FROM listing
  UNION ALL SELECT 9000000000000000000 + p_partkey, p_partkey, p_brand FROM part WHERE p_partkey % 40 = 0
  UNION ALL SELECT 9000000000000000000 + p_partkey, NULL, p_brand FROM part WHERE p_partkey % 40 = 0)"""


# ------------------------------------------------------------- staged upserts
def customer_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three loads of the customer table, to be merged in this order: updates and inserts of half the keys, of the other
    half, and a last one that changes keys of both, some twice. Every 11th key is missing, and balances are."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    key = F.when(k % 11 == 0, F.lit(None).cast("bigint")).otherwise(k * 2)

    def load(rows: Column, name: Column, balance: Column, segment: Column, source: str) -> DataFrame:
        return c.filter(rows).select(key.alias("CustKey"), name.alias("Name"), balance.cast("double").alias("AcctBal"),
                                     segment.cast("string").alias("Segment"), F.lit(source).alias("Source"))

    seen = F.col("c_mktsegment")
    missing = F.when(k % 3 != 0, F.col("c_acctbal") + 1.0)
    last = load(k % 5 == 0, F.lower("c_name"), F.lit(None), F.when(k % 2 == 0, F.lit("LAST")), "load-3")
    twice = load(k % 35 == 0, F.concat("c_name", F.lit(" again")), F.col("c_acctbal") + 2.0, F.lit(None), "load-3b")
    return [load(k % 2 == 0, F.upper("c_name"), missing, seen, "load-1"), load(k % 2 == 1, F.upper("c_name"), missing, seen, "load-2"),
            last.unionByName(twice)]


_KEY = "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey * 2 END AS CustKey"
_MISSING = "CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal + 1.0 END AS AcctBal"
CUSTOMER_BATCHES_SQL = f"""
batch_1 AS (SELECT {_KEY}, upper(c_name) AS Name, {_MISSING}, c_mktsegment AS Segment, 'load-1' AS Source
            FROM customer WHERE c_custkey % 2 = 0),
batch_2 AS (SELECT {_KEY}, upper(c_name) AS Name, {_MISSING}, c_mktsegment AS Segment, 'load-2' AS Source
            FROM customer WHERE c_custkey % 2 = 1),
batch_3 AS (SELECT {_KEY}, lower(c_name) AS Name, CAST(NULL AS DOUBLE) AS AcctBal,
                   CASE WHEN c_custkey % 2 = 0 THEN 'LAST' END AS Segment, 'load-3' AS Source FROM customer WHERE c_custkey % 5 = 0
            UNION ALL
            SELECT {_KEY}, c_name || ' again', c_acctbal + 2.0, NULL, 'load-3b' FROM customer WHERE c_custkey % 35 = 0)"""
