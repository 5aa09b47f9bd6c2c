"""Landing JSON sources: explicit schemas and flatteners.

The crawler lands one JSON document per API response. Each landing row carries
the request context (which parent/category/product/page was asked for) next to
the response body. Flattening is ``from_json`` with an explicit schema plus
``explode`` / struct paths: never schema inference, never Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType,
)

# ------------------------------------------------------------------ schemas
ID_NAME = StructType([StructField("id", LongType()), StructField("name", StringType())])
MENU = StructType([StructField("menu_block", StructType([
    StructField("items", ArrayType(StructType([StructField("link", StringType()),
                                               StructField("text", StringType())])))]))])
CATEGORY_PAGE = StructType([StructField("data", ArrayType(ID_NAME))])
LISTING_PAGE = StructType([
    StructField("paging", StructType([StructField("last_page", IntegerType())])),
    StructField("data", ArrayType(StructType([StructField("id", LongType()),
                                              StructField("brand_name", StringType())]))),
])
PRODUCT = StructType([
    StructField("id", LongType()), StructField("name", StringType()), StructField("short_url", StringType()),
    StructField("price", DoubleType()), StructField("original_price", DoubleType()),
    StructField("thumbnail_url", StringType()), StructField("inventory_status", StringType()),
    StructField("inventory_type", StringType()), StructField("day_ago_created", LongType()),
    StructField("all_time_quantity_sold", LongType()),
    StructField("brand", StructType([StructField("id", LongType()), StructField("name", StringType()),
                                     StructField("slug", StringType())])),
    StructField("current_seller", StructType([StructField("id", LongType()), StructField("name", StringType()),
                                              StructField("link", StringType()), StructField("logo", StringType())])),
    StructField("categories", StructType([StructField("id", LongType()), StructField("is_leaf", BooleanType())])),
    StructField("breadcrumbs", ArrayType(StructType([StructField("category_id", LongType())]))),
])
REVIEWER = StructType([
    StructField("id", LongType()), StructField("name", StringType()), StructField("created_time", StringType()),
    StructField("contribute_info", StructType([StructField("summary", StructType([
        StructField("total_review", LongType()), StructField("total_thank", LongType())]))])),
])
REVIEW_PAGE = StructType([
    StructField("paging", StructType([StructField("last_page", IntegerType())])),
    StructField("stars", MapType(StringType(), StructType([StructField("count", LongType())]))),
    StructField("reviews_count", LongType()),
    StructField("data", ArrayType(StructType([
        StructField("id", LongType()), StructField("title", StringType()), StructField("content", StringType()),
        StructField("thank_count", LongType()), StructField("rating", LongType()),
        StructField("created_at", LongType()), StructField("created_by", REVIEWER),
    ]))),
])


def parse(df: DataFrame, body_col: str, schema: StructType, alias: str = "body") -> DataFrame:
    """Parse the JSON text column with an explicit schema."""
    return df.withColumn(alias, F.from_json(F.col(body_col), schema))


def read_landing(spark, path: str, schema: StructType) -> DataFrame:
    """Read newline-delimited landing JSON with an explicit schema."""
    return spark.read.schema(schema).json(path)


# ------------------------------------------------------------- category tree
def group_id_from_link(link) -> Column:
    """Last path segment of the link without its first character."""
    link = F.col(link) if isinstance(link, str) else link
    return F.substring(F.element_at(F.split(link, "/"), -1), 2, 1 << 30)


def flatten_category_tree(menu: DataFrame, pages: DataFrame, groups: Sequence[str] | DataFrame) -> DataFrame:
    """Menu + category responses -> one row per (group, master, category, sub).

    ``menu``: rows with ``body`` (MENU). ``pages``: rows (parent_id, body
    CATEGORY_PAGE), several pages per parent allowed. Groups are kept when their
    id is in ``groups`` (ids, or a table whose first column holds them). A parent whose response lists no children yields one
    row with the lower levels null; a parent with no response at all (the
    request failed) yields nothing. Three joins against the response table,
    which is as large as the category tree, not the data."""
    g = (menu.select(F.explode("body.menu_block.items").alias("it"))
             .select(group_id_from_link("it.link").alias("gid"), F.col("it.text").alias("GroupName")))
    if isinstance(groups, DataFrame):
        g = g.join(groups.select(F.col(groups.columns[0]).cast("string").alias("gid")), "gid", "left_semi")
    else:
        g = g.filter(F.col("gid").isin(list(groups)))
    g = g.select(F.col("gid").cast("bigint").alias("GroupID"), "GroupName")
    # A body that does not parse has no ``data``: a failed request.
    kids = pages.filter("body.data is not null").select("parent_id", F.explode_outer("body.data").alias("c")) \
                .select("parent_id", F.col("c").isNull().alias("none"), F.col("c.id").alias("cid"), F.col("c.name").alias("cname"))
    kids = kids.dropDuplicates(["parent_id", "none", "cid", "cname"])
    full = kids.filter(~F.col("none"))
    # An empty page pads its parent only if no other page lists a child.
    kids = full.unionByName(kids.filter("none").join(full.select("parent_id").distinct(), "parent_id", "left_anti")).drop("none")

    def level(rows: DataFrame, parent: str, cid: str, cname: str) -> DataFrame:
        k = kids.select(F.col("parent_id").alias("_p"), F.col("cid").alias(cid), F.col("cname").alias(cname))
        j = rows.join(k, rows[parent] == k["_p"], "left")
        # a null parent passes through; a parent without any response is dropped
        return j.filter(F.col(parent).isNull() | F.col("_p").isNotNull()).drop("_p")

    m = g.join(kids.select(F.col("parent_id").alias("GroupID"), F.col("cid").alias("MasterCategoryID"),
                           F.col("cname").alias("MasterCategoryName")), "GroupID", "inner")
    c = level(m, "MasterCategoryID", "CategoryID", "CategoryName")
    s = level(c, "CategoryID", "SubCategoryID", "SubCategoryName")
    return s.select("GroupID", "GroupName", "MasterCategoryID", "MasterCategoryName",
                    "CategoryID", "CategoryName", "SubCategoryID", "SubCategoryName")


# ------------------------------------------------------------------ listing
def flatten_listing(pages: DataFrame) -> DataFrame:
    """Listing pages (category_id, page, body LISTING_PAGE) -> (sub_category_id,
    product_id, brand_name or null)."""
    return (pages.select(F.col("category_id").alias("sub_category_id"), F.explode("body.data").alias("it"))
                 .select("sub_category_id", F.col("it.id").alias("product_id"),
                         F.col("it.brand_name").alias("brand_name")))


# ------------------------------------------------------------------ product
def leaf_category(body: str = "body") -> Column:
    """The product's own category if it is a leaf, else the second-to-last
    breadcrumb when there are at least two, else null."""
    cats, crumbs = F.col(f"{body}.categories"), F.col(f"{body}.breadcrumbs")
    return (F.when(F.coalesce(cats["is_leaf"], F.lit(False)), cats["id"])
             .when(F.size(crumbs) >= 2, F.element_at(crumbs, -2)["category_id"]))


def flatten_product(docs: DataFrame, body: str = "body") -> DataFrame:
    """Product documents (sub_category_id, brand_name, body PRODUCT) -> one flat
    row. A missing seller gives 0 for its id and '0' for its text fields; the
    brand name comes from the listing row, not the document."""
    b = lambda f: F.col(f"{body}.{f}")
    seller = F.col(f"{body}.current_seller")
    has_seller = seller.isNotNull()

    def sfield(name: str, dtype: str):
        zero = F.lit(0).cast(dtype) if dtype == "bigint" else F.lit("0")
        return F.when(has_seller, F.coalesce(seller[name].cast(dtype), zero)).otherwise(zero)
    return docs.select(
        b("id").alias("product_id"), b("name").alias("product_name"), b("short_url").alias("product_url"),
        b("price").alias("pricing_current"), b("original_price").alias("pricing_original"),
        b("thumbnail_url").alias("product_image_url"), b("inventory_status").alias("inventory_status"),
        b("inventory_type").alias("inventory_type"), b("day_ago_created").alias("created_date"),
        b("all_time_quantity_sold").alias("quantity_sold"),
        b("brand.id").alias("brand_id"), F.col("brand_name"), b("brand.slug").alias("brand_slug"),
        sfield("id", "bigint").alias("seller_id"), sfield("name", "string").alias("seller_name"),
        sfield("link", "string").alias("seller_link"), sfield("logo", "string").alias("seller_image_url"),
        leaf_category(body).alias("category_id"), F.col("sub_category_id"),
    )


# ------------------------------------------------------------------ reviews
def flatten_reviews(pages: DataFrame, body: str = "body") -> DataFrame:
    """Review pages (product_id, page, body REVIEW_PAGE) -> one row per review
    with the page's star counts (missing -> 0) and reviewer fields (missing
    reviewer -> null user, 0 totals)."""
    stars = F.col(f"{body}.stars")
    star = lambda k: F.coalesce(F.try_element_at(stars, F.lit(k))["count"], F.lit(0).cast("bigint"))
    p = pages.select(
        F.col("product_id").alias("ProductID"),
        *[star(str(i)).alias(f"{n}StarCount") for i, n in enumerate(["One", "Two", "Three", "Four", "Five"], 1)],
        F.coalesce(F.col(f"{body}.reviews_count"), F.lit(0).cast("bigint")).alias("reviews_count"),
        F.explode(F.col(f"{body}.data")).alias("r"))
    u = F.col("r.created_by")
    summ = u["contribute_info"]["summary"]
    return p.select(
        "ProductID", "OneStarCount", "TwoStarCount", "ThreeStarCount", "FourStarCount", "FiveStarCount",
        "reviews_count", F.col("r.id").alias("review_id"), F.col("r.title").alias("review_title"),
        F.col("r.content").alias("review_content"),
        F.coalesce(F.col("r.thank_count"), F.lit(0).cast("bigint")).alias("review_upvote"),
        F.col("r.rating").alias("review_rating"), F.col("r.created_at").alias("review_created_at"),
        u["id"].alias("user_id"), u["name"].alias("username"), u["created_time"].alias("joined_time"),
        F.coalesce(summ["total_review"], F.lit(0).cast("bigint")).alias("total_reviews"),
        F.coalesce(summ["total_thank"], F.lit(0).cast("bigint")).alias("total_upvotes"),
    )
