"""Product flow: raw product snapshots -> Product, ProductSale, Inventory,
Pricing, Brand and Seller tables (exact step order of the daily load)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions.exprs import (
    date_text, minus_days, nan_if_null, reference_time, ts_text, with_prefix, zero_float_if_null, zero_if_null,
)
from martlake.operators.dedup import drop_marked_duplicates
from martlake.operators.order import SEQ, dense_id, distinct_rows, keep_first, tag_run
from martlake.operators.snapshots import created_at, daily_last, day_change, last_updated, spread_day_change

# Fixed values (the image host is deployment configuration; pass your own)
SELLER_IMAGE_PREFIX = "https://cdn.example.com/ts/seller/"
DEFAULT_TZ_OFFSET_HOURS = 7

PRODUCT_COLUMNS = ["ProductID", "BrandID", "SellerID", "SubCategoryID", "Name", "URL", "ImageURL", "CreatedAt"]


def conform_product(raw: DataFrame) -> DataFrame:
    """Select/rename to the product schema; ids and quantity null -> 0."""
    return raw.select(
        zero_if_null(F.col("product_id")).alias("ProductID"),
        zero_if_null(F.col("brand_id")).alias("BrandID"),
        zero_if_null(F.col("seller_id")).alias("SellerID"),
        zero_if_null(F.col("sub_category_id")).alias("SubCategoryID"),
        F.col("product_name").alias("Name"),
        F.col("product_url").alias("URL"),
        F.col("product_image_url").alias("ImageURL"),
        F.col("created_date").try_cast("double").alias("CreatedDate"),
        zero_if_null(F.col("quantity_sold")).alias("QuantitySold"),
        F.col(SEQ),
    )


def with_dates(raw: DataFrame, as_of: str, tz_offset_hours: int = DEFAULT_TZ_OFFSET_HOURS) -> DataFrame:
    """Conformed rows plus LastUpdated and CreatedAt (timestamps)."""
    ref = reference_time(as_of, tz_offset_hours)
    p = conform_product(raw)
    p = last_updated(p, "ProductID", "CreatedDate", ref)
    return created_at(p, "CreatedDate").drop("_maxdays")


def product_clean(raw: DataFrame, as_of: str, tz_offset_hours: int = DEFAULT_TZ_OFFSET_HOURS) -> DataFrame:
    """Dated rows -> distinct -> drop sentinel seller 0.

    The per-product maximum is taken before seller-0 rows are dropped. The days
    column stays as a hidden order column (it is a function of LastUpdated
    within a product, so keeping it does not change the distinct)."""
    p = with_dates(raw, as_of, tz_offset_hours)
    p = distinct_rows(p)
    return p.filter(F.col("SellerID") != 0)


def product_dim(clean: DataFrame) -> DataFrame:
    """First row per product ordered by days-ago descending (nulls last), then
    arrival; products without CreatedAt are dropped."""
    d = F.col("CreatedDate")
    first = keep_first(clean, ["ProductID"], [d.isNull(), -d, F.col(SEQ)])
    first = first.filter(F.col("CreatedAt").isNotNull())
    return first.select(*[F.col(c) for c in PRODUCT_COLUMNS[:-1]], ts_text("CreatedAt").alias("CreatedAt"))


def product_dim_of(raw: DataFrame, as_of: str, tz_offset_hours: int = DEFAULT_TZ_OFFSET_HOURS) -> DataFrame:
    """:func:`product_dim` of the cleaned raw rows, by one aggregate over them: the product's maximum over all rows, and
    beside it the first row that a sentinel seller does not rule out. (Repeated rows have equal contents, so the distinct
    changes nothing here.)"""
    p, d, ref = conform_product(raw), F.col("CreatedDate"), reference_time(as_of, tz_offset_hours)
    row = F.struct(*PRODUCT_COLUMNS[1:-1], "CreatedDate")
    order = F.when(F.col("SellerID") != 0, F.struct(d.isNull(), -d, F.col(SEQ)))  # a null order is never the least
    g = p.groupBy("ProductID").agg(F.max(d).alias("_max"), F.min_by(row, order).alias("_r"))
    back = F.col("_r.CreatedDate")
    created = minus_days(minus_days(ref, F.col("_max") - back), back)
    return (g.filter(back.isNotNull())
             .select("ProductID", *[F.col(f"_r.{c}").alias(c) for c in PRODUCT_COLUMNS[1:-1]], ts_text(created).alias("CreatedAt")))


def daily_values(raw: DataFrame, as_of: str, tz_offset_hours: int = DEFAULT_TZ_OFFSET_HOURS) -> DataFrame:
    """What the daily rules need of the cleaned rows, from one scan of the raw rows:
    (ProductID, QuantitySold, LastUpdated, Day, last: whether the quantity is the day's last one, n: cleaned rows like this).

    The dates of a row follow from its product and its days ago alone, so the distinct rows are counted per (product, days ago,
    quantity) first. That table has a row per value and not per snapshot, and the product's maximum, the day's last
    quantity and the day before are windows over it."""
    p = conform_product(raw)
    own = [c for c in p.columns if c != SEQ]
    d = p.groupBy(*own).agg(F.min(SEQ).alias(SEQ))
    sold = F.col("SellerID") != 0
    v = d.groupBy("ProductID", "CreatedDate", "QuantitySold").agg(
        F.count_if(sold).alias("n"), F.max(F.when(sold, F.col(SEQ))).alias(SEQ))
    back = F.max("CreatedDate").over(Window.partitionBy("ProductID")) - F.col("CreatedDate")
    v = v.withColumn("LastUpdated", minus_days(reference_time(as_of, tz_offset_hours), back)).filter("n > 0")
    v = v.withColumn("Day", F.to_date("LastUpdated"))
    newest = Window.partitionBy("ProductID", "Day").orderBy(F.col("LastUpdated").desc(), F.col(SEQ).desc())
    return v.withColumn("last", (F.row_number().over(newest) == 1) & F.col("Day").isNotNull()).drop(SEQ, "CreatedDate")


def daily_change(values: DataFrame) -> DataFrame:
    """(ProductID, Day, QuantitySold, QuantityFluctuation): the daily last quantities and their changes."""
    return day_change(values.filter("last").select("ProductID", "Day", "QuantitySold"), "ProductID", "Day", "QuantitySold")


def product_sale_of(values: DataFrame) -> DataFrame:
    """:func:`product_sale` from :func:`daily_values`: each cleaned row with its day's change."""
    days = Window.partitionBy("ProductID").orderBy(F.unix_date("Day")).rangeBetween(Window.unboundedPreceding, -1)
    today = F.max(F.when(F.col("last"), F.col("QuantitySold"))).over(Window.partitionBy("ProductID", "Day"))
    before = F.last(F.when(F.col("last"), F.col("QuantitySold")), ignorenulls=True).over(days)
    v = values.withColumn("_today", today).withColumn("_before", before)
    change = F.greatest(F.coalesce(F.col("_today") - F.col("_before"), F.col("_today")), F.lit(0))
    change = F.when(F.col("Day").isNull(), F.lit(0)).otherwise(change).cast("bigint")
    return v.select("ProductID", "QuantitySold", change.alias("QuantityFluctuation"), date_text("LastUpdated").alias("LastUpdated"),
                    F.explode(F.array_repeat(F.lit(True), F.col("n").cast("int"))).alias("_row")).drop("_row")


def product_sale(clean: DataFrame, daily: DataFrame | None = None) -> DataFrame:
    """Each clean row with the day-over-day change of its product's daily last
    quantity (``daily``, if it is there already); rows without a date get change 0."""
    if daily is None:
        daily = daily_last(clean, "ProductID", "LastUpdated", "QuantitySold", ["LastUpdated", SEQ])
    changes = day_change(daily, "ProductID", "Day", "QuantitySold")
    rows = spread_day_change(clean.select("ProductID", "QuantitySold", "LastUpdated"), changes,
                             "ProductID", "LastUpdated", "Day", "QuantityFluctuation")
    return rows.select("ProductID", "QuantitySold", "QuantityFluctuation",
                       date_text("LastUpdated").alias("LastUpdated"))


def ordinals(raw: DataFrame) -> DataFrame:
    """What the inventory and pricing tables need of every raw row, with its dense id in arrival order (``_id``)."""
    return dense_id(raw.select("product_id", "inventory_status", "inventory_type", "pricing_current", "pricing_original", SEQ),
                    [F.col(SEQ)], "_id")


def inventory_snapshot(raw: DataFrame, as_of: str, tz_offset_hours: int = DEFAULT_TZ_OFFSET_HOURS,
                       run_id: str | None = None) -> DataFrame:
    """Every raw row with a dense InventoryID in arrival order (that of :func:`ordinals`, if the rows have it) and the run time."""
    ref = reference_time(as_of, tz_offset_hours)
    r = raw.select(zero_if_null(F.col("product_id")).alias("ProductID"),
                   F.col("inventory_status").alias("Status"), F.col("inventory_type").alias("Type"),
                   *([F.col("_id").alias("InventoryID")] if "_id" in raw.columns else [SEQ]))
    if "_id" not in raw.columns:
        r = dense_id(r, [F.col(SEQ)], "InventoryID")
    return tag_run(r.select("InventoryID", "ProductID", "Status", "Type", ts_text(ref).alias("LastUpdated")), run_id)


def pricing_snapshot(raw: DataFrame, as_of: str, tz_offset_hours: int = DEFAULT_TZ_OFFSET_HOURS,
                     run_id: str | None = None) -> DataFrame:
    """Every raw row with a dense PricingID (as in the inventory), prices null -> 0.0, and the run time."""
    ref = reference_time(as_of, tz_offset_hours)
    r = raw.select(zero_if_null(F.col("product_id")).alias("ProductID"),
                   zero_float_if_null("pricing_current").alias("CurrentPrice"),
                   zero_float_if_null("pricing_original").alias("OriginalPrice"),
                   *([F.col("_id").alias("PricingID")] if "_id" in raw.columns else [SEQ]))
    if "_id" not in raw.columns:
        r = dense_id(r, [F.col(SEQ)], "PricingID")
    out = r.select("PricingID", "ProductID", "CurrentPrice", "OriginalPrice", ts_text(ref).alias("LastUpdated"))
    return tag_run(out, run_id)


def brand_dim(raw: DataFrame) -> DataFrame:
    """First row per brand id (a null id is one brand of its own)."""
    b = raw.select(F.col("brand_id").alias("BrandID"), F.col("brand_name").alias("Name"),
                   F.col("brand_slug").alias("Slug"), SEQ)
    return keep_first(b, ["BrandID"], [F.col(SEQ)]).drop(SEQ)


def seller_dim(raw: DataFrame, prefix: str = SELLER_IMAGE_PREFIX, strict_suffix: bool = False) -> DataFrame:
    """Seller rows: id null -> 0, image URL null -> 'nan' then prefixed unless it
    starts with http; duplicated ids lose rows whose image URL contains 'nan';
    first row per id. ``strict_suffix`` drops only URLs that are the null
    marker itself (prefix + 'nan'), so a real URL containing 'nan' survives."""
    s = raw.select(zero_if_null(F.col("seller_id")).alias("SellerID"),
                   F.col("seller_name").cast("string").alias("Name"),
                   F.col("seller_link").cast("string").alias("Link"),
                   with_prefix(nan_if_null("seller_image_url"), prefix).alias("ImageURL"), SEQ)
    url = F.col("ImageURL")
    marked = (url == F.lit(prefix + "nan")) | (url == F.lit("nan")) if strict_suffix else url.contains("nan")
    out = drop_marked_duplicates(s, "SellerID", marked)
    return out.drop(SEQ)


def brand_filter(df: DataFrame, brands, column: str = "BrandName") -> DataFrame:
    """Rows whose brand is in ``brands`` (exact case). ``brands`` is a name, a
    list of names (a literal IN list) or a DataFrame of names (semi join)."""
    if isinstance(brands, str):
        brands = [brands]
    if isinstance(brands, DataFrame):
        names = brands.select(F.col(brands.columns[0]).alias("_brand")).distinct()
        return df.join(names, df[column] == names["_brand"], "left_semi")
    return df.filter(F.col(column).isin(list(brands)))
