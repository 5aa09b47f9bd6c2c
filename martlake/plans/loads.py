"""Whole loads, from raw rows or landing documents to their tables in a folder: each stage is written once,
counted in that pass, and read by what comes after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.operators.hierarchy import collapse_single_category, fill_levels, split_dimensions
from martlake.operators.commit import commit
from martlake.operators.metrics import RunMetrics
from martlake.operators.quality import strict_cast_sink
from martlake.operators.snapshots import daily_last
from martlake.plans import category as cat
from martlake.plans import feedback as fb
from martlake.plans import product as prod
from martlake.sources import payloads as S


def load_product(raw: DataFrame, folder: str, as_of: str, tz_offset_hours: int = prod.DEFAULT_TZ_OFFSET_HOURS,
                 metrics: RunMetrics | None = None) -> tuple[dict[str, DataFrame], RunMetrics]:
    """The daily product load: raw snapshots -> cleaned rows -> Product, ProductSale, Inventory, Pricing, Brand and Seller.

    The raw rows and the cleaned rows are tables of the run (its landing and staging), so the inputs are scanned
    once and the dates, the distinct and the sentinel filter run once, however many tables follow. The sales take the daily
    quantities from their table, and inventory and pricing share one set of ordinal ids."""
    m = metrics or RunMetrics()
    raw = m.store("extracted", raw, f"{folder}/extracted")
    clean = m.store("transformed", prod.product_clean(raw, as_of, tz_offset_hours), f"{folder}/transformed")
    daily = m.store("daily", daily_last(clean, "ProductID", "LastUpdated", "QuantitySold", ["LastUpdated", "_seq"]), f"{folder}/daily")
    numbered = prod.ordinals(raw)
    tables = {
        "product": prod.product_dim(clean), "product_sale": prod.product_sale(clean, daily),
        "inventory": prod.inventory_snapshot(numbered, as_of, tz_offset_hours),
        "pricing": prod.pricing_snapshot(numbered, as_of, tz_offset_hours),
        "brand": prod.brand_dim(raw), "seller": prod.seller_dim(raw),
    }
    return {"daily": daily} | {name: m.store(name, df, f"{folder}/{name}") for name, df in tables.items()}, m


def load_category(menu: DataFrame, pages: DataFrame, groups: Sequence[str] | DataFrame, folder: str,
                  metrics: RunMetrics | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Menu and category responses -> flattened tree -> collapsed and filled levels -> strict id casts -> the four
    dimensions, and the rows that the casts reject."""
    m = metrics or RunMetrics()
    tree = m.store("extracted", S.flatten_category_tree(menu, pages, groups), f"{folder}/tree")
    valid, quarantine = strict_cast_sink(fill_levels(collapse_single_category(tree)), cat.LEVEL_CASTS,
                                         f"{folder}/hierarchy", m, "hierarchy")
    dims = {name: m.store(name, df, f"{folder}/{name}") for name, df in split_dimensions(valid).items()}
    return dims, quarantine


def load_reference(pages: DataFrame, folder: str, metrics: RunMetrics | None = None) -> tuple[DataFrame, DataFrame]:
    """Listing responses -> reference ids -> distinct -> strict casts -> ReferenceProduct, replaced as a whole by one
    commit, and the rows that the casts reject."""
    m = metrics or RunMetrics()
    listing = S.flatten_listing(pages)
    valid, quarantine = strict_cast_sink(cat.reference_rows(listing), cat.REFERENCE_CASTS, f"{folder}/reference", m, "reference")
    return commit(m.watch("reference_product", valid), f"{folder}/ReferenceProduct"), quarantine


def load_detail(raw: DataFrame, folder: str, metrics: RunMetrics | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw reviews -> strict casts -> FeedbackDetail, and the rows that the casts reject."""
    m = metrics or RunMetrics()
    valid, quarantine = strict_cast_sink(fb.detail_columns(raw), fb.DETAIL_STRICT, f"{folder}/detail", m, "detail")
    detail = m.store("feedback_detail", fb.detail_table(fb.detail_versions(valid)), f"{folder}/FeedbackDetail")
    return detail, quarantine.select("ProductID", "UserID", "GeneralFeedbackID", "Upvote", "Rating", F.col("_error"))
