"""Registry of named jobs: each takes (spark, sf_dir) and returns a DataFrame.

The jobs wire the library operators to the driver tables through
:mod:`martlake.sources.bindings`. Outputs use flat, explicitly typed columns
(ids bigint, flags int, times as formatted text) so they compare one to one
with the SQL oracle in :mod:`martlake.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.functions.exprs import date_text, ts_text
from martlake.plans import product as prod
from martlake.sources import bindings as B

Job = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Job] = {}


def job(name: str):
    def deco(fn: Job) -> Job:
        REGISTRY[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ product
def _raw_product(spark, d):
    return B.raw_product(spark, d)


def _clean(spark, d):
    return prod.product_clean(_raw_product(spark, d), B.AS_OF, B.PRODUCT_TZ_OFFSET_HOURS)


def _daily_values(spark, d):
    return prod.daily_values(_raw_product(spark, d), B.AS_OF, B.PRODUCT_TZ_OFFSET_HOURS)


@job("last_updated")
def q_last_updated(spark, d):
    p = prod.with_dates(_raw_product(spark, d), B.AS_OF, B.PRODUCT_TZ_OFFSET_HOURS)
    return p.select("ProductID", "SellerID", "CreatedDate", ts_text("LastUpdated").alias("LastUpdated"))


@job("created_at")
def q_created_at(spark, d):
    p = prod.with_dates(_raw_product(spark, d), B.AS_OF, B.PRODUCT_TZ_OFFSET_HOURS)
    return p.select("ProductID", "SellerID", "CreatedDate", ts_text("CreatedAt").alias("CreatedAt"))


@job("product_clean")
def q_product_clean(spark, d):
    c = _clean(spark, d)
    return c.select("ProductID", "BrandID", "SellerID", "SubCategoryID", "Name", "URL", "ImageURL",
                    "QuantitySold", ts_text("LastUpdated").alias("LastUpdated"),
                    ts_text("CreatedAt").alias("CreatedAt"))


@job("daily_last_quantity")
def q_daily_last_quantity(spark, d):
    daily = _daily_values(spark, d).filter("last")
    return daily.select("ProductID", date_text("Day").alias("Day"), "QuantitySold")


@job("quantity_fluctuation")
def q_quantity_fluctuation(spark, d):
    ch = prod.daily_change(_daily_values(spark, d))
    return ch.select("ProductID", date_text("Day").alias("Day"), "QuantitySold", "QuantityFluctuation")


@job("product_sale")
def q_product_sale(spark, d):
    return prod.product_sale_of(_daily_values(spark, d))


@job("product_dim")
def q_product_dim(spark, d):
    return prod.product_dim_of(_raw_product(spark, d), B.AS_OF, B.PRODUCT_TZ_OFFSET_HOURS)


@job("inventory_snapshot")
def q_inventory_snapshot(spark, d):
    return prod.inventory_snapshot(_raw_product(spark, d), B.AS_OF, B.PRODUCT_TZ_OFFSET_HOURS)


@job("pricing_snapshot")
def q_pricing_snapshot(spark, d):
    return prod.pricing_snapshot(_raw_product(spark, d), B.AS_OF, B.PRODUCT_TZ_OFFSET_HOURS)


@job("brand_dim")
def q_brand_dim(spark, d):
    return prod.brand_dim(_raw_product(spark, d))


@job("seller_dim")
def q_seller_dim(spark, d):
    return prod.seller_dim(_raw_product(spark, d))


@job("distinct_rows")
def q_distinct_rows(spark, d):
    """Ordered distinct on its own: the product rows minus the snapshot-specific
    columns, each survivor carrying its first arrival."""
    from martlake.operators.order import distinct_rows
    p = prod.conform_product(_raw_product(spark, d)).drop("CreatedDate", "QuantitySold")
    out = distinct_rows(p)
    return out.select("ProductID", "BrandID", "SellerID", "SubCategoryID", "Name", "URL", "ImageURL",
                      ts_text(F.col("_seq.d")).alias("FirstShipDate"), F.col("_seq.o").alias("FirstOrderKey"))


@job("dense_id")
def q_dense_id(spark, d):
    """Dense 1..N ordinal over all lineitem rows in (shipdate, orderkey,
    linenumber, suppkey, partkey) order."""
    from martlake.operators.order import dense_id
    r = _raw_product(spark, d).select("product_id", "seller_id", "_seq")
    out = dense_id(r, [F.col("_seq")], "RowID")
    return out.select("RowID", F.col("product_id").alias("ProductID"), F.col("seller_id").alias("SellerID"),
                      F.col("_seq.o").alias("OrderKey"), F.col("_seq.n").alias("LineNumber"))


# ----------------------------------------------------------------- feedback
from martlake.plans import feedback as fb  # noqa: E402


def _raw_feedback(spark, d):
    return B.raw_feedback(spark, d)


@job("history")
def q_history(spark, d):
    return fb.history(_raw_feedback(spark, d))


@job("user_dim")
def q_user_dim(spark, d):
    return fb.user_dim(_raw_feedback(spark, d))


@job("priority_dedup")
def q_priority_dedup(spark, d):
    return fb.priority_user(_raw_feedback(spark, d))


@job("general_feedback")
def q_general_feedback(spark, d):
    return fb.general_feedback(_raw_feedback(spark, d), B.AS_OF, B.FEEDBACK_TZ_OFFSET_HOURS)


@job("unmasked_content")
def q_unmasked_content(spark, d):
    u = fb.unmasked_content(_raw_feedback(spark, d))
    return u.select("ProductID", "UserID", "GeneralFeedbackID", "CreatedDate", "Title", "Content", "Upvote", "Rating")


@job("feedback_detail")
def q_feedback_detail(spark, d):
    return fb.feedback_detail(_raw_feedback(spark, d))


@job("strict_cast_quarantine")
def q_strict_cast_quarantine(spark, d):
    return fb.detail_quarantine(_raw_feedback(spark, d))


# --------------------------------------------------------------- text, ABSA
from martlake.functions import text as T  # noqa: E402
from martlake.operators import absa as X  # noqa: E402
from martlake.plans import absa as ab  # noqa: E402


def _review_text(spark, d):
    return B.review_text(spark, d)


def _meaningful(spark, d):
    return ab.meaningful_reviews(_review_text(spark, d))


def _parsed(spark, d):
    return ab.parse_responses(ab.aspect_responses(_meaningful(spark, d)))


def _scored(spark, d):
    return ab.scored_terms(_parsed(spark, d))


@job("clean_text")
def q_clean_text(spark, d):
    r = _review_text(spark, d)
    return r.select("GeneralFeedbackID", T.clean_text("Content").alias("Content"))


@job("mask_phone")
def q_mask_phone(spark, d):
    r = _review_text(spark, d)
    return r.select("GeneralFeedbackID", T.mask_phones("Content").alias("Content"))


@job("meaningful_text")
def q_meaningful_text(spark, d):
    return _meaningful(spark, d).select("GeneralFeedbackID", "ID", "Content")


def noisy_responses(responses: DataFrame) -> DataFrame:
    """Model output as it arrives in practice: some documents wrapped in prose,
    some cut off half way (derived deterministically from the review id)."""
    r, g = F.col("response"), F.col("GeneralFeedbackID")
    noisy = (F.when(g % 3 == 1, F.concat(F.lit("Kết quả:\n"), r, F.lit("\nHết.")))
              .when(g % 7 == 0, F.substring(r, 1, (F.length(r) / 2).cast("int")))
              .otherwise(r))
    return responses.select("GeneralFeedbackID", "ID", noisy.alias("response"))


@job("recover_json")
def q_recover_json(spark, d):
    resp = noisy_responses(ab.aspect_responses(_meaningful(spark, d)))
    doc = X.recover_json(F.col("response"))
    return resp.select("GeneralFeedbackID", doc.isNotNull().alias("Recovered"),
                       F.size(doc["Aspects"]).cast("bigint").alias("Aspects"))


@job("aspect_terms")
def q_aspect_terms(spark, d):
    p = _parsed(spark, d).select("GeneralFeedbackID", F.explode("Aspects").alias("a"))
    terms = X.normalize_terms(F.col("a.AspectTerms"))
    return p.select("GeneralFeedbackID", F.col("a.AspectCategory").alias("AspectCategory"),
                    F.size(terms).cast("bigint").alias("NTerms"), F.array_join(terms, "|").alias("Terms"))


@job("aspect_explode")
def q_aspect_explode(spark, d):
    e = X.explode_aspects(_parsed(spark, d))
    return e.select("GeneralFeedbackID", "AspectCategory", "AspectTerms")


@job("context_window")
def q_context_window(spark, d):
    return _scored(spark, d).select("GeneralFeedbackID", "AspectCategory", "AspectTerms", "Context")


@job("score_context")
def q_score_context(spark, d):
    s = _scored(spark, d)
    return s.select("GeneralFeedbackID", "AspectCategory", "AspectTerms",
                    *[F.round(F.col("scores")[n], 6).alias(n) for n in X.LABELS])


@job("dominant_sentiment")
def q_dominant_sentiment(spark, d):
    return _scored(spark, d).select("GeneralFeedbackID", "AspectCategory", "AspectTerms",
                                    "DominantLabel", "DominantScore")


@job("polarity")
def q_polarity(spark, d):
    return _scored(spark, d).select("GeneralFeedbackID", "AspectCategory", "AspectTerms", "Polarity")


@job("sentiment_distribution")
def q_sentiment_distribution(spark, d):
    return ab.sentiment_distribution(_scored(spark, d))


@job("absa_nested")
def q_absa_nested(spark, d):
    """One row per review; its aspects as the JSON array the result sink writes."""
    return ab.aspects_json(ab.nest_scored(_parsed(spark, d)))


def _fresh(spark, name: str) -> str:
    """A new folder of this run under the shared checkpoint folder."""
    import uuid
    from martlake.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@job("absa_json_roundtrip")
def q_absa_json_roundtrip(spark, d):
    """The nested result written by its JSON sink and read back, one row per scored term."""
    path = _fresh(spark, "absa-json")
    ab.write_nested_json(ab.nest_scored(_parsed(spark, d)), path)
    back = ab.read_nested_json(spark, path)
    return back.select("GeneralFeedbackID", "ID", "Content", F.posexplode("Aspects").alias("Position", "a")) \
               .select("GeneralFeedbackID", "ID", "Content", "Position", "a.*")


def flaky_extractor():
    """An extractor as a remote model behaves, by row id: some rows always fail, some answer on a second call, some
    answers are cut off or wrapped in prose. Its answers are those of the lexicon."""
    import json
    import pandas as pd
    asked: set[int] = set()

    def extract(batch):
        out, new = [], set()
        for gid, row, text in zip(batch["GeneralFeedbackID"], batch["ID"], batch["Content"]):
            k = (gid >> 2) % 1000 + row
            if k % 11 == 0:
                raise RuntimeError("model refused")
            aspects = [{"AspectCategory": c, "AspectTerms": [t for t in terms if t in text]} for c, terms in X.ASPECT_LEXICON.items()]
            answer = json.dumps({"GeneralFeedbackID": int(gid), "ID": int(row), "Content": text, "Aspects": aspects}, ensure_ascii=False)
            if k % 7 == 0 and gid not in asked:
                new.add(gid)
                answer = None
            elif k % 5 == 0:
                answer = answer[:-3]
            elif k % 3 == 0:
                answer = f"Here it is: {answer} Done."
            out.append(answer)
        asked.update(new)
        return pd.Series(out, dtype=object)
    return extract


def _extraction(spark, d):
    from martlake.operators.metrics import RunMetrics
    m = RunMetrics()
    outcomes = X.batch_outcomes(_meaningful(spark, d), flaky_extractor)
    good, bad = X.settle_outcomes(outcomes, f"{_fresh(spark, 'extraction')}/outcomes", m)
    return good, bad, m


@job("extraction_results")
def q_extraction_results(spark, d):
    """Aspect terms of the responses from which a document was recovered."""
    good, _, _ = _extraction(spark, d)
    a = good.select("GeneralFeedbackID", "ID", F.explode("Aspects").alias("a"))
    return a.select("GeneralFeedbackID", "ID", F.col("a.AspectCategory").alias("AspectCategory"),
                    F.array_join(X.normalize_terms(F.col("a.AspectTerms")), "|").alias("Terms"))


@job("extraction_failures")
def q_extraction_failures(spark, d):
    """Rows that got no usable response, with the error and the number of calls."""
    _, bad, _ = _extraction(spark, d)
    return bad.select("GeneralFeedbackID", "ID", F.col("error").alias("Error"), F.col("attempts").cast("bigint").alias("Attempts"))


@job("extraction_counts")
def q_extraction_counts(spark, d):
    """How many rows were asked, succeeded and failed, counted while the outcomes were written."""
    return _extraction(spark, d)[2].table(spark)


@job("model_score_context")
def q_model_score_context(spark, d):
    """:func:`q_score_context` by a batch scorer that is loaded once per Python worker."""
    e = X.explode_aspects(_parsed(spark, d)).filter(F.col("AspectTerms").isNotNull())
    e = e.select("GeneralFeedbackID", "AspectCategory", "AspectTerms", X.context_window("Content", "AspectTerms").alias("Context"))
    s = X.model_scores(e, "Context", X.LexiconScorer, "lexicon")
    return s.select("GeneralFeedbackID", "AspectCategory", "AspectTerms", *[F.round(F.col("scores")[n], 6).alias(n) for n in X.LABELS])


# ---------------------------------------------------- category, load, merge
from martlake.operators import hierarchy as H  # noqa: E402
from martlake.operators import merge as M  # noqa: E402
from martlake.plans import category as cat  # noqa: E402
from martlake.plans.product import brand_filter  # noqa: E402

# The brands a brand-scoped run loads (the feature is the filter).
BRANDS = ["Brand#1", "Brand#2", "Brand#3"]


@job("collapse_single_category")
def q_collapse_single_category(spark, d):
    return H.collapse_single_category(B.raw_category(spark, d).drop("_seq"))


@job("fill_hierarchy")
def q_fill_hierarchy(spark, d):
    return H.fill_levels(H.collapse_single_category(B.raw_category(spark, d).drop("_seq")))


@job("category_dims")
def q_category_dims(spark, d):
    return cat.category_dimensions_long(B.raw_category(spark, d))


@job("upsert_category")
def q_upsert_category(spark, d):
    result, _ = M.upsert(B.customer_existing(spark, d), B.customer_incoming(spark, d), ["CustKey"])
    return result.withColumnRenamed("_action", "Action")


@job("upsert_bucketed")
def q_upsert_bucketed(spark, d):
    """:func:`q_upsert_category` into a table stored in buckets of its key, which no join shuffles."""
    from martlake.operators.buckets import open_buckets, upsert_buckets
    old, path = B.customer_existing(spark, d), _fresh(spark, "customers")
    table = open_buckets(spark, f"customers_{path.rpartition('-')[2]}", path, old.schema, ["CustKey"], BUCKETS)
    table.append(old)
    return upsert_buckets(table, B.customer_incoming(spark, d)).withColumnRenamed("_action", "Action")


#: Buckets of the stored tables in these jobs; a deployment chooses by the size of the table.
BUCKETS = 16


@job("insert_distinct")
def q_insert_distinct(spark, d):
    """Two loads appended to a table in buckets of the row digest; only the loads are shuffled."""
    from martlake.operators import buckets as K
    first, second = B.sales_loads(spark, d)
    path = _fresh(spark, "sales")
    table = K.open_distinct(spark, f"sales_{path.rpartition('-')[2]}", path, first.schema, BUCKETS)
    K.append_distinct(table, first)
    K.append_distinct(table, second)
    return K.rows_of(table, spark)


@job("first_load")
def q_first_load(spark, d):
    """A first load is stored as it comes, repeated rows too."""
    result, _ = M.insert_distinct(None, B.sales_loads(spark, d)[0])
    return result


def _category_load(spark, d):
    from martlake.plans.loads import load_category
    menu, pages = B.broken_category_landing(spark, d)
    parts = B.read_table(spark, d, "part").filter("p_partkey % 50 = 0").select((F.col("p_partkey") * 10 + 5).cast("string"))
    menu_docs = S.parse(menu, "json", S.MENU).select("body")
    page_docs = S.parse(pages, "json", S.CATEGORY_PAGE).select("parent_id", "body")
    return load_category(menu_docs, page_docs, parts.unionByName(spark.createDataFrame([(g,) for g in GROUPS], parts.schema)),
                         _fresh(spark, "category-load"))


@job("category_load")
def q_category_load(spark, d):
    """Responses -> tree -> repaired hierarchy -> strict casts -> the four dimensions, as one load."""
    return H.dimensions_long(_category_load(spark, d)[0])


@job("category_quarantine")
def q_category_quarantine(spark, d):
    """What the strict casts of the category load reject: groups whose pages list no master."""
    return _category_load(spark, d)[1].select("GroupID", "GroupName", "MasterCategoryID", F.col("_error").alias("Error"))


def _reference_load(spark, d):
    from martlake.plans.loads import load_reference
    return load_reference(S.parse(B.broken_listing_pages(spark, d), "json", S.LISTING_PAGE), _fresh(spark, "reference-load"))


@job("reference_load")
def q_reference_load(spark, d):
    """Listing responses -> reference ids -> distinct -> strict casts -> one commit of the whole table."""
    return _reference_load(spark, d)[0]


@job("reference_quarantine")
def q_reference_quarantine(spark, d):
    """Reference rows without a usable id."""
    return _reference_load(spark, d)[1].select("ReferenceID", "SubCategoryID", "ProductID", "BrandName", F.col("_error").alias("Error"))


@job("detail_load")
def q_detail_load(spark, d):
    """Raw reviews -> strict casts -> FeedbackDetail, valid and rejected rows written in one pass."""
    from martlake.plans.loads import load_detail
    return load_detail(_raw_feedback(spark, d), _fresh(spark, "detail-load"))[0]


@job("detail_quarantine")
def q_detail_quarantine(spark, d):
    from martlake.plans.loads import load_detail
    return load_detail(_raw_feedback(spark, d), _fresh(spark, "detail-load"))[1]


@job("reference_product")
def q_reference_product(spark, d):
    """Listing -> ReferenceProduct, loaded by full overwrite (twice, as two
    scheduled refreshes would: the second replaces the first, nothing doubles)."""
    from martlake.operators.commit import commit, read_committed
    valid, _ = cat.reference_product(B.listing(spark, d))
    path = _fresh(spark, "reference-product")
    for _ in range(2):
        commit(valid, path)
    return read_committed(spark, path)


@job("brand_filter")
def q_brand_filter(spark, d):
    valid, _ = cat.reference_product(B.listing(spark, d))
    return brand_filter(valid, BRANDS)


# ------------------------------------------------------------------ sources
from martlake.sources import csvio  # noqa: E402
from martlake.sources import payloads as S  # noqa: E402

# The category groups a run loads (the whitelist is the feature).
GROUPS = ["11", "21", "31", "41"]


@job("flatten_category_tree")
def q_flatten_category_tree(spark, d):
    """The category responses are landed as newline-delimited JSON files (as
    the crawler writes them) and read back with an explicit schema; the
    flattener then works on the landed files, not on the plan that made them."""
    import uuid
    from pyspark.sql.types import LongType, StructField, StructType
    from martlake.session import scratch_path
    base = scratch_path(spark, f"landing-category-{uuid.uuid4().hex}")
    menu, pages = B.category_landing(spark, d)
    menu.select(F.concat(F.lit('{"body":'), "json", F.lit("}"))).write.text(f"{base}/menu")
    pages.select(F.concat(F.lit('{"parent_id":'), F.col("parent_id").cast("string"), F.lit(',"page":'),
                          F.col("page").cast("string"), F.lit(',"body":'), "json", F.lit("}"))) \
         .write.text(f"{base}/pages")
    menu_docs = S.read_landing(spark, f"{base}/menu", StructType([StructField("body", S.MENU)]))
    page_docs = S.read_landing(spark, f"{base}/pages", StructType([
        StructField("parent_id", LongType()), StructField("page", LongType()),
        StructField("body", S.CATEGORY_PAGE)]))
    return S.flatten_category_tree(menu_docs, page_docs, GROUPS)


@job("flatten_listing")
def q_flatten_listing(spark, d):
    return S.flatten_listing(S.parse(B.listing_pages(spark, d), "json", S.LISTING_PAGE))


@job("flatten_product")
def q_flatten_product(spark, d):
    return S.flatten_product(S.parse(B.product_docs(spark, d), "json", S.PRODUCT))


@job("leaf_category")
def q_leaf_category(spark, d):
    docs = S.parse(B.product_docs(spark, d), "json", S.PRODUCT)
    return docs.select(F.col("body.id").alias("product_id"), S.leaf_category().alias("category_id"))


@job("flatten_reviews")
def q_flatten_reviews(spark, d):
    return S.flatten_reviews(S.parse(B.review_pages(spark, d), "json", S.REVIEW_PAGE))


@job("csv_roundtrip")
def q_csv_roundtrip(spark, d):
    """Whole documents (quotes, commas, newlines inside) written as warehouse
    CSV under the shared scratch folder and read back with an explicit schema."""
    from martlake.session import scratch_path
    import uuid
    docs = B.read_table(spark, d, "documents").select("doc_id", "lang", "text")
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    csvio.write_csv(docs, path)
    return csvio.read_csv(spark, path, docs.schema)


# ------------------------------------------------------ metrics and marts
from martlake.operators import marts as MT  # noqa: E402
from martlake.operators.quality import quality_report  # noqa: E402


@job("run_metrics")
def q_run_metrics(spark, d):
    """Rows of each stage and table of the product load, counted while they are written."""
    from martlake.plans.loads import load_product
    _, metrics = load_product(_raw_product(spark, d), _fresh(spark, "product-load"), B.AS_OF, B.PRODUCT_TZ_OFFSET_HOURS)
    return metrics.table(spark)


@job("dq_report")
def q_dq_report(spark, d):
    f = quality_report(_raw_feedback(spark, d), "raw_feedback", ["review_id"],
                       {"review_rating": "bigint", "review_created_at": "bigint", "joined_time": "timestamp"})
    p = quality_report(_raw_product(spark, d), "raw_product", ["product_id", "seller_id"],
                       {"created_date": "bigint", "quantity_sold": "bigint", "seller_image_url": "string"})
    return f.unionByName(p)


@job("review_summary")
def q_review_summary(spark, d):
    return MT.review_summary(fb.feedback_detail_rows(_raw_feedback(spark, d)))


def _daily_prices(spark, d):
    r = _raw_product(spark, d).select(F.col("product_id").alias("ProductID"), F.col("_seq.d").alias("ts"),
                                      "pricing_current", "pricing_original", "_seq")
    return MT.daily_price(r, "ProductID", "ts", ["_seq"], "pricing_current", "pricing_original")


@job("price_change")
def q_price_change(spark, d):
    out = MT.price_change(_daily_prices(spark, d), "ProductID")
    return out.withColumn("Day", date_text("Day"))


@job("kpi_direction")
def q_kpi_direction(spark, d):
    daily = _daily_values(spark, d).filter("last").select("ProductID", "Day", "QuantitySold")
    return MT.kpi_direction(daily, "ProductID", "QuantitySold").withColumn("Day", date_text("Day"))


@job("incremental_upsert")
def q_incremental_upsert(spark, d):
    """General-feedback rows land as 4 files; a file-source stream merges them
    one file per micro-batch (append-distinct); a second run finds nothing new."""
    import uuid
    from martlake.session import scratch_path
    from martlake.streaming.incremental import run_incremental
    base = scratch_path(spark, f"incremental-{uuid.uuid4().hex}")
    rows = fb.general_feedback_rows(_raw_feedback(spark, d), B.AS_OF, B.FEEDBACK_TZ_OFFSET_HOURS)
    rows.repartition(4, "GeneralFeedbackID").write.parquet(f"{base}/landing")
    for _ in range(2):
        run_incremental(spark, f"{base}/landing", rows.schema, f"{base}/target", f"{base}/checkpoint",
                        max_files_per_trigger=1)
    return spark.read.parquet(f"{base}/target")


@job("incremental_bucketed")
def q_incremental_bucketed(spark, d):
    """:func:`q_incremental_upsert` into a table in buckets of the row digest: micro-batches are shuffled, the table is not."""
    from martlake.streaming.incremental import append_buckets, run_incremental
    base = _fresh(spark, "incremental-bucketed")
    rows = fb.general_feedback_rows(_raw_feedback(spark, d), B.AS_OF, B.FEEDBACK_TZ_OFFSET_HOURS)
    rows.repartition(4, "GeneralFeedbackID").write.parquet(f"{base}/landing")

    def twice(batch, number):  # each micro-batch arrives again, as after a failure
        for _ in range(2):
            append_buckets(batch, f"{base}/target", BUCKETS)

    run_incremental(spark, f"{base}/landing", rows.schema, f"{base}/target", f"{base}/checkpoint", max_files_per_trigger=1, merge=twice)
    return spark.read.schema(rows.schema).parquet(f"{base}/target")


@job("streaming_upsert")
def q_streaming_upsert(spark, d):
    """Three landings are upserted one micro-batch after the other into a stored table with a column of its own and
    duplicated keys; each micro-batch is delivered twice. Null keys, duplicate keys, one commit each."""
    from martlake.operators.commit import commit, read_committed
    from martlake.streaming.incremental import merge_committed, run_incremental
    base = _fresh(spark, "streaming-upsert")
    old = B.customer_existing(spark, d)
    commit(old.drop("_seq"), f"{base}/target")

    def twice(batch, number):
        for _ in range(2):
            merge_committed(batch, f"{base}/target", ["CustKey"], "customers", number, order=["Name"])

    for batch in B.customer_batches(spark, d):  # a run takes what has landed since the last one
        batch.write.mode("append").parquet(f"{base}/landing")
        run_incremental(spark, f"{base}/landing", batch.schema, f"{base}/target", f"{base}/checkpoint", merge=twice)
    return read_committed(spark, f"{base}/target")


@job("kpi_heat")
def q_kpi_heat(spark, d):
    """Heat of a product's day: fifths of the day's products by quantity, ties by product id."""
    from martlake.operators.rank import ntile
    daily = _daily_values(spark, d).filter("last").select("ProductID", "Day", "QuantitySold")
    out = ntile(daily, 5, ["Day"], ["QuantitySold", "ProductID"], "Heat")
    return out.withColumn("Day", date_text("Day"))


@job("ordered_sale")
def q_ordered_sale(spark, d):
    """The sale table written in global order (product, then date) and read back."""
    from martlake.sources.ordered import write_ordered
    path = _fresh(spark, "ordered-sale")
    write_ordered(q_product_sale(spark, d), path, ["ProductID", "LastUpdated", "QuantitySold"])
    return spark.read.parquet(path)
