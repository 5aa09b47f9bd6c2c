"""Landing JSON flatteners and the warehouse CSV round trip (FIXTURES §C)."""

import json

from pyspark.sql import functions as F

from conftest import rows
from martlake.sources import csvio
from martlake.sources import payloads as P


def _landing(spark, schema_ddl, data, body_schema):
    return P.parse(spark.createDataFrame(data, schema_ddl), "json", body_schema)


def test_category_tree_missing_levels_and_failed_response(spark):
    menu = _landing(spark, "json string", [(json.dumps({"menu_block": {"items": [
        {"link": "/nha-cua/c1", "text": "Nhà"}, {"link": "/x/c2", "text": "Other"}]}}),)], P.MENU)
    pages = _landing(spark, "parent_id bigint, json string", [
        (1, json.dumps({"data": [{"id": 10, "name": "M10"}, {"id": 11, "name": "M11"}]})),
        (10, json.dumps({"data": [{"id": 100, "name": "C100"}]})),
        (100, json.dumps({"data": []})),                    # no children -> one row, sub null
        # 11 has no response at all -> no row
    ], P.CATEGORY_PAGE)
    out = P.flatten_category_tree(menu, pages, ["1"])
    assert rows(out) == [(1, "Nhà", 10, "M10", 100, "C100", None, None)]


def test_listing_product_and_leaf(spark):
    docs = _landing(spark, "sub_category_id bigint, brand_name string, json string", [
        (5, "ListBrand", json.dumps({"id": 1, "name": "n", "brand": {"id": 3, "name": "DocBrand", "slug": "s"},
                                     "current_seller": {"id": 7, "name": "S"},
                                     "categories": {"id": 99, "is_leaf": True}})),
        (5, None, json.dumps({"id": 2, "categories": {"id": 98, "is_leaf": False},
                              "breadcrumbs": [{"category_id": 1}, {"category_id": 2}, {"category_id": 3}]})),
    ], P.PRODUCT)
    out = P.flatten_product(docs).select("product_id", "brand_name", "seller_id", "seller_name", "seller_link",
                                         "category_id")
    assert rows(out) == [(1, "ListBrand", 7, "S", "0", 99), (2, None, 0, "0", "0", 2)]
    listing = _landing(spark, "category_id bigint, json string", [
        (5, json.dumps({"paging": {"last_page": 1}, "data": [{"id": 1, "brand_name": "B"}, {"id": 2}]}))],
        P.LISTING_PAGE)
    assert rows(P.flatten_listing(listing)) == [(5, 1, "B"), (5, 2, None)]


def test_reviews_star_counts_and_missing_reviewer(spark):
    pages = _landing(spark, "product_id bigint, json string", [(8, json.dumps({
        "stars": {"1": {"count": 2}, "5": {"count": 9}}, "reviews_count": 11,
        "data": [{"id": 100, "content": "ok", "rating": 5, "created_by": {"id": 4, "name": "u",
                  "contribute_info": {"summary": {"total_review": 3}}}},
                 {"id": 101, "content": "x", "rating": 1}]}))], P.REVIEW_PAGE)
    out = P.flatten_reviews(pages).select("review_id", "OneStarCount", "TwoStarCount", "FiveStarCount",
                                          "user_id", "total_reviews", "total_upvotes", "review_upvote")
    assert rows(out) == [(100, 2, 0, 9, 4, 3, 0, 0), (101, 2, 0, 9, None, 0, 0, 0)]


def test_csv_round_trip_quotes_newlines_bom(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", text\nsecond line'), (2, "NA"), (3, None), (4, "  padded ")],
                               "id bigint, text string")
    path = csvio.write_csv(df.coalesce(1), str(tmp_path / "out"))
    back = csvio.read_csv(spark, path, df.schema)
    first = next((tmp_path / "out").glob("part-*")).read_bytes()
    assert first.startswith(b"\xef\xbb\xbf" + df.columns[0].encode() + b",")
    plain = csvio.write_csv(df.coalesce(1), str(tmp_path / "plain"), bom=False)
    assert next((tmp_path / "plain").glob("part-*")).read_bytes() == first[3:]
    assert rows(csvio.read_csv(spark, plain, df.schema)) == rows(back)
    assert rows(back) == rows(df)
    bom = tmp_path / "bom.csv"
    bom.write_bytes("﻿id,text\n1,x\n2,NA\n".encode("utf-8"))
    got = rows(csvio.read_csv(spark, str(bom), df.schema, na_values="NA"))
    assert got == [(1, "x"), (2, None)]


def test_failed_and_empty_category_responses(spark):
    from martlake.sources import payloads as P
    menu = P.parse(spark.createDataFrame(
        [('{"menu_block":{"items":[{"link":"https://x/c1","text":"G"}]}}',)], "raw string"), "raw", P.MENU)
    pages = P.parse(spark.createDataFrame([
        (1, '{"data":[{"id":10,"name":"m"},{"id":11,"name":"n"},{"id":12,"name":"o"}]}'), (1, '{"data":[]}'),
        (10, "<html>502</html>"), (11, '{"data":[]}'), (12, '{"data":[{"id":20,"name":"c"}]}'), (12, '{"data":[]}'),
        (20, '{"data":[{"id":30,"name":"s"}]}')], "parent_id bigint, raw string"), "raw", P.CATEGORY_PAGE)
    got = {(r.MasterCategoryID, r.CategoryID, r.SubCategoryID) for r in P.flatten_category_tree(menu, pages, ["1"]).collect()}
    assert got == {(11, None, None), (12, 20, 30)}
