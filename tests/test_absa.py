"""Aspect JSON recovery, explode, context window, dominant label, polarity,
custom batch extractor/scorer and re-nesting (FIXTURES §C)."""

import json

import pandas as pd
from pyspark.sql import functions as F

from conftest import rows
from martlake.operators import absa as X
from martlake.plans import absa as ab


def _doc(gid, aspects):
    return json.dumps({"GeneralFeedbackID": gid, "ID": gid, "Content": "giao hàng nhanh, sản phẩm tốt",
                       "Aspects": aspects}, ensure_ascii=False)


def test_recover_json(spark):
    good = _doc(1, [{"AspectCategory": "A", "AspectTerms": ["x"]}])
    cases = [(1, good), (2, "Kết quả:\n" + _doc(2, []) + "\nHết."), (3, "không có json"), (4, good[:20]), (5, None)]
    df = spark.createDataFrame(cases, "k int, r string")
    got = {r["k"]: r["g"] for r in df.select("k", X.recover_json(F.col("r"))["GeneralFeedbackID"].alias("g")).collect()}
    assert got == {1: 1, 2: 2, 3: None, 4: None, 5: None}


def test_explode_and_context(spark):
    aspects = [{"AspectCategory": "A", "AspectTerms": '["giao hàng", "thiếu"]'},
               {"AspectCategory": "B", "AspectTerms": "[]"},
               {"AspectCategory": "C", "AspectTerms": "sản phẩm"}]
    parsed = ab.parse_responses(spark.createDataFrame([(1, 1, _doc(1, aspects))], "GeneralFeedbackID bigint, ID bigint, response string"))
    e = X.explode_aspects(parsed)
    e = e.withColumn("ctx", X.context_window("Content", "AspectTerms"))
    got = [(r["AspectCategory"], r["AspectTerms"], r["ctx"]) for r in e.orderBy("apos", "tpos").collect()]
    text = "giao hàng nhanh, sản phẩm tốt"
    assert got == [("A", "giao hàng", text[0:29]), ("A", "thiếu", text[0:min(len(text), -1 + 5 + 20)]),
                   ("B", None, None), ("C", "sản phẩm", text[max(0, 17 - 20):min(len(text), 17 + 8 + 20)])]


def test_dominant_and_polarity(spark):
    df = spark.createDataFrame([(0.4, 0.4, 0.2), (0.2, 0.4, 0.4), (1 / 3, 1 / 3, 1 / 3), (0.1, 0.2, 0.7)],
                               "Negative double, Positive double, Neutral double")
    label, score = X.dominant(F.struct("Negative", "Positive", "Neutral"))
    got = [tuple(r) for r in df.select(label, score).collect()]
    assert got == [("Negative", 0.4), ("Positive", 0.4), ("Negative", 0.333), ("Neutral", 0.7)]
    lab = spark.createDataFrame([("Positive",), ("NEGATIVE",), ("neutral",), ("other",), (None,)], "l string")
    assert [r[0] for r in lab.select(X.polarity(F.col("l"))).collect()] == ["POS", "NEG", "NEU", "NEU", "NEU"]


def test_custom_extractor_scorer_and_nest(spark):
    reviews = spark.createDataFrame([(1, 1, "hàng tốt giao chậm"), (2, 2, "bình thường")],
                                    "GeneralFeedbackID bigint, ID bigint, Content string")

    def extractor(b: pd.DataFrame) -> pd.Series:
        out = []
        for g, i, c in zip(b["GeneralFeedbackID"], b["ID"], b["Content"]):
            if g == 2:
                out.append("model error")           # failure -> dropped
            else:
                out.append(json.dumps({"GeneralFeedbackID": int(g), "ID": int(i), "Content": c, "Aspects": [
                    {"AspectCategory": "P", "AspectTerms": '["hàng"]'},
                    {"AspectCategory": "S", "AspectTerms": "giao"}]}))
        return pd.Series(out)

    def scorer(ctx: pd.Series) -> pd.DataFrame:
        neg = ctx.str.contains("chậm").astype(float)
        return pd.DataFrame({"Negative": neg, "Positive": 1 - neg, "Neutral": 0.0})

    parsed = ab.parse_responses(ab.aspect_responses(reviews, extractor))
    scored = ab.scored_terms(parsed, scorer)
    nested = ab.nest(scored).collect()
    assert len(nested) == 1
    a = [(x["AspectCategory"], x["AspectTerms"], x["Polarity"]) for x in nested[0]["Aspects"]]
    assert a == [("P", "hàng", "NEG"), ("S", "giao", "NEG")]   # both contexts reach "chậm"
    assert rows(ab.sentiment_distribution(scored)) == [("NEG", 2)]


def test_meaningful_reviews_first_row_per_id(spark):
    r = spark.createDataFrame([(1, 1, "Hàng TỐT lắm", 2), (1, 9, "aaaaaa", 1), (2, 2, "zzzzzz", 3), (3, 3, "   ", 4)],
                              "GeneralFeedbackID bigint, ID bigint, Content string, _seq bigint")
    assert rows(ab.meaningful_reviews(r)) == []          # id 1 keeps its first row (junk), others junk/blank
    r2 = r.withColumn("_seq", F.when(F.col("ID") == 1, 0).otherwise(F.col("_seq")))
    assert rows(ab.meaningful_reviews(r2)) == [(1, 1, "hàng tốt lắm")]


def test_nested_json_sink_round_trip(spark, tmp_path):
    reviews = spark.createDataFrame([(1, 1, "sản phẩm tốt, giao hàng chậm")],
                                    "GeneralFeedbackID bigint, ID bigint, Content string")
    nested = ab.nest(ab.scored_terms(ab.parse_responses(ab.aspect_responses(reviews))))
    path = str(tmp_path / "absa")
    ab.write_nested_json(nested, path)
    back = spark.read.schema(nested.schema).json(path).collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in nested.collect()]
    text = ab.aspects_json(nested).collect()[0]["Aspects"]
    assert json.loads(text)[0]["AspectCategory"] == X.PRODUCT_ASPECT


def test_review_without_aspects_and_list_like_term(spark):
    df = spark.createDataFrame([(1, 1, "abc", []), (2, 1, "[x] is fine", [("Quality", "[x")])],
                               "GeneralFeedbackID bigint, ID bigint, Content string, Aspects array<struct<AspectCategory:string,AspectTerms:string>>")
    got = {r.GeneralFeedbackID: r.Aspects for r in ab.nest(ab.scored_terms(df)).collect()}
    assert got[1] == [] and [a.AspectTerms for a in got[2]] == ["[x"]


def test_outcomes_keep_every_row(spark, tmp_path):
    """Rows at fault stand alone, others of their batch are answered; retries ask failed rows only."""
    from martlake.operators.metrics import RunMetrics
    answer = _doc(0, [])

    def load():
        seen = set()

        def extract(batch):
            new, out = set(), []
            for i in batch["GeneralFeedbackID"]:
                if i == 3:
                    raise KeyError("three")
                if i == 4 and i not in seen:
                    new.add(i)
                    out.append(None)
                else:
                    out.append({5: "no json", 6: None}.get(i, answer.replace('"ID": 0', f'"ID": {i}')))
            seen.update(new)
            return pd.Series(out, dtype=object)
        return extract

    r = spark.createDataFrame([(i, i, "text") for i in range(1, 9)], "GeneralFeedbackID bigint, ID bigint, Content string").coalesce(1)
    m = RunMetrics()
    good, bad = X.settle_outcomes(X.batch_outcomes(r, load), str(tmp_path / "o"), m)
    assert [x[0] for x in rows(good.select("ID"))] == [1, 2, 4, 7, 8]
    assert rows(bad.select("GeneralFeedbackID", "error", "attempts")) == [
        (3, "KeyError: 'three'", 3), (5, X.UNREADABLE, 1), (6, X.NO_RESPONSE, 3)]
    assert m.counts() == {"extraction": 8, "extraction.accepted": 5, "extraction.rejected": 3}
    short = X.batch_outcomes(r, lambda: lambda b: pd.Series([], dtype=object), attempts=1)
    assert {x["error"] for x in short.collect()} == {"ValueError: 0 responses for 1 rows"}
    assert X.batch_outcomes(r.limit(0), load).collect() == []


def test_a_model_is_loaded_once_per_worker(spark, tmp_path):
    import os
    folder = str(tmp_path)

    def load():
        import uuid
        open(os.path.join(folder, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return X.LexiconScorer()

    df = spark.range(4000).selectExpr("id", "concat('good bad ', id) AS ctx").repartition(16)
    for _ in range(2):  # two jobs of 16 tasks each
        got = X.model_scores(df, "ctx", load, "test-model").select("scores.*").distinct().collect()
        assert len(got) == 1 and abs(sum(got[0]) - 1) < 1e-9
    loads = [x.partition("-")[0] for x in os.listdir(folder)]
    assert len(loads) == len(set(loads)) <= 8


def test_scores_in_the_array_are_those_of_exploded_rows(spark):
    docs = [(i, i, _doc(i, a)) for i, a in enumerate([
        [], None, [{"AspectCategory": "A", "AspectTerms": '["giao hàng", "thiếu"]'}, {"AspectCategory": "B", "AspectTerms": "[]"},
                   {"AspectCategory": None, "AspectTerms": "sản phẩm"}], [{"AspectCategory": "C", "AspectTerms": "[not a list"}],
        [{"AspectCategory": "D", "AspectTerms": None}]])]
    parsed = ab.parse_responses(spark.createDataFrame(docs, "GeneralFeedbackID bigint, ID bigint, response string"))
    assert rows(ab.nest_scored(parsed)) == rows(ab.nest(ab.scored_terms(parsed)))
    assert rows(ab.nest_scored(parsed)) == rows(ab.nest(ab.scored_terms(parsed, X.LexiconScorer())))
