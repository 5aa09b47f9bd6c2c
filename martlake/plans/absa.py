"""Review-text flow: dedup -> clean -> meaningful filter -> aspects -> sentiment
-> nested result per review."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.functions.exprs import let, select_where
from martlake.functions.text import clean_text, is_blank, is_meaningful, surely_too_long
from martlake.operators import absa as X
from martlake.operators.order import SEQ, keep_first


def meaningful_reviews(reviews: DataFrame, id_col: str = "GeneralFeedbackID", text_col: str = "Content") -> DataFrame:
    """First row per review id, text cleaned, junk and blank texts dropped.

    Cleaning and the junk test are per-row functions, so they run before the
    first-row-per-id shuffle, and a junk text is replaced by null there: the
    shuffle carries only short meaningful texts (at most 200 characters after
    cleaning) instead of whole raw lines, and a text that is too long by its letters alone is not cleaned at
    all. The first row is still chosen among
    all rows of an id; if its text is junk the id is dropped, as before."""
    keep = lambda t: is_meaningful(t) & ~is_blank(t)
    if SEQ not in reviews.columns:
        cleaned = F.when(~surely_too_long(text_col), clean_text(text_col))
        cols = {c: (cleaned if c == text_col else F.col(c)) for c in reviews.columns}
        return select_where(reviews, cols, lambda x: keep(x[text_col]))
    text = let(F.when(~surely_too_long(text_col), clean_text(text_col)), lambda t: F.when(keep(t), t))
    r = reviews.select(*[text.alias(c) if c == text_col else F.col(c) for c in reviews.columns])
    first = keep_first(r, [id_col], [F.col(SEQ)])
    return first.filter(F.col(text_col).isNotNull()).drop(SEQ)


def aspect_responses(reviews: DataFrame, extractor: Callable[[pd.DataFrame], pd.Series] | None = None) -> DataFrame:
    """(GeneralFeedbackID, ID, response text); default = lexicon extractor."""
    if extractor is None:
        return X.lexicon_aspects(reviews)
    return X.batch_aspects(reviews, extractor)


def parse_responses(responses: DataFrame) -> DataFrame:
    """Recovered documents; failures (null) are dropped. Columns of the schema."""
    docs = F.filter(F.array(X.recover_json(F.col("response"))), lambda d: d.isNotNull())
    return responses.select(F.inline(docs))


def scored_terms(parsed: DataFrame, scorer: Callable[[pd.Series], pd.DataFrame] | None = None) -> DataFrame:
    """Exploded (review, aspect, term) rows with context, label probabilities,
    dominant label/score and polarity; empty aspects keep null sentiment."""
    e = X.explode_aspects(parsed)
    has = F.col("AspectTerms").isNotNull()
    e = e.withColumn("Context", F.when(has, X.context_window("Content", "AspectTerms")))
    if scorer is None:
        e = e.withColumn("scores", F.when(has, X.lexicon_scores(F.col("Context"))))
    else:
        e = X.batch_scores(e, "Context", scorer).withColumn("scores", F.when(has, F.col("scores")))
    e = e.withColumn("_s", F.when(has, X.sentiment(F.col("scores"))))
    return e.select("*", "_s.DominantLabel", "_s.DominantScore", "_s.Polarity").drop("_s")


def nest_scored(parsed: DataFrame) -> DataFrame:
    """One row per review with its scored aspects in input order (the JSON result), by the default
    scorer inside the array. :func:`nest` does the same for rows that a batch scorer has scored."""
    return parsed.select("GeneralFeedbackID", "ID", "Content", X.score_aspects(F.col("Aspects"), F.col("Content")).alias("Aspects"))


def nest(scored: DataFrame) -> DataFrame:
    """One row per review with its aspects in input order (the JSON result)."""
    item = F.struct("apos", "tpos", "AspectCategory", "AspectTerms", "Polarity", "DominantScore")
    g = scored.groupBy("GeneralFeedbackID", "ID", "Content").agg(F.sort_array(F.collect_list(item)).alias("_a"))
    aspects = F.transform(F.filter("_a", lambda a: a["apos"].isNotNull()), lambda a: F.struct(a["AspectCategory"].alias("AspectCategory"),
                                                   a["AspectTerms"].alias("AspectTerms"),
                                                   a["Polarity"].alias("Polarity"),
                                                   a["DominantScore"].alias("DominantScore")))
    return g.select("GeneralFeedbackID", "ID", "Content", aspects.alias("Aspects"))


def sentiment_distribution(scored: DataFrame) -> DataFrame:
    """Aspect-term count per polarity (empty aspects are not counted)."""
    # Polarity is null exactly when the aspect has no term; test the cheap column.
    return (scored.filter(F.col("AspectTerms").isNotNull())
                  .groupBy("Polarity").agg(F.count(F.lit(1)).cast("bigint").alias("Aspects")))


def aspects_json(nested: DataFrame) -> DataFrame:
    """The nested result with ``Aspects`` as the JSON text the sink writes
    (null fields kept, so every aspect object has the same four keys)."""
    return nested.select("GeneralFeedbackID", "ID", "Content",
                         F.to_json("Aspects", {"ignoreNullFields": "false"}).alias("Aspects"))


#: The nested result's columns, as its sink writes and a reader expects them.
NESTED = ("GeneralFeedbackID bigint, ID bigint, Content string, Aspects array<struct<AspectCategory:string, "
          "AspectTerms:string, Polarity:string, DominantScore:double>>")


def write_nested_json(nested: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Result sink: newline-delimited JSON, one review per line, null fields kept."""
    nested.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_nested_json(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_nested_json` wrote."""
    return spark.read.schema(NESTED).json(path)
