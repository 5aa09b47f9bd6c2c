"""Aspect-based sentiment operators.

The reference calls a language model per review (aspects) and a neural
classifier per aspect term (sentiment). Here both are pluggable:

* the default aspect extractor is a small fixed lexicon (category -> terms)
  matched per row with array expressions, emitting the same JSON document a
  model would return;
* the default scorer counts positive/negative lexicon words in the context and
  turns the counts into probabilities with a softmax, all native expressions;
* a custom extractor or scorer is a pandas batch function run with
  ``mapInPandas`` (Arrow batches, loaded once per Python worker where it has a key), never per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from martlake.functions.exprs import let
from martlake.operators.metrics import RunMetrics
from martlake.operators.quality import split_sink

# The shipped default lexicons (lower case, matched as substrings
# of the cleaned text). Aspect categories are the two the reference asks for.
PRODUCT_ASPECT = "Về Sản Phẩm"
SERVICE_ASPECT = "Về Dịch Vụ"
ASPECT_LEXICON = {
    PRODUCT_ASPECT: ["sản phẩm", "chất lượng", "giá", "màu", "product", "quality", "price", "size", "color",
                     "material", "design", "thing", "produit", "qualité", "prix", "produkt", "qualität",
                     "preis", "producto", "calidad", "precio"],
    SERVICE_ASPECT: ["giao hàng", "dịch vụ", "đóng gói", "shop", "delivery", "shipping", "service", "support",
                     "seller", "work", "livraison", "vendeur", "lieferung", "verkäufer", "envío", "vendedor"],
}
POSITIVE_WORDS = ["tốt", "đẹp", "hài lòng", "good", "great", "best", "excellent", "love", "nice", "bon", "bien",
                  "gut", "bueno", "excelente"]
NEGATIVE_WORDS = ["tệ", "kém", "chậm", "bad", "poor", "worst", "terrible", "broken", "late", "mauvais",
                  "schlecht", "malo"]
NEUTRAL_BIAS = 0.5          # logit of Neutral; Negative/Positive logits are word counts
CONTEXT_CHARS = 20
LABELS = ("Negative", "Positive", "Neutral")  # tie order of the dominant label
POLARITY = {"negative": "NEG", "positive": "POS", "neutral": "NEU"}

ASPECT_SCHEMA = StructType([
    StructField("GeneralFeedbackID", LongType()),
    StructField("ID", LongType()),
    StructField("Content", StringType()),
    # AspectTerms is read as text: a JSON list arrives as its JSON text, a bare
    # string as itself (see :func:`explode_aspects`).
    StructField("Aspects", ArrayType(StructType([
        StructField("AspectCategory", StringType()),
        StructField("AspectTerms", StringType()),
    ]))),
])


def lexicon_aspects(reviews: DataFrame, lexicon: dict[str, Sequence[str]] = ASPECT_LEXICON,
                    id_col: str = "GeneralFeedbackID", row_col: str = "ID",
                    text_col: str = "Content") -> DataFrame:
    """Default extractor: (id, row id, response JSON text) per review.

    The response lists every category with the lexicon terms found in the
    text (possibly none), in lexicon order, like the model's required format.
    Matching is a per-row expression over the fixed term arrays: no join, no
    shuffle, no grouping."""
    text = F.col(text_col)
    aspects = F.array(*[
        F.struct(F.lit(cat).alias("AspectCategory"),
                 F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.instr(text, t) > 0).alias("AspectTerms"))
        for cat, terms in lexicon.items()])
    doc = F.struct(F.col(id_col).alias("GeneralFeedbackID"), F.col(row_col).alias("ID"),
                   text.alias("Content"), aspects.alias("Aspects"))
    return reviews.select(id_col, row_col, F.to_json(doc).alias("response"))


def batch_aspects(reviews: DataFrame, extractor: Callable[[pd.DataFrame], pd.Series],
                  id_col: str = "GeneralFeedbackID", row_col: str = "ID", text_col: str = "Content") -> DataFrame:
    """Custom extractor: ``extractor(batch) -> Series of response text`` (None
    on failure), applied per Arrow batch with ``mapInPandas``. An exception ends the job;
    :func:`batch_outcomes` keeps it beside its row instead."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({id_col: b[id_col], row_col: b[row_col],
                                "response": extractor(b).astype(object).values})
    schema = f"{id_col} bigint, {row_col} bigint, response string"
    return reviews.select(id_col, row_col, text_col).mapInPandas(run, schema)


NO_RESPONSE = "no response"
UNREADABLE = "unreadable response"


def _try_rows(rows: pd.DataFrame, extractor: Callable[[pd.DataFrame], pd.Series]) -> list[tuple[str | None, str | None]]:
    """(response, error) per row. A batch that raises is halved until the rows at fault stand alone."""
    try:
        got = list(extractor(rows))
        if len(got) != len(rows):
            raise ValueError(f"{len(got)} responses for {len(rows)} rows")
    except Exception as e:  # noqa: BLE001 - whatever a user's extractor raises is that row's outcome
        if len(rows) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
        half = len(rows) // 2
        return _try_rows(rows.iloc[:half], extractor) + _try_rows(rows.iloc[half:], extractor)
    return [(None, NO_RESPONSE) if r is None or r != r else (str(r), None) for r in got]


def batch_outcomes(reviews: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.Series]], key: str | None = None,
                   attempts: int = 3, id_col: str = "GeneralFeedbackID", row_col: str = "ID",
                   text_col: str = "Content") -> DataFrame:
    """Custom extractor with an outcome for every row: (id, row id, response, error, attempts).

    ``load`` makes the extractor (:func:`per_worker`). Rows without a response, or at which it
    raises, are given to it again, up to ``attempts`` times; the other rows of their batch are not asked twice."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extractor = per_worker(key, load)
        for b in batches:
            got, tries = _try_rows(b, extractor), [1] * len(b)
            for n in range(2, attempts + 1):
                failed = [i for i, (_, error) in enumerate(got) if error]
                if not failed:
                    break
                for i, again in zip(failed, _try_rows(b.iloc[failed], extractor), strict=True):
                    got[i], tries[i] = again, n
            yield pd.DataFrame({id_col: b[id_col].values, row_col: b[row_col].values,
                                "response": pd.Series([g[0] for g in got], dtype=object),
                                "error": pd.Series([g[1] for g in got], dtype=object), "attempts": tries})
    schema = f"{id_col} bigint, {row_col} bigint, response string, error string, attempts int"
    return reviews.select(id_col, row_col, text_col).mapInPandas(run, schema)


def settle_outcomes(outcomes: DataFrame, path: str, metrics: RunMetrics | None = None, stage: str = "extraction"
                    ) -> tuple[DataFrame, DataFrame]:
    """Recover the document of every response and write all outcomes in one pass (:func:`split_sink`). Returns
    (results: the document's columns, failures: id, row id, error, attempts, response). A response from which no document
    can be recovered is a failure too."""
    doc = outcomes.withColumn("_doc", recover_json(F.col("response")))
    done = doc.withColumn("error", F.coalesce("error", F.when(F.col("_doc").isNull(), F.lit(UNREADABLE))))
    good, bad = split_sink(done, F.col("error").isNull(), path, metrics, stage)
    return good.select("_doc.*"), bad.drop("_doc")


_loaded: dict[str, object] = {}


def per_worker(key: str | None, load: Callable[[], object]) -> object:
    """What ``load`` returns. With a ``key`` it is called once in each Python worker, and what it returned is kept over
    batches, tasks and jobs (a model of gigabytes is not read per batch); without one, once per task."""
    if key is None:
        return load()
    if key not in _loaded:
        _loaded[key] = load()
    return _loaded[key]


def recover_json(response: Column, schema: StructType = ASPECT_SCHEMA, key: str = "GeneralFeedbackID") -> Column:
    """Parse the response; failing that, parse the text from the first '{' to
    the last '}'; failing that, null. Validity is decided by ``try_parse_json``
    (``from_json`` alone may return partial fields of a cut-off document) and
    the document must carry ``key``."""
    def parsed(text: Column, fallback: Column) -> Column:
        return let(F.from_json(text, schema),
                   lambda d: F.when(F.try_parse_json(text).isNotNull() & d[key].isNotNull(), d).otherwise(fallback))

    # The brace extraction sits in the fallback branch, so it runs only for
    # responses that do not parse as they are.
    return let(response, lambda r: parsed(r, let(F.regexp_extract(r, r"(?s)\{.*\}", 0),
                                                 lambda ext: parsed(ext, F.lit(None).cast(schema)))))


def normalize_terms(raw: Column) -> Column:
    """AspectTerms text -> array<string>: a JSON list -> its elements, a bare
    non-empty string (also one that only starts like a list) -> one term, null / '' / '[]' -> empty."""
    empty = F.array().cast("array<string>")
    return (F.when(raw.isNull() | (raw == ""), empty)
             .when(F.ltrim(raw).startswith("["), F.coalesce(F.from_json(raw, "array<string>"), F.array(raw)))
             .otherwise(F.array(raw)))


def explode_aspects(parsed: DataFrame) -> DataFrame:
    """One row per (review, aspect, term). An aspect with no terms keeps one row
    with a null term; a bare string is one term; a JSON list gives one row per
    element; a review without aspects keeps one row with a null ``apos``. ``apos``/``tpos`` keep the positions for re-nesting."""
    a = parsed.select("GeneralFeedbackID", "ID", "Content", F.posexplode_outer("Aspects").alias("apos", "aspect"))
    terms = normalize_terms(F.col("aspect.AspectTerms"))
    a = a.select("GeneralFeedbackID", "ID", "Content", "apos",
                 F.col("aspect.AspectCategory").alias("AspectCategory"), terms.alias("_terms"))
    return a.select("GeneralFeedbackID", "ID", "Content", "apos", "AspectCategory",
                    F.posexplode_outer("_terms").alias("tpos", "AspectTerms"))


def context_window(text, term, chars: int = CONTEXT_CHARS) -> Column:
    """``text[max(0, f-20) : min(len, f+len(term)+20)]`` with f = first index of
    the term (-1 when missing), using Python slice rules; null text or term -> null."""
    t, w = F.col(text) if isinstance(text, str) else text, F.col(term) if isinstance(term, str) else term
    f = F.instr(t, w) - 1
    start = F.greatest(F.lit(0), f - chars)
    end = F.least(F.length(t), f + F.length(w) + chars)
    window = F.when(end > start, F.substring(t, start + 1, end - start)).otherwise(F.lit(""))
    return F.when(t.isNotNull() & w.isNotNull(), window)  # greatest/least skip nulls


def _count_words(c: Column, words: Sequence[str]) -> Column:
    """Occurrences of all words in the text: one loop over a constant array, so the expression stays small."""
    once = lambda n, w: n + (F.length(c) - F.length(F.replace(c, w, F.lit("")))) / F.length(w)
    return F.aggregate(F.array(*[F.lit(w) for w in words]), F.lit(0.0), once)


def lexicon_scores(ctx: Column, positive: Sequence[str] = POSITIVE_WORDS,
                   negative: Sequence[str] = NEGATIVE_WORDS, neutral_bias: float = NEUTRAL_BIAS) -> Column:
    """Default scorer: struct(Negative, Positive, Neutral) probabilities. Every step is bound once."""
    counts = F.struct(_count_words(ctx, negative).alias("n"), _count_words(ctx, positive).alias("p"),
                      F.lit(float(neutral_bias)).alias("u"))

    def exps(k: Column) -> Column:
        return let(F.greatest(k["n"], k["p"], k["u"]), lambda m: F.struct(
            *[F.exp(k[f] - m).alias(f) for f in ("n", "p", "u")]))

    def shares(e: Column) -> Column:
        return let(e["n"] + e["p"] + e["u"], lambda s: F.struct(
            (e["n"] / s).alias("Negative"), (e["p"] / s).alias("Positive"), (e["u"] / s).alias("Neutral")))
    return let(let(counts, exps), shares)


def _score_batches(batches: Iterator[pd.DataFrame], ctx_col: str, scorer: Callable[[pd.Series], pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        s = scorer(b[ctx_col].fillna(""))
        b = b.copy()
        b["scores"] = s[list(LABELS)].to_dict("records")
        yield b


def _with_scores(df: DataFrame) -> StructType:
    return StructType(df.schema.fields + [StructField("scores", StructType([StructField(n, DoubleType()) for n in LABELS]))])


def batch_scores(df: DataFrame, ctx_col: str, scorer: Callable[[pd.Series], pd.DataFrame]) -> DataFrame:
    """Custom scorer: ``scorer(contexts) -> DataFrame[Negative, Positive, Neutral]``
    per Arrow batch (``mapInPandas``); adds a ``scores`` struct column."""
    return df.mapInPandas(lambda batches: _score_batches(batches, ctx_col, scorer), _with_scores(df))


def model_scores(df: DataFrame, ctx_col: str, load: Callable[[], Callable[[pd.Series], pd.DataFrame]], key: str) -> DataFrame:
    """:func:`batch_scores` with a scorer that must be loaded: ``load`` runs once in each Python worker (:func:`per_worker`)
    and never on the driver, so neither the plan nor a task carries the model."""
    return df.mapInPandas(lambda batches: _score_batches(batches, ctx_col, per_worker(key, load)), _with_scores(df))


class LexiconScorer:
    """The default scorer for batches: word counts and their softmax in numpy."""

    def __init__(self, positive: Sequence[str] = POSITIVE_WORDS, negative: Sequence[str] = NEGATIVE_WORDS,
                 neutral_bias: float = NEUTRAL_BIAS):
        self.words, self.bias = (list(negative), list(positive)), float(neutral_bias)

    def __call__(self, contexts: pd.Series) -> pd.DataFrame:
        logits = np.full((len(contexts), 3), self.bias)
        for k, words in enumerate(self.words):
            logits[:, k] = [sum(map(t.count, words)) for t in contexts]
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return pd.DataFrame(e / e.sum(axis=1, keepdims=True), columns=list(LABELS))


def sentiment(scores: Column) -> Column:
    """struct(DominantLabel, DominantScore, Polarity) of a score struct, each step bound once; null scores -> null."""
    def named(s: Column) -> Column:
        label, score = dominant(s)
        return F.when(s.isNotNull(), let(label, lambda x: F.struct(
            x.alias("DominantLabel"), score.alias("DominantScore"), polarity(x).alias("Polarity"))))
    return let(scores, named)


def score_aspects(aspects: Column, text: Column) -> Column:
    """The scored aspects of a review inside its array: one element (AspectCategory, AspectTerms, Polarity, DominantScore)
    per term, in input order, an aspect without terms keeping one with a null term and no sentiment; null -> empty. No
    row is exploded or regrouped, so the text is not shuffled."""
    def item(category: Column, term: Column) -> Column:
        scored = F.when(term.isNotNull(), sentiment(lexicon_scores(context_window(text, term))))
        return let(scored, lambda s: F.struct(category.alias("AspectCategory"), term.alias("AspectTerms"),
                                              s["Polarity"].alias("Polarity"), s["DominantScore"].alias("DominantScore")))

    def per_aspect(a: Column) -> Column:
        none = F.array(F.lit(None).cast("string"))
        terms = let(normalize_terms(a["AspectTerms"]), lambda t: F.when(F.size(t) > 0, t).otherwise(none))
        return F.transform(terms, lambda t: item(a["AspectCategory"], t))

    empty = F.array().cast("array<struct<AspectCategory:string,AspectTerms:string,Polarity:string,DominantScore:double>>")
    return F.coalesce(F.flatten(F.transform(aspects, per_aspect)), empty)


def dominant(scores: Column) -> tuple[Column, Column]:
    """(label, rounded score): argmax with ties going to Negative, then Positive."""
    n, p, u = scores["Negative"], scores["Positive"], scores["Neutral"]
    label = F.when((n >= p) & (n >= u), F.lit("Negative")).when(p >= u, F.lit("Positive")).otherwise(F.lit("Neutral"))
    score = F.when(label == "Negative", n).when(label == "Positive", p).otherwise(u)
    return label, F.round(score, 3)


def polarity(label: Column) -> Column:
    """negative/positive/neutral (any case) -> NEG/POS/NEU; anything else NEU."""
    m = F.create_map(*[x for k, v in POLARITY.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[F.lower(label)], F.lit("NEU"))
