"""Oracle SQL for text cleaning and ABSA (DuckDB, RE2 regex).

RE2 has no lookaround, so the phone rule consumes its boundary characters and
is applied twice (a phone right after another one is found on the second pass).
"""

from martlake.operators.absa import ASPECT_LEXICON, NEGATIVE_WORDS, NEUTRAL_BIAS, POSITIVE_WORDS
from martlake.sources.bindings import REVIEW_TEXT_SQL, with_bindings

SP = r"\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\p{Z}"
W = r"\p{L}\p{N}_"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _phone(x: str) -> str:
    plus = rf"'([{W}])\+84\p{{Nd}}{{9,10}}([^{W}]|$)'"
    plain = rf"'(^|[^{W}])(?:84|0)\p{{Nd}}{{9,10}}([^{W}]|$)'"
    for _ in range(2):
        x = f"regexp_replace({x}, {plus}, '\\1[PHONE]\\2', 'g')"
    for _ in range(2):
        x = f"regexp_replace({x}, {plain}, '\\1[PHONE]\\2', 'g')"
    return x


def _clean(x: str) -> str:
    x = rf"regexp_replace({x}, 'https?://[^{SP}]+|www\.[^{SP}]+', '', 'g')"
    x = rf"regexp_replace({x}, '<[^\n>]*>', '', 'g')"
    x = rf"regexp_replace({x}, '#[{W}]+', '', 'g')"
    x = _phone(x)
    x = rf"regexp_replace({x}, '[^a-zA-Z0-9{SP}\x{{C0}}-\x{{1EF9}}.,!?]', '', 'g')"
    x = rf"trim(regexp_replace({x}, '[{SP}]+', ' ', 'g'))"
    return f"lower({x})"


def _count(ctx: str, words) -> str:
    return " + ".join(f"(length({ctx}) - length(replace({ctx}, {_lit(w)}, ''))) / {len(w)}" for w in words)


_CATS = list(ASPECT_LEXICON)
_TERM_LISTS = {c: "[" + ", ".join(_lit(t) for t in ts) + "]" for c, ts in ASPECT_LEXICON.items()}

_BASE = rf"""
rt AS (SELECT * FROM review_text),
cl AS (SELECT GeneralFeedbackID, ID, {_clean('Content')} AS Content FROM rt),
mc AS (SELECT *, regexp_replace(lower(Content), '[^{W}{SP}]', '', 'g') AS c FROM cl),
mf AS (
  SELECT GeneralFeedbackID, ID, Content FROM mc
  WHERE length(c) BETWEEN 2 AND 200
    AND NOT regexp_matches(c, '[bcdfghjklmnpqrstvwxyz]{{5,}}')
    AND list_max(list_transform(string_split(c, ''), lambda x: length(c) - length(replace(c, x, '')))) <= length(c) * 0.5
    AND NOT list_contains(list_transform(range(2, 6), lambda L:
          list_contains(list_transform(range(1, length(c) - 2 * L + 1),
                                       lambda i: substr(c, i, L) = substr(c, i + L, L)), true)), true)
    AND length(regexp_replace(Content, '[{SP}]+', '', 'g')) > 0),
asp AS (
  {" UNION ALL ".join(
      f"SELECT GeneralFeedbackID, ID, Content, {i} AS apos, {_lit(c)} AS AspectCategory, "
      f"list_filter({_TERM_LISTS[c]}, lambda t: contains(Content, t)) AS terms FROM mf"
      for i, c in enumerate(_CATS))}),
ex AS (
  SELECT GeneralFeedbackID, ID, Content, apos, AspectCategory,
         unnest(CASE WHEN len(terms) = 0 THEN [NULL::VARCHAR] ELSE terms END) AS AspectTerms
  FROM asp),
cx AS (
  SELECT *, CASE WHEN AspectTerms IS NULL THEN NULL
                 WHEN least(length(Content), instr(Content, AspectTerms) - 1 + length(AspectTerms) + 20)
                      > greatest(0, instr(Content, AspectTerms) - 1 - 20)
                 THEN substr(Content, greatest(0, instr(Content, AspectTerms) - 1 - 20) + 1,
                             least(length(Content), instr(Content, AspectTerms) - 1 + length(AspectTerms) + 20)
                             - greatest(0, instr(Content, AspectTerms) - 1 - 20))
                 ELSE '' END AS Context
  FROM ex),
lg AS (
  SELECT *, {_count('Context', NEGATIVE_WORDS)} AS ln, {_count('Context', POSITIVE_WORDS)} AS lp,
         {NEUTRAL_BIAS} AS lu FROM cx),
pr AS (
  SELECT *, exp(ln - greatest(ln, lp, lu)) AS en, exp(lp - greatest(ln, lp, lu)) AS ep,
         exp(lu - greatest(ln, lp, lu)) AS eu FROM lg),
sc AS (
  SELECT *, CASE WHEN AspectTerms IS NULL THEN NULL ELSE en / (en + ep + eu) END AS Negative,
            CASE WHEN AspectTerms IS NULL THEN NULL ELSE ep / (en + ep + eu) END AS Positive,
            CASE WHEN AspectTerms IS NULL THEN NULL ELSE eu / (en + ep + eu) END AS Neutral
  FROM pr),
dm AS (
  SELECT *, CASE WHEN AspectTerms IS NULL THEN NULL
                 WHEN Negative >= Positive AND Negative >= Neutral THEN 'Negative'
                 WHEN Positive >= Neutral THEN 'Positive' ELSE 'Neutral' END AS DominantLabel
  FROM sc),
pl AS (
  SELECT *, round(CASE DominantLabel WHEN 'Negative' THEN Negative WHEN 'Positive' THEN Positive
                                     WHEN 'Neutral' THEN Neutral END, 3) AS DominantScore,
         CASE WHEN DominantLabel IS NULL THEN NULL
              ELSE coalesce(CASE lower(DominantLabel) WHEN 'negative' THEN 'NEG' WHEN 'positive' THEN 'POS'
                                                      WHEN 'neutral' THEN 'NEU' END, 'NEU') END AS Polarity
  FROM dm)
"""

_W = with_bindings(REVIEW_TEXT_SQL, _BASE)

SQL = {
    "clean_text": _W + "SELECT GeneralFeedbackID, Content FROM cl",
    "mask_phone": _W.replace("cl AS (", "ph AS (SELECT GeneralFeedbackID, " + _phone("Content")
                             + " AS Content FROM rt),\ncl AS (", 1) + "SELECT GeneralFeedbackID, Content FROM ph",
    "meaningful_text": _W + "SELECT GeneralFeedbackID, ID, Content FROM mf",
    "recover_json": _W + r"""
SELECT GeneralFeedbackID, NOT (GeneralFeedbackID % 3 <> 1 AND GeneralFeedbackID % 7 = 0) AS Recovered,
       CASE WHEN GeneralFeedbackID % 3 <> 1 AND GeneralFeedbackID % 7 = 0 THEN NULL
            ELSE CAST(""" + str(len(_CATS)) + r""" AS BIGINT) END AS Aspects
FROM mf""",
    "aspect_terms": _W + """
SELECT GeneralFeedbackID, AspectCategory, CAST(len(terms) AS BIGINT) AS NTerms,
       array_to_string(terms, '|') AS Terms FROM asp""",
    "aspect_explode": _W + "SELECT GeneralFeedbackID, AspectCategory, AspectTerms FROM ex",
    "context_window": _W + "SELECT GeneralFeedbackID, AspectCategory, AspectTerms, Context FROM cx",
    "score_context": _W + """
SELECT GeneralFeedbackID, AspectCategory, AspectTerms, round(Negative, 6) AS Negative,
       round(Positive, 6) AS Positive, round(Neutral, 6) AS Neutral FROM sc""",
    "dominant_sentiment": _W + """
SELECT GeneralFeedbackID, AspectCategory, AspectTerms, DominantLabel, DominantScore FROM pl""",
    "polarity": _W + "SELECT GeneralFeedbackID, AspectCategory, AspectTerms, Polarity FROM pl",
    "absa_nested": _W.replace(
        "unnest(CASE WHEN len(terms) = 0 THEN [NULL::VARCHAR] ELSE terms END) AS AspectTerms",
        "unnest(CASE WHEN len(terms) = 0 THEN [NULL::VARCHAR] ELSE terms END) AS AspectTerms,\n"
        "         unnest(range(greatest(len(terms), 1))) AS tpos", 1) + """
SELECT GeneralFeedbackID, ID, Content,
       CAST(to_json(list(struct_pack(AspectCategory := AspectCategory, AspectTerms := AspectTerms,
                                     Polarity := Polarity, DominantScore := DominantScore)
                         ORDER BY apos, tpos)) AS VARCHAR) AS Aspects
FROM pl GROUP BY GeneralFeedbackID, ID, Content""",
    "sentiment_distribution": _W + """
SELECT Polarity, count(*) AS Aspects FROM pl WHERE Polarity IS NOT NULL GROUP BY Polarity""",
}

# A flaky extractor by row id: refused, cut off, answered on the second call, or answered at once.
_FLAKY = _W + """,
k AS (SELECT *, (GeneralFeedbackID // 4) % 1000 + ID AS k FROM mf),
oc AS (SELECT *, CASE WHEN k % 11 = 0 THEN 'RuntimeError: model refused'
                      WHEN k % 5 = 0 THEN 'unreadable response' END AS Error,
              CASE WHEN k % 11 = 0 THEN 3 WHEN k % 7 = 0 THEN 2 ELSE 1 END AS Attempts FROM k)
"""
SQL["extraction_results"] = _FLAKY + """
SELECT a.GeneralFeedbackID, a.ID, a.AspectCategory, array_to_string(terms, '|') AS Terms
FROM asp a JOIN oc ON a.GeneralFeedbackID = oc.GeneralFeedbackID WHERE Error IS NULL"""
SQL["extraction_failures"] = _FLAKY + """
SELECT GeneralFeedbackID, ID, Error, CAST(Attempts AS BIGINT) AS Attempts FROM oc WHERE Error IS NOT NULL"""
SQL["extraction_counts"] = _FLAKY + """
SELECT 'extraction' AS stage, count(*) AS "rows" FROM oc
UNION ALL SELECT 'extraction.accepted', count(*) FROM oc WHERE Error IS NULL
UNION ALL SELECT 'extraction.rejected', count(*) FROM oc WHERE Error IS NOT NULL"""
SQL["model_score_context"] = SQL["score_context"] + " WHERE AspectTerms IS NOT NULL"
SQL["absa_json_roundtrip"] = SQL["absa_nested"].partition("SELECT GeneralFeedbackID, ID, Content,\n       CAST(to_json")[0] + """
SELECT GeneralFeedbackID, ID, Content, CAST(row_number() OVER (PARTITION BY GeneralFeedbackID ORDER BY apos, tpos) - 1 AS INT) AS Position,
       AspectCategory, AspectTerms, Polarity, DominantScore FROM pl"""
