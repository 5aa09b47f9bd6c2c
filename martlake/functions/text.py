"""Review-text cleaning and the "meaningful text" predicate as native Spark
expressions (Java regex inside whole-stage codegen; no Python UDF).

The character classes reproduce Python ``re`` semantics for ``str`` patterns:
Python's ``\\s`` is Unicode whitespace and ``\\w`` is Unicode letters/digits/_,
while Java's are ASCII, so both are spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlake.functions.exprs import col, let

# Character classes and patterns of the cleaning rules.
SPACE = r"\s\x1c-\x1f\x85\p{Z}"                 # Python \s over the BMP
WORD = r"\p{L}\p{N}_"                            # Python \w (no combining marks)
URL_RE = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
TAG_RE = r"<[^\n>]*>"                            # '<.*?>' where '.' stops only at '\n'
HASHTAG_RE = rf"#[{WORD}]+"
PHONE_RE = (rf"(?:(?<=[{WORD}])\+84|(?<![{WORD}])(?:84|0))\p{{Nd}}{{9,10}}(?![{WORD}])")
PHONE_TOKEN = "[PHONE]"
KEEP_RE = rf"[^a-zA-Z0-9{SPACE}À-ỹ.,!?]"  # everything outside is removed
NON_WORD_RE = rf"[^{WORD}{SPACE}]"
CONSONANT_RUN_RE = "[bcdfghjklmnpqrstvwxyz]{5,}"
REPEAT_RE = r"(?s)(.{2,5})\1."                  # a repeat must be followed by one more char
MIN_LEN, MAX_LEN, MAX_REPEAT_RATIO = 2, 200, 0.5


def remove_urls(c) -> Column:
    return F.regexp_replace(col(c), URL_RE, "")


def remove_tags(c) -> Column:
    return F.regexp_replace(col(c), TAG_RE, "")


def remove_hashtags(c) -> Column:
    return F.regexp_replace(col(c), HASHTAG_RE, "")


def mask_phones(c, token: str = PHONE_TOKEN) -> Column:
    """Vietnamese mobile numbers (0 / 84 / +84 then 9-10 digits, as whole words)."""
    return F.regexp_replace(col(c), PHONE_RE, token.replace("\\", "\\\\").replace("$", "\\$"))


def keep_allowed_chars(c) -> Column:
    """Keep ASCII letters/digits, whitespace, U+00C0..U+1EF9 and . , ! ?"""
    return F.regexp_replace(col(c), KEEP_RE, "")


def collapse_spaces(c) -> Column:
    return F.trim(F.regexp_replace(col(c), rf"[{SPACE}]+", " "))


def clean_text(c) -> Column:
    """URLs, tags, hashtags removed; phones masked; disallowed characters removed
    (which also strips the brackets of the phone token); spaces collapsed;
    lower-cased. Emoji naming after this step is a no-op (no emoji survive)."""
    x = remove_urls(c)
    x = remove_tags(x)
    x = remove_hashtags(x)
    x = mask_phones(x)
    x = keep_allowed_chars(x)
    x = collapse_spaces(x)
    return F.lower(x)


def _max_char_count(c: Column) -> Column:
    chars = F.array_distinct(F.split(c, ""))
    return F.array_max(F.transform(chars, lambda ch: F.length(c) - F.length(F.replace(c, ch, F.lit("")))))


def is_meaningful(c, min_len: int = MIN_LEN, max_len: int = MAX_LEN,
                  max_repeat_ratio: float = MAX_REPEAT_RATIO) -> Column:
    """True when the lower-cased text without punctuation has 2..200 chars, no
    run of 5 consonants, no character above half of the length (spaces count),
    and no adjacent repeat of a 2..5-char chunk followed by at least one more
    character. Null -> false. The length test comes first, so the per-row cost
    is bounded by ``max_len``."""
    t = F.regexp_replace(F.lower(col(c)), NON_WORD_RE, "")

    def rules(x: Column) -> Column:
        n = F.length(x)
        rest = (~x.rlike(CONSONANT_RUN_RE)) \
            & (_max_char_count(x) <= n * F.lit(max_repeat_ratio)) \
            & (~x.rlike(REPEAT_RE))
        return F.when(n.between(min_len, max_len), rest).otherwise(F.lit(False))
    return F.coalesce(let(t, rules), F.lit(False))


_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def surely_too_long(c, max_len: int = MAX_LEN) -> Column:
    """True only for a text whose cleaned form has more than ``max_len`` characters, told without a regex pass: cleaning
    keeps every ASCII letter outside links, tags and hashtags, so a text that can hold none of these is at least as long
    as it has letters."""
    x = col(c)
    removable = F.contains(x, F.lit("http")) | F.contains(x, F.lit("www.")) | F.contains(x, F.lit("<")) | F.contains(x, F.lit("#"))
    return ~removable & (F.length(x) > max_len) & (F.length(x) - F.length(F.translate(x, _LETTERS, "")) > max_len)


def is_blank(c) -> Column:
    """Empty after stripping (Unicode) whitespace; null counts as blank."""
    return F.coalesce(F.length(F.regexp_replace(col(c), rf"[{SPACE}]+", "")) == 0, F.lit(True))
