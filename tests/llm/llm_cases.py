"""Rows that every operator must take: nulls, empties, repeats, long texts, clashing columns."""

import random

LONG = " ".join(random.Random(5).choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=30_000))
UNBROKEN = "".join(random.Random(6).choices("abcxyz0189", k=20_000))
EDGE = [
    (1, "The quick brown fox jumps over the lazy dog, again and again and again."),
    (2, None), (3, ""), (4, " \n\t "), (5, "The quick brown fox jumps over the lazy dog, again and again and again."),
    (None, "a row without an id, of some words, one two three four five six seven"), (None, None),
    (6, "repeated row repeated row"), (6, "repeated row repeated row"),
    (7, LONG), (8, UNBROKEN), (9, "Ünïcödé – “quotes” 漢字 🙂 <|endoftext|> tail  two  blanks  x\x1cy"),
    (10, "x"), (11, "▁marker▁▁ <s> </s> <unk>"), (12, "\n\n\nlines\n\nof\ntext\n"),
]


def table(spark, rows):
    """doc_id and text with extra columns whose names clash with those the operators make."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("lang", "source", "hash", "keep_id", "n_words", "item", "row", "words", "score", "ids", "start", "text_sha256"):
        df = df.withColumn(c, F.lit("x"))
    return df


def edge(spark):
    return table(spark, EDGE).repartition(3)


def empty(spark):
    return table(spark, [])
