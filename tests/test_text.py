"""Review-text cleaning and the meaningful-text predicate, checked against a
plain Python ``re`` restatement of the rules (FIXTURES §C)."""

import collections
import random
import re

from pyspark.sql import functions as F

from martlake.functions.text import clean_text, is_blank, is_meaningful, mask_phones


def py_clean(s):
    s = re.sub(r"https?://\S+|www\.\S+", "", s)
    s = re.sub(r"<.*?>", "", s)
    s = re.sub(r"#\w+", "", s)
    s = re.sub(r"\b(?:\+84|84|0)\d{9,10}\b", "[PHONE]", s)
    s = re.sub(r"[^a-zA-Z0-9\sÀ-ỹ.,!?]", "", s)
    s = re.sub(r"\s+", " ", s).strip()
    return s.lower()


def py_meaningful(s):
    c = re.sub(r"[^\w\s]", "", s.lower())
    if not 2 <= len(c) <= 200:
        return False
    if re.search(r"[bcdfghjklmnpqrstvwxyz]{5,}", c):
        return False
    if max(collections.Counter(c).values()) / len(c) > 0.5:
        return False
    for n in range(2, 6):                       # adjacent repeat, not at the very end
        for i in range(len(c) - 2 * n):
            if c[i:i + n] == c[i + n:i + 2 * n]:
                return False
    return True


EDGE = [
    "Xem https://a.vn/x?y=1 và www.b.com ngay", "tag <b>đậm</b> <a\nhref=x>", "#thẻ hay #ok_1 và # trống",
    "gọi 0912345678 hoặc +84912345678 nhé", "số0912345678à", "84912345678", "Ngoń quá 😀   hết",
    "dòng1\rdòng2\u001cx", "", "   ", "a", "ab", "x" * 200, "x" * 201, "strength", "abcab", "abab",
    "xin chào bạn, hàng tốt!", "aaaa bbb", "hello hello", "okokok!", "Giao hàng nhanh, đóng gói cẩn thận",
]


def random_texts(n=400, seed=7):
    rnd = random.Random(seed)
    parts = ["a", "b", "e", "ô", "ệ", "x", "y", "z", " ", "  ", ".", ",", "!", "?", "#", "<", ">", "\n", "\r",
             "\u001c", "́", " ", "😀", "0", "9", "84", "+", "http://", "www.", "/", "_", "ab", "ng", "ươ"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_clean_and_meaningful_match_python(spark):
    texts = EDGE + random_texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", clean_text("t").alias("c"), is_meaningful(clean_text("t")).alias("m"),
                    is_meaningful("t").alias("m_raw")).collect()
    for r in out:
        t = texts[r["i"]]
        assert r["c"] == py_clean(t), (t, r["c"], py_clean(t))
        assert r["m"] == py_meaningful(py_clean(t)), t
        assert r["m_raw"] == py_meaningful(t), t


def test_phone_mask_and_blank(spark):
    df = spark.createDataFrame([("gọi 0912345678",), ("+84912345678",), ("a0912345678",), (None,), ("  ",)],
                               "t string")
    got = [tuple(r) for r in df.select(mask_phones("t"), is_blank("t")).collect()]
    assert got == [("gọi [PHONE]", False), ("+[PHONE]", False), ("a0912345678", False), (None, True), ("  ", True)]


def test_meaningful_edges(spark):
    cases = {"a": False, "ab": True, "x" * 200: False, "ab" * 100: False, "strengths": False, "strength": True, "abcab": True,
             "abab": True, "ababx": False, "": False, "xin chào": True}
    df = spark.createDataFrame(list(cases.items()), "t string, expect boolean")
    for r in df.select("t", "expect", is_meaningful(F.col("t")).alias("m")).collect():
        assert r["m"] == r["expect"] == py_meaningful(r["t"]), r["t"]


def test_long_texts_are_told_without_cleaning(spark):
    """Never true for a text that could pass, true for plain long ones."""
    from martlake.functions.text import MAX_LEN, surely_too_long
    cases = ["a" * 200, "a" * 201, "ab " * 100, "1" * 500, "é" * 300, "http" + "a" * 300, "<" + "a" * 300 + ">", "#" + "a" * 300,
             "www." + "a" * 300, "a. " * 66 + "aa", "word " * 60, "x" * 150 + "漢" * 100, "", "Z" * 250 + " 0912345678"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = df.select("i", surely_too_long("t").alias("long"), F.length(F.regexp_replace(clean_text("t"), "[^a-z]", "")).alias("n")).collect()
    assert all(not r["long"] or r["n"] > MAX_LEN for r in got)
    assert {r["i"] for r in got if r["long"]} == {1, 10, 13}
