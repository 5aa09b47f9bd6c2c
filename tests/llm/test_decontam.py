import hashlib
import re

import pytest
from llm_cases import EDGE, LONG, edge, empty, table

from martlake.llm import decontam

ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short item"), (3, None), (4, ""),
         (10, "two three four five six seven eight nine ten ELEVEN"), (None, "lazy dog, again"), (2, "Short, item"),
         (5, " ".join(LONG.split()[100:130])), (6, "漢字")]
DOCS = EDGE + [(20, "x One two, three four five six seven eight nine ten eleven twelve"), (21, "a short item; short item"),
               (22, "two three four five six seven eight nine ten"), (23, "one two three four five six seven eight nine ten")]


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        k = min(10, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[a:a + k]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, names = words(t), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if (own := tuple(w[a:a + k])) in windows:
                    hit |= set(range(a, a + k))
                    names |= {str(x) for x in windows[own] if x is not None}
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(map(str, out))


def bench(spark, items):
    from pyspark.sql import functions as F
    return spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1)).withColumn("doc_id", F.lit(2))


@pytest.mark.parametrize("block", [decontam.BLOCK_WINDOWS, 4])
def test_report(spark, block, monkeypatch):
    monkeypatch.setattr(decontam, "CHUNK_WINDOWS", 3)
    got = decontam.contamination_report(table(spark, DOCS).repartition(2), bench(spark, ITEMS), block_windows=block).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(DOCS, ITEMS)


def test_drop_and_remove(spark):
    docs, b = table(spark, DOCS).repartition(2), bench(spark, ITEMS)
    dirty = {d for d, _, n, *_ in map(eval, brute(DOCS, ITEMS)) if n}
    kept = decontam.drop_contaminated(docs, b)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in DOCS if d not in dirty)
    text = {r.doc_id: r.text for r in decontam.remove_spans(docs, b).collect()}
    assert text[20] == "x  twelve" and text[21] == "a " and text[22] == DOCS[-2][1] and text[2] == ""


def test_empty(spark):
    assert decontam.contamination_report(empty(spark), bench(spark, ITEMS)).collect() == []
    got = decontam.contamination_report(edge(spark), bench(spark, [])).collect()
    assert len(got) == len(EDGE) and not any(r.contaminated for r in got)


def test_one_block_per_stage(spark):
    """However many blocks there are, the last stage scans with one, over what the others left."""
    df = decontam.scan(table(spark, DOCS).repartition(2), bench(spark, ITEMS), block_windows=4)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "FileScan parquet" in plan


def test_a_window_of_many_items_is_one_entry():
    same = b" ".join(b"w%d" % i for i in range(10))
    block = decontam.Block([(f"i{k}", same) for k in range(500)] + [(None, same), ("x", same + b" more")], 10)
    assert block.by_length[10].shape[1] == 2
    assert sorted(map(len, block.items[10])) == [1, 501]
