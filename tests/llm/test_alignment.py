"""Alignment of two tokenizers against the libraries on whole texts and a search of all token pairs."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import public_tokenizers as P
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import EDGE, empty, table

from martlake.llm import alignment as A
from martlake.llm.queries import BYTE_BPE, PIECE_MODEL, op13_alignment

PATHS = P.path(BYTE_BPE), P.path(PIECE_MODEL)


def spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(rows):
    ta = tokenizers.Tokenizer.from_file(PATHS[0])
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    alphabet = A.byte_level()
    docs, count = [], Counter()
    for name, text in rows:
        want, a, b = (" " + (text or "")).encode(), [], []
        if text:
            e = ta.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(alphabet[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
            for i in tb.encode(text):
                p = tb.id_to_piece(i)
                b.append((i, bytes([int(p[3:5], 16)]) if tb.is_byte(i) else p.replace("▁", " ").encode()))
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            docs.append((name, [], [], [], ""))
            continue
        a, b = spans(a), spans(b)
        links, j = [], 0
        for i, lo, hi in a:
            while b[j][2] <= lo:
                j += 1
            k = j
            while k < len(b) and b[k][1] < hi:
                links.append((i, b[k][0]))
                k += 1
        count.update(links)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [[[], []] for _ in ends]
        for side, tokens in enumerate((a, b)):
            for i, _, hi in tokens:
                groups[bisect_left(ends, hi)][side].append(str(i))
        text = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        docs.append((name, a, b, links, hashlib.sha256(text.encode()).hexdigest(), len(groups)))
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return sorted(((d[0], len(d[1]), len(d[2]), d[5] if len(d) > 5 else 0, len(d[3]), sum(count[x] == best[x[1]] for x in d[3]),
                    sum(count[x] for x in d[3]), d[4]) for d in docs), key=str)


ROWS = EDGE + [(20, "a "), (21, " "), (22, "  a   b  "), (23, "tab\tand\r\nline ends\n\n"), (24, "\x00nul\x01"), (25, "🙂🙂 𐍈 ﬁ é"),
               (26, "word " * 30_000), (27, " no-break　wide"), (28, "<0x41> <s>A</s>"), (29, "é" * 5_000)]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    want = brute(ROWS)
    assert any(w[1] for w in want) and sum(not w[1] for w in want) >= 4
    docs = table(spark, ROWS).repartition(3)
    for head in (A.HEAD_PAIRS, 50, 0):  # all counts broadcast, a few, none
        assert got(A.alignment_report(docs, *PATHS, head_pairs=head)) == want


def test_smallest_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r.values()) for r in pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    assert got(op13_alignment(spark, d)) == brute(rows)


def test_empty_table(spark):
    assert A.alignment_report(empty(spark), *PATHS).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 400), max_size=120), st.sets(st.integers(0, 400), max_size=120))
def test_gallop(a, b):
    a, b = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    assert A.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()


def test_gallop_reads_near_the_last_find(monkeypatch):
    rnd = random.Random(1)
    long = np.cumsum([rnd.randint(1, 3) for _ in range(50_000)])
    short = long[::7].copy()
    reads = []
    class Watched(np.ndarray):
        def __getitem__(self, i):
            if isinstance(i, np.ndarray):
                reads.append(i.size)
            return super().__getitem__(i)
    found = A.gallop(short, long.view(Watched))
    assert found.tolist() == list(range(0, 50_000, 7))
    assert sum(reads) < 9 * len(short)  # against 16 for a plain binary search


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(61, 70))
def test_overlaps(a, b, end):
    a, b = sorted(a | {end}), sorted(b | {end})
    x, y, i, j = A.overlaps(np.array(a), np.array(b))
    assert [a[k] for k in x] == [b[k] for k in y] == sorted(set(a) & set(b))
    lo_a, lo_b = [0, *a], [0, *b]
    want = [(k, m) for k in range(len(a)) for m in range(len(b)) if lo_a[k] < b[m] and lo_b[m] < a[k]]
    assert sorted(zip(i.tolist(), j.tolist())) == want
