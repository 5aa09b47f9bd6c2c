import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import EDGE, edge, empty, table

from martlake.llm import dedup_suffix as S


def brute(rows):
    """Every LENGTH-byte string in the order of (doc_id, text hash order given by the caller, start)."""
    seen, out = set(), {}
    for k, (d, t) in enumerate(rows):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - S.LENGTH + 1):
            w = raw[i:i + S.LENGTH]
            if w in seen:
                gone[i:i + S.LENGTH] = True
            seen.add(w)
        spans = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out[k] = (d, len(raw), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
    return out


def corpus(seed, n=60):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdéf", k=rnd.randint(1, 7))) for _ in range(400)]
    passages = [" ".join(rnd.choices(words, k=k)) for k in (25, 40, 60, 120)]
    rows = []
    for i in range(n):
        parts = [" ".join(rnd.choices(words, k=rnd.randint(0, 60))) for _ in range(3)]
        for p in rnd.choices(passages, k=rnd.randint(0, 2)):
            parts.insert(rnd.randint(0, 3), p)
        t = " ".join(parts)
        if rows and rnd.random() < 0.3:
            t = rnd.choice(rows)[1]
            if rnd.random() < 0.5:
                a = rnd.randint(0, len(t))
                t = t[:a] + "#" + t[a + 1:]
        rows.append((i, t))
    return rows


@pytest.mark.parametrize("hot,known", [(S.HOT, S.SAMPLE_RUNS), (3, S.SAMPLE_RUNS), (1, S.SAMPLE_RUNS), (3, 4), (S.HOT, 1)])
def test_against_brute_force(spark, monkeypatch, hot, known):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "SAMPLE", 1)
    monkeypatch.setattr(S, "SAMPLE_RUNS", known)
    monkeypatch.setattr(S, "PACK_BYTES", 3000)
    rows = corpus(1) + [(100, "ab" * 400), (101, "x" + "ab" * 100), (102, "z" * 5000), (103, "z" * 99), (104, "z" * 100), (105, ""),
                        (106, "漢字" * 60), (107, "字漢" * 60)]
    got = S.repeat_report(table(spark, rows).repartition(7), bucket_bytes=2000).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows).values())


def test_one_run_that_repeats_inside_itself(spark):
    prose = corpus(5, 8)
    rows = [(1, "-" * 200), (2, "ha " * 90), (3, prose[0][1] + "=" * 160 + prose[1][1]), (4, "+" * 101), (5, "*" * 100), (6, "#" * 355),
            (7, "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3), *[(10 + i, t) for i, t in prose]]
    got = sorted(tuple(r) for r in S.repeat_report(table(spark, rows)).collect())
    assert got == sorted(brute(rows).values())
    assert [r[2] for r in got[:6]] == [199, 267, got[2][2], 100, 0, 354] and got[2][2] >= 159


def test_edges(spark):
    rows = [(d, t) for d, t in EDGE if d is not None and d != 6] + [(None, EDGE[9][1][:500])]
    got = S.repeat_report(table(spark, rows)).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, brute(rows).values()))
    assert len(S.repeat_report(edge(spark)).collect()) == len(EDGE)
    assert S.repeat_report(empty(spark)).collect() == []


def test_repeated_rows_are_one_document(spark):
    t = corpus(3, 5)[4][1]
    rows = [(1, t), (1, t), (2, t)]
    got = sorted(tuple(r)[:3] for r in S.repeat_report(table(spark, rows)).collect())
    n = len(t.encode())
    assert got == [(1, n, 0), (1, n, 0), (2, n, n if n >= S.LENGTH else 0)]


def test_a_very_frequent_hash_is_never_gathered(spark, monkeypatch):
    monkeypatch.setattr(S, "SAMPLE", 1)
    monkeypatch.setattr(S, "SAMPLE_RUNS", 100)
    passage = " ".join(f"word{i}" for i in range(40))
    docs = table(spark, [(i, f"{i} begins {passage} ends {i}") for i in range(300)])
    base = docs.selectExpr("doc_id AS key", "text", "xxhash64(text) AS hashed")
    hot = S.very_hot(base)
    assert 0 < len(hot) < 20
    sent = base.mapInArrow(S._send_hashes(8, spark.sparkContext.broadcast(hot)), "bucket long, kind int, hashes binary, docs binary, numbers binary")
    by_kind = {0: [], 1: []}
    for r in sent.collect():
        by_kind[r.kind] += np.frombuffer(r.hashes, "<u8").tolist()
    assert set(by_kind[1]) == set(hot.tolist()) and not set(by_kind[0]) & set(hot.tolist())
    assert len(by_kind[1]) >= 300 * len(hot)
    got = sorted(tuple(r) for r in S.repeat_report(docs).collect())
    assert got == sorted(brute([(i, f"{i} begins {passage} ends {i}") for i in range(300)]).values())


def test_many_null_ids(spark):
    rows = [(None, t) for _, t in corpus(7, 40)] + [(1, corpus(7, 40)[5][1])]
    docs = table(spark, rows)
    order = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) AS h").collect()}
    distinct = [(None, t) for t in sorted({t for _, t in rows[:-1]}, key=lambda t: order[t] >> 24)]
    want = brute([rows[-1], *distinct])
    of = {t: want[i + 1] for i, (_, t) in enumerate(distinct)}
    got = sorted((tuple(r) for r in S.repeat_report(docs.repartition(5)).collect()), key=str)
    assert got == sorted([want[0], *[of[t] for _, t in rows[:-1]]], key=str)


def test_kept_bytes(spark):
    rows = corpus(2, 30)
    want = {v[0]: v[4] for v in brute(rows).values()}
    for r in S.remove_repeats(table(spark, rows)).collect():
        assert hashlib.sha256(r.kept).hexdigest() == want[r.doc_id]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 40)), max_size=60))
def test_earlier_match(items):
    rank, pos = (np.array([x[i] for x in items], np.int64) for i in (0, 1))
    order = np.argsort(rank, kind="stable")
    got = S.earlier_match(order, rank, pos)
    assert got.tolist() == [any(r == rank[i] and p < pos[i] for r, p in items) for i in range(len(items))]


def test_suffix_order_is_by_bytes():
    rnd = random.Random(4)
    body = bytes(rnd.choices(b"ab", k=700))
    starts, counts = np.array([0, 300]), np.array([201, 301])
    order, rank = S.truncated_suffix_array(np.frombuffer(body, np.uint8), starts, counts)
    wins = [body[s + i:s + i + S.LENGTH] for s, c in zip(starts, counts, strict=True) for i in range(c)]
    assert [wins[i] for i in order] == sorted(wins)
    assert [rank[i] for i in order] == sorted(rank)
