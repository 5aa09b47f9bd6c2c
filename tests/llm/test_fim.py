"""Fill-in-middle against a plain rebuild of the contract, and frames against their texts."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import EDGE, edge, empty, table

from martlake.llm import fim


def brute(name, text):
    t = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", t)
    n = len(units)
    h = hashlib.sha256(f"7:{'' if name is None else name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        form, out, before, middle = "plain", t, None, None
    elif h4 % 100 < 50:
        form, out, before, middle = "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    else:
        form, out, before, middle = "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (out, t)]
    return (name, n, form, before, middle, *sha), out


LINES = [(i, "".join(random.Random(i).choices(["a", "é", "漢", "\n", "\n\n", "<", "<S", "S>", " long words ", "🙂"], k=i % 61))) for i in range(100, 300)]
ODD = [(20, "has <P> inside"), (21, "<M>"), (22, "\n"), (23, "no end"), (24, "<S"), (25, "P>\n<P\n>"),
       (26, ("line of text é\n" * 40_000) + "z"), (27, "漢" * 100_000), (28, "x" * 70_000 + "\n" + "y" * 200_000)]


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    rows = EDGE + ODD + LINES
    want = [brute(*r) for r in rows]
    for size in (fim.FRAME_BYTES, 7):
        if size == 7:
            rows, want = EDGE[:9] + EDGE[11:] + LINES, [brute(*r) for r in EDGE[:9] + EDGE[11:] + LINES]
        stored = fim.store(table(spark, rows).repartition(3), frame_bytes=size)
        done = fim.transform(stored)
        assert as_rows(fim.restore(done)) == sorted(((i, t or "") for i, t in rows), key=str)
        assert as_rows(fim.output_text(done)) == sorted(((w[0], w[2], out) for w, out in want), key=str)
    got = fim.fim_report(table(spark, EDGE + ODD + LINES).repartition(3))
    assert as_rows(got) == sorted((brute(*r)[0] for r in EDGE + ODD + LINES), key=str)


def test_empty_table(spark):
    assert fim.fim_report(empty(spark)).collect() == []


def test_edge_columns(spark):
    assert fim.fim_report(edge(spark)).columns == [
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def test_only_cut_frames_are_decompressed(monkeypatch):
    text = "".join(f"line {i}\n" for i in range(50_000))
    frames = fim.frames_of(text, 4096)
    opened = []
    real = fim._unpack
    monkeypatch.setattr(fim, "_unpack", lambda f: opened.append(f) or real(f))
    got = fim._transform("5", 50_000, False, frames, 7, 100, 50)
    assert got[0] in ("psm", "spm") and len(frames) > 80
    assert len(opened) <= 2
    assert len(set(f["data"] for f in frames) & set(got[3])) >= len(frames) - 2  # the others are passed on as stored


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab\né漢<S>PM", max_size=80), st.integers(0, 10**6), st.integers(4, 12))
def test_frames_and_cuts(text, name, size):
    frames = fim.frames_of(text, size)
    assert b"".join(fim.stream(f["data"] for f in frames)).decode() == text
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    for k in range(len(units) + 1):
        cut = fim.Stored(frames).seek(k)
        left = fim.Stored(frames).between((0, b"", b""), cut)
        assert b"".join(fim.stream(left)).decode() == "".join(units[:k])
        assert fim.Stored(frames).chars_to(cut) == len("".join(units[:k]))
    form, before, middle, out = fim._transform(str(name), len(units), any(x in text for x in ("<P>", "<S>", "<M>")), frames, 7, 100, 50)
    assert b"".join(fim.stream(out)).decode() == brute(name, text)[1]
    assert b"".join(fim.restored(out, form)).decode() == text


@pytest.mark.parametrize("seed,rate,spm", [(1, 30, 90), (2, 0, 0)])
def test_rates(spark, seed, rate, spm):
    got = fim.fill_in_middle(table(spark, LINES), seed=seed, rate=rate, spm_rate=spm).collect()
    share = sum(r.form != "plain" for r in got) / len(got)
    assert share <= rate / 100 + 0.15
