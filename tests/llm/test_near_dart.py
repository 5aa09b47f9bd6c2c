import random

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import EDGE, edge, empty, table

from martlake.llm import near_dart as D
from martlake.llm.columns import Words, text_bytes


def shingles(t):
    w = "".join(c.lower() if c.isascii() else c for c in t or "")
    w = "".join(c if c.isalnum() or not c.isascii() else " " for c in w).split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Connected components of all pairs with a Jaccard similarity of at least 0.8."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    out = []
    for g in groups.values():
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        c = min(ids) if ids else None
        out += [(rows[i][0], c, len(g), rows[i][0] == c) for i in g]
    return sorted(map(str, out))


def corpus():
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(400):
        if rows and rnd.random() < 0.5:
            w = rnd.choice(rows)[1].split()
            for _ in range(rnd.choice([0, 1, 1, 2, 12])):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            rows.append((i, " ".join(w)))
        else:
            rows.append((i, " ".join(rnd.choices(words, k=rnd.choice([3, 30, 120, 200])))))
    base = rnd.choices(words, k=150)
    for i in range(400, 460):  # one large group of near copies
        w = list(base)
        w[rnd.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("small", [D.SMALL, 2])
def test_classes(spark, monkeypatch, small):
    monkeypatch.setattr(D, "SMALL", small)
    rows = corpus()
    got = D.near_classes(table(spark, rows).repartition(4))
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("rest", [0, D.REST])
def test_few_rejected_nodes_take_no_further_round(spark, monkeypatch, rest):
    calls, compared = [], D._compared
    monkeypatch.setattr(D, "SMALL", 2)
    monkeypatch.setattr(D, "REST", rest)
    monkeypatch.setattr(D, "_compared", lambda *a: calls.append(1) or compared(*a))
    rows = corpus()
    got = D.near_classes(table(spark, rows).repartition(4))
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)
    assert len(calls) <= 2 or not rest


def test_chains_of_copies_in_a_large_group(spark, monkeypatch):
    # One bucket of all nodes, so that only the comparison within it decides.
    sketch = D._sketch

    def one_bucket(weights, text_col):
        run = sketch(weights, text_col)

        def all_in_one(batches):
            for b in run(batches):
                bands = pa.array([[1] if x else [] for x in b.column("bands").to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("node"), bands], b.schema.names)
        return all_in_one
    monkeypatch.setattr(D, "_sketch", one_bucket)
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(200)]

    def edited(w, k, tag):
        w = list(w)
        for j in rnd.sample(range(0, len(w), 6), k):
            w[j] = f"{tag}{j}"
        return w
    rows = [(i, " ".join(edited(base, 1, f"a{i}x"))) for i in range(40)]
    for i in range(12):  # copies of copies of the base text, linked to it by one copy in between
        between = edited(base, 4, f"b{i}x")
        rows += [(100 + i, " ".join(between)), (200 + i, " ".join(edited(between, 4, f"c{i}x")))]
        rows += [(300 + i, " ".join(edited(base, 12, f"d{i}x")))]  # linked to nothing
    want = brute(rows)
    assert sum("True" in r for r in want) < 16
    got = D.near_classes(table(spark, rows).repartition(4))
    assert sorted(str(tuple(r)) for r in got.collect()) == want


@pytest.mark.parametrize("held", [1 << 17, 3])
def test_components_of_chains_and_random_links(spark, monkeypatch, held):
    """Links that one task holds are joined up by it, in one table; those of many tasks by rounds."""
    written, own = [], D.scratch_table
    monkeypatch.setattr(D, "scratch_table", lambda df, name: written.append(name) or own(df, name))
    monkeypatch.setattr(D, "HELD_LINKS", held)
    rnd = random.Random(3)
    order = rnd.sample(range(60), 60)
    pairs = list(zip(order, order[1:])) + [(100 + rnd.randrange(80), 100 + rnd.randrange(80)) for _ in range(50)]
    pairs = [(min(p), max(p)) for p in pairs if p[0] != p[1]]
    least = {x: x for p in pairs for x in p}
    while any(least[a] != least[b] for a, b in pairs):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    edges = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in pairs], "a binary, b binary")
    if held > 3:
        edges = edges.coalesce(1)
        monkeypatch.setattr(type(edges), "distinct", lambda self: self.dropDuplicates().coalesce(1))
    got = D.components(edges).collect()
    assert sorted((r.node[0], r.label[0]) for r in got) == sorted(least.items())
    assert held == 3 or len(written) == 1


def test_links_that_one_task_can_hold_take_one_table(spark, monkeypatch):
    """However many partitions they come in; there was a round of star contraction after another."""
    written, own = [], D.scratch_table
    monkeypatch.setattr(D, "scratch_table", lambda df, name: written.append(name) or own(df, name))
    edges = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(60)], "a binary, b binary").repartition(30)
    got = D.components(edges).collect()
    assert sorted((r.node[0], r.label[0]) for r in got) == [(i, 0) for i in range(61)]
    assert len(written) == 1


@pytest.mark.parametrize("weights", ["set", "count"])
def test_bits_that_differ_never_exceed_the_weight_of_one_side(weights):
    rnd = np.random.default_rng(5)
    for k in (3, 40, 400, 6000):
        a = rnd.choice(k, k)
        b = np.concatenate([a[:k - k // 5], rnd.choice(k, k // 5) + k])
        t, h, uses = D.elements(Words(*text_bytes(pa.array([" ".join(f"t{x}" for x in s) for s in (a, b)]))), 1)
        w = D._weight(uses, weights)
        bits = D.parity(t, h, 2)
        differ = sum(int(x).bit_count() for x in (bits[0] ^ bits[1]).view(np.uint64))
        sim, mass = D.similarity((h[t == 0], w[t == 0]), (h[t == 1], w[t == 1])), w.sum()
        assert differ <= mass - 2 * mass * sim / (1 + sim) + 1e-9


@pytest.mark.parametrize("sketched", [True, False])
def test_unlike_copies_in_a_large_group_are_ruled_out_without_their_texts(spark, monkeypatch, sketched):
    """Copies with many edits, all shared with some other copy: neither their weights nor leaders rule all of their pairs out."""
    pairs, own = [], D._open_pairs

    def noted(*a):
        out = own(*a)
        pairs.append(0 if out is None else out.count())
        return out
    monkeypatch.setattr(D, "_open_pairs", noted)
    monkeypatch.setattr(D, "_bands", lambda sig: np.where((sig != 0).any(axis=1)[:, None], np.arange(D.BANDS, dtype=np.uint64)[None], 0).astype(np.uint64))
    if not sketched:
        monkeypatch.setattr(D, "parity", lambda text, element, texts: np.zeros((texts, D.SKETCH_WORDS), np.int64))
    rnd = random.Random(4)
    base, rows = [f"w{i}" for i in range(300)], []
    edits = [(i, f"e{i}") for i in range(0, 300, 6)]
    for i in range(60):
        w = list(base)
        for j, x in rnd.sample(edits, 18):
            w[j] = x
        rows.append((i, " ".join(w)))
    rows += [(60 + i, " ".join([*base, f"x{i}"])) for i in range(2)]  # a link
    got = D.near_classes(table(spark, rows).repartition(4))
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)
    assert pairs[0] < 60 if sketched else pairs[0] > 600


def test_edges(spark):
    assert sorted(str(tuple(r)) for r in D.near_classes(edge(spark)).collect()) == brute(EDGE)
    assert D.near_classes(empty(spark)).collect() == []


def test_drop(spark):
    docs = edge(spark)
    out = D.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in out.collect())
    assert ids.count("6") == 1 and "5" not in ids and "1" in ids
    assert len(ids) == len(EDGE) - 2
    assert D.drop_near_duplicates(empty(spark)).collect() == []


@pytest.mark.parametrize("weights", ["set", "count"])
def test_agreement_is_the_weighted_similarity(weights):
    rnd = np.random.default_rng(3)
    agree, true = [], []
    for _ in range(30):
        a = rnd.choice(500, 200)
        b = np.concatenate([a[:150], rnd.choice(500, 50)])
        text = ["  ".join(f"t{x}" for x in s) for s in (a, b)]
        t, h, uses = D.elements(Words(*text_bytes(pa.array(text))), 1)
        w = D._weight(uses, weights)
        sig = D.signatures(t, h, w, 2, 400)
        agree.append((sig[0] == sig[1]).mean())
        true.append(D.similarity((h[t == 0], w[t == 0]), (h[t == 1], w[t == 1])))
    assert abs(np.mean(agree) - np.mean(true)) < 0.02
    assert (sig != 0).all()


def test_fractional_weights():
    t, h = np.zeros(2, np.int64), np.array([5, 9], np.uint64)
    share = np.mean([(D.signatures(t, h * np.uint64(k), np.array([0.25, 0.75]), 1, 64) ==
                      D.signatures(t, h * np.uint64(k), np.array([0.25, 0.25]), 1, 64)).mean() for k in range(1, 60)])
    assert abs(share - 0.5) < 0.03  # min 0.5, max 1


def test_the_closing_step_compares_sketches_in_a_loop(spark, monkeypatch):
    r, plans = random.Random(9), []
    docs = [(i, " ".join(r.choices([f"w{k}" for k in range(40)], k=3) + [f"c{k}" for k in range(60)] + [f"u{i}_{k}" for k in range(i % 8)])) for i in range(60)]
    kept = D.scratch_table
    monkeypatch.setattr(D, "scratch_table", lambda df, name: (plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())), kept(df, name))[1])
    got = D.near_classes(table(spark, docs)).collect()
    assert sorted(str(tuple(x)) for x in got) == brute(docs)
    closing = [p for name, p in plans if name == "near-pairs" and "bit_count" in p]
    assert closing and all(p.count("bit_count") < D.SKETCH_WORDS for p in closing)


def test_hashing_words_keeps_no_tables_of_a_texts_size():
    import tracemalloc
    from martlake.llm.columns import prefix_hash, range_hash
    data = np.random.default_rng(1).integers(0, 256, 2 << 20).astype(np.uint8)
    tracemalloc.start()
    h = prefix_hash(data)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 << 20  # the sums themselves are 16 MB
    data[1_500_000:1_500_040] = data[16_370:16_410]  # across the end of a part
    h = prefix_hash(data)
    a, b = range_hash(h, np.array([16_370, 1_500_000, 7]), np.array([16_410, 1_500_040, 47]))[:2]
    base = 0x9E3779B97F4A7C15
    want = sum((int(x) + 1) * pow(base, i, 1 << 64) for i, x in enumerate(data[:40_000])) % (1 << 64)
    assert a == b and int(h[40_000]) == want
    assert prefix_hash(data[:0]).tolist() == [0]
