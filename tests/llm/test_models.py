"""Toxicity, language identification and language-model scoring on small data and edge rows."""

import math
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from llm_cases import EDGE, edge, empty, table

from martlake.llm import langid, lm, toxicity
from martlake.llm.columns import Words, text_bytes

MODEL = P.path("piece_bpe_32k.model")
rnd = random.Random(2)
PLAIN = ["".join(rnd.choices("abcdefghijklmnopqrst", k=rnd.randint(2, 6))) for _ in range(500)]


def toxic_rows(n=600):
    docs, labels = [], []
    for i in range(n):
        w = rnd.choices(PLAIN, k=rnd.randint(20, 60))
        bad = i % 4 == 0
        if bad:
            for _ in range(2):
                w.insert(rnd.randrange(len(w)), rnd.choice(["vile", "rotten", "nasty"]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_learns_from_the_other_folds(spark):
    docs, labels = toxic_rows()
    # Wrong labels in the held-out fold would show if they were read.
    given = [(i, y if zlib.crc32(str(i).encode()) % 5 else 1 - y) for i, y in labels] + [(None, 1), (7, None), (99999, 1)]
    lab = spark.createDataFrame(given, "doc_id long, toxic int")
    rows = toxicity.toxicity_report(table(spark, docs + EDGE[1:5] + [(None, None)]).repartition(3), lab).collect()
    assert len(rows) == len(docs) + 5
    truth, right, held = dict(labels), 0, 0
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is None:
            assert r.held_out is False
            continue
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.held_out and r.doc_id > 10:
            held += 1
            right += r.predicted == truth[r.doc_id]
    assert right >= 0.97 * held > 50


def test_toxicity_edges(spark):
    docs, labels = toxic_rows(100)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(table(spark, docs), lab)
    assert len(model.index) < 2000  # a sparse model
    assert len(toxicity.score(edge(spark), model).collect()) == len(EDGE)
    assert toxicity.score(empty(spark), model).collect() == []
    kept = toxicity.drop_toxic(edge(spark), model)
    assert kept.columns == edge(spark).columns and kept.count() == len(EDGE)
    none = toxicity.fit(table(spark, docs), lab.filter("toxic = 0"))
    assert {r.score for r in toxicity.score(edge(spark), none).collect()} == {0.0}


def test_ftrl_step_by_step():
    """Against the per-coordinate rule, one coordinate at a time."""
    f = toxicity.Ftrl(0.5, 1.0, 0.3, 0.1)
    z, n, base = {}, {}, 1 << toxicity.BITS
    for step in range(200):
        i, y = sorted({rnd.randrange(6), rnd.randrange(6)}), rnd.randrange(2)
        w = {}
        for c in [*i, base]:
            l1 = 0 if c == base else 0.3
            zc, nc = z.get(c, 0.0), n.get(c, 0.0)
            w[c] = 0.0 if abs(zc) <= l1 else -(zc - math.copysign(l1, zc)) / ((1 + math.sqrt(nc)) / 0.5 + 0.1)
        g = 1 / (1 + math.exp(-sum(w.values()))) - y
        for c in w:
            nc = n.get(c, 0.0)
            z[c] = z.get(c, 0.0) + g - (math.sqrt(nc + g * g) - math.sqrt(nc)) / 0.5 * w[c]
            n[c] = nc + g * g
        f.learn(np.array(i), y)
    assert np.allclose([f.z[c] for c in z], list(z.values())) and np.allclose([f.n[c] for c in n], list(n.values()))


def test_toxicity_score_of_each_text():
    """Against the distinct words, pairs and skip-grams of each text, taken one by one from the text's words."""
    texts = ["vile rotten vile rotten x", "", "one", "Vile x ROTTEN, x vile!", "a b c a b c d", "漢字 vile"]

    def one(t):
        return Words(*text_bytes(pa.array([t])))

    def name(t):  # the number of a feature, told by a text that has no other
        return set(toxicity.features(one(t))[1].tolist())

    def own(t):
        words = ["".join(c.lower() if c < "\x80" else c for c in w) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t)]
        out = set().union(*[name(w) for w in words]) if words else set()
        for a, b in zip(words, words[1:]):
            out |= name(f"{a} {b}") - name(a) - name(b)
        for a, b in zip(words, words[2:]):
            out |= name(f"{a} zz {b}") - name(f"{a} zz") - name(f"zz {b}")
        return out

    r = np.random.default_rng(4)
    index = np.unique(np.concatenate([list(own(t)) for t in texts if own(t)])).astype(np.int64)
    model = toxicity.ToxicityModel(index, r.normal(size=len(index)), -0.3)
    weight = dict(zip(index.tolist(), model.weight))
    want = [1 / (1 + math.exp(0.3 - sum(weight[f] for f in own(t)))) for t in texts]
    assert np.allclose(model.score(Words(*text_bytes(pa.array(texts)))), want)


def segmentations(word):
    if not word:
        yield []
    for m in range(1, len(word) + 1):
        for rest in segmentations(word[m:]):
            yield [word[:m], *rest]


def test_forward_sums_all_segmentations():
    v = langid.vocabulary(MODEL)
    p = np.random.default_rng(1).random((len(v) + 1, 2)) / len(v)
    number = {x: i for i, x in enumerate(v.pieces, 1)}
    words = ["▁there", "▁ü", "▁的x", "ing", "▁thingss", "▁" + "the" * 3]
    got = langid.word_scores(words, v, p)
    uses = langid.expected_counts(words, np.array([1.0, 2, 3, 4, 5, 6]), np.array([0, 1, 0, 1, 0, 1]), v, p)
    want_uses = np.zeros_like(p)
    for k, w in enumerate(words):
        total, lang, mine = np.zeros(2), k % 2, np.zeros(len(p))
        for seg in segmentations(w):
            ids = [number.get(s, 0 if len(s) == 1 else None) for s in seg]
            if None in ids:
                continue
            q = np.prod([p[i] for i in ids], axis=0)
            total += q
            for i in ids:
                mine[i] += q[lang]
        assert np.allclose(got[k], np.log(total))
        want_uses[:, lang] += (k + 1) * mine / total[lang]
    assert np.allclose(uses, want_uses)


def test_long_words():
    """Words of any length against sums in logarithms, without blocks or rescaling."""
    v = langid.vocabulary(MODEL)
    assert v.longest == max(len(x) for x in v.pieces) > 12
    p = np.random.default_rng(2).random((len(v) + 1, 3)) / len(v)
    number = {x: i for i, x in enumerate(v.pieces, 1)}
    for word in ("▁international" + "ization" * 8, "▁" + "漢" * 60, "▁" + "straße" * 900, "▁" + "ab" * (langid.BLOCK // 2), "▁" + "c" * (langid.BLOCK - 1)):
        a = [np.zeros(3)]
        for j in range(1, len(word) + 1):
            terms = [a[j - m] + np.log(p[number.get(word[j - m:j], 0)]) for m in range(1, min(j, v.longest) + 1) if m == 1 or word[j - m:j] in number]
            a.append(np.logaddexp.reduce(terms))
        assert np.allclose(langid.word_scores([word], v, p)[0], a[-1])
    uses = langid.expected_counts(["▁" + "straße" * 100], np.ones(1), np.zeros(1, np.int64), v, p)
    sizes = np.array([1, *map(len, v.pieces)])
    assert np.isclose((uses[:, 0] * sizes).sum(), 601)  # every letter is used once


def test_letters():
    assert langid.words_of("½ ² Ⅷ ① 12_3 --") == []
    assert langid.words_of("हिन्दी Straße x²y l'été") == ["▁हिन्दी", "▁straße", "▁x", "▁y", "▁l", "▁été"]


LETTERS = {"aa": "abcde", "bb": "uvwxyz"}


def language_rows(n=90):
    out = []
    for i in range(n):
        lang = ["aa", "bb", None][i % 3]
        out.append((i, " ".join("".join(rnd.choices(LETTERS[lang or "aa"], k=5)) for _ in range(30)), lang))
    return out


def test_language(spark):
    rows = language_rows()
    docs = spark.createDataFrame(rows + [(1000, None, "aa"), (1001, "12 34 -- ½ Ⅷ ①", "bb"), (None, "abc abc", None)],
                                 "doc_id long, text string, lang string")
    got = langid.language_report(docs, MODEL).collect()
    assert len(got) == len(rows) + 3
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in (1000, 1001):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
            assert r.lang_pred == (rows[r.doc_id][2] or "aa")
    model = langid.fit(docs, MODEL)
    assert len(langid.predict(edge(spark), model, MODEL).collect()) == len(EDGE)
    assert langid.predict(empty(spark), model, MODEL).collect() == []
    none = langid.fit(docs.filter("lang = 'zz'"), MODEL)
    assert {r.lang_pred for r in langid.predict(edge(spark), none, MODEL).collect()} == {"und"}


def test_gradient_by_differences():
    r = np.random.default_rng(0)
    net = lm.Network(lm.Network.start(r.random(lm.VOCAB)).flat.astype(np.float64))
    context, token = r.integers(0, lm.VOCAB + 1, (7, 4)), r.integers(0, lm.VOCAB, 7)
    g = net.gradient(context, token)
    for i in r.choice(np.flatnonzero(g), 40, replace=False):
        d = 1e-5
        up, down = net.flat.copy(), net.flat.copy()
        up[i] += d
        down[i] -= d
        num = -(lm.Network(up).log_prob(context, token).mean() - lm.Network(down).log_prob(context, token).mean()) / (2 * d)
        assert abs(num - g[i]) < 1e-4 + 1e-2 * abs(num)


def test_distribution_sums_to_one():
    net = lm.Network.start(np.arange(lm.VOCAB, dtype=float))
    every = np.arange(lm.VOCAB)
    lp = net.log_prob(np.tile([3, 5, lm.EDGE, 9], (lm.VOCAB, 1)), every)
    assert abs(np.exp(lp.astype(np.float64)).sum() - 1) < 1e-4


def test_contexts_stay_in_their_text():
    w = Words(*text_bytes(pa.array(["a b c", "", "d"])))
    tokens = lm.Tokens(np.empty(0, np.uint64))
    context, token, text = tokens.positions(w)
    e, t = lm.EDGE, token.tolist()
    assert text.tolist() == [0, 0, 0, 2]
    assert context.tolist() == [[e, e, t[1], t[2]], [e, t[0], t[2], e], [t[0], t[1], e, e], [e] * 4]


def test_every_position_is_trained(spark):
    # Word k of every text has its own neighbours; only a network that was trained on position k can tell it from its frequency.
    docs = [(i, " ".join(f"w{k}" for k in range(8))) for i in range(3000)]
    tokens, net, *_ = lm.fit(table(spark, docs).repartition(1))
    context, token, _ = tokens.positions(Words(*text_bytes(pa.array([docs[0][1]]))))
    assert len(set(token.tolist())) == 8
    assert (net.log_prob(context, token) > math.log(0.5)).all()


def test_words_of_one_hash_class_have_their_own_probability(spark):
    hashed = {}
    for k in range(60_000):
        hashed.setdefault(int(Words(*text_bytes(pa.array([f"v{k}"]))).hash[0] % np.uint64(lm.VOCAB - lm.FREQUENT)), []).append(f"v{k}")
        if len(hashed[0] if 0 in hashed else ()) == 3:
            break
    often, seldom, never = hashed[0]
    common = [f"c{i}" for i in range(lm.FREQUENT)]
    docs = [(i, " ".join(common)) for i in range(20)] + [(100, " ".join([often] * 8 + [seldom] * 2))]
    model = lm.fit(table(spark, docs))
    got = {r.doc_id: r.log_likelihood for r in lm.score(table(spark, [(1, often), (2, seldom), (3, never), (4, None)]), model).collect()}
    assert got[1] - got[2] == pytest.approx(math.log(8 / 2))
    assert got[2] - got[3] == pytest.approx(math.log(2))
    assert got[4] == 0


def test_words_whose_uses_are_not_sent_are_joined(spark, monkeypatch):
    r = np.random.default_rng(3)
    docs = table(spark, [(i, " ".join(f"w{k}" for k in r.zipf(1.3, 300) % 4000)) for i in range(40)]).repartition(1)
    got = []
    for sent in (lm.SENT_WORDS, 5, 0):
        monkeypatch.setattr(lm, "SENT_WORDS", sent)
        model = lm.fit(docs)
        assert len(model.sent[0]) == len(model.sent[1]) <= sent
        got.append(sorted((x.doc_id, round(x.log_likelihood, 6)) for x in lm.score(docs, model).collect()))
    assert got[0] == got[1] == got[2]


def test_frequent_words_that_begin_alike():
    known = np.array([5, 7, 5 << 50, (5 << 50) + 1, 2**64 - 1], np.uint64)
    h = np.concatenate([known, known + np.uint64(2)])
    assert lm.Tokens(known).of(h).tolist() == [0, 1, 2, 3, 4, 1] + [lm.FREQUENT + int(x % np.uint64(lm.VOCAB - lm.FREQUENT)) for x in h[6:]]


def test_scoring_prefers_what_the_corpus_says(spark):
    base = "the cat sat on the mat and the dog sat on the rug".split()
    docs = [(i, " ".join(base * 20)) for i in range(40)]
    shuffled = list(base * 20)
    random.Random(1).shuffle(shuffled)
    df = table(spark, docs + [(100, None), (None, "the cat")]).repartition(2)
    model = lm.fit(df)
    got = {r.doc_id: r for r in lm.score(table(spark, [(0, docs[0][1]), (1, " ".join(shuffled)), (2, None)]), model).collect()}
    assert got[0].mean_log_prob > got[1].mean_log_prob + 0.5
    assert (got[2].n_words, got[2].log_likelihood, got[2].mean_log_prob) == (0, 0.0, 0.0)
    assert got[0].log_likelihood == pytest.approx(got[0].mean_log_prob * got[0].n_words)
    assert len(lm.score_report(edge(spark)).collect()) == len(EDGE)
    assert lm.score_report(empty(spark)).collect() == []


def test_gradient_sums_repeated_words_and_leaves_absent_classes_at_zero():
    r = np.random.default_rng(5)
    net = lm.Network(lm.Network.start(r.random(lm.VOCAB)).flat.astype(np.float64))
    context, token = np.tile([3, 3, lm.EDGE, 3], (600, 1)).astype(np.int16), np.full(600, 70)
    held = lm.Network(np.full(lm.SIZE, np.nan))
    g = lm.Network(net.gradient(context, token, held))
    one = lm.Network(net.gradient(context[:1], token[:1]))
    assert np.allclose(g.flat, one.flat, rtol=1e-9, atol=1e-15)
    assert np.flatnonzero(np.abs(g.emb).sum(axis=1)).tolist() == [3, lm.EDGE]
    assert np.flatnonzero(np.abs(g.wt).sum(axis=(1, 2))).tolist() == [70 // lm.PER_CLASS]


def test_words_are_counted_over_several_slices_at_once(monkeypatch):
    texts = ["one two two"] * 5
    whole = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    monkeypatch.setattr(lm, "slices", lambda col: ((i, i + 1) for i in range(len(col))))
    for held, batches in ((100, 1), (6, 3), (1, 5)):  # of 15 words
        monkeypatch.setattr(lm, "COUNTED", held, raising=False)
        got = list(lm._count_words(iter([whole.slice(0, 2), whole.slice(2)])))
        assert len(got) == batches
        assert sorted(pa.Table.from_batches(got).group_by("word").aggregate([("n", "sum")]).column("n_sum").to_pylist()) == [5, 10]
    assert list(lm._count_words(iter([]))) == []
