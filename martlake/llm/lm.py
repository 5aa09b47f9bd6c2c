"""Language-model scoring by masked pseudo-likelihood.

A small network reads the two words on either side of a position and gives a distribution over all tokens
for the word in the middle; a text's score is the sum of the log-probabilities of its words, each
predicted from both sides. Tokens are the most frequent words of the corpus, each on its own, and
hash classes for all other words. Inside a hash class a word has its share of the class's uses in the corpus. The counts of the
``SENT_WORDS`` most frequent words are sent to the scoring tasks, the others stay in a table that is joined by word; words
that the corpus does not have share one more use of their class. The distribution is factored (class, then token within the class), so it
sums to one over the vocabulary and costs two small softmaxes.

Word counts are taken over all documents. Training is data-parallel over all documents: in each round every
task takes gradient steps (in numpy) on every ``ROUNDS``-th position of each text it holds, from a common start, so that
over the rounds every position of every text is a target once,
and Spark sums the tasks' parameters, weighted by positions, coordinate by coordinate; only that
sum (a fixed number of rows) reaches the driver. Scoring covers every position of every whole text.

Defined cases: null or empty text has no words and scores 0 in sum and mean; a word at the edge of a
text sees an edge mark; with no words at all the network stays as it started; repeated rows count each.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.columns import Words, id_text, scratch_table, slices, text_bytes, with_fields

CLASSES = PER_CLASS = 32
VOCAB = CLASSES * PER_CLASS
#: Tokens that stand for one word each; the rest are hash classes of all other words.
FREQUENT = 768
EDGE = VOCAB
SIDE, DIM, HIDDEN = 2, 16, 32
ROUNDS, BATCH, RATE = 2, 512, 0.05
#: Words that a task gathers before they are counted, 8 bytes each, and one slice more.
COUNTED = 1 << 20
#: Positions that are scored at once, few enough for their arrays to stay in a core's cache.
CHUNK = 1 << 12
#: The most frequent words whose uses every scoring task has (16 bytes each); those of the others are joined.
SENT_WORDS = 1 << 19

SHAPES = {"emb": (VOCAB + 1, DIM), "w1": (2 * SIDE * DIM, HIDDEN), "b1": (HIDDEN,), "wc": (HIDDEN, CLASSES), "bc": (CLASSES,),
          "wt": (CLASSES, HIDDEN, PER_CLASS), "bt": (CLASSES, PER_CLASS)}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


class Network:
    """Parameters as one vector with a named view of each part."""

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        for name, shape in SHAPES.items():
            n = int(np.prod(shape))
            setattr(self, name, flat[at:at + n].reshape(shape))
            at += n

    @classmethod
    def start(cls, counts: np.ndarray) -> Network:
        """Small random weights; biases at the tokens' plain log-frequencies."""
        net = cls(np.random.default_rng(7).normal(0, 0.1, SIZE).astype(np.float32))
        p = (counts + 1.0).reshape(CLASSES, PER_CLASS)
        net.b1[:] = 0
        net.bc[:] = np.log(p.sum(axis=1) / p.sum())
        net.bt[:] = np.log(p / p.sum(axis=1, keepdims=True))
        return net

    def hidden(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Input and hidden layer, a row a position."""
        x = self.emb.take(context, axis=0).reshape(len(context), -1)
        z = x @ self.w1
        z += self.b1
        return x, np.tanh(z, out=z)

    def log_prob(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        """log p(token | context) of each position."""
        _, h = self.hidden(context)
        cls = token // PER_CLASS
        out = _log_of(self.wc.T @ h.T + self.bc[:, None], cls)
        order = np.argsort(cls.astype(np.uint16), kind="stable")  # a radix sort
        hs, dt = h.take(order, axis=0), np.empty((PER_CLASS, len(token)), h.dtype)
        for c, lo, hi in _runs(cls):
            np.add(self.wt[c].T @ hs[lo:hi].T, self.bt[c][:, None], out=dt[:, lo:hi])
        out[order] += _log_of(dt, token[order] % PER_CLASS)
        return out

    def gradient(self, context: np.ndarray, token: np.ndarray, into: Network | None = None) -> np.ndarray:
        """Gradient of the mean of -log p(token | context); ``into`` is a network to hold it, whose values are lost."""
        g = into or Network(np.empty(SIZE, self.flat.dtype))
        g.flat[:] = 0
        x, h = self.hidden(context)
        n, each = len(token), np.arange(len(token))
        cls, own = np.divmod(token, PER_CLASS)
        order = np.argsort(cls.astype(np.uint16), kind="stable")  # a radix sort
        hs, cls, own = h.take(order, axis=0), cls[order], own[order]
        parts = _runs(cls)
        first = [lo for _, lo, _ in parts]
        # Logits have a column a position: numpy takes long over many short rows.
        dc = _softmax(self.wc.T @ hs.T + self.bc[:, None])
        dc[cls, each] -= 1
        dc /= n
        g.wc[:], g.bc[:] = (dc @ hs).T, dc.sum(axis=1)
        back = dc.T @ self.wc.T
        dt = np.empty((n, PER_CLASS), h.dtype)
        for c, lo, hi in parts:
            np.dot(hs[lo:hi], self.wt[c], out=dt[lo:hi])
        dt += self.bt.take(cls, axis=0)
        dt = _softmax(dt.T.copy())
        dt[own, each] -= 1
        dt /= n
        g.bt[[c for c, _, _ in parts]] = np.add.reduceat(dt, first, axis=1).T
        dt = np.ascontiguousarray(dt.T)
        own, ht = np.empty_like(h), hs.T
        for c, lo, hi in parts:
            d = dt[lo:hi]
            np.dot(ht[:, lo:hi], d, out=g.wt[c])
            np.dot(d, self.wt[c].T, out=own[lo:hi])
        back += own
        dz = np.empty_like(h)
        dz[order] = back
        dz *= 1 - h * h
        g.w1[:], g.b1[:] = x.T @ dz, dz.sum(axis=0)
        word = context.reshape(-1)
        order = np.argsort(word.astype(np.uint16), kind="stable")
        word = word[order]
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        g.emb[word[first]] = np.add.reduceat((dz @ self.w1.T).reshape(-1, DIM).take(order, axis=0), first, axis=0)
        return g.flat


def _runs(cls: np.ndarray) -> list[tuple[int, int, int]]:
    """(class, begin, end) of each class that occurs in ``cls``, when that is in order."""
    end = np.cumsum(np.bincount(cls, minlength=CLASSES)).tolist()
    return [(c, lo, hi) for c, (lo, hi) in enumerate(zip([0, *end], end)) if lo < hi]


def _log_of(x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Log-softmax of each column of ``x`` in its ``row``."""
    x -= x.max(axis=0)
    out = x[row, np.arange(x.shape[1])]
    return out - np.log(np.exp(x, out=x).sum(axis=0))


def _softmax(x: np.ndarray) -> np.ndarray:
    """Softmax of each column of ``x``, in place."""
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x /= x.sum(axis=0)
    return x


class Tokens:
    """Words to tokens: frequent words by number, others by hash class."""

    def __init__(self, frequent: np.ndarray):
        self.order = np.argsort(frequent)
        self.known = frequent[self.order]
        # The known words that begin with the same 16 bits are known[first[bits]:first[bits + 1]].
        self.first = np.searchsorted(self.known >> np.uint64(48), np.arange((1 << 16) + 1, dtype=np.uint64)).astype(np.int32)

    def of(self, h: np.ndarray) -> np.ndarray:
        out = FREQUENT + (h % np.uint64(VOCAB - FREQUENT)).astype(np.int64)
        if len(self.known):
            bits = (h >> np.uint64(48)).astype(np.int32)
            at, end = self.first[bits], self.first[bits + 1]
            own = np.flatnonzero(at < end)
            while len(own):
                k = at[own]
                same = self.known[k] == h[own]
                out[own[same]] = self.order[k[same]]
                at[own] += 1
                own = own[~same & (at[own] < end[own])]
        return out

    def positions(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context, token, text) of every word."""
        text = w.text_of()
        token = self.of(w.hash)
        edge, none = np.full(SIDE, EDGE, np.int16), np.full(SIDE, -1)
        pad = np.concatenate([edge, token, edge], dtype=np.int16, casting="unsafe")
        whose = np.concatenate([none, text, none])
        n = len(token)
        context = np.empty((n, 2 * SIDE), np.int16)
        for k, d in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
            at = slice(SIDE + d, SIDE + d + n)
            context[:, k] = np.where(whose[at] == text, pad[at], np.int16(EDGE))
        return context, token, text


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def counted() -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], ["word", "n"])

    for b in batches:
        for lo, hi in slices(b.column("text")):
            held.append(Words(*text_bytes(b.column("text").slice(lo, hi - lo))).hash)
            if sum(map(len, held)) >= COUNTED:
                yield counted()
    if held:
        yield counted()


class Model(NamedTuple):
    tokens: Tokens
    net: Network
    #: word, n: uses of every word of the corpus.
    counts: DataFrame
    #: Uses of each token.
    uses: np.ndarray
    #: The SENT_WORDS most frequent words (hashes in order) and the logs of their uses.
    sent: tuple[np.ndarray, np.ndarray]


def fit(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> Model:
    """Fit the network on all documents."""
    sc = docs.sparkSession.sparkContext
    own = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counts = scratch_table(own.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    tokens = Tokens(np.array([r["word"] for r in top], np.int64).view(np.uint64))
    freq = np.zeros(VOCAB)
    for r in counts.groupBy(F.pmod("word", F.lit(VOCAB - FREQUENT)).alias("c")).agg(F.sum("n").alias("n")).collect():
        freq[FREQUENT + r["c"]] = r["n"]
    for i, r in enumerate(top):
        freq[i] = r["n"]
        freq[FREQUENT + r["word"] % (VOCAB - FREQUENT)] -= r["n"]
    net = Network.start(freq)
    for r in range(rounds):
        sent = sc.broadcast((tokens, net.flat))

        def train(batches: Iterator[pa.RecordBatch], sent=sent, r=r) -> Iterator[pa.RecordBatch]:
            known, flat = sent.value
            local, squares, seen = Network(flat.copy()), np.full(SIZE, 1e-6, np.float32), 0
            held, step = Network(np.empty(SIZE, np.float32)), np.empty(SIZE, np.float32)
            for b in batches:
                for lo, hi in slices(b.column("text")):
                    w = Words(*text_bytes(b.column("text").slice(lo, hi - lo)))
                    context, token, text = known.positions(w)
                    nth = np.arange(len(token)) - w.first[text]
                    use = np.flatnonzero(nth % rounds == r)
                    use = np.random.default_rng(r).permutation(use)
                    context, token = context[use], token[use]
                    for at in range(0, len(use), BATCH):
                        g = local.gradient(context[at:at + BATCH], token[at:at + BATCH], held)
                        squares += np.multiply(g, g, out=step)
                        g *= RATE
                        g /= np.sqrt(squares, out=step)
                        local.flat -= g
                    seen += len(use)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(SIZE + 1), pa.int32()), pa.array(
                    np.append(local.flat.astype(np.float64) * seen, seen))], ["i", "v"])

        got = own.mapInArrow(train, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
        if len(got):
            v = np.zeros(SIZE + 1)
            v[got["i"]] = got["v"]
            net = Network((v[:-1] / v[-1]).astype(np.float32))
    often = counts.filter("n > 1").orderBy(F.desc("n"), "word").limit(SENT_WORDS).orderBy("word").toPandas()
    return Model(tokens, net, counts, freq, (often["word"].to_numpy(np.int64), np.log(often["n"].to_numpy(np.float64))))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, log_likelihood (summed conditional log-probabilities) and mean_log_prob of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast((model.tokens, model.net.flat, np.log(model.uses[FREQUENT:] + 1), *model.sent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, flat, of_class, often, log_uses = sent.value
        net = Network(flat)
        for b in batches:
            for lo, hi in slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                w = Words(*text_bytes(part.column("text")))
                context, token, text = tokens.positions(w)
                s = np.zeros(len(part))
                for at in range(0, len(token), CHUNK):
                    i = slice(at, at + CHUNK)
                    s += np.bincount(text[i], net.log_prob(context[i], token[i]).astype(np.float64), len(part))
                rare = np.flatnonzero(token >= FREQUENT)
                s -= np.bincount(text[rare], of_class[token[rare] - FREQUENT], len(part))
                word, turn = np.unique(w.hash[rare].view(np.int64), return_inverse=True)
                own, left = np.zeros(len(word)), np.ones(len(word), bool)
                if len(often):
                    at = np.minimum(np.searchsorted(often, word), len(often) - 1)
                    left = often[at] != word
                    own[~left] = log_uses[at[~left]]
                s += np.bincount(text[rare], own[turn], len(part))
                rare = rare[left[turn]]
                off = pa.array(np.searchsorted(text[rare], np.arange(len(part) + 1)), pa.int32())
                n = np.bincount(text, minlength=len(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(s), pa.ListArray.from_arrays(off, pa.array(w.hash[rare].view(np.int64)))],
                    ["doc_id", "n_words", "s", "rare"])

    own = id_text(docs, id_col, text_col)
    scored = scratch_table(own.mapInArrow(run, with_fields(own, "n_words long, s double, rare array<long>"))
                           .withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    # Words that stand for a hash class: log of their own uses; a word that the corpus does not have counts as used once, and a
    # word that is used once has a log of 0.
    uses = (scored.select("row", F.explode("rare").alias("word")).join(model.counts.filter("n > 1"), "word")
            .groupBy("row").agg(F.sum(F.log("n")).alias("own")))
    total = F.col("s") + F.coalesce("own", F.lit(0.0))
    return (scored.select("row", "doc_id", "n_words", "s").join(uses, "row", "left")
            .select("doc_id", "n_words", total.alias("log_likelihood"), (total / F.greatest("n_words", F.lit(1))).alias("mean_log_prob")))


def score_report(docs: DataFrame, **how) -> DataFrame:
    """Scores of ``docs`` under a network fitted on all of them."""
    return score(docs, fit(docs, **how))
