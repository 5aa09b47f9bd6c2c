"""Language identification by segmentation-marginalised unigrams.

Each language is a distribution over the pieces of one fixed public vocabulary. The probability of a word
is the sum over all its segmentations into pieces of the product of their probabilities, which the
forward algorithm adds up letter by letter; the probability of a text is the product over its words. No piece
crosses a word boundary, so a word's probability depends on nothing else and each distinct word is
worked out once per batch, many words of one length at a time, and remembered.

Fitting is expectation-maximisation: expected piece counts (forward times backward) are computed by
Spark tasks over the word counts of each language and summed per (language, piece), at most
languages x vocabulary rows. It reads at most ``SAMPLE_PER_LANG`` labelled texts per language, chosen by a hash of
their ids; prediction covers every whole text.

Words are lower-cased runs of Unicode letters, with the marks that follow them. A word of any length is summed over as a whole:
the forward values of its last few positions are carried on, rescaled as they shrink. Fitting leaves out words beyond
``FIT_LETTERS`` letters. Defined cases: a text without a letter, or null, is ``und`` with score 0; letters outside the
vocabulary have a fixed small probability in every language; ties go to the language first in order; with
nothing to learn from, every text is ``und``; training rows with a null language are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.columns import crc_mod, id_text, scratch_table, slices, with_fields
from martlake.llm.pieces import Memo, once
from martlake.llm.sentencepieces import MARK, NORMAL, Model

#: Labelled texts read per language, at most about.
SAMPLE_PER_LANG = 1_500
ROUNDS = 2
#: Longest word that the model is fitted on.
FIT_LETTERS = 1_000
#: Letters of a word that are looked up at once, and positions after which forward values are rescaled.
BLOCK, RESCALE = 4_096, 16
FLOOR = 1e-8
FOLDS, HELD_OUT = 3, 1

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters with their marks, led by the marker."""
    return [MARK + w for w in _WORD.findall((text or "").lower())]


class Vocabulary:
    """Pieces of lower-case letters, with or without the marker, numbered from 1; 0 is any other letter."""

    def __init__(self, path: str):
        plain = regex.compile(f"{MARK}?[\\p{{L}}\\p{{M}}]*")
        own = [p for p, _, t in Model(path).pieces
               if t == NORMAL and p and p == p.lower() and plain.fullmatch(p)]
        self.pieces = list(dict.fromkeys([MARK, *own]))
        self.longest = max(map(len, self.pieces))
        by_length: dict[int, list[int]] = {}
        for i, x in enumerate(self.pieces, 1):
            by_length.setdefault(len(x), []).append(i)
        self.tables = {}
        for m, numbers in by_length.items():
            h = np.zeros(len(numbers), np.uint64)
            for c in np.array([self.pieces[i - 1] for i in numbers]).view(np.uint32).reshape(-1, m).T:
                h = self._step(h, c)
            order = np.argsort(h)
            if len(np.unique(h)) < len(h):
                raise ValueError("two pieces share a hash")
            maybe = np.zeros(1 << 20, bool)
            maybe[h >> np.uint64(44)] = True
            self.tables[m] = h[order], np.array(numbers, np.int32)[order], maybe

    def __len__(self) -> int:
        return len(self.pieces)

    @staticmethod
    def _step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + (c + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)

    def ids(self, words: list[str]) -> np.ndarray:
        """[word, end, length] piece numbers of words of one length; -1: no piece."""
        n = len(words[0])
        code = np.array(words).view(np.uint32).reshape(len(words), n)
        out = np.full((len(words), n + 1, min(n, self.longest) + 1), -1, np.int32)
        out[:, 1:, 1] = 0
        h = np.zeros((len(words), n + 1), np.uint64)
        for m in range(1, out.shape[2]):
            h = self._step(h[:, :n - m + 1], code[:, m - 1:].astype(np.uint64))
            if m in self.tables:
                known, number, maybe = self.tables[m]
                row, start = np.nonzero(maybe[h >> np.uint64(44)])
                got = h[row, start]
                at = np.minimum(np.searchsorted(known, got), len(known) - 1)
                hit = known[at] == got
                out[row[hit], start[hit] + m, m] = number[at[hit]]
        return out


def vocabulary(path: str) -> Vocabulary:
    return once(("langid", path), lambda: Vocabulary(path))


def _by_length(words: list[str], most: int = 48_000) -> Iterator[np.ndarray]:
    """Positions of words of one length, up to ``most`` letters at once."""
    size = np.array([len(w) for w in words])
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield from np.array_split(at, -(-len(at) // max(1, most // int(n))))


def _forward(ids: np.ndarray, p: np.ndarray, known: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """[word, position, language] sums over the segmentations of each prefix, of which the first positions are ``known``.
    They are divided by what is added to ``scale`` (as a logarithm) so that they stay near 1."""
    words, ends, longest = ids.shape
    a = np.zeros((words, ends, p.shape[1]))
    a[:, :known.shape[1]] = known
    for j in range(known.shape[1], ends):
        for m in range(1, min(j, longest - 1) + 1):
            own = np.flatnonzero(ids[:, j, m] >= 0)
            a[own, j] += a[own, j - m] * p[ids[own, j, m]]
        if j % RESCALE == 0:
            by = a[:, j].copy()
            a[:, max(0, j - longest + 1):j + 1] /= by[:, None]
            scale += np.log(by)
    return a


def word_scores(words: list[str], vocab: Vocabulary, p: np.ndarray) -> np.ndarray:
    """log of the summed probability of each word in each language."""
    out = np.zeros((len(words), p.shape[1]), np.float64)
    for at in _by_length(words):
        own = [words[i] for i in at]
        known, scale = np.ones((len(own), 1, p.shape[1])), np.zeros((len(own), p.shape[1]))
        for lo in range(0, len(own[0]), BLOCK):
            back = known.shape[1] - 1  # positions before the block that its first pieces may start from
            known = _forward(vocab.ids([w[lo - back:lo + BLOCK] for w in own]), p, known, scale)[:, -vocab.longest:]
        out[at] = np.log(known[:, -1]) + scale
    return out


def expected_counts(words: list[str], counts: np.ndarray, lang: np.ndarray, vocab: Vocabulary, p: np.ndarray) -> np.ndarray:
    """[piece, language] expected uses of each piece in the given words."""
    out, log_p = np.zeros(p.size), np.log(p)
    for at in _by_length(words):
        ids, own, rows = vocab.ids([words[i] for i in at]), lang[at], np.arange(len(at))
        n = ids.shape[1] - 1
        a, b = np.full((2, len(at), n + 1), -np.inf)  # logarithms, since long words underflow
        a[:, 0] = b[:, n] = 0
        use = [(j, m, np.flatnonzero(ids[:, j, m] >= 0)) for j in range(1, n + 1) for m in range(1, min(j, ids.shape[2] - 1) + 1)]
        probs = [log_p[ids[k, j, m], own[k]] for j, m, k in use]  # each word under its own language only
        for (j, m, k), q in zip(use, probs, strict=True):
            a[k, j] = np.logaddexp(a[k, j], a[k, j - m] + q)
        for (j, m, k), q in zip(reversed(use), reversed(probs), strict=True):
            b[k, j - m] = np.logaddexp(b[k, j - m], b[k, j] + q)
        z = np.log(counts[at]) - a[rows, n]
        where = np.concatenate([ids[k, j, m] * p.shape[1] + own[k] for j, m, k in use])
        out += np.bincount(where, np.exp(np.concatenate([a[k, j - m] + q + b[k, j] + z[k] for (j, m, k), q in zip(use, probs, strict=True)])),
                           p.size)
    return out.reshape(p.shape)


class LanguageModel:
    """Languages in order, and [piece, language] probabilities."""

    def __init__(self, langs: list[str], p: np.ndarray):
        self.langs, self.p = langs, p


def fit(labelled: DataFrame, vocab_path: str, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        per_lang: int = SAMPLE_PER_LANG, rounds: int = ROUNDS) -> LanguageModel:
    """Fit on at most about ``per_lang`` texts of each non-null language."""
    own = labelled.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                          F.col(text_col).cast("string").alias("text")).filter("lang is not null and text is not null")
    totals = sorted((r["lang"], r["count"]) for r in own.groupBy("lang").count().collect())
    langs = [t[0] for t in totals]
    vocab = vocabulary(vocab_path)
    if not langs:
        return LanguageModel([], np.zeros((len(vocab) + 1, 0)))
    share = F.create_map(*[x for lang, n in totals for x in (F.lit(lang), F.lit(int(min(1.0, per_lang / n) * (1 << 30))))])
    sample = own.filter(F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)) < share[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                words = [[w for w in words_of(t) if len(w) <= FIT_LETTERS] for t in part.column("text").to_pylist()]
                pdf = pd.DataFrame({"lang": np.repeat(part.column("lang").to_pylist(), [len(w) for w in words]),
                                    "word": [x for w in words for x in w]}, dtype=object)
                pdf["n"] = 1
                yield pa.RecordBatch.from_pandas(pdf.groupby(["lang", "word"], as_index=False)["n"].sum(), schema=pa.schema(
                    [("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]), preserve_index=False)

    counts = scratch_table(sample.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
                           .groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    size, number = len(vocab) + 1, {x: i for i, x in enumerate(langs)}
    lengths = np.array([1, *map(len, vocab.pieces)], np.float64)
    p = np.repeat((0.05 ** lengths / (0.05 ** lengths).sum())[:, None], len(langs), axis=1)
    for _ in range(rounds):
        sent = labelled.sparkSession.sparkContext.broadcast(p)

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own_vocab = vocabulary(vocab_path)
            for b in batches:
                e = expected_counts(b.column("word").to_pylist(), b.column("n").to_numpy().astype(np.float64),
                                    np.array([number[x] for x in b.column("lang").to_pylist()], np.int64), own_vocab, sent.value)
                piece, lang = np.nonzero(e)
                yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int64()), pa.array(lang, pa.int64()), pa.array(e[piece, lang])],
                                                 ["piece", "lang", "e"])

        got = counts.mapInArrow(expect, "piece long, lang long, e double").groupBy("piece", "lang").agg(F.sum("e").alias("e")).toPandas()
        e = np.zeros((size, len(langs)))
        e[got["piece"], got["lang"]] = got["e"]
        p = e + 0.01
        p /= p.sum(axis=0)
        p = np.maximum(p, FLOOR)
        p[0] = FLOOR
    return LanguageModel(langs, p)


def predict(docs: DataFrame, model: LanguageModel, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (the share of the predicted language in the text's probability) of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        vocab, k = vocabulary(vocab_path), len(m.langs)
        memo = Memo(lambda new: [x.tobytes() for x in word_scores(new, vocab, m.p)])
        for b in batches:
            for lo, hi in slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                words = [words_of(t) for t in part.column("text").to_pylist()]
                value = memo.look_up(words) if k else None
                langs, scores = [], []
                for w in words:
                    if not w or not k:
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    s = np.frombuffer(b"".join(map(value, w))).reshape(-1, k).sum(axis=0)
                    best = int(np.argmax(s))
                    langs.append(m.langs[best])
                    scores.append(float(1 / np.exp(s - s[best]).sum()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                                 ["doc_id", "lang_pred", "score"])

    own = id_text(docs, id_col, text_col)
    return own.mapInArrow(run, with_fields(own, "lang_pred string, score double"))


def language_report(docs: DataFrame, vocab_path: str, **how) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    model = fit(docs.filter(crc_mod("doc_id", FOLDS) != HELD_OUT), vocab_path, **how)
    return predict(docs, model, vocab_path).select(
        "doc_id", F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")
