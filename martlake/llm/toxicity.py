"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, word pairs, and pairs with one word between, in
2**BITS places. FTRL-proximal keeps a rate of its own for each coordinate and sets a weight to exactly zero
until its evidence exceeds L1, so the fitted model is a few weights out of a million places: that compact list
is what is broadcast for scoring, where only features with a weight are looked up per distinct text feature.

Fitting reads at most about ``SAMPLE_PER_CLASS`` labelled texts of each class, chosen by a hash of the
id; their features are made by Spark tasks and streamed partition by partition through the online
learner, which holds only its coordinates. Scoring covers every whole text.

Defined cases: null or empty text has no features and scores the fitted base rate; labels other than
0 and 1, or null, are not used; several labels of one id: each is used; without labels of both
classes every text scores 0; a document without an id is scored like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.columns import Words, crc_mod, id_text, mix64, scratch_table, slices, text_bytes, with_fields

BITS = 22
#: Labelled texts of each class that the model is fitted on, at most about.
SAMPLE_PER_CLASS = 4_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 3.0, 1.0, 4.0, 0.0
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word, pair and skip-gram occurrence."""
    of, h, n = w.text_of(), w.hash, len(w)
    text, made = [of], [h]
    for gap, salt in ((1, 0x51ED270B), (2, 0x2545F491)):
        if n > gap:
            same = of[gap:] == of[:-gap]
            made.append(mix64(h[:-gap] * np.uint64(0x9FB21C651E98DF25) + h[gap:] + np.uint64(salt))[same])
            text.append(of[gap:][same])
    return np.concatenate(text), (np.concatenate(made) >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """Online learner; coordinate 0 .. 2**BITS - 1 are features, the last one is the base rate."""

    def __init__(self, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << BITS) + 1, np.float64)
        self.n = np.zeros((1 << BITS) + 1, np.float64)

    def weights(self, i: np.ndarray) -> np.ndarray:
        z = self.z[i]
        l1 = np.where(i == 1 << BITS, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(self.n[i])) / self.alpha + self.l2))

    def learn(self, i: np.ndarray, y: int) -> None:
        """One step on a text with the distinct features ``i`` and label ``y``."""
        i = np.append(i, 1 << BITS)
        w = self.weights(i)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[i] = n + g * g


class ToxicityModel:
    """Sorted feature numbers, their weights, and the base rate's weight."""

    def __init__(self, index: np.ndarray, weight: np.ndarray, base: float):
        self.index, self.weight, self.base = index, weight, base

    def score(self, w: Words) -> np.ndarray:
        """Probability of label 1 for each text."""
        s = np.full(len(w.first) - 1, self.base)
        if len(self.index) and len(w):
            text, f = features(w)
            at = np.minimum(np.searchsorted(self.index, f), len(self.index) - 1)
            hit = self.index[at] == f
            pairs = np.unique(text[hit] * len(self.index) + at[hit])  # each feature once per text
            np.add.at(s, pairs // len(self.index), self.weight[pairs % len(self.index)])
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-s))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        per_class: int = SAMPLE_PER_CLASS, epochs: int = EPOCHS) -> ToxicityModel:
    """Fit on labelled texts; ``labels`` has the id and the label (0 or 1)."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("y in (0, 1)")
    totals = dict(known.groupBy("y").count().collect())
    if len(totals) < 2:
        return ToxicityModel(np.empty(0, np.int64), np.empty(0), -np.inf)
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    share = F.when(F.col("y") == 1, int(min(1, per_class / totals[1]) * (1 << 30))).otherwise(int(min(1, per_class / totals[0]) * (1 << 30)))
    sample = known.filter(F.pmod(order, F.lit(1 << 30)) < share)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                text, f = features(Words(*text_bytes(part.column("text"))))
                pairs = np.unique((text << BITS) | f)
                cut = np.searchsorted(pairs, np.arange(len(part) + 1) << BITS)
                f = (pairs & ((1 << BITS) - 1)).astype("<i4")
                yield pa.RecordBatch.from_arrays([part.column("turn"), part.column("y"), pa.array(
                    [f[a:z].tobytes() for a, z in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], ["turn", "y", "f"])

    # The order of the sample is a hash of the id, so the fit does not depend on files or partitions.
    rows = (own.join(F.broadcast(sample), "doc_id")
            .select(F.xxhash64("doc_id", "text").alias("turn"), "y", F.coalesce("text", F.lit("")).alias("text"))
            .mapInArrow(make, "turn long, y int, f binary"))
    rows = scratch_table(rows, "toxicity-features").orderBy("turn", "y")
    learner = Ftrl()
    for _ in range(epochs):
        for r in rows.toLocalIterator(prefetchPartitions=True):
            learner.learn(np.frombuffer(r["f"], "<i4"), r["y"])
    every = np.arange((1 << BITS) + 1)
    w = learner.weights(every)
    index = np.flatnonzero(w[:-1])
    return ToxicityModel(index, w[index], float(w[-1]))


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score >= 0.5) of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                s = sent.value.score(Words(*text_bytes(part.column("text"))))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])

    own = id_text(docs, id_col, text_col)
    return (own.mapInArrow(run, with_fields(own, "score double"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def toxicity_report(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the labels that are not held out."""
    model = fit(docs, labels.filter(crc_mod("doc_id", FOLDS) != HELD_OUT), **how)
    return score(docs, model).select("doc_id", F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                                     "score", "predicted")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the texts that the model rejects, all columns as they were. A row passes through the task
    once, as it is, and is let through or not, in slices of bounded bytes."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(at)):
                part = b.slice(lo, hi - lo)
                s = sent.value.score(Words(*text_bytes(part.column(at))))
                yield part.filter(pa.array(s < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
