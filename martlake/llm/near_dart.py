"""Near-duplicate documents by DartMinHash: sparse weighted minhash signatures, banded joining, exact verification.

Elements are the distinct word N-grams of a text (its whole word sequence if it has fewer words), with weight 1, or
their number of uses (``weights="count"``). The plane of weight x rank is cut into unit cells; hashing throws a Poisson(1)
number of darts into each cell of each element, the same for every document. A dart counts if it falls under
the element's weight, goes to one of COORDINATES coordinates, and the dart of least rank in a coordinate is its value. Ranks
are opened cell by cell until every coordinate has a dart, about k ln k + 2k darts whatever the
number of elements. Two signatures agree in a coordinate with a probability equal to the weighted Jaccard similarity.

Bands of ROWS coordinates are joined. Documents with the same element set are one node first. The buckets of the first FIRST_BANDS
bands come first: their nodes are compared once, and the links found give components, within which nothing is compared
any more, in whatever bucket; of all other buckets only those with several components go on. Nodes of a bucket
of at most SMALL are all compared. In a larger bucket (copies of one text by the thousand) every node is compared with
LEADERS of its nodes, the most central ones: those that share the most buckets, as an original does with its copies. Nodes
that are similar to no leader go on among themselves if they can be similar to any: elements that no other such node has are
lost to every pair, which bounds a node's similarity from above, and rules out copies whose edits are their own.
The others form the bucket anew, with twice the leaders, until at most REST are left. A node that is similar to a leader is settled
and leaves the bucket. What the leaders leave undecided is closed exactly: in every large bucket whose nodes are in several components
by then, nodes outside its largest component are compared with all nodes of other components, except pairs that cannot reach the
threshold by the triangle inequality (1 - similarity is a metric, and all distances to the first leaders are known), by the weight
of the elements that other such nodes have, or by parity sketches: SKETCH_WORDS x 64 bits, of which each element turns over one. Bits
that differ are at most as many as the elements of one text alone, whose weights are 1 or more, and this weight is what a pair's
similarity leaves. So the classes are those of all pairs that share a bucket. Every pair is verified on the
texts themselves (similarity >= THRESHOLD), hot partners split by skew joins. Classes are the connected components of the verified
links, found by alternating star contraction on tables written to the shared folder; each task first joins up the links that it holds.

Defined cases: a text without words (null, empty) is alone in its class; rows with equal element sets are one class; a null
doc_id never names a class unless all its ids are null; of repeated rows of a class's first id one stays; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.columns import Words, mix64, scratch_table, slices, text_bytes, with_fields

N = 5
THRESHOLD = 0.8
ROWS, BANDS = 5, 20
COORDINATES = ROWS * BANDS
#: Nodes of a bucket that are compared with each other.
SMALL = 8
#: Nodes that all others of a larger bucket are compared with, in the first round after the first bands, and in these.
LEADERS = 4
FIRST_LEADERS = 2
#: Rejected members of buckets that are worth another round; fewer are left to the closing step, which compares them anyway.
REST = 1 << 14
#: Bands whose buckets come first: they join four of five pairs of similarity 0.8, and nearly all closer ones.
FIRST_BANDS = 4
#: Rows of the broadcast bitmap that says which nodes' texts are wanted: at most 64 bits each, whatever the input.
BITMAP_WORDS = 1 << 18
#: Words of 64 bits of a node's parity sketch.
SKETCH_WORDS = 1 << 5
#: Links that a task joins up at once.
HELD_LINKS = 1 << 17
#: Documents whose darts are thrown at once.
GROUP = 256

_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 18)]))


# -- signatures -----------------------------------------------------------------------------------------

def elements(w: Words, n: int = N) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, element, uses) of the distinct elements of each text, in order of text and element."""
    size = np.diff(w.first)
    text, made = [], []
    h, inside = w.grams(n)
    text.append(w.text_of()[:len(h)][inside])
    made.append(h[inside])
    for k in range(1, n):  # texts of fewer words: one element
        own = np.flatnonzero(size == k)
        if len(own):
            h, _ = w.grams(k)
            text.append(own)
            made.append(mix64(h[w.first[own]] + np.uint64(k)))
    text, h = np.concatenate(text), np.concatenate(made)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    return text[first], h[first], np.diff(np.append(first, len(h)))


def signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, k: int = COORDINATES) -> np.ndarray:
    """[text, coordinate] dart of least rank; texts without elements get zeros."""
    out = np.zeros((texts, k), np.uint64)
    mass = np.bincount(text, weight, texts)
    open_ = mass > 0
    done = np.zeros(texts, np.int64)  # rank cells opened so far
    goal = np.zeros(texts, np.int64)
    goal[open_] = np.ceil((k * np.log(k) + 2 * k) / mass[open_]).astype(np.int64)
    layers = np.ceil(weight).astype(np.int64)
    while open_.any():
        own = np.flatnonzero(open_[text])
        cells = (goal - done)[text[own]]
        n = cells * layers[own]
        at = np.repeat(own, n)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        rank = done[text[at]] + nth // layers[at]
        layer = nth % layers[at]
        cell = mix64(mix64(element[at] + rank.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + layer.astype(np.uint64))
        darts = np.searchsorted(_POISSON, (cell >> np.uint64(11)).astype(np.float64) * 2.0 ** -53, side="right")
        at, rank, layer = np.repeat(at, darts), np.repeat(rank, darts), np.repeat(layer, darts)
        j = np.arange(len(at)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix64(np.repeat(cell, darts) + (j + 1).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        spot = mix64(dart ^ np.uint64(0xA0761D6478BD642F))
        under = layer + (spot >> np.uint64(40)).astype(np.float64) * 2.0 ** -24 < weight[at]
        at, rank, dart, spot = at[under], rank[under], dart[under], spot[under]
        where = text[at] * k + ((dart >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((rank + (spot & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32, where))
        where, dart = where[order], dart[order]
        first = np.ones(len(where), bool)
        first[1:] = where[1:] != where[:-1]
        where, dart = where[first], dart[first]
        flat = out.reshape(-1)
        free = flat[where] == 0  # darts of earlier cells have lower ranks
        flat[where[free]] = np.maximum(dart[free], np.uint64(1))
        done[open_] = goal[open_]
        open_ &= (out == 0).any(axis=1)
        goal[open_] = 2 * done[open_]
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (sorted elements, weights)."""
    at = np.minimum(np.searchsorted(b[0], a[0]), max(len(b[0]) - 1, 0))
    hit = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    common = np.minimum(a[1][hit], b[1][at[hit]]).sum()
    total = a[1].sum() + b[1].sum() - common
    return float(common / total) if total else 0.0


def _weight(uses: np.ndarray, weights: str) -> np.ndarray:
    return uses.astype(np.float64) if weights == "count" else np.ones(len(uses))


def _sketch(weights: str, text_col: str = "text"):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(_text_of(b, text_col)):
                for lo2 in range(lo, hi, GROUP):
                    part = b.slice(lo2, min(GROUP, hi - lo2))
                    text, h, uses = elements(Words(*text_bytes(_text_of(part, text_col))))
                    weight = _weight(uses, weights)
                    sig = signatures(text, h, weight, len(part))
                    band = _bands(sig)
                    # Order-free 128-bit name of the weighted set.
                    own = mix64(h + uses.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) * np.uint64(weights == "count"))
                    cut = np.searchsorted(text, np.arange(len(part) + 1))
                    node, bands = [], []
                    for d, (a, z) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
                        name = (int(own[a:z].sum()), int(mix64(own[a:z] ^ np.uint64(0xE7037ED1A0B428DB)).sum()) ^ (z - a))
                        node.append(b"".join(x.to_bytes(8, "big") for x in name) if z > a else None)
                        bands.append(band[d].view(np.int64).tolist() if z > a else [])
                    yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(node, pa.binary()),
                                                      pa.array(bands, pa.list_(pa.int64()))], ["row", "node", "bands"])
    return run


def _text_of(batch: pa.RecordBatch, text_col: str) -> pa.Array:
    """The texts inside the rows of a batch."""
    return batch.column("row").field(text_col).cast(pa.string())


def _bands(sig: np.ndarray) -> np.ndarray:
    """[text, band] hashes of ROWS coordinates each."""
    out = np.full((len(sig), BANDS), 0x2545F4914F6CDD1D, np.uint64)
    out += np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        out = mix64(out + sig[:, r::ROWS])
    return out


def _weighted_sets(part: pa.RecordBatch, weights: str) -> tuple[list, list]:
    """The weighted sets of the texts on both sides of pairs (a, b), each distinct text read once."""
    memo: dict[bytes, tuple] = {}
    sides = [part.column("a").to_pylist(), part.column("b").to_pylist()]
    for names, col in zip(sides, ("text_a", "text_b"), strict=True):
        at = {x: i for i, x in enumerate(names) if x not in memo}
        if at:
            text, h, uses = elements(Words(*text_bytes(part.column(col).take(pa.array(list(at.values()))))))
            cut = np.searchsorted(text, np.arange(len(at) + 1))
            for x, lo, hi in zip(at, cut[:-1], cut[1:], strict=True):
                memo[x] = h[lo:hi], _weight(uses[lo:hi], weights)
    return [memo[x] for x in sides[0]], [memo[x] for x in sides[1]]


def _verify(weights: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column("text_b"), 1 << 20):
                part = b.slice(lo, hi - lo)
                left, right = _weighted_sets(part, weights)
                sim = pa.array([similarity(x, y) for x, y in zip(left, right, strict=True)], pa.float64())
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), sim], ["a", "b", "sim"])
    return run


def parity(text: np.ndarray, element: np.ndarray, texts: int, words: int = SKETCH_WORDS) -> np.ndarray:
    """[text, word] sketch of each text: every element turns over the bit that its hash names."""
    spot = mix64(element ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(64 * words)
    odd = np.bincount(text * (64 * words) + spot.astype(np.int64), minlength=texts * 64 * words) & 1
    return np.packbits(odd.astype(np.uint8).reshape(texts, -1), axis=1, bitorder="little").view(np.int64)


def _elements(weights: str):
    """node, the weight of its elements, its parity sketch, and the elements with their weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                text, h, uses = elements(Words(*text_bytes(part.column("text"))))
                w = _weight(uses, weights)
                off = pa.array(np.searchsorted(text, np.arange(len(part) + 1)), pa.int32())
                bits = pa.FixedSizeListArray.from_arrays(pa.array(parity(text, h, len(part)).reshape(-1)), SKETCH_WORDS).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(np.bincount(text, w, len(part))), bits, pa.ListArray.from_arrays(off, pa.array(h.view(np.int64))),
                     pa.ListArray.from_arrays(off, pa.array(w))], ["node", "mass", "bits", "elements", "weights"])
    return run


# -- links and classes ----------------------------------------------------------------------------------

def _texts_of(wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of at least the wanted nodes, one row each; others are left out before the texts are shuffled.

    The bitmap holds a bit of each wanted node's hash. A node whose bit is not set is not wanted; one whose bit is set may not be
    either, so the caller joins on the node. A full bitmap lets all nodes through."""
    h = F.xxhash64("node")
    word = F.pmod(h, F.lit(BITMAP_WORDS)).cast("int")
    bit = F.expr("shiftleft(1L, cast(pmod(shiftright(xxhash64(node), 32), 64) AS INT))")
    bitmap = wanted.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    return (nodes.select("node", "text", word.alias("word")).join(F.broadcast(bitmap), "word")
            .filter(F.col("bits").bitwiseAND(bit) != 0).select("node", "text").dropDuplicates(["node"]))


def _with_texts(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) with the text of a document of each node."""
    texts = _texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), nodes)
    return (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .select("a", "b", "text_a", "text_b"))


def _shared(members: DataFrame) -> DataFrame:
    """Members (bucket, node and others) of buckets with several nodes, with the number of nodes."""
    size = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return scratch_table(members.join(size, "bucket"), "near-members")


def _apart(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of buckets whose nodes are in several components, with the label of each node's (a node without a link: itself)."""
    if labels is None:
        return members.withColumn("label", F.col("node"))
    known = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = known.groupBy("bucket").agg((F.min("label") != F.max("label")).alias("several")).filter("several").select("bucket")
    return scratch_table(known.join(several, "bucket"), "near-apart")


def _small_pairs(members: DataFrame) -> DataFrame:
    """All pairs a < b of different components of buckets of at most SMALL nodes."""
    few = members.filter(F.col("n") <= SMALL).groupBy("bucket").agg(F.array_sort(F.collect_set(F.struct("node", "label"))).alias("nodes"))
    pair = F.expr("filter(flatten(transform(nodes, (x, i) -> transform(slice(nodes, i + 2, size(nodes)), y -> "
                  "struct(x.node AS a, y.node AS b, x.label = y.label AS same)))), p -> NOT p.same)")
    return few.select(F.explode(pair).alias("p")).select("p.a", "p.b")


def _star_pairs(members: DataFrame, leaders: int) -> DataFrame:
    """(bucket, k, a, b, same) of the nodes b of larger buckets with each of the bucket's leaders a, the k-th of them, and
    whether they are in one component.

    A node's centrality is the number of nodes it shares buckets with; the most central node of each of
    ``leaders`` hash classes of a bucket leads."""
    large = members.filter(F.col("n") > SMALL)
    central = large.groupBy("node").agg(F.sum("n").alias("c"))
    best = (large.join(central, "node").groupBy("bucket", F.pmod(F.xxhash64("node"), F.lit(leaders)).alias("k"))
            .agg(F.max(F.struct("c", "node", "label")).alias("best"))
            .select("bucket", "k", F.col("best.node").alias("a"), F.col("best.label").alias("label_a")))
    return (large.select("bucket", F.col("node").alias("b"), "label").join(best, "bucket").filter("a <> b")
            .select("bucket", "k", "a", "b", (F.col("label") == F.col("label_a")).alias("same")))


def _compared(members: DataFrame, leaders: int, nodes: DataFrame, weights: str) -> tuple[DataFrame, DataFrame]:
    """(star pairs, verified similarities) of one round over members with labels."""
    stars = scratch_table(_star_pairs(members, leaders), "near-stars")
    pairs = _small_pairs(members).unionByName(stars.filter("NOT same").select("a", "b"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return stars, _verified(scratch_table(pairs, "near-pairs"), nodes, weights)


def _masses(wanted: DataFrame, nodes: DataFrame, weights: str) -> DataFrame:
    """(node, mass, bits, c) of the wanted nodes: their weight, parity sketch, and how much weight is on elements that other wanted nodes have too."""
    texts = _texts_of(wanted, nodes).join(wanted.select("node").distinct(), "node", "left_semi")
    made = "node binary, mass double, bits array<long>, elements array<long>, weights array<double>"
    sets = scratch_table(texts.mapInArrow(_elements(weights), made), "near-sets")
    own = (sets.select("node", F.explode(F.arrays_zip("elements", "weights")).alias("e"))
           .groupBy("e.elements").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), F.min("e.weights").alias("w"))
           .filter("n = 1").groupBy("node").agg(F.sum("w").alias("own")))
    return sets.select("node", "mass", "bits").join(own, "node", "left").select("node", "mass", "bits", (F.col("mass") - F.coalesce("own", F.lit(0.0))).alias("c"))


def _may_reach(known: DataFrame, threshold: float) -> DataFrame:
    """Those of (bucket, node, mass, c, least) whose similarity to another node of the bucket may reach the threshold.

    With weight m, of which c is on elements that other nodes have too, a node's similarity to
    one of weight s is at most min(c, s) / (m + s - min(c, s)), greatest for the least s that is not below c."""
    s = F.greatest("least", "c")
    return known.filter(F.col("c") >= threshold * (F.col("mass") + s - F.col("c")) - 1e-9)


def _can_link(rejected: DataFrame, nodes: DataFrame, weights: str, threshold: float) -> DataFrame:
    """Those of (bucket, node) that may be similar to another of them in the bucket."""
    known = rejected.join(_masses(rejected, nodes, weights), "node")
    least = known.groupBy("bucket").agg(F.min("mass").alias("least"))
    return _may_reach(known.join(least, "bucket"), threshold).select("bucket", "node")


def _verified(pairs: DataFrame, nodes: DataFrame, weights: str) -> DataFrame:
    """(a, b, sim) of the pairs (a, b)."""
    return scratch_table(_with_texts(pairs, nodes).mapInArrow(_verify(weights), "a binary, b binary, sim double"), "near-links")


def links(nodes: DataFrame, weights: str, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Verified links (a, b) between nodes; the members of shared buckets; distances (bucket, k, node, d) to leaders, where
    known.

    The links of large buckets connect nodes with leaders (see the module); _open_pairs has the rest."""
    banded = nodes.select("node", "bands").dropDuplicates(["node"]).select("node", F.posexplode("bands").alias("band", "bucket"))
    every = _shared(banded)
    _, sims = _compared(_apart(every.filter(F.col("band") < FIRST_BANDS), None), FIRST_LEADERS, nodes, weights)
    found = sims.filter(F.col("sim") >= threshold).select("a", "b")
    labels = components(found)
    members, far, leaders = _apart(every, labels), None, LEADERS
    while not members.isEmpty():
        stars, sims = _compared(members, leaders, nodes, weights)
        ok = sims.filter(F.col("sim") >= threshold).select("a", "b")
        found = found.unionByName(ok)
        apart = stars.withColumn("x", F.least("a", "b")).withColumn("y", F.greatest("a", "b"))
        known = apart.join(sims.select(F.col("a").alias("x"), F.col("b").alias("y"), "sim"), ["x", "y"], "left")
        if far is None:
            far = (known.filter("sim is not null").select("bucket", "k", F.col("b").alias("node"), (1 - F.col("sim")).alias("d"))
                   .unionByName(stars.select("bucket", "k", F.col("a").alias("node"), F.lit(0.0).alias("d")).distinct()))
        # Nodes that are in no leader's component of their bucket; a leader has been compared with all of it.
        led = stars.select("bucket", F.col("a").alias("b")).distinct()
        rejected = (known.groupBy("bucket", "b").agg(F.max(F.col("same") | F.coalesce(F.col("sim") >= threshold, F.lit(False))).alias("ok"))
                    .filter("NOT ok").join(led, ["bucket", "b"], "left_anti").select("bucket", F.col("b").alias("node")))
        rejected = scratch_table(rejected, "near-rejected")
        if rejected.limit(REST + 1).count() <= REST:
            break
        members = _apart(_shared(_can_link(rejected, nodes, weights, threshold)), labels)
        leaders *= 2
    return found, every, far


def _open_pairs(members: DataFrame, far: DataFrame | None, labels: DataFrame, nodes: DataFrame, weights: str, threshold: float) -> DataFrame | None:
    """Pairs (a, b) of nodes of a large bucket that are in different components and may reach the threshold; None if there are none.

    All nodes of a bucket outside its largest component are paired with all of the bucket. A pair is left out only if its distances
    to a leader differ by more than 1 - threshold, if the weight that either has on shared elements is too small for both weights, or if
    their sketches differ in more bits than a pair of the threshold can have elements of one side alone. This needs no texts."""
    label = (members.filter(F.col("n") > SMALL).select("bucket", "node").join(labels, "node", "left")
             .withColumn("label", F.coalesce("label", "node")))
    main = (label.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket")
            .agg(F.max(F.struct("n", "label")).alias("main"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
            .select("bucket", F.col("main.label").alias("main")))
    several = scratch_table(label.join(main, "bucket"), "near-open")
    if several.isEmpty():
        return None
    known, k = several.join(_masses(several, nodes, weights), "node"), range(LEADERS if far is not None else 0)
    if far is not None:
        dist = far.groupBy("bucket", "node").agg(*[F.min(F.when(F.col("k") == i, F.col("d"))).alias(f"d{i}") for i in k])
        known = known.join(dist, ["bucket", "node"], "left")
    known = scratch_table(known, "near-known")
    least = known.groupBy("bucket").agg(F.min("mass").alias("least"))
    outside = _may_reach(known.filter("label <> main").join(least, "bucket"), threshold).drop("least")
    x = outside.select("bucket", *[F.col(c).alias(f"x_{c}") for c in outside.columns if c != "bucket"])
    both = known.join(x, "bucket").filter("label <> x_label").filter(
        F.least("c", "x_c") * (1 + threshold) >= threshold * (F.col("mass") + F.col("x_mass")) - 1e-9)
    for i in k:  # no distance: the bucket has no such leader, or they were in one component and not compared
        both = both.filter(F.coalesce(F.abs(F.col(f"d{i}") - F.col(f"x_d{i}")) <= 1 - threshold + 1e-9, F.lit(True)))
    # A loop, not a term for each word: compiling those took 200 MB of each executor.
    differ = F.expr(f"aggregate(sequence(0, {SKETCH_WORDS - 1}), 0, (n, i) -> n + bit_count(bits[i] ^ x_bits[i]))")
    both = both.filter(differ * (1 + threshold) <= (1 - threshold) * (F.col("mass") + F.col("x_mass")) + 1e-9)
    return scratch_table(both.select(F.least("node", "x_node").alias("a"), F.greatest("node", "x_node").alias("b")).distinct(), "near-pairs")


def linked(sketches: DataFrame, weights: str, threshold: float) -> DataFrame:
    """(node, label) of every node that has a link to a node of a shared bucket; the label is the least node of its component."""
    nodes = sketches.filter("node is not null")
    found, members, far = links(nodes, weights, threshold)
    labels = components(found)  # without any link, those among nodes that do not lead are still to be found
    pairs = _open_pairs(members, far, labels, nodes, weights, threshold)
    if pairs is not None and not pairs.isEmpty():
        more = _verified(pairs, nodes, weights).filter(F.col("sim") >= threshold).select("a", "b")
        if not more.isEmpty():
            labels = components(found.unionByName(more))
    return labels


def local_stars(a: list[bytes], b: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Links from the least node of each component of the links (a, b) to its other nodes."""
    up: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        path = []
        while (y := up.get(x, x)) != x:
            path.append(x)
            x = y
        for p in path:
            up[p] = x
        return x

    for x, y in zip(a, b, strict=True):
        x, y = root(x), root(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    others = list(up)
    return [root(x) for x in others], others


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = [], []

    def stars() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in local_stars(a, b)], ["a", "b"])

    for batch in batches:
        a += batch.column("a").to_pylist()
        b += batch.column("b").to_pylist()
        if len(a) >= HELD_LINKS:
            yield stars()
            a, b = [], []
    yield stars()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with a link; the label is the least node of its component.

    Each round points all neighbours of a node that are larger than it to its least neighbour, then a node and its
    smaller neighbours to their least one, until all links are stars; links stay one or two per node. Before, each task
    puts stars in place of the links that it holds, and the links are dealt to as many tasks as hold HELD_LINKS each, not to more.
    """
    def step(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        turned = e.select(F.col("b").alias("u"), F.col("a").alias("v"))
        near = both.unionByName(turned)
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        joined = near.join(least, "u")
        if large:
            out = joined.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        else:
            out = joined.filter("v < u").select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
                least.filter("m < u").select(F.col("m").alias("a"), F.col("u").alias("b")))
        return out.filter("a <> b").distinct()

    def bent(e: DataFrame) -> bool:
        """Whether a node has several smaller neighbours, or smaller and larger ones."""
        ends = e.select(F.col("a").alias("node"), F.lit(0).alias("smaller")).unionByName(e.select(F.col("b").alias("node"), F.lit(1).alias("smaller")))
        count = ends.groupBy("node").agg(F.sum("smaller").alias("smaller"), F.count(F.lit(1)).alias("n"))
        return not count.filter("smaller > 1 OR smaller = 1 AND n > 1").isEmpty()

    def written(e: DataFrame, tasks: int) -> DataFrame:
        return scratch_table(e.repartition(tasks).mapInArrow(_joined_up, "a binary, b binary"), "near-edges")

    tasks = max(1, -(-edges.count() // HELD_LINKS))
    e = written(edges, tasks)
    while tasks > 1 and bent(e):  # one task has left stars only
        e = written(step(step(e, True), False), max(2, -(-e.count() // HELD_LINKS)))
    return e.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(
        e.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())


def _classes(docs: DataFrame, id_col: str, text_col: str, weights: str, threshold: float) -> DataFrame:
    """row (all columns), id, label (null: alone), class_id, class_size."""
    own = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    sketches = scratch_table(own.mapInArrow(_sketch(weights, text_col), with_fields(own, "node binary, bands array<long>", "row")), "near-sketches")
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    labels = linked(sketches.select(text.alias("text"), "node", "bands"), weights, threshold)
    named = (sketches.select("row", F.col("row").getField(id_col).alias("id"), "node").join(labels, "node", "left")
             .withColumn("label", F.coalesce("label", "node")))
    groups = (named.filter("label is not null").groupBy("label")
              .agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size")))
    return (named.select("row", "id", "label").join(groups, "label", "left")
            .withColumn("class_id", F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("class_id")))
            .withColumn("class_size", F.coalesce("class_size", F.lit(1).cast("long"))))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: str = "set",
                 threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its class), class_size, kept (it names the class)."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = _classes(own, "doc_id", "text", weights, threshold)
    return out.select(F.col("id").alias("doc_id"), "class_id", "class_size", F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: str = "set",
                         threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class, all columns as they were."""
    out = _classes(docs, id_col, text_col, weights, threshold).filter(F.col("id").eqNullSafe(F.col("class_id")))
    alone = out.filter("label is null").select("row.*")
    # Only repeated rows of a class's first id are ranked here.
    one = Window.partitionBy("label").orderBy(F.lit(1))
    first = out.filter("label is not null").withColumn("rank", F.row_number().over(one)).filter("rank = 1").select("row.*")
    return first.unionByName(alone)
