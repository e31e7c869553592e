"""Operator 7: near duplicates by circulant MinHash, banding and exact Jaccard verification.

Shingles are hashed into a universe of ``2 ** 20`` positions.  One
permutation scatters them, a second, circularly shifted by 0, 1, 2, ...,
gives all signature coordinates: coordinate ``k`` is the least value of the
second permutation at ``position + k``, so a shingle's contributions to all
coordinates are one contiguous slice of a table.

1. Each text gives its shingle count, a 128-bit digest of its shingle set,
   its band keys and one low bit of each signature coordinate.  Equal sets are
   one node from here on (their least id).
2. Turns of stars: in each bucket one node of each component that meets there
   is drawn, and the first of those is the bucket's centre.  A node is
   compared with one centre a turn, that of most of its buckets, so a turn
   has no more pairs than nodes.  Pairs are verified on the full sets, links
   are closed to components, and the next turn draws in another order.
3. Where a bucket still holds different components, its nodes are open.  All
   links among open nodes of different components are found by an exact set
   similarity join: every set's shingles are put in one global order, rarest
   first, and two sets that reach the similarity share a shingle among the
   first ``n - ceil(2 p n / (100 + p)) + 1`` of the smaller one and the first
   ``m - ceil(p m / 100) + 1`` of the larger one.  Of texts that share
   boilerplate but lie below the similarity, those first shingles are their
   own words, so no pair of them arises, however many they are.  Within a
   shingle's rows the pairs of its most frequent component are left out by
   joining the other components' rows alone with all.  A pair that shares
   several first shingles is a row at the rarest of them only.
4. A node that links with one component links with many of its nodes where
   the component is large.  So the join is made in rounds: first the other
   components with about ``DRAWN`` nodes of a shingle's most frequent one,
   then with ``DRAWN_MORE`` times as many, and so on; links are closed to
   components after each round, so a node takes few links into the next, and
   the last round, with all nodes, has those left that link with hardly any.

So each pair that shares a bucket is linked, refused, or within one component
already: nothing is capped.  The order's frequencies are counts of hashed
cells (2 ** 21 of them, a bounded table sent to every task); any order is
exact, a good one is only faster.

Before texts are compared, a pair is refused if its set sizes rule the
similarity out, or if its signatures' low bits differ in more places than six
standard deviations above what the similarity gives, which a linked pair does
once in a thousand million.  In the exact join the condition holds a bound of
the overlap: for sets of up to ``MARKED`` shingles that of their 16-bit marks,
which hardly lets through a pair that isn't linked, for larger ones the bits
of ``FINE`` coordinates.  So near misses of small texts are refused within the
join and make no rows; they are still looked at there.

Of the links only what connects components is kept from turn to turn.  The
joins by id are sort-merge joins throughout: their many small broadcasts would
gather in the driver.

With 32 bands of 8 rows a pair of similarity 0.85 shares no bucket with
probability 4e-5, of 0.9 with 2e-8.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import WordTable, fitted, free_name, lean, map_batches, mix64, saved, text_or_empty, texts_of, worker_cache

UNIVERSE = 1 << 20
#: cells of the shingles' frequency table
CELLS = 1 << 21
#: coordinates of the sketches of open nodes
FINE = 4096
#: shingles of an open node up to which its set is compared by marks
MARKED = 256
#: rarest shingles that a row of the join carries, to be made at the first one shared
PRIOR = 64
#: nodes of a shingle's most frequent component that the others are compared with in the first round, and by what the next rounds have more
DRAWN, DRAWN_MORE = 32, 16
#: turns of stars at most; what they leave open is found by the exact join
TURNS = 8
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                0xA0761D6478BD642F], np.uint64)


class _Words:
    """Word hashes of this Python worker, bounded by the word table."""

    def __init__(self):
        self.table, self.hashes = WordTable(), np.zeros(1 << 16, np.uint64)

    def of(self, words: list[bytes]) -> np.ndarray:
        if self.table.full():
            self.table = WordTable()
        ids = self.table.ids(words)
        new = self.table.take_new()
        if new:
            end = len(self.table)
            if end > len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.zeros(max(end, len(self.hashes)), np.uint64)])
            self.hashes[end - len(new):end] = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))
        return self.hashes[ids]


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``words`` words, after lower-casing A-Z.

    A text of fewer words is one shingle of its whole sequence; one without words has none.
    """
    h = worker_cache("minhash", _Words).of(text.lower().split())
    n = len(h)
    if n == 0:
        return h
    w = min(words, n)
    acc = np.full(n - w + 1, w, np.uint64)
    for i in range(w):
        acc = mix64(acc + h[i:n - w + 1 + i] * ODD[i % len(ODD)])
    return np.unique(acc)


@lru_cache(maxsize=2)
def _permutations(coords: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    scatter = rng.permutation(UNIVERSE).astype(np.int64)
    values = rng.permutation(UNIVERSE).astype(np.uint32)
    circle = np.concatenate([values, values[:coords]])
    return scatter, np.lib.stride_tricks.sliding_window_view(circle, coords)


def signature(shingles: np.ndarray, coords: int, seed: int = 7) -> np.ndarray:
    """All ``coords`` coordinates of a non-empty set."""
    scatter, shifted = _permutations(coords, seed)
    at = scatter[(shingles & np.uint64(UNIVERSE - 1)).astype(np.int64)]
    out = shifted[at[:2048]].min(axis=0)
    for i in range(2048, len(at), 2048):
        np.minimum(out, shifted[at[i:i + 2048]].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    acc = mix64(np.arange(1, bands + 1, dtype=np.uint64))
    for i in range(rows):
        acc = mix64(acc + sig[i::rows][:bands].astype(np.uint64) * ODD[i % len(ODD)])
    return acc.view(np.int64)


def sketch(sig: np.ndarray) -> np.ndarray:
    """The coordinates' low bits as 64-bit integers, the last filled with zeros."""
    bits = np.packbits((sig & 1).astype(np.uint8))
    return np.frombuffer(bits.tobytes() + bytes(-len(bits) % 8), np.int64)


def most_differing(coords: int, percent: int) -> int:
    """Differing low bits that a pair of the least linked similarity passes with six standard deviations."""
    p = (1 - percent / 100) / 2
    return int(coords * p + 6 * (coords * p * (1 - p)) ** 0.5)


def _bits_agree(a: str, b: str, coords: int, percent: int):
    """Whether two sketches allow the similarity."""
    words = range(-(-coords // 64))
    differ = sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in words), F.lit(0))
    return differ <= most_differing(coords, percent)


def marks(shingles: np.ndarray) -> np.ndarray:
    """The distinct last 16 bits of the shingles."""
    return np.unique((shingles & np.uint64(0xFFFF)).astype(np.uint16)).view(np.int16)


def _marks_agree(percent: int):
    """Whether the marks of x and y allow the similarity.

    Common shingles that share a mark count once in the intersection; each set has at most n - size(marks) of those.
    """
    lost = F.least(F.col("x_n") - F.size("x_marks"), F.col("y_n") - F.size("y_marks"))
    return (100 + percent) * (F.size(F.array_intersect("x_marks", "y_marks")) + lost) >= percent * (F.col("x_n") + F.col("y_n"))


def _may_link(a: str, b: str, coords: int, percent: int):
    """Whether sizes and sketches allow the similarity; a and b name columns with n and bits."""
    sizes = 100 * F.least(f"{a}.n", f"{b}.n") >= percent * F.greatest(f"{a}.n", f"{b}.n")
    return sizes & _bits_agree(f"{a}.bits", f"{b}.bits", coords, percent)


def _signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, keys, bits = [], [], [], []
        for t in texts_of(b.column(1)):
            s = shingle_set(t, words)
            counts.append(len(s))
            digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            sig = signature(s, bands * rows) if len(s) else None
            keys.append(band_keys(sig, bands, rows) if len(s) else None)
            bits.append(sketch(sig) if len(s) else None)
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
             pa.array(bits, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "digest", "bands", "bits"])
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_batches(cols, run, "doc_id long, n_shingles long, digest binary, bands array<long>, bits array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity.

    The pairs of an ``a`` that has many are dealt over several keys, each with its copy of the text.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / 512).cast("int").alias("k"))
    dealt = pairs.join(parts.hint("merge"), "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("k")).cast("int").alias("s"))
    left = (texts.join(parts.hint("merge"), F.col("id") == F.col("a"))
            .select("a", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("s"), F.col("text").alias("ta")))
    joined = (dealt.hint("merge").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
              .hint("merge").join(left, ["a", "s"]).select("a", "b", "ta", "tb"))

    def run(batches):
        last, sa = None, None
        for batch in batches:
            ok = []
            for ta, tb in zip(texts_of(batch.column(2)), texts_of(batch.column(3))):
                if ta != last:
                    last, sa = ta, shingle_set(ta, words)
                sb = shingle_set(tb, words)
                common = len(sa) + len(sb) - len(np.union1d(sa, sb))
                ok.append(100 * common >= percent * (len(sa) + len(sb) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return joined.mapInArrow(lean(run), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component): the least id reachable over ``links`` (a, b), for each linked id.

    Rounds of taking the neighbours' least label and then that label's own
    label, each saved to shared files, until no label changes.
    """
    both = saved(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = saved(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b").hint("merge"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("_n"))
        step = labels.join(near.hint("merge"), "id").select("id", F.col("component").alias("_was"), F.least("component", "_n").alias("_c"))
        jump = labels.select(F.col("id").alias("_c"), F.col("component").alias("_j"))
        new = saved(step.join(jump.hint("merge"), "_c").select("id", F.least("_c", "_j").alias("component"), "_was"), "labels")
        labels = new.select("id", "component")
        if new.where("component <> _was").isEmpty():
            return labels


def joined_components(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` (id, component; None: every node by itself) after ``links`` (a, b): the links are taken to the labels first."""
    if labels is None:
        return components(links)
    for side in "ab":
        of = labels.select(F.col("id").alias(side), F.col("component").alias("_c")).hint("merge")
        links = links.join(of, side, "left").withColumn(side, F.coalesce("_c", side)).drop("_c")
    found = components(links.where("a <> b").select("a", "b").distinct())
    moved = found.select(F.col("id").alias("component"), F.col("component").alias("_c")).hint("merge")
    old = labels.join(moved, "component", "left").select("id", F.coalesce("_c", "component").alias("component"))
    new = found.join(labels.select("id").hint("merge"), "id", "left_anti")
    return saved(old.unionByName(new.select("id", "component")), "labels")


def _one_centre(entries: DataFrame, turn: int) -> DataFrame:
    """(a, b): nodes b, one of each component in a bucket, with the centre a of most of their buckets.

    ``entries``: key, node, c.  The order by which a bucket's centre and its
    components' nodes are drawn is another in each turn, the same in all
    buckets, so that nodes meet in few pairs and later turns try others.
    """
    drawn = entries.groupBy("key", "c").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("o"), "node")).alias("d"))
    centres = drawn.groupBy("key").agg(F.min(F.struct("d", "c")).alias("m"), F.count("*").alias("_n")).where("_n > 1")
    met = drawn.join(centres, "key").where("c <> m.c").groupBy(F.col("d.node").alias("b"), F.col("m.d.node").alias("a")).agg(F.count("*").alias("_n"))
    return met.groupBy("b").agg(F.max_by("a", F.struct("_n", -F.col("a"))).alias("a")).select("a", "b")


def first_shingles(shingles: np.ndarray, often: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The shingles a larger set is found by, rarest first, and how many of them a smaller one is found by."""
    n = len(shingles)
    order = np.lexsort((shingles, often[(shingles & np.uint64(CELLS - 1)).astype(np.int64)]))
    return shingles[order[:n + 1 + (-percent * n) // 100]], n + 1 + (-2 * percent * n) // (100 + percent)


def _frequencies(texts: DataFrame, words: int) -> np.ndarray:
    """How many shingles of all texts fall in each cell, on a scale of logarithms with eight steps to a doubling (0: none), in bytes."""
    def cells(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, words) for t in texts_of(b.column(0))]
        n = np.bincount((np.concatenate(sets) & np.uint64(CELLS - 1)).astype(np.int64)) if sets else np.zeros(0, np.int64)
        at = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], names=["cell", "n"])

    def table(rows: pa.Table) -> np.ndarray:
        out = np.zeros(CELLS, np.uint8)
        out[np.asarray(rows["cell"])] = np.minimum(1 + 8 * np.log2(np.maximum(np.asarray(rows["n"]), 1)), 255)
        return out
    return fitted(map_batches(texts.select("text"), cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")), table)


def _meeting(rows: DataFrame) -> DataFrame:
    """The rows whose shingle several components share: ``minor`` unless of its most frequent one, which has ``most_n`` rows."""
    rows = rows.drop("minor", "most_n")
    per = rows.groupBy("s", "c").agg(F.count("*").alias("_n"))
    shared = per.groupBy(F.col("s").alias("_s")).agg(
        F.count("*").alias("_k"), F.max_by("c", F.struct("_n", "c")).alias("_most"), F.max("_n").alias("most_n")).where("_k > 1")
    return saved(rows.join(shared, F.col("s") == F.col("_s")).select(*rows.columns, (F.col("c") != F.col("_most")).alias("minor"), "most_n"), "shared-shingles")


def _open_rows(open_texts: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (node, c, n, s, at, small, minor, most_n) of the rare shingles at which components meet, and (node, bits, marks, prior) of their nodes."""
    often = open_texts.sparkSession.sparkContext.broadcast(_frequencies(open_texts, words))

    def entries(b: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list[np.ndarray]] = [[], [], [], [], [], []]
        for i, c, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b.column(2))):
            s = shingle_set(t, words)
            if not len(s):
                continue
            rare, small = first_shingles(s, often.value, percent)
            k = len(rare)
            for col, v in zip(cols, (np.full(k, i), np.full(k, c), np.full(k, len(s)), rare.view(np.int64), np.arange(k), np.arange(k) < small)):
                col.append(v)
        whole = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols]
        return pa.RecordBatch.from_arrays([pa.array(w, pa.int64()) for w in whole[:5]] + [pa.array(whole[5].astype(bool))],
                                          names=["node", "c", "n", "s", "at", "small"])

    rows = saved(map_batches(open_texts.select("id", "c", "text"), entries, "node long, c long, n long, s long, at long, small boolean"), "rare-shingles")
    rows = _meeting(rows)

    def sketches(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, words) for t in texts_of(b.column(1))]
        # the larger of two sets that may link has at most 100 / percent of the smaller one's shingles, so both have the one or the other
        bits = [sketch(signature(s, FINE)) if 100 * len(s) >= percent * MARKED else None for s in sets]
        small = [marks(s) if len(s) <= MARKED else None for s in sets]
        # an id with several texts has rows of each, so none of them comes first
        prior = [first_shingles(s, often.value, percent)[0][:PRIOR].view(np.int64) if n == 1 else [] for s, n in zip(sets, b.column(2).to_pylist())]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(bits, pa.list_(pa.int64())), pa.array(small, pa.list_(pa.int16())), pa.array(prior, pa.list_(pa.int64()))],
                                          names=["node", "bits", "marks", "prior"])
    met = open_texts.join(rows.select(F.col("node").alias("id")).distinct(), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"), F.count("*").alias("n"))
    return rows, saved(map_batches(met, sketches, "node long, bits array<long>, marks array<short>, prior array<long>"), "sketches")


def _rows_of_pairs(rows: DataFrame, sketches: DataFrame, percent: int, drawn: int | None = None) -> DataFrame:
    """(a, b) of different components that may reach the similarity, at the first shingle they share.

    With ``drawn``, only those with about so many nodes of a shingle's most
    frequent component, at the shingles where it has more.
    """
    if drawn is not None:
        place = F.pmod(F.xxhash64("node"), F.lit(1_000_000))
        rows = rows.where((F.col("most_n") > drawn) & (F.col("minor") | (place * F.col("most_n") < 1_000_000 * drawn)))
    rows = saved(rows.hint("merge").join(sketches, "node"), "sketched-shingles")
    x, y = (rows.select(*[F.col(c).alias(f"{side}_{c}") for c in rows.columns]) for side in "xy")
    # x is the smaller set (ties by id); both orders of a component that is not the shingle's most frequent with all
    smaller = (F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_node") < F.col("y_node")))
    overlap = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
    may = (smaller & (F.col("x_c") != F.col("y_c")) & (100 * F.col("x_n") >= percent * F.col("y_n"))
           & ((100 + percent) * overlap >= percent * (F.col("x_n") + F.col("y_n"))))
    may &= ~F.arrays_overlap(*[F.slice(f"{side}_prior", F.lit(1), F.col(f"{side}_at").cast("int")) for side in "xy"])
    marked = F.col("x_marks").isNotNull() & F.col("y_marks").isNotNull()
    may &= F.when(marked, _marks_agree(percent)).otherwise(_bits_agree("x_bits", "y_bits", FINE, percent))
    on = F.col("x_s") == F.col("y_s")
    first = x.where("x_small and x_minor").join(y if drawn is None else y.where("not y_minor"), on & may)
    second = x.where("x_small and not x_minor").join(y.where("y_minor"), on & may)
    both = first.select("x_node", "y_node").unionByName(second.select("x_node", "y_node"))
    return both.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b"))


def _open_pairs(open_texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) of different components, by rare shingles: all that may reach the similarity.  ``open_texts``: id, c, text."""
    return _rows_of_pairs(*_open_rows(open_texts, words, percent), percent).distinct()


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85, bands: int = 32, rows: int = 8) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept.

    Linked are documents with ``100 * intersection >= percent * union`` of
    their shingle sets.  Texts without words (null and empty ones too) have
    no shingles and are linked with nothing.  A row's id names its text: rows
    repeated with one id are one node, and each is kept if the id is.  Rows
    with a null id are linked with nothing, have a null component_id and are
    kept.  An empty table gives an empty result; only doc_id and text are read.
    """
    sig = saved(_signatures(docs, words, bands, rows), "signatures")
    nodes = (sig.where("digest is not null and doc_id is not null").groupBy("digest")
             .agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"), F.min_by("bands", "doc_id").alias("bands"),
                  F.min_by("bits", "doc_id").alias("bits")))
    nodes = saved(nodes, "nodes")
    # entries of the buckets that hold more than one node
    every_key = nodes.select("node", F.explode("bands").alias("key"))
    full = every_key.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").select("key")
    entries = saved(every_key.join(full, "key", "left_semi"), "buckets")
    of_node = nodes.select("node", F.struct("n", "bits").alias("x"))
    # the texts of all nodes that share a bucket, found by a sort-merge join at any size
    every = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("text"))
    ids = entries.select(F.col("node").alias("id")).distinct()
    texts = saved(every.join(ids.hint("merge"), "id", "left_semi").distinct(), "bucket-texts")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """Those of the pairs (a, b) whose sizes, sketches and then full sets reach the similarity."""
        near = (pairs.hint("merge").join(of_node.select(F.col("node").alias("a"), "x"), "a")
                .hint("merge").join(of_node.select(F.col("node").alias("b"), F.col("x").alias("y")), "b")
                .where(_may_link("x", "y", bands * rows, percent)).select("a", "b"))
        return saved(_verified(saved(near, f"{name}-pairs"), texts, words, percent), f"{name}-links")

    labels, tested = None, None
    for turn in range(TURNS):
        # buckets that still hold different components
        of = entries.withColumn("c", F.col("node")) if labels is None else (
            entries.join(labels.withColumnRenamed("id", "node").hint("merge"), "node", "left").select("key", "node", F.coalesce("component", "node").alias("c")))
        open_keys = of.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("key")
        of = saved(of.join(open_keys, "key", "left_semi"), "open-buckets")
        pairs = _one_centre(of, turn)
        sorted_pair = (F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
        if tested is not None:
            pairs = pairs.select("*", *sorted_pair).join(tested.hint("merge"), ["lo", "hi"], "left_anti").select("a", "b")
        pairs = saved(pairs, "star")
        n = pairs.count()
        new = linked(pairs, "star")
        fresh = new.count()
        tested = pairs.select(*sorted_pair) if tested is None else tested.union(pairs.select(*sorted_pair))
        if fresh:
            labels = joined_components(labels, new)
            entries = of.select("key", "node")
        if 10 * fresh < n or not n:  # a turn that links few is the last
            break
    # the nodes still open
    of = entries.withColumn("c", F.col("node")) if labels is None else (
        entries.join(labels.withColumnRenamed("id", "node").hint("merge"), "node", "left").select("key", "node", F.coalesce("component", "node").alias("c")))
    open_keys = of.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("key")
    open_nodes = of.join(open_keys, "key", "left_semi").groupBy(F.col("node").alias("id")).agg(F.first("c").alias("c"))
    open_texts = saved(texts.join(open_nodes.hint("merge"), "id"), "open-texts")
    if not open_texts.isEmpty():
        met, sketches = _open_rows(open_texts, words, percent)
        before = tested.select(F.col("lo").alias("a"), F.col("hi").alias("b")).hint("merge")
        drawn, last = DRAWN, False
        while not last:
            last = (met.agg(F.max("most_n").alias("n")).first()["n"] or 0) <= drawn
            across = _rows_of_pairs(met, sketches, percent, None if last else drawn).distinct()
            more = linked(across.join(before, ["a", "b"], "left_anti"), "open")
            drawn *= DRAWN_MORE
            if not more.isEmpty():
                labels = joined_components(labels, more)
                if not last:
                    now = labels.select(F.col("id").alias("node"), F.col("component").alias("_c")).hint("merge")
                    met = _meeting(met.join(now, "node", "left").withColumn("c", F.coalesce("_c", "c")).drop("_c"))
    found = labels if labels is not None else docs.sparkSession.createDataFrame([], "id long, component long")
    least = nodes.select("digest", "node").join(found.withColumnRenamed("id", "node"), "node", "left").select(
        F.col("digest"), F.coalesce("component", "node").alias("_c"))
    out = sig.select("doc_id", "n_shingles", "digest").join(least, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.col("_c"), F.col("doc_id")))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 40, rows: int = 6) -> DataFrame:
    """The rows of ``docs`` whose id stays (one of each component), with all their columns.

    An id goes only if every row that bears it does.  With 40 bands of 6 rows
    a pair of similarity 0.8 shares no bucket with probability 5e-6.
    """
    found = near_duplicates(docs, words, percent, bands, rows).where("doc_id is not null")
    own = free_name(docs, "id")
    gone = found.groupBy(F.col("doc_id").alias(own)).agg(F.max("kept").alias("kept")).where("not kept").select(own)
    return docs.join(gone, F.col("doc_id") == F.col(own), "left_anti")


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
n AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT DISTINCT a AS doc_id, a AS seen FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.seen = e.a),
m AS (SELECT doc_id, min(seen) AS c FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id, coalesce(m.c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""
