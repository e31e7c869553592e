"""Operator 10: pack documents into sequences by cutting-stock column generation.

1. Tokenise: a document's ids and a closing id are cut into full sequences
   and one rest.  Each piece keeps its length and a checksum of its ids.
2. Rests of an eighth of a sequence or less are laid end to end (a running sum
   by blocks of rows) and cut into bundles of exactly that length, so short
   pieces waste nothing and a sequence may hold any number of them.
3. The length histogram of the other pieces and the bundles (classes of
   ``capacity / 128`` tokens, so 128 at most at any input size) is the demand
   of a cutting-stock problem.  Its
   linear program is solved by column generation: a revised simplex over
   patterns, and a knapsack dynamic program that prices the next pattern.
   Patterns are rounded down, and what is left is filled greedily.
4. Pieces are ranked within their class (by counts of blocks of rows, so no
   task ranks a whole class), and the rank names the pattern's sequence.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.shared import WordTable, fitted, map_batches, saved, text_or_empty, texts_of, worker_cache

CLASSES = 128
#: classes of a bundle of short pieces
BUNDLE = 16
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: how ``word_bpe_49k.json`` normalises and splits a text; any other vocabulary's words all take the whole tokenizer
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
END = "</w>"
# words which that normaliser leaves as they are: of lower-case letters of ASCII and Latin-1, digits and ASCII signs but for
# the apostrophe; and the pieces it splits them into
PLAIN = re.compile(rb"(?:[!-&(-@\[-~]|\xc3[\x9f-\xb6\xb8-\xbf])+")
PIECES = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:-@\[-`{-~]+")


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary; the blank between pieces stays."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden) if b != 32}


class WordIds:
    """Token ids of white-space delimited words, remembered up to a bounded number of words.

    The tokenizer drops white space and splits at it, so the ids of a text
    are those of its words in turn.  Plain words need no normalising and are
    split here; their pieces go to the vocabulary's merges alone, many in a
    call: a piece ends with the one id that closes a piece.
    """

    def __init__(self, path: str, limit: int = 700_000):
        from tokenizers import Tokenizer, pre_tokenizers
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer, self.limit, self.merges = Tokenizer.from_file(path), limit, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if (spec["normalizer"], spec["pre_tokenizer"], spec["post_processor"], spec["model"].get("end_of_word_suffix")) == (NORMALIZER, SPLITTER, None, END):
            self.merges = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}))
            self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
            self.closes = np.zeros(max(spec["model"]["vocab"].values()) + 1, bool)
            self.closes[[i for token, i in spec["model"]["vocab"].items() if token.endswith(END)]] = True
            self.letters = byte_letters()
        self._clear()

    def _clear(self) -> None:
        self.words = WordTable(self.limit)
        self.start, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.ids, self.end = np.zeros(1 << 18, np.int32), 0

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        if self.words.full():
            self._clear()
        # lower-casing first halves the words to learn; "<|" may begin a special token, whose case matters
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        at = self.words.ids([w for ws in split for w in ws])
        new = self.words.take_new()
        if new:
            self._learn(new)
        n = self.count[at]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        flat = np.arange(total, dtype=np.int64) + np.repeat(self.start[at] - (ends - n), n)
        words = np.cumsum([0] + [len(ws) for ws in split])
        upto = np.concatenate([[0], ends])
        return self.ids[flat], np.diff(upto[words])

    def _learn(self, new: list[bytes]) -> None:
        size = len(self.words)
        while size > len(self.start):
            self.start, self.count = np.concatenate([self.start, 0 * self.start]), np.concatenate([self.count, 0 * self.count])
        at = size - len(new)
        for i in range(0, len(new), 16_384):
            self._learn_some(new[i:i + 16_384], at + i)

    def _learn_some(self, new: list[bytes], at: int) -> None:
        split = [PIECES.findall(w) if PLAIN.fullmatch(w) and b"<|" not in w else [] for w in new] if self.merges else [[]] * len(new)
        per = np.fromiter(map(len, split), np.int64, len(new))
        own = np.flatnonzero(per)
        if len(own):
            line = b" ".join([p for ps in split for p in ps]).decode("latin-1").translate(self.letters)
            ids = np.array(self.merges.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == per.sum() and ends[-1] == len(ids):
                self._keep(at + own, np.diff(ends[np.cumsum(per[own]) - 1], prepend=0), ids)
            else:  # a letter that the vocabulary lacks
                per[:] = 0
        rest = np.flatnonzero(per == 0)
        if len(rest):
            words = [new[k].decode("utf-8") for k in rest.tolist()]
            coded = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            self._keep(at + rest, sizes, np.fromiter((x for c in coded for x in c), np.int32, int(sizes.sum())))

    def _keep(self, at: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """``ids``: those of the words numbered ``at`` in a row."""
        while self.end + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, 0 * self.ids])
        self.ids[self.end:self.end + len(ids)] = ids
        self.start[at], self.count[at] = self.end + np.cumsum(sizes) - sizes, sizes
        self.end += len(ids)


def word_ids(path: str) -> WordIds:
    return worker_cache(("packing", path), lambda: WordIds(path))


def cut_pieces(docs: DataFrame, capacity: int, end_id: int, vocabulary: str) -> DataFrame:
    """The pieces; those that fit a bundle keep their ids, which a bundle's end may yet cut."""
    short = BUNDLE * (capacity // CLASSES)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts, doc = texts_of(b.column(1)), b.column(0)
        rows: list[list] = [[], [], [], [], [], []]
        for lo in range(0, len(texts), 256):
            ids, counts = word_ids(vocabulary).of(texts[lo:lo + 256])
            at = 0
            for i, n in enumerate(counts.tolist()):
                whole = np.append(ids[at:at + n], np.int32(end_id)).astype("<u4")
                at += n
                for s in range(0, n + 1, capacity):
                    piece = whole[s:s + capacity]
                    raw = piece.tobytes()
                    for col, v in zip(rows, (lo + i, s, len(piece), zlib.crc32(raw), n + 1, raw if len(piece) <= short else None)):
                        col.append(v)
        cols = [doc.take(pa.array(rows[0], pa.int64()))] + [pa.array(c, pa.int64()) for c in rows[1:5]] + [pa.array(rows[5], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=[*NAMES, "ids"])
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")), run, PIECE + ", ids binary")


def cut_at_bundles(batch: pa.RecordBatch, size: int) -> pa.RecordBatch:
    """Pieces with their ids and their place ``at`` in the row of all short pieces: cut where a bundle ends, with the bundle's number."""
    out: list[list] = [[], [], [], [], [], []]
    doc, start, length, crc, tokens, ids, at = (c.to_pylist() for c in batch.columns)
    for i in range(batch.num_rows):
        room = size - at[i] % size
        first = min(room, length[i])
        whole = first == length[i]
        for lo, n, c in ((0, first, crc[i] if whole else zlib.crc32(ids[i][:4 * first])),
                         (first, length[i] - first, None if whole else zlib.crc32(ids[i][4 * first:]))):
            if n:
                for col, v in zip(out, (doc[i], start[i] + lo, n, c, tokens[i], (at[i] + lo) // size)):
                    col.append(v)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=[*NAMES, "_rank"])


def price_pattern(worth: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity (unbounded knapsack by dynamic programming)."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)  # sizes ascend
    upto = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if upto[c]:
            value = best[c - sizes[:upto[c]]] + worth[:upto[c]]
            i = int(value.argmax())
            if value[i] > best[c] + 1e-12:
                best[c], took[c] = value[i], i
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            pattern[took[c]] += 1
            c -= sizes[took[c]]
    return float(best[capacity]), pattern


def solve_patterns(demand: np.ndarray, sizes: np.ndarray, capacity: int, gap: float = 0.002, rounds: int = 4000) -> list[tuple[np.ndarray, int]]:
    """Patterns with whole multiplicities that cover ``demand`` of each size.

    The value of the linear program over all patterns lies between the
    present one and that over the best pattern's worth, so generation ends
    once the worth is within ``gap`` of 1.
    """
    m = len(sizes)
    if m == 0:
        return []
    cols = [np.eye(m, dtype=np.int64)[i] * (capacity // sizes[i]) for i in range(m)]
    cost = np.ones(m)
    inv = np.diag([1.0 / cols[i][i] for i in range(m)])
    x = inv @ demand
    for k in range(rounds):
        duals = cost @ inv
        value, enter = price_pattern(np.maximum(duals, 0), sizes, capacity)
        price = 1.0
        if value <= 1 + gap:
            i = int(duals.argmin())
            if duals[i] >= -1e-9:
                break
            enter, price = -np.eye(m, dtype=np.int64)[i], 0.0  # more of a size than is asked for
        step = inv @ enter
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        x = np.maximum(x - ratio[out] * step, 0)
        x[out] = max(ratio[out], 0)
        pivot = inv[out] / step[out]
        inv -= np.outer(step, pivot)
        inv[out] = pivot
        cols[out], cost[out] = enter, price
        if k % 200 == 199:
            inv = np.linalg.inv(np.stack(cols, 1).astype(float))
            x = np.maximum(inv @ demand, 0)
    left, result = demand.astype(np.int64).copy(), []

    def use(pattern: np.ndarray, n: int) -> None:
        result.append((pattern, n))
        np.subtract(left, pattern * n, out=left)

    for p, v, c in sorted(((p, v, c) for p, v, c in zip(cols, x, cost) if c), key=lambda t: -t[1]):
        n = int(v + 1e-6)
        held = p > 0
        n = min(n, int((left[held] // p[held]).min())) if held.any() else 0
        if n > 0:
            use(p, n)
    while left.sum() > 0:  # what rounding left: largest first into each further pattern
        room, p = capacity, np.zeros(m, np.int64)
        for i in np.argsort(-sizes):
            p[i] = min(left[i], room // sizes[i])
            room -= p[i] * sizes[i]
        held = p > 0
        use(p, int((left[held] // p[held]).min()))
    return result


def pack(docs: DataFrame, capacity: int = 2048, end_id: int = 1, vocabulary: str | None = None, block: int = 50_000) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``capacity`` is a multiple of 128.  Pieces of an eighth of it or less may
    be cut once more where a bundle ends.  A null or empty text is the closing
    id alone.  Repeated rows are packed each by itself, null ids like others.
    Pieces tied in their class rank by id, start and checksum; those equal in
    all of it are interchangeable.  An empty table gives an empty result, and
    only doc_id and text are read.  Sequences are numbered from 0.
    """
    unit = capacity // CLASSES
    pieces = saved(cut_pieces(docs, capacity, end_id, vocabulary or default_vocabulary()).withColumn("_uid", F.monotonically_increasing_id())
                   .withColumn("_class", F.when(F.col("ids").isNotNull(), 0).otherwise(F.ceil(F.col("length") / F.lit(unit))).cast("int")), "pieces")
    spark = docs.sparkSession
    blocks = max(1, -(-pieces.count() // block))
    pieces = pieces.withColumn("_block", F.pmod(F.xxhash64("_uid"), F.lit(blocks)))  # by row, so a repeated id is spread
    counts = saved(pieces.groupBy("_class", "_block").agg(F.count("*").alias("_n"), F.sum("length").alias("_tokens")), "piece-counts")
    hist = {r["_class"]: (r["n"], r["t"]) for r in counts.groupBy("_class").agg(F.sum("_n").alias("n"), F.sum("_tokens").alias("t")).collect()}
    bundles = -(-hist.pop(0, (0, 0))[1] // (BUNDLE * unit))
    demands = {c: n for c, (n, _) in hist.items()} | ({BUNDLE: bundles} if bundles else {})  # pieces of that class are bundled
    sizes = np.array(sorted(demands), np.int64)
    demand = np.array([demands[s] for s in sizes.tolist()], np.float64)
    patterns = fitted(spark.range(1), lambda _: solve_patterns(demand, sizes, CLASSES))
    # for each class the ranks at which a pattern's slots begin, with the pattern's first sequence and slots
    first = np.cumsum([0] + [n for _, n in patterns])
    slots: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for i, s in enumerate(sizes.tolist()):
        own = [(int(p[i]), n, int(first[k])) for k, (p, n) in enumerate(patterns) if p[i] > 0]
        slots[s] = (np.cumsum([0] + [a * n for a, n, _ in own]), np.array([f for _, _, f in own]), np.array([a for a, _, _ in own]))
    before = Window.partitionBy("_class").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_class", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                           F.coalesce(F.sum("_tokens").over(before), F.lit(0)).alias("_tokens_before"))
    inside = Window.partitionBy("_class", "_block").orderBy("doc_id", "start", "ids_crc32", "_uid")
    whole = pieces.where("_class > 0").drop("ids").withColumn("_r", F.row_number().over(inside)).join(starts, ["_class", "_block"])
    whole = whole.select(*NAMES, "_class", (F.col("_before") + F.col("_r") - 1).alias("_rank"))
    laid = pieces.where("_class = 0").withColumn("_end", F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    laid = laid.join(starts, ["_class", "_block"]).select(*NAMES, "ids", (F.col("_tokens_before") + F.col("_end") - F.col("length")).alias("at"))
    cut = map_batches(laid, lambda b: cut_at_bundles(b, BUNDLE * unit), PIECE + ", _rank long")
    ranked = whole.unionByName(cut.select(*NAMES, F.lit(BUNDLE).alias("_class"), "_rank"))

    def assign(b: pa.RecordBatch) -> pa.RecordBatch:
        cls, rank = b.column(5).to_numpy(zero_copy_only=False), b.column(6).to_numpy(zero_copy_only=False)
        seq = np.zeros(b.num_rows, np.int64)
        for c in np.unique(cls).tolist():
            upto, base, per = slots[c]
            own = np.flatnonzero(cls == c)
            p = np.searchsorted(upto, rank[own], "right") - 1
            seq[own] = base[p] + (rank[own] - upto[p]) // per[p]
        return pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq)],
                                          names=[*NAMES, "sequence_id"])
    placed = map_batches(ranked, assign, PIECE + ", sequence_id long")
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32")
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
