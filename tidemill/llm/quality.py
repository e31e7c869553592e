"""Operator 2: quality scores from random Fourier features of document statistics.

1. One pass over the whole texts computes each document's statistics, saved
   as a slim table.
2. Random Fourier features (cosines of random projections) approximate a
   Gaussian kernel over the standardised statistics.  Each task sums its
   labelled rows' normal equations, the sums are added in a tree, and one
   task solves the ridge system.
3. Labelled rows held back from the fit are counted in score bins, and an
   isotonic fit of the bins turns raw scores into probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import fitted, fold, map_batches, saved, text_or_empty, texts_of

STATS = ("log_chars", "log_words", "word_len", "word_len_sd", "distinct", "top_word", "repeat_next", "upper", "digit", "space",
         "newline", "period", "comma", "exclaim", "symbol", "pipe", "other_punct", "non_ascii", "line_len", "repeat_line",
         "top_line", "no_vowel", "long_word", "sentence_len")
_BYTES = {
    "upper": range(65, 91), "digit": range(48, 58), "space": b" ", "newline": b"\n", "period": b".", "comma": b",", "exclaim": b"!?",
    "symbol": b"#$%&*@^~<>{}[]\\", "pipe": b"|", "other_punct": b"-_=+/:;'\"()`", "non_ascii": range(128, 256)}
_MASKS = np.array([[c in list(v) for c in range(256)] for v in _BYTES.values()], float)


def statistics(text: bytes) -> list[float]:
    """The statistics of one whole text; all are defined for the empty text."""
    size = max(len(text), 1)
    shares = _MASKS @ (np.bincount(np.frombuffer(text, np.uint8), minlength=256) / size)
    by_byte = dict(zip(_BYTES, shares.tolist()))
    words = text.lower().split()
    n = max(len(words), 1)
    lens = np.fromiter(map(len, words), float, len(words))
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    line_counts = Counter(lines)
    m = max(len(lines), 1)
    same = sum(a == b for a, b in zip(words, words[1:]))
    vowelless = sum(c for w, c in counts.items() if w.isascii() and not w.translate(None, b"bcdfghjklmnpqrstvwxz0123456789.,;:!?-'\"()"))
    value = {
        "log_chars": np.log1p(len(text)), "log_words": np.log1p(len(words)),
        "word_len": float(lens.mean()) if len(lens) else 0.0, "word_len_sd": float(lens.std()) if len(lens) else 0.0,
        "distinct": len(counts) / n ** 0.8, "top_word": max(counts.values(), default=0) / n, "repeat_next": same / n,
        "line_len": np.log1p(len(text) / m), "repeat_line": 1 - len(line_counts) / m, "top_line": max(line_counts.values(), default=0) / m,
        "no_vowel": vowelless / n, "long_word": float((lens > 14).mean()) if len(lens) else 0.0,
        "sentence_len": np.log1p(n / (1 + text.count(b". ") + text.count(b".\n"))), **by_byte}
    return [float(value[k]) for k in STATS]


def document_statistics(docs: DataFrame) -> DataFrame:
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([statistics(t) for t in texts_of(b.column(1))], float).reshape(-1, len(STATS))
        return pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c) for c in rows.T]], names=["doc_id", *STATS])
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")), run,
                       "doc_id long, " + ", ".join(f"{s} double" for s in STATS))


class Fourier:
    """cos(x W + b) features of standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, sd: np.ndarray, size: int, width: float, seed: int = 2):
        rng = np.random.default_rng(seed)
        self.mean, self.sd = mean, np.where(sd > 1e-9, sd, 1.0)
        self.w = rng.standard_normal((len(mean), size)) / width
        self.b = rng.uniform(0, 2 * np.pi, size)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.sd, -6, 6)
        return np.concatenate([np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b), np.ones((len(z), 1))], axis=1)


def _matrix(b, first: int = 1) -> np.ndarray:
    return np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(first, first + len(STATS))], axis=1).astype(float)


def _summed(parts: DataFrame) -> DataFrame:
    """Add the partitions' sums: one row for each partition that has any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for s in b.column(0).to_pylist():
                x = np.frombuffer(s)
                total = x.copy() if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])
    return parts.mapInArrow(run, "sums binary")


def isotonic(x: np.ndarray, ones: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over ascending bins: block centres and their rates, each drawn one row toward 1/2."""
    blocks: list[list[float]] = []
    for c, o, k in zip(x, ones, n):
        blocks.append([c * k, o, k])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            a = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], a)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([(b[1] + 0.5) / (b[2] + 1) for b in blocks])


def score_quality(docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality", size: int = 256, width: float | None = None,
                  ridge: float = 1e-3, bins: int = 1000) -> DataFrame:
    """doc_id and score for each row of ``docs``; learned from the labelled rows where ``train`` (a Column of doc_id) holds.

    All labelled rows take part: a quarter of them (by a hash of the id)
    calibrates, the others fit.  Of several labels for one id the largest
    counts; null ids and labels take no part in learning.  With no labelled
    rows, or of one value alone, every score is their rate (0.5 if none).
    Empty and null texts are scored by their statistics, which are all
    defined.  Rows repeated or with null ids are scored like others; an empty
    table gives an empty result.
    """
    stats = saved(document_statistics(docs), "quality-stats")
    lab = (labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y")).where("_id is not null and _y in (0, 1)")
           .groupBy("_id").agg(F.max("_y").alias("_y")))
    learn = saved(stats.where(train).join(lab, F.col("doc_id") == F.col("_id")).drop("_id")
                  .withColumn("_cal", F.pmod(F.xxhash64(F.lit("cal"), F.col("doc_id")), F.lit(4)) == 0), "quality-rows")
    row = learn.agg(F.count("*").alias("n"), F.sum("_y").alias("ones"), *[F.avg(s).alias(f"m_{s}") for s in STATS],
                    *[F.stddev_pop(s).alias(f"s_{s}") for s in STATS]).first()
    n, ones = row["n"], row["ones"] or 0
    if ones in (0, n):
        return stats.select("doc_id", F.lit(ones / n if n else 0.5).alias("score"))
    features = Fourier(np.array([row[f"m_{s}"] for s in STATS]), np.array([row[f"s_{s}"] for s in STATS]), size, width or 0.7 * len(STATS) ** 0.5)
    d = size + 1

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for b in batches:
            if b.num_rows:
                z, y = features(_matrix(b, 0)), b.column(len(STATS)).to_numpy(zero_copy_only=False).astype(float)
                part = np.concatenate([(z.T @ z).ravel(), z.T @ y, [len(y)]])
                sums = part if sums is None else sums + part
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    fit = learn.where("not _cal").select(*STATS, "_y")
    parts = _summed(fit.mapInArrow(normal, "sums binary").repartition(16))

    def solve(t: pa.Table) -> np.ndarray:
        total = sum(np.frombuffer(s) for s in t["sums"].to_pylist()) if t.num_rows else np.zeros(d * d + d + 1)
        a, r, k = total[:d * d].reshape(d, d), total[d * d:-1], total[-1]
        return np.linalg.solve(a + ridge * max(k, 1) * np.eye(d) / size, r)

    weights = fitted(parts, solve)

    def raw(b: pa.RecordBatch) -> pa.RecordBatch:
        x = features(_matrix(b)) @ weights
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(np.clip(x, -0.5, 1.5))], names=["y", "raw"])

    held = map_batches(learn.where("_cal").select("_y", *STATS), raw, "y int, raw double")
    counted = sorted((r["b"], r["n"], r["o"]) for r in held.groupBy(F.floor(F.col("raw") * (bins / 2)).alias("b"))
                     .agg(F.count("*").alias("n"), F.sum("y").alias("o")).collect())
    if not counted:
        counted = [(0, n, ones)]
    b, k, o = (np.array(c, float) for c in zip(*counted))
    centres, rates = isotonic((b + 0.5) * 2 / bins, o, k)

    def score(x: pa.RecordBatch) -> pa.RecordBatch:
        s = np.interp(features(_matrix(x)) @ weights, centres, rates)
        return pa.RecordBatch.from_arrays([x.column(0), pa.array(np.clip(s, 0, 1))], names=["doc_id", "score"])

    return map_batches(stats.select("doc_id", *STATS), score, "doc_id long, score double")


def predict_quality(docs: DataFrame, labels: DataFrame, held: int = 0, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from labelled rows whose fold is not ``held``."""
    out = score_quality(docs, labels, fold("doc_id", folds) != held)
    return out.select("doc_id", (fold("doc_id", folds) == held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
