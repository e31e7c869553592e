"""Operator 1: toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is a word vector (hashed) plus the mean of its character
trigrams' vectors (hashed, with the word's ends marked).  Two gated recurrent
layers read each window of words in both directions, attention pools their
states, and a linear layer scores the window.  Every overlapping window of
the whole text is scored; the text's score comes from its largest, by a
logistic calibration.

Training is plain numpy in one Spark task on a bounded number of labelled
texts (``bound`` for each label value).  It begins with random windows that
bear their text's label and goes on with each text's largest window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import WordTable, fitted, fold, map_batches, text_or_empty, texts_of, training_rows, worker_cache

WIDTH, STRIDE = 24, 16
DIM, HIDDEN, ATTENTION = 16, 12, 12
WORD_ROWS, CHAR_ROWS = 1 << 13, 1 << 12


class Inputs:
    """Hashed word and trigram rows of the words met so far, bounded by the word table."""

    def __init__(self, limit: int = 250_000):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.table = WordTable(self.limit)
        self.table[b""] = 0  # the padding
        self.word, self.tri, self.tri_at = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        self.tri_end = 1

    def add(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of new words: word row, trigram rows in a line, and where each word's trigrams begin."""
        word = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) & np.uint64(WORD_ROWS - 1)
        # each word between two marks: a word of n bytes has n trigrams
        flat = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(2 * np.arange(len(words)), size)
        tri = ((flat[at] * 0x9E3779B1 + flat[at + 1] * 0x85EBCA77 + flat[at + 2] * 0xC2B2AE3D) >> 7) & (CHAR_ROWS - 1)
        return word.astype(np.int64), tri, begin

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, tuple | None]:
        at = self.table.ids(words)
        new = self.table.take_new()
        return at, self.add(new) if new else None


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid out in a line: each window's text, its first word and its number of words."""
    per = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WIDTH) // STRIDE)), 0)
    text = np.repeat(np.arange(len(counts)), per)
    nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    begin = (np.cumsum(counts) - counts)[text] + nth * STRIDE
    return text, begin, np.minimum(WIDTH, counts[text] - nth * STRIDE)


def new_parameters(seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)
    return {"word": normal(WORD_ROWS, DIM, scale=0.1), "char": normal(CHAR_ROWS, DIM, scale=0.1),
            "wx": normal(2, DIM, 3 * HIDDEN, scale=DIM ** -0.5), "wh": normal(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN ** -0.5),
            "bx": np.zeros((2, 1, 3 * HIDDEN), np.float32), "u": normal(2 * HIDDEN, ATTENTION, scale=(2 * HIDDEN) ** -0.5),
            "v": normal(ATTENTION, scale=ATTENTION ** -0.5), "w": normal(2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5),
            "b": np.zeros(1, np.float32)}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray | None, keep: bool = False):
    """Logits of windows x[width, batch, dim]; mask[width, batch] is 0 on padding.  With ``keep``, also what backward needs."""
    width, n, _ = x.shape
    h2 = 2 * HIDDEN
    both = np.stack([x, x[::-1]])
    xp = (both.reshape(2, width * n, DIM) @ p["wx"] + p["bx"]).reshape(2, width, n, 3 * HIDDEN)
    m = None if mask is None else np.stack([mask, mask[::-1]])[..., None]
    h = np.zeros((2, n, HIDDEN), np.float32)
    states = np.empty((2, width, n, HIDDEN), np.float32)
    steps = []
    for t in range(width):
        hp = h @ p["wh"]
        gates = xp[:, t, :, :h2] + hp[..., :h2]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r = gates[..., :HIDDEN], gates[..., HIDDEN:]
        c = r * hp[..., h2:]
        c += xp[:, t, :, h2:]
        np.tanh(c, out=c)
        new = h - c
        new *= z
        new += c
        if m is not None:
            new = h + m[:, t] * (new - h)
        if keep:
            steps.append((h, hp, z, r, c))
        h = new
        states[:, t] = h
    s = np.concatenate([states[0], states[1, ::-1]], axis=-1)  # width, batch, 2 hidden
    a = np.tanh(s @ p["u"])
    e = a @ p["v"]
    if mask is not None:
        e = np.where(mask > 0, e, np.float32(-1e9))
    e = np.exp(e - e.max(axis=0))
    e /= e.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", e, s)
    logits = pooled @ p["w"] + p["b"]
    return (logits, (both, xp, m, steps, s, a, e, pooled)) if keep else logits


def backward(p: dict[str, np.ndarray], kept, dlogits: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of all but the two tables, and of x."""
    both, xp, m, steps, s, a, e, pooled = kept
    _, width, n, _ = both.shape
    g = {"w": pooled.T @ dlogits, "b": np.array([dlogits.sum()], np.float32)}
    dpool = dlogits[:, None] * p["w"]
    de = np.einsum("nh,tnh->tn", dpool, s)
    ds = e[..., None] * dpool
    de = e * (de - (e * de).sum(axis=0))
    da = de[..., None] * p["v"] * (1 - a * a)
    g["v"] = np.einsum("tn,tna->a", de, a)
    g["u"] = s.reshape(-1, s.shape[-1]).T @ da.reshape(-1, ATTENTION)
    ds = ds + da @ p["u"].T
    dstates = np.stack([ds[..., :HIDDEN], ds[::-1, :, HIDDEN:]])
    dxp = np.empty_like(xp)
    g["wh"] = np.zeros_like(p["wh"])
    dh = np.zeros((2, n, HIDDEN), np.float32)
    wh_t = p["wh"].transpose(0, 2, 1)
    for t in range(width - 1, -1, -1):
        h, hp, z, r, c = steps[t]
        dnew = dh + dstates[:, t]
        skip = 0 if m is None else dnew * (1 - m[:, t])
        if m is not None:
            dnew = dnew * m[:, t]
        dc = dnew * (1 - z) * (1 - c * c)
        dz = dnew * (h - c) * z * (1 - z)
        dr = dc * hp[..., 2 * HIDDEN:] * r * (1 - r)
        dxp[:, t] = np.concatenate([dz, dr, dc], axis=-1)
        dhp = np.concatenate([dz, dr, dc * r], axis=-1)
        g["wh"] += h.transpose(0, 2, 1) @ dhp
        dh = dnew * z + dhp @ wh_t + skip
    flat = dxp.reshape(2, width * n, 3 * HIDDEN)
    g["bx"] = flat.sum(axis=1, keepdims=True)
    g["wx"] = both.reshape(2, width * n, DIM).transpose(0, 2, 1) @ flat
    dboth = (flat @ p["wx"].transpose(0, 2, 1)).reshape(both.shape)
    return g, dboth[0] + dboth[1, ::-1]


def word_vectors(p, rows) -> np.ndarray:
    word, tri, begin = rows
    sums = np.add.reduceat(p["char"][tri], begin, axis=0)
    size = np.diff(np.append(begin, len(tri)))
    return p["word"][word] + sums / size[:, None].astype(np.float32)


class Scorer:
    """Window logits of texts, with the vectors of the words met so far."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.inputs = p, Inputs()
        self._clear()

    def _clear(self) -> None:
        self.inputs.clear()
        self.vectors, self.size = np.zeros((1 << 14, DIM), np.float32), 1

    def logits(self, texts: list[bytes], block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """Each window's text and logit."""
        if self.inputs.table.full():
            self._clear()
        split = [t.lower().split() for t in texts]
        at, rows = self.inputs.ids([w for ws in split for w in ws])
        if rows is not None:
            self._grow(word_vectors(self.p, rows))
        text, begin, count = windows(np.array([len(ws) for ws in split], np.int64))
        out = np.empty(len(text), np.float32)
        order = np.argsort(-count, kind="stable")  # whole windows first, so that they go without a mask
        span = np.arange(WIDTH)[:, None]
        for lo in range(0, len(order), block):
            own = order[lo:lo + block]
            if count[own[-1]] == WIDTH:
                out[own] = forward(self.p, self.vectors[at[begin[own] + span]], None)
            else:
                width = int(count[own[0]])
                mask = (span[:width] < count[own]).astype(np.float32)
                ids = at[np.minimum(begin[own] + span[:width], len(at) - 1)]
                out[own] = forward(self.p, self.vectors[ids] * mask[..., None], mask)
        return text, out

    def _grow(self, new: np.ndarray) -> None:
        if self.size + len(new) > len(self.vectors):
            self.vectors = np.concatenate([self.vectors, np.zeros((max(len(new), len(self.vectors)), DIM), np.float32)])
        self.vectors[self.size:self.size + len(new)] = new
        self.size += len(new)

    def largest(self, texts: list[bytes]) -> np.ndarray:
        """Largest window logit of each text, -inf for texts without words."""
        top = np.full(len(texts), -np.inf)
        text, logit = self.logits(texts)
        np.maximum.at(top, text, logit)
        return top


class _Adam:
    def __init__(self, p, rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g) -> None:
        self.t += 1
        c = self.rate * (1 - 0.999 ** self.t) ** 0.5 / (1 - 0.9 ** self.t)
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.v[k] += 0.001 * (d * d - self.v[k])
            self.p[k] -= c * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)


def learn(texts: list[bytes], y: np.ndarray, rate_of_ones: float, steps: int = 500, later: int = 450, batch: int = 192, seed: int = 1):
    """(parameters, slope, offset): a text's probability is the sigmoid of slope * largest logit + offset."""
    rng = np.random.default_rng(seed)
    p = new_parameters(seed)
    adam = _Adam(p, 4e-3)
    inputs = Inputs(limit=1 << 60)
    split = [t.lower().split() for t in texts]
    at, (word, tri, begin_tri) = inputs.ids([w for ws in split for w in ws])
    word, tri = np.concatenate([[0], word]), np.concatenate([[0], tri])  # row 0: the padding
    begin_tri = np.concatenate([[0], begin_tri + 1, [len(tri)]])
    text, begin, count = windows(np.array([len(ws) for ws in split], np.int64))
    fit = rng.random(len(texts)) < 0.8
    span = np.arange(WIDTH)[:, None]

    def train(own: np.ndarray, target: np.ndarray) -> None:
        mask = (span < count[own]).astype(np.float32)
        ids, inverse = np.unique(at[np.minimum(begin[own] + span, len(at) - 1)], return_inverse=True)
        size = begin_tri[ids + 1] - begin_tri[ids]
        first = np.cumsum(size) - size
        parts = tri[np.arange(size.sum()) + np.repeat(begin_tri[ids] - first, size)]
        vec = word_vectors(p, (word[ids], parts, first))
        x = vec[inverse.reshape(WIDTH, len(own))] * mask[..., None]
        logits, kept = forward(p, x, mask, keep=True)
        g, dx = backward(p, kept, ((sigmoid(logits) - target) / len(own)).astype(np.float32))
        dvec = np.zeros_like(vec)
        np.add.at(dvec, inverse.ravel(), (dx * mask[..., None]).reshape(-1, DIM))
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], word[ids], dvec)
        np.add.at(g["char"], parts, np.repeat(dvec / size[:, None].astype(np.float32), size, axis=0))
        adam.step(g)

    of_one, of_zero = np.flatnonzero(fit[text] & (y[text] == 1)), np.flatnonzero(fit[text] & (y[text] == 0))
    half = batch // 2
    target = np.concatenate([np.ones(half), np.zeros(half)])
    for _ in range(steps):
        train(np.concatenate([rng.choice(of_one, half), rng.choice(of_zero, half)]), target)
    rounds = 3
    for k in range(rounds):
        adam.rate = 2e-3 / (k + 1)
        tops = np.full(len(texts), -1)
        _, logit = _all_logits(Scorer(p), texts)
        order = np.lexsort((logit, text))
        last = np.append(np.flatnonzero(np.diff(text[order])), len(order) - 1)
        tops[text[order[last]]] = order[last]
        ones, zeros = tops[fit & (y == 1) & (tops >= 0)], tops[fit & (y == 0) & (tops >= 0)]
        for _ in range(later // rounds):
            other = np.concatenate([rng.choice(zeros, half - half // 2), rng.choice(of_zero, half // 2)])
            train(np.concatenate([rng.choice(ones, half), other]), target)
    top = np.full(len(texts), -np.inf)
    tx, logit = _all_logits(Scorer(p), texts)
    np.maximum.at(top, tx, logit)
    held = ~fit & np.isfinite(top)
    if len(np.unique(y[held])) < 2:
        held = np.isfinite(top)
    return p, *_logistic(top[held], y[held], rate_of_ones)


def _all_logits(scorer: Scorer, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [scorer.logits(texts[lo:lo + 128]) for lo in range(0, len(texts), 128)]
    return np.concatenate([t + 128 * i for i, (t, _) in enumerate(parts)]), np.concatenate([x for _, x in parts])


def _logistic(x: np.ndarray, y: np.ndarray, rate_of_ones: float) -> tuple[float, float]:
    """Slope and offset by Newton's method, the rows weighted to the table's rate of ones, with a weak pull to 0."""
    share = y.mean()
    weight = np.where(y == 1, rate_of_ones / share, (1 - rate_of_ones) / (1 - share))
    beta, design = np.array([1.0, 0.0]), np.stack([x, np.ones_like(x)], axis=1)

    def loss(b: np.ndarray) -> float:
        margin = np.where(y == 1, 1, -1) * (design @ b)
        return float((weight * np.logaddexp(0, -margin)).sum() + 0.5e-1 * b @ b)

    for _ in range(50):
        q = sigmoid(design @ beta)
        grad = design.T @ (weight * (q - y)) + 1e-1 * beta
        hess = design.T @ (design * (weight * q * (1 - q))[:, None]) + 1e-1 * np.eye(2)
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
    return float(beta[0]), float(beta[1])


def score_toxicity(docs: DataFrame, labels: DataFrame, train: Column, label: str = "toxic", bound: int = 2500) -> DataFrame:
    """doc_id and score for each row of ``docs``; learned from labelled rows where ``train`` (a Column of _id) holds.

    Texts without words (null and empty ones too) score 0.  Of several labels
    for one id the largest counts; null ids and labels take no part in
    learning.  Without labelled rows of both values every score is 0.  Rows
    repeated or with null ids are scored like others; an empty table gives an
    empty result; only doc_id, text and the label are read.
    """
    rows, n = training_rows(docs, labels, label, train, bound, "toxicity")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))

    def fit(t: pa.Table):
        y = t["y"].to_numpy()
        texts = t["text"].to_pylist()
        if len(np.unique(y)) < 2 or not any(x.split() for x in texts):
            return None
        order = sorted(range(len(texts)), key=lambda i: (t["doc_id"][i].as_py(), texts[i]))
        return learn([texts[i] for i in order], y[order].astype(np.float64), n[1] / (n[0] + n[1]))

    model = fitted(rows.select("doc_id", F.col("text").cast("binary").alias("text"), "y"), fit) if n.get(0) and n.get(1) else None
    if model is None:
        return slim.select("doc_id", F.lit(0.0).alias("score"))
    p, slope, offset = model
    mark = float(p["u"].sum()) + float(p["wh"].sum())

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        scorer = worker_cache(("toxicity", mark), lambda: Scorer(p))
        texts, tops = texts_of(b.column(1)), []
        for lo in range(0, len(texts), 128):
            tops.append(scorer.largest(texts[lo:lo + 128]))
        top = np.concatenate(tops) if tops else np.zeros(0)
        score = np.where(np.isfinite(top), sigmoid(slope * np.where(np.isfinite(top), top, 0) + offset), 0.0)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return map_batches(slim, run, "doc_id long, score double")


def predict_toxicity(docs: DataFrame, labels: DataFrame, held: int = 1, folds: int = 3, threshold: float = 0.7, bound: int = 2500) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from labelled rows whose fold is not ``held``."""
    out = score_toxicity(docs, labels, fold("_id", folds) != held, bound=bound)
    return out.select("doc_id", (fold("doc_id", folds) == held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
