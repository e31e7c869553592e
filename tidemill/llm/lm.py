"""Operator 6: language-model scores from causal self-attention over subword ids.

A text is its words, each with a blank before it, in the ids of a public
byte-pair vocabulary, and one end.  The model gives the probability of each
id after those before it: causal self-attention (position biases by
distance) and a hidden layer predict the id's class, and the id's share
within its class, given the class of the id before it, comes from counts over
the whole corpus.  A text's score is the log10 of their product over its ids.

Windows of ``WIDTH`` ids overlap by ``LEAD``: each id is scored once, in the
first window that holds it, with at least ``LEAD`` ids before it where there
are as many.

Texts are split and encoded once; their ids are saved, two bytes each with
this vocabulary, and all later passes read those.  A word is counted by a
hash of its ids: only its first id begins with a blank, so they tell it.

What is gathered from the corpus grows with it: one pass counts every word,
every subword and every pair of neighbouring subwords of all training texts;
classes come from the neighbours' counts and shares from the pairs' counts.
The network starts from a bounded number of training texts (``bound``), in
numpy, in one task; then every partition takes it once through all of its
training texts, and the mean of what the partitions learned is kept.

The counts of the ``HEAD`` most frequent words go to the tasks with the
network (a bounded table); a text's rarer words meet their counts in a join
by hash.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import WordTable, drawn, fitted, fold, map_batches, mix64, saved, text_or_empty, texts_of, worker_cache

WIDTH, LEAD = 32, 16
DIM, HIDDEN = 16, 40
SINGLE, GROUPS = 128, 80
HEAD = 50_000
NEAR = 64  # neighbours, by which ids are put into classes
BACK_OFF = 20.0  # ids that the share without context counts for
LOG10E = 0.4342944819032518


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=1)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("lm", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _begins(path: str) -> np.ndarray:
    """Whether an id begins a word, for each id, or is the end: the blank before a word is the only one in its ids."""
    encoding = _encoding(path)
    return np.array([encoding.decode_single_token_bytes(i)[:1] == b" " for i in range(encoding.n_vocab)] + [True])


class Words:
    """Subword ids of the words a Python worker has met, bounded by the word table."""

    def __init__(self, path: str, limit: int = 800_000):
        self.encoding, self.begins, self.limit = _encoding(path), _begins(path), limit
        self.end_id = self.encoding.n_vocab
        self.clear()

    def clear(self) -> None:
        self.table = WordTable(self.limit)
        self.start, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.ids, self.used = np.zeros(1 << 18, np.int32), 0

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Each word's number in the table, in a line, and the number of words of each text."""
        split = [t.lower().split() for t in texts]
        at = self.table.ids([w for ws in split for w in ws])
        new = self.table.take_new()
        if new:
            self._learn(new)
        return at, np.array([len(ws) for ws in split], np.int64)

    def _learn(self, new: list[bytes]) -> None:
        end, at = len(self.table), len(self.table) - len(new)
        while end > len(self.start):
            self.start, self.count = (np.concatenate([x, 0 * x]) for x in (self.start, self.count))
        encode = self.encoding.encode_ordinary
        coded: list[int] = []
        for lo in range(0, len(new), 512):
            some = new[lo:lo + 512]
            line = " " + b" ".join(some).decode("utf-8")
            # many words in a call; a word that holds a blank of another alphabet would be cut by what follows it
            for text in [line] if len(line.split()) == len(some) else [" " + w.decode("utf-8") for w in some]:
                coded += encode(text)
        flat = np.array(coded, np.int32)
        first = np.flatnonzero(self.begins[flat])
        sizes = np.diff(np.append(first, len(flat)))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, 0 * self.ids])
        self.ids[self.used:self.used + len(flat)] = flat
        self.start[at:end], self.count[at:end] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used += len(flat)

    def subwords(self, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a line, and their number for each text."""
        n = self.count[at]
        ends = np.cumsum(n)
        flat = self.ids[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.start[at] - (ends - n), n)]
        upto = np.concatenate([[0], ends])[np.cumsum(counts)]  # where each text's ids end
        return flat, np.diff(np.concatenate([[0], upto]))


def closed(flat: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts in a line, each closed by the end id."""
    return np.insert(flat.astype(np.int64), np.cumsum(sizes), end), sizes + 1


def kind_of(end: int) -> type:
    """The narrowest type for saved ids."""
    return np.uint16 if end <= 0xFFFF else np.uint32


def coded(docs: DataFrame, train, vocabulary: str) -> DataFrame:
    """uid, doc_id, train and ids (without the end, as bytes) of each row: texts are split and encoded once, all later passes read these."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        words = worker_cache(("lm-words", vocabulary), lambda: Words(vocabulary))
        texts, lines, sizes = texts_of(b.column(3)), [], []
        for lo in range(0, len(texts), 256):
            if words.table.full():
                words.clear()
            flat, n = words.subwords(*words.of(texts[lo:lo + 256]))
            lines.append(flat.astype(kind_of(words.end_id)))
            sizes.append(n)
        line = np.concatenate(lines)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) * line.itemsize
        ids = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(line)])
        return pa.RecordBatch.from_arrays([*b.columns[:3], ids.cast(pa.binary())], names=["uid", "doc_id", "train", "ids"])

    slim = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(train, F.lit(False)).alias("train"), text_or_empty().alias("text"))
    return saved(map_batches(slim, run, "uid long, doc_id long, train boolean, ids binary"), "lm-ids")


def id_lines(column: pa.Array, end: int, some: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ids of ``some`` texts at a time in a line, each text closed by the end id, and their sizes."""
    column = column.cast(pa.large_binary())
    kind = kind_of(end)
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(kind) if data is not None else np.zeros(0, kind)
    ends = (ends - ends[0]) // np.dtype(kind).itemsize
    for lo in range(0, len(column), some):
        own = ends[lo:lo + some + 1]
        yield closed(flat[own[0]:own[-1]], np.diff(own), end)


class WordKeys:
    """A 64-bit hash of each word, of its ids: of a number for each id times a power for its place."""

    def __init__(self, path: str):
        self.begins = _begins(path)
        with np.errstate(over="ignore"):
            self.mixed = mix64(np.arange(1, len(self.begins) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For texts closed by the end id: each word's key, and the number of the text it is in."""
        at = np.flatnonzero(self.begins[ids])
        if not len(at):
            return np.zeros(0, np.int64), at
        nth = np.arange(len(ids)) - np.repeat(at, np.diff(np.append(at, len(ids))))
        power = np.full(int(nth.max()) + 1, 0xD6E8FEB86659FD93, np.uint64)
        power[0] = 1
        key = np.add.reduceat(self.mixed[ids] * np.cumprod(power)[nth], at).view(np.int64)
        end = ids[at] == len(self.begins) - 1
        return key[~end], (np.cumsum(end) - end)[~end]


def corpus_counts(ids: DataFrame, vocabulary: str) -> DataFrame:
    """(kind, key, n): of all texts, kind 0 the count of each word by hash, kind 1 that of each subword id.

    Kind 2 counts pairs of neighbouring ids, by id before * number of ids + id;
    before a text's first id comes the end id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_cache(("lm-keys", vocabulary), lambda: WordKeys(vocabulary))
        end = len(words.begins) - 1
        seen = np.zeros(end + 1, np.int64)
        met: dict[int, list[np.ndarray]] = {0: [], 2: []}

        def rows(kind: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key), pa.array(n.astype(np.int64))],
                                              names=["kind", "key", "n"])

        def flush(kind: int) -> pa.RecordBatch:
            key, n = np.unique(np.concatenate([np.zeros(0, np.int64), *met[kind]]), return_counts=True)
            met[kind].clear()
            return rows(kind, key, n)

        for b in batches:
            for line, _ in id_lines(b.column(0), end, 256):
                met[0].append(words.of(line)[0])
                met[2].append(np.concatenate([[end], line[:-1]]) * (end + 1) + line)
                seen += np.bincount(line, minlength=end + 1)
                for kind in met:
                    if sum(map(len, met[kind])) > 2_000_000:
                        yield flush(kind)
        seen[end] = 0
        yield flush(0)
        yield flush(2)
        yield rows(1, np.flatnonzero(seen), seen[seen > 0])

    return ids.select("ids").mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def pair_table(pairs: DataFrame, fn, names: tuple[str, str]) -> DataFrame:
    """``fn`` of (id before, id, n) gives two columns of integers and n, for each batch of pairs."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        cols = fn(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(cols, (np.int32, np.int32, np.int64))], names=[*names, "n"])
    return map_batches(pairs, run, f"{names[0]} int, {names[1]} int, n long")


def stretches(sizes: np.ndarray, step: int = WIDTH - LEAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid out in a line: each window's text, first target and number of targets."""
    per = 1 + np.maximum(0, -(-(sizes - WIDTH) // step))
    text = np.repeat(np.arange(len(sizes)), per)
    nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    return text, (np.cumsum(sizes) - sizes)[text] + nth * step, np.minimum(WIDTH, sizes[text] - nth * step)


CAUSAL = np.tril(np.ones((WIDTH, WIDTH), bool))
DISTANCE = np.maximum(np.arange(WIDTH)[:, None] - np.arange(WIDTH)[None, :], 0)
ROWS = 512  # places whose class probabilities are in memory at a time: they stay in a core's cache
SAFE = np.float32(60)  # within this nothing leaves the range of exp, so no maximum need be taken off


def packed(m: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """What the network has besides its embeddings, in a line, and views of it: biases are a last row of their weights."""
    parts = {"qkv": np.concatenate([m["wq"], m["wk"], m["wv"]], axis=1), "far": m["far"], "w1": np.vstack([m["w1"], m["b1"]]), "w2": np.vstack([m["w2"], m["b2"]])}
    line = np.concatenate([v.ravel() for v in parts.values()]).astype(np.float32)
    return line, views(line, len(m["b2"]))


def views(line: np.ndarray, n_classes: int) -> dict[str, np.ndarray]:
    shapes = {"qkv": (DIM, 3 * DIM), "far": (WIDTH,), "w1": (2 * DIM + 1, HIDDEN), "w2": (HIDDEN + 1, n_classes)}
    cut = np.cumsum([0] + [int(np.prod(v)) for v in shapes.values()])
    return {k: line[lo:hi].reshape(shape) for (k, shape), lo, hi in zip(shapes.items(), cut, cut[1:])}


def unpacked(e: np.ndarray, net: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    wq, wk, wv = np.split(net["qkv"], 3, axis=1)
    return {"e": e, "wq": wq, "wk": wk, "wv": wv, "far": net["far"], "w1": net["w1"][:-1], "b1": net["w1"][-1], "w2": net["w2"][:-1], "b2": net["w2"][-1]}


def projection(net: dict[str, np.ndarray]) -> np.ndarray:
    """(embedding, 1) times this is (q, k, v, 1)."""
    out = np.zeros((DIM + 1, 3 * DIM + 1), np.float32)
    out[:DIM, :-1] = net["qkv"]
    out[DIM, -1] = 1
    return out


def weigh(s: np.ndarray, own: np.ndarray) -> None:
    """exp of attention scores in place, up to a factor for each place that asks; ``own``: a place's score with itself."""
    if s.max() > SAFE or own.min() < -SAFE:
        s -= s.max(axis=2, keepdims=True)
    np.exp(s, out=s)


def class_weights(net: dict[str, np.ndarray], h: np.ndarray, safe: bool, z: np.ndarray) -> np.ndarray:
    """Logits of the classes for hidden states (with a last 1), in ``z``, the maximum taken off unless ``safe``."""
    np.matmul(h, net["w2"], out=z)
    if not safe:
        z -= z.max(axis=1, keepdims=True)
    return z


def safe_classes(net: dict[str, np.ndarray]) -> bool:
    return np.abs(net["w2"]).sum(axis=0).max() < SAFE


def _gradients(e: np.ndarray, net: dict[str, np.ndarray], x: np.ndarray, target: np.ndarray, weight: np.ndarray, g: dict[str, np.ndarray]) -> np.ndarray:
    """Gradients of the mean class cross-entropy over the targets of weight 1: of each place's embedding; the network's go to ``g``.

    The softmax is never divided out: with E = exp(z), its sum and r = weight / sum,
    the gradient of z is r * (E - sum at the target), and r moves to the narrow
    side of each product.  In attention likewise.
    """
    n_windows, n, n_classes = len(x), x.size, net["w2"].shape[1]
    both = np.empty((n, 2 * DIM + 1), np.float32)  # attended, own embedding, 1
    both[:, DIM:-1] = e[x.ravel()]
    both[:, -1] = 1
    qkv = (both[:, DIM:] @ projection(net)).reshape(n_windows, WIDTH, -1)
    q, k, v = qkv[..., :DIM], qkv[..., DIM:2 * DIM], qkv[..., 2 * DIM:]
    s = q @ k.transpose(0, 2, 1)
    s += np.where(CAUSAL, net["far"][DISTANCE], np.float32(-1e9))
    weigh(s, s.diagonal(axis1=1, axis2=2))
    a = (s @ v).reshape(n, -1)  # the column of ones gives the sums
    part = 1 / a[:, DIM:]
    np.multiply(a[:, :DIM], part, out=both[:, :DIM])
    h = np.ones((n, HIDDEN + 1), np.float32)
    np.tanh(both @ net["w1"], out=h[:, :-1])

    dh = np.empty((n, HIDDEN), np.float32)
    back = np.ascontiguousarray(net["w2"][:-1].T)
    share, target = weight.ravel() / weight.sum(), target.ravel()
    z, ones, place, safe = np.empty((min(n, ROWS), n_classes), np.float32), np.ones(n_classes, np.float32), np.arange(ROWS) * n_classes, safe_classes(net)
    g["w2"][:] = 0
    for lo in range(0, n, ROWS):
        own = slice(lo, min(n, lo + ROWS))
        p = class_weights(net, h[own], safe, z[:own.stop - lo])
        np.exp(p, out=p)
        total = p @ ones
        p.ravel()[place[:len(p)] + target[own]] -= total
        r = (share[own] / total)[:, None]
        np.matmul(p, back, out=dh[own])
        dh[own] *= r
        g["w2"] += (h[own] * r).T @ p
    dh *= 1 - h[:, :-1] * h[:, :-1]
    g["w1"][:] = both.T @ dh
    dboth = dh @ net["w1"][:-1].T
    da = np.empty((n, DIM + 1), np.float32)
    np.multiply(dboth[:, :DIM], part, out=da[:, :-1])
    da[:, -1] = -np.einsum("ij,ij->i", da[:, :-1], both[:, :DIM])
    da = da.reshape(n_windows, WIDTH, -1)
    ds = da @ v.transpose(0, 2, 1)
    ds *= s
    g["far"][:] = np.bincount(DISTANCE[CAUSAL], weights=ds.sum(axis=0)[CAUSAL], minlength=WIDTH)
    d = np.concatenate([ds @ k, ds.transpose(0, 2, 1) @ q, s.transpose(0, 2, 1) @ da[..., :-1]], axis=2).reshape(n, -1)
    g["qkv"][:] = both[:, DIM:-1].T @ d
    d = d @ net["qkv"].T
    d += dboth[:, DIM:]
    return d


def summed(d: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The sums of rows by their number."""
    return np.bincount((at[:, None] * DIM + np.arange(DIM)).ravel(), weights=d.ravel(), minlength=n * DIM).reshape(n, DIM).astype(np.float32)


def adam(value: np.ndarray, first: np.ndarray, second: np.ndarray, d: np.ndarray, rate: np.float32) -> None:
    """One step in place; ``d``, the gradient, is used up."""
    step = d - first
    step *= np.float32(0.1)
    first += step
    d *= d
    d -= second
    d *= np.float32(0.01)
    second += d
    np.sqrt(second, out=d)
    d += np.float32(1e-8)
    np.divide(first, d, out=d)
    d *= rate
    value -= d


def columns_of(count: np.ndarray) -> np.ndarray:
    """A number for each of the ``NEAR`` most frequent ids, -1 for others."""
    column = np.full(len(count), -1)
    order = np.argsort(-count, kind="stable")[:NEAR]
    column[order] = np.arange(len(order))
    return column


def _classes(count: np.ndarray, near_counts: tuple[np.ndarray, np.ndarray, np.ndarray], starts_word: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A class for each id: one each for the most frequent and the end, groups by neighbours for others, two for rare ones.

    ``near_counts``: id, column and count, the column of a frequent id after
    it or ``NEAR`` more than the column of one before it.  No class mixes ids
    that begin a word (the end among them) with others.
    """
    n_ids = len(count)
    of = np.where(starts_word, 1, 0)
    order = np.argsort(-count, kind="stable")
    of[n_ids - 1] = 2
    top = [i for i in order[:SINGLE + 1].tolist() if i != n_ids - 1][:SINGLE]
    of[top] = 3 + np.arange(len(top))
    for begins in (False, True):
        rest = np.array([i for i in np.flatnonzero(count >= 5) if of[i] < 2 and starts_word[i] == begins], np.int64)
        if len(rest) < 2 * GROUPS:
            continue
        row = np.full(n_ids, -1)
        row[rest] = np.arange(len(rest))
        near = np.zeros((len(rest), 2 * NEAR))
        own = row[near_counts[0]] >= 0
        near[row[near_counts[0][own]], near_counts[1][own]] = near_counts[2][own]
        near = np.sqrt(near / count[rest][:, None])
        centres = near[rng.choice(len(rest), GROUPS // 2, replace=False)]
        for _ in range(12):
            nearest = ((centres ** 2).sum(axis=1) - 2 * near @ centres.T).argmin(axis=1)
            for c in range(GROUPS // 2):
                if (nearest == c).any():
                    centres[c] = near[nearest == c].mean(axis=0)
        of[rest] = 3 + SINGLE + (GROUPS // 2) * begins + nearest
    return of


def learn(texts: list[bytes], vocabulary: str, count: np.ndarray, near: tuple[np.ndarray, np.ndarray, np.ndarray], steps: int = 3000,
          batch: int = 96, seed: int = 6) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(network, class of each id): the classes from counts over the corpus, the network from a bounded list of texts."""
    rng = np.random.default_rng(seed)
    words = Words(vocabulary, limit=1 << 60)
    at, counts = words.of(texts)
    ids, sizes = closed(*words.subwords(at, counts), words.end_id)
    n_ids = words.end_id + 1
    of = _classes(count, near, words.begins & (np.arange(n_ids) < words.end_id), rng)
    n_classes = 3 + SINGLE + GROUPS

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)
    m = {"e": normal(n_ids, DIM, scale=0.3), "wq": normal(DIM, DIM, scale=0.3), "wk": normal(DIM, DIM, scale=0.3),
         "wv": normal(DIM, DIM, scale=0.3), "far": np.zeros(WIDTH, np.float32), "w1": normal(2 * DIM, HIDDEN, scale=0.2),
         "b1": np.zeros(HIDDEN, np.float32), "w2": normal(HIDDEN, n_classes, scale=0.2), "b2": np.zeros(n_classes, np.float32)}
    _, begin, count = stretches(sizes)
    line = np.concatenate([[words.end_id], ids])  # line[i]: the id before target i
    met, line = np.unique(line, return_inverse=True)  # other embeddings have no gradient
    e, (net_line, net) = m["e"][met], packed(m)
    first, second, g_line = (np.zeros_like(net_line) for _ in range(3))
    e_first, e_second, g = np.zeros_like(e), np.zeros_like(e), views(g_line, n_classes)
    span, classes = np.arange(WIDTH), of[ids]
    for t in range(1, steps + 1):
        own = rng.integers(0, len(begin), batch)
        weight = (span < count[own][:, None]).astype(np.float32)
        place = np.minimum(begin[own][:, None] + span, len(ids) - 1)
        x = line[place]
        d = _gradients(e, net, x, classes[place], weight, g)
        rate = np.float32(5e-3 * min(1, t / 30) * (1 - 0.9 * t / steps) * (1 - 0.99 ** t) ** 0.5 / (1 - 0.9 ** t))
        adam(net_line, first, second, g_line, rate)
        adam(e, e_first, e_second, summed(d, x.ravel(), len(e)), rate)
    m["e"][met] = e
    return unpacked(m["e"], net), of


def _epoch(texts: Iterator[tuple[np.ndarray, np.ndarray]], m: dict[str, np.ndarray], of: np.ndarray, batch: int = 96, top_rate: float = 1e-3):
    """(network, times each id was read, windows read) after going once through the texts: their ids in a line and their sizes."""
    net_line, net = packed(m)
    first, second, g_line = (np.zeros_like(net_line) for _ in range(3))
    g, end = views(g_line, len(m["b2"])), len(of) - 1
    e = np.concatenate([m["e"], 0 * m["e"], 0 * m["e"]], axis=1)  # an embedding and its moments
    read, windows, t, span = np.zeros(len(of), np.int64), 0, 0, np.arange(WIDTH)
    rng = np.random.default_rng(6)
    for ids, sizes in texts:
        _, begin, count = stretches(sizes, WIDTH)
        line, classes = np.concatenate([[end], ids]), of[ids]
        read += np.bincount(line[:-1], minlength=len(of))
        order = rng.permutation(len(begin))
        for lo in range(0, len(order), batch):
            own = order[lo:lo + batch]
            weight = (span < count[own][:, None]).astype(np.float32)
            place = np.minimum(begin[own][:, None] + span, len(ids) - 1)
            x = line[place]
            seen, at = np.unique(x, return_inverse=True)
            at = at.reshape(x.shape)
            rows = e[seen]  # embeddings move where they are read
            d = _gradients(rows[:, :DIM], net, at, classes[place], weight, g)
            t, windows = t + 1, windows + len(own)
            rate = np.float32(top_rate * min(1, t / 30) * len(own) / batch * (1 - 0.99 ** t) ** 0.5 / (1 - 0.9 ** t))
            adam(net_line, first, second, g_line, rate)
            adam(rows[:, :DIM], rows[:, DIM:2 * DIM], rows[:, 2 * DIM:], summed(d, at.ravel(), len(seen)), rate)
            e[seen] = rows
    return unpacked(np.ascontiguousarray(e[:, :DIM]), net), read, windows


def refined(ids: DataFrame, m: dict[str, np.ndarray], of: np.ndarray) -> dict[str, np.ndarray]:
    """The network after each partition took it once through all of its texts: the mean of the partitions' changes.

    An embedding's change is weighted by the times a partition read its id,
    that of the other parameters by its windows.  The sums are rows of
    ``DIM`` numbers, as many as the vocabulary and the network ask for.
    """
    rest = sorted(k for k in m if k != "e")
    flat = lambda p: np.concatenate([p[k].ravel() for k in rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, read, windows = _epoch((x for b in batches for x in id_lines(b.column(0), len(of) - 1, 256)), m, of)
        if windows:
            own = np.flatnonzero(read)
            moved = flat(got) - flat(m)
            moved = np.concatenate([moved, np.zeros(-len(moved) % DIM, np.float32)]).reshape(-1, DIM) * windows
            key = np.concatenate([own, len(of) + np.arange(len(moved))])
            w = np.concatenate([read[own], np.full(len(moved), windows)])
            d = np.concatenate([(got["e"][own] - m["e"][own]) * read[own][:, None], moved]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(w), *[pa.array(c) for c in np.ascontiguousarray(d.T)]],
                                             names=["key", "w", *[f"d{i}" for i in range(DIM)]])

    parts = ids.select("ids").mapInArrow(run, "key long, w long, " + ", ".join(f"d{i} double" for i in range(DIM)))
    got = parts.groupBy("key").agg(F.sum("w").alias("w"), *[F.sum(f"d{i}").alias(f"d{i}") for i in range(DIM)]).toArrow()
    key, w = got["key"].to_numpy(), got["w"].to_numpy()
    mean = np.stack([got[f"d{i}"].to_numpy() for i in range(DIM)], 1) / w[:, None] if len(key) else np.zeros((0, DIM))
    out = {k: v.astype(np.float64) for k, v in m.items()}
    out["e"][key[key < len(of)]] += mean[key < len(of)]
    line = np.zeros((-(-len(flat(m)) // DIM), DIM))
    line[key[key >= len(of)] - len(of)] = mean[key >= len(of)]
    line = line.ravel()
    for k in rest:
        out[k] += line[:m[k].size].reshape(m[k].shape)
        line = line[m[k].size:]
    return {k: v.astype(np.float32) for k, v in out.items()}


def shares_after(of: np.ndarray, seen: np.ndarray, after: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Log probability within its class of each id after an id of each class, float32[classes, ids].

    ``after``: class of the id before, id and count.  Of the share without
    context, ``seen`` gives counts; it counts for ``BACK_OFF`` ids.
    """
    n_classes = 3 + SINGLE + GROUPS
    alone = seen / np.bincount(of, weights=seen)[of]
    order = np.argsort(after[0], kind="stable")
    cut = np.searchsorted(after[0][order], np.arange(n_classes + 1))
    out = np.empty((n_classes, len(of)), np.float32)
    for c in range(n_classes):
        own = order[cut[c]:cut[c + 1]]
        n = np.bincount(after[1][own], weights=after[2][own], minlength=len(of))
        out[c] = np.log((n + BACK_OFF * alone) / (np.bincount(of, weights=n)[of] + BACK_OFF))
    return out


class Scorer:
    def __init__(self, m: dict[str, np.ndarray], of: np.ndarray, share: np.ndarray):
        """``share``: the log probability of each id within its class, or, for each class of the id before, a row of them."""
        self.e, self.of, self.share = m["e"], of, share
        _, self.net = packed(m)
        self.projection, self.safe = projection(self.net), safe_classes(self.net)
        self.ones = np.ones(len(m["b2"]), np.float32)
        bias = np.where(CAUSAL, m["far"][DISTANCE], np.float32(-1e9))
        self.bias = bias[LEAD:].astype(np.float32)

    def hidden(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Hidden states and a last 1 for pieces of ``WIDTH - LEAD`` ids before, each seeing itself and, unless it is a text's ``first``, the piece before it.

        That is what the windows that overlap by ``LEAD`` see.
        """
        step, n = WIDTH - LEAD, len(x)
        both = np.zeros(((n + 1) * step, 2 * DIM + 1), np.float32)
        both[step:, DIM:-1] = self.e[x.ravel()]
        both[:, -1] = 1
        qkv = both[:, DIM:] @ self.projection
        wide = np.lib.stride_tricks.as_strided(qkv, (n, WIDTH, qkv.shape[1]), (step * qkv.strides[0], *qkv.strides), writeable=False)
        s = wide[:, LEAD:, :DIM] @ wide[..., DIM:2 * DIM].transpose(0, 2, 1)
        s += self.bias
        s[first, :, :LEAD] = -1e9
        weigh(s, s[..., LEAD:].diagonal(axis1=1, axis2=2))
        a = (s @ wide[..., 2 * DIM:]).reshape(n * step, -1)  # the column of ones gives the sums
        np.divide(a[:, :DIM], a[:, DIM:], out=both[step:, :DIM])
        h = np.ones((n * step, HIDDEN + 1), np.float32)
        np.tanh(both[step:] @ self.net["w1"], out=h[:, :-1])
        return h

    def scores(self, ids: np.ndarray, sizes: np.ndarray, block: int = 128) -> np.ndarray:
        """Log10 probability of each text; the id before a text's first is the end id."""
        if not len(sizes):
            return np.zeros(0)
        step = WIDTH - LEAD
        line = np.concatenate([[len(self.of) - 1], ids])
        classes, log = self.of[line], np.empty(len(ids))
        per = -(-sizes // step)  # a text's pieces
        nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        begin = np.repeat(np.cumsum(sizes) - sizes, per) + nth * step
        count = np.minimum(step, np.repeat(sizes, per) - nth * step)
        z = np.empty((ROWS, len(self.ones)), np.float32)
        rows, span = np.arange(ROWS) * z.shape[1], np.arange(step)
        for lo in range(0, len(begin), block):
            before = max(lo - 1, 0)  # the piece before is seen, not scored again
            place = np.minimum(begin[before:lo + block, None] + span, len(ids) - 1)
            new = (span < count[lo:lo + block, None]).ravel()
            h = self.hidden(line[place], nth[before:lo + block] == 0)[(lo - before) * step:]
            at = place[lo - before:].ravel()
            if not new.all():
                h, at = h[new], at[new]
            for k in range(0, len(h), ROWS):
                own = at[k:k + ROWS]
                p = class_weights(self.net, h[k:k + ROWS], self.safe, z[:len(own)])
                right = p.ravel()[rows[:len(own)] + classes[own + 1]]
                np.exp(p, out=p)
                log[own] = right - np.log(p @ self.ones)
        log += self.share[ids] if self.share.ndim == 1 else self.share[classes[:-1], ids]
        return np.add.reduceat(log, np.cumsum(sizes) - sizes) * LOG10E


def score_texts(docs: DataFrame, train, bound: int = 1000, vocabulary: str | None = None, head: int = HEAD) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``; ``train`` marks training rows.

    Tokens are the words and one end; a null or empty text is the end alone.
    Words are counted by a 64-bit hash.  Without training rows N and V are 0,
    no token is known, and the network keeps its initial state.  Repeated
    rows count and are scored each by itself, null ids like others; an empty
    table gives an empty result; only doc_id and text are read.
    """
    path = vocabulary or default_vocabulary()
    rows = docs.where(train)
    lines = coded(docs, train, path)
    learned = lines.where("train")
    counts = saved(corpus_counts(learned, path), "lm-counts")
    words = counts.where("kind = 0").select("key", "n")
    n_docs = learned.count()
    total = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_all, distinct = (total["n"] or 0) + n_docs, total["v"] + (n_docs > 0)
    sample = drawn(rows.select("doc_id", "text"), min(1.0, bound / max(n_docs, 1)), "lm")
    sample = sample.select("doc_id", text_or_empty().cast("binary").alias("text"))

    n_ids = _encoding(path).n_vocab + 1
    seen = np.zeros(n_ids)
    for r in counts.where("kind = 1").select("key", "n").collect():  # at most one row for each id of the vocabulary
        seen[r["key"]] = r["n"]
    seen[-1] = n_docs
    pairs = counts.where("kind = 2").select(F.expr(f"key div {n_ids}").alias("before"), (F.col("key") % n_ids).alias("id"), "n")
    column = columns_of(seen)

    def beside(before, after, n):
        right, left = column[after], column[before] + NEAR
        a, b = right >= 0, left >= NEAR
        return np.concatenate([before[a], after[b]]), np.concatenate([right[a], left[b]]), np.concatenate([n[a], n[b]])

    near = pair_table(pairs, beside, ("id", "column")).toArrow()  # at most 2 * NEAR rows for each id
    near = tuple(near[c].to_numpy() for c in ("id", "column", "n"))

    def fit(t: pa.Table):
        pairs = sorted(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        return learn([x for _, x in pairs] or [b""], path, seen, near)

    m, of = fitted(sample, fit)
    m = refined(learned, m, of)
    after = pair_table(pairs, lambda before, i, n: (of[before], i, n), ("class", "id"))
    after = after.groupBy("class", "id").agg(F.sum("n").alias("n")).toArrow()  # at most one row for each id and class
    share = shares_after(of, seen + 0.05, tuple(after[c].to_numpy() for c in ("class", "id", "n")))
    del near, after
    top = words.orderBy(F.desc("n"), "key").limit(head).collect()  # a bounded table
    head_key = np.array([r["key"] for r in top], np.int64)
    head_n = np.array([r["n"] for r in top], np.int64)[np.argsort(head_key)]
    head_key = np.sort(head_key)
    mark = float(m["e"].sum()) + float(share.sum())
    shares = docs.sparkSession.sparkContext.broadcast(share)  # a worker reads it once, not with each task
    del share

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        scorer, keys = worker_cache(("lm", mark, path), lambda: (Scorer(m, of, shares.value), WordKeys(path)))
        cols: list[list] = [[] for _ in range(5)]
        tails: list[np.ndarray] = []
        for ids, sizes in id_lines(b.column(2), len(of) - 1, 128):
            key, where = keys.of(ids)
            i = np.minimum(np.searchsorted(head_key, key), max(len(head_key) - 1, 0))
            known = (head_key[i] == key) if len(head_key) else np.zeros(len(key), bool)
            log = np.log10(head_n[i[known]] + 1.0) if len(head_key) else np.zeros(0)
            cols[0] += (np.bincount(where, minlength=len(sizes)) + 1).tolist()
            cols[1] += np.bincount(where[known], minlength=len(sizes)).tolist()
            cols[2] += np.bincount(where[known], weights=log, minlength=len(sizes)).tolist()
            cols[3] += scorer.scores(ids, sizes).tolist()
            cols[4] += np.bincount(where[~known], minlength=len(sizes)).tolist()
            tails.append(key[~known])
        ends = pa.array(np.cumsum([0] + cols[4]), pa.int32())
        tail = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(tails) if tails else [], pa.int64()))
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()),
             pa.array(cols[3], pa.float64()), tail], names=["uid", "doc_id", "n_tokens", "head_known", "head_log", "score", "tail"])

    scored = saved(map_batches(lines.select("uid", "doc_id", "ids"), run, "uid long, doc_id long, n_tokens long, head_known long, head_log double, score double, tail array<long>"), "lm-scores")
    rare = scored.select("uid", F.explode("tail").alias("key")).join(words, "key")
    rare = rare.groupBy("uid").agg(F.count("*").alias("_known"), F.sum(F.log10(F.col("n") + 1)).alias("_log"))
    end_known = F.lit(1 if n_docs else 0)
    base = (F.col("head_log") + F.coalesce("_log", F.lit(0.0)) + F.lit(float(np.log10(n_docs + 1)))
            - F.col("n_tokens") * F.lit(float(np.log10(n_all + (distinct + 1)))))
    return scored.drop("tail").join(rare, "uid", "left").select(
        "doc_id", "n_tokens", (F.col("head_known") + F.coalesce("_known", F.lit(0)) + end_known).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def score_corpus(docs: DataFrame, held: int = 2, folds: int = 7, bound: int = 1000, vocabulary: str | None = None) -> DataFrame:
    """doc_id, held_out and the columns of ``score_texts``; learned from the rows whose fold is not ``held``."""
    out = score_texts(docs, fold("doc_id", folds) != held, bound, vocabulary)
    return out.select("doc_id", (fold("doc_id", folds) == held).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
