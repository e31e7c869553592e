"""Operator 9: language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
The probability of a word (with a leading blank) is the sum over all its
segmentations into pieces, found by a forward pass; a text's is the product
over its words.  The piece probabilities are learned by expectation
maximisation over all segmentations, on a bounded number of labelled texts
for each language (``bound``).

Words are the letters between ASCII non-letters, lower-cased.  All pieces of
the vocabulary take part, by a 64-bit hash that runs along a word, and words
of any length teach.  Each Python worker remembers the scores of a bounded
number of words.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.shared import WordTable, drawn, fitted, fold, map_batches, text_or_empty, texts_of, worker_cache

PIECE_BYTES = 32  # the longest piece of the vocabulary has 25
BASE, STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95  # odd multipliers of the hash
UNDETERMINED = "und"
# other ASCII characters become blanks, A-Z become a-z
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
ASCII_LETTER = re.compile(rb"[A-Za-z]")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=1)
def pieces_of(path: str) -> np.ndarray:
    """The vocabulary's pieces as sorted hashes, and single bytes for the rest."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    keys = set()
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            keys.add(sp.id_to_piece(i).replace("▁", " ").lower().encode())
    if max(map(len, keys)) > PIECE_BYTES:
        raise ValueError(f"the vocabulary has pieces over {PIECE_BYTES} bytes")
    keys |= {bytes([b]) for b in range(256)}
    return np.sort(np.array([_key(k) for k in keys], np.uint64))


def _key(piece: bytes) -> int:
    value = 0
    for c in piece:
        value = value * BASE + c + 1
    return (value * STEP + len(piece)) % (1 << 64)


def words_of(text: bytes) -> list[bytes]:
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return text.translate(LETTERS).split()


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def lattice(words: list[bytes], keys: np.ndarray) -> np.ndarray:
    """Piece number (or -1) for each word, end position and piece length: int32[words, bytes + 1, longest piece].

    All words have the same number of bytes.
    """
    n, size = len(words), len(words[0]) + 1
    chars = np.frombuffer(b"".join(b" " + w for w in words), np.uint8).reshape(n, size).astype(np.uint64) + np.uint64(1)
    longest = min(PIECE_BYTES, size)
    out = np.full((n, size, longest), -1, np.int32)
    value = chars.copy()
    for k in range(1, longest + 1):
        # value[:, j]: the hash of the k bytes that end at j
        if k > 1:
            power = np.uint64(pow(BASE, k - 1, 1 << 64))
            value[:, k - 1:] += chars[:, :size - k + 1] * power
        want = value[:, k - 1:] * np.uint64(STEP) + np.uint64(k)
        at = np.searchsorted(keys, want)
        at[at == len(keys)] = 0
        out[:, k - 1:, k - 1] = np.where(keys[at] == want, at, -1)
    return out


def forward(grid: np.ndarray, probs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """alpha[position, word, language], scaled, and the log probability of each word in each language.

    ``probs`` has one more row, of zeros, which -1 reads.
    """
    n, size, longest = grid.shape
    langs = probs.shape[1]
    alpha = np.zeros((size + 1, n, langs))
    alpha[0] = 1
    log = np.zeros((n, langs))
    long: list[list[int]] = [[] for _ in range(size)]  # pieces over 8 bytes are rare: their lengths by end
    for j, k in np.argwhere((grid[:, :, 8:] >= 0).any(axis=0)).tolist():
        long[j].append(k + 9)
    for j in range(1, size + 1):
        for k in range(1, min(8, longest, j) + 1):
            alpha[j] += alpha[j - k] * probs[grid[:, j - 1, k - 1]]
        for k in long[j - 1]:
            own = np.flatnonzero(grid[:, j - 1, k - 1] >= 0)
            alpha[j, own] += alpha[j - k, own] * probs[grid[own, j - 1, k - 1]]
        if j % 4 == 0 and j < size:
            lo = max(0, j - longest + 1)
            top = alpha[lo:j + 1].max(axis=0)
            alpha[lo:j + 1] /= top
            log += np.log(top)
    return alpha, log + np.log(alpha[size])


def word_scores(words: list[bytes], keys: np.ndarray, probs: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language, float32[words, languages]."""
    out = np.zeros((len(words), probs.shape[1]), np.float32)
    by_size: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_size.setdefault(len(w), []).append(i)
    for size, at in by_size.items():
        step = max(1, 50_000 // (size + 1))
        for lo in range(0, len(at), step):
            part = at[lo:lo + step]
            out[part] = forward(lattice([words[i] for i in part], keys), probs)[1]
    return out


def expect(grid: np.ndarray, p: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Expected number of each piece over all segmentations; forward and backward passes in logarithms, for words of any length."""
    n, size, longest = grid.shape
    begin = np.full_like(grid, -1)  # pieces by where they begin
    for k in range(1, longest + 1):
        begin[:, :size - k + 1, k - 1] = grid[:, k - 1:, k - 1]
    a, z = np.zeros((size + 1, n)), np.zeros((size + 1, n))
    for j in range(1, size + 1):
        m = min(longest, j)
        a[j] = a[j - 1] + np.log((np.exp(a[j - m:j][::-1] - a[j - 1]) * p[grid[:, j - 1, :m]].T).sum(axis=0))
    for j in range(size - 1, -1, -1):
        m = min(longest, size - j)
        z[j] = z[j + 1] + np.log((np.exp(z[j + 1:j + m + 1] - z[j + 1]) * p[begin[:, j, :m]].T).sum(axis=0))
    out = np.zeros(len(p))
    for k in range(1, longest + 1):
        g = begin[:, :size - k + 1, k - 1].T
        own = np.flatnonzero(g.ravel() >= 0)
        piece = g.ravel()[own]
        part = np.exp((a[:size - k + 1] + z[k:] - a[size]).ravel()[own]) * p[piece] * times[own % n]
        out += np.bincount(piece, weights=part, minlength=len(p))
    return out


def learn(texts: list[bytes], langs: list[str], vocabulary: str, rounds: int = 3) -> tuple[list[str], np.ndarray]:
    """(languages by code point, probabilities[piece + 1, language])."""
    keys = pieces_of(vocabulary)
    names = sorted(set(langs))
    probs = np.zeros((len(keys) + 1, len(names)))
    for col, name in enumerate(names):
        counts: dict[bytes, int] = {}
        for t, g in zip(texts, langs):
            if g == name:
                for w in words_of(t):
                    counts[w] = counts.get(w, 0) + 1
        groups: dict[int, list[bytes]] = {}
        for w in sorted(counts):
            groups.setdefault(len(w), []).append(w)
        grids = [(lattice(ws, keys), np.array([counts[w] for w in ws], float)) for ws in groups.values()]
        p = np.full(len(keys) + 1, 1.0 / len(keys))
        p[-1] = 0
        for _ in range(rounds):
            expected = np.full(len(keys) + 1, 0.01)
            for grid, times in grids:
                expected += expect(grid, p, times)
            expected[-1] = 0
            p = expected / expected.sum()
        probs[:, col] = p
    return names, probs


def train(docs: DataFrame, bound: int = 400, vocabulary: str | None = None) -> tuple[list[str], np.ndarray]:
    """Learn from about ``bound`` texts of each language of ``docs`` (doc_id, text, lang); null languages take no part."""
    path = vocabulary or default_vocabulary()
    rows = docs.where("lang is not null")
    n = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not n:
        return [], np.zeros((1, 0))
    rate = F.element_at(F.create_map(*[x for k, v in n.items() for x in (F.lit(k), F.lit(min(1.0, bound / v)))]), F.col("lang"))
    sample = drawn(rows.select("doc_id", "text", "lang"), rate, "lang").select(text_or_empty().cast("binary").alias("text"), "lang")
    return fitted(sample, lambda t: learn(t["text"].to_pylist(), t["lang"].to_pylist(), path))


class _Scores:
    """Scores of the words this Python worker has met, bounded by the word table."""

    def __init__(self, keys: np.ndarray, probs: np.ndarray):
        self.keys, self.probs = keys, probs
        self._clear()

    def _clear(self) -> None:
        self.table, self.rows = WordTable(500_000), np.zeros((1 << 16, self.probs.shape[1]), np.float32)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each text in each language, and its number of words."""
        if self.table.full():
            self._clear()
        split = [words_of(t) for t in texts]
        at = self.table.ids([w for ws in split for w in ws])
        new = self.table.take_new()
        if new:
            end = len(self.table)
            if end > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((max(end, len(self.rows)), self.rows.shape[1]), np.float32)])
            self.rows[end - len(new):end] = word_scores(new, self.keys, self.probs)
        counts = np.array([len(ws) for ws in split])
        total = np.zeros((len(texts), self.rows.shape[1]))
        some = np.flatnonzero(counts)
        if len(some):
            starts = (np.cumsum(counts) - counts)[some]
            total[some] = np.add.reduceat(self.rows[at], starts, axis=0, dtype=np.float64)
        return total, counts


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], columns: list[str] | None = None,
             vocabulary: str | None = None, certain_words: int = 16) -> DataFrame:
    """The named columns of ``docs`` (all, unless given) with lang_pred and score, for each row.

    ``score`` is the posterior of the predicted language under equal priors,
    with the evidence of a long text counted as that of ``certain_words``
    words (so it does not saturate at once).  Texts that are null or hold no
    letter, and all texts if no language was learned, give ``und`` and 0.
    Ties go to the first language by code point.  Repeated rows are scored
    alike, null ids like others; an empty table gives an empty result.
    Columns of ``docs`` named lang_pred or score are replaced.
    """
    names, probs = model
    path = vocabulary or default_vocabulary()
    mark = (len(names), float(probs.sum()), float((probs * np.arange(len(probs))[:, None]).sum()))
    columns = [c for c in (docs.columns if columns is None else columns) if c not in ("lang_pred", "score")]
    text_at = columns.index("text") if "text" in columns else len(columns)  # a text goes to the task once

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        known_words = worker_cache(("language", mark), lambda: _Scores(pieces_of(path), probs))
        preds, scores = [], []
        texts = texts_of(b.column(text_at))
        for lo in range(0, len(texts), 256):
            part = texts[lo:lo + 256]
            total, counts = known_words.of(part) if names else (np.zeros((len(part), 0)), np.zeros(len(part)))
            total *= np.minimum(1, certain_words / np.maximum(counts, 1))[:, None]
            top = total.argmax(axis=1) if names else np.zeros(len(part), int)
            post = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1) if names else np.zeros(len(part))
            for t, i, s in zip(part, top.tolist(), post.tolist()):
                known = bool(names) and has_letter(t)
                preds.append(names[i] if known else UNDETERMINED)
                scores.append(s if known else 0.0)
        return pa.RecordBatch.from_arrays([*b.columns[:len(columns)], pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                                          names=[*columns, "lang_pred", "score"])
    read = docs.select(*[F.col(f"`{c}`") for c in columns], *[F.col("text").alias("_text")] * (text_at == len(columns)))
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in columns]).schema.fields,
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_batches(read, run, schema)


def predict_languages(docs: DataFrame, held: int = 2, folds: int = 4, bound: int = 400, vocabulary: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row; learned from the rows whose fold is not ``held``."""
    model = train(docs.select("doc_id", "text", "lang").where(fold("doc_id", folds) != held), bound, vocabulary)
    out = identify(docs, model, ["doc_id"], vocabulary)
    return out.select("doc_id", (fold("doc_id", folds) == held).alias("held_out"), "lang_pred", "score")
