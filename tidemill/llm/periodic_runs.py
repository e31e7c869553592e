"""Operator 13: periodic runs of words, by a dictionary of basic factors.

A basic factor is a stretch of ``2 ** k`` words.  Level ``k`` names every
basic factor that occurs more than once in its document: the name of a factor
comes from the names of its two halves, so a level costs one sort of the
positions still in play, and a position whose factor occurs once leaves for
good.  On each level the successor of an occurrence is the next one of the
same factor.  Successors at the same distance ``p``, at most twice the
factor's length away, from consecutive positions form an arithmetic
progression: it proposes period ``p`` for the stretch it covers.  A proposal
is extended to both sides as far as words ``p`` apart agree, kept if it is
long enough, and found once however many levels propose it.

A run of period ``q`` and ``4 * q`` words or more shows on the level whose
factors are the shortest of ``q`` words or more: a factor as long as a period
recurs inside the run at distance ``q`` and no sooner.  A stretch of four
periods whose smallest period were a part of ``p`` would have a nearer
successor, so a kept period is the smallest one.

Documents are taken many at a time; positions of different documents never
share a name.  One row gives one row, nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import WordTable, text_or_empty, texts_of

RUN = "struct<start: long, length: long, period: long>"
#: words looked at in one go (a longer document is taken by itself)
CHUNK = 400_000


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int = 6, times: int = 4) -> list[tuple[int, int, int, int]]:
    """Sorted (document, start, period, length) of all runs.

    ``words`` are the integers of all documents' words in a row, document ``d``
    being ``words[bounds[d]:bounds[d + 1]]``.  A run has ``max(least, times *
    period)`` words or more; ``times`` is 4 or more.
    """
    n = len(words)
    if n == 0:
        return []
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = doc * (int(words.max()) + 1) + words
    at, name, b = np.arange(n), np.full(n, -1, np.int64), 1
    found: set[tuple[int, int, int, int]] = set()
    while len(at):
        order = np.argsort(key, kind="stable")
        place, same = at[order], np.diff(key[order]) == 0
        gap = np.diff(place)
        near = same & (gap <= 2 * b)
        for start, period, count in _progressions(place[:-1][near], gap[near], b, least, times):
            lo, hi = int(bounds[doc[start]]), int(bounds[doc[start] + 1])
            end = start + count - 1 + b + period
            while start > lo and words[start - 1] == words[start - 1 + period]:
                start -= 1
            while end < hi and words[end] == words[end - period]:
                end += 1
            if end - start >= max(least, times * period):
                found.add((int(doc[start]), start - lo, period, end - start))
        # names of this level; what occurs once has none
        again = np.zeros(len(place), bool)
        again[:-1] |= same
        again[1:] |= same
        number = np.concatenate([[0], np.cumsum(~same)])
        name[place[again]] = number[again]
        at = np.sort(place[again])
        at = at[at + b < n]
        at = at[(name[at + b] >= 0) & (doc[at] == doc[at + b])]
        key = name[at] * (int(number[-1]) + 1) + name[at + b]
        name[place] = -1
        b *= 2
    return sorted(found)


def _progressions(at: np.ndarray, period: np.ndarray, b: int, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """(first position, period, positions) of consecutive positions with one successor distance.

    Left out are those too short for any run of their period: a run of
    ``length`` words gives ``length - period - b + 1`` positions on this level.
    """
    if not len(at):
        return
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(period) != 0)) + 1
    first = np.concatenate([[0], cut])
    count = np.diff(np.concatenate([first, [len(at)]]))
    fits = count >= np.maximum(least, times * period[first]) - period[first] - b + 1
    yield from zip(at[first[fits]].tolist(), period[first[fits]].tolist(), count[fits].tolist())


def _documents(ids: list, texts: list[bytes], rewrite) -> Iterator[list[list[bytes]]]:
    """Documents' words, as many documents at a time as ``CHUNK`` words allow."""
    held, size = [], 0
    for d, t in zip(ids, texts):
        ws = t.split()
        if rewrite is not None:
            ws = rewrite(d, ws)
        if held and size + len(ws) > CHUNK:
            yield held
            held, size = [], 0
        held.append(ws)
        size += len(ws)
    if held:
        yield held


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4,
                  rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, runs, collapsed.

    Words are the runs of bytes outside blanks (``\\x20 \\x09-\\x0D``), compared
    byte by byte.  ``runs`` are structs (start, length, period) by start, then
    period: every maximal stretch with smallest period ``q`` and at least
    ``max(least, times * q)`` words.  ``collapsed`` is the words joined by one
    blank, without those that a run holds after its first period.
    ``rewrite(doc_id, words)`` may give other words first.

    Null and empty texts have no words, no runs and an empty ``collapsed``.
    Repeated rows and null ids are rows like others; only doc_id and text are
    read, so other columns may bear any name.  An empty table gives an empty
    result.  Long texts are read whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = 0
            for held in _documents(b.column(0).to_pylist(), texts_of(b.column(1)), rewrite):
                table = WordTable()
                numbers = [table.ids(ws) for ws in held]
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in numbers])]).astype(np.int64)
                runs = find_runs(np.concatenate(numbers), bounds, least, times)
                own = np.searchsorted(np.array([r[0] for r in runs], np.int64), np.arange(len(held) + 1))
                texts = []
                for i, ws in enumerate(held):
                    mine = runs[own[i]:own[i + 1]]
                    if mine:
                        kept = np.ones(len(ws), bool)
                        for _, start, period, length in mine:
                            kept[start + period:start + length] = False
                        ws = [ws[j] for j in np.flatnonzero(kept).tolist()]
                    texts.append(b" ".join(ws))
                cols = [pa.array([r[i] for r in runs], pa.int64()) for i in (1, 3, 2)]
                listed = pa.ListArray.from_arrays(pa.array(own, pa.int32()),
                                                  pa.StructArray.from_arrays(cols, ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(done, len(held)), pa.array(np.diff(bounds), pa.int64()), listed,
                     pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])
                done += len(held)
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return cols.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def strongest(runs: str | Column = "runs") -> Column:
    """Of an array of runs that with the greatest length / period, the first of equals; null without runs."""
    runs = F.col(runs) if isinstance(runs, str) else runs
    none = F.lit(None).cast(RUN)
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run's start, length, period and exponent_milli, and the two checksums."""
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    best = found.withColumn("best", strongest())
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
