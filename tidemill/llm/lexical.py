"""Operator 11: ranked lexical search by Block-Max MaxScore over sharded inverted lists.

Index.  Each scan split cuts its rows into shards of bounded text.  A shard
numbers its documents by length, inverts them, and keeps for each term one
list: blocks of ``BLOCK`` postings (document number and occurrences, as
variable-length integers that are only readable after decoding), and beside
them, open, each block's first and last document, its greatest occurrence
count and its least document length.  Nothing of the index depends on counts
of the whole corpus, so shards can be added; it is written to the shared
folder.

Search.  The corpus's counts are sums over the shards, and with them the
block maxima follow: a score never falls with more occurrences nor with a
shorter document.  A task holds the lists of one shard for one block of
queries.  For a query it walks windows of documents, the most promising
first.  In a window, lists whose maxima together stay below the score to beat
are non-essential: only documents of the other, essential lists are
candidates.  The non-essential lists are then probed from the strongest on;
a candidate whose score so far, the maximum of the block it would be in and
the maxima of the lists still to come cannot reach the score to beat is
dropped before that block is decoded.  Each shard gives its best ``k`` rows a
query; those are merged by a group-limited rank.

Scores are whole numbers: with N documents that hold a term, L terms in all,
a document's n terms, a term's document frequency df and its occurrences tf in
the document, ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))``,
``m = 10 + 90 n N div L``, and a document's score is the sum of
``w * (10^9 tf div (1000 tf + 8 m))`` over the query's distinct terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.shared import WordTable, map_batches, saved, text_or_empty, texts_of

BLOCK = 128
WINDOW = 1024
SHARD_BYTES = 8 << 20
SHARD_DOCS = 1 << 15
QUERY_BLOCK = 256
#: ASCII letters are lowered and kept, as are digits and all bytes of other characters; the rest are blanks.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
LISTS = ("shard string, term binary, df long, firsts array<int>, lasts array<int>, most array<long>, shortest array<long>, "
         "ends array<int>, packed binary, doc_ids array<long>, lengths array<long>")


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def pack_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers as bytes of seven bits, least first, the last of each below 128; and each one's byte count."""
    size = np.ones(len(values), np.int64)
    rest = values >> 7
    while rest.any():
        size += rest > 0
        rest = rest >> 7
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for i in range(int(size.max()) if len(size) else 0):
        own = size > i
        byte = (values[own] >> (7 * i)) & 127
        out[ends[own] - size[own] + i] = byte | np.where(size[own] > i + 1, 128, 0)
    return out, size


def unpack_numbers(packed: np.ndarray) -> np.ndarray:
    last = packed < 128
    start = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    shift = np.arange(len(packed)) - np.repeat(start, np.diff(np.concatenate([start, [len(packed)]])))
    return np.add.reduceat((packed & 127).astype(np.int64) << (7 * shift), start)


class _Shard:
    """Rows gathered for one shard, and their inversion."""

    def __init__(self):
        self.table, self.ids, self.parts, self.bytes = WordTable(), [], [], 0

    def add(self, doc_id, text: bytes) -> None:
        ws = terms_of(text)
        if ws:
            self.ids.append(doc_id)
            self.parts.append(self.table.ids(ws).astype(np.int32))
            self.bytes += len(text)

    def full(self) -> bool:
        return self.bytes >= SHARD_BYTES or len(self.ids) >= SHARD_DOCS

    def lists(self, shard: str) -> Iterator[pa.RecordBatch]:
        """The header (document ids and lengths by number), then the terms' lists."""
        n = np.array([len(p) for p in self.parts], np.int64)
        order = np.lexsort((np.array([-1 if d is None else d for d in self.ids], np.int64), n))
        n, ids = n[order], [self.ids[i] for i in order.tolist()]
        doc = np.repeat(np.arange(len(n)), n)
        term = np.concatenate([self.parts[i] for i in order.tolist()]).astype(np.int64)
        pair, tf = np.unique(term * len(n) + doc, return_counts=True)
        term, doc = pair // len(n), pair % len(n)
        begins = np.flatnonzero(np.concatenate([[True], np.diff(term) != 0]))
        df = np.diff(np.concatenate([begins, [len(term)]]))
        # a block begins every BLOCK postings of a term
        inside = np.arange(len(term)) - np.repeat(begins, df)
        first = np.flatnonzero(inside % BLOCK == 0)
        last = np.concatenate([first[1:], [len(term)]]) - 1
        delta = np.diff(doc, prepend=0)
        delta[first] = doc[first]
        numbers = np.empty(2 * len(term), np.int64)
        numbers[0::2], numbers[1::2] = delta, tf
        packed, size = pack_numbers(numbers)
        upto = np.concatenate([[0], np.cumsum(size)])
        block_of = np.concatenate([[0], np.cumsum(-(-df // BLOCK))])  # first block of each term
        byte_of = upto[2 * begins]
        ends = upto[2 * (last + 1)] - np.repeat(byte_of, np.diff(block_of))
        words = [w for w in self.table]
        assert len(df) == len(words)

        def listed(values, kind) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array(block_of, pa.int32()), pa.array(values, kind))
        m, none = len(df), pa.nulls
        raw = packed.tobytes()
        cut = np.concatenate([byte_of, [len(raw)]]).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard]), none(1, pa.binary()), none(1, pa.int64()), *[none(1, pa.list_(pa.int32()))] * 2, *[none(1, pa.list_(pa.int64()))] * 2,
             none(1, pa.list_(pa.int32())), none(1, pa.binary()), pa.array([ids], pa.list_(pa.int64())), pa.array([n.tolist()], pa.list_(pa.int64()))],
            names=NAMES)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard]).take(pa.array(np.zeros(m, np.int64))), pa.array(words, pa.binary()), pa.array(df, pa.int64()), listed(doc[first], pa.int32()),
             listed(doc[last], pa.int32()), listed(np.maximum.reduceat(tf, first), pa.int64()), listed(n[doc[first]], pa.int64()),
             listed(ends, pa.int32()), pa.array([raw[a:b] for a, b in zip(cut, cut[1:])], pa.binary()),
             none(m, pa.list_(pa.int64())), none(m, pa.list_(pa.int64()))], names=NAMES)


NAMES = [c.split()[0] for c in LISTS.split(", ")]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted lists of all rows, saved in the shared folder; rows without a term are not in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, number, held = TaskContext.get().partitionId(), 0, _Shard()
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                held.add(d, t)
                if held.full():
                    yield from held.lists(f"{task}-{number}")
                    number, held = number + 1, _Shard()
        if held.ids:
            yield from held.lists(f"{task}-{number}")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return saved(rows.mapInArrow(run, LISTS), "lexical-index")


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item, term)."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = [sorted(set(terms_of(t))) for t in texts_of(b.column(1))]
        at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array([w for s in sets for w in s], pa.binary())],
                                          names=["item", "term"])
    rows = queries.select(F.col(id_col).cast("long").alias("item"), text_or_empty(text_col).alias("text")).where("item is not null")
    return map_batches(rows, run, "item long, term binary").distinct()


class _List:
    """One term's postings in a shard: block maxima are open, blocks are decoded when asked for and then kept."""

    def __init__(self, weight: int, row: dict, lengths_m: np.ndarray, docs_m, windows: int):
        self.weight, self.m = weight, lengths_m
        self.first, self.last = np.array(row["firsts"], np.int64), np.array(row["lasts"], np.int64)
        self.ends = np.concatenate([[0], row["ends"]]).astype(np.int64)
        self.packed = np.frombuffer(row["packed"], np.uint8)
        self.block_max = weight * impact(np.array(row["most"], np.int64), docs_m(np.array(row["shortest"], np.int64)))
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        # greatest block maximum in each window of documents
        self.window_max = np.zeros(windows, np.int64)
        self.lo = np.searchsorted(self.last, np.arange(windows) * WINDOW)
        self.hi = np.searchsorted(self.first, (np.arange(windows) + 1) * WINDOW)
        for w in range(windows):
            if self.lo[w] < self.hi[w]:
                self.window_max[w] = self.block_max[self.lo[w]:self.hi[w]].max()

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of a block."""
        if b not in self.blocks:
            numbers = unpack_numbers(self.packed[self.ends[b]:self.ends[b + 1]])
            docs = np.cumsum(numbers[0::2])
            self.blocks[b] = docs, self.weight * impact(numbers[1::2], self.m[docs])
        return self.blocks[b]

    def between(self, w: int) -> tuple[np.ndarray, np.ndarray]:
        """All postings of a window."""
        got = [self.block(b) for b in range(self.lo[w], self.hi[w])]
        docs, scores = got[0] if len(got) == 1 else (np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got]))
        a, z = np.searchsorted(docs, (w * WINDOW, (w + 1) * WINDOW))
        return docs[a:z], scores[a:z]


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def top_of_shard(lists: list[_List], ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents (numbers in the shard) and scores of the ``k`` best, equal scores by id."""
    best, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    maxima = np.stack([x.window_max for x in lists])
    total = maxima.sum(axis=0)
    beat = 1  # the score to reach
    for w in np.argsort(-total, kind="stable").tolist():
        if total[w] < beat:
            break
        order = np.argsort(maxima[:, w], kind="stable")
        order = order[maxima[order, w] > 0]
        upto = np.cumsum(maxima[order, w])  # maxima of the lists up to each one
        essential = int(np.searchsorted(upto, beat))
        acc = np.zeros(WINDOW, np.int64)
        for i in order[essential:].tolist():
            docs, s = lists[i].between(w)
            acc[docs - w * WINDOW] += s
        at = np.flatnonzero(acc)
        got = acc[at]
        at = at + w * WINDOW
        for j in range(essential - 1, -1, -1):
            x, below = lists[order[j]], int(upto[j - 1]) if j else 0
            b = np.minimum(np.searchsorted(x.last, at), len(x.last) - 1)
            bound = np.where((x.first[b] <= at) & (at <= x.last[b]), x.block_max[b], 0)
            stays = got + bound + below >= beat
            at, got, b, bound = at[stays], got[stays], b[stays], bound[stays]
            for n in np.unique(b[bound > 0]).tolist():
                docs, s = x.block(n)
                own = np.flatnonzero(b == n)
                p = np.minimum(np.searchsorted(docs, at[own]), len(docs) - 1)
                got[own] += np.where(docs[p] == at[own], s[p], 0)
        ok = got >= beat
        if ok.any():
            best, scores = np.concatenate([best, at[ok]]), np.concatenate([scores, got[ok]])
            keep = np.lexsort((ids[best], -scores))[:k]
            best, scores = best[keep], scores[keep]
            if len(best) == k:
                beat = max(1, int(scores[-1]))
    return best, scores


def search(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of ``index`` with the highest score above 0 for each item.

    Equal scores go by ascending doc_id, a null doc_id last; each indexed row
    is a document of its own, whatever rows share its id or text.  Rows of
    ``queries`` that share an id are one item with the terms of all its texts;
    those with a null id take no part, and items without a known term have no
    result.  Null and empty texts have no terms.  An empty index or no queries
    give an empty result.  Other columns are not read.
    """
    terms = saved(query_terms(queries, id_col, text_col), "query-terms")
    blocks = max(1, -(-terms.select("item").distinct().count() // QUERY_BLOCK))
    size = index.where("doc_ids is not null").agg(F.sum(F.size("doc_ids")).alias("N"),
                                                  F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("L")).first()
    big_n, big_l = int(size["N"] or 0), int(size["L"] or 0)
    by_block = terms.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
    wanted = by_block.groupBy("term", "block").agg(F.collect_list("item").alias("items"))  # a block's items at most
    lists = index.where("term is not null")
    known = lists.select("term", "df").join(terms.select("term"), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("corpus_df"))
    # saved, so that Spark knows its size: a small one is broadcast, and the index then isn't shuffled to find its lists
    wanted = saved(wanted.join(known, "term"), "query-lists")
    found = lists.join(wanted, "term").select("shard", "block", "items", "corpus_df", "firsts", "lasts", "most", "shortest", "ends", "packed",
                                              F.lit(None).cast("array<long>").alias("doc_ids"), F.lit(None).cast("array<long>").alias("lengths"))
    heads = index.where("doc_ids is not null").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    heads = heads.select("shard", "block", *[F.lit(None).cast(t).alias(c) for c, t in found.dtypes[2:10]], "doc_ids", "lengths")

    def rank(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        head = next(r for r in rows if r["doc_ids"] is not None)
        n = np.array(head["lengths"], np.int64)
        ids = np.array([(1 << 63) - 1 if d is None else d for d in head["doc_ids"]], np.int64)
        windows = -(-len(n) // WINDOW)

        def docs_m(lengths: np.ndarray) -> np.ndarray:
            return 10 + (90 * lengths * big_n) // big_l
        m, of_item = docs_m(n), {}
        for r in rows:
            if r["doc_ids"] is None:
                weight = math.floor(1000 * math.log((2 * big_n + 2) / (2 * r["corpus_df"] + 1)))
                if weight > 0:
                    x = _List(weight, r, m, docs_m, windows)
                    for item in r["items"]:
                        of_item.setdefault(item, []).append(x)
        out: list[list] = [[], [], []]
        for item, own in of_item.items():
            docs, scores = top_of_shard(own, ids, k)
            out[0] += [item] * len(docs)
            out[1] += [head["doc_ids"][d] for d in docs.tolist()]
            out[2] += scores.tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("item_id", "doc_id", "score"), out)})

    tops = found.unionByName(heads).groupBy("shard", "block").applyInArrow(rank, "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return tops.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
c AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0),
p AS (SELECT doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS t FROM d),
f AS (SELECT doc_id, n, t, CAST(count(*) AS BIGINT) AS tf FROM p GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2 * (SELECT n FROM c) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f GROUP BY t),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * f.n * c.n) // c.l)))) AS BIGINT) AS score
      FROM q JOIN w USING (t) JOIN f USING (t), c GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
