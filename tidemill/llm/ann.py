"""Operator 5: nearest neighbours by inner product over randomly rotated one-bit codes.

A vector's direction is rotated at random and kept as its signs, packed into
64-bit words, with two correction scalars: its norm and the inner product of
the direction with its own sign vector.  A query's rotated direction is
rounded to ``QUERY_BITS`` bits a component and split into bit planes, so the
inner product with a sign vector is a weighted sum of popcounts of words.
Over the correction scalar that estimates the inner product of the
directions; the estimate's error has a standard deviation of at most
``sqrt((1 - f^2) / f^2 / (D - 1))`` for the correction scalar ``f``, with the
rounding's own added (the sum of both, which is no less than that of their squares).

Queries and candidates meet in blocks of bounded size: every query block meets
every candidate block once.  There the ``4 k`` candidates with the best
estimates are scored exactly; the ``k``-th best of those scores is a floor
that the true ``k``-th best reaches.  Only the candidates whose estimate plus
``DEVIATIONS`` deviations reaches the floor are reranked with the original
vectors, in single precision first and, where that may matter, in double.  A
meeting gives at most ``k`` rows a query, and nothing is collected or broadcast
but the rotation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.shared import map_batches, saved

#: A neighbour at the floor itself is passed over once in about 160 times, one above it less often.
DEVIATIONS = 2.5
QUERY_BITS = 5
CANDIDATE_BLOCK, QUERY_BLOCK = 1 << 16, 1 << 12


def rotation(dims: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix, float32."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms in double and unit vectors in single precision; squares stay within range."""
    v = vectors.astype(np.float64)
    top = np.abs(v).max(axis=1, initial=0.0)
    norms = top * np.sqrt(((v / top[:, None]) ** 2).sum(axis=1))
    return norms, (v / norms[:, None]).astype(np.float32)


def packed_words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words, filled with zeros."""
    packed = np.packbits(bits, axis=1)
    packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))
    return np.ascontiguousarray(packed).view(np.uint64)


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sign words, norms, and the inner products of the unit directions with their unit sign vectors."""
    norms, unit = directions(vectors)
    turned = unit @ turn
    return packed_words(turned > 0), norms, np.abs(turned).sum(axis=1, dtype=np.float64) / np.sqrt(vectors.shape[1])


class Codes:
    """One block of candidates: ids, original vectors, sign words and correction scalars."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, words: np.ndarray, norms: np.ndarray, agree: np.ndarray):
        self.ids, self.vectors, self.norms = ids, vectors, norms
        self.unit = directions(vectors)[1]
        self.words = np.ascontiguousarray(words.T)  # a row for each word
        self.ones = np.bitwise_count(self.words).sum(axis=0, dtype=np.int32)
        agree, dims = np.maximum(agree, 1e-6), vectors.shape[1]
        # all in units of the query's norm
        self.scale = (norms / (np.sqrt(dims) * agree)).astype(np.float32)
        self.spread = (norms * np.sqrt(np.maximum(1 - agree ** 2, 0) / max(dims - 1, 1)) / agree).astype(np.float32)
        self.rounding = (norms / np.sqrt(12) / agree).astype(np.float32)

    def estimate(self, turned: np.ndarray, deviations: float) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products of all vectors with a query's direction, and their upper bounds, from popcounts."""
        lo, hi = float(turned.min()), float(turned.max())
        step = (hi - lo) / ((1 << QUERY_BITS) - 1) or 1.0
        level = np.rint((turned - lo) / step).astype(np.uint8)
        total = np.zeros(len(self.ids), np.int32)
        for bit in range(QUERY_BITS):
            plane = packed_words(((level >> bit) & 1)[None, :].astype(bool))[0]
            for row, word in zip(self.words, plane):
                total += np.bitwise_count(row & word).astype(np.int32) << bit
        # twice the sum of the query's components where the sign is positive, less the sum of all
        signed = np.float32(2 * lo) * self.ones + np.float32(2 * step) * total - np.float32(lo * len(turned) + step * float(level.sum()))
        est = signed * self.scale
        return est, est + np.float32(deviations) * (self.spread + np.float32(step) * self.rounding)


def best_ids(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of distinct ids, equal scores by id."""
    if len(scores) > 16 * k:  # most often those with the 4 k best scores hold them
        top = np.flatnonzero(scores >= -np.partition(-scores, 4 * k)[4 * k])
        if len(top) <= len(scores) // 2 and len(np.unique(ids[top])) >= k:
            return top[best_ids(ids[top], scores[top], k)]
    order = np.lexsort((ids, -scores))
    first = np.unique(ids[order], return_index=True)[1]
    return order[np.sort(first)][:k]


def search_block(query_ids, queries, block: Codes, turn, k: int, deviations: float = DEVIATIONS, count: list | None = None):
    """(query, vector, score) rows: the ``k`` best of one candidate block for each query of one query block.

    Rows that share an id count once, by their best score; a query's own id is no candidate.  ``count`` gathers how
    many candidates of each query were reranked.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    sizes, units = directions(queries)
    for i in range(len(query_ids)):
        q, q_unit = queries[i].astype(np.float64), units[i]
        est, upper = block.estimate(q_unit @ turn, deviations)
        own = block.ids == query_ids[i]
        est[own] = upper[own] = -np.inf
        floor, some = -np.inf, min(4 * k, len(est))
        at = np.argpartition(-est, some - 1)[:some]
        at = at[~own[at]]
        rough = block.norms[at] * (block.unit[at] @ q_unit)
        first = best_ids(block.ids[at], rough, k)
        if len(first) == k:
            floor = rough[first[-1]] - 1e-5 * block.norms[at][first[-1]]
        at = np.flatnonzero((upper >= floor) & ~own)
        if count is not None:
            count.append(len(at))
        rough, near = block.norms[at] * (block.unit[at] @ q_unit), 1e-5 * block.norms[at]
        first = best_ids(block.ids[at], rough, k)
        if len(first) == k:  # what single precision can't rule out
            stays = rough + near >= (rough - near)[first].min()
            at = at[stays]
        score = (block.vectors[at].astype(np.float64) * q).sum(axis=1)
        first = best_ids(block.ids[at], score, k)
        out.append((np.full(len(first), query_ids[i]), block.ids[at][first], score[first]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*out))


def nearest(vectors: DataFrame, query_rows, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest other vectors of each row that ``query_rows`` (a Column) marks.

    Vectors that are null, zero, or hold null or non-finite components take
    no part, nor do rows with a null id or with fewer or more components
    than most.  Nearest first, ties to the smaller id.  Rows that share an id
    count as one candidate (by their best score) and as one query (by their
    greatest vector); equal rows are one from the start, and blocks are dealt
    by id and vector, so a much repeated id is spread too.  With fewer than
    ``k`` candidates all are returned; an empty table gives an empty result.
    Other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), query_rows.alias("is_query"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where("id is not null and v is not null").where(fine & F.exists("v", lambda x: x != 0))
    rows = rows.groupBy("id", "v").agg(F.max("is_query").alias("is_query"))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None or sizes["d"] == 0:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, n = sizes["d"], sizes["n"]
    rows = rows.where(F.size("v") == dims)
    # made in the tasks that use it
    seed_turn: list[np.ndarray] = []

    def turn() -> np.ndarray:
        if not seed_turn:
            seed_turn.append(rotation(dims))
        return seed_turn[0]

    def as_matrix(b) -> np.ndarray:
        col = b.column("v")
        col = pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) else col
        return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)

    kind = dict(rows.dtypes)["v"]
    cells = max(1, -(-n // candidate_block))

    def codes(b: pa.RecordBatch) -> pa.RecordBatch | None:
        if not b.num_rows:
            return None
        words, norms, agree = encode(as_matrix(b), turn())
        return pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array([w.tobytes() for w in words], pa.binary()),
                                           pa.array(norms), pa.array(agree), b.column("is_query"), b.column("cell")],
                                          names=["id", "v", "words", "norm", "agree", "is_query", "cell"])

    dealt = rows.withColumn("cell", F.pmod(F.xxhash64("id", "v"), F.lit(cells)).cast("int"))
    coded = saved(map_batches(dealt, codes, f"id long, v {kind}, words binary, norm double, agree double, is_query boolean, cell int"), "one-bit-codes")
    queries = saved(coded.where("is_query").groupBy("id").agg(F.max("v").alias("v")), "ann-queries")
    query_cells = max(1, -(-queries.count() // query_block))
    left = coded.select("id", "v", "words", "norm", "agree", F.col("cell").alias("i")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.lit(query_cells - 1))))
    right = queries.withColumn("j", F.pmod(F.xxhash64("id"), F.lit(query_cells)).cast("int")).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))

    def meet(c: pa.Table, q: pa.Table) -> pa.Table:
        if not c.num_rows or not q.num_rows:
            cols = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        else:
            words = np.frombuffer(b"".join(c["words"].to_pylist()), np.uint64).reshape(c.num_rows, -1)
            block = Codes(c["id"].to_numpy(), as_matrix(c), words, c["norm"].to_numpy(), c["agree"].to_numpy())
            cols = search_block(q["id"].to_numpy(), as_matrix(q), block, turn(), k)
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    near = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(meet, "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
