"""Operator 4: mix sources to target weights by Pareto order sampling.

DataFrame functions only.  Every document of a source is wanted ``target /
source size`` times.  The whole part of that number is allocated to each
document for certain; the rest is an inclusion probability ``p``, and the
documents are ranked by their random odds over the inclusion odds,
``(u / (1 - u)) / (p / (1 - p))``, with ``u`` from a hash of the id.  The
sample is of fixed size in words: documents are taken in rank order while
the middle of a document lies within the words still wanted, so a source
misses its target by half a document at most.

The rank never needs a whole source in one task: words are first summed in
65,536 ranges of ``u`` for each source, which settles all ranges but the one
that crosses the target, and only that range is ordered row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.shared import free_name, saved, text_or_empty, WORD_PATTERN

RANGES = 65_536


def uniform(doc_id: Column, seed: str) -> Column:
    """52 bits of a hash of the id, as a double within (0, 1)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("long").cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources by code point, null last, get ``weights`` in turn and divide
    ``share`` times all sizes; no target passes ``most`` times its source's
    size, and what is cut off goes to the others by weight.  The sources a
    cap binds are those first in order of cap over weight, so one pass over
    the sources (not the documents) finds them.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("_rn", F.row_number().over(order)).withColumn("_w", w)
    s = s.withColumn("_cap", F.col("source_size").cast("double") * F.lit(float(most)))
    every = Window.partitionBy()
    s = s.withColumn("_budget", F.sum("source_size").over(every).cast("double") * F.lit(share))
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), "_rn").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("_used", F.coalesce(F.sum("_cap").over(by_cap), F.lit(0.0)))
    s = s.withColumn("_left_w", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(by_cap), F.lit(0.0)))
    s = s.withColumn("_full", (F.col("_budget") - F.col("_used")) * F.col("_w") >= F.col("_cap") * F.col("_left_w"))
    free_w = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(every)
    free = F.col("_budget") - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(F.lit(0.0))).over(every)
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(F.try_divide(free, free_w) * F.col("_w"))
    return s.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2,
                seed: str = "mix") -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    Only ``doc_id``, ``text`` and ``source`` are read.  Null, empty or blank
    texts have size 0 and are taken 0 times over; a null source is a source
    of its own, last in order; a null id counts as the empty text in the
    hash.  Repeated rows share their rank and are interchangeable; rows tied
    in rank go by id.  An empty table gives an empty result.
    """
    n_words = F.regexp_count(text_or_empty(), F.lit(WORD_PATTERN)).cast("long")
    slim = saved(docs.select("doc_id", "source", n_words.alias("size"), uniform(F.col("doc_id"), seed).alias("_u"))
                 .withColumn("_bin", F.floor(F.col("_u") * RANGES).cast("int")), "mix-sizes")
    bins = slim.groupBy("source", "_bin").agg(F.sum("size").alias("_words"))
    t = source_targets(bins.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, share, most)
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("long")
    t = t.withColumn("_whole", whole).withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
    t = t.withColumn("_p", F.coalesce(F.try_divide(F.col("_rest"), F.col("source_size")), F.lit(0.0)))
    run = bins.withColumn("_end", F.sum("_words").over(Window.partitionBy("source").orderBy("_bin")))
    t = t.withColumnRenamed("source", "_s")
    same = F.col("source").eqNullSafe(F.col("_s"))
    cross = (run.join(t.select("_s", "_rest"), same).where(F.col("_end") > F.col("_rest"))
             .groupBy("_s").agg(F.min(F.struct("_bin", (F.col("_end") - F.col("_words")).alias("b"))).alias("_x"))
             .select(F.col("_s").alias("_s2"), F.col("_x._bin").alias("_cut"), F.col("_x.b").alias("_before")))
    t = saved(t.join(cross, F.col("_s").eqNullSafe(F.col("_s2")), "left").drop("_s2"), "mix-targets")
    rows = slim.join(t, same)
    odds = F.try_divide(F.col("_u") / (1 - F.col("_u")), F.try_divide(F.col("_p"), 1 - F.col("_p")))  # null if p is 0
    at = F.col("_before") + F.sum("size").over(
        Window.partitionBy("source").orderBy(odds, "_u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    settled = rows.where("_cut is null or _bin <> _cut").withColumn("_extra", F.coalesce(F.col("_bin") < F.col("_cut"), F.lit(False)))
    crossing = rows.where("_bin = _cut").withColumn("_at", at).withColumn(
        "_extra", 2 * F.col("_at") - F.col("size") <= 2 * F.col("_rest")).drop("_at")
    copies = (F.col("_whole") + F.col("_extra").cast("long")).alias("copies")
    out = settled.unionByName(crossing).select("doc_id", "source", "size", "source_size", "target", copies)
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them (0 to ``most`` times), with all their columns.

    Rows that share id and source are taken equally often.
    """
    own, src, copies, nth = (free_name(docs, n) for n in ("id", "src", "copies", "nth"))
    mix = mix_sources(docs, weights, share, most).groupBy(F.col("doc_id").alias(own), F.col("source").alias(src)).agg(F.max("copies").alias(copies))
    rows = docs.join(mix.where(F.col(copies) > 0), F.col("doc_id").eqNullSafe(F.col(own)) & F.col("source").eqNullSafe(F.col(src)))
    return (rows.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         (CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
           / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM s),
w AS (SELECT *, CAST([5, 2, 1][(rn - 1) % 3 + 1] AS DOUBLE) AS w, source_size * 2.0::DOUBLE AS cap FROM r),
p AS (SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget,
        coalesce(sum(cap) OVER (ORDER BY cap / w, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS used,
        sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS left_w
      FROM w),
f AS (SELECT *, (budget - used) * w >= cap * left_w AS is_full FROM p),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE
        (budget - sum(CASE WHEN is_full THEN cap ELSE 0.0 END) OVER ()) / sum(CASE WHEN NOT is_full THEN w END) OVER () * w END AS target
      FROM f),
k AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
q AS (SELECT *, target - whole * source_size AS rest,
        CASE WHEN source_size > 0 THEN (target - whole * source_size) / source_size ELSE 0.0 END AS p FROM k),
o AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.whole, q.rest,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END, u, doc_id, size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + CASE WHEN 2 * run - size <= 2 * rest THEN size ELSE 0 END AS BIGINT) AS taken
FROM o
"""
