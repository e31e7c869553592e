"""Operator 3: exact duplicates through an extendible-hash index on shared files.

1. Each scan split chains its own rows by a 64-bit key of the normalised
   text, compares bytes along a chain and marks one row as the
   representative of each text.  The rows go to shared files (the index's
   records); only a representative keeps its text.  A text that a third of
   all rows hold thus leaves few records with text for each split.  A split
   begins new chains once its present ones hold ``HELD`` bytes.
2. The directory: record counts over the key's leading bits.  Where a bucket
   holds more than ``capacity`` records the directory doubles (one more bit)
   and the bucket splits into its two halves; the others keep their depth.
   It is a table in shared files and goes as deep as the key has bits, so
   only records with one key may overfill a bucket.
3. Runs of neighbouring buckets of about ``OWNED`` bytes have one owner.  An
   owner task reads the records of its key range in key order, chains equal
   keys, compares bytes, and writes for each representative the row that
   stays and the number of rows, again to shared files.  The driver holds the
   owners' first keys (``MOST_OWNERS`` at most), not the directory.
4. Each row looks up its representative's entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.shared import ascii_lower, forget_cache, free_name, lean, saved, text_or_empty

RECORD = "uid long, doc_id long, key long, text_sha256 string, rep long, copies long, largest long, size long, text string"
NAMES = ["uid", "doc_id", "key", "text_sha256", "rep", "copies", "largest", "size", "text"]
#: bytes of distinct texts that a split chains at a time, bytes of records an owner takes, owners at most
HELD, OWNED, MOST_OWNERS = 16 << 20, 8 << 20, 1 << 16
#: bits of a record's place in the directory: the key without its last bit, so that places are not negative
PLACE_BITS = 63
#: depths that one count of records settles
DEPTHS = 3


def _local_chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mark the rows of one split: ``rep`` is the uid of the first row with the same bytes since chains began."""
    forget_cache()
    chains: dict[int, list[int]] = {}
    reps: dict[int, list] = {}
    held = 0
    for b in batches:
        rep_of = []
        for u, d, k, s, t in zip(*(b.column(i).to_pylist() for i in range(4)), (t.as_py() for t in b.column(4))):
            for r in chains.setdefault(k, []):
                if reps[r][3] == t:
                    entry = reps[r]
                    entry[1] += 1
                    entry[2] = d if entry[2] is None or (d is not None and d > entry[2]) else entry[2]
                    break
            else:
                r = u
                chains[k].append(u)
                reps[u] = [k, 1, d, t, s]
                held += len(t) + 200
            rep_of.append(r)
            if held > HELD:
                yield from _records(reps)
                chains.clear()
                held = 0
        n = b.num_rows
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), b.column(3), pa.array(rep_of, pa.int64()), *[pa.nulls(n, pa.int64())] * 3,
             pa.nulls(n, pa.string())], names=NAMES)
    yield from _records(reps)


def _records(reps: dict[int, list]) -> Iterator[pa.RecordBatch]:
    """The representatives' records, taken out of ``reps``, in pieces of bounded bytes."""
    kinds = [*[pa.int64()] * 3, pa.string(), *[pa.int64()] * 4, pa.string()]
    piece, held = [], 0
    for u in list(reps):
        k, c, m, t, s = reps.pop(u)
        piece.append((None, None, k, s, u, c, m, len(t.encode()), t))
        held += len(t)
        if held > 4_000_000 or len(piece) >= 5_000 or not reps:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*piece), kinds)], names=NAMES)
            piece, held = [], 0


def build_directory(records: DataFrame, capacity: int) -> DataFrame:
    """The buckets: depth, prefix (the place's leading ``depth`` bits), n, weight, lo and hi (places).

    ``records``: place, weight.  One count of the records settles several
    depths: each cell of the deepest belongs to the bucket of the least depth
    that is not overfull.  Cells that are overfull at the deepest are counted
    anew with further bits, until they hold one place alone.  Each count
    stays a table; an empty table has no buckets.
    """
    total = records.count()
    depth = min(PLACE_BITS, max(0, (total // max(capacity, 1)).bit_length() - 1))
    todo, settled = records, None
    sums = (F.sum("n").alias("n"), F.sum("weight").alias("weight"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    while True:
        deepest = min(depth + DEPTHS, PLACE_BITS)
        cells = saved(todo.groupBy(F.shiftright("place", PLACE_BITS - deepest).alias("cell"))
                      .agg(F.count("*").alias("n"), F.sum("weight").alias("weight"), F.min("place").alias("lo"), F.max("place").alias("hi")), "cells")
        at = F.lit(None).cast("int")
        for d in range(deepest, depth - 1, -1):
            above = Window.partitionBy(F.shiftright("cell", deepest - d))
            at = F.when((F.sum("n").over(above) <= capacity) | (F.min("lo").over(above) == F.max("hi").over(above)), d).otherwise(at)
        cells = saved(cells.withColumn("depth", at), "cell-depths")
        done = (cells.where("depth is not null").groupBy("depth", F.expr(f"shiftright(cell, {deepest} - depth)").alias("prefix")).agg(*sums))
        settled = done if settled is None else settled.union(done)
        over = cells.where("depth is null").select("cell")
        if over.isEmpty():
            return saved(settled, "directory")
        todo = records.join(over, F.shiftright("place", PLACE_BITS - deepest) == F.col("cell"), "left_semi")
        depth = deepest + 1


def owners(directory: DataFrame) -> np.ndarray:
    """The first place of each owner, owners being runs of neighbouring buckets of about equal weight."""
    total = directory.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).first()["w"]
    share = max(OWNED, -(-total // MOST_OWNERS), 1)
    # the weight before a bucket: that of the groups before its own, and that before it inside its group
    group = F.shiftright("lo", PLACE_BITS - 12)
    buckets = directory.select("lo", "weight", group.alias("g"))
    before = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)  # 4,096 groups at most
    groups = buckets.groupBy("g").agg(F.sum("weight").alias("w")).select("g", F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w"))
    inside = Window.partitionBy("g").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.floor((F.col("w") + F.coalesce(F.sum("weight").over(inside), F.lit(0))) / F.lit(share))
    first = buckets.join(groups, "g").select("lo", owner.alias("owner")).groupBy("owner").agg(F.min("lo").alias("lo"))
    return np.sort(np.array([r["lo"] for r in first.collect()], np.int64))


def _owner_chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records in key order: chain equal keys, compare bytes, settle each chain when its key ends."""
    forget_cache()
    now, chain = None, []  # chain: [text, rows, largest doc_id, reps]
    out: list[tuple] = []

    def settle() -> None:
        for _, n, m, reps in chain:
            out.extend((r, m, n) for r in reps)
        chain.clear()

    def batch() -> pa.RecordBatch:
        cols = [pa.array([r[i] for r in out], pa.int64()) for i in range(3)]
        out.clear()
        return pa.RecordBatch.from_arrays(cols, names=["rep", "keep_id", "group_size"])

    for b in batches:
        for k, r, c, m, t in zip(*(b.column(i).to_pylist() for i in range(5))):
            if k != now:
                settle()
                now = k
            for link in chain:
                if link[0] == t:
                    link[1] += c
                    link[2] = m if link[2] is None or (m is not None and m > link[2]) else link[2]
                    link[3].append(r)
                    break
            else:
                chain.append([t, c, m, [r]])
        if len(out) >= 20_000:
            yield batch()
    settle()
    yield batch()


def exact_duplicates(docs: DataFrame, capacity: int = 4096) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are after lower-casing A-Z; a null text
    is the empty text and equal to it.  The row with the largest id stays;
    null ids are smaller than any, and a group of null ids alone has a null
    keep_id.  Of repeated rows (one id, one text) exactly one is kept.  An
    empty table gives an empty result; other columns of ``docs`` are not read.
    """
    norm = ascii_lower(text_or_empty())
    rows = (docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), norm.alias("text"))
            .select("uid", "doc_id", F.xxhash64("text").alias("key"), F.sha2("text", 256).alias("text_sha256"), "text"))
    index = saved(rows.mapInArrow(lean(_local_chains), RECORD), "index-records")
    reps = index.where("uid is null").withColumn("place", F.shiftrightunsigned("key", 1))
    firsts = owners(build_directory(reps.select("place", (F.col("size") + 64).alias("weight")), capacity))

    @F.pandas_udf("int")
    def owner(place: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(firsts, place.to_numpy(), "right") - 1, 0).astype(np.int32))
    owned = (reps.select("key", "rep", "copies", "largest", "text", owner("place").alias("owner"))
             .repartitionById(max(len(firsts), 1), "owner").sortWithinPartitions("key", "rep")
             .select("key", "rep", "copies", "largest", "text"))
    found = saved(owned.mapInArrow(lean(_owner_chains), "rep long, keep_id long, group_size long"), "index-chains")
    rows = index.where("uid is not null").select("uid", "doc_id", "text_sha256", "rep")
    out = rows.join(found, "rep")
    # of repeated rows with the id that stays, the one with the smallest uid is kept
    first = (out.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("text_sha256", "keep_id")
             .agg(F.min("uid").alias("uid")).select("uid", F.lit(True).alias("_k")))
    return out.join(first, "uid", "left").select(
        "doc_id", "keep_id", "group_size", F.coalesce("_k", F.lit(False)).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are found again by text digest and id; of repeated rows (one id,
    one text) the first in its partition stays.
    """
    own, nth = free_name(docs, "key"), free_name(docs, "nth")

    def key(sha):
        return F.concat_ws(":", sha, F.col("doc_id").cast("string"))
    stay = exact_duplicates(docs).where("kept").select(key(F.col("text_sha256")).alias(own))
    rows = docs.withColumn(own, key(F.sha2(ascii_lower(text_or_empty()), 256))).join(stay, own)
    first = F.row_number().over(Window.partitionBy(own).orderBy(own))
    return rows.withColumn(nth, first).where(F.col(nth) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, CAST(count(*) OVER w AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
