"""Helpers the operators share: saved tables, splits by checksum, word ids.

Text conventions used throughout: a null text counts as empty, lower-casing
touches A-Z only, and a word is a run of bytes outside ``\\x20 \\x09-\\x0D``
(``bytes.lower`` and ``bytes.split`` do exactly that on UTF-8).
"""

from __future__ import annotations

import ctypes
import pickle
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import checkpoint_dir

#: bytes of an Arrow batch that a function on batches takes at a time
PIECE = 8 << 20
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and reread it.

    Later steps then see the same rows whatever is retried, on any executor,
    and read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def fold(doc_id: str | Column, k: int) -> Column:
    """crc32 of the id as text, modulo ``k``; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(k))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever the caller's columns are called."""
    taken = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name.lower() in taken:
        name = "_" + name
    return name


def load_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, keep: Column, bound: int,
                  by: str) -> tuple[DataFrame, dict[int, int]]:
    """At most about ``bound`` labelled rows for each label value, spread by a hash of the id.

    The rate of each label comes from the labels' own counts, so the sample
    reaches over the whole table; those counts are returned too.  Of several labels for one id the largest
    counts; ids and labels that are null take no part.
    """
    lab = (labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
           .where("_id is not null and _y in (0, 1)").groupBy("_id").agg(F.max("_y").alias("_y")))
    n = {r["_y"]: r["n"] for r in lab.where(keep).groupBy("_y").agg(F.count("*").alias("n")).collect()}
    u = F.pmod(F.xxhash64(F.lit(by), F.col("_id")), F.lit(1_000_000)) / F.lit(1_000_000)
    rate = F.when(F.col("_y") == 1, F.lit(min(1.0, bound / max(n.get(1, 0), 1)))).otherwise(
        F.lit(min(1.0, bound / max(n.get(0, 0), 1))))
    lab = lab.where(keep).where(u < rate)
    # about 2 * bound ids and labels at most: broadcast, so that no text is shuffled to find them
    rows = docs.select("doc_id", "text").join(F.broadcast(lab), F.col("doc_id") == F.col("_id")).select(
        "doc_id", text_or_empty().alias("text"), F.col("_y").alias("y"))
    # of rows that share an id the least text teaches, so that a repeated id doesn't pass the bound
    return rows.groupBy("doc_id", "y").agg(F.min("text").alias("text")), n


def drawn(rows: DataFrame, rate: float | Column, by: str) -> DataFrame:
    """Rows of (doc_id, text, ...) drawn at ``rate`` by a hash of id and text, repeated rows once.

    Whatever share of the rows one id (or null) bears, its texts are drawn at the same rate as others.
    """
    u = F.pmod(F.xxhash64(F.lit(by), F.col("doc_id"), F.col("text")), F.lit(1_000_000)) / F.lit(1_000_000)
    return rows.where(u < rate).distinct()


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` on each Arrow batch, a large one in pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = fn(b)
            if out is not None:
                yield out
    return df.mapInArrow(lean(run), schema)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` on pieces of about ``PIECE`` bytes at most, none of them empty; after each piece of a larger batch, and at the end, what was freed is given back."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = 0

        def pieces() -> Iterator[pa.RecordBatch]:
            nonlocal read
            for b in batches:
                read += b.nbytes
                step = max(1, b.num_rows * PIECE // max(b.nbytes, 1))
                for lo in range(0, b.num_rows, step):
                    yield b.slice(lo, step)
                    if step < b.num_rows:
                        give_back()
        yield from run(pieces())
        if read > PIECE:
            give_back()
    return task


def give_back() -> None:
    """Freed memory goes back to the machine: a worker lives as long as its executor and would hold the most it ever took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


class WordTable(dict):
    """Word (bytes) to a small integer; what a word maps to lives in arrays beside it.

    One table serves a Python worker; past ``limit`` entries it starts anew
    between batches, so its memory is bounded however many words there are.
    ``make`` gets the list of the new words and returns nothing; it extends
    the caller's arrays.
    """

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit, self.new = limit, []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def take_new(self) -> list[bytes]:
        new, self.new = self.new, []
        return new

    def full(self) -> bool:
        return len(self) > self.limit


_kept: list = [None, None]


def worker_cache(key, make: Callable[[], object]):
    """What this Python worker keeps between tasks under ``key``.

    A worker keeps one thing at a time: the word table of one operator goes
    when another operator's task comes, so a session that runs many operators
    holds no more than the largest.
    """
    if _kept[0] != key:
        _kept[:] = [None, None]
        _kept[:] = [key, make()]
    return _kept[1]


def forget_cache() -> None:
    """For tasks that need nothing kept and much memory."""
    _kept[:] = [None, None]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on unsigned 64-bit integers (xor-shift and odd multiplications)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def fitted(rows: DataFrame, fit: Callable[[pa.Table], object]):
    """``fit`` of a bounded table, run in one Spark task; its small result comes to the driver.

    A task's Python worker has one BLAS thread and the executor's memory;
    numpy in the driver process has neither (its BLAS threads do not survive
    the fork that starts the JVM).
    """
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        table = pa.Table.from_batches(got) if got else pa.table({n: [] for n in names})
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(table))], pa.binary())], names=["model"])

    # repartitioned, not coalesced: what leads to the rows keeps its own tasks
    got = rows.repartition(1).mapInArrow(run, "model binary").first()
    if got is None:  # a table that Spark knows to be empty has no task
        got = rows.sparkSession.range(1).mapInArrow(lambda _: run(iter(())), "model binary").first()
    return pickle.loads(got["model"])
