"""The registered queries of the numbered operators: ``opN_<name>`` and ``pipeline``.

Each query applies its operator, with production parameters, to its whole
table and returns the digest columns.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemill.llm import (ann, exact_dedup, langid, lexical, lm, minhash, mixing, packing, periodic_runs, quality, secret_scan, toxicity,
                          warc)
from tidemill.llm.shared import load_docs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


@_register("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict_toxicity(load_docs(spark, sf_dir), _labels(spark, sf_dir))


@_register("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predict_quality(load_docs(spark, sf_dir), _labels(spark, sf_dir))


@_register("op3_exact_dedup", exact_dedup.ORACLE_SQL)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(load_docs(spark, sf_dir))


@_register("op4_mix_sources", mixing.ORACLE_SQL)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(load_docs(spark, sf_dir))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@_register("op5_ann", ann.ORACLE_SQL)
def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    return ann.nearest(vectors, F.col("vec_id") % 20 == 0)


@_register("op6_lm")
def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_corpus(load_docs(spark, sf_dir))


@_register("op7_minhash", minhash.ORACLE_SQL)
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(load_docs(spark, sf_dir))


@_register("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(load_docs(spark, sf_dir))


@_register("op9_langid")
def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(load_docs(spark, sf_dir))


@_register("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load_docs(spark, sf_dir))


@_register("op11_lexical", lexical.ORACLE_SQL)
def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return lexical.search(lexical.build_index(load_docs(spark, sf_dir)), items)


@_register("op12_warc", warc.ORACLE_SQL)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """In one document of ten, by checksum of the id (null: of the empty text), the words from ``a`` on repeat with period ``p``."""
    h, n = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@_register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(load_docs(spark, sf_dir), rewrite=_repeat_tail))


@_register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
