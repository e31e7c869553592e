"""Corpus pipeline: language ID, exact dedup, near dedup, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept, and returns the rows it keeps with the columns of ``documents``; the
last returns the packed pieces.  Stages run one after another on saved
Parquet, so an executor lost in one stage does not repeat the stages before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import exact_dedup, langid, minhash, mixing, packing
from tidemill.llm.shared import load_docs, saved

#: A text whose best language is less likely than this is rejected, as is one without letters.
LEAST_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9, learned from the rows' own languages; rejects ``und`` and doubtful texts."""
    columns = docs.columns
    out = langid.identify(docs, langid.train(docs.select("doc_id", "text", "lang")))
    return out.where(F.col("lang_pred") != langid.UNDETERMINED).where(F.col("score") >= LEAST_LANGUAGE_SCORE).select(*columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of equal texts the row with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7 with shingles of five words and similarity 0.8: the least id of each component stays."""
    return minhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: rows as often as the mix takes them."""
    return mixing.apply_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the pieces of all sequences."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("pack", pack)]

# A trained language model, exact set similarity over components and a linear program have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_docs(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
