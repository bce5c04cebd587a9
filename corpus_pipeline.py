"""From raw documents to packed training sequences, in five stages of the llm operators.

Every stage works on all rows that its predecessor kept and is written as Parquet before the next one
reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.exact_dedup import exact_dedup
from tickloom.llm.language_id import recognised
from tickloom.llm.minhash import near_dedup
from tickloom.llm.mixing import sample_mixture
from tickloom.llm.packing import best_fit_packing
from tickloom.session import scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; ``lang`` stays as given."""
    return recognised(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal text."""
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target shares of sources, languages and topics."""
    return sample_mixture(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, packed into sequences."""
    return best_fit_packing(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL can't express the trained classifier, the sampled near copies, the raking or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        done.write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.schema(done.schema).parquet(f"{folder}/{number}-{name}")
    return docs
