"""Reading the given tables, and intermediate tables in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import materialise

__all__ = ["documents", "embeddings", "keep_rows", "materialise", "parts", "private", "row_key", "small_batches"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def parts(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which follows the size of the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after bounding, for the rest of the session, the rows of a batch that Python tasks get: texts are long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return df


def private(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Only the named columns of ``df``, under names of our own: extra columns can't clash."""
    return df.select(*[(df[c] if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def row_key(doc_id: Column, text: Column) -> Column:
    """Stands for (doc_id, whole text) in joins; rows with equal keys are equal in both."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.xxhash64(text).cast("string"), F.xxhash64(F.lit(7), text).cast("string"))


def keep_rows(docs: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is in ``keys`` (column "key"), one of each repeated row."""
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), key.alias("key"))
    kept = keyed.join(keys.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    return kept.select("row.*")
