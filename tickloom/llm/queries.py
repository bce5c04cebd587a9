"""The registered queries: each applies its operator to a whole table with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import substring_dedup, suffix_dedup
from tickloom.llm.embedding_dedup import near_vectors
from tickloom.llm.exact_dedup import exact_groups
from tickloom.llm.language_id import language_id
from tickloom.llm.licenses import license_scan
from tickloom.llm.minhash import near_groups
from tickloom.llm.mixing import mixed
from tickloom.llm.packing import best_fit_packing
from tickloom.llm.periodic_runs import collapse_runs
from tickloom.llm.secrets import secret_scan
from tickloom.llm.spelling import spelling_variants, word_counts
from tickloom.llm.tables import documents, embeddings
from tickloom.llm.token_files import token_table

# Fixed values of the contracts: every tenth document gets repeats, one in 199 words loses a letter.
REPEATED, CHANGED = 10, 199


def suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.without_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(documents(spark, sf_dir))


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(documents(spark, sf_dir))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(embeddings(spark, sf_dir))


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir)).select("doc_id", "class_id", "kept")


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(documents(spark, sf_dir))


def with_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten ends with a block of its own words over and over; one without id stays as it is."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % REPEATED or not words:
        return words
    n, g = len(words), h // REPEATED
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    return words[:at] + [words[at + (i - at) % period] for i in range(at, n)]


def _most_repeated(runs: Column) -> Column:
    """The run of greatest length / period, the first of equal ones; compared without division."""

    def better(best: Column, run: Column) -> Column:
        return F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best)

    return F.reduce(runs, F.get(runs, F.lit(0)), better)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(documents(spark, sf_dir), with_repeats).withColumn("best", _most_repeated(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.col("kept_sha256").alias("collapsed_sha256"),
    )


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(documents(spark, sf_dir)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(documents(spark, sf_dir), planted=CHANGED))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": suffixes,
    "op2_language_id": language,
    "op3_secret_scan": secrets,
    "op4_source_mixing": mixture,
    "op5_embedding_dedup": vectors,
    "op6_minhash_dedup": near,
    "op7_license_scan": licenses,
    "op8_exact_dedup": exact,
    "op9_best_fit_packing": packing,
    "op10_substring_dedup": substrings,
    "op11_periodic_runs": runs,
    "op12_token_files": tokens,
    "op13_spelling_variants": variants,
}
