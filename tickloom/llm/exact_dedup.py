"""Exact dedup: Golomb-coded fingerprint exchange, then byte verification of the suspects.

Senders (groups of rows) sort the 48-bit fingerprints of their texts, cut them by owner (a range of
fingerprints) and send each owner one Golomb-coded run. Owners answer with one bit per fingerprint:
stands it anywhere else? Only texts of suspects are shuffled then, and compared byte by byte; equal
texts are combined before the shuffle, so a group of copies of any size is one row per task.

Defined cases: a null text counts as empty; all white space is one space; of rows with the same text
and doc_id one stays; a null doc_id sorts last; an empty table gives an empty result; columns of
``docs`` other than ``doc_id`` and ``text`` are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import keep_rows, materialise, parts, private

#: Bits of a fingerprint. Suspects are verified, so a chance match costs time and nothing else.
BITS = 48


def normal_text(text: Column) -> Column:
    """The text as it is compared: each run of white space is one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def golomb_encode(values: np.ndarray, universe: int) -> bytes:
    """Sorted non-negative values below ``universe`` as Golomb-coded gaps.

    The divisor is a power of two near the mean gap. All quotients (in unary) stand before all
    remainders, so both parts decode without a loop over values.
    """
    n = len(values)
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    low = max(0, int(universe // max(n, 1)).bit_length() - 1)
    quotients = (gaps >> np.uint64(low)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + n, dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    rest = np.unpackbits(gaps.astype(">u8").view(np.uint8)).reshape(n, 64)[:, 64 - low :]
    head = np.array([n, low, len(unary)], dtype="<u8").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes()


def golomb_decode(data: bytes) -> np.ndarray:
    n, low, width = (int(x) for x in np.frombuffer(data, "<u8", 3))
    body = np.frombuffer(data, np.uint8, offset=24)
    cut = -(-width // 8)
    stops = np.flatnonzero(np.unpackbits(body[:cut], count=width) == 0)
    quotients = (np.diff(stops, prepend=-1) - 1).astype(np.uint64)
    rest = np.zeros((n, 64), dtype=np.uint8)
    if low:
        rest[:, 64 - low :] = np.unpackbits(body[cut:], count=n * low).reshape(n, low)
    remainders = np.packbits(rest.ravel()).view(">u8").astype(np.uint64)
    return np.cumsum((quotients << np.uint64(low)) | remainders)


def _bounds(owners: int) -> np.ndarray:
    return np.array([i * (1 << BITS) // owners for i in range(owners + 1)], dtype=np.uint64)


def _sent(fingerprints: np.ndarray, owners: int) -> Iterator[tuple[int, np.ndarray]]:
    """The runs of sorted fingerprints that each owner gets, in owner order."""
    bounds = _bounds(owners)
    cuts = np.searchsorted(fingerprints, bounds)
    for owner in np.flatnonzero(np.diff(cuts)):
        yield int(owner), fingerprints[cuts[owner] : cuts[owner + 1]] - bounds[owner]


def suspects(rows: DataFrame) -> DataFrame:
    """The ``rid`` of the rows whose ``fp`` another row has too. rows: rid, fp, sender; stored."""
    owners = parts(rows.sparkSession)
    universe = (1 << BITS) // owners + 1

    def send(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        fingerprints = np.sort(group["fp"].to_numpy().astype(np.uint64))
        runs = [(owner, key[0], golomb_encode(run, universe)) for owner, run in _sent(fingerprints, owners)]
        return pd.DataFrame(runs, columns=["owner", "sender", "run"])

    def answer(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        runs = [golomb_decode(x) for x in group["run"]]
        every = np.sort(np.concatenate(runs))
        repeated = np.unique(every[1:][every[1:] == every[:-1]])
        bits = [np.packbits(np.isin(run, repeated)).tobytes() for run in runs]
        return pd.DataFrame({"sender": group["sender"], "owner": key[0], "bits": bits})

    def receive(key: tuple, group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        group = group.iloc[np.argsort(group["fp"].to_numpy(), kind="stable")]
        bits = dict(zip(answers["owner"], answers["bits"], strict=True))
        flags = [
            np.unpackbits(np.frombuffer(bits[owner], np.uint8), count=len(run))
            for owner, run in _sent(group["fp"].to_numpy().astype(np.uint64), owners)
        ]
        return group.loc[np.concatenate(flags).astype(bool), ["rid"]]

    sent = rows.select("sender", "fp").groupBy("sender").applyInPandas(send, "owner int, sender long, run binary")
    answers = sent.groupBy("owner").applyInPandas(answer, "sender long, owner int, bits binary")
    return rows.select("sender", "rid", "fp").groupBy("sender").cogroup(answers.groupBy("sender")).applyInPandas(receive, "rid long")


def _row_key(doc_id: Column, fp: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), fp.cast("string"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: rid, doc_id, keep_id, group_size, kept, text_sha256."""
    norm = normal_text(F.col("text"))
    texts = private(docs, doc_id="doc_id", text="text").select("doc_id", norm.alias("norm"))
    fp = F.shiftrightunsigned(F.xxhash64("norm"), 64 - BITS)
    rows = texts.select("doc_id", fp.alias("fp"), F.sha2("norm", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("rid"))
    rows = materialise(rows.withColumn("sender", F.pmod(F.shiftright("rid", 33), F.lit(parts(docs.sparkSession)))), "exact-rows")
    found = rows.join(suspects(rows), "rid", "left_semi")
    keys = found.select(_row_key(F.col("doc_id"), F.col("fp")).alias("key")).distinct()
    seen = texts.withColumn("key", _row_key(F.col("doc_id"), fp)).join(keys, "key", "left_semi")
    equal = seen.groupBy("norm").count().filter("count > 1").select(F.sha2("norm", 256).alias("text_sha256"))
    groups = (
        rows.join(found.select("rid"), "rid", "left_semi")
        .groupBy("text_sha256")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first"), F.count("*").alias("size"))
        .join(equal, "text_sha256", "left_semi")
    )
    groups = materialise(groups, "exact-groups")
    own = F.col("size").isNull()
    return rows.join(groups, "text_sha256", "left").select(
        "rid",
        "doc_id",
        F.when(own, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (own | (F.col("first.rid") == F.col("rid"))).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = exact_groups(docs)
    key = F.concat_ws(":", F.coalesce(docs["doc_id"].cast("string"), F.lit("-")), F.sha2(normal_text(docs["text"]), 256))
    kept = groups.filter("kept").select(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text_sha256").alias("key"))
    return keep_rows(docs, kept, key)
