"""Candidates for repeated stretches of text, with no repeat missed.

Of every window of fixed size, the gram with the smallest hash is its anchor; windows with equal content
have equal anchors, and neighbouring windows mostly share theirs, so a text has few of them. A window can
only be repeated if its anchor stands elsewhere too. Anchors are compared through ``exchange``; only texts
with repeated anchors are looked at again. Of texts that are equal as a whole (by the SHA-256 of their bytes
or words), one is looked at. An anchor's hash only finds candidates: what is repeated is decided elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import exchange, rolling
from tickloom.llm.tables import materialise, private, row_key, small_batches

#: Anchors of one sender.
SENDER = 200_000


@dataclass(frozen=True)
class Windows:
    """Windows of ``size`` items (bytes or words), and the grams of ``gram`` items that anchor them."""

    size: int
    gram: int
    by_word: bool

    def items(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """64-bit codes of all items, bounds of the texts in them, and where words stand."""
        if not self.by_word:
            return rolling.byte_codes(data), bounds, ()
        starts, ends, own = rolling.words(data, bounds)
        return rolling.word_hashes(data, starts, ends), own, (starts, ends)

    def anchors(self, sums: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of the gram at each item, the anchor's hash of each window (0: no window), and which grams are anchors."""
        grams = rolling.windows(sums, self.gram)
        valid = rolling.within(bounds, self.size, len(grams))
        low, chosen = rolling.winnow(grams, valid, self.size - self.gram + 1)
        return grams, low, chosen & (low.max(initial=0) > 0)


def _held(own: np.ndarray) -> bytes:
    """A text's distinct anchors; those that it has more than once, twice. Minima are small numbers, so
    they are mixed again: owners take ranges of keys."""
    values, counts = np.unique(rolling.mix(own), return_counts=True)
    return np.concatenate([values, values[counts > 1]]).astype("<u8").tobytes()


def _described(docs: DataFrame, kind: Windows) -> DataFrame:
    """key, doc_id, n (items), digest and anchors of each row. The digest is over the bytes of the text or,
    by word, over its words with a space between; rows with equal digests are one class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in rolling.chunks(batch):
                codes, own, _ = kind.items(data, bounds)
                sums = rolling.prefix(codes)
                grams, _, chosen = kind.anchors(sums, own)
                at = np.flatnonzero(chosen)
                cuts = np.searchsorted(at, own)
                n = np.diff(own)
                texts = [data[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                if kind.by_word:
                    texts = [b" ".join(x.split()) for x in texts]
                columns = [
                    rows.column("key"),
                    rows.column("doc_id").cast(pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                    pa.array([_held(grams[at[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "doc_id", "n", "sha256", "anchors"])

    return docs.select("key", "doc_id", "text").mapInArrow(run, "key string, doc_id long, n long, sha256 string, anchors binary")


def _gathered(first: DataFrame) -> DataFrame:
    """Senders: rows with the anchors of many texts. first: rid, anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rids, blobs, held = [], [], 0

        def row() -> pa.RecordBatch:
            arrays = [np.array(rids, "<i8").tobytes(), np.array([len(b) // 8 for b in blobs], "<i8").tobytes(), b"".join(blobs)]
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in arrays], names=["rids", "sizes", "anchors"])

        for batch in batches:
            for rid, blob in zip(batch.column("rid").to_pylist(), batch.column("anchors").to_pylist(), strict=True):
                rids.append(rid)
                blobs.append(blob)
                held += len(blob) // 8
                if held >= SENDER:
                    yield row()
                    rids, blobs, held = [], [], 0
        if rids:
            yield row()

    return first.select("rid", "anchors").mapInArrow(run, "rids binary, sizes binary, anchors binary")


def _keys(row: dict) -> tuple[np.ndarray, None]:
    return np.unique(np.frombuffer(row["anchors"], "<u8")), None


def _repeated(first: DataFrame) -> DataFrame:
    """rid and its repeated anchors, for texts that have some."""
    senders = materialise(_gathered(first).withColumn("sender", F.monotonically_increasing_id()), "anchor-senders")
    owners = exchange.owners_of(senders, senders.agg(F.sum(F.length("anchors"))).first()[0] // 8 if not senders.isEmpty() else 0)

    def receive(key: tuple, group: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in group.to_dict("records"):
            anchors = np.frombuffer(row["anchors"], "<u8")
            keys, which, counts = np.unique(anchors, return_inverse=True, return_counts=True)
            shared = (counts > 1) | exchange.received(replies, keys, owners)
            ends = np.cumsum(np.frombuffer(row["sizes"], "<i8"))
            for rid, own, flags in zip(np.frombuffer(row["rids"], "<i8"), np.split(anchors, ends[:-1]), np.split(shared[which], ends[:-1]), strict=True):
                if flags.any():
                    out.append((rid, own[flags].tobytes()))
        return pd.DataFrame(out, columns=["rid", "anchors"])

    replies = exchange.answers(exchange.sent(senders, _keys, owners))
    return senders.groupBy("sender").cogroup(replies.groupBy("sender")).applyInPandas(receive, "rid long, anchors binary")


def candidates(docs: DataFrame, kind: Windows) -> tuple[DataFrame, DataFrame]:
    """All rows, stored: rid, doc_id, n, sha256, copies (rows with these items), first (is the row the
    one of smallest doc_id, nulls last). And of the first ones those with repeated anchors: rid, order
    (doc_id, nulls last), text, anchors."""
    texts = private(small_batches(docs), key=row_key(docs["doc_id"], docs["text"]), doc_id="doc_id", text="text")
    rows = materialise(_described(texts, kind).withColumn("rid", F.monotonically_increasing_id()), "described")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    classes = rows.groupBy("sha256").agg(F.min(order).alias("head"), F.count("*").alias("copies"))
    classes = materialise(classes.select("sha256", F.col("head.rid").alias("head"), "copies"), "text-classes")
    found = materialise(_repeated(rows.join(classes.select(F.col("head").alias("rid")), "rid", "left_semi")), "repeated-anchors")
    last = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("order")
    wanted = rows.select("key", "rid", last).join(found, "rid")
    few = texts.select("key", "text").join(wanted, "key").dropDuplicates(["key"]).select("rid", "order", "text", "anchors")
    every = rows.select("rid", "doc_id", "n", "sha256").join(classes, "sha256")
    return every.select("rid", "doc_id", "n", "sha256", "copies", (F.col("head") == F.col("rid")).alias("first")), few


def repeated_windows(rows: pa.RecordBatch, low: np.ndarray) -> np.ndarray:
    """Which windows have an anchor that is repeated. rows: with ``anchors``; low: anchor of each window."""
    known = np.unique(np.concatenate([np.frombuffer(x, "<u8") for x in rows.column("anchors").to_pylist()]))
    mixed = rolling.mix(low)
    at = np.minimum(np.searchsorted(known, mixed), len(known) - 1)
    return (known[at] == mixed) & (low > 0)
