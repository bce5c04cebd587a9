"""Suffix-array dedup: every byte in a string of ``SIZE`` bytes that also starts anywhere else goes.

Texts are cut into shards of bounded size. A shard sorts the suffixes that may start a repeated string
(Larsson-Sadakane refinement: by 8 bytes, then doubling through ranks, only groups that still tie) and
gets the common prefixes of neighbours by Kasai's rule. Neighbours with ``SIZE`` bytes in common are
repeats within the shard. Across shards, each sends one sorted run with a fingerprint of each of its
different strings; owners sort their runs together (no binary search) and answer with a bit per string.
No text moves for that, and a string that is frequent everywhere is sent once by each shard. So suffix arrays
decide repeats within a shard, equal fingerprints those across shards. A fingerprint is two polynomials modulo
2^61 - 1 whose bases are drawn at random for each run: whatever the texts, two different strings have equal
ones with a chance of at most (400 / 2^61)^2, which is under 2^-104.

Defined cases: a null text is empty; texts under ``SIZE`` bytes lose nothing; of equal texts one is
looked at (equal by the SHA-256 of their bytes) and all lose what it loses or, from ``SIZE`` bytes on,
everything; repeated rows are equal texts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import exchange, rolling
from tickloom.llm.anchors import Windows, candidates, repeated_windows
from tickloom.llm.tables import materialise

SIZE, GRAM = 400, 200
#: Bytes of text and of possible repeats in a shard (one text may be longer).
SHARD_TEXT, SHARD_REPEATS = 4_000_000, 800_000
_DEPTH, _PAIRS = 512, 1 << 13


def suffix_order(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``_DEPTH`` bytes, and their ranks after the first half of that.

    ends: for each byte, where its stretch ends. Suffixes are compared by blocks of 8 bytes; less than 8
    bytes at the end of a stretch are a letter of its own, above all others.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + n]
    left = ends - np.arange(n)
    full = np.flatnonzero(left >= 8)
    full = full[np.argsort(key[full], kind="stable")]
    order = np.concatenate([full, np.flatnonzero(left < 8)])
    new = np.ones(n, dtype=bool)
    new[1 : len(full)] = key[full[1:]] != key[full[:-1]]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    half, h = rank, 8
    while h < _DEPTH:
        if h == _DEPTH // 2:
            half = rank.copy()
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, n))
        tied = np.repeat(sizes > 1, sizes)
        slots = np.flatnonzero(tied)
        if len(slots) == 0:
            break
        own = order[slots]
        after = np.where(left[own] == h, n + own, rank[np.minimum(own + h, n - 1)])
        group = rank[own]
        moved = np.argsort(group.astype(np.uint64) * np.uint64(2 * n) + after.astype(np.uint64), kind="stable")
        own, after, group = own[moved], after[moved], group[moved]
        order[slots] = own
        differs = np.ones(len(own), dtype=bool)
        differs[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        new[slots] = differs
        rank[own] = slots[np.maximum.accumulate(np.where(differs, np.arange(len(own)), 0))]
        h *= 2
    else:
        return order, half
    return order, rank if h <= _DEPTH // 2 else half


def _compared(data: np.ndarray, ends: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes x and y have in common, compared 64 at a time, some thousand pairs at once."""
    limit = np.minimum(ends[x] - x, ends[y] - y)
    size = np.zeros(len(x), dtype=np.int64)
    padded, steps = np.concatenate([data, np.zeros(64, np.uint8)]), np.arange(64)
    for low in range(0, len(x), _PAIRS):
        active = np.arange(low, min(low + _PAIRS, len(x)))
        while len(active):
            here = size[active]
            same = padded[(x[active] + here)[:, None] + steps] == padded[(y[active] + here)[:, None] + steps]
            run = np.where(same.all(axis=1), 64, same.argmin(axis=1))
            size[active] = np.minimum(here + run, limit[active])
            active = active[(run == 64) & (here + 64 < limit[active])]
    return size


def common_prefixes(data: np.ndarray, ends: np.ndarray, at: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix ``at`` (ascending) with its neighbour ``before`` in suffix order.

    Kasai: where both move on by one byte, one byte less is common. So only the first of such a chain is
    compared, and the one behind the place where nothing is left.
    """
    head = np.zeros(len(at), dtype=bool)
    head[:1] = True
    for x in (at, before):
        head[1:] |= (x[1:] != x[:-1] + 1) | (ends[x[1:]] != ends[x[:-1]])
    while True:
        first = np.flatnonzero(head)
        chain = np.cumsum(head) - 1
        common = _compared(data, ends, at[first], before[first])[chain] - (at - at[first][chain])
        over = common < 0
        over[1:] &= ~over[:-1] | head[1:]
        if not over.any():
            return common
        head |= over


class Shard:
    """The strings of ``SIZE`` bytes in a shard's row that may be repeated: the stretches of text that
    hold them, one behind the other, and where each string starts in them and in the text."""

    def __init__(self, row: dict) -> None:
        self.rids = np.frombuffer(row["rids"], "<i8")
        self.bounds = np.frombuffer(row["bounds"], "<i8")
        self.text = np.frombuffer(row["text"], np.uint8)
        runs = np.frombuffer(row["runs"], "<i8").reshape(-1, 2)
        strings = runs[:, 1] - runs[:, 0]
        sizes = strings + SIZE - 1
        last = np.cumsum(sizes)
        self.ends = np.repeat(last, sizes)
        self.data = self.text[np.repeat(runs[:, 0] - last + sizes, sizes) + np.arange(sizes.sum())]
        within = np.arange(strings.sum()) - np.repeat(np.cumsum(strings) - strings, strings)
        self.starts = np.repeat(runs[:, 0], strings) + within
        self.places = np.repeat(last - sizes, strings) + within

    def fingerprints(self, bases: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each string; the first, of 61 bits, is moved up, as owners take ranges of all 64."""
        one, two = (rolling.prime_hashes(self.data, self.places, self.places + SIZE, base) for base in bases)
        return one << np.uint64(3), two

    def repeats(self) -> np.ndarray:
        """Which strings stand more than once in this shard, from its suffix array."""
        order, half = suffix_order(self.data, self.ends)
        number = np.full(len(self.data), -1, dtype=np.int64)
        number[self.places] = np.arange(len(self.places))
        order = order[number[order] >= 0]
        tied = np.flatnonzero(half[order[1:]] == half[order[:-1]])
        at, before = order[tied + 1], order[tied]
        by = np.argsort(at)
        at, before = at[by], before[by]
        long = common_prefixes(self.data, self.ends, at, before) >= SIZE
        flags = np.zeros(len(self.places), dtype=bool)
        flags[number[at[long]]] = True
        flags[number[before[long]]] = True
        return flags


def _shards(texts: DataFrame, kind: Windows) -> DataFrame:
    """One row per shard: rids, bounds of the texts, their bytes, runs of starts of possible repeats, and how many those are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rids, sizes, blobs, runs, text, held = [], [], [], [], 0, 0

        def row() -> pa.RecordBatch:
            arrays = [np.array(rids, "<i8"), np.concatenate([[0], np.cumsum(sizes)]).astype("<i8"), b"".join(blobs), np.concatenate(runs).astype("<i8")]
            arrays = [pa.array([x if isinstance(x, bytes) else x.tobytes()], pa.binary()) for x in arrays] + [pa.array([held], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["rids", "bounds", "text", "runs", "strings"])

        for batch in batches:
            for rows, data, bounds in rolling.chunks(batch):
                codes, own, _ = kind.items(data, bounds)
                _, low, _ = kind.anchors(rolling.prefix(codes), own)
                starts, ends = rolling.runs(repeated_windows(rows, low))
                cuts = np.searchsorted(starts, bounds)
                for i, rid in enumerate(rows.column("rid").to_pylist()):
                    mine = slice(cuts[i], cuts[i + 1])
                    if cuts[i] == cuts[i + 1]:
                        continue
                    size = int(bounds[i + 1] - bounds[i])
                    rids.append(rid)
                    sizes.append(size)
                    blobs.append(data[bounds[i] : bounds[i + 1]].tobytes())
                    runs.append(np.stack([starts[mine], ends[mine]], axis=1) + (text - bounds[i]))
                    text += size
                    held += int((ends[mine] - starts[mine]).sum())
                    if text >= SHARD_TEXT or held >= SHARD_REPEATS:
                        yield row()
                        rids, sizes, blobs, runs, text, held = [], [], [], [], 0, 0
        if rids:
            yield row()

    return texts.mapInArrow(run, "rids binary, bounds binary, text binary, runs binary, strings long")


def _local(shards: DataFrame) -> DataFrame:
    """sender, bits: repeats within each shard, from its suffix array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bits = np.packbits(Shard(row).repeats()).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([row["sender"]], pa.int64()), pa.array([bits], pa.binary())], names=["sender", "local"])

    return shards.mapInArrow(run, "sender long, local binary")


def _cut(shards: DataFrame, local: DataFrame, replies: DataFrame, bases: tuple[int, int], owners: int) -> DataFrame:
    """rid, n_removed, n_spans, kept_sha256 and kept bytes of the texts in shards."""

    def run(key: tuple, group: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in group.to_dict("records"):
            shard = Shard(row)
            keys, _, which = exchange.distinct(*shard.fingerprints(bases))
            gone = np.unpackbits(np.frombuffer(row["local"], np.uint8), count=len(shard.starts)).astype(bool)
            gone |= exchange.received(replies, keys, owners)[which]
            removed = rolling.cover(shard.starts[gone], SIZE, len(shard.text))
            for rid, a, b in zip(shard.rids, shard.bounds[:-1], shard.bounds[1:], strict=True):
                own = removed[a:b]
                kept = shard.text[a:b][~own].tobytes()
                out.append((rid, int(own.sum()), len(rolling.runs(own)[0]), hashlib.sha256(kept).hexdigest(), kept))
        return pd.DataFrame(out, columns=["rid", "n_removed", "n_spans", "kept_sha256", "kept"])

    sides = shards.join(local, "sender").groupBy("sender").cogroup(replies.groupBy("sender"))
    return sides.applyInPandas(run, "rid long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes where some went (else null)."""
    kind = Windows(SIZE, GRAM, by_word=False)
    every, few = candidates(docs, kind)
    shards = materialise(_shards(few, kind).withColumn("sender", F.monotonically_increasing_id()), "suffix-shards")
    local = materialise(_local(shards), "suffix-repeats")
    bases = (secrets.randbelow(1 << 60) + 1000, secrets.randbelow(1 << 60) + 1000)

    def keys(row: dict) -> tuple[np.ndarray, np.ndarray]:
        return exchange.distinct(*Shard(row).fingerprints(bases))[:2]

    owners = exchange.owners_of(shards, shards.agg(F.sum("strings")).first()[0] or 0)
    cut = _cut(shards, local, exchange.answers(exchange.sent(shards, keys, owners)), bases, owners)
    zero, whole = F.lit(0).cast("long"), (F.col("copies") > 1) & (F.col("n") >= SIZE)
    return every.join(cut, "rid", "left").select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        F.when(whole, F.col("n")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(whole, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"),
    )
