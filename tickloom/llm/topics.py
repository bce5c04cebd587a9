"""Topics of texts: spherical k-means over hashed words.

Centroids come from all different texts: each text's counts of words by bucket are stored once, packed in blocks of texts,
and each seed and each round is one pass over these, in tasks that send back sums per cluster. Sums are of whole numbers,
so centroids don't depend on how rows lie. Several sets of seeds start, the best goes on. Every text is then assigned to the nearest
centroid where it lies, from all of its words. Topics are named by their number of different texts, the largest ``topic0``.

Defined cases: a text without words, or a null one, has no topic (null); texts with equal counts are learned from once;
fewer different texts than topics give as many topics as there are texts; without texts there are none.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import rolling
from tickloom.llm.tables import materialise

TOPICS, BUCKETS = 8, 512
#: Sets of seeds, rounds after which the best of them goes on alone, and rounds in all.
TRIES, FIRST, ROUNDS = 4, 4, 30
#: Parts that a coordinate is counted in, and the distance from which on texts are different.
PARTS, APART = 1 << 20, 1e-6
ENTRY = np.dtype([("bucket", "<u2"), ("count", "<u4")])
#: Texts of a stored block: a pass reads a row for each block, and the vectors of one fit into a processor's cache.
BLOCK = 64
#: Bytes of blocks that a task reads at once, as a row group of their table.
GROUP_BYTES = 16 << 20


@dataclass(frozen=True)
class Topics:
    """One row for each topic, of length 1."""

    centroids: np.ndarray

    @property
    def names(self) -> list[str]:
        return [f"topic{i}" for i in range(len(self.centroids))]

    def of(self, data: np.ndarray, bounds: np.ndarray) -> list[str | None]:
        """The topic of each text of a chunk."""
        rows = vectors(data, bounds)
        if not len(self.centroids):
            return [None] * len(rows)
        best = (rows @ self.centroids.T).argmax(axis=1)
        return [f"topic{b}" if ok else None for b, ok in zip(best, rows.any(axis=1), strict=True)]


def vectors(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """log(1 + count) of each bucket of words, scaled to length 1; zero for texts without words."""
    return _scaled(_weights(_counts(data, bounds)))


def _counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    starts, ends, own = rolling.words(data, bounds)
    buckets = (rolling.word_hashes(data, starts, ends) >> np.uint64(40)).astype(np.int64) % BUCKETS
    texts = np.repeat(np.arange(len(bounds) - 1), np.diff(own))
    return np.bincount(texts * BUCKETS + buckets, minlength=(len(bounds) - 1) * BUCKETS).reshape(-1, BUCKETS)


def _weights(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts).astype(np.float32)


#: Weights of the counts that fit into a byte.
_FEW = _weights(np.arange(256, dtype=np.float32))


def _scaled(rows: np.ndarray) -> np.ndarray:
    """``rows`` of weights scaled to length 1, in place; zero stays zero."""
    sizes = np.linalg.norm(rows, axis=1, keepdims=True)
    rows /= np.where(sizes > 0, sizes, np.float32(1))
    return rows


def _keys(rows: np.ndarray, places: np.ndarray, chosen: np.ndarray, attempt: int) -> np.ndarray:
    """The row with the smallest key is drawn with a chance in proportion to its distance from the seeds ``chosen``; none if infinite."""
    far = np.ones(len(rows)) if not len(chosen) else 1 - (rows @ chosen.T).max(axis=1).astype(float)
    x = places.astype(np.uint64) + np.uint64((attempt * 1000 + len(chosen) + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    chance = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53)
    return np.where(far > APART, -np.log(np.maximum(chance, 1e-300)) / np.maximum(far, APART), np.inf)


def _sums(rows: np.ndarray, tries: list[np.ndarray]) -> np.ndarray:
    """For each try and cluster the sum of its rows, their number, and the sum of their similarities, in parts."""
    # Whole numbers of at most PARTS: exact as single floats, and so are their sums as doubles.
    parts = np.rint(rows * np.float32(PARTS)).astype(float)
    total = np.zeros((len(tries), len(tries[0]), BUCKETS + 2), np.int64)
    for centroids, out in zip(tries, total, strict=True):
        alike = rows @ centroids.T
        own = np.zeros((len(centroids), len(rows)))
        own[alike.argmax(axis=1), np.arange(len(rows))] = 1
        out[:, :BUCKETS] = np.rint(own @ parts)
        out[:, BUCKETS] = own.sum(axis=1)
        out[:, BUCKETS + 1] = np.rint(own @ np.rint(alike.max(axis=1).astype(float) * PARTS))
    return total


def _clustered(seeds: Callable[[list[np.ndarray]], dict[int, np.ndarray]], sums: Callable[[list[np.ndarray]], np.ndarray], k: int) -> np.ndarray:
    """Centroids of at most k clusters, largest first. seeds: the next seed of each try; sums: ``_sums`` over all rows for each try."""
    tries = [np.zeros((0, BUCKETS), np.float32) for _ in range(TRIES)]
    for _ in range(k):
        found = seeds(tries)
        if len(found) < len(tries):
            tries = [t for i, t in enumerate(tries) if i in found] or tries[:1]
            if not found:
                break
        tries = [np.vstack([t, f]) for t, (_, f) in zip(tries, sorted(found.items()), strict=True)]
    if not len(tries[0]):
        return tries[0]
    for number in range(ROUNDS):
        got = sums(tries)
        if number == FIRST:
            best = int(got[:, :, -1].sum(axis=1).argmax())
            tries, got = [tries[best]], got[best : best + 1]
        moved = []
        for centroids, own in zip(tries, got, strict=True):
            points = own[:, :BUCKETS].astype(float)
            sizes = np.linalg.norm(points, axis=1, keepdims=True)
            moved.append(np.where(sizes > 0, points / np.maximum(sizes, 1e-12), centroids).astype(np.float32))
        if all(np.allclose(a, b, atol=1e-6) for a, b in zip(tries, moved, strict=True)):
            break
        tries = moved
    best = int(got[:, :, -1].sum(axis=1).argmax())
    return tries[best][np.argsort(-got[best, :, BUCKETS], kind="stable")]


def cluster(rows: np.ndarray, k: int) -> np.ndarray:
    """Centroids of at most k clusters, largest first. rows: of length 1, all different."""
    # By the buckets in use: the last bits of weights differ between machines, and seeds must not.
    places = np.array([zlib.crc32(np.packbits(r > 0).tobytes()) for r in rows], np.uint64)

    def seeds(tries: list[np.ndarray]) -> dict[int, np.ndarray]:
        keys = [_keys(rows, places, chosen, i) for i, chosen in enumerate(tries)] if len(rows) else []
        return {i: rows[int(own.argmin())] for i, own in enumerate(keys) if np.isfinite(own.min())}

    return _clustered(seeds, lambda tries: _sums(rows, tries), k)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, bounds in rolling.chunks(batch):
            counts = _counts(data, bounds)
            texts, buckets = np.nonzero(counts)
            entries = np.zeros(len(texts), ENTRY)
            entries["bucket"], entries["count"] = buckets, counts[texts, buckets]
            ends = np.cumsum(np.bincount(texts, minlength=len(counts))) * ENTRY.itemsize
            buffers = [None, pa.py_buffer(np.append(0, ends).astype("<i4")), pa.py_buffer(entries.tobytes())]
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(counts), buffers)], names=["entries"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """places, buckets and counts of up to ``BLOCK`` texts in a row: a bit for each bucket, and the counts of those in use, as narrow as they fit."""
    for batch in batches:
        blocks = []
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            data, bounds = rolling.strings(part.column("entries"))
            entries = data.view(ENTRY)
            used = np.zeros((part.num_rows, BUCKETS), bool)
            starts = np.repeat(np.arange(part.num_rows) * BUCKETS, np.diff(bounds) // ENTRY.itemsize)
            used.ravel()[starts + entries["bucket"]] = True
            counts = entries["count"].astype(np.min_scalar_type(entries["count"].max()))
            blocks.append([x.tobytes() for x in (part.column("place").to_numpy(), np.packbits(used), counts)])
        if blocks:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*blocks, strict=True)], names=["places", "buckets", "counts"])


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts' vectors of length 1 and their places, of each stored block."""
    for batch in batches:
        for block in zip(*batch.columns, strict=True):
            places, used, counts = (np.frombuffer(x.as_buffer(), kind) for x, kind in zip(block, (np.int64, np.uint8, np.uint8), strict=True))
            rows = np.zeros((len(places), BUCKETS), np.float32)
            cells = np.flatnonzero(np.unpackbits(used))
            counts = counts.view(f"u{len(counts) // len(cells)}")
            rows.ravel()[cells] = _FEW[counts] if counts.itemsize == 1 else _weights(counts.astype(np.float32))
            yield _scaled(rows), places


def learned(texts: DataFrame, k: int = TOPICS) -> Topics:
    """Topics of ``texts`` (text), from all different ones."""
    rows = texts.filter("text is not null").select(F.lit(0).alias("place"), "text")
    entries = rows.mapInArrow(_counted, "entries binary").filter(F.octet_length("entries") > 0).distinct()
    blocks = entries.select(F.xxhash64("entries").alias("place"), "entries").mapInArrow(_blocks, "places binary, buckets binary, counts binary")
    stored = materialise(blocks, "topic-rows", **{"parquet.block.size": GROUP_BYTES})

    def seeds(tries: list[np.ndarray]) -> dict[int, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple[float, int, bytes]] = {}
            for rows, places in _opened(batches):
                for i, chosen in enumerate(tries):
                    keys = _keys(rows, places.view(np.uint64), chosen, i)
                    at = int(keys.argmin())
                    if np.isfinite(keys[at]):
                        found = float(keys[at]), int(places[at]), rows[at].tobytes()
                        best[i] = min(best.get(i, found), found)
            if best:
                columns = [pa.array(x, kind) for x, kind in zip(zip(*((i, *x) for i, x in best.items()), strict=True), (pa.int32(), pa.float64(), pa.int64(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["attempt", "key", "place", "row"])

        found = stored.mapInArrow(run, "attempt int, key double, place long, row binary")
        found = found.groupBy("attempt").agg(F.min_by("row", F.struct("key", "place")).alias("row")).collect()
        return {r["attempt"]: np.frombuffer(bytes(r["row"]), np.float32) for r in found}

    def sums(tries: list[np.ndarray]) -> np.ndarray:
        shape = len(tries), len(tries[0]), BUCKETS + 2

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape, np.int64)
            for rows, _ in _opened(batches):
                total += _sums(rows, tries)
            cells = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel()[cells])], names=["cell", "n"])

        found = stored.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        total = np.zeros(shape, np.int64)
        total.ravel()[found["cell"].to_numpy()] = found["n"].to_numpy()
        return total

    return Topics(_clustered(seeds, sums, k))
