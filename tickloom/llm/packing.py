"""Best-fit packing: a plan over counts of lengths, then documents take planned slots by rank.

Every document is tokenised where it lies. Only a histogram of piece lengths (at most ``size`` rows)
reaches the driver. Best fit, longest first, runs over its counts: bins with equal free space form a
range, and a length with c pieces takes whole ranges at once. A planned slot is "ranks a to b of this
length go to sequences from s on, at this offset"; a piece finds its slot by its rank among the pieces
of its length. Each length empties ranges, and leaves at most two parts of one and a range of new bins, so
the plan's size depends on ``size`` (some thousand slots for 1024) and not on the number of documents.
Ranks come from counts per (length, chunk), so no length is gathered in one task.

Defined cases: a null or empty text is one piece of one token (the end token); pieces of equal length
are alike, so ties don't matter; repeated rows are packed one by one; an empty table packs to nothing.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm.tables import materialise, parts, private, small_batches

SIZE = 1024
END = 2
VOCABULARY = "byte_bpe_50k"
SPECIAL = {"<|endoftext|>": 50256}
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Both libraries split these characters alike; other texts go to the reference tokenizer itself.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ]*")


class Encoder:
    """Ids of the ``tokenizers`` vocabulary; plain texts go through ``tiktoken``, five times as fast, same ids."""

    def __init__(self, vocabulary: str = VOCABULARY) -> None:
        self.exact = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def ids(self, text: str) -> np.ndarray:
        if _PLAIN.fullmatch(text):
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")


def pieces_of(ids: np.ndarray, size: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids; the first piece takes the odd length."""
    start, n = 0, len(ids)
    for piece in range(-(-n // size)):
        length = (n - 1) % size + 1 if piece == 0 else size
        yield piece, start, length, zlib.crc32(ids[start : start + length].tobytes())
        start += length


def tokenised(docs: DataFrame, size: int = SIZE, end: int = END) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").cast(pa.int64()).to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encoder.ids(text.as_py() or ""), np.array([end], "<u4")).astype("<u4", copy=False)
                out += [(doc_id, *x) for x in pieces_of(ids, size)]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return private(small_batches(docs), doc_id="doc_id", text="text").mapInArrow(run, PIECES)


@dataclass(frozen=True)
class Slots:
    """Ranks [first, first + count) of a length go, in order, to sequences from ``sequence`` on, at ``offset``."""

    length: int
    first: int
    count: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], size: int = SIZE) -> list[Slots]:
    """Best fit, longest first, over counts. Bins of equal free space are ranges [sequence, count]."""
    free: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []
    slots: list[Slots] = []
    opened = 0

    def put(space: int, sequence: int, count: int) -> None:
        if space and count:
            if space not in free:
                free[space] = []
                insort(spaces, space)
            free[space].append((sequence, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0

        def fill(space: int, sequence: int, count: int, each: int, length: int = length) -> None:
            nonlocal left, rank
            for k in range(each):
                slots.append(Slots(length, rank, count, sequence, size - space + k * length))
                rank += count
            left -= each * count
            put(space - each * length, sequence, count)

        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                sequence, count = free[space].pop()
                if not free[space]:
                    del free[space]
                    spaces.pop(at)
            else:
                space, sequence = size, opened
                count = -(-left // (size // length))
                opened += count
            each = space // length
            whole = min(count, left // each)
            if whole:
                fill(space, sequence, whole, each)
            if left and whole < count:
                fill(space, sequence + whole, 1, left)
                whole += 1
            put(space, sequence + whole, count - whole)
    return slots


def packed(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` with sequence_id and offset. pieces: stored rows of ``tokenised``."""
    chunks = parts(pieces.sparkSession)
    rows = materialise(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.lit(chunks)))
    counts = rows.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan(histogram, size)
    table = np.array([(s.length, s.first, s.sequence, s.offset) for s in slots], dtype=np.int64).reshape(-1, 4)
    order = np.lexsort((table[:, 1], table[:, 0]))
    lengths, firsts, sequences, offsets = table[order].T
    starts = {int(x): (int(np.searchsorted(lengths, x)), int(np.searchsorted(lengths, x, "right"))) for x in np.unique(lengths)}

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            at = np.zeros(len(frame), dtype=np.int64)
            own, ranks = frame["length"].to_numpy(), frame["rank"].to_numpy()
            for x in np.unique(own):
                lo, hi = starts[int(x)]
                mine = own == x
                at[mine] = lo + np.searchsorted(firsts[lo:hi], ranks[mine], "right") - 1
            yield frame.drop(columns="rank").assign(sequence_id=sequences[at] + ranks - firsts[at], offset=offsets[at])

    base = counts.selectExpr("length", "chunk", "sum(n) over (partition by length order by chunk) - n as base")
    ranked = rows.selectExpr("*", "row_number() over (partition by length, chunk order by uid) - 1 as local")
    ranked = ranked.join(base, ["length", "chunk"]).select(*pieces.columns, (F.col("base") + F.col("local")).alias("rank"))
    return ranked.mapInPandas(place, PIECES + ", sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, size: int = SIZE, end: int = END) -> DataFrame:
    """One row per piece of a document, with the sequence it is in and its place there."""
    return packed(tokenised(docs, size, end), size)
