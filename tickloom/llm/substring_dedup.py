"""Substring dedup: suffix automata of reference shards give matching statistics of word sequences.

A window of ``SIZE`` words is removed where the same words start earlier. Stretches of windows with one
repeated anchor go to the shard of that anchor, so all places of a window meet. A shard takes its
stretches in document order: each streams through the automaton of the earlier ones, and a window is
repeated where the longest match that ends with it has ``SIZE`` words or more; new words extend the
automaton. Stretches are sent as words, not as hashes; a shard numbers its different words. Reference shards are bounded in size; sending stretches to the one shard that can hold their
match takes the place of sending every shard to all documents, which would grow with the square of the
input. Equal stretches are combined before the shuffle. An anchor with many different stretches is dealt
over several shards, and the windows that are new there meet once more by a 128-bit BLAKE2 hash of their words.

Defined cases: a null text has no words; of texts with equal words the one with the smallest doc_id
(nulls last, then by row) counts as earliest; repeated rows are texts of their own, so all but one lose
their windows; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import rolling
from tickloom.llm.anchors import Windows, candidates, repeated_windows
from tickloom.llm.tables import materialise

SIZE, GRAM = 20, 5
#: Stretches in a reference shard, about, and those of one anchor from which on they are dealt out.
SHARD, SPLIT = 3000, 500
#: Stretches that a task holds to combine equal ones before it sends them.
HELD = 100_000

_STRETCH = "anchor long, digest long, order long, rid long, start long, windows long, words binary"


class Automaton:
    """Suffix automaton of several sequences: the smallest automaton that knows all their substrings."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, after: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(after)
        return len(self.length) - 1

    def _split(self, p: int, q: int, code: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(code) == q:
            self.next[p][code] = clone
            p = self.link[p]
        return clone

    def add(self, codes: list[int]) -> list[int]:
        """Learn a sequence; for each place, the length of the longest one that ends there and ended somewhere before."""
        following, link, length = self.next, self.link, self.length
        last, out = 0, []
        for code in codes:
            q = following[last].get(code)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, q, code)
                out.append(length[last])
                continue
            new = self._state(length[last] + 1, 0, {})
            p = last
            while p >= 0 and code not in following[p]:
                following[p][code] = new
                p = link[p]
            if p >= 0:
                q = following[p][code]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, q, code)
            last = new
            out.append(length[link[new]])
        return out

    def matches(self, codes: list[int]) -> list[int]:
        """For each place, the length of the longest known sequence that ends there."""
        following, link, length = self.next, self.link, self.length
        state, size, out = 0, 0, []
        for code in codes:
            while state and code not in following[state]:
                state = link[state]
                size = length[state]
            state = following[state].get(code, 0)
            size = size + 1 if state else 0
            out.append(size)
        return out


def _single_spaced(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a chunk with one space between words."""
    texts = [b" ".join(data[a:b].tobytes().split()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _stretches(texts: DataFrame, kind: Windows) -> DataFrame:
    """Stretches of windows with one repeated anchor; words is null where the task has an equal earlier one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def combined() -> pa.RecordBatch:
            columns = [np.concatenate([h[i] for h in held]).astype(np.int64) for i in range(5)]
            blobs = [b for h in held for b in h[5]]
            anchor, order, rid, start, _ = columns
            first: dict[tuple[int, bytes], int] = {}
            for i in np.lexsort((start, rid, order)).tolist():
                first.setdefault((anchor[i], blobs[i]), i)
            sent = set(first.values())
            digests = [int.from_bytes(hashlib.blake2b(b, digest_size=8).digest(), "little", signed=True) if i in sent else 0 for i, b in enumerate(blobs)]
            arrays = [pa.array(c, pa.int64()) for c in (anchor, digests, *columns[1:])]
            arrays.append(pa.array([b if i in sent else None for i, b in enumerate(blobs)], pa.binary()))
            return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in _STRETCH.split(", ")])

        for batch in batches:
            for rows, data, bounds in rolling.chunks(batch):
                data, bounds = _single_spaced(data, bounds)
                codes, own, (firsts, lasts) = kind.items(data, bounds)
                _, low, _ = kind.anchors(rolling.prefix(codes), own)
                shared = np.where(repeated_windows(rows, low), low, np.uint64(0))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], shared, [0]]).astype(np.uint64)))
                starts, ends = edge[:-1], edge[1:]
                full = shared[starts] > 0 if len(starts) else np.zeros(0, bool)
                starts, ends = starts[full], ends[full]
                to = ends + kind.size - 1
                text = np.searchsorted(own, starts, "right") - 1
                rids, orders = (np.array(rows.column(c).to_pylist(), dtype=np.int64) for c in ("rid", "order"))
                whole = data.tobytes()
                blobs = [whole[a:b] for a, b in zip(firsts[starts].tolist(), lasts[to - 1].tolist(), strict=True)] if len(starts) else []
                held.append((shared[starts], orders[text], rids[text], starts - own[text], ends - starts, blobs))
                size += len(starts)
                if size >= HELD:
                    yield combined()
                    held, size = [], 0
        if size:
            yield combined()

    return texts.mapInArrow(run, _STRETCH)


_FOUND = "rid long, start long, windows long, fresh_a long, fresh_b long, order long"


def _matched(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows of a shard's stretches, as runs; and, of dealt-out anchors, the hash of each new window."""
    group = group.sort_values(["order", "rid", "start"])
    known, seen, runs, fresh = Automaton(), set(), [], []
    numbers: dict[bytes, int] = {}
    for blob, rid, start, windows, order, salts in zip(*[group[c] for c in ("words", "rid", "start", "windows", "order", "salts")], strict=True):
        if blob in seen:
            runs.append((rid, start, windows))
            continue
        seen.add(blob)
        words = blob.split(b" ")
        codes = [numbers.setdefault(w, len(numbers)) for w in words]
        old = np.array(known.matches(codes))[SIZE - 1 :] >= SIZE
        if not old.all():
            old = np.array(known.add(codes))[SIZE - 1 :] >= SIZE  # repeats within the stretch too
        runs += [(rid, start + a, b - a) for a, b in zip(*rolling.runs(old), strict=True)]
        if salts > 1:
            for at in np.flatnonzero(~old):
                name = np.frombuffer(hashlib.blake2b(b" ".join(words[at : at + SIZE]), digest_size=16).digest(), "<i8")
                fresh.append((rid, start + at, 1, name[0], name[1], order))
    found = pd.DataFrame(runs, columns=["rid", "start", "windows"]).astype("int64").assign(fresh_a=None, fresh_b=None, order=None)
    new = pd.DataFrame(fresh, columns=found.columns).astype("int64")
    return pd.concat([found.astype("Int64"), new.astype("Int64")])


def repeated_runs(texts: DataFrame, kind: Windows) -> DataFrame:
    """rid, start, windows: runs of windows whose words start earlier as well. texts: stored."""
    stretches = materialise(_stretches(texts, kind), "stretches")
    sent = stretches.filter("words is not null")
    shards = max(1, -(-sent.count() // SHARD))
    many = sent.groupBy("anchor").count().filter(F.col("count") > SPLIT)
    many = materialise(many.select("anchor", F.ceil(F.col("count") / SPLIT).alias("salts")), "split-anchors")
    dealt = sent.join(many, "anchor", "left").withColumn("salts", F.coalesce("salts", F.lit(1).cast("long")))
    salt = F.pmod(F.xxhash64("digest"), F.col("salts"))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("anchor", salt), F.lit(shards)))
    columns = ["shard", "words", "rid", "start", "windows", "order", "salts"]
    found = materialise(dealt.select(*columns).groupBy("shard").applyInPandas(_matched, _FOUND), "matches")
    local = stretches.filter("words is null").select("rid", "start", "windows")
    again = found.filter("fresh_a is not null").selectExpr(
        "rid", "start", "windows", 'row_number() over (partition by fresh_a, fresh_b order by "order", rid, start) as place'.replace('"', "`")
    )
    runs = found.filter("fresh_a is null").select("rid", "start", "windows")
    return local.union(runs).union(again.filter("place > 1").select("rid", "start", "windows"))


def _cut(texts: DataFrame) -> DataFrame:
    """rid, n_removed, kept_sha256 of texts with their runs of repeated windows. texts: rid, text, runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rid, text, runs in zip(*[batch.column(c).to_pylist() for c in ("rid", "text", "runs")], strict=True):
                words = (text or "").encode().split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for r in runs:
                    gone[r["start"]] += 1
                    gone[r["start"] + r["windows"] + SIZE - 1] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                out.append((rid, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["rid", "n_removed", "kept_sha256", "kept_text"]
            )

    return texts.select("rid", "text", "runs").mapInArrow(run, "rid long, n_removed long, kept_sha256 string, kept_text string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, and kept_text where words went (else null)."""
    kind = Windows(SIZE, GRAM, by_word=True)
    every, few = candidates(docs, kind)
    few = materialise(few, "word-candidates")
    runs = repeated_runs(few, kind).groupBy("rid").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    cut = _cut(few.select("rid", "text").join(runs, "rid"))
    later = ~F.col("first") & (F.col("n") >= SIZE)
    return every.join(cut, "rid", "left").select(
        "doc_id",
        F.col("n").alias("n_words"),
        F.when(later, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(later, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(later, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )
