"""Periodic runs: stretches of words that repeat a block of ``q`` words at least four times.

Periods are taken by octave, [B, 2B). For each octave a text is cut into overlapping tiles, and a tile is
solved on its own. It has a boundary every 2B words; any run of that octave holds one that matches the
word one period on. The Z-function of the words from the boundary on, and that of the words before it read
backwards, say for every period of the octave how far the match goes either way, up to 2B words: a fragment
of a run, by the places i with ``word[i] = word[i + q]``. They also tell blocks that are themselves repeats of
a shorter one, which are left out: with four repeats, that leaves the smallest period. Fragments of
neighbouring boundaries touch; those of one tile are joined there, and all of a (document, period) are
shuffled together and stitched to whole runs. Work is in proportion to words times octaves, whatever the texts.

Short texts are tiled and solved where they lie, many in one array. Texts over ``LONG`` words are dealt out
by tile, so that no task holds the work of a long one.

Defined cases: a null text has no words; a text of repeats only keeps its first block; repeated rows are
rows of their own; ids may be null or repeat; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import rolling
from tickloom.llm.tables import materialise, parts, private, small_batches

#: A run has at least this many words, and this many times its period.
WORDS, TIMES = 6, 4
#: Words from which on a text's tiles are dealt out, and words between the first boundaries of tiles.
LONG, TILE = 1_000_000, 1 << 16
#: Places that are compared before a boundary's Z-functions are made.
_FIRST = 8

#: What to make of a document's words, by its id: as they are, or for instance with repeats planted.
Change = Callable[[int | None, list[bytes]], list[bytes]]


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items from there on equal those from the start on."""
    n = len(s)
    z = [0] * n
    z[0] = n
    low = high = 0
    for i in range(1, n):
        k = min(high - i, z[i - low]) if i < high else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > high:
            low, high = i, i + k
    return z


def _primes(octave: int) -> list[list[int]]:
    """Prime factors of each period of an octave."""
    own: list[list[int]] = [[] for _ in range(octave)]
    left = np.arange(octave, 2 * octave)
    r = 2
    while r * r < 2 * octave:
        hits = np.flatnonzero(left % r == 0)
        for i in hits:
            own[i].append(r)
        while len(hits):
            left[hits] //= r
            hits = hits[left[hits] % r == 0]
        r += 1
    for i in np.flatnonzero(left > 1):
        own[i].append(int(left[i]))
    return own


def _candidates(codes: np.ndarray, octave: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(boundary, period) pairs whose match may hold for ``octave`` places on one side."""
    step, n = 2 * octave, len(codes)
    count = -(-(last - first) // step)
    edge = step + _FIRST
    # Codes are at least 0, so padding equals nothing, not even other padding.
    own = np.concatenate([-2 - np.arange(edge), codes, -2 - edge - np.arange(2 * step + _FIRST)])
    rows = own[edge + first : edge + first + count * step]
    if len(rows) < count * step:
        rows = np.concatenate([rows, np.full(count * step - len(rows), -1)])
    rows = rows.reshape(count, step)
    row, column = np.nonzero(rows[:, octave:] == rows[:, :1])
    at, period = first + row * step, column + octave
    keep = at + period < n
    at, period = at[keep], period[keep]
    ahead, behind = np.ones(len(at), bool), np.ones(len(at), bool)
    for t in range(1, min(octave, _FIRST)):
        ahead &= own[edge + at + t] == own[edge + at + period + t]
    for t in range(1, min(octave, _FIRST) + 1):
        behind &= own[edge + at - t] == own[edge + at + period - t]
    keep = ahead | behind
    return at[keep], period[keep]


def _at_boundary(codes: np.ndarray, octave: int, at: int, periods: np.ndarray, primes: list[list[int]]) -> Iterator[tuple[int, int, int]]:
    """Fragments (period, first place, place behind the last) that hold a boundary."""
    reach = 2 * octave
    low, high = max(0, at - reach), min(len(codes), at + 2 * reach)
    ahead = z_function(codes[at:high].tolist())
    near = min(len(codes), at + reach)
    before = codes[low:at][::-1].tolist()
    behind = z_function([*before, -1, *codes[low:near][::-1].tolist()])
    for q in periods.tolist():
        if any(ahead[q // r] >= q - q // r for r in primes[q - octave]):
            continue
        on = min(ahead[q], reach)
        back = behind[len(before) + 1 + near - at - q] if before and at + q < near else 0
        if at + q == near and before:  # the match behind ends at the last word looked at
            back = behind[len(before) + 1]
        whole = on < reach and back < reach
        if on + back >= (max(WORDS, TIMES * q) - q if whole else reach):
            yield q, at - back, at + on


def joined(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Fragments of one period that touch, as one."""
    out: list[tuple[int, int, int]] = []
    for q, a, b in sorted(found):
        if out and out[-1][0] == q and a <= out[-1][2]:
            out[-1] = (q, out[-1][1], max(b, out[-1][2]))
        else:
            out.append((q, a, b))
    return out


def fragments(codes: np.ndarray, octave: int, first: int, last: int) -> list[tuple[int, int, int]]:
    """Fragments of one tile: (period, first place, place behind the last). Its boundaries are ``first``, ... below ``last``."""
    at, period = _candidates(codes, octave, first, last)
    if len(at) == 0:
        return []
    primes, found = _primes(octave), []
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    for a, b in zip(starts, np.append(starts[1:], len(at)), strict=True):
        found += _at_boundary(codes, octave, int(at[a]), period[a:b], primes)
    return joined(found)


def octaves(n: int) -> list[int]:
    """The octaves whose runs fit into n words."""
    out = []
    while n >= max(WORDS, TIMES << len(out)):
        out.append(1 << len(out))
    return out


def tiles(n: int, octave: int) -> Iterator[tuple[int, int, int, int]]:
    """Tiles of n words: the first word and the one behind the last, the first boundary and the end of boundaries."""
    step = max(TILE, 8 * octave) // (2 * octave) * 2 * octave
    for first in range(0, n, step):
        last = min(n, first + step)
        yield max(0, first - 2 * octave), min(n, last + 4 * octave), first, last


def _numbered(words: list[bytes], numbers: dict[bytes, int]) -> list[int]:
    return [numbers.setdefault(w, len(numbers)) for w in words]


def _short(texts: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    """Fragments of each of some short texts. They lie one behind the other, with a word of its own between any two."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts])
    codes = [np.array(t, dtype=np.int64) for t in texts]
    highest = max((int(c.max()) for c in codes if len(c)), default=0)
    for octave in octaves(int(sizes.max(initial=0))):
        fit = np.flatnonzero(sizes >= max(WORDS, TIMES * octave))
        offsets = np.concatenate([[0], np.cumsum(sizes[fit] + 1)])
        row = np.concatenate([x for i, k in enumerate(fit) for x in (codes[k], [highest + 1 + i])])
        for q, a, b in fragments(row, octave, 0, len(row)):
            own = int(np.searchsorted(offsets, a, "right")) - 1
            out[fit[own]].append((q, a - int(offsets[own]), b - int(offsets[own])))
    return out


_FOUND = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))


def _described(docs: DataFrame, change: Change | None) -> DataFrame:
    """doc_id, n_words, words_sha256, found (fragments; null for a long text), and words, if there are fragments or the text is long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in rolling.chunks(batch):
                ids = rows.column("doc_id").cast(pa.int64()).to_pylist()
                texts = [data[a:b].tobytes().split() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                if change is not None:
                    texts = [change(i, t) for i, t in zip(ids, texts, strict=True)]
                numbers: dict[bytes, int] = {}
                found = _short([_numbered(t, numbers) if len(t) <= LONG else [] for t in texts])
                whole = [b" ".join(t) for t in texts]
                far = [len(t) > LONG for t in texts]
                columns = [
                    pa.array(ids, pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(w).hexdigest() for w in whole], pa.string()),
                    pa.array([None if long else [dict(zip(("period", "start", "stop"), x, strict=True)) for x in f] for f, long in zip(found, far, strict=True)], _FOUND),
                    pa.array([w if f or long else None for w, f, long in zip(whole, found, far, strict=True)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "words_sha256", "found", "words"])

    schema = "doc_id long, n_words long, words_sha256 string, found array<struct<period long, start long, stop long>>, words binary"
    return private(small_batches(docs), doc_id="doc_id", text="text").mapInArrow(run, schema)


def _dealt(long: DataFrame) -> DataFrame:
    """rid, period, start, stop: fragments of long texts (rid, words), tile by tile."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("words").to_pylist(), strict=True):
                numbers: dict[bytes, int] = {}
                codes = np.array(_numbered(text.split(), numbers), dtype="<i8")
                for octave in octaves(len(codes)):
                    for low, high, first, last in tiles(len(codes), octave):
                        row = [rid, octave, low, first, last, codes[low:high].tobytes()]
                        kinds = [pa.int64()] * 5 + [pa.binary()]
                        arrays = [pa.array([x], k) for x, k in zip(row, kinds, strict=True)]
                        yield pa.RecordBatch.from_arrays(arrays, names=["rid", "octave", "low", "first", "last", "codes"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                low = row["low"]
                found = fragments(np.frombuffer(row["codes"], "<i8"), row["octave"], row["first"] - low, row["last"] - low)
                out += [(row["rid"], q, a + low, b + low) for q, a, b in found]
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["rid", "period", "start", "stop"])

    cuts = long.mapInArrow(cut, "rid long, octave long, low long, first long, last long, codes binary")
    cuts = cuts.repartition(parts(long.sparkSession), "rid", "octave", "low")
    return cuts.mapInArrow(solve, "rid long, period long, start long, stop long")


def stitched(found: DataFrame) -> DataFrame:
    """rid, start, length, period: whole runs from fragments (rid, period, start, stop)."""
    order = Window.partitionBy("rid", "period").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = found.withColumn("_new", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    apart = apart.withColumn("_run", F.sum("_new").over(order))
    runs = apart.groupBy("rid", "period", "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    runs = runs.select("rid", "start", (F.col("stop") - F.col("start") + F.col("period")).alias("length"), "period")
    return runs.filter(F.col("length") >= F.greatest(F.lit(WORDS), TIMES * F.col("period")))


_CUT = "doc_id long, n_words long, runs array<struct<start long, length long, period long>>, kept_sha256 string, kept_text string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs, digests, kept = [], [], []
        for row in batch.select(["n_words", "words_sha256", "words", "runs"]).to_pylist():
            own = sorted(row["runs"] or [], key=lambda r: (r["start"], r["period"]))
            runs.append(own)
            if not own:
                digests.append(row["words_sha256"])
                kept.append(None)
                continue
            edge = np.zeros(row["n_words"] + 1, dtype=np.int64)
            for r in own:
                edge[r["start"] + r["period"]] += 1
                edge[r["start"] + r["length"]] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            left = b" ".join([w for w, g in zip(row["words"].split(b" "), gone.tolist(), strict=True) if not g])
            digests.append(hashlib.sha256(left).hexdigest())
            kept.append(left.decode())
        columns = [batch.column("doc_id"), batch.column("n_words"), pa.array(runs, _RUNS), pa.array(digests, pa.string()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "kept_sha256", "kept_text"])


def collapse_runs(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start, then period), kept_sha256
    (words but for the repeats, joined by a space), and kept_text where words went (else null)."""
    rows = materialise(_described(docs, change).withColumn("rid", F.monotonically_increasing_id()), "run-fragments")
    near = rows.filter("size(found) > 0").select("rid", F.explode("found").alias("f")).select("rid", "f.*")
    long = rows.filter("found is null").select("rid", "words")
    found = near if long.isEmpty() else near.unionByName(_dealt(long))
    runs = stitched(found).groupBy("rid").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    return rows.join(runs, "rid", "left").select("doc_id", "n_words", "words_sha256", "words", "runs").mapInArrow(_collapsed, _CUT)
