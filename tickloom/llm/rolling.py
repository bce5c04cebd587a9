"""Vectorised text primitives used inside Arrow tasks: word bounds, rolling hashes, window minima.

All functions work on one bounded chunk of concatenated texts; ``chunks`` cuts Arrow batches into
such chunks without splitting a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once (one text may be longer).
CHUNK_BYTES = 1_000_000
MAX64 = np.uint64(0xFFFFFFFFFFFFFFFF)

# White space is 20 and 09 to 0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = {
    seed: np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for seed in (11, 12)
}
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 2 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def strings(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of at most ``limit`` bytes of text (or one row), with bytes and bounds."""
    if batch.num_rows == 0:
        return
    data, bounds = strings(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at), data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without white space), and word bounds of each text."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    inside = ~SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[bounds] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def prefix(codes: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial over ``codes``; ``span`` reads hashes of stretches from them."""
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * _power(_BASE, len(codes)), out=sums[1:])
    return sums


def span(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of [start, end) stretches, the same wherever the stretch stands."""
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(sums))[starts])


def windows(sums: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all stretches of ``size`` codes."""
    n = len(sums) - size
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((sums[size:] - sums[:n]) * _power(_INVERSE, len(sums))[:n])


# Hashes that tell different strings apart for certain but for a known chance: polynomials modulo the prime 2^61 - 1.
# Two different strings of n bytes have one hash for at most n of the 2^61 - 2 bases.

PRIME = np.uint64((1 << 61) - 1)
_LOW30, _LOW31 = np.uint64((1 << 30) - 1), np.uint64((1 << 31) - 1)
_S1, _S30, _S31, _S61 = (np.uint64(k) for k in (1, 30, 31, 61))
_prime_powers: dict[int, np.ndarray] = {}


def _folded(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> _S61)
    return np.where(x >= PRIME, x - PRIME, x)


def prime_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, for values below it."""
    a1, a0, b1, b0 = a >> _S31, a & _LOW31, b >> _S31, b & _LOW31
    middle = a1 * b0 + a0 * b1
    return _folded(((a1 * b1) << _S1) + (middle >> _S30) + ((middle & _LOW30) << _S31) + a0 * b0)


def prime_powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo the prime."""
    have = _prime_powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, dtype=np.uint64)
        while len(have) < max(n, 1 << 16):
            have = np.concatenate([have, prime_product(have, np.uint64(pow(base, len(have), int(PRIME))))])
        if n <= 8 * CHUNK_BYTES:
            if len(_prime_powers) >= 8:
                _prime_powers.clear()
            _prime_powers[base] = have
    return have[:n]


def prime_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of the stretches [start, end) of bytes, each below the prime, the same wherever the stretch stands."""
    power, codes = prime_powers(base, len(data)), data.astype(np.uint64) + np.uint64(1)
    # Powers are summed in two parts of 30 and 31 bits. Sums may wrap round; those over a stretch must not.
    if (ends - starts).max(initial=0) >= 1 << 25:
        raise ValueError("a stretch is longer than sums can hold")
    out = []
    for part in (power & _LOW30, power >> _S30):
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(codes * part, out=sums[1:])
        out.append(_folded(sums[ends] - sums[starts]))
    low, high = out
    # high * 2^30 modulo the prime: its upper 30 bits come back at the bottom.
    shifted = _folded((high >> _S31) + ((high & _LOW31) << _S30))
    return prime_product(_folded(shifted + low), prime_powers(pow(base, -1, int(PRIME)), len(data) + 1)[starts])


def byte_codes(data: np.ndarray, seed: int = 11) -> np.ndarray:
    return _BYTE_CODES[seed][data]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 11) -> np.ndarray:
    """64-bit hashes of words, to find candidates by: equal for equal words, but long words can be built whose hashes are equal too."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    return mix(span(prefix(byte_codes(data, seed)), starts, ends) + (ends - starts).astype(np.uint64))


def within(bounds: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of the n stretches of ``size`` items lie in one text, by its first item."""
    good = np.zeros(n + 1, dtype=np.int64)
    lo, hi = bounds[:-1], np.maximum(bounds[:-1], bounds[1:] - size + 1)
    has = hi > lo
    np.add.at(good, np.minimum(lo[has], n), 1)
    np.add.at(good, np.minimum(hi[has], n), -1)
    return np.cumsum(good[:n]) > 0


def _sliding(x: np.ndarray, width: int, pick, fill) -> np.ndarray:
    """pick over x[i : i + width] for every i (van Herk and Gil-Werman); short ends see ``fill``."""
    n = len(x)
    size = -(-(n + width) // width) * width
    padded = np.full(size, fill, dtype=x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    behind = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[:n], ahead[width - 1 : width - 1 + n])


def window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i : i + width]) for every i."""
    return _sliding(x, width, np.minimum, MAX64)


def winnow(grams: np.ndarray, valid: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum of each window of ``width`` grams (0 where ``valid`` is false), and the grams that are
    the minimum of some valid window. Equal windows have equal minima, wherever they stand."""
    low = np.where(valid, window_minima(grams, width), np.uint64(0))
    padded = np.concatenate([np.zeros(width - 1, np.uint64), low])
    best = _sliding(padded, width, np.maximum, np.uint64(0))[: len(grams)]
    return low, best == grams


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def cover(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n items a stretch of ``size`` items from one of ``starts`` covers."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n), -1)
    return np.cumsum(edge[:n]) > 0
