import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.frames import awkward, docs, prose, rows_of
from tickloom.llm import exact_dedup, rolling, substring_dedup, suffix_dedup
from tickloom.llm.exchange import cuts, distinct

SPACE = b" \t\n\x0b\x0c\r"


def sha(data):
    return hashlib.sha256(data).hexdigest()


def encoded(rows):
    return [(d, (t or "").encode()) for d, t in rows]


def brute_suffixes(rows, size=400):
    every = encoded(rows)
    counts = Counter(t[i : i + size] for _, t in every for i in range(len(t) - size + 1))
    out = []
    for d, t in every:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - size + 1):
            if counts[t[i : i + size]] > 1:
                gone[i : i + size] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((d, len(t), int(gone.sum()), len(rolling.runs(gone)[0]), sha(kept)))
    return out


def brute_windows(rows, size=20):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), {}
    for i in order:
        w = (rows[i][1] or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            if key in seen:
                gone[k : k + size] = [True] * size
            seen.add(key)
        out[i] = (rows[i][0], len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g)))
    return [out[i] for i in range(len(rows))]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("extra", [False, True])
def test_suffix_arrays_equal_brute_force(spark, extra):
    rows = awkward() + [(30, "x" * 1000), (31, "x" * 399), (32, "é" * 300), (33, prose(2, 400)[5:])]
    got = suffix_dedup.without_repeats(docs(spark, rows, extra)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows_of(got) == ordered(brute_suffixes(rows))


def test_small_shards_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_TEXT", 2000)
    rows = awkward()
    got = suffix_dedup.without_repeats(docs(spark, rows).repartition(3)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows_of(got) == ordered(brute_suffixes(rows))


def test_kept_bytes_are_returned(spark):
    rows = awkward()
    for r in suffix_dedup.without_repeats(docs(spark, rows)).collect():
        assert r.kept is None or sha(bytes(r.kept)) == r.kept_sha256


@given(st.lists(st.integers(0, 2), min_size=1, max_size=1500), st.integers(1, 4))
@settings(max_examples=40, deadline=None)
def test_suffix_order_and_prefixes(values, stretches):
    data = np.array(values, np.uint8)
    bounds = np.linspace(0, len(data), stretches + 1).astype(int)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    order, _ = suffix_dedup.suffix_order(data, ends)
    assert sorted(order.tolist()) == list(range(len(data)))
    text = data.tobytes()
    # By blocks of 8 bytes; what is left of a stretch below 8 bytes is a letter of its own above all others.
    blocks = lambda i: [(0, text[k : k + 8]) if k + 8 <= ends[i] else (1, k) for k in range(i, min(ends[i], i + 512), 8)]
    whole = [blocks(i) for i in order.tolist()]
    assert all(a <= b for a, b in zip(whole, whole[1:]))
    if len(order) > 1:
        by = np.argsort(order[1:])
        at, before = order[1:][by], order[:-1][by]
        want = [next((k for k in range(min(ends[x] - x, ends[y] - y)) if text[x + k] != text[y + k]), min(ends[x] - x, ends[y] - y)) for x, y in zip(at, before)]
        got = suffix_dedup.common_prefixes(data, ends, at, before)
        assert [min(a, 500) for a in got] == [min(b, 500) for b in want]


@pytest.mark.parametrize("extra", [False, True])
def test_substrings_equal_brute_force(spark, extra):
    rows = awkward() + [(40, "a b " * 100), (41, "a b " * 50), (42, prose(2, 19)), (43, prose(2, 20))]
    got = substring_dedup.without_repeats(docs(spark, rows, extra)).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows_of(got) == ordered(brute_windows(rows))


def test_split_anchors_give_the_same(spark, monkeypatch):
    """One passage in many contexts: its anchors are dealt over shards, and still only the first place stays."""
    monkeypatch.setattr(substring_dedup, "SPLIT", 3)
    passage = prose(50, 25)
    rows = [(i, f"{prose(100 + i // 2, 15)} {passage} {prose(300 + i // 2, 15)}") for i in range(60)]
    got = substring_dedup.without_repeats(docs(spark, rows).repartition(4)).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows_of(got) == ordered(brute_windows(rows))


@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=40), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_automaton(sequences):
    known, before = substring_dedup.Automaton(), []

    def longest(codes, i, sources):
        for size in range(i + 1, 0, -1):
            want = codes[i + 1 - size : i + 1]
            if any(s[k : k + size] == want for s in sources for k in range(len(s) - size + 1)):
                return size
        return 0

    for codes in sequences:
        assert known.matches(codes) == [longest(codes, i, before) for i in range(len(codes))]
        assert known.add(codes) == [longest(codes, i, [*before, codes[:i]]) for i in range(len(codes))]
        before.append(codes)


@pytest.mark.parametrize("extra", [False, True])
def test_exact_groups(spark, extra):
    rows = awkward()
    got = [tuple(r) for r in exact_dedup.exact_groups(docs(spark, rows, extra)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    norm = [sha(__import__("re").sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()) for _, t in rows]
    sizes = Counter(norm)
    keep = {}
    for (d, _), n in zip(rows, norm):
        if d is not None:
            keep[n] = min(d, keep.get(n, d))
    want = sorted((str(d), str(keep.get(n)), sizes[n], n) for (d, _), n in zip(rows, norm))
    assert sorted((str(d), str(k), s, n) for d, k, s, _, n in got) == want
    assert Counter(n for *_, kept, n in got if kept) == Counter(set(norm))
    assert all(d == k for d, k, _, kept, _ in got if kept)


def test_exact_dedup_keeps_columns(spark):
    df = docs(spark, awkward(), extra=True)
    kept = exact_dedup.exact_dedup(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 7, 8, 9, 11, 12, 13, 14, 15, 16, 18]


def test_byte_verification_tells_equal_fingerprints_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BITS", 8)
    rows = [(i, prose(i, 5)) for i in range(600)] + [(1000, prose(3, 5))]
    got = exact_dedup.exact_groups(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.keep_id) for r in got if r.group_size > 1) == [(3, 3), (1000, 3)]
    assert len(got) == 601


@given(st.lists(st.integers(0, (1 << 44) - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_golomb_round_trip(values):
    values = np.sort(np.array(values, dtype=np.uint64))
    assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(values, 1 << 44)) == values).all()


@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_words_and_hashes(texts):
    blobs = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(blobs), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(b) for b in blobs])])
    starts, ends, own = rolling.words(data, bounds)
    found = [[bytes(data[a:b]) for a, b in zip(starts[i:j], ends[i:j])] for i, j in zip(own[:-1], own[1:])]
    assert found == [b.split() for b in blobs]
    hashes = rolling.word_hashes(data, starts, ends)
    flat = [w for ws in found for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat))


@given(st.lists(st.integers(0, 50), min_size=1, max_size=200), st.integers(1, 20))
@settings(max_examples=60, deadline=None)
def test_window_minima_and_winnowing(values, width):
    x = np.array(values, np.uint64) + np.uint64(1)
    valid = np.arange(len(x)) + width <= len(x)
    low, chosen = rolling.winnow(x, valid, width)
    for i in range(len(x) - width + 1):
        assert low[i] == x[i : i + width].min()
        assert chosen[i : i + width][x[i : i + width] == low[i]].all()
    if not valid.any():
        assert not chosen.any()


def thue_morse(n, one, two):
    """Two different texts whose polynomial hashes modulo 2^64 are equal, whatever the base."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return [one if b else two for b in bits], [two if b else one for b in bits]


def test_hashes_tell_built_texts_apart():
    for n in (2048, 4096):
        a, b = (np.frombuffer("".join(t).encode(), np.uint8) for t in thue_morse(n, "a", "b"))
        ends = np.array([0]), np.array([n])
        assert rolling.span(rolling.prefix(rolling.byte_codes(a)), *ends) == rolling.span(rolling.prefix(rolling.byte_codes(b)), *ends)
        assert rolling.prime_hashes(a, *ends, 12345) != rolling.prime_hashes(b, *ends, 12345)


@given(st.binary(min_size=1, max_size=300), st.integers(2, (1 << 61) - 2))
@settings(max_examples=60, deadline=None)
def test_prime_hashes(data, base):
    prime, values = (1 << 61) - 1, np.frombuffer(data, np.uint8)
    starts = np.arange(len(data))
    ends = np.minimum(starts + 37, len(data))
    want = [sum((c + 1) * pow(base, i, prime) for i, c in enumerate(data[a:b])) % prime for a, b in zip(starts, ends)]
    assert rolling.prime_hashes(values, starts, ends, base).tolist() == want


def test_built_texts_lose_nothing_that_stands_nowhere_else(spark):
    rows = [(i, "".join(t)) for i, t in enumerate(thue_morse(4096, "a", "b"))]
    got = suffix_dedup.without_repeats(docs(spark, rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows_of(got) == ordered(brute_suffixes(rows))
    rows = [(i, " ".join(t)) for i, t in enumerate(thue_morse(4096, "one", "two"))]
    got = substring_dedup.without_repeats(docs(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows_of(got) == ordered(brute_windows(rows))


def test_windows_that_differ_in_one_word(spark):
    same = " ".join(f"w{i}" for i in range(19))
    rows = [(i, f"{same} {i:07x}") for i in range(3000)]
    got = substring_dedup.without_repeats(docs(spark, rows)).select("n_removed").distinct().collect()
    assert [r[0] for r in got] == [0]


def test_distinct_and_cuts():
    keys = np.array([5, 1, 5, 5, 1], np.uint64)
    k, c, which = distinct(keys, np.array([1, 2, 1, 3, 2], np.uint32))
    assert k.tolist() == [1, 5, 5] and c.tolist() == [2, 1, 3] and which.tolist() == [1, 0, 1, 2, 0]
    assert cuts(np.array([0, 1 << 63], np.uint64), 2).tolist() == [0, 1, 2]


def test_empty_tables(spark):
    none = docs(spark, [])
    assert suffix_dedup.without_repeats(none).count() == 0
    assert substring_dedup.without_repeats(none).count() == 0
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.exact_dedup(none).columns == none.columns
