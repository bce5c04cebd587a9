import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.frames import awkward, docs, prose, rows_of
from tickloom.llm import periodic_runs, queries, spelling, token_files

FOLDER = "/root/testdata/sf0.001"


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, str(v)) for v in r))


# Periodic runs


def brute_runs(words):
    found = {}
    for q in range(len(words) // 4, 0, -1):
        i, last = 0, len(words) - q
        while i < last:
            j = i
            while j < last and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found[i, j - i + q] = q  # a smaller period of the same stretch comes later
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_collapsed(words):
    runs = brute_runs(words)
    gone = set()
    for s, n, q in runs:
        gone.update(range(s + q, s + n))
    return runs, b" ".join(w for i, w in enumerate(words) if i not in gone)


def brute_query(rows):
    out = []
    for doc_id, text in rows:
        words = queries.with_repeats(doc_id, (text or "").encode().split())
        runs, kept = brute_collapsed(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        exact = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        out.append((doc_id, len(runs), *exact, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    return out


def repetitive(seed, n):
    r, words = random.Random(seed), []
    while len(words) < n:
        block = [f"w{r.randrange(r.choice([1, 2, 3, 80]))}" for _ in range(r.randrange(1, 14))]
        words += block * r.randrange(1, 9)
    return words[: n - r.randrange(3)]


@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=5), st.sampled_from([16, 64]))
@settings(max_examples=60, deadline=None)
def test_tiles_give_all_runs(seeds, tile):
    texts = [repetitive(s, s % 150 + 3) for s in seeds]
    numbers: dict = {}
    codes = [periodic_runs._numbered(t, numbers) for t in texts]

    def whole(found):
        return sorted((a, b - a + q, q) for q, a, b in periodic_runs.joined(found) if b - a + q >= max(6, 4 * q))

    want = [brute_runs(t) for t in texts]
    assert [whole(f) for f in periodic_runs._short(codes)] == want
    before, periodic_runs.TILE = periodic_runs.TILE, tile
    try:
        for row, runs in zip(codes, want, strict=True):
            found, row = [], np.array(row)
            for octave in periodic_runs.octaves(len(row)):
                for low, high, first, last in periodic_runs.tiles(len(row), octave):
                    found += [(q, a + low, b + low) for q, a, b in periodic_runs.fragments(row[low:high], octave, first - low, last - low)]
            assert whole(found) == runs
    finally:
        periodic_runs.TILE = before


def repeats():
    return awkward() + [(50 + i, " ".join(repetitive(i, 200))) for i in range(20)] + [(90, "x " * 3000), (91, "a b a a b " * 400), (92, prose(9, 2000) + " p q r" * 700)]


@pytest.mark.parametrize("extra", [False, True])
@pytest.mark.parametrize("long", [1_000_000, 100])
def test_runs_equal_brute_force(spark, extra, long, monkeypatch):
    monkeypatch.setattr(periodic_runs, "LONG", long)
    monkeypatch.setattr(periodic_runs, "TILE", 64)
    rows = repeats()
    for r in periodic_runs.collapse_runs(docs(spark, rows, extra)).collect():
        texts = [(t or "").encode().split() for d, t in rows if d == r.doc_id]
        want = [brute_collapsed(t) for t in texts]
        kept = None if r.kept_text is None else r.kept_text.encode()
        got = [tuple(x) for x in r.runs]
        assert (got, r.kept_sha256) in [(a, hashlib.sha256(b).hexdigest()) for a, b in want]
        assert (kept is None) == (not got) and (kept is None or kept in [b for _, b in want])


def test_run_query_equals_brute_force(spark, tmp_path):
    rows = repeats() + [(200 + i, prose(i, 120)) for i in range(60)]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(queries.runs(spark, str(tmp_path))) == ordered(brute_query(rows))


def test_run_query_on_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.runs(spark, FOLDER)) == ordered(brute_query(rows))


# Token files


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@given(st.text(alphabet=st.sampled_from(list("abeinorstABE 'sdt019.,!-<|>\n\täßéÉİñ²½ª\xad漢́😀_")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_equal_the_library(exact, text):
    token_files.encoder("word_bpe_49k").clear()
    for t in (text, text + "<|endoftext|>" + text, text.replace(" ", "")):
        assert np.frombuffer(token_files.encoder("word_bpe_49k").packed(t), "<u2").tolist() == exact.encode(t, add_special_tokens=False).ids


def test_words_are_kept_within_bounds(monkeypatch, exact):
    monkeypatch.setattr(token_files, "WORDS", 5)
    own = token_files.Encoder()
    text = " ".join(f"word{i % 9} and the" for i in range(60))
    assert np.frombuffer(own.packed(text), "<u2").tolist() == exact.encode(text, add_special_tokens=False).ids and len(own) <= 5


def test_ids_of_given_documents_and_long_words(spark, exact):
    texts = [r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    for t in texts + ["ab" * 5000, "x" * 399 + " y", "the" * 2000 + " end", "1234567890" * 300]:
        assert np.frombuffer(token_files.encoder("word_bpe_49k").packed(t), "<u2").tolist() == exact.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("extra", [False, True])
def test_tokens_come_back(spark, exact, extra):
    rows = awkward() + [(3, prose(8, 40_000)), (1 << 40, "last"), (-5, "first")] + [(70, f"copy {i % 3}") for i in range(30)]
    table = token_files.token_table(docs(spark, rows, extra).repartition(5))
    got = sorted((r.start, r.n_tokens, r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in table.collect())
    assert [g[0] for g in got] == np.concatenate([[0], np.cumsum([g[1] for g in got])])[:-1].tolist()
    assert [g[2] for g in got] == sorted((d for d, _ in rows), key=lambda d: (d is None, d))
    want = [(d, tuple([*exact.encode(t or "", add_special_tokens=False).ids, 1])) for d, t in rows]
    assert ordered(g[2:] for g in got) == ordered(want) and all(g[1] == len(g[3]) for g in got)


def test_only_wanted_frames_are_read(tmp_path):
    lengths = [0, 5, 100, 1, 250, 3, 64, 64, 7]
    texts = [np.arange(n, dtype="<u4") + 1000 * i for i, n in enumerate(lengths)]
    file = token_files.FileWriter(f"{tmp_path}/x.zst", 2, frame=64)
    for i, t in enumerate(texts):
        file.add(None if i == 3 else i * 10, t)
    file.close()
    with open(f"{tmp_path}/x.zst", "rb") as f:
        data = f.read()
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()  # any reader unpacks it to the ids
    assert np.frombuffer(whole, "<u2").tolist() == np.concatenate(texts).tolist()
    got = token_files.FileReader(f"{tmp_path}/x.zst")
    assert [got.ids(i).tolist() for i in range(9)] == [t.tolist() for t in texts]
    assert got.none.tolist() == [i == 3 for i in range(9)]
    got = token_files.FileReader(f"{tmp_path}/x.zst")
    assert got.wanted({10, 999}).tolist() == [1] and got.wanted({0}).tolist() == [0]
    got.ids(8)
    assert got.n_read == 1
    got.ids(4)  # 250 ids from place 106 on: frames 1 to 5
    assert got.n_read == 6
    for at in (3, len(data) // 3):
        broken = bytearray(data)
        broken[at] ^= 0x55
        with open(f"{tmp_path}/y.zst", "wb") as f:
            f.write(broken)
        with pytest.raises((ValueError, zstandard.ZstdError)):
            bad = token_files.FileReader(f"{tmp_path}/y.zst")
            [bad.ids(i) for i in range(9)]


def test_documents_asked_for_by_id(spark, tmp_path):
    rows = [(i, prose(i, 50)) for i in range(200)]
    token_files.write_tokens(docs(spark, rows), f"{tmp_path}/t")
    some = token_files.read_tokens(spark, f"{tmp_path}/t", [7, 150, 999])
    every = {r.doc_id: tuple(r) for r in token_files.read_tokens(spark, f"{tmp_path}/t").collect()}
    assert sorted(map(tuple, some.collect())) == [every[7], every[150]]


def test_files_of_failed_tasks_are_not_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    token_files.write_tokens(docs(spark, [(1, "a"), (2, "b")]), path)
    stray = token_files.FileWriter(f"{path}/part-00000-00000-stray.tokens.zst", 2)
    stray.add(9, np.array([1, 2], "<u4"))
    stray.close()
    assert sorted(r.doc_id for r in token_files.read_tokens(spark, path).collect()) == [1, 2]


def test_several_files_a_task(spark, tmp_path, exact):
    rows = [(i, prose(i, 30)) for i in range(50)]
    frame = token_files.tokenised(docs(spark, rows), []).coalesce(1).sortWithinPartitions("doc_id").select("doc_id", "ids")
    writer = token_files._Writer(f"{tmp_path}/t", 2, True)
    before, token_files.ROLL_DOCS = token_files.ROLL_DOCS, 7
    try:
        token_files.TaskContext.get, kept = (lambda: type("C", (), {"partitionId": lambda self: 0})()), token_files.TaskContext.get
        writer.commit([writer.write(iter(frame.toArrow().to_batches()))])
    finally:
        token_files.ROLL_DOCS, token_files.TaskContext.get = before, kept
    assert len(token_files.listed(f"{tmp_path}/t")) == 8
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in token_files.read_tokens(spark, f"{tmp_path}/t").collect())
    sizes = [len(exact.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows]
    assert got == [(sum(sizes[:i]), i, sizes[i]) for i in range(50)]


# Spelling variants


def brute_counts(rows, planted):
    counts = Counter()
    letters = [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xFF)]
    for doc_id, text in rows:
        run = ""
        for c in [*(text or ""), " "]:
            if any(a <= ord(c) <= b for a, b in letters):
                run += c.lower() if c.isascii() else c
                continue
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if planted and run and h % planted == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
            run = ""
    return counts


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute_variants(counts):
    words = {w: n for w, n in counts.items() if n >= 5}
    near = defaultdict(set)
    for a, b in combinations(words, 2):
        if one_edit(a, b):
            near[a].add(b)
            near[b].add(a)
    best = {w: min(near[w], key=lambda x: (-words[x], x), default=None) for w in words}
    form = {w: b if b is not None and words[b] >= 5 * words[w] else None for w, b in best.items()}
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


@pytest.mark.parametrize("planted", [None, 7])
@pytest.mark.parametrize("extra", [False, True])
def test_words_are_counted(spark, planted, extra):
    rows = awkward() + [(20, "Straße÷STRASSE×ÀÉ ÀÉÎÕÜß àéîõüß x" * 6), (21, "don't Colour_colour COLOURS1colours")]
    got = {r.word: r.n for r in spelling.word_counts(docs(spark, rows, extra), planted=planted).collect()}
    assert got == brute_counts(rows, planted)


@given(st.dictionaries(st.text(alphabet="abß", min_size=6, max_size=9), st.sampled_from([4, 5, 6, 25, 26, 130]), min_size=0, max_size=60))
@settings(max_examples=6, deadline=None)
def test_variants_equal_brute_force(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.spelling_variants(words)) == ordered(brute_variants(counts))


def test_long_words_that_share_most_letters(spark):
    base = "abcdefgh" * 6
    counts = {base: 3000, base[:-1]: 500, base + "x": 90, "z" + base: 15, base[:20] + base[21:]: 5, base[:20] + "qq" + base[22:]: 7}
    counts |= {"aaaaaa": 5, "aaaaaaa": 26, "aaaaaaaa": 140, "aaaaaab": 9, "baaaaaa": 9}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.spelling_variants(words)) == ordered(brute_variants(counts))


def test_variant_query_equals_brute_force(spark, tmp_path):
    r = random.Random(3)
    usual = ["organise", "harbour", "grüßend", "recieved", "theatre"]
    odd = ["organize", "harbor", "harboure", "grüssend", "received", "theater", "theatree"]
    rows = [(i, " ".join(r.choice(usual + (odd if i % 5 == 0 else [])) for _ in range(40))) for i in range(60)] + awkward()
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(queries.variants(spark, str(tmp_path))) == ordered(brute_variants(brute_counts(rows, 199)))


@pytest.mark.parametrize("query", [queries.runs, queries.tokens, queries.variants])
def test_empty_tables(spark, tmp_path, query):
    docs(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert query(spark, str(tmp_path)).collect() == []
