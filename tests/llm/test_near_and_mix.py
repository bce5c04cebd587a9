import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tests.llm.frames import awkward, docs, prose, rows_of, words
from tickloom.llm import embedding_dedup, minhash, mixing, packing, topics
from tickloom.llm.components import components


def brute_components(nodes, links):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(1, 200)] + [(7, 7)]
    want = brute_components({n for x in links for n in x}, links)
    got = {row.node: row.component for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: c for n, c in want.items() if n != c}


# Embeddings


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, key string")


def brute_vectors(rows, threshold=0.93):
    good = {}
    for i, (vec_id, e, label, _) in enumerate(rows):
        if vec_id is not None and label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e):
            x = np.array(e, np.float32).astype(np.float64)
            good[i] = x / np.linalg.norm(x)
    links = [(i, j) for i in good for j in good if i != j and rows[i][2] == rows[j][2] and len(good[i]) == len(good[j]) and good[i] @ good[j] >= threshold]
    low = brute_components([r[0] for r in rows], [(rows[i][0], rows[j][0]) for i, j in links])
    n = Counter(i for i, _ in links)
    return sorted(str((r[0], n[i], low[r[0]], r[0] is not None and r[0] == low[r[0]])) for i, r in enumerate(rows))


def cloud(seed, n, labels=3, width=16, noise=0.25):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, width))
    return [(i, [float(x) for x in np.float32(centres[i % 12] + noise * r.normal(size=width))], int(i % labels), "own") for i in range(n)]


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 32)
    rows = cloud(1, 300)
    rows += [(1000 + i, rows[5][1], rows[5][2], "copy") for i in range(80)]
    rows += [(2000, None, 1, ""), (2001, [], 1, ""), (2002, [0.0] * 16, 1, ""), (2003, [float("nan")] * 16, 1, ""), (2004, [None] + [1.0] * 15, 1, "")]
    rows += [(2005, rows[5][1], None, ""), (2006, [float("inf")] * 16, 1, ""), (2007, rows[5][1][:8], rows[5][2], ""), (2008, [x * 1e-30 for x in rows[5][1]], rows[5][2], "")]
    got = embedding_dedup.near_vectors(vectors(spark, rows).repartition(5)).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_vectors(rows)


@given(st.integers(0, 10_000), st.sampled_from([2, 8, 64]), st.floats(0.01, 2))
@settings(max_examples=40, deadline=None)
def test_bounds_are_rigorous(seed, width, noise):
    r = np.random.default_rng(seed)
    centre = r.normal(size=width)
    units = [embedding_dedup.unit(centre + noise * r.normal(size=(40, width)) + 1e-6) for _ in range(2)]
    sides = [(u, *embedding_dedup.quantise(u)) for u in units]
    assert (embedding_dedup.linked(*sides, 0.93) == (units[0] @ units[1].T >= 0.93)).all()


def test_near_vectors_of_nothing(spark):
    assert embedding_dedup.near_vectors(vectors(spark, [])).count() == 0
    got = embedding_dedup.near_vectors(vectors(spark, [(None, [1.0], 1, ""), (1, None, None, "")])).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(["(None, 0, None, False)", "(1, 0, 1, True)"])


# Near copies


def shingle_weights(text, idf):
    hashes, counts, cuts = minhash.shingles(np.frombuffer((text or "").encode(), np.uint8), np.array([0, len((text or "").encode())]))
    return hashes, minhash.weights(hashes, counts, idf)


def edited(seed, base, edits):
    r, w = random.Random(seed), list(base)
    for _ in range(edits):
        w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


def near_rows():
    rows = awkward()
    for group in range(6):
        base = words(500 + group, 300)
        rows += [(1000 * (group + 1) + i, edited(group * 50 + i, base, 2)) for i in range(8)]
        rows += [(1000 * (group + 1) + 100 + i, edited(group * 50 + i, base, 40)) for i in range(3)]
    return rows


@pytest.mark.parametrize("extra", [False, True])
def test_groups_equal_all_pairs(spark, extra):
    rows = near_rows()
    df = docs(spark, rows, extra).repartition(4)
    idf = minhash.rarity(minhash.document_frequencies(df), len(rows))
    weighed = [shingle_weights(t, idf) for _, t in rows]
    ids = list(range(len(rows)))
    links = [(i, j) for i in ids for j in ids if i < j and len(weighed[i][0]) and len(weighed[j][0]) and minhash.near(weighed[i], weighed[j])]
    low = brute_components(ids, links)
    smallest = {}
    for i in ids:
        d = rows[i][0]
        if d is not None:
            smallest[low[i]] = min(d, smallest.get(low[i], d))
    got = minhash.near_groups(df).collect()
    assert sorted(str((r.doc_id, r.class_id)) for r in got) == sorted(str((rows[i][0], smallest.get(low[i]))) for i in ids)
    with_words = [r for r in got if r.class_id not in (5, 6, 7)]
    assert Counter(r.class_id for r in with_words if r.kept) == Counter({r.class_id for r in with_words})
    assert all(r.doc_id == r.class_id for r in got if r.kept)


def test_links_that_the_star_misses(spark, monkeypatch):
    """A chain of near copies, in which a band's smallest member is near to few others."""
    monkeypatch.setattr(minhash, "TILE", 4)
    base = words(77, 400)
    rows, current = [], list(base)
    for i in range(40):
        current = edited(900 + i, current, 6).split()
        rows.append((i, " ".join(current)))
    df = docs(spark, rows).repartition(3)
    got = minhash.near_groups(df).collect()
    idf = minhash.rarity(minhash.document_frequencies(df), len(rows))
    weighed = [shingle_weights(t, idf) for _, t in rows]
    links = [(i, j) for i in range(40) for j in range(i) if minhash.near(weighed[i], weighed[j])]
    low = brute_components(range(40), links)
    assert {r.doc_id: r.class_id for r in got} == low


def test_repeats_within_a_text_are_near(spark):
    """Pairs of high plain and low weighted similarity: a text written k times, and a block repeated in one of two."""
    rows = []
    for k in range(2, 11):
        for i in range(4):
            base, at = prose(5000 + 10 * k + i, 300), 1000 * k + 2 * i
            rows += [(at, base), (at + 1, " ".join([base] * k))]
    for i in range(20):
        base = words(6000 + i, 400)
        rows += [(20_000 + 2 * i, " ".join(base)), (20_001 + 2 * i, " ".join(base[:100] + base[100:160] * 50 + base[160:]))]
    idf = minhash.rarity(minhash.document_frequencies(docs(spark, rows)), len(rows))
    weighed = [shingle_weights(t, idf) for _, t in rows]
    assert all(minhash.similarity(weighed[i], weighed[i + 1])[1] >= minhash.THRESHOLD for i in range(0, len(rows), 2))
    got = {r.doc_id: r.class_id for r in minhash.near_groups(docs(spark, rows).repartition(4)).collect()}
    assert got == {d: d - d % 2 for d, _ in rows}


def test_shingles_of_texts():
    texts = ["a b c d e f a b c d e", "one two", "", "  x  "]
    blobs = [t.encode() for t in texts]
    data, bounds = np.frombuffer(b"".join(blobs), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in blobs])])
    hashes, counts, cuts = minhash.shingles(data, bounds)
    assert np.diff(cuts).tolist() == [6, 1, 0, 1]
    assert counts[: cuts[1]].sum() == 7 and counts.max() == 2
    alone = minhash.shingles(np.frombuffer(blobs[0], np.uint8), np.array([0, len(blobs[0])]))
    assert (alone[0] == hashes[: cuts[1]]).all()


def test_shingles_tell_300000_texts_apart():
    texts = [f"item {i:09x} sold".encode() for i in range(300_000)]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in texts])])
    hashes, counts, cuts = minhash.shingles(data, bounds)
    assert (np.diff(cuts) == 1).all() and (counts == 1).all() and len(np.unique(hashes)) == 300_000


def test_second_hashes_settle_chance_matches():
    one, two = np.array([5, 7], "<u8"), np.array([5, 7, 9], "<u8")
    assert minhash._agree((one, two[:2].tobytes()), (two, two.tobytes()))
    assert not minhash._agree((one, np.array([1, 7], "<u8").tobytes()), (two, two.tobytes()))
    assert minhash._agree((one, b""), (two, two.tobytes()))


def test_texts_of_one_shingle(spark):
    rows = [(i, f"item {i // 2} sold") for i in range(400)] + [(1000, "x x x x x"), (1001, "x x x x x x"), (1002, "x x x x")]
    got = {r.doc_id: r.class_id for r in minhash.near_groups(docs(spark, rows)).collect()}
    assert got == {i: i - i % 2 for i in range(400)} | {1000: 1000, 1001: 1000, 1002: 1002}


def plain_jaccard_groups(rows):
    """Groups by links of plain similarity 0.8 or more, from the words alone."""
    sets = []
    for _, text in rows:
        w = (text or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    return brute_components(range(len(rows)), links)


def test_groups_hold_all_plain_links(spark):
    """A brute force that shares no code with the operator: no link between texts of 0.8 or more is lost, and far ones stay apart."""
    rows = [r for r in near_rows() if r[0] is not None]
    low = plain_jaccard_groups(rows)
    got = [r.class_id for r in sorted(minhash.near_groups(docs(spark, [(i, t) for i, (_, t) in enumerate(rows)])).collect(), key=lambda r: r.doc_id)]
    assert all(got[i] == got[low[i]] for i in range(len(rows)))
    # Without repeated shingles a weighted link has a plain similarity of 0.8 / 1.05 at least.
    loose = []
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if got[i] == got[j]:
                continue
            x, y = (set(zip(*[(t or "").split()[k:] for k in range(5)])) for t in (a, rows[j][1]))
            loose.append(len(x & y) < 0.8 * len(x | y) or not x or not y)
    assert all(loose)


@pytest.mark.parametrize("shared", [0.5, 0.8, 0.95])
def test_samples_agree_as_often_as_sets_are_similar(shared):
    r = np.random.default_rng(3)
    agree, truth = [], []
    for _ in range(60):
        every = np.unique(r.integers(1, 1 << 54, 900, dtype=np.uint64))
        weight = (r.integers(1, 4, len(every)) * r.uniform(1, 2, len(every))).astype(np.float32)
        cut = int(len(every) * (1 - shared) / 2)
        a, b = slice(0, len(every) - cut), slice(cut, len(every))
        drawn = minhash.weighted_samples(np.concatenate([every[a], every[b]]), np.concatenate([weight[a], weight[b]]), np.array([0, len(every[a]), len(every[a]) + len(every[b])]))
        agree.append((drawn[0] == drawn[1]).mean())
        truth.append(minhash.similarity((every[a], weight[a]), (every[b], weight[b]))[0])
    assert abs(np.mean(agree) - np.mean(truth)) < 0.03


def test_near_dedup_keeps_columns(spark):
    df = docs(spark, near_rows(), extra=True)
    kept = minhash.near_dedup(df)
    assert kept.columns == df.columns
    assert minhash.near_dedup(docs(spark, [])).count() == 0


# Mixing


def test_raking_holds_marginals():
    r = np.random.default_rng(0)
    tokens = r.integers(1, 1000, (6, 4, 3)).astype(float)
    targets = tuple(tokens.sum() * 0.05 * x / x.sum() for x in (r.uniform(1, 2, 6), r.uniform(1, 2, 4), r.uniform(1, 2, 3)))
    cells = mixing.rake(tokens, targets)
    for axis, target in enumerate(targets):
        assert np.allclose(cells.sum(axis=tuple(i for i in range(3) if i != axis)), target)
    assert (cells < tokens).all()
    odds = lambda x: x[0, 0, 0] * x[1, 1, 0] / (x[1, 0, 0] * x[0, 1, 0])
    assert np.isclose(odds(cells), odds(tokens))


def shares(found, axis):
    return {level: (asked, reach, got) for a, level, asked, reach, got in found if a == axis}


@pytest.mark.parametrize("seed", range(8))
def test_feasible_targets_are_met_under_full_cells(seed):
    """Targets that a draw with some full cells has are met, cell by cell none above what there is."""
    r = np.random.default_rng(seed)
    tokens = r.integers(0, 1000, (5, 4, 3)) * (r.random((5, 4, 3)) < 0.8)
    chance = np.minimum(1, r.uniform(0, 1.6, tokens.shape))
    drawn = tokens * chance
    names = [[f"{axis}{i}" for i in range(n)] for axis, n in zip("slt", tokens.shape)]
    margins = [dict(zip(names[k], drawn.sum(axis=mixing._others(k)))) for k in range(3)]
    targets = mixing.Targets(*margins, share=float(drawn.sum() / tokens.sum()))
    cells = {(a, b, c): int(tokens[i, j, k]) for i, a in enumerate(names[0]) for j, b in enumerate(names[1]) for k, c in enumerate(names[2]) if tokens[i, j, k]}
    found = mixing.report(cells, targets)
    assert max(abs(asked - got) for _, _, asked, _, got in found) < 1e-6
    chances = mixing.probabilities(cells, targets)
    assert max(chances.values()) == 1 or (chance < 1).all()
    assert sum(chances[c] * n for c, n in cells.items()) == pytest.approx(drawn.sum(), rel=1e-6)


def test_targets_out_of_reach_are_reported():
    cells = {("a", "en", "x"): 1000, ("b", "en", "x"): 10, ("b", "de", "x"): 490}
    targets = mixing.Targets({"a": 1, "b": 1}, {"en": 1, "de": 9}, {"x": 1}, share=0.5)
    found = mixing.report(cells, targets)
    asked, reach, got = shares(found, "lang")["de"]
    assert asked == 0.9 and reach == pytest.approx(490 / 750) and got <= reach + 1e-6
    assert shares(found, "lang")["en"][1] == pytest.approx(260 / 750)
    alone = mixing.Targets({"a": 1, "b": 1}, {"en": 1, "de": 1}, {"x": 1}, share=0.9)
    assert shares(mixing.report(cells, alone), "source")["b"][1] == pytest.approx(500 / 1350)


def brute_mixture(rows, targets, topics):
    """Cells, raking by plain loops over a dict with factors found by halving, and the draw."""
    import hashlib
    import math

    cells, tokens = [], defaultdict(float)
    for (d, t, lang, source, _), topic in zip(rows, topics, strict=True):
        c = tuple(x if x in m else mixing.OTHER for x, m in zip((source, lang, topic), targets.margins()))
        n = max(1, math.ceil(len((t or "").encode()) / 4))
        cells.append((d, c, n))
        tokens[c] += n
    total = sum(tokens.values())

    def factor(weights, most, want):
        if want >= sum(most) * (1 - 1e-15):
            return None
        low, high = 0.0, 1e12
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(n, mid * w) for w, n in zip(weights, most)) < want else (low, mid)
        return high

    wanted = []
    for i, m in enumerate(targets.margins()):
        levels = sorted({c[i] for c in tokens})
        most = [sum(n for c, n in tokens.items() if c[i] == x) for x in levels]
        f = factor([m.get(x, 0.0) for x in levels], most, targets.share * total)
        wanted.append({x: min(n, f * m.get(x, 0.0)) for x, n in zip(levels, most)})
    weight = dict(tokens)
    for _ in range(300):
        for i in range(3):
            for level, want in wanted[i].items():
                own = [c for c in tokens if c[i] == level]
                f = factor([weight[c] for c in own], [tokens[c] for c in own], want)
                for c in own:
                    weight[c] = max(weight[c], tokens[c]) if f is None else weight[c] * f
    out = []
    for d, c, n in cells:
        p = min(1, weight[c] / tokens[c])
        u = int(hashlib.md5(f"{targets.seed}:{d}".encode()).hexdigest()[:12], 16) / (1 << 48)
        out.append((d, n, p, u < p))
    return out


@pytest.mark.parametrize("extra", [False, True])
def test_mixture_equals_brute_force(spark, extra):
    r = random.Random(6)
    kinds = [words(70 + k, 60, 60) for k in range(3)]
    rows = [(i, " ".join(f"{'abc'[i % 3]}{r.choice(kinds[i % 3])}" for _ in range(r.randrange(1, 200))), r.choice(["en", "en", "de", "fr", "xx", None]), r.choice(["web", "web", "web", "book", "zzz", None]), 1) for i in range(600)]
    rows += [(601, None, None, None, None), (602, "", "en", "web", 0)]
    own = topics.learned(docs(spark, rows), 3)
    data = [(t or "").encode() for _, t, *_ in rows]
    named = own.of(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    assert named[600:] == [None, None] and set(named[:600]) == {"topic0", "topic1", "topic2"}
    targets = mixing.Targets({"web": 1, "book": 2, "*": 1}, {"en": 1, "de": 2, "fr": 1, "*": 1}, {"topic0": 1, "topic1": 1, "topic2": 2, "*": 0.001}, share=0.3)
    got = sorted(mixing.mixed(docs(spark, rows, extra), targets, own).collect(), key=lambda x: x.doc_id)
    for have, (d, n, p, kept) in zip(got, brute_mixture(rows, targets, named), strict=True):
        assert (have.doc_id, have.tokens) == (d, n)
        assert have.probability == pytest.approx(p, rel=1e-5, abs=1e-9)
        assert have.kept == kept or abs(have.draw - p) < 1e-5
    sampled = mixing.sample_mixture(docs(spark, rows, extra), targets, own)
    assert sampled.columns == docs(spark, rows, extra).columns
    assert sorted(x.doc_id for x in sampled.collect()) == [x.doc_id for x in got if x.kept]


def test_mixture_of_the_table_meets_its_targets(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    own = mixing.corpus(table)
    targets = own.tempered(power=1.0, share=0.2)  # topics go with languages here: other shares of both may not be met together
    found = mixing.report(own.cells(targets), targets)
    assert max(abs(reach - got) for *_, reach, got in found) < 1e-6
    assert all(abs(asked - got) < 1e-6 for asked, _, got in shares(found, "lang").values())
    assert {r.axis for r in mixing.marginals(table, targets, own.topics).collect()} == {"source", "lang", "topic"}
    rows = mixing.mixed(table, targets, own.topics).collect()
    assert sum(x.tokens * x.probability for x in rows) == pytest.approx(0.2 * sum(x.tokens for x in rows), rel=1e-6)


def test_mixture_of_nothing(spark):
    assert mixing.mixed(docs(spark, [])).count() == 0
    assert mixing.marginals(docs(spark, [])).count() == 0
    assert mixing.sample_mixture(docs(spark, [])).count() == 0
    repeated = mixing.mixed(docs(spark, [(1, "a b", "en", "web", 3)] * 3)).collect()
    assert len({r.kept for r in repeated}) == 1


def test_clusters_of_words():
    r = random.Random(1)
    texts = [" ".join(r.choice(words(90 + k % 4, 40)) + "xyzw"[k % 4] for _ in range(50)).encode() for k in range(80)]
    rows = topics.vectors(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    own = topics.Topics(topics.cluster(rows, 4))
    named = own.of(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    assert len(set(named)) == 4 and len({(k % 4, t) for k, t in enumerate(named)}) == 4
    assert topics.cluster(rows[:2], 4).shape[0] == 2 and topics.Topics(topics.cluster(rows[:0], 4)).of(np.zeros(0, np.uint8), np.zeros(2, np.int64)) == [None]


def test_seeds_do_not_hang_on_the_last_bit():
    r = np.random.default_rng(8)
    rows = r.random((60, topics.BUCKETS), np.float32) * (r.random((60, topics.BUCKETS)) < 0.1)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    other = np.where(rows > 0, np.nextafter(rows, np.float32(1)), rows)
    assert np.abs(topics.cluster(rows, 6) - topics.cluster(other, 6)).max() < 1e-4


def test_sums_of_several_tries():
    r = np.random.default_rng(3)
    rows = r.random((500, topics.BUCKETS), np.float32) * (r.random((500, topics.BUCKETS)) < 0.1)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    tries = [rows[:3], rows[10:13]]
    for centroids, found in zip(tries, topics._sums(rows, tries), strict=True):
        alike = rows @ centroids.T
        for cluster, own in enumerate(found):
            inside = alike.argmax(axis=1) == cluster
            assert own[: topics.BUCKETS].tolist() == [sum(round(float(x) * topics.PARTS) for x in column) for column in rows[inside].T]
            assert own[topics.BUCKETS :].tolist() == [inside.sum(), sum(round(float(x) * topics.PARTS) for x in alike[inside].max(axis=1))]


def test_passes_read_blocks_of_texts(spark, monkeypatch):
    """The table that every seed and round reads has a row for each block, and gives the texts' own vectors back."""
    r, kept = random.Random(5), []
    texts = [" ".join(f"{w} " * r.randrange(1, 4) for w in words(k, 1 + k % 90)) for k in range(300)] + ["one two " + "two " * 400, "x " * 70_000]
    materialise = topics.materialise
    monkeypatch.setattr(topics, "materialise", lambda *a, **options: kept.append(materialise(*a, **options)) or kept[0])
    topics.learned(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1), 2)
    stored = [b for b in kept[0].toArrow().to_batches() if b.num_rows]
    opened = np.vstack([rows for rows, _ in topics._opened(stored)])
    data = [t.encode() for t in texts]
    want = topics.vectors(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    assert len(opened) == len(texts) and kept[0].count() <= len(texts) / topics.BLOCK + 8
    order = lambda rows: rows[np.lexsort(np.round(rows, 4).T)]
    assert np.abs(order(opened) - order(want)).max() < 1e-6


def test_topics_without_the_texts(spark):
    table = spark.createDataFrame([(1, "one two"), (2, None), (None, "three"), (2, "one two")], "doc_id long, text string")
    own = topics.learned(table, 2)
    light = mixing.with_topic(table, own, table["doc_id"])
    assert light.schema["row"].dataType.names == ["doc_id"]
    key = lambda r: (r["row"]["doc_id"] or 0, r["topic"] or "")
    assert sorted(map(key, light.collect())) == sorted(map(key, mixing.with_topic(table, own).collect()))


def test_topics_come_from_all_texts(spark):
    """The one cluster's centre is the mean direction of all different texts, also of very many."""
    r, own = random.Random(2), words(95, 60)
    texts = list({" ".join(r.choice(own) for _ in range(6)) for _ in range(5000)})
    rows = spark.createDataFrame([(t,) for t in [*texts, *texts[:900], "", None]], "text string").repartition(5)
    data = [t.encode() for t in texts]
    all_of_them = np.unique(topics.vectors(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])), axis=0)
    mean = all_of_them.astype(float).sum(axis=0)
    found = topics.learned(rows, 1).centroids
    assert found.shape == (1, topics.BUCKETS) and np.abs(found[0] - mean / np.linalg.norm(mean)).max() < 1e-5
    assert np.array_equal(found, topics.learned(rows.repartition(2), 1).centroids)


# Packing


def check_packing(rows, got, size=packing.SIZE):
    encoder = packing.Encoder()
    want = Counter()
    for d, t in rows:
        ids = [*encoder.exact.encode(t or "", add_special_tokens=False).ids, packing.END]
        first = (len(ids) - 1) % size + 1
        cuts = [0, *range(first, len(ids) + 1, size)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            want[(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), -(-sum(r.length for r in got) // size)


@pytest.mark.parametrize("extra", [False, True])
def test_packing_is_complete_and_gapless(spark, extra):
    rows = awkward() + [(100 + i, prose(i, 5 + 37 * i % 900)) for i in range(120)] + [(300, "<|endoftext|> text"), (301, "日本語 テキスト ́ x")]
    used, least = check_packing(rows, packing.best_fit_packing(docs(spark, rows, extra)).collect())
    assert used <= least * 1.02 + 1


def test_packing_of_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = packing.best_fit_packing(table).collect()
    used, least = check_packing([(r.doc_id, r.text) for r in table.collect()], got)
    assert used <= least + 1


def best_fit_decreasing(lengths, size):
    from bisect import bisect_left, insort

    spaces, bins = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect_left(spaces, n)
        if at < len(spaces):
            left = spaces.pop(at) - n
        else:
            bins, left = bins + 1, size - n
        insort(spaces, left)
    return bins


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=30))
@settings(max_examples=100, deadline=None)
def test_plan_places_every_count_once(histogram):
    slots = packing.plan(histogram, 64)
    ranks, used = defaultdict(list), defaultdict(list)
    for s in slots:
        ranks[s.length] += range(s.first, s.first + s.count)
        for k in range(s.count):
            used[s.sequence + k].append((s.offset, s.length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    plain = best_fit_decreasing([n for n, c in histogram.items() for _ in range(c)], 64)
    assert len(used) <= plain + 1


@given(st.text(st.characters(codec="utf-8"), max_size=200) | st.text("\t\n\r abcüß'sé.,0123", max_size=300))
@settings(max_examples=200, deadline=None)
def test_both_encoders_agree(text):
    encoder = packing.Encoder()
    assert encoder.ids(text).tolist() == encoder.exact.encode(text, add_special_tokens=False).ids


def test_packing_of_nothing(spark):
    assert packing.best_fit_packing(docs(spark, [])).count() == 0


# Pipeline


def test_pipeline_stages(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    now = table
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "/root/testdata/sf0.001")
        assert now.schema.simpleString() == table.schema.simpleString()
        now = spark.createDataFrame(now.collect(), table.schema)
        seen.append(now.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0
    texts = {r.doc_id: r.text for r in table.collect()}
    assert all(texts[r.doc_id] == r.text for r in now.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, now, "").collect()
    check_packing([(r.doc_id, r.text) for r in now.collect()], packed)
    run = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    pieces = lambda rows: sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)
    assert pieces(run.collect()) == pieces(packed)


@pytest.mark.parametrize("extra", [False, True])
def test_pipeline_on_awkward_rows(spark, extra):
    now = docs(spark, awkward(), extra)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, "")
        assert out.columns == now.columns
        now = spark.createDataFrame(out.collect(), now.schema)
    corpus_pipeline.STAGES[-1][1](spark, now, "").collect()
