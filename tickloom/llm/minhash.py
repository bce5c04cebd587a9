"""Near-dedup: consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

1. Document frequencies of hashed shingles are counted over all documents, in a table of fixed size.
2. Improved consistent weighted sampling (Ioffe) draws ``BANDS * ROWS`` samples of each text by weight, and
   as many with all weights 1; rows with the same shingles and counts are one class from here on.
3. Classes that share a band are linked to the smallest of the band (a star, never all pairs), and
   every distinct link is verified by the exact weighted Jaccard similarity of the two texts.
4. Verified links give clusters. Where a band still holds several clusters, all of its members meet in
   tiles of bounded size, and any pair of different clusters is verified, so no link is lost to the
   star. Tiles return links that join clusters, at most one per member.

A shingle is five words as they stand (all words of a shorter text), told by a 54-bit hash; texts of up to
``FEW`` shingles are verified by a second hash as well, as there one chance match would be enough. Its weight is TF-IDF with both
parts damped: 1 + ln(count) times 1 to 1.25 by rarity, so that neither one shingle repeated a thousand
times nor the words that a large group of copies shares decide alone. Two texts are near if their
weighted Jaccard similarity is ``THRESHOLD`` or more; or if the plain one is, since what many near copies
share weighs a little less than what each has for itself. Either similarity has bands of its own: a text
and the same text written twice are near by the plain one only.

Defined cases: a null text and one without words link with nothing; texts with equal words (by the SHA-256 of
the words) are one class; a group
is named by its smallest doc_id, nulls last, and of rows with that id one is kept; an empty table gives
an empty result.
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
from tickloom.llm.components import components
from tickloom.llm.tables import keep_rows, materialise, parts, private, row_key, small_batches

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 12, 4
#: Samples of one kind; the first half of a text's samples and bands is by weight, the second is plain.
SAMPLES = BANDS * ROWS
#: Entries of the table of document frequencies, and entries that one row of it holds in a shuffle.
TABLE, BLOCK = 1 << 20, 1 << 14
#: Samples of a kind that two texts of that similarity ``THRESHOLD`` share at least, but for one in a million such pairs.
LEAST = 24
#: Members of one band that meet in one task at a time.
TILE = 256
#: Groups of such meetings for each shuffle partition.
GROUPS = 32
_COLUMNS = 1 << 12
#: Shingles up to which a text carries a second hash of each.
FEW = 8
#: Bits of a shingle's hash: what is left of 64 beside the number of a text among ``_TEXTS``.
_BITS, _TEXTS = np.uint64(54), 1 << 10
_BASES = [int(x) for x in np.random.default_rng(21).integers(1 << 32, 1 << 60, 2)]

_STEPS = 1 << 16


def _gamma() -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2, at ``_STEPS`` midpoints."""
    p = (np.arange(_STEPS) + 0.5) / _STEPS
    x = np.sqrt(2 * p)
    for _ in range(60):
        x = np.maximum(x - (1 - np.exp(-x) * (1 + x) - p) / np.maximum(x * np.exp(-x), 1e-300), 1e-9)
    return x


_R = _gamma().astype(np.float32)
_INVERSE_R = (1 / _R).astype(np.float32)
_LOG_C = np.log(_gamma()).astype(np.float32)
_SEEDS = np.random.default_rng(20).integers(1, 1 << 63, (2 * SAMPLES, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _shingles(data: np.ndarray, bounds: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, own = rolling.words(data, bounds)
    sums = rolling.prefix(rolling.mix(rolling.prime_hashes(data, starts, ends, base)))
    n = np.diff(own)
    many = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    texts = np.repeat(np.arange(len(n)), many)
    first = np.cumsum(many) - many
    at = own[:-1][texts] + np.arange(len(texts)) - first[texts]
    hashes = rolling.span(sums, at, at + np.minimum(SHINGLE, n)[texts])
    keys = (texts.astype(np.uint64) << _BITS) | (hashes >> (np.uint64(64) - _BITS))
    keys, counts = np.unique(keys, return_counts=True)
    cuts = np.append(np.searchsorted(keys, np.arange(len(n), dtype=np.uint64) << _BITS), len(keys))
    return keys & ((np.uint64(1) << _BITS) - np.uint64(1)), counts.astype(np.uint32), cuts


def shingles(data: np.ndarray, bounds: np.ndarray, base: int = _BASES[0]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 54-bit shingle hashes of each text, sorted, their counts, and the bounds of the texts."""
    hashes, counts, cuts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
    for low in range(0, len(bounds) - 1, _TEXTS):
        own = bounds[low : low + _TEXTS + 1]
        h, c, ends = _shingles(data[own[0] : own[-1]], own - own[0], base)
        hashes.append(h)
        counts.append(c)
        cuts.append(ends[1:] + cuts[-1][-1])
    return np.concatenate(hashes), np.concatenate(counts), np.concatenate(cuts)


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """For each entry of the hashed table, the documents with a shingle in it, over all of ``docs`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(TABLE, dtype=np.int64)
        for batch in batches:
            for _, data, bounds in rolling.chunks(batch):
                hashes, _, _ = shingles(data, bounds)
                table += np.bincount((hashes & np.uint64(TABLE - 1)).astype(np.int64), minlength=TABLE)
        blocks = [(i, table[i * BLOCK : (i + 1) * BLOCK].astype("<u4").tobytes()) for i in range(TABLE // BLOCK)] if table.any() else []
        yield pa.RecordBatch.from_arrays([pa.array([b[0] for b in blocks], pa.int32()), pa.array([b[1] for b in blocks], pa.binary())], names=["block", "counts"])

    def total(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sums = np.zeros(BLOCK, dtype=np.int64)
        for x in group["counts"]:
            sums += np.frombuffer(x, "<u4")
        return pd.DataFrame({"block": [key[0]], "counts": [sums.astype("<i8").tobytes()]})

    blocks = docs.select("text").mapInArrow(count, "block int, counts binary").groupBy("block").applyInPandas(total, "block int, counts binary")
    table = np.zeros(TABLE, dtype=np.int64)
    for row in blocks.collect():  # TABLE entries, whatever the size of the data
        table[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["counts"], "<i8")
    return table


def rarity(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """Inverse document frequencies, between 1 (in all documents) and 1.25 (in one)."""
    rare = np.log((documents + 1) / (np.minimum(frequencies, documents) + 1)) / np.log(documents + 1.0)
    return (1 + 0.25 * rare).astype(np.float32)


def weights(hashes: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(counts.astype(np.float32))) * idf[(hashes & np.uint64(TABLE - 1)).astype(np.int64)]


def weighted_samples(hashes: np.ndarray, weight: np.ndarray, cuts: np.ndarray, seeds: np.ndarray = _SEEDS[:SAMPLES]) -> np.ndarray:
    """A consistent weighted sample by each of ``seeds`` for each text that has shingles, as 32-bit names."""
    logs = np.log(weight)
    x = rolling.mix(hashes + np.uint64(1))
    starts, sizes = cuts[:-1], np.diff(cuts)
    out = np.zeros((len(starts), len(seeds)), dtype=np.uint32)
    for k in range(len(seeds)):
        one, two = x * seeds[k, 0], x * seeds[k, 1]
        which = (one >> np.uint64(48)).astype(np.int32)
        shift = (two >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
        step = np.floor(logs * _INVERSE_R[which] + shift)
        value = _LOG_C[((one >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int32)] - _R[which] * (step - shift + 1)
        least = np.minimum.reduceat(value, starts)
        hits = np.flatnonzero(value == np.repeat(least, sizes))
        texts = np.searchsorted(cuts, hits, "right") - 1
        first = hits[np.unique(texts, return_index=True)[1]]
        name = rolling.mix(x[first] + step[first].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[:, k] = (name >> np.uint64(32)).astype(np.uint32)
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Weighted and plain Jaccard similarity of two texts: (sorted hashes, weights) each."""
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = b[0][at] == a[0]
    shared, same = float(np.minimum(a[1][both], b[1][at[both]]).sum(dtype=np.float64)), int(both.sum())
    every = float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - shared
    return shared / every, same / (len(a[0]) + len(b[0]) - same)


def near(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> bool:
    return max(similarity(a, b)) >= THRESHOLD


def _agree(a: tuple[np.ndarray, bytes], b: tuple[np.ndarray, bytes]) -> bool:
    """Whether texts of few shingles share as many of them by the second hash as by the first: (hashes, second hashes) each."""
    if not a[1] or not b[1]:
        return True
    seconds = [np.frombuffer(x[1], "<u8") for x in (a, b)]
    return len(np.intersect1d(*seconds)) == len(np.intersect1d(a[0], b[0]))


def _signed(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """key, doc_id, the class (digest of the words), samples and bands. docs: key, doc_id, text."""
    schema = "key string, doc_id long, class string, samples binary, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in rolling.chunks(batch):
                hashes, counts, cuts = shingles(data, bounds)
                full = np.flatnonzero(np.diff(cuts))
                own = np.append(cuts[full], len(hashes))
                names, samples, bands = ([None] * rows.num_rows for _ in range(3))
                if len(full):
                    plain = weighted_samples(hashes, np.ones(len(hashes), np.float32), own, _SEEDS[SAMPLES:])
                    drawn = np.hstack([weighted_samples(hashes, weights(hashes, counts, idf), own), plain])
                    band = np.zeros((len(full), 2 * BANDS), dtype=np.uint64)
                    for b in range(2 * BANDS):
                        for r in range(ROWS):
                            band[:, b] = rolling.mix(band[:, b] * np.uint64(31) + drawn[:, b * ROWS + r] + np.uint64(b + 1))
                    for i, text in enumerate(full):
                        names[text] = hashlib.sha256(b" ".join(data[bounds[text] : bounds[text + 1]].tobytes().split())).hexdigest()
                        samples[text], bands[text] = drawn[i].tobytes(), band[i].astype(np.int64)
                columns = [rows.column("key"), rows.column("doc_id").cast(pa.int64()), pa.array(names, pa.string())]
                columns += [pa.array(samples, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "doc_id", "class", "samples", "bands"])

    return docs.select("key", "doc_id", "text").mapInArrow(run, schema)


_VECTOR = ("hashes", "counts", "second")


def _vectors(texts: DataFrame) -> DataFrame:
    """node, hashes and counts of the texts to verify, and second hashes of those with few shingles. texts: node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in rolling.chunks(batch):
                hashes, counts, cuts = shingles(data, bounds)
                each = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                blobs = [pa.array([x[s].tobytes() for s in each], pa.binary()) for x in (hashes, counts)]
                second = [b""] * len(each)
                for i in np.flatnonzero(np.diff(cuts) <= FEW):
                    text = data[bounds[i] : bounds[i + 1]]
                    second[i] = shingles(text, np.array([0, len(text)]), _BASES[1])[0].tobytes()
                yield pa.RecordBatch.from_arrays([rows.column("node"), *blobs, pa.array(second, pa.binary())], names=["node", *_VECTOR])

    return texts.select("node", "text").mapInArrow(run, "node long, hashes binary, counts binary, second binary")


def _read(hashes: bytes, counts: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(hashes, "<u8")
    return own, weights(own, np.frombuffer(counts, np.uint32), idf)


def _verified(pairs: DataFrame, idf: np.ndarray) -> DataFrame:
    """The links of ``pairs`` (a, b with their vectors) whose similarity reaches the threshold."""

    def good(p: bytes, q: bytes, x: bytes, r: bytes, s: bytes, y: bytes) -> bool:
        a, b = _read(p, q, idf), _read(r, s, idf)
        return near(a, b) and _agree((a[0], x), (b[0], y))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(f"{side}_{c}").to_pylist() for side in ("a", "b") for c in _VECTOR]
            yield batch.select(["a", "b"]).filter(pa.array([good(*x) for x in zip(*columns, strict=True)], pa.bool_()))

    return pairs.mapInArrow(run, "a long, b long")


class _Sets:
    """Which clusters are known to be one, within a task."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(up, up)
            x = up
        return x

    def join(self, x: int, y: int) -> None:
        self.parent[self.find(x)] = self.find(y)


def _common(hashes: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two texts share, as a product of their 0-1 rows, some columns at a time."""
    rows = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    names, columns = np.unique(np.concatenate(hashes), return_inverse=True)
    common = np.zeros((len(hashes), len(hashes)), dtype=np.float32)
    for low in range(0, len(names), _COLUMNS):
        own = (columns >= low) & (columns < low + _COLUMNS)
        block = np.zeros((len(hashes), min(_COLUMNS, len(names) - low)), dtype=np.float32)
        block[rows[own], columns[own] - low] = 1
        common += block @ block.T
    return common


def _joined(group: pd.DataFrame, idf: np.ndarray) -> list[tuple[int, int]]:
    """Verified links between the clusters of one tile, or of two tiles of a band.

    Plain similarities of all pairs come from one product. Where no shingle repeats, weights lie between 1
    and 1.25, so a pair with a weighted similarity of 0.8 has a plain one of 0.8 / 1.05 at least; only
    pairs between that and 0.8, and those with repeated shingles, are compared by weight.
    """
    drawn = np.array([np.frombuffer(x, np.uint32) for x in group["samples"]])
    clusters, nodes, tiles = (group[c].to_numpy() for c in ("cluster", "node", "tile"))
    hashes = [np.frombuffer(x, "<u8") for x in group["hashes"]]
    seconds = group["second"].to_list()
    counts = [np.frombuffer(x, np.uint32) for x in group["counts"]]
    sizes, once = np.array([len(h) for h in hashes]), np.array([c.max() == 1 for c in counts])
    common, alone = _common(hashes), tiles[0] == tiles[-1]
    sets, links, read = _Sets(), [], {}
    for i in range(len(group) - 1):
        plain = common[i, i + 1 :] / (sizes[i] + sizes[i + 1 :] - common[i, i + 1 :])
        sure = plain >= THRESHOLD
        maybe = ((drawn[i + 1 :] == drawn[i]).sum(axis=1) >= LEAST) & ((plain >= THRESHOLD / 1.05 - 1e-6) | ~(once[i] & once[i + 1 :]))
        apart = (clusters[i + 1 :] != clusters[i]) & (alone | (tiles[i + 1 :] != tiles[i]))
        for j in i + 1 + np.concatenate([np.flatnonzero(sure & apart), np.flatnonzero(maybe & ~sure & apart)]):
            if sets.find(clusters[i]) == sets.find(clusters[j]):
                continue
            if not sure[j - i - 1]:
                for k in (i, j):
                    if k not in read:
                        read[k] = hashes[k], weights(hashes[k], counts[k], idf)
                if not near(read[i], read[j]):
                    continue
            if not _agree((hashes[i], seconds[i]), (hashes[j], seconds[j])):
                continue
            sets.join(clusters[i], clusters[j])
            links.append((nodes[i], nodes[j]))
    return links


def _across(members: DataFrame, idf: np.ndarray) -> DataFrame:
    """Verified links between clusters that share a band. members: band, tile, tiles, node, cluster, samples by weight, hashes, counts, second.

    A unit of work is a tile or a pair of tiles; units are dealt by hash, some to each group.
    """
    unit = ["band", "low_tile", "high_tile"]

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([*unit, "tile", "node"], ignore_index=True)
        keys = group[unit].to_numpy()
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(group)]
        links = [x for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b - a > 1 for x in _joined(group.iloc[a:b], idf)]
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    pairs = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pairs = pairs.withColumns({"low_tile": F.least("tile", "other"), "high_tile": F.greatest("tile", "other")})
    dealt = pairs.withColumn("group", F.pmod(F.xxhash64(*unit), F.lit(GROUPS * parts(members.sparkSession))))
    return dealt.groupBy("group").applyInPandas(meet, "a long, b long")


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per document: key (see ``row_key``), doc_id, class_id, n_links, kept."""
    rows = private(small_batches(docs), key=row_key(docs["doc_id"], docs["text"]), doc_id="doc_id", text="text")
    idf = rarity(document_frequencies(rows), max(rows.count(), 1))
    signed = materialise(_signed(rows, idf).withColumn("rid", F.monotonically_increasing_id()), "signed")
    classes = signed.filter("class is not null").groupBy("class").agg(
        F.min(F.struct("rid", "key", "samples", "bands")).alias("x"), F.min("doc_id").alias("doc_id")
    )
    classes = materialise(classes.select("class", F.col("x.rid").alias("node"), "x.key", "x.samples", "x.bands", "doc_id"), "shingle-classes")
    banded = classes.select("node", F.explode("bands").alias("band"))
    stars = banded.groupBy("band").agg(F.min("node").alias("b"), F.count("*").alias("n")).filter("n > 1")
    stars = materialise(stars, "bands")
    members = materialise(banded.join(stars, "band").select("band", "n", F.col("node").alias("a"), "b"), "band-members")
    # Texts are shuffled once, for those classes that share a band.
    wanted = members.select(F.col("a").alias("node")).distinct().join(classes.select("node", "key"), "node")
    texts = rows.join(wanted, "key").select("node", "text")
    vectors = materialise(_vectors(texts).dropDuplicates(["node"]), "shingle-vectors")

    samples = classes.select("node", "samples")
    pairs = members.filter("a <> b").select("a", "b").distinct()
    for side in ("a", "b"):
        pairs = pairs.join(samples.select(F.col("node").alias(side), F.col("samples").alias(f"{side}_samples")), side)
    weighted, plain = (
        F.expr(f"aggregate(sequence({i}, {i + 4 * SAMPLES - 4}, 4), 0, (s, i) -> s + if(substring(a_samples, i, 4) = substring(b_samples, i, 4), 1, 0))")
        for i in (1, 4 * SAMPLES + 1)
    )
    pairs = materialise(pairs.filter((weighted >= LEAST) | (plain >= LEAST)).select("a", "b"), "near-pairs")
    for side in ("a", "b"):
        pairs = pairs.join(vectors.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in _VECTOR]), side)
    links = materialise(_verified(pairs, idf), "verified")

    clusters = materialise(components(links).withColumnRenamed("component", "cluster"), "clusters")
    placed = members.withColumnRenamed("a", "node").join(clusters, "node", "left").withColumn("cluster", F.coalesce("cluster", "node"))
    placed = materialise(placed.select("band", "n", "node", "cluster"), "placed")
    mixed = placed.groupBy("band").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high")).filter("low <> high").select("band")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    open_members = placed.join(materialise(mixed, "mixed-bands"), "band").withColumn("tiles", tiles)
    open_members = open_members.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    open_members = open_members.join(samples.withColumn("samples", F.expr(f"substring(samples, 1, {4 * SAMPLES})")), "node").join(vectors, "node")
    across = materialise(_across(open_members.drop("n"), idf), "across")

    every = materialise(components(links.union(across)), "near-components")
    degree = links.union(across).selectExpr("stack(2, a, b) as node").groupBy("node").agg(F.count("*").alias("n_links"))
    groups = classes.select("class", "node", "doc_id").join(every, "node", "left").join(degree, "node", "left").withColumn("component", F.coalesce("component", "node"))
    groups = materialise(groups, "near-classes")
    first = signed.filter("class is not null").join(groups.select("class", "component"), "class")
    first = first.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first"))
    groups = materialise(groups.join(first, "component").select("class", "component", "first", "n_links"), "near-classes")
    own = F.col("first").isNull()
    return signed.join(groups, "class", "left").select(
        "key",
        "doc_id",
        F.when(own, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        (own | (F.col("first.rid") == F.col("rid"))).alias("kept"),
    )


def near_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, with all their columns."""
    return keep_rows(docs, near_groups(docs).filter("kept").select("key"), row_key(docs["doc_id"], docs["text"]))
