"""Embedding near-dedup: int8 tile products with error bounds, full precision only where they can't tell.

Equal vectors are one row with a count first. Rows of a label are dealt over tiles by hash, and each
pair of tiles is one task's unit of work, so a label of any size spreads. In it the product of the
int8 vectors (exact whole numbers) is known to be off by at most
``|sq(x)| e(y) + |sq(y)| e(x) + e(x) e(y)``, where e is a vector's own quantisation error; only pairs
whose bounds straddle the threshold are computed again in double precision. A unit returns, for each
linked vector, its number of links and one lower vector it hangs together with: never pairs.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite values, and one without
label or id, links with nothing; vectors of different length don't link; rows that repeat an id are
one node of a component, and each counts as a link of the other; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.components import components
from tickloom.llm.tables import materialise, private

THRESHOLD = 0.93
#: Vectors in a tile.
TILE = 1024
_KEYS = ["label", "width", "low_tile", "high_tile"]
_TILE = "label string, width int, tile int, tiles int, n int, ids binary, counts binary, vectors binary, codes binary, scales binary, errors binary"


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, scale of each row, and the length of what a row lost."""
    scales = np.abs(units).max(axis=1) / 127
    codes = np.rint(units / scales[:, None]).astype(np.int8)
    lost = units - codes * scales[:, None]
    return codes, scales, np.sqrt(np.einsum("ij,ij->i", lost, lost)) * (1 + 1e-9) + 1e-12


def linked(left: tuple, right: tuple, threshold: float) -> np.ndarray:
    """Which rows of ``left`` and ``right`` (units, codes, scales, errors) have a cosine of ``threshold`` or more."""
    (x, a, s, e), (y, b, t, f) = left, right
    # Products of int8 codes stay below 2**24 for up to 1040 dimensions: exact in single precision.
    kind = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    near = (a.astype(kind) @ b.astype(kind).T) * s[:, None] * t
    size_a, size_b = 1 + e, 1 + f  # |code * scale| is at most the unit length and what was lost
    bound = np.outer(size_a, f) + np.outer(e, size_b) + np.outer(e, f) + 1e-9
    sure = near - bound >= threshold
    i, j = np.nonzero((near + bound >= threshold) & ~sure)
    for at in range(0, len(i), 1 << 16):
        own = slice(at, at + (1 << 16))
        sure[i[own], j[own]] = np.einsum("ij,ij->i", x[i[own]], y[j[own]]) >= threshold
    return sure


def lowest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each side, the smallest id that its rows hang together with through ``links``."""
    far = np.iinfo(np.int64).max
    while True:
        over = np.minimum(right, np.where(links, left[:, None], far).min(axis=0, initial=far))
        back = np.minimum(left, np.where(links, over, far).min(axis=1, initial=far))
        if (over == right).all() and (back == left).all():
            return left, right
        left, right = back, over


def _packed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("id")
    units = unit(np.array(group["vector"].tolist(), dtype=np.float64))
    codes, scales, errors = quantise(units)
    blobs = (group["id"].to_numpy(np.int64), group["count"].to_numpy(np.int64), units, codes, scales, errors)
    row = [*key, int(group["tiles"].iloc[0]), len(group), *[x.tobytes() for x in blobs]]
    return pd.DataFrame([row], columns=[x.split()[0] for x in _TILE.split(", ")])


def _sides(row) -> tuple[np.ndarray, np.ndarray, tuple]:
    read = lambda x, kind: np.frombuffer(x, kind)
    shape = (row.n, row.width)
    vectors = (read(row.vectors, np.float64).reshape(shape), read(row.codes, np.int8).reshape(shape), read(row.scales, np.float64), read(row.errors, np.float64))
    return read(row.ids, np.int64), read(row.counts, np.int64), vectors


def near_vectors(table: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept. table: vec_id, embedding, label."""

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sides = [_sides(row) for row in group.sort_values("tile").itertuples()]
        (ids, counts, left), (others, more, right) = sides[0], sides[-1]
        links = linked(left, right, threshold)
        if len(sides) == 1:
            np.fill_diagonal(links, False)
        low, high = lowest(links, ids, others)
        found = [pd.DataFrame({"id": ids, "links": links @ more, "low": low})]
        if len(sides) == 2:
            found.append(pd.DataFrame({"id": others, "links": counts @ links, "low": high}))
        found = pd.concat(found)
        return found[found["links"] > 0]

    value = F.col("embedding")
    usable = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)
    rows = private(table, vec_id="vec_id", embedding="embedding", label=table["label"].cast("string"))
    usable = F.coalesce(usable & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    key = F.concat_ws(":", F.size("embedding"), F.xxhash64("embedding"), F.xxhash64(F.lit(7), "embedding"), "label")
    rows = materialise(rows.withColumn("key", F.when(usable, key)), "vectors")
    classes = rows.filter("key is not null").groupBy("key").agg(
        F.first("label").alias("label"), F.min("vec_id").alias("id"), F.count("*").alias("count"), F.first("embedding").alias("vector")
    )
    classes = materialise(classes.withColumn("width", F.size("vector")), "vector-classes")
    sizes = materialise(classes.groupBy("label", "width").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")), "tiles")
    dealt = classes.join(sizes, ["label", "width"]).withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
    tiles = dealt.select("label", "width", "tile", "tiles", "id", "count", "vector").groupBy("label", "width", "tile").applyInPandas(_packed, _TILE)
    tiles = materialise(tiles, "packed-tiles")
    units = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    units = units.withColumns({"low_tile": F.least("tile", "other"), "high_tile": F.greatest("tile", "other")})
    found = units.groupBy(*_KEYS).applyInPandas(compare, "id long, links long, low long")
    found = materialise(found, "vector-links")
    groups = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    states = (
        classes.select("key", "id", "count")
        .join(links, "id", "left")
        .join(groups.withColumnRenamed("node", "id"), "id", "left")
        .select("key", (F.col("count") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("component"))
    )
    states = materialise(states, "vector-states")
    return rows.join(states, "key", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(False)).alias("kept"),
    )
