"""Mixing sources to target weights: raked cell weights, then a draw with calibrated probabilities.

Tokens are summed by cell (source, language, topic). Levels that the targets don't name share one
level, so the number of cells is bounded by the targets, never by the data. Cells are raked by iterative
proportional fitting: source, language and topic are scaled in turn until the tokens expected of each level are
the target's. No cell can give more than it has, so each step scales the cells of a level that still have tokens
left until the level's sum holds. Where targets ask for more than there is, those levels give all they have, the
others share the rest in proportion, and ``marginals`` says what was asked, what can be reached and what is reached.

A document is then kept with its cell's probability, expected tokens over present ones, by a hash of its
id, so reruns and retries agree. Topics are clusters of the texts (``topics``). One pass finds the cells, one
aggregation with map-side combination sums them; the draw needs no shuffle.

Defined cases: null source, language or topic count as the level "*", a null text as an empty one of one token;
a target whose level has no tokens is left out and the others are scaled up; repeated rows share a
draw; without rows, nothing is drawn.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import rolling
from tickloom.llm.tables import materialise, private, small_batches
from tickloom.llm.topics import TOPICS, Topics, learned

#: The level of everything that the targets don't name.
OTHER = "*"
AXES = ("source", "lang", "topic")
#: Levels with the most tokens that get a target of their own by default, of each axis.
LEVELS = 32
#: Share of all tokens to draw, and by what power default targets flatten the corpus's own shares.
SHARE, POWER = 0.5, 0.7

Cells = dict[tuple[str, str, str], int]


@dataclass(frozen=True)
class Targets:
    """Wanted shares of tokens by level, on any scale, and the share of all tokens to draw."""

    source: dict[str, float]
    lang: dict[str, float]
    topic: dict[str, float]
    share: float = SHARE
    seed: int = 1

    def margins(self) -> tuple[dict[str, float], ...]:
        return self.source, self.lang, self.topic


def token_weight(text: Column) -> Column:
    """Tokens of a text at four bytes each, one at least."""
    return F.greatest(F.lit(1).cast("long"), F.ceil(F.octet_length(F.coalesce(text, F.lit(""))) / 4))


def _scaled(cells: np.ndarray, most: np.ndarray, amount: float) -> np.ndarray:
    """``cells`` times the one factor for which min(cells, most) has the sum ``amount``; as far as ``most`` goes."""
    there = cells > 0
    if not there.any() or amount <= 0:
        return np.zeros_like(cells)
    own, limit = cells[there], most[there]
    if amount >= limit.sum():
        out = cells.copy()
        out[there] = np.maximum(own, limit)
        return out
    with np.errstate(over="ignore"):  # a cell that targets rule out shrinks to nothing
        ratio = limit / own
    order = np.argsort(ratio)
    full = np.concatenate([[0.0], np.cumsum(limit[order])])
    open_ = own.sum() - np.concatenate([[0.0], np.cumsum(own[order])])
    # With the first k cells full, the others need this factor; the right k is the first whose factor fills no further cell.
    factors = (amount - full[:-1]) / np.maximum(open_[:-1], 1e-300)
    k = int(np.argmax(factors <= ratio[order] * (1 + 1e-15)))
    return cells * factors[k]


def amounts(target: np.ndarray, most: np.ndarray, total: float) -> np.ndarray:
    """Tokens of each level in proportion to ``target`` with this total, none above ``most``."""
    return np.minimum(_scaled(target.astype(float), most, total), most)


def rake(tokens: np.ndarray, wanted: tuple[np.ndarray, ...], rounds: int = 2000, close: float = 1e-9) -> np.ndarray:
    """Expected tokens of each cell, none above ``tokens``, with the marginals ``wanted``; close to the cells' own proportions."""
    cells = tokens.astype(float)
    for _ in range(rounds):
        for axis, sums in enumerate(wanted):
            own, most = np.moveaxis(cells, axis, 0), np.moveaxis(tokens, axis, 0)
            own[...] = np.stack([_scaled(c, m, s) for c, m, s in zip(own, most, sums, strict=True)])
        got = np.minimum(cells, tokens)
        if all(np.abs(got.sum(axis=_others(axis)) - s).max() <= close * max(s.sum(), 1) for axis, s in enumerate(wanted)):
            break
    return np.minimum(cells, tokens)


def _others(axis: int) -> tuple[int, ...]:
    return tuple(i for i in range(len(AXES)) if i != axis)


def _table(cells: Cells) -> tuple[list[list[str]], np.ndarray]:
    levels = [sorted({key[i] for key in cells}) for i in range(len(AXES))]
    tokens = np.zeros([len(x) for x in levels])
    for key, n in cells.items():
        tokens[tuple(own.index(x) for own, x in zip(levels, key, strict=True))] = n
    return levels, tokens


def _planned(cells: Cells, targets: Targets) -> tuple[list[list[str]], np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Levels, tokens, asked shares, tokens of each level that are in reach by themselves, and expected tokens of each cell."""
    levels, tokens = _table(cells)
    asked = [np.array([margin.get(x, 0.0) for x in own]) for margin, own in zip(targets.margins(), levels, strict=True)]
    asked = [a / a.sum() if a.sum() > 0 else np.full(len(a), 1 / len(a)) for a in asked]
    most = [tokens.sum(axis=_others(axis)) for axis in range(len(AXES))]
    total = min([targets.share * tokens.sum(), *(m[a > 0].sum() for a, m in zip(asked, most, strict=True))])
    wanted = [amounts(a, m, total) for a, m in zip(asked, most, strict=True)]
    return levels, tokens, asked, wanted, rake(tokens, tuple(wanted))


def probabilities(cells: Cells, targets: Targets) -> Cells:
    """Chance of a document of each cell."""
    if not cells:
        return {}
    levels, tokens, _, _, expected = _planned(cells, targets)
    chance = np.divide(expected, tokens, out=np.zeros_like(expected), where=tokens > 0)
    return {key: float(chance[tuple(own.index(x) for own, x in zip(levels, key, strict=True))]) for key in cells}


def _level(column: Column, names: dict[str, float]) -> Column:
    return F.when(column.isin(*[n for n in names if n != OTHER]), column).otherwise(F.lit(OTHER))


def with_topic(docs: DataFrame, topics: Topics, *kept: Column) -> DataFrame:
    """``row`` and ``topic``. row: all columns of ``docs``, or only ``kept``, so that tasks need not hand the texts back."""

    apart = bool(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text") if apart else batch.column("row").field("text")
            texts = pa.RecordBatch.from_arrays([batch.column("row"), text], names=["row", "text"])
            for rows, data, bounds in rolling.chunks(texts):
                yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(topics.of(data, bounds), pa.string())], names=["row", "topic"])

    row = F.struct(*(kept or [docs[c] for c in docs.columns])).alias("row")
    rows = small_batches(docs).select(row, *([docs["text"]] if kept else []))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, topic string"
    return rows.mapInArrow(run, schema)


@dataclass(frozen=True)
class Corpus:
    """Documents with their cell, before levels are chosen: doc_id, source, lang, topic, tokens (stored)."""

    rows: DataFrame
    topics: Topics

    def tempered(self, power: float = POWER, share: float = SHARE, levels: int = LEVELS) -> Targets:
        """Targets that flatten the corpus: each level's share of tokens to this power. The ``levels`` largest of an axis have one of their
        own, the others one together."""
        margins = []
        for axis in AXES:
            sums = self.rows.filter(F.col(axis).isNotNull()).groupBy(axis).agg(F.sum("tokens").alias("n"))
            top = sums.orderBy(F.desc("n"), axis).limit(levels).collect()
            total = self.rows.agg(F.sum("tokens")).first()[0] or 0
            own = {r[0]: float(r["n"]) for r in top}
            rest = total - sum(own.values())
            margins.append({k: v**power for k, v in own.items()} | ({OTHER: rest**power} if rest > 0 else {}))
        return Targets(*margins, share=share)

    def cells(self, targets: Targets) -> Cells:
        """Tokens by cell; there are at most as many as the product of the targets' levels."""
        keys = [_level(F.col(axis), margin).alias(axis) for axis, margin in zip(AXES, targets.margins(), strict=True)]
        return {(r[0], r[1], r[2]): r["n"] for r in self.rows.groupBy(*keys).agg(F.sum("tokens").alias("n")).collect()}


def corpus(docs: DataFrame, topics: Topics | None = None) -> Corpus:
    """The cells' rows of ``docs``, in one pass over the texts."""
    if topics is None:
        topics = learned(private(docs, text="text"), TOPICS)
    own = private(docs, doc_id="doc_id", source="source", lang="lang", text="text")
    placed = with_topic(own, topics, own["doc_id"], own["source"], own["lang"], token_weight(own["text"]).alias("tokens"))
    rows = placed.select("row.doc_id", "row.source", "row.lang", "topic", "row.tokens")
    return Corpus(materialise(rows, "mixing-rows"), topics)


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from a document's id."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") / float(1 << 48)


def _drawn(rows: DataFrame, chances: Cells, targets: Targets) -> DataFrame:
    """``rows`` (doc_id, source, lang, topic, ...) with their levels, probability, draw, kept."""
    levels = [f"{axis}_level" for axis in AXES]
    rows = rows.withColumns({name: _level(F.col(axis), margin) for name, axis, margin in zip(levels, AXES, targets.margins(), strict=True)})
    table = rows.sparkSession.createDataFrame([(*key, p) for key, p in sorted(chances.items())], ", ".join(f"{x} string" for x in levels) + ", probability double")
    # The table has a row for each cell: at most the product of the targets' levels.
    rows = rows.join(F.broadcast(table), levels, "left").withColumn("probability", F.coalesce("probability", F.lit(0.0)))
    return rows.withColumn("draw", draw(F.col("doc_id"), targets.seed)).withColumn("kept", F.col("draw") < F.col("probability"))


def mixed(docs: DataFrame, targets: Targets | None = None, topics: Topics | None = None) -> DataFrame:
    """One row per document: its cell, tokens, probability, draw, whether it is kept, and its weight."""
    own = corpus(docs, topics)
    targets = targets or own.tempered()
    rows = _drawn(own.rows, probabilities(own.cells(targets), targets), targets)
    return rows.select(
        "doc_id", "source_level", "lang_level", "topic_level", "tokens", "probability", "draw", "kept",
        F.when(F.col("kept"), 1 / F.col("probability")).alias("weight"),
    )


def marginals(docs: DataFrame, targets: Targets | None = None, topics: Topics | None = None) -> DataFrame:
    """axis, level, asked, in_reach, expected: the target's share of each level, the share it can have for its own number of tokens, and the
    share of the tokens that are expected of the draw. They are equal where targets can be met together."""
    own = corpus(docs, topics)
    targets = targets or own.tempered()
    return docs.sparkSession.createDataFrame(
        report(own.cells(targets), targets), "axis string, level string, asked double, in_reach double, expected double"
    )


def report(cells: Cells, targets: Targets) -> list[tuple[str, str, float, float, float]]:
    if not cells:
        return []
    levels, _, asked, wanted, expected = _planned(cells, targets)
    out = []
    for axis, name in enumerate(AXES):
        got = expected.sum(axis=_others(axis))
        out += [(name, *x) for x in zip(levels[axis], asked[axis].tolist(), (wanted[axis] / wanted[axis].sum()).tolist(), (got / got.sum()).tolist(), strict=True)]
    return out


def sample_mixture(docs: DataFrame, targets: Targets | None = None, topics: Topics | None = None) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns."""
    own = corpus(docs, topics)
    targets = targets or own.tempered()
    chances = probabilities(own.cells(targets), targets)
    rows = with_topic(docs, own.topics).select("row", "topic", *[F.col(f"row.{c}").alias(c) for c in ("doc_id", "source", "lang")])
    return _drawn(rows, chances, targets).filter("kept").select("row.*")
