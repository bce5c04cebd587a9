"""Language ID: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

The classifier is fitted on a bounded sample of labelled rows (about ``SAMPLE`` for each label and
``TOTAL`` in sum, but ``LEAST`` for each label and one at least, drawn by hash, whole texts): tasks turn them into counts of
hashed subwords, and stochastic gradient descent runs over those in numpy. All labels are learned. A temperature fitted on a
part kept apart makes scores probabilities, and rejection starts below the score that nearly all right answers of
that part reach. A prediction is a softmax of a mean of table rows, computed where the text lies: no shuffle. The table
that tasks get has a row per subword of logits or, beyond ``WIDTH`` labels, of embeddings, so it doesn't grow with the labels.

Defined cases: null texts and texts without a letter are ``und`` with score 0, and rejected; without
labelled rows every text is; rows with a null label or doc_id are predicted but not learned from; a
repeated row gets the same answer each time; equal scores go to the label that sorts first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import rolling
from tickloom.llm.tables import materialise, private, small_batches

#: Labelled rows that are learned from, on average: for each label, and in sum; the bound of what the driver sees.
SAMPLE, TOTAL = 500, 4000
#: Rows that are learned from for each of very many labels, on average; of each, one at least.
LEAST = 10
BUCKETS, WIDTH, EPOCHS = 1 << 14, 12, 12
#: Step of the softmax, and how much larger the step of an embedding is, whose share in a mean is small.
RATE, GAIN = 0.5, 20
#: Subwords of no opinion that every mean holds besides a text's own: short texts get modest scores.
PRIOR = 40
SUBWORDS = (1, 2, 3, 4)
#: Right answers of the calibration part that rejection may cost at most.
LOSS = 0.002
UNKNOWN = "und"

_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_ALNUM = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return text is not None and any(m.group().isalpha() for m in _ALNUM.finditer(text))


def _folded(texts: pa.Array) -> pa.Array:
    """Lower-cased texts in UTF-8; what is no letter in ASCII is a space."""
    folded = ((x or "") for x in texts.to_pylist())
    return pa.array([(x if x.isascii() else x.lower()).encode("utf-8", "replace").translate(_LETTERS) for x in folded], pa.large_binary())


def _subwords(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each subword length: the bucket at every byte, and whether the subword lies in one text."""
    code = np.zeros(len(data), dtype=np.uint64)
    for size in range(1, max(SUBWORDS) + 1):
        n = len(data) - size + 1
        if n <= 0:
            return
        code = (code[:n] << np.uint64(8)) | data[size - 1 : size - 1 + n]
        if size in SUBWORDS:
            key = (code + np.uint64(size << 40)) * np.uint64(0x9E3779B97F4A7C15)
            yield (key >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32), rolling.within(bounds, size, n)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    folded = batch.set_column(batch.schema.get_field_index("text"), "text", _folded(batch.column("text")))
    yield from rolling.chunks(folded, limit=1_000_000)


def subword_counts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one folded text, and how often each occurs."""
    found = [buckets[good] for buckets, good in _subwords(data, np.array([0, len(data)]))]
    return np.unique(np.concatenate(found or [np.zeros(0, np.int32)]), return_counts=True)


@dataclass(frozen=True)
class Model:
    """Logits of each label for each subword bucket, divided by the temperature; for many labels in two factors."""

    labels: tuple[str, ...]
    table: np.ndarray
    weights: np.ndarray | None
    threshold: float

    def chances(self, means: np.ndarray) -> np.ndarray:
        """Probabilities of the labels from means of table rows."""
        return _softmax(means if self.weights is None else means @ self.weights)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 5) -> Model | None:
    """samples: (label, buckets, counts). A fifth of each label calibrates, the rest is learned from."""
    samples = [x for x in samples if len(x[1])]
    labels = tuple(sorted({x[0] for x in samples}))
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    place = {label: i for i, label in enumerate(labels)}
    apart = [[x for x in samples if x[0] == label] for label in labels]
    learn = [x for own in apart for k, x in enumerate(own) if k % 5 or len(own) < 5]
    # Labels of a few rows calibrate nothing, unless there are no others.
    check = [x for own in apart for k, x in enumerate(own) if not k % 5 and len(own) >= 5] or learn
    table = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    weights = np.zeros((WIDTH, len(labels)))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(learn)):
            label, buckets, counts = learn[i]
            share = counts / counts.sum()
            mean = share @ table[buckets]
            error = _softmax(mean @ weights)
            error[place[label]] -= 1
            step = weights @ error
            weights -= rate * np.outer(mean, error)
            table[buckets] -= (rate * GAIN) * share[:, None] * step
    few = len(labels) <= WIDTH
    rows = (table @ weights if few else table).astype(np.float32)
    means = np.array([c @ rows[b].astype(np.float64) / (c.sum() + PRIOR) for _, b, c in check])
    means = means if few else means @ weights
    truth = np.array([place[label] for label, _, _ in check])
    scales = np.geomspace(0.05, 5, 50)
    losses = [-np.log(np.maximum(_softmax(means * s)[np.arange(len(truth)), truth], 1e-12)).mean() for s in scales]
    scale = scales[int(np.argmin(losses))]
    scores = _softmax(means * scale)
    right = scores.argmax(axis=1) == truth
    # A little below, since scores are computed in single precision later.
    threshold = float(np.quantile(scores.max(axis=1)[right], LOSS, method="lower")) * (1 - 1e-6) if right.any() else 0.0
    return Model(labels, rows * np.float32(scale) if few else rows, None if few else weights * scale, threshold)


def sample(docs: DataFrame) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Subword counts of about ``SAMPLE`` rows of each label. docs: doc_id, text, label."""
    rows = docs.filter("label is not null and text is not null")
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30))
    sizes = materialise(rows.groupBy("label").agg(F.count("*").alias("count"), F.min(place).alias("lowest")), "label-sizes")
    each = min(SAMPLE, max(LEAST, TOTAL / max(1, sizes.count())))
    # The row of the lowest place is drawn in any case. Spark broadcasts the sizes only if they are few.
    limits = sizes.select("label", F.greatest("lowest", F.floor(each / F.col("count") * (1 << 30))).alias("limit"))
    drawn = rows.join(limits, "label").filter(place <= F.col("limit")).select("doc_id", "label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, label, text in zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), _folded(batch.column("text")), strict=True):
                buckets, counts = subword_counts(np.frombuffer(text.as_py(), np.uint8))
                out.append((doc_id, label, buckets.astype("<i4").tobytes(), counts.astype("<i4").tobytes()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            types = [pa.int64(), pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=["doc_id", "label", "buckets", "counts"])

    found = drawn.mapInArrow(count, "doc_id long, label string, buckets binary, counts binary").collect()
    found.sort(key=lambda r: (r["label"], r["doc_id"], bytes(r["buckets"])))
    return [(r["label"], np.frombuffer(r["buckets"], "<i4"), np.frombuffer(r["counts"], "<i4")) for r in found]


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (text last) with lang_pred, score and rejected in place of text."""
    fields = [f for f in docs.schema if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = np.array([has_letter(x) for x in batch.column("text").to_pylist()], dtype=bool)
            means = []
            for _, data, bounds in _pieces(batch) if model else ():
                total = np.zeros((len(bounds) - 1, model.table.shape[1]))
                seen = np.zeros(len(bounds) - 1)
                for buckets, good in _subwords(data, bounds):
                    use = np.flatnonzero(good)
                    if len(use) == 0:
                        continue
                    cuts = np.searchsorted(use, bounds)
                    full = np.flatnonzero(np.diff(cuts))
                    total[full] += np.add.reduceat(model.table[buckets[use]], cuts[full], axis=0, dtype=np.float64)
                    seen += np.diff(cuts)
                means.append(total / (seen + PRIOR)[:, None])
            if means:
                chances = model.chances(np.concatenate(means))
                best = chances.argmax(axis=1)
                score = np.where(lettered, chances[np.arange(len(best)), best], 0.0)
                names = [model.labels[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
                rejected = ~lettered | (score < model.threshold)
            else:
                names, score, rejected = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            own = [batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)],
                names=[*[f.name for f in fields], "lang_pred", "score", "rejected"],
            )

    return docs.mapInArrow(run, f"{schema}, lang_pred string, score double, rejected boolean")


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: a fifth, by checksum of their id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learned(docs: DataFrame) -> Model | None:
    """A model of the labelled rows of ``docs`` that aren't held out."""
    rows = private(small_batches(docs), doc_id="doc_id", text="text", label="lang")
    return fit(sample(rows.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))))


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected for each row."""
    rows = private(docs, doc_id="doc_id", held_out=held_out(docs["doc_id"]), text="text")
    return predict(rows, learned(docs))


def recognised(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language isn't rejected, with all their columns as they are."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].alias("text"))
    return predict(rows, learned(docs)).filter(~F.col("rejected")).select("row.*")
