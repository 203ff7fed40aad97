"""Quality classifier: naive Bayes features under a linear support vector machine.

A document is the set of its n-grams: byte trigrams, hashed, and runs of up to six marks
that tell whether a word repeats the one before. Each indicator is scaled by the log of
the ratio of its smoothed counts in the two classes, documents are scaled to length one,
and a hinge-loss model is fitted by dual coordinate descent. A sigmoid, fitted on labelled
rows that the model has not seen, turns margins into scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import column_of, small_batches, word_chunks

# Labelled documents that the model is fitted on, at most.
FIT_ROWS = 6000
FOLDS = 5
THRESHOLD = 0.3
_TRIGRAMS = 1 << 15
_MARKS = 6
_CHUNK = 4 << 20
_FEATURES = _TRIGRAMS + (1 << (_MARKS + 1))


def _distinct(numbers: np.ndarray) -> np.ndarray:
    numbers = np.sort(numbers, kind="stable")
    return numbers[np.append(True, numbers[1:] != numbers[:-1])]


def indicators(raw: bytes) -> np.ndarray:
    """The numbers of the n-grams that a UTF-8 text holds, ascending, as uint16."""
    parts, data = [], np.frombuffer(raw, np.uint8)
    for at in range(0, max(len(data) - 2, 0), _CHUNK):
        some = data[at : at + _CHUNK + 2].astype(np.uint32)
        code = (some[:-2] << np.uint32(16)) | (some[1:-1] << np.uint32(8)) | some[2:]
        code *= np.uint32(0x9E3779B1)
        code >>= np.uint32(17)
        parts.append(_distinct(code.astype(np.uint16)))
    words, marks = [], np.zeros(0, np.uint16)
    for more in word_chunks(raw, _CHUNK):
        words = words[-1:] + more
        new = np.fromiter(map(bytes.__eq__, words[1:], words), np.uint16, max(len(words) - 1, 0))
        marks = np.concatenate([marks[-_MARKS + 1 :], new])
        run = np.zeros(len(marks), np.uint16)
        for n in range(1, min(_MARKS, len(marks)) + 1):
            # A leading one keeps runs of different lengths apart.
            run = run[: len(marks) - n + 1] * np.uint16(2) + marks[n - 1 :]
            seen = np.flatnonzero(np.bincount(run, minlength=1 << n))
            parts.append((_TRIGRAMS + (1 << n) + seen).astype(np.uint16))
    if not parts:
        return np.zeros(0, np.uint16)
    found = np.concatenate(parts)
    return found if len(raw) <= _CHUNK else _distinct(found)


def _indicator_rows(column: pa.Array) -> Iterator[np.ndarray]:
    for raw in column.cast(pa.binary()):
        yield indicators(raw.as_py() or b"")


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of the scaled indicators
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, features: np.ndarray) -> float:
        ratios = self.ratios[features]
        length = float(np.sqrt(ratios @ ratios)) or 1.0
        return float(self.weights[features] @ ratios) / length + self.bias

    def score(self, features: np.ndarray) -> float:
        z = self.slope * self.margin(features) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed, normalised counts of each indicator in good and bad."""
    counts = np.ones((2, _FEATURES))
    for features, label in zip(rows, good.tolist()):
        counts[int(label), features] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def descend(rows: list[np.ndarray], good, ratios, c: float = 1.0, passes: int = 20):
    """(weights, bias) of the hinge-loss model, by dual coordinate descent."""
    scaled = []
    for features in rows:
        value = ratios[features]
        scaled.append(value / (np.sqrt(value @ value) or 1.0))
    signs = np.where(good, 1.0, -1.0)
    square = np.array([1.0 + x @ x for x in scaled])  # the constant feature adds one
    alpha = np.zeros(len(rows))
    weights, bias = np.zeros(_FEATURES), 0.0
    order = np.random.default_rng(7)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ scaled[i] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), c)
            step = (new - alpha[i]) * signs[i]
            if step:
                weights[rows[i]] += step * scaled[i]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def sigmoid(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the most likely score of each margin, labels smoothed."""
    n1, n0 = int(good.sum()), int((~good).sum())
    wanted = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    at = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -500, 500)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (wanted - p)
        )
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo the folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """(fold, good, text) of at most ``most`` documents outside fold 0, those with the
    smallest hash of their id; of several labels the worst counts, of several texts with
    one id the smallest."""
    labels = (
        labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("good"))
    )
    labels = labels.withColumn("fold", fold()).where("fold <> 0")
    labels = labels.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "fold", "good").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Model:
    """Fit on (doc_id, text) and (doc_id, quality).

    Only indicator numbers of the sample come to the driver. Fold 1 is kept for the
    sigmoid. Without rows of both classes every document scores the share of good ones.
    """
    schema = "fold long, good int, doc_id long, features binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            features = [x.tobytes() for x in _indicator_rows(column_of(batch, "text"))]
            columns = [column_of(batch, c) for c in ("fold", "good", "doc_id")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(features, pa.binary())],
                names=["fold", "good", "doc_id", "features"],
            )

    sample = labelled_sample(docs, labels, most).select(
        "fold",
        F.col("good").cast("int").alias("good"),
        F.xxhash64("doc_id").alias("doc_id"),
        "text",
    )
    table = sample.mapInArrow(run, schema).toArrow().sort_by("doc_id")
    rows = [np.frombuffer(x.as_py(), np.uint16) for x in table["features"]]
    good = table["good"].to_numpy() > 0
    later = table["fold"].to_numpy() == 1
    if any(len(set(good[part])) < 2 for part in (later, ~later)):
        odds = np.log((good.sum() + 1) / ((~good).sum() + 1)) if len(good) else 0.0
        zero = np.zeros(_FEATURES)
        return Model(zero, zero, 0.0, 1.0, float(odds))
    used = [x for x, out in zip(rows, later) if not out]
    ratios = count_ratios(used, good[~later])
    weights, bias = descend(used, good[~later], ratios)
    model = Model(weights, ratios, bias, 1.0, 0.0)
    margins = np.array([model.margin(x) for x, out in zip(rows, later) if out])
    slope, shift = sigmoid(margins, good[later])
    return Model(weights, ratios, bias, slope, shift)


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """Add the score of every text, 0 to 1, higher where label 1 is likelier.

    A null or empty text has no n-grams and scores by the bias. A column called ``into``
    is replaced, others pass through; nothing but the text is looked at.
    """
    docs = docs.drop(into).withColumn(into, F.lit(0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            values = [model.score(x) for x in _indicator_rows(column_of(batch, text))]
            at = batch.schema.get_field_index(into)
            yield batch.set_column(at, batch.schema.field(at), pa.array(values, pa.float64()))

    return docs.mapInArrow(run, docs.schema)
