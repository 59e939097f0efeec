"""A linear classifier of text quality: support vectors on naive Bayes features.

Features are indicators of n-grams, of bytes and of words, hashed to a fixed number of
places. Each is scaled by the log of the ratio of its smoothed shares in the two classes;
a text is scaled to length 1. A linear model with hinge loss is then fitted by coordinate
descent on the dual, and its margins are mapped to probabilities by a logistic curve that
is fitted on rows kept back from the descent.

The model is fitted on a sample of labelled rows, at most ``TRAIN_ROWS`` of them (the
smallest hashes of their ids). Its size is fixed, so it goes to every task; texts are
scored where they are, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.batches import add_columns, byte_slices
from termloom.llm.words import find_words, gram_hashes, gram_starts, mix, word_hashes

#: Labelled rows that the model is fitted on, at most.
TRAIN_ROWS = 4000
#: One row of so many is kept back from the descent, for the logistic curve.
HOLD_BACK = 5

BYTE_GRAM, BYTE_BITS = 3, 16
WORD_GRAMS, WORD_BITS = (1, 2), 16
#: Runs of equal words are n-grams of their own, whatever the word is.
RUNS = (2, 3, 4)
_FIRST_RUN = (1 << BYTE_BITS) + len(WORD_GRAMS) * (1 << WORD_BITS)
PLACES = _FIRST_RUN + len(RUNS)

SMOOTHING = 1.0
COST = 1.0
EPOCHS = 20


def _places(column: pa.Array) -> Iterator[np.ndarray]:
    """Per text, the places of its n-grams, each once."""
    words = find_words(column)
    data, texts = words.data.astype(np.uint64), words.texts
    codes = np.zeros(0, np.int64)
    if len(data) >= BYTE_GRAM:
        grams = (data[:-2] << np.uint64(16)) | (data[1:-1] << np.uint64(8)) | data[2:]
        codes = (mix(grams) >> np.uint64(64 - BYTE_BITS)).astype(np.int64)
    hashes, of_words = word_hashes(words), []
    for i, n in enumerate(WORD_GRAMS):
        grams = (gram_hashes(hashes, n) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        offset = (1 << BYTE_BITS) + i * (1 << WORD_BITS)
        of_words.append(np.where(gram_starts(words, n), grams + offset, -1))
    equal = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    runs = []
    for n in RUNS:
        whole = equal[: max(0, len(equal) - n + 2)].copy()
        for i in range(1, n - 1):
            whole &= equal[i : i + len(whole)]
        has = np.zeros(len(texts) - 1, bool)
        has[words.doc[: len(whole)][whole]] = True
        runs.append(has)
    seen = np.zeros(PLACES, bool)
    for d in range(len(texts) - 1):
        seen[codes[texts[d] : max(texts[d], texts[d + 1] - BYTE_GRAM + 1)]] = True
        for n, grams in zip(WORD_GRAMS, of_words, strict=True):
            seen[grams[words.first[d] : max(words.first[d], words.first[d + 1] - n + 1)]] = True
        for i, has in enumerate(runs):
            seen[_FIRST_RUN + i] = has[d]
        found = np.flatnonzero(seen)
        seen[found] = False
        yield found


@dataclass
class Model:
    """``score = 1 / (1 + exp(-(slope * margin + shift)))``, with ``margin = unit(ratio) . weight + bias``."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, places: np.ndarray) -> float:
        ratio = self.ratio[places]
        length = float(np.sqrt(ratio @ ratio))
        return self.bias + (float(ratio @ self.weight[places]) / length if length else 0.0)

    def score(self, places: np.ndarray) -> float:
        x = float(np.clip(self.slope * self.margin(places) + self.shift, -500, 500))
        return float(1 / (1 + np.exp(-x)))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = [np.full(PLACES, SMOOTHING), np.full(PLACES, SMOOTHING)]
    for places, label in zip(rows, labels, strict=True):
        counts[int(label)][places] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, size: int, cost: float = COST, epochs: int = EPOCHS
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise half their squared length plus ``cost`` times all hinge losses.

    ``rows``: places and values. The bias is the weight of a feature that every row has.
    """
    weight, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    squares = [float(values @ values) + 1.0 for _, values in rows]
    random = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            places, values = rows[i]
            slack = 1 - signs[i] * (float(weight[places] @ values) + bias)
            new = min(max(alpha[i] + slack / squares[i], 0.0), cost)
            step = (new - alpha[i]) * signs[i]
            if step:
                alpha[i] = new
                weight[places] += step * values
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weight, bias


def fit_logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton's method, towards smoothed labels."""
    good, bad = int(labels.sum()), int((1 - labels).sum())
    goal = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    beta, x = np.array([1.0, 0.0]), np.column_stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        gradient = x.T @ (p - goal) + np.array([1e-3, 0]) * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def fit_model(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """With rows of one class only, or none, the score is the smoothed share of label 1 for every text."""
    flat = np.zeros(PLACES)
    if len(rows) == 0 or labels.min() == labels.max():
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(flat, flat, 0.0, 0.0, float(np.log(share / (1 - share))))
    ratio = log_count_ratios(rows, labels)
    scaled = []
    for places in rows:
        values = ratio[places]
        scaled.append((places, values / max(float(np.sqrt(values @ values)), 1e-12)))
    signs = np.where(labels == 1, 1.0, -1.0)
    back = np.arange(len(rows)) % HOLD_BACK == HOLD_BACK - 1
    if len(set(labels[back])) < 2:
        back[:] = False
    used = np.flatnonzero(~back)
    weight, bias = dual_coordinate_descent([scaled[i] for i in used], signs[used], PLACES)
    model = Model(ratio, weight, bias, 1.0, 0.0)
    judged = np.flatnonzero(back) if back.any() else used
    margins = np.array([model.margin(rows[i]) for i in judged])
    model.slope, model.shift = fit_logistic(margins, labels[judged])
    return model


def train(
    docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", column: str = "text", max_rows: int = TRAIN_ROWS
) -> Model:
    """Fit on ``labels (doc_id, <label> 0/1)`` and the texts of ``docs``.

    Rows without a label or an id are left out; an id labelled twice has its lower label.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    known = known.groupBy(doc_id).agg(F.min(label).alias("__label"))
    chosen = known.orderBy(F.xxhash64(doc_id), doc_id).limit(max_rows)
    texts = docs.select(F.col(doc_id).alias("__id"), F.col(column).alias("__text"))
    sample = chosen.join(texts, F.col(doc_id) == F.col("__id")).select("__id", "__text", "__label")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "__text"):
                packed = [p.astype("<i4").tobytes() for p in _places(part.column("__text"))]
                arrays = [part.column("__id").cast(pa.string()), part.column("__label").cast(pa.int32()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "label", "places"])

    rows = sample.mapInArrow(features, "id string, label int, places binary")
    # Repeated rows of a document must not exceed the bound.
    rows = rows.groupBy("id").agg(F.min("label").alias("label"), F.min("places").alias("places")).collect()
    distinct = sorted(rows, key=lambda row: row["id"])
    order = np.random.default_rng(0).permutation(len(distinct))
    places = [np.frombuffer(distinct[i]["places"], "<i4") for i in order]
    return fit_model(places, np.array([distinct[i]["label"] for i in order], np.int64))


def score(docs: DataFrame, model: Model, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns and ``score``: how likely label 1 is. Null and empty texts have no n-grams."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(part: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"score": pa.array([shared.value.score(p) for p in _places(part.column(column))], pa.float64())}

    return add_columns(docs, make, "score double", column, keep)
