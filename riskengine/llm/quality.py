"""Operator 3: quality classifier, naive Bayes features under a linear hinge-loss model.

Features are indicators of the text's byte 4-grams, hashed to 65,536 columns, and of runs of one
word; they are scaled by the log-count ratio of the two classes and brought to unit length. The weights minimise the hinge
loss by dual coordinate descent. Margins are calibrated to probabilities on labelled rows that the
fit did not see.

The fit uses labelled rows only, and no more than about MAX_LABELLED of them (a documented bound,
drawn by a hash of doc_id; a smaller label table is used whole), in one task; the weights, half a
megabyte, go back to the tasks that score every whole text. Labels, language, source and doc_id
are never features.

Defined results: null, empty and very short texts have no features and get the score of the bias
alone; labels that are null or whose document is missing are ignored, of several labels of one
document the smaller counts; without labels of both classes every score is 0.5; repeated rows get
equal scores; empty tables give no rows; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.llm.common import carrying, kept_as
from riskengine.llm.shingles import runs

GRAM_BYTES = 4
BYTE_COLUMNS = 1 << 16
WORD_RUNS = (2, 4, 8)
COLUMNS = BYTE_COLUMNS + len(WORD_RUNS)
MAX_LABELLED = 16_000
# Every fifth labelled row is left out of the fit and calibrates it.
CALIBRATE_EVERY = 5
EPOCHS = 12
COST = 1.0
SMOOTHING = 1.0
THRESHOLD = 0.7


def grams(text: bytes) -> np.ndarray:
    """Sorted columns of a text: hashed byte 4-grams, and grams of equal neighbouring words.

    The last columns say that some word stands 2, 4 or 8 times in a row; 4-grams stay below them.
    """
    data = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    if len(data) < GRAM_BYTES:
        return np.zeros(0, dtype=np.int32)
    joined = data[:-3] | data[1:-2] << np.uint32(8) | data[2:-1] << np.uint32(16) | data[3:] << np.uint32(24)
    hashed = ((joined * np.uint32(2654435761)) >> np.uint32(16)).astype(np.uint16)
    hashed.sort(kind="stable")
    distinct = hashed[np.concatenate(([True], hashed[1:] != hashed[:-1]))]
    words = text.split()
    same = bytes([a == b for a, b in zip(words, words[1:])])
    runs = [BYTE_COLUMNS + i for i, n in enumerate(WORD_RUNS) if b"\x01" * (n - 1) in same]
    return np.concatenate((distinct, np.array(runs, dtype=np.uint32))).astype(np.int32)


def log_count_ratio(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """log of the smoothed share of each column in good texts over that in bad texts."""
    counts = np.full((2, COLUMNS), SMOOTHING)
    for row, label in zip(rows, good):
        counts[int(label), row] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1]) - np.log(share[0])


def dual_coordinate_descent(
    rows: list[np.ndarray], values: np.ndarray, good: np.ndarray, epochs: int = EPOCHS, cost: float = COST
) -> tuple[np.ndarray, float]:
    """Weights over scaled columns and a bias that minimise the hinge loss.

    A row's entries are values[row] / |values[row]|, plus one constant entry for the bias. They are
    worked out again at each visit, because all at once take twice the room of the columns. Rows
    are visited in an order fixed by the epoch.
    """
    sign = np.where(good, 1.0, -1.0)
    norm = np.array([max(np.linalg.norm(values[row]), 1e-12) for row in rows])
    square = np.array([(x := values[row] / n) @ x + 1.0 for row, n in zip(rows, norm)])
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(len(values)), 0.0
    for epoch in range(epochs):
        moved = 0.0
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            row = rows[i]
            x = values[row] / norm[i]
            gradient = sign[i] * (weights[row] @ x + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                alpha[i] = new
                weights[row] += step * x
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def sigmoid_fit(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the calibrated probability, by Newton steps on softened labels."""
    n_good, n_bad = good.sum(), (~good).sum()
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    slope, shift = 1.0, 0.0
    x = np.stack([margins, np.ones_like(margins)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        gradient = x @ (p - target) + np.array([1e-3 * slope, 0.0])
        curvature = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        change = np.linalg.solve(curvature, gradient)
        slope, shift = slope - change[0], shift - change[1]
        if np.abs(change).max() < 1e-8:
            break
    return max(float(slope), 0.0), float(shift)


@dataclass
class QualityModel:
    ratio: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, row: np.ndarray) -> float:
        values = self.ratio[row]
        norm = np.linalg.norm(values)
        return self.bias + (float(self.weights[row] @ values) / norm if norm else 0.0)

    def score(self, text: bytes) -> float:
        z = self.slope * self.margin(grams(text)) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_rows(rows: list[np.ndarray], good: np.ndarray) -> QualityModel | None:
    """The model of labelled texts' columns, or None without both classes in fit and calibration rows."""
    held = np.arange(len(rows)) % CALIBRATE_EVERY == 0
    if any(len(set(good[part])) < 2 for part in (held, ~held)):
        return None
    fit = [rows[i] for i in np.flatnonzero(~held)]
    ratio = log_count_ratio(fit, good[~held])
    weights, bias = dual_coordinate_descent(fit, ratio, good[~held])
    model = QualityModel(ratio, weights, bias, 1.0, 0.0)
    margins = np.array([model.margin(rows[i]) for i in np.flatnonzero(held)])
    model.slope, model.shift = sigmoid_fit(margins, good[held])
    return model


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id's text leaves 2 by 4."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> QualityModel | None:
    """Fit on labelled documents (doc_id, text) and labels (doc_id, quality)."""
    known = (
        kept_as(labels, doc_id="doc_id", quality="quality")
        .where("doc_id is not null and quality is not null")
        .where(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    total = known.count()
    if total > max_labelled:
        draw = F.pmod(F.xxhash64(F.lit("quality"), F.col("doc_id")), F.lit(total))
        known = known.where(draw < max_labelled)
    # About max_labelled rows of two numbers: a proven bound for the broadcast.
    rows = kept_as(docs, doc_id="doc_id", text="text").join(F.broadcast(known), "doc_id")
    ordered = (
        rows.dropDuplicates(["doc_id"])
        .repartition(1)
        .sortWithinPartitions(F.xxhash64(F.lit("order"), F.col("doc_id")))
        .select("text", "quality")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, good = [], []
        for batch in batches:
            rows += [grams((t.as_py() or "").encode()) for t in batch.column("text")]
            good += batch.column("quality").to_pylist()
        model = fit_rows(rows, np.array(good, dtype=np.int64) == 1)
        if model:
            columns = [[model.ratio.tobytes()], [model.weights.tobytes()], [model.bias], [model.slope], [model.shift]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], ["ratio", "weights", "bias", "slope", "shift"]
            )

    found = ordered.mapInArrow(work, "ratio binary, weights binary, bias double, slope double, shift double").collect()
    if not found:
        return None
    row = found[0]
    return QualityModel(
        np.frombuffer(bytes(row["ratio"])), np.frombuffer(bytes(row["weights"])), row["bias"], row["slope"], row["shift"]
    )


def score_documents(docs: DataFrame, model: QualityModel | None, name: str = "score") -> DataFrame:
    """All columns of `docs` with `name`, the calibrated probability of good quality."""
    schema = docs.drop(name).schema.add(name, "double")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in runs(whole)):
            texts = batch.column("text").to_pylist()
            scores = [model.score((t or "").encode()) if model else 0.5 for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], schema.names)

    return docs.drop(name).mapInArrow(work, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document (doc_id, text)."""
    model = train(docs, labels)
    scored = score_documents(kept_as(docs, doc_id="doc_id", text="text"), model)
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""

    def work(docs: DataFrame) -> DataFrame:
        scored = score_documents(docs, train(docs, labels), name="_quality")
        return scored.where(F.col("_quality") >= threshold).drop("_quality")

    return carrying(docs, ("doc_id", "text"), work)
