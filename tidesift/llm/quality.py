"""Quality by naive Bayes support vectors: log-count ratios scale n-gram indicators for a linear hinge-loss model."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField

from tidesift.llm.hashed import NGrams, collect_features, row_sums
from tidesift.llm.textbytes import texts, with_columns

#: Bound on the rows of each class that the model is fitted on.
ROWS_PER_CLASS = 3000


@dataclass
class Model:
    """``weights`` already hold ratio times coefficient; ``squares`` the squared ratios, for the length of a row."""

    grams: NGrams
    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, size: int, smooth: float = 1.0) -> np.ndarray:
    """Logarithm of each feature's share among rows of label 1 over that among rows of label 0.

    Features that no row has get 0.
    """
    counts = [np.full(size, smooth) for _ in range(2)]
    for at, y in zip(rows, labels, strict=True):
        counts[int(y > 0)][at] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratios[(counts[0] == smooth) & (counts[1] == smooth)] = 0
    return ratios


def dual_descent(
    rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, size: int, cost: np.ndarray, epochs: int, seed: int
) -> tuple[np.ndarray, float]:
    """Coefficients and bias of a linear model with hinge loss, by coordinate descent on its dual."""
    w, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    norms = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            gradient = signs[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                w[rows[i]] += step * signs[i] * values[i]
                bias += step * signs[i]
                alpha[i] = new
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return w, bias


def _scaled(rows: list[np.ndarray], ratios: np.ndarray) -> list[np.ndarray]:
    out = []
    for at in rows:
        v = ratios[at]
        out.append(v / max(np.sqrt(v @ v), 1e-9))
    return out


def _sigmoid_fit(margins: np.ndarray, labels: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of the sigmoid that turns margins into probabilities, by Newton's method on smoothed targets."""
    ones = labels.sum()
    zeros = len(labels) - ones
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0, 0.0
    x = np.stack([margins, np.ones_like(margins)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2), x @ (p - target))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit_rows(
    rows: list[np.ndarray], labels: np.ndarray, grams: NGrams, cost: float = 1.0, epochs: int = 20, seed: int = 5
) -> Model:
    """Margins for the sigmoid come from models that did not see the row (three parts), the weights from all rows.

    With rows of one class only, every text gets a score on that class's side.
    """
    one_sided = len(labels) == 0 or labels.min() == labels.max()
    if one_sided:
        shift = 0.0 if len(labels) == 0 else (3.0 if labels[0] > 0 else -3.0)
        return Model(grams, np.zeros(grams.size, np.float32), np.zeros(grams.size, np.float32), 0.0, 1.0, shift)

    def train(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        own, y = [rows[i] for i in at], labels[at]
        ratios = log_count_ratios(own, y, grams.size)
        signs = np.where(y > 0, 1.0, -1.0)
        each = np.where(y > 0, cost * len(y) / (2 * max(1, (y > 0).sum())), cost * len(y) / (2 * max(1, (y <= 0).sum())))
        return ratios, *dual_descent(own, _scaled(own, ratios), signs, grams.size, each, epochs, seed)

    part = np.random.default_rng(seed).integers(0, 3, len(rows))
    margins = np.zeros(len(rows))
    for k in range(3):
        ratios, w, bias = train(np.flatnonzero(part != k))
        for i in np.flatnonzero(part == k):
            margins[i] = w[rows[i]] @ _scaled([rows[i]], ratios)[0] + bias
    slope, shift = _sigmoid_fit(margins, labels)
    ratios, w, bias = train(np.arange(len(rows)))
    return Model(grams, (ratios * w).astype(np.float32), (ratios**2).astype(np.float32), bias, slope, shift)


def fit(rows: DataFrame, text: str, label: str, share: float | None = None, grams: NGrams | None = None) -> Model:
    """Fits on a bounded set of rows with label 0 or 1; null texts count as empty.

    ``share`` is that of label 1 outside the sample, to which the probabilities are brought.
    """
    grams = grams or NGrams(runs=(1, 2), bits=18)
    features, labels = collect_features(rows, text, label, grams)
    model = fit_rows(features, labels, grams)
    if share is not None and 0 < share < 1 and 0 < labels.sum() < len(labels):
        own = labels.mean()
        model.shift += float(np.log(share / (1 - share)) - np.log(own / (1 - own)))
    return model


def score(df: DataFrame, model: Model, text: str, out: str = "score") -> DataFrame:
    """The rows with the probability of label 1 of their whole text.

    Null and empty texts, and texts without words, get the probability of a row without features. Rows are scored one
    by one, so repeated rows get equal scores. A column named like the new one is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # two arrays of 2^bits numbers

    def compute(piece: pa.RecordBatch) -> list[pa.Array]:
        m: Model = shared.value
        features, counts = m.grams.of(texts(piece.column(text)))
        length = np.sqrt(np.maximum(row_sums(m.squares[features], counts), 0))
        margin = row_sums(m.weights[features], counts) / np.maximum(length, 1e-9) + m.bias
        return [pa.array(1 / (1 + np.exp(-np.clip(m.slope * margin + m.shift, -35, 35))))]

    return with_columns(df, text, [StructField(out, DoubleType())], compute)
