"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField

from tidesift.llm.hashed import NGrams, collect_features, row_sums
from tidesift.llm.textbytes import texts, with_columns

#: Bound on the rows of each class that the model is fitted on.
ROWS_PER_CLASS = 3000


@dataclass(frozen=True)
class FTRL:
    """Per-coordinate rates ``alpha / (beta + sqrt(sum g^2))``; weights whose ``|z|`` stays within ``l1`` are zero."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 1.0
    epochs: int = 4
    seed: int = 7


@dataclass
class Model:
    """Non-zero weights by feature number."""

    grams: NGrams
    features: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    bias: float = 0.0

    def dense(self) -> np.ndarray:
        full = np.zeros(self.grams.size, np.float32)
        full[self.features] = self.weights
        return full


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, grams: NGrams, how: FTRL = FTRL()) -> Model:
    """One pass per epoch over rows of distinct features, one step per row; no rows give an even model."""
    z, n = np.zeros(grams.size), np.zeros(grams.size)
    bias_z = bias_n = bias = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        rate = (how.beta + np.sqrt(n[at])) / how.alpha + how.l2
        return np.where(np.abs(own) <= how.l1, 0.0, (np.sign(own) * how.l1 - own) / rate)

    rng = np.random.default_rng(how.seed)
    for _ in range(how.epochs):
        for i in rng.permutation(len(rows)):
            at = rows[i]
            w = weights(at)
            bias = -bias_z / ((how.beta + np.sqrt(bias_n)) / how.alpha)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - labels[i]
            if abs(g) < 1e-4:
                continue
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / how.alpha * w
            n[at] += g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / how.alpha * bias
            bias_n += g * g
    all_weights = weights(np.arange(grams.size))
    kept = np.flatnonzero(all_weights).astype(np.int32)
    return Model(grams, kept, all_weights[kept].astype(np.float32), float(bias))


def fit(rows: DataFrame, text: str, label: str, grams: NGrams | None = None, how: FTRL = FTRL()) -> Model:
    """Fits on a bounded set of rows with label 0 or 1; null texts count as empty."""
    grams = grams or NGrams(runs=(1, 2), skips=(1,), stems=(7, 8, 9), bits=18)
    return fit_rows(*collect_features(rows, text, label, grams), grams, how)


def score(df: DataFrame, model: Model, text: str, out: str = "score") -> DataFrame:
    """The rows with the probability of label 1 of their whole text.

    Null and empty texts, and texts without words, get the probability of the bias alone. Rows are scored one by one,
    so repeated rows get equal scores. A column named like the new one is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most 2^bits weights
    cache: list[np.ndarray] = []

    def compute(piece: pa.RecordBatch) -> list[pa.Array]:
        if not cache:
            cache.append(shared.value.dense())
        features, counts = shared.value.grams.of(texts(piece.column(text)))
        margin = row_sums(cache[0][features], counts) + shared.value.bias
        return [pa.array(1 / (1 + np.exp(-np.clip(margin, -35, 35))))]

    return with_columns(df, text, [StructField(out, DoubleType())], compute)
