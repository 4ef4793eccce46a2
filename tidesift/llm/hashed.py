"""Hashed word n-grams of texts, as distinct features of each row."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidesift.llm.textbytes import LOWER, SPLIT, Texts, binaries, join_hashes, pieces, texts, within, word_hashes, words


@dataclass(frozen=True)
class NGrams:
    """Words are runs of letters and digits, or of punctuation. Which n-grams count: lengths of runs, gaps of skipped pairs, and bits of a feature's number.

    ``stems`` adds single words cut to so many leading bytes, so that longer words of one stem share a feature.
    """

    runs: tuple[int, ...] = (1, 2)
    skips: tuple[int, ...] = ()
    stems: tuple[int, ...] = ()
    bits: int = 18

    def of(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Distinct features of each row in ascending order, and how many each row has."""
        data = LOWER[t.data]
        starts, ends, counts = words(Texts(data, t.bounds), SPLIT)
        hashes = word_hashes(data, starts, ends)
        rows = np.repeat(np.arange(len(t)), counts)
        parts = []
        kinds = [tuple(range(n)) for n in self.runs] + [(0, gap + 1) for gap in self.skips]
        for seed, places in enumerate(kinds, 1):
            first = within(counts, places[-1])
            parts.append((rows[first], join_hashes(*(hashes[first + p] for p in places), seed=seed)))
        for length in self.stems:
            cut = np.flatnonzero(ends - starts >= length)
            stems = word_hashes(data, starts[cut], starts[cut] + length)
            parts.append((rows[cut], join_hashes(stems, seed=100 + length)))
        shift = np.uint64(64 - self.bits)
        key = np.sort(np.concatenate([(at << self.bits) | (h >> shift).astype(np.int64) for at, h in parts]))
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        key = key[new]
        return (key & ((1 << self.bits) - 1)).astype(np.int32), np.bincount(key >> self.bits, minlength=len(t))

    @property
    def size(self) -> int:
        return 1 << self.bits


def row_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    bounds = np.concatenate(([0], np.cumsum(counts)))
    return total[bounds[1:]] - total[bounds[:-1]]


def collect_features(rows: DataFrame, text: str, label: str, grams: NGrams) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and labels of a bounded set of rows, in an order that does not depend on tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                features, counts = grams.of(texts(piece.column(text)))
                yield pa.RecordBatch.from_arrays(
                    [binaries(features, counts).cast(pa.binary()), piece.column(label)], names=["features", "label"]
                )

    table = rows.select(text, label).mapInArrow(run, "features binary, label double").toArrow()
    found = sorted(zip(table["features"].to_pylist(), table["label"].to_pylist(), strict=True))
    return [np.frombuffer(f, np.int32) for f, _ in found], np.array([y for _, y in found], np.float64)
