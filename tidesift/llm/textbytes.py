"""Texts of an Arrow batch as one byte array: words, hashes, sets. Everything is vectorised over many rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

#: Bytes of text looked at together; bounds the memory of a task, as one text alone may be longer.
PIECE = 1 << 20
#: Kinds of bytes: 0 between words (space and 0x09 to 0x0D), else 1.
PLAIN = np.ones(256, np.uint8)
PLAIN[[0x20, *range(0x09, 0x0E)]] = 0
#: As before, with ASCII punctuation and signs as a kind of its own, so that a word and what follows it are two.
SPLIT = PLAIN.copy()
SPLIT[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = 2
#: Lower case for A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def randoms(n: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random odd numbers."""
    return mix(np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


_BYTE = randoms(256, 11)
_BASE = randoms(1, 12)[0]
_BASE_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPAN = 1 << 16
_POWERS, _BACK = _powers(_BASE, _SPAN), _powers(_BASE_BACK, _SPAN)
_FAR, _FAR_BACK = (np.uint64(pow(int(b), _SPAN, 1 << 64)) for b in (_BASE, _BASE_BACK))


class Texts:
    """Rows of text as ``data[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1


def texts(column: pa.Array) -> Texts:
    """Bytes of a string column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(data[bounds[0] : bounds[-1]], bounds - bounds[0])


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most so many bytes of text, or a single row."""
    bounds = texts(batch.column(text)).bounds
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def words(t: Texts, kinds: np.ndarray = PLAIN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of words of each row. A word is a run of bytes of one kind."""
    n = len(t.data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(t), np.int64)
    kind = kinds[t.data]
    edge = np.zeros(n + 1, bool)
    edge[t.bounds] = True
    edge[1:n] |= kind[1:] != kind[:-1]
    cuts = np.flatnonzero(edge)
    solid = kind[cuts[:-1]] != 0
    starts, ends = cuts[:-1][solid], cuts[1:][solid]
    return starts, ends, np.diff(np.searchsorted(starts, t.bounds))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``, which are not empty.

    Differences of one running sum of bytes times powers of an odd base, brought to a common power.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    high = len(data) // _SPAN + 1
    far, far_back = _powers(_FAR, high), _powers(_FAR_BACK, high)
    total = np.zeros(len(data) + 1, np.uint64)
    body = total[1:]
    np.take(_BYTE, data, out=body)
    for k in range(high):
        part = body[k * _SPAN : (k + 1) * _SPAN]
        part *= _POWERS[: len(part)]
        part *= far[k]
    np.cumsum(body, out=body)
    value = total[ends] - total[starts]
    value *= _BACK[starts % _SPAN]
    value *= far_back[starts // _SPAN]
    return mix(value + (ends - starts).astype(np.uint64))


def join_hashes(*parts: np.ndarray, seed: int) -> np.ndarray:
    """One hash for several in a row; ``seed`` tells kinds of n-grams apart."""
    total = np.uint64(seed)
    for part, factor in zip(parts, randoms(len(parts), seed), strict=True):
        total = total + part * factor
    return mix(total)


def within(counts: np.ndarray, reach: int) -> np.ndarray:
    """Indices of items that have ``reach`` further items behind them in the same row."""
    left = np.maximum(counts - reach, 0)
    first = np.cumsum(counts) - counts
    return np.arange(left.sum()) + np.repeat(first - (np.cumsum(left) - left), left)


def row_sets(rows: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row in ascending order, and how many each row has."""
    free = max(1, n - 1).bit_length()
    key = (rows.astype(np.uint64) << np.uint64(64 - free)) | (values >> np.uint64(free))
    order = np.argsort(key)
    key, rows, values = key[order], rows[order], values[order]
    if np.any((key[1:] == key[:-1]) & (values[1:] != values[:-1])):  # equal but for the bits left out
        order = np.lexsort((values, rows))
        rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return values[new], np.bincount(rows[new], minlength=n)


def binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column whose rows hold so many of the values each."""
    bounds = np.concatenate(([0], np.cumsum(counts))) * values.itemsize
    body = pa.py_buffer(np.ascontiguousarray(values))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(bounds), body])


def with_columns(
    df: DataFrame, text: str, fields: list[StructField], compute: Callable[[pa.RecordBatch], list[pa.Array]]
) -> DataFrame:
    """The rows with columns that ``compute`` derives from a piece of them.

    A column of the input that has the name of a new one is replaced.
    """
    taken = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in taken]
    positions = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in taken]
    schema = StructType([*kept, *fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                columns = [piece.column(i) for i in positions] + compute(piece)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, schema)
