"""Terms of many texts counted together inside a task.

Words of some texts are numbered, pairs are numbers of two words, and sorting numbers tells how often and in how many
texts each occurs. A term is spelt out once for all the texts that it was counted over.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

#: Words that are counted together, and terms that are handed on together.
COUNTED, HANDED = 1 << 21, 1 << 17

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _tally(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, in how many rows each is, and how often; rows ascend."""
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order]
    other = np.append(True, key[1:] != key[:-1])
    starts = np.flatnonzero(other)
    rows = np.add.reduceat(other | np.append(True, row[1:] != row[:-1]), starts, dtype=np.int64)
    return key[starts], rows, np.diff(np.append(starts, len(key)))


def _parts(words: pa.ListArray) -> Iterator[pa.ListArray]:
    """Rows with at most so many words together, or a single row."""
    ends = np.cumsum(words.value_lengths().fill_null(0).to_numpy())
    start = 0
    while start < len(words):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + COUNTED, "right")))
        yield words.slice(start, stop - start)
        start = stop


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(term, df, tf)`` of the words, which hold no space, and pairs of neighbours in a column of lists.

    A term comes again for other rows: the sums over all are what it counts.
    """
    for batch in batches:
        for part in _parts(batch.column(0)):
            words = part.flatten().dictionary_encode()
            spelt, code = words.dictionary, words.indices.to_numpy().astype(np.int64)
            if not len(code):
                continue
            row = np.repeat(np.arange(len(part)), part.value_lengths().fill_null(0).to_numpy())
            near = np.flatnonzero(row[1:] == row[:-1])
            pairs = code[near] * len(spelt) + code[near + 1]
            for key, at in ((code, row), (pairs, row[near])):
                if not len(key):
                    continue
                key, rows, times = _tally(key, at)
                for start in range(0, len(key), HANDED):
                    some = slice(start, start + HANDED)
                    if at is row:
                        term = spelt.take(pa.array(key[some]))
                    else:
                        first, second = np.divmod(key[some], len(spelt))
                        term = pc.binary_join_element_wise(spelt.take(pa.array(first)), spelt.take(pa.array(second)), " ")
                    yield pa.RecordBatch.from_arrays([term.cast(pa.string()), pa.array(rows[some]), pa.array(times[some])], names=["term", "df", "tf"])


def last_followers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(word, formal, doc_id, pos)`` of ``(doc_id, words)`` rows: each word with the one behind it, where it is last by id and place.

    Null ids come first. A word comes again for other rows: the last of all is the one that counts.
    """
    for batch in batches:
        done = 0
        for part in _parts(batch.column(1)):
            ids = batch.column(0).slice(done, len(part))
            done += len(part)
            words = part.flatten().dictionary_encode()
            spelt, code = words.dictionary, words.indices.to_numpy().astype(np.int64)
            lengths = part.value_lengths().fill_null(0).to_numpy()
            row = np.repeat(np.arange(len(part)), lengths)
            near = np.flatnonzero(row[1:] == row[:-1])
            if not len(near):
                continue
            pos = near - (np.cumsum(lengths) - lengths)[row[near]]
            rank = pc.rank(ids, "ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
            order = np.lexsort((pos, rank[row[near]], code[near]))
            word = code[near[order]]
            last = order[np.append(word[1:] != word[:-1], True)]
            for start in range(0, len(last), HANDED):
                some = last[start : start + HANDED]
                at = near[some]
                columns = [spelt.take(pa.array(code[at])), spelt.take(pa.array(code[at + 1])), ids.take(pa.array(row[at])), pa.array(pos[some], pa.int32())]
                yield pa.RecordBatch.from_arrays([columns[0].cast(pa.string()), columns[1].cast(pa.string()), *columns[2:]], names=["word", "formal", "doc_id", "pos"])
