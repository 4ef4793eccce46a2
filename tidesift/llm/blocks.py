"""Rows dealt into blocks, and packed lists of cells that blocks send to ranges of cells and get marks back for.

A block is a bounded share of all texts, the same rows in the same order whenever it is looked at. What a block holds
(n-grams) is counted by cell, a hash cut to some bits. Its cells go, sorted and packed, to ranges of cells, where the
packs of all blocks meet; a range answers each block with one mark per cell. So hot cells count once a block, and
neither texts nor answers pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Bytes of text in a block, and blocks up to which each is a partition of its own.
BLOCK, ALONE = 8 << 20, 4096

PACKS = "block int, range long, cells binary, counts binary"
MARKS = "block int, range long, marks binary"


def partitions(blocks: int) -> int:
    return blocks if blocks <= ALONE else max(ALONE, blocks // 16)


def to_blocks(df: DataFrame, blocks: int):
    """What is sent to blocks, grouped by them and dealt as they are, so that texts need not move again to meet it."""
    return df.repartition(partitions(blocks), "block").groupBy("block")


def deal(rows: DataFrame, text: str, key: Column) -> tuple[DataFrame, int, int]:
    """The rows with a column ``block``, together by it; the number of blocks, and the bytes of all texts.

    Other columns are renamed ``c0``, ``c1`` and so on, so that any name can pass.
    """
    total = rows.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK))
    dealt = rows.select(F.pmod(key, F.lit(blocks)).cast("int"), "*").toDF("block", *[f"c{i}" for i in range(len(rows.columns))])
    return dealt.repartition(partitions(blocks), "block"), blocks, total


def position(df: DataFrame, column: str) -> str:
    """The name that ``deal`` gives a column."""
    return f"c{[c.lower() for c in df.columns].index(column.lower())}"


def bits_for(n: int) -> int:
    """Bits of a cell so that there are at least ``n`` cells."""
    return min(62, max(8, int(n - 1).bit_length()))


def ranges(cells: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The range, of ``n``, that each cell is in; later cells are in later ranges."""
    return cells // np.uint64(-(-(1 << bits) // n))


def pack(cells: np.ndarray, counts: np.ndarray, parts: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """``(range, cells, counts)`` of sorted distinct cells: steps from one to the next in as few bytes as all fit in."""
    cuts = np.flatnonzero(parts[1:] != parts[:-1]) + 1
    for s, e in zip([0, *cuts], [*cuts, len(cells)], strict=True):
        if e > s:
            steps = np.diff(cells[s:e], prepend=np.uint64(0))
            body = steps[1:]
            most = int(body.max(initial=0))
            kind = np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64
            yield int(parts[s]), cells[s : s + 1].tobytes() + body.astype(kind).tobytes(), counts[s:e].tobytes()


def unpack(cells: bytes, n: int) -> np.ndarray:
    """``n`` cells again."""
    size = (len(cells) - 8) // max(1, n - 1)
    steps = np.frombuffer(cells, f"u{size}", n - 1, 8) if n > 1 else np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    out[0] = np.frombuffer(cells, np.uint64, 1)[0]
    out[1:] = steps
    return np.cumsum(out, dtype=np.uint64)


def unpacked(table: pa.Table, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells and counts of each pack."""
    for cells, counts in zip(table["cells"], table["counts"], strict=True):
        n = np.frombuffer(counts.as_py(), kind)
        yield unpack(cells.as_py(), len(n)), n


def marked(cells: np.ndarray, bits: int, n: int, answers: dict[int, bytes], first: int = 0) -> np.ndarray:
    """For each of a block's sorted distinct cells, whether its range has marked it."""
    parts = ranges(cells, bits, n).astype(np.int64) + first
    out = np.zeros(len(cells), bool)
    cuts = np.flatnonzero(parts[1:] != parts[:-1]) + 1
    for s, e in zip([0, *cuts], [*cuts, len(cells)], strict=True):
        if e > s:
            out[s:e] = np.unpackbits(np.frombuffer(answers[int(parts[s])], np.uint8), count=e - s)
    return out


def answers(table: pa.Table) -> dict[int, bytes]:
    return {r.as_py(): m.as_py() for r, m in zip(table["range"], table["marks"], strict=True)}


def rows_of(columns: dict[str, pa.DataType], rows: list[tuple]) -> pa.Table:
    kinds = list(columns.items())
    return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(kinds)})


def pack_table(block: int, packs: Iterator[tuple[int, bytes, bytes]]) -> pa.Table:
    rows = [(block, *p) for p in packs]
    return rows_of({"block": pa.int32(), "range": pa.int64(), "cells": pa.binary(), "counts": pa.binary()}, rows)


def mark_table(table: pa.Table, marks: list[np.ndarray]) -> pa.Table:
    packed = pa.array([np.packbits(m).tobytes() for m in marks], pa.binary())
    return pa.table({"block": table["block"], "range": table["range"], "marks": packed})
