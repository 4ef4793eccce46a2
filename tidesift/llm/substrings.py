"""Removal of repeated passages: windows of words that start earlier elsewhere, found behind a count-min prefilter.

1. Texts are dealt into blocks once. A window's anchor is the least of its short n-grams, by hash. Equal windows have
   equal anchors at the same place in them, so an anchor occurs at least as often as any window around it. Anchors are
   about a sixth of all windows.
2. Each block counts its anchors in a sketch of ``DEPTH`` rows; a row has more cells than there are anchors and is kept
   as a sorted list of the cells in use, with counts up to two. Ranges of cells merge the sketches of all blocks by
   adding, and tell each block which of its cells hold two or more. A cell holds the sum of all anchors in it, so what
   is estimated is never too little, and no repeated window is lost.
3. Only windows whose anchor is estimated repeated in all rows are grouped exactly, by 128 bits of hash from words: inside
   the block first, then the first of each group in the block with those of other blocks. All but the first of all are
   repeats, and the words that they cover are removed.

Blocks hold about ``blocks.BLOCK`` bytes of text, ranges what so much text has of cells: both are bounded by the data's
share, and a passage that all documents share counts once a block. One text is never split.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidesift.llm import blocks as bl, textbytes as tb

DEPTH = 2
#: A row id that is null comes after all others.
LAST = np.iinfo(np.int64).max

_SEEDS = tb.randoms(DEPTH + 1, 41)


def least_in(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, the place of its least one, the first of equal ones."""
    best, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = best[:-step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        span += step
    return best


class Block:
    """The rows of a block in the order of their ids, then texts, and their words."""

    def __init__(self, table: pa.Table, id_col: str, text: str):
        order = pc.sort_indices(table.select([id_col, text]), [(id_col, "ascending"), (text, "ascending")], null_placement="at_end")
        self.table = table.take(order).combine_chunks()
        self.texts = tb.texts(self.table[text])
        self.starts, self.ends, self.counts = tb.words(self.texts)
        self.number = int(table["block"][0].as_py())
        self.id_col = id_col


class Windows:
    """Windows of a block by the place of their first word, with anchors and hashes."""

    def __init__(self, block: Block, size: int):
        hashes = tb.word_hashes(block.texts.data, block.starts, block.ends)
        half = (size + 1) // 2
        self.places = tb.within(block.counts, size - 1)
        n = max(0, len(hashes) - half + 1)
        grams, others = (tb.join_hashes(*[hashes[i : i + n] for i in range(half)], seed=s) for s in (51, 52))
        anchor = least_in(grams, size - half + 1)[self.places] if len(self.places) else self.places
        self.anchors, self.anchor_of = np.unique(anchor, return_inverse=True)
        self.grams = grams[self.anchors]  # of each anchor
        self.others, self.tail = others, size - half

    def cells(self, row: int, bits: int) -> np.ndarray:
        return tb.mix(self.grams ^ _SEEDS[row]) >> np.uint64(64 - bits)

    def hashes(self, some: np.ndarray) -> np.ndarray:
        """Of windows by number: both halves, which overlap where the size is odd, cover all words."""
        first = self.places[some]
        return tb.join_hashes(self.others[first], self.others[first + self.tail], seed=53)


def _sketch(block: Block, size: int, bits: int, n: int) -> pa.Table:
    windows = Windows(block, size)

    def packs():
        for row in range(DEPTH):
            cells, counts = np.unique(windows.cells(row, bits), return_counts=True)
            parts = bl.ranges(cells, bits, n).astype(np.int64) + row * n
            yield from bl.pack(cells, np.minimum(counts, 2).astype(np.uint8), parts)

    return bl.pack_table(block.number, packs())


def _merge(table: pa.Table) -> pa.Table:
    """Marks cells that all blocks together have counted twice or more."""
    packs = list(bl.unpacked(table, np.uint8))
    cells, inverse = np.unique(np.concatenate([c for c, _ in packs]), return_inverse=True)
    total = np.bincount(inverse, np.concatenate([n for _, n in packs]), len(cells)) >= 2
    ends = np.cumsum([len(c) for c, _ in packs])
    return bl.mark_table(table, np.split(total[inverse], ends[:-1]))


#: What a block sends on: per range the first windows of their kind in the block, and the places of those it knows as repeats.
_SENT = "block int, range long, known boolean, hashes binary, grams binary, ids binary, places binary"
_SENT_ARROW = {
    "block": pa.int32(), "range": pa.int64(), "known": pa.bool_(), "hashes": pa.binary(), "grams": pa.binary(), "ids": pa.binary(), "places": pa.binary(),
}


def _estimated(block: Block, marks: pa.Table, size: int, bits: int, n: int) -> pa.Table:
    windows, found = Windows(block, size), bl.answers(marks)
    repeated = np.ones(len(windows.anchors), bool)
    for row in range(DEPTH):
        cells, inverse = np.unique(windows.cells(row, bits), return_inverse=True)
        repeated &= bl.marked(cells, bits, n, found, row * n)[inverse]
    some = np.flatnonzero(repeated[windows.anchor_of])
    hashes, grams, places = windows.hashes(some), windows.grams[windows.anchor_of[some]], windows.places[some]
    order = np.lexsort((hashes, grams))  # keeps places in order among equal ones
    first = np.ones(len(order), bool)
    first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (grams[order][1:] != grams[order][:-1])
    known = np.sort(places[order[~first]])
    sent = np.sort(order[first])
    hashes, grams, places = hashes[sent], grams[sent], places[sent]
    ids = block.table[block.id_col].fill_null(LAST).to_numpy().astype(np.int64)
    ids = np.repeat(ids, block.counts)[places]
    parts = (tb.mix(grams ^ _SEEDS[DEPTH]) % np.uint64(n)).astype(np.int64)
    order = np.argsort(parts, kind="stable")
    rows = [(block.number, block.number % n, True, b"", b"", b"", known.astype(np.uint32).tobytes())] if len(known) else []
    cuts = np.flatnonzero(np.diff(parts[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        rows.append((block.number, int(parts[part[0]]), False, hashes[part].tobytes(), grams[part].tobytes(), ids[part].tobytes(), places[part].astype(np.uint32).tobytes()))
    return bl.rows_of(_SENT_ARROW, rows)


def _repeats(table: pa.Table) -> pa.Table:
    """Places of windows that another block has earlier, and those known already, by block."""
    known = table["known"].to_numpy()
    rows = [(b.as_py(), p.as_py()) for b, p, k in zip(table["block"], table["places"], known, strict=True) if k]
    table = table.filter(pa.array(~known))
    if table.num_rows:
        hashes, grams = (np.frombuffer(b"".join(table[c].to_pylist()), np.uint64) for c in ("hashes", "grams"))
        ids = np.frombuffer(b"".join(table["ids"].to_pylist()), np.int64)
        sizes = np.array([len(p.as_py()) // 4 for p in table["places"]])
        places = np.frombuffer(b"".join(table["places"].to_pylist()), np.uint32)
        block = np.repeat(table["block"].to_numpy(), sizes)
        order = np.lexsort((places, block, ids, hashes, grams))
        again = np.zeros(len(order), bool)
        again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (grams[order][1:] == grams[order][:-1])
        late = order[again]
        late = late[np.argsort(block[late], kind="stable")]
        cuts = np.flatnonzero(np.diff(block[late])) + 1
        rows += [(int(block[part[0]]), places[part].tobytes()) for part in np.split(late, cuts) if len(part)]
    return bl.rows_of({"block": pa.int32(), "places": pa.binary()}, rows)


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One text for each row: its words, ``counts`` of them, with single spaces between."""
    sizes = ends - starts + 1  # and a space behind
    stops = np.cumsum(sizes)
    total = int(stops[-1]) if len(stops) else 0
    out = data[np.minimum(np.arange(total) + np.repeat(starts - (stops - sizes), sizes), len(data) - 1)] if total else np.zeros(0, np.uint8)
    out[stops - 1] = 0x20
    last = np.cumsum(counts)[counts > 0] - 1
    keep = np.ones(total, bool)
    keep[stops[last] - 1] = False
    sizes = sizes.copy()
    sizes[last] -= 1
    ends_by_word = np.concatenate(([0], np.cumsum(sizes)))
    bounds = ends_by_word[np.concatenate(([0], np.cumsum(counts)))]
    return pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out[keep])).cast(pa.string())


def _kept(block: Block, repeats: pa.Table, size: int, columns: list[str]) -> pa.Table:
    change = np.zeros(len(block.starts) + 1, np.int64)
    for places in repeats["places"]:
        at = np.frombuffer(places.as_py(), np.uint32).astype(np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + size, -1)
    keep = np.cumsum(change)[:-1] == 0
    row = np.repeat(np.arange(len(block.counts)), block.counts)
    left = np.bincount(row[keep], minlength=len(block.counts))
    text = joined(block.texts.data, block.starts[keep], block.ends[keep], left)
    found = [block.table[c] for c in columns] + [pa.array(block.counts.astype(np.int64)), pa.array((block.counts - left).astype(np.int64)), text]
    return pa.table(found, names=[*columns, "n_words", "n_removed", "kept"])


def remove_repeats(table: DataFrame, id_col: str, text: str, size: int = 20) -> DataFrame:
    """The rows with ``n_words``, ``n_removed`` and ``kept``: the words left, joined by single spaces.

    Words are runs of bytes other than space and 0x09 to 0x0D. A word goes if it is in a window of ``size`` words that
    also starts earlier: in a row with a smaller id, or earlier in the same row. Rows without an id come last. Rows that
    share an id are rows of their own, in an order fixed by their ids and texts; of equal rows, any one is first. A null
    text has no words, texts with fewer than ``size`` words lose none, and an empty table has no rows. The id is an
    integer. Other columns pass through; one with the name of a new column is replaced.
    """
    added = [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())]
    new = {f.name for f in added}
    rows = table.select(*[c for c in table.columns if c.lower() not in new or c in (id_col, text)])
    key = F.xxhash64(F.col(id_col), F.col(text))
    dealt, n, total = bl.deal(rows, text, key)
    i, t = bl.position(rows, id_col), bl.position(rows, text)
    dealt = dealt.withColumn(i, F.col(i).cast("long"))
    bits = bl.bits_for(total)  # over eight cells for each anchor
    columns = [f for f in dealt.columns if f != "block"]
    by_block = dealt.groupBy("block")

    def sketch(own: pa.Table) -> pa.Table:
        return _sketch(Block(own, i, t), size, bits, n)

    def estimated(own: pa.Table, marks: pa.Table) -> pa.Table:
        return _estimated(Block(own, i, t), marks, size, bits, n)

    def kept(own: pa.Table, repeats: pa.Table) -> pa.Table:
        return _kept(Block(own, i, t), repeats, size, columns)

    marks = by_block.applyInArrow(sketch, bl.PACKS).groupBy("range").applyInArrow(_merge, bl.MARKS)
    sent = by_block.cogroup(bl.to_blocks(marks, n)).applyInArrow(estimated, _SENT)
    repeats = sent.groupBy("range").applyInArrow(_repeats, "block int, places binary")
    schema = StructType([*[dealt.schema[c] for c in columns], *added])
    out = by_block.cogroup(bl.to_blocks(repeats, n)).applyInArrow(kept, schema)
    return out.toDF(*rows.columns, *[f.name for f in added])
