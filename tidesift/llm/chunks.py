"""Texts cut where no token can cross, the distinct cuts of many texts, and what is remembered of them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidesift.llm.textbytes import PLAIN, texts

#: White space, beyond the ASCII kinds, that one engine or another counts as such.
ODD_SPACE = (
    r"[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
)

#: Bytes of text whose distinct chunks are looked up together.
PIECE = 8 << 20
#: Bounds on the chunks that a Python worker remembers, and on their bytes.
REMEMBERED, REMEMBERED_BYTES = 1_000_000, 64 << 20
#: Slices that ``spread`` puts in place at once, and new chunks that are encoded at once.
SPREAD, ENCODED = 1 << 16, 1 << 14


def _distinct(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    buffers = [pa.py_buffer(np.ascontiguousarray(x)) for x in (offsets, data)]
    found = pa.LargeStringArray.from_buffers(len(offsets) - 1, *buffers).dictionary_encode()
    return found.dictionary, found.indices.to_numpy()


def by_space(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Cuts before each run of spaces; the space at a cut is left out.

    Returns the distinct chunks, the chunks of all texts in order by number, and how many each text has. A text's
    chunks joined by single spaces are the text; an empty text has none.
    """
    t = texts(column)
    space = t.data == 0x20
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    full = np.diff(t.bounds) > 0
    heads = t.bounds[:-1][full]
    cut[heads] = False
    starts = np.sort(np.concatenate((heads, np.flatnonzero(cut))))
    at_cut = cut[starts]
    offsets = starts - (np.cumsum(at_cut) - at_cut)
    body = t.data[~cut]
    chunks, codes = _distinct(body, np.append(offsets, len(body)).astype(np.int64))
    return chunks, codes, np.diff(np.searchsorted(starts, t.bounds))


def by_word(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Cuts before each run of white space, which leads the next chunk.

    A chunk is thus white space and then none, whole text otherwise. Texts with rarer kinds of white space, on which
    engines differ, are one chunk. Returns as ``by_space``; a text's chunks joined are the text.
    """
    t = texts(column)
    space = PLAIN[t.data] == 0
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    odd = pc.fill_null(pc.match_substring_regex(column, ODD_SPACE), False).to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(odd):
        cut[t.bounds[i] : t.bounds[i + 1]] = False
    cut[t.bounds[:-1][np.diff(t.bounds) > 0]] = True
    starts = np.flatnonzero(cut)
    chunks, codes = _distinct(t.data, np.append(starts, len(t.data)).astype(np.int64))
    return chunks, codes, np.diff(np.searchsorted(starts, t.bounds))


def spread(values: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Concatenation of the slices that the codes name; slice ``i`` of the values has ``sizes[i]`` of them.

    Places are made for some codes at a time: those of all would take many times the bytes of the result.
    """
    first = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes[codes].sum()), values.dtype)
    at = 0
    for start in range(0, len(codes), SPREAD):
        some = codes[start : start + SPREAD]
        size = sizes[some]
        ends = np.cumsum(size)
        out[at : at + ends[-1]] = values[np.arange(ends[-1]) + np.repeat(first[some] - (ends - size), size)]
        at += ends[-1]
    return out


class ChunkMemory:
    """Ids of chunks seen before, so that ``encode`` sees each distinct chunk once while it is remembered.

    ``encode`` gives the ids of all given chunks, one after the other, and how many each has. Past a bound, chunks that
    were asked for once are forgotten, and of others those asked for least.
    """

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], most: int | None = None):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.chunks = pa.array([], pa.large_string())
        self.ids, self.sizes, self.hits = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def find(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks, one after the other, and how many each has."""
        chunks = chunks.cast(pa.large_string())
        at = pc.fill_null(pc.index_in(chunks, value_set=self.chunks), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            unknown = chunks.take(pa.array(new))
            ids, sizes = self.encode(unknown)
            at[new] = len(self.sizes) + np.arange(len(new))
            self.chunks = pa.concat_arrays([self.chunks, unknown])
            self.ids, self.sizes = np.concatenate((self.ids, ids.astype(np.uint32))), np.concatenate((self.sizes, sizes))
            self.hits = np.concatenate((self.hits, np.zeros(len(new), np.int64)))
        self.hits[at] += 1
        found = spread(self.ids, self.sizes, at), self.sizes[at]
        if len(self.chunks) > (self.most or REMEMBERED) or self.chunks.nbytes > REMEMBERED_BYTES:
            self._forget()
        return found

    def _forget(self) -> None:
        most = (self.most or REMEMBERED) // 2
        kept = np.flatnonzero(self.hits > 1)
        if len(kept) > most:
            kept = np.sort(kept[np.argpartition(-self.hits[kept], most)[:most]])
        self.chunks, self.ids = self.chunks.take(pa.array(kept)), spread(self.ids, self.sizes, kept)
        # Halved, so that what was frequent long ago does not stay for ever.
        self.sizes, self.hits = self.sizes[kept], self.hits[kept] // 2
        if self.chunks.nbytes > REMEMBERED_BYTES // 2:
            self._clear()
