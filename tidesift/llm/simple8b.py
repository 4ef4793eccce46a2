"""Simple-8b: varying counts of whole numbers in 64-bit words, coded and decoded by whole arrays.

The top four bits of a word select how many numbers of how many bits follow. Selector 15 is the escape: the next word
is one number of up to 64 bits. Numbers are coded in groups of ``GROUP``, which start at a word of their own; the
words of each group are counted, so groups are decoded apart or all at once.
"""

from __future__ import annotations

import numpy as np

GROUP = 1024
#: Selector: numbers in a word, bits of each.
LAYOUTS = [(120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15),
           (3, 20), (2, 30), (1, 60)]
ESCAPE = 15
_COUNTS = np.array([n for n, _ in LAYOUTS] + [1])


_SMALL = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    if values.max() < len(_SMALL):
        return _SMALL[values]
    bits = np.zeros(values.shape, np.uint8)
    rest = values.copy()
    for step in (32, 16, 8, 4, 2, 1):
        large = rest >> np.uint64(step) != 0
        bits[large] += step
        rest[large] >>= np.uint64(step)
    return bits + (rest != 0).astype(np.uint8)


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For each place the layout that holds most of the numbers from there on, within its row."""
    width = bits.shape[1]
    best = np.where(bits <= 60, 14, ESCAPE).astype(np.uint8)
    reach = {1: bits}
    for k in (1, 2, 4, 8, 16, 32):
        reach[2 * k] = np.full_like(bits, 255)
        reach[2 * k][:, : width - k] = np.maximum(reach[k][:, : width - k], reach[k][:, k:])
    for selector in range(13, -1, -1):
        n, size = LAYOUTS[selector]
        k = 1 << (n.bit_length() - 1)
        most = np.full_like(bits, 255)
        if width >= n:
            most[:, : width - n + 1] = np.maximum(reach[k][:, : width - n + 1], reach[k][:, n - k : width - k + 1])
        np.copyto(best, np.uint8(selector), where=most <= size)
    return best


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all numbers, and the number of words of each group."""
    values = values.astype(np.uint64)
    groups = -(-len(values) // GROUP)
    if not groups:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    padded = np.zeros(groups * GROUP, np.uint64)
    padded[: len(values)] = values
    bits = _bit_lengths(padded)
    bits[len(values) :] = 255  # nothing reaches beyond the end
    chosen = _selectors(bits.reshape(groups, GROUP))
    length = np.full(groups, GROUP)
    length[-1] = len(values) - (groups - 1) * GROUP
    place, rows = np.zeros(groups, np.int64), np.arange(groups)
    steps = []
    while len(rows):  # all groups together, a word of each at a time
        selector = chosen[rows, place]
        steps.append((rows, rows * GROUP + place, selector))
        place = place + _COUNTS[selector]
        left = place < length[rows]
        rows, place = rows[left], place[left]
    rows, start, selector = (np.concatenate(x) for x in zip(*steps, strict=True))
    order = np.argsort(rows, kind="stable")
    rows, start, selector = rows[order], start[order], selector[order]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s, (n, size) in enumerate(LAYOUTS):
        own = np.flatnonzero(selector == s)
        if size and len(own):
            parts = padded[start[own][:, None] + np.arange(n)] << (np.arange(n, dtype=np.uint64) * np.uint64(size))
            words[own] |= np.bitwise_or.reduce(parts, 1)
    per_group = np.bincount(rows, minlength=groups)
    escaped = np.flatnonzero(selector == ESCAPE)
    if len(escaped):
        words = np.insert(words, escaped + 1, padded[start[escaped]])
        per_group += np.bincount(rows[escaped], minlength=groups)
    return words, per_group


def decode(words: np.ndarray) -> np.ndarray:
    """All numbers of some words, which start at a group."""
    if not len(words):
        return np.zeros(0, np.uint64)
    top = (words >> np.uint64(60)).astype(np.int64)
    marked = top == ESCAPE
    raw = np.zeros(len(words), bool)
    if marked.any():  # in a run of words that look like escapes, each second one is the number of the one before
        at = np.flatnonzero(marked)
        new = np.ones(len(at), bool)
        new[1:] = np.diff(at) > 1
        first = at[np.flatnonzero(new)[np.cumsum(new) - 1]]
        raw[at[(at - first) % 2 == 0] + 1] = True
    counts = _COUNTS[top]
    counts[raw] = 0
    place = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s, (n, size) in enumerate(LAYOUTS):
        own = np.flatnonzero((top == s) & ~raw)
        if size and len(own):
            mask = np.uint64((1 << size) - 1)
            out[place[own][:, None] + np.arange(n)] = words[own][:, None] >> (np.arange(n, dtype=np.uint64) * np.uint64(size)) & mask
    escaped = np.flatnonzero(marked & ~raw)
    out[place[escaped]] = words[escaped + 1]
    return out
