"""Benchmark items found in training texts: BM25 over an inverted index of items, with block-max WAND.

Items are cut into parts of at most ``STRIDE`` words, and texts into overlapping windows of two strides, so that a
part lies whole in some window. Every window is a query. A part's BM25 weights are divided by their sum: the score of
a window is the share of the part's weight that its words cover, and one threshold holds for all parts.

Retrieval takes the three tests of block-max WAND for all windows of a piece of text together. A window is dropped
when its terms' largest weights (the pivot test) do not add up to the threshold; a block of postings when its own
largest weights do not; what is left is scored in full. All parts at or above the threshold are retrieved. They are
then verified by the shares of the question's and the answer's word n-grams that the window holds.

A character of a script that is written without blanks (Chinese, Japanese, Thai and the like) is a word. Items of too
few words for that search are found, if asked for, where all their words stand in a run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType

from tidesift.llm.textbytes import SPLIT, join_hashes, texts, with_columns, word_hashes, words
from tidesift.sources.scratch import stage

#: Words of a part at most, and between the starts of windows; parts in a block of postings.
STRIDE, BLOCK = 64, 8
#: Words of an n-gram that verifies.
GRAM = 3
#: Postings of one broadcast index. More items are searched by several, one after the other.
SHARD = 2_000_000
#: Ranges of characters that are words of their own, and of punctuation beyond ASCII, in code points.
SINGLE = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x2E80, 0x2FFF), (0x3003, 0x3007),
    (0x3021, 0x3029), (0x3031, 0x312F), (0x31A0, 0x9FFF), (0xA000, 0xA4CF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
    (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
)
SIGNS = (
    (0x2000, 0x200B), (0x2010, 0x2029), (0x202F, 0x205F), (0x3000, 0x3002), (0x3008, 0x3020), (0x302A, 0x3030),
    (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65),
)
FOUND = "array<struct<item:bigint,score:double,question:double,answer:double>>"


@dataclass(frozen=True)
class Rule:
    """Least share of BM25 weight, least share of n-grams of question and answer, words below which an item says
    nothing, the constants of BM25, and whether n-grams of question and answer count together, not each by themselves."""

    score: float = 0.6
    overlap: float = 0.6
    min_words: int = 8
    k1: float = 1.2
    b: float = 0.75
    whole: bool = False


def _beyond_ascii(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the characters of ``SINGLE`` and ``SIGNS``, and which are of ``SINGLE``."""
    at = np.flatnonzero(data >= 0xE0)  # characters of three or four bytes
    size = 3 + (data[at] >= 0xF0)
    byte = lambda k: data[at + k].astype(np.int64) & 0x3F
    code = ((data[at].astype(np.int64) & 0x0F) << 12) | (byte(1) << 6) | byte(2)
    four = np.flatnonzero(size == 4)
    code[four] = ((code[four] & 0x7FFF) << 6) | (data[at[four] + 3] & 0x3F)
    single, sign = (np.logical_or.reduce([(code >= a) & (code <= b) for a, b in ranges]) for ranges in (SINGLE, SIGNS))
    own = single | sign
    return at[own], (at + size)[own], single[own]


def plain_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, in lower case and without punctuation, and how many each text has."""
    t = texts(pc.utf8_lower(column.cast(pa.large_string())))
    data = t.data
    starts, ends, _ = words(t, SPLIT)
    solid = SPLIT[data[starts]] == 1 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[solid], ends[solid]
    first, last, single = _beyond_ascii(data)
    if len(first):  # cut out of the words that they are in
        starts, ends = np.sort(np.concatenate((starts, first, last))), np.sort(np.concatenate((ends, first, last)))
        full = starts < ends
        starts, ends = starts[full], ends[full]
        place = np.minimum(np.searchsorted(first, starts), len(first) - 1)
        keep = (first[place] != starts) | single[place]
        starts, ends = starts[keep], ends[keep]
    return word_hashes(data, starts, ends), np.diff(np.searchsorted(starts, t.bounds))


def _parts(items: DataFrame, item_id: str, question: str, answer: str | None, rule: Rule) -> DataFrame:
    """``item, words, cut`` of each part; words before ``cut`` are the question's. Items of too few words are one part, cut at -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (q, nq), (a, na) = (plain_words(batch.column(c)) for c in ("question", "answer"))
            qs, as_ = np.split(q, np.cumsum(nq)[:-1]), np.split(a, np.cumsum(na)[:-1])
            out = {"item": [], "words": [], "cut": []}
            for item, x, y in zip(batch.column("item").to_pylist(), qs, as_, strict=True):
                every = np.concatenate((x, y)).view(np.int64)
                if len(every) < rule.min_words:
                    if len(every):
                        for name, value in (("item", item), ("words", every), ("cut", -1)):
                            out[name].append(value)
                    continue
                for at in np.array_split(np.arange(len(every)), -(-len(every) // STRIDE)):
                    out["item"].append(item)
                    out["words"].append(every[at])
                    out["cut"].append(int(np.clip(len(x) - at[0], 0, len(at))))
            types = {"item": pa.int64(), "words": pa.list_(pa.int64()), "cut": pa.int32()}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, types[k]) for k, v in out.items()})

    rows = items.select(
        F.col(item_id).cast("long").alias("item"),
        F.col(question).cast("string").alias("question"),
        (F.col(answer).cast("string") if answer else F.lit(None).cast("string")).alias("answer"),
    )
    parts = rows.where(F.col("question").isNotNull() | F.col("answer").isNotNull())
    parts = parts.mapInArrow(run, "item bigint, words array<bigint>, cut int").distinct()
    return parts.withColumn("part", F.xxhash64("item", "words", "cut"))


@dataclass
class Index:
    """Postings by term, then block, then part, and the n-grams of parts. All by whole arrays."""

    items: list[int | None]  # of each part
    blocks: int
    terms: np.ndarray
    top: np.ndarray  # largest weight of each term
    term_at: np.ndarray  # a term's blocks
    block: np.ndarray
    block_top: np.ndarray
    block_at: np.ndarray  # a block's postings
    part: np.ndarray
    weight: np.ndarray
    grams: np.ndarray
    gram_at: np.ndarray
    gram_part: np.ndarray
    gram_answer: np.ndarray
    sizes: np.ndarray  # distinct n-grams of question and answer by part
    runs: list[int]  # how many words items of too few words have, the hashes of all their words, and the items
    run: np.ndarray
    run_item: list[int | None]


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal keys, and the end."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.append(np.flatnonzero(new), len(keys[0]))


def grams_of(words_: np.ndarray) -> np.ndarray:
    n = len(words_) - GRAM + 1
    return join_hashes(*(words_[k : k + n] for k in range(GRAM)), seed=GRAM) if n > 0 else np.zeros(0, np.uint64)


def run_of(words_: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    m = max(0, len(words_) - n + 1)
    return join_hashes(*(words_[k : k + m] for k in range(n)), seed=2000 + n)


def build(rows: list, postings: list, short: list = ()) -> Index:
    """From rows ``part, item, words, cut``, postings ``part, term, weight`` and rows of items of too few words."""
    rows = sorted(rows, key=lambda r: (len(r["words"]), r["part"]))  # parts of a block are of like lengths
    number = {r["part"]: i for i, r in enumerate(rows)}
    part = np.array([number[p["part"]] for p in postings], np.int64)
    term = np.array([p["term"] for p in postings], np.int64).view(np.uint64)
    weight = np.array([p["weight"] for p in postings], np.float64)
    order = np.lexsort((part, term))
    part, term, weight = part[order], term[order], weight[order]
    block = part // BLOCK
    block_at = _runs(term, block) if len(term) else np.zeros(1, np.int64)
    own = block_at[:-1]
    term_at = _runs(term[own]) if len(term) else np.zeros(1, np.int64)
    block_top = np.maximum.reduceat(weight, own) if len(own) else weight
    found = []
    sizes = np.zeros((len(rows), 2), np.int64)
    for i, r in enumerate(rows):
        g = grams_of(np.array(r["words"], np.int64).view(np.uint64))
        last = np.arange(len(g)) + GRAM - 1
        for side, at in enumerate((last < r["cut"], last >= r["cut"])):
            own_grams = np.unique(g[at])
            sizes[i, side] = len(own_grams)
            found.append((own_grams, np.full(len(own_grams), i), np.full(len(own_grams), side)))
    g, gp, ga = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)
    order = np.argsort(g, kind="stable")
    g, gp, ga = g[order], gp[order], ga[order]
    gram_at = _runs(g) if len(g) else np.zeros(1, np.int64)
    run = np.array([run_of(np.array(r["words"], np.int64).view(np.uint64), len(r["words"]))[0] for r in short], np.uint64)
    by_run = np.argsort(run, kind="stable")
    return Index(
        [r["item"] for r in rows], -(-len(rows) // BLOCK), term[own][term_at[:-1]],
        np.maximum.reduceat(block_top, term_at[:-1]) if len(own) else block_top, term_at, block[own], block_top, block_at,
        part, weight, g[gram_at[:-1]], gram_at, gp, ga, sizes,
        sorted({len(r["words"]) for r in short}), run[by_run], [short[i]["item"] for i in by_run],
    )


def indexes(
    items: DataFrame, item_id: str, question: str, answer: str | None = None, rule: Rule = Rule(), short: bool = False
) -> Iterator[Index]:
    """Indexes of bounded size over all items, with BM25 statistics of all parts of all items that are not short.

    Null and empty items are left out, and those of too few words but for ``short``; equal ones count once.
    """
    every = stage(_parts(items, item_id, question, answer, rule), "parts")
    parts = every.where("cut >= 0")
    runs = every.where("cut < 0") if short else every.limit(0)
    total, mean = parts.agg(F.count("*"), F.avg(F.size("words"))).first()
    more = runs.count()
    if not total + more:
        return
    terms = parts.select("part", F.size("words").alias("n"), F.explode("words").alias("term"))
    terms = terms.groupBy("part", "n", "term").agg(F.count("*").alias("tf"))
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log1p((F.lit(total) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + rule.k1 * (1 - rule.b + rule.b * F.col("n") / mean)
    weighed = terms.join(df, "term").withColumn("weight", idf * F.col("tf") * (rule.k1 + 1) / norm)
    weighed = weighed.withColumn("weight", F.col("weight") / F.sum("weight").over(Window.partitionBy("part")))
    weighed = weighed.select("part", "term", "weight", F.count("*").over(Window.partitionBy("part")).alias("size"))
    weighed = stage(weighed, "postings")
    shards = -(-(weighed.count() + more) // SHARD)
    for k in range(shards):
        own = F.pmod(F.hash("part"), F.lit(shards)) == k
        postings = weighed.where(own).select("part", "term", "weight").collect()
        yield build(parts.where(own).collect(), postings, runs.where(own).select("item", "words").distinct().collect() if more else [])


def _expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of all places from first to last of each row."""
    n = last - first
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[row]


def _lookup(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are in a sorted table, and their places."""
    place = np.searchsorted(table, values)
    known = np.flatnonzero(table[np.minimum(place, len(table) - 1)] == values)
    return known, place[known]


def retrieve(ix: Index, hashes: np.ndarray, counts: np.ndarray, rule: Rule) -> tuple[np.ndarray, ...]:
    """``row, part, score, question, answer`` of all verified parts of all windows of some texts."""
    none = (np.zeros(0, np.int64),) * 2 + (np.zeros(0),) * 3
    if not len(ix.terms) or not len(hashes):
        return none
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    windows = np.maximum(1, -(-counts // STRIDE) - 1)
    first = np.cumsum(windows) - windows
    row_of = np.repeat(np.arange(len(counts)), windows)

    def by_window(at: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct ids of each window, from ids at places of words."""
        rows = np.searchsorted(np.cumsum(counts), at, "right")
        j, last = place[at] // STRIDE, windows[rows] - 1
        own = first[rows] + np.minimum(j, last)
        both = (j >= 1) & (j <= last)
        key = np.concatenate((own * n + ids, (own[both] - 1) * n + ids[both]))
        key = np.unique(key)
        return key // n, key % n

    least = rule.score * (1 - 1e-9)
    win, term = by_window(*_lookup(ix.terms, hashes), len(ix.terms))
    pivot = np.bincount(win, ix.top[term], len(row_of)) >= least
    win, term = win[pivot[win]], term[pivot[win]]
    row, entry = _expand(ix.term_at[term], ix.term_at[term + 1])
    win = win[row]
    cell = win * ix.blocks + ix.block[entry]
    cells, which = np.unique(cell, return_inverse=True)
    alive = (np.bincount(which, ix.block_top[entry], len(cells)) >= least)[which]
    win, entry = win[alive], entry[alive]
    row, posting = _expand(ix.block_at[entry], ix.block_at[entry + 1])
    n = len(ix.items)
    pairs, which = np.unique(win[row] * n + ix.part[posting], return_inverse=True)
    score = np.bincount(which, ix.weight[posting], len(pairs))
    pairs, score = pairs[score >= least], score[score >= least]
    if not len(pairs) or not len(ix.grams):
        return none
    grams = grams_of(hashes)
    inside = place[: len(grams)] + GRAM <= np.repeat(counts, counts)[: len(grams)]  # of one text
    at, gram = _lookup(ix.grams, grams)
    keep = inside[at]
    win, gram = by_window(at[keep], gram[keep], len(ix.grams))
    row, hit = _expand(ix.gram_at[gram], ix.gram_at[gram + 1])
    key = win[row] * n + ix.gram_part[hit]
    known = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
    mine = pairs[known] == key
    seen = np.zeros((len(pairs), 2))
    np.add.at(seen, (known[mine], ix.gram_answer[hit][mine]), 1)
    part = pairs % n
    share = np.where(ix.sizes[part] > 0, seen / np.maximum(ix.sizes[part], 1), 1.0)
    least = seen.sum(1) >= rule.overlap * (1 - 1e-9) * ix.sizes[part].sum(1) if rule.whole else (share >= rule.overlap).all(1)
    good = np.flatnonzero(least)
    return row_of[pairs // n][good], part[good], np.minimum(score, 1)[good], share[good, 0], share[good, 1]


def retrieve_runs(ix: Index, hashes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int | None]]:
    """``row, item`` of the short items of which all words stand in a run, each once."""
    if not len(ix.run):
        return
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(hashes))  # words up to the end of the text
    rows = np.repeat(np.arange(len(counts)), counts)
    for n in ix.runs:
        at, _ = _lookup(ix.run, own := run_of(hashes, n))
        at = at[left[at] >= n]
        if not len(at):
            continue
        row, found = np.unique(np.stack([rows[at].astype(np.uint64), own[at]]), axis=1)
        first, last = np.searchsorted(ix.run, found), np.searchsorted(ix.run, found, "right")
        which, place = _expand(first, last)
        for r, i in zip(row[which].tolist(), place.tolist(), strict=True):
            yield r, ix.run_item[i]


def search(df: DataFrame, text: str, index: Index, out: str, rule: Rule = Rule()) -> DataFrame:
    """The rows with the items found in their whole text, best window and part of each, by item."""
    shared = df.sparkSession.sparkContext.broadcast(index)  # at most SHARD postings
    kind = StructType.fromDDL(f"x {FOUND}")["x"].dataType

    def compute(piece: pa.RecordBatch) -> list[pa.Array]:
        ix: Index = shared.value
        hits: list[dict] = [{} for _ in range(piece.num_rows)]
        words_ = plain_words(piece.column(text))
        found = retrieve(ix, *words_, rule)
        for row, part, *rest in zip(*(x.tolist() for x in found), strict=True):
            own, item = hits[row], ix.items[part]
            if item not in own or rest > own[item]:
                own[item] = rest
        for row, item in retrieve_runs(ix, *words_):
            hits[row][item] = [1.0, 1.0, 1.0]
        names = ("score", "question", "answer")
        rows = [
            [{"item": item, **dict(zip(names, rest, strict=True))} for item, rest in sorted(h.items(), key=lambda x: (x[0] is None, x[0] or 0))]
            for h in hits
        ]
        made = pa.struct([("item", pa.int64()), *((name, pa.float64()) for name in names)])
        return [pa.array(rows, pa.list_(made))]

    return with_columns(df, text, [StructField(out, kind)], compute)


def find(
    df: DataFrame, text: str, items: DataFrame, item_id: str, question: str, answer: str | None = None, out: str = "leaks", rule: Rule = Rule(),
    short: bool = False,
) -> DataFrame:
    """The rows with a list ``out`` of the items that their whole text holds; empty for clean, null and empty texts.

    Repeated rows get equal lists. A column named like the new one is replaced; other columns pass through. Without
    items every list is empty. An item without an id is listed under null. Items of fewer words than the rule's are
    searched with ``short`` only, and found where all their words stand in a run.
    """
    columns = []
    for k, index in enumerate(indexes(items, item_id, question, answer, rule, short)):
        columns.append(f"__leaks_{k}")
        df = search(df, text, index, columns[-1], rule)
    found = F.concat(*columns) if columns else F.array().cast(FOUND)
    return df.withColumn(out, F.array_distinct(found)).drop(*columns)


def split_answer(items: DataFrame, text: str) -> DataFrame:
    """``question`` and ``answer`` of items in one text: the answer is the last sentence, if there are several."""
    cut = F.regexp_extract(F.col(text), r"(?s)^(.*[.!?])\s+(\S.*)$", 1)
    rest = F.regexp_extract(F.col(text), r"(?s)^(.*[.!?])\s+(\S.*)$", 2)
    one = (cut == "") | cut.isNull()
    return items.withColumn("question", F.when(one, F.col(text)).otherwise(cut)).withColumn("answer", F.when(~one, rest))
