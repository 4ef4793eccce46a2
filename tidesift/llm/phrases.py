"""Phrases that stand together more often than their parts explain, found by Misra-Gries summaries.

1. Texts are dealt into blocks once. A block counts its n-grams of up to ``words`` words per group (language), exactly,
   by numbers of words, and sends hashes and counts, packed, to ranges of hashes.
2. A range merges the counts of all blocks in a Misra-Gries summary: when it holds more counters than its capacity, the
   largest count beyond the capacity is taken off all, and counters at nothing go. Capacity is over ``SLACK`` times the
   range's mass divided by the threshold, so no more than ``threshold / SLACK`` is taken off any counter in all. What is
   left plus what was taken is no less than the true count: every frequent n-gram survives. Merging order does not matter
   for that, and memory is bounded by the capacity. Each block is told which of its n-grams survive.
3. In the second pass blocks send the survivors as text with their counts, which are added up exactly. Hashes that meet
   only make a survivor of what is not frequent, and that is dropped by its exact count.

Scores, and the phrases inside longer ones, are joins over the frequent n-grams alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidesift.llm import blocks as bl, textbytes as tb
from tidesift.llm.chunks import _distinct
from tidesift.sources.scratch import stage

#: How many times over the least one the capacity is.
SLACK = 4
#: Parts of a group that are ranked by themselves before the group is.
PARTS = 8
#: 0 between words, 2 where also a piece ends.
_KINDS = np.ones(256, np.uint8)
_KINDS[[0x20, 0x09]] = 0
_KINDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


@dataclass(frozen=True)
class Rule:
    """Most words of a phrase, least count, the percentage of its count in a longer phrase that drops it, and rows a group."""

    words: int = 3
    threshold: int = 10
    inside: int = 50
    first: int = 2000


class Grams:
    """The distinct n-grams of one length in a block: first place, count, hash, and of each word place its n-gram or -1."""

    def __init__(self, codes: np.ndarray, places: np.ndarray, n: int):
        found = pa.array(codes).dictionary_encode()
        numbers = found.indices.to_numpy().astype(np.int64)
        self.size = len(found.dictionary)
        self.first = np.empty(self.size, np.int64)
        self.first[numbers[::-1]] = places[::-1]
        self.counts = np.bincount(numbers, minlength=self.size)
        self.at = np.full(n, -1, np.int64)
        self.at[places] = numbers


class Block:
    """Words of a block by number, lower-cased, and its n-grams by length."""

    def __init__(self, table: pa.Table, text: str, group: str, longest: int):
        self.number = int(table["block"][0].as_py())
        t = tb.texts(table[text])
        data = tb.LOWER[t.data]
        kind = _KINDS[data]
        starts, ends, counts = tb.words(tb.Texts(data, t.bounds), (_KINDS == 1).astype(np.uint8))
        row = np.repeat(np.arange(len(counts)), counts)
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts) + row
        self.words, number = _distinct(data[kind == 1], np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64))
        del kind, data, t
        number = number.astype(np.int64)
        self.number_of = number
        groups = table[group].combine_chunks().dictionary_encode()
        self.groups, of_row = groups.dictionary, groups.indices.to_numpy().astype(np.int64)
        self.group = of_row[row]
        self.totals = np.bincount(self.group, minlength=len(self.groups))
        size, n = max(1, len(self.words)), len(number)
        word_hash = _hashes(self.words)
        self.grams = [Grams(self.group * size + number, np.arange(n), n)]
        first = self.grams[0].first
        self.hashes = [tb.join_hashes(_hashes(self.groups)[self.group[first]], word_hash[number[first]], seed=61)]
        for k in range(2, longest + 1):
            before = self.grams[-1]
            places = np.flatnonzero(piece[: n - k + 1] == piece[k - 1 :]) if n >= k else np.zeros(0, np.int64)
            grams = Grams(before.at[places] * size + number[places + k - 1], places, n)
            own = self.hashes[-1][before.at[grams.first]]
            self.hashes.append(tb.join_hashes(own, word_hash[number[grams.first + k - 1]], seed=61 + k))
            before.at = None  # only the next length asks for it
            self.grams.append(grams)

    def phrases(self, k: int, some: np.ndarray) -> pa.Array:
        """Texts of n-grams of ``k`` words by number."""
        first = self.grams[k - 1].first[some]
        parts = [self.words.take(pa.array(self.number_of[first + i])) for i in range(k)]
        return pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())).cast(pa.string())


def _hashes(words: pa.Array) -> np.ndarray:
    """Hashes of texts, the empty one included."""
    t = tb.texts(words)
    full = np.diff(t.bounds) > 0
    out = np.full(len(t), 1, np.uint64)
    out[full] = tb.word_hashes(t.data, t.bounds[:-1][full], t.bounds[1:][full])
    return out


def misra_gries(parts: Iterable[tuple[np.ndarray, np.ndarray]], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted keys, what is left of their counts, and what was taken off at most, from parts with distinct keys.

    A key's true count is between what is left (nothing for a key that went) and that plus what was taken.
    """
    keys, counts, lost = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merge() -> None:
        nonlocal keys, counts, lost
        both = np.concatenate([keys, *[k for k, _ in held]])
        values = np.concatenate([counts, *[c.astype(np.int64) for _, c in held]])
        held.clear()
        order = np.argsort(both, kind="stable")
        both, values = both[order], values[order]
        new = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.zeros(0, np.int64)
        keys, counts = both[new], np.add.reduceat(values, new) if len(new) else values
        if len(keys) > capacity:
            cut = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
            lost += cut
            keys, counts = keys[counts > cut], counts[counts > cut] - cut

    for part in parts:
        held.append(part)
        if sum(len(k) for k, _ in held) > capacity:
            merge()
    merge()
    return keys, counts, lost


def _survivors(table: pa.Table, kind: type, threshold: int) -> pa.Table:
    mass = sum(int(np.frombuffer(c.as_py(), kind).sum(dtype=np.int64)) for c in table["counts"])
    keys, counts, lost = misra_gries(bl.unpacked(table, kind), SLACK * mass // threshold + 1)
    keys = keys[counts + lost >= threshold]
    return bl.mark_table(table, [np.isin(cells, keys) for cells, _ in bl.unpacked(table, kind)])


def frequent(table: DataFrame, text: str, group: Column, rule: Rule = Rule()) -> DataFrame:
    """``grp, words, phrase, n``: all n-grams of up to ``rule.words`` words that occur ``rule.threshold`` times in a group.

    For each group there is a row of 0 words and a null phrase with the number of its words.
    """
    rows = table.select(F.col(text).alias("text"), group.cast("string").alias("grp"), F.xxhash64(*table.columns).alias("spread"))
    dealt, n, total = bl.deal(rows.where("text IS NOT NULL"), "text", F.col("spread"))
    dealt = dealt.select("block", F.col("c0").alias("text"), F.col("c1").alias("grp"))
    bits = bl.bits_for(8 * total)  # some forty cells for each n-gram
    kind = np.uint8 if rule.threshold < 256 else np.uint32
    by_block = dealt.groupBy("block")

    def merged(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cells = np.concatenate(block.hashes) >> np.uint64(64 - bits)
        counts = np.minimum(np.concatenate([g.counts for g in block.grams]), rule.threshold)
        order = np.argsort(cells, kind="stable")
        new = np.concatenate(([True], np.diff(cells[order]) > 0)) if len(order) else np.zeros(0, bool)
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        sums = np.add.reduceat(counts[order], np.flatnonzero(new)) if len(order) else counts
        return cells[order][new], np.minimum(sums, rule.threshold), at

    def counted(own: pa.Table) -> pa.Table:
        block = Block(own, "text", "grp", rule.words)
        cells, counts, _ = merged(block)
        return bl.pack_table(block.number, bl.pack(cells, counts.astype(kind), bl.ranges(cells, bits, n).astype(np.int64)))

    def survivors(packs: pa.Table) -> pa.Table:
        return _survivors(packs, kind, rule.threshold)

    def exact(own: pa.Table, marks: pa.Table) -> pa.Table:
        block = Block(own, "text", "grp", rule.words)
        cells, _, at = merged(block)
        alive = bl.marked(cells, bits, n, bl.answers(marks))[at]
        ends = np.cumsum([g.size for g in block.grams])

        def parts() -> Iterator[pa.Table]:
            none = pa.nulls(len(block.groups), pa.string())
            yield _counts(block.groups, 0, none, block.totals)
            for k, (grams, stop) in enumerate(zip(block.grams, ends, strict=True), 1):
                some = np.flatnonzero(alive[stop - grams.size : stop])
                own_groups = block.groups.take(pa.array(block.group[grams.first[some]]))
                yield _counts(own_groups, k, block.phrases(k, some), grams.counts[some])

        return pa.concat_tables(parts())

    marks = by_block.applyInArrow(counted, bl.PACKS).groupBy("range").applyInArrow(survivors, bl.MARKS)
    found = by_block.cogroup(bl.to_blocks(marks, n)).applyInArrow(exact, "grp string, words int, phrase string, n long")
    sums = found.groupBy("grp", "words", "phrase").agg(F.sum("n").alias("n"))
    return sums.where((F.col("words") == 0) | (F.col("n") >= rule.threshold))


def _counts(groups: pa.Array, words: int, phrases: pa.Array, counts: np.ndarray) -> pa.Table:
    size = len(counts)
    columns = [groups.cast(pa.string()), pa.array(np.full(size, words, np.int32)), phrases, pa.array(counts.astype(np.int64))]
    return pa.table(columns, names=["grp", "words", "phrase", "n"])


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def collocations(table: DataFrame, text: str, group: Column, rule: Rule = Rule()) -> DataFrame:
    """``grp, rank, phrase, a, l, r, n, score``: each group's first phrases by score, then count, then text.

    A-Z are lower-cased; texts are cut into pieces at ``.,;:!?`` and 0x0A to 0x0D, and pieces into words at spaces and
    tabs. Phrases are 2 to ``rule.words`` words in a row of one piece, counted with overlaps, that occur ``threshold``
    times. Of a phrase's cuts into two parts, with counts ``l`` and ``r``, that with the least
    ``floor(1000000 * a * a / (l * r))`` counts, the first of equal ones; products are exact while counts are below
    10**16. A phrase goes if a longer one around it has ``inside`` percent of its count, whether that one goes or not.

    ``group`` may not be null. Null and empty texts have no words, repeated rows count as often as they stand there, an
    empty table has no rows, and other columns, whatever their names, only help to spread the rows.
    """
    counts = stage(frequent(table, text, group, rule), "phrases")
    phrases = counts.where("words >= 2").select("grp", "words", "phrase", F.col("n").alias("a"))
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    head = F.call_function("substring_index", "phrase", F.lit(" "), F.col("k"))
    tail = F.call_function("substring_index", "phrase", F.lit(" "), F.col("k") - F.col("words"))
    parts = counts.where("words >= 1").select("grp", "phrase", "n")
    cut = cut.select("*", head.alias("head"), tail.alias("tail"))
    cut = cut.join(parts.toDF("grp", "head", "l"), ["grp", "head"]).join(parts.toDF("grp", "tail", "r"), ["grp", "tail"])
    whole = {c: F.col(c).cast("decimal(16,0)") for c in "alr"}
    score = _div(whole["a"] * whole["a"] * F.lit(1000000).cast("decimal(7,0)"), whole["l"] * whole["r"])
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cut.groupBy("grp", "words", "phrase", "a").agg(worst)

    at = F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1))
    inner = phrases.where("words >= 3").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1))).withColumn("at", at)
    inner = inner.select("grp", F.array_join(F.slice(F.split("phrase", " "), F.col("at"), F.col("size")), " ").alias("phrase"), "a")
    around = inner.groupBy("grp", "phrase").agg(F.max("a").alias("around"))
    left = scored.join(around, ["grp", "phrase"], "left").where(F.expr(f"NOT coalesce(100 * around >= {rule.inside} * a, false)"))

    # A group's first are among the first of its parts, so that what one task ranks is bounded at any size.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    flat = left.select("grp", "phrase", "a", "cut.l", "cut.r", "cut.score", part.alias("part"))
    order = F.desc("score"), F.desc("a"), "phrase"
    flat = flat.withColumn("rank", F.row_number().over(Window.partitionBy("grp", "part").orderBy(*order))).where(F.col("rank") <= rule.first)
    flat = flat.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(*order))).where(F.col("rank") <= rule.first)
    words = counts.where("words = 0").select("grp", F.col("n"))
    best = flat.join(words, "grp")
    return best.select("grp", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
