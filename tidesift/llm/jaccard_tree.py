"""Sets of word n-grams joined by Jaccard similarity, with signature trees.

1. Equal sets are one class. A class keeps the n-grams of its prefix (two sets that are similar enough share one of
   them, whatever the order of n-grams), and a signature: a bitmap of all its n-grams. The order puts n-grams that
   a fixed table of counts holds for frequent last, which keeps them out of prefixes and never changes a result.
2. Classes that share a prefix n-gram form a cell; cells with the same classes are one. Large cells are dealt out as
   pairs of blocks.
3. In a cell the classes are the leaves of a signature tree, sorted by size. Inner nodes hold the OR of bitmaps and
   the range of sizes. A dual traversal drops pairs of nodes whose largest possible overlap is too small.
4. Bitmaps of long sets are nearly full. Their pairs must also pass a bound on the overlap from how many n-grams
   fall into each of some bins, before they leave the cell, and of more bins afterwards.
5. What is left is verified on the whole sets. The first traversal pairs each class of a larger cell with one
   other, that with the largest possible overlap, so that a group of copies is joined by about as many links as it
   has members; the second runs over what is still in different components, and leaves nothing out.

No table that is joined is bounded, and Spark sizes exploded ones by the files below them, far too low. So joins are
told to merge: none may broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidesift.llm.components import components
from tidesift.llm.textbytes import LOWER, Texts, binaries, join_hashes, mix, pieces, row_sets, texts, within, word_hashes, words
from tidesift.sources.scratch import stage

#: Bits of a signature; places in the table of counts; bits of the filter for ids.
SIGNATURE, COUNTERS, FILTER = 1024, 1 << 20, 1 << 22
#: Bins of long sets that go with them to cells.
COARSE = 256
#: Classes in a leaf, children of a node, most classes of a cell in one task, and pairs compared at a time.
LEAF, FAN, BLOCK, STEP = 16, 8, 4096, 1 << 16
#: Pairs that a task holds to drop repeated ones.
HELD = 1 << 20
#: Partners of a class whose sets are compared in one task.
SLOT = 64


@dataclass(frozen=True)
class Rule:
    """Words in an n-gram, and the least similarity in hundredths."""

    words: int = 5
    percent: int = 80

    def overlap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Fewest common n-grams with which sets of these sizes are similar enough."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def prefix(self, size: np.ndarray) -> np.ndarray:
        return size + (-self.percent * size // 100) + 1


def sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct n-grams of each text in ascending order, and how many each has.

    A-Z is lower-cased. A text with fewer words has all of them as its only n-gram; one without words has none.
    """
    t = texts(column)
    t = Texts(LOWER[t.data], t.bounds)
    starts, ends, counts = words(t)
    hashes = word_hashes(t.data, starts, ends)
    rows = np.repeat(np.arange(len(t)), counts)
    first = within(counts, n - 1)
    grams, owners = [join_hashes(*(hashes[first + k] for k in range(n)), seed=n)], [rows[first]]
    begin = np.cumsum(counts) - counts
    for k in range(1, n):
        short = np.flatnonzero(counts == k)
        grams.append(join_hashes(*(hashes[begin[short] + i] for i in range(k)), seed=1000 + k))
        owners.append(short)
    return row_sets(np.concatenate(owners), np.concatenate(grams), len(t))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([np.uint64(0)], np.cumsum(values, dtype=np.uint64)))
    bounds = np.concatenate(([0], np.cumsum(counts)))
    return total[bounds[1:]] - total[bounds[:-1]]


def fingerprints(grams: np.ndarray, counts: np.ndarray) -> pa.Array:
    """16 bytes that tell sets apart; null for an empty one."""
    out = np.stack([mix(_sums(mix(grams ^ np.uint64(k)), counts) + counts.astype(np.uint64)) for k in (1, 2)], 1)
    return pa.array([x.tobytes() if n else None for x, n in zip(out, counts.tolist(), strict=True)], pa.binary())


def _counter(grams: np.ndarray) -> np.ndarray:
    return (mix(grams) >> np.uint64(44)).astype(np.int64)


def frequency_levels(docs: DataFrame, text: str, rule: Rule) -> np.ndarray:
    """For each counter, by how many half powers of two it exceeds the mean; 0 for most. Of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(COUNTERS, np.int64), 0
        for batch in batches:
            for piece in pieces(batch, text):
                grams, _ = sets(piece.column(text), rule.words)
                count += np.bincount(_counter(grams), minlength=COUNTERS)
                total += len(grams)
        hot = np.flatnonzero(count >= max(8, 3 * total / COUNTERS))
        yield pa.RecordBatch.from_pydict({"place": np.append(hot, -1), "n": np.append(count[hot], total)})

    found = docs.select(text).mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    counts = dict(zip(found["place"].tolist(), found["n"].tolist(), strict=True))
    mean = max(1.0, counts.pop(-1, 0) / COUNTERS)
    levels = np.zeros(COUNTERS, np.uint8)
    for place, n in counts.items():
        levels[place] = min(255, max(0, int(2 * np.log2(n / mean))) + 1)
    return levels


def signatures(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A bitmap for each row."""
    rows = np.repeat(np.arange(len(counts)), counts)
    bits = np.zeros((len(counts), SIGNATURE), bool)
    bits[rows, (grams >> np.uint64(5)).astype(np.int64) % SIGNATURE] = True
    return np.packbits(bits, axis=1)


def histograms(grams: np.ndarray, counts: np.ndarray) -> pa.Array:
    """How many n-grams of a set fall into each of ``SIGNATURE`` bins, 255 at most; null for sets that are not long."""
    rows = np.repeat(np.arange(len(counts)), counts)
    long = np.flatnonzero(counts > SIGNATURE)
    at = np.full(len(counts), -1)
    at[long] = np.arange(len(long))
    keep = at[rows] >= 0
    bins = (grams[keep] >> np.uint64(5)).astype(np.int64) % SIGNATURE
    made = np.bincount(at[rows[keep]] * SIGNATURE + bins, minlength=len(long) * SIGNATURE).reshape(-1, SIGNATURE)
    out: list[bytes | None] = [None] * len(counts)
    for row, content in zip(long.tolist(), np.minimum(made, 255).astype(np.uint8), strict=True):
        out[row] = content.tobytes()
    return pa.array(out, pa.binary())


def coarse(bins: pa.Array) -> pa.Array:
    """Histograms of ``COARSE`` bins, 255 at most in each, from those of ``SIGNATURE``."""
    full = [b.as_py() for b in bins]
    sums = {i: np.frombuffer(b, np.uint8).reshape(-1, COARSE).sum(0, dtype=np.int64) for i, b in enumerate(full) if b is not None}
    return pa.array([np.minimum(sums[i], 255).astype(np.uint8).tobytes() if i in sums else None for i in range(len(full))], pa.binary())


def profiles(docs: DataFrame, doc_id: str, text: str, rule: Rule) -> DataFrame:
    """``doc_id, size, print, prefix, bits, bins, coarse`` of each row; an empty set has neither print nor prefix."""
    spark = docs.sparkSession
    levels = spark.sparkContext.broadcast(frequency_levels(docs, text, rule))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                grams, counts = sets(piece.column("text"), rule.words)
                rows = np.repeat(np.arange(len(counts)), counts)
                order = np.lexsort((grams, levels.value[_counter(grams)], rows))
                place = np.arange(len(grams)) - np.repeat(np.cumsum(counts) - counts, counts)
                keep = place < rule.prefix(counts)[rows]
                chosen = grams[order][keep]
                size = np.bincount(rows[keep], minlength=len(counts))
                bits, bins = signatures(grams, counts), histograms(grams, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"), pa.array(counts), fingerprints(grams, counts),
                        pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(chosen.view(np.int64))),
                        binaries(bits.reshape(-1), np.full(len(bits), bits.shape[1])).cast(pa.binary()),
                        bins, coarse(bins),
                    ],
                    names=["doc_id", "size", "print", "prefix", "bits", "bins", "coarse"],
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, size long, print binary, prefix array<long>, bits binary, bins binary, coarse binary")


@dataclass
class Level:
    """Nodes of a tree: OR of bitmaps, ranges of sizes and components, most bits lost to collisions, first child."""

    bits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    last: np.ndarray
    lost: np.ndarray
    start: np.ndarray
    stop: np.ndarray


def _count(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(bits).view(np.uint64)).sum(-1, dtype=np.int64)


def _parents(level: Level, fan: int) -> Level:
    at = np.arange(0, len(level.low), fan)
    return Level(
        np.bitwise_or.reduceat(level.bits, at), np.minimum.reduceat(level.low, at), np.maximum.reduceat(level.high, at),
        np.minimum.reduceat(level.first, at), np.maximum.reduceat(level.last, at), np.maximum.reduceat(level.lost, at),
        at, np.minimum(at + fan, len(level.low)),
    )


def _possible(x: Level, a: np.ndarray, b: np.ndarray, rule: Rule) -> np.ndarray:
    """Whether anything below two nodes of a level can be similar enough and is not joined yet."""
    fit = (100 * x.high[a] >= rule.percent * x.low[b]) & (100 * x.high[b] >= rule.percent * x.low[a])
    fit &= ~((x.first[a] == x.last[a]) & (x.first[b] == x.last[b]) & (x.first[a] == x.first[b]))
    at = np.flatnonzero(fit)
    for i in range(0, len(at), STEP):
        own = at[i : i + STEP]
        p, q = a[own], b[own]
        most = _count(x.bits[p] & x.bits[q]) + np.minimum(x.lost[p], x.lost[q])
        most = np.minimum(most, np.minimum(x.high[p], x.high[q]))
        fit[own] = most >= rule.overlap(x.low[p], x.low[q])
    return fit


def _expand(x: Level, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of pairs of nodes; a node with itself gives each pair once."""
    na, nb = x.stop[a] - x.start[a], x.stop[b] - x.start[b]
    total = na * nb
    row = np.repeat(np.arange(len(a)), total)
    place = np.arange(len(row)) - np.repeat(np.cumsum(total) - total, total)
    p, q = x.start[a][row] + place // nb[row], x.start[b][row] + place % nb[row]
    keep = (a[row] != b[row]) | (p <= q)
    return p[keep], q[keep]


def traverse(leaves: Level, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of classes of one cell, sorted by size, that the bounds of the signature tree leave possible."""
    levels = [leaves]
    fan = LEAF
    while len(levels[-1].low) > 1:
        levels.append(_parents(levels[-1], fan))
        fan = FAN
    a = b = np.zeros(1, np.int64)
    for k in range(len(levels) - 1, 0, -1):
        found = [(a[:0], b[:0])]
        for i in range(0, len(a), STEP // (LEAF * LEAF)):
            p, q = _expand(levels[k], a[i : i + STEP // (LEAF * LEAF)], b[i : i + STEP // (LEAF * LEAF)])
            if k == 1:
                p, q = p[p != q], q[p != q]
            fit = _possible(levels[k - 1], p, q, rule)
            found.append((p[fit], q[fit]))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return (a, b) if len(levels) > 1 else (a[:0], b[:0])


def _leaves(size: np.ndarray, group: np.ndarray, bits: np.ndarray) -> Level:
    return Level(bits, size, size, group, group, size - _count(bits), size, size)


class _Bound:
    """The largest possible overlap of pairs of rows: by bitmaps, and of two long sets by bins too."""

    def __init__(self, size: np.ndarray, leaves: Level, bins: pa.ChunkedArray):
        self.size, self.leaves = size, leaves
        long = [b.as_py() for b in bins]
        self.at = np.full(len(size), -1)
        has = np.flatnonzero([b is not None for b in long])
        self.at[has] = np.arange(len(has))
        self.bins = np.frombuffer(b"".join(long[i] for i in has), np.uint8).reshape(-1, COARSE)
        self.rest = size[has] - self.bins.sum(1, dtype=np.int64)  # n-grams over what a bin can count

    def most(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        out = np.minimum(self.size[p], self.size[q])
        for i in range(0, len(p), STEP):
            a, b = p[i : i + STEP], q[i : i + STEP]
            own = _count(self.leaves.bits[a] & self.leaves.bits[b]) + np.minimum(self.leaves.lost[a], self.leaves.lost[b])
            x, y = self.at[a], self.at[b]
            long = np.flatnonzero((x >= 0) & (y >= 0))
            x, y = x[long], y[long]
            shared = np.minimum(self.bins[x], self.bins[y]).sum(1, dtype=np.int64) + np.minimum(self.rest[x], self.rest[y])
            own[long] = np.minimum(own[long], shared)
            out[i : i + STEP] = np.minimum(out[i : i + STEP], own)
        return out


def _cell_pairs(rule: Rule, forest: bool):
    """Pairs of a task's cells, whose rows come sorted by cell and size."""

    def pairs(rows: pa.Table) -> pa.Table:
        cell = np.stack([rows.column(c).to_numpy() for c in ("token", "i", "j")], 1)
        new = np.ones(len(cell), bool)
        new[1:] = (cell[1:] != cell[:-1]).any(1)
        bounds = np.append(np.flatnonzero(new), len(cell))
        ids, size, group, side = (rows.column(c).to_numpy() for c in ("id", "size", "root", "side"))
        bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint8).reshape(len(cell), -1)
        whole = _leaves(size, group, bits)
        bound = _Bound(size, whole, rows.column("coarse"))
        counts = np.diff(bounds)
        small = counts <= LEAF  # a tree of one leaf: all its pairs, many cells together
        begin = bounds[:-1][small]
        out = []
        for i in range(0, len(begin), STEP // (LEAF * LEAF) * 4):
            b0, n = begin[i : i + STEP // (LEAF * LEAF) * 4], counts[small][i : i + STEP // (LEAF * LEAF) * 4]
            both = Level(*[None] * 6, start=b0, stop=b0 + n)
            p, q = _expand(both, np.arange(len(n)), np.arange(len(n)))
            p, q = p[p < q], q[p < q]
            fit = _possible(whole, p, q, rule)
            p, q = p[fit], q[fit]
            fit = bound.most(p, q) >= rule.overlap(size[p], size[q])
            out.append((p[fit], q[fit]))
        for k in np.flatnonzero(~small):
            at = slice(bounds[k], bounds[k + 1])
            p, q = (x + bounds[k] for x in traverse(_leaves(size[at], group[at], bits[at]), rule))
            most = bound.most(p, q)
            fit = most >= rule.overlap(size[p], size[q])
            p, q, most = p[fit], q[fit], most[fit]
            if forest:  # the best partner for each
                order = np.lexsort((p, -most / (size[p] + size[q]), q))
                p, q = p[order], q[order]
                q, one = np.unique(q, return_index=True)
                p = p[one]
            out.append((p, q))
        p, q = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int),) * 2
        keep = (side[p] != side[q]) | (side[p] < 0)
        a, b = np.minimum(ids[p], ids[q])[keep], np.maximum(ids[p], ids[q])[keep]
        long = (np.minimum(size[p], size[q])[keep] > SIGNATURE).astype(np.int64)
        a, b, long = np.unique(np.stack([a, b, long]), axis=1) if len(a) else (a, b, long)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "long": pa.array(long.astype(bool))})

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        key = ("token", "i", "j")
        for batch in batches:
            if not batch.num_rows:
                continue
            last = [batch.column(c)[-1].as_py() for c in key]
            same = np.ones(batch.num_rows, bool)
            for c, v in zip(key, last, strict=True):
                same &= batch.column(c).to_numpy() == v
            cut = int(np.flatnonzero(same)[0])  # rows are sorted: from here on the last cell, which may go on
            if cut or (held and [held[-1].column(c)[-1].as_py() for c in key] != last):
                done = pa.Table.from_batches([*held, batch.slice(0, cut)])
                yield pairs(done)
                held = [batch.slice(cut)]
            else:
                held.append(batch)
        if held:
            yield pairs(pa.Table.from_batches(held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of a task's cells; those that several of its cells hold leave it once, as far as ``HELD`` pairs tell."""
        found: list[pa.Table] = []
        for table in cells(batches):
            found.append(table)
            if sum(t.num_rows for t in found) > HELD:
                found = [pa.concat_tables(found).group_by(["a", "b", "long"]).aggregate([])]
                if found[0].num_rows > HELD // 2:
                    yield from found.pop().to_batches()
        if found:
            yield from pa.concat_tables(found).group_by(["a", "b", "long"]).aggregate([]).to_batches()

    return run


def candidates(cells: DataFrame, rule: Rule, forest: bool) -> DataFrame:
    """``(a, b)``, each once, and whether both are long, from rows ``token, n, home, id, size, root, bits, coarse``.

    ``n`` is the number of classes of a cell and ``home`` the first of them: cells of one group of copies, which differ
    by few classes and hold the same pairs over and over, mostly have the same and meet in one task. Blocks of larger
    cells are dealt out by themselves.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    rows = cells.withColumn("blocks", blocks).withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "token", "home",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        "id", "size", "root", "bits", "coarse",
        F.when(F.col("own") == F.col("other"), -1).otherwise(F.when(F.col("own") < F.col("other"), 0).otherwise(1)).alias("side"),
    )
    rows = rows.repartition("home", "i", "j").drop("home").sortWithinPartitions("token", "i", "j", "size", "id")
    return rows.mapInArrow(_cell_pairs(rule, forest), "a long, b long, long boolean").distinct()


def plausible(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``(a, b)`` of ``candidates`` but for those of long sets whose bins leave too small an overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb = (batch.column(c).to_numpy() for c in ("a", "b", "na", "nb"))
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SIGNATURE) for c in ("left", "right")
            )
            most = np.minimum(left, right).sum(1, dtype=np.int64)
            # n-grams over the 255 that a bin can count
            most += np.minimum(na - left.sum(1, dtype=np.int64), nb - right.sum(1, dtype=np.int64))
            keep = most >= rule.overlap(na, nb)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    bins = classes.where(F.col("bins").isNotNull())
    left = bins.select(F.col("id").alias("a"), F.col("size").alias("na"), F.col("bins").alias("left"))
    right = bins.select(F.col("id").alias("b"), F.col("size").alias("nb"), F.col("bins").alias("right"))
    met = pairs.where("long").select("a", "b").join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return pairs.where("not long").select("a", "b").unionAll(met.mapInArrow(run, "a long, b long"))


def _id_filter(ids: DataFrame) -> np.ndarray:
    """Bits of a fixed filter that are set by some ids. It lets others pass too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER, bool)
        for batch in batches:
            bits[batch.column(0).to_numpy()] = True
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_pydict({"word": at >> 6, "bit": at & 63})

    place = F.pmod(F.xxhash64(ids.columns[0]), F.lit(FILTER)).alias("place")
    set_bits = ids.select(place).mapInArrow(run, "word long, bit long")
    masks = set_bits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("mask")).toPandas()
    out = np.zeros(FILTER // 64, np.uint64)
    out[masks["word"].to_numpy(np.int64)] = masks["mask"].to_numpy(np.int64).view(np.uint64)
    return out


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str, text: str, rule: Rule) -> DataFrame:
    """The pairs of classes whose whole sets are similar enough, with their overlap.

    The first class of a pair is a hub: the sets of its partners are sent to it, and its own once per slot of them.
    """
    hubs = pairs.groupBy("a").agg(F.ceil(F.count("*") / SLOT).cast("int").alias("slots"))
    partners = pairs.join(hubs.hint("merge"), "a").select(
        F.col("b").alias("id"), F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), F.col("slots")).cast("int").alias("slot")
    )
    own = hubs.select(F.col("a").alias("id"), F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"))
    sent = classes.select("id", "print", F.col("sample").alias("doc_id")).join(partners.unionAll(own).hint("merge"), "id")
    wanted = stage(sent, "sent")
    filter_bits = docs.sparkSession.sparkContext.broadcast(_id_filter(wanted.select("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_bits.value
        seen = set()  # repeated rows go on once a task
        for batch in batches:
            place = batch.column("place").to_numpy()
            known = (bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)
            for piece in pieces(batch.filter(pa.array(known.astype(bool))), "text"):
                grams, counts = sets(piece.column("text"), rule.words)
                made = pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), fingerprints(grams, counts), binaries(grams, counts).cast(pa.binary())],
                    names=["doc_id", "print", "grams"],
                )
                ids = (tuple(x.values()) if isinstance(x, dict) else x for x in made.column(0).to_pylist())
                keys = list(zip(ids, made.column(1).to_pylist(), strict=True))
                new = [k not in seen and not seen.add(k) for k in keys]
                yield made.filter(pa.array(new, pa.bool_()))

    place = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(FILTER)).alias("place")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), place)
    kind = rows.schema["doc_id"].dataType.simpleString()
    grams = rows.mapInArrow(run, f"doc_id {kind}, print binary, grams binary")
    same = grams["doc_id"].eqNullSafe(wanted["doc_id"])
    met = wanted.join(grams.hint("merge"), (wanted["print"] == grams["print"]) & same)
    met = met.select("hub", "slot", (F.col("id") != F.col("hub")).alias("partner"), "id", "grams")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, set_of_hub = None, np.zeros(0, np.uint64)  # the hub's own row comes first
        for batch in batches:
            found = []
            keys = zip(*(batch.column(c).to_pylist() for c in ("hub", "id")), strict=True)
            for (at, other), content in zip(keys, batch.column("grams"), strict=True):
                own = np.frombuffer(content.as_buffer(), np.uint64)
                if at == other:
                    hub, set_of_hub = at, own
                elif at == hub:
                    both = np.concatenate((set_of_hub, own))
                    both.sort()
                    found.append((at, other, len(set_of_hub), len(own), int((both[1:] == both[:-1]).sum())))
            a, b, na, nb, shared = np.array(found, np.int64).reshape(-1, 5).T
            made = pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, shared)], names=["a", "b", "shared"])
            yield made.filter(pa.array(shared >= rule.overlap(na, nb)))

    met = met.repartition("hub", "slot").sortWithinPartitions("hub", "slot", "partner", "id")
    return met.mapInArrow(compare, "a long, b long, shared long").distinct()


def join(docs: DataFrame, doc_id: str, text: str, rule: Rule = Rule()) -> DataFrame:
    """``doc_id, size`` (of its set) and ``component``, the smallest id reachable by links, for each row.

    Rows link when the similarity of their sets of n-grams reaches the rule's. Null and empty texts, and texts without
    words, have an empty set and link with nothing; equal sets always link. Rows with the same id and different texts
    are apart unless their sets link. Null ids are passed over by the minimum; an id may be a struct, whose null fields
    count as smallest. An empty table gives no rows. Other columns are not looked at.
    """
    rows = stage(profiles(docs, doc_id, text, rule), "profiles")
    full = rows.where(F.col("print").isNotNull())
    classes = full.groupBy("print", "size").agg(
        F.min(F.struct("doc_id", "prefix", "bits", "bins", "coarse")).alias("one"), F.min("doc_id").alias("doc_id")
    )
    classes = classes.select(
        F.monotonically_increasing_id().alias("id"), "print", "size", "doc_id", F.col("one.doc_id").alias("sample"), "one.prefix", "one.bits", "one.bins", "one.coarse"
    )
    classes = stage(classes, "classes")

    # dealt by token once, for the counts and for the join with them
    members = classes.select(F.explode("prefix").alias("token"), "id").where("token is not null").repartition("token")
    found = members.groupBy("token").agg(
        F.count("*").alias("n"), F.min("id").alias("home"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")
    )
    found = found.where("n > 1").groupBy("n", "x", "y").agg(F.min("token").alias("token"), F.min("home").alias("home"))
    cells = stage(members.join(found.select("token", "n", "home").hint("merge"), "token").select("token", "n", "home", "id"), "cells")
    facts = classes.select("id", "size", "bits", "coarse").hint("merge")

    first = candidates(cells.join(facts, "id").withColumn("root", F.col("id")), rule, forest=True)
    first = stage(plausible(first, classes, rule), "pairs")
    links = stage(verified(first, classes, docs, doc_id, text, rule).select("a", "b"), "links")
    roots = components(links)

    rooted = cells.join(roots.hint("merge"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    second = candidates(rooted.join(mixed.select("token").hint("merge"), "token", "left_semi").join(facts, "id"), rule, forest=False)
    second = stage(plausible(second.join(first.hint("merge"), ["a", "b"], "left_anti"), classes, rule), "pairs")
    more = verified(second, classes, docs, doc_id, text, rule).select("a", "b")
    roots = components(links.union(more))

    named = classes.select("id", "print", "doc_id").join(roots.hint("merge"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    lowest = named.groupBy("root").agg(F.min("doc_id").alias("component"))
    named = named.join(lowest.hint("merge"), "root").select("print", "component")
    out = rows.select("doc_id", "size", "print").join(named.hint("merge"), "print", "left")
    return out.select("doc_id", "size", F.coalesce("component", "doc_id").alias("component"))
