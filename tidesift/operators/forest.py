"""A random forest over sparse vectors, whose rows stay as small as their entries.

Spark's own forest lays each row out as one whole number per feature: 80 KB a row at 20 000 terms, read again for every
level. Here a row holds the bins of its own entries. A level is one pass: each task routes its rows and adds up class
weights by node, drawn feature and bin; a shuffle by node sums them; what a node's absent entries weigh is its total less
that; and one row a node, the best split, reaches the driver. Bins of at most ``WHOLE_BYTES`` go to the tasks whole, and each
grows trees by itself: the same trees, as deep ones take many levels. The result is Spark's model, with its settings and meaning.

Weights are summed as whole numbers, so that the order of tasks decides nothing.
"""

from __future__ import annotations

import json
import math
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, ShortType, StructField, StructType

from tidesift.sources.local import local_frame
from tidesift.sources.scratch import scratch_path, stage

#: Rows that the bins' bounds are learnt on, as many as Spark's forest takes; every row is binned and counted.
BOUND_ROWS = 10_000
#: Bytes of a task's counts, and of its table of drawn features, in one pass; more nodes take more passes.
COUNT_BYTES, DRAWN_BYTES = 256 << 20, 64 << 20
#: Bytes of a table's bins that are sent to the tasks whole.
WHOLE_BYTES = 64 << 20
#: Nodes of a model that are written together.
WRITTEN = 1 << 19
#: Steps of a weight, of the greatest one.
WEIGHT_STEPS = 1 << 30

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


def subset_size(strategy: str, features: int, trees: int) -> int:
    """Features drawn for a node, as Spark reads the setting."""
    named = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "onethird": math.ceil(features / 3), "log2": math.ceil(math.log2(features))}
    named["auto"] = named["sqrt"] if trees > 1 else features
    if strategy in named:
        return max(1, named[strategy])
    count = int(strategy) if strategy.isdigit() else math.ceil(float(strategy) * features)
    return max(1, min(features, count))


@dataclass
class Binned:
    """Rows with ``_key``, ``_idx`` and ``_bin`` besides their own columns; ``bounds`` per feature, padded by infinity."""

    rows: DataFrame
    bounds: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.isfinite(self.bounds).sum(axis=1)


def _entries(df: DataFrame, features: str) -> DataFrame:
    vector = F.unwrap_udt(F.col(features))
    every = F.when(F.size(vector["values"]) > 0, F.sequence(F.lit(0), F.size(vector["values"]) - 1)).otherwise(F.array().cast("array<int>"))
    return df.withColumns({"_idx": F.when(vector["type"] == 0, vector["indices"]).otherwise(every), "_value": vector["values"]})


def _bounds(df: DataFrame, rows: int, features: int, max_bins: int, seed: int) -> np.ndarray:
    """Upper bounds of each feature's bins: 0, and quantiles of its other values."""
    sample = df if rows <= BOUND_ROWS else df.sample(False, BOUND_ROWS / rows, seed)
    cuts = max_bins - 1
    at = [k / cuts for k in range(1, cuts)]
    entries = sample.select(F.inline(F.arrays_zip("_idx", "_value"))).where("_value <> 0")
    found = entries.groupBy("_idx").agg(F.percentile_approx("_value", at, 1000).alias("q")).collect()
    out = np.full((features, cuts), np.inf)
    out[:, 0] = 0.0
    for r in found:
        own = np.unique(np.append(r["q"], 0.0))
        out[r["_idx"], : len(own)] = own
    return out[:, : max(1, int(np.isfinite(out).sum(axis=1).max()))]


def _binning(bounds: np.ndarray):
    """Puts the number of a feature's bounds below each value in the value's place; zeros are left out."""
    steps = [1 << k for k in reversed(range(max(1, bounds.shape[1]).bit_length()))]
    padded = np.full((bounds.shape[0], 2 * steps[0] + 1), np.inf)
    padded[:, : bounds.shape[1]] = bounds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("_idx")
            idx, value = lists.flatten().to_numpy(), batch.column("_value").flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy())
            some = value != 0
            idx, value, row = idx[some], value[some], row[some]
            bins = np.zeros(len(idx), dtype=np.int64)
            for step in steps:
                bins += step * (padded[idx, bins + step - 1] < value)
            ends = np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows))).astype(np.int32)
            made = {"_idx": pa.ListArray.from_arrays(ends, pa.array(idx, pa.int32())), "_bin": pa.ListArray.from_arrays(ends, pa.array(bins, pa.int16()))}
            kept = [n for n in batch.schema.names if n not in ("_idx", "_value")]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], *made.values()], names=[*kept, *made])

    return run


def bin_rows(df: DataFrame, features: str, columns: list[str], max_bins: int, seed: int) -> Binned:
    """Written once: each level reads the bins again."""
    entries = _entries(df, features)
    first = df.select(F.unwrap_udt(F.col(features)).alias("v")).select(F.coalesce("v.size", F.size("v.values"))).first()
    if first is None:
        raise ValueError("there are no rows to fit a forest on")
    bounds = _bounds(entries, df.count(), first[0], max_bins, seed)
    stored = [F.unwrap_udt(F.col(c)).alias(c) if c == features else F.col(c) for c in columns]
    kept = entries.select(*stored, F.monotonically_increasing_id().alias("_key"), "_idx", "_value")
    made = [StructField("_key", LongType()), StructField("_idx", ArrayType(IntegerType())), StructField("_bin", ArrayType(ShortType()))]
    written = StructType([*[kept.schema[c] for c in columns], *made])
    read = StructType([*[df.schema[c] for c in columns], *made])
    return Binned(stage(kept.mapInArrow(_binning(bounds), written), "binned", read), bounds)


@dataclass
class Tree:
    """Nodes in order of growth; ``feature`` is -1 at a leaf, and the right child follows the left one."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    depth: list[int] = field(default_factory=lambda: [0])
    stats: list[list[int] | None] = field(default_factory=lambda: [None])

    def split(self, node: int, feature: int, cut: int, gain: float, left: list[int], right: list[int]) -> list[int]:
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, len(self.feature), gain
        for stats in (left, right):
            self.feature.append(-1), self.cut.append(0), self.left.append(-1), self.gain.append(-1.0)
            self.depth.append(self.depth[node] + 1), self.stats.append(stats)
        return [self.left[node], self.left[node] + 1]


def _draws(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree draws each row: Poisson numbers from a hash of row, tree and seed."""
    salt = (tree + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1342543DE82EF95
    z = key.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(salt % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    return np.searchsorted(_POISSON, (z >> np.uint64(11)) * 2.0**-53, side="right")


def _counting(trees: dict[int, tuple], drawn: np.ndarray, features: int, zero: np.ndarray, bins: int, classes: int, bootstrap: bool, seed: int):
    """Sums of class weights and rows by open node, drawn feature and bin, and by open node.

    ``trees`` has of each tree its features, cuts, left children and slots of open nodes; ``drawn`` has each slot's features.
    """
    slots, size = drawn.shape
    wide = classes + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full((slots, features), -1, dtype=np.int16 if size < 1 << 15 else np.int32)
        np.put_along_axis(place, drawn, np.arange(size, dtype=place.dtype)[None, :], axis=1)
        sums = np.zeros(slots * (size + 1) * bins * wide, dtype=np.int64)

        def add(cell: np.ndarray, label: np.ndarray, weight: np.ndarray, n: np.ndarray) -> None:
            np.add.at(sums, cell * wide + label, weight)
            np.add.at(sums, cell * wide + classes, n)

        for batch in batches:
            lists = batch.column("_idx")
            idx, bin_ = lists.flatten().to_numpy(), batch.column("_bin").flatten().to_numpy()
            lengths = lists.value_lengths().to_numpy()
            entry_row = np.repeat(np.arange(batch.num_rows), lengths)
            entry = entry_row * features + idx
            key, label = batch.column("_key").to_numpy(), batch.column("_label").to_numpy()
            weight = batch.column("_weight").to_numpy()
            for number, (feature, cut, left, slot_of) in trees.items():
                n = _draws(key, number, seed) if bootstrap else np.ones(batch.num_rows, dtype=np.int64)
                node = np.zeros(batch.num_rows, dtype=np.int64)
                at = np.flatnonzero(n)
                while True:
                    at = at[feature[node[at]] >= 0]
                    if not len(at):
                        break
                    here = node[at]
                    want = at * features + feature[here]
                    own = zero[feature[here]]
                    if len(entry):
                        found = np.minimum(np.searchsorted(entry, want), len(entry) - 1)
                        own = np.where(entry[found] == want, bin_[found], own)
                    node[at] = left[here] + (own > cut[here])
                slot = np.where(n > 0, slot_of[node], -1)
                at = np.flatnonzero(slot >= 0)
                add(slot[at] * (size + 1) * bins + size * bins, label[at], weight[at] * n[at], n[at])
                entry_slot = slot[entry_row]
                mine = np.flatnonzero(entry_slot >= 0)
                where = place[entry_slot[mine], idx[mine]]
                mine, where = mine[where >= 0], where[where >= 0].astype(np.int64)
                row = entry_row[mine]
                add((slot[row] * (size + 1) + where) * bins + bin_[mine], label[row], weight[row] * n[row], n[row])
        sums = sums.reshape(-1, wide)
        for part in np.array_split(np.flatnonzero(sums[:, classes]), 1 + len(sums) // 1_000_000):
            slot, cell = np.divmod(part, (size + 1) * bins)
            columns = [pa.array(slot, pa.int32()), pa.array(cell, pa.int32()), *[pa.array(sums[part, c]) for c in range(wide)]]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", "cell", *[f"s{c}" for c in range(wide)]])

    return run


def _impurity(stats: np.ndarray) -> np.ndarray:
    total = stats.sum(axis=-1, keepdims=True)
    return 1 - np.square(stats / np.where(total == 0, 1, total)).sum(axis=-1)


def _best(cell: np.ndarray, sums: np.ndarray, total: np.ndarray, lengths: np.ndarray, bins: int, least: int) -> tuple[int, int, float, np.ndarray] | None:
    """Of a node's sums by cell, the best split: place of its feature, cut, gain, and what lies below. None where none gains anything.

    A cell is a feature's place times ``bins`` and a bin; cells ascend, and those of a feature add up to ``total``. Cuts between
    cells change nothing, and the first of equal splits is the best.
    """
    classes = len(total) - 1
    at, cut = np.divmod(cell, bins)
    upto = sums.cumsum(axis=0)
    first = np.searchsorted(at, at)
    below = upto - np.where(first[:, None] > 0, upto[first - 1], 0)
    above = total - below
    fine = np.flatnonzero((cut < np.minimum(lengths[at], bins - 1)) & (below[:, classes] >= least) & (above[:, classes] >= least))
    if not len(fine):
        return None
    below, above = below[fine], above[fine]
    weight = total[:classes].sum()
    part = lambda s: s[:, :classes].sum(axis=-1) / max(weight, 1) * _impurity(s[:, :classes])
    gain = _impurity(total[:classes]) - part(below) - part(above)
    k = int(gain.argmax())
    return (int(at[fine[k]]), int(cut[fine[k]]), float(gain[k]), below[k]) if gain[k] > 1e-12 else None


def _with_rest(cell: np.ndarray, sums: np.ndarray, total: np.ndarray, zero: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums by cell in ascending order, where rows without a feature are in its cell of zero."""
    places = len(zero)
    at = cell // bins
    own = np.zeros((places, len(total)), dtype=np.int64)
    np.add.at(own, at, sums)
    cell, sums = np.append(cell, np.arange(places) * bins + zero), np.concatenate((sums, total - own))
    order = np.argsort(cell, kind="stable")
    cell, sums = cell[order], sums[order]
    starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    return cell[starts], np.add.reduceat(sums, starts)


def _splitting(drawn: np.ndarray, lengths: np.ndarray, zero: np.ndarray, bins: int, classes: int, least: int):
    """The best split of one node from its sums; -1 where none gains anything."""
    size, wide = drawn.shape[1], classes + 1

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        slot = int(cells["slot"].iloc[0])
        own = drawn[slot]
        cell, sums = cells["cell"].to_numpy().astype(np.int64), cells[[f"s{c}" for c in range(wide)]].to_numpy()
        total, of_feature = sums[cell == size * bins][0], cell < size * bins
        best = _best(*_with_rest(cell[of_feature], sums[of_feature], total, zero[own], bins), total, lengths[own], bins, least)
        at, cut, gain, below = best or (0, 0, -1.0, total)
        out = {"slot": slot, "feature": int(own[at]) if best else -1, "cut": cut, "gain": gain, "total": total.tolist(), "below": below.tolist()}
        return pd.DataFrame([out])

    return run


@dataclass
class Whole:
    """All rows of a table: keys, labels and weights; where each row's entries end; features and bins of the entries."""

    key: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    ends: np.ndarray
    idx: np.ndarray
    bin: np.ndarray

    @classmethod
    def of(cls, rows: DataFrame) -> "Whole":
        table = rows.toArrow().combine_chunks()
        one = lambda c: table.column(c).to_numpy()
        flat = lambda c: pa.concat_arrays([x.flatten() for x in table.column(c).chunks]).to_numpy()
        lengths = pc.list_value_length(table.column("_idx")).to_numpy()
        return cls(one("_key"), one("_label"), one("_weight"), np.append(0, np.cumsum(lengths, dtype=np.int64)), flat("_idx"), flat("_bin"))


def _grow_tree(rows: Whole, number: int, features: int, size: int, lengths: np.ndarray, zero: np.ndarray, bins: int, classes: int, least: int, depth: int, bootstrap: bool, seed: int) -> Tree:
    """One tree of a whole table: node by node in the order that passes grow them."""
    times = _draws(rows.key, number, seed) if bootstrap else np.ones(len(rows.key), dtype=np.int64)
    tree, place = Tree(), np.full(features, -1)
    first = np.flatnonzero(times)
    open_ = [(0, first)] if len(first) else []
    for node, at in open_:  # grows
        label, n = rows.label[at], times[at]
        weight = rows.weight[at] * n
        total = np.zeros(classes + 1, dtype=np.int64)
        np.add.at(total, label, weight)
        total[classes] = n.sum()
        tree.stats[node] = total.tolist()
        own = rows.ends[at + 1] - rows.ends[at]
        row = np.repeat(np.arange(len(at)), own)
        entry = np.arange(len(row)) + np.repeat(rows.ends[at] - np.cumsum(own) + own, own)
        idx, bin_ = rows.idx[entry], rows.bin[entry]
        drawn = _drawn(features, size, seed, number, node)
        place[drawn] = np.arange(size)
        where = place[idx]
        place[drawn] = -1
        mine = np.flatnonzero(where >= 0)
        # A feature that no row of the node has cannot split it.
        used, place_of = np.unique(where[mine], return_inverse=True)
        if not len(used) or depth <= tree.depth[node]:
            continue
        sums = np.zeros((len(mine), classes + 1), dtype=np.int64)
        sums[np.arange(len(mine)), label[row[mine]]] = weight[row[mine]]
        sums[:, classes] = n[row[mine]]
        best = _best(*_with_rest(place_of * bins + bin_[mine], sums, total, zero[drawn[used]], bins), total, lengths[drawn[used]], bins, least)
        if best is None:
            continue
        feature, cut, gain, below = int(drawn[used[best[0]]]), *best[1:]
        bin_of = np.full(len(at), zero[feature])
        bin_of[row[idx == feature]] = bin_[idx == feature]
        sides = at[bin_of <= cut], at[bin_of > cut]
        for child, part, stats in zip(tree.split(node, feature, cut, gain, below.tolist(), (total - below).tolist()), sides, (below, total - below)):
            if tree.depth[child] < depth and stats[classes] >= 2 * least and np.count_nonzero(stats[:classes]) > 1:
                open_.append((child, part))
    return tree


def _grow_whole(rows: DataFrame, trees: int, *how) -> list[Tree]:
    """Trees of a table that is sent to the tasks whole."""
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(Whole.of(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                t = _grow_tree(shared.value, number, *how)
                stats = [x for s in t.stats for x in (s or [0] * (how[5] + 1))]
                columns = [number], [t.feature], [t.cut], [t.left], [t.gain], [stats]
                kinds = pa.int64(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.float64()), pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "feature", "cut", "left", "gain", "stats"])

    numbers = rows.sparkSession.range(0, trees, 1, min(trees, 2 * context.defaultParallelism))
    made = numbers.mapInArrow(run, "id long, feature array<int>, cut array<int>, left array<int>, gain array<double>, stats array<long>").toArrow().sort_by("id")
    shared.unpersist()
    of = lambda c, k: made.column(c)[k].values.to_numpy()
    return [Tree(*(of(c, k) for c in ("feature", "cut", "left", "gain")), [], of("stats", k).reshape(-1, how[5] + 1)) for k in range(trees)]


def _grow(binned: Binned, label: str, weight: str | None, estimator: RandomForestClassifier) -> tuple[list[Tree], int, float]:
    """Trees level by level; with them, the number of classes and the size of a weight step."""
    features = len(binned.bounds)
    lengths, zero = binned.lengths, (binned.bounds < 0).sum(axis=1)
    bins = binned.bounds.shape[1] + 1
    trees_asked, seed = estimator.getNumTrees(), estimator.getSeed()
    size, least = subset_size(estimator.getFeatureSubsetStrategy(), features, trees_asked), max(1, estimator.getMinInstancesPerNode())
    own = F.col(weight).cast("double") if weight else F.lit(1.0)
    last, heaviest, count, entries = binned.rows.agg(F.max(label), F.max(own), F.count("*"), F.sum(F.size("_idx"))).first()
    if last is None:
        raise ValueError("there are no rows to fit a forest on")
    classes, step = int(last) + 1, (heaviest or 1.0) / WEIGHT_STEPS
    rows = binned.rows.select("_key", "_idx", "_bin", F.col(label).cast("int").alias("_label"), F.round(own / step).cast("long").alias("_weight"))
    if 24 * count + 6 * entries <= WHOLE_BYTES:
        how = features, size, lengths, zero, bins, classes, least, estimator.getMaxDepth(), estimator.getBootstrap(), seed
        return _grow_whole(rows, trees_asked, *how), classes, step
    sums = ", ".join(f"s{c} long" for c in range(classes + 1))
    group = max(1, min(COUNT_BYTES // ((size + 1) * bins * (classes + 1) * 8), DRAWN_BYTES // (features * 2)))
    trees = [Tree() for _ in range(trees_asked)]
    open_ = [(t, 0) for t in range(trees_asked)]
    while open_:
        grown: list[tuple[int, int]] = []
        for start in range(0, len(open_), group):
            mine = open_[start : start + group]
            drawn = np.array([_drawn(features, size, seed, t, n) for t, n in mine])
            spec = {}
            for t in {t for t, _ in mine}:
                slot_of = np.full(len(trees[t].feature), -1)
                spec[t] = (np.array(trees[t].feature), np.array(trees[t].cut), np.array(trees[t].left), slot_of)
            for k, (t, n) in enumerate(mine):
                spec[t][3][n] = k
            counted = rows.mapInArrow(_counting(spec, drawn, features, zero, bins, classes, estimator.getBootstrap(), seed), f"slot int, cell int, {sums}")
            # Dealt by node: the sums and the split of a node meet in one task.
            cells = counted.repartition("slot").groupBy("slot", "cell").agg(*[F.sum(f"s{c}").alias(f"s{c}") for c in range(classes + 1)])
            splitting = _splitting(drawn, lengths, zero, bins, classes, least)
            best = cells.groupBy("slot").applyInPandas(splitting, "slot int, feature int, cut int, gain double, total array<long>, below array<long>")
            for r in sorted(best.collect(), key=lambda r: r["slot"]):
                t, n = mine[r["slot"]]
                tree = trees[t]
                tree.stats[n] = r["total"]
                if r["feature"] < 0 or tree.depth[n] >= estimator.getMaxDepth():
                    continue
                above = [a - b for a, b in zip(r["total"], r["below"])]
                for child in tree.split(n, r["feature"], r["cut"], r["gain"], r["below"], above):
                    stats = tree.stats[child]
                    if tree.depth[child] < estimator.getMaxDepth() and stats[classes] >= 2 * least and np.count_nonzero(stats[:classes]) > 1:
                        grown.append((t, child))
        open_ = grown
    return trees, classes, step


def _drawn(features: int, size: int, seed: int, tree: int, node: int) -> np.ndarray:
    return np.random.default_rng([seed % 2**32, tree, node]).choice(features, size, replace=False, shuffle=False)


def _nodes(number: int, tree: Tree, bounds: np.ndarray, classes: int, step: float, schema: pa.Schema) -> pa.Table:
    """A tree's nodes as rows of Spark's file format."""
    stats = np.array([[0] * (classes + 1) if s is None else s for s in tree.stats], dtype=np.int64)  # none where no row was drawn
    feature, cut, left, n = np.array(tree.feature), np.array(tree.cut), np.array(tree.left), len(tree.feature)
    inner, weights = feature >= 0, stats[:, :classes]
    impurity = np.where(weights.any(axis=1), _impurity(weights), 0.0)
    lists = lambda counts, values: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(values, pa.float64()))
    thresholds = lists(inner, bounds[feature[inner], cut[inner]])
    split = [pa.array(feature, pa.int32()), thresholds, pa.array(np.full(n, -1), pa.int32())]
    columns = [
        pa.array(np.arange(n), pa.int32()), pa.array(weights.argmax(axis=1), pa.float64()), pa.array(impurity), lists(np.full(n, classes), (weights * step).reshape(-1)),
        pa.array(stats[:, classes]), pa.array(np.array(tree.gain, dtype=float)), pa.array(left, pa.int32()), pa.array(np.where(inner, left + 1, -1), pa.int32()),
        pa.StructArray.from_arrays(split, fields=list(schema.field("nodeData").type.field("split").type)),
    ]
    data = pa.StructArray.from_arrays(columns, fields=list(schema.field("nodeData").type))
    return pa.Table.from_arrays([pa.array(np.full(n, number), pa.int32()), data], schema=schema)


def _model(spark, estimator: RandomForestClassifier, trees: list[Tree], bounds: np.ndarray, classes: int, step: float) -> RandomForestClassificationModel:
    """The trees as Spark's model, by way of its file format."""
    path = scratch_path(spark, "forest")
    params = {p.name: estimator.getOrDefault(p) for p in estimator.params if estimator.isDefined(p)}
    of_tree = {k: v for k, v in params.items() if k not in ("numTrees", "bootstrap", "featureSubsetStrategy", "subsamplingRate")}

    def record(kind: str, own: dict, **more) -> str:
        head = {"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": 0, "sparkVersion": spark.version, "uid": f"{kind}_{uuid.uuid4().hex[:12]}"}
        return json.dumps(head | {"paramMap": own, "defaultParamMap": {}} | more)

    whole = record("RandomForestClassificationModel", params, numFeatures=len(bounds), numClasses=classes, numTrees=len(trees))
    local_frame(spark, [(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    heads = [(t, record("DecisionTreeClassificationModel", of_tree), 1.0) for t in range(len(trees))]
    local_frame(spark, heads, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    node = "id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, leftChild int, rightChild int"
    split = "struct<featureIndex:int, leftCategoriesOrThreshold:array<double>, numCategories:int>"
    fields = ", ".join(f.replace(" ", ":", 1) for f in node.split(", "))
    schema = StructType.fromDDL(f"treeID int, nodeData struct<{fields}, split:{split}>")
    held: list[pa.Table] = []
    for t, tree in enumerate(trees):
        held.append(_nodes(t, tree, bounds, classes, step, to_arrow_schema(schema)))
        if sum(h.num_rows for h in held) > WRITTEN or t == len(trees) - 1:
            spark.createDataFrame(pa.concat_tables(held), schema).write.mode("append").parquet(f"{path}/data")
            held = []
    return RandomForestClassificationModel.load(path)


class SparseForestClassifier(RandomForestClassifier):
    """``RandomForestClassifier`` fitted by passes over sparse rows.

    ``binned`` has the bins of a table and its bounds, for many fits on parts of that table: rows that have bins are not binned anew.
    """

    binned: np.ndarray | None = None

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        label, weight = self.getLabelCol(), self.getWeightCol() if self.isSet(self.weightCol) else None
        if self.binned is not None:
            data = Binned(dataset, self.binned)
        else:
            data = bin_rows(dataset, self.getFeaturesCol(), [label, *([weight] if weight else [])], self.getMaxBins(), self.getSeed())
        trees, classes, step = _grow(data, label, weight, self)
        return _model(dataset.sparkSession, self, trees, data.bounds, classes, step)
