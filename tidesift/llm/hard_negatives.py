"""Hard negatives by angular triangle filtering.

1. Reference directions are learnt on a bounded sample. Every row is stored with its angles to them, in groups of
   bounded size that hold neighbouring rows: those nearest to one direction, by their angle to it.
2. On a sphere, angles obey the triangle inequality: the angle of two vectors is between the difference and the sum of
   their angles to any direction. So angles give an interval of cosines, and times the norms one of scores, which is
   widened by more than all rounding. It is taken for a group, to choose the groups that an anchor visits, and again
   for tiles of rows inside a group.
3. A window of scores that matter is known for each anchor: at first those from its fifth best own neighbour on, later
   the shares of each positive's score. Only tiles whose interval overlaps a window are scored, in whole numbers.

Anchors travel to groups, packed with nothing but themselves; rows stay in their groups. Each group sends back the few
best per anchor and window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidesift.sources.scratch import stage

#: Rows that the directions are learnt on, directions, and passes over the sample.
SAMPLE, DIRECTIONS, PASSES = 4096, 16, 8
#: Bytes of a group's vectors as doubles, least rows of a group, rows of a tile, anchors looked at together.
GROUP_BYTES, LEAST_ROWS, TILE, ANCHORS = 64 << 20, 4096, 512, 256
#: Groups that an anchor is compared with by name; beyond so many, neighbouring groups share one interval.
ROUTES = 1 << 14
#: Angles are off by less than this: they are kept as single floats, and arc cosines lose half of a double's digits.
LOOSE = 2e-6
#: Windows and thresholds without a bound.
LOW, HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Whole numbers up to here are exact in doubles, in any order of summation.
EXACT = 1 << 53

_FOUND = "anchor long, slot int, id long, score long, key long"


@dataclass(frozen=True)
class Rule:
    """Positives per anchor, negatives per positive, and the least and greatest percentage of the positive's score."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95


def whole(vector: str, scale: int = 256) -> Column:
    """Components times ``scale``, rounded down; null for a vector that is null or holds null or non-finite ones."""
    c = F.col(vector)
    odd = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, F.transform(c, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _lists(values: np.ndarray) -> pa.Array:
    """A column of equally long lists, one for each row of the matrix."""
    bounds = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values.ravel()))


def directions(sample: np.ndarray, n: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors, one a row, around which the sample's directions gather. Fixed for a given sample."""
    norms = np.linalg.norm(sample, axis=1)
    unit = sample[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.zeros((1, sample.shape[1]))
    best = unit[:: max(1, len(unit) // n)][:n].copy()
    for _ in range(PASSES):
        nearest = (unit @ best.T).argmax(1)
        for j in range(len(best)):
            mean = unit[nearest == j].sum(0)
            if np.linalg.norm(mean) > 1e-9:
                best[j] = mean / np.linalg.norm(mean)
    return best


def angles(x: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles of each row to each direction, and the rows' norms. A null vector is at a right angle to all."""
    norms = np.sqrt((x * x).sum(1))
    cosines = (x @ refs.T) / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1)).astype(np.float32), norms


def intervals(own: np.ndarray, norm: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of anchors with sets of rows, as ``[anchor, set]``.

    ``own`` are angles of anchors, ``low`` and ``high`` the extreme angles of each set, ``least`` and ``most`` its norms.
    """
    up = np.ones((len(own), len(low)))
    down = -up
    for j in range(own.shape[1]):
        a, lo, hi = own[:, j, None].astype(np.float64), low[None, :, j] - LOOSE, high[None, :, j] + LOOSE
        apart = np.maximum(0, np.maximum(lo - a, a - hi) - LOOSE)
        np.minimum(up, np.cos(apart), out=up)
        first, last = a + lo - LOOSE, a + hi + LOOSE
        sums = np.where((first <= np.pi) & (last >= np.pi), -1.0, np.minimum(np.cos(first), np.cos(last)))
        np.maximum(down, sums, out=down)
    top, bottom = norm[:, None] * most[None], norm[:, None] * least[None]
    loose = 1 + 1e-6 * top
    return np.where(down < 0, down * top, down * bottom) - loose, np.where(up > 0, up * top, up * bottom) + loose


class Best:
    """The ``k`` best scores of each anchor and slot so far: higher first, then smaller id, then smaller key."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.k, self.slots = k, slots
        self.least = np.full(anchors * slots, LOW, np.int64)  # scores below do not count
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # anchor and slot, score, id, key

    def add(self, *new: np.ndarray) -> None:
        if not len(new[0]):
            return
        place, score, ids, keys = (np.concatenate(x) for x in zip(self.rows, new, strict=True))
        order = np.lexsort((keys, ids, -score, place))
        place = place[order]
        first = np.searchsorted(place, place)
        rank = np.arange(len(place)) - first
        keep = rank < self.k
        full = place[rank == self.k - 1]
        self.rows = [x[keep] for x in (place, score[order], ids[order], keys[order])]
        self.least[full] = np.maximum(self.least[full], score[order][rank == self.k - 1])


class Group:
    """The rows of one group, in tiles."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, theta: np.ndarray, norms: np.ndarray):
        self.keys, self.ids, self.labels, self.x = keys, ids, labels, x
        self.top = float(norms.max(initial=0))
        starts = np.arange(0, len(ids), TILE)
        self.tiles = [slice(s, s + TILE) for s in starts]
        self.low, self.high = np.minimum.reduceat(theta, starts), np.maximum.reduceat(theta, starts)
        self.least, self.most = np.minimum.reduceat(norms, starts), np.maximum.reduceat(norms, starts)

    def search(self, keys, labels, x, theta, norms, low, high, same: bool, k: int) -> Best:
        """The best ``k`` rows of each anchor in each of its windows ``low`` to ``high``, with its label or with others."""
        n, slots = low.shape
        best = Best(n, slots, k)
        best.least[:] = low.ravel()
        down, up = intervals(theta, norms, self.low, self.high, self.least, self.most)
        exact = self.top * float(norms.max(initial=0)) < EXACT
        kind = np.float64 if exact else np.int64
        own, rows = x.astype(kind, copy=False), self.x.astype(kind, copy=False)
        open_ = (low <= high).any(1)
        ceiling = np.where(low <= high, high, LOW).max(1, initial=LOW)
        for t in np.argsort(-up.max(0, initial=0), kind="stable"):
            tile = self.tiles[t]
            floor = best.least.reshape(n, slots)
            needed = (floor <= up[:, t, None]) & (high >= down[:, t, None]) & (low <= high)
            asked = np.flatnonzero(needed.any(1) & open_)
            if not len(asked):
                continue
            score = (own[asked] @ rows[tile].T).astype(np.int64)
            lowest = np.where(low[asked] <= high[asked], floor[asked], HIGH).min(1)
            fits = (score >= lowest[:, None]) & (score <= ceiling[asked, None])
            fits &= (labels[asked, None] == self.labels[None, tile]) == same
            a, r = np.nonzero(fits)
            s = score[a, r]
            a, r = asked[a], r + tile.start
            other = keys[a] != self.keys[r]
            a, r, s = a[other], r[other], s[other]
            for slot in range(slots):
                held = (s >= floor[a, slot]) & (s <= high[a, slot])
                best.add(a[held] * slots + slot, s[held], self.ids[r[held]], self.keys[r[held]])
        return best


def _index(rows: DataFrame, refs: np.ndarray, groups: int, k: int) -> DataFrame:
    """Rows in groups of neighbours, each row once, with angles; anchors with the score of their ``k``-th in the group."""
    shared = rows.sparkSession.sparkContext.broadcast(refs)  # DIRECTIONS vectors

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            theta, norms = angles(_matrix(b.column("vector"), np.float64), shared.value)
            near = theta.argmin(1)
            added = [pa.array(near.astype(np.int32)), pa.array(theta[np.arange(len(near)), near]), _lists(theta), pa.array(norms)]
            yield pa.RecordBatch.from_arrays([*b.columns, *added], names=[*b.schema.names, "cell", "near", "angles", "norm"])

    kinds = "id long, label long, vector array<int>, asked boolean, cell int, near float, angles array<float>, norm double"
    placed = rows.mapInArrow(place, kinds).repartitionByRange(groups, "cell", "near", "id")
    placed = placed.withColumn("group", F.spark_partition_id())

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        own = pa.Table.from_batches(got).combine_chunks()
        x = _matrix(own["vector"].chunk(0), np.int64)
        ids, labels = own["id"].to_numpy(), own["label"].to_numpy()
        order = np.lexsort((*x.T[::-1], labels, ids, own["near"].to_numpy(), own["cell"].to_numpy()))
        x, ids, labels = x[order], ids[order], labels[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (labels[1:] != labels[:-1]) | (x[1:] != x[:-1]).any(1)
        order, x, ids, labels = order[new], x[new], ids[new], labels[new]
        own = own.take(pa.array(order))
        theta, norms = _matrix(own["angles"].combine_chunks(), np.float32), own["norm"].to_numpy()
        keys = (np.int64(own["group"][0].as_py()) << 32) + np.arange(len(ids))
        floor = np.full(len(ids), LOW, np.int64)
        asked = np.flatnonzero(own["asked"].to_numpy())
        group = Group(keys, ids, labels, x, theta, norms)
        for at in range(0, len(asked), ANCHORS):
            some = asked[at : at + ANCHORS]
            free = np.full((len(some), 1), LOW), np.full((len(some), 1), HIGH)
            floor[some] = group.search(keys[some], labels[some], x[some], theta[some], norms[some], *free, True, k).least
        table = own.append_column("key", pa.array(keys)).append_column("floor", pa.array(floor))
        yield from table.select(_COLUMNS).to_batches(max_chunksize=4096)

    return placed.mapInArrow(finish, _INDEX)


_COLUMNS = ["group", "key", "id", "label", "vector", "asked", "angles", "norm", "floor"]
_INDEX = "group int, key long, id long, label long, vector array<int>, asked boolean, angles array<float>, norm double, floor long"


@dataclass
class Routes:
    """The extreme angles and norms of the groups, ``step`` neighbouring groups together."""

    step: int
    groups: int
    numbers: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray
    most: np.ndarray


def _routes(index: DataFrame, n: int) -> Routes:
    groups = (index.agg(F.max("group")).first()[0] or 0) + 1
    step = -(-groups // ROUTES)
    extremes = [f(F.get("angles", F.lit(j))) for f in (F.min, F.max) for j in range(n)]
    kept = [e.alias(f"e{i}") for i, e in enumerate(extremes)]
    found = index.groupBy(F.floor(F.col("group") / step).alias("g")).agg(*kept, F.min("norm").alias("least"), F.max("norm").alias("most"))
    rows = found.orderBy("g").toPandas()  # ROUTES rows at most
    body = rows[[f"e{i}" for i in range(2 * n)]].to_numpy(np.float64)
    return Routes(step, groups, rows["g"].to_numpy(np.int64), body[:, :n], body[:, n:], rows["least"].to_numpy(), rows["most"].to_numpy())


def _visits(anchors: DataFrame, routes: Routes) -> DataFrame:
    """The anchors, once for each group whose scores may lie in one of their windows."""
    shared = anchors.sparkSession.sparkContext.broadcast(routes)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, ANCHORS):
                b = batch.slice(at, ANCHORS)
                down, up = intervals(_matrix(b.column("angles"), np.float32), b.column("norm").to_numpy(), r.low, r.high, r.least, r.most)
                low, high = _matrix(b.column("low"), np.int64), _matrix(b.column("high"), np.int64)
                meets = (low[:, None] <= up[..., None]) & (high[:, None] >= down[..., None]) & (low <= high)[:, None]
                a, g = np.nonzero(meets.any(2))
                first = r.numbers[g] * r.step
                n = np.minimum(r.step, r.groups - first)
                bounds = np.concatenate(([0], np.cumsum(np.bincount(a, n, b.num_rows)))).astype(np.int32)
                each = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                column = pa.ListArray.from_arrays(pa.array(bounds), pa.array(each.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*b.columns, column], names=[*b.schema.names, "groups"])

    kinds = "anchor long, label long, vector array<int>, angles array<float>, norm double, low array<long>, high array<long>"
    return anchors.mapInArrow(choose, f"{kinds}, groups array<int>").withColumn("group", F.explode("groups")).drop("groups")


def _search(index: DataFrame, anchors: DataFrame, routes: Routes, same: bool, k: int) -> DataFrame:
    """Each group's best rows per anchor and window."""
    none = F.lit(None)
    rows = index.select(
        "group", F.lit(False).alias("asks"), "key", "id", "label", "vector", "angles", "norm", none.cast("array<long>").alias("low"), none.cast("array<long>").alias("high")
    )
    asks = _visits(anchors, routes).select(
        "group", F.lit(True).alias("asks"), F.col("anchor").alias("key"), none.cast("long").alias("id"), "label", "vector", "angles", "norm", "low", "high"
    )
    met = rows.unionByName(asks).repartition(routes.groups, "group").sortWithinPartitions("group", "asks", "key")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
        for b in batches:
            if b.num_rows:
                g, q = b.column("group").to_numpy(), b.column("asks").to_numpy(zero_copy_only=False)
                cuts = np.flatnonzero((g[1:] != g[:-1]) | (q[1:] != q[:-1])) + 1
                for s, e in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
                    yield int(g[s]), bool(q[s]), b.slice(s, e - s)

    def answer(group: Group, some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, some.num_rows, ANCHORS):
            b = some.slice(at, ANCHORS)
            keys, low = b.column("key").to_numpy(), _matrix(b.column("low"), np.int64)
            best = group.search(
                keys, b.column("label").to_numpy(), _matrix(b.column("vector"), np.int64), _matrix(b.column("angles"), np.float32),
                b.column("norm").to_numpy(), low, _matrix(b.column("high"), np.int64), same, k,
            )
            place, score, ids, own = best.rows
            slot = (place % low.shape[1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (keys[place // low.shape[1]], slot, ids, score, own)], names=["anchor", "slot", "id", "score", "key"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, group = -1, [], None
        for g, asks, b in runs(batches):
            if g != number:
                number, held, group = g, [], None
            if not asks:
                held.append(b)
                continue
            if group is None:
                own = pa.Table.from_batches(held).combine_chunks()
                held = []
                x, theta = _matrix(own["vector"].chunk(0), np.int64), _matrix(own["angles"].chunk(0), np.float32)
                group = Group(own["key"].to_numpy(), own["id"].to_numpy(), own["label"].to_numpy(), x, theta, own["norm"].to_numpy())
            yield from answer(group, b)

    return met.mapInArrow(scan, _FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of all groups per anchor and window, with their place from 1."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "key")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(table: DataFrame, id_col: str, label: str, vector: str, anchors: Column, rule: Rule = Rule()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vector`` holds whole numbers (see ``whole``), ``label`` is an integer. A score is the inner product; higher come
    first, then smaller ids. Positives are an anchor's first other rows of its label; negatives, per positive, the first
    rows of other labels with ``low * positive <= 100 * negative <= high * positive``, ``low`` being less than ``high``.
    A positive of negative score has none.

    Rows with a null id, label, vector or component take no part, nor do vectors whose squared length is 2**62 or more
    (whose scores need not fit a long) and those of another length than most have. Rows that repeat id, label and vector
    count once; rows that share only the id are rows of their own, each an anchor if the id is one. Other columns, whatever
    their names, are not looked at. Empty tables give no rows.
    """
    spark: SparkSession = table.sparkSession
    kept = table.select(
        F.col(id_col).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<long>").alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("asked"),
    )
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    kept = kept.where("id IS NOT NULL AND label IS NOT NULL").where(F.coalesce(square < float(1 << 62), F.lit(False)))
    lengths = kept.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not lengths or not lengths[0]["d"]:
        return spark.createDataFrame([], out)
    d, total = lengths[0]["d"], lengths[0]["count"]
    kept = kept.where(F.size("vector") == d).withColumn("vector", F.col("vector").cast("array<int>"))

    rate = max(1, int(min(1.0, 2 * SAMPLE / total) * (1 << 24)))
    drawn = kept.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 24)) < rate)
    sample = drawn.orderBy(F.xxhash64("id", F.lit("order")), "id", "label", "vector").limit(min(SAMPLE, GROUP_BYTES // (8 * d) + 1)).select("vector").toPandas()
    x = np.stack(list(sample["vector"])).astype(np.float64) if len(sample) else np.eye(1, d)
    refs = directions(x)

    largest = max(1, GROUP_BYTES // (8 * d))
    groups = max(-(-total // largest), min(2 * spark.sparkContext.defaultParallelism, -(-total // LEAST_ROWS)))
    index = stage(_index(kept, refs, groups, rule.positives), "angles")
    routes = _routes(index, len(refs))

    asked = index.where("asked").withColumnRenamed("key", "anchor")
    body = ["anchor", "label", "vector", "angles", "norm"]
    free = asked.select(*body, F.array("floor").alias("low"), F.array(F.lit(int(HIGH))).alias("high"))
    near = _first(_search(index, free, routes, True, rule.positives), rule.positives)
    near = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("near"))
    near = stage(asked.select(*body, F.col("id").alias("anchor_id")).join(near, "anchor"), "positives")

    score = F.col("near.score")
    filled = [F.transform(score, lambda s: F.when(s >= 0, edge(s)).otherwise(F.lit(other))) for edge, other in (
        (lambda s: F.call_function("div", s.cast("decimal(20,0)") * rule.low + 99, F.lit(100)), 1),
        (lambda s: F.call_function("div", s.cast("decimal(20,0)") * rule.high, F.lit(100)), 0),
    )]
    wanted = [F.concat(c.cast("array<long>"), F.array_repeat(F.lit(v), F.lit(rule.positives) - F.size(c)).cast("array<long>")) for c, v in zip(filled, (1, 0), strict=True)]
    windows = near.select(*body, wanted[0].alias("low"), wanted[1].alias("high"))
    far = _first(_search(index, windows, routes, False, rule.negatives), rule.negatives)
    positives = near.select("anchor", "anchor_id", F.posexplode("near").alias("slot", "positive"))
    return far.join(positives, ["anchor", "slot"]).select(
        "anchor_id", F.col("positive.id").alias("positive_id"), F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )

