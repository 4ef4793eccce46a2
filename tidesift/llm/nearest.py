"""Nearest neighbours by multi-index hashing.

1. Rotations learnt on a bounded sample (principal axes, then turned so that signs lose least) give each vector a
   binary code, one bit per dimension and rotation. The radius is learnt with them: it holds ``RECALL`` of the true
   neighbours within the sample, which are farther away than those among all rows.
2. Rows are dealt out in blocks of bounded size. A block's codes are split into substrings, each of which is indexed:
   a table of places by the substring's value.
3. Two codes within radius ``r`` have a substring within ``r / substrings``. So probing each table with all values
   that near retrieves every code within the radius, and the distance of the codes confirms them.
4. What is retrieved is ranked by the exact distance of the vectors; each block keeps the nearest per query.
5. Queries whose radius held fewer than ``k`` codes in all blocks go round again with a wider one, up to all bits.

Copies of one vector are kept as often as a query can need them, which is found before anything is gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidesift.sources.scratch import stage

#: Rows that the rotation is learnt on; rows and queries in a block; pairs ranked at a time.
SAMPLE, ROWS, QUERIES, STEP = 20_000, 16_384, 16_384, 1 << 18
#: Bits of a substring, rotations, and the share of neighbours that the first radius is to hold.
PART, TURNS, RECALL = 16, 2, 0.96


def usable(vector: str) -> Column:
    """Not null, without null, NaN or infinite components, and not all zero."""
    c = F.col(vector)
    odd = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return c.isNotNull() & ~odd & F.exists(c, lambda x: x != 0)


@dataclass
class Model:
    """Mean, rotations side by side, and the first radius to probe."""

    mean: np.ndarray
    axes: np.ndarray
    radius: int = 0

    @property
    def bits(self) -> int:
        return -(-self.axes.shape[1] // PART) * PART

    def codes(self, x: np.ndarray) -> np.ndarray:
        """A row of substrings for each vector."""
        bits = (x - self.mean) @ self.axes > 0
        full = np.zeros((len(bits), self.bits), bool)
        full[:, : bits.shape[1]] = bits
        return np.ascontiguousarray(np.packbits(full, axis=1)).view(np.uint16)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def _turned(x: np.ndarray, seed: int, steps: int = 30) -> np.ndarray:
    """A rotation found by alternating between signs and the best rotation to them."""
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(x.shape[1], x.shape[1])))
    for _ in range(steps):
        u, _, v = np.linalg.svd(x.T @ np.where(x @ turn > 0, 1.0, -1.0))
        turn = u @ v
    return turn


def learn(sample: np.ndarray, k: int, probes: int = 256) -> Model:
    mean = sample.mean(0)
    x = sample - mean
    _, vectors = np.linalg.eigh(x.T @ x)
    x = x @ vectors
    model = Model(mean, np.concatenate([vectors @ _turned(x, seed) for seed in range(TURNS)], 1))
    codes = model.codes(sample)
    bits = []
    for i in range(0, len(sample), max(1, len(sample) // probes)):
        far = ((sample - sample[i]) ** 2).sum(1)
        far[i] = np.inf
        near = np.argpartition(far, min(k, len(far)) - 1)[:k]
        bits.append(distances(codes[near[near != i]], codes[i]))
    model.radius = int(np.ceil(np.quantile(np.concatenate(bits), RECALL))) if len(sample) > 1 else model.bits
    return model


def masks(radius: int) -> np.ndarray:
    """All substrings with at most so many bits, fewest first."""
    out = [sum(1 << b for b in bits) for n in range(min(radius, PART) + 1) for bits in combinations(range(PART), n)]
    return np.array(out, np.uint16)


def within(rows: np.ndarray, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of query and row whose codes differ in at most ``radius`` bits, some queries at a time."""
    parts = rows.shape[1]
    flips = masks(radius // parts)
    step = max(1, STEP // len(flips))
    tables = []
    for t in range(parts):
        order = np.argsort(rows[:, t], kind="stable")
        tables.append((order, np.concatenate(([0], np.cumsum(np.bincount(rows[:, t], minlength=1 << PART))))))
    for at in range(0, len(queries), step):
        found = []
        for t, (order, starts) in enumerate(tables):
            keys = (queries[at : at + step, t, None] ^ flips[None]).astype(np.int64)
            first, n = starts[keys], starts[keys + 1] - starts[keys]
            q, k = np.nonzero(n)
            n, first = n[q, k], first[q, k]
            each = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + first[each]
            found.append(q[each] * len(rows) + order[place])
        pairs = np.unique(np.concatenate(found))
        q, r = pairs // len(rows) + at, pairs % len(rows)
        keep = distances(queries[q], rows[r]) <= radius
        yield q[keep], r[keep]


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column])


def _round(rows: DataFrame, queries: DataFrame, model, k: int, radius: int) -> DataFrame:
    """``query_id, vec_id, score`` of the nearest in each block, and once per query and block ``n``, the codes in reach."""
    n_rows, n_queries = -(-max(1, rows.count()) // ROWS), -(-max(1, queries.count()) // QUERIES)
    left = rows.withColumn("b", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_rows)).cast("int"))
    left = left.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    right = queries.withColumn("c", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(n_queries)).cast("int"))
    right = right.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))

    def search(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": [], "n": []}
        if len(own) and len(asked):
            x, q = matrix(own["vector"]), matrix(asked["vector"])
            ids, asked_ids = own["id"].to_numpy(), asked["id"].to_numpy()
            m: Model = model.value
            for a, b in within(m.codes(x), m.codes(q), radius):
                a, b = (v[asked_ids[a] != ids[b]] for v in (a, b))
                score = np.concatenate([
                    np.sqrt(((q[a[i : i + STEP // 8]] - x[b[i : i + STEP // 8]]) ** 2).sum(1)) for i in range(0, max(1, len(a)), STEP // 8)
                ])
                order = np.lexsort((ids[b], score, a))
                a, b, score = a[order], b[order], score[order]
                n = np.bincount(a, minlength=len(q))
                place = np.arange(len(a)) - (np.cumsum(n) - n)[a]
                keep = place < k
                out["query_id"].append(asked_ids[a[keep]])
                out["vec_id"].append(ids[b[keep]])
                out["score"].append(score[keep])
                out["n"].append(np.where(place[keep] == 0, n[a[keep]], 0))
        types = {"query_id": np.int64, "vec_id": np.int64, "score": np.float64, "n": np.int64}
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, types[c]) for c, v in out.items()})

    pairs = left.groupBy("b", "c").cogroup(right.groupBy("b", "c"))
    return pairs.applyInPandas(search, "query_id long, vec_id long, score double, n long")


def nearest(table: DataFrame, id_col: str, vector: str, queries: Column, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` rows found nearest to each row that ``queries`` holds for.

    Nearness is the Euclidean distance in double precision, ties go to the smaller id, a row is no answer to itself.
    Vectors that are null, all zero, or hold null or non-finite components take no part, as rows without an id and
    vectors of another length than most have. With ``k`` candidates or fewer all are returned. Rows that repeat id and
    vector count once; of rows with one id and other vectors each is a candidate, and each query. Other columns are
    not looked at.
    """
    spark = table.sparkSession
    rows = table.withColumn("__query", F.coalesce(queries, F.lit(False))).where(usable(vector) & F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.col("__query").alias("asked"))
    rows = stage(rows.dropDuplicates(["id", "vector"]), "vectors")
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == lengths[0]["d"])
    total = lengths[0]["count"]
    # of equal vectors a query needs k others, the first by id
    kept = rows.withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("place") <= k + 1)
    kept = stage(kept.select("id", "vector"), "kept")
    asked = rows.where("asked").select("id", "vector")

    share = min(1.0, 2 * SAMPLE / total)
    drawn = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 24)) < int(share * (1 << 24)) + 1
    sample = kept.where(drawn).orderBy(F.xxhash64("id", F.lit("order")), "id").limit(SAMPLE).select("vector").toPandas()
    if not len(sample):
        sample = kept.orderBy("id").limit(SAMPLE).select("vector").toPandas()
    model = learn(matrix(sample["vector"]), k)
    shared = spark.sparkContext.broadcast(model)  # as large as TURNS square matrices of the dimension

    radius, found = model.radius, []
    left = asked
    while True:
        part = stage(_round(kept, left, shared, k, radius), "near")
        seen = part.groupBy("query_id").agg(F.sum("n").alias("n")).where(F.col("n") >= k)
        short = stage(left.join(seen.select(F.col("query_id").alias("id")), "id", "left_anti"), "short")
        last = radius >= model.bits or short.isEmpty()
        found.append(part if last else part.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti"))
        if last:
            break
        left, radius = short, min(model.bits, radius + model.bits // 16)
    near = reduce(DataFrame.unionAll, found).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

