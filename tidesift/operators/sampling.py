"""Exact and repeatable resampling, shuffling and splitting.

The order of rows inside a class is that of the md5 of seed and id: the same on
every engine, every cluster size and every retry. Nothing here windows over a
whole class. A row's place is found from counts per hash prefix, and only the
rows of one prefix are ever sorted together.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidesift.sources.local import local_frame

SEED = 42
PREFIX = 4  # hex digits: up to 65 536 prefixes per class
# A row drawn more often than this has its draws spread over several tasks.
DRAWS_PER_SALT = 1000


def hash_key(seed: int, *columns: str) -> Column:
    """Hex digest that orders rows at random."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def _hash_number(digest: Column) -> Column:
    """The first 60 bits of a hex digest."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def class_counts(df: DataFrame, label: str) -> dict[str, int]:
    """Rows per class, on the driver: one entry per class."""
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}


def _keyed(df: DataFrame, id_col: str, label: str, seed: int) -> DataFrame:
    key = hash_key(seed, id_col)
    return df.select(F.col(label).alias("label"), F.col(id_col).alias("id"), key.alias("key")).withColumn(
        "prefix", F.substring("key", 1, PREFIX)
    )


def _prefix_offsets(keyed: DataFrame) -> DataFrame:
    """Rows of a class before each prefix: at most 65 536 rows per class."""
    counts = keyed.groupBy("label", "prefix").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("label").orderBy("prefix"))
    return counts.withColumn("before", upto - F.col("n"))


def rank_in_class(df: DataFrame, id_col: str = "doc_id", label: str = "label", seed: int = SEED) -> DataFrame:
    """``(label, id, rank)`` with ranks 1..n in the random order of each class."""
    keyed = _keyed(df, id_col, label, seed)
    local = F.row_number().over(Window.partitionBy("label", "prefix").orderBy("key", "id"))
    ranked = keyed.withColumn("local", local).join(_prefix_offsets(keyed), ["label", "prefix"])
    return ranked.select("label", "id", (F.col("before") + F.col("local")).alias("rank"))


def _per_class(label: Column, values: dict, default) -> Column:
    """A constant per class."""
    out = F.lit(default)
    for name, value in values.items():
        out = F.when(label == name, F.lit(value)).otherwise(out)
    return out


def _cuts(df: DataFrame, id_col: str, label: str, seed: int, ranks: dict[str, list[int]]) -> dict[str, list[tuple]]:
    """The ``(key, id)`` of the row at each wanted rank (1-based) of each class.

    Needs two narrow passes: one counts prefixes, one sorts the rows of just the
    prefixes that hold a wanted rank. The driver gets one row per wanted rank.
    """
    spark = df.sparkSession
    wanted = sorted({(c, r) for c, rs in ranks.items() for r in rs})
    schema = f"label {df.schema[label].dataType.simpleString()}, wanted bigint"
    keyed = _keyed(df, id_col, label, seed)
    targets = F.broadcast(local_frame(spark, wanted, schema))
    at = (F.col("wanted") > F.col("before")) & (F.col("wanted") <= F.col("before") + F.col("n"))
    places = _prefix_offsets(keyed).join(targets, "label").filter(at).select("label", "prefix", "before", "wanted")
    near = keyed.join(F.broadcast(places.select("label", "prefix").distinct()), ["label", "prefix"])
    local = F.row_number().over(Window.partitionBy("label", "prefix").orderBy("key", "id"))
    rows = (
        near.withColumn("local", local)
        .join(F.broadcast(places), ["label", "prefix"])
        .filter(F.col("before") + F.col("local") == F.col("wanted"))
        .select("label", "wanted", "key", "id")
        .collect()
    )
    found = {(r["label"], r["wanted"]): (r["key"], r["id"]) for r in rows}
    return {c: [found[c, r] for r in rs] for c, rs in ranks.items()}


def _cuts_passed(cuts: dict[str, list[tuple]], id_col: str, label: str, seed: int) -> Column:
    """How many of its class's cuts a row lies behind; a row on a cut lies before it."""
    key, row_id = hash_key(seed, id_col), F.col(id_col)
    passed = F.lit(0)
    for name, points in cuts.items():
        behind = F.lit(0)
        for cut_key, cut_id in points:
            after = (key > cut_key) | ((key == cut_key) & (row_id > cut_id))
            behind = behind + after.cast("int")
        passed = F.when(F.col(label) == name, behind).otherwise(passed)
    return passed


def stratified_split(
    df: DataFrame, test_share: float = 0.2, id_col: str = "doc_id", label: str = "label", seed: int = SEED
) -> DataFrame:
    """Adds ``split``: the class's first ``round(share * n)`` rows in random order are ``test``.

    The rows do not move: each compares its hash with its class's cut.
    """
    sizes = class_counts(df, label)
    tests = {c: int(n * test_share + 0.5) for c, n in sizes.items()}
    cuts = _cuts(df, id_col, label, seed, {c: [k] for c, k in tests.items() if k > 0})
    has_test = F.col(label).isin(list(cuts)) if cuts else F.lit(False)
    is_test = has_test & (_cuts_passed(cuts, id_col, label, seed) == 0)
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def stratified_folds(
    df: DataFrame, folds: int = 5, id_col: str = "doc_id", label: str = "label", seed: int = SEED
) -> DataFrame:
    """Adds ``fold`` 0..folds-1; each class falls into parts that differ by one row at most."""
    sizes = class_counts(df, label)
    # The row at rank r of n belongs to fold floor((r - 1) * folds / n), so fold
    # k begins behind rank ceil(k * n / folds).
    ends = {c: [-(-k * n // folds) for k in range(1, folds)] for c, n in sizes.items()}
    return df.withColumn("fold", _cuts_passed(_cuts(df, id_col, label, seed, ends), id_col, label, seed))


def resample_classes(
    df: DataFrame, targets: DataFrame, id_col: str = "doc_id", label: str = "label", seed: int = SEED
) -> DataFrame:
    """Draws exactly ``target`` rows per class with replacement.

    Adds ``draw``, the number of the draw in its class; ``(label, draw)`` is the
    new key. Draws are generated in parallel, meet the narrow ranked ids, and
    only then fetch the rows. The rows of a small class are drawn again and
    again, so they are copied under as many salts as their draws need: at most
    one copy per ``DRAWS_PER_SALT`` draws on top of the rows themselves. The
    table is read several times: pass one that was written before.
    """
    sizes = class_counts(df, label)
    plan = targets.select(label, "target").collect()
    wanted = {r[label]: r["target"] for r in plan if sizes.get(r[label]) and r["target"] > 0}
    if not wanted:
        return df.withColumn("draw", F.lit(None).cast("bigint")).limit(0)
    copies = {c: -(-t // (sizes[c] * DRAWS_PER_SALT)) for c, t in wanted.items()}
    salts = F.explode(F.sequence(F.lit(0), _per_class(F.col(label), copies, 1) - 1))

    name, first = F.lit(None), F.lit(None)
    start = 0
    for c in sorted(wanted):
        here = (F.col("id") >= start) & (F.col("id") < start + wanted[c])
        name = F.when(here, F.lit(c)).otherwise(name)
        first = F.when(here, F.lit(start)).otherwise(first)
        start += wanted[c]
    draws = df.sparkSession.range(start).select(name.alias(label), (F.col("id") - first + 1).alias("draw"))
    draws = draws.select(
        label,
        "draw",
        (F.pmod(_hash_number(hash_key(seed, label, "draw")), _per_class(F.col(label), sizes, 1)) + 1).alias("rank"),
        F.pmod("draw", _per_class(F.col(label), copies, 1)).cast("int").alias("_salt"),
    )
    ranked = rank_in_class(df, id_col, label, seed).select(F.col("label").alias(label), F.col("id").alias(id_col), "rank")
    drawn = draws.join(ranked.withColumn("_salt", salts), [label, "rank", "_salt"])
    return df.withColumn("_salt", salts).join(drawn.select(id_col, "_salt", "draw"), [id_col, "_salt"]).drop("_salt")


def shuffle_rows(df: DataFrame, *keys: str, seed: int = SEED) -> DataFrame:
    """All rows in a random order that the seed and the key columns fix: one range sort."""
    return df.orderBy(hash_key(seed, *keys), *keys)


# The forest's search space.
PARAM_SPACE = {
    "n_estimators": [100, 200, 300, 400, 500],
    "max_depth": [None, 10, 20, 30, 50],
    "min_samples_split": [2, 5, 10, 15],
    "min_samples_leaf": [1, 2, 4, 6],
    "max_features": ["sqrt", "log2", 0.3, 0.5],
    "bootstrap": [True, False],
}


def sample_param_grid(space: dict[str, list] = PARAM_SPACE, n: int = 30, seed: int = SEED) -> list[dict]:
    """``n`` different combinations of the space, drawn at random."""
    size = 1
    for values in space.values():
        size *= len(values)
    picks = []
    for number in random.Random(seed).sample(range(size), min(n, size)):
        combo = {}
        for name, values in space.items():
            number, at = divmod(number, len(values))
            combo[name] = values[at]
        picks.append(combo)
    return picks


#: Settings of the space that Spark's forest has, with the greatest depth it takes, which stands for none.
SPARK_SETTINGS = ("n_estimators", "max_depth", "min_samples_leaf", "max_features", "bootstrap")
MAX_DEPTH = 30


def effective_space(space: dict[str, list] = PARAM_SPACE) -> dict[str, list]:
    """The space of models that differ in Spark: settings it has, values it tells apart.

    There is no smallest size of a node to be split, and depths over ``MAX_DEPTH`` are that depth.
    """
    depth = lambda d: MAX_DEPTH if d is None else min(d, MAX_DEPTH)
    known = {k: [depth(v) for v in values] if k == "max_depth" else values for k, values in space.items() if k in SPARK_SETTINGS}
    return {k: list(dict.fromkeys(values)) for k, values in known.items()}
