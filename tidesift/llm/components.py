"""Connected components of a table of links, without a node's links ever being gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidesift.sources.scratch import stage


def _both(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """``(a, b)`` of each row's pairs of columns, from one reading of the rows."""
    return df.select(F.inline(F.array(*[F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs])))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (or smaller) neighbours to the smallest node around it."""
    if large:
        around = _both(links, ("a", "b"), ("b", "a"))
    else:
        around = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = around.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    # Spark sizes the links by their files, too low, and might broadcast a side.
    met = around.join(lowest.hint("merge"), "a")
    if large:
        out = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = _both(met, ("b", "low"), ("a", "low"))
    return out.where(F.col("a") != F.col("b")).distinct()


def _stars_left(links: DataFrame) -> bool:
    """Whether each node has one link to a node that has none, or is such a node: another round would change nothing."""
    end = lambda c, up: F.struct(F.col(c).alias("id"), F.lit(up).alias("up"), F.lit(1 - up).alias("down"))
    nodes = links.select(F.inline(F.array(end("a", 1), end("b", 0)))).groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up + down > 1").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` of all nodes with a link but the roots; the root is the smallest id that can be reached.

    ``links`` has the columns ``a`` and ``b``, of one type that can be ordered; links with a null end join nothing.
    Alternates large and small stars until only stars are left, each round written to the shared folder.
    """
    links = links.select("a", "b").where(F.col("a") != F.col("b")).distinct()
    while True:
        links = stage(_star(_star(links, large=True), large=False), "links")
        if _stars_left(links):
            return links.select(F.col("a").alias("id"), F.col("b").alias("root"))
