"""Distributions, frequent terms and time trends: the tables behind the charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidesift.functions.text import tokenize
from tidesift.operators.features import bigrams
from tidesift.operators.joins import word_counts
from tidesift.operators.lexicon import CLASSES

# Share of the largest class each class is resampled to.
CLASS_FACTORS = {"Negatif": 1.15, "Positif": 0.92, "Netral": 0.88}


def label_distribution(df: DataFrame, label: str = "label", by: tuple[str, ...] = ()) -> DataFrame:
    """Rows and percentage per class, largest class first."""
    counts = df.groupBy(*by, label).agg(F.count("*").alias("n"))
    # The window runs over the counted classes, not over the rows.
    total = F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, 6)).orderBy(*by, F.desc("n"), label)


def class_targets(df: DataFrame, label: str = "label", factors: dict[str, float] = CLASS_FACTORS) -> DataFrame:
    """Rows each class shall have: a share of the largest class, cut to whole rows."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    base = F.max("n").over(Window.partitionBy())
    factor = F.lit(1.0)
    for name, value in factors.items():
        factor = F.when(F.col(label) == name, F.lit(value)).otherwise(factor)
    return counts.withColumn("target", (base * factor).cast("bigint"))


def top_words(df: DataFrame, n: int = 20, text: str = "processed_text") -> DataFrame:
    """The most frequent words; ties in alphabetical order."""
    return word_counts(df, tokenize(F.col(text))).orderBy(F.desc("n"), "word").limit(n)


def cloud_terms(
    df: DataFrame, by: str | None = None, k: int = 200, text: str = "processed_text", terms: Column | None = None
) -> DataFrame:
    """The ``k`` most frequent terms overall or per class, sized against the most frequent one.

    The rank filter is applied in each task before rows of a class meet, so the
    vocabulary of a large class is never sorted in one task.
    """
    keys = (by,) if by else ()
    counts = word_counts(df, tokenize(F.col(text)) if terms is None else terms, keys)
    if by is None:
        top = counts.orderBy(F.desc("n"), "word").limit(k)
    else:
        rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "word"))
        top = counts.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")
    return top.withColumn("rel", F.round(F.col("n") / F.max("n").over(Window.partitionBy(*keys)), 6))


def cloud_bigrams(df: DataFrame, by: str | None = None, k: int = 150, text: str = "processed_text") -> DataFrame:
    """``cloud_terms`` over words and pairs of neighbouring words."""
    staged = df.withColumn("_tokens", tokenize(F.col(text)))
    return cloud_terms(staged, by, k, terms=F.concat("_tokens", bigrams(F.col("_tokens"))))


def class_sizes(df: DataFrame, label: str = "label", text: str = "processed_text") -> DataFrame:
    """Texts and words per class."""
    words = F.size(tokenize(F.coalesce(text, F.lit(""))))
    return df.groupBy(label).agg(F.count("*").alias("texts"), F.sum(words).cast("bigint").alias("words"))


# -- time -------------------------------------------------------------------

_HAS_ZONE = r"(Z|[+-]\d{2}:?\d{2})$"


def parse_timestamp(c: Column) -> Column:
    """Text as UTC time, null where it cannot be read.

    Reads ``Wed Oct 10 20:19:24 +0000 2018`` and ISO 8601 with or without a
    zone; a time without a zone is UTC. The result has no zone of its own, so it
    does not change with the session's time zone.
    """
    c = F.trim(c)
    instant = F.coalesce(
        F.try_to_timestamp(F.substring(c, 5, 60), F.lit("MMM dd HH:mm:ss Z yyyy")),
        F.when(c.rlike(_HAS_ZONE), c.try_cast("timestamp")),
    )
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)
    return F.coalesce(utc, F.when(~c.rlike(_HAS_ZONE), c.try_cast("timestamp_ntz")))


def parse_timestamps(df: DataFrame, column: str = "created_at", keep_invalid: bool = False) -> DataFrame:
    """Replace a text column by its time and drop rows where it cannot be read."""
    parsed = df.withColumn(column, parse_timestamp(F.col(column)))
    return parsed if keep_invalid else parsed.filter(F.col(column).isNotNull())


def time_coverage(df: DataFrame, column: str = "created_at") -> DataFrame:
    """Rows with a readable time, and all rows."""
    return df.agg(
        F.count(parse_timestamp(F.col(column))).alias("valid"), F.count("*").alias("total")
    )


def _grain(grain: str, ts: Column) -> dict[str, Column]:
    """Group keys of a grain; the first one sorts the result."""
    # Formatted by way of the date: an hour that the session's zone skips would move.
    day = ts.cast("date")
    if grain == "month":
        return {"month": F.date_format(day, "yyyy-MM")}
    if grain == "weekday":
        return {"day_no": F.weekday(day), "weekday": F.date_format(day, "EEEE")}
    if grain == "hour":
        return {"hour": F.hour(ts)}
    raise ValueError(f"unknown grain {grain!r}; use month, weekday or hour")


def trend(
    df: DataFrame, grain: str, ts: str = "ts", label: str = "label", classes: list[str] = CLASSES
) -> DataFrame:
    """Rows per month, weekday or hour and class, with 0 where a class has none.

    ``ts`` is a UTC time. Classes are counted side by side in one aggregation.
    """
    keys = _grain(grain, F.col(ts))
    counts = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*[c.alias(name) for name, c in keys.items()])
        .agg(*[F.count_if(F.col(label) == c).alias(c) for c in classes])
    )
    return counts.orderBy(next(iter(keys)))
