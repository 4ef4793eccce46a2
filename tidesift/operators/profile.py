"""Profiling, filtering and removing copies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidesift.functions.text import is_blank


def drop_missing_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.filter(F.col(text).isNotNull())


def dedup_keep_first(df: DataFrame, text: str = "text", order_col: str = "doc_id") -> DataFrame:
    """One row per exact text: the one first in input order.

    The row travels as the minimum of an aggregate, so the copies of one text
    meet in each map task before the shuffle, however many there are. The hash
    leads the key to make comparing long texts cheap; the text keeps it exact.
    """
    row = F.struct(order_col, *[c for c in df.columns if c not in (order_col, text)])
    first = df.groupBy(F.xxhash64(text).alias("_hash"), text).agg(F.min(row).alias("_row"))
    return first.select(*[F.col(text) if c == text else F.col(f"_row.{c}").alias(c) for c in df.columns])


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, as ``(column_name, nulls)`` rows."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls")


def duplicate_count(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows beyond the first of each text; nulls are equal to each other."""
    groups = df.groupBy(F.xxhash64(text).alias("_hash"), text).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def stage_audit(df: DataFrame, text: str, processed: str, order_col: str = "doc_id") -> DataFrame:
    """Rows in, out and removed at each stage, from one pass over flagged rows.

    ``df`` holds the raw rows with their processed text. Rows are counted per
    text before the shuffle; a text's first row decides whether it is empty.
    """
    per_text = df.groupBy(F.xxhash64(text).alias("_hash"), text).agg(
        F.count("*").alias("n"),
        F.min_by(is_blank(F.col(processed)), order_col).alias("empty"),
    )
    return _stages(per_text, text)


def audit_texts(df: DataFrame, prepare: Callable[[DataFrame], DataFrame], text: str, processed: str) -> DataFrame:
    """``stage_audit`` of raw rows: ``prepare`` adds the processed text, once to each different text."""
    counted = df.groupBy(F.xxhash64(text).alias("_hash"), text).agg(F.count("*").alias("n"))
    return _stages(prepare(counted).withColumn("empty", is_blank(F.col(processed))), text)


def _stages(per_text: DataFrame, text: str) -> DataFrame:
    """The audit of ``(text, n, empty)`` rows."""
    present = F.col(text).isNotNull()
    totals = per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("with_text"),
        F.count_if(present).alias("distinct_text"),
        F.count_if(present & ~F.col("empty")).alias("non_empty"),
    )
    steps = [("1_drop_missing", "raw", "with_text"), ("2_dedup", "with_text", "distinct_text"), ("3_drop_empty", "distinct_text", "non_empty")]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("stage"),
                F.col(before).alias("rows_in"),
                F.col(after).alias("rows_out"),
                (F.col(before) - F.col(after)).alias("removed"),
            )
            for name, before, after in steps
        ]
    )
    return totals.select(F.inline(rows))


def preview(df: DataFrame, columns: list[str], n: int = 5, order_col: str = "doc_id") -> DataFrame:
    """The first ``n`` rows in input order."""
    return df.orderBy(order_col).limit(n).select(*columns)


def drop_empty_processed(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows where each named text is non-blank (one column, or both in strict mode)."""
    for c in columns:
        df = df.filter(~is_blank(F.col(c)))
    return df
