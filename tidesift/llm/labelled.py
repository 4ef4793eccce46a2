"""Folds, and a bounded sample of labelled rows to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that is never learnt from; rows without an id belong to it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(True))


def sample(rows: DataFrame, id_col: str, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each label, never over twice that on average.

    A row is in when the hash of its id is below its label's rate, so the choice needs no sort of a
    class and is the same on every run. Labels are few; their counts are all that the driver sees.
    """
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return rows
    rate = F.lit(0.0)
    for value, n in counts.items():
        rate = F.when(F.col(label) == value, min(1.0, per_class / n)).otherwise(rate)
    place = F.pmod(F.xxhash64(id_col, F.lit("sample")), F.lit(1 << 24)) / F.lit(float(1 << 24))
    bound = 2 * per_class * len(counts)
    return rows.where(place < rate).orderBy(place, id_col).limit(bound)


def training(labels: DataFrame, docs: DataFrame, column: str, per_class: int) -> tuple[DataFrame, float | None]:
    """``(text, label)`` of a bounded sample of the documents labelled 0 or 1 that are not held out, and the share of label 1."""
    known = labels.where(~held_out()).select("doc_id", F.col(column).cast("double").alias("label"))
    known = known.where(F.col("label").isin(0.0, 1.0))
    share = known.agg(F.avg("label")).first()[0]
    chosen = sample(known, "doc_id", "label", per_class)  # bounded by the sample, so it may be broadcast
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label"), share
