"""Documents to token ids in five stages, each written to the shared folder and read back as the next one's input.

Every stage keeps clean documents and, but for the last, returns the columns of the documents it was given. Tables
besides the documents (labels, benchmark) come from ``sf_dir``. Rows that repeat a document pass all stages but that
of near duplicates, which keeps one row of each group, whatever the ids: they may be null or repeat.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidesift.llm import jaccard_tree, langid_cnn, quality, sentencepiece_table
from tidesift.llm.queries import fit_language, fit_quality, leaks, table
from tidesift.sources.scratch import stage

#: A document's language is refused if it is unknown, or if the model is surer than this that it is another than stated.
SURE = 0.9
#: Documents less likely of quality than this go.
LEAST_QUALITY = 0.3


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name = "_" + name
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (no letters), and those surely in another language than they state."""
    model = fit_language(docs)
    lang, score = _free(docs, "lang_pred"), _free(docs, "lang_score")
    found = langid_cnn.predict(docs, model, "text", lang, score)
    wrong = F.col("lang").isNotNull() & (F.col(lang) != F.col("lang")) & (F.col(score) >= SURE)
    refused = (F.col(lang) == langid_cnn.UNKNOWN) | wrong
    return found.where(~refused).select(docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier refuses."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    score = _free(docs, "quality_score")
    return quality.score(docs, model, "text", score).where(F.col(score) >= LEAST_QUALITY).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id of each group of near duplicates, null ids last and equal ids by text.

    Rows are told apart by id and text, not by the id alone. Texts without words are in no group, and all are kept.
    """
    key, size, own = (_free(docs, c) for c in ("row_key", "row_size", "row_own"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    keyed = docs.withColumn(key, F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), digest))
    joined = jaccard_tree.join(keyed, key, "text", jaccard_tree.Rule())
    first = joined.where(F.col("doc_id").eqNullSafe(F.col("component"))).select(F.col("doc_id").alias(key), F.col("size").alias(size))
    kept = keyed.join(first.distinct().hint("merge"), key).withColumn(own, F.when(F.col(size) == 0, F.monotonically_increasing_id()))
    return kept.groupBy(key, own).agg(F.min(F.struct(docs.columns)).alias("row")).select("row.*")


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    out = _free(docs, "leaks")
    return leaks(docs, table(spark, sf_dir, "benchmark"), out).where(F.size(out) == 0).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, ids, n_tokens`` and the bytes of the text that the ids decode to."""
    rows = docs.select("doc_id", "lang", "source", "text")
    coded = sentencepiece_table.encode(rows, "text", public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), F.octet_length("decoded").alias("decoded_bytes"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", clean_of_benchmark),
    ("sentencepiece", token_ids),
]

#: The classifiers and the tokenizer are beyond SQL; tests check stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
