"""Labels, terms, vocabulary and TF-IDF.

Counting and weighting the terms of one text needs that text only, so it is
done inside the row, on its sorted terms. Only the vocabulary, of a size fixed
beforehand, is shared between rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType

from tidesift.functions.lookup import LiteralMap
from tidesift.functions.once import compute_once
from tidesift.functions.text import case_fold, tokenize
from tidesift.operators.counts import count_terms
from tidesift.sources.local import local_frame
from tidesift.sources.scratch import stage

MAX_FEATURES = 20_000
#: Terms of a saved vocabulary that are read as a constant.
MAX_READ = 1_000_000
MIN_DF = 3
MIN_TERM = 2


def label_mapping(df: DataFrame, label: str = "label") -> DataFrame:
    """``(label, label_idx)``: classes in alphabetical order from 0."""
    classes = df.select(label).filter(F.col(label).isNotNull()).distinct()
    # One row per class reaches the window.
    return classes.withColumn("label_idx", F.row_number().over(Window.partitionBy().orderBy(label)) - 1)


def encode_labels(df: DataFrame, label: str = "label", classes: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Adds ``label_idx`` and returns the class names in its order."""
    if classes is None:
        classes = [r[label] for r in label_mapping(df, label).orderBy("label_idx").collect()]
    index = LiteralMap({c: k for k, c in enumerate(classes)}, "int")
    return df.withColumn("label_idx", index.get(F.col(label))), classes


def decode_labels(index: Column, classes: list[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in classes]), index.cast("int"))


def bigrams(tokens: Column) -> Column:
    """Pairs of neighbouring words."""
    last = F.greatest(F.size(tokens) - 1, F.lit(0))
    heads, tails = F.slice(tokens, F.lit(1), last), F.slice(tokens, F.lit(2), last)
    return F.zip_with(heads, tails, lambda a, b: F.concat(a, F.lit(" "), b))


def term_tokens(text: Column) -> Column:
    """Lower-case words of at least two characters."""
    words = tokenize(case_fold(F.coalesce(text, F.lit(""))))
    return F.filter(words, lambda w: F.char_length(w) >= MIN_TERM)


def add_terms(df: DataFrame, text: str = "processed_text", out: str = "terms") -> DataFrame:
    """Adds the words and word pairs of a text."""
    tokens = compute_once(df, {"_tokens": term_tokens(F.col(text))})
    return tokens.withColumn(out, F.concat("_tokens", bigrams(F.col("_tokens")))).drop("_tokens")


def add_term_counts(df: DataFrame, text: str = "processed_text", out: str = "term_counts") -> DataFrame:
    """Adds ``array<struct<term, tf>>``, one entry per different term.

    The terms are sorted; an entry's count is the distance to where the next
    different term starts.
    """
    sorted_ = compute_once(add_terms(df, text, "_terms"), {"_terms": F.sort_array("_terms")})
    size = F.size("_terms")
    positions = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    first = lambda i: (i == 0) | (F.get("_terms", i) != F.get("_terms", i - 1))
    starts = compute_once(sorted_, {"_starts": F.filter(positions, first)})
    entry = lambda start, i: F.struct(
        F.get("_terms", start).alias("term"),
        (F.coalesce(F.get("_starts", i + 1), size) - start).alias("tf"),
    )
    return compute_once(starts, {out: F.transform("_starts", entry)}).drop("_terms", "_starts")


@dataclass
class Vocabulary:
    """``terms``: ``(term, idx, df, tf, idf)``; ``documents``: number of texts."""

    terms: DataFrame
    documents: int


def vocabulary_terms(
    df: DataFrame, text: str = "processed_text", min_df: int = MIN_DF, max_features: int = MAX_FEATURES
) -> DataFrame:
    """``(term, idx, df, tf)``: terms of at least ``min_df`` texts, the most frequent ones.

    ``idx`` numbers them in alphabetical order. One shuffle by term, after each
    task has added up its own counts, of many texts together.
    """
    words = df.select(term_tokens(F.col(text)).alias("words"))
    counts = words.mapInArrow(count_terms, "term string, df long, tf long")
    stats = counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))
    top = stats.filter(F.col("df") >= min_df).orderBy(F.desc("tf"), "term").limit(max_features)
    # At most max_features rows reach the window.
    return top.withColumn("idx", F.row_number().over(Window.partitionBy().orderBy("term")) - 1)


def fit_tfidf(
    df: DataFrame, text: str = "processed_text", min_df: int = MIN_DF, max_features: int = MAX_FEATURES
) -> Vocabulary:
    """Learn the vocabulary and the smoothed inverse document frequencies."""
    documents = df.count()
    terms = vocabulary_terms(df, text, min_df, max_features)
    idf = F.log((F.lit(documents) + 1.0) / (F.col("df") + 1.0)) + 1.0
    return Vocabulary(terms.withColumn("idf", idf), documents)


class TfidfModel:
    """A fitted vocabulary, held as a constant of at most ``max_features`` terms."""

    def __init__(self, terms: list[tuple[str, int, float]]):
        self.terms = sorted(terms, key=lambda t: t[1])
        self.size = len(self.terms)

    @classmethod
    def of(cls, vocabulary: Vocabulary) -> "TfidfModel":
        return cls([(r["term"], r["idx"], r["idf"]) for r in vocabulary.terms.select("term", "idx", "idf").collect()])

    def frame(self, spark) -> DataFrame:
        return local_frame(spark, self.terms, "term string, idx int, idf double")

    def transform(self, df: DataFrame, text: str = "processed_text", out: str = "tfidf") -> DataFrame:
        """Adds ``array<struct<idx, value>>`` of unit length, sorted by idx; unknown terms count for nothing."""
        if not self.terms:
            return df.withColumn(out, F.array().cast("array<struct<idx:int,value:double>>"))
        # Spark ML counts the known terms of a text in a hash map, and gives them sorted by place in the list.
        known = CountVectorizerModel.from_vocabulary([term for term, _, _ in self.terms], "_terms", "_vector")
        counted = compute_once(known.transform(add_terms(df, text, "_terms")), {"_counts": F.unwrap_udt("_vector")}).drop("_terms", "_vector")
        numbers = lambda values, kind: F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")
        idxs, idfs = numbers([idx for _, idx, _ in self.terms], "int"), numbers([idf for _, _, idf in self.terms], "double")
        raw = F.zip_with(
            "_counts.indices", "_counts.values",
            lambda at, tf: F.struct(F.get(idxs, at).alias("idx"), ((F.log(tf) + 1.0) * F.get(idfs, at)).alias("value")),
        )
        weighed = compute_once(counted, {"_raw": raw}).drop("_counts")
        square = F.aggregate("_raw", F.lit(0.0), lambda s, e: s + e["value"] * e["value"])
        normed = compute_once(weighed, {"_norm": F.sqrt(square)})
        scale = lambda e: F.struct(e["idx"].alias("idx"), (e["value"] / F.col("_norm")).alias("value"))
        return compute_once(normed, {out: F.transform("_raw", scale)}).drop("_raw", "_norm")


def long_form(df: DataFrame, id_col: str = "doc_id", column: str = "tfidf") -> DataFrame:
    """``(id, idx, value)`` rows of the sparse entries."""
    return df.select(id_col, F.inline(column))


def _stored_vector(size: int, column: str) -> Column:
    """A sparse vector as Spark ML stores one: kind 0, size, indices and values."""
    none = F.array().cast
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        F.coalesce(F.col(f"{column}.idx"), none("array<int>")).alias("indices"),
        F.coalesce(F.col(f"{column}.value"), none("array<double>")).alias("values"),
    )


def assemble_vectors(df: DataFrame, size: int, column: str = "tfidf", out: str = "features") -> DataFrame:
    """Sparse vectors for Spark ML, of rows or a stream; null entries make an empty vector.

    No function turns a struct into the vector type it is stored as. A JSON reader that is given that type does, and
    doubles come back as they were, so no row passes through Python.
    """
    text = F.to_json(F.struct(_stored_vector(size, column).alias("v")))
    return df.withColumn(out, F.from_json(text, StructType([StructField("v", VectorUDT())]))["v"])


def vector_entries(df: DataFrame, id_col: str = "doc_id", column: str = "features") -> DataFrame:
    """``(id, idx, value)`` rows of sparse vectors."""
    stored = F.from_json(F.to_json(F.struct(F.col(column).alias("v"))), "v struct<indices:array<int>,values:array<double>>")["v"]
    return df.select(id_col, F.inline(F.arrays_zip(stored["indices"].alias("idx"), stored["values"].alias("value"))))


def stage_vectors(df: DataFrame, size: int, name: str, column: str = "tfidf", out: str = "features") -> DataFrame:
    """``assemble_vectors`` for a table that is written anyway: the file's columns are read back as vectors."""
    keep = [f for f in df.schema.fields if f.name != column]
    schema = StructType([*keep, StructField(out, VectorUDT())])
    return stage(df.select(*[f.name for f in keep], _stored_vector(size, column).alias(out)), name, schema)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``(label, n, weight)``: rows over classes times rows of the class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    every = Window.partitionBy()
    weight = F.sum("n").over(every) / (F.count("*").over(every) * F.col("n"))
    return counts.withColumn("weight", weight)


def add_class_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Adds its class's weight to each row; one constant per class."""
    weights = LiteralMap({r[label]: r["weight"] for r in class_weights(df, label).collect()}, "double")
    return df.withColumn(out, F.coalesce(weights.get(F.col(label)), F.lit(1.0)))
