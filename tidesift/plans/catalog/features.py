"""Queries: encoded labels, terms, vocabulary, TF-IDF and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidesift.operators import features as ft, preprocess as pp
from tidesift.plans.catalog.base import SQL_LABELLED, labelled, query, tables
from tidesift.plans.catalog.texts import SQL_TURN_CTES, turns
from tidesift.sources.scratch import stage


@query(f"{SQL_LABELLED} SELECT doc_id, label, (dense_rank() OVER (ORDER BY label) - 1)::INT AS label_idx FROM labelled")
def encode_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(labelled(spark, sf).select("doc_id", "label"), "labelled")
    encoded, _ = ft.encode_labels(rows)
    return encoded


@query(f"{SQL_LABELLED} SELECT doc_id, label, label AS decoded FROM labelled")
def decode_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(labelled(spark, sf).select("doc_id", "label"), "labelled")
    encoded, classes = ft.encode_labels(rows)
    return encoded.select("doc_id", "label", ft.decode_labels(F.col("label_idx"), classes).alias("decoded"))


_SQL_TERMS = """
tok AS (SELECT doc_id, list_filter(string_split(processed_text, ' '), lambda w: length(w) >= 2) AS l FROM labelled),
terms AS (
  SELECT doc_id, unnest(l) AS term FROM tok
  UNION ALL SELECT doc_id, l[i] || ' ' || l[i + 1] FROM (
    SELECT doc_id, l, unnest(generate_series(1, len(l) - 1)) AS i FROM tok WHERE len(l) > 1)),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term)"""
SQL_VOCABULARY = f"""{_SQL_TERMS},
vocabulary AS (
  SELECT term, df, tf, row_number() OVER (ORDER BY term) - 1 AS idx
  FROM (SELECT term, count(*) AS df, sum(tf)::BIGINT AS tf FROM tfs GROUP BY term HAVING count(*) >= 3 ORDER BY tf DESC, term LIMIT 20000)),
corpus AS (SELECT count(*) AS n FROM labelled)"""


def _sql_tfidf(tfs: str) -> str:
    return f"""raw AS (
  SELECT t.doc_id, v.idx, (1 + ln(t.tf)) * (ln((1.0 + c.n)::DOUBLE / (1.0 + v.df)::DOUBLE) + 1) AS value
  FROM {tfs} t JOIN vocabulary v USING (term) CROSS JOIN corpus c)
SELECT doc_id, idx::INT AS idx, round(value / sqrt(sum(value * value) OVER (PARTITION BY doc_id)), 6) AS value FROM raw"""


@query(f"{SQL_LABELLED}, {_SQL_TERMS} SELECT doc_id, term, tf::INT AS tf FROM tfs")
def ngrams_1_2(spark: SparkSession, sf: str) -> DataFrame:
    return ft.add_term_counts(labelled(spark, sf)).select("doc_id", F.inline("term_counts"))


@query(f"{SQL_LABELLED}, {SQL_VOCABULARY} SELECT term, df, tf, idx::INT AS idx FROM vocabulary")
def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return ft.vocabulary_terms(labelled(spark, sf))


def _fitted(rows: DataFrame) -> ft.TfidfModel:
    return ft.TfidfModel.of(ft.fit_tfidf(rows))


def _rounded(df: DataFrame) -> DataFrame:
    return ft.long_form(df).withColumn("value", F.round("value", 6))


@query(f"{SQL_LABELLED}, {SQL_VOCABULARY}, {_sql_tfidf('tfs')}")
def tfidf_sublinear(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(labelled(spark, sf).select("doc_id", "processed_text"), "labelled")
    return _rounded(_fitted(rows).transform(rows))


@query(f"""{SQL_LABELLED}, {SQL_VOCABULARY}, {SQL_TURN_CTES},
turn_tok AS (SELECT doc_id, list_filter(string_split(processed_text, ' '), lambda w: length(w) >= 2) AS l FROM turn_processed),
turn_tfs AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(l) AS term FROM turn_tok
    UNION ALL SELECT doc_id, l[i] || ' ' || l[i + 1] FROM (
      SELECT doc_id, l, unnest(generate_series(1, len(l) - 1)) AS i FROM turn_tok WHERE len(l) > 1)) GROUP BY doc_id, term),
{_sql_tfidf('turn_tfs')}
""")
def tfidf_transform(spark: SparkSession, sf: str) -> DataFrame:
    """Vocabulary of the documents, applied to the conversation turns."""
    new = pp.preprocess_for_scoring(turns(spark, sf), tables(spark), light=None)
    return _rounded(_fitted(labelled(spark, sf)).transform(new))


@query(f"{SQL_LABELLED}, {SQL_VOCABULARY}, {_sql_tfidf('tfs')}")
def assemble_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The entries of the documents' vectors."""
    rows = stage(labelled(spark, sf).select("doc_id", "processed_text"), "labelled")
    model = _fitted(rows)
    return ft.vector_entries(ft.assemble_vectors(model.transform(rows), model.size)).withColumn("value", F.round("value", 6))


@query(f"""{SQL_LABELLED}
SELECT label, count(*) AS n, round(sum(count(*)) OVER ()::DOUBLE / (count(*) OVER () * count(*)), 6) AS weight FROM labelled GROUP BY label
""")
def class_weights_balanced(spark: SparkSession, sf: str) -> DataFrame:
    return ft.class_weights(labelled(spark, sf)).withColumn("weight", F.round("weight", 6))


