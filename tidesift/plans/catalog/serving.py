"""Queries: scoring in batch, by request and on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidesift.operators import lexicon as lx, preprocess as pp, scoring as sc
from tidesift.operators.sampling import hash_key
from tidesift.plans.catalog.base import (
    SQL_TEXTS, SQL_WORD_TABLES, documents, event_texts, lexicon, query, sql_argmax, sql_proba, sql_score_cte,
    sql_token_ctes, table, tables,
)
from tidesift.plans.catalog.labelling import SQL_LISTS, corpus_lexicon
from tidesift.plans.catalog.texts import SQL_LEXICON_SCORED, SQL_TURN_CTES, SQL_TURNS, load_word_map, turns
from tidesift.sources.scratch import scratch_path, stage
from tidesift.streaming.score import read_requests, read_scored, score_batches, score_stream

CLASSES = lx.CLASSES


def given_probs() -> dict[str, Column]:
    """Stands for a model's output: three shares of the first hex digits of the id's hash."""
    key = hash_key(7, "doc_id")
    parts = [F.conv(F.substring(key, k, 2), 16, 10).cast("double") + 1 for k in (1, 3, 5)]
    total = parts[0] + parts[1] + parts[2]
    return {c: p / total for c, p in zip(CLASSES, parts)}


_SQL_PARTS = [f"(('0x' || substr(md5('7|' || doc_id), {k}, 2))::BIGINT::DOUBLE + 1)" for k in (1, 3, 5)]
_SQL_GIVEN = f"""given AS (
  SELECT doc_id, a / (a + b + c) AS "Negatif", b / (a + b + c) AS "Netral", c / (a + b + c) AS "Positif"
  FROM (SELECT doc_id, {_SQL_PARTS[0]} AS a, {_SQL_PARTS[1]} AS b, {_SQL_PARTS[2]} AS c FROM docs))"""
_LEX = sql_proba("coalesce(s.score, 0)")
_SQL_EVENT_DOCS = "(SELECT e.event_id, d.text FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id)"
SQL_BLENDED = f"""WITH {SQL_WORD_TABLES}, {sql_token_ctes(_SQL_EVENT_DOCS, "event_id", "")}, {_SQL_GIVEN},
{sql_score_cte("scores", "(SELECT * FROM proc_words)")},
mixed AS (
  SELECT d.doc_id, d.text, p.processed_text,
    {", ".join(f'g."{c}" * 0.5::DOUBLE + {_LEX[c]} * 0.5::DOUBLE AS "{c}"' for c in CLASSES)}
  FROM docs d JOIN given g USING (doc_id) LEFT JOIN processed p USING (doc_id) LEFT JOIN scores s USING (doc_id)),
blended AS (
  SELECT doc_id, text AS text_original, coalesce(processed_text, '') AS text_preprocessed,
    CASE WHEN processed_text IS NULL THEN 'Netral' ELSE {sql_argmax('"Negatif"', '"Netral"', '"Positif"')} END AS sentiment,
    CASE WHEN processed_text IS NULL THEN 0 ELSE round(greatest("Negatif", "Netral", "Positif"), 4) END AS confidence,
    {", ".join(f'CASE WHEN processed_text IS NULL THEN 0 ELSE round("{c}", 4) END AS "prob_{c}"' for c in CLASSES)}
  FROM mixed)
"""


def blended(spark: SparkSession, sf: str) -> DataFrame:
    ready = pp.preprocess_for_scoring(event_texts(spark, sf).select("doc_id", "text"), tables(spark))
    return sc.score_given(ready, given_probs(), lexicon(spark), tables(spark))


@query(f"{SQL_BLENDED} SELECT * FROM blended")
def score_blended_given(spark: SparkSession, sf: str) -> DataFrame:
    return blended(spark, sf)


@query(f"{SQL_BLENDED} SELECT * FROM blended WHERE text_preprocessed = ''")
def empty_result(spark: SparkSession, sf: str) -> DataFrame:
    return blended(spark, sf).filter(F.col("text_preprocessed") == "")


_SQL_GIVEN_DOCS = f"WITH docs AS (SELECT doc_id FROM documents), {_SQL_GIVEN}"


@query(f"{_SQL_GIVEN_DOCS} SELECT doc_id, {sql_argmax(*[chr(34) + c + chr(34) for c in CLASSES])} AS sentiment FROM given")
def argmax_class(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf, "doc_id").select("doc_id", sc.argmax_class(given_probs()).alias("sentiment"))


@query(f"""{_SQL_GIVEN_DOCS} SELECT doc_id, {", ".join(f'round("{c}", 6) AS "prob_{c}"' for c in CLASSES)} FROM given""")
def flatten_probabilities(spark: SparkSession, sf: str) -> DataFrame:
    pairs = [x for c, p in given_probs().items() for x in (F.lit(c), F.round(p, 6))]
    return sc.flatten_probabilities(documents(spark, sf, "doc_id").withColumn("probabilities", F.create_map(*pairs)))


@query(f"""{SQL_LEXICON_SCORED}
SELECT doc_id, left(coalesce(text_original, ''), 50) || '...' AS text, sentiment,
  printf('%.2f%%', greatest("prob_Negatif", "prob_Netral", "prob_Positif") * 100) AS confidence FROM scored
""")
def prediction_summary(spark: SparkSession, sf: str) -> DataFrame:
    return sc.prediction_summary(sc.score_lexicon(documents(spark, sf), lexicon(spark), tables(spark)))


# -- requests ------------------------------------------------------------------

# A turn's role names the model it asks for; there is none called "system".


def scorers(spark: SparkSession) -> dict[str, sc.Route]:
    words, lex = tables(spark), lexicon(spark)
    return {"user": sc.Route(words, lex), "assistant": sc.Route(words, lex, negated=False)}


def _sql_routed(head: str = SQL_TURNS, lexicon: str = "lexicon") -> str:
    p = sql_proba("coalesce(CASE role WHEN 'user' THEN n.score ELSE q.score END, 0)")
    blank = "l.light_text IS NULL"
    scored = {c: f"CASE WHEN {blank} THEN 0 ELSE {p[c]} END" for c in CLASSES}
    return f"""{head}, {sql_score_cte("neg_scores", "turn_norm", True, lexicon)}, {sql_score_cte("plain_scores", "turn_norm", False, lexicon)},
requests AS (
  SELECT *, CASE WHEN role NOT IN ('user', 'assistant') THEN 'unknown model'
    WHEN trim(text) = '' THEN 'text must not be empty' END AS error FROM turn_docs)
SELECT r.doc_id, r.text AS text_original, coalesce(l.light_text, '') AS text_preprocessed,
  CASE WHEN {blank} THEN 'Netral' ELSE {sql_argmax(p["Negatif"], p["Netral"], p["Positif"])} END AS sentiment,
  greatest({", ".join(scored.values())}) AS confidence, {", ".join(f'{v} AS "prob_{c}"' for c, v in scored.items())},
  r.role AS model, r.error
FROM requests r LEFT JOIN turn_light l USING (doc_id) LEFT JOIN neg_scores n USING (doc_id) LEFT JOIN plain_scores q USING (doc_id)
WHERE r.error IS NULL
UNION ALL SELECT doc_id, text, NULL, NULL, NULL, {", ".join("NULL" for _ in CLASSES)}, role, error FROM requests WHERE error IS NOT NULL
"""


@query(_sql_routed())
def route_by_model(spark: SparkSession, sf: str) -> DataFrame:
    return sc.route_by_model(turns(spark, sf).withColumnRenamed("role", "model"), scorers(spark))


def _arriving(spark: SparkSession, sf: str) -> DataFrame:
    known = spark.read.parquet(f"{sf}/conversations.parquet")
    # A folder is streamed with the folders in it; a stream's path is no file, so a single one is named by a pattern that nothing else fits.
    alone = any(f.endswith("/conversations.parquet") for f in known.inputFiles())
    return read_requests(spark, f"{sf}/conversations.parque{'[t]' if alone else 't'}", known.schema).select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("doc_id"),
        F.col("role").alias("model"),
        "text",
    )


@query(_sql_routed())
def score_stream_requests(spark: SparkSession, sf: str) -> DataFrame:
    """The same requests as a stream of files, scored to a Parquet sink and read back."""
    sink = scratch_path(spark, "scored")
    score_stream(_arriving(spark, sf), scorers(spark), sink, scratch_path(spark, "scored-log")).awaitTermination()
    return spark.read.parquet(sink)


@query(_sql_routed(f"{SQL_LISTS}, {SQL_TURN_CTES}", "corpus_lexicon"))
def score_stream_large(spark: SparkSession, sf: str) -> DataFrame:
    """As a stream against a lexicon of all labelled words, and of all pairs of neighbours, which one word never equals."""
    pairs = load_word_map(spark, sf).select(F.concat_ws(" ", "word", "formal").alias("word"), F.lit(1).alias("weight"))
    large = stage(corpus_lexicon(spark, sf).unionByName(pairs), "lexicon")
    words, sink = tables(spark), scratch_path(spark, "scored")
    routes = {"user": sc.Route(words, large), "assistant": sc.Route(words, large, negated=False)}
    score_batches(_arriving(spark, sf), routes, sink, scratch_path(spark, "scored-log")).awaitTermination()
    return read_scored(spark, sink)
