"""Queries: building lexicons from labelled texts, and scoring by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidesift.functions import text as tx
from tidesift.operators import joins, lexicon as lx, preprocess as pp
from tidesift.plans.catalog import base
from tidesift.plans.catalog.base import (
    SQL_LABELLED, SQL_TEXTS, documents, labelled, light_tokens, lexicon, query, sql_filter_text, sql_label, sql_proba,
    sql_score_cte, sql_words, table, tables,
)
from tidesift.sources.scratch import stage

# -- lists learnt from the labels: they grow with the corpus -------------------


def _list_of(spark: SparkSession, sf: str, flag: str, sign: int) -> DataFrame:
    """Words of the texts that carry a flag, weighted by the number of such texts, 5 at most."""
    marked = table(spark, sf, "labels").filter(F.col(flag) == 1).select("doc_id")
    words = light_tokens(spark, sf).join(marked, "doc_id", "left_semi")
    counts = joins.word_counts(words, F.array_distinct("tokens"))
    return counts.select("word", (F.least("n", F.lit(5)) * sign).cast("int").alias("weight"))


def positive_list(spark: SparkSession, sf: str) -> DataFrame:
    return _list_of(spark, sf, "quality", 1)


def negative_list(spark: SparkSession, sf: str) -> DataFrame:
    return _list_of(spark, sf, "toxic", -1)


def override_list(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the benchmark texts; those in three of them become neutral."""
    folded = tx.case_fold(tx.filter_text(F.col("text")))
    counts = joins.word_counts(table(spark, sf, "benchmark"), F.array_distinct(tx.tokenize(folded, squeezed=True)))
    return counts.select("word", (F.least("n", F.lit(6)) - 3).cast("int").alias("weight"))


SQL_LISTS = f"""{SQL_TEXTS},
pos AS (
  SELECT w AS word, least(count(DISTINCT doc_id), 5)::INT AS weight FROM words
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY w),
neg AS (
  SELECT w AS word, -least(count(DISTINCT doc_id), 5)::INT AS weight FROM words
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY w),
bench AS (
  SELECT item_id, unnest({sql_words(f"lower({sql_filter_text('text')})")}) AS w FROM benchmark),
overrides AS (SELECT w AS word, (least(count(DISTINCT item_id), 6) - 3)::INT AS weight FROM bench GROUP BY w),
both_sides AS (
  SELECT coalesce(pos.word, neg.word) AS word, coalesce(pos.weight, 0) AS p, coalesce(abs(neg.weight), 0) AS n
  FROM pos FULL OUTER JOIN neg ON pos.word = neg.word),
net AS (SELECT word, (p - n)::INT AS weight FROM both_sides WHERE p <> n),
corpus_lexicon AS (
  SELECT word, weight FROM net WHERE word NOT IN (SELECT word FROM overrides)
  UNION ALL SELECT word, weight FROM overrides WHERE weight <> 0)
"""


@query(f"{SQL_LISTS} SELECT word, weight FROM net")
def lexicon_conflicts_net(spark: SparkSession, sf: str) -> DataFrame:
    return lx.resolve_conflicts(positive_list(spark, sf), negative_list(spark, sf), "net")


@query(f"{SQL_LISTS} SELECT word, (p - n)::INT AS weight FROM both_sides WHERE p = 0 OR n = 0")
def lexicon_conflicts_drop(spark: SparkSession, sf: str) -> DataFrame:
    return lx.resolve_conflicts(positive_list(spark, sf), negative_list(spark, sf), "drop")


@query(f"{SQL_LISTS} SELECT word, (CASE WHEN p > n THEN p ELSE -n END)::INT AS weight FROM both_sides WHERE p <> n")
def lexicon_conflicts_stronger(spark: SparkSession, sf: str) -> DataFrame:
    return lx.resolve_conflicts(positive_list(spark, sf), negative_list(spark, sf), "stronger")


def corpus_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return lx.build_lexicon(positive_list(spark, sf), negative_list(spark, sf), override_list(spark, sf))


@query(f"{SQL_LISTS} SELECT word, weight FROM corpus_lexicon")
def lexicon_overrides(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_lexicon(spark, sf)


@query(f"""{SQL_LISTS}
SELECT 'positive_listed' AS item, count(*) AS words FROM pos
UNION ALL SELECT 'negative_listed', count(*) FROM neg
UNION ALL SELECT 'conflicts', count(*) FROM pos JOIN neg USING (word)
UNION ALL SELECT 'positive_kept', count(*) FROM net WHERE weight > 0
UNION ALL SELECT 'negative_kept', count(*) FROM net WHERE weight < 0
""")
def lexicon_stats(spark: SparkSession, sf: str) -> DataFrame:
    # Each list is read three times below: written once, it is not computed three times.
    pos, neg = stage(positive_list(spark, sf), "positive"), stage(negative_list(spark, sf), "negative")
    return lx.lexicon_stats(pos, neg, stage(lx.resolve_conflicts(pos, neg), "net"))


@query(f"{SQL_LISTS} SELECT word FROM pos WHERE word IN (SELECT word FROM neg)")
def set_membership(spark: SparkSession, sf: str) -> DataFrame:
    return lx.set_membership(positive_list(spark, sf), negative_list(spark, sf), "intersection")


@query(f"{SQL_LISTS} SELECT word FROM pos UNION SELECT word FROM overrides", "set_membership_union")
def set_membership_union(spark: SparkSession, sf: str) -> DataFrame:
    return lx.set_membership(positive_list(spark, sf), override_list(spark, sf), "union")


# -- scores --------------------------------------------------------------------


def _light(spark: SparkSession, sf: str) -> DataFrame:
    light = pp.preprocess_light(documents(spark, sf), tables(spark), filter_lang=False)
    return light.select("doc_id", "light_text")


@query(f"""{SQL_TEXTS}, {sql_score_cte("scores", "norm", negated=False)}
SELECT d.doc_id, coalesce(s.score, 0)::BIGINT AS score FROM docs d LEFT JOIN scores s USING (doc_id)
""")
def lexicon_score_plain(spark: SparkSession, sf: str) -> DataFrame:
    return lx.lexicon_score(_light(spark, sf), lexicon(spark)).drop("light_text")


@query(f"""{SQL_TEXTS}, {sql_score_cte("scores", "norm")}
SELECT d.doc_id, coalesce(s.score, 0)::BIGINT AS score FROM docs d LEFT JOIN scores s USING (doc_id)
""")
def lexicon_score_negated(spark: SparkSession, sf: str) -> DataFrame:
    return lx.lexicon_score(_light(spark, sf), lexicon(spark), base.NEGATIONS).drop("light_text")


@query(f"""{SQL_LISTS}, {sql_score_cte("scores", "norm", False, "corpus_lexicon")}
SELECT d.doc_id, coalesce(s.score, 0)::BIGINT AS score FROM docs d LEFT JOIN scores s USING (doc_id)
""")
def lexicon_score_plain_large(spark: SparkSession, sf: str) -> DataFrame:
    return lx.lexicon_score_by_join(_light(spark, sf), stage(corpus_lexicon(spark, sf), "lexicon")).drop("light_text")


@query(f"""{SQL_LISTS}, {sql_score_cte("scores", "norm", True, "corpus_lexicon")}
SELECT d.doc_id, coalesce(s.score, 0)::BIGINT AS score FROM docs d LEFT JOIN scores s USING (doc_id)
""")
def lexicon_score_negated_large(spark: SparkSession, sf: str) -> DataFrame:
    return lx.lexicon_score_by_join(_light(spark, sf), stage(corpus_lexicon(spark, sf), "lexicon"), base.NEGATIONS).drop("light_text")


@query(f"{SQL_LABELLED} SELECT doc_id, lang, score, label FROM labelled")
def sentiment_label(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).select("doc_id", "lang", "score", "label")


_P = sql_proba("score")


@query(f"""{SQL_LABELLED}
SELECT doc_id, {_P["Negatif"]} AS "prob_Negatif", {_P["Netral"]} AS "prob_Netral", {_P["Positif"]} AS "prob_Positif" FROM labelled
""")
def lexicon_pseudo_proba(spark: SparkSession, sf: str) -> DataFrame:
    probs = lx.pseudo_proba(F.col("score"))
    return labelled(spark, sf).select("doc_id", *[p.alias(f"prob_{c}") for c, p in probs.items()])


@query(f"{SQL_LABELLED} SELECT doc_id, label FROM labelled")
def concat_frames(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(labelled(spark, sf).select("doc_id", "label"), "labelled")
    return lx.concat_frames(*[rows.filter(F.col("label") == c) for c in lx.CLASSES])
