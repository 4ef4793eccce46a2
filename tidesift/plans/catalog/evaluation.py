"""Queries: evaluation of one labelling of the documents against another.

The label by the lexicon with negation is taken as actual; the label without it,
and the one of the processed text, as predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidesift.operators import evaluate as ev, lexicon as lx, sampling
from tidesift.plans.catalog import base
from tidesift.plans.catalog.base import SQL_LABELLED, labelled, lexicon, query, sql_label, sql_score_cte
from tidesift.sources.scratch import stage

CLASSES = lx.CLASSES


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    rows = lx.lexicon_score(labelled(spark, sf), lexicon(spark), None, "light_text", score="plain_score")
    rows = lx.lexicon_score(rows, lexicon(spark), base.NEGATIONS, "processed_text", score="processed_score")
    return rows.select(
        "doc_id",
        F.col("label").alias("actual"),
        lx.sentiment_label(F.col("plain_score")).alias("predicted"),
        lx.sentiment_label(F.col("processed_score")).alias("predicted_processed"),
    )


SQL_PREDICTIONS = f"""{SQL_LABELLED}, {sql_score_cte("processed_scores", "proc_words")},
predictions AS (
  SELECT l.doc_id, l.label AS actual, l.plain_label AS predicted, {sql_label("coalesce(s.score, 0)")} AS predicted_processed
  FROM labelled l LEFT JOIN processed_scores s USING (doc_id))
"""


@query(f"""{SQL_PREDICTIONS}
SELECT c.actual, count(*) FILTER (p.predicted = 'Negatif') AS "Negatif",
  count(*) FILTER (p.predicted = 'Netral') AS "Netral", count(*) FILTER (p.predicted = 'Positif') AS "Positif"
FROM (VALUES ('Negatif'), ('Netral'), ('Positif')) c(actual) LEFT JOIN predictions p USING (actual) GROUP BY c.actual
""")
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return ev.confusion_matrix(predictions(spark, sf))


@query(f"{SQL_PREDICTIONS} SELECT round(avg((actual = predicted)::INT), 6) AS accuracy FROM predictions")
def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return ev.accuracy(predictions(spark, sf)).select(F.round("accuracy", 6).alias("accuracy"))


def _sql_metrics(source: str, name: str = "m") -> str:
    """Per-class metrics, and their summary, by textbook formulas."""
    return f"""{name}_counts AS (
  SELECT c.class, count(*) FILTER (p.actual = c.class AND p.predicted = c.class) AS tp,
    count(*) FILTER (p.predicted = c.class) AS np, count(*) FILTER (p.actual = c.class) AS support
  FROM (VALUES ('Negatif'), ('Netral'), ('Positif')) c(class) CROSS JOIN {source} p GROUP BY c.class),
{name}_pr AS (
  SELECT class, support, np, tp, coalesce(tp::DOUBLE / nullif(np, 0), 0) AS precision,
    coalesce(tp::DOUBLE / nullif(support, 0), 0) AS recall FROM {name}_counts),
{name}_rows AS (
  SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM {name}_pr),
{name}_summary AS (
  SELECT sum(tp)::DOUBLE / sum(support) AS accuracy, avg(f1) FILTER (np + support > 0) AS f1_macro,
    sum(f1 * support) / sum(support) AS f1_weighted, avg(precision) FILTER (np + support > 0) AS precision_macro,
    avg(recall) FILTER (np + support > 0) AS recall_macro,
    sum(precision * support) / sum(support) AS precision_weighted, sum(support)::BIGINT AS support FROM {name}_rows)"""


@query(f"""{SQL_PREDICTIONS}, {_sql_metrics("predictions")}
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM m_rows
UNION ALL SELECT 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), support FROM m_summary
UNION ALL SELECT 'macro avg', round(precision_macro, 6), round(recall_macro, 6), round(f1_macro, 6), support FROM m_summary
UNION ALL SELECT 'weighted avg', round(precision_weighted, 6), round(accuracy, 6), round(f1_weighted, 6), support FROM m_summary
""")
def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(ev.classification_report(predictions(spark, sf)))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


_SQL_SUMMARY = ", ".join(f"round({m}, 6) AS {m}" for m in ev.METRICS)


@query(f"{SQL_PREDICTIONS}, {_sql_metrics('predictions')} SELECT {_SQL_SUMMARY} FROM m_summary")
def summary_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(ev.summary_metrics(predictions(spark, sf)))


_SQL_BOTH = f"""{SQL_PREDICTIONS}, {_sql_metrics("predictions")},
processed_predictions AS (SELECT actual, predicted_processed AS predicted FROM predictions),
{_sql_metrics("processed_predictions", "n")}"""
_SQL_TEXTS = ", ".join(f"""printf('%.4f', {m}) AS "{h}" """ for m, h in ev.REPORT_HEADINGS.items())


@query(f"""{_SQL_BOTH}
SELECT 'plain' AS "Model", {_SQL_TEXTS} FROM m_summary UNION ALL SELECT 'processed', {_SQL_TEXTS} FROM n_summary
""")
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(predictions(spark, sf), "predictions")
    return ev.model_comparison(
        {"plain": ev.summary_metrics(rows), "processed": ev.summary_metrics(rows, predicted="predicted_processed")}
    )


def by_model(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of both predictions, from one pass: each row is turned into two."""
    models = F.array(
        F.struct(F.lit("plain").alias("model"), F.col("predicted").alias("predicted")),
        F.struct(F.lit("processed").alias("model"), F.col("predicted_processed").alias("predicted")),
    )
    long = predictions(spark, sf).select("actual", F.inline(models))
    return ev.summary_metrics(long, by=("model",))


@query(f"""{_SQL_BOTH}
SELECT round((SELECT accuracy FROM n_summary) - (SELECT accuracy FROM m_summary), 6) AS delta
""")
def metric_delta(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(ev.metric_delta(by_model(spark, sf), "plain", "processed"))


@query(f"""{_SQL_BOTH},
board AS (SELECT 'plain' AS model, {_SQL_SUMMARY} FROM m_summary UNION ALL SELECT 'processed', {_SQL_SUMMARY} FROM n_summary)
SELECT * FROM board ORDER BY f1_macro DESC, model LIMIT 1
""")
def select_best_candidate(spark: SparkSession, sf: str) -> DataFrame:
    return ev.select_best_candidate(_rounded(by_model(spark, sf)))


@query(f"""{SQL_PREDICTIONS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY actual ORDER BY md5('42|' || doc_id), doc_id) AS rn,
  count(*) OVER (PARTITION BY actual) AS n FROM predictions),
acc AS (SELECT avg((actual = predicted)::INT) FILTER (rn > round(0.2 * n)) AS train_accuracy,
  avg((actual = predicted)::INT) FILTER (rn <= round(0.2 * n)) AS test_accuracy FROM ranked)
SELECT round(train_accuracy, 6) AS train_accuracy, round(test_accuracy, 6) AS test_accuracy,
  round(train_accuracy - test_accuracy, 6) AS gap,
  CASE WHEN train_accuracy - test_accuracy > 0.10 THEN 'overfitting'
    WHEN train_accuracy - test_accuracy > 0.05 THEN 'slight overfitting' ELSE 'good' END AS band FROM acc
""")
def overfit_gap(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(predictions(spark, sf), "predictions")
    return _rounded(ev.overfit_gap(sampling.stratified_split(rows, label="actual")))


_SQL_CHECKED = f"""{SQL_PREDICTIONS}, checked AS (
  SELECT doc_id, actual AS expected, predicted,
    CASE WHEN actual = predicted THEN 'PASSED' ELSE 'FAILED' END AS status FROM predictions)"""


def _checked(spark: SparkSession, sf: str, overall: bool) -> DataFrame:
    rows = predictions(spark, sf)
    expected = rows.select("doc_id", F.col("actual").alias("expected"))
    return ev.verify_expected(rows, expected, label="predicted", overall=overall)


@query(f"{_SQL_CHECKED} SELECT * FROM checked")
def verify_expected(spark: SparkSession, sf: str) -> DataFrame:
    return _checked(spark, sf, False)


@query(f"""{_SQL_CHECKED}
SELECT count(*) AS checked, count(*) FILTER (status = 'PASSED') AS passed, bool_and(status = 'PASSED') AS all_passed FROM checked
""")
def verify_expected_overall(spark: SparkSession, sf: str) -> DataFrame:
    return _checked(spark, sf, True)


