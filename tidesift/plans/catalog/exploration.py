"""Queries: distributions, terms, trends, resampling and splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidesift.operators import explore, sampling
from tidesift.plans.catalog.base import SQL_LABELLED, documents, labelled, query, table
from tidesift.sources.scratch import stage

# -- the flagship: classes per language ----------------------------------------


@query(f"""{SQL_LABELLED}
SELECT lang, label, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY lang), 6) AS pct
FROM labelled GROUP BY lang, label
""")
def sentiment_by_language(spark: SparkSession, sf: str) -> DataFrame:
    return explore.label_distribution(labelled(spark, sf), by=("lang",))


@query(f"""{SQL_LABELLED}
SELECT label, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct FROM labelled GROUP BY label
""")
def label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return explore.label_distribution(labelled(spark, sf))


_SQL_TARGETS = f"""{SQL_LABELLED},
counts AS (SELECT label, count(*) AS n FROM labelled GROUP BY label),
targets AS (
  SELECT label, n, trunc(max(n) OVER () * CASE label WHEN 'Negatif' THEN 1.15::DOUBLE WHEN 'Positif' THEN 0.92::DOUBLE ELSE 0.88::DOUBLE END)::BIGINT AS target
  FROM counts)
"""


@query(f"{_SQL_TARGETS} SELECT label, n, target FROM targets")
def class_targets(spark: SparkSession, sf: str) -> DataFrame:
    return explore.class_targets(labelled(spark, sf))


_SQL_WORDS = f"""{SQL_LABELLED},
tokens AS (SELECT doc_id, label, unnest(string_split(processed_text, ' ')) AS word FROM labelled),
pairs AS (
  SELECT doc_id, label, l[i] || ' ' || l[i + 1] AS word FROM (
    SELECT doc_id, label, l, unnest(generate_series(1, len(l) - 1)) AS i
    FROM (SELECT doc_id, label, string_split(processed_text, ' ') AS l FROM labelled) WHERE len(l) > 1))
"""


@query(f"{_SQL_WORDS} SELECT word, count(*) AS n FROM tokens GROUP BY word ORDER BY n DESC, word LIMIT 20")
def top_words(spark: SparkSession, sf: str) -> DataFrame:
    return explore.top_words(labelled(spark, sf))


@query(f"""{_SQL_WORDS},
top AS (SELECT word, count(*) AS n FROM tokens GROUP BY word ORDER BY n DESC, word LIMIT 200)
SELECT word, n, round(n::DOUBLE / max(n) OVER (), 6) AS rel FROM top
""")
def cloud_terms(spark: SparkSession, sf: str) -> DataFrame:
    return explore.cloud_terms(labelled(spark, sf))


def _sql_cloud_by_label(source: str, k: int) -> str:
    return f"""{_SQL_WORDS},
counts AS (SELECT label, word, count(*) AS n FROM {source} GROUP BY label, word),
top AS (SELECT label, word, n FROM counts QUALIFY row_number() OVER (PARTITION BY label ORDER BY n DESC, word) <= {k})
SELECT label, word, n, round(n::DOUBLE / max(n) OVER (PARTITION BY label), 6) AS rel FROM top
"""


@query(_sql_cloud_by_label("tokens", 150))
def cloud_terms_by_label(spark: SparkSession, sf: str) -> DataFrame:
    return explore.cloud_terms(labelled(spark, sf), "label", 150)


@query(_sql_cloud_by_label("(SELECT * FROM tokens UNION ALL SELECT * FROM pairs)", 150))
def cloud_bigrams(spark: SparkSession, sf: str) -> DataFrame:
    return explore.cloud_bigrams(labelled(spark, sf), "label", 150)


@query(f"""{SQL_LABELLED}
SELECT label, count(*) AS texts, sum(len(string_split(processed_text, ' ')))::BIGINT AS words FROM labelled GROUP BY label
""")
def class_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return explore.class_sizes(labelled(spark, sf))


# -- time ----------------------------------------------------------------------

ORDER_CLASSES = ["F", "O", "P"]


@query("""
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) FILTER (o_orderstatus = 'F') AS "F",
  count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P"
FROM orders GROUP BY 1
""")
def trend_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return explore.trend(table(spark, sf, "orders"), "month", "o_orderdate", "o_orderstatus", ORDER_CLASSES)


def timed(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with the time of the event of the same number."""
    events = table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), "ts")
    return labelled(spark, sf).select("doc_id", "label").join(events, "doc_id")


_SQL_CLASSES = """count(*) FILTER (label = 'Negatif') AS "Negatif",
  count(*) FILTER (label = 'Netral') AS "Netral", count(*) FILTER (label = 'Positif') AS "Positif"
FROM labelled l JOIN events e ON e.event_id = l.doc_id GROUP BY ALL"""


@query(f"{SQL_LABELLED} SELECT strftime(ts, '%Y-%m') AS month, {_SQL_CLASSES}")
def trend_month_by_label(spark: SparkSession, sf: str) -> DataFrame:
    return explore.trend(timed(spark, sf), "month")


@query(f"{SQL_LABELLED} SELECT (isodow(ts) - 1)::INT AS day_no, dayname(ts) AS weekday, {_SQL_CLASSES}")
def trend_weekday(spark: SparkSession, sf: str) -> DataFrame:
    return explore.trend(timed(spark, sf), "weekday")


@query(f"{SQL_LABELLED} SELECT hour(ts)::INT AS hour, {_SQL_CLASSES}")
def trend_hour(spark: SparkSession, sf: str) -> DataFrame:
    return explore.trend(timed(spark, sf), "hour")


def time_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Event times as text, in a format per type of event; those of errors cannot be read."""
    ts = F.date_trunc("SECOND", F.col("ts")).cast("timestamp_ntz")
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(F.date_format(ts, "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format(ts, "yyyy")))
        .when(kind == "view", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(kind == "error", F.concat(F.lit("at "), F.date_format(ts, "HH:mm")))
        .when(kind == "purchase", F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("+07:00")))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    )
    return table(spark, sf, "events").select("event_id", "event_type", text.alias("created_at"))


_SQL_TIME = """CASE event_type WHEN 'error' THEN NULL
  WHEN 'purchase' THEN date_trunc('second', ts) - INTERVAL 7 HOUR ELSE date_trunc('second', ts) END"""


@query(f"SELECT event_id, strftime({_SQL_TIME}, '%Y-%m-%d %H:%M:%S') AS created_at FROM events WHERE event_type <> 'error'")
def parse_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    parsed = explore.parse_timestamps(time_texts(spark, sf))
    return parsed.select("event_id", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


@query("SELECT count(*) FILTER (event_type <> 'error') AS valid, count(*) AS total FROM events")
def time_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return explore.time_coverage(time_texts(spark, sf))


# -- resampling and splitting --------------------------------------------------

_SQL_HASH = "('0x' || substr(md5(concat_ws('|', '42', label, draw::VARCHAR)), 1, 15))::BIGINT"
SQL_RESAMPLED = f"""{_SQL_TARGETS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || doc_id), doc_id) AS rank FROM labelled),
draws AS (SELECT label, n, unnest(generate_series(1, target)) AS draw FROM targets),
resampled AS (
  SELECT r.doc_id, r.lang, r.label, r.score, r.processed_text, r.light_text, d.draw
  FROM (SELECT label, draw, {_SQL_HASH} % n + 1 AS rank FROM draws) d JOIN ranked r USING (label, rank))
"""


def balanced(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(labelled(spark, sf).select("doc_id", "lang", "label", "score"), "labelled")
    return sampling.resample_classes(rows, explore.class_targets(rows))


@query(f"{SQL_RESAMPLED} SELECT doc_id, lang, label, score, draw FROM resampled")
def resample_classes(spark: SparkSession, sf: str) -> DataFrame:
    return balanced(spark, sf)


@query(f"{SQL_RESAMPLED} SELECT doc_id, label, draw FROM resampled ORDER BY md5('42|' || doc_id || '|' || draw), doc_id, draw")
def shuffle_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.shuffle_rows(balanced(spark, sf).select("doc_id", "label", "draw"), "doc_id", "draw")


_SQL_RANKED = f"""{SQL_LABELLED},
ranked AS (
  SELECT doc_id, lang, label, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || doc_id), doc_id) AS rn,
    count(*) OVER (PARTITION BY label) AS n FROM labelled)
"""
SQL_SPLIT = f"""{_SQL_RANKED},
parts AS (SELECT doc_id, label, CASE WHEN rn <= round(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM ranked)
"""


def split(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(labelled(spark, sf).select("doc_id", "label"), "labelled")
    return sampling.stratified_split(rows)


@query(f"{SQL_SPLIT} SELECT doc_id, label, split FROM parts")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return split(spark, sf)


@query(f"{_SQL_RANKED} SELECT doc_id, label, ((rn - 1) * 5 // n)::INT AS fold FROM ranked")
def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(labelled(spark, sf).select("doc_id", "label"), "labelled")
    return sampling.stratified_folds(rows)


@query(f"""{SQL_SPLIT}
SELECT split, label, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY split), 6) AS pct
FROM parts GROUP BY split, label
""")
def split_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return explore.label_distribution(split(spark, sf), by=("split",))
