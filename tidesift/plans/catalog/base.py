"""Word tables for the generated languages, input tables, SQL building blocks and the registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidesift.functions import text as tx
from tidesift.operators.preprocess import TextTables
from tidesift.plans.pipeline import build_labelled
from tidesift.sources import wordlists
from tidesift.sources.files import read_table
from tidesift.sources.local import local_frame

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL twin."""

    def register(run: Query) -> Query:
        key = name or run.__name__
        assert key not in REGISTRY, key
        REGISTRY[key] = Entry(run, sql)
        return run

    return register


# -- word tables for the generated languages ---------------------------------

WORD_MAP = {"mit": "with", "im": "in", "dem": "den", "lo": "los", "su": "sus", "nd": "and", "th": "the", "au": "aux", "er": "der"}
STOPWORDS = [
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "be", "by", "this", "are", "at",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est",
    "der", "die", "und", "den", "von", "zu", "das", "auf", "ist",
    "el", "y", "los", "se", "las", "por", "su", "al", "not", "no",
]
STEMS = {"ing": "in", "ed": "e", "tion": "ti", "ou": "o", "ción": "ci", "eau": "au", "sch": "ch", "ungen": "ung", "ment": "men"}
STRONG = ["the", "of", "and", "to", "is", "that", "it", "for", "was", "on", "with", "as", "by", "this"]
LEXICON = {
    "for": 2, "with": 1, "was": -2, "from": -1, "mit": 2, "sich": -1,
    "con": 2, "del": -1, "pour": 2, "sur": -1,
}
NEGATIONS = ["not", "nicht", "no", "pas"]


def tables(spark: SparkSession) -> TextTables:
    return TextTables(
        wordlists.map_frame(spark, WORD_MAP),
        wordlists.words_frame(spark, STOPWORDS),
        local_frame(spark, STEMS.items(), "word string, stem string"),
        STRONG,
        NEGATIONS,
        "en",
    )


def lexicon(spark: SparkSession) -> DataFrame:
    return wordlists.lexicon_frame(spark, LEXICON)


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return table(spark, sf, "documents").select(*(columns or ("doc_id", "lang", "text")))


#: Setting of a session that deals each table out to so many tasks (see ``read_table``); tables are read as they lie without it.
PARTITIONS = "spark.tidesift.read.partitions"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    n = spark.conf.get(PARTITIONS, None)
    return read_table(spark, f"{sf}/{name}.parquet", int(n) if n else None)


def event_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the text of the document of the same number, null where there is none."""
    events = table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), "ts")
    return events.join(documents(spark, sf, "doc_id", "lang", "text"), "doc_id", "left")


def light_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the words of their cleaned text."""
    folded = tx.case_fold(tx.filter_text(F.col("text")))
    return documents(spark, sf).select("doc_id", "lang", tx.tokenize(folded, squeezed=True).alias("tokens"))


def labelled(spark: SparkSession, sf: str, negated: bool = True) -> DataFrame:
    """Deduplicated documents with both texts, score and label, all languages."""
    raw = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return build_labelled(
        raw, tables(spark), lexicon(spark), filter_lang=False, negated=negated
    )


# -- SQL building blocks -------------------------------------------------------


def _regex(value: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({value}, '{pattern}', '{by}', 'g')"


SQL_STEPS = {
    "urls": lambda x: _regex(x, tx.URL),
    "mentions": lambda x: _regex(x, tx.MENTION),
    "hashtags": lambda x: _regex(x, tx.HASHTAG, "\\1"),
    "emoji": lambda x: _regex(x, tx.EMOJI),
    "digits": lambda x: _regex(x, tx.DIGITS),
    "punctuation": lambda x: _regex(x, tx.PUNCTUATION),
    "underscores": lambda x: _regex(x, tx.UNDERSCORES),
    "spaces": lambda x: f"trim({_regex(x, tx.SPACES)})",
}


def sql_filter_text(x: str) -> str:
    """Every step by itself, where the engine fuses them: checks the fusion too."""
    for step in SQL_STEPS.values():
        x = step(x)
    return f"coalesce({x}, '')"


def sql_words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def sql_values(rows, *columns: str) -> str:
    def literal(v) -> str:
        return f"'{v}'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({', '.join(columns)}))"


SQL_WORD_TABLES = f"""
word_map AS {sql_values(WORD_MAP.items(), "word", "formal")},
stopwords AS {sql_values([(w,) for w in STOPWORDS], "word")},
stems AS {sql_values(STEMS.items(), "word", "stem")},
strong AS {sql_values([(w,) for w in STRONG], "word")},
lexicon AS {sql_values(LEXICON.items(), "word", "weight")},
negations AS {sql_values([(w,) for w in NEGATIONS], "word")}
"""


def sql_token_ctes(source: str = "documents", doc_id: str = "doc_id", extra: str = "lang,", p: str = "") -> str:
    """docs, words (raw), norm (after the word map), light and processed texts; ``p`` leads each name."""
    return f"""
{p}docs AS (SELECT {doc_id} AS doc_id, {extra} text, lower({sql_filter_text("text")}) AS folded FROM {source}),
{p}words AS (
  SELECT doc_id, unnest(l) AS w, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, {sql_words("folded")} AS l FROM {p}docs)),
{p}norm AS (
  SELECT x.doc_id, x.pos, coalesce(m.formal, x.w) AS w
  FROM {p}words x LEFT JOIN word_map m ON m.word = x.w),
{p}light AS (SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS light_text FROM {p}norm GROUP BY doc_id),
{p}proc_words AS (
  SELECT n.doc_id, n.pos, coalesce(s.stem, n.w) AS w
  FROM {p}norm n LEFT JOIN stems s ON s.word = n.w
  WHERE length(n.w) > 1 AND n.w NOT IN (SELECT word FROM stopwords)),
{p}processed AS (SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS processed_text FROM {p}proc_words GROUP BY doc_id)
"""


def sql_score_cte(name: str, words: str, negated: bool = True, lexicon: str = "lexicon") -> str:
    """``(doc_id, score)`` of the texts with a hit, from ``(doc_id, pos, w)`` rows."""
    if not negated:
        return f"""{name} AS (
  SELECT n.doc_id, sum(l.weight)::BIGINT AS score
  FROM {words} n JOIN {lexicon} l ON l.word = n.w GROUP BY n.doc_id)"""
    return f"""{name} AS (
  SELECT doc_id, sum(CASE WHEN neg THEN 0 WHEN flip THEN -weight ELSE weight END)::BIGINT AS score
  FROM (
    SELECT doc_id, neg, weight, coalesce(lag(neg) OVER (PARTITION BY doc_id ORDER BY pos), false) AS flip
    FROM (
      SELECT n.doc_id, n.pos, g.word IS NOT NULL AS neg, coalesce(l.weight, 0) AS weight
      FROM {words} n LEFT JOIN {lexicon} l ON l.word = n.w LEFT JOIN negations g ON g.word = n.w)
    WHERE neg OR weight <> 0)
  GROUP BY doc_id)"""


def sql_label(score: str) -> str:
    return f"CASE WHEN {score} > 0 THEN 'Positif' WHEN {score} < 0 THEN 'Negatif' ELSE 'Netral' END"


SQL_TEXTS = f"WITH {SQL_WORD_TABLES}, {sql_token_ctes()}"

SQL_LABELLED = f"""{SQL_TEXTS},
{sql_score_cte("scores", "norm")},
{sql_score_cte("plain_scores", "norm", negated=False)},
firsts AS (SELECT min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text),
labelled AS (
  SELECT d.doc_id, d.lang, d.text, p.processed_text, l.light_text,
    coalesce(s.score, 0)::BIGINT AS score, {sql_label("coalesce(s.score, 0)")} AS label,
    coalesce(q.score, 0)::BIGINT AS plain_score, {sql_label("coalesce(q.score, 0)")} AS plain_label
  FROM docs d JOIN firsts USING (doc_id) JOIN processed p USING (doc_id) JOIN light l USING (doc_id)
  LEFT JOIN scores s USING (doc_id) LEFT JOIN plain_scores q USING (doc_id))
"""


def sql_proba(score: str) -> dict[str, str]:
    def case(strong_neg, neg, zero, pos, strong_pos) -> str:
        return (
            f"(CASE WHEN {score} <= -5 THEN {strong_neg} WHEN {score} < 0 THEN {neg} WHEN {score} = 0 THEN {zero} "
            f"WHEN {score} < 5 THEN {pos} ELSE {strong_pos} END)::DOUBLE"
        )

    return {
        "Negatif": case(0.95, 0.85, 0.10, 0.05, 0.01),
        "Netral": case(0.04, 0.10, 0.80, 0.10, 0.04),
        "Positif": case(0.01, 0.05, 0.10, 0.85, 0.95),
    }


def sql_argmax(ng: str, nt: str, ps: str) -> str:
    return f"CASE WHEN {ng} >= {nt} AND {ng} >= {ps} THEN 'Negatif' WHEN {nt} >= {ps} THEN 'Netral' ELSE 'Positif' END"
