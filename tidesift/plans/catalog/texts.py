"""Queries: sources, profiling, cleaning and preprocessing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidesift.functions import text as tx
from tidesift.operators import joins, langid, preprocess as pp, profile, stems
from tidesift.operators.counts import last_followers
from tidesift.operators.explore import label_distribution
from tidesift.operators.lexicon import label_texts
from tidesift.operators.scoring import score_lexicon
from tidesift.plans.catalog import base
from tidesift.plans.catalog.base import (
    SQL_LABELLED, SQL_STEPS, SQL_TEXTS, SQL_WORD_TABLES, documents, event_texts, labelled, light_tokens, lexicon,
    query, sql_argmax, sql_filter_text, sql_label, sql_proba, sql_score_cte, sql_token_ctes, table, tables,
)
from tidesift.sources import files
from tidesift.sources.scratch import scratch_path, stage

CSV_OUT = {"header": True, "escape": '"', "quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

# -- sources -------------------------------------------------------------------


@query("""
SELECT lpad(doc_id::VARCHAR, 8, '0') AS id_str, source AS created_at, text AS full_text, lang FROM documents
""")
def scan_required_columns(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tweets-csv")
    raw = documents(spark, sf, "doc_id", "source", "text", "lang", "n_chars").select(
        F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("id_str"),
        F.col("source").alias("created_at"),
        F.col("text").alias("full_text"),
        "lang",
        "n_chars",
    )
    raw.write.options(**CSV_OUT).csv(path)
    return files.scan_required_columns(spark, path)


_SQL_PAIRS = f"""{SQL_TEXTS},
pairs AS (
  SELECT w.doc_id, w.pos, w.w AS word, v.w AS next, d.n_chars
  FROM words w JOIN words v ON v.doc_id = w.doc_id AND v.pos = w.pos + 1
  JOIN (SELECT doc_id, n_chars FROM documents) d ON d.doc_id = w.doc_id)"""


def _pairs(tokens: DataFrame) -> DataFrame:
    """Each word of a text with the one behind it, and the place of the pair among all texts."""
    pairs = F.transform(F.slice("tokens", F.lit(2), F.greatest(F.size("tokens") - 1, F.lit(0))), lambda x, i: F.struct(i.alias("pos"), F.get("tokens", i).alias("word"), x.alias("next")))
    rows = tokens.select("*", F.inline(pairs)).drop("tokens")
    return rows.withColumn("line", F.struct("doc_id", "pos"))


@query(f"{_SQL_PAIRS} SELECT word, last(next ORDER BY doc_id, pos) AS formal FROM pairs GROUP BY word")
def load_word_map(spark: SparkSession, sf: str) -> DataFrame:
    """A map that grows with the corpus: each word stands for the one that last follows it anywhere."""
    return _word_map(light_tokens(spark, sf))


def _word_map(tokens: DataFrame) -> DataFrame:
    # Of a task's texts only the last pair of each word goes on: all pairs would be sorted, and spilled, once a token.
    kind = tokens.schema["doc_id"].dataType.simpleString()
    last = tokens.select("doc_id", "tokens").mapInArrow(last_followers, f"word string, formal string, doc_id {kind}, pos int")
    return files.clean_word_map(last.select(F.struct("doc_id", "pos").alias("line"), "word", "formal"))


@query(f"""{_SQL_PAIRS}, rows AS (
  SELECT doc_id, pos, word, CASE WHEN next = 'the' THEN 'weight' ELSE ((n_chars + pos - 1)::DOUBLE / 100 - 5)::VARCHAR END AS weight FROM pairs)
SELECT word, last(trunc(try_cast(weight AS DOUBLE)) ORDER BY doc_id, pos)::INT AS weight
FROM rows WHERE try_cast(weight AS DOUBLE) IS NOT NULL GROUP BY word
""")
def load_lexicon_tsv(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of all words of all texts: with blanks around them, in capitals, and some without a number."""
    words = tx.tokenize(tx.case_fold(tx.filter_text(F.col("text"))), squeezed=True)
    rows = _pairs(documents(spark, sf, "doc_id", "n_chars", "text").select("doc_id", "n_chars", words.alias("tokens")))
    number = ((F.col("n_chars") + F.col("pos")).cast("double") / 100 - 5).cast("string")
    rows = rows.select(
        "line",
        F.concat(F.lit("  "), F.col("word"), F.lit(" ")).alias("word"),
        F.when(F.col("next") == "the", "weight").otherwise(number).alias("weight"),
    )
    return files.clean_lexicon(rows)


@query(f"{SQL_TEXTS} SELECT d.doc_id, coalesce(l.light_text, '') AS light_text FROM docs d LEFT JOIN light l USING (doc_id)")
def with_fallback(spark: SparkSession, sf: str) -> DataFrame:
    t = tables(spark)
    t.word_map = files.load_word_map(spark, scratch_path(spark, "no-such-map"), base.WORD_MAP)
    return pp.preprocess_light(documents(spark, sf), t, filter_lang=False).select("doc_id", "light_text")


_SQL_STRIP = f"regexp_replace(line, '^[{tx.SPACE}]+|[{tx.SPACE}]+$', '', 'g')"


@query(f"""
SELECT text FROM (
  SELECT {_SQL_STRIP} AS text FROM (SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM documents))
WHERE text <> ''
""")
def scan_text_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    documents(spark, sf, "text").write.text(path)
    return files.scan_text_lines(spark, path)


@query("""
SELECT coalesce(d.text, 'nan') AS text FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id
""")
def scan_csv_text_column(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "batch-csv")
    event_texts(spark, sf).select(F.col("doc_id").cast("string"), "text").write.options(**CSV_OUT).option(
        "nullValue", None
    ).csv(path)
    return files.scan_csv_text_column(spark, path, "text")


_P = sql_proba("coalesce(s.score, 0)")
SQL_LEXICON_SCORED = f"""{SQL_TEXTS}, {sql_score_cte("scores", "norm")},
scored AS (
  SELECT d.doc_id, d.text AS text_original, coalesce(l.light_text, '') AS text_preprocessed,
    CASE WHEN l.light_text IS NULL THEN 'Netral' ELSE {sql_argmax(_P["Negatif"], _P["Netral"], _P["Positif"])} END AS sentiment,
    CASE WHEN l.light_text IS NULL THEN 0.0::DOUBLE ELSE {_P["Negatif"]} END AS "prob_Negatif",
    CASE WHEN l.light_text IS NULL THEN 0.0::DOUBLE ELSE {_P["Netral"]} END AS "prob_Netral",
    CASE WHEN l.light_text IS NULL THEN 0.0::DOUBLE ELSE {_P["Positif"]} END AS "prob_Positif"
  FROM docs d LEFT JOIN light l USING (doc_id) LEFT JOIN scores s USING (doc_id))
"""


@query(f"""{SQL_LEXICON_SCORED}
SELECT doc_id, text_preprocessed, sentiment, greatest("prob_Negatif", "prob_Netral", "prob_Positif") AS confidence,
  "prob_Negatif", "prob_Netral", "prob_Positif" FROM scored
""")
def write_predictions(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    scored = score_lexicon(documents(spark, sf), lexicon(spark), tables(spark)).drop("text_original")
    files.write_predictions(scored, path)
    return spark.read.schema(scored.schema).option("header", True).option("escape", '"').csv(path).fillna("")


@query(f"""
WITH lines AS (SELECT * FROM (
  SELECT doc_id, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line, generate_subscripts(string_split_regex(text, '\\r\\n|\\r|\\n'), 1) AS k FROM documents)),
kept AS (SELECT {_SQL_STRIP} AS text, row_number() OVER (ORDER BY doc_id, k) AS n FROM lines WHERE {_SQL_STRIP} <> '')
SELECT row_number() OVER (ORDER BY n) - 1 AS place, text AS text_original FROM kept
""")
def score_lines_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of files to scores to CSV: the place of each line in what was written is its place in what was read."""
    source, out = scratch_path(spark, "lines"), scratch_path(spark, "scores")
    documents(spark, sf, "doc_id", "text").orderBy("doc_id").select("text").write.text(source)
    texts = files.scan_text_lines(spark, source, number="doc_id")
    files.write_predictions(score_lexicon(texts, lexicon(spark), tables(spark)), out, number="doc_id")
    return files.read_csv(spark, out, number="place").select("place", "text_original")


_SQL_DISTRIBUTION = f"""{SQL_LABELLED}
SELECT label, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct FROM labelled GROUP BY label
"""


@query(_SQL_DISTRIBUTION)
def write_reports(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "report")
    report = label_distribution(labelled(spark, sf))
    files.write_report(report, path, "json")
    return spark.read.schema(report.schema).json(path)


@query(f"""{SQL_LABELLED}
SELECT doc_id, json_object('processed_text', processed_text, 'score', score, 'label', label)::VARCHAR AS json FROM labelled
""")
def result_json(spark: SparkSession, sf: str) -> DataFrame:
    return files.result_json(labelled(spark, sf).select("doc_id", "processed_text", "score", "label"))


# -- profiling -----------------------------------------------------------------

_SQL_EVENT_TEXTS = """
WITH event_texts AS (
  SELECT e.event_id AS doc_id, e.ts, d.lang, d.text FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id)
"""


@query(f"{_SQL_EVENT_TEXTS} SELECT doc_id, lang, text FROM event_texts WHERE text IS NOT NULL")
def drop_missing_text(spark: SparkSession, sf: str) -> DataFrame:
    return profile.drop_missing_text(event_texts(spark, sf)).select("doc_id", "lang", "text")


@query("SELECT min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, text FROM documents GROUP BY text")
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return profile.dedup_keep_first(documents(spark, sf))


@query(f"""{_SQL_EVENT_TEXTS}
SELECT 'doc_id' AS column_name, count(*) FILTER (doc_id IS NULL) AS nulls FROM event_texts
UNION ALL SELECT 'ts', count(*) FILTER (ts IS NULL) FROM event_texts
UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL) FROM event_texts
UNION ALL SELECT 'text', count(*) FILTER (text IS NULL) FROM event_texts
""")
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_profile(event_texts(spark, sf))


@query(f"{_SQL_EVENT_TEXTS} SELECT (count(*) - (count(DISTINCT text) + 1))::BIGINT AS duplicates FROM event_texts")
def duplicate_count(spark: SparkSession, sf: str) -> DataFrame:
    return profile.duplicate_count(event_texts(spark, sf).select("text"))


@query(f"""{SQL_TEXTS},
event_texts AS (
  SELECT e.event_id AS doc_id, d.text, coalesce(p.processed_text, '') AS processed_text
  FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id LEFT JOIN processed p ON p.doc_id = e.event_id),
counts AS (
  SELECT count(*) AS a, count(text) AS b, count(DISTINCT text) AS c,
    count(DISTINCT CASE WHEN processed_text <> '' THEN text END) AS d FROM event_texts)
SELECT '1_drop_missing' AS stage, a AS rows_in, b AS rows_out, a - b AS removed FROM counts
UNION ALL SELECT '2_dedup', b, c, b - c FROM counts
UNION ALL SELECT '3_drop_empty', c, d, c - d FROM counts
""")
def stage_audit(spark: SparkSession, sf: str) -> DataFrame:
    prepare = lambda df: pp.preprocess(df, tables(spark), filter_lang=False, light=None)
    return profile.audit_texts(event_texts(spark, sf), prepare, "text", "processed_text")


@query("SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 5")
def preview(spark: SparkSession, sf: str) -> DataFrame:
    return profile.preview(documents(spark, sf), ["doc_id", "lang", "text"], 5)


@query(f"{SQL_TEXTS} SELECT doc_id, light_text, processed_text FROM light JOIN processed USING (doc_id)")
def drop_empty_processed(spark: SparkSession, sf: str) -> DataFrame:
    ready = pp.preprocess(documents(spark, sf), tables(spark), filter_lang=False)
    return profile.drop_empty_processed(ready, "processed_text", "light_text").select(
        "doc_id", "light_text", "processed_text"
    )


# -- cleaning steps ------------------------------------------------------------


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.concat_ws(" ", "url", "html").alias("text"))


def _register_step(name: str, step, key: str) -> None:
    sql = f"SELECT page_id, {SQL_STEPS[key]('text')} AS text FROM (SELECT page_id, concat_ws(' ', url, html) AS text FROM pages)"

    @query(sql, name)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _pages(spark, sf).select("page_id", step(F.col("text")).alias("text"))


for _name, _step, _key in [
    ("strip_urls", tx.strip_urls, "urls"),
    ("strip_mentions", tx.strip_mentions, "mentions"),
    ("unwrap_hashtags", tx.unwrap_hashtags, "hashtags"),
    ("strip_digits", tx.strip_digits, "digits"),
    ("strip_punctuation", tx.strip_punctuation, "punctuation"),
    ("strip_underscores", tx.strip_underscores, "underscores"),
    ("squeeze_spaces", tx.squeeze_spaces, "spaces"),
]:
    _register_step(_name, _step, _key)


@query(f"SELECT doc_id, {SQL_STEPS['emoji']('text')} AS text FROM (SELECT doc_id, replace(text, '.', '\U0001f600❶✂') AS text FROM documents)")
def strip_emoji(spark: SparkSession, sf: str) -> DataFrame:
    marked = F.replace("text", F.lit("."), F.lit("\U0001f600❶✂"))
    return documents(spark, sf).select("doc_id", tx.strip_emoji(marked).alias("text"))


@query(f"""
SELECT 'd' || doc_id AS id, {sql_filter_text('text')} AS text FROM documents
UNION ALL SELECT 'p' || page_id, {sql_filter_text("concat_ws(' ', url, html)")} FROM pages
""")
def filter_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    pages = _pages(spark, sf).select(F.concat(F.lit("p"), "page_id").alias("id"), "text")
    return docs.unionByName(pages).select("id", tx.filter_text(F.col("text")).alias("text"))


@query(f"SELECT doc_id, lower({sql_filter_text('text')}) AS text FROM documents")
def case_fold(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", tx.case_fold(tx.filter_text(F.col("text"))).alias("text"))


@query(f"{SQL_TEXTS} SELECT doc_id, pos - 1 AS pos, w AS token FROM words")
def tokenize(spark: SparkSession, sf: str) -> DataFrame:
    tokens = joins.explode_tokens(light_tokens(spark, sf))
    return tokens.withColumn("pos", F.col("pos").cast("bigint"))


# -- language ------------------------------------------------------------------

_SQL_HEURISTIC = """heuristic AS (
  SELECT d.doc_id, count(w.w) < 3 OR count(s.word) >= 2 AS keep
  FROM docs d LEFT JOIN words w USING (doc_id) LEFT JOIN strong s ON s.word = w.w GROUP BY d.doc_id)"""


@query(f"{SQL_TEXTS}, {_SQL_HEURISTIC} SELECT doc_id, keep FROM heuristic")
def language_heuristic(spark: SparkSession, sf: str) -> DataFrame:
    return light_tokens(spark, sf).select("doc_id", pp.language_heuristic(F.col("tokens"), base.STRONG).alias("keep"))


_SQL_LANGID = """word_n AS (SELECT w.doc_id, d.lang, ' ' || w.w || ' ' AS p, count(*) AS n FROM words w JOIN docs d USING (doc_id) GROUP BY ALL),
grams AS (SELECT doc_id, lang, n, substr(p, i, 3) AS gram FROM (SELECT *, unnest(generate_series(1, length(p) - 2)) AS i FROM word_n)),
gram_n AS (SELECT lang, gram, sum(n) AS n FROM grams GROUP BY lang, gram),
lang_n AS (SELECT lang, sum(n) AS total FROM gram_n GROUP BY lang),
vocab AS (SELECT DISTINCT gram FROM gram_n),
logp AS (
  SELECT l.lang, v.gram, round(ln((coalesce(g.n, 0) + 1)::DOUBLE / (l.total + (SELECT count(*) FROM vocab))::DOUBLE) * 1000000)::BIGINT AS s
  FROM lang_n l CROSS JOIN vocab v LEFT JOIN gram_n g ON g.lang = l.lang AND g.gram = v.gram),
doc_grams AS (SELECT doc_id, gram, sum(n) AS n FROM grams GROUP BY doc_id, gram),
lang_scores AS (
  SELECT d.doc_id, p.lang, sum(d.n * p.s)::BIGINT AS score FROM doc_grams d JOIN logp p USING (gram) GROUP BY d.doc_id, p.lang),
lang_pred AS (
  SELECT doc_id, lang AS lang_pred, score FROM lang_scores
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) = 1)"""


@query(f"{SQL_TEXTS}, {_SQL_LANGID} SELECT doc_id, lang_pred, score FROM lang_pred")
def ngram_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return langid.ngram_language_id(docs, langid.train_profiles(docs))


# -- word steps ----------------------------------------------------------------


@query(f"{SQL_TEXTS} SELECT doc_id, light_text AS text FROM light")
def normalize_words(spark: SparkSession, sf: str) -> DataFrame:
    tokens = light_tokens(spark, sf).filter(F.size("tokens") > 0)
    out = joins.map_tokens(tokens, "tokens", tables(spark).word_map, "word", "formal")
    return out.select("doc_id", F.array_join("tokens", " ").alias("text"))


@query(f"""{_SQL_PAIRS},
corpus_map AS (SELECT word, last(next ORDER BY doc_id, pos) AS formal FROM pairs GROUP BY word)
SELECT w.doc_id, string_agg(coalesce(m.formal, w.w), ' ' ORDER BY w.pos) AS text
FROM words w LEFT JOIN corpus_map m ON m.word = w.w GROUP BY w.doc_id
""")
def normalize_words_large(spark: SparkSession, sf: str) -> DataFrame:
    """By a map that grows with the corpus."""
    # Written once: the words are read for the map, for the lookup and for the result.
    tokens = stage(light_tokens(spark, sf).filter(F.size("tokens") > 0).select("doc_id", "tokens"), "tokens")
    out = joins.map_tokens_by_join(tokens, "tokens", stage(_word_map(tokens), "word-map"), "word", "formal")
    return out.select("doc_id", F.array_join("tokens", " ").alias("text"))


@query(f"""{SQL_TEXTS}
SELECT d.doc_id, coalesce(t.text, '') AS text FROM docs d LEFT JOIN (
  SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS text FROM words
  WHERE length(w) > 1 AND w NOT IN (SELECT word FROM stopwords) GROUP BY doc_id) t USING (doc_id)
""")
def remove_stopwords(spark: SparkSession, sf: str) -> DataFrame:
    out = joins.drop_tokens(light_tokens(spark, sf), "tokens", tables(spark).stopwords, "word", pp.MIN_WORD)
    return out.select("doc_id", F.array_join("tokens", " ").alias("text"))


@query(f"""{SQL_TEXTS},
bench_words AS (
  SELECT DISTINCT unnest({base.sql_words(f"lower({sql_filter_text('text')})")}) AS word FROM benchmark)
SELECT d.doc_id, coalesce(t.text, '') AS text FROM docs d LEFT JOIN (
  SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS text FROM words
  WHERE length(w) > 1 AND w NOT IN (SELECT word FROM bench_words) GROUP BY doc_id) t USING (doc_id)
""")
def remove_stopwords_large(spark: SparkSession, sf: str) -> DataFrame:
    """Stop words taken from a table that grows: all words of the benchmark texts."""
    folded = tx.case_fold(tx.filter_text(F.col("text")))
    words = table(spark, sf, "benchmark").select(F.explode(tx.tokenize(folded, squeezed=True)).alias("word"))
    out = joins.drop_tokens_by_join(light_tokens(spark, sf), "tokens", words, "word", pp.MIN_WORD)
    return out.select("doc_id", F.array_join("tokens", " ").alias("text"))


RULES = stems.AffixRules(suffixes=["(ly|es|en)", "(ing|tion|ed|er)"], prefixes=[("(re|un|be)", ""), ("(in|an)", "")], depth=1)

# Vocabulary and roots are used several times over.
_SQL_STEMS = """vocab AS MATERIALIZED (SELECT w AS word, count(*) AS n FROM words GROUP BY w),
roots AS MATERIALIZED (SELECT word FROM vocab WHERE length(word) BETWEEN 3 AND 5)"""


def _sql_ruled(vocab: str, p: str = "") -> str:
    """``{p}changed``: words of ``vocab`` with the stem that the rules or the table of stems give them."""
    return f"""{p}cut1 AS (SELECT word, regexp_replace(word, '(ly|es|en)$', '') AS s1 FROM {vocab}),
{p}cut2 AS MATERIALIZED (SELECT word, s1, regexp_replace(s1, '(ing|tion|ed|er)$', '') AS s2 FROM {p}cut1),
{p}forms AS (
  SELECT word, word AS stem, 0 AS cuts FROM {p}cut2 UNION ALL SELECT word, s1, 1 FROM {p}cut2 UNION ALL SELECT word, s2, 2 FROM {p}cut2
  UNION ALL SELECT word, regexp_replace(word, '^(re|un|be)', ''), 3 FROM {p}cut2
  UNION ALL SELECT word, regexp_replace(word, '^(in|an)', ''), 4 FROM {p}cut2
  UNION ALL SELECT word, regexp_replace(s1, '^(re|un|be)', ''), 5 FROM {p}cut2
  UNION ALL SELECT word, regexp_replace(s1, '^(in|an)', ''), 6 FROM {p}cut2
  UNION ALL SELECT word, regexp_replace(s2, '^(re|un|be)', ''), 7 FROM {p}cut2
  UNION ALL SELECT word, regexp_replace(s2, '^(in|an)', ''), 8 FROM {p}cut2),
{p}ruled AS (SELECT word, arg_min(stem, cuts) AS stem FROM {p}forms JOIN (SELECT word AS stem FROM roots) USING (stem) GROUP BY word),
{p}changed AS (
  SELECT word, stem FROM {p}ruled WHERE word NOT IN (SELECT word FROM stems)
  UNION ALL SELECT word, stem FROM stems WHERE word IN (SELECT word FROM {vocab}))"""


@query(f"""{SQL_TEXTS}, {_SQL_STEMS}, {_sql_ruled("vocab")}
SELECT word, stem FROM changed WHERE word <> stem
""")
def stem_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = stage(joins.word_counts(light_tokens(spark, sf), "tokens"), "vocabulary")
    roots = vocabulary.filter(F.char_length("word").between(3, 5)).select("word")
    return stems.build_stems(vocabulary, roots, RULES, tables(spark).stems)


# -- whole preprocessing ---------------------------------------------------------


@query(f"""{SQL_TEXTS}, {_SQL_HEURISTIC}, {_SQL_LANGID},
kept AS (SELECT h.doc_id FROM heuristic h LEFT JOIN lang_pred p USING (doc_id) WHERE h.keep OR coalesce(p.lang_pred = 'en', true))
SELECT d.doc_id, CASE WHEN k.doc_id IS NULL THEN '' ELSE coalesce(p.processed_text, '') END AS processed_text
FROM docs d LEFT JOIN kept k USING (doc_id) LEFT JOIN processed p USING (doc_id)
""")
def preprocess(spark: SparkSession, sf: str) -> DataFrame:
    t, docs = tables(spark), documents(spark, sf)
    t.profiles = langid.train_profiles(docs)
    return pp.preprocess(docs, t, light=None).select("doc_id", "processed_text")


@query(f"""{SQL_TEXTS}, {_SQL_HEURISTIC}, {_SQL_LANGID}, {_SQL_STEMS.replace("vocab ", "all_words ").replace("FROM vocab", "FROM all_words")},
kept AS (SELECT h.doc_id FROM heuristic h LEFT JOIN lang_pred p USING (doc_id) WHERE h.keep OR coalesce(p.lang_pred = 'en', true)),
left_words AS MATERIALIZED (
  SELECT n.doc_id, n.pos, n.w FROM norm n JOIN kept USING (doc_id) WHERE length(n.w) > 1 AND n.w NOT IN (SELECT word FROM stopwords)),
left_vocab AS MATERIALIZED (SELECT DISTINCT w AS word FROM left_words), {_sql_ruled("left_vocab", "left_")},
stemmed AS (
  SELECT w.doc_id, string_agg(coalesce(c.stem, w.w), ' ' ORDER BY w.pos) AS text
  FROM left_words w LEFT JOIN left_changed c ON c.word = w.w GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(t.text, '') AS processed_text FROM docs d LEFT JOIN stemmed t USING (doc_id)
""")
def preprocess_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    """With affix rules inside: roots are the short words of all texts, and the vocabulary left is stemmed once a word."""
    t, docs = tables(spark), documents(spark, sf)
    t.profiles, t.affixes = langid.train_profiles(docs), RULES
    words = joins.word_counts(light_tokens(spark, sf), "tokens")
    t.roots = stage(words.filter(F.char_length("word").between(3, 5)).select("word"), "roots")
    return pp.preprocess(docs, t, light=None).select("doc_id", "processed_text")


@query(f"""{SQL_TEXTS}, {_SQL_HEURISTIC}, {_SQL_LANGID},
kept AS (SELECT h.doc_id FROM heuristic h LEFT JOIN lang_pred p USING (doc_id) WHERE h.keep OR coalesce(p.lang_pred = 'en', true))
SELECT d.doc_id, CASE WHEN k.doc_id IS NULL THEN '' ELSE coalesce(l.light_text, '') END AS light_text
FROM docs d LEFT JOIN kept k USING (doc_id) LEFT JOIN light l USING (doc_id)
""")
def preprocess_light(spark: SparkSession, sf: str) -> DataFrame:
    t, docs = tables(spark), documents(spark, sf)
    t.profiles = langid.train_profiles(docs)
    return pp.preprocess_light(docs, t).select("doc_id", "light_text")


_TURN_ID = "(c.conv_id::VARCHAR || ':' || c.turn::VARCHAR)"
SQL_TURN_CTES = sql_token_ctes("conversations c", _TURN_ID, "c.role,", "turn_")
SQL_TURNS = f"WITH {SQL_WORD_TABLES}, {SQL_TURN_CTES}"


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("doc_id"), "role", "text"
    )


@query(f"""{SQL_TURNS}
SELECT d.doc_id, coalesce(l.light_text, '') AS light_text, coalesce(p.processed_text, '') AS processed_text
FROM turn_docs d LEFT JOIN turn_light l USING (doc_id) LEFT JOIN turn_processed p USING (doc_id)
""")
def preprocess_for_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return pp.preprocess_for_scoring(turns(spark, sf), tables(spark)).select("doc_id", "light_text", "processed_text")


@query(f"""{SQL_TEXTS}, {_SQL_HEURISTIC},
no_stop AS (SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS text FROM norm
  WHERE length(w) > 1 AND w NOT IN (SELECT word FROM stopwords) GROUP BY doc_id)
SELECT d.doc_id, {sql_filter_text("d.text")} AS filtered, d.folded, h.keep, coalesce(l.light_text, '') AS normalized,
  coalesce(n.text, '') AS no_stopwords, coalesce(p.processed_text, '') AS stemmed
FROM docs d JOIN heuristic h USING (doc_id) LEFT JOIN light l USING (doc_id)
LEFT JOIN no_stop n USING (doc_id) LEFT JOIN processed p USING (doc_id)
""")
def preprocess_trace(spark: SparkSession, sf: str) -> DataFrame:
    return pp.preprocess_trace(documents(spark, sf), tables(spark))


@query(f"""{SQL_TEXTS}
SELECT d.doc_id, coalesce(t.text, '') AS light_text FROM docs d LEFT JOIN (
  SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS text FROM norm WHERE pos <= 128 GROUP BY doc_id) t USING (doc_id)
""")
def truncate_tokens(spark: SparkSession, sf: str) -> DataFrame:
    light = pp.preprocess_light(documents(spark, sf), tables(spark), filter_lang=False)
    return pp.truncate_tokens(light, "light_text", 128).select("doc_id", "light_text")
