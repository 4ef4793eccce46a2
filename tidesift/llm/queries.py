"""Queries over the operators of this subpackage, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidesift.llm import (
    decontaminate, hard_negatives, jaccard_tree, labelled, langid_cnn, nearest, phrases, quality, render, sentencepiece_table, substrings,
    token_files, toxicity, warc,
)
from tidesift.llm.labelled import held_out
from tidesift.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fit_language(docs: DataFrame) -> langid_cnn.Model:
    known = docs.where(~held_out() & F.col("lang").isNotNull()).select("doc_id", F.col("lang").alias("label"))
    chosen = labelled.sample(known, "doc_id", "label", langid_cnn.ROWS_PER_CLASS)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return langid_cnn.fit(rows, "text", "label")


def fit_quality(docs: DataFrame, labels: DataFrame) -> quality.Model:
    rows, share = labelled.training(labels, docs, "quality", quality.ROWS_PER_CLASS)
    return quality.fit(rows, "text", "label", share)


@query
def op1_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf, "pages"), path)
    read = warc.read(spark, path, payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op1_warc"] = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
),
firsts AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS largest FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN largest END AS refers_to
FROM firsts
"""


@query
def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = fit_language(docs)
    return langid_cnn.predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model, "text").drop("text")


@query
def op3_render(spark: SparkSession, sf: str) -> DataFrame:
    return render.extract(table(spark, sf, "pages").select("page_id", "html"), "html", "text").drop("html")


@query
def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    rows, _ = labelled.training(table(spark, sf, "labels"), docs, "toxic", toxicity.ROWS_PER_CLASS)
    model = toxicity.fit(rows, "text", "label")
    scored = toxicity.score(docs.select("doc_id", held_out().alias("held_out"), "text"), model, "text").drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def leaks(docs: DataFrame, items: DataFrame, out: str = "leaks") -> DataFrame:
    """Documents with the benchmark items they hold, short ones too.

    The benchmark has no answers: overlaps are given for an item's last sentence and what is before it, but the item
    counts as a whole.
    """
    parts = decontaminate.split_answer(items, "text")
    return decontaminate.find(docs, "text", parts, "item_id", "question", "answer", out, decontaminate.Rule(whole=True), short=True)


@query
def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = leaks(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    found = found.select("doc_id", F.explode("leaks").alias("leak"))
    return found.select(
        "doc_id",
        F.col("leak.item").alias("item_id"),
        "leak.score",
        F.col("leak.question").alias("question_overlap"),
        F.col("leak.answer").alias("answer_overlap"),
    )


@query
def op9_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return nearest.nearest(table(spark, sf, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 100 == 0)


@query
def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = fit_quality(docs, table(spark, sf, "labels"))
    scored = quality.score(docs.select("doc_id", held_out().alias("held_out"), "text"), model, "text").drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op6_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    coded = sentencepiece_table.encode(docs, "text", public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    docs = table(spark, sf, "documents")
    token_files.write(docs, path, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read(spark, path, token_files.id_checksums, "ids_crc32 long")


@query
def op8_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = jaccard_tree.join(table(spark, sf, "documents"), "doc_id", "text", jaccard_tree.Rule(words=4, percent=85))
    return joined.select("doc_id", F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


@query
def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", turned.alias("label"), hard_negatives.whole("embedding").alias("vector"))
    return hard_negatives.mine(rows, "vec_id", "label", "vector", F.col("vec_id") % 50 == 0)


SQL["op11_hard_negatives"] = """
WITH rows AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.id <> b.id WHERE a.id % 50 = 0
),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 3
"""


@query
def op12_substrings(spark: SparkSession, sf: str) -> DataFrame:
    left = substrings.remove_repeats(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op12_substrings"] = r"""
WITH texts AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS body FROM texts, unnest(range(1, len(w) - 18)) AS t(i)
),
late AS (
    SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, i) > 1
),
words AS (
    SELECT doc_id, i, w[i] AS word FROM texts, unnest(range(1, len(w) + 1)) AS t(i)
),
covered AS (
    SELECT words.doc_id, words.i, word,
           coalesce(max(CASE WHEN late.i IS NOT NULL THEN 1 END) OVER (
               PARTITION BY words.doc_id ORDER BY words.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) AS gone
    FROM words LEFT JOIN late ON late.doc_id = words.doc_id AND late.i = words.i
),
sums AS (
    SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed,
           coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '') AS kept
    FROM covered GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN sums USING (doc_id)
"""


@query
def op13_phrases(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return phrases.collocations(docs, "text", F.coalesce("lang", F.lit("und"))).withColumnRenamed("grp", "lang")


SQL["op13_phrases"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
split AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM split, unnest([1, 2, 3]) AS a(k), unnest(range(1, len(w) - k + 2)) AS b(i)
),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE k >= 2 AND f >= 10),
cuts AS (
    SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r,
           ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
    JOIN counts x ON x.lang = c.lang AND x.k = cut AND x.phrase = array_to_string(c.w[1:cut], ' ')
    JOIN counts y ON y.lang = c.lang AND y.k = c.k - cut AND y.phrase = array_to_string(c.w[cut + 1:], ' ')
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1
),
around AS (
    SELECT lang, phrase, max(a) AS most FROM (
        SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM candidates WHERE k = 3
    ) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM cuts LEFT JOIN around USING (lang, phrase) JOIN sizes USING (lang)
WHERE NOT coalesce(100 * most >= 50 * a, FALSE)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
