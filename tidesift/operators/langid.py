"""Language identification: naive Bayes over the character n-grams of words, as joins and sums."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidesift.functions.once import compute_once
from tidesift.functions.text import case_fold, filter_text, tokenize
from tidesift.operators.joins import hits, table_size, text_key, word_counts
from tidesift.sources.scratch import stage

# N-grams whose scores may be broadcast, by their measured bytes: some 30 MB.
MAX_BROADCAST_SCORES, SCORE_BYTES = 300_000, 100
GRAM = 3
# Log probabilities are held in whole millionths, so sums do not depend on order.
SCALE = 1_000_000


@dataclass
class LanguageProfiles:
    """``grams`` holds ``(gram, scores)`` with one score per language, in order."""

    languages: list[str]
    unseen: list[int]
    grams: DataFrame


def word_grams(word: Column) -> Column:
    """The n-grams of a word with a blank on both sides; a blank marks where words begin and end."""
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    # Looks ahead by a whole n-gram, then takes one character.
    return F.regexp_extract_all(padded, F.lit(f"(?=(.{{{GRAM}}}))."), F.lit(1))


def _words(df: DataFrame, keep: str, text: str, cleaned: bool) -> DataFrame:
    """How often each word of the whole cleaned text occurs per value of ``keep``."""
    clean = F.col(text) if cleaned else case_fold(filter_text(F.col(text)))
    return word_counts(df.select(F.col(keep), clean.alias("_clean")), tokenize(F.col("_clean"), squeezed=True), (keep,))


def gram_counts(df: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """Occurrences of each n-gram in each language.

    Words are counted first, so each different word is cut up once per language.
    """
    words = _words(df, lang, text, False)
    grams = words.select(F.col(lang).alias("lang"), "n", F.explode(word_grams(F.col("word"))).alias("gram"))
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train_profiles(df: DataFrame, lang: str = "lang", text: str = "text") -> LanguageProfiles:
    """Learn n-gram log probabilities per language, add-one smoothed; rows without a language take no part.

    The driver sees one row per language; the n-gram table is written once to
    the shared folder and read from there by every later use.
    """
    counts = stage(gram_counts(df.where(F.col(lang).isNotNull()), lang, text), "gram-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()
    vocabulary = counts.select("gram").distinct().count()
    languages = [r.lang for r in totals]
    # Not named n: a Row also has tuple methods, and count or index would hide a column.
    denominators = [r["n"] + vocabulary for r in totals]

    def score(n: Column, denominator: int) -> Column:
        p = (n + 1).cast("double") / F.lit(float(denominator))
        return F.round(F.log(p) * SCALE).cast("long")

    per_language = [
        score(F.coalesce(F.sum(F.when(F.col("lang") == l, F.col("n"))), F.lit(0)), d)
        for l, d in zip(languages, denominators)
    ]
    grams = stage(counts.groupBy("gram").agg(F.array(*per_language).alias("scores")), "gram-scores")
    unseen = list(
        df.sparkSession.range(1).select(*[score(F.lit(0), d).alias(f"u{k}") for k, d in enumerate(denominators)]).first()
    )
    return LanguageProfiles(languages, unseen, grams)


def word_scores(words: DataFrame, profiles: LanguageProfiles) -> DataFrame:
    """``word`` with the sum of its n-grams' scores in each language, ``s0`` and so on; each word is cut up once."""
    grams = words.select("word", F.explode(word_grams(F.col("word"))).alias("gram"))
    names = [f"s{k}" for k in range(len(profiles.languages))]
    scores = profiles.grams.select("gram", *[F.get("scores", F.lit(k)).alias(s) for k, s in enumerate(names)])
    small = table_size(scores)[1] <= MAX_BROADCAST_SCORES * SCORE_BYTES
    met = grams.join(F.broadcast(scores) if small else scores.hint("merge"), "gram", "left")
    return met.groupBy("word").agg(*[F.sum(F.coalesce(s, F.lit(u))).alias(s) for s, u in zip(names, profiles.unseen)])


def text_languages(texts: DataFrame, tokens: str, profiles: LanguageProfiles) -> DataFrame:
    """``text, lang_pred, score`` of each different text with at least one word; ``text`` is its key (``joins.text_key``).

    N-grams are looked up once per different word of all texts, and a text adds up its words. Equal texts
    are one: each word's sums count as often as the text's first word does, and are divided by that.
    """
    if not profiles.languages:
        return texts.select(text_key(F.col(tokens)).alias("text"), F.lit(None).cast("string").alias("lang_pred"), F.lit(0).cast("long").alias("score")).limit(0)
    scored = stage(word_scores(word_counts(texts, tokens).select("word"), profiles), "word-scores")
    found = hits(texts, tokens, scored, "word")
    names = [f"s{k}" for k in range(len(profiles.languages))]
    copies = F.sum((F.col("pos") == 0).cast("long"))
    sums = found.groupBy("text").agg(copies.alias("copies"), *[F.sum(F.col("found")[s]).alias(s) for s in names])
    order = [
        F.struct(F.call_function("div", F.col(s), F.col("copies")).alias("score"), F.lit(-k).alias("order"), F.lit(l).alias("lang"))
        for k, (s, l) in enumerate(zip(names, profiles.languages))
    ]
    best = F.array_max(F.array(*order))
    return sums.select("text", best.alias("best")).select("text", F.col("best.lang").alias("lang_pred"), F.col("best.score").alias("score"))


def ngram_language_id(
    df: DataFrame, profiles: LanguageProfiles, text: str = "text", id_col: str = "doc_id", cleaned: bool = False
) -> DataFrame:
    """``(id, lang_pred, score)`` of each row whose text has at least one word, whatever the ids.

    Ties go to the language first in alphabetical order.
    """
    clean = F.col(text) if cleaned else case_fold(filter_text(F.col(text)))
    texts = compute_once(df.select(id_col, clean.alias("__clean")), {"__words": tokenize(F.col("__clean"), squeezed=True)})
    rows = texts.where(F.size("__words") > 0).select(id_col, text_key(F.col("__words")).alias("text"))
    return rows.join(text_languages(texts, "__words", profiles), "text").select(id_col, "lang_pred", "score")
