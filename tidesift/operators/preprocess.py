"""From raw texts to processed and light texts.

Steps: clean, lower, keep the wanted language, replace informal words (the
*light* text ends here), drop stop words, stem (the *processed* text).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidesift.functions import text as tx
from tidesift.functions.lookup import LiteralSet
from tidesift.functions.names import free
from tidesift.functions.once import compute_once
from tidesift.operators.joins import drop_tokens, map_tokens, text_key
from tidesift.operators.langid import LanguageProfiles, text_languages, train_profiles
from tidesift.operators.stems import INDONESIAN, AffixRules, stem_tokens
from tidesift.sources import wordlists

MIN_WORD = 2


@dataclass
class TextTables:
    """Word tables of the preprocessing steps.

    ``affixes`` stem the words that ``stems`` does not hold, checked against ``roots``.
    """

    word_map: DataFrame
    stopwords: DataFrame
    stems: DataFrame | None = None
    strong: list[str] = field(default_factory=lambda: list(wordlists.STRONG_WORDS))
    negations: list[str] = field(default_factory=lambda: list(wordlists.NEGATIONS))
    language: str = "id"
    profiles: LanguageProfiles | None = None
    roots: DataFrame | None = None
    affixes: AffixRules | None = None


def default_tables(spark: SparkSession, known: DataFrame | None = None, text: str = "text", lang: str = "lang") -> TextTables:
    """The embedded tables, with affix rules and root words.

    ``known`` holds texts with their languages, such as the rows themselves where they state one: language
    profiles are learnt from it. Without it, or with one language only, no text is refused for its language.
    """
    out = TextTables(
        wordlists.map_frame(spark, wordlists.WORD_MAP), wordlists.words_frame(spark, wordlists.STOPWORDS),
        roots=wordlists.words_frame(spark, wordlists.ROOTS), affixes=INDONESIAN,
    )
    if known is not None:
        profiles = train_profiles(known, lang, text)
        out.profiles = profiles if len(profiles.languages) > 1 else None
    return out


def language_heuristic(tokens: Column, strong: list[str]) -> Column:
    """True where a text is kept without asking for its language.

    That is below three words, or with two or more occurrences of strong words.
    """
    words = LiteralSet(strong)
    return (F.size(tokens) < 3) | (F.size(F.filter(tokens, words.contains)) >= 2)


def _tokens(df: DataFrame, text: str, tokens: str) -> DataFrame:
    clean = tx.case_fold(tx.filter_text(F.col(text)))
    return compute_once(df, {tokens: tx.tokenize(clean, squeezed=True)})


def _keep_language(df: DataFrame, tables: TextTables, tokens: str) -> DataFrame:
    """Empties the tokens of texts in another language.

    Only texts the heuristic leaves open are scored by the n-gram profiles;
    without profiles they cannot be judged, and are kept.
    """
    if tables.profiles is None:
        return df
    keep, key, other, lang = free(df, "__keep", "__text", "__other", "__lang")
    kept = df.withColumn(keep, language_heuristic(F.col(tokens), tables.strong))
    # Read from the input a second time: the two branches share no shuffle,
    # and the decided texts take no part in the join.
    open_ = kept.filter(~F.col(keep))
    langs = text_languages(open_.select(tokens), tokens, tables.profiles)
    langs = langs.select(F.col("text").alias(other), F.col("lang_pred").alias(lang))
    found = open_.withColumn(key, text_key(F.col(tokens))).join(langs, F.col(key) == F.col(other), "left")
    # A text without any n-gram cannot be judged, and is kept.
    found = found.withColumn(keep, F.coalesce(F.col(lang) == tables.language, F.lit(True)))
    kept = kept.filter(keep).unionByName(found.select(kept.columns))
    empty = F.array().cast("array<string>")
    return kept.withColumn(tokens, F.when(F.col(keep), F.col(tokens)).otherwise(empty)).drop(keep)


def _stemmed(df: DataFrame, tables: TextTables, tokens: str, id_col: str) -> DataFrame:
    if tables.affixes is not None and tables.roots is not None:
        return stem_tokens(df, tokens, tables.roots, tables.affixes, tables.stems, id_col)
    return df if tables.stems is None else map_tokens(df, tokens, tables.stems, "word", "stem", id_col)


def preprocess(
    df: DataFrame,
    tables: TextTables,
    text: str = "text",
    id_col: str = "doc_id",
    filter_lang: bool = True,
    processed: str | None = "processed_text",
    light: str | None = "light_text",
) -> DataFrame:
    """Adds the processed and the light text; both share all steps up to the light text.

    A text that is empty, or that the tables' language profiles find in another
    language, gets empty texts. Give None for one that is not wanted. Null texts
    count as empty. Ids may be null or repeat.
    """
    tokens, short = free(df, "__tokens", "__light")
    out = _tokens(df, text, tokens)
    if filter_lang:
        out = _keep_language(out, tables, tokens)
    out = map_tokens(out, tokens, tables.word_map, "word", "formal", id_col)
    out = compute_once(out, {short: F.trim(F.array_join(tokens, " "))})
    if processed:
        # Formal words may hold blanks, so the light text is split once more.
        out = out.withColumn(tokens, tx.tokenize(F.col(short), squeezed=True))
        out = drop_tokens(out if light else out.drop(short), tokens, tables.stopwords, "word", MIN_WORD, id_col)
        out = _stemmed(out, tables, tokens, id_col)
        out = compute_once(out, {processed: F.array_join(tokens, " ")})
    if light:
        out = out.withColumn(light, F.col(short))
    return out.drop(tokens, short)


def preprocess_light(df: DataFrame, tables: TextTables, **options) -> DataFrame:
    """Adds only the light text, which keeps negations and word order."""
    return preprocess(df, tables, processed=None, **options)


def preprocess_for_scoring(df: DataFrame, tables: TextTables, **options) -> DataFrame:
    """Both texts without the language filter, so that short texts are not lost."""
    return preprocess(df, tables, filter_lang=False, **options)


def preprocess_trace(df: DataFrame, tables: TextTables, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per text with what each step makes of it."""
    out = df.select(id_col, F.col(text).alias("_text"))
    out = compute_once(out, {"filtered": tx.filter_text(F.col("_text"))}).drop("_text")
    out = compute_once(out, {"folded": tx.case_fold(F.col("filtered"))})
    out = compute_once(out, {"_t": tx.tokenize(F.col("folded"), squeezed=True)})
    out = out.withColumn("keep", language_heuristic(F.col("_t"), tables.strong))
    out = compute_once(map_tokens(out, "_t", tables.word_map, "word", "formal", id_col), {"_t": F.col("_t")})
    out = compute_once(out, {"normalized": F.array_join("_t", " ")})
    out = out.withColumn("_t", tx.tokenize(F.col("normalized"), squeezed=True))
    out = compute_once(drop_tokens(out, "_t", tables.stopwords, "word", MIN_WORD, id_col), {"_t": F.col("_t")})
    out = out.withColumn("no_stopwords", F.array_join("_t", " "))
    out = _stemmed(out, tables, "_t", id_col)
    out = out.withColumn("stemmed", F.array_join("_t", " "))
    return out.select(id_col, "filtered", "folded", "keep", "normalized", "no_stopwords", "stemmed")


def truncate_tokens(df: DataFrame, text: str, max_length: int = 128) -> DataFrame:
    """Caps a text at ``max_length`` words."""
    return df.withColumn(text, F.array_join(F.slice(tx.tokenize(F.col(text)), 1, max_length), " "))
