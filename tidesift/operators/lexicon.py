"""Sentiment lexicons: building one, and scoring texts by it.

A lexicon is one table ``(word, weight)`` of unique words; the sign of the
weight is the polarity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidesift.functions.lookup import LiteralMap, LiteralSet, small_map
from tidesift.functions.names import free
from tidesift.functions.once import compute_once
from tidesift.functions.text import tokenize
from tidesift.operators.joins import back_to_texts, hits
from tidesift.sources.local import local_frame

# Class names, in alphabetical order.
CLASSES = ["Negatif", "Netral", "Positif"]
NEGATIVE, NEUTRAL, POSITIVE = CLASSES

CONFLICT_RULES = ("net", "drop", "stronger")


def resolve_conflicts(positive: DataFrame, negative: DataFrame, rule: str = "net") -> DataFrame:
    """One lexicon of two lists; the rule decides on words that stand in both.

    ``net`` keeps the difference on the stronger side, ``stronger`` keeps the
    stronger side's whole weight, ``drop`` keeps neither. Equal sides cancel
    under each rule.
    """
    if rule not in CONFLICT_RULES:
        raise ValueError(f"unknown rule {rule!r}; use one of {CONFLICT_RULES}")
    both = positive.select("word", F.col("weight").alias("p")).join(
        negative.select("word", F.abs("weight").alias("n")), "word", "full_outer"
    )
    p, n = F.coalesce("p", F.lit(0)), F.coalesce("n", F.lit(0))
    if rule == "net":
        weight = p - n
    else:
        stronger = F.when(p > n, p).when(n > p, -n).otherwise(0)
        in_both = F.col("p").isNotNull() & F.col("n").isNotNull()
        weight = F.when(in_both, 0).otherwise(p - n) if rule == "drop" else stronger
    return both.select("word", weight.cast("int").alias("weight")).filter(F.col("weight") != 0)


def lexicon_overrides(lexicon: DataFrame, overrides: DataFrame) -> DataFrame:
    """Set the weights of the override words; weight 0 removes a word."""
    kept = lexicon.join(overrides, "word", "left_anti").select("word", "weight")
    return kept.unionByName(overrides.filter(F.col("weight") != 0).select("word", "weight"))


def build_lexicon(
    positive: DataFrame, negative: DataFrame, overrides: DataFrame | None = None, rule: str = "net"
) -> DataFrame:
    lexicon = resolve_conflicts(positive, negative, rule)
    return lexicon if overrides is None else lexicon_overrides(lexicon, overrides)


def lexicon_stats(positive: DataFrame, negative: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Sizes of the lists, of their overlap and of the two sides of the result."""
    shared = positive.select("word").intersect(negative.select("word"))
    parts = [
        ("positive_listed", positive),
        ("negative_listed", negative),
        ("conflicts", shared),
        ("positive_kept", lexicon.filter(F.col("weight") > 0)),
        ("negative_kept", lexicon.filter(F.col("weight") < 0)),
    ]
    rows = [part.agg(F.lit(name).alias("item"), F.count("*").alias("words")) for name, part in parts]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def _score_expression(tokens: Column, weights: LiteralMap, negations: LiteralSet | None) -> Column:
    """Folds over the tokens that matter."""
    weight = lambda t: F.coalesce(weights.get(t), F.lit(0)).cast("long")
    if negations is None:
        return F.aggregate(F.transform(tokens, weight), F.lit(0).cast("long"), lambda s, w: s + w)
    marked = F.transform(tokens, lambda t: F.when(~negations.contains(t), weight(t)))
    return _fold(F.filter(marked, lambda w: w.isNull() | (w != 0)))


def _fold(marked: Column) -> Column:
    """The sum of weights in order, where null, a negation word, turns the sign of the next one."""

    def step(state: Column, w: Column) -> Column:
        signed = F.when(state["flip"], -w).otherwise(w)
        return F.struct(
            F.coalesce(state["score"] + signed, state["score"]).alias("score"), w.isNull().alias("flip")
        )

    start = F.struct(F.lit(0).cast("long").alias("score"), F.lit(False).alias("flip"))
    return F.aggregate(marked, start, step, lambda state: state["score"])


def lexicon_score(
    df: DataFrame,
    lexicon: DataFrame,
    negations: list[str] | None = None,
    text: str = "light_text",
    id_col: str = "doc_id",
    score: str = "score",
) -> DataFrame:
    """Adds the summed weight of a text's words.

    With ``negations``, a negation word is not scored itself; it turns the sign
    of the next weighted word, and several in a row turn it once. Null texts
    score 0. Of a word that the lexicon holds twice, the greater weight counts.
    """
    lexicon = lexicon.groupBy("word").agg(F.max("weight").alias("weight"))
    weights = small_map(lexicon, "word", "weight")
    if weights is None:
        return lexicon_score_by_join(df, lexicon, negations, text, id_col, score)
    words = LiteralSet(negations) if negations else None
    total = _score_expression(tokenize(F.col(text)), weights, words)
    return compute_once(df, {score: F.coalesce(total, F.lit(0).cast("long"))})


def lexicon_score_by_join(
    df: DataFrame,
    lexicon: DataFrame,
    negations: list[str] | None = None,
    text: str = "light_text",
    id_col: str = "doc_id",
    score: str = "score",
) -> DataFrame:
    """``lexicon_score`` for a lexicon of any size, whatever the ids.

    Only weighted words and negations pass the join, and the previous such word
    of the same text decides on the sign. Texts without a hit score 0.
    """
    spark = df.sparkSession
    # A word of weight 0 must not stand between a negation and the word it turns.
    table = lexicon.filter(F.col("weight") != 0).select("word", F.col("weight").cast("long").alias("weight"))
    if negations:
        flags = local_frame(spark, [(w,) for w in sorted(set(negations))], "word string")
        table = table.join(F.broadcast(flags), "word", "left_anti").unionByName(
            flags.withColumn("weight", F.lit(None).cast("long"))
        )
    tokens, found = free(df, "__tokens", "__found")
    texts = compute_once(df, {tokens: tokenize(F.col(text))})
    scored = back_to_texts(texts, tokens, hits(texts, tokens, table, "word"), found)
    total = _fold(F.transform(found, lambda f: f["found"]["weight"]))
    return scored.withColumn(score, F.coalesce(total, F.lit(0).cast("long"))).select(*[c for c in df.columns if c != score], score)


def sentiment_label(score: Column) -> Column:
    return F.when(score > 0, POSITIVE).when(score < 0, NEGATIVE).otherwise(NEUTRAL)


def label_texts(df: DataFrame, lexicon: DataFrame, negations: list[str] | None, text: str = "light_text", **options) -> DataFrame:
    """Adds ``score`` and ``label``; null and blank texts are neutral."""
    scored = lexicon_score(df, lexicon, negations, text, **options)
    return scored.withColumn("label", sentiment_label(F.col("score")))


# Class shares given to a score, by its sign and strength.
STRONG_SCORE = 5
SHARES = {
    "strong": {"same": 0.95, "neutral": 0.04, "other": 0.01},
    "weak": {"same": 0.85, "neutral": 0.10, "other": 0.05},
    "none": {"neutral": 0.80, "other": 0.10},
}


def pseudo_proba(score: Column) -> dict[str, Column]:
    """Class probabilities made from a lexicon score."""
    strong = F.abs(score) >= STRONG_SCORE

    def share(kind: str) -> Column:
        return F.when(strong, SHARES["strong"][kind]).otherwise(SHARES["weak"][kind])

    def side(sign: int) -> Column:
        return F.when(score == 0, SHARES["none"]["other"]).when(F.signum(score) == sign, share("same")).otherwise(share("other"))

    return {
        NEGATIVE: side(-1),
        NEUTRAL: F.when(score == 0, SHARES["none"]["neutral"]).otherwise(share("neutral")),
        POSITIVE: side(1),
    }


def set_membership(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Words of both tables (``intersection``) or of either (``union``), each once."""
    left, right = left.select("word"), right.select("word")
    return left.intersect(right) if how == "intersection" else left.union(right).distinct()


def concat_frames(*frames: DataFrame) -> DataFrame:
    """Rows of several tables of the same columns."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
