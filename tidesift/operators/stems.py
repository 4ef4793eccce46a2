"""Stemming: each word of the vocabulary once, not each token.

A word is cut by affix rules; of its forms found among the root words the one
with the fewest cuts is its stem. A ``(word, stem)`` table given by the user
goes before the rules.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tidesift.functions.lookup import LiteralSet, read_small, small_map, small_set
from tidesift.operators.joins import map_tokens, word_counts
from tidesift.sources.scratch import stage


@dataclass
class AffixRules:
    """``suffixes`` are tried in order, each at most once; ``prefixes`` up to ``depth`` times.

    A suffix is a pattern to cut at the end of a word, a prefix rule a pattern
    at its start with the text that replaces it. ``impossible`` names pairs of
    patterns, of a word's start and of the last suffix cut, that no word has
    around its root: behind such a suffix that start is part of the root.
    A word that ``prefix_first`` matches loses prefixes before suffixes.
    """

    suffixes: list[str] = field(default_factory=list)
    prefixes: list[tuple[str, str]] = field(default_factory=list)
    depth: int = 2
    min_length: int = 2
    impossible: list[tuple[str, str]] = field(default_factory=list)
    prefix_first: str | None = None


# Indonesian affixes as given in grammars and in the published
# confix-stripping method; a nasal prefix may hide the first letter of the root.
INDONESIAN = AffixRules(
    suffixes=["(lah|kah|tah|pun)", "(ku|mu|nya)", "(kan|an|i)"],
    prefixes=[
        ("di", ""), ("ke", ""), ("se", ""),
        ("ber", ""), ("bel", ""), ("be", ""),
        ("ter", ""), ("te", ""), ("per", ""), ("pel", ""),
        ("(?:me|pe)", ""),
        ("(?:mem|pem)(?=[bfvp])", ""), ("(?:mem|pem)(?=[aiueor])", "p"),
        ("(?:men|pen)(?=[cdjstz])", ""), ("(?:men|pen)(?=[aiueor])", "t"),
        ("(?:meny|peny)(?=[aiueo])", "s"),
        ("(?:meng|peng)(?=[aiueoghkq])", ""), ("(?:meng|peng)(?=[aiueo])", "k"),
        ("(?:menge|penge)", ""),
    ],
    impossible=[("be", "i"), ("di", "an"), ("ke", "i|kan"), ("me", "an"), ("se", "i|kan"), ("te", "an")],
    prefix_first="^(?:be.*(?:lah|an)|(?:di|me|pe|ter).*i)$",
)


def _cut(word: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(word, F.lit(pattern), F.lit(by))


def _suffix_chain(word: Column, rules: AffixRules) -> list[tuple[Column, Column]]:
    """The word and its forms after each kind of suffix, with the last suffix cut."""
    forms = [(word, F.lit(""))]
    for suffix in rules.suffixes:
        form, tail = forms[-1]
        cut = _cut(form, f"{suffix}$")
        forms.append((cut, F.when(cut != form, F.substr(form, F.char_length(cut) + 1)).otherwise(tail)))
    return forms


def _without_prefixes(found: Column, rules: AffixRules) -> Column:
    """``found`` forms with their suffixes, followed by what up to ``depth`` prefixes leave of them."""

    def cut(f: Column, pattern: str, by: str) -> Column:
        kept = _cut(f["form"], f"^{pattern}", by)
        bad = [f["form"].rlike(f"^{start}") & f["tail"].rlike(f"^(?:{tail})$") for start, tail in rules.impossible]
        for b in bad:
            kept = F.when(b, f["form"]).otherwise(kept)
        return F.struct(kept.alias("form"), f["tail"].alias("tail"))

    for _ in range(rules.depth if rules.prefixes else 0):
        new = F.flatten(F.transform(found, lambda f: F.array(*[cut(f, p, by) for p, by in rules.prefixes])))
        found = F.array_distinct(F.concat(found, new))
    return found


def candidates(word: Column, rules: AffixRules) -> Column:
    """The word's forms, those with fewer cuts first; the word itself leads.

    At most ``len(suffixes) + 1`` forms enter, and each of ``depth`` rounds adds one per form and prefix rule,
    of which those that change nothing are dropped.
    """
    pair = lambda form, tail: F.struct(form.alias("form"), tail.alias("tail"))
    chain = F.array_distinct(F.array(*[pair(form, tail) for form, tail in _suffix_chain(word, rules)]))
    found = F.transform(_without_prefixes(chain, rules), lambda f: f["form"])
    if rules.prefix_first:
        bare = F.transform(_without_prefixes(F.array(pair(word, F.lit(""))), rules), lambda f: f["form"])
        found = F.when(word.rlike(rules.prefix_first), F.concat(bare, found)).otherwise(found)
    return F.filter(F.array_distinct(found), lambda f: F.char_length(f) >= rules.min_length)


def stem_word(word: Column, roots: LiteralSet, rules: AffixRules) -> Column:
    """The first form of a word that is a root, or the word: for streams, which have no vocabulary."""
    return F.coalesce(F.get(F.filter(candidates(word, rules), roots.contains), F.lit(0)), word)


def stem_tokens(df: DataFrame, tokens: str, roots: DataFrame, rules: AffixRules, stems: DataFrame | None = None, id_col: str = "doc_id") -> DataFrame:
    """Replaces tokens by their stems: the vocabulary of all texts is stemmed, once a word, and joined back once a word.

    A stream's words are stemmed where they stand; its roots must fit a constant.
    """
    if df.isStreaming:
        known = read_small(roots.select("word"))
        if known is None:
            raise ValueError("the roots of a stream must fit a constant; score its batches by foreachBatch")
        words = LiteralSet(r["word"] for r in known)
        given = small_map(stems, "word", "stem") if stems is not None else None
        first = (lambda x: given.get(x)) if given is not None else (lambda x: F.lit(None).cast("string"))
        return df.withColumn(tokens, F.transform(tokens, lambda x: F.coalesce(first(x), stem_word(x, words, rules))))
    # The words are read to be counted, looked up and put back; what made them, such as a filter by language, is done once.
    void = {f.name: F.lit(None) for f in df.schema.fields if f.dataType.typeName() == "void"}
    df = stage(df.drop(*void), "stemming").withColumns(void).select(df.columns)
    vocabulary = word_counts(df, tokens).select("word")
    return map_tokens(df, tokens, stage(build_stems(stage(vocabulary, "vocabulary"), roots, rules, stems), "stems"), "word", "stem", id_col)


def build_stems(
    vocabulary: DataFrame, roots: DataFrame, rules: AffixRules, stems: DataFrame | None = None
) -> DataFrame:
    """``(word, stem)`` of each vocabulary word that changes.

    ``vocabulary`` and ``roots`` hold a ``word`` column of unique words.
    """
    forms = vocabulary.select("word", F.posexplode(candidates(F.col("word"), rules)).alias("cuts", "stem"))
    known = small_set(roots, "word")
    if known is not None:
        found = forms.filter(known.contains(F.col("stem")))
    else:
        found = forms.join(roots.select(F.col("word").alias("stem")), "stem", "left_semi")
    ruled = found.groupBy("word").agg(F.min_by("stem", "cuts").alias("stem"))
    if stems is not None:
        ruled = ruled.join(stems, "word", "left_anti").unionByName(
            stems.join(vocabulary, "word", "left_semi").select("word", "stem")
        )
    return ruled.filter(F.col("stem") != F.col("word"))
