"""Text cleaning as column expressions.

Java's ``\\w``, ``\\d`` and ``\\s`` are ASCII-only, so the classes are spelled out in
Unicode terms. They read the same in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Character classes of the cleaning rules.
SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"
NOT_SPACE = f"[^{SPACE}]"
WORD = r"[\p{L}\p{N}_]"

URL = f"http{NOT_SPACE}+|www{NOT_SPACE}+"
MENTION = f"@{WORD}+"
HASHTAG = f"#({WORD}+)"
DIGITS = r"\p{Nd}+"
PUNCTUATION = rf"[^\p{{L}}\p{{N}}_{SPACE}]"
UNDERSCORES = "_+"
SPACES = f"[{SPACE}]+"

# The ten code-point ranges treated as emoji.
EMOJI_RANGES = [
    ("1F600", "1F64F"),
    ("1F300", "1F5FF"),
    ("1F680", "1F6FF"),
    ("1F700", "1F77F"),
    ("1F780", "1F7FF"),
    ("1F800", "1F8FF"),
    ("1F900", "1F9FF"),
    ("1FA00", "1FA6F"),
    ("1FA70", "1FAFF"),
    ("2702", "27B0"),
]
EMOJI = "[" + "".join(rf"\x{{{lo}}}-\x{{{hi}}}" for lo, hi in EMOJI_RANGES) + "]+"

# Emoji, digits, punctuation, underscores and blanks in one class. All the emoji
# ranges but the dingbats hold symbols only, which the first part already covers.
# One class, not two in a group: Java repeats a group by recursion, which long runs end by a stack overflow.
NOT_LETTERS = r"[[^\p{L}\p{Nl}\p{No}][\x{2702}-\x{27B0}]]+"


def _replace(c: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(by))


def strip_urls(c: Column) -> Column:
    return _replace(c, URL, " ")


def strip_mentions(c: Column) -> Column:
    return _replace(c, MENTION, " ")


def unwrap_hashtags(c: Column) -> Column:
    return _replace(c, HASHTAG, "$1")


def strip_emoji(c: Column) -> Column:
    return _replace(c, EMOJI, " ")


def strip_digits(c: Column) -> Column:
    return _replace(c, DIGITS, " ")


def strip_punctuation(c: Column) -> Column:
    return _replace(c, PUNCTUATION, " ")


def strip_underscores(c: Column) -> Column:
    return _replace(c, UNDERSCORES, " ")


def squeeze_spaces(c: Column) -> Column:
    return F.trim(_replace(c, SPACES, " "))


def filter_text(c: Column) -> Column:
    """All cleaning steps in their fixed order; null becomes the empty text."""
    c = unwrap_hashtags(strip_mentions(strip_urls(c)))
    return F.coalesce(F.trim(_replace(c, NOT_LETTERS, " ")), F.lit(""))


def case_fold(c: Column) -> Column:
    """Lower case; applied after cleaning, so an upper-case ``HTTP://`` is not a URL."""
    return F.lower(c)


def tokenize(c: Column, squeezed: bool = False) -> Column:
    """Words between blanks; an empty text gives an empty array.

    ``squeezed`` says that the text has no other blanks than spaces.
    """
    return F.array_remove(F.split(c, F.lit(" " if squeezed else SPACES)), F.lit(""))


def is_blank(c: Column) -> Column:
    """True for null and for texts of blanks only."""
    return ~F.coalesce(c.rlike(NOT_SPACE), F.lit(False))
