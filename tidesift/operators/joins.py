"""Looking up the words of texts in dictionaries of any size.

Up to 50 000 entries a dictionary is a constant of the expression and texts do not move (``functions.lookup``). Larger
ones are joined by word:

- Up to ``MAX_BROADCAST_BYTES``, which are measured, the dictionary goes to the tokens.
- Beyond, tokens go to the dictionary, but only those that pass a Bloom filter of its words, built by an aggregate and
  sized by its rows. Both sides of that join are shuffled by word, so that Spark splits a word that many texts share.
  Where adaptive execution is off, which does that, such words are counted first and get salts.

Only what was found goes back to the texts: per text, its places and values. A text is told by a hash of its words, so
ids may be null or repeat and texts need not be written to get a key; copies of a text get one answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidesift.functions.lookup import LiteralMap, small_map, small_set
from tidesift.functions.names import free
from tidesift.functions.once import compute_once

#: Bytes of a dictionary, with ``ENTRY_BYTES`` for each entry besides its texts, that may be broadcast.
MAX_BROADCAST_BYTES = 64 << 20
ENTRY_BYTES = 64
#: Entries for each 64-bit word of a Bloom filter, and most such words (16 MB). Beyond, more tokens pass; none is lost.
PER_BLOCK, MAX_BLOCKS = 4, 1 << 21
# Salts per average partition's worth of tokens.
SALTS_PER_PARTITION = 4

_CHUNK = 4096


def explode_tokens(df: DataFrame, tokens: str = "tokens", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per token: the kept columns, ``pos`` from 0, and ``token``."""
    # Catalyst drops empty arrays before it explodes a column: by a filter that would make the column again.
    once = compute_once(df.select(*keep, tokens), {tokens: F.col(tokens)})
    return once.select(*keep, F.posexplode(tokens).alias("pos", "token"))


def frequent_words(df: DataFrame, tokens: str, partitions: int) -> dict[str, int]:
    """Salts of the words that would fill a good part of a partition, counted over all texts.

    Shares add up to 1, so there are at most ``SALTS_PER_PARTITION * partitions`` such words.
    """
    counts = word_counts(df.select(tokens), tokens)
    total = counts.agg(F.sum("n").alias("total"))
    # The total is one row, and counts are summed before their shuffle.
    share = F.col("n") * SALTS_PER_PARTITION * partitions
    hot = counts.join(F.broadcast(total), share > F.col("total")).collect()
    return {r["word"]: -(-r["n"] * SALTS_PER_PARTITION * partitions // r["total"]) for r in hot}


def text_key(tokens: Column) -> Column:
    """128 bits that tell texts apart; tokens hold no 0x1f, which is white space."""
    return F.substring(F.unhex(F.sha2(F.array_join(tokens, "\x1f"), 256)), 1, 16)


def table_size(table: DataFrame) -> tuple[int, int]:
    """Rows of a dictionary, and about the bytes they take in memory."""
    own = [F.octet_length(f.name) if f.dataType.typeName() == "string" else F.lit(16) for f in table.schema.fields]
    texts = sum((F.coalesce(c, F.lit(0)) for c in own), F.lit(0))
    rows, size = table.agg(F.count("*"), F.sum(texts)).first()
    return rows, (size or 0) + ENTRY_BYTES * rows


class WordFilter:
    """A Bloom filter of a table's words, as one array that Spark computes once per query.

    A word sets four bits of one 64-bit block.
    """

    def __init__(self, table: DataFrame, word: str, rows: int):
        self.blocks = min(MAX_BLOCKS, max(1, -(-rows // PER_BLOCK)))
        set_ = table.select(self._block(F.col(word)).alias("block"), self._mask(F.col(word)).alias("mask"))
        whole = table.sparkSession.range(self.blocks).select(F.col("id").alias("block"))
        masks = set_.groupBy("block").agg(F.bit_or("mask").alias("mask"))
        filled = whole.join(masks, "block", "left").withColumn("mask", F.coalesce("mask", F.lit(0).cast("long")))
        values = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("block", c))), lambda s: s[c])
        chunks = filled.groupBy(F.floor(F.col("block") / _CHUNK).alias("chunk")).agg(values("mask").alias("masks"))
        chunks = chunks.withColumnRenamed("chunk", "block")
        self.bits = chunks.agg(F.flatten(values("masks")).alias("bits"))

    def _block(self, word: Column) -> Column:
        return F.pmod(F.xxhash64(word, F.lit("block")), F.lit(self.blocks)).cast("int")

    @staticmethod
    def _mask(word: Column) -> Column:
        h = F.xxhash64(word, F.lit("bits"))
        bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, at).bitwiseAND(F.lit(63).cast("long")).cast("int"))
        return bit(0).bitwiseOR(bit(6)).bitwiseOR(bit(12)).bitwiseOR(bit(18))

    def may_hold(self, word: Column) -> Column:
        mask = self._mask(word)
        return F.get(self.bits.scalar(), self._block(word)).bitwiseAND(mask) == mask


def hits(texts: DataFrame, tokens: str, table: DataFrame, word: str) -> DataFrame:
    """``text, pos, found``: the places of the texts' tokens that the table holds, ``found`` being its other columns.

    ``table`` has unique words. A text that occurs several times may give a place several times.
    """
    rows, size = table_size(table)
    values = [c for c in table.columns if c != word]
    right = table.select(F.col(word).alias("token"), F.struct(*values).alias("found") if values else F.lit(True).alias("found"))
    left = compute_once(texts.select(F.col(tokens).alias("tokens")), {"tokens": F.col("tokens")})
    # The key is made below the generator, once a text; beside it, it would be made for each token.
    left = left.withColumn("text", text_key(F.col("tokens"))).select("text", F.posexplode("tokens").alias("pos", "token"))
    if size <= MAX_BROADCAST_BYTES:
        return left.join(F.broadcast(right), "token").select("text", "pos", "found")
    left = left.where(WordFilter(right, "token", rows).may_hold(F.col("token")))
    by, conf = ["token"], texts.sparkSession.conf.get
    if conf("spark.sql.adaptive.enabled", "true") == "false":
        n = LiteralMap(frequent_words(texts, tokens, int(conf("spark.sql.shuffle.partitions"))), "int")
        of_word = F.coalesce(n.get(F.col("token")), F.lit(1))
        left = left.withColumn("salt", F.pmod(F.xxhash64("text", "pos"), of_word).cast("int"))
        right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), of_word - 1)))
        by.append("salt")
    # Spark guesses the size of the tokens from that of the files, and might broadcast them.
    return left.join(right.hint("merge"), by).select("text", "pos", "found")


def back_to_texts(df: DataFrame, tokens: str, found: DataFrame, name: str) -> DataFrame:
    """The rows with a column of what was found in their text: sorted ``(pos, found)``, null where there is nothing."""
    key, other = free(df, "__text", "__other")
    grouped = found.groupBy(F.col("text").alias(other)).agg(F.sort_array(F.collect_set(F.struct("pos", "found"))).alias(name))
    keyed = compute_once(df, {tokens: F.col(tokens)}).withColumn(key, text_key(F.col(tokens)))
    return keyed.join(grouped, F.col(key) == F.col(other), "left").select(*df.columns, name)


def _replace(df: DataFrame, tokens: str, found: str, value: str | None) -> DataFrame:
    """Puts the found ``value`` in the place of its token, or without one drops the tokens found."""
    put = (lambda f: f["found"][value]) if value else (lambda f: F.lit(None).cast("string"))
    own = F.transform(tokens, lambda x, i: F.struct(i.alias("pos"), F.lit(0).alias("k"), x.alias("token")))
    new = F.transform(found, lambda f: F.struct(f["pos"].alias("pos"), F.lit(1).alias("k"), put(f).alias("token")))
    (both,) = free(df, "__both")
    merged = F.when(F.col(found).isNull(), own).otherwise(F.sort_array(F.concat(own, new)))
    out = compute_once(df, {both: merged})
    last = lambda x, i: F.coalesce(F.get(both, i + 1)["pos"] != x["pos"], F.lit(True))
    kept = F.filter(both, last if value else lambda x, i: (x["k"] == 0) & last(x, i))
    return out.withColumn(tokens, F.transform(kept, lambda x: x["token"])).drop(both, found)


def map_tokens(df: DataFrame, tokens: str, table: DataFrame, word: str, value: str, id_col: str = "doc_id") -> DataFrame:
    """Replace each token by its value in the table, if it has one; of several, by the greatest."""
    table = table.groupBy(word).agg(F.max(value).alias(value))
    mapping = small_map(table, word, value)
    if mapping is not None:
        return df.withColumn(tokens, F.transform(tokens, lambda x: F.coalesce(mapping.get(x), x)))
    return map_tokens_by_join(df, tokens, table, word, value, id_col)


def map_tokens_by_join(
    df: DataFrame, tokens: str, table: DataFrame, word: str, value: str, id_col: str = "doc_id"
) -> DataFrame:
    """``map_tokens`` for a table of any size, whatever the ids."""
    (found,) = free(df, "__found")
    known = table.select(word, value).where(F.col(word).isNotNull() & F.col(value).isNotNull())
    return _replace(back_to_texts(df, tokens, hits(df, tokens, known, word), found), tokens, found, value)


def drop_tokens(
    df: DataFrame, tokens: str, table: DataFrame, word: str = "word", min_len: int = 1, id_col: str = "doc_id"
) -> DataFrame:
    """Drop the table's words and words shorter than ``min_len``."""
    words = small_set(table, word)
    if words is not None:
        keep = lambda x: ~words.contains(x) & (F.char_length(x) >= min_len)
        return df.withColumn(tokens, F.filter(tokens, keep))
    return drop_tokens_by_join(df, tokens, table, word, min_len, id_col)


def drop_tokens_by_join(
    df: DataFrame, tokens: str, table: DataFrame, word: str = "word", min_len: int = 1, id_col: str = "doc_id"
) -> DataFrame:
    """``drop_tokens`` for a table of any size, whatever the ids."""
    (found,) = free(df, "__found")
    df = df.withColumn(tokens, F.filter(tokens, lambda x: F.char_length(x) >= min_len))
    known = table.select(word).where(F.col(word).isNotNull()).distinct()
    return _replace(back_to_texts(df, tokens, hits(df, tokens, known, word), found), tokens, found, None)


def word_counts(df: DataFrame, tokens: Column | str, by: tuple[str, ...] = ()) -> DataFrame:
    """How often each word occurs, in all texts or per group; counted before the shuffle."""
    once = compute_once(df, {"_words": F.col(tokens) if isinstance(tokens, str) else tokens})
    words = once.select(*by, F.explode("_words").alias("word"))
    return words.groupBy(*by, "word").agg(F.count("*").alias("n"))
