"""Readers and writers for the files the engine takes in and gives out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidesift.functions.text import SPACE, squeeze_spaces
from tidesift.sources import wordlists

# Columns a table of raw texts must have.
REQUIRED_COLUMNS = ["id_str", "created_at", "full_text", "lang"]

_OUTER = f"^[{SPACE}]+|[{SPACE}]+$"

CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"'}


class MissingColumns(ValueError):
    """The input lacks a column the operator needs."""


def read_table(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Read a Parquet table, split as its files and row groups allow; no row is moved.

    ``partitions`` deals the columns that are used out to so many tasks, round robin: for a table that is small but
    dear to work on and lies in fewer row groups than there are cores. It is never guessed, and changes no result.
    """
    rows = spark.read.parquet(path)
    return rows if partitions is None else rows.repartition(partitions)


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep the named columns; fail before any job if one is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns {missing}; the input has {df.columns}")
    return df.select(*columns)


#: A file's rows by place: ``NUMBER`` counts the rows of all files of a reading from 0, files in the order of their names.
NUMBER = "row_number"


def _lines(spark: SparkSession, path: str, ends: str | None = None) -> DataFrame:
    """Lines with their file, the byte range they were read in, and their place in it.

    Without ``ends`` they end as Spark's reader has it: at line feeds, carriage returns and both together.
    """
    read = (spark.read.option("lineSep", ends) if ends else spark.read).text(path)
    return read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    )


def _ranges(lines: DataFrame, *sums: Column) -> DataFrame:
    """One row per byte range with sums over its lines: few and narrow, whatever the files hold."""
    return lines.groupBy("file", "block").agg(*sums)


def _before(c: str) -> Column:
    """What all ranges before have of a column; a window over the ranges alone."""
    earlier = Window.partitionBy().orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(c).over(earlier), F.lit(0))


def number_lines(lines: DataFrame, keep: Column) -> DataFrame:
    """``NUMBER, line`` of the lines that ``keep`` holds for, in two passes.

    The first counts the lines to keep in each byte range, the second numbers them inside their range and adds what the
    ranges before have. No more than one range is ever sorted by a task.
    """
    kept = lines.where(keep)
    starts = _ranges(kept, F.count("*").alias("n")).select("file", "block", _before("n").alias("start"))
    place = F.row_number().over(Window.partitionBy("file", "block").orderBy("at")) - 1
    numbered = kept.withColumn("place", place).join(starts, ["file", "block"])
    return numbered.select((F.col("start") + F.col("place")).alias(NUMBER), "line")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``NUMBER, record``: the records of CSV files without their headers, each file read in as many tasks as it has ranges.

    A line feed is inside a record where an odd number of quotes lies before it in the file, which is known from the
    quotes of all ranges before and of the lines before in its own. A record belongs to the range it starts in; the
    lines of one that goes on meet by the record's number. Quotes stand around whole fields and are doubled inside.
    """
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    lines = _lines(spark, path, "\n").withColumn("quotes", quotes.cast("long")).withColumn("line", F.regexp_replace("line", "\r$", ""))
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    open_ = F.coalesce(F.sum("q").over(in_file), F.lit(0)) % 2
    parity = _ranges(lines, F.sum("quotes").alias("q")).select("file", "block", open_.alias("open"), ((open_ + F.col("q")) % 2).alias("goes_on"))
    here = Window.partitionBy("file", "block").orderBy("at")
    before = F.sum("quotes").over(here) - F.col("quotes")
    known = lines.join(parity, ["file", "block"]).withColumn("starts", (((F.col("open") + before) % 2) == 0).cast("long"))
    known = known.where((F.col("starts") == 0) | (F.length("line") > 0))
    ranges = _ranges(known, F.sum("starts").alias("n"))
    first = F.coalesce(F.sum("n").over(in_file), F.lit(0))
    # Records of all files but their headers, in the order of the files.
    headers = F.dense_rank().over(Window.partitionBy().orderBy("file"))
    ranges = ranges.select("file", "block", "n", first.alias("first"), (_before("n") - first - headers).alias("shift"))
    numbered = known.withColumn("nth", F.sum("starts").over(here)).join(ranges, ["file", "block"])
    numbered = numbered.withColumn("record", F.col("nth") + F.col("first")).where(F.col("record") > 1)
    numbered = numbered.withColumn(NUMBER, F.col("record") + F.col("shift") - 1)
    own = Window.partitionBy("file", "block", "nth").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    records = numbered.withColumn("body", F.array_join(F.collect_list("line").over(own), "\n")).where("starts = 1")
    cut = (F.col("nth") == F.col("n")) & (F.col("goes_on") == 1)
    tails = numbered.where("nth = 0").groupBy(NUMBER).agg(F.sort_array(F.collect_list(F.struct("block", "at", "line"))).alias("tail"))
    tail = F.array_join(F.transform("tail", lambda p: p["line"]), "\n")
    stitched = records.where(cut).join(tails, NUMBER, "left").select(NUMBER, F.concat_ws("\n", "body", tail).alias("record"))
    return records.where(~cut).select(NUMBER, F.col("body").alias("record")).unionByName(stitched)


def read_csv(spark: SparkSession, path: str, number: str | None = None) -> DataFrame:
    """CSV files with a header as text columns; ``number`` names a column for each row's place in the input.

    One large file is read by many tasks, though fields may hold line feeds. Empty lines are no rows.
    """
    names = spark.read.options(**CSV_OPTIONS).option("inferSchema", False).csv(path).columns
    fields = F.from_csv("record", ", ".join(f"f{i} string" for i in range(len(names))), {"escape": '"'})
    rows = csv_records(spark, path).select(NUMBER, fields.alias("fields"))
    columns = [F.col(f"fields.f{i}").alias(name) for i, name in enumerate(names)]
    return rows.select(*columns, *([F.col(NUMBER).alias(number)] if number else []))


def scan_required_columns(
    spark: SparkSession, path: str, columns: list[str] = REQUIRED_COLUMNS, number: str | None = None
) -> DataFrame:
    """Read a CSV of raw texts as strings and keep its required columns, and each row's place in the input if it is named.

    Ids stay text, so leading zeros survive.
    """
    return require_columns(read_csv(spark, path, number), [*columns, number] if number else columns)


def scan_csv_text_column(
    spark: SparkSession, path: str, column: str = "text", null_text: str | None = "nan", number: str | None = None
) -> DataFrame:
    """One named column of a CSV as ``text``; a null becomes ``null_text`` unless that is None."""
    df = require_columns(read_csv(spark, path, number), [column, number] if number else [column])
    return df.select(null_as_text(F.col(column), null_text).alias("text"), *([number] if number else []))


def null_as_text(c: Column, null_text: str | None = "nan") -> Column:
    c = c.cast("string")
    return c if null_text is None else F.coalesce(c, F.lit(null_text))


def scan_text_lines(spark: SparkSession, path: str, number: str | None = None) -> DataFrame:
    """One text per line, without its outer blanks; blank lines are skipped. ``number`` names a column for each text's place."""
    if number is None:
        return keep_text_lines(spark.read.text(path).select(F.col("value").alias("text")))
    lines = _lines(spark, path).withColumn("line", F.regexp_replace("line", F.lit(_OUTER), F.lit("")))
    return number_lines(lines, F.length("line") > 0).select(F.col("line").alias("text"), F.col(NUMBER).alias(number))


def keep_text_lines(lines: DataFrame) -> DataFrame:
    text = F.regexp_replace("text", F.lit(_OUTER), F.lit(""))
    return lines.select(text.alias("text")).filter(F.length("text") > 0)


def _numbered(df: DataFrame) -> DataFrame:
    """Adds ``line``, which sorts by place in the file."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", place.alias("line"))


def last_wins(df: DataFrame, key: str, value: str, line: str = "line") -> DataFrame:
    """One row per key, with the value of its last line; copies meet before the shuffle."""
    return df.groupBy(key).agg(F.max_by(value, line).alias(value))


def clean_word_map(rows: DataFrame) -> DataFrame:
    """``(line, word, formal)`` rows as a map: the last line of a word wins."""
    return last_wins(rows.filter(F.col("word").isNotNull()), "word", "formal")


def clean_lexicon(rows: DataFrame) -> DataFrame:
    """``(line, word, weight)`` text rows as a lexicon.

    Words are trimmed and lowered, rows without a numeric weight go, weights are
    cut to whole numbers, and the last line of a word wins.
    """
    weight = F.col("weight").try_cast("double")
    typed = rows.select(
        "line",
        F.lower(F.regexp_replace(F.coalesce("word", F.lit("nan")), F.lit(f"^[{SPACE}]+|[{SPACE}]+$"), F.lit(""))).alias("word"),
        weight.alias("weight"),
    ).filter(F.col("weight").isNotNull() & ~F.isnan("weight"))
    return last_wins(typed.withColumn("weight", F.col("weight").cast("int")), "word", "weight")


def load_word_map(spark: SparkSession, path: str, fallback: dict[str, str] | None = None) -> DataFrame:
    """Read a CSV of spellings: the named columns if it has them, else its first two.

    A path that cannot be read gives the fallback table.
    """
    try:
        df = _numbered(spark.read.options(**CSV_OPTIONS).csv(path))
    except AnalysisException:
        return wordlists.map_frame(spark, wordlists.WORD_MAP if fallback is None else fallback)
    by_name = {c.lower(): c for c in df.columns if c != "line"}
    names = (
        [by_name["tidak_baku"], by_name["kata_baku"]]
        if {"tidak_baku", "kata_baku"} <= set(by_name)
        else df.columns[:2]
    )
    return clean_word_map(df.select("line", F.col(names[0]).alias("word"), F.col(names[1]).alias("formal")))


def load_lexicon_tsv(spark: SparkSession, path: str, fallback: dict[str, int]) -> DataFrame:
    """Read a headerless ``word <tab> weight`` file; unreadable gives the fallback."""
    try:
        df = _numbered(spark.read.schema("word string, weight string").csv(path, sep="\t"))
        return clean_lexicon(df)
    except AnalysisException:
        return wordlists.lexicon_frame(spark, fallback)


def write_predictions(scored: DataFrame, path: str, number: str | None = None) -> None:
    """Batch scores as CSV files with a header, one per partition.

    With the column ``number``, which is not written, rows lie in its order: within files, and from one file's name
    to the next.
    """
    if number:
        scored = scored.orderBy(number).drop(number)
    scored.write.option("header", True).option("escape", '"').csv(path)


def write_report(table: DataFrame, path: str, format: str = "csv") -> None:
    """A report table (comparison, importances, metrics) as CSV or JSON."""
    writer = table.write.mode("overwrite")
    writer.option("header", True).csv(path) if format == "csv" else writer.json(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A short report as one text file."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def result_json(scored: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Each prediction record as one JSON text."""
    fields = [F.col(c) for c in scored.columns if c != id_col]
    return scored.select(id_col, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("json"))
