import random

import pytest
from pyspark.sql import functions as F

from tidesift.operators import explore
from tidesift.operators.preprocess import default_tables
from tidesift.operators.scoring import score_lexicon
from tidesift.sources import files, wordlists


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_required_columns(spark, tmp_path):
    path = write(tmp_path, "t.csv", 'id_str,extra,created_at,full_text,lang\n007,x,now,"two\nlines, ""quoted""",in\n8,y,,,en\n')
    got = [tuple(r) for r in files.scan_required_columns(spark, path).collect()]
    assert got == [("007", "now", 'two\nlines, "quoted"', "in"), ("8", None, None, "en")]
    with pytest.raises(files.MissingColumns):
        files.scan_required_columns(spark, write(tmp_path, "u.csv", "id_str,full_text\n1,a\n"))


def test_word_map_by_name_or_place_last_wins(spark, tmp_path):
    named = write(tmp_path, "a.csv", "no,kata_baku,tidak_baku\n1,tidak,gak\n2,enggak,gak\n3,sudah,udah\n")
    placed = write(tmp_path, "b.csv", "slang,formal\ngak,tidak\nudah,sudah\ngak,enggak\n")
    for path in (named, placed):
        assert {r.word: r.formal for r in files.load_word_map(spark, path).collect()} == {"gak": "enggak", "udah": "sudah"}


def test_lexicon_file(spark, tmp_path):
    path = write(tmp_path, "l.tsv", "word\tweight\n Bagus \t3\njelek\t-2.7\nbad\tabc\nbagus\t4\nluar biasa\t5\n")
    got = {r.word: r.weight for r in files.load_lexicon_tsv(spark, path, {}).collect()}
    assert got == {"bagus": 4, "jelek": -2, "luar biasa": 5}


def test_unreadable_files_give_fallbacks(spark, tmp_path):
    missing = str(tmp_path / "missing")
    assert files.load_word_map(spark, missing).count() == len(wordlists.WORD_MAP) == 24
    assert files.load_lexicon_tsv(spark, missing, wordlists.POSITIVE).count() == 16
    assert (len(wordlists.NEGATIVE), len(wordlists.STOPWORDS), len(wordlists.STRONG_WORDS)) == (14, 52, 35)


def test_text_lines(spark, tmp_path):
    path = write(tmp_path, "x.txt", " one \n\n\t \ntwo words\n")
    assert sorted(r.text for r in files.scan_text_lines(spark, path).collect()) == ["one", "two words"]


def test_csv_text_column(spark, tmp_path):
    path = write(tmp_path, "c.csv", "id,text\n1,hi\n2,\n")
    assert sorted(r.text for r in files.scan_csv_text_column(spark, path).collect()) == ["hi", "nan"]
    assert files.scan_csv_text_column(spark, path, null_text=None).filter("text is null").count() == 1
    with pytest.raises(files.MissingColumns):
        files.scan_csv_text_column(spark, path, "body")


@pytest.mark.parametrize("zone", ["UTC", "Asia/Jakarta", "America/New_York"])
def test_timestamps_do_not_follow_the_session(spark, rows, zone):
    texts = ["Wed Oct 10 20:19:24 +0000 2018", "2018-10-10T20:19:24Z", "2018-10-11T03:19:24+07:00", "2018-10-10 20:19:24", "bad", None]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = rows([(t,) for t in texts], "created_at string")
        got = [str(r.created_at) for r in explore.parse_timestamps(df).collect()]
        assert got == ["2018-10-10 20:19:24"] * 4
        assert tuple(explore.time_coverage(df).first()) == (4, 6)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("split", ["10b", "64b", "1m"])
def test_quoted_records_over_byte_ranges(spark, rows, tmp_path, split):
    """Files cut anywhere, also inside quotes, quoted line feeds and doubled quotes, read as the whole-file reader does."""
    rng = random.Random(3)
    bits = ["a", ",", "\n", '"', "é❶", " ", "", "\n\n", '""', ",\n\"", "x" * 70, "#"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 9))) for _ in range(160)] + ["tail\n" * 40, None, "", "plain"]
    df = rows([(f"{i:04d}", t, None if i % 3 else "z") for i, t in enumerate(texts)], "id string, text string, other string")
    path = str(tmp_path / "in")
    df.coalesce(1).sortWithinPartitions("id").repartition(3, "other").sortWithinPartitions("id").write.options(header=True, escape='"', quoteAll=True).csv(path)
    whole = spark.read.options(**files.CSV_OPTIONS).csv(path).withColumn("file", F.col("_metadata.file_path"))
    want = [tuple(r)[:3] for r in sorted(whole.collect(), key=lambda r: (r.file, r.id))]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = files.read_csv(spark, path, "n")
        assert got.columns == ["id", "text", "other", "n"]
        found = sorted(map(tuple, got.collect()), key=lambda r: r[3])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r[3] for r in found] == list(range(len(texts))) and [r[:3] for r in found] == want


def test_csv_without_quotes_and_with_other_line_ends(spark, tmp_path):
    path = write(tmp_path, "w.csv", 'id,text\r\n1,one\r\n\r\n2,"two\r\nlines"\r\n3\r\n4,a,b\r\n')
    assert [tuple(r) for r in files.read_csv(spark, path, "n").orderBy("n").collect()] == [("1", "one", 0), ("2", "two\nlines", 1), ("3", None, 2), ("4", "a", 3)]
    assert files.read_csv(spark, write(tmp_path, "h.csv", "id,text\n")).collect() == []


def test_lines_to_scores_in_input_order(spark, tmp_path):
    lines = [rng_text for i in range(300) for rng_text in (f" kata{i} bagus ", "", f"jelek {i}", "\t")]
    source, out = write(tmp_path, "l.txt", "\n".join(lines)), str(tmp_path / "out")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        texts = files.scan_text_lines(spark, source, number="doc_id")
        assert texts.rdd.getNumPartitions() >= 1
        lexicon = wordlists.lexicon_frame(spark, wordlists.POSITIVE | wordlists.NEGATIVE)
        scored = score_lexicon(texts, lexicon, default_tables(spark))
        files.write_predictions(scored, out, number="doc_id")
        order = [r.doc_id for r in scored.orderBy("doc_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert order == list(range(600))
    read = spark.read.option("header", True).csv(out).withColumn("file", F.col("_metadata.file_name")).withColumn("at", F.monotonically_increasing_id())
    got = [r.text_original for r in sorted(read.collect(), key=lambda r: (r.file, r.at))]
    assert got == [x.strip() for x in lines if x.strip()] and "doc_id" not in read.columns
