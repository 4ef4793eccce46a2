"""Cleaning and preprocessing against Python's own string rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidesift.functions import text as tx
from tidesift.operators import joins, preprocess as pp
from tidesift.operators.langid import ngram_language_id, train_profiles, word_grams
from tidesift.operators.preprocess import TextTables, default_tables
from tidesift.operators.stems import INDONESIAN, AffixRules, build_stems, stem_tokens
from tidesift.plans.catalog import texts as catalog
from tidesift.sources import wordlists

EDGE = [
    None, "", "   ", "http://only.url/x", "HTTP://UPPER.case", "xhttpfoo bar", "#a_b", "##x", "@user_1 hi", "S2", "4.000",
    "a_b__c", "❶ ² ½", "١٢٣ x", "été", "a b c", "\U0001f600\U0001f680 ok ✂",
    "www.x.y z", "line\nbreak\tand\x0btab\x1cfs", "tail #", "​zero", "İstanbul",
]
EMOJI = re.compile("[" + "".join(f"{chr(int(a, 16))}-{chr(int(b, 16))}" for a, b in tx.EMOJI_RANGES) + "]+")
# The rules in Python's dialect, whose classes are Unicode-aware by themselves.
PYTHON_RULES = [
    (re.compile(r"http\S+|www\S+"), " "), (re.compile(r"@\w+"), " "), (re.compile(r"#(\w+)"), r"\1"), (EMOJI, " "),
    (re.compile(r"\d+"), " "), (re.compile(r"[^\w\s]"), " "), (re.compile(r"_+"), " "), (re.compile(r"\s+"), " "),
]


def python_filter(text):
    text = text or ""
    for pattern, by in PYTHON_RULES:
        text = pattern.sub(by, text)
    return text.strip()


def random_texts(n, seed):
    rng = random.Random(seed)
    alphabet = list("abS2 _#@.,!\n\t") + ["http", "www", "é", "❶", "²", "٣", "́", " ", "\U0001f600", "✂", "中", "ᾈ", "Ⅰ", "ª", "ำ"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 25))) for _ in range(n)]


def test_filter_text_equals_python(rows):
    texts = EDGE + random_texts(3000, 7)
    df = rows([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r.id: r.t for r in df.select("id", tx.filter_text(F.col("text")).alias("t")).collect()}
    assert {i: got[i] for i, t in enumerate(texts) if got[i] != python_filter(t)} == {}


def test_tokens_and_blanks_equal_python(rows):
    texts = [t for t in EDGE if t is not None] + random_texts(1000, 8)
    df = rows([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r.id: (r.tokens, r.blank) for r in df.select("id", tx.tokenize(F.col("text")).alias("tokens"), tx.is_blank(F.col("text")).alias("blank")).collect()}
    assert all(got[i] == (t.split(), not t.strip()) for i, t in enumerate(texts))


def test_upper_case_url_survives(rows):
    df = rows([("HTTP://X.Y",)], "text string")
    assert df.select(tx.case_fold(tx.filter_text(F.col("text")))).first()[0] == "http x y"


def test_preprocess_indonesian(spark, rows):
    df = rows([(1, "Aku GAK suka ini http://x.co @a #Bagus_sekali 2x \U0001f600"), (2, None), (3, "ya")], "doc_id int, text string")
    got = {r.doc_id: r for r in pp.preprocess(df, default_tables(spark)).collect()}
    assert got[1].light_text == "aku tidak suka ini bagus sekali x"
    assert got[1].processed_text == "suka bagus sekali"
    assert (got[2].light_text, got[2].processed_text) == ("", "")
    assert (got[3].light_text, got[3].processed_text) == ("ya", "")


def test_undecided_texts_stay_without_profiles(spark, rows):
    text = "beasiswa luar negeri membantu mahasiswa"
    (got,) = pp.preprocess(rows([(1, text)], "doc_id int, text string"), default_tables(spark)).collect()
    assert got.light_text == text and got.processed_text


def test_language_filter(spark, rows):
    tables = default_tables(spark)
    texts = [("id", "saya makan nasi goreng di warung"), ("id", "kami pergi belajar bersama teman"), ("en", "the weather was very nice today"), ("en", "they went through the whole thing")] * 3
    tables.profiles = train_profiles(rows(texts, "lang string, text string"))
    df = rows([(1, "makan nasi bersama teman"), (2, "the weather through today"), (3, "nice weather"), (4, "yg the weather ini nice")], "doc_id int, text string")
    got = {r.doc_id: r.light_text for r in pp.preprocess_light(df, tables).collect()}
    assert got[1] and got[2] == "" and got[3] == "nice weather" and got[4]


def test_word_grams(rows):
    df = rows([("a",), ("abc",)], "w string")
    assert [r[0] for r in df.select(word_grams(F.col("w"))).collect()] == [[" a "], [" ab", "abc", "bc "]]


def test_language_of_blank_text_is_unknown(rows):
    profiles = train_profiles(rows([("x", "aaa bbb"), ("y", "ccc ddd")], "lang string, text string"))
    df = rows([(1, "aaa"), (2, "!!"), (3, "ddd ccc")], "doc_id int, text string")
    assert {r.doc_id: r.lang_pred for r in ngram_language_id(df, profiles).collect()} == {1: "x", 3: "y"}


def test_large_profiles_give_the_same(rows, monkeypatch):
    from tidesift.operators import langid

    profiles = train_profiles(rows([("x", "aaa bbb abab"), ("y", "ccc ddd cdcd")], "lang string, text string"))
    df = rows([(i, t) for i, t in enumerate(["aaa cdc ccc", "abab bbb", "dddd aaa"])], "doc_id int, text string")
    small = sorted(map(tuple, ngram_language_id(df, profiles).collect()))
    monkeypatch.setattr(langid, "MAX_BROADCAST_SCORES", 2)
    assert sorted(map(tuple, ngram_language_id(df, profiles).collect())) == small


@pytest.fixture
def token_rows(rows):
    rng = random.Random(3)
    words = ["a", "b", "cc", "dd", "x", "hot"]
    data = [(i, rng.choices(words, weights=[1, 1, 1, 1, 1, 6], k=rng.randint(0, 30))) for i in range(200)] + [(999, [])]
    return data, rows(data, "doc_id int, tokens array<string>")


def test_joined_lookup_equals_constant_lookup(rows, token_rows):
    data, df = token_rows
    table = rows([("a", "A"), ("hot", "h"), ("cc", "c")], "word string, formal string")
    want = sorted((i, [{"a": "A", "hot": "h", "cc": "c"}.get(t, t) for t in ts]) for i, ts in data)
    for f in (joins.map_tokens, joins.map_tokens_by_join):
        assert sorted(map(tuple, f(df, "tokens", table, "word", "formal").collect())) == want
    want = sorted((i, [t for t in ts if t not in ("a", "hot") and len(t) >= 2]) for i, ts in data)
    stop = rows([("a",), ("hot",), ("a",)], "word string")
    for f in (joins.drop_tokens, joins.drop_tokens_by_join):
        assert sorted(map(tuple, f(df, "tokens", stop, "word", 2).collect())) == want


def test_frequent_words_get_salts(token_rows):
    salts = joins.frequent_words(token_rows[1], "tokens", 8)
    assert salts["hot"] > max(n for w, n in salts.items() if w != "hot")


def test_long_dictionary_and_set(rows):
    from tidesift.functions.lookup import LiteralMap, LiteralSet, small_map

    entries = {f"w{i}": i for i in range(3000)} | {"é\"'\\": 7}
    df = rows([(w,) for w in [*entries, "none"]], "w string")
    m, s = LiteralMap(entries, "int"), LiteralSet(entries)
    got = {r.w: (r.v, r.s) for r in df.select("w", m.get(F.col("w")).alias("v"), s.contains(F.col("w")).alias("s")).collect()}
    assert got == {w: (v, True) for w, v in entries.items()} | {"none": (None, False)}
    assert small_map(df.withColumn("v", F.lit(1)), "w", "v", limit=10) is None


def test_indonesian_stems(rows):
    words = ["membantu", "bantuan", "dibantu", "menulis", "penulisan", "menyapu", "mengambil", "bermain", "terbaik", "bukunya", "rumah", "zzz"]
    roots = ["bantu", "tulis", "sapu", "ambil", "main", "baik", "buku", "rumah"]
    got = build_stems(rows([(w,) for w in words], "word string"), rows([(w,) for w in roots], "word string"), INDONESIAN)
    assert {r.word: r.stem for r in got.collect()} == {
        "membantu": "bantu", "bantuan": "bantu", "dibantu": "bantu", "menulis": "tulis", "penulisan": "tulis",
        "menyapu": "sapu", "mengambil": "ambil", "bermain": "main", "terbaik": "baik", "bukunya": "buku",
    }


def test_given_stems_go_first(rows):
    got = build_stems(rows([("main",), ("bermain",)], "word string"), rows([("main",)], "word string"), INDONESIAN,
                      rows([("bermain", "permainan"), ("absent", "x")], "word string, stem string"))
    assert [tuple(r) for r in got.collect()] == [("bermain", "permainan")]


def test_formal_words_of_two_words_are_split(spark, rows):
    tables = TextTables(rows([("tq", "terima kasih")], "word string, formal string"), wordlists.words_frame(spark, ["kasih"]))
    got = pp.preprocess_for_scoring(rows([(1, "tq ya kak")], "doc_id int, text string"), tables).first()
    assert (got.light_text, got.processed_text) == ("terima kasih ya kak", "terima ya kak")


def test_joined_lookup_keeps_rows_with_null_and_repeated_ids(rows):
    data = [(None, ["a", "x"]), (None, ["hot"]), (1, ["b", "a"]), (1, ["x"]), (1, []), (2, None)]
    table, stop = rows([("a", "A"), ("hot", "h")], "word string, formal string"), rows([("a",), ("hot",)], "word string")
    as_list = lambda df: sorted(map(repr, map(tuple, df.collect())))
    for name in ("tokens", "_tokens"):
        df = rows(data, f"doc_id int, {name} array<string>")
        assert as_list(joins.map_tokens_by_join(df, name, table, "word", "formal")) == as_list(joins.map_tokens(df, name, table, "word", "formal"))
        assert as_list(joins.drop_tokens_by_join(df, name, stop, "word")) == as_list(joins.drop_tokens(df, name, stop, "word"))


@pytest.mark.parametrize("most", [joins.MAX_BROADCAST_BYTES, 0])
def test_dictionaries_over_the_broadcast_bound_give_the_same(spark, rows, monkeypatch, most):
    """Behind a Bloom filter, with and without salts; copies of a text, null and empty ones among them."""
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", most)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    data = [(i % 30, [rng.choice(words) for _ in range(rng.randint(0, 40))]) for i in range(120)] + [(None, None), (1, []), (2, ["w1"]), (2, ["w1"])]
    entries = {w: w.upper() for w in words[::3]}
    table = rows([*entries.items(), (None, "x"), ("w2", None)], "word string, formal string")
    df = rows(data, "doc_id int, words array<string>")
    as_list = lambda x: sorted(map(repr, map(tuple, x.collect())))
    want = sorted(repr((i, t if t is None else [entries.get(w, w) for w in t])) for i, t in data)
    dropped = sorted(repr((i, t if t is None else [w for w in t if w not in entries and len(w) >= 3])) for i, t in data)
    for adaptive in ("true", "false"):  # without it, frequent words get salts
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            assert as_list(joins.map_tokens_by_join(df, "words", table, "word", "formal")) == want
            stop = table.where("formal IS NOT NULL")
            assert as_list(joins.drop_tokens_by_join(df, "words", stop, "word", 3)) == dropped
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")


def test_word_filter_passes_all_its_words_and_few_others(spark):
    words = spark.range(3000).select(F.concat(F.lit("w"), "id").alias("word"))
    other = spark.range(3000).select(F.concat(F.lit("v"), "id").alias("word"))
    for rows_, least in ((3000, 2900), (1, 0)):
        known = joins.WordFilter(words, "word", rows_)
        assert words.where(known.may_hold(F.col("word"))).count() == 3000
        assert other.where(~known.may_hold(F.col("word"))).count() >= least


def test_operators_leave_columns_of_any_name(spark, rows):
    names = ["__tokens", "__light", "__found", "__text", "_tokens", "_light", "_keep", "_clean", "__row"]
    df = rows([(1, "aku gak suka ini", *names)], f"doc_id int, text string, {', '.join(n + ' string' for n in names)}")
    tables = default_tables(spark)
    tables.profiles = train_profiles(rows([("id", "saya makan nasi"), ("en", "the weather")], "lang string, text string"))
    got = pp.preprocess(df, tables).first()
    assert [got[n] for n in names] == names and got.light_text == "aku tidak suka ini"


def test_default_tables_stem_and_detect(spark, rows):
    """The embedded roots and rules stem; profiles come from texts that state their language."""
    known = [("id", "saya makan nasi goreng di warung bersama teman"), ("id", "kami pergi belajar di sekolah"),
             ("en", "the weather was very nice today"), ("en", "they went through the whole thing"), (None, "?")] * 3
    tables = default_tables(spark, rows(known, "lang string, text string"))
    texts = [(1, "panitia membantu kekecewaan pendaftaran beasiswanya"), (None, "weather whole through thing"), (None, "makan nasi bersama teman")]
    got = {r.text: r.processed_text for r in pp.preprocess(rows(texts, "doc_id int, text string"), tables).collect()}
    assert got[texts[0][1]].split()[1:] == ["bantu", "kecewa", "daftar", "beasiswanya"]
    assert got[texts[1][1]] == "" and got[texts[2][1]] == "makan nasi bersama teman"
    assert default_tables(spark, rows([("id", "saya")], "lang string, text string")).profiles is None


def test_order_of_affixes_around_a_root(rows):
    """Prefixes go first in such words, and a suffix that its prefix cannot have belongs to the root."""
    roots = rows([(w,) for w in ["beri", "ber", "sekolah", "seko", "tandai", "tanda", "kirim", "dian"]], "word string")
    words = rows([(w,) for w in ["diberi", "sekolah", "menandai", "dikirimi", "didian"]], "word string")
    got = {r.word: r.stem for r in build_stems(words, roots, INDONESIAN).collect()}
    assert got == {"diberi": "beri", "menandai": "tandai", "dikirimi": "kirim", "didian": "dian"}


def test_language_of_rows_with_null_and_repeated_ids(rows):
    profiles = train_profiles(rows([("x", "aaa bbb"), ("y", "ccc ddd")], "lang string, text string"))
    df = rows([(None, "aaa"), (None, "ccc ccc"), (1, "ddd ccc"), (1, "aaa"), (1, "aaa"), (2, None)], "doc_id int, text string")
    got = ngram_language_id(df, profiles).collect()
    assert sorted(str((r.doc_id, r.lang_pred)) for r in got) == sorted(str(x) for x in [(None, "x"), (None, "y"), (1, "y"), (1, "x"), (1, "x")])
    assert len({r.score for r in got if (r.doc_id, r.lang_pred) == (1, "x")}) == 1


def test_stemming_makes_its_words_once(spark, rows):
    """What comes before the stems, such as a filter by language, is not done again to count, look up and put back words."""
    df = rows([(1, "UNDOING it"), (1, None), (None, "undoing")], "doc_id long, text string")
    df = df.withColumn("tokens", F.split(F.lower(F.coalesce("text", F.lit(""))), " ")).withColumn("nothing", F.lit(None))
    out = stem_tokens(df, "tokens", rows([("do",)], "word string"), AffixRules(["(ing)"], [("(un)", "")], 1))
    assert out.columns == df.columns and out.schema["nothing"].dataType.typeName() == "void"
    assert "lower(" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.doc_id or 0, r.text or "", r.tokens) for r in out.collect())
    assert got == [(0, "undoing", ["do"]), (1, "", [""]), (1, "UNDOING it", ["do", "it"])]


def test_large_map_cleans_texts_once(spark, rows, tmp_path):
    """The words are read for the map, for the lookup and for the result; texts are cleaned before, once."""
    docs = rows([(1, "en", "A b c", 5), (2, "en", "b, d", 4), (3, None, None, None), (None, "en", "c", 1)], "doc_id long, lang string, text string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = catalog.normalize_words_large(spark, str(tmp_path))
    assert "regexp_replace(" not in out._jdf.queryExecution().optimizedPlan().toString()
    # Each word stands for the one that last follows it.
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "c"), (1, "b d c"), (2, "d d")]


def test_long_runs_without_letters_are_cleaned(spark):
    """A run of some thousand signs overflowed the stack of the pattern."""
    run = F.repeat(F.lit("-. 7\u2705"), 100_000)
    got = spark.range(1).select(tx.filter_text(F.concat(F.lit("a"), run, F.lit("b\u2702c\u2169\u00b2"))).alias("x")).first()["x"]
    assert got == "a b c\u2169\u00b2"


def test_word_map_shuffles_a_word_once_for_many_texts(spark, rows, monkeypatch):
    """One row for each word and task is sorted, not one for each token; the last pair by id and place wins, null ids first."""
    sent = []
    real = catalog.files.clean_word_map
    monkeypatch.setattr(catalog.files, "clean_word_map", lambda df: sent.append(df.count()) or real(df))
    texts = [(5, "a b a c".split()), (None, "a z q r".split()), (7, "a d".split()), (7, "x a e".split()), (6, ["a"]), (1, []), (2, None)]
    docs = [(k, ["a", "b", "b", "a"] * 20) for k in (-3, -2, -1)] + texts
    got = {r.word: r.formal for r in catalog._word_map(rows(docs, "doc_id long, tokens array<string>").coalesce(1)).collect()}
    assert got == {"a": "e", "b": "a", "x": "a", "z": "q", "q": "r"}
    assert sent == [5]
