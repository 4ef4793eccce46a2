import random

import pytest
from pyspark.sql import functions as F

from tidesift.operators import lexicon as lx
from tidesift.operators.preprocess import default_tables, preprocess_light
from tidesift.sources import wordlists

GOLDEN = [
    ("Alhamdulillah akhirnya lolos! Bangga banget, programnya membantu dan bikin semangat #senang", "Positif"),
    ("Seleksinya mengecewakan, ribet, dan banyak yang gagal karena aturan amburadul", "Negatif"),
    ("Pendaftaran dibuka 30 Juni, kuota tahun ini 4.000 orang, lihat www.contoh.id", "Netral"),
    ("Saya tidak pernah kecewa sama sekali", "Positif"),
    ("gak bagus", "Negatif"),
]


@pytest.fixture(scope="module")
def lexicon(spark):
    return lx.build_lexicon(
        wordlists.lexicon_frame(spark, wordlists.POSITIVE), wordlists.lexicon_frame(spark, wordlists.NEGATIVE),
        wordlists.overrides_frame(spark),
    )


def test_golden_sentences(spark, rows, lexicon):
    df = rows([(i, t) for i, (t, _) in enumerate(GOLDEN)], "doc_id int, text string")
    light = preprocess_light(df, default_tables(spark), filter_lang=False)
    got = {r.doc_id: r.label for r in lx.label_texts(light, lexicon, wordlists.NEGATIONS).collect()}
    assert got == {i: label for i, (_, label) in enumerate(GOLDEN)}


def python_score(tokens, weights, negations):
    total, flip = 0, False
    for t in tokens:
        if negations and t in negations:
            flip = True
        elif weights.get(t):
            total += -weights[t] if flip else weights[t]
            flip = False
    return total


@pytest.mark.parametrize("negations", [None, ["n", "m", "both"]])
@pytest.mark.parametrize("score", [lx.lexicon_score, lx.lexicon_score_by_join])
def test_scores_equal_a_plain_loop(rows, score, negations):
    rng = random.Random(11)
    weights = {"p": 2, "q": -3, "both": 4, "z": 0, "two words": 5}
    texts = ["", "  ", None] + [" ".join(rng.choices(["n", "m", "p", "q", "x", "both", "z"], k=rng.randint(1, 12))) for _ in range(500)]
    df = rows([(i, t) for i, t in enumerate(texts)], "doc_id int, light_text string")
    table = rows(list(weights.items()), "word string, weight int")
    got = {r.doc_id: r.score for r in score(df, table, negations).collect()}
    assert got == {i: python_score((t or "").split(), weights, negations) for i, t in enumerate(texts)}


def test_repeated_words_score_the_same_either_way(rows, monkeypatch):
    df = rows([(1, "a b a"), (2, None)], "doc_id int, light_text string")
    table = rows([("a", 2), ("a", 5), ("b", -1)], "word string, weight int")
    small = {r.doc_id: r.score for r in lx.lexicon_score(df, table).collect()}
    monkeypatch.setattr(lx, "small_map", lambda *a: None)
    assert small == {r.doc_id: r.score for r in lx.lexicon_score(df, table).collect()} == {1: 9, 2: 0}


def test_null_text_is_neutral(rows, lexicon):
    df = rows([(1, None), (2, " ")], "doc_id int, light_text string")
    assert [r.label for r in lx.label_texts(df, lexicon, wordlists.NEGATIONS).collect()] == ["Netral", "Netral"]


@pytest.mark.parametrize(
    "rule, want", [("net", {"a": 2, "b": -1, "only": 1, "neg": -2}), ("stronger", {"a": 5, "b": -4, "only": 1, "neg": -2}), ("drop", {"only": 1, "neg": -2})]
)
def test_conflicts(rows, rule, want):
    pos = rows([("a", 5), ("b", 3), ("c", 2), ("only", 1)], "word string, weight int")
    neg = rows([("a", -3), ("b", -4), ("c", -2), ("neg", -2)], "word string, weight int")
    assert {r.word: r.weight for r in lx.resolve_conflicts(pos, neg, rule).collect()} == want


def test_unknown_rule():
    with pytest.raises(ValueError):
        lx.resolve_conflicts(None, None, "other")


def test_overrides_set_turn_and_delete(rows):
    lexicon = rows([("a", 3), ("b", 2), ("c", -1)], "word string, weight int")
    over = rows([("a", -4), ("b", 0), ("new", 5)], "word string, weight int")
    assert {r.word: r.weight for r in lx.lexicon_overrides(lexicon, over).collect()} == {"a": -4, "c": -1, "new": 5}


def test_pseudo_probabilities(rows):
    df = rows([(s,) for s in (-7, -5, -4, -1, 0, 1, 4, 5, 9)], "s bigint")
    got = {r.s: (r.Negatif, r.Netral, r.Positif) for r in df.select("s", *[p.alias(c) for c, p in lx.pseudo_proba(F.col("s")).items()]).collect()}
    assert got[-7] == got[-5] == (0.95, 0.04, 0.01) and got[-4] == got[-1] == (0.85, 0.10, 0.05)
    assert got[0] == (0.10, 0.80, 0.10) and got[1] == got[4] == (0.05, 0.10, 0.85) and got[5] == got[9] == (0.01, 0.04, 0.95)
    assert all(abs(sum(v) - 1) < 1e-9 for v in got.values())


def test_scores_of_null_and_repeated_ids_are_the_same_either_way(rows):
    data = [(None, "a b"), (None, "n a"), (1, "a a"), (1, "n"), (1, "a n b"), (2, None)]
    df, table = rows(data, "doc_id int, light_text string"), rows([("a", 2), ("b", -1)], "word string, weight int")
    small, large = (sorted(map(repr, map(tuple, f(df, table, ["n"]).collect()))) for f in (lx.lexicon_score, lx.lexicon_score_by_join))
    assert small == large and len(large) == len(data)
