import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidesift.operators import explore, features as ft, profile, sampling


def digest(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


@pytest.fixture(scope="module")
def labelled(spark):
    data = [(i, "big" if i % 3 else ("mid" if i % 2 else "tiny")) for i in range(400)] + [(1000 + i, "few") for i in range(3)]
    return spark.createDataFrame(data, "doc_id bigint, label string")


def sizes(df):
    return Counter(r.label for r in df.collect())


def test_ranks_equal_a_sort(labelled):
    got = {(r.label, r.id): r.rank for r in sampling.rank_in_class(labelled).collect()}
    for label in ("big", "mid", "tiny", "few"):
        ids = sorted((r.doc_id for r in labelled.filter(F.col("label") == label).collect()), key=lambda i: (digest(42, i), i))
        assert [got[label, i] for i in ids] == list(range(1, len(ids) + 1))


def test_resample_is_exact_even_for_a_class_drawn_many_times(spark, labelled):
    targets = spark.createDataFrame([("big", 300), ("few", 9000), ("tiny", 1), ("absent", 5)], "label string, target bigint")
    out = sampling.resample_classes(labelled, targets).collect()
    assert Counter(r.label for r in out) == {"big": 300, "few": 9000, "tiny": 1}
    ranks = {(r.label, r.rank): r.id for r in sampling.rank_in_class(labelled).collect()}
    n = sizes(labelled)
    want = {(c, d, ranks[c, int(digest(42, c, d)[:15], 16) % n[c] + 1]) for c, t in (("big", 300), ("few", 9000), ("tiny", 1)) for d in range(1, t + 1)}
    assert {(r.label, r.draw, r.doc_id) for r in out} == want and len(out) == len(want)


def test_class_targets_cut_to_whole_rows(rows):
    df = rows([("Negatif",)] * 7 + [("Positif",)] * 3 + [("Netral",)] + [("Other",)] * 2, "label string")
    assert {r.label: r.target for r in explore.class_targets(df).collect()} == {"Negatif": 8, "Positif": 6, "Netral": 6, "Other": 7}


def test_split_shares_and_order(labelled):
    out = sampling.stratified_split(labelled).collect()
    n = sizes(labelled)
    tests = Counter(r.label for r in out if r.split == "test")
    assert tests == {c: int(0.2 * k + 0.5) for c, k in n.items() if int(0.2 * k + 0.5)}
    assert len(out) == sum(n.values())
    for c in n:
        order = sorted(((digest(42, r.doc_id), r.split) for r in out if r.label == c))
        assert [s for _, s in order] == ["test"] * tests[c] + ["train"] * (n[c] - tests[c])


def test_folds_differ_by_one_row_at_most(labelled):
    out = sampling.stratified_folds(labelled, 5).collect()
    for c, n in sizes(labelled).items():
        members = sorted((digest(42, r.doc_id), r.fold) for r in out if r.label == c)
        assert [f for _, f in members] == [k * 5 // n for k in range(n)]


def test_shuffle_is_sorted_by_hash(labelled):
    got = [r.doc_id for r in sampling.shuffle_rows(labelled, "doc_id").collect()]
    assert got == sorted(got, key=lambda i: digest(42, i)) and got != sorted(got)


def test_param_grid_is_distinct_and_repeatable():
    grid = sampling.sample_param_grid()
    assert len({str(g) for g in grid}) == 30 and grid == sampling.sample_param_grid()
    assert len(sampling.sample_param_grid({"a": [1, 2]}, 30)) == 2
    assert all(g[k] in v for g in grid for k, v in sampling.PARAM_SPACE.items())


def test_many_classes_are_all_kept(spark):
    df = spark.range(2000).withColumn("label", F.format_string("c%04d", "id"))
    assert len(sampling.class_counts(df, "label")) == 2000
    encoded, classes = ft.encode_labels(df)
    assert len(classes) == 2000
    assert ft.add_class_weights(encoded).where("label_idx != id or label_idx is null or weight != 1.0").count() == 0


def test_dedup_keeps_the_first(rows):
    df = rows([(5, "a", "x"), (2, "a", "y"), (3, "b", "z"), (9, None, "n"), (7, None, "m")], "doc_id int, text string, lang string")
    assert sorted(map(tuple, profile.dedup_keep_first(df).collect()), key=str) == [(2, "a", "y"), (3, "b", "z"), (7, None, "m")]
    assert profile.duplicate_count(df).first()[0] == 2
    assert {r.column_name: r.nulls for r in profile.null_profile(df).collect()} == {"doc_id": 0, "text": 2, "lang": 0}


def test_stage_audit(rows):
    df = rows([(1, "a", "p"), (2, "a", "p"), (3, "b", " "), (4, None, "")], "doc_id int, text string, processed string")
    assert [tuple(r) for r in profile.stage_audit(df, "text", "processed").collect()] == [
        ("1_drop_missing", 4, 3, 1), ("2_dedup", 3, 2, 1), ("3_drop_empty", 2, 1, 1),
    ]


def test_search_draws_models_that_differ():
    """No setting that Spark lacks, no two names of one model, and as many as are asked for."""
    space = sampling.effective_space()
    assert set(space) == set(sampling.SPARK_SETTINGS) and space["max_depth"] == [30, 10, 20]
    grid = sampling.sample_param_grid(space, 30)
    assert len({str(g) for g in grid}) == 30
    assert sampling.effective_space({"max_depth": [None, 50, 30, 8], "min_samples_split": [2, 5]}) == {"max_depth": [30, 8]}


def test_first_by_input_order(spark, rows):
    from tidesift.operators.preprocess import default_tables
    from tidesift.plans import pipeline as pl
    from tidesift.sources import wordlists

    raw = rows([("10", "bagus sekali", 1), ("9", "bagus sekali", 0), ("8", "bagus sekali", 2)], "id_str string, text string, row_number long")
    lexicon = wordlists.lexicon_frame(spark, wordlists.POSITIVE)
    build = lambda **o: pl.build_labelled(raw, default_tables(spark), lexicon, id_col="id_str", **o).collect()
    assert [r.id_str for r in build()] == ["10"] and [r.id_str for r in build(order_col="row_number")] == ["9"]


def test_audit_of_raw_texts_prepares_each_once(rows):
    df = rows([(1, "a"), (2, "a"), (3, "-"), (4, None), (5, "-")], "doc_id int, text string")
    prepare = lambda d: d.withColumn("processed", F.translate("text", "-", ""))
    assert [tuple(r) for r in profile.audit_texts(df, prepare, "text", "processed").collect()] == [
        ("1_drop_missing", 5, 4, 1), ("2_dedup", 4, 2, 2), ("3_drop_empty", 2, 1, 1),
    ]
