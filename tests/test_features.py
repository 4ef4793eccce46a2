import math
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidesift.operators import counts as cn, evaluate as ev, features as ft

TEXTS = ["aa bb aa", "aa cc", "bb cc dd aa", "", None, "x aa", "dd ee"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, processed_text string")


def terms_of(text):
    words = [w for w in (text or "").split() if len(w) > 1]
    return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def brute_tfidf(texts, min_df, top):
    counts = [terms_of(t) for t in texts]
    df = Counter(t for c in counts for t in c)
    tf = sum(counts, Counter())
    kept = sorted(sorted((t for t in df if df[t] >= min_df), key=lambda t: (-tf[t], t))[:top])
    idf = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in kept}
    out = []
    for c in counts:
        raw = {kept.index(t): (1 + math.log(n)) * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.append({k: v / norm for k, v in raw.items()})
    return kept, out


def test_terms_of_many_texts_are_counted_together(texts, monkeypatch):
    """Terms leave a task once for all texts counted together, and their sums are right however the texts are parted."""
    counts = [terms_of(t) for t in TEXTS]
    want = {t: (sum(t in c for c in counts), sum(c[t] for c in counts)) for t in sum(counts, Counter())}
    words = texts.select(ft.term_tokens(F.col("processed_text")).alias("words")).coalesce(1).toArrow().combine_chunks().to_batches()
    for bound in (1, 3, 1 << 21):
        monkeypatch.setattr(cn, "COUNTED", bound)
        found = [r for b in cn.count_terms(iter(words)) for r in b.to_pylist()]
        got = {t: (sum(r["df"] for r in found if r["term"] == t), sum(r["tf"] for r in found if r["term"] == t)) for t in {r["term"] for r in found}}
        assert got == want and (bound < 9 or len(found) == len(want))
    assert {r.term: (r.df, r.tf) for r in ft.vocabulary_terms(texts, min_df=1).collect()} == want
    assert ft.vocabulary_terms(texts.limit(0)).count() == 0


@pytest.mark.parametrize("min_df, top", [(1, 100), (2, 100), (1, 3)])
def test_tfidf_equals_the_formula(texts, min_df, top):
    kept, want = brute_tfidf(TEXTS, min_df, top)
    model = ft.TfidfModel.of(ft.fit_tfidf(texts, min_df=min_df, max_features=top))
    assert [t for t, _, _ in model.terms] == kept
    out = model.transform(texts)
    got = {r.doc_id: {e.idx: e.value for e in r.tfidf} for r in out.collect()}
    assert all(got[i] == pytest.approx(w, abs=1e-12) for i, w in enumerate(want))
    vectors = {r.doc_id: r.v for r in ft.assemble_vectors(out, model.size).select("doc_id", vector_to_array("features").alias("v")).collect()}
    staged = {r.doc_id: r.v for r in ft.stage_vectors(out, model.size, "test").select("doc_id", vector_to_array("features").alias("v")).collect()}
    assert vectors == staged
    assert all(vectors[i] == pytest.approx([w.get(k, 0.0) for k in range(len(kept))]) for i, w in enumerate(want))


def test_labels(rows):
    df = rows([("b",), ("a",), ("c",), ("a",)], "label string")
    encoded, classes = ft.encode_labels(df)
    assert classes == ["a", "b", "c"]
    back = encoded.withColumn("back", ft.decode_labels(F.col("label_idx"), classes))
    assert back.filter("back <> label").count() == 0


def test_class_weights(rows):
    df = rows([("a",)] * 6 + [("b",)] * 2, "label string")
    assert {r.label: r.weight for r in ft.class_weights(df).collect()} == {"a": 8 / 12, "b": 2.0}
    assert ft.add_class_weights(df).agg(F.sum("weight")).first()[0] == pytest.approx(8.0)


PAIRS = [("Negatif", "Negatif")] * 3 + [("Negatif", "Positif")] * 2 + [("Positif", "Positif")] * 4 + [("Netral", "Negatif")]


def test_metrics_with_a_class_never_predicted(rows):
    df = rows(PAIRS, "actual string, predicted string")
    report = {r["class"]: r for r in ev.classification_report(df).collect()}
    assert (report["Negatif"].precision, report["Negatif"].recall) == (0.75, 0.6)
    assert (report["Netral"].precision, report["Netral"].recall, report["Netral"].f1, report["Netral"].support) == (0, 0, 0, 1)
    s = ev.summary_metrics(df).first()
    assert s.accuracy == 0.7 and s.f1_macro == pytest.approx((2 / 3 + 0 + 0.8) / 3)
    assert s.f1_weighted == pytest.approx((2 / 3 * 5 + 0.8 * 4) / 10)
    assert [tuple(r) for r in ev.confusion_matrix(df).collect()] == [("Negatif", 3, 0, 2), ("Netral", 1, 0, 0), ("Positif", 0, 0, 4)]
    assert "Netral" in ev.report_text(ev.classification_report(df))


def test_macro_runs_over_classes_that_occur(rows):
    df = rows([("Negatif", "Negatif"), ("Positif", "Positif")], "actual string, predicted string")
    assert ev.summary_metrics(df).first().f1_macro == 1.0


def test_metrics_of_nothing_are_zero(rows):
    df = rows([], "actual string, predicted string")
    assert ev.accuracy(df).first().accuracy == 0.0
    assert sum(sum(r[1:]) for r in ev.confusion_matrix(df).collect()) == 0


@pytest.mark.parametrize("train_hits, band", [(10, "overfitting"), (9, "slight overfitting"), (8, "good")])
def test_overfit_bands(rows, train_hits, band):
    data = [("train", "x", "x" if i < train_hits * 2 else "y") for i in range(20)] + [("test", "x", "x" if i < 17 else "y") for i in range(20)]
    data = [(s, a, p) for s, a, p in data]
    if train_hits == 9:
        data[18] = ("train", "x", "x")
    assert ev.overfit_gap(rows(data, "split string, actual string, predicted string")).first().band == band


def test_verify(rows):
    expected = rows([(1, "a"), (2, "b"), (3, "c")], "doc_id int, expected string")
    predicted = rows([(1, "a"), (2, "x")], "doc_id int, sentiment string")
    assert {r.doc_id: r.status for r in ev.verify_expected(predicted, expected).collect()} == {1: "PASSED", 2: "FAILED", 3: "FAILED"}
    assert tuple(ev.verify_expected(predicted, expected, overall=True).first()) == (3, 1, False)
