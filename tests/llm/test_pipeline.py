"""Stages of the pipeline on rows that are hard to tell apart."""

import random

import corpus_pipeline
from tidesift.llm import components, jaccard_tree
from tests.llm.test_search import _prose


def test_near_duplicates_with_null_and_repeated_ids(spark, rows):
    """One row of each group stays, and every unlinked text, whatever the ids."""
    rng = random.Random(12)
    a, b, c, d, e, f = (_prose(rng, 120) for _ in range(6))
    near = lambda text: text + " " + rng.choice(["end", "stop"])
    docs = [
        (3, a, "first"), (None, b, "null id"), (None, c, "null id"), (None, near(c), "null id"), (7, near(a), "copy of 3"), (7, d, "unlike"),
        (7, d, "unlike"), (8, e, "one id"), (8, f, "one id"), (9, "", "x"), (9, "", "x"), (None, None, "x"), (None, a.upper(), "copy of 3"),
    ]
    got = corpus_pipeline.one_of_each(spark, rows(docs, "doc_id long, text string, source string"), "").collect()
    assert sorted((r.doc_id or 0, (r.text or "")[:100]) for r in got) == sorted(
        [(3, a[:100]), (0, b[:100]), (0, c[:100]), (7, d[:100]), (8, e[:100]), (8, f[:100]), (9, ""), (9, ""), (0, "")]
    )
    assert got and list(got[0].asDict()) == ["doc_id", "text", "source"]


def test_near_duplicates_broadcast_no_table(spark, rows, monkeypatch):
    """Tables of pairs, members and facts grow with the documents, whatever size Spark takes small ones for."""
    plans = []
    for module in (components, jaccard_tree):
        monkeypatch.setattr(module, "stage", lambda df, *more, real=module.stage: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, *more))
    rng = random.Random(5)
    texts = [_prose(rng, 60) for _ in range(6)]
    docs = [(k, t + end, "x") for k, t in enumerate(texts) for end in ("", " end", " stop")]
    kept = corpus_pipeline.one_of_each(spark, rows(docs, "doc_id long, text string, source string"), "")
    plans.append(kept._jdf.queryExecution().executedPlan().toString())
    assert kept.count() == 6
    assert sum("SortMergeJoin" in p for p in plans) >= 5 and not any("Broadcast" in p for p in plans)
