"""Every registered query: against its SQL twin, or for rows where it has none."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, differences

# Trained several times over by their neighbours in this list, and slow.
SLOW = {"search_leaderboard", "training_curve", "model_metadata", "fit_forest_split_first", "predict_proba", "score_plain_forest"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, sf_dir, con, name):
    assert differences(queries()[name](spark, sf_dir), oracle_sql()[name], con) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_gives_rows(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).limit(1).count() == 1


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.columns == ["lang", "label", "n", "pct"]
    assert df.count() == 12


def test_result_does_not_depend_on_partitions(spark, sf_dir):
    got = []
    for n in ("1", "8", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append([sorted(map(tuple, queries()[q](spark, sf_dir).collect())) for q in ("resample_classes", "lexicon_score_negated_large")])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got[0] == got[1] == got[2]
