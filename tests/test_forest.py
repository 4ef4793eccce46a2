"""The forest over sparse rows: splits by brute force, model by Spark's file format, rows of the size of their entries."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidesift.operators import forest as fo, models

WIDE = 20_000


def _data(n: int, features: int, seed: int = 0):
    """Rows of 8 entries; the class is told by three features, and one row in twenty lies."""
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        at = np.sort(rng.choice(40, 8, replace=False))
        values = np.round(rng.random(8) - 0.2, 2)
        own = dict(zip(at.tolist(), values.tolist()))
        y = 2 if own.get(3, 0) > 0.4 else 1 if 5 in own or own.get(9, 0) < 0 else 0
        y = int(rng.integers(3)) if rng.random() < 0.05 else y
        vector = Vectors.sparse(features, at.tolist(), values.tolist())
        out.append((float(y), Vectors.dense(vector.toArray()) if features < 100 and k % 3 == 0 else vector, 1.0 + y, k % 2))
    return out


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(_data(600, 40), ["label_idx", "features", "weight", "fold"]).repartition(5)


def _gini(weights):
    total = weights.sum()
    return 1 - np.square(weights / total).sum() if total else 0.0


def test_first_split_is_the_best_of_all(spark, small):
    model = models.fit_forest(small, num_trees=1, max_depth=1, max_features="all", bootstrap=False)
    assert isinstance(model, RandomForestClassificationModel) and model.totalNumNodes == 3
    rows = [(r.features.toArray(), int(r.label_idx), r.weight) for r in small.collect()]
    x, y, w = (np.array(c) for c in zip(*rows))
    weights = lambda m: np.bincount(y[m], w[m], 3)
    binned = fo.bin_rows(small, "features", [], 32, 42)
    best = 0.0
    for f, bounds in enumerate(binned.bounds):
        for b in bounds[np.isfinite(bounds)]:
            left = x[:, f] <= b
            if min(left.sum(), (~left).sum()) >= 2:
                parts = [weights(left), weights(~left)]
                best = max(best, _gini(weights(y >= 0)) - sum(p.sum() / w.sum() * _gini(p) for p in parts))
    tree = model.trees[0].toDebugString
    feature, cut = int(tree.split("feature ")[1].split()[0]), float(tree.split("<= ")[1].split(")")[0])
    left = x[:, feature] <= cut
    gain = _gini(weights(y >= 0)) - sum(p.sum() / w.sum() * _gini(p) for p in (weights(left), weights(~left)))
    assert gain == pytest.approx(best, abs=1e-5)
    for r in model.transform(small).collect():
        side = left if r.features.toArray()[feature] <= cut else ~left
        assert r.probability.toArray() == pytest.approx(weights(side) / weights(side).sum(), abs=1e-7)


def test_same_forest_whatever_the_weights_order_and_learns(spark, small):
    binned = fo.bin_rows(small, "features", ["label_idx", "weight"], 32, 42)
    got = []
    for parts in (1, 7):
        estimator = models.forest(num_trees=5, max_depth=5)
        estimator.binned = binned.bounds
        model = estimator.fit(binned.rows.repartition(parts))
        got.append(model.toDebugString.split("\n", 1)[1])
    assert got[0] == got[1]
    scored = model.transform(small)
    assert scored.agg(F.avg((F.col("prediction") == F.col("label_idx")).cast("int"))).first()[0] > 0.8
    assert set(np.argsort(model.featureImportances.toArray())[-3:]) == {3, 5, 9}


def test_search_by_folds(spark, small):
    space = {"n_estimators": [3, 4], "max_depth": [1, 4], "min_samples_leaf": [1], "max_features": ["all"], "bootstrap": [True]}
    best, board = models.tune_forest(small, 3, space, 4, 2)
    rows = board.collect()
    assert len(rows) == 4 and rows[0]["params"]["max_depth"] == "4" and best.getMaxDepth() == 4


def test_bins_made_before_give_the_same_forest(small):
    """Several forests can read one table of bins."""
    settings = {"num_trees": 3, "max_depth": 3, "bootstrap": False}  # draws go by the place of a row
    weight = "weight" if "weight" in small.columns else None
    binned = models.bin_for_forests(small)
    got, want = models.fit_forest(small, binned, weight=weight, **settings), models.fit_forest(small, weight=weight, **settings)
    trees = [[t for t in m.toDebugString.splitlines() if "uid" not in t] for m in (got, want)]
    assert trees[0] == trees[1] and len(trees[0]) > 3


def test_rows_of_many_features_stay_small(spark):
    """A row of 20 000 features took 80 KB; its bins take what its 8 entries take."""
    df = spark.createDataFrame(_data(300, WIDE), ["label_idx", "features", "weight", "fold"])
    binned = fo.bin_rows(df, "features", ["label_idx"], 32, 42)
    assert binned.rows.agg(F.max(F.size("_idx")), F.max(F.size("_bin"))).first() == (8, 8)
    model = models.fit_forest(df, num_trees=3, max_depth=3, max_features="0.5")
    assert model.numFeatures == WIDE and model.getNumTrees == 3


def test_a_label_alone_and_settings(spark):
    one = spark.createDataFrame([(0.0, Vectors.sparse(3, [0], [1.0]), 1.0)] * 4, ["label_idx", "features", "weight"])
    model = models.fit_forest(one, num_trees=2, max_depth=3)
    assert model.totalNumNodes == 2 and model.transform(one).first()["prediction"] == 0.0
    assert [fo.subset_size(s, 20_000, 2) for s in ("sqrt", "log2", "0.3", "7", "all", "auto")] == [142, 15, 6000, 7, 20_000, 142]
    with pytest.raises(ValueError):
        models.fit_forest(one.limit(0))


def test_trees_grown_in_tasks_are_those_of_passes(small, monkeypatch):
    """A small table goes to the tasks whole: deep trees of it, which took a pass and more for each level, stay the same."""
    got, passes = [], []
    counting = fo._counting
    monkeypatch.setattr(fo, "_counting", lambda *a: passes.append(1) or counting(*a))
    for size in (fo.WHOLE_BYTES, -1):
        monkeypatch.setattr(fo, "WHOLE_BYTES", size)
        before = len(passes)
        for more in ({"max_features": "0.3"}, {"bootstrap": False, "max_depth": 4}, {"min_samples_leaf": 5, "weight": None}):
            model = models.fit_forest(small.coalesce(1), **{"num_trees": 4} | more)
            got.append((model.toDebugString.split("\n", 1)[1], [t.featureImportances.toArray().tolist() for t in model.trees]))
        if size > 0:
            assert len(passes) == before
    assert passes and got[:3] == got[3:] and max(t.depth for t in model.trees) > 4


def test_queries_of_forests_take_the_whole_of_them(monkeypatch):
    """F24-F26: 300 trees, 30 candidates of the whole space and 5 folds, not a few of each."""
    from tidesift.operators.sampling import PARAM_SPACE
    from tidesift.plans.catalog import learning

    class Done(Exception):
        pass

    def stop(*args, **options):
        raise Done(args, options)

    monkeypatch.setattr(learning.pl, "train", stop)
    monkeypatch.setattr(learning, "labelled", lambda *a: None)
    for query, tune in ((learning.fit_forest, False), (learning.tune_forest, True)):
        with pytest.raises(Done) as found:
            query(None, "")
        options = found.value.args[0][1]
        assert options.settings == {} and options.tune == tune
        assert (options.n_iter, options.folds, options.space) == (30, 5, PARAM_SPACE)
    assert models.forest().getNumTrees() == 300 and models.forest().getMaxDepth() == 30

    class Fitted:
        classes = ["a", "b", "c"]
        training_vectors = staticmethod(lambda rows: rows)

    asked = []
    monkeypatch.setattr(learning, "_fit", lambda *a, **more: asked.append(more) or (Fitted, None))
    monkeypatch.setattr(learning.ft, "add_class_weights", lambda rows: rows)
    monkeypatch.setattr(learning.sampling, "stratified_folds", lambda rows, folds=5: folds)
    monkeypatch.setattr(learning.models, "tune_forest", lambda vectors, classes, space=PARAM_SPACE, n_iter=30, folds=5: (None, (vectors, classes, space, n_iter, folds)))
    assert learning.sample_param_grid(None, "") == (5, 3, PARAM_SPACE, 30, 5) and asked == [{"settings": {}}]
