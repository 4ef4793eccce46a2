"""Training, tuning and using Spark ML classifiers."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, functions as F

from tidesift.operators.evaluate import summary_metrics
from tidesift.operators.forest import Binned, SparseForestClassifier, bin_rows
from tidesift.operators.sampling import MAX_DEPTH, PARAM_SPACE, SEED, effective_space, sample_param_grid
from tidesift.sources.local import local_frame


class MacroF1Evaluator(Evaluator):
    """Macro-averaged F1 of class indices; Spark's own evaluator has the weighted one only."""

    def __init__(self, classes: int):
        super().__init__()
        self.classes = classes

    def _evaluate(self, dataset: DataFrame) -> float:
        names = [str(k) for k in range(self.classes)]
        pairs = dataset.select(
            F.col("label_idx").cast("int").cast("string").alias("actual"),
            F.col("prediction").cast("int").cast("string").alias("predicted"),
        )
        return summary_metrics(pairs, names).first()["f1_macro"]

    def isLargerBetter(self) -> bool:
        return True


def forest(
    num_trees: int = 300,
    max_depth: int | None = None,
    min_samples_leaf: int = 2,
    max_features: str | float = "sqrt",
    bootstrap: bool = True,
    seed: int = SEED,
    weight: str | None = "weight",
) -> RandomForestClassifier:
    """A random forest with the given settings; a smallest split size has no counterpart in Spark."""
    estimator = SparseForestClassifier(
        featuresCol="features",
        labelCol="label_idx",
        numTrees=num_trees,
        maxDepth=min(max_depth or MAX_DEPTH, MAX_DEPTH),
        minInstancesPerNode=min_samples_leaf,
        featureSubsetStrategy=str(max_features),
        bootstrap=bootstrap,
        seed=seed,
    )
    return estimator.setWeightCol(weight) if weight else estimator


def bin_for_forests(train: DataFrame, seed: int = SEED) -> Binned:
    """Bins of rows that several forests of this seed are fitted on, beside the vectors that the models are tried on."""
    needed = [c for c in ("label_idx", "weight", "fold", "features") if c in train.columns]
    return bin_rows(train, "features", needed, forest(seed=seed).getMaxBins(), seed)


def fit_forest(train: DataFrame, binned: Binned | None = None, **settings) -> Model:
    """Fit a forest on ``features``, ``label_idx`` and ``weight``, or on bins that were made of them before."""
    estimator = forest(**settings)
    if binned is None:
        return estimator.fit(train)
    estimator.binned = binned.bounds
    return estimator.fit(binned.rows)


def _param_map(estimator: RandomForestClassifier, combo: dict) -> dict:
    depth = combo.get("max_depth")
    values = {
        estimator.numTrees: combo.get("n_estimators"),
        estimator.maxDepth: min(depth or MAX_DEPTH, MAX_DEPTH) if "max_depth" in combo else None,
        estimator.minInstancesPerNode: combo.get("min_samples_leaf"),
        estimator.featureSubsetStrategy: None if "max_features" not in combo else str(combo["max_features"]),
        estimator.bootstrap: combo.get("bootstrap"),
    }
    return {param: value for param, value in values.items() if value is not None}


def tune_forest(
    train: DataFrame,
    classes: int,
    space: dict[str, list] = PARAM_SPACE,
    n_iter: int = 30,
    folds: int = 5,
    parallelism: int = 4,
    seed: int = SEED,
    binned: Binned | None = None,
) -> tuple[Model, DataFrame]:
    """Random search by cross-validated macro F1 over the ``fold`` column.

    Candidates are drawn without repetition from the settings that make different models in Spark. Returns the best candidate fitted on all rows, and the leaderboard.
    """
    combos = sample_param_grid(effective_space(space), n_iter, seed)
    estimator = forest(seed=seed)
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=[_param_map(estimator, c) for c in combos],
        evaluator=MacroF1Evaluator(classes),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=seed,
    )
    # Every fit reads the same bins again: they are made once.
    binned = binned or bin_for_forests(train, seed)
    estimator.binned = binned.bounds
    fitted = search.fit(binned.rows)
    return fitted.bestModel, search_leaderboard(train, combos, fitted.avgMetrics)


def search_leaderboard(df: DataFrame, combos: list[dict], scores: list[float]) -> DataFrame:
    """Settings and mean score per candidate, best first."""
    rows = [
        (k, float(s), {name: str(value) for name, value in c.items()}) for k, (c, s) in enumerate(zip(combos, scores))
    ]
    board = df.sparkSession.createDataFrame(rows, "candidate int, f1_macro double, params map<string,string>")
    return board.orderBy(F.desc("f1_macro"), "candidate")


def fit_weighted_softmax(train: DataFrame, max_iter: int = 50, reg: float = 0.01, weight: str | None = "weight") -> Model:
    """Multinomial logistic regression: cross-entropy with a weight per class."""
    estimator = LogisticRegression(
        featuresCol="features", labelCol="label_idx", family="multinomial", maxIter=max_iter, regParam=reg
    )
    return (estimator.setWeightCol(weight) if weight else estimator).fit(train)


def training_curve(model: Model, df: DataFrame) -> DataFrame:
    """Loss after each iteration."""
    losses = list(enumerate(float(x) for x in model.summary.objectiveHistory))
    return local_frame(df.sparkSession, losses, "iteration int, loss double")


def predict_proba(model: Model, df: DataFrame, classes: list[str]) -> DataFrame:
    """Adds ``prediction`` and one ``prob_<class>`` column per class."""
    scored = model.transform(df).withColumn("_p", vector_to_array("probability"))
    probs = {f"prob_{c}": F.get("_p", F.lit(k)) for k, c in enumerate(classes)}
    return scored.withColumns(probs).drop("_p", "probability", "rawPrediction")


def feature_importances(model: Model, terms: DataFrame, top_n: int = 20) -> DataFrame:
    """The most important terms; ties in alphabetical order."""
    weights = model.featureImportances
    rows = list(zip(weights.indices.tolist(), weights.values.tolist()))
    scores = local_frame(terms.sparkSession, rows, "idx int, importance double")
    found = terms.select("idx", "term").join(F.broadcast(scores), "idx", "left")
    score = F.coalesce("importance", F.lit(0.0)).alias("Importance")
    return found.select(F.col("term").alias("Fitur"), score).orderBy(F.desc("Importance"), "Fitur").limit(top_n)
