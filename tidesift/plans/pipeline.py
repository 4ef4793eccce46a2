"""The whole way: raw texts to labelled, balanced rows, to a fitted and reported classifier."""

from __future__ import annotations

import inspect
import json
import re
from dataclasses import dataclass, field
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidesift.operators import evaluate, explore, features, models, profile, sampling
from tidesift.operators.lexicon import CLASSES, label_texts
from tidesift.operators.preprocess import TextTables, preprocess
from tidesift.sources.files import write_report, write_text
from tidesift.sources.scratch import stage

KINDS = {"random-forest": RandomForestClassificationModel, "softmax": LogisticRegressionModel}
MODEL_NAMES = {"random-forest": "Random Forest Base", "softmax": "Softmax (light text)"}


def build_labelled(
    raw: DataFrame,
    tables: TextTables,
    lexicon: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    filter_lang: bool = True,
    negated: bool = True,
    order_col: str | None = None,
) -> DataFrame:
    """Drop missing and repeated texts, preprocess, drop empty ones, label by the light text.

    Of equal texts the first stays by ``order_col``, such as the row numbers that file readers give, else by the id.
    """
    clean = profile.dedup_keep_first(profile.drop_missing_text(raw, text), text, order_col or id_col)
    ready = preprocess(clean, tables, text, id_col, filter_lang)
    kept = profile.drop_empty_processed(ready, "processed_text")
    return label_texts(kept, lexicon, tables.negations if negated else None, "light_text", id_col=id_col)


def balance(labelled: DataFrame, id_col: str = "doc_id", seed: int = sampling.SEED) -> DataFrame:
    """Resample the classes to their target sizes."""
    return sampling.resample_classes(labelled, explore.class_targets(labelled), id_col, "label", seed)


@dataclass
class FittedClassifier:
    """A classifier with its vocabulary: scores texts, and can be saved."""

    kind: str
    model: Model
    tfidf: features.TfidfModel
    classes: list[str]
    text: str

    def weighed(self, df: DataFrame) -> DataFrame:
        """Adds ``tfidf`` of the whole text."""
        return self.tfidf.transform(df, self.text)

    def training_vectors(self, df: DataFrame) -> DataFrame:
        """``features``, ``label_idx``, ``weight`` and, where there are such, ``fold`` and what tells rows: written once, read by every pass."""
        keep = [c for c in ("doc_id", "label", "split", "label_idx", "weight", "fold") if c in df.columns]
        return features.stage_vectors(self.weighed(df).select(*keep, "tfidf"), self.tfidf.size, "vectors")

    def proba(self, df: DataFrame) -> DataFrame:
        vectors = features.assemble_vectors(self.weighed(df), self.tfidf.size).drop("tfidf")
        return models.predict_proba(self.model, vectors, self.classes).drop("features")

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``predicted``, the class name."""
        return self._named(self.proba(df))

    def told(self, vectors: DataFrame) -> DataFrame:
        """``predict`` for rows of ``training_vectors``."""
        return self._named(models.predict_proba(self.model, vectors, self.classes).drop("features"))

    def _named(self, df: DataFrame) -> DataFrame:
        return df.withColumn("predicted", features.decode_labels(F.col("prediction"), self.classes))

    def save(self, spark: SparkSession, path: str, metadata: dict) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        self.tfidf.frame(spark).write.mode("overwrite").parquet(f"{path}/vocabulary")
        record = metadata | {"kind": self.kind, "text": self.text, "classes": self.classes}
        row = spark.createDataFrame([(json.dumps(record, ensure_ascii=False),)], "value string")
        row.write.mode("overwrite").text(f"{path}/metadata")


def load_metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/metadata", wholetext=True).first()["value"])


def load_classifier(spark: SparkSession, path: str) -> FittedClassifier:
    """Reload a saved classifier; a missing part is an error."""
    try:
        record = load_metadata(spark, path)
        terms = spark.read.parquet(f"{path}/vocabulary").limit(features.MAX_READ + 1).collect()
        model = KINDS[record["kind"]].load(f"{path}/model")
    except (AnalysisException, Py4JJavaError) as error:
        if not re.search("PATH_NOT_FOUND|[Pp]ath does not exist", str(error)):
            raise
        raise FileNotFoundError(f"no complete classifier under {path}; train one first") from error
    if len(terms) > features.MAX_READ:
        raise ValueError(f"the vocabulary under {path} has over {features.MAX_READ} terms, which is too many for a constant")
    return FittedClassifier(
        record["kind"],
        model,
        features.TfidfModel([(r["term"], r["idx"], r["idf"]) for r in terms]),
        record["classes"],
        record["text"],
    )


@dataclass
class TrainOptions:
    kind: str = "random-forest"
    seed: int = sampling.SEED
    test_share: float = 0.2
    min_df: int = features.MIN_DF
    max_features: int = features.MAX_FEATURES
    order: str = "resample_then_split"
    tune: bool = False
    folds: int = 5
    n_iter: int = 30
    space: dict[str, list] = field(default_factory=lambda: dict(sampling.PARAM_SPACE))
    settings: dict = field(default_factory=dict)


@dataclass
class TrainResult:
    fitted: FittedClassifier
    predictions: DataFrame
    reports: dict[str, DataFrame]
    metadata: dict


ORDERS = ("resample_then_split", "split_then_resample")


def split_rows(labelled: DataFrame, options: TrainOptions, id_col: str = "doc_id") -> DataFrame:
    """Balanced rows with a ``split``; ``row_id`` is their key.

    ``resample_then_split`` lets copies of one text fall on both sides, as the
    first published method did; ``split_then_resample`` keeps the test rows
    apart and as they are.
    """
    if options.order not in ORDERS:
        raise ValueError(f"unknown order {options.order!r}; use one of {ORDERS}")
    key = F.concat_ws("#", F.col(id_col).cast("string"), F.col("draw").cast("string")).alias("row_id")
    if options.order == "resample_then_split":
        rows = balance(labelled, id_col, options.seed).select("*", key)
        rows = stage(rows, "balanced")
        return sampling.stratified_split(rows, options.test_share, "row_id", "label", options.seed)
    parts = sampling.stratified_split(labelled, options.test_share, id_col, "label", options.seed)
    parts = stage(parts, "parts")
    train = balance(parts.filter("split = 'train'"), id_col, options.seed)
    test = parts.filter("split = 'test'").withColumn("draw", F.lit(0).cast("bigint"))
    return stage(train.unionByName(test).select("*", key), "balanced")


def train(labelled: DataFrame, options: TrainOptions | None = None, id_col: str = "doc_id") -> TrainResult:
    """Split, weigh, vectorise, fit, tune on request, evaluate.

    The labelled table is written once to the shared folder, since every later
    job reads it again.
    """
    options = options or TrainOptions()
    text = "light_text" if options.kind == "softmax" else "processed_text"
    labelled = stage(labelled.select(id_col, "processed_text", "light_text", "label"), "labelled")
    rows = split_rows(labelled, options, id_col).select(
        F.col("row_id").alias("doc_id"), text, "label", "split"
    )
    rows, classes = features.encode_labels(rows, "label")
    basis = rows if options.order == "resample_then_split" else rows.filter("split = 'train'")
    vocabulary = features.fit_tfidf(basis, text, options.min_df, options.max_features)
    tfidf = features.TfidfModel.of(vocabulary)
    fitted = FittedClassifier(options.kind, None, tfidf, classes, text)

    train_rows = features.add_class_weights(rows.filter("split = 'train'"))
    if options.tune:
        train_rows = sampling.stratified_folds(train_rows, options.folds, "doc_id", "label", options.seed)
    vectors = fitted.training_vectors(train_rows)
    # Vectors of every row are made once: what they are trained on is also what they are told by.
    others = rows.filter(~F.coalesce(F.col("split") == "train", F.lit(False)))
    vectorised = vectors.unionByName(fitted.training_vectors(others), allowMissingColumns=True)

    reports: dict[str, DataFrame] = {}
    summaries: dict[str, DataFrame] = {}
    if options.kind == "softmax":
        fitted.model = models.fit_weighted_softmax(vectors, **options.settings)
        reports["training_curve"] = models.training_curve(fitted.model, vectors)
    else:
        binned = models.bin_for_forests(vectors, options.seed) if options.tune else None
        fitted.model = models.fit_forest(vectors, binned, seed=options.seed, **options.settings)

    def evaluated() -> DataFrame:
        scored = fitted.told(vectorised).select("doc_id", F.col("label").alias("actual"), "predicted", "split")
        return stage(scored, "predictions")

    def report(name: str, suffix: str, predictions: DataFrame) -> None:
        test = predictions.filter("split = 'test'")
        summaries[name] = evaluate.summary_metrics(test, classes)
        reports[f"confusion_matrix_{suffix}"] = evaluate.confusion_matrix(test, classes)
        reports[f"classification_report_{suffix}"] = evaluate.classification_report(test, classes)

    predictions = evaluated()
    report(MODEL_NAMES[options.kind], "base", predictions)
    base_name = MODEL_NAMES[options.kind]
    best = {k: str(v) for k, v in _settings(options).items()}
    if options.tune and options.kind == "random-forest":
        fitted.model, board = models.tune_forest(
            vectors, len(classes), options.space, options.n_iter, options.folds, seed=options.seed, binned=binned
        )
        reports["search_leaderboard"] = board
        best = board.first()["params"]
        predictions = evaluated()
        report("Random Forest Tuned", "tuned", predictions)
    reports["model_comparison"] = evaluate.model_comparison(summaries)
    gap = stage(evaluate.overfit_gap(predictions), "gap")
    reports["overfit_gap"] = gap
    if options.kind == "random-forest":
        terms = tfidf.frame(labelled.sparkSession)
        reports["feature_importances"] = models.feature_importances(fitted.model, terms)

    final_name = list(summaries)[-1]
    base, final = summaries[base_name].first(), summaries[final_name].first()
    metadata = model_metadata(options, classes, best, base.asDict(), final.asDict(), gap.first().asDict())
    return TrainResult(fitted, predictions, reports, metadata)


def _settings(options: TrainOptions) -> dict:
    """What the classifier is fitted with, defaults included."""
    fit = models.fit_weighted_softmax if options.kind == "softmax" else models.forest
    own = inspect.signature(fit).parameters
    defaults = {k: v.default for k, v in own.items() if v.default is not inspect.Parameter.empty and k not in ("seed", "weight")}
    return defaults | options.settings


def model_metadata(options: TrainOptions, classes: list[str], best: dict, base: dict, final: dict, gap: dict | None = None) -> dict:
    """One record that says what was trained, how, and how good it is.

    A softmax also tells its training settings and how it does on the rows it was fitted on.
    """
    record = {
        "created_at": datetime.now(timezone.utc).isoformat(),
        "model_type": options.kind,
        "classes": classes,
        "label_mapping": {c: k for k, c in enumerate(classes)},
        "best_params": best,
        "performance": {
            "base_model_accuracy": round(base["accuracy"], 4),
            "final_model_accuracy": round(final["accuracy"], 4),
            "f1_macro_final": round(final["f1_macro"], 4),
        },
        "vectorizer_config": {
            "max_features": options.max_features,
            "ngram_range": [1, 2],
            "sublinear_tf": True,
            "min_df": options.min_df,
        },
    }
    if options.kind == "softmax" and gap:
        record["training_args"] = _settings(options)
        record["performance"] |= {
            "train_accuracy": round(gap["train_accuracy"], 4),
            "test_accuracy": round(gap["test_accuracy"], 4),
            "f1_macro_test": round(final["f1_macro"], 4),
            "train_test_gap": round(gap["gap"], 4),
        }
    return record


def explore_reports(labelled: DataFrame, ts: str | None = None) -> dict[str, DataFrame]:
    """The exploration tables: classes, words, clouds and, given a time, trends."""
    out = {
        "label_distribution": explore.label_distribution(labelled),
        "class_sizes": explore.class_sizes(labelled),
        "top_words": explore.top_words(labelled),
        "cloud_terms": explore.cloud_terms(labelled),
        "cloud_terms_by_label": explore.cloud_terms(labelled, "label", 150),
        "cloud_bigrams": explore.cloud_bigrams(labelled),
    }
    if ts:
        out |= {f"trend_{g}": explore.trend(labelled, g, ts) for g in ("month", "weekday", "hour")}
    return out


def save_run(
    result: TrainResult, spark: SparkSession, model_dir: str, reports_dir: str, labelled: DataFrame | None = None, ts: str | None = None
) -> None:
    """Write the classifier with its metadata, and every report: tables, and classification reports as text too.

    Given the labelled rows, exploration tables are written as well, trends with a column of times.
    """
    result.fitted.save(spark, model_dir, result.metadata)
    explored = explore_reports(labelled, ts) if labelled is not None else {}
    for name, table in (result.reports | explored).items():
        write_report(table, f"{reports_dir}/{name}", "json" if name == "search_leaderboard" else "csv")
        if name.startswith("classification_report"):
            write_text(spark, evaluate.report_text(table), f"{reports_dir}/{name}_text")


__all__ = [
    "CLASSES",
    "FittedClassifier",
    "TrainOptions",
    "TrainResult",
    "balance",
    "build_labelled",
    "explore_reports",
    "load_classifier",
    "load_metadata",
    "save_run",
    "split_rows",
    "train",
]
