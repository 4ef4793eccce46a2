"""Evaluation: every metric comes from one table of (actual, predicted) counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidesift.operators.lexicon import CLASSES

METRICS = ["accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro"]

# Headings of the comparison report.
REPORT_HEADINGS = {
    "accuracy": "Akurasi",
    "f1_macro": "F1 Macro",
    "f1_weighted": "F1 Weighted",
    "precision_macro": "Precision Macro",
    "recall_macro": "Recall Macro",
}


def _ratio(num: Column, den: Column) -> Column:
    """A quotient that is 0 where nothing was counted."""
    return F.coalesce(num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)), F.lit(0.0))


def confusion_matrix(
    df: DataFrame, classes: list[str] = CLASSES, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """A row per actual class, a column per predicted class; classes never seen have zeros.

    The rows are counted in one aggregate without a key, which the tasks fold
    into one row each; that row is then laid out as the matrix.
    """
    cells = [
        F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"c_{i}_{j}")
        for i, a in enumerate(classes)
        for j, p in enumerate(classes)
    ]
    lines = [
        F.struct(F.lit(a).alias("actual"), *[F.col(f"c_{i}_{j}").alias(p) for j, p in enumerate(classes)])
        for i, a in enumerate(classes)
    ]
    return df.agg(*cells).select(F.inline(F.array(*lines)))


def accuracy(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.agg(_ratio(F.count_if(F.col(actual) == F.col(predicted)), F.count("*")).alias("accuracy"))


def class_metrics(
    df: DataFrame, classes: list[str] = CLASSES, actual: str = "actual", predicted: str = "predicted", by: tuple[str, ...] = ()
) -> DataFrame:
    """Precision, recall, F1 and support per class."""
    pairs = df.groupBy(*by, F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    # At most classes x classes rows per group come this far.
    per_class = [
        F.struct(
            F.lit(c).alias("class"),
            total((F.col("a") == c) & (F.col("p") == c)).alias("tp"),
            total(F.col("p") == c).alias("n_predicted"),
            total(F.col("a") == c).alias("support"),
        )
        for c in classes
    ]
    counted = pairs.groupBy(*by).agg(F.array(*per_class).alias("rows")).select(*by, F.inline("rows"))
    precision = _ratio(F.col("tp"), F.col("n_predicted"))
    recall = _ratio(F.col("tp"), F.col("support"))
    # F1 = 2 tp / (predicted + support), which is 0 where the class never occurs.
    f1 = _ratio(F.col("tp") * 2, F.col("n_predicted") + F.col("support"))
    return counted.select(
        *by, "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support", "tp", "n_predicted"
    )


def _macro(metric: str) -> Column:
    """Mean over the classes that occur as actual or predicted."""
    return F.coalesce(F.avg(F.when(F.col("support") + F.col("n_predicted") > 0, F.col(metric))), F.lit(0.0))


def summary_metrics(
    df: DataFrame, classes: list[str] = CLASSES, actual: str = "actual", predicted: str = "predicted", by: tuple[str, ...] = ()
) -> DataFrame:
    """One row: accuracy, macro and weighted F1, macro precision and recall.

    Averages run over the classes that occur as actual or predicted.
    """
    rows = class_metrics(df, classes, actual, predicted, by)
    support = F.sum("support")
    return rows.groupBy(*by).agg(
        _ratio(F.sum("tp"), support).alias("accuracy"),
        _macro("f1").alias("f1_macro"),
        _ratio(F.sum(F.col("f1") * F.col("support")), support).alias("f1_weighted"),
        _macro("precision").alias("precision_macro"),
        _macro("recall").alias("recall_macro"),
    )


def classification_report(
    df: DataFrame, classes: list[str] = CLASSES, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """Per-class rows, then ``accuracy``, ``macro avg`` and ``weighted avg`` rows."""
    rows = class_metrics(df, classes, actual, predicted)
    support = F.sum("support")
    weighted = lambda c: _ratio(F.sum(F.col(c) * F.col("support")), support)
    hits = _ratio(F.sum("tp"), support)
    averages = rows.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("class"), hits.alias("precision"), hits.alias("recall"), hits.alias("f1"), support.alias("support")),
            F.struct(
                F.lit("macro avg").alias("class"),
                _macro("precision").alias("precision"),
                _macro("recall").alias("recall"),
                _macro("f1").alias("f1"),
                support.alias("support"),
            ),
            F.struct(
                F.lit("weighted avg").alias("class"),
                weighted("precision").alias("precision"),
                weighted("recall").alias("recall"),
                weighted("f1").alias("f1"),
                support.alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    return rows.drop("tp", "n_predicted").unionByName(averages)


def report_text(report: DataFrame) -> str:
    """The classification report as text; it has one row per class and three more."""
    lines = [f"{'':>14}{'precision':>11}{'recall':>11}{'f1-score':>11}{'support':>11}"]
    for r in report.collect():
        numbers = "".join(f"{r[c]:>11.2f}" for c in ("precision", "recall", "f1"))
        lines.append(f"{r['class']:>14}{numbers}{r['support']:>11}")
    return "\n".join(lines) + "\n"


def model_comparison(summaries: dict[str, DataFrame]) -> DataFrame:
    """One row per model with the metrics as four-decimal texts."""
    rows = [
        df.select(
            F.lit(name).alias("Model"),
            *[F.format_string("%.4f", F.col(m)).alias(h) for m, h in REPORT_HEADINGS.items()],
        )
        for name, df in summaries.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def metric_delta(summary: DataFrame, base: str, tuned: str, model: str = "model", metric: str = "accuracy") -> DataFrame:
    """Metric of the tuned model less that of the base model."""
    value = lambda name: F.max(F.when(F.col(model) == name, F.col(metric)))
    return summary.agg((value(tuned) - value(base)).alias("delta"))


def overfit_gap(df: DataFrame, actual: str = "actual", predicted: str = "predicted", split: str = "split") -> DataFrame:
    """Train accuracy less test accuracy, and how bad that is."""
    share = lambda part: _ratio(
        F.count_if((F.col(split) == part) & (F.col(actual) == F.col(predicted))), F.count_if(F.col(split) == part)
    )
    accuracies = df.agg(share("train").alias("train_accuracy"), share("test").alias("test_accuracy"))
    gap = F.col("train_accuracy") - F.col("test_accuracy")
    # Bounds of the bands.
    band = F.when(gap > 0.10, "overfitting").when(gap > 0.05, "slight overfitting").otherwise("good")
    return accuracies.select("train_accuracy", "test_accuracy", gap.alias("gap"), band.alias("band"))


def verify_expected(
    predicted: DataFrame, expected: DataFrame, id_col: str = "doc_id", label: str = "sentiment", overall: bool = False
) -> DataFrame:
    """PASSED or FAILED per expected row, or one row over all; a missing prediction fails."""
    joined = expected.select(id_col, "expected").join(predicted.select(id_col, F.col(label).alias("predicted")), id_col, "left")
    ok = F.coalesce(F.col("expected") == F.col("predicted"), F.lit(False))
    rows = joined.withColumn("status", F.when(ok, "PASSED").otherwise("FAILED"))
    if not overall:
        return rows
    return rows.agg(
        F.count("*").alias("checked"),
        F.count_if(F.col("status") == "PASSED").alias("passed"),
        F.bool_and(F.col("status") == "PASSED").alias("all_passed"),
    )


def select_best_candidate(board: DataFrame, metric: str = "f1_macro", name: str = "model") -> DataFrame:
    """The candidate with the highest metric; ties go to the first name."""
    return board.orderBy(F.desc(metric), name).limit(1)
