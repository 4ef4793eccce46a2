"""Scoring new texts: blending, the choice of class, empty results and routing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tidesift.functions.names import free
from tidesift.functions.once import compute_once
from tidesift.functions.text import is_blank
from tidesift.operators.lexicon import CLASSES, NEUTRAL, lexicon_score, pseudo_proba
from tidesift.operators.preprocess import TextTables, preprocess, preprocess_for_scoring

# Fixed value: weight of the model against the lexicon.
BLEND = 0.5
DIGITS = 4


def argmax_class(probs: dict[str, Column]) -> Column:
    """The class of the highest probability; ties go to the first in alphabetical order."""
    names = sorted(probs)
    highest = F.greatest(*[probs[c] for c in names])
    out = F.lit(names[-1])
    for c in reversed(names[:-1]):
        out = F.when(probs[c] == highest, F.lit(c)).otherwise(out)
    return out


def blend(model: dict[str, Column], lexicon: dict[str, Column], share: float = BLEND) -> dict[str, Column]:
    return {c: model[c] * share + lexicon[c] * (1 - share) for c in model}


def _finish(
    df: DataFrame, probs: dict[str, Column], text: str, processed: str, id_col: str, keep: list[str] | None = None
) -> DataFrame:
    """Prediction columns; an empty processed text gets the empty result, and no row is dropped."""
    names = {c: f"_p_{c}" for c in CLASSES}
    blank = is_blank(F.col(text)) | is_blank(F.col(processed))
    staged = compute_once(df, {names[c]: probs[c] for c in CLASSES} | {"_empty": blank})
    columns, empty = {c: F.col(names[c]) for c in CLASSES}, F.col("_empty")
    shown = lambda c: F.when(empty, F.lit(0.0)).otherwise(F.round(c, DIGITS))
    return staged.select(
        id_col,
        F.col(text).alias("text_original"),
        F.when(empty, F.lit("")).otherwise(F.col(processed)).alias("text_preprocessed"),
        F.when(empty, F.lit(NEUTRAL)).otherwise(argmax_class(columns)).alias("sentiment"),
        shown(F.greatest(*columns.values())).alias("confidence"),
        *[shown(columns[c]).alias(f"prob_{c}") for c in CLASSES],
        *(keep or []),
    )


def score_given(
    df: DataFrame,
    probs: dict[str, Column],
    lexicon: DataFrame,
    tables: TextTables,
    text: str = "text",
    processed: str = "processed_text",
    id_col: str = "doc_id",
    lexicon_text: str = "processed",
) -> DataFrame:
    """Blend given model probabilities of preprocessed texts with the lexicon's.

    The lexicon reads the processed text, as at training time it read the light
    one; ``lexicon_text='light'`` reads that here too.
    """
    source = processed if lexicon_text == "processed" else "light_text"
    scored = lexicon_score(df, lexicon, tables.negations, source, id_col, "_lexicon_score")
    return _finish(scored, blend(probs, pseudo_proba(F.col("_lexicon_score"))), text, processed, id_col)


def _model_probs() -> dict[str, Column]:
    return {c: F.col(f"prob_{c}") for c in CLASSES}


def score_blended(df: DataFrame, fitted, lexicon: DataFrame, tables: TextTables, text: str = "text", id_col: str = "doc_id", lexicon_text: str = "processed") -> DataFrame:
    """Score raw texts by a fitted classifier and the lexicon, half each."""
    ready = preprocess_for_scoring(df, tables, text=text, id_col=id_col)
    return score_given(fitted.proba(ready), _model_probs(), lexicon, tables, text, id_col=id_col, lexicon_text=lexicon_text)


def score_plain(df: DataFrame, fitted, tables: TextTables, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Score raw texts by the classifier alone, on the text it was trained on."""
    light = fitted.text == "light_text"
    names = {"processed": None} if light else {"light": None}
    ready = preprocess(df, tables, text, id_col, filter_lang=False, **names)
    return _finish(fitted.proba(ready), _model_probs(), text, fitted.text, id_col)


def score_lexicon(
    df: DataFrame, lexicon: DataFrame, tables: TextTables, text: str = "text", id_col: str = "doc_id", negated: bool = True
) -> DataFrame:
    """Score raw texts by the lexicon alone, on the light text."""
    ready = preprocess(df, tables, text, id_col, filter_lang=False, processed=None)
    scored = lexicon_score(ready, lexicon, tables.negations if negated else None, "light_text", id_col, "_score")
    return _finish(scored, pseudo_proba(F.col("_score")), text, "light_text", id_col)


def flatten_probabilities(df: DataFrame, column: str = "probabilities", classes: list[str] = CLASSES) -> DataFrame:
    """A map of class probabilities as ``prob_<class>`` columns; row order is up to the caller."""
    return df.withColumns({f"prob_{c}": F.col(column)[c] for c in classes}).drop(column)


def prediction_summary(scored: DataFrame, id_col: str = "doc_id", width: int = 50) -> DataFrame:
    """Short text, class and confidence in percent."""
    return scored.select(
        id_col,
        F.concat(F.substring(F.coalesce("text_original", F.lit("")), 1, width), F.lit("...")).alias("text"),
        "sentiment",
        F.format_string("%.2f%%", F.col("confidence") * 100).alias("confidence"),
    )


Scorer = Callable[[DataFrame], DataFrame]

UNKNOWN_MODEL = "unknown model"
EMPTY_TEXT = "text must not be empty"


@dataclass(frozen=True)
class Route:
    """A way of scoring whose steps can be shared: by a lexicon, by a fitted classifier, or by both, half each.

    A lexicon alone, and a classifier of light texts, read the light text; the others read the processed one.
    """

    tables: TextTables
    lexicon: DataFrame | None = None
    fitted: Any = None
    negated: bool = True

    @property
    def light(self) -> bool:
        return self.fitted is None or self.fitted.text == "light_text"

    def probabilities(self, df: DataFrame, text: str, name: str) -> DataFrame:
        """Adds ``name``, a struct of class probabilities of the text in the column ``text``."""
        parts = []
        if self.fitted is not None:
            mine = self.fitted.proba(df.withColumn(self.fitted.text, F.col(text)))
            added = [c for c in mine.columns if c not in df.columns]
            df = compute_once(mine, {name: F.struct(*[F.col(f"prob_{c}").alias(c) for c in CLASSES])}).drop(*added)
            parts.append({c: F.col(name)[c] for c in CLASSES})
        if self.lexicon is not None:
            (score,) = free(df, "__lexicon")
            df = lexicon_score(df, self.lexicon, self.tables.negations if self.negated else None, text, score=score)
            parts.append(pseudo_proba(F.col(score)))
        probs = parts[0] if len(parts) == 1 else blend(*parts)
        out = compute_once(df, {name: F.struct(*[probs[c].alias(c) for c in CLASSES])})
        return out.drop(score) if self.lexicon is not None else out


def _route_once(checked: DataFrame, routes: dict[str, Route], id_col: str, text: str, model: str) -> DataFrame:
    """All models over one reading of the requests: a step that several share is done once, and a model's own
    steps see only its own texts."""
    df = checked.select(id_col, F.col(text).alias("text"), F.col(model).alias("model"), "error")
    df = compute_once(df, {"__asked": F.when(F.col("error").isNull(), F.col("text"))})
    groups: list[TextTables] = []
    for route in routes.values():
        if not any(t is route.tables for t in groups):
            groups.append(route.tables)
    for k, tables in enumerate(groups):
        own = [r for r in routes.values() if r.tables is tables]
        wanted = {"processed": f"__processed{k}" if not all(r.light for r in own) else None, "light": f"__light{k}"}
        df = preprocess(df, tables, "__asked", id_col, filter_lang=False, **wanted)
    probs, shown = F.lit(None), F.lit(None).cast("string")
    for k, (name, route) in enumerate(routes.items()):
        group = next(i for i, t in enumerate(groups) if t is route.tables)
        mine = F.col("model") == name
        df = df.withColumn(f"__text{k}", F.when(mine, F.col(f"__light{group}" if route.light else f"__processed{group}")))
        df = route.probabilities(df, f"__text{k}", f"__probs{k}")
        probs = F.when(mine, F.col(f"__probs{k}")) if k == 0 else probs.when(mine, F.col(f"__probs{k}"))
        shown = F.when(mine, F.col(f"__text{k}")) if k == 0 else shown.when(mine, F.col(f"__text{k}"))
    df = compute_once(df, {"__probs": probs, "__shown": shown})
    done = _finish(df, {c: F.col("__probs")[c] for c in CLASSES}, "text", "__shown", id_col, ["model", "error"])
    scored = [c for c in done.columns if c not in (id_col, "text_original", "model", "error")]
    return done.withColumns({c: F.when(F.col("error").isNull(), F.col(c)) for c in scored})


def route_by_model(requests: DataFrame, scorers: dict[str, Scorer | Route], id_col: str = "doc_id", text: str = "text", model: str = "model") -> DataFrame:
    """Score each request by the model it names.

    Requests that name no known model, or hold no text, come back with an
    ``error`` and no scores. Works on a stream too. ``Route`` scorers read the requests once between them; with
    functions among the scorers each branch is a filter over a reading of its own.
    """
    known = F.coalesce(F.col(model).isin(list(scorers)), F.lit(False))
    fail = F.when(~known, F.lit(UNKNOWN_MODEL)).when(is_blank(F.col(text)), F.lit(EMPTY_TEXT))
    checked = requests.withColumn("error", fail)
    if scorers and all(isinstance(s, Route) for s in scorers.values()):
        return _route_once(checked, scorers, id_col, text, model)
    parts = []
    for name, scorer in scorers.items():
        mine = checked.filter((F.col(model) == name) & F.col("error").isNull()).select(id_col, text)
        if isinstance(scorer, Route):
            asked = mine.select(id_col, F.col(text).alias(text), F.lit(name).alias(model), F.lit(None).cast("string").alias("error"))
            parts.append(_route_once(asked, {name: scorer}, id_col, text, model))
        else:
            parts.append(scorer(mine).select("*", F.lit(name).alias("model"), F.lit(None).cast("string").alias("error")))
    refused = checked.filter(F.col("error").isNotNull()).select(
        id_col, F.col(text).alias("text_original"), F.col(model).alias("model"), "error"
    )
    return reduce(DataFrame.unionByName, parts).unionByName(refused, allowMissingColumns=True)
