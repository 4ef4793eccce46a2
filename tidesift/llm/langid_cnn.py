"""Language identification by a byte convolutional network, trained in numpy.

Bytes are embedded, filters of several widths run over them, the largest answer of each filter in a window goes
through a softmax. A text's languages are the mean over all its windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StringType, StructField

from tidesift.llm.textbytes import Texts, pieces, texts, with_columns

#: Bytes of a window; windows do not overlap, the last of a text is filled with byte 0.
WINDOW = 192
#: Bound on the training texts of each language; all windows of each are learnt from.
ROWS_PER_CLASS = 300
UNKNOWN = "und"


@dataclass
class Model:
    classes: list[str]
    embed: np.ndarray  # 256 x size
    filters: dict[int, np.ndarray]  # width: (width, size, filters)
    biases: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    _tables: dict[int, list[np.ndarray]] = field(default_factory=dict, repr=False)

    def tables(self) -> dict[int, list[np.ndarray]]:
        """What each byte, or pair of bytes, adds to the answers of a filter: embedding and convolution in one lookup."""
        if not self._tables:
            for width, f in self.filters.items():
                one = [(self.embed @ f[k]).astype(np.float32) for k in range(width)]
                two = [(one[k][:, None] + one[k + 1][None]).reshape(65536, -1) for k in range(0, width - 1, 2)]
                self._tables[width] = two + ([one[-1]] if width % 2 else [])
        return self._tables

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_tables": {}}


def windows(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """All windows of each text as rows of bytes, and how many each text has."""
    size = np.diff(t.bounds)
    counts = -(-size // WINDOW)
    out = np.zeros((int(counts.sum()), WINDOW), np.uint8)
    first = (np.cumsum(counts) - counts) * WINDOW
    out.reshape(-1)[np.arange(len(t.data)) + np.repeat(first - t.bounds[:-1], size)] = t.data
    return out, counts


def probabilities(model: Model, rows: np.ndarray, step: int = 256) -> np.ndarray:
    """Class probabilities of windows, some at a time so that answers stay in the cache."""
    out = np.empty((len(rows), len(model.classes)))
    for at in range(0, len(rows), step):
        part = rows[at : at + step]
        pairs = part[:, :-1].astype(np.uint16) << 8 | part[:, 1:]
        pooled = []
        for width, tables in model.tables().items():
            n = WINDOW - width + 1
            answer = tables[0][pairs[:, :n]]
            for k, table in enumerate(tables[1:], 1):
                codes = part if len(table) == 256 else pairs
                answer += table[codes[:, 2 * k : 2 * k + n]]
            pooled.append(np.maximum(answer.max(1) + model.biases[width], 0))
        logits = np.concatenate(pooled, 1) @ model.out + model.out_bias
        logits = np.exp(logits - logits.max(1, keepdims=True))
        out[at : at + step] = logits / logits.sum(1, keepdims=True)
    return out


def fit_windows(
    rows: np.ndarray, labels: np.ndarray, classes: list[str], widths: tuple[int, ...] = (2, 3, 4), size: int = 8,
    filters: int = 16, epochs: int = 4, rate: float = 4e-3, batch: int = 64, seed: int = 3,
) -> Model:
    """Trains on labelled windows by Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    shapes = {"embed": (256, size), "out": (filters * len(widths), len(classes)), "out_bias": (len(classes),)}
    for w in widths:
        shapes |= {f"f{w}": (w * size, filters), f"b{w}": (filters,)}
    p = {k: rng.normal(0, 0.3 if k == "embed" else (2 / s[0]) ** 0.5, s) if len(s) > 1 else np.zeros(s) for k, s in shapes.items()}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            x, y = rows[order[at : at + batch]], labels[order[at : at + batch]]
            n, each = len(x), np.arange(len(x))
            e = p["embed"][x]
            pooled, best = [], {}
            for w in widths:
                view = np.concatenate([e[:, k : WINDOW - w + 1 + k] for k in range(w)], 2)
                answer = view @ p[f"f{w}"]
                top = answer.argmax(1)
                best[w] = view, top
                pooled.append(np.take_along_axis(answer, top[:, None], 1)[:, 0] + p[f"b{w}"])
            h = np.concatenate(pooled, 1)
            logits = np.maximum(h, 0) @ p["out"] + p["out_bias"]
            prob = np.exp(logits - logits.max(1, keepdims=True))
            prob /= prob.sum(1, keepdims=True)
            prob[each, y] -= 1
            prob /= n
            g = {"out": np.maximum(h, 0).T @ prob, "out_bias": prob.sum(0), "embed": np.zeros_like(p["embed"])}
            back = (prob @ p["out"].T) * (h > 0)
            for i, w in enumerate(widths):
                own, (view, top) = back[:, i * filters : (i + 1) * filters], best[w]
                seen = view[each[:, None], top]  # rows x filters x (width * size)
                g[f"b{w}"] = own.sum(0)
                g[f"f{w}"] = np.einsum("nf,nfd->df", own, seen)
                to_embed = (own[:, :, None] * p[f"f{w}"].T[None]).reshape(n, filters, w, size)
                codes = x[each[:, None, None], top[:, :, None] + np.arange(w)]
                np.add.at(g["embed"], codes, to_embed)
            t += 1
            for k in p:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.001 * (g[k] ** 2 - v[k])
                p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return Model(
        classes, p["embed"], {w: p[f"f{w}"].reshape(w, size, filters) for w in widths}, {w: p[f"b{w}"] for w in widths},
        p["out"], p["out_bias"],
    )


def fit(rows: DataFrame, text: str, label: str) -> Model:
    """Trains on a bounded set of labelled rows. Rows without label or text teach nothing; none at all give no class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                found, counts = windows(texts(piece.column(text)))
                first = np.cumsum(counts) - counts
                for i, y in enumerate(piece.column(label).to_pylist()):
                    if counts[i]:
                        own = [w.tobytes() for w in found[first[i] : first[i] + counts[i]]]
                        yield pa.RecordBatch.from_pydict({"window": own, "label": [y] * len(own)})

    rows = rows.where(rows[label].isNotNull()).select(text, label)
    table = rows.mapInArrow(run, "window binary, label string").toArrow()
    seen = sorted(zip(table["window"].to_pylist(), table["label"].to_pylist(), strict=True))
    classes = sorted({y for _, y in seen})
    numbers = {y: i for i, y in enumerate(classes)}
    x = np.frombuffer(b"".join(w for w, _ in seen), np.uint8).reshape(-1, WINDOW)
    return fit_windows(x, np.array([numbers[y] for _, y in seen], int), classes)


def has_letter(column: pa.Array) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    return pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def predict(df: DataFrame, model: Model, text: str, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """The rows with the likeliest language of their whole text and its probability.

    Null texts, texts without a letter and any text under a model without classes are ``und`` with score 0. Ties go
    to the class first in order. Columns named like the new ones are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def compute(piece: pa.RecordBatch) -> list[pa.Array]:
        m: Model = shared.value
        column = piece.column(text)
        known = has_letter(column)
        if not m.classes:
            known[:] = False
            return [pa.array([UNKNOWN] * len(known)), pa.array(np.zeros(len(known)))]
        rows, counts = windows(texts(column))
        total = np.concatenate((np.zeros((1, len(m.classes))), np.cumsum(probabilities(m, rows), 0)))
        bounds = np.concatenate(([0], np.cumsum(counts)))
        mean = (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(counts, 1)[:, None]
        best = mean.argmax(1)
        names = np.where(known, np.array(m.classes, object)[best], UNKNOWN)
        scores = np.where(known, np.clip(mean[np.arange(len(best)), best], 0, 1), 0.0)
        return [pa.array(names, pa.string()), pa.array(scores)]

    return with_columns(df, text, [StructField(lang, StringType()), StructField(score, DoubleType())], compute)
