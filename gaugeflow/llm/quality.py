"""Quality of texts by regularised quadratic discriminant analysis.

Every text becomes a vector of statistics, transformed so that each is roughly normal. A class is a
normal distribution; its covariance is shrunk towards the diagonal of the pooled one, and factored
once. The score is the posterior that the two log densities and the class sizes give.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SYMBOLS = "#*$%&|<>{}[]\\~^=@_+"
_PUNCTUATION = ".,;:!?'\"()-"
_CLASSES = ("letter", "upper", "digit", "symbol", "punctuation", "space", "other")

#: The statistics, each already transformed.
STATISTICS = (
    "log_words",
    "log_lines",
    "mean_word",
    "spread_word",
    "upper",
    "digit",
    "symbol",
    "punctuation",
    "exclamation",
    "other",
    "distinct",
    "top_word",
    "same_next",
    "bare_symbol",
    "marked_word",
    "same_line",
    "line_words",
    "log_longest",
)


@cache
def _class_of() -> np.ndarray:
    """The class of a code point below 0x20000; those above are ``other``."""

    def of(c: str) -> str:
        if c.isalpha():
            return "upper" if c.isupper() else "letter"
        if c.isdigit():
            return "digit"
        if c.isspace():
            return "space"
        return "symbol" if c in _SYMBOLS else "punctuation" if c in _PUNCTUATION else "other"

    return np.array([_CLASSES.index(of(chr(c))) for c in range(0x20000)])



def statistics(text: str | None) -> list[float]:
    """The values of :data:`STATISTICS`; a null text is an empty one."""
    text = text or ""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _class_of()[np.minimum(codes, 0x1FFFF)]
    n = dict(zip(_CLASSES, np.bincount(kinds, minlength=len(_CLASSES)).tolist(), strict=True))
    shown = len(text) - n["space"]
    words = text.split()
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    count = len(words)

    def rate(part: float, whole: float) -> float:
        """Square root of a share: the spread of a small share is about constant then."""
        return math.sqrt(part / whole) if whole else 0.0

    return [
        math.log1p(count),
        math.log1p(len(lines)),
        math.log1p(float(lengths.mean())),
        math.log1p(float(lengths.std())),
        rate(n["upper"], shown),
        rate(n["digit"], shown),
        rate(n["symbol"], shown),
        rate(n["punctuation"], shown),
        rate(text.count("!"), shown),
        rate(n["other"], shown),
        rate(len(counts), count),
        rate(max(counts.values(), default=0), count),
        rate(sum(map(str.__eq__, words, words[1:])), count),
        rate(sum(len(w) == 1 and not w.isalnum() for w in words), count),
        rate(sum(not w.isalnum() for w in words), count),
        rate(len(lines) - len(set(lines)), len(lines)),
        math.log1p(count / max(len(lines), 1)),
        math.log1p(float(lengths.max())),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the ``x`` of every ``text``.

    Null and empty texts have the statistics of no words. Every row is measured by itself, repeated ones
    and those with repeated or null ``doc_id`` too; other columns are not read, and an empty table gives
    an empty one.
    """

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "x": pa.array(x, pa.list_(pa.float64()))}
            )

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(measured, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Per class: log of its share, mean, inverse Cholesky factor and its log determinant."""

    log_prior: np.ndarray
    means: np.ndarray
    whiten: np.ndarray
    log_det: np.ndarray
    temperature: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        """Log density of every row of ``x`` in every class, up to a constant."""
        out = np.empty((len(x), len(self.means)))
        for k, (mean, whiten) in enumerate(zip(self.means, self.whiten, strict=True)):
            out[:, k] = self.log_det[k] - 0.5 * (((x - mean) @ whiten.T) ** 2).sum(axis=1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1."""
        both = self.log_density(x) / self.temperature + self.log_prior
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(both[:, 0] - both[:, 1]))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of 1, x and x x' per class, one row per class and cell, of a partition."""
    size = len(STATISTICS) + 1
    total = np.zeros((2, size, size))
    for batch in batches:
        x = np.array(batch.column("x").to_pylist()).reshape(-1, size - 1)
        x = np.c_[np.ones(len(x)), x]
        label = batch.column("label").to_numpy(zero_copy_only=False)
        for k in (0, 1):
            total[k] += x[label == k].T @ x[label == k]
    k, i, j = np.indices(total.shape)
    yield pa.RecordBatch.from_pydict(
        {"k": k.ravel(), "i": i.ravel(), "j": j.ravel(), "value": total.ravel()}
    )


def fit(measured: DataFrame, shrink: float = 0.1, temperature: float = 3.0) -> Discriminant | None:
    """The discriminant of ``x`` and ``label`` (0 or 1); None unless both classes have two rows.

    Rows with another or a null label teach nothing, equal rows count each; an empty table gives None.

    A class covariance is ``1 - shrink`` times its own and ``shrink`` times the diagonal of the
    pooled one. Log densities are divided by ``temperature``, as statistics that depend on each other
    make them too sure.
    """
    rows = measured.where("label IN (0, 1)").select(F.col("label").cast("int"), "x")
    cells = rows.mapInArrow(_moments, "k long, i long, j long, value double")
    size = len(STATISTICS) + 1
    total = np.zeros((2, size, size))
    for r in cells.groupBy("k", "i", "j").agg(F.sum("value").alias("value")).collect():
        total[r["k"], r["i"], r["j"]] = r["value"]  # two squares of the statistics' number
    n = total[:, 0, 0]
    if n.min() < 2:
        return None
    means = total[:, 0, 1:] / n[:, None]
    own = np.stack([t[1:, 1:] / c - np.outer(m, m) for t, c, m in zip(total, n, means, strict=True)])
    pooled = np.einsum("k,kii->i", n / n.sum(), own)
    mean = (n / n.sum()) @ means
    pooled += (n / n.sum()) @ (means - mean) ** 2
    spread = np.diag(np.maximum(pooled, 1e-6))
    whiten, log_det = [], []
    for covariance in own:
        factor = np.linalg.cholesky((1 - shrink) * covariance + shrink * spread)
        whiten.append(np.linalg.inv(factor))
        log_det.append(-np.log(np.diag(factor)).sum())
    return Discriminant(
        np.log(n / n.sum()), means, np.stack(whiten), np.array(log_det), temperature
    )


def predict(measured: DataFrame, model: Discriminant | None, threshold: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted`` of every row; without a model all scores are 0.5.

    Repeated rows and repeated or null ``doc_id`` are scored each; other columns are not read, and an
    empty table gives an empty one.
    """
    held = measured.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist()).reshape(-1, len(STATISTICS))
            score = held.value.score(x) if held.value else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "score": score,
                    "predicted": (score >= threshold).astype(np.int32),
                }
            )

    return measured.select("doc_id", "x").mapInArrow(
        scored, "doc_id long, score double, predicted int"
    )
