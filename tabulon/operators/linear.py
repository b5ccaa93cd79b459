"""Linear models from sums: every fold, penalty and feature subset from one pass over the rows.

A task multiplies each batch of rows with itself and leaves one matrix of sums per fold, so what is gathered is (folds x
columns x columns) numbers, whatever the rows. The training sums of a fold are the total less its own. Scaling, ordinary
and ridge solutions and the coordinate descent of the lasso need nothing else. Rows are read again only to be scored, by
all configurations and folds at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.numeric import col

FAMILIES = ("linear", "ridge", "lasso")
SCALINGS = ("standard", "minimal", "passthrough")
#: Coordinate descent ends when no coefficient moves by more than this, relative to the largest.
TOLERANCE, SWEEPS = 1e-12, 10_000


@dataclass(frozen=True)
class Moments:
    """Sums over rows of (1, x - shift, y - shift) and their products."""

    features: tuple[str, ...]
    shift: np.ndarray
    sums: np.ndarray

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.features, self.shift, self.sums - other.sums)

    @property
    def rows(self) -> int:
        return int(round(self.sums[0, 0]))

    def centred(self) -> tuple[np.ndarray, np.ndarray]:
        """Means and centred products of all columns, the label last."""
        means = self.sums[0, 1:] / self.sums[0, 0]
        return means + self.shift, self.sums[1:, 1:] - self.sums[0, 0] * np.outer(means, means)


@dataclass(frozen=True)
class Solution:
    """Coefficients of scaled features, and of features as they are."""

    features: tuple[str, ...]
    scaled: np.ndarray
    scaled_intercept: float
    weights: np.ndarray
    intercept: float


def fold_moments(df: DataFrame, features: Sequence[str], label: str, fold: str | None = None) -> dict[int, Moments]:
    """Moments of each fold (of all rows under 0 where there are no folds). Rows with a null in any of the columns are left
    out; no features or no rows give no moments."""
    names = [*features, label]
    number = (F.lit(0) if fold is None else col(fold)).cast("int").alias("_fold")
    rows = df.select(number, *[col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(names)]).dropna()
    means = rows.agg(*[F.avg(f"_x{i}") for i in range(len(names))]).first()
    if means[0] is None:
        return {}
    shift, width = np.array(means, float), len(names) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            folds = batch.column(0).to_numpy()
            z = np.stack([np.ones(len(folds)), *(batch.column(i + 1).to_numpy() - s for i, s in enumerate(shift))], 1)
            for f in np.unique(folds).tolist():
                part = z[folds == f]
                sums[f] = sums.get(f, 0) + part.T @ part
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.ravel() for s in sums.values()], pa.list_(pa.float64()))], names=["fold", "sums"])

    parts = rows.mapInArrow(run, "fold int, sums array<double>").select("fold", F.posexplode("sums").alias("at", "value"))
    out: dict[int, np.ndarray] = {}
    for r in parts.groupBy("fold", "at").agg(F.sum("value").alias("value")).collect():  # folds x columns x columns numbers
        out.setdefault(r["fold"], np.zeros((width, width)))[divmod(r["at"], width)] = r["value"]
    return {f: Moments(tuple(features), shift, s) for f, s in sorted(out.items())}


def total(moments: dict[int, Moments]) -> Moments:
    first = next(iter(moments.values()))
    return Moments(first.features, first.shift, sum(m.sums for m in moments.values()))


def solve(moments: Moments, family: str, features: Sequence[str] | None = None, *, alpha: float = 0.0, scaling: str = "standard",
          minimal_cols: Sequence[str] = ()) -> Solution:
    """The model of some of the features. `alpha` weighs the squared coefficients of the ridge against the squared errors of
    all rows, and the absolute ones of the lasso against half the mean squared error."""
    if family not in FAMILIES or scaling not in SCALINGS:
        raise ValueError(f"no solution from sums for {family!r} with scaling {scaling!r}; expected {FAMILIES} and {SCALINGS}")
    features = tuple(features or moments.features)
    at = [moments.features.index(f) for f in features]
    means, products = moments.centred()
    n = moments.sums[0, 0]
    scaled = {"standard": features, "minimal": tuple(minimal_cols), "passthrough": ()}[scaling]
    deviation = np.sqrt(np.maximum(np.diag(products)[at], 0) / n)
    scale = np.array([d if f in scaled and d > 0 else 1.0 for f, d in zip(features, deviation)])
    gram, cross = products[np.ix_(at, at)] / np.outer(scale, scale), products[at, -1] / scale
    if family == "lasso":
        w = _descend(gram / n, cross / n, alpha)
    elif family == "ridge":
        w = np.linalg.solve(gram + alpha * np.eye(len(at)), cross)
    else:
        w = np.linalg.lstsq(gram, cross, rcond=None)[0]
    centre = np.array([means[i] if f in scaled else 0.0 for f, i in zip(features, at)])
    intercept = means[-1] - (w / scale) @ means[at]
    return Solution(features, w, float(intercept + (w / scale) @ centre), w / scale, float(intercept))


def _descend(gram: np.ndarray, cross: np.ndarray, alpha: float) -> np.ndarray:
    w = np.zeros(len(cross))
    for _ in range(SWEEPS):
        moved = 0.0
        for i in range(len(w)):
            if gram[i, i] <= 0:
                continue
            rest = cross[i] - gram[i] @ w + gram[i, i] * w[i]
            new = np.sign(rest) * max(abs(rest) - alpha, 0.0) / gram[i, i]
            moved, w[i] = max(moved, abs(new - w[i])), new
        if moved <= TOLERANCE * max(1.0, np.abs(w).max()):
            break
    return w


def score(df: DataFrame, solutions: dict[tuple[str, int], Solution], row_id: str, label: str, fold: str | None = None) -> DataFrame:
    """(config, fold, row_id, label, score): each row by the solutions of its fold (of fold 0 where there are no folds)."""
    features = sorted({f for s in solutions.values() for f in s.features})
    table = [(c, k, s.intercept, [float(s.weights[s.features.index(f)]) if f in s.features else 0.0 for f in features]) for (c, k), s in solutions.items()]
    models = df.sparkSession.createDataFrame(table, "config string, _fold int, _intercept double, _weights array<double>")
    number = (F.lit(0) if fold is None else col(fold)).cast("int")
    rows = df.select(number.alias("fold"), row_id, col(label).alias("label"), F.array(*[col(f).cast("double") for f in features]).alias("_x"))
    products = F.zip_with("_x", "_weights", lambda x, w: F.when(w == 0, 0.0).otherwise(x * w))
    joined = rows.join(models, F.col("fold") == F.col("_fold"))
    return joined.select("config", "fold", row_id, "label", (F.col("_intercept") + F.aggregate(products, F.lit(0.0), lambda a, x: a + x)).alias("score"))
