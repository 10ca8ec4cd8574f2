"""Linear models from moments: one scan serves every penalty and fold.

The sums of products of features and label, about a fixed shift, are
added up per fold in the tasks (Arrow batches, one matrix product each)
and then per entry across tasks; (features + 1)^2 numbers per fold come
to the driver. Moments of several folds add up, so a training set is the
total less its fold, and a validation error follows from the fold's own
moments without another scan.

Objectives, on features scaled by mean and population deviation:
ordinary least squares (the least solution where features are
collinear), ridge ``|y - Xw|^2 + alpha |w|^2``, and elastic net
``|y - Xw|^2 / 2n + alpha (l1_ratio |w|_1 + (1 - l1_ratio) |w|^2 / 2)``.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANK_TOLERANCE = 1e-10
SWEEPS = 20_000


@dataclass(frozen=True)
class LinearSpec:
    """ols, ridge (alpha), or net (alpha, l1_ratio)."""

    kind: str = "ols"
    alpha: float = 0.0
    l1_ratio: float = 0.0


@dataclass(frozen=True)
class Moments:
    """n, and the sums and sums of products of the variables less ``shift``; the label is the last."""

    n: int
    sums: np.ndarray
    products: np.ndarray
    shift: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.sums + other.sums, self.products + other.products, self.shift)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.sums - other.sums, self.products - other.products, self.shift)

    @property
    def mean(self) -> np.ndarray:
        return self.shift + self.sums / self.n

    @property
    def centred(self) -> np.ndarray:
        return self.products - np.outer(self.sums, self.sums) / self.n


def fold_moments(df: DataFrame, features: Sequence[str], label: str, fold: str | None = None) -> dict[int, Moments]:
    """The moments of each fold (0 without a fold column); a NULL, NaN or infinite value is an error.

    The shift is the first row: it only has to be near the data.
    """
    names = [*features, label]
    p = len(names)
    rows = df.select((F.lit(0) if fold is None else F.col(fold)).cast("long").alias("fold"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    first = rows.first()
    if first is None:
        return {}
    shift = np.array([v if v is not None and math.isfinite(v) else 0.0 for v in first[1:]])
    upper = np.triu_indices(p)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]])
            if not np.isfinite(x).all():
                raise ValueError("a feature or label is NULL, NaN or infinite: impute or reject such rows first")
            for f in np.unique(at):
                z = x[at == f] - shift
                own = np.concatenate([[len(z)], z.sum(0), (z.T @ z)[upper]])
                totals[int(f)] = totals.get(int(f), 0) + own
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array([t.tolist() for t in totals.values()], pa.list_(pa.float64()))], names=["fold", "v"])

    parts = rows.mapInArrow(add, "fold long, v array<double>").select("fold", F.posexplode("v").alias("at", "v"))
    out: dict[int, np.ndarray] = {}
    for r in parts.groupBy("fold", "at").agg(F.sum("v").alias("v")).collect():  # folds x (p + 1)(p + 2) / 2 numbers
        out.setdefault(r["fold"], np.zeros(1 + p + len(upper[0])))[r["at"]] = r["v"]
    found = {}
    for f, v in sorted(out.items()):
        products = np.zeros((p, p))
        products[upper] = v[1 + p:]
        found[f] = Moments(int(v[0]), v[1:1 + p], products + np.triu(products, 1).T, shift)
    return found


def total(folds: dict[int, Moments]) -> Moments:
    every = list(folds.values())
    return sum(every[1:], every[0])


@dataclass(frozen=True)
class LinearFit:
    """Coefficients of raw features and of scaled ones."""

    features: tuple[str, ...]
    intercept: float
    coefficients: np.ndarray
    scaled: np.ndarray

    def mse(self, m: Moments) -> float:
        """Mean squared error over the rows whose moments these are."""
        w = np.append(-self.coefficients, 1.0)
        mean = float(w @ m.mean) - self.intercept
        return max(float(w @ m.centred @ w) / m.n, 0.0) + mean * mean

    def pipeline(self) -> PipelineModel:
        """An assembler and Spark's linear regression model with these coefficients; saves and loads as any pipeline model."""
        context = SparkContext.getOrCreate()
        assembler = VectorAssembler(inputCols=list(self.features), outputCol="raw_features", handleInvalid="error")
        made = context._jvm.org.apache.spark.ml.regression.LinearRegressionModel(f"linear-{uuid.uuid4().hex[:12]}", _py2java(context, Vectors.dense(self.coefficients)), self.intercept)
        model = PipelineModel([assembler, LinearRegressionModel(made).setFeaturesCol("raw_features")])
        model.linear = self
        return model


def scaled_system(m: Moments, ddof: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Deviations, X'X / n and X'y / n of the scaled features (a constant one has deviation 1 and zeros)."""
    c = m.centred
    spread = np.diag(c)[:-1] / max(m.n - ddof, 1)
    # what rounding leaves of a constant's square is no spread
    constant = spread <= 1e-14 * (np.diag(m.products)[:-1] / m.n + 1e-300)
    s = np.where(constant, 1.0, np.sqrt(np.where(constant, 1.0, spread)))
    a, b = c[:-1, :-1] / np.outer(s, s) / m.n, c[:-1, -1] / s / m.n
    a[constant], a[:, constant], b[constant] = 0.0, 0.0, 0.0
    return s, a, b


def violation(a: np.ndarray, b: np.ndarray, w: np.ndarray, l1: float, l2: float) -> float:
    """How far w is from meeting the optimality conditions of the objective."""
    g = a @ w - b + l2 * w
    return float(np.where(w != 0, np.abs(g + l1 * np.sign(w)), np.maximum(np.abs(g) - l1, 0)).max(initial=0.0))


def coordinate_descent(a: np.ndarray, b: np.ndarray, l1: float, l2: float, sweeps: int = SWEEPS) -> np.ndarray:
    """Least of w'Aw / 2 - b'w + l1 |w|_1 + l2 |w|^2 / 2.

    Now and then w goes towards the solution of the equations of the non-zero
    coefficients, as far as no sign changes; a coefficient that gets to 0 leaves
    them. Where columns depend on each other they may have no solution: then w
    moves along the direction that leaves the fit alone and shrinks |w|_1. Every
    move lowers the objective (sweeps alone creep).
    """
    w, d = np.zeros(len(b)), np.diag(a) + l2
    goal = 1e-12 * max(1.0, np.abs(b).max(initial=0.0))
    order = [j for j in range(len(b)) if d[j] > 0]
    for sweep in range(sweeps):
        for j in order:
            r = b[j] - a[j] @ w + a[j, j] * w[j]
            w[j] = math.copysign(max(abs(r) - l1, 0.0), r) / d[j]
        if sweep % 20 == 19 or sweep + 1 == sweeps:
            if violation(a, b, w, l1, l2) <= goal:
                break
            while (own := np.flatnonzero(w)).size:
                system, rhs = a[np.ix_(own, own)] + l2 * np.eye(len(own)), b[own] - l1 * np.sign(w[own])
                size, vectors = np.linalg.eigh(system)
                full = size > RANK_TOLERANCE * size.max()
                left = vectors[:, ~full] @ (vectors[:, ~full].T @ rhs)
                endless = np.abs(left).max() > max(1e-6 * l1, 10 * goal)
                if not endless:
                    left = (vectors[:, full] / size[full]) @ (vectors[:, full].T @ (rhs - system @ w[own]))
                crossing = left * w[own] < 0
                reach = np.where(crossing, -w[own] / np.where(crossing, left, 1.0), np.inf)
                if reach.min() >= 1 and not endless:
                    w[own] += left
                    break
                if not np.isfinite(reach.min()):
                    break
                w[own] += reach.min() * left
                w[own[reach.argmin()]] = 0.0
            if violation(a, b, w, l1, l2) <= goal:
                break
    return w


def fit(m: Moments, spec: LinearSpec, features: Sequence[str], ddof: int = 0) -> LinearFit:
    s, a, b = scaled_system(m, ddof)
    if spec.kind == "ols":
        w = np.linalg.pinv(a, rcond=RANK_TOLERANCE, hermitian=True) @ b
    elif spec.kind == "ridge":
        w = np.linalg.solve(a + spec.alpha / m.n * np.eye(len(b)) + np.diag(np.diag(a) == 0), b) if spec.alpha else np.linalg.pinv(a, rcond=RANK_TOLERANCE, hermitian=True) @ b
    else:
        w = coordinate_descent(a, b, spec.alpha * spec.l1_ratio, spec.alpha * (1 - spec.l1_ratio))
    raw = w / s
    mean = m.mean
    return LinearFit(tuple(features), float(mean[-1] - raw @ mean[:-1]), raw, w)


def cross_validated(folds: dict[int, Moments], spec: LinearSpec, features: Sequence[str]) -> dict[int, float]:
    """fold -> mean squared error of the model fitted on the others."""
    every = total(folds)
    return {f: fit(every - own, spec, features).mse(own) for f, own in folds.items()}
