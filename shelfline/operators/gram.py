"""Linear models from additive statistics of the rows.

One pass gives, for every part of the rows, the matrix of sums of products of (1, features, target). Such matrices add
up, so any union of parts (all folds but one, the first sizes of a learning curve) is fitted and evaluated from sums of
them on the driver, whose work depends on the number of features only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A feature of which less than this share is not explained by the features before it gets no coefficient.
ALIASED = 1e-9
SWEEPS = 500


@dataclass
class Gram:
    """Sums of products of (1, features, target)."""

    m: np.ndarray

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.m + other.m)

    @staticmethod
    def total(parts: Iterable[Gram]) -> Gram:
        return Gram(sum(p.m for p in parts))

    @property
    def rows(self) -> int:
        return int(round(self.m[0, 0]))

    def centred(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Centred products of the features, those with the target, and the means of both."""
        n, means = self.m[0, 0], self.m[0, 1:] / self.m[0, 0]
        s = self.m[1:, 1:] - n * np.outer(means, means)
        return s[:-1, :-1], s[:-1, -1], means[:-1], float(means[-1])

    def rmse(self, fit: LinearFit) -> float:
        v = np.r_[-fit.intercept, -fit.coefficients, 1.0]
        return float(np.sqrt(max(v @ self.m @ v, 0) / self.m[0, 0]))


@dataclass
class LinearFit:
    name: str
    intercept: float
    coefficients: np.ndarray


def gram_parts(rows: DataFrame, part: str, features: str, target: str, width: int) -> dict[int, Gram]:
    """The matrix of every value of ``part``; ``features`` is an array of ``width`` doubles. Empty parts have none."""
    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            which, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            a = np.column_stack([np.ones(len(y)), x, y])
            for k in np.unique(which):
                own = a[which == k]
                sums[int(k)] = sums.get(int(k), 0) + own.T @ own
        for k, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, k)), pa.array(np.arange(m.size)), pa.array(m.ravel())], names=["part", "at", "value"])

    chosen = rows.select(F.col(part).cast("long"), F.col(features), F.col(target).cast("double"))
    summed = chosen.mapInArrow(partial_sums, "part long, at long, value double").groupBy("part", "at").agg(F.sum("value").alias("value"))
    out: dict[int, Gram] = {}
    for r in summed.collect():
        out.setdefault(r.part, Gram(np.zeros((width + 2, width + 2)))).m.flat[r["at"]] = r.value
    return out


def least_squares(g: Gram, name: str = "LinearRegression", alpha: float = 0.0) -> LinearFit:
    """Least squares with penalty ``alpha`` times the squared coefficients; aliased features get 0."""
    s, c, mean_x, mean_y = g.centred()
    k = len(c)
    a = np.column_stack([s + alpha * np.eye(k), c])
    least = ALIASED * a.diagonal()
    for i in range(k):
        if a[i, i] <= least[i]:
            a[i, :] = a[:, i] = 0
            continue
        a[i] /= a[i, i]
        others = np.arange(k) != i
        a[others] -= np.outer(a[others, i], a[i])
    return LinearFit(name, mean_y - float(a[:, -1] @ mean_x), a[:, -1])


def lasso(g: Gram, alpha: float, name: str = "Lasso", sweeps: int = SWEEPS) -> LinearFit:
    """Half the mean squared error plus ``alpha`` times the absolute coefficients, by cyclic coordinate descent."""
    s, c, mean_x, mean_y = g.centred()
    b, limit = np.zeros(len(c)), alpha * g.m[0, 0]
    for _ in range(sweeps):
        for j in range(len(c)):
            if s[j, j] > 0:
                rest = c[j] - s[j] @ b + s[j, j] * b[j]
                b[j] = np.sign(rest) * max(abs(rest) - limit, 0) / s[j, j]
    return LinearFit(name, mean_y - float(b @ mean_x), b)


def linear_models(ridge_alpha: float, lasso_alpha: float) -> dict:
    """The fitting function of each linear model, by name."""
    return {"LinearRegression": lambda g: least_squares(g), "Ridge": lambda g: least_squares(g, "Ridge", ridge_alpha),
            "Lasso": lambda g: lasso(g, lasso_alpha)}


def fold_scores(parts: dict[int, Gram], fit, folds: Iterable[int]) -> list[float]:
    """RMSE on each fold of the model fitted on the others."""
    folds = list(folds)
    return [parts[k].rmse(fit(Gram.total(parts[j] for j in folds if j != k))) for k in folds]


def as_column(fit: LinearFit, names: list[str], means: Iterable[float], deviations: Iterable[float]) -> Column:
    """The fitted model on unscaled feature columns as one expression."""
    out = F.lit(float(fit.intercept))
    for name, b, m, s in zip(names, fit.coefficients, means, deviations):
        if b and s:
            out = out + (F.col(name) - F.lit(float(m))) * F.lit(float(b / s))
    return out
