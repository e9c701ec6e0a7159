"""Linear models from sums of products.

The design has one dummy per group, a flag and a slope on the logarithm of an
order number (shared, or also per group). Its Gram matrix is one aggregated
row, so the data may be of any size; only the matrix of the model's size is
solved on the driver. Leave-one-out residuals need one more pass, in the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def design(groups: Sequence[str], group: Column, flag: Column, pick: Column, slopes: str) -> list[Column]:
    """Columns of the design; ``slopes`` is shared, own or both."""
    dummies = [(group == g).cast("double") for g in groups]
    log_pick = F.log(pick.cast("double"))
    shared, own = [log_pick], [log_pick * d for d in dummies]
    return [*dummies, flag.cast("double"), *{"shared": shared, "own": own, "both": [*shared, *own]}[slopes]]


def gram(df: DataFrame, columns: Sequence[Column], target: Column) -> tuple[np.ndarray, np.ndarray, float, float, int]:
    """(X'X, X'y, y'y, sum of y, n) by one aggregation with partial sums."""
    k = len(columns)
    x = df.select(*[c.alias(f"x{i}") for i, c in enumerate(columns)], target.cast("double").alias("y"))
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
    row = x.agg(*products, *[F.sum(F.col(f"x{i}") * F.col("y")).alias(f"b{i}") for i in range(k)], F.sum(F.col("y") * F.col("y")).alias("yy"), F.sum("y").alias("sy"), F.count("y").alias("n")).first()
    matrix = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            matrix[i, j] = matrix[j, i] = row[f"g{i}_{j}"] or 0.0
    return matrix, np.array([row[f"b{i}"] or 0.0 for i in range(k)]), row["yy"] or 0.0, row["sy"] or 0.0, row["n"]


@dataclass(frozen=True)
class Fit:
    """Coefficients, the inverse used for leverage, squared error, explained share and size of a fit."""

    coefficients: np.ndarray
    inverse: np.ndarray
    sse: float
    r2: float
    n: int


def fit(df: DataFrame, columns: Sequence[Column], target: Column, penalties: Sequence[float] | None = None) -> Fit:
    """Least squares; ``penalties`` adds a ridge per column (0 for none)."""
    xx, xy, yy, sy, n = gram(df, columns, target)
    inverse = np.linalg.pinv(xx) if penalties is None else np.linalg.inv(xx + np.diag(penalties))
    b = inverse @ xy
    sse = float(yy - 2 * b @ xy + b @ xx @ b)
    total = yy - sy * sy / n if n else 0.0
    return Fit(b, inverse, sse, 1 - sse / total if total else 0.0, n)


def nested_f(small: Fit, large: Fit) -> tuple[float, float]:
    """F statistic and p value of the columns that the larger model adds."""
    more, left = len(large.coefficients) - len(small.coefficients), large.n - len(large.coefficients)
    f = ((small.sse - large.sse) / more) / (large.sse / left)
    return f, _f_tail(f, more, left)


def _f_tail(f: float, d1: int, d2: int) -> float:
    """P(F > f), by the continued fraction of the incomplete beta function."""
    if f <= 0:
        return 1.0
    x, a, b = d2 / (d2 + d1 * f), d2 / 2, d1 / 2

    def fraction(a: float, b: float, x: float) -> float:
        tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
        d = 1 / (d if abs(d) > tiny else tiny)
        h = d
        for m in range(1, 300):
            for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1 + step * d
                d = 1 / (d if abs(d) > tiny else tiny)
                c = 1 + step / c
                c = c if abs(c) > tiny else tiny
                h *= d * c
            if abs(d * c - 1) < 1e-14:
                break
        return h

    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if 0 < x < 1 else 0.0
    if x < (a + 1) / (a + b + 2):
        return front * fraction(a, b, x) / a
    return 1 - front * fraction(b, a, 1 - x) / b


def residuals(df: DataFrame, columns: Sequence[Column], target: Column, model: Fit) -> DataFrame:
    """``df`` with ``fitted``, ``residual`` and ``loo_residual`` (residual over one minus leverage; null for a row that alone decides its own value)."""
    dot = lambda weights: sum((c * F.lit(float(w)) for c, w in zip(columns, weights, strict=True)), F.lit(0.0))
    fitted = dot(model.coefficients)
    leverage = sum((dot(model.inverse[i]) * c for i, c in enumerate(columns)), F.lit(0.0))
    out = df.withColumn("fitted", fitted).withColumn("residual", target - F.col("fitted"))
    return out.withColumn("loo_residual", F.when(1 - leverage > 1e-9, F.col("residual") / (1 - leverage)))


def rmse(column: str, where: Column | None = None) -> Column:
    """Root mean square of a residual column."""
    value = F.col(column) * F.col(column)
    return F.sqrt(F.avg(value if where is None else F.when(where, value)))
