"""Weighted ridge regression by normal equations: one aggregate over the rows, a small solve on the driver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ONE = "intercept"


@dataclass(frozen=True)
class RidgeFit:
    """`coefficients` by column; the intercept is not penalised."""

    coefficients: dict[str, float]
    intercept: float

    def score(self) -> Column:
        terms = [F.col(c) * F.lit(b) for c, b in self.coefficients.items()]
        return reduce(Column.__add__, terms, F.lit(self.intercept))


def cross_products(df: DataFrame, columns: Sequence[str], label: str, weight: str | None = None) -> DataFrame:
    """(left, right, total): weighted sums of products of all pairs among the columns, a constant and the label.

    One pass and one row of partial sums per task, whatever the number of rows. Rows with a missing value in any of
    the columns, the label or the weight do not count. The constant with itself gives the sum of weights.
    """
    names = [ONE, *columns, label]
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    value = {ONE: F.lit(1.0)} | {c: F.col(c).cast("double") for c in [*columns, label]}
    known = reduce(Column.__and__, [v.isNotNull() for v in [*value.values(), w]])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = [F.coalesce(F.sum(w * value[a] * value[b]), F.lit(0.0)) for a, b in pairs]
    found = df.filter(known).agg(F.array(*sums).alias("sums"))
    rows = F.array(*[F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.get("sums", F.lit(i)).alias("total")) for i, (a, b) in enumerate(pairs)])
    return found.select(F.inline(rows))


def solve(products: DataFrame, columns: Sequence[str], label: str, penalty: float = 1.0) -> RidgeFit:
    """Minimum of the weighted squared error plus `penalty` times the squared coefficients, by Cholesky.

    `products` has a row per pair of columns. Columns that are constant (or doubled, without a penalty) get what the
    penalty leaves them; without any weight all is zero.
    """
    total = {(r["left"], r["right"]): r["total"] for r in products.collect()}
    total |= {(b, a): v for (a, b), v in total.items()}
    weights = total[ONE, ONE]
    if not weights:
        return RidgeFit(dict.fromkeys(columns, 0.0), 0.0)
    means = np.array([total[ONE, c] / weights for c in columns])
    mean = total[ONE, label] / weights
    gram = np.array([[total[a, b] for b in columns] for a in columns]).reshape(len(columns), len(columns))
    centred = gram - weights * np.outer(means, means) + penalty * np.eye(len(columns))
    right = np.array([total[c, label] for c in columns]) - weights * means * mean
    scale = np.sqrt(np.maximum(np.diag(centred), 1e-300))  # equal diagonals before the factorisation
    lower = np.linalg.cholesky(centred / np.outer(scale, scale) + 1e-14 * np.eye(len(columns)))
    beta = np.linalg.solve(lower.T, np.linalg.solve(lower, right / scale)) / scale
    return RidgeFit({c: float(b) for c, b in zip(columns, beta)}, float(mean - means @ beta))


def fit(df: DataFrame, columns: Sequence[str], label: str, weight: str | None = None, penalty: float = 1.0) -> RidgeFit:
    return solve(cross_products(df, columns, label, weight), columns, label, penalty)
