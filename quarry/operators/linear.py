"""Regularisation paths of linear regression from one pass over the rows.

All strengths, and the errors on every part of a split, follow from the moments
of features and label: the penalised normal equations are solved for each
strength on the small matrix, and the squared error of any coefficients is a
quadratic form in it.  The scaling is that of ``LinearRegression``: features and
label are divided by their deviations, the strength by the label's.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.moments import Moments, moments

#: Coordinate descent stops when no coefficient moves by more than this (standardised).
TOLERANCE, MAX_SWEEPS = 1e-13, 100_000


class Fit(NamedTuple):
    reg_param: float
    coefficients: np.ndarray
    intercept: float

    def rmse(self, m: Moments) -> float:
        """Root mean squared error on the rows with moments ``m``."""
        w = np.append(-self.coefficients, 1.0)  # the residual is w . (x, y) - intercept
        centre = w @ m.mean - self.intercept
        return float(np.sqrt(max(w @ m.products @ w, 0.0) / m.n + centre * centre))


def solve(corr: np.ndarray, target: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """Minimise ``w'Cw / 2 - w'c + l1 |w| + l2 |w|^2 / 2`` (columns with C_jj = 0 stay 0)."""
    used = np.diag(corr) > 0
    w = np.zeros(len(target))
    if not l1:
        a = corr[np.ix_(used, used)] + l2 * np.eye(used.sum())
        w[used] = np.linalg.lstsq(a, target[used], rcond=None)[0]
        return w
    active = np.flatnonzero(used)
    for _ in range(MAX_SWEEPS):
        moved = 0.0
        for j in active:
            rest = target[j] - corr[j] @ w + corr[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (corr[j, j] + l2)
            moved, w[j] = max(moved, abs(new - w[j])), new
        if moved <= TOLERANCE:
            break
    return w


def path(m: Moments, reg_params: Sequence[float], alpha: float) -> list[Fit]:
    """One fit per strength; ``alpha`` mixes the penalties (1 = lasso, 0 = ridge)."""
    deviation = np.sqrt(np.diag(m.products) / m.n)
    sx, sy = deviation[:-1], deviation[-1]
    inverse = np.divide(1.0, sx, out=np.zeros_like(sx), where=sx > 0)
    out = []
    for reg in reg_params:
        if sy == 0:
            coefficients = np.zeros(len(sx))
        else:
            corr = m.products[:-1, :-1] / m.n * inverse[:, None] * inverse
            target = m.products[:-1, -1] / m.n * inverse / sy
            strength = float(reg) / sy
            coefficients = solve(corr, target, alpha * strength, (1 - alpha) * strength) * inverse * sy
        out.append(Fit(float(reg), coefficients, float(m.mean[-1] - coefficients @ m.mean[:-1])))
    return out


def one_feature_paths(spark: SparkSession, df: DataFrame, x: str, y: str, alpha: float,
                      reg_params: Sequence[float]) -> DataFrame:
    """Slope and intercept of ``y ~ x`` for each regularisation strength, from one scan."""
    found = moments(df, F.array(F.col(x).cast("double")), F.col(y))["all"]
    rows = [(f.reg_param, float(f.coefficients[0]), f.intercept) for f in path(found, reg_params, alpha)]
    return spark.createDataFrame(rows, "reg_param double, slope double, intercept double")
