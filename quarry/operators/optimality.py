"""Whether fitted generalised linear models are at their optimum, from one pass.

The derivative of a model's penalised likelihood is a sum of products of the
residual and the features; with the moments of both, the optimality conditions
of every coefficient are checked on a small table:

* the intercept is not penalised: predictions add up to labels;
* squared penalty: a coefficient's derivative balances strength times coefficient;
* absolute penalty: the derivative balances the strength where the coefficient is
  not 0 and does not exceed it where it is.

Logistic models are penalised in units of the features' deviations and per row,
the Poisson model in the features' own units and per expected count, as their
estimators document.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.moments import moments


class Residual(NamedTuple):
    n: int
    sum_label: float
    sum_predicted: float
    #: Largest violation of the conditions, in label units per row and feature deviation.
    worst: float


def _violation(gradient: np.ndarray, coefficients: np.ndarray, reg: float, alpha: float) -> np.ndarray:
    ridge = gradient + reg * (1 - alpha) * coefficients
    pulled = np.abs(ridge + reg * alpha * np.sign(coefficients))
    return np.where((coefficients == 0) & (alpha > 0), np.maximum(np.abs(ridge) - reg * alpha, 0.0), pulled)


class Fitted(NamedTuple):
    """A fitted model: its label and predicted mean as columns, coefficients and penalty."""

    label: Column
    mean: Column
    coefficients: Sequence[float]
    reg: float
    alpha: float
    family: str


def residuals(scored: DataFrame, x: Column, fits: Sequence[Fitted]) -> list[Residual]:
    """The conditions of models fitted on the same rows, from one pass of moments over these."""
    columns = [c for f in fits for c in (f.label.cast("double"), f.mean - f.label)]
    m = moments(scored, F.concat(x, F.array(*columns[:-1])), columns[-1])["all"]
    width = len(m.mean) - len(columns)
    deviation = np.sqrt(np.diag(m.products)[:width] / max(m.n - 1, 1))
    scale = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)
    out = []
    for i, fit in enumerate(fits):
        label, off = width + 2 * i, width + 2 * i + 1
        w = np.array(fit.coefficients, float)
        sum_label = m.mean[label] * m.n
        sum_predicted = sum_label + m.mean[off] * m.n
        # Sums of residual times feature, from centred products and means.
        sums = m.products[:width, off] + m.n * m.mean[:width] * m.mean[off]
        if fit.family == "poisson":
            worst = _violation(sums / sum_predicted, w, fit.reg, fit.alpha) * scale * sum_predicted / m.n
        else:
            worst = _violation(sums / m.n * scale, w * deviation, fit.reg, fit.alpha)
        out.append(Residual(m.n, float(sum_label), float(sum_predicted), float(max([abs(m.mean[off]), *worst]))))
    return out


def residual(scored: DataFrame, x: Column, y: Column, mean: Column, coefficients: Sequence[float], reg: float,
             alpha: float, family: str) -> Residual:
    """The conditions of a fitted model on its training rows; ``mean`` is the predicted mean."""
    return residuals(scored, x, [Fitted(y, mean, coefficients, reg, alpha, family)])[0]
