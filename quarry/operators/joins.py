"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``).

    Catalyst still plans it as a hash or sort-merge equi-join (null-safe
    keys are rewritten to a value plus an is-null flag), so nothing is lost
    in performance; the result has each key column once, from the left.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("join_null_safe needs at least one key")
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                           *[F.col(c) for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    out = left.join(renamed, cond, how)
    if how in ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti"):
        return out
    return out.drop(*[f"__r_{k}" for k in keys])
