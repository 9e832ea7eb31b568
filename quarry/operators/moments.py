"""Counts, means and products of a feature vector and a label, in one pass.

Every task adds up its rows around their own mean; the partial sums of all
tasks are merged pairwise by the rule for combining centred products, in two
steps, so nothing loses digits to large means and no task merges all of them.
The result is one small matrix per group (at most ``MAX_WIDTH`` columns).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_WIDTH, SALTS, ROWS = 4096, 64, 1 << 21
SCHEMA = "grp string, n long, mean array<double>, products array<double>"


class Moments(NamedTuple):
    """Of the columns x1..xd, y: rows, means and centred sums of products."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    def merge(self, other: Moments) -> Moments:
        n = self.n + other.n
        shift = other.mean - self.mean
        return Moments(n, self.mean + shift * (other.n / n),
                       self.products + other.products + np.outer(shift, shift) * (self.n * other.n / n))


def _write(found: dict[str | None, Moments]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.string()), pa.array([m.n for m in found.values()], pa.int64()),
         pa.array([m.mean for m in found.values()], pa.list_(pa.float64())),
         pa.array([m.products.ravel() for m in found.values()], pa.list_(pa.float64()))],
        names=["grp", "n", "mean", "products"])


def _add(found: dict, group: str | None, part: Moments) -> None:
    found[group] = found[group].merge(part) if group in found else part


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str | None, Moments] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.list_value_length(batch["x"])
        width = lengths[0].as_py()
        if pc.any(pc.not_equal(lengths, width)).as_py() or lengths.null_count:
            raise ValueError("feature vectors differ in length or are NULL")
        step = max(1, ROWS // (width + 1))
        for first in range(0, batch.num_rows, step):
            part = batch.slice(first, step)
            rows = np.column_stack([part["x"].flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width),
                                    part["y"].to_numpy(zero_copy_only=False)])
            if not np.isfinite(rows).all():
                raise ValueError("a feature or label is NULL, NaN or infinite")
            groups = part["grp"].dictionary_encode(null_encoding="encode")
            codes = groups.indices.to_numpy(zero_copy_only=False)
            for code, group in enumerate(groups.dictionary.to_pylist()):
                own = rows[codes == code]
                mean = own.mean(axis=0)
                own = own - mean
                _add(found, group, Moments(len(own), mean, own.T @ own))
    if found:
        yield _write(found)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str | None, Moments] = {}
    for batch in batches:
        for group, n, mean, products in zip(*(batch[c] for c in ("grp", "n", "mean", "products"))):
            mean = mean.values.to_numpy()
            _add(found, group.as_py(), Moments(n.as_py(), mean, products.values.to_numpy().reshape(len(mean), -1)))
    if found:
        yield _write(found)


def moments(df: DataFrame, x: Column, y: Column, by: Column | None = None) -> dict[str | None, Moments]:
    """Moments of array ``x`` and label ``y`` for each value of the string column ``by`` (few values)."""
    rows = df.select((F.lit("all") if by is None else by).alias("grp"), x.alias("x"), y.cast("double").alias("y"))
    parts = rows.mapInArrow(_measure, SCHEMA)
    parts = parts.withColumn("salt", F.spark_partition_id() % SALTS).repartition("grp", "salt").drop("salt")
    merged = parts.mapInArrow(_merge, SCHEMA).repartition("grp").mapInArrow(_merge, SCHEMA)
    return {r["grp"]: Moments(r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(len(r["mean"]), -1))
            for r in merged.collect()}  # one row per group
