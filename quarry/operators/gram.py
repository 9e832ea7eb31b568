"""Principal components of a matrix held as cells, from the Gram matrix of its shorter side.

A matrix of ``n`` observations and ``d`` features has the same components
whether they are taken from the ``d x d`` correlations or from the ``n x n``
products of the standardised observations.  The shorter side is used, so a
matrix of any length may be transposed freely: rows of the longer side become
sparse lists of at most :data:`MAX_SIDE` cells, each task adds up the products
of its rows, and the partial matrices are summed in tiles.  Only the finished
matrix of the shorter side and its leading eigenvectors reach the driver; the
longer side's coordinates or loadings are computed row by row where they lie.

Repeated cells add up, missing cells are 0, cells without a label are left out.
A feature that does not vary is 0 after standardising.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.sources.worktables import WorkTables

#: Labels of the shorter side at most (its matrix is held by a task and by the driver).
MAX_SIDE = 4096
TILE = 512
#: Numbers of the dense rows in memory at a time, and partial sums per tile before the last one.
DENSE, SALTS = 1 << 21, 64


class Projection(NamedTuple):
    #: (observation, pc1..pck), (component, eigenvalue, explained_variance), (feature, component, loading).
    coords: DataFrame
    variance: DataFrame
    loadings: DataFrame


def sum_cells(cells: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """One cell per (row, column): repeated ones add up, NULL values count as 0."""
    labelled = cells.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    return labelled.groupBy(row, column).agg(F.coalesce(F.sum(F.col(value).cast("double")), F.lit(0.0)).alias(value))


def sparse_rows(cells: DataFrame, row: str, positions: DataFrame, column: str, value: str) -> DataFrame:
    """(row, idx, val): each row's cells as ascending positions and values."""
    placed = cells.join(F.broadcast(positions), column).groupBy(row).agg(
        F.sort_array(F.collect_list(F.struct("_pos", F.col(value).alias("v")))).alias("_c"))
    return placed.select(row, F.col("_c._pos").alias("idx"), F.col("_c.v").alias("val"))


def _dense(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Labels and dense values of consecutive rows, a bounded number of values at a time."""
    step = max(1, DENSE // width)
    for batch in batches:
        for first in range(0, batch.num_rows, step):
            part = batch.slice(first, step)
            lengths = pc.list_value_length(part["idx"]).to_numpy(zero_copy_only=False)
            out = np.zeros((part.num_rows, width))
            out[np.repeat(np.arange(part.num_rows), lengths), part["idx"].flatten().to_numpy()] = part["val"].flatten().to_numpy()
            yield part.column(0), out


def _standard(rows: np.ndarray) -> np.ndarray:
    """Rows minus their mean, by their sample deviation (0 where they do not vary)."""
    rows = rows - rows.mean(axis=1, keepdims=True)
    deviation = rows.std(axis=1, ddof=1, keepdims=True)
    return np.divide(rows, deviation, out=np.zeros_like(rows), where=deviation > 0)


TILES = "bi int, bj int, products array<double>"


def _products(width: int, centre: np.ndarray | None):
    """Each task's sum of products of its rows (centred columns, or standardised rows), in tiles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for _, rows in _dense(batches, width):
            rows = _standard(rows) if centre is None else rows - centre
            total += rows.T @ rows
        for i in range(0, width, TILE):
            for j in range(i, width, TILE):
                yield _tile(i, j, total[i:i + TILE, j:j + TILE].ravel())

    return run


def _tile(i: int, j: int, products: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()),
                                       pa.array([products], pa.list_(pa.float64()))], names=["bi", "bj", "products"])


def _add_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for i, j, products in zip(batch["bi"].to_pylist(), batch["bj"].to_pylist(), batch["products"]):
            values = products.values.to_numpy()
            sums[i, j] = sums[i, j] + values if (i, j) in sums else values.copy()
    for (i, j), products in sums.items():
        yield _tile(i, j, products)


def gram(rows: DataFrame, width: int, centre: np.ndarray | None = None) -> np.ndarray:
    """``width x width`` sum of products of ``rows`` (idx, val).

    With ``centre`` it is taken off every row; without, every row is standardised by itself.
    """
    parts = rows.mapInArrow(_products(width, centre), TILES)
    # The partial matrices of all tasks are added in two steps, so that no task adds all of them.
    parts = parts.withColumn("salt", F.spark_partition_id() % SALTS).repartition("bi", "bj", "salt").drop("salt")
    tiles = parts.mapInArrow(_add_tiles, TILES).repartition("bi", "bj").mapInArrow(_add_tiles, TILES).collect()
    out = np.zeros((width, width))
    for i, j, products in tiles:
        n, m = min(TILE, width - i), min(TILE, width - j)
        out[i:i + n, j:j + m] = np.array(products).reshape(n, m)
    return np.triu(out) + np.triu(out, 1).T


def _times(width: int, centre: np.ndarray | None, scale: np.ndarray | None, vectors: np.ndarray):
    """Each row's products with ``vectors``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for labels, rows in _dense(batches, width):
            rows = _standard(rows) if centre is None else (rows - centre) * scale
            yield pa.RecordBatch.from_arrays([labels, pa.array(list(rows @ vectors), pa.list_(pa.float64()))], names=["label", "x"])

    return run


def _along(rows: DataFrame, label: str, *how) -> DataFrame:
    kind = rows.schema[label].dataType
    return rows.mapInArrow(_times(*how), f"label {kind.simpleString()}, x array<double>").withColumnRenamed("label", label)


def principal_components(cells: DataFrame, obs: str, feature: str, value: str = "n", k: int = 2) -> Projection:
    """Standardised features' first ``k`` components; the largest loading of each is positive."""
    spark = cells.sparkSession
    with WorkTables(spark, "pca") as work:
        cells = work.keep(sum_cells(cells, obs, feature, value), "cells")
        n_obs, n_features = (cells.select(c).distinct().count() for c in (obs, feature))
        if n_obs < 2 or min(n_obs, n_features) > MAX_SIDE:
            raise ValueError(f"{n_obs} observations of {n_features} features: at least 2 observations are needed, "
                             f"and at most {MAX_SIDE} labels on the shorter side")
        dual = n_obs <= n_features
        short, long = (obs, feature) if dual else (feature, obs)
        labels = [r[0] for r in cells.select(short).distinct().orderBy(short).collect()]  # at most MAX_SIDE
        kind = cells.schema[short].dataType.simpleString()
        positions = spark.createDataFrame([(x, i) for i, x in enumerate(labels)], f"{short} {kind}, _pos int")
        rows = work.keep(sparse_rows(cells, long, positions, short, value), "rows", result=True)
        width = len(labels)
        if dual:
            centre = scale = None
            matrix = gram(rows, width) / (n_obs - 1)
        else:
            sums = cells.groupBy(short).agg(F.sum(value)).collect()  # one row per label of the shorter side
            centre = np.array([dict(map(tuple, sums))[x] for x in labels]) / n_obs
            matrix = gram(rows, width, centre) / (n_obs - 1)
            deviation = np.sqrt(np.diag(matrix))
            scale = np.divide(1.0, deviation, out=np.zeros(width), where=deviation > 0)
            matrix = matrix * scale[:, None] * scale
        work.drop("cells")
    found, vectors = np.linalg.eigh(matrix)
    k = min(k, width)
    eigen, vectors = np.maximum(found[::-1][:k], 0.0), vectors[:, ::-1][:, :k]
    total = float(np.trace(matrix)) or 1.0
    variance = spark.createDataFrame([(j + 1, float(e), float(e) / total) for j, e in enumerate(eigen)],
                                     "component int, eigenvalue double, explained_variance double")
    if dual:
        # Loadings are the features' products with the eigenvectors, scaled to length 1.
        length = np.sqrt(eigen * (n_obs - 1))
        along = _along(rows, long, width, None, None, np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0))
        signs = _signs(along, long, k)
        coords = _table(spark, obs, kind, labels, vectors * length * signs)
        loadings = along.select(feature, F.posexplode("x").alias("j", "x")).select(
            feature, (F.col("j") + 1).alias("component"), (F.col("x") * _pick(signs, F.col("j"))).alias("loading"))
    else:
        signs = np.sign([v[np.argmax(np.abs(v))] for v in vectors.T])
        coords = _along(rows, long, width, centre, scale, vectors * signs).select(
            obs, *[F.col("x")[j].alias(f"pc{j + 1}") for j in range(k)])
        loadings = _table(spark, feature, kind, labels, vectors * signs).select(feature, F.posexplode(
            F.array(*[f"pc{j + 1}" for j in range(k)])).alias("j", "loading")).select(
            feature, (F.col("j") + 1).alias("component"), "loading")
    return Projection(coords, variance, loadings)


def _pick(values: np.ndarray, at: Column) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])[at]


def _signs(along: DataFrame, label: str, k: int) -> np.ndarray:
    """Per component the sign of the loading of largest magnitude (of equals, of the first label)."""
    largest = along.agg(*[F.min_by(F.signum(F.col("x")[j]), F.struct(-F.abs(F.col("x")[j]), F.col(label))) for j in range(k)])
    return np.array([s or 1.0 for s in largest.first()])


def _table(spark, label: str, kind: str, labels: list, values: np.ndarray) -> DataFrame:
    columns = ", ".join(f"pc{j + 1} double" for j in range(values.shape[1]))
    return spark.createDataFrame([(x, *map(float, v)) for x, v in zip(labels, values)], f"{label} {kind}, {columns}")
