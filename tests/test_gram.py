"""Principal components from the shorter side's products, against Spark's PCA and numpy."""

import numpy as np
import pytest
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quarry.operators.gram import MAX_SIDE, gram, principal_components
from quarry.plans import papers


def _cells(spark, matrix, parts=4):
    rows = [(i, j, float(v)) for i, row in enumerate(matrix) for j, v in enumerate(row) if v or not j]  # zeros need no cell, but rows do
    return spark.createDataFrame(rows, "o long, f long, n double").repartition(parts)


def _want(matrix, k=2):
    z = (matrix - matrix.mean(axis=0))
    sd = matrix.std(axis=0, ddof=1)
    z = np.divide(z, sd, out=np.zeros_like(z), where=sd > 0)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    signs = np.sign([v[np.argmax(np.abs(v))] for v in vt[:k]])
    return (z @ vt[:k].T) * signs, s[:k] ** 2 / (len(matrix) - 1), vt[:k].T * signs, (s ** 2).sum() / (len(matrix) - 1)


@pytest.mark.parametrize("shape", [(40, 12), (12, 40), (9, 4000), (700, 5)])
def test_components_equal_a_decomposition(spark, shape):
    rng = np.random.default_rng(3)
    matrix = np.round(rng.poisson(1.0, shape) * rng.random(shape[1]), 3)
    matrix[0, :] += 0.5  # every feature has a cell
    coords, eigen, loadings, total = _want(matrix)
    got = principal_components(_cells(spark, matrix), "o", "f")
    ours = np.array([r[1:] for r in sorted(map(tuple, got.coords.collect()))])
    assert np.allclose(ours, coords, atol=1e-8)
    for r in got.variance.collect():
        assert abs(r.eigenvalue - eigen[r.component - 1]) < 1e-8
        assert abs(r.explained_variance - eigen[r.component - 1] / total) < 1e-10
    table = {(r.f, r.component): r.loading for r in got.loadings.collect()}
    assert len(table) == 2 * shape[1]
    for (f, c), v in table.items():
        assert abs(v - loadings[f, c - 1]) < 1e-8


def test_components_equal_the_library(spark):
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(60, 7)) @ rng.normal(size=(7, 7)) + 3
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], "o long, x array<double>")
    vec = df.select("o", array_to_vector("x").alias("v"))
    z = StandardScaler(inputCol="v", outputCol="z", withMean=True, withStd=True).fit(vec).transform(vec)
    model = PCA(k=2, inputCol="z", outputCol="p").fit(z)
    theirs = np.array([r[0] for r in model.transform(z).orderBy("o").select(vector_to_array("p")).collect()])
    got = principal_components(_cells(spark, matrix), "o", "f")
    ours = np.array([r[1:] for r in sorted(map(tuple, got.coords.collect()))])
    assert np.allclose(np.abs(ours), np.abs(theirs), atol=1e-8)
    assert np.allclose([r[2] for r in got.variance.orderBy("component").collect()], model.explainedVariance.toArray())


def test_tiles_of_several_tasks_add_up(spark, monkeypatch):
    monkeypatch.setattr("quarry.operators.gram.TILE", 3)
    monkeypatch.setattr("quarry.operators.gram.DENSE", 40)
    rng = np.random.default_rng(1)
    matrix = rng.normal(size=(50, 8))
    rows = spark.createDataFrame([(i, list(range(8)), [float(x) for x in r]) for i, r in enumerate(matrix)],
                                 "o long, idx array<int>, val array<double>").repartition(6)
    centre = matrix.mean(axis=0)
    assert np.allclose(gram(rows, 8, centre), (matrix - centre).T @ (matrix - centre))


def test_repeated_null_and_unlabelled_cells(spark):
    cells = [(1, "a", 1.0), (1, "a", 2.0), (1, "b", 5.0), (2, "a", None), (2, "b", 1.0), (3, "c", 4.0), (None, "a", 9.0), (3, None, 9.0)]
    df = spark.createDataFrame(cells, "o long, f string, n double")
    rows = {r.o: (r.width, r.idx, r.val) for r in papers.observation_vectors(df, "o", "f").collect()}
    assert rows == {1: (3, [0, 1], [3.0, 5.0]), 2: (3, [0, 1], [0.0, 1.0]), 3: (3, [2], [4.0])}
    coords, *_ = _want(np.array([[3.0, 5, 0], [0, 1, 0], [0, 0, 4]]))
    ours = np.array([r[1:] for r in sorted(map(tuple, principal_components(df, "o", "f").coords.collect()))])
    assert np.allclose(ours, coords, atol=1e-8)


def test_vectors_grow_with_cells_not_with_width(spark):
    """4000 features of which every observation has three."""
    df = spark.range(3000).select(F.col("id").alias("o"), F.explode(F.array(*[(F.col("id") * 7 + 1333 * j) % 4000 for j in range(3)]))
                                  .alias("f"), F.lit(1.0).alias("n"))
    rows = papers.observation_vectors(df, "o", "f")
    assert rows.select(F.sum(F.size("idx")), F.count("*")).first() == (9000, 3000)


def test_limits_raise(spark):
    one = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0)], "o long, f long, n double")
    with pytest.raises(ValueError):
        principal_components(one, "o", "f")
    wide = spark.range(MAX_SIDE + 1).select(F.col("id").alias("o"), F.col("id").alias("f"), F.lit(1.0).alias("n"))
    with pytest.raises(ValueError):
        principal_components(wide, "o", "f")
