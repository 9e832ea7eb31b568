"""Moments, regularisation paths and optimality conditions against the library's fits."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from quarry.operators import models
from quarry.operators.linear import path
from quarry.operators.moments import moments
from quarry.operators.optimality import residual
from quarry.plans import claims


def _rows(spark, n=600, d=5, seed=2, shift=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + shift
    x[:, d - 1] = 3.0  # a feature that does not vary
    y = x @ rng.normal(size=d) + rng.normal(size=n)
    rows = [([float(v) for v in a], float(b), "ab"[i % 2]) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "x array<double>, y double, part string").repartition(7), x, y


def test_moments_keep_digits_with_large_means(spark):
    df, x, y = _rows(spark, shift=1e8)
    m = moments(df, F.col("x"), F.col("y"))["all"]
    data = np.column_stack([x, y])
    centred = data - data.mean(axis=0)
    want = centred.T @ centred
    assert m.n == 600 and np.allclose(m.mean, data.mean(axis=0), rtol=1e-12)
    assert np.allclose(m.products, want, rtol=1e-5, atol=1e-5 * np.abs(want).max())
    parts = moments(df, F.col("x"), F.col("y"), F.col("part"))
    merged = parts["a"].merge(parts["b"])
    assert set(parts) == {"a", "b"} and np.allclose(merged.products, m.products) and merged.n == 600


def test_moments_refuse_missing_values(spark):
    for bad in ("array(1D, NULL), 1D", "array(1D, double('NaN')), 1D", "array(1D, 2D), double(NULL)"):
        df = spark.sql(f"SELECT array(1D, 2D) AS x, 1D AS y UNION ALL SELECT {bad}")
        with pytest.raises(Exception, match="NULL, NaN or infinite"):
            moments(df, F.col("x"), F.col("y"))
    assert moments(spark.sql("SELECT array(1D) AS x, 1D AS y").limit(0), F.col("x"), F.col("y")) == {}


@pytest.mark.parametrize("alpha", [0.0, 1.0, 0.3])
def test_paths_equal_the_library(spark, alpha):
    df, _, _ = _rows(spark, shift=2.0)
    vec = VectorAssembler(inputCols=[f"x{i}" for i in range(5)], outputCol="features").transform(
        df.select(*[F.col("x")[i].alias(f"x{i}") for i in range(5)], "y", "part", "x")).cache()
    m = moments(df, F.col("x"), F.col("y"))["all"]
    by_part = moments(df, F.col("x"), F.col("y"), F.col("part"))
    for fit in path(m, [0.0, 0.01, 0.5, 100.0], alpha):
        theirs = LinearRegression(labelCol="y", regParam=fit.reg_param, elasticNetParam=alpha, maxIter=2000, tol=1e-12).fit(vec)
        assert np.allclose(fit.coefficients, theirs.coefficients.toArray(), atol=2e-5)
        assert abs(fit.intercept - theirs.intercept) < 1e-4
        for part, own in by_part.items():
            scored = theirs.transform(vec.where(F.col("part") == part))
            rmse = scored.agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), 2)))).first()[0]
            assert abs(fit.rmse(own) - rmse) < 1e-5


def test_constant_label(spark):
    df, _, _ = _rows(spark)
    fit = path(moments(df, F.col("x"), F.lit(4.0))["all"], [0.1], 0.0)[0]
    assert fit.intercept == 4.0 and not fit.coefficients.any()


@pytest.mark.parametrize("name, label", [("glm_poisson", "count"), ("logistic_l1", "flag"), ("logistic_l2", "flag")])
def test_conditions_hold_at_the_optimum_only(spark, name, label):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 3))
    count = rng.poisson(np.exp(0.4 * x[:, 0] - 0.3 * x[:, 1] + 0.2)).astype(float)
    df = spark.createDataFrame([([float(v) for v in a], float(c), float(c > 0)) for a, c in zip(x, count)],
                               "x array<double>, count double, flag double")
    vec = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(
        df.select(*[F.col("x")[i].alias("abc"[i]) for i in range(3)], "x", "count", "flag"))
    model = models.make_estimator(name, 0.05, label).setTol(1e-10).fit(vec)
    family, alpha = claims.CONDITIONS[name]
    mean = F.col("prediction") if family == "poisson" else vector_to_array("probability")[1]
    scored = model.transform(vec)
    right = residual(scored, F.col("x"), F.col(label), mean, model.coefficients.toArray(), 0.05, alpha, family)
    assert right.worst < 1e-5 and right.n == 500 and abs(right.sum_label - right.sum_predicted) < 1e-2
    wrong = residual(scored, F.col("x"), F.col(label), mean, model.coefficients.toArray() * 1.05 + 0.01, 0.05, alpha, family)
    assert wrong.worst > claims.OPTIMUM
    biased = residual(scored, F.col("x"), F.col(label), mean * 1.01, model.coefficients.toArray(), 0.05, alpha, family)
    assert biased.worst > claims.OPTIMUM
