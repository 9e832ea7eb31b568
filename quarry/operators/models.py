"""Estimator registry, fit-and-score, and model introspection as tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.metrics import classification_report, regression_metrics

# The model names.  name -> (factory(reg_param, label, features), default label, metric)
_REGISTRY: dict[str, tuple[Callable, str, str]] = {
    "glm_poisson": (lambda reg, y, x: GeneralizedLinearRegression(
        family="poisson", link="log", maxIter=50, regParam=reg, labelCol=y, featuresCol=x),
        "pp_claim_nb", "rmse"),
    "linear_l1": (lambda reg, y, x: LinearRegression(
        maxIter=50, regParam=reg, elasticNetParam=1.0, labelCol=y, featuresCol=x),
        "log_claim_nb", "rmse"),
    "linear_l2": (lambda reg, y, x: LinearRegression(
        maxIter=50, regParam=reg, elasticNetParam=0.0, labelCol=y, featuresCol=x),
        "log_claim_nb", "rmse"),
    "logistic_l1": (lambda reg, y, x: LogisticRegression(
        maxIter=50, regParam=reg, elasticNetParam=1.0, labelCol=y, featuresCol=x),
        "nz_claim", "accuracy"),
    "logistic_l2": (lambda reg, y, x: LogisticRegression(
        maxIter=50, regParam=reg, elasticNetParam=0.0, labelCol=y, featuresCol=x),
        "nz_claim", "accuracy"),
}

MODEL_NAMES = list(_REGISTRY)
#: The linear models and the share of their penalty that is absolute (see quarry.operators.linear).
LINEAR = {"linear_l1": 1.0, "linear_l2": 0.0}


def make_estimator(name: str, reg_param: float = 0.001, label: str | None = None,
                   features: str = "features", offset: str | None = None):
    """Estimator by name; an unknown name raises instead of returning None.

    ``offset`` (Poisson only) sets ``offsetCol``, e.g. ln(exposure).
    """
    if name not in _REGISTRY:
        raise ValueError(f"unknown model {name!r}; known: {MODEL_NAMES}")
    factory, default_label, _ = _REGISTRY[name]
    est = factory(reg_param, label or default_label, features)
    if offset is not None:
        if name != "glm_poisson":
            raise ValueError("offset is only defined for the Poisson model")
        est = est.setOffsetCol(offset)
    return est


def model_label(name: str) -> str:
    return _REGISTRY[name][1]


def model_metric(name: str) -> str:
    return _REGISTRY[name][2]


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Slot names of an assembled vector, from its ML attribute metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs += group
    if not attrs:
        return [f"f{i}" for i in range(meta.get("num_attrs", 0))]
    return [a.get("name", f"f{a['idx']}") for a in sorted(attrs, key=lambda a: a["idx"])]


def coefficients_table(spark: SparkSession, model, names: Sequence[str],
                       tags: dict | None = None) -> DataFrame:
    """``(term, value)`` rows of a linear model (+ ``intercept``), with tags."""
    coef = model.coefficients.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(names, coef)] + [("intercept", float(model.intercept))]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("term", T.StringType()),
                                                   T.StructField("value", T.DoubleType())]))
    for k, v in (tags or {}).items():
        df = df.withColumn(k, F.lit(v))
    return df


def score(predictions: DataFrame, label: str, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """Long ``(by..., metric, value)`` rows from a predictions frame."""
    if metric in ("rmse", "mae", "mse"):
        m = regression_metrics(predictions, label, "prediction", by)
    else:
        m = classification_report(predictions, label, "prediction", by)
    return m.select(*by, F.lit(metric).alias("metric"), F.col(metric).cast("double").alias("value"))


def add_mean(model, df: DataFrame, name: str) -> tuple[DataFrame, Column]:
    """``df`` with the predictions of a Poisson or logistic model in columns of their own, and its predicted mean."""
    model = model.copy().setPredictionCol(name)
    if not model.hasParam("probabilityCol"):
        return model.transform(df), F.col(name)
    model = model.setRawPredictionCol(f"{name}_raw").setProbabilityCol(f"{name}_p")
    return model.transform(df), vector_to_array(f"{name}_p")[1]


def fit_and_score(spark: SparkSession, name: str, reg_param: float, parts: DataFrame,
                  fit_part: str, split_col: str = "split", features: str = "features",
                  label: str | None = None, names: Sequence[str] | None = None):
    """Fit on ``parts[split == fit_part]``; score every part in one aggregate.

    Returns ``(metrics, coefficients)``: metrics has one row per split, the
    coefficients one row per term (both tagged with model and reg_param).
    """
    label = label or model_label(name)
    est = make_estimator(name, reg_param, label, features)
    model = est.fit(parts.filter(F.col(split_col) == fit_part))
    tags = {"model": name, "reg_param": float(reg_param)}
    m = score(model.transform(parts), label, model_metric(name), [split_col])
    for k, v in tags.items():
        m = m.withColumn(k, F.lit(v))
    coefs = coefficients_table(spark, model, names or feature_names(parts, features), tags)
    return m, coefs


def als(rank: int = 10, max_iter: int = 10, reg_param: float = 0.1, seed: int = 20240501,
        user: str = "user_id", item: str = "item_id", rating: str = "rating") -> ALS:
    """Explicit-feedback ALS; cold-start rows are dropped at scoring time.

    The item factors are checkpointed in every iteration, upon which Spark deletes
    the iteration's shuffle files: they hold the factors once per block, and those
    of ten iterations (the default interval) are many times the ratings.
    """
    return ALS(rank=rank, maxIter=max_iter, regParam=reg_param, userCol=user, itemCol=item,
               ratingCol=rating, seed=seed, coldStartStrategy="drop", checkpointInterval=1)


def kmeans(k: int = 25, seed: int = 20240501, features: str = "features") -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol=features)


def random_forest(label: str = "label", seed: int = 20240501, **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, seed=seed, **params)


def boosted_trees(label: str = "label", seed: int = 20240501, **params) -> GBTClassifier:
    return GBTClassifier(labelCol=label, seed=seed, **params)
