"""Model selection: grid validation, regularisation sweeps, k-fold search.

Fits run on a small thread pool (like ``CrossValidator(parallelism=...)``)
so that several small fits keep the cluster busy at once; every fit reads
the same checkpointed feature frame.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.linear import path
from quarry.operators.models import LINEAR, feature_names, fit_and_score, model_label
from quarry.operators.moments import moments


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def validate_grid(estimator, grid: Sequence[dict]) -> None:
    """Raise if a grid sets a parameter that belongs to none of the stages.

    ``ParamGridBuilder`` accepts any ``Param``; one taken from *another*
    estimator instance is silently ignored by ``fit``, so every combination
    would train the defaults.
    """
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else [estimator]
    uids = {s.uid for s in stages}
    for combo in grid:
        for param in combo:
            if param.parent not in uids:
                raise ValueError(f"grid parameter {param.name!r} belongs to {param.parent}, "
                                 f"not to any stage of the estimator ({sorted(uids)})")


def build_grid(estimator, options: dict[str, Sequence]) -> list[dict]:
    """Parameter grid from ``{param name: values}`` on ``estimator`` itself."""
    builder = ParamGridBuilder()
    for name, values in options.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def sweep(spark: SparkSession, parts: DataFrame, models: Sequence[str],
          reg_params: Sequence[float], fit_part: str, split_col: str = "split",
          features: str = "features", names: Sequence[str] | None = None,
          parallelism: int = 4) -> tuple[DataFrame, DataFrame]:
    """Every (model, reg_param) fitted on ``fit_part`` and scored on all parts.

    The linear models' fits and errors all come from one pass of moments per
    label; the others are fitted one by one.  Returns ``(metrics,
    coefficients)`` long tables.
    """
    names = names or feature_names(parts, features)
    linear = [m for m in models if m in LINEAR]
    solved = linear_sweep(spark, parts, linear, reg_params, fit_part, split_col, features, names) if linear else []
    combos = [(m, r) for r in reg_params for m in models if m not in LINEAR]
    if not combos:
        return solved

    def one(c):
        # Scores and coefficients are a few rows; taken at once, the parts may go afterwards.
        m, coefs = fit_and_score(spark, c[0], c[1], parts, fit_part, split_col, features, names=names)
        return spark.createDataFrame(m.collect(), m.schema), coefs

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(combos)))) as pool:
        results = list(pool.map(one, combos))
    results += [solved] if solved else []
    return union_all(r[0] for r in results), union_all(r[1] for r in results)


def linear_sweep(spark: SparkSession, parts: DataFrame, models: Sequence[str], reg_params: Sequence[float],
                 fit_part: str, split_col: str, features: str, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The linear models of a sweep, from the moments of every part."""
    metrics, coefs = [], []
    for label in dict.fromkeys(model_label(m) for m in models):
        found = moments(parts, vector_to_array(features), F.col(label), F.col(split_col))
        for model in (m for m in models if model_label(m) == label):
            for fit in path(found[fit_part], reg_params, LINEAR[model]):
                metrics += [(part, "rmse", fit.rmse(m), model, fit.reg_param) for part, m in found.items()]
                values = [*zip(names, fit.coefficients), ("intercept", fit.intercept)]
                coefs += [(term, float(v), model, fit.reg_param) for term, v in values]
    return (spark.createDataFrame(metrics, f"{split_col} string, metric string, value double, model string, reg_param double"),
            spark.createDataFrame(coefs, "term string, value double, model string, reg_param double"))


def cross_validate(estimator, grid: Sequence[dict], evaluator, train: DataFrame,
                   fold_col: str, folds: int, parallelism: int = 4):
    """k-fold search with a *given* fold column (repeatable folds).

    Returns ``(cv_model, results)`` where results has one row per grid
    combination: its parameter values and mean metric.
    """
    validate_grid(estimator, grid)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=list(grid),
                        evaluator=evaluator, numFolds=folds, foldCol=fold_col,
                        parallelism=parallelism, collectSubModels=False)
    model = cv.fit(train)
    rows = []
    for i, (combo, metric) in enumerate(zip(grid, model.avgMetrics)):
        rows.append((i, ";".join(f"{p.name}={v}" for p, v in
                                 sorted(combo.items(), key=lambda kv: kv[0].name)),
                     float(metric)))
    schema = T.StructType([T.StructField("combo", T.IntegerType()),
                           T.StructField("params", T.StringType()),
                           T.StructField("avg_metric", T.DoubleType())])
    results = train.sparkSession.createDataFrame(rows, schema)
    return model, results


def best_params(cv_model, names: Sequence[str]) -> dict:
    """Chosen values of ``names`` on the last stage of the best model."""
    best = cv_model.bestModel
    stage = best.stages[-1] if hasattr(best, "stages") else best
    return {n: stage.getOrDefault(stage.getParam(n)) for n in names}


def compare_table(metrics: DataFrame, row_keys: Sequence[str], column: str,
                  value: str = "value", values: Sequence | None = None) -> DataFrame:
    """Pivot a long metric table: one row per ``row_keys``, one column per
    value of ``column`` (give ``values`` to skip the discovery job)."""
    g = metrics.groupBy(*row_keys)
    g = g.pivot(column, list(values)) if values is not None else g.pivot(column)
    return g.agg(F.first(value))
