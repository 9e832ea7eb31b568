"""Claim-frequency models: labels, stratified split, five GLM-type models,
regularisation sweep.

The feature half of the pipeline (index, one-hot, assemble, scale) is fit
once on the training part; its output is written once as a work table, which
every model reads and which goes when the results (a few rows) stand.
"""

from __future__ import annotations

from collections.abc import Sequence

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import features as feat
from quarry.operators import models, sampling, selection
from quarry.operators.optimality import Fitted, residuals
from quarry.sources.worktables import WorkTables

NUMERIC = ["total_price", "order_year", "order_month"]
CATEGORICAL = ["priority", "status"]
# The regularisation strengths of the sweep.
REG_PARAMS = [0.001, 0.01, 0.1, 1.0, 10.0]
LABELS = ["nz_claim", "pp_claim_nb", "log_claim_nb"]


def split_claims(labels: DataFrame, key: str = "policy_id", ratio: float = 0.7,
                 seed: int = 14, inner_ratio: float | None = None) -> DataFrame:
    """Stratified on the claim-count class (``pp_claim_nb``), exact per class."""
    if inner_ratio is None:
        return sampling.stratified_split(labels, "pp_claim_nb", key, ratio, seed)
    return sampling.holdout_split(labels, "pp_claim_nb", key, ratio, inner_ratio, seed, seed + 1)


def labelled(claims: DataFrame, work: WorkTables) -> DataFrame:
    """The claims (often a join of tables) with their labels, written once: the cuts read them several times."""
    return work.keep(feat.claim_labels(claims), "labelled")


def featurize(parts: DataFrame, fit_part: str, work: WorkTables, numeric: Sequence[str] = NUMERIC,
              categorical: Sequence[str] = CATEGORICAL, key: str = "policy_id",
              split_col: str = "split") -> tuple[DataFrame, list[str]]:
    """Fit the feature pipeline on one part, transform all parts into a work table."""
    parts = work.keep(parts, "parts")
    pipe = feat.feature_pipeline(numeric, categorical)
    model = pipe.fit(parts.filter(F.col(split_col) == fit_part))
    out = model.transform(parts).select(key, split_col, *LABELS, "features")
    names = [numeric[int(n.rsplit("_", 1)[1])] if n.startswith("_num_scaled_") else n
             for n in models.feature_names(out)]
    out = work.keep(out, "features")
    work.drop("parts")
    return out, names


def claim_models(spark: SparkSession, claims: DataFrame,
                 names: Sequence[str] = tuple(models.MODEL_NAMES),
                 reg_params: Sequence[float] = (0.001,), parallelism: int = 8):
    """Fit the chosen models on the 70 % part; score train and test.

    Returns ``(metrics, coefficients)``.
    """
    with WorkTables(spark, "claims") as work:
        fx, term_names = featurize(split_claims(labelled(claims, work)), "train", work)
        return selection.sweep(spark, fx, names, reg_params, "train", names=term_names,
                               parallelism=parallelism)


def validation_curve(spark: SparkSession, claims: DataFrame,
                     names: Sequence[str] = tuple(models.MODEL_NAMES),
                     reg_params: Sequence[float] = tuple(REG_PARAMS),
                     parallelism: int = 8) -> DataFrame:
    """Train score and held-out score for every model x regularisation.

    The 70 % training part is split again 90/10 (``fit`` / ``validate``);
    the test part is not touched.
    """
    with WorkTables(spark, "claims") as work:
        parts = split_claims(labelled(claims, work), inner_ratio=0.9).filter(F.col("split") != "test")
        fx, term_names = featurize(parts, "fit", work)
        metrics, _ = selection.sweep(spark, fx, names, reg_params, "fit", names=term_names,
                                     parallelism=parallelism)
    return metrics


#: A model counts as fitted when no optimality condition is off by more than this
#: (label units per row and feature deviation).
OPTIMUM = 5e-4
#: Model name -> family and share of the penalty that is absolute.
CONDITIONS = {"glm_poisson": ("poisson", 0.0), "logistic_l1": ("logistic", 1.0), "logistic_l2": ("logistic", 0.0)}


def model_optimum(spark: SparkSession, claims: DataFrame, names: Sequence[str] = tuple(CONDITIONS),
                  reg_params: Sequence[float] = tuple(REG_PARAMS), parallelism: int = 8) -> DataFrame:
    """(model, reg_param, n, sum_label, sum_predicted, worst, at_optimum) of every fit on the training part."""
    with WorkTables(spark, "claims") as work:
        fx, _ = featurize(split_claims(labelled(claims, work)), "train", work)
        combos = [(n, r) for n in names for r in reg_params]
        train = fx.where(F.col("split") == "train")
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            fitted = list(pool.map(lambda c: models.make_estimator(*c).fit(train), combos))
        # All fits are checked in one pass over the rows.
        scored, checks = train, []
        for i, ((name, reg), model) in enumerate(zip(combos, fitted)):
            family, alpha = CONDITIONS[name]
            scored, mean = models.add_mean(model, scored, f"_mean{i}")
            checks.append(Fitted(F.col(models.model_label(name)), mean, model.coefficients.toArray(), reg, alpha, family))
        found = residuals(scored, vector_to_array("features"), checks)
        rows = [(name, float(reg), r.n, r.sum_label, r.sum_predicted, r.worst, r.worst <= OPTIMUM)
                for (name, reg), r in zip(combos, found)]
    return spark.createDataFrame(rows, "model string, reg_param double, n long, sum_label double, sum_predicted double, "
                                       "worst double, at_optimum boolean")


def category_rates(claims: DataFrame, category: str, exposure: str) -> DataFrame:
    """(model, category, rate): unpenalised fits on one category alone.

    Their optimum is known: the logistic model gives each category's share of
    claims, the Poisson model with the log of the exposure as offset its counts
    over its exposure.
    """
    rows = feat.claim_labels(claims).withColumn("log_exposure", F.log(F.col(exposure)))
    with WorkTables(claims.sparkSession, "rates") as work:
        stages = [*feat.indexer_encoder([category]), VectorAssembler(inputCols=[f"{category}_ohe"], outputCol="features")]
        rows = work.keep(Pipeline(stages=stages).fit(rows).transform(rows)
                         .select(category, *LABELS, "log_exposure", "features"), "rows")
        logistic = models.make_estimator("logistic_l2", 0.0).setTol(1e-9).setMaxIter(200).fit(rows)
        poisson = models.make_estimator("glm_poisson", 0.0, offset="log_exposure").setTol(1e-12).fit(rows)
        out = [(name, r[0], r[1]) for name, model, rate in (
            ("logistic_l2", logistic, vector_to_array("probability")[1]),
            ("glm_poisson", poisson, F.col("prediction") / F.exp("log_exposure")))
            for r in model.transform(rows).groupBy(category).agg(F.avg(rate)).collect()]  # one row per category
    return claims.sparkSession.createDataFrame(out, f"model string, {category} string, rate double")


def report(metrics: DataFrame, coefs: DataFrame) -> DataFrame:
    """One long table: metric rows (split set) and coefficient rows (split NULL)."""
    m = metrics.select("model", "reg_param", "split", "metric", F.col("metric").alias("item"),
                       "value").drop("metric")
    c = coefs.select("model", "reg_param", F.lit(None).cast("string").alias("split"),
                     F.col("term").alias("item"), "value")
    return m.unionByName(c)


def split_distribution(labels: DataFrame, key: str = "policy_id", ratio: float = 0.7,
                       seed: int = 14, label: str = "pp_claim_nb") -> DataFrame:
    """Rows and % per claim class in all data and in each part of the split.

    Groups are aggregated first; the per-part totals come from a window over
    that small (part x class) table.
    """
    from pyspark.sql import Window

    from quarry.functions.columns import half_up_pct
    parts = split_claims(labels.select(key, label), key, ratio, seed)
    both = parts.select("split", label).unionByName(
        labels.select(F.lit("all").alias("split"), label))
    g = both.groupBy("split", label).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", half_up_pct(F.col("n"), F.sum("n").over(Window.partitionBy("split"))))
