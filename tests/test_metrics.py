import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator

from quarry.operators import metrics

SCORES = [(0.1, 0.0), (0.4, 1.0), (0.4, 0.0), (0.4, 1.0), (0.8, 1.0), (0.8, 0.0)]


def test_auc_mid_ranks_match_evaluator(spark):
    df = spark.createDataFrame(SCORES, "s double, y double")
    ours = metrics.area_under_roc(df, "s", "y").first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    assert abs(ours - ev.evaluate(df)) < 1e-12
    # Mann-Whitney by hand: positives 0.4,0.4,0.8 vs negatives 0.1,0.4,0.8
    assert abs(ours - (1.5 + 1.5 + 2.5) / 9) < 1e-12


def test_auc_undefined_for_one_class(spark):
    df = spark.createDataFrame([(0.1, 1.0), (0.2, 1.0)], "s double, y double")
    r = metrics.area_under_roc(df, "s", "y").first()
    assert r.auc is None and r.n_neg == 0


def test_regression_metrics_one_pass(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0)], "y double, p double")
    r = metrics.regression_metrics(df, "y", "p").first()
    for name in ("rmse", "mae", "mse"):
        ev = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name)
        assert abs(r[name] - ev.evaluate(df)) < 1e-12


def test_classification_report(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (0.0, 0.0), (1.0, 0.0)], "y double, p double")
    r = metrics.classification_report(df, "y", "p").first()
    assert (r.tp, r.fp, r.tn, r.fn, r.accuracy) == (1, 1, 1, 1, 0.5)


@pytest.fixture
def many_ranges(spark):
    """Small tables in several ranges, as large ones are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _brute_auc(rows):
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y != 1]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_over_ranges_and_groups_equals_all_pairs(spark, many_ranges):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.random(), rng.randint(0, 5) / 5]), float(rng.random() < 0.3))
            for _ in range(900)]
    bad = [("a", None, 1.0), ("a", float("nan"), 0.0), ("b", 0.5, None), (None, None, None)]
    df = spark.createDataFrame(rows + bad, "g string, s double, y double").repartition(5)
    got = {r.g: r for r in metrics.area_under_roc(df, "s", "y", by=["g"]).collect()}
    for g in ("a", "b", None):
        own = [(s, y) for k, s, y in rows if k == g]
        assert abs(got[g].auc - _brute_auc(own)) < 1e-12
        assert (got[g].n_pos, got[g].n_neg) == (sum(y == 1 for _, y in own), sum(y != 1 for _, y in own))
        assert got[g].n_unscored == sum(k == g for k, *_ in bad)
    whole = metrics.area_under_roc(df, "s", "y").first()
    assert abs(whole.auc - _brute_auc([(s, y) for _, s, y in rows])) < 1e-12 and whole.n_unscored == 4


def test_auc_of_a_hard_label_is_the_mean_of_both_rates(spark, many_ranges):
    rng = random.Random(6)
    rows = [(float(rng.random() < 0.4), float(rng.random() < 0.3)) for _ in range(500)]
    df = spark.createDataFrame(rows, "p double, y double")
    hit = sum(p for p, y in rows if y == 1) / sum(y == 1 for _, y in rows)
    false = sum(p for p, y in rows if y != 1) / sum(y != 1 for _, y in rows)
    assert abs(metrics.area_under_roc(df, "p", "y").first().auc - (1 + hit - false) / 2) < 1e-12


def test_auc_has_no_constant_key(spark):
    df = spark.createDataFrame(SCORES, "s double, y double")
    out = metrics.area_under_roc(df, "s", "y")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_g" not in plan


def test_rows_without_label_or_prediction_are_counted(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (0.0, None), (1.0, float("nan"))], "y double, p double")
    r = metrics.regression_metrics(df, "y", "p").first()
    assert (r.n, r.n_unscored, r.mse) == (1, 3, 0.0)
    c = metrics.classification_report(df.where("p is null or p = 1"), "y", "p").first()
    assert (c.n, c.n_unscored, c.accuracy) == (1, 2, 1.0)
