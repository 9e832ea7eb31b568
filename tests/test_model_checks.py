"""The checks on fitted models find right fits right and wrong ones wrong."""

import random
from types import SimpleNamespace

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators import optimality
from quarry.operators.groups import top_k
from quarry.operators.ranking import sums_before
from quarry.operators.split_gains import gain_at, split_gains
from quarry.plans import claims, classifier, recommender
from quarry.sources import tables
from quarry.sources.readers import read_table
from quarry.sources.worktables import WorkTables


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _ratings(spark):
    return tables.ratings_table(read_table(spark, SF_SMALL, "lineitem"), read_table(spark, SF_SMALL, "orders"))


def test_factor_residual_tells_solved_from_unsolved(spark):
    parts = recommender.temporal_parts(_ratings(spark), (0.8,))
    model = recommender._fit(parts, 0.8, {"rank": 4, "max_iter": 3, "reg_param": 0.1}, 1)
    off = recommender.factor_residual(parts.train(0.8), model, 0.1, 4).agg(F.max("off"), F.sum("n")).first()
    assert off[0] < 1e-5 and off[1] == parts.train(0.8).count()
    moved = SimpleNamespace(itemFactors=model.itemFactors, userFactors=model.userFactors.withColumn(
        "features", F.transform("features", lambda x: (x * 1.02).cast("float"))))
    assert recommender.factor_residual(parts.train(0.8), moved, 0.1, 4).agg(F.min("off")).first()[0] > recommender.SOLVED
    other = recommender.factor_residual(parts.train(0.8), model, 0.2, 4).agg(F.min("off")).first()[0]
    assert other > recommender.SOLVED


def test_clusters_of_known_centres(spark):
    rng = random.Random(3)
    rows = [(i, [float(10 * (i % 3)) + rng.random(), rng.random()]) for i in range(90)]
    users = spark.createDataFrame(rows, "id int, features array<float>")
    clusters = recommender.taste_clusters(users, k=3, seed=1, top=2)
    n, used, wrong, drift = recommender.cluster_check(clusters)
    assert (n, used, wrong) == (90, 3, 0) and drift < 1e-6
    assert [r["size"] for r in clusters.largest.orderBy("position").collect()] == [30, 30]
    assert [r["cluster"] for r in clusters.largest.orderBy("position").collect()] == [0, 1]
    swapped = clusters._replace(members=clusters.members.withColumn("cluster", (F.col("cluster") + 1) % 3))
    _, _, wrong, drift = recommender.cluster_check(swapped)
    assert wrong == 90 and drift > 0.5


def test_members_of_the_largest_cluster_are_ids_of_ratings(spark):
    parts = recommender.temporal_parts(_ratings(spark), (0.6,))
    model = recommender._fit(parts, 0.6, {"rank": 3, "max_iter": 2, "reg_param": 0.1}, 1)
    clusters = recommender.taste_clusters(model.userFactors, k=5)
    members = recommender.largest_members(clusters, parts)
    assert members.count() == members.distinct().count() == clusters.largest.where("position = 1").first()["size"]
    assert members.join(parts.train(0.6), "user_id", "left_anti").count() == 0


def test_optimum_counts_scored_rows(spark):
    out = recommender.recommender_optimum(_ratings(spark), {"x": {"rank": 3, "max_iter": 2, "reg_param": 0.1}}, (0.1, 0.8))
    ratings = sorted(map(tuple, _ratings(spark).select("ts", "order_id", "line_no", "item_id", "user_id", "rating").collect()))
    for r in out.collect():
        train, test = ratings[:r.n_train], ratings[r.n_train:]
        users, items = {x[4] for x in train}, {x[3] for x in train}
        assert r.n_train == int(len(ratings) * r.train_frac) and r.n_test == len(test) and r.n_users == len(users)
        assert r.n_scored == sum(x[4] in users and x[3] in items for x in test) and r.solved


def _gini(rows):
    share = sum(y for _, y in rows) / len(rows)
    return 2 * share * (1 - share)


def test_gains_of_all_splits_equal_brute_force(spark, many_ranges):
    rng = random.Random(11)
    rows = [(rng.random() if i % 2 else rng.randint(0, 4) / 4, float(rng.randint(0, 3)), float(rng.random() < 0.4)) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, y double").repartition(5)
    extra = df.unionAll(spark.sql("SELECT 1D, 1D, CAST(NULL AS DOUBLE)"))
    got = {(r.feature, r.value): r for r in split_gains(extra, ["a", "b"], "y").collect()}
    want = 0
    for k, name in enumerate("ab"):
        cells = [(r[k], r[2]) for r in rows]
        for value in sorted({v for v, _ in cells})[:-1]:
            left, right = [c for c in cells if c[0] <= value], [c for c in cells if c[0] > value]
            gain = _gini(cells) - len(left) / 400 * _gini(left) - len(right) / 400 * _gini(right)
            assert abs(got[name, value].gain - gain) < 1e-12 and got[name, value].n_left == len(left)
            want += 1
    assert len(got) == want
    assert abs(gain_at(df, "b", 1.5, "y") - got["b", 1.0].gain) < 1e-12


def test_fitted_trees_have_the_best_root(spark):
    ev = tables.collision_events(read_table(spark, SF_SMALL, "lineitem"))
    for r in classifier.tree_check(ev, tables.COLLISION_FEATURES, "event_key", 0.5).collect():
        assert r.gain_is_exact and r.gain_is_best and r.n > 1000


def test_report_with_small_grids(spark):
    """The whole classifier job, with two combinations instead of 27 per model."""
    ev = tables.collision_events(read_table(spark, SF_SMALL, "lineitem"))
    grids = {"forest": {"maxDepth": [2, 3], "numTrees": [3]}, "boost": {"maxDepth": [2], "maxBins": [28, 32]}}
    report, searched = classifier.classifier_report(spark, ev, tables.COLLISION_FEATURES, "event_key", sample_fraction=0.5, options=grids)
    rows = {(r.model, r.stage, r.metric): r.value for r in report.collect()}
    assert len(rows) == 8 and all(0 <= v <= 1 for v in rows.values())
    assert searched.count() == 4


def test_hard_label_auc_of_a_classifier(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.9), (0.0, 1.0, 0.6), (0.0, 0.0, 0.2), (1.0, 0.0, 0.4)], "label double, prediction double, p double")
    df = df.withColumn("probability", array_to_vector(F.array(1 - F.col("p"), F.col("p"))))
    with WorkTables(spark, "test") as work:
        soft = classifier.evaluate(df, {"m": "x"}, work, "a")
        hard = classifier.evaluate(df, {"m": "x"}, work, "b", hard_label_auc=True)
    assert soft == [("x", "accuracy", 0.5), ("x", "auc", 0.75)] and hard == [("x", "accuracy", 0.5), ("x", "auc", 0.5)]


def test_sums_over_ranges_equal_a_window(spark, many_ranges):
    df = spark.range(2000).select("id", (F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("v")).repartition(6)
    got = sums_before(df, ["g"], [F.col("id")], {"s": "v"}, WorkTables(spark, "test"))
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("s", F.coalesce(F.sum("v").over(w), F.lit(0)))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_global_top_k_is_a_top_k_in_the_plan(spark):
    df = spark.range(1000).select((F.col("id") % 37).alias("x")).groupBy("x").count()
    out = top_k(df, [F.col("count").desc(), F.col("x")], 3)
    assert [(r.x, r["rank"]) for r in out.collect()] == [(0, 1), (1, 2), (2, 3)]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_all_fits_are_checked_in_one_pass(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, float(rng.randint(0, 2)), float(rng.randint(1, 9)), 2020.0, float(i % 12), "xyz"[i % 3], "FO"[i % 2]) for i in range(300)]
    df = spark.createDataFrame(rows, "policy_id long, claim_nb double, total_price double, order_year double, order_month double, "
                                     "priority string, status string")
    passes, moments = [], optimality.moments
    monkeypatch.setattr(optimality, "moments", lambda *a, **k: passes.append(1) or moments(*a, **k))
    out = claims.model_optimum(spark, df, reg_params=[0.01, 0.1]).collect()
    n = sum(7 * sum(r[1] == c for r in rows) // 10 for c in (0.0, 1.0, 2.0))
    assert len(passes) == 1 and len(out) == 6
    for r in out:
        assert r.at_optimum and r.n == n and abs(r.sum_label - r.sum_predicted) < 0.5, r
