import math

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from quarry.operators import features


def test_claim_labels(spark):
    df = spark.createDataFrame([("a", "0"), ("b", "1"), ("c", "4"), ("d", None), ("e", "x")],
                               "id string, claim_nb string")
    rows = {r.id: r for r in features.claim_labels(df).collect()}
    assert "claim_nb" not in features.claim_labels(df).columns
    assert (rows["a"].nz_claim, rows["a"].pp_claim_nb) == (0.0, 0.5)
    assert math.isclose(rows["a"].log_claim_nb, math.log(0.5))
    assert (rows["b"].nz_claim, rows["b"].pp_claim_nb, rows["b"].log_claim_nb) == (1.0, 1.0, 0.0)
    assert rows["c"].pp_claim_nb == 4.0 and math.isclose(rows["c"].log_claim_nb, math.log(4))
    for k in ("d", "e"):     # NULL and unparsable: flag 0, shifted and log NULL
        assert rows[k].nz_claim == 0.0 and rows[k].pp_claim_nb is None
        assert rows[k].log_claim_nb is None


def test_category_index_matches_string_indexer(spark):
    vals = ["b"] * 3 + ["a"] * 3 + ["c"] * 5 + ["d"]
    df = spark.createDataFrame([(v,) for v in vals], "cat string")
    ours = [r.cat for r in features.category_index(df, "cat").orderBy("idx").collect()]
    theirs = StringIndexer(inputCol="cat", outputCol="i").fit(df).labels
    assert ours == list(theirs) == ["c", "a", "b", "d"]


def test_one_hot_sparse_drops_last(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["x", "x", "y", "z"])],
                               "k long, cat string")
    rows = {r.k: r for r in features.one_hot_sparse(df, "cat", "k").collect()}
    assert rows[0].slot == 0 and rows[2].slot == 1 and rows[3].slot is None
    assert {r.width for r in rows.values()} == {2}


def test_scaler_uses_sample_std_without_centring(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    out = [r.x_scaled for r in features.scale_columns(df, ["x"]).orderBy("x").collect()]
    assert [round(v, 12) for v in out] == [1.0, 2.0, 3.0]   # sample std of 1,2,3 is 1


def test_standardise_zero_variance(spark):
    df = spark.createDataFrame([(1, [1.0, 5.0]), (2, [3.0, 5.0])], "id int, v array<double>")
    z, _ = features.standardise_array(df, "v")
    rows = sorted((r.id, r.z) for r in z.collect())
    assert [round(x, 9) for x in rows[0][1]] == [-0.707106781, 0.0]


def test_dense_ids_are_dense_and_unique(spark):
    df = spark.createDataFrame([(k,) for k in [10**12, 5, 5, 7, 3 * 10**11, None]], "k long")
    m = features.dense_ids(df, "k", "idx").collect()
    assert sorted(r.idx for r in m) == [0, 1, 2, 3]
    assert len({r.k for r in m}) == 4


def test_scaling_ignores_missing_values(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, None)], "id int, x double")
    got = {r["id"]: r["x_scaled"] for r in features.scale_columns(df, ["x"]).collect()}
    assert got[3] is None
    assert abs(got[1] - 1.0 / 2 ** 0.5) < 1e-12 and abs(got[2] - 3.0 / 2 ** 0.5) < 1e-12


def test_model_pipeline_drops_the_last_category(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0), ("c", 4.0)], "k string, x double")
    model = features.feature_pipeline(["x"], ["k"]).fit(df)
    assert {r["features"].size for r in model.transform(df).collect()} == {3}


def test_ranks_of_many_categories_equal_the_indexer(spark):
    df = spark.range(6000).select(((F.col("id") * F.col("id")) % 997).cast("string").alias("cat"))
    ours = {r.cat: (r.idx, r.n) for r in features.category_index(df, "cat").collect()}
    theirs = {r.cat: (r.idx, r.n) for r in features.indexed(df, "cat").collect()}
    assert ours == theirs and len(ours) > 400


def test_models_scaling_equals_the_table_form_and_refuses_missing(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, c double")
    for r, q in zip(features.model_scaled(df, ["x", "c"]).orderBy("x").collect(), features.scale_columns(df, ["x", "c"]).orderBy("x").collect()):
        assert abs(r.x_scaled - q.x_scaled) < 1e-12 and r.c_scaled == q.c_scaled == 0.0
    with pytest.raises(Exception):
        features.model_scaled(df.unionAll(spark.sql("SELECT CAST(NULL AS DOUBLE), 1D")), ["x"]).collect()
