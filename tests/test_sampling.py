import datetime as dt
import math
import random
from fractions import Fraction

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions.columns import hash_order_key
from quarry.operators import cuts, sampling


def _classes(spark):
    rows = [(i, "big") for i in range(100)] + [(100 + i, "mid") for i in range(10)] + [(999, "one")]
    return spark.createDataFrame(rows, "k long, c string")


def test_stratified_split_floors_and_partition(spark):
    df = _classes(spark)
    out = sampling.stratified_split(df, "c", "k", 0.7, seed=3).collect()
    train = [r for r in out if r.split == "train"]
    assert len(out) == df.count()
    assert len({r.k for r in out}) == len(out)
    by = {}
    for r in train:
        by[r.c] = by.get(r.c, 0) + 1
    assert by.get("big") == 70 and by.get("mid") == 7 and by.get("one", 0) == 0


@pytest.mark.parametrize("ratio", [0.63, 1 / 3, Fraction(1, 3), 0.00004, 0.0, 1.0])
def test_stratified_split_equals_brute_force(spark, ratio):
    rnd = random.Random(5)
    rows = [(i, rnd.choice("abc")) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, c string")
    ours = {r.k: r.split for r in sampling.stratified_split(df, "c", "k", ratio, seed=9).collect()}
    h = df.withColumn("h", hash_order_key(F.col("k"), 9))
    w = Window.partitionBy("c").orderBy("h", "k")
    brute = h.withColumn("rn", F.row_number().over(w)).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("c")))
    share = Fraction(ratio).limit_denominator(10 ** 9)
    ref = {r.k: ("train" if r.rn <= math.floor(r.n * share) else "test") for r in brute.collect()}
    assert ours == ref


def test_small_fractions_of_many_rows_are_exact(spark):
    df = spark.range(100_000).select(F.col("id").alias("k"), F.lit("x").alias("c"))
    assert sampling.stratified_split(df, "c", "k", 0.00004).where("split = 'train'").count() == 4
    assert sampling.stratified_split(df.limit(99_999), "c", "k", 1 / 3).where("split = 'train'").count() == 33_333
    assert sampling.stratified_split(df.limit(3), "c", "k", 0.999999999).where("split = 'train'").count() == 2
    with pytest.raises(ValueError):
        sampling.stratified_split(df, "c", "k", 1.5)


def test_rare_classes_can_go_to_train(spark):
    out = sampling.stratified_split(_classes(spark), "c", "k", 0.7, seed=3, min_class=11)
    got = {(r.c, r.split): r["count"] for r in out.groupBy("c", "split").count().collect()}
    assert got == {("big", "train"): 70, ("big", "test"): 30, ("mid", "train"): 10, ("one", "train"): 1}


def test_temporal_split_tie_break(spark):
    t0 = dt.datetime(2024, 1, 1)
    ts = [t0 + dt.timedelta(hours=i) for i in range(6)] + [t0 + dt.timedelta(hours=6)] * 4
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "k long, ts timestamp_ntz")
    out = sampling.temporal_split(df, "ts", "k", (0.8,)).collect()
    train = sorted(r.k for r in out if r.split == "train")
    test = sorted(r.k for r in out if r.split == "test")
    assert train == [0, 1, 2, 3, 4, 5, 6, 7] and test == [8, 9]
    assert max(ts[k] for k in train) <= min(ts[k] for k in test)


def test_duplicate_rows_are_split_exactly(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t0)] * 5 + [(2, t0)], "k long, ts timestamp_ntz")
    out = sampling.temporal_split(df, "ts", "k", (0.5,)).collect()
    assert sum(r.split == "train" for r in out) == 3 and len(out) == 6


def test_holdout_and_sample(spark):
    df = _classes(spark)
    h = sampling.holdout_split(df, "c", "k", 0.7, 0.9).groupBy("split").count().collect()
    got = {r.split: r["count"] for r in h}
    assert sum(got.values()) == 111 and got["test"] == 111 - 77
    s1 = sampling.stratified_sample(df, "c", "k", 0.5, seed=1).count()
    s2 = sampling.stratified_sample(df, "c", "k", 0.5, seed=1).count()
    assert s1 == s2 and 30 < s1 < 80
    only_big = sampling.stratified_sample(df, "c", "k", {"big": 1.0}).count()
    assert only_big == 100


def test_kfold_column(spark):
    df = _classes(spark)
    folds = {r.fold for r in sampling.kfold_column(df, "k", 3).collect()}
    assert folds == {0, 1, 2}


def test_null_class_and_null_time_are_kept(spark):
    rows = [(i, None if i % 4 == 0 else "a", None if i % 5 == 0 else dt.datetime(2024, 1, 1 + i % 9))
            for i in range(40)]
    df = spark.createDataFrame(rows, "k long, c string, ts timestamp_ntz")
    s = sampling.stratified_split(df, "c", "k", 0.5).collect()
    assert len(s) == 40 and sum(r.split == "train" for r in s if r.c is None) == 5
    t = sampling.temporal_split(df, "ts", "k", (0.5,)).collect()
    assert len(t) == 40 and sum(r.split == "train" for r in t) == 20


def _same_split(df, label_rows):
    """The multiset of labelled rows under several partitionings."""
    got = [sorted(map(repr, label_rows(df.repartition(n)).collect())) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2]
    return got[0]


def test_mass_ties_are_told_apart_by_the_whole_row(spark):
    """Half of the rows share time and key but differ elsewhere: the same rows go everywhere."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [(7, t0, f"v{i}") for i in range(300)] + [(i, t0 + dt.timedelta(days=i % 9 - 4), None) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v string")
    out = _same_split(df, lambda d: sampling.temporal_split(d, "ts", "k", (0.41, 0.5)))
    assert sum("train_frac=0.41, split='train'" in r for r in out) == 246
    assert sum("train_frac=0.5, split='train'" in r for r in out) == 300


def test_cuts_among_equal_rows_are_exact(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(7, t0, None)] * 50 + [(8, t0, "x")] * 10 + [(6, t0, "y")], "k long, ts timestamp_ntz, v string")
    out = _same_split(df, lambda d: sampling.temporal_split(d, "ts", "k", (0.1, 1 / 3, 0.9)))
    for f, n in ((0.1, 6), (1 / 3, 20), (0.9, 54)):
        train = [r for r in out if f"train_frac={f}, split='train'" in r]
        assert len(train) == n and sum("k=6" in r for r in train) == 1 and sum("k=8" in r for r in train) == max(0, n - 51)
    assert len(out) == 183
    with_map = df.withColumn("m", F.create_map(F.lit("a"), F.col("k")))
    assert sampling.temporal_split(with_map, "ts", "k", (0.5,)).where("split = 'train'").count() == 30
    classes = df.withColumn("c", F.when(F.col("k") > 7, "a"))
    held = sampling.holdout_split(classes.repartition(5), "c", "k", 0.5, 0.5).groupBy("c", "split").count().collect()
    assert {(r.c, r.split): r["count"] for r in held} == {("a", "fit"): 2, ("a", "validate"): 3, ("a", "test"): 5,
                                                         (None, "fit"): 12, (None, "validate"): 13, (None, "test"): 26}


def test_random_times_equal_brute_force(spark):
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(rnd.randrange(50), t0 + dt.timedelta(minutes=rnd.randrange(3) * 90, seconds=rnd.randrange(3))) for _ in range(400)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz")
    got = sorted((r.ts, r.k, r.split) for r in sampling.temporal_split(df, "ts", "k", (0.37,)).collect())
    assert got == sorted((t, k, "train" if i < 148 else "test") for i, (t, k) in enumerate(sorted((t, k) for k, t in rows)))


def test_empty_table_and_many_classes(spark):
    df = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 1500).alias("c"))
    assert sampling.stratified_split(df.limit(0), "c", "k").count() == 0
    out = sampling.stratified_split(df, "c", "k", 0.5).groupBy("c").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("split") == "train", 1)).alias("t"))
    assert out.where("t <> floor(n / 2)").count() == 0 and out.count() == 1500


def test_rows_are_not_exchanged(spark):
    """Labelling compares rows in place, also where Spark would broadcast nothing by itself."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderstatus")
        for out in (sampling.stratified_split(df, "o_orderstatus", "o_orderkey"),
                    sampling.holdout_split(df, "o_orderstatus", "o_orderkey")):
            out.collect()
            plan = out._jdf.queryExecution().executedPlan().toString()
            final = plan.split("== Initial Plan ==")[0]
            assert "BroadcastHashJoin" in final and "hashpartitioning" not in final and "rangepartitioning" not in final
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string"])
def test_only_keys_near_the_cuts_are_sorted(spark, monkeypatch, kind):
    """The sorted keys are those of the buckets in which a cut falls, the split that of sorting all."""
    sizes, in_ranges = [], cuts.in_ranges
    monkeypatch.setattr(cuts, "in_ranges", lambda df, *a, **k: sizes.append(df.count()) or in_ranges(df, *a, **k))
    df = spark.range(20_000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("c"),
        F.when(F.col("id") % 50 > 0, F.timestamp_seconds(F.xxhash64("id") % 5_000_000)).cast(kind).alias("ts"))
    out = sampling.stratified_split(df, "c", "k", 0.7, seed=3)
    assert sizes[0] <= 60
    w = Window.partitionBy("c").orderBy(hash_order_key(F.col("k"), 3))
    want = df.withColumn("split", F.when(F.row_number().over(w) <= 4666, "train").otherwise("test"))
    assert out.count() == 20_000 and out.exceptAll(want).count() == 0
    out = sampling.temporal_bands(df, "ts", "k", (0.01, 0.4, 0.8))
    assert sizes[1] <= (20_000 if kind == "string" else 1_200)  # the rows without a time and two of 116 days
    at = F.row_number().over(Window.orderBy("ts", "k"))
    want = df.withColumn("band", sum((at > n).cast("int") for n in (200, 8_000, 16_000)).cast("int"))
    assert out.count() == 20_000 and out.exceptAll(want).count() == 0
