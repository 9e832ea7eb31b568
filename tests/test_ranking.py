"""Ranks over ranges and the work tables under them."""

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.ranking import numbered
from quarry.sources.worktables import WorkTables


def test_numbers_equal_a_window_whatever_the_ties(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 11).alias("v")).repartition(7)
    want = df.withColumn("n", F.row_number().over(Window.orderBy("v", F.desc("id"))).cast("long"))
    work = WorkTables(spark, "test")
    got = numbered(df, [F.col("v"), F.col("id").desc()], "n", work)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert numbered(df.limit(0), [F.col("v")], "n", work, "none").count() == 0


def test_no_partition_holds_all_rows_of_one_value(spark):
    df = spark.range(40000).select("id", F.lit(1).alias("v"))
    work = WorkTables(spark, "test")
    with work:
        ranked = numbered(df.repartition(4), [F.col("v"), F.col("id")], "n", work)
        assert ranked.where("n <> id + 1").count() == 0


def test_work_tables_go_when_superseded(spark):
    def there(work):
        return sorted(os.listdir(work.folder.removeprefix("file:"))) if os.path.isdir(work.folder.removeprefix("file:")) else []

    with WorkTables(spark, "test") as work:
        a = work.keep(spark.range(10).toDF("x"), "a")
        b = work.keep(a.where("x > 3"), "b", result=True)
        work.drop("a")
        work.keep(spark.range(3).toDF("x"), "c")
        assert there(work) == ["b", "c"]
    assert there(work) == ["b"] and b.count() == 6
    with WorkTables(spark, "test") as work:
        work.keep(spark.range(3).toDF("x"), "c")
    assert there(work) == []
