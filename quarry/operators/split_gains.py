"""Exact gains of tree splits from one histogram of (feature, value, label).

Rows are counted per feature and value; the rows and positives at or below a
value are sums over ranges of the values, so features of any number of values
are handled.  A fitted tree's root is checked against these gains.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ranking import sums_before
from quarry.sources.worktables import WorkTables


def gini(n: Column, positives: Column) -> Column:
    share = F.try_divide(positives.cast("double"), n.cast("double"))
    return 2.0 * share * (1.0 - share)


def gain(n: Column, pos: Column, n_left: Column, pos_left: Column) -> Column:
    """How far a split lowers the mean Gini impurity."""
    n_right, pos_right = n - n_left, pos - pos_left
    return gini(n, pos) - (n_left / n * gini(n_left, pos_left) + n_right / n * gini(n_right, pos_right))


def split_gains(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, value, n, n_left, pos_left, gain) of every split ``feature <= value`` with rows on both sides.

    Rows without a label count nowhere, rows without a value of a feature not for it.
    """
    long = df.where(F.col(label).isNotNull()).unpivot([label], list(features), "feature", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("_c"), F.count(F.when(F.col(label) == 1, 1)).alias("_p"))
    totals = counts.groupBy("feature").agg(F.sum("_c").alias("n"), F.sum("_p").alias("pos"))
    work = WorkTables(df.sparkSession, "gains")
    below = sums_before(counts, ["feature"], [F.col("value")], {"_cb": "_c", "_pb": "_p"}, work)
    both = below.join(F.broadcast(totals), "feature").withColumns(
        {"n_left": F.col("_cb") + F.col("_c"), "pos_left": F.col("_pb") + F.col("_p")})
    return both.where(F.col("n_left") < F.col("n")).select(
        "feature", "value", "n", "n_left", "pos_left",
        gain(F.col("n"), F.col("pos"), F.col("n_left"), F.col("pos_left")).alias("gain"))


def root_split(tree) -> tuple[int, float, float]:
    """(feature index, threshold, gain) of a fitted tree's root."""
    root = tree._java_obj.rootNode()
    return root.split().featureIndex(), root.split().threshold(), root.gain()


def gain_at(df: DataFrame, feature: str, threshold: float, label: str) -> float:
    """The gain of one split, from one aggregate."""
    left = F.col(feature) <= threshold
    n, pos = F.count(F.lit(1)), F.count(F.when(F.col(label) == 1, 1))
    n_left, pos_left = F.count(F.when(left, 1)), F.count(F.when(left & (F.col(label) == 1), 1))
    r = df.agg(n.alias("n"), pos.alias("p"), n_left.alias("nl"), pos_left.alias("pl"))
    return r.select(gain(F.col("n"), F.col("p"), F.col("nl"), F.col("pl"))).first()[0]
