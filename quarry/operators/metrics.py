"""Model-quality metrics as aggregates (one pass, grouped, no driver hop).

* regression: RMSE, MAE and MSE together in one ``agg``;
* classification: accuracy with the confusion counts;
* area under ROC, exact, with mid-ranks for tied scores -- from per-score
  counts and prefix sums over ranges of the score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ranking import sums_before
from quarry.sources.worktables import WorkTables


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def regression_metrics(df: DataFrame, label: str | Column, prediction: str | Column,
                       by: Sequence[str] = ()) -> DataFrame:
    """``n, n_unscored, rmse, mae, mse`` of ``prediction`` against ``label`` per group.

    Rows whose label or prediction is NULL or NaN have no error; they are
    counted in ``n_unscored``.
    """
    d = (_c(prediction).cast("double") - _c(label).cast("double"))
    ok = d.isNotNull() & ~F.isnan(d)
    dd = F.when(ok, d)
    mse = F.avg(dd * dd)
    return df.groupBy(*by).agg(F.count(dd).alias("n"), (F.count(F.lit(1)) - F.count(dd)).alias("n_unscored"), F.sqrt(mse).alias("rmse"),
                               F.avg(F.abs(dd)).alias("mae"), mse.alias("mse"))


def classification_report(df: DataFrame, label: str | Column, prediction: str | Column,
                          by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and binary confusion counts (positive class = 1); rows without
    a label or a prediction are counted in ``n_unscored`` only."""
    y = _c(label).cast("double")
    p = _c(prediction).cast("double")

    def cnt(cond: Column) -> Column:
        return F.count(F.when(cond, F.lit(1)))

    return df.groupBy(*by).agg(
        F.count((y == p)).alias("n"), cnt((y == p).isNull()).alias("n_unscored"),
        F.avg((y == p).cast("double")).alias("accuracy"),
        cnt((y == 1) & (p == 1)).alias("tp"), cnt((y != 1) & (p == 1)).alias("fp"),
        cnt((y != 1) & (p != 1)).alias("tn"), cnt((y == 1) & (p != 1)).alias("fn"))


def area_under_roc(df: DataFrame, score: str | Column, label: str | Column,
                   by: Sequence[str] = ()) -> DataFrame:
    """Exact ``auc, n_pos, n_neg, n_unscored`` per group; ``auc`` is NULL when a class is absent.

    AUC = sum over positives of (#negatives scored lower + 0.5 * #negatives
    tied) / (P * N), i.e. the Mann-Whitney statistic with mid-ranks.  Rows with
    a NULL or NaN score or a NULL label rank nowhere and are counted in
    ``n_unscored``.  A hard label is a score like any other (0 or 1).

    Plan: one pass counts positives and negatives per distinct score; these
    counts are sorted over ranges of (group, score), and the negatives below a
    score are those of the group's earlier ranges plus those before it in its
    own range.  No task holds a whole group, the sums are integers.
    """
    by = list(by)
    value, pos = _c(score).cast("double"), _c(label).cast("double") == 1.0
    ranked = value.isNotNull() & ~F.isnan(value) & pos.isNotNull()
    rows = df.select(*by, F.when(ranked, value).alias("_s"), pos.alias("_pos"), ranked.alias("_ok"))
    per = rows.groupBy(*by, "_s").agg(
        F.count(F.when(F.col("_ok") & F.col("_pos"), 1)).alias("_p"),
        F.count(F.when(F.col("_ok") & ~F.col("_pos"), 1)).alias("_n"),
        F.count(F.when(~F.col("_ok"), 1)).alias("_u"))
    per = sums_before(per, by, [F.col("_s")], {"_below": "_n"}, WorkTables(df.sparkSession, "auc"))
    # Twice the pairs won, in integers of up to 38 digits.
    won = F.col("_p").cast("decimal(19,0)") * (2 * F.col("_below") + F.col("_n")).cast("decimal(19,0)")
    total = per.groupBy(*by).agg(F.sum(won).alias("_won"), F.sum("_p").alias("n_pos"), F.sum("_n").alias("n_neg"),
                                 F.sum("_u").alias("n_unscored"))
    pairs = 2.0 * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return total.select(*by, F.try_divide(F.col("_won").cast("double"), pairs).alias("auc"), "n_pos", "n_neg", "n_unscored")
