"""Calendar parts, zero-filled activity grids, pivots and matrix transposes.

Everything is one grouped plan for all keys at once (no per-key driver
loop): the grid spine is generated per key with ``sequence`` + ``explode``
from that key's own day bounds, then left-joined to the counts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.joins import join_null_safe


def calendar_parts(df: DataFrame, ts_col: str = "ts", day_col: str = "day",
                   hour_col: str = "hour") -> DataFrame:
    """Add the calendar date and the hour (0-23) of a local timestamp."""
    return df.withColumns({day_col: F.to_date(F.col(ts_col)),
                           hour_col: F.hour(F.col(ts_col)).cast("int")})


def day_hour_counts(df: DataFrame, keys: Sequence[str], ts_col: str = "ts",
                    n_col: str = "n") -> DataFrame:
    """Rows per (keys, day, hour)."""
    return (calendar_parts(df, ts_col).groupBy(*keys, "day", "hour")
            .agg(F.count(F.lit(1)).alias(n_col)))


def dense_grid(counts: DataFrame, keys: Sequence[str], n_col: str = "n",
               day_col: str = "day", hour_col: str = "hour", max_days: int = 3660,
               span: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Every (day in [min, max] of the key) x (hour 0..23) cell; missing = 0.

    ``counts`` holds one row per (keys, day, hour) that occurred.  The spine
    is a superset of the data by construction (its bounds come from the same
    rows), so a left join from the spine loses nothing; keys are matched
    null-safely.  Rows without a timestamp have no cell.

    ``span`` gives first and last day of every key instead.  A key whose days
    span more than ``max_days``, or lie outside a given ``span``, fails the job
    (one wrong clock would make a grid of millions of days); nothing is cut off.
    """
    keys = list(keys)
    bounds = counts.groupBy(*keys).agg(F.min(day_col).alias("_lo"), F.max(day_col).alias("_hi"))
    if span:
        first, last = (F.lit(d) for d in span)
        wrong, text = (F.col("_lo") < first) | (F.col("_hi") > last), f"days outside the span {span[0]} to {span[1]}: "
    else:
        first, last = F.col("_lo"), F.col("_hi")
        wrong, text = F.datediff("_hi", "_lo") >= max_days, f"a grid of more than {max_days} days: "
    days = F.when(F.coalesce(wrong, F.lit(False)), F.raise_error(F.concat(F.lit(text), F.concat_ws(" to ", "_lo", "_hi"))))
    days = days.otherwise(F.when(F.col("_lo").isNotNull(), F.sequence(first, last, F.expr("INTERVAL 1 DAY"))))
    spine = (bounds.select(*keys, F.explode(days).alias(day_col))
             .select(*keys, day_col, F.explode(F.sequence(F.lit(0), F.lit(23))).alias(hour_col)))
    return (join_null_safe(spine, counts, keys + [day_col, hour_col], "left")
            .select(*keys, day_col, hour_col,
                    F.coalesce(F.col(n_col), F.lit(0).cast("long")).alias(n_col)))


def pivot_hours(grid: DataFrame, keys: Sequence[str], n_col: str = "n",
                hour_col: str = "hour", prefix: str = "h") -> DataFrame:
    """Long (keys, hour, n) -> one row per keys with columns h00..h23.

    The 24 pivot values are given, so Spark does not run a job to discover
    them; an hour without a row is 0.
    """
    wide = grid.groupBy(*keys).pivot(hour_col, list(range(24))).agg(F.max(n_col))
    return wide.select(*keys, *[F.coalesce(F.col(str(h)), F.lit(0).cast("long"))
                                .alias(f"{prefix}{h:02d}") for h in range(24)])


def transpose_long(long_df: DataFrame, row_col: str = "row_label",
                   col_col: str = "column_label", value_col: str = "n") -> DataFrame:
    """Transpose a matrix held in long form: swap the row and column labels.

    A wide matrix is first brought to long form with ``DataFrame.unpivot``;
    the transpose is then a projection (no shuffle, nothing on the driver).
    """
    return long_df.select(F.col(col_col).alias(row_col), F.col(row_col).alias(col_col),
                          F.col(value_col))


def unpivot_wide(df: DataFrame, id_col: str, row_col: str = "row_label",
                 col_col: str = "column_label", value_col: str = "n") -> DataFrame:
    """Wide matrix (one id column + one numeric column per label) -> long form."""
    value_cols = [c for c in df.columns if c != id_col]
    return (df.unpivot(id_col, value_cols, col_col, value_col)
            .withColumnRenamed(id_col, row_col)
            .withColumn(value_col, F.col(value_col).try_cast("double")))
