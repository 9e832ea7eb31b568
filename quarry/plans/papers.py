"""Count matrix -> one vector per paper -> standardised -> 2-D projection.

The matrix arrives in long form ``(row_label, column_label, n)`` (a wide CSV is
brought there with :func:`quarry.operators.grid.unpivot_wide`).  Transposing
swaps the labels; vectors are sparse and hold the sums of their cells, so the
work grows with the number of cells, however long either side is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import grid
from quarry.operators.gram import Projection, principal_components, sum_cells
from quarry.operators.ranking import numbered
from quarry.sources.worktables import WorkTables


def observation_vectors(long_df: DataFrame, obs_col: str, feature_col: str,
                        value_col: str = "n") -> DataFrame:
    """(obs, width, idx, val): one sparse vector per observation.

    A feature's position is its place (from 0) among all labels in order;
    repeated cells add up, cells that are missing are 0 and not listed.
    """
    work = WorkTables(long_df.sparkSession, "vectors")
    cells = work.keep(sum_cells(long_df, obs_col, feature_col, value_col), "cells", result=True)
    positions = numbered(cells.select(feature_col).distinct(), [F.col(feature_col)], "_place", work, "positions")
    width = positions.count()
    rows = cells.join(positions, feature_col).groupBy(obs_col).agg(F.sort_array(F.collect_list(
        F.struct((F.col("_place") - 1).cast("int").alias("p"), F.col(value_col).alias("v")))).alias("_c"))
    return rows.select(obs_col, F.lit(width).cast("long").alias("width"), F.col("_c.p").alias("idx"), F.col("_c.v").alias("val"))


def paper_vectors(long_df: DataFrame, row_col: str = "row_label", col_col: str = "column_label",
                  value_col: str = "n") -> DataFrame:
    """Word x paper counts -> one sparse vector of word counts per paper."""
    return observation_vectors(grid.transpose_long(long_df, row_col, col_col, value_col), row_col, col_col, value_col)


def paper_projection(long_df: DataFrame, row_col: str = "row_label",
                     col_col: str = "column_label", value_col: str = "n",
                     transpose: bool = True, k: int = 2) -> Projection:
    """Word x paper counts -> papers as observations -> ``k`` coordinates."""
    if transpose:
        long_df = grid.transpose_long(long_df, row_col, col_col, value_col)
    return principal_components(long_df, row_col, col_col, value_col, k)
