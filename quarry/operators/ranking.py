"""Ranks and prefix sums over a total order, without a one-task window.

Rows are dealt by ranges of the order and sorted within each range; a row's
place is the number of rows in earlier ranges (one number per range, added up
on the driver) plus its place in its own range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.joins import join_null_safe
from quarry.sources.worktables import WorkTables

_PLACES = (1 << 33) - 1


def in_ranges(df: DataFrame, order: Sequence[Column], work: WorkTables, name: str = "ordered",
              result: bool = False) -> DataFrame:
    """``df`` sorted over ranges and written, with its range ``_part`` and place ``_pos`` (from 0).

    ``order`` should end in a column that tells equal rows apart wherever one
    value may hold a large share of the rows, so that ranges can cut it.
    """
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_at", F.monotonically_increasing_id()))
    placed = work.keep(placed, name, result)
    return (placed.withColumn("_part", F.shiftright("_at", 33)).withColumn("_pos", F.col("_at").bitwiseAND(_PLACES))
            .drop("_at"))


def numbered(df: DataFrame, order: Sequence[Column], name: str, work: WorkTables, table: str = "ordered",
             result: bool = True) -> DataFrame:
    """``df`` with its 1-based place in the total order as a long column ``name``."""
    placed = in_ranges(df, order, work, table, result)
    counts = sorted(placed.groupBy("_part").count().collect())  # one row per range
    offsets, before = [], 0
    for part, n in counts:
        offsets.append((part, before))
        before += n
    offsets = df.sparkSession.createDataFrame(offsets, "_part long, _before long")
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + F.col("_pos") + 1).drop("_part", "_pos", "_before"))


def sums_before(df: DataFrame, by: Sequence[str], order: Sequence[Column], sums: Mapping[str, str],
                work: WorkTables, table: str = "ordered", result: bool = True) -> DataFrame:
    """``df`` with, per entry ``new: column`` of ``sums``, the sum over earlier rows of the ``by`` group.

    A row's sum is that of the group's earlier ranges plus that of the rows
    before it in its own range, so no task holds a whole group.
    """
    by = list(by)
    placed = in_ranges(df, [*[F.col(c) for c in by], *order], work, table, result)
    keys = ["_part", *by]
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range (and group in it).
    ranges = placed.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    ranges = ranges.select(*keys, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_r_{n}") for n in sums])
    before = Window.partitionBy(*keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    out = join_null_safe(placed, ranges, keys)
    out = out.withColumns({n: F.col(f"_r_{n}") + F.coalesce(F.sum(c).over(before), F.lit(0)) for n, c in sums.items()})
    return out.drop("_part", "_pos", *[f"_r_{n}" for n in sums])
