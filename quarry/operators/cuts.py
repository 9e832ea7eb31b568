"""Exact cuts: one key per class below which lies the head of the class.

The first ``floor(f * n)`` rows of each class in a total order are those whose
key does not exceed the key of the row at that place.  A row's key is its order
values and, after them, a hash of the whole row, so rows tied in the order are
told apart by what they hold, never by where they lie.

:func:`find_cuts` counts the rows per class and bucket of the order, sorts only
the keys of the buckets in which a wanted place lies (narrow rows, dealt by
ranges), numbers them and returns the keys there: one row per class and fraction.
:func:`label` then compares every row with the cuts of its class: a broadcast
of that table behind a check of its size, no exchange of the rows themselves.
Several fractions are bands of one pass: band ``b`` lies in the head of every
fraction from the ``b``-th on.

Rows equal in every column share a key.  Where a cut falls among such copies,
the copies are counted per partition and dealt out by their number (which copy
goes where cannot be seen in the result).
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ranking import in_ranges
from quarry.sources.worktables import WorkTables

#: The table of cuts is broadcast up to this many bytes, joined by class beyond.
BROADCAST_BYTES = 32 << 20
#: Floats stand for the simplest fraction nearby, so that 1/3 means a third.
LARGEST_DENOMINATOR = 10 ** 9


def exact(fraction: float | Fraction) -> Fraction:
    value = Fraction(fraction).limit_denominator(LARGEST_DENOMINATOR)
    if not 0 <= value <= 1:
        raise ValueError(f"fraction must be in [0, 1], got {fraction}")
    return value


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of all columns in which NULL differs from absence."""
    columns = [F.col(f"`{n}`") if not t.startswith(("map", "variant")) else F.to_json(F.struct(f"`{n}`"))
               for n, t in df.dtypes]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


class Cuts(NamedTuple):
    by: list[str]
    order: list[Column]
    #: One row per class: ``_cut_class`` and ``_cut_list``, per fraction the key of the last head row
    #: (``k``, NULL: empty head), copies of it in all (``copies``) and in the head (``inside``).
    table: DataFrame
    broadcast: bool
    #: Whether some cut falls among rows that are equal in every column.
    partial: bool


def _class(by: Sequence[str]) -> Column:
    # A struct, so that a NULL class is a class like any other.
    return F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))


def _key(df: DataFrame, order: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], row_hash(df).alias("h"))


def find_cuts(df: DataFrame, by: Sequence[str], order: Sequence[Column], fractions: Sequence[float | Fraction],
              min_class: int = 0, bucket: Column | None = None) -> Cuts:
    """The cuts of ``df`` at ``fractions`` (ascending); classes of fewer than ``min_class`` rows are all head.

    ``bucket`` has few values and never falls where the order ascends (the
    first digits of a digest, the day of a time).  Without one, every key of a
    class is sorted.
    """
    shares = [exact(f) for f in fractions]
    if shares != sorted(shares):
        raise ValueError("fractions must ascend")
    bucket = F.lit(0) if bucket is None else bucket
    with WorkTables(df.sparkSession, "cuts") as work:
        rows = df.withColumn("_cell", F.struct(_class(by).alias("c"), bucket.alias("b")))
        wanted = F.array(*[F.struct(F.lit(i).alias("i"), _floor_of(F.col("_all"), s, min_class).alias("need"))
                           for i, s in enumerate(shares)])
        earlier = Window.partitionBy("_cell.c").orderBy("_cell.b").rowsBetween(Window.unboundedPreceding, -1)
        cells = (rows.groupBy("_cell").agg(F.count("*").alias("_n"))
                 .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
                 .withColumn("_all", F.sum("_n").over(Window.partitionBy("_cell.c")))
                 .select("*", F.explode(wanted).alias("_w")).select("*", "_w.i", "_w.need"))
        # One row per class and fraction: the cell in which the head ends and how many of its rows are in the
        # head, no cell where the head is empty.
        ends = (F.col("_before") < F.col("need")) & (F.col("need") <= F.col("_before") + F.col("_n"))
        places = cells.where(ends | ((F.col("need") == 0) & (F.col("_before") == 0))).select(
            F.col("_cell.c").alias("_cut_class"), "i", F.when(F.col("need") > 0, F.col("_cell")).alias("_cell"),
            (F.col("need") - F.col("_before")).alias("need"))
        places = work.keep(places, "places")
        cut = places.where(F.col("_cell").isNotNull())
        near = rows.join(cut.select("_cell").distinct(), "_cell", "left_semi")
        # The row number spreads equal keys over ranges; their order among themselves means nothing.
        keys = near.select("_cell", _key(df, order).alias("_cut_key"), F.monotonically_increasing_id().alias("_r"))
        placed = in_ranges(keys, [F.col("_cell"), F.col("_cut_key"), F.col("_r")], work).drop("_r")
        parts = placed.groupBy("_part", "_cell").agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
        earlier = Window.partitionBy("_cell").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        # Rows that end a head: one per class and fraction, none where the head is empty.
        at = (parts.join(cut, "_cell").where(ends)
              .select("_part", (F.col("_first") + F.col("need") - F.col("_before") - 1).alias("_pos"), "i", "need"))
        found = placed.join(at, ["_part", "_pos"]).select("_cell", "i", "need", F.col("_cut_key").alias("k"))
        found = work.keep(found, "found")
        met = placed.join(found, "_cell").where(F.col("_cut_key") <= F.col("k"))
        copies = met.groupBy("_cell", "i").agg(
            F.count(F.when(F.col("_cut_key") == F.col("k"), 1)).alias("copies"),
            F.count(F.when(F.col("_cut_key") < F.col("k"), 1)).alias("below"))
        ready = (found.join(copies, ["_cell", "i"])
                 .select(F.col("_cell.c").alias("_cut_class"), "i", "k", "copies", (F.col("need") - F.col("below")).alias("inside")))
        table = (places.select("_cut_class", "i").join(ready, ["_cut_class", "i"], "left").groupBy("_cut_class")
                 .agg(F.sort_array(F.collect_list(F.struct("i", "k", "copies", "inside"))).alias("_cut_list")))
        table = work.keep(table, "cuts", result=True)
    size, partial = table.agg(F.sum(F.length(F.to_json(F.struct("*")))),
                              F.max(F.exists("_cut_list", lambda c: c["inside"] < c["copies"]))).first()
    return Cuts(list(by), list(order), table, (size or 0) <= BROADCAST_BYTES, bool(partial))


def _floor_of(n: Column, share: Fraction, min_class: int) -> Column:
    # 38 digits hold any row count times any numerator exactly; integer division does not round.
    whole = F.lit(share.numerator).cast("decimal(10,0)") * n.cast("decimal(20,0)")
    need = F.call_function("div", whole, F.lit(share.denominator).cast("decimal(10,0)")).cast("long")
    return F.when(n < min_class, n).otherwise(need) if min_class else need


def label(df: DataFrame, cuts: Cuts, band: str = "band", only: Column | None = None) -> DataFrame:
    """``df`` with the number of heads that a row misses (0: in all) as int column ``band``.

    ``df`` must have the columns that the cuts were found with.  Rows for which
    ``only`` does not hold get NULL.
    """
    columns = df.columns
    keyed = df.withColumns({"_cut_class": _class(cuts.by), "_cut_key": _key(df, cuts.order)})
    table = F.broadcast(cuts.table) if cuts.broadcast else cuts.table
    keyed = keyed.join(table, "_cut_class", "left")
    missed = F.size(F.filter("_cut_list", lambda c: c["k"].isNull() | (c["k"] < F.col("_cut_key")))).cast("int")
    if only is not None:
        missed = F.when(only, missed)
    if not cuts.partial:
        return keyed.withColumn(band, missed).select(*columns, band)
    split = F.exists("_cut_list", lambda c: (c["k"] == F.col("_cut_key")) & (c["inside"] < c["copies"]))
    split = F.coalesce(split if only is None else split & only, F.lit(False))
    rest = keyed.where(~split).withColumn(band, missed).select(*columns, band)
    return rest.unionByName(_deal_copies(keyed.where(split), columns, band))


def _deal_copies(copies: DataFrame, columns: list[str], band: str) -> DataFrame:
    """Rows among which cuts fall: counted per partition, numbered by the counts, written out again."""
    kinds = dict(copies.dtypes)
    plain = [c for c in columns if not kinds[c].startswith(("map", "variant"))]
    others = [c for c in columns if c not in plain]
    counted = (copies.groupBy("_cut_class", "_cut_key", *plain, F.spark_partition_id().alias("_pid"))
               .agg(F.count("*").alias("_n"), F.first("_cut_list").alias("_cut_list"), *[F.first(c).alias(c) for c in others]))
    earlier = Window.partitionBy("_cut_class", "_cut_key").orderBy("_pid", *plain).rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("_off", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    # Copy number x (from 1) misses the heads that hold fewer than x copies.
    inside = F.transform("_cut_list", lambda c: F.when(c["k"].isNull() | (c["k"] < F.col("_cut_key")), F.lit(0).cast("long"))
                         .when(c["k"] == F.col("_cut_key"), c["inside"]).otherwise(F.lit(2 ** 62)))
    dealt = counted.withColumn("_inside", inside).repartition("_pid")
    dealt = dealt.withColumn("_x", F.explode(F.sequence(F.col("_off") + 1, F.col("_off") + F.col("_n"))))
    return (dealt.withColumn(band, F.size(F.filter("_inside", lambda n: n < F.col("_x"))).cast("int"))
            .select(*columns, band))
