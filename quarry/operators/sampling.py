"""Repeatable, exact splits and samples.

Every split is a function of the rows' values only (an md5 of ``"<seed>:<key>"``
or the row's timestamp, and the whole row where these tie), never of ``rand()``
or of the partitioning, so a lost executor recomputes exactly the same rows and
the same split comes out on every cluster.  The work is done by the cuts of
:mod:`quarry.operators.cuts`: only keys are sorted, rows are compared with one
key per class and stay where they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import hash_order_key, threshold_hex
from quarry.operators.cuts import Cuts, find_cuts, label as label_rows

#: Hex digits of a digest by which rows are counted before keys are sorted: 4096 buckets.
DIGITS = 3


def _named(band: Column, names: tuple[str, str]) -> Column:
    return F.when(band == 0, F.lit(names[0])).otherwise(F.lit(names[1]))


def _split_cuts(df: DataFrame, label: str, key: str, ratio: float | Fraction, seed: int, min_class: int) -> Cuts:
    digest = hash_order_key(F.col(key), seed)
    return find_cuts(df, [label], [digest, F.col(key)], [ratio], min_class, F.substring(digest, 1, DIGITS))


def _day(df: DataFrame, ts: str) -> Column | None:
    """The day of a time, as a number; none for other types."""
    kind = dict(df.dtypes)[ts]
    if kind == "timestamp":
        # Not the local date, which may go back by a day where clocks are set back at midnight.
        return F.floor(F.unix_seconds(F.col(ts)) / 86400)
    return F.to_date(F.col(ts)) if kind in ("date", "timestamp_ntz") else None


def stratified_split(df: DataFrame, label: str, key: str, ratio: float | Fraction = 0.7,
                     seed: int = 14, split_col: str = "split",
                     names: tuple[str, str] = ("train", "test"), min_class: int = 0) -> DataFrame:
    """Exact stratified split: per class the first ``floor(ratio * n)`` rows
    in md5 order go to ``names[0]``, the rest to ``names[1]``.

    Class shares are therefore equal in both parts up to one row per class.
    Classes of fewer than ``min_class`` rows go to ``names[0]`` as a whole.
    """
    cuts = _split_cuts(df, label, key, ratio, seed, min_class)
    return label_rows(df, cuts, "_band").withColumn(split_col, _named(F.col("_band"), names)).drop("_band")


def holdout_split(df: DataFrame, label: str, key: str, ratio: float | Fraction = 0.7,
                  inner_ratio: float | Fraction = 0.9, seed: int = 14, inner_seed: int = 15,
                  split_col: str = "split", min_class: int = 0) -> DataFrame:
    """Train/test split, then the train part split again into fit/validate.

    The inner cuts are found among the keys of the train part; both labels are
    then made in one pass over the rows.
    """
    outer = label_rows(df, _split_cuts(df, label, key, ratio, seed, min_class), "_outer")
    train = F.col("_outer") == 0
    inner = _split_cuts(outer.where(train), label, key, inner_ratio, inner_seed, min_class)
    both = label_rows(outer, inner, "_inner", only=train)
    name = F.when(train, _named(F.col("_inner"), ("fit", "validate"))).otherwise(F.lit("test"))
    return both.withColumn(split_col, name).drop("_outer", "_inner")


def stratified_sample(df: DataFrame, label: str, key: str,
                      fractions: float | Fraction | Mapping[object, float | Fraction], seed: int = 7) -> DataFrame:
    """Bernoulli sample per class: rows whose key's md5 is below the fraction (no shuffle, repeatable).

    A single ``fraction`` keeps the class balance; a mapping gives one
    fraction per class (classes not in it are dropped, as with ``sampleBy``).
    """
    digest = hash_order_key(F.col(key), seed)
    if not isinstance(fractions, Mapping):
        return df.filter(digest < F.lit(threshold_hex(fractions)))
    pairs = [F.lit(x) for cls, f in fractions.items() for x in (cls, threshold_hex(f))]
    return df.filter(digest < F.try_element_at(F.create_map(*pairs), F.col(label)))


def temporal_bands(df: DataFrame, ts: str, key: str | Sequence[str], fractions: Sequence[float | Fraction],
                   band_col: str = "band") -> DataFrame:
    """``df`` with the number of fractions whose oldest rows do not include the row.

    With fractions in ascending order, band ``b`` is train for the fractions
    from the ``b``-th (0-based) on and test for those before it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return label_rows(df, find_cuts(df, [], [F.col(c) for c in (ts, *keys)], fractions, bucket=_day(df, ts)), band_col)


def temporal_split(df: DataFrame, ts: str, key: str | Sequence[str],
                   fractions: Sequence[float] = (0.4, 0.6, 0.8),
                   frac_col: str = "train_frac", split_col: str = "split") -> DataFrame:
    """Oldest ``floor(f * n)`` rows (by ts, then key) train, the rest test, for every fraction ``f``.

    The bands of one pass, written out as one copy of the rows per fraction;
    jobs that need no copies use :func:`temporal_bands`.
    """
    ordered = sorted(fractions)
    banded = temporal_bands(df, ts, key, ordered, "_band")
    copies = F.array(*[F.struct(F.lit(float(f)).alias("f"), (F.col("_band") <= i).alias("head"))
                       for i, f in enumerate(ordered)])
    return (banded.withColumn("_copy", F.explode(copies))
            .withColumns({frac_col: F.col("_copy.f"),
                          split_col: F.when(F.col("_copy.head"), "train").otherwise("test")})
            .drop("_copy", "_band"))


def kfold_column(df: DataFrame, key: str, k: int, seed: int = 11,
                 fold_col: str = "fold") -> DataFrame:
    """Repeatable fold id 0..k-1 from the key's md5 (for ``CrossValidator(foldCol=)``)."""
    h = hash_order_key(F.col(key), seed)
    return df.withColumn(fold_col, F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"),
                                          F.lit(k)).cast("int"))
