"""Per-group counts, distinct counts, shares and top-N reports.

Scale notes
-----------
* Every count is a two-phase hash aggregate (partial on the map side, final
  after the exchange), so a group holding a third of all rows only costs
  one partial row per input partition.
* Rankings never run over raw rows: rows are aggregated to one row per
  (group, item) first.  ``row_number() <= n`` directly after the window lets
  Catalyst insert a partial ``WindowGroupLimit`` *before* the exchange, so
  at most ``n`` rows per group and partition are shuffled, however skewed
  the group is.
* Totals for percentages come from their own aggregate rather than from a
  window over all items of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.columns import half_up_pct
from quarry.operators.joins import join_null_safe


def _list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def group_counts(df: DataFrame, keys: str | Sequence[str], name: str = "n",
                 only: dict[str, Sequence] | None = None) -> DataFrame:
    """Rows per group; ``only`` keeps groups whose column values are listed."""
    if only:
        for col, values in only.items():
            df = df.filter(F.col(col).isin(list(values)))
    return df.groupBy(*_list(keys)).agg(F.count(F.lit(1)).alias(name))


def distinct_counts(df: DataFrame, keys: str | Sequence[str], item: str,
                    name: str = "n_distinct", approximate: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """Distinct ``item`` values per group (exact, or HyperLogLog++ on request)."""
    agg = (F.approx_count_distinct(item, rsd) if approximate else F.count_distinct(item))
    return df.groupBy(*_list(keys)).agg(agg.alias(name))


def share_of_total(counts: DataFrame, n_col: str = "n", share_col: str = "share",
                   pct_col: str | None = "pct") -> DataFrame:
    """Add each row's share of the column total to an aggregated table.

    Meant for class distributions (a handful of rows), where a window over
    the whole, already aggregated table is one tiny task.
    """
    total = F.sum(n_col).over(Window.partitionBy())
    out = counts.withColumn(share_col, F.try_divide(F.col(n_col).cast("double"), total))
    if pct_col:
        out = out.withColumn(pct_col, half_up_pct(F.col(n_col), total))
    return out


def class_distribution(df: DataFrame, label: str, n_col: str = "n") -> DataFrame:
    """Rows and share of all rows per class (one aggregate, one tiny window)."""
    return share_of_total(group_counts(df, label, n_col), n_col)


def _rank_window(keys: list[str], count_col: str, item: str) -> Window:
    # Second sort key: ties at the cut are broken by the item, so the
    # result is the same on every run.
    return Window.partitionBy(*keys).orderBy(F.col(count_col).desc(), F.col(item).asc())


def item_counts(df: DataFrame, keys: str | Sequence[str], item: str,
                count_col: str = "n") -> DataFrame:
    """One row per (group, item) with its number of rows."""
    return df.groupBy(*_list(keys), item).agg(F.count(F.lit(1)).alias(count_col))


def top_n(df: DataFrame, keys: str | Sequence[str], item: str, n: int,
          count_col: str = "n", rank_col: str = "rank") -> DataFrame:
    """The ``n`` most frequent items per group, ranked 1..n (ties by item)."""
    keys = _list(keys)
    counted = item_counts(df, keys, item, count_col)
    ranked = counted.withColumn(rank_col, F.row_number().over(_rank_window(keys, count_col, item)))
    return ranked.filter(F.col(rank_col) <= n)


def top_k(df: DataFrame, order: Sequence[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """The first ``n`` rows in a total order, in that order, ranked 1..n.

    Planned as TakeOrderedAndProject: every task keeps ``n`` rows; only the
    ``n`` rows that are left are numbered.
    """
    first = df.orderBy(*order).limit(n)
    return first.withColumn(rank_col, F.row_number().over(Window.orderBy(*order))).orderBy(rank_col)


def top_n_vs_rest(df: DataFrame, keys: str | Sequence[str], item: str, n: int = 9,
                  rest_label: str = "Other", count_col: str = "n",
                  rank_col: str = "rank", pct_col: str = "pct",
                  item_label_col: str | None = None) -> DataFrame:
    """Top ``n`` items per group plus one ``rest_label`` row, with % of group.

    The rest row has rank ``n + 1`` and holds ``total - sum(top n)``; a group
    with at most ``n`` items gets no rest row.  Totals come from a separate
    aggregate over the (group, item) counts, so no window ever spans all
    items of a group.
    """
    keys = _list(keys)
    label_col = item_label_col or item
    counted = item_counts(df, keys, item, count_col)
    top = (counted.withColumn(rank_col, F.row_number().over(_rank_window(keys, count_col, item)))
           .filter(F.col(rank_col) <= n))
    totals = counted.groupBy(*keys).agg(F.sum(count_col).alias("_total"),
                                        F.count(F.lit(1)).alias("_items"))
    top_sum = top.groupBy(*keys).agg(F.sum(count_col).alias("_top"))
    rest = (join_null_safe(totals, top_sum, keys).filter(F.col("_items") > n)
            .select(*keys, F.lit(rest_label).alias(label_col),
                    (F.col("_total") - F.col("_top")).alias(count_col),
                    F.lit(n + 1).alias(rank_col)))
    head = top.select(*keys, F.col(item).cast("string").alias(label_col),
                      F.col(count_col), F.col(rank_col))
    both = head.unionByName(rest)
    return (join_null_safe(both, totals.select(*keys, "_total"), keys)
            .withColumn(pct_col, half_up_pct(F.col(count_col), F.col("_total")))
            .drop("_total"))


def arg_max(df: DataFrame, keys: str | Sequence[str], item: str,
            count_col: str = "n") -> DataFrame:
    """The most frequent item per group (ties: smallest item), as a frame."""
    return top_n(df, keys, item, 1, count_col).drop("rank")
