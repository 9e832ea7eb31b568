"""Web-server log mining: typed parse, per-country counts, top hosts, grids.

The jobs take the parsed log (or any table with a group and an item
column), so the same plan serves hosts per country, users per event type
and so on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import suffix_label
from quarry.functions.logs import parse_log_frame
from quarry.operators import grid, groups
from quarry.operators.joins import join_null_safe

# Host suffixes of the countries of interest and their names.
COUNTRY_SUFFIXES = {".de": "Germany", ".ca": "Canada", ".sg": "Singapore"}
COUNTRIES_OF_INTEREST = ["Germany", "Canada", "Singapore"]


def parse_access_log(lines: DataFrame, value_col: str = "value",
                     keep_malformed: bool = True) -> DataFrame:
    """Text lines -> ``host, ts, tz_offset, request, status, size, malformed``."""
    parsed = parse_log_frame(lines, value_col)
    return parsed if keep_malformed else parsed.filter(~F.col("malformed"))


def tag_country(parsed: DataFrame, mapping: Mapping[str, str] = COUNTRY_SUFFIXES,
                host_col: str = "host", out_col: str = "host_cntry",
                default: str = "Other") -> DataFrame:
    """Add the country named by the host's suffix (``Other`` when unknown)."""
    return parsed.withColumn(out_col, suffix_label(F.col(host_col), mapping, default))


def requests_per_group(df: DataFrame, group: str, only: Sequence[str] | None = None,
                       name: str = "n_requests") -> DataFrame:
    return groups.group_counts(df, group, name, only={group: only} if only else None)


def unique_items_per_group(df: DataFrame, group: str, item: str,
                           name: str = "n_unique") -> DataFrame:
    return groups.distinct_counts(df, group, item, name)


def top_item_activity_grid(df: DataFrame, group: str, item: str, ts_col: str = "ts",
                           n_col: str = "n") -> DataFrame:
    """Zero-filled day x hour request grid of each group's most frequent item.

    The top item per group is a tiny frame (one row per group); the detail
    rows are filtered with a left-semi join on it, so only the top items'
    rows are counted.
    """
    top = groups.arg_max(df, group, item).select(group, item)
    rows = join_null_safe(df, top, [group, item], "left_semi")
    counts = grid.day_hour_counts(rows, [group, item], ts_col, n_col)
    return grid.dense_grid(counts, [group, item], n_col)
