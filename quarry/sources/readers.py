"""Readers: parquet tables, text logs, CSV with declared schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.schemas import CORRUPT_COL


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (column pruning / pushdown apply)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_log_text(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Access-log text, one row per line in ``value``.

    Gzip files cannot be split, so each file arrives as one task; when
    ``partitions`` is given the lines are spread round-robin right after the
    read so the parse and aggregation run in parallel.
    """
    df = spark.read.text(path)
    if partitions:
        df = df.repartition(partitions)
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             header: bool = True, keep_corrupt: bool = False) -> DataFrame:
    """CSV with a declared schema (never inferred).

    ``PERMISSIVE`` keeps malformed lines; with ``keep_corrupt`` their raw text
    lands in ``_corrupt_record`` so rejects can be counted, not lost.
    """
    if keep_corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT_COL, T.StringType())])
    reader = (spark.read.schema(schema)
              .option("header", str(header).lower())
              .option("mode", "PERMISSIVE"))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    return reader.csv(path)


def rename_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename every column by position in one projection."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def cast_columns(df: DataFrame, columns: Iterable[str], to: str = "double") -> DataFrame:
    """Cast a list of columns in one ``select``; bad values become NULL."""
    wanted = set(columns)
    missing = wanted - set(df.columns)
    if missing:
        raise ValueError(f"unknown columns: {sorted(missing)}")
    return df.select([F.col(f"`{c}`").try_cast(to).alias(c) if c in wanted else F.col(f"`{c}`")
                      for c in df.columns])
