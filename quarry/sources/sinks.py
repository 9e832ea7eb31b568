"""Result sinks and persistence helpers."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def write_result(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 mode: str = "overwrite") -> None:
    """Write a result table as parquet (the library's only terminal sink)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows in a total order (a top-k, planned as TakeOrderedAndProject)."""
    return df.orderBy(*order_by).limit(n)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist a frame for the duration of a block and always release it."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
