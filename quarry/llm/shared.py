"""Work folders on shared storage and small frame helpers of the operators."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the text contracts: space and U+0009..U+000D.
SPACE = " \t\n\x0b\x0c\r"
#: Name of the caller's row beside an operator's columns.
ROW = "_the_whole_row"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = "file://" + tempfile.mkdtemp(prefix="quarry-llm-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet to shared storage and read it back.

    Cuts the lineage: a lost executor costs a re-read, never a recomputation,
    and ids made by ``monotonically_increasing_id`` stay what they are.
    """
    spark, path = df.sparkSession, work_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder on shared storage and the path within it.

    Hadoop's names of the S3 connector are those of one store.
    """
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def wrapped(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` beside the whole row as a struct under a name of its own.

    An operator that adds columns, or replaces those of the same name, then
    leaves the caller's alone; :func:`unwrapped` gives them back.
    """
    return docs.select(*[F.col(c) for c in columns if c in docs.columns], F.struct(*docs.columns).alias(ROW))


def unwrapped(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The caller's rows in their columns, with those of ``changed`` replaced where the caller has them."""
    return df.select(*[changed[c].alias(c) if c in changed else F.col(f"{ROW}.`{c}`") for c in columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (bound to a lambda variable)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
