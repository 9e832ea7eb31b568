"""Work tables: intermediate results in column format on shared storage.

A job that reads an intermediate result more than once writes it with
:meth:`WorkTables.keep` below the session's checkpoint folder and goes on from
the written files: lineage is cut, columns are pruned on every later read, and
a lost executor costs a re-read.  A table is deleted as soon as the job has
superseded it (:meth:`drop`) and all are deleted when the ``with`` block ends,
except those marked ``result=True``, which the returned frame still reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from quarry.session import ensure_checkpoint_dir


class WorkTables:
    def __init__(self, spark: SparkSession, name: str):
        base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
        self.spark, self.folder = spark, f"{base.rstrip('/')}/work-{name}-{uuid.uuid4().hex}"
        self._paths: dict[str, bool] = {}

    def keep(self, df: DataFrame, name: str, result: bool = False, by: Sequence[str] = (), **options) -> DataFrame:
        """Write ``df`` once, in a folder per value of ``by`` if given, and return it as read back."""
        if name in self._paths:
            raise ValueError(f"work table {name!r} exists already")
        path = f"{self.folder}/{name}"
        self._paths[name] = result
        writer = df.write.options(**options)
        (writer.partitionBy(*by) if by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete superseded tables."""
        for name in names:
            del self._paths[name]
            self._delete(f"{self.folder}/{name}")

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def __enter__(self) -> WorkTables:
        return self

    def __exit__(self, *error) -> None:
        self.drop(*[n for n, result in self._paths.items() if not result])
        if not self._paths:
            self._delete(self.folder)
