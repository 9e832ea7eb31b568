"""Session helpers.

The library never creates a session on its own inside a job; callers (tests,
``bench.py``) use :func:`local_session` and cluster users bring their own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package assumes.  AQE re-plans joins by their
# measured size (a side only becomes a broadcast once its runtime size is
# below ``autoBroadcastJoinThreshold``), coalesces small shuffle partitions
# and splits skewed join partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files of frames that are no longer referenced are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """A ``local[n]`` session for tests and benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g")))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when nothing is configured (local tests) a fresh scratch
    folder is created.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server's setting applies
        if not conf_dir:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        conf_dir = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir
