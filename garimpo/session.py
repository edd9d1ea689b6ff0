"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


SHUFFLE_PARTITION_BYTES = 128 * 1024**2


def build_session(
    app_name: str = "garimpo", master: str | None = None, shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` overrides them.

    ``shuffle_bytes`` is the size of the largest shuffle expected. Adaptive
    execution merges small shuffle partitions but does not split those of an
    aggregate, so it has to start from enough of them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_bytes:
        first = max(200, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", first)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Pages are costly per byte: keep shuffled pages on all cores.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and all executors reach.

    ``spark.checkpoint.dir`` names it; where it is unset, the warehouse is used,
    which a session shares with its executors too. No machine-local folder is.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder; nothing is created or reused."""
    return f"{shared_dir(spark)}/garimpo/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, in whatever store it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
