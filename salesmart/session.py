"""SparkSession construction and the shared scratch location."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants; cluster-specific sizing
# (shuffle partitions, maxPartitionBytes, executor memory) is left to the
# deployment and only defaulted here for local runs.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", app: str = "salesmart", shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the local benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or (cpus if cpus != "*" else 8))
    conf["spark.driver.memory"] = os.environ.get("SALESMART_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Raises when none is configured: on a cluster a machine-local folder
    would not survive the loss of an executor, so we never invent one.
    Tests set their own before the session starts.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder for written tables")
    return root.rstrip("/")


def require_ansi(spark: SparkSession) -> None:
    """Casts must fail on malformed values; without ANSI they give nulls."""
    if str(spark.conf.get("spark.sql.ansi.enabled", "true")).lower() != "true":
        raise RuntimeError("spark.sql.ansi.enabled must be true: malformed values would silently become null")


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists and holds anything, in whatever store it is."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(conf)
    return bool(fs.exists(where)) and len(fs.listStatus(where)) > 0


def new_run_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh folder under the checkpoint root for one pipeline run."""
    return f"{checkpoint_root(spark)}/salesmart/{label}-{uuid.uuid4().hex[:12]}"
