"""Session helpers: local test sessions and shared scratch locations.

Scratch output (lineage cuts, round-trip writes) always lives under the
folder the cluster names in ``spark.checkpoint.dir``.  A local default is set
only when the session has none, which is the case in tests and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "fernwood") -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a local one only if unset.

    A folder of this machine is no use to executors elsewhere, so on anything but a
    ``local[...]`` master an unset ``spark.checkpoint.dir`` is an error.
    """
    current = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local[") and master != "local":
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that all executors share (master is {master})")
        current = tempfile.mkdtemp(prefix="fernwood-ckpt-", dir="/tmp")
        spark.conf.set(_CHECKPOINT_KEY, current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), f"{name}-{uuid.uuid4().hex[:12]}")


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written Parquet table in the shared folder: computed once, lineage cut.

    The folder is deleted when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
