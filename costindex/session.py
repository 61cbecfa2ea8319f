"""Session helpers.

The library never depends on a session built here: every operator takes
DataFrames.  ``build_session`` is for tests, the bench and local runs.
``shared_root`` resolves the folder that all writes go under; on a cluster it
comes from ``spark.checkpoint.dir`` (a shared file system), so nothing is
written to a machine-local temporary folder there.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "costindex") -> SparkSession:
    builder = (
        SparkSession.builder
        .master(master or os.environ.get("COSTINDEX_MASTER", "local[8]"))
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("COSTINDEX_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Settings for a large cluster (thousands of cores, ~100 TB of facts).  Scan
# splits of 512 MB keep the task count manageable; a high initial shuffle
# partition count lets AQE coalesce down to ~256 MB per reducer and split
# skewed join partitions; broadcasts stay behind the explicit size checks of
# operators.joins (the automatic threshold is left at its default).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # else coalescing ignores the size above in favour of more tasks
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def apply_cluster_conf(spark: SparkSession) -> SparkSession:
    """Apply CLUSTER_CONF to a running session (runtime SQL settings only)."""
    for k, v in CLUSTER_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    value = spark.conf.get(key, None)
    if value:
        return value
    return spark.sparkContext.getConf().get(key, None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when none is set.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    is always used.  Where it is unset a local master gets a fresh folder under
    the system temp directory; on a cluster that is an error, as executors
    would write to their own disks.
    """
    root = _conf(spark, "spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="costindex-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_root(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the shared checkpoint folder for one warehouse."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/costindex/{name or uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Delete the staged tables of this session's shared folder (call when a job's results are written)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_root(spark, "stage"))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage_table(df, name: str = "stage"):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (later branches plan against a small stored table, and a
    lost executor re-reads the files instead of recomputing the inputs).
    """
    spark = df.sparkSession
    path = f"{shared_root(spark, 'stage')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
