"""Session construction and shared-storage paths.

All intermediate tables (sink swaps, stream checkpoints, lineage cuts) live
under the folder the cluster names in ``spark.checkpoint.dir``.  A private
folder is created only when that setting is missing, which happens in local
tests and never on a configured cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "tidemark", driver_memory: str | None = None) -> SparkSession:
    """Session with the settings every job here relies on.

    * AQE re-plans joins and coalesces partitions at run time; its skew-join
      rule splits hot keys of a sort-merge join.
    * Session time zone is UTC so TIMESTAMP and TIMESTAMP_NTZ agree.
    * Streaming state lives in RocksDB (spills to local disk, snapshots to the
      checkpoint folder) rather than in executor heap.
    * Intermediate tables are written below ``spark.checkpoint.dir``
      (:func:`materialize`); :func:`release` removes what this application wrote.
    * Partition sizing that holds at any scale: scans split files into
      ~256 MB input partitions; AQE coalesces or splits shuffle partitions
      toward ~128 MB each, and any partition 5x the median and over
      256 MB counts as skewed and is split in joins.  AQE merges shuffle
      partitions but never adds any for aggregates and range sorts, so
      ``shuffle_partitions`` bounds their parallelism: without a value the
      cluster's own setting holds, in local mode 16.
    * No UI server.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.files.maxPartitionBytes", str(256 * 1024 * 1024))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 * 1024 * 1024))
        .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "5")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", str(256 * 1024 * 1024))
    )
    if shuffle_partitions is None and master.startswith("local"):
        shuffle_partitions = 16
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master.startswith("local"):
        # In local mode the driver JVM runs every task; give it the memory.
        builder = builder.config("spark.driver.memory",
                                 driver_memory or os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset."""
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"{_CHECKPOINT_KEY} must name a folder that the driver and all executors share")
        # Only reached in local runs, where one machine holds everything.
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    app = spark.sparkContext.applicationId
    return os.path.join(root, "tidemark", app, f"{name}-{uuid.uuid4().hex}")


def release(spark: SparkSession) -> None:
    """Remove every scratch folder of this application, on whatever file system it lies.

    Call it when the job's results are written: frames that read scratch
    tables fail afterwards.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        os.path.join(ensure_checkpoint_dir(spark), "tidemark", spark.sparkContext.applicationId))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str = "table"):
    """Cut lineage by writing ``df`` as Parquet into the shared checkpoint
    folder and reading it back.

    Unlike ``DataFrame.checkpoint()``, which evaluates its plan twice (once
    for the eager count, once more to write) and stores serialized rows,
    this evaluates the plan once and stores a columnar table that later
    readers prune and filter.  The folder is shared storage, so a lost
    executor costs nothing already written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"mat-{name}")
    df.write.mode("overwrite").parquet(path)
    # the schema is known: skip footer-based inference on the way back
    return spark.read.schema(df.schema).parquet(path)
