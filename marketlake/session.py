"""Session construction and the shared scratch/checkpoint location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def build_session(app_name: str = "marketlake", master: str | None = None,
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the settings every layer relies on.

    * session time zone pinned to UTC: ``date``/``hour`` of a timestamp are
      taken in UTC, whatever the machine zone is;
    * adaptive execution on (coalesces small shuffles, splits skewed
      partitions, turns small joins into broadcasts at run time);
    * snappy Parquet;
    * ANSI mode left at the Spark 4 default (on); operators use ``try_*``
      expressions where bad input must become NULL.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def sizing_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle and split sizes for a given input size and total executor cores.

    Scan splits of ``target_partition_bytes``.  Initial shuffle width: one
    partition per ``target_partition_bytes`` of input, kept between 2x and 8x
    the cores (shuffled data is far smaller than the input once columns are
    pruned and aggregates pre-reduced; AQE coalesces small partitions and
    splits skewed ones at run time).  At 100 TB on 8,000 cores: ~400k scan
    splits, 64k initial shuffle partitions.
    """
    wanted = -(-int(input_bytes) // target_partition_bytes)
    parts = min(max(2 * cores, wanted), 8 * cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        # Bronze is many KB-sized JSON documents: count each file as 1 MB
        # (not the default 4 MB) so one task packs ~256 of them
        "spark.sql.files.openCostInBytes": str(1 << 20),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def ensure_utc(spark: SparkSession) -> None:
    """Dates and hours are defined in UTC; pin the session zone if it differs."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set (a shared file system or object store): a
    local folder would leave each executor's part of a table on its own disk.
    Only a ``local`` master without it -- tests, trials -- gets a folder made
    here and registered as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="marketlake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one run's staged data."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder through Hadoop's file system, if it is there."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's file system (works for any scheme)."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(hpath))
    except Exception:  # no JVM handle (remote session): ask the data source
        from pyspark.errors import AnalysisException
        try:
            spark.read.format("binaryFile").load(path).limit(0).collect()
            return True
        except AnalysisException:
            return False


__all__ = ["build_session", "ensure_utc", "checkpoint_root", "scratch_path", "path_exists",
           "delete_path", "sizing_conf"]
