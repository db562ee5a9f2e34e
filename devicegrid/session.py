"""Spark session setup and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings every job relies on.  Shuffle width is left to AQE on a
# cluster (it coalesces small partitions and splits skewed ones at run time).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "devicegrid", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` and ``shuffle_partitions`` are meant for tests and local runs;
    on a cluster leave them unset so spark-submit decides.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Where it is unset, a
    scratch folder is created on a local master only; on a cluster each
    machine would have its own, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        d = tempfile.mkdtemp(prefix="devicegrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system Spark would read it from."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (for written intermediate tables)."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint): recomputation reads
    the written files instead of replaying the whole lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``cut_lineage`` as Parquet, a fresh folder below the shared one: a fraction of
    a checkpoint's size, and later reads take the columns they use."""
    path = shared_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scale_conf(shuffled_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
               broadcast_bytes: int = 64 << 20, most_partitions: int = 20_000) -> dict[str, str]:
    """Session settings for a job that shuffles ``shuffled_bytes`` at once.

    Give what is left *after* map-side aggregation and column pruning, not the
    input volume.  The initial shuffle width aims at ``target_partition_bytes``,
    with three waves of the cluster's cores at least and ``most_partitions`` at
    most (map and reduce blocks multiply); AQE coalesces small partitions and
    splits skewed ones at run time, larger partitions spill.
    """
    wanted = -(-shuffled_bytes // target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(max(3 * total_cores, min(most_partitions, wanted))),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }
