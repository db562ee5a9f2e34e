"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devicegrid.session import shared_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def id_crc32(column: str = "doc_id") -> Column:
    """CRC-32 of the id written as text (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


#: Spark drops the shuffle files of a statement when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` to a fresh folder below the cluster's shared checkpoint
    folder and read it back: later reads need no recomputation and survive
    lost executors.  ``drop_shuffles``: the shuffle files of the write go as
    soon as it has ended."""
    spark = df.sparkSession
    path = shared_path(spark, f"{label}-{uuid.uuid4().hex}")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true" if drop_shuffles else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: mallopt's numbers for the free memory that malloc keeps, and for the size from which arrays are mapped.
M_TRIM_THRESHOLD, M_MMAP_THRESHOLD = -1, -3


def release_memory() -> None:
    """Gives back the free memory that Arrow and malloc hold for later: a worker keeps it
    while it waits for a next task.  From then on malloc gives back arrays of a megabyte
    as they are freed; by default it stops doing so after the first ones."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):  # glibc
        libc.mallopt(M_TRIM_THRESHOLD, 1 << 20)
        libc.mallopt(M_MMAP_THRESHOLD, 1 << 20)
        libc.malloc_trim(0)
