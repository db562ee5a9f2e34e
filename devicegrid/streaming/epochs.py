"""Rows that micro-batches add, as Parquet folders by query and epoch.

``write_epoch`` overwrites the folder of its own (query, epoch) and no other,
so a retried epoch replaces what its failed attempt left and adds nothing
twice.  Nothing is changed in place: a newer version of a row is a further row,
and :func:`latest` takes the newest per key.  A query on a fresh checkpoint has
another id and adds to the table; its versions are newer by their write time.
The folders are plain partitions, so any Parquet reader sees ``run``, ``epoch``
and the write time as columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicegrid.session import path_exists

#: Columns beside the rows' own: write time, query id, epoch.
VERSION = ["written_at", "run", "epoch"]


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query whose micro-batch this is (stable over restarts)."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def write_epoch(rows: DataFrame, path: str, run: str, epoch: int) -> None:
    """Write the rows of one epoch; writing it again replaces them."""
    (rows.withColumn("written_at", F.current_timestamp())
         .write.mode("overwrite").parquet(f"{path}/run={run}/epoch={epoch}"))


def read_epochs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows with their version columns; none where nothing is written yet."""
    full = T.StructType([*schema.fields, T.StructField("written_at", T.TimestampType()),
                         T.StructField("run", T.StringType()), T.StructField("epoch", T.LongType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The newest version of each key's row, without the version columns.

    ``max_by`` keeps one version per key and task before the shuffle, so a key
    with many versions sends one row a task.
    """
    own = [c for c in rows.columns if c not in VERSION and c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*own), F.struct("written_at", "epoch")).alias("row"))
    return newest.select(*keys, *[F.col("row")[c].alias(c) for c in own])
