"""Structured Streaming ingest: topic -> bronze Parquet with a checkpoint.

Sources carry the Kafka envelope (key, value, kafka_ts, partition, offset).
The Kafka reader needs the Kafka connector on the classpath; tests and the
registered queries use a file source with the same envelope columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from devicegrid.operators import silver
from devicegrid.sources.schemas import BRONZE_SCHEMAS, TOPIC_ENTITY

ENVELOPE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("kafka_ts", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])


def kafka_stream(spark: SparkSession, brokers: str, topic: str, starting: str = "earliest",
                 max_offsets_per_trigger: int | None = 200_000,
                 fail_on_data_loss: bool = False) -> DataFrame:
    """Kafka topic as a streaming frame with the envelope columns.

    ``starting="latest"`` tails the topic; progress lives in the query's
    checkpoint (no consumer-group offsets needed).
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", brokers)
         .option("subscribe", topic)
         .option("startingOffsets", starting)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value",
                               "timestamp AS kafka_ts", "partition", "offset")


def file_stream(spark: SparkSession, path: str, fmt: str = "json",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed message files (envelope schema) as a streaming frame."""
    r = spark.readStream.schema(ENVELOPE).format(fmt).option("ignoreMissingFiles", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def to_bronze(stream: DataFrame, schema: T.StructType) -> DataFrame:
    """Decode the message text (tolerant), flatten, add lineage columns."""
    d = silver.decode_json(stream, schema, keep=("kafka_ts", "partition", "offset"))
    return (d.withColumnRenamed("_malformed", "malformed")
             .withColumn("ingested_at", F.current_timestamp())
             .withColumn("ingest_date", F.to_date("kafka_ts")))


def dedupe_stream(bronze: DataFrame, key: str = "event_id", delay: str = "1 hour") -> DataFrame:
    """Drop producer re-sends (same ``key``) arriving within ``delay`` of each other.

    Replayed *reads* are already excluded by the checkpointed offsets; this
    handles re-*sent* messages, which get new offsets.  State is bounded by
    the watermark.
    """
    return bronze.withWatermark("kafka_ts", delay).dropDuplicatesWithinWatermark([key])


def start_parquet_sink(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                       partition_by: tuple[str, ...] = ("ingest_date",),
                       processing_time: str | None = None) -> StreamingQuery:
    """Append to Parquet; the file sink + checkpoint make it exactly-once.

    ``available_now`` drains what is there and stops (batch-style runs);
    otherwise a ``processing_time`` trigger keeps it running.
    """
    w = (df.writeStream.format("parquet").option("path", path)
           .option("checkpointLocation", checkpoint).outputMode("append"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def ingest(spark: SparkSession, topic_schema: T.StructType, source: DataFrame, out_dir: str,
           checkpoint: str, dedupe_key: str | None = None) -> StreamingQuery:
    """One parameterised ingest job per topic: source -> bronze sink."""
    b = to_bronze(source, topic_schema)
    if dedupe_key:
        b = dedupe_stream(b, dedupe_key)
    return start_parquet_sink(b, out_dir, checkpoint)


def ingest_topic(spark: SparkSession, topic: str, source: DataFrame, out_dir: str, checkpoint: str,
                 dedupe_key: str | None = None) -> StreamingQuery:
    """The ingest job of a topic, by its name; the schema follows from it."""
    if topic not in BRONZE_SCHEMAS:
        raise ValueError(f"unknown topic {topic}; known: {', '.join(sorted(BRONZE_SCHEMAS))}")
    return ingest(spark, BRONZE_SCHEMAS[topic], source, f"{out_dir}/{TOPIC_ENTITY[topic]}", checkpoint, dedupe_key)


def main(argv=None) -> None:
    """``python -m devicegrid.streaming.ingest --topic atm.cash --files DIR --out DIR --checkpoint DIR``
    (or ``--brokers HOST:PORT`` with the Kafka connector on the classpath)."""
    import argparse

    from devicegrid.session import build_session

    ap = argparse.ArgumentParser(description=main.__doc__)
    ap.add_argument("--topic", required=True)
    ap.add_argument("--files")
    ap.add_argument("--brokers")
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint", required=True)
    a = ap.parse_args(argv)
    if bool(a.files) == bool(a.brokers):
        ap.error("give either --files or --brokers")
    spark = build_session()
    source = file_stream(spark, a.files) if a.files else kafka_stream(spark, a.brokers, a.topic)
    ingest_topic(spark, a.topic, source, a.out, a.checkpoint).awaitTermination()


if __name__ == "__main__":
    main()
