"""File sources: CSV with a declared schema, optional inputs, landed JSON
documents (column-oriented weather, holiday list, alert feed)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicegrid.session import path_exists
from devicegrid.sources.schemas import HOLIDAY_SCHEMA, WEATHER_SCHEMA


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """CSV with a declared schema (no inference pass); files split into partitions."""
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  **options) -> DataFrame:
    """Read ``path``, or an empty frame of ``schema`` when it does not exist."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    r = spark.read.schema(schema).options(**options)
    return r.format(fmt).load(path)


def parse_date_columns(df: DataFrame, marker: str = "date") -> DataFrame:
    """Text columns whose name contains ``marker`` become timestamps
    (unparsable values NULL instead of an error)."""
    cols = []
    for f in df.schema.fields:
        if marker in f.name.lower() and isinstance(f.dataType, T.StringType):
            cols.append(F.try_to_timestamp(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Column-oriented daily weather JSON -> one row per day (``time`` -> ``date``)."""
    raw = spark.read.schema(WEATHER_SCHEMA).option("multiLine", True).json(path)
    d = raw.select(F.explode(F.arrays_zip(
        "daily.time", "daily.temperature_2m_max", "daily.temperature_2m_min",
        "daily.precipitation_sum", "daily.windspeed_10m_max")).alias("r"))
    return d.select(F.to_date("r.time").alias("date"), "r.temperature_2m_max",
                    "r.temperature_2m_min", "r.precipitation_sum", "r.windspeed_10m_max")


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """Array-of-objects holiday JSON -> (date, name, localName)."""
    raw = spark.read.schema(HOLIDAY_SCHEMA).option("multiLine", True).json(path)
    return raw.select(F.to_date("date").alias("date"), "name", "localName")


FEED_ENTRY = T.StructType([T.StructField(n, T.StringType()) for n in
                           ("alert_id", "type", "priority", "atm_id", "city", "message", "created_at")])


def read_feed_entries(spark: SparkSession, path: str) -> DataFrame:
    """Alert rows of a feed written by ``sinks.write_feed`` (empty if absent)."""
    return read_or_empty(spark, path, FEED_ENTRY, fmt="json")


def read_feed_document(spark: SparkSession, path: str) -> DataFrame:
    """Alert rows of a single nested feed document (``{.., "alerts": [..]}``)."""
    doc = T.StructType([T.StructField("alerts", T.ArrayType(FEED_ENTRY))])
    raw = read_or_empty(spark, path, doc, fmt="json", multiLine=True)
    return raw.select(F.inline("alerts"))
