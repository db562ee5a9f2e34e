"""Keyed JSON encoding of rows (the producer side of a topic)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicegrid.functions.exprs import iso_ts


def _clean_columns(df: DataFrame) -> list:
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = iso_ts(c)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return cols


def clean_for_json(df: DataFrame) -> DataFrame:
    """NaN -> null, timestamps -> ISO text, dates -> ``yyyy-MM-dd``."""
    return df.select(*_clean_columns(df))


def encode_keyed(df: DataFrame, key: str = "atm_id", envelope: dict | None = None) -> DataFrame:
    """(key, value): key = entity id text, value = JSON of the whole row.

    Null fields are written as ``null`` (not dropped), so every message has
    the same field set.  ``envelope`` maps further output columns to
    expressions over ``df`` (broker time, partition, offset).
    """
    extra = {f"__{n}": c for n, c in (envelope or {}).items()}
    c = df.withColumns(extra) if extra else df
    cols = _clean_columns(df)
    return c.select(F.col(key).cast("string").alias("key"),
                    F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"),
                    *[F.col(e).alias(e[2:]) for e in extra])


def topic_messages(frames: dict[str, DataFrame], topics=None, limit: int | None = None,
                   key: str = "atm_id") -> DataFrame:
    """Keyed messages of several topics in one frame (topic, key, value).

    ``topics`` publishes a subset; ``limit`` caps the rows per topic (a trial
    publish of the first rows).  The result is written partitioned by topic.
    """
    out = None
    for name, df in frames.items():
        if topics is not None and name not in topics:
            continue
        if limit is not None:
            df = df.limit(limit)
        m = encode_keyed(df, key).select(F.lit(name).alias("topic"), "key", "value")
        out = m if out is None else out.unionByName(m)
    if out is None:
        raise ValueError("no topic selected")
    return out
