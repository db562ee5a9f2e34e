"""Bronze -> silver: tolerant decode, typed conversion, key filter, quarantine,
de-duplication.

JSON messages from loosely typed producers carry ``343.0`` for ints and
``"7"`` / ``"False"`` for longs and booleans.  A typed ``from_json`` turns those
into NULL; here every field is decoded as text first and converted with
``try_cast`` rules, so values survive and nothing raises under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicegrid.functions.exprs import try_date, try_timestamp
from devicegrid.sources.schemas import tolerant_schema


def _whole_number(c: Column, kind: str) -> Column:
    """The number a text states, if it is whole and fits; else NULL.

    Decimals keep every digit (a double would not beyond 2^53); texts with
    an exponent are the exception and go through a double, whole values of
    up to 2^53 only.
    """
    d = c.try_cast("decimal(38,10)")
    exact = F.when(d == F.floor(d), d.cast("decimal(38,0)").try_cast(kind))
    e = F.when(c.rlike("[eE]"), c.try_cast("double"))
    powers = F.when((e == F.rint(e)) & (F.abs(e) <= F.lit(9007199254740992.0)), e.try_cast(kind))
    return F.coalesce(exact, powers)


def text_to_long(c: Column) -> Column:
    """``"7"`` -> 7, ``"343.0"`` -> 343; ``"343.7"``, junk and what does not fit -> NULL."""
    return _whole_number(c, "long")


def text_to_int(c: Column) -> Column:
    return _whole_number(c, "int")


def text_to_bool(c: Column) -> Column:
    """``true/false`` in any case, ``1/0``; anything else NULL."""
    s = F.lower(F.trim(c))
    return (F.when(s.isin("true", "1"), F.lit(True))
             .when(s.isin("false", "0"), F.lit(False)))


def convert(c: Column, dtype: T.DataType) -> Column:
    """Text -> ``dtype`` without raising."""
    if isinstance(dtype, T.LongType):
        return text_to_long(c)
    if isinstance(dtype, T.IntegerType):
        return text_to_int(c)
    if isinstance(dtype, T.BooleanType):
        return text_to_bool(c)
    if isinstance(dtype, T.DoubleType):
        return c.try_cast("double")
    if isinstance(dtype, T.TimestampType):
        return try_timestamp(c)
    if isinstance(dtype, T.DateType):
        return try_date(c)
    return c


def decode_json(raw: DataFrame, schema: T.StructType, value_col: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """Decode JSON text into typed columns of ``schema`` (tolerant).

    Adds ``_malformed``: true when there is a text and it is not a JSON
    object, so callers can quarantine it.  A NULL text and a JSON object
    without known fields are not malformed; they have no key.

    The text is parsed once, inside an ``inline`` generator: a later filter
    on a decoded field (e.g. the key) cannot be pushed below a generator,
    so Catalyst does not copy the ``from_json`` call into the filter.
    """
    tol = tolerant_schema(schema)
    corrupt = "_corrupt"
    text = F.col(value_col).cast("string")
    d = F.from_json(text, T.StructType([*tol.fields, T.StructField(corrupt, T.StringType())]),
                    {"columnNameOfCorruptRecord": corrupt})
    flat = raw.select(*keep, F.inline(F.array(d)))
    typed = [convert(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields]
    return flat.select(*keep, *typed, F.col(corrupt).isNotNull().alias("_malformed"))


#: JSON types by the names a variant's schema gives them.
JSON_TYPES = {"BIGINT": "whole", "DECIMAL": "decimal", "FLOAT": "decimal", "DOUBLE": "decimal", "STRING": "text",
              "BOOLEAN": "boolean", "VOID": "null", "OBJECT": "object", "ARRAY": "array"}


def _json_types(dtype: T.DataType) -> set[str]:
    """JSON types that state a value of ``dtype`` without conversion."""
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return {"whole"}
    if isinstance(dtype, T.DoubleType):
        return {"whole", "decimal"}
    return {"boolean"} if isinstance(dtype, T.BooleanType) else {"text"}


def field_types(messages: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """(field, type, n, drifted): which JSON types the fields of messages have, how often.

    ``drifted``: ``schema`` knows no such field or not by that type (null is
    never drift).  Texts that are no JSON object count under a null field as
    ``malformed``; null texts do not count.  A message is parsed once, into a
    variant; counts combine in the tasks.
    """
    text = F.col(value_col).cast("string")
    v = F.try_parse_json(text)
    is_object = F.schema_of_variant(v).startswith("OBJECT")
    parsed = messages.filter(text.isNotNull()).select(F.when(is_object, v).alias("__v"))
    spark = messages.sparkSession
    fields = parsed.lateralJoin(spark.tvf.variant_explode_outer(F.col("__v").outer()))
    names = F.create_map(*[F.lit(x) for kv in JSON_TYPES.items() for x in kv])
    kind = F.coalesce(names[F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)], F.lit("other"))
    known = [F.lit(f"{f.name}:{t}") for f in schema.fields for t in sorted(_json_types(f.dataType) | {"null"})]
    return (fields.select(F.col("key").alias("field"),
                          F.when(F.col("__v").isNull(), "malformed").otherwise(kind).alias("type"))
                  .filter("field IS NOT NULL OR type = 'malformed'")
                  .groupBy("field", "type").agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("drifted", ~F.coalesce(F.concat("field", F.lit(":"), "type").isin(*known), F.lit(False))))


def to_silver(decoded: DataFrame, ts_col: str, key: str = "atm_id",
              ts_name: str = "event_ts", date_name: str | None = "event_date",
              keep: Sequence[str] = ()) -> DataFrame:
    """Parse the event time text and drop rows without a key.

    A bad time text gives NULL ``event_ts``/``event_date`` and the row stays
    (only the key decides); rows without a key go to ``quarantine``.
    """
    ts = try_timestamp(F.col(ts_col))
    cols = [c for c in decoded.columns if c not in (ts_col, "_malformed")]
    out = decoded.filter(F.col(key).isNotNull()).withColumn(ts_name, ts)
    if date_name:
        out = out.withColumn(date_name, F.to_date(F.col(ts_name)))
    head = [key, ts_name] + ([date_name] if date_name else [])
    return out.select(*head, *[c for c in cols if c not in head and c not in keep], *keep)


def quarantine(decoded: DataFrame, key: str = "atm_id",
               keep: Sequence[str] = ("value",)) -> DataFrame:
    """Rows that cannot enter silver, with the reason: ``malformed_json`` (not a
    JSON object), ``empty_message`` (no text; needs ``value`` among the
    columns) or ``missing_key``."""
    empty = F.trim("value") == "" if "value" in decoded.columns else F.lit(False)
    none = F.col("value").isNull() if "value" in decoded.columns else F.lit(False)
    reason = (F.when(none | empty, "empty_message").when(F.col("_malformed"), "malformed_json")
               .otherwise("missing_key"))
    return (decoded.filter(F.col(key).isNull())
                   .select(*keep, reason.alias("reason")))


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one row per key: the one with the greatest ``order`` tuple.

    ``row_number() = 1`` over the key, latest first.  Spark plans this with a
    window group limit (``spark.sql.optimizer.windowGroupLimitThreshold``,
    default 1000 >= 1): a partial limit of one row per key and partition
    *before* the shuffle, so a key holding a large share of the rows is
    reduced map-side (measured in SKEW.md; faster than a ``max_by`` struct
    aggregate, which plans as a sort aggregate).  ``order`` must be a total
    order over duplicates for a deterministic survivor.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (df.withColumn("_rank", F.row_number().over(w))
              .filter(F.col("_rank") == 1).drop("_rank"))


# Per entity: the event-time text field and its silver names, extra date
# fields, and whether the entity is a dimension (one row per key, latest wins).
SILVER_SPECS = {
    "transactions": {"ts": "timestamp", "ts_name": "event_ts", "date_name": "event_date"},
    "cash": {"ts": "timestamp", "ts_name": "event_ts", "date_name": "event_date"},
    "faults": {"ts": "event_timestamp", "ts_name": "event_ts", "date_name": "event_date",
               "constants": {"fault_occurred": 1}},
    "replenishments": {"ts": "refill_timestamp", "ts_name": "refill_ts", "date_name": None},
    "dim": {"dates": ["installed_date"], "latest_by": ["kafka_ts", "offset", "partition"]},
}
LINEAGE = ("kafka_ts", "partition", "offset", "ingested_at", "ingest_date", "malformed",
           "_malformed")


def silver_from_bronze(entity: str, bronze: DataFrame, key: str = "atm_id") -> DataFrame:
    """Typed bronze rows of one topic -> the entity's silver table.

    Event times are parsed (NULL when unparsable), rows without a key are
    dropped, and a dimension keeps only the latest version of each key
    (by broker time, then offset, then partition).
    """
    spec = SILVER_SPECS[entity]
    df = bronze.filter(F.col(key).isNotNull())
    for c in spec.get("dates", []):
        df = df.withColumn(c, try_date(F.col(c)))
    for c, v in spec.get("constants", {}).items():
        df = df.withColumn(c, F.lit(v))
    if "latest_by" in spec:
        keep = [c for c in df.columns if c not in LINEAGE or c in spec["latest_by"]]
        df = dedupe_latest(df.select(*keep), [key], spec["latest_by"])
    if "ts" in spec:
        df = to_silver(df, spec["ts"], key, spec["ts_name"], spec["date_name"])
    return df.select(*[c for c in df.columns if c not in LINEAGE])
