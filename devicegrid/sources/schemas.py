"""Declared schemas per entity: wire (bronze), tolerant decode, silver."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Message schemas per topic, as the producer sends them (timestamps as text).
BRONZE_SCHEMAS: dict[str, T.StructType] = {
    "atm.dim": _struct(
        ("atm_id", S), ("city", S), ("region", S), ("latitude", D), ("longitude", D),
        ("atm_type", S), ("atm_model", S), ("bank", S), ("installed_date", S),
        ("is_active", B)),
    "atm.transactions": _struct(
        ("atm_id", S), ("timestamp", S), ("tx_type", S), ("amount_mwk", L),
        ("card_type", S), ("success", B)),
    "atm.cash": _struct(
        ("atm_id", S), ("timestamp", S), ("cash_level_mwk", L),
        ("hourly_withdrawal_mwk", L), ("was_refilled", B), ("below_threshold", B)),
    "atm.faults": _struct(
        ("atm_id", S), ("event_timestamp", S), ("fault_type", S), ("component", S),
        ("event_class", S), ("duration_mins", I), ("resolved", B), ("fault_occurred", I)),
    "atm.replenishments": _struct(
        ("atm_id", S), ("refill_timestamp", S), ("amount_loaded_mwk", L),
        ("cit_team", S), ("downtime_mins", I)),
}

# Topic -> short entity name used for folders and silver tables.
TOPIC_ENTITY = {
    "atm.dim": "dim",
    "atm.transactions": "transactions",
    "atm.cash": "cash",
    "atm.faults": "faults",
    "atm.replenishments": "replenishments",
}

# Envelope columns every bronze row carries (source lineage).
LINEAGE_COLUMNS = ("kafka_ts", "partition", "offset", "ingested_at")


def tolerant_schema(schema: T.StructType) -> T.StructType:
    """Same field names, every field decoded as text.

    ``from_json`` with a typed schema turns ``343.0`` in an int field, or
    ``"7"`` in a long field, into NULL.  Decoding to text and converting with
    ``try_cast`` afterwards keeps those values and never raises.
    """
    return T.StructType([T.StructField(f.name, S, True) for f in schema.fields])


# Silver tables: typed, event time parsed, key not null.
SILVER_SCHEMAS: dict[str, T.StructType] = {
    "transactions": _struct(
        ("atm_id", S), ("event_ts", T.TimestampType()), ("event_date", T.DateType()),
        ("tx_type", S), ("amount_mwk", L), ("card_type", S), ("success", B)),
    "cash": _struct(
        ("atm_id", S), ("event_ts", T.TimestampType()), ("event_date", T.DateType()),
        ("cash_level_mwk", L), ("hourly_withdrawal_mwk", L), ("was_refilled", B),
        ("below_threshold", B)),
    "faults": _struct(
        ("atm_id", S), ("event_ts", T.TimestampType()), ("event_date", T.DateType()),
        ("fault_type", S), ("component", S), ("event_class", S), ("duration_mins", I),
        ("resolved", B), ("fault_occurred", I)),
    "replenishments": _struct(
        ("atm_id", S), ("refill_ts", T.TimestampType()), ("amount_loaded_mwk", L),
        ("cit_team", S), ("downtime_mins", I)),
    "dim": _struct(
        ("atm_id", S), ("city", S), ("region", S), ("latitude", D), ("longitude", D),
        ("atm_type", S), ("atm_model", S), ("bank", S), ("installed_date", T.DateType()),
        ("is_active", B)),
}

# Side files landed by other tools.
WEATHER_SCHEMA = T.StructType([
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(S)),
        T.StructField("temperature_2m_max", T.ArrayType(D)),
        T.StructField("temperature_2m_min", T.ArrayType(D)),
        T.StructField("precipitation_sum", T.ArrayType(D)),
        T.StructField("windspeed_10m_max", T.ArrayType(D)),
    ])),
])
HOLIDAY_SCHEMA = _struct(("date", S), ("name", S), ("localName", S), ("countryCode", S))

# Transactions as the driver-derived topic carries them (with an event id, the
# only safe de-duplication key for transactions).
TX_MESSAGE_SCHEMA = T.StructType(
    [T.StructField("event_id", L, True)] + list(BRONZE_SCHEMAS["atm.transactions"].fields))
