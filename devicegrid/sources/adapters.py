"""Canonical silver-shaped tables derived from the driver's tables.

The source pipeline's own data is not available, so the device entities are
mapped onto the driver's star schema (the oracle repeats the same mapping in
SQL, see ``devicegrid.plans.oracle``):

* transactions  <- events    (user_id plays the device, one event one transaction)
* cash levels   <- lineitem  (l_suppkey plays the device, l_shipdate the reading time)
* fault events  <- lineitem  (l_suppkey div 10 plays the device)
* dimension     <- customer x nation x region, installed = first order date
* level dimension <- supplier x nation x region (devices of the cash levels)

``floor`` (not ``round``) is used for number conversions so both engines agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicegrid import config as C
from devicegrid.functions.exprs import pick
from devicegrid.sources.tables import Tables

# Mapping choices of this build: event type -> transaction type.
EVENT_TO_TX = {
    "purchase": "withdrawal",
    "view": "balance_enquiry",
    "signup": "deposit",
}
REFILL_AMOUNT = C.REFILL_AMOUNT


def transactions(t: Tables) -> DataFrame:
    """(event_id, atm_id, event_ts, event_date, tx_type, amount_mwk, card_type, success)."""
    e = t.events
    k = F.from_json("props", "k LONG").getField("k")
    tx_type = F.coalesce(
        *[F.when(F.col("event_type") == src, F.lit(dst)) for src, dst in EVENT_TO_TX.items()],
        F.lit("transfer"))
    return e.select(
        F.col("event_id"),
        F.col("user_id").alias("atm_id"),
        F.col("ts").alias("event_ts"),
        F.to_date("ts").alias("event_date"),
        tx_type.alias("tx_type"),
        F.floor(F.col("value") * 100).cast("long").alias("amount_mwk"),
        pick(C.CARD_TYPES, F.pmod(k, F.lit(4))).alias("card_type"),
        (F.col("event_type") != "error").alias("success"),
    )


def cash_levels(t: Tables) -> DataFrame:
    """(atm_id, event_ts, event_date, cash_level_mwk, hourly_withdrawal_mwk, was_refilled, below_threshold)."""
    li = t.lineitem
    return li.select(
        F.col("l_suppkey").alias("atm_id"),
        F.col("l_shipdate").alias("event_ts"),
        F.to_date("l_shipdate").alias("event_date"),
        F.floor("l_extendedprice").cast("long").alias("cash_level_mwk"),
        F.floor("l_quantity").cast("long").alias("hourly_withdrawal_mwk"),
        (F.col("l_returnflag") == "R").alias("was_refilled"),
        (F.col("l_extendedprice") < 10000).alias("below_threshold"),
    )


def fault_events(t: Tables) -> DataFrame:
    """(atm_id, event_ts, event_date, fault_type, component, event_class, duration_mins, resolved, fault_occurred)."""
    li = t.lineitem
    idx = F.pmod(F.col("l_partkey"), F.lit(len(C.COMPONENTS)))
    is_fault = F.col("l_returnflag") == "R"
    return li.select(
        F.expr("l_suppkey div 10").alias("atm_id"),
        F.col("l_shipdate").alias("event_ts"),
        F.to_date("l_shipdate").alias("event_date"),
        pick(C.FAULT_TYPES, idx).alias("fault_type"),
        pick(C.COMPONENTS, idx).alias("component"),
        F.when(is_fault, "fault").otherwise("warning").alias("event_class"),
        F.when(is_fault, F.floor("l_quantity").cast("int")).alias("duration_mins"),
        F.when(is_fault, F.col("l_linenumber") != 7).alias("resolved"),
        F.lit(1).alias("fault_occurred"),
    )


def replenishments(levels: DataFrame) -> DataFrame:
    """Refill log derived from the level readings: one row per refilled reading."""
    return levels.filter("was_refilled").select(
        "atm_id",
        F.col("event_ts").alias("refill_ts"),
        F.lit(REFILL_AMOUNT).cast("long").alias("amount_loaded_mwk"),
        F.lit(None).cast("string").alias("cit_team"),
        F.lit(None).cast("int").alias("downtime_mins"),
    )


def _geo(t: Tables) -> DataFrame:
    # No hint: AQE broadcasts a side when its measured size allows it.
    n, r = t.nation, t.region
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "n_name", "n_regionkey", "r_name")


def _dim_columns(key: str, nationkey: str, acctbal: str, kind) -> list:
    return [
        F.col(key).alias("atm_id"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
        kind.alias("atm_type"),
        F.concat(F.lit("model_"), F.pmod(F.col(nationkey), F.lit(4)).cast("string")).alias("atm_model"),
        F.col("r_name").alias("bank"),
    ]


def device_dim(t: Tables) -> DataFrame:
    """Dimension of the transaction / fault devices (customers).

    ``installed_date`` is the customer's first order date and NULL for
    customers without orders.  The per-customer minimum is an aggregate on
    ``orders`` (partial aggregation before the shuffle); the join with
    ``customer`` then shares that hash partitioning on the key.
    """
    c = t.customer
    first_order = (t.orders.groupBy("o_custkey")
                   .agg(F.to_date(F.min("o_orderdate")).alias("installed_date")))
    base = c.join(_geo(t), c.c_nationkey == F.col("n_nationkey"))
    return (base.join(first_order, base.c_custkey == first_order.o_custkey, "left")
                .select(*_dim_columns("c_custkey", "c_nationkey", "c_acctbal", F.col("c_mktsegment")),
                        F.col("installed_date"),
                        (F.col("c_acctbal") >= 0).alias("is_active")))


def level_dim(t: Tables) -> DataFrame:
    """Dimension of the cash-level devices (suppliers); no install date known."""
    s = t.supplier
    base = s.join(_geo(t), s.s_nationkey == F.col("n_nationkey"))
    kind = F.when(F.col("s_acctbal") >= 0, "branch").otherwise("offsite")
    return base.select(*_dim_columns("s_suppkey", "s_nationkey", "s_acctbal", kind),
                       F.lit(None).cast("date").alias("installed_date"),
                       (F.col("s_acctbal") >= 0).alias("is_active"))


def topic_frames(t: Tables) -> dict[str, DataFrame]:
    """The rows of each topic with the field names of its messages."""
    levels = cash_levels(t)
    return {
        "atm.transactions": transactions(t).withColumnRenamed("event_ts", "timestamp").drop("event_date"),
        "atm.cash": levels.withColumnRenamed("event_ts", "timestamp").drop("event_date"),
        "atm.faults": fault_events(t).withColumnRenamed("event_ts", "event_timestamp").drop("event_date"),
        "atm.replenishments": replenishments(levels).withColumnRenamed("refill_ts", "refill_timestamp"),
        "atm.dim": device_dim(t),
    }


def messages(t: Tables, topic: str) -> DataFrame:
    """All rows of a topic as keyed JSON messages in a broker's envelope:
    (key, value, kafka_ts, partition, offset)."""
    from devicegrid.operators.encode import encode_keyed

    rows = topic_frames(t)[topic]
    time = next((c for c in rows.columns if c.endswith("timestamp")), "installed_date")
    offset = F.col("event_id") if "event_id" in rows.columns else F.xxhash64(*rows.columns)
    return encode_keyed(rows, envelope={
        "kafka_ts": F.col(time).cast("timestamp"),
        "partition": F.pmod(F.col("atm_id"), F.lit(3)).cast("int"),
        "offset": offset})


def damaged(messages: DataFrame) -> DataFrame:
    """Every message cut off in its middle: what a quarantine has to hold back."""
    return messages.withColumn("value", F.expr("left(value, cast(length(value) / 2 as int))"))


def dimension_messages(dim: DataFrame, changed_segment: str = "BUILDING") -> DataFrame:
    """The device dimension as a topic that carries two versions of some keys.

    Every device is sent once; devices of ``changed_segment`` are sent again
    a day later with a changed city (lower case), so de-duplication must keep
    the later version.  Columns: key, value, kafka_ts, partition, offset.
    """
    from devicegrid.operators.encode import encode_keyed

    base = dim.withColumn("atm_id", F.col("atm_id").cast("string"))
    v1 = encode_keyed(base).select("key", "value",
                                   F.lit("2024-01-01 00:00:00").cast("timestamp").alias("kafka_ts"))
    changed = base.filter(F.col("atm_type") == changed_segment).withColumn("city", F.lower("city"))
    v2 = encode_keyed(changed).select("key", "value",
                                      F.lit("2024-01-02 00:00:00").cast("timestamp").alias("kafka_ts"))
    msgs = v1.unionByName(v2)
    return msgs.select("key", "value", "kafka_ts",
                       F.lit(0).alias("partition"),
                       (F.unix_timestamp("kafka_ts") * 10_000_000 + F.col("key").cast("long"))
                       .alias("offset"))
