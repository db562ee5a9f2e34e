"""Alerts from the gold marts: cash refills and fault risk, messages and feed.

Everything is a column expression over the marts; there is no per-row Python.
The latest date is an uncorrelated scalar subquery (``DataFrame.scalar``),
which Spark evaluates once and folds into the filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicegrid import config as C
from devicegrid.functions.exprs import alert_id, component_list, render, thousands

ALERT_COLUMNS = [
    "alert_id", "type", "priority", "created_at", "atm_id", "event_date", "city", "region",
    "sms", "email_subject", "email_body",
]


def cash_alerts(daily_cash: DataFrame, dim: DataFrame, run_ts: str = C.DEFAULT_RUN_TS,
                key: str = "atm_id", date: str = "event_date",
                min_cash: int = C.ALERT_MIN_CASH,
                date_source: DataFrame | None = None) -> DataFrame:
    """Devices whose minimum level on the latest date is below ``min_cash``.

    Priority P1 below half of ``min_cash``, else P2.  ``date_source`` (the
    mart's input rows) gives the same latest date with one scan and a partial
    max, instead of recomputing the mart's aggregate and window for it.
    """
    src = daily_cash if date_source is None else date_source
    latest = src.select(F.max(date)).scalar()
    rows = daily_cash.filter((F.col(date) == latest) & (F.col("min_cash_mwk") < min_cash))
    j = rows.join(dim.select(key, "city", "region"), key)
    p = F.when(F.col("min_cash_mwk") < min_cash / 2, "P1").otherwise("P2")
    v = {"priority": p, "atm_id": F.col(key), "city": F.col("city"), "region": F.col("region"),
         "amount": thousands("min_cash_mwk"), "cash_status": F.col("cash_status")}
    return j.select(
        F.lit(C.ALERT_TYPE_CASH).alias("type"),
        p.alias("priority"),
        F.lit(run_ts).alias("created_at"),
        key, date, "city", "region", "min_cash_mwk", "cash_status",
        render(C.CASH_SMS, v).alias("sms"),
        render(C.CASH_EMAIL_SUBJECT, v).alias("email_subject"),
        render(C.CASH_EMAIL_BODY, v).alias("email_body"),
    )


def fault_alerts(daily_faults: DataFrame, dim: DataFrame, run_ts: str = C.DEFAULT_RUN_TS,
                 key: str = "atm_id", date: str = "event_date",
                 lookback_days: int = C.ALERT_LOOKBACK_DAYS,
                 min_warnings: int = C.ALERT_MIN_WARNINGS,
                 date_source: DataFrame | None = None) -> DataFrame:
    """Fault-risk days in the trailing window (latest date - ``lookback_days``,
    inclusive) with a fault or at least ``min_warnings`` warnings.
    ``date_source``: as in ``cash_alerts``."""
    src = daily_faults if date_source is None else date_source
    start = src.select(F.date_sub(F.max(date), lookback_days)).scalar()
    rows = daily_faults.filter((F.col(date) >= start)
                               & ((F.col("faults") > 0) | (F.col("warnings") >= min_warnings)))
    j = rows.join(dim.select(key, "city", "region", "atm_model"), key)
    p = (F.when(F.col("severity") == "high", "P1")
          .when(F.col("severity") == "medium", "P2")
          .otherwise("P3"))
    comps = component_list({c: F.col(f"{c}_events") for c in C.ALERT_COMPONENTS})
    v = {"priority": p, "atm_id": F.col(key), "city": F.col("city"), "region": F.col("region"),
         "atm_model": F.col("atm_model"), "severity": F.col("severity"),
         "faults": F.col("faults"), "warnings": F.col("warnings"), "components": comps}
    return j.select(
        F.lit(C.ALERT_TYPE_FAULT).alias("type"),
        p.alias("priority"),
        F.lit(run_ts).alias("created_at"),
        key, date, "city", "region", "atm_model", "severity", "faults", "warnings",
        F.col("faults_ma_30d").cast("double").alias("faults_ma_30d"),
        comps.alias("components"),
        render(C.FAULT_SMS, v).alias("sms"),
        render(C.FAULT_EMAIL_SUBJECT, v).alias("email_subject"),
        render(C.FAULT_EMAIL_BODY, v).alias("email_body"),
    )


def union_alerts(cash: DataFrame, fault: DataFrame, key: str = "atm_id",
                 date: str = "event_date") -> DataFrame:
    """Both alert kinds in one frame (missing columns NULL) with repeatable ids."""
    u = cash.unionByName(fault, allowMissingColumns=True)
    return u.withColumn("alert_id", alert_id("type", key, date))


def alert_messages(alerts: DataFrame, key: str = "atm_id") -> DataFrame:
    """One row per alert and channel (sms, email), ready for a partitioned sink."""
    to_sms = F.when(F.col("type") == C.ALERT_TYPE_CASH, C.RECIPIENT_CASH).otherwise(C.RECIPIENT_FAULT)
    message_key = F.concat_ws("_", "type", F.col(key).cast("string"), "alert_id")
    sms = F.struct(F.lit("sms").alias("channel"), to_sms.alias("to"),
                   F.lit(C.SENDER).alias("from"), F.lit(None).cast("string").alias("subject"),
                   F.col("sms").alias("body"))
    email = F.struct(F.lit("email").alias("channel"), F.lit(C.EMAIL_TO).alias("to"),
                     F.lit(None).cast("string").alias("from"),
                     F.col("email_subject").alias("subject"), F.col("email_body").alias("body"))
    return (alerts.select(message_key.alias("message_key"), "priority",
                          F.col("created_at").alias("sent_at"), key,
                          F.explode(F.array(sms, email)).alias("m"))
                  .select("message_key", "m.channel", "m.to", "m.from", "m.subject", "m.body",
                          "priority", "sent_at", key))


def feed_counts(alerts: DataFrame) -> DataFrame:
    """One row of totals by type and by priority (zero for absent values)."""
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(F.col("type") == C.ALERT_TYPE_CASH).alias("cash_refill"),
        F.count_if(F.col("type") == C.ALERT_TYPE_FAULT).alias("fault_prediction"),
        F.count_if(F.col("priority") == "P1").alias("p1"),
        F.count_if(F.col("priority") == "P2").alias("p2"),
        F.count_if(F.col("priority") == "P3").alias("p3"),
    )


def feed_summary(alerts: DataFrame, generated_at: str = C.DEFAULT_RUN_TS) -> DataFrame:
    """Feed header: totals with ``by_type`` / ``by_priority`` maps.

    The alert list itself is *not* folded into this row (it grows with the
    data); it is written next to it as JSON lines by ``sinks.write_feed``.
    """
    c = feed_counts(alerts)
    return c.select(
        F.lit(generated_at).alias("generated_at"),
        "total_alerts",
        F.create_map(F.lit(C.ALERT_TYPE_CASH), F.col("cash_refill"),
                     F.lit(C.ALERT_TYPE_FAULT), F.col("fault_prediction")).alias("by_type"),
        F.create_map(F.lit("P1"), F.col("p1"), F.lit("P2"), F.col("p2"),
                     F.lit("P3"), F.col("p3")).alias("by_priority"),
    )


def feed_entries(alerts: DataFrame, key: str = "atm_id") -> DataFrame:
    """Feed list rows: (alert_id, type, priority, atm_id, city, message, created_at)."""
    return alerts.select("alert_id", "type", "priority", key, "city",
                         F.col("sms").alias("message"), "created_at")


def dispatch_candidates(scores: DataFrame, threshold: float = C.SCORE_DISPATCH_THRESHOLD,
                        score_col: str = "fault_probability") -> DataFrame:
    """Scored device-days above ``threshold`` (feeds an engineer dispatch)."""
    return scores.filter(F.col(score_col) > threshold)
