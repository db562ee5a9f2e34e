"""Gold marts: daily levels, daily fault profile, device profile.

Plan shape (checked with ``explain``): each daily mart is a hash aggregate on
(device, date) with map-side partial aggregation, then a window over the
*aggregated* rows partitioned by device.  A device that holds a third of all
raw rows is spread over its dates by the first shuffle; the window only sees
one row per device and day, so its largest group is bounded by the number of
days, not by the raw volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from devicegrid import config as C
from devicegrid.functions.exprs import cash_status, safe_ratio, severity


def _series_window(key: str, date: str) -> Window:
    # NULL dates sort last, as the SQL warehouse of the source pipeline does.
    return Window.partitionBy(key).orderBy(F.col(date).asc_nulls_last())


def daily_level_base(levels: DataFrame, key: str = "atm_id", date: str = "event_date",
                     level: str = "cash_level_mwk",
                     outflow: str = "hourly_withdrawal_mwk") -> DataFrame:
    """The aggregate part of the daily level mart: one row per device and day."""
    return (levels.filter(F.col(key).isNotNull())
            .groupBy(key, date)
            .agg(F.min(level).alias("min_cash_mwk"),
                 F.max(level).alias("max_cash_mwk"),
                 F.avg(level).alias("avg_cash_mwk"),
                 F.sum(outflow).alias("total_withdrawal_mwk"),
                 F.count_if(F.col("was_refilled")).alias("refill_count"),
                 F.count_if(F.col("below_threshold")).alias("hours_below_threshold")))


def daily_level_windows(daily: DataFrame, key: str = "atm_id", date: str = "event_date",
                        ma_rows: int = C.CASH_MA_ROWS,
                        critical_below: int = C.CASH_CRITICAL_BELOW,
                        low_below: int = C.CASH_LOW_BELOW) -> DataFrame:
    """The window part: moving averages over ``ma_rows`` rows, previous minimum, tier."""
    w = _series_window(key, date)
    frame = w.rowsBetween(-(ma_rows - 1), Window.currentRow)
    return daily.select(
        key, date, "min_cash_mwk", "max_cash_mwk", "avg_cash_mwk", "total_withdrawal_mwk",
        "refill_count", "hours_below_threshold",
        F.avg("avg_cash_mwk").over(frame).alias("cash_ma_7d"),
        F.avg("total_withdrawal_mwk").over(frame).alias("withdrawal_ma_7d"),
        F.lag("min_cash_mwk", 1).over(w).alias("prev_min_cash"),
        cash_status("min_cash_mwk", critical_below, low_below).alias("cash_status"),
    )


LEVEL_BASE_COLUMNS = ["min_cash_mwk", "max_cash_mwk", "avg_cash_mwk", "total_withdrawal_mwk",
                      "refill_count", "hours_below_threshold"]


def daily_level_mart(levels: DataFrame, key: str = "atm_id", date: str = "event_date",
                     level: str = "cash_level_mwk", outflow: str = "hourly_withdrawal_mwk",
                     ma_rows: int = C.CASH_MA_ROWS,
                     critical_below: int = C.CASH_CRITICAL_BELOW,
                     low_below: int = C.CASH_LOW_BELOW) -> DataFrame:
    """Daily min/max/avg level, outflow, refill and below-threshold counts,
    ``ma_rows``-row moving averages, previous day's minimum and a status tier."""
    return daily_level_windows(daily_level_base(levels, key, date, level, outflow),
                               key, date, ma_rows, critical_below, low_below)


def daily_fault_base(faults: DataFrame, key: str = "atm_id", date: str = "event_date",
                     components=C.COMPONENTS) -> DataFrame:
    """The aggregate part of the daily fault mart: one row per device and day.

    The counts per component are computed in the same aggregate as the
    totals (one shuffle instead of an aggregate, a second aggregate and a
    join).  As with the equi-join on the date, a row whose date is NULL gets
    0 for every component.
    """
    has_date = F.col(date).isNotNull()
    is_fault = F.col("is_fault") == 1
    comp_aggs = [F.count_if((F.col("component") == c) & has_date).alias(f"{c}_events")
                 for c in components]
    daily = (faults.filter(F.col(key).isNotNull())
             .groupBy(key, date)
             .agg(F.count_if(is_fault).alias("faults"),
                  F.count_if(F.col("event_class") == "warning").alias("warnings"),
                  F.count_if(F.col("unresolved_flag") == 1).alias("unresolved"),
                  F.avg(F.when(is_fault, F.col("duration_mins"))).alias("avg_duration_mins"),
                  F.sum(F.when(is_fault, F.col("duration_mins"))).alias("total_downtime_mins"),
                  *comp_aggs))
    return daily.select(
        key, date, "faults", "warnings", "unresolved",
        F.coalesce("avg_duration_mins", F.lit(0.0)).alias("avg_duration_mins"),
        F.coalesce("total_downtime_mins", F.lit(0)).cast("long").alias("total_downtime_mins"),
        *[f"{c}_events" for c in components])


def daily_fault_windows(daily: DataFrame, key: str = "atm_id", date: str = "event_date",
                        rolling_rows: int = C.FAULT_ROLLING_ROWS,
                        high_faults: int = C.SEVERITY_HIGH_FAULTS,
                        medium_warnings: int = C.SEVERITY_MEDIUM_WARNINGS,
                        calendar_days: int | None = None) -> DataFrame:
    """The window part: rolling fault sum over ``rolling_rows`` rows, severity."""
    w = _series_window(key, date)
    cols = [F.col(c) for c in daily.columns]
    cols.append(F.sum("faults").over(w.rowsBetween(-(rolling_rows - 1), Window.currentRow))
                 .alias("faults_ma_30d"))
    if calendar_days:
        day_no = Window.partitionBy(key).orderBy(F.unix_date(F.col(date)))
        cols.append(F.sum("faults").over(day_no.rangeBetween(-(calendar_days - 1), 0))
                     .alias(f"faults_{calendar_days}d"))
    cols.append(severity("faults", "warnings", high_faults, medium_warnings).alias("severity"))
    return daily.select(*cols)


def daily_fault_mart(faults: DataFrame, key: str = "atm_id", date: str = "event_date",
                     components=C.COMPONENTS, rolling_rows: int = C.FAULT_ROLLING_ROWS,
                     high_faults: int = C.SEVERITY_HIGH_FAULTS,
                     medium_warnings: int = C.SEVERITY_MEDIUM_WARNINGS,
                     calendar_days: int | None = None) -> DataFrame:
    """Daily fault profile from staged fault events (``stg_faults``).

    ``faults_ma_30d`` is a rolling SUM over the last ``rolling_rows`` *rows*
    (days with events), not calendar days; ``calendar_days`` adds a
    ``faults_<n>d`` column summing over calendar days instead.
    """
    return daily_fault_windows(daily_fault_base(faults, key, date, components), key, date,
                               rolling_rows, high_faults, medium_warnings, calendar_days)


def device_tx_stats(tx: DataFrame, key: str = "atm_id",
                    withdrawal_type: str = "withdrawal") -> DataFrame:
    """Lifetime transaction statistics per device (algebraic: also streamable)."""
    return (tx.groupBy(key)
              .agg(F.count(F.lit(1)).alias("total_tx"),
                   F.count_if(F.col("success_flag") == 0).alias("failed_tx"),
                   F.avg(F.when(F.col("tx_type") == withdrawal_type, F.col("amount_mwk")))
                    .alias("avg_withdrawal_mwk"),
                   F.max("event_date").alias("last_tx_date")))


def device_fault_stats(faults: DataFrame, key: str = "atm_id") -> DataFrame:
    """Lifetime fault count and last fault date per device."""
    is_fault = F.col("is_fault") == 1
    return (faults.groupBy(key)
                  .agg(F.count_if(is_fault).alias("lifetime_faults"),
                       F.max(F.when(is_fault, F.col("event_date"))).alias("last_fault_date")))


def device_profile_join(dim: DataFrame, tx_stats: DataFrame, fault_stats: DataFrame,
                        key: str = "atm_id") -> DataFrame:
    """Dimension left-joined with the per-device statistics (1:1 on the key)."""
    j = dim.join(tx_stats, key, "left").join(fault_stats, key, "left")
    return j.select(
        key, "city", "region", "latitude", "longitude", "atm_type", "atm_model", "bank",
        "installed_date", "age_years", "is_active",
        F.coalesce("total_tx", F.lit(0)).alias("total_tx"),
        F.coalesce("failed_tx", F.lit(0)).alias("failed_tx"),
        safe_ratio(F.coalesce("failed_tx", F.lit(0)), F.col("total_tx")).alias("failure_rate"),
        F.coalesce("avg_withdrawal_mwk", F.lit(0.0)).alias("avg_withdrawal_mwk"),
        "last_tx_date",
        F.coalesce("lifetime_faults", F.lit(0)).alias("lifetime_faults"),
        "last_fault_date",
    )


def device_profile_mart(dim: DataFrame, tx: DataFrame, faults: DataFrame,
                        key: str = "atm_id", withdrawal_type: str = "withdrawal") -> DataFrame:
    """Per-device lifetime profile: dimension + transaction and fault statistics.

    ``dim`` is a staged dimension (``stg_dim``), ``tx`` staged transactions,
    ``faults`` staged fault events.  Both statistics are pre-aggregated per
    device (partial + final aggregation), so each join is 1:1 on the key.
    No broadcast hint: the number of devices grows with the data, and AQE
    switches a side to broadcast at run time only when its measured size is
    below ``spark.sql.autoBroadcastJoinThreshold`` (sort-merge otherwise).
    """
    return device_profile_join(dim, device_tx_stats(tx, key, withdrawal_type),
                               device_fault_stats(faults, key), key)
