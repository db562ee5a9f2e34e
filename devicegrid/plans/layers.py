"""The whole flow as one function: silver -> gold -> alerts -> messages/feed.

Replaces the source's scheduler DAG by plain ordering.  Each layer is written
and the next layer reads the written files: recomputation after an executor
loss starts from the last written layer, not from the raw scan.

Layout: silver and gold are partitioned by event month and sorted by device
inside each file, so date filters prune partitions and device filters skip
row groups by their min/max statistics.  Rows are *not* repartitioned by
month before the write: that would send a whole month to one task.  Each
task sorts what it has and writes one file per month it holds.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicegrid import config as C
from devicegrid.operators import alerts, forecast, marts, ml, staging
from devicegrid.plans.model import Model
from devicegrid.sinks import writers

MAX_RECORDS_PER_FILE = 5_000_000


def _write_layer(df: DataFrame, path: str, date_col: str | None, key: str = "atm_id") -> int:
    if date_col:
        df = (df.withColumn("event_month", F.date_format(F.col(date_col), "yyyy-MM"))
                .sortWithinPartitions("event_month", key, date_col))
        parts = ["event_month"]
    else:
        df, parts = df.sortWithinPartitions(key), None
    return writers.write_counted(df, path, "overwrite", partition_by=parts,
                                 options={"maxRecordsPerFile": str(MAX_RECORDS_PER_FILE)})


def build_layers(spark: SparkSession, sf_dir: str, out_dir: str,
                 as_of: _dt.date = C.DEFAULT_AS_OF, run_ts: str = C.DEFAULT_RUN_TS,
                 with_forecast: bool = True) -> dict[str, int]:
    """Build every layer below ``out_dir``; returns the row count per table."""
    m = Model(spark, sf_dir, as_of, run_ts)
    p = lambda *a: os.path.join(out_dir, *a)
    n: dict[str, int] = {}

    # silver
    n["silver.transactions"] = _write_layer(m.transactions, p("silver", "transactions"), "event_date")
    n["silver.cash"] = _write_layer(m.cash_levels, p("silver", "cash"), "event_date")
    n["silver.faults"] = _write_layer(m.fault_events, p("silver", "faults"), "event_date")
    n["silver.replenishments"] = _write_layer(m.refills, p("silver", "replenishments"), "refill_ts")
    n["silver.device_dim"] = _write_layer(m.device_dim, p("silver", "device_dim"), None)
    n["silver.level_dim"] = _write_layer(m.level_dim, p("silver", "level_dim"), None)
    read = lambda *a: spark.read.parquet(p(*a)).drop("event_month")

    # staging (views) and gold
    stg_tx = staging.stg_transactions(read("silver", "transactions"))
    stg_faults = staging.stg_faults(read("silver", "faults"))
    stg_cash = staging.stg_cash(read("silver", "cash"))
    stg_dim = staging.stg_dim(read("silver", "device_dim"), as_of)
    stg_level_dim = staging.stg_dim(read("silver", "level_dim"), as_of)
    n["gold.daily_cash"] = _write_layer(marts.daily_level_mart(stg_cash), p("gold", "daily_cash"),
                                       "event_date")
    n["gold.daily_faults"] = _write_layer(marts.daily_fault_mart(stg_faults),
                                         p("gold", "daily_faults"), "event_date")
    n["gold.device_profile"] = _write_layer(marts.device_profile_mart(stg_dim, stg_tx, stg_faults),
                                           p("gold", "device_profile"), None)
    daily_cash, daily_faults = read("gold", "daily_cash"), read("gold", "daily_faults")

    # alerts, messages, feed
    a = alerts.union_alerts(alerts.cash_alerts(daily_cash, stg_level_dim, run_ts=run_ts),
                            alerts.fault_alerts(daily_faults, stg_dim, run_ts=run_ts))
    n["alerts"] = writers.write_counted(a, p("alerts", "all"), "overwrite")
    a = spark.read.parquet(p("alerts", "all"))
    n["alerts.messages"] = writers.write_messages(a, p("alerts", "messages"))
    n["alerts.feed"] = writers.write_feed(a, p("alerts", "feed"), generated_at=run_ts)

    # features and forecast
    n["features.next_day_label"] = writers.write_counted(
        ml.next_event_label(daily_faults), p("features", "next_day_label"))
    if with_forecast:
        n["forecast.cash"] = writers.write_counted(forecast.forecast_horizon(daily_cash),
                                                   p("forecast", "cash"))
    return n


def main(argv=None) -> None:
    """``python -m devicegrid.plans.layers --sf-dir DIR [--out DIR]``.

    Without ``--out`` the layers go below the session's shared checkpoint
    folder (``spark.checkpoint.dir``).
    """
    import argparse
    import json
    import uuid

    from devicegrid.session import build_session, shared_path

    ap = argparse.ArgumentParser(description=main.__doc__)
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out")
    ap.add_argument("--as-of", default=C.DEFAULT_AS_OF.isoformat())
    ap.add_argument("--no-forecast", action="store_true")
    a = ap.parse_args(argv)
    spark = build_session()
    out = a.out or shared_path(spark, "layers", uuid.uuid4().hex[:12])
    n = build_layers(spark, a.sf_dir, out, _dt.date.fromisoformat(a.as_of),
                     with_forecast=not a.no_forecast)
    print(json.dumps({"out": out, "rows": n}))


if __name__ == "__main__":
    main()
