"""Measure per-task shuffle input of the daily mart under a hot device.

One device is given a third of all level readings.  The daily mart's plan
(partial aggregate -> shuffle on (device, date) -> final aggregate ->
shuffle on device -> window) is run next to a naive plan that first
repartitions the raw rows by device.  Task metrics come from Spark's event
log, written to a scratch folder (no UI).  Prints a markdown table.

    python tools/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(sf_dir: str = "/root/testdata/sf0.1") -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from devicegrid.operators import marts, silver, staging
    from devicegrid.sources import adapters
    from devicegrid.sources.tables import Tables

    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-probe")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "64")
             # keep the 64 reduce tasks visible instead of coalescing them
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    levels = adapters.cash_levels(Tables(spark, sf_dir))
    hot = levels.withColumn("atm_id", F.when(
        F.pmod(F.xxhash64("event_ts", "cash_level_mwk", "hourly_withdrawal_mwk"), F.lit(3)) == 0,
        F.lit(0)).otherwise(F.col("atm_id")))
    hot_rows = hot.filter(F.col("atm_id") == 0).count()
    total = hot.count()

    # latest-wins de-duplication with one key holding a third of the rows
    li = Tables(spark, sf_dir).lineitem
    hot_key = F.pmod(F.xxhash64("l_partkey", "l_quantity", "l_shipdate"), F.lit(3)) == 0
    dup = (li.withColumn("l_orderkey", F.when(hot_key, F.lit(-1)).otherwise(F.col("l_orderkey")))
             .withColumn("l_linenumber", F.when(hot_key, F.lit(1)).otherwise(F.col("l_linenumber"))))
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    keys = ["l_orderkey", "l_linenumber"]

    def dedupe_max_by():
        payload = [c for c in dup.columns if c not in keys]
        best = F.max_by(F.struct(*payload), F.struct(*order))
        return (dup.groupBy(*keys).agg(best.alias("_b"))
                   .select(*keys, *[F.col("_b").getField(c).alias(c) for c in payload]))

    # device profile with one device owning a third of the transactions
    t = Tables(spark, sf_dir)
    tx = adapters.transactions(t)
    hot_tx = tx.withColumn("atm_id", F.when(F.pmod(F.col("event_id"), F.lit(3)) == 0, F.lit(0))
                           .otherwise(F.col("atm_id")))
    dim = staging.stg_dim(adapters.device_dim(t))
    faults = staging.stg_faults(adapters.fault_events(t))

    runs = {
        "mart: aggregate then window (used)": lambda: marts.daily_level_mart(hot),
        "mart: repartition by device first": lambda: marts.daily_level_mart(hot.repartition("atm_id")),
        "dedupe: row_number = 1 window (used)": lambda: silver.dedupe_latest(dup, keys, order),
        "dedupe: max_by struct aggregate": dedupe_max_by,
        "profile: pre-aggregated stats, 1:1 joins (used)":
            lambda: marts.device_profile_mart(dim, staging.stg_transactions(hot_tx), faults),
    }
    hot_dup = dup.filter(F.col("l_orderkey") == -1).count()
    hot_user = hot_tx.filter(F.col("atm_id") == 0).count()
    tx_total = tx.count()
    for name, build in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_group, tasks = {}, defaultdict(list)
    # Spark 4 writes a rolling event log: a folder of events_<n>_<app> files
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p) and "appstatus" not in os.path.basename(p))
    for path in paths:
        with open(path) as f:
            events = [json.loads(line) for line in f if line.strip()]
        for e in events:
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerTaskEnd":
                rm = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                recs = rm.get("Total Records Read", 0)
                if recs:
                    tasks[e["Stage ID"]].append(recs)

    print(f"input rows {total:,}; hot device rows {hot_rows:,} "
          f"({hot_rows / total:.0%}); hot de-duplication key rows {hot_dup:,}; "
          f"hot device transactions {hot_user:,} of {tx_total:,}; "
          "64 shuffle partitions, AQE coalescing off\n")
    print("| plan | shuffle-read stage | tasks | max records per task | median |")
    print("|---|---|---|---|---|")
    for name in runs:
        for sid in sorted(s for s, g in stage_group.items() if g == name and tasks.get(s)):
            t = tasks[sid]
            print(f"| {name} | {sid} | {len(t)} | {max(t):,} | {int(statistics.median(t)):,} |")


if __name__ == "__main__":
    main(*sys.argv[1:])
