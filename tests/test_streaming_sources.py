"""Streaming restart / de-duplication, file sources and sinks."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from devicegrid.session import shared_path
from devicegrid.sinks import writers
from devicegrid.sources import files
from devicegrid.sources.schemas import BRONZE_SCHEMAS, TX_MESSAGE_SCHEMA
from devicegrid.streaming import epochs, ingest, live


def _scratch(spark, name):
    """A fresh folder below the session's shared checkpoint folder."""
    return shared_path(spark, "tests", f"{name}-{uuid.uuid4().hex[:10]}")


def _land(spark, folder, rows):
    os.makedirs(folder, exist_ok=True)
    spark.createDataFrame(rows, ingest.ENVELOPE).coalesce(1).write.mode("append").json(folder)


def _msg(i, ts="2024-01-01 00:00:00"):
    v = json.dumps({"event_id": i, "atm_id": f"A{i % 3}", "timestamp": ts, "tx_type": "withdrawal",
                    "amount_mwk": 100 + i, "card_type": "Visa", "success": True})
    import datetime as dt
    return (f"A{i % 3}", v, dt.datetime(2024, 1, 1, 0, i % 60), i % 3, i)


def test_restart_on_checkpoint_gives_no_duplicates(spark):
    base = _scratch(spark, "stream")
    landing, out, ck = f"{base}/in", f"{base}/bronze", f"{base}/ck"
    _land(spark, landing, [_msg(i) for i in range(100)])
    q = ingest.ingest(spark, TX_MESSAGE_SCHEMA, ingest.file_stream(spark, landing), out, ck)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 100
    # restart without new input: nothing added
    q = ingest.ingest(spark, TX_MESSAGE_SCHEMA, ingest.file_stream(spark, landing), out, ck)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 100
    # 10 more messages: only those are added
    _land(spark, landing, [_msg(i) for i in range(100, 110)])
    q = ingest.ingest(spark, TX_MESSAGE_SCHEMA, ingest.file_stream(spark, landing), out, ck)
    q.awaitTermination()
    b = spark.read.parquet(out)
    assert b.count() == 110 and b.select("event_id").distinct().count() == 110
    assert set(b.columns) >= {"kafka_ts", "partition", "offset", "ingested_at", "ingest_date"}


def test_resent_messages_dropped_within_watermark(spark):
    base = _scratch(spark, "dedupe")
    landing, out, ck = f"{base}/in", f"{base}/bronze", f"{base}/ck"
    rows = [_msg(i) for i in range(20)]
    resent = [(k, v, ts, p, o + 1000) for k, v, ts, p, o in rows[:5]]  # new offsets, same ids
    _land(spark, landing, rows + resent)
    q = ingest.ingest(spark, TX_MESSAGE_SCHEMA, ingest.file_stream(spark, landing), out, ck,
                      dedupe_key="event_id")
    q.awaitTermination()
    assert spark.read.parquet(out).select("event_id").distinct().count() == 20
    assert spark.read.parquet(out).count() == 20


def test_live_sink_and_per_minute(spark):
    base = _scratch(spark, "live")
    landing = f"{base}/in"
    _land(spark, landing, [_msg(i) for i in range(30)] + [("x", "junk", None, 0, 999)])
    rows = live.live_rows(ingest.to_bronze(ingest.file_stream(spark, landing), TX_MESSAGE_SCHEMA))
    live.drained(live.start_live_sink(rows, f"{base}/live", f"{base}/ck"), 300)
    t = spark.read.schema(rows.schema).parquet(f"{base}/live")
    assert t.count() == 30 and t.filter(F.col("event_ts").isNull()).count() == 0
    batch = ingest.to_bronze(spark.read.schema(ingest.ENVELOPE).json(landing), TX_MESSAGE_SCHEMA)
    pm = live.per_minute_counts(batch.filter("atm_id IS NOT NULL"), ts="kafka_ts")
    assert pm.agg(F.sum("n")).first()[0] == 30
    top = live.latest_n(batch.filter("atm_id IS NOT NULL"), 15, "kafka_ts", "offset").collect()
    assert len(top) == 15


def test_weather_holidays_feed_and_missing(spark):
    base = _scratch(spark, "files")
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/weather.json", "w") as f:
        json.dump({"daily": {"time": ["2023-01-01", "2023-01-02"], "temperature_2m_max": [30.1, 29.0],
                             "temperature_2m_min": [18.0, 17.5], "precipitation_sum": [0.0, 12.3],
                             "windspeed_10m_max": [10.0, 12.0]}}, f)
    with open(f"{base}/holidays.json", "w") as f:
        json.dump([{"date": "2023-01-02", "name": "New Year", "localName": "Chaka Chatsopano",
                    "countryCode": "MW"}], f)
    w = files.read_weather(spark, f"{base}/weather.json").orderBy("date").collect()
    assert len(w) == 2 and w[1].precipitation_sum == 12.3 and str(w[0].date) == "2023-01-01"
    h = files.read_holidays(spark, f"{base}/holidays.json").first()
    assert h.name == "New Year" and str(h.date) == "2023-01-02"
    empty = files.read_or_empty(spark, f"{base}/nope", BRONZE_SCHEMAS["atm.cash"])
    assert empty.count() == 0 and empty.columns == BRONZE_SCHEMAS["atm.cash"].fieldNames()
    assert files.read_feed_entries(spark, f"{base}/nofeed").count() == 0
    df = spark.createDataFrame([("2024-01-02", "x"), ("bad", "y")], "install_date string, name string")
    p = files.parse_date_columns(df).collect()
    assert p[1].install_date is None and p[0].install_date is not None


def test_written_row_count_and_inventory(spark):
    base = _scratch(spark, "sink")
    n = writers.write_counted(spark.range(123), f"{base}/t")
    assert n == 123 and spark.read.parquet(f"{base}/t").count() == 123
    n = writers.overwrite_partitions(spark.range(10).withColumn("p", F.col("id") % 2), f"{base}/p", ["p"])
    assert n == 10
    writers.overwrite_partitions(spark.range(3).withColumn("p", F.lit(0)), f"{base}/p", ["p"])
    assert spark.read.parquet(f"{base}/p").count() == 8  # partition 1 kept, partition 0 replaced
    writers.save_table(spark.range(3), "dg_inv_view", materialized="view")
    writers.save_table(spark.range(4), "dg_inv_table")
    inv = {r.database: r.tables for r in writers.table_inventory(spark).collect()}
    assert inv["default"] >= 2 and spark.table("dg_inv_table").count() == 4
    writers.truncate_table(spark, "dg_inv_table")
    assert spark.table("dg_inv_table").count() == 0
    spark.sql("DROP TABLE dg_inv_table")
    run = writers.append_metrics(spark, f"{base}/metrics", "m", {"a": 1.0, "b": 2.0})
    assert spark.read.parquet(f"{base}/metrics").filter(F.col("run_id") == run).count() == 2


def test_build_layers_writes_every_layer(spark, sf_dir):
    import __spark_entry__ as E
    from devicegrid.plans.layers import build_layers
    out = _scratch(spark, "pipe")
    n = build_layers(spark, sf_dir, out)
    assert n["silver.cash"] == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    gold = spark.read.parquet(f"{out}/gold/daily_cash").drop("event_month")
    q = E.queries()["daily_cash_mart"](spark, sf_dir)
    assert gold.count() == q.count() == n["gold.daily_cash"]
    assert gold.select(F.sum("total_withdrawal_mwk")).first()[0] == \
        q.select(F.sum("total_withdrawal_mwk")).first()[0]
    assert n["alerts"] == E.queries()["all_alerts"](spark, sf_dir).count()
    assert n["alerts.messages"] == 2 * n["alerts"]
    assert spark.read.json(f"{out}/alerts/feed/summary").first().total_alerts == n["alerts"]
    assert files.read_feed_entries(spark, f"{out}/alerts/feed/alerts").count() == n["alerts"]
    msgs = spark.read.json(f"{out}/alerts/messages")
    assert {r.channel for r in msgs.select("channel").distinct().collect()} == {"sms", "email"}
    # month partitions exist and prune
    assert any(d.startswith("event_month=") for d in os.listdir(f"{out}/silver/cash"))


def test_mart_refresh_with_late_batches_equals_batch_mart(spark, sf_dir):
    from devicegrid.operators import marts, staging
    from devicegrid.plans.model import Model
    from devicegrid.streaming import marts_stream
    faults = Model(spark, sf_dir).fault_events
    base = _scratch(spark, "martref")
    # up to 1998, then from 2000 and rows without a date, then late rows of 1999
    year = F.year("event_date")
    undated = faults.filter(F.dayofmonth("event_date") == 3).withColumn("event_date", F.lit(None).cast("date"))
    parts = [faults.filter(year <= 1998), faults.filter(year >= 2000).unionByName(undated), faults.filter(year == 1999)]
    for epoch, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
        src = spark.readStream.schema(faults.schema).parquet(f"{base}/in")
        marts_stream.start_mart_refresh(src, f"{base}/daily", f"{base}/mart", f"{base}/ck",
                                        lambda rows: marts.daily_fault_base(staging.stg_faults(rows)),
                                        marts.daily_fault_windows).awaitTermination()
    seen = spark.read.schema(faults.schema).parquet(f"{base}/in")
    want = marts.daily_fault_mart(staging.stg_faults(seen))
    got = marts_stream.read_mart(spark, f"{base}/mart", want.schema)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    # the late batch replays from each device's first late day on, and what comes after it
    last = epochs.read_epochs(spark, f"{base}/mart", want.schema).filter("epoch = 2")
    assert last.filter(F.year("event_date") < 1999).count() == 0 and last.filter(F.year("event_date") > 1999).count() > 0
    # a retried epoch replaces itself
    daily = marts.daily_fault_base(staging.stg_faults(seen))
    again = epochs.read_epochs(spark, f"{base}/daily", daily.schema).filter("epoch = 2")
    again.select(*daily.columns).write.parquet(f"{base}/again")
    run = again.first().run
    before = spark.read.parquet(f"{base}/mart").count()
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", run)
    try:
        marts_stream.refresh_batch(spark.read.parquet(f"{base}/again"), 2, f"{base}/daily", f"{base}/mart", marts.daily_fault_windows)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert spark.read.parquet(f"{base}/mart").count() == before
    assert marts_stream.read_mart(spark, f"{base}/mart", want.schema).exceptAll(want).count() == 0


def _landed_levels(spark, base):
    """Level readings of three devices in two files; the second has a late day of device 1."""
    import datetime as dt
    schema = "atm_id long, event_ts timestamp, event_date date, cash_level_mwk long, hourly_withdrawal_mwk long, was_refilled boolean, below_threshold boolean"
    day = lambda k, d: (k, dt.datetime(2024, 1, d, 6), dt.date(2024, 1, d), 1000 * k + d, d, d % 2 == 0, k == 2)
    for rows in ([day(1, 2), day(1, 9), day(2, 3), day(3, 4)], [day(1, 5), day(1, 9), day(2, 8)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")


def _refreshed_levels(spark, base):
    from devicegrid.operators import marts, staging
    from devicegrid.streaming import marts_stream
    src = _landed_levels(spark, base)
    marts_stream.start_mart_refresh(src, f"{base}/daily", f"{base}/mart", f"{base}/ck",
                                    lambda rows: marts.daily_level_base(staging.stg_cash(rows)), marts.daily_level_windows).awaitTermination()
    want = marts.daily_level_mart(staging.stg_cash(spark.read.schema(src.schema).parquet(f"{base}/in")))
    return marts_stream.read_mart(spark, f"{base}/mart", want.schema), want


def test_daily_rows_of_a_mart_stream_lie_on_disk(spark):
    """The state of a mart's stream is as large as its daily rows: not kept in the heap."""
    base, key = _scratch(spark, "martstate"), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    got, want = _refreshed_levels(spark, base)
    with open(f"{base}/ck/offsets/0") as f:
        assert "RocksDBStateStoreProvider" in f.read()
    assert spark.conf.get(key) == before and spark.conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "false") == "false"
    assert got.count() == 6 and got.exceptAll(want).count() == 0


def test_replay_deals_daily_rows_out_once(spark, monkeypatch):
    """Newest rows, touched devices and windows of a replay share one exchange by device."""
    from devicegrid.operators import marts
    from devicegrid.streaming import marts_stream
    base, plans, write = _scratch(spark, "martplan"), [], epochs.write_epoch

    def spied(rows, path, run, epoch):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, path, run, epoch)
    monkeypatch.setattr(epochs, "write_epoch", spied)
    daily = marts.daily_level_base(spark.range(400).select(
        (F.col("id") % 5).alias("atm_id"), F.expr("date_add(date '2024-01-01', cast(id % 40 as int))").alias("event_date"),
        F.col("id").alias("cash_level_mwk"), F.col("id").alias("hourly_withdrawal_mwk"), F.lit(True).alias("was_refilled"), F.lit(False).alias("below_threshold")))
    for epoch in (0, 1):
        marts_stream.refresh_batch(daily.filter(F.col("atm_id") >= 3 * epoch), epoch, f"{base}/daily", f"{base}/mart", marts.daily_level_windows)
    assert plans[3].count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plans[3]
    want = marts.daily_level_windows(daily)
    got = marts_stream.read_mart(spark, f"{base}/mart", want.schema)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


STATS = "atm_id long, total_tx long"


def _stats(spark, path):
    schema = spark.createDataFrame([], STATS).schema
    rows = epochs.latest(epochs.read_epochs(spark, path, schema), ["atm_id"])
    return sorted((r.atm_id, r.total_tx) for r in rows.collect())


def test_epochs_replace_themselves_and_the_newest_version_holds(spark):
    path = f"{_scratch(spark, 'epochs')}/stats"
    assert _stats(spark, path) == []
    epochs.write_epoch(spark.createDataFrame([(1, 5), (2, 7), (3, 1)], STATS), path, "q", 0)
    epochs.write_epoch(spark.createDataFrame([(1, 99)], STATS), path, "q", 1)
    epochs.write_epoch(spark.createDataFrame([(1, 6), (4, None)], STATS), path, "q", 1)  # retried: replaced, not added
    assert _stats(spark, path) == [(1, 6), (2, 7), (3, 1), (4, None)]
    epochs.write_epoch(spark.createDataFrame([], STATS), path, "q", 2)
    # a fresh checkpoint has another id: its epoch 0 adds, and is newer
    epochs.write_epoch(spark.createDataFrame([(2, 1), (7, 1)], STATS), path, "other", 0)
    assert _stats(spark, path) == [(1, 6), (2, 1), (3, 1), (4, None), (7, 1)]
    # an epoch that broke off half-way leaves the others as they were
    with pytest.raises(Exception, match="broke off"):
        broken = spark.createDataFrame([(3, 50)], STATS).withColumn(
            "total_tx", F.when(F.col("atm_id") == 3, F.raise_error(F.lit("broke off")).cast("long")))
        epochs.write_epoch(broken, path, "other", 1)
    assert (3, 1) in _stats(spark, path)


def test_rows_behind_the_watermark_are_an_error(spark):
    base = _scratch(spark, "late")
    for i in range(4):  # four files that each cover the whole time range
        _land(spark, f"{base}/in", [_msg(j) for j in range(i, 400, 4)])
    b = ingest.to_bronze(ingest.file_stream(spark, f"{base}/in", max_files_per_trigger=1), TX_MESSAGE_SCHEMA)

    def run(delay, name):
        counts = live.per_minute_counts(b, ts="kafka_ts", delay=delay, where=F.col("atm_id").isNotNull())
        with live.LateRows(spark) as late:
            late.finished(live.start_minute_counts(counts, f"{base}/{name}", f"{base}/{name}-ck"))
        return live.minute_counts(spark, f"{base}/{name}", counts.schema)

    assert run("400 days", "wide").agg(F.sum("n")).first()[0] == 400
    with pytest.raises(RuntimeError, match="later than the watermark"):
        run("1 second", "narrow")


def test_no_scratch_folder_on_a_cluster(spark):
    from devicegrid import session

    class Cluster:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster)


def test_ingest_by_topic_name(spark, sf_dir):
    from devicegrid.plans.model import Model
    base = _scratch(spark, "topic")
    m = Model(spark, sf_dir)
    for topic, entity in (("atm.cash", "cash"), ("atm.replenishments", "replenishments")):
        m.messages(topic).write.json(f"{base}/{entity}-in")
        ingest.main(["--topic", topic, "--files", f"{base}/{entity}-in", "--out", base, "--checkpoint", f"{base}/ck-{entity}"])
        assert spark.read.parquet(f"{base}/{entity}").where("not malformed").count() == m.messages(topic).count()
    with pytest.raises(ValueError, match="unknown topic"):
        ingest.ingest_topic(spark, "atm.other", None, base, base)


def test_late_rows_are_counted_over_more_batches_than_a_query_remembers(spark):
    base = _scratch(spark, "manylate")
    _land(spark, f"{base}/in", [_msg(59)])  # advances event time; every later file is behind it
    for i in range(12):
        _land(spark, f"{base}/in", [_msg(0)])
    b = ingest.to_bronze(ingest.file_stream(spark, f"{base}/in", max_files_per_trigger=1), TX_MESSAGE_SCHEMA)
    counts = live.per_minute_counts(b, ts="kafka_ts", delay="1 second")
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 3)  # a short memory stands for a long stream
    try:
        with live.LateRows(spark) as late:
            q = live.start_minute_counts(counts, f"{base}/out", f"{base}/ck")
            with pytest.raises(RuntimeError, match="later than the watermark"):
                late.finished(q)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    remembered = sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])
    counted = live.minute_counts(spark, f"{base}/out", counts.schema).agg(F.sum("n")).first()[0]
    lost = late.lost[str(q.runId)]
    assert counted + lost == 13 and lost >= 11 > remembered  # the batch after an advance may still admit
    assert late.batches[str(q.runId)] > len(q.recentProgress)


def test_insert_batches_by_size_or_age_lose_and_repeat_nothing_over_a_restart(spark):
    import time
    base = _scratch(spark, "batches")

    def start(seconds):
        rows = live.live_rows(ingest.to_bronze(ingest.file_stream(spark, f"{base}/in"), TX_MESSAGE_SCHEMA))
        return live.start_live_sink(rows, f"{base}/live", f"{base}/ck", seconds=seconds)

    def out():
        schema = "partition int, offset long, batch_offset long, batch_rows int"
        return spark.read.schema(schema).parquet(f"{base}/live").collect() if os.path.exists(f"{base}/live") else []

    _land(spark, f"{base}/in", [_msg(i) for i in range(135)])  # 45 rows in each of 3 partitions
    q = start(3600)
    end = time.monotonic() + 120
    while len(out()) < 120 and time.monotonic() < end:
        time.sleep(1)
    q.stop()  # 5 rows a partition are held in state, too young to go
    first = out()
    assert len(first) == 120 and {r.batch_rows for r in first} == {20}
    _land(spark, f"{base}/in", [_msg(i) for i in range(135, 135 + 54)])  # 18 more each: 23 held, so one batch and 3 rows
    q = start(2)
    live.drained(q, 300)
    rows = out()
    assert sorted(r.offset for r in rows) == list(range(189))
    sizes = {}
    for r in rows:
        sizes.setdefault((r.partition, r.batch_offset), []).append(r)
    for p in range(3):
        assert sorted(len(v) for k, v in sizes.items() if k[0] == p) == [3, 20, 20, 20]
    assert all(len(v) == v[0].batch_rows for v in sizes.values())


def test_laid_out_tables_need_no_exchange_and_keep_their_order(spark, sf_dir):
    import __spark_entry__ as E
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for tables beyond a broadcast
    try:
        text = E.queries()["laid_out_devices"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" in text and "Window" in text and "Exchange" not in text
    spark.sql("CREATE DATABASE order_check LOCATION '" + _scratch(spark, "order") + "'")
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), F.xxhash64("id").alias("at"), "id")
    t = writers.save_laid_out(rows, "order_check.t", "k", ["at"], buckets=4)
    assert sorted(r.id for r in t.collect()) == list(range(1000))
    files_of = t.select("_metadata.file_path").distinct().collect()
    assert 1 <= len(files_of) <= 4  # one file a bucket
    for f in files_of:
        got = [(r.k, r["at"]) for r in spark.read.parquet(f.file_path).coalesce(1).collect()]
        assert got == sorted(got)


def test_landed_ranges_are_split_by_their_rows(spark, monkeypatch):
    from devicegrid.plans import catalog
    from devicegrid.session import shared_path
    monkeypatch.setattr(catalog, "FILE_ROWS", 100)
    rows = spark.range(3000).select((F.col("id") % 7).alias("atm_id"), F.timestamp_seconds(F.col("id") % 50).alias("event_ts"))
    path = shared_path(spark, "tests", f"ranges-{uuid.uuid4().hex[:10]}")
    src = catalog._stream_by_time(rows, path, 6, 2)
    assert src.isStreaming and src.schema == rows.schema
    counts = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert sum(counts) == 3000 and len(counts) > 20 and max(counts) <= 250


def test_table_inventory_leaves_out_temporary_views(spark):
    before = sorted(writers.table_inventory(spark, views=False).collect())
    spark.range(1).createOrReplaceTempView("inventory_view")
    try:
        assert sorted(writers.table_inventory(spark, views=False).collect()) == before
    finally:
        spark.catalog.dropTempView("inventory_view")
