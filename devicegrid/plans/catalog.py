"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables in full (no id subsets, no row caps
except where a limit is the feature, e.g. a top-k report) and returns a lazy
DataFrame.  Computed columns carry the same names as in the SQL oracle.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicegrid import config as C
from devicegrid.functions import exprs
from devicegrid.operators import alerts, boosting, clusters, encode, forecast, marts, ml, profile, silver, staging
from devicegrid.plans import sql_marts
from devicegrid.plans.model import Model
from devicegrid.plans.normalize import round_doubles
from devicegrid.session import cut_lineage, shared_path
from devicegrid.sinks import writers
from devicegrid.sources import adapters, files
from devicegrid.sources.schemas import BRONZE_SCHEMAS, TX_MESSAGE_SCHEMA
from devicegrid.streaming import ingest, live, marts_stream, profile_stream, topic

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(Model(spark, sf_dir)))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# --- gold marts -------------------------------------------------------------

@query("daily_cash_mart")
def daily_cash_mart(m: Model) -> DataFrame:
    """Daily level mart: G1 G2 W1 W2 W3 P7 (flagship)."""
    return m.daily_cash


@query("daily_fault_mart")
def daily_fault_mart(m: Model) -> DataFrame:
    """Daily fault mart: G2 G3 G5 G6 W4 P8 P11."""
    return m.daily_faults


@query("device_profile_mart")
def device_profile_mart(m: Model) -> DataFrame:
    """Device profile: G3 G4 J1 P11 P13 X5."""
    return m.device_profile


# --- staging ----------------------------------------------------------------

@query("stg_transactions")
def stg_transactions(m: Model) -> DataFrame:
    """Flags and calendar columns on transactions."""
    return m.stg_transactions


@query("stg_faults")
def stg_faults(m: Model) -> DataFrame:
    """Fault flags."""
    return m.stg_faults


@query("stg_refills")
def stg_refills(m: Model) -> DataFrame:
    """Refill log derived from level readings."""
    return m.stg_refills


# --- alerts -----------------------------------------------------------------

@query("cash_alerts")
def cash_alerts(m: Model) -> DataFrame:
    """F2 F5 J3 J5 P9 X12 X13."""
    return m.cash_alerts


@query("fault_alerts")
def fault_alerts(m: Model) -> DataFrame:
    """F3 F4 J3 P9 X12 X14."""
    return m.fault_alerts


@query("all_alerts")
def all_alerts(m: Model) -> DataFrame:
    """Both kinds with repeatable ids."""
    return m.all_alerts.select(*alerts.ALERT_COLUMNS)


@query("alert_messages")
def alert_messages(m: Model) -> DataFrame:
    """K8 P10: one row per alert and channel."""
    return alerts.alert_messages(m.all_alerts)


@query("alert_feed_summary")
def alert_feed_summary(m: Model) -> DataFrame:
    """Alert totals by type and priority."""
    return alerts.feed_counts(m.all_alerts)


# --- wire format, silver ------------------------------------------------------

@query("json_encode_keyed")
def json_encode_keyed(m: Model) -> DataFrame:
    """K4 K5 X11: keyed JSON messages of the transactions (rows-only check)."""
    return encode.encode_keyed(m.transactions)


@query("message_field_types")
def message_field_types(m: Model) -> DataFrame:
    """Drift report of all five topics, the JSON types found per field."""
    return functools.reduce(DataFrame.unionByName, [
        silver.field_types(m.messages(name), schema).select(F.lit(name).alias("topic"), "field", "type", "n", "drifted")
        for name, schema in BRONZE_SCHEMAS.items()])


@query("silver_transactions")
def silver_transactions(m: Model) -> DataFrame:
    """All transactions through message, decode, time parsing, key filter."""
    return m.silver("atm.transactions").select("event_id", "atm_id", "event_ts", "event_date", "tx_type",
                                               "amount_mwk", "card_type", "success")


@query("silver_cash")
def silver_cash(m: Model) -> DataFrame:
    """All level readings through message and decode."""
    return m.silver("atm.cash")


@query("silver_faults")
def silver_faults(m: Model) -> DataFrame:
    """All fault events through message and decode."""
    return m.silver("atm.faults")


@query("silver_replenishments")
def silver_replenishments(m: Model) -> DataFrame:
    """All refills through message and decode."""
    return m.silver("atm.replenishments")


@query("quarantine_transactions")
def quarantine_transactions(m: Model) -> DataFrame:
    """Messages that cannot enter silver, with the reason: here every transaction, cut off in its middle."""
    return m.tx_quarantine.select("offset", "reason")


@query("silver_dim_latest")
def silver_dim_latest(m: Model) -> DataFrame:
    """Dimension messages with re-sent versions -> silver, latest version wins."""
    msgs = adapters.dimension_messages(m.device_dim)
    bronze = silver.decode_json(msgs, BRONZE_SCHEMAS["atm.dim"],
                                keep=("kafka_ts", "partition", "offset"))
    return silver.silver_from_bronze("dim", bronze)


@query("dedupe_latest")
def dedupe_latest(m: Model) -> DataFrame:
    """One row per (l_orderkey, l_linenumber), the latest by a total order."""
    li = m.tables.lineitem
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return silver.dedupe_latest(li, ["l_orderkey", "l_linenumber"], order)


@query("calendar_features")
def calendar_features(m: Model) -> DataFrame:
    """Hour / weekend / month-end / peak features of each transaction."""
    return m.transactions.select("event_id", *exprs.calendar_features("event_ts"))


@query("component_lookup")
def component_lookup(m: Model) -> DataFrame:
    """Fault type -> component by a literal map (default for unknown types)."""
    lookup = F.create_map(*[F.lit(x) for pair in zip(C.FAULT_TYPES, C.COMPONENTS) for x in pair])
    return (m.fault_events.groupBy("fault_type").agg(F.count(F.lit(1)).alias("events"))
              .select("fault_type",
                      F.coalesce(F.try_element_at(lookup, F.col("fault_type")), F.lit("unknown"))
                       .alias("component"),
                      "events"))


# --- profiles and serving queries -------------------------------------------

@query("profile_numeric")
def profile_numeric(m: Model) -> DataFrame:
    """Mean / std / min / max per numeric column of each table, one decimal."""
    t = m.tables
    parts = [profile.numeric_profile(t.read(n)).select(F.lit(n).alias("table"), "*") for n in STAR_TABLES]
    return functools.reduce(DataFrame.unionByName, parts)


@query("profile_shapes")
def profile_shapes(m: Model) -> DataFrame:
    """Rows, columns and null cells per table."""
    return profile.shape_profile({n: m.tables.read(n) for n in STAR_TABLES})


@query("type_breakdown")
def type_breakdown(m: Model) -> DataFrame:
    """Count and rounded mean amount per transaction type."""
    return profile.type_breakdown(m.transactions)


@query("success_rate")
def success_rate(m: Model) -> DataFrame:
    """Overall success rate in percent."""
    return profile.rate_percent(m.transactions, "success", name="success_rate_pct")


@query("level_flag_counts")
def level_flag_counts(m: Model) -> DataFrame:
    """Refills and readings below the threshold."""
    return profile.flag_counts(m.cash_levels, {"refills": "was_refilled",
                                               "hours_below_threshold": "below_threshold"})


@query("class_type_pivot")
def class_type_pivot(m: Model) -> DataFrame:
    """Fault events by class x type, missing = 0."""
    return profile.crosstab_counts(m.fault_events, "event_class", "fault_type", C.FAULT_TYPES)


@query("dimension_counts")
def dimension_counts(m: Model) -> DataFrame:
    """Devices per region and per type."""
    return profile.dimension_counts(m.device_dim, ["region", "atm_type"])


@query("filter_values")
def filter_values(m: Model) -> DataFrame:
    """Sorted distinct regions and types (filter lists)."""
    return profile.filter_lists(m.device_dim, ["region", "atm_type"])


@query("severity_distribution")
def severity_distribution(m: Model) -> DataFrame:
    """Device-days per severity."""
    return m.daily_faults.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))


@query("status_distribution")
def status_distribution(m: Model) -> DataFrame:
    """Cash status counts on the latest day."""
    return profile.value_counts(profile.latest_rows(m.daily_cash, date_source=m.stg_cash),
                                "cash_status")


@query("network_kpis")
def network_kpis(m: Model) -> DataFrame:
    """Network figures in one row."""
    return profile.network_kpis(m.device_profile, m.daily_cash)


@query("latest_status_map")
def latest_status_map(m: Model) -> DataFrame:
    """Devices with the latest day's status, default healthy."""
    return profile.latest_status_map(m.level_dim, m.daily_cash, date_source=m.stg_cash)


@query("component_matrix_long")
def component_matrix_long(m: Model) -> DataFrame:
    """Component events per device, long format."""
    return profile.component_matrix_long(m.daily_faults)


@query("top10_faulty")
def top10_faulty(m: Model) -> DataFrame:
    """Ten devices with the highest rolling fault sum."""
    return profile.top_k(m.daily_faults, "atm_id", "faults_ma_30d", 10)


@query("feed_page")
def feed_page(m: Model) -> DataFrame:
    """First 25 P1/P2 alerts of the feed in a total order."""
    a = m.all_alerts.filter(F.col("priority").isin("P1", "P2"))
    entries = a.select("alert_id", "type", "priority", "atm_id", "event_date", "city",
                       F.col("sms").alias("message"), "created_at")
    return profile.first_n(entries, ["priority", "type", "atm_id", "event_date"], 25)


@query("entity_history")
def entity_history(m: Model) -> DataFrame:
    """F8 O1: daily series of the device with the lowest level on the latest day."""
    latest = profile.latest_rows(m.daily_cash, date_source=m.stg_cash)
    worst = (latest.orderBy(F.col("min_cash_mwk").asc(), F.col("atm_id").asc())
                   .select("atm_id").limit(1))
    return (m.daily_cash.join(worst, "atm_id", "left_semi")
              .select("atm_id", "event_date", "min_cash_mwk", "cash_ma_7d", "cash_status")
              .orderBy("event_date"))


@query("sample_repeatable")
def sample_repeatable(m: Model) -> DataFrame:
    """100 transactions in a seeded order."""
    return profile.repeatable_sample(m.transactions, 100, ["event_id"])


@query("shuffled_transactions")
def shuffled_transactions(m: Model) -> DataFrame:
    """All transactions in a seeded order."""
    return profile.shuffled(m.transactions, ["event_id"]).select("event_id", "atm_id", "shuffle_key")


# --- features, models, forecast ---------------------------------------------

_FITTED: dict = {}


def _fault_model(m: Model):
    """Fit once per session and input folder (the queries below share it)."""
    k = ("gbt", m.spark.sparkContext.applicationId, m.tables.sf_dir)
    if k not in _FITTED:
        split = ml.stratified_split(ml.next_event_label(m.daily_faults), ["atm_id", "event_date"], cells_first=True)
        _FITTED[k] = (ml.fit_fault_model(split.filter("split = 'train'")), split)
    return _FITTED[k]


def _kmeans(m: Model):
    k = ("kmeans", m.spark.sparkContext.applicationId, m.tables.sf_dir)
    if k not in _FITTED:
        z = ml.zscore(m.device_profile)
        _FITTED[k] = (clusters.fit_kmeans(z), z)
    return _FITTED[k]


@query("next_day_label")
def next_day_label(m: Model) -> DataFrame:
    """Features and the next event row's fault count as label."""
    return ml.next_event_label(m.daily_faults)


@query("label_positives")
def label_positives(m: Model) -> DataFrame:
    """Rows and positive labels."""
    return ml.next_event_label(m.daily_faults).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").cast("long").alias("positives"))


@query("stratified_split")
def stratified_split(m: Model) -> DataFrame:
    """M5: seeded 80/20 split, exact within each label."""
    lab = ml.next_event_label(m.daily_faults)
    return ml.stratified_split(lab, ["atm_id", "event_date"]).select("atm_id", "event_date", "label", "split")


@query("fault_model_scores")
def fault_model_scores(m: Model) -> DataFrame:
    """M4 M6 M7: boosted trees, scored on the held-out rows."""
    model, split = _fault_model(m)
    test = split.filter("split = 'test'")
    return ml.score(model, test).select("atm_id", "event_date", "label", "fault_probability",
                                        "predicted")


@query("fault_importance")
def fault_importance(m: Model) -> DataFrame:
    """M8: feature importances of the fault model."""
    model, _ = _fault_model(m)
    return ml.feature_importance(m.spark, model)


@query("dispatch_candidates")
def dispatch_candidates(m: Model) -> DataFrame:
    """Held-out device-days scored above the dispatch threshold."""
    model, split = _fault_model(m)
    scored = ml.score(model, split.filter("split = 'test'"))
    return alerts.dispatch_candidates(scored).select("atm_id", "event_date", "fault_probability")


@query("model_metrics")
def model_metrics(m: Model) -> DataFrame:
    """Metric rows of the fault model and the clustering."""
    model, split = _fault_model(m)
    fm = ml.classification_metrics(ml.score(model, split.filter("split = 'test'")))
    rows = [("fault_gbt", "roc_auc", fm["roc_auc"]), ("fault_gbt", "f1", fm["f1"])]
    return m.spark.createDataFrame(rows, "model string, metric string, value double").unionByName(cluster_metrics(m))


@query("first_split_gains")
def first_split_gains(m: Model) -> DataFrame:
    """M6: gain of every split open to the root of the fault model's first tree."""
    split = ml.stratified_split(ml.next_event_label(m.daily_faults), ["atm_id", "event_date"])
    return boosting.first_split_gains(split.filter("split = 'train'"), C.FAULT_FEATURES)


@query("feature_auc")
def feature_auc(m: Model) -> DataFrame:
    """M7: exact AUC of every feature against the next day's label."""
    return ml.feature_auc(ml.next_event_label(m.daily_faults))


@query("cluster_metrics")
def cluster_metrics(m: Model) -> DataFrame:
    """Silhouette, inertia and rows of the clustering."""
    km, z = _kmeans(m)
    rows = [("kmeans", "silhouette", clusters.silhouette(clusters.assign(z, km))), ("kmeans", "inertia", km.cost)]
    n = z.select(F.count(F.lit(1)).cast("double")).scalar()
    base = m.spark.createDataFrame(rows, "model string, metric string, value double")
    return base.unionByName(m.spark.range(1).select(
        F.lit("kmeans").alias("model"), F.lit("n_samples").alias("metric"), n.alias("value")))


@query("cluster_zscores")
def cluster_zscores(m: Model) -> DataFrame:
    """M9: standardised clustering features (NULL -> 0, population sd)."""
    return ml.zscore(m.device_profile)


@query("cluster_assignments")
def cluster_assignments(m: Model) -> DataFrame:
    """K-means (best of 10 seeds) cluster per device."""
    km, z = _kmeans(m)
    return clusters.assign(z, km).select("atm_id", "cluster")


@query("fault_model_checks")
def fault_model_checks(m: Model) -> DataFrame:
    """M5 M6 M7: held-out rows and positives, and violations that must be 0."""
    model, split = _fault_model(m)
    return ml.score_checks(ml.score(model, split.filter("split = 'test'")), ["atm_id", "event_date"])


@query("cluster_checks")
def cluster_checks(m: Model) -> DataFrame:
    """Devices, clusters, and devices nearer to another centre (must be 0)."""
    km, z = _kmeans(m)
    return ml.cluster_checks(clusters.assign(z, km), km.centres)


@query("cluster_profile")
def cluster_profile(m: Model) -> DataFrame:
    """Cluster sizes and mean transaction volume."""
    km, z = _kmeans(m)
    a = clusters.assign(z, km).select("atm_id", "cluster")
    return (m.device_profile.join(a, "atm_id")
              .groupBy("cluster").agg(F.count(F.lit(1)).alias("n"),
                                      F.avg("total_tx").alias("avg_tx")))


@query("utilisation_scores")
def utilisation_scores(m: Model) -> DataFrame:
    """Share of the region's devices with at most this volume (own definition)."""
    return ml.utilisation(m.device_profile)


@query("forecast_mae")
def forecast_mae(m: Model) -> DataFrame:
    """Hold-out error of the per-device trend and season model."""
    return round_doubles(forecast.forecast_holdout_error(m.daily_cash), 2)


@query("cash_forecast")
def cash_forecast(m: Model) -> DataFrame:
    """Next 3 days per device with the 80 % band and refill flag."""
    return round_doubles(forecast.forecast_horizon(m.daily_cash), 2)


@query("forecast_summary")
def forecast_summary(m: Model) -> DataFrame:
    """Devices needing a refill within the horizon and the mean hold-out error."""
    return round_doubles(forecast.forecast_summary(m.daily_cash), 2)


@query("forecast_metrics")
def forecast_metrics(m: Model) -> DataFrame:
    """Hold-out error and training rows per device as metric rows."""
    e = round_doubles(forecast.forecast_holdout_error(m.daily_cash), 2).select(
        F.lit("cash_forecast").alias("model"), F.col("atm_id").cast("string").alias("entity"),
        F.col("mae"), F.col("train_rows").cast("double").alias("train_rows"))
    return e.unpivot(["model", "entity"], ["mae", "train_rows"], "name", "value")


# --- managed tables ---

def _database(m: Model, name: str) -> str:
    """A database of this run's own, in the shared folder."""
    base = _run_dir(m, name)
    database = f"{name}_{base.rsplit('-', 1)[1]}"
    m.spark.sql(f"CREATE DATABASE {database} LOCATION '{base}'")
    return database


@query("laid_out_devices")
def laid_out_devices(m: Model) -> DataFrame:
    """Daily cash rows and the device dimension as managed tables bucketed
    by device, the daily rows sorted by date; rolling columns joined with the
    dimension, with no exchange after the tables are written."""
    db = _database(m, "laidout")
    daily = writers.save_laid_out(marts.daily_level_base(m.stg_cash), f"{db}.daily_cash", "atm_id", ["event_date"])
    dim = writers.save_laid_out(m.stg_level_dim, f"{db}.dim", "atm_id", [])
    return (marts.daily_level_windows(daily).join(dim, "atm_id")
            .select("atm_id", "region", "event_date", "min_cash_mwk", "cash_ma_7d", "withdrawal_ma_7d", "prev_min_cash", "cash_status"))


@query("managed_tables")
def managed_tables(m: Model) -> DataFrame:
    """Staging tables built in full, counted, one of them truncated and counted again."""
    db = _database(m, "managed")
    counts = []
    for name, rows in (("stg_transactions", m.stg_transactions), ("stg_cash", m.stg_cash), ("stg_faults", m.stg_faults)):
        table = writers.save_table(rows, f"{db}.{name}")
        counts.append(table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n"))
    built = cut_lineage(functools.reduce(DataFrame.unionByName, counts))  # counted before the truncation
    writers.truncate_table(m.spark, f"{db}.stg_cash")
    left = m.spark.table(f"{db}.stg_cash").agg(F.count(F.lit(1)).alias("n")).select(F.lit("stg_cash, truncated").alias("name"), "n")
    here = writers.table_inventory(m.spark, views=False).filter(F.col("database") == db)
    return built.unionByName(left).unionByName(here.select(F.lit("tables").alias("name"), F.col("tables").alias("n")))


# --- streaming and file round trips -------------------------------------------

def _run_dir(m: Model, name: str) -> str:
    return shared_path(m.spark, "runs", f"{name}-{uuid.uuid4().hex[:12]}")


def _land_messages(m: Model, base: str) -> str:
    """Land the transactions topic as message files (what a broker would hold)."""
    landing = f"{base}/landing"
    m.tx_messages.write.mode("overwrite").json(landing)
    return landing


@query("bronze_stream")
def bronze_stream(m: Model) -> DataFrame:
    """Message stream -> tolerant decode -> bronze
    Parquet with a checkpoint, drained with an available-now trigger."""
    base = _run_dir(m, "bronze")
    src = ingest.file_stream(m.spark, _land_messages(m, base))
    q = ingest.ingest(m.spark, TX_MESSAGE_SCHEMA, src, f"{base}/bronze", f"{base}/_checkpoint")
    q.awaitTermination()
    return (m.spark.read.parquet(f"{base}/bronze")
              .select("offset", "event_id", "atm_id", "amount_mwk", "success", "malformed"))


#: Offsets in a segment of the landed topic, and in a micro-batch at most.
SEGMENT, BATCH = 1_000, 50_000


def _topic_to_bronze(m: Model, base: str, starting: str = "earliest") -> DataFrame:
    """Read the landed topic on from where the stream's checkpoint stands."""
    src = topic.topic_stream(m.spark, f"{base}/topic", f"{base}/progress", starting, BATCH, segment_offsets=SEGMENT)
    topic.drain(ingest.start_parquet_sink(ingest.to_bronze(src, TX_MESSAGE_SCHEMA), f"{base}/bronze", f"{base}/_checkpoint",
                                          available_now=False, partition_by=()))
    rows = ingest.to_bronze(m.tx_messages, TX_MESSAGE_SCHEMA)
    return (m.spark.read.schema(rows.schema).parquet(f"{base}/bronze")
              .select("offset", "event_id", "atm_id", "amount_mwk", "success", "malformed"))


@query("bronze_by_offsets")
def bronze_by_offsets(m: Model) -> DataFrame:
    """Offset-addressed topic -> bronze, so many offsets a micro-batch at most."""
    base = _run_dir(m, "offsets")
    topic.land(m.tx_messages, f"{base}/topic", SEGMENT)
    return _topic_to_bronze(m, base)


@query("bronze_from_latest")
def bronze_from_latest(m: Model) -> DataFrame:
    """A stream that starts at the topic's end, with half the topic landed
    before its start, takes what is landed after it."""
    base = _run_dir(m, "latest")
    half = m.tx_messages.select(F.floor(F.floor(F.max("offset") / 2) / SEGMENT) * SEGMENT).scalar()
    topic.land(m.tx_messages.filter(F.col("offset") < half), f"{base}/topic", SEGMENT)
    _topic_to_bronze(m, base, "latest")
    topic.land(m.tx_messages.filter(F.col("offset") >= half), f"{base}/topic", SEGMENT)
    return _topic_to_bronze(m, base, "latest")


@query("bronze_lost_segment")
def bronze_lost_segment(m: Model) -> DataFrame:
    """S3: the topic has lost the second segment of partition 0; the stream passes over it."""
    base = _run_dir(m, "lost")
    lost = (F.col("partition") == 0) & F.col("offset").between(SEGMENT, 2 * SEGMENT - 1)
    topic.land(m.tx_messages.filter(~lost), f"{base}/topic", SEGMENT)
    return _topic_to_bronze(m, base)


@query("live_sink")
def live_sink(m: Model) -> DataFrame:
    """Insert batches of 20 rows or 2 seconds per source partition
    (list state, processing-time timers), arrival time and defaults, appended
    by the file sink.  Runs until no row is held any more."""
    base = _run_dir(m, "live")
    src = ingest.file_stream(m.spark, _land_messages(m, base))
    rows = live.live_rows(ingest.to_bronze(src, TX_MESSAGE_SCHEMA))
    live.drained(live.start_live_sink(rows, f"{base}/live", f"{base}/_checkpoint", lanes=8))
    return (m.spark.read.schema(rows.schema).parquet(f"{base}/live")
              .select("atm_id", "tx_type", "amount_mwk", "card_type", "success"))


@query("live_per_minute")
def live_per_minute(m: Model) -> DataFrame:
    """Per-minute transaction counts on the stream.

    The topic arrives in five files that each cover the whole time range, one
    per micro-batch.  The watermark's delay is that disorder, the topic's own time
    span; the newest count of each minute holds, and a row lost behind the
    watermark would be an error.  Equals the batch counts of decodable
    transactions.
    """
    base = _run_dir(m, "perminute")
    landing = f"{base}/landing"
    m.tx_messages.repartition(5, "offset").write.json(landing)
    span = m.tx_messages.agg(F.coalesce(F.timestamp_diff("SECOND", F.min("kafka_ts"), F.max("kafka_ts")), F.lit(0))).first()[0]
    b = ingest.to_bronze(ingest.file_stream(m.spark, landing, max_files_per_trigger=1), TX_MESSAGE_SCHEMA)
    counts = live.per_minute_counts(b, ts="kafka_ts", delay=f"{span + 60} seconds", where=F.col("atm_id").isNotNull())
    with live.LateRows(m.spark) as late:
        late.finished(live.start_minute_counts(counts, f"{base}/out", f"{base}/_checkpoint"))
    return live.minute_counts(m.spark, f"{base}/out", counts.schema)


@query("tx_per_minute")
def tx_per_minute(m: Model) -> DataFrame:
    """D5 batch twin: transactions per minute."""
    return live.per_minute_counts(m.transactions)


@query("latest_15")
def latest_15(m: Model) -> DataFrame:
    """The 15 most recent transactions."""
    return live.latest_n(m.transactions, 15, "event_ts", "event_id").select(
        "event_id", "atm_id", "event_ts", "tx_type", "amount_mwk", "success")


@query("csv_round_trip")
def csv_round_trip(m: Model) -> DataFrame:
    """Write a table as CSV with a header, read it back with its schema."""
    path = _run_dir(m, "csv")
    rows = m.tables.customer
    writers.write_csv(rows, path)
    return files.read_csv(m.spark, path, rows.schema)


@query("weather_document")
def weather_document(m: Model) -> DataFrame:
    """Daily figures landed as one column-oriented document (bounded by the days), read back by row."""
    path = _run_dir(m, "weather")
    day = F.to_date("l_shipdate")
    days = m.tables.lineitem.groupBy(day.alias("d")).agg(
        F.max("l_quantity").alias("hi"), F.min("l_quantity").alias("lo"), F.max("l_discount").alias("rain"), F.max("l_tax").alias("wind"))
    one = days.agg(F.array_sort(F.collect_list(F.struct("d", "hi", "lo", "rain", "wind"))).alias("x"))
    one.select(F.struct(
        F.transform("x", lambda r: F.date_format(r["d"], "yyyy-MM-dd")).alias("time"),
        F.col("x.hi").alias("temperature_2m_max"), F.col("x.lo").alias("temperature_2m_min"),
        F.col("x.rain").alias("precipitation_sum"), F.col("x.wind").alias("windspeed_10m_max")).alias("daily")).coalesce(1).write.json(path)
    return files.read_weather(m.spark, path)


@query("holiday_document")
def holiday_document(m: Model) -> DataFrame:
    """Order days landed as one array of objects, read back by row."""
    path = _run_dir(m, "holidays")
    days = m.tables.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.min("o_orderpriority").alias("name"), F.max("o_orderpriority").alias("localName"))
    days.agg(F.to_json(F.collect_list(F.struct("date", "name", "localName", F.lit("MW").alias("countryCode")))).alias("value")
             ).coalesce(1).write.text(path)
    return files.read_holidays(m.spark, path)


@query("feed_document")
def feed_document(m: Model) -> DataFrame:
    """The feed's header and first page as one nested document, its alerts read back."""
    path = _run_dir(m, "feed")
    alerts_ = m.all_alerts.filter(F.col("priority").isin("P1", "P2"))
    writers.write_feed_document(alerts_, path, ["priority", "type", "atm_id", "event_date"])
    return files.read_feed_document(m.spark, path)


@query("dates_from_text")
def dates_from_text(m: Model) -> DataFrame:
    """Orders written as CSV, read as text or as nothing where absent, their date columns parsed."""
    path = _run_dir(m, "orders")
    writers.write_csv(m.tables.orders.select("o_orderkey", "o_orderdate"), path)
    schema = "o_orderkey long, o_orderdate string"
    landed = files.read_csv(m.spark, path, schema)
    absent = files.read_or_empty(m.spark, f"{path}-absent", landed.schema, "csv")
    return files.parse_date_columns(landed.unionByName(absent))


@query("rewritten_table")
def rewritten_table(m: Model) -> DataFrame:
    """A table written twice with its row count observed during the write, read back as a view."""
    path = _run_dir(m, "rewritten")
    written = [writers.write_counted(m.tables.part, path) for _ in range(2)]
    view = writers.save_table(m.spark.read.parquet(path), "dg_rewritten", materialized="view")
    return view.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.lit(written[-1]).cast("long").alias("written"))


@query("filtered_devices")
def filtered_devices(m: Model) -> DataFrame:
    """equality filters where "All" means none."""
    return profile.optional_filter(m.device_dim, region="ASIA", atm_type="All").select("atm_id", "region", "atm_type")


# --- the marts as SQL text (same oracles as the DataFrame forms) -----------------

@query("daily_cash_mart_sql")
def daily_cash_mart_sql(m: Model) -> DataFrame:
    """The daily level mart as Spark SQL over temp views."""
    return sql_marts.daily_cash_mart_sql(m)


@query("daily_fault_mart_sql")
def daily_fault_mart_sql(m: Model) -> DataFrame:
    """The daily fault mart as Spark SQL with FILTER (WHERE ...)."""
    return sql_marts.daily_fault_mart_sql(m)


@query("device_profile_mart_sql")
def device_profile_mart_sql(m: Model) -> DataFrame:
    """The device profile as Spark SQL."""
    return sql_marts.device_profile_mart_sql(m)


#: Rows of a landed file, about.
FILE_ROWS = 500_000


def _stream_by_time(rows: DataFrame, path: str, parts: int, per_batch: int) -> DataFrame:
    """Land ``rows`` in ``parts`` ranges of time, each split into as many files as
    its rows ask for (no task gets a whole range), and stream them, ``per_batch``
    ranges a micro-batch."""
    split = max(1, -(-rows.count() // (parts * FILE_ROWS)))
    rows.repartitionByRange(parts * split, "event_ts", "atm_id").write.mode("overwrite").parquet(path)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", per_batch * split).parquet(path)


@query("daily_cash_mart_stream")
def daily_cash_mart_stream(m: Model) -> DataFrame:
    """W1-W3 on a stream: level readings arrive in several micro-batches, each
    covering a range of dates; daily rows are streaming state, and every batch
    replays the windows of the devices it touched from their first touched day.
    The newest rows equal the batch mart (same oracle)."""
    base = _run_dir(m, "martstream")
    levels = m.cash_levels
    src = _stream_by_time(levels, f"{base}/landing", 6, 2)
    q = marts_stream.start_mart_refresh(
        src, f"{base}/daily", f"{base}/mart", f"{base}/_checkpoint",
        lambda rows: marts.daily_level_base(staging.stg_cash(rows)), marts.daily_level_windows)
    q.awaitTermination()
    return marts_stream.read_mart(m.spark, f"{base}/mart", m.daily_cash.schema)


@query("daily_fault_mart_stream")
def daily_fault_mart_stream(m: Model) -> DataFrame:
    """W4 on a stream: fault events arrive in time-ranged micro-batches; the
    30-row rolling sum is replayed for touched devices over their daily rows.
    Same oracle as the batch fault mart."""
    base = _run_dir(m, "faultstream")
    events = m.fault_events
    src = _stream_by_time(events, f"{base}/landing", 6, 2)
    q = marts_stream.start_mart_refresh(
        src, f"{base}/daily", f"{base}/mart", f"{base}/_checkpoint",
        lambda rows: marts.daily_fault_base(staging.stg_faults(rows)), marts.daily_fault_windows)
    q.awaitTermination()
    return marts_stream.read_mart(m.spark, f"{base}/mart", m.daily_faults.schema)


@query("device_profile_stream")
def device_profile_stream(m: Model) -> DataFrame:
    """G4 J1 on a stream: transaction statistics kept as streaming state
    (update mode), the newest totals taken; joined with the dimension and
    the fault statistics it equals the batch profile (same oracle)."""
    base = _run_dir(m, "profilestream")
    tx = m.transactions
    src = _stream_by_time(tx, f"{base}/landing", 5, 2)
    q = profile_stream.start_stats_stream(staging.stg_transactions(src), f"{base}/tx_stats", f"{base}/_checkpoint")
    q.awaitTermination()
    stats = profile_stream.read_stats(m.spark, f"{base}/tx_stats", marts.device_tx_stats(m.stg_transactions).schema)
    return marts.device_profile_join(m.stg_device_dim, stats, marts.device_fault_stats(m.stg_faults))
