"""Hand-made edge rows per operator (NULL handling, boundaries, parsing)."""

import datetime as dt

from pyspark.sql import functions as F

from devicegrid.functions import exprs
from devicegrid.operators import alerts, marts, silver, staging
from devicegrid.sources.schemas import BRONZE_SCHEMAS

D = dt.date
TS = dt.datetime

FAULT_COLS = ("atm_id string, event_ts timestamp, event_date date, fault_type string, "
              "component string, event_class string, duration_mins int, resolved boolean")
TX_COLS = ("atm_id string, event_ts timestamp, event_date date, tx_type string, "
           "amount_mwk long, card_type string, success boolean")
DIM_COLS = ("atm_id string, city string, region string, latitude double, longitude double, "
            "atm_type string, atm_model string, bank string, installed_date date, is_active boolean")


def _faults(spark, rows):
    return staging.stg_faults(spark.createDataFrame(rows, FAULT_COLS))


def test_null_success_counts_as_failed(spark):
    tx = spark.createDataFrame([("A", TS(2024, 1, 1, 10), D(2024, 1, 1), "withdrawal", 100, "Visa", None),
                                ("A", TS(2024, 1, 1, 11), D(2024, 1, 1), "withdrawal", 300, "Visa", True)],
                               TX_COLS)
    s = staging.stg_transactions(tx)
    assert sorted(r.success_flag for r in s.collect()) == [0, 1]
    dim = staging.stg_dim(spark.createDataFrame(
        [("A", "c", "r", 0.0, 0.0, "t", "m", "b", None, True),
         ("B", "c", "r", 0.0, 0.0, "t", "m", "b", None, True)], DIM_COLS))
    prof = {r.atm_id: r for r in marts.device_profile_mart(dim, s, _faults(spark, [])).collect()}
    assert (prof["A"].total_tx, prof["A"].failed_tx, prof["A"].failure_rate) == (2, 1, 0.5)
    assert prof["A"].avg_withdrawal_mwk == 200.0
    # device without transactions
    assert (prof["B"].total_tx, prof["B"].failed_tx, prof["B"].failure_rate,
            prof["B"].avg_withdrawal_mwk, prof["B"].lifetime_faults) == (0, 0, None, 0.0, 0)


def test_null_resolved_is_not_unresolved(spark):
    f = _faults(spark, [("A", None, D(2024, 1, 1), "x", "dispenser", "warning", None, None),
                        ("A", None, D(2024, 1, 1), "x", "dispenser", "fault", 30, False)])
    assert sorted(r.unresolved_flag for r in f.collect()) == [0, 1]


def test_cash_tiers(spark):
    df = spark.createDataFrame([(49_999,), (50_000,), (99_999,), (100_000,), (None,)], "m long")
    got = [r.s for r in df.select(exprs.cash_status("m").alias("s")).collect()]
    assert got == ["critical", "low", "low", "healthy", "healthy"]


def test_severity_tiers(spark):
    df = spark.createDataFrame([(2, 9), (1, 5), (1, 4)], "f long, w long")
    assert [r.s for r in df.select(exprs.severity("f", "w").alias("s")).collect()] == \
        ["high", "medium", "low"]


def _daily_cash(spark, mins):
    rows = [(f"A{i}", D(2024, 1, 5), m) for i, m in enumerate(mins)] + [("Z", D(2024, 1, 4), 1)]
    d = spark.createDataFrame(rows, "atm_id string, event_date date, min_cash_mwk long")
    return d.withColumn("cash_status", exprs.cash_status("min_cash_mwk"))


def _dim(spark, ids):
    return spark.createDataFrame([(i, "city", "reg", "m") for i in ids],
                                 "atm_id string, city string, region string, atm_model string")


def test_cash_alert_edges(spark):
    d = _daily_cash(spark, [49_999, 50_000, 100_000])
    a = {r.atm_id: r for r in alerts.cash_alerts(d, _dim(spark, ["A0", "A1", "A2", "Z"])).collect()}
    assert set(a) == {"A0", "A1"}  # only the latest date; 100,000 is no alert
    assert a["A0"].priority == "P1" and a["A1"].priority == "P2"
    assert a["A0"].sms == "[P1] ATM A0 (city) cash low: 49,999 MWK. Refill needed within 24h."
    assert a["A1"].email_body == ("ATM A1 in city (reg) dropped below minimum.\n"
                                  "Current: 50,000 MWK\nStatus: low")


def _daily_faults(spark, rows):
    cols = ("atm_id string, event_date date, faults long, warnings long, severity string, "
            "faults_ma_30d long, card_reader_events long, dispenser_events long, "
            "printer_events long, network_events long")
    return spark.createDataFrame(rows, cols)


def test_fault_alert_filter_and_window(spark):
    last = D(2024, 3, 31)
    rows = [("A", last, 0, 2, "low", 0, 0, 0, 0, 0),        # out: no fault, < 3 warnings
            ("B", last, 0, 3, "low", 0, 0, 1, 0, 0),        # in
            ("C", last, 1, 0, "low", 1, 2, 0, 0, 3),        # in
            ("D", last - dt.timedelta(days=30), 2, 0, "high", 2, 0, 0, 0, 0),  # in: edge
            ("E", last - dt.timedelta(days=31), 2, 0, "high", 2, 0, 0, 0, 0)]  # out
    a = {r.atm_id: r for r in alerts.fault_alerts(_daily_faults(spark, rows),
                                                  _dim(spark, "ABCDE")).collect()}
    assert set(a) == {"B", "C", "D"}
    assert a["C"].components == "card_reader:2, network:3"
    assert a["D"].components == "no component data" and a["D"].priority == "P1"
    assert a["B"].sms == ("[P3] ATM B (city) low fault risk. Components: dispenser:1. "
                          "Dispatch engineer within 48h.")


def test_alert_ids_repeatable(spark):
    d = _daily_cash(spark, [10])
    c1 = alerts.cash_alerts(d, _dim(spark, ["A0"]))
    f = alerts.fault_alerts(_daily_faults(spark, [("A0", D(2024, 1, 5), 1, 0, "low", 1, 0, 0, 0, 0)]),
                            _dim(spark, ["A0"]))
    ids1 = sorted(r.alert_id for r in alerts.union_alerts(c1, f).collect())
    ids2 = sorted(r.alert_id for r in alerts.union_alerts(c1, f).collect())
    assert ids1 == ids2 and len(set(ids1)) == 2
    msgs = alerts.alert_messages(alerts.union_alerts(c1, f)).collect()
    assert len(msgs) == 4
    assert {(m.channel, m.to) for m in msgs} == {("sms", "CIT_TEAM"), ("sms", "FIELD_ENGINEER"),
                                                 ("email", "ops@bank.example")}


def test_null_date_gets_zero_components(spark):
    f = _faults(spark, [("A", None, None, "x", "dispenser", "fault", 10, True),
                        ("A", None, D(2024, 1, 1), "x", "dispenser", "fault", 10, True)])
    rows = {r.event_date: r for r in marts.daily_fault_mart(f).collect()}
    assert rows[None].dispenser_events == 0 and rows[None].faults == 1
    assert rows[D(2024, 1, 1)].dispenser_events == 1


def test_rolling_fault_sum_counts_rows_not_days(spark):
    # 31 event days with gaps, one fault each -> 30 on the last row
    days = [D(2024, 1, 1) + dt.timedelta(days=3 * i) for i in range(31)]
    f = _faults(spark, [("A", None, d, "x", "printer", "fault", 5, True) for d in days])
    m = marts.daily_fault_mart(f, calendar_days=30).orderBy("event_date").collect()
    assert m[-1].faults_ma_30d == 30 and m[0].faults_ma_30d == 1
    assert m[-1].faults_30d == 10  # calendar variant: events on the last 30 days only
    assert m[-1].avg_duration_mins == 5.0 and m[-1].total_downtime_mins == 5


def test_daily_cash_window_and_lag(spark):
    rows = [("A", TS(2024, 1, d, h), D(2024, 1, d), 1000 * d + h, 10, h == 0, False)
            for d in range(1, 10) for h in range(2)]
    lv = spark.createDataFrame(rows, "atm_id string, event_ts timestamp, event_date date, "
                                     "cash_level_mwk long, hourly_withdrawal_mwk long, "
                                     "was_refilled boolean, below_threshold boolean")
    m = marts.daily_level_mart(lv).orderBy("event_date").collect()
    assert m[0].prev_min_cash is None and m[1].prev_min_cash == 1000
    assert m[0].refill_count == 1 and m[0].total_withdrawal_mwk == 20
    # day 9: mean of daily averages of days 3..9
    assert abs(m[8].cash_ma_7d - sum(1000 * d + 0.5 for d in range(3, 10)) / 7) < 1e-9


def test_age_years_leap_day(spark):
    df = spark.createDataFrame([(D(2024, 2, 29),)], "i date")
    a = df.select(exprs.age_years("i", D(2025, 2, 28)).alias("a"),
                  exprs.age_years("i", D(2025, 3, 1)).alias("b")).first()
    assert (a.a, a.b) == (0, 1)


def test_day_of_week_sunday_is_zero(spark):
    df = spark.createDataFrame([(TS(2023, 1, 1, 12),)], "t timestamp")
    assert df.select(exprs.day_of_week_sunday0("t").alias("d")).first().d == 0


def test_tolerant_json_decode(spark):
    schema = BRONZE_SCHEMAS["atm.faults"]
    raw = spark.createDataFrame([('{"atm_id": "A", "event_timestamp": "bad", "duration_mins": 343.0}',),
                                 ("junk",)], "value string")
    d = silver.decode_json(raw, schema).collect()
    assert d[0].duration_mins == 343 and not d[0]._malformed
    assert d[1]._malformed and d[1].atm_id is None
    s = silver.to_silver(silver.decode_json(raw, schema), "event_timestamp").collect()
    assert len(s) == 1 and s[0].event_ts is None and s[0].event_date is None
    q = silver.quarantine(silver.decode_json(raw, schema, keep=("value",))).collect()
    assert [(r.value, r.reason) for r in q] == [("junk", "malformed_json")]
    tx = silver.decode_json(spark.createDataFrame(
        [('{"atm_id": "A", "amount_mwk": "7", "success": "False"}',)], "value string"),
        BRONZE_SCHEMAS["atm.transactions"]).first()
    assert tx.amount_mwk == 7 and tx.success is False


def test_dedupe_latest_keeps_later_offset(spark):
    df = spark.createDataFrame([("A", "old", TS(2024, 1, 1), 0, 5),
                                ("A", "new", TS(2024, 1, 1), 0, 9),
                                ("B", "only", TS(2024, 1, 1), 1, 1)],
                               "atm_id string, city string, kafka_ts timestamp, partition int, offset long")
    out = {r.atm_id: r.city for r in
           silver.dedupe_latest(df, ["atm_id"], ["kafka_ts", "offset", "partition"]).collect()}
    assert out == {"A": "new", "B": "only"}


def test_lower_is_true(spark):
    df = spark.createDataFrame([("True",), ("false",), (None,), ("x",)], "v string")
    assert [r.b for r in df.select(exprs.lower_is_true("v").alias("b")).collect()] == \
        [True, False, False, False]


def test_component_list_skips_zero(spark):
    df = spark.createDataFrame([(0, 0), (2, 0)], "a long, b long")
    got = [r.c for r in df.select(exprs.component_list({"a": F.col("a"), "b": F.col("b")})
                                  .alias("c")).collect()]
    assert got == ["no component data", "a:2"]


def test_optional_filters_and_pages(spark):
    from devicegrid.operators import profile
    df = spark.createDataFrame([("N", "a", 1), ("S", "a", 2), ("S", "b", 3)],
                               "region string, atm_type string, v int")
    assert profile.optional_filter(df, region="All", atm_type=None).count() == 3
    assert profile.optional_filter(df, region="S", atm_type="All").count() == 2
    assert profile.optional_filter(df, region="S", atm_type="b").count() == 1
    assert [r.v for r in profile.first_n(df, [F.col("v").desc()], 2).collect()] == [3, 2]
    assert [r.region for r in profile.distinct_sorted(df, "region").collect()] == ["N", "S"]
    vc = profile.value_counts(df, "region").collect()
    assert [(r.region, r.n) for r in vc] == [("S", 2), ("N", 1)]


def test_silver_specs_per_entity(spark):
    raw = spark.createDataFrame(
        [('{"atm_id": "A", "event_timestamp": "2024-01-02 03:04:05", "event_class": "fault", '
          '"duration_mins": "12", "resolved": "False"}', 1),
         ('{"atm_id": null, "event_timestamp": "2024-01-02"}', 2)], "value string, offset long")
    b = silver.decode_json(raw, BRONZE_SCHEMAS["atm.faults"], keep=("offset",))
    f = silver.silver_from_bronze("faults", b).collect()
    assert len(f) == 1 and f[0].event_ts == TS(2024, 1, 2, 3, 4, 5) and f[0].event_date == D(2024, 1, 2)
    assert f[0].duration_mins == 12 and f[0].resolved is False and f[0].fault_occurred == 1
    assert "offset" not in silver.silver_from_bronze("faults", b).columns
    rr = spark.createDataFrame([('{"atm_id": "A", "refill_timestamp": "2024-01-05 10:00:00", '
                                 '"amount_loaded_mwk": 500000.0, "downtime_mins": 30}',)], "value string")
    r = silver.silver_from_bronze("replenishments",
                                  silver.decode_json(rr, BRONZE_SCHEMAS["atm.replenishments"])).first()
    assert r.refill_ts == TS(2024, 1, 5, 10) and r.amount_loaded_mwk == 500000 and r.downtime_mins == 30


def test_topic_subset_and_row_cap(spark):
    from devicegrid.operators import encode
    a = spark.createDataFrame([(f"A{i}", i) for i in range(10)], "atm_id string, v long")
    b = spark.createDataFrame([(f"B{i}", float(i)) for i in range(5)], "atm_id string, x double")
    m = encode.topic_messages({"atm.cash": a, "atm.faults": b}, limit=3)
    assert {(r.topic, r["count"]) for r in m.groupBy("topic").count().collect()} == \
        {("atm.cash", 3), ("atm.faults", 3)}
    only = encode.topic_messages({"atm.cash": a, "atm.faults": b}, topics={"atm.faults"})
    assert only.count() == 5 and only.first().value.startswith('{"atm_id":"B')


def test_loosely_typed_messages_decode_alike(spark, sf_dir):
    from devicegrid.plans.model import Model
    from devicegrid.sources.schemas import TX_MESSAGE_SCHEMA
    from drifting_messages import transaction_messages
    tx = Model(spark, sf_dir).transactions
    d = silver.decode_json(transaction_messages(tx), TX_MESSAGE_SCHEMA, keep=("value", "offset"))
    junk = (F.col("card_type") == "UnionPay") & (F.col("tx_type") == "transfer")
    kept = ["event_id", "amount_mwk", "success", "tx_type"]
    want = tx.where(~junk).select(*kept)
    got = d.where("not _malformed").select(*kept)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert silver.quarantine(d).where("reason = 'malformed_json'").count() == tx.where(junk).count()


def test_silver_tables_have_the_declared_schema(spark, sf_dir):
    from devicegrid.plans.model import Model
    from devicegrid.sources.schemas import SILVER_SCHEMAS, TOPIC_ENTITY
    m = Model(spark, sf_dir)
    for topic, entity in TOPIC_ENTITY.items():
        got = {f.name: f.dataType for f in m.silver(topic).schema if f.name != "event_id"}
        assert got == {f.name: f.dataType for f in SILVER_SCHEMAS[entity]}, entity
