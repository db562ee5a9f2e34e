"""Invariants on the real inputs and property checks of scalar rules."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from devicegrid import config as C
from devicegrid.functions import exprs
from devicegrid.operators import alerts, silver
from devicegrid.plans.model import Model


def test_component_counts_add_up(spark, sf_dir):
    m = Model(spark, sf_dir)
    d = m.daily_faults
    comp = sum((F.col(f"{c}_events") for c in C.COMPONENTS), F.lit(0))
    bad = d.filter(F.col("event_date").isNotNull() & (comp != F.col("faults") + F.col("warnings")))
    assert bad.count() == 0
    assert d.agg(F.sum("faults") + F.sum("warnings")).first()[0] == m.fault_events.count()


def test_tiers_partition_rows(spark, sf_dir):
    m = Model(spark, sf_dir)
    d = m.daily_cash
    assert d.groupBy("cash_status").count().agg(F.sum("count")).first()[0] == d.count()
    assert {r.cash_status for r in d.select("cash_status").distinct().collect()} <= \
        {"critical", "low", "healthy"}
    # every reading lands in exactly one daily row
    assert d.agg(F.sum("refill_count")).first()[0] == m.cash_levels.filter("was_refilled").count()


def test_union_and_rerun(spark, sf_dir):
    m = Model(spark, sf_dir)
    u = m.all_alerts
    assert u.count() == m.cash_alerts.count() + m.fault_alerts.count()
    again = alerts.union_alerts(Model(spark, sf_dir).cash_alerts, Model(spark, sf_dir).fault_alerts)
    assert sorted(r.alert_id for r in u.collect()) == sorted(r.alert_id for r in again.collect())
    assert u.select("alert_id").distinct().count() == u.count()


def test_rolling_sum_bounded_by_window(spark, sf_dir):
    d = Model(spark, sf_dir).daily_faults
    assert d.filter(F.col("faults_ma_30d") < F.col("faults")).count() == 0
    mx = d.agg(F.max("faults")).first()[0]
    assert d.agg(F.max("faults_ma_30d")).first()[0] <= 30 * mx


def _py_age(installed: dt.date, as_of: dt.date) -> int:
    return as_of.year - installed.year - ((as_of.month, as_of.day) < (installed.month, installed.day))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31)),
                          st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31))),
                min_size=1, max_size=30))
def test_age_years_matches_calendar_rule(spark, pairs):
    df = spark.createDataFrame(pairs, "i date, a date")
    got = [r.y for r in df.select(exprs.age_years("i", F.col("a")).alias("y")).collect()]
    assert got == [_py_age(i, a) for i, a in pairs]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.integers(-2**63, 2**63 - 1).map(str),
                          st.integers(-2**63, 2**63 - 1).map(lambda v: f"{v}.0"),
                          st.decimals(-10**6, 10**6, places=2).map(str),
                          st.integers(2**63, 2**70).map(str),
                          st.text(alphabet="ab x.", max_size=4)),
                min_size=1, max_size=30))
def test_text_to_long_keeps_whole_numbers_exactly(spark, values):
    from decimal import Decimal, InvalidOperation
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.v for r in df.select(silver.text_to_long(F.col("s")).alias("v")).collect()]

    def expect(s):
        try:
            d = Decimal(s)
        except InvalidOperation:
            return None
        return int(d) if d == d.to_integral_value() and -2**63 <= d < 2**63 else None
    assert got == [expect(v) for v in values]


def test_quarantine_reasons(spark):
    from devicegrid.sources.schemas import TX_MESSAGE_SCHEMA
    bodies = ["{}", '{"foo": 1}', "junk", None, "", '{"atm_id": "A"}', "[1", '{"amount_mwk": 343.7}']
    d = silver.decode_json(spark.createDataFrame([(b,) for b in bodies], "value string"), TX_MESSAGE_SCHEMA, keep=("value",))
    got = {r.value: r.reason for r in silver.quarantine(d).collect()}
    assert got == {"{}": "missing_key", '{"foo": 1}': "missing_key", "junk": "malformed_json", None: "empty_message",
                   "": "empty_message", "[1": "malformed_json", '{"amount_mwk": 343.7}': "missing_key"}
    assert d.where("amount_mwk is not null").count() == 0
