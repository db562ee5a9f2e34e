"""Domain constants and default parameters.

Every operator takes these as keyword arguments; the values below are only
the defaults for the cash-machine preset.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# These must equal the source pipeline's values for the results
# to agree (thresholds, category lists, message texts).
# ---------------------------------------------------------------------------

# Cash tiers of the daily mart: below 50,000 critical, below 100,000 low.
CASH_CRITICAL_BELOW = 50_000
CASH_LOW_BELOW = 100_000

# Severity of a fault day: at least 2 faults is high, at least 5 warnings medium.
SEVERITY_HIGH_FAULTS = 2
SEVERITY_MEDIUM_WARNINGS = 5

# Cash loaded by a refill (the starting level of a device).
REFILL_AMOUNT = 500_000

# Moving-window lengths in rows.
CASH_MA_ROWS = 7
FAULT_ROLLING_ROWS = 30

# Alerts: cash alert below 100,000 (P1 below half of it); fault alerts look back
# 30 days from the latest date and need a fault or at least 3 warnings.
ALERT_MIN_CASH = 100_000
ALERT_LOOKBACK_DAYS = 30
ALERT_MIN_WARNINGS = 3

# Live table: rows of an insert batch, longest wait of a batch's first row.
LIVE_BATCH_ROWS = 20
LIVE_BATCH_SECONDS = 2.0

# Forecast: refill needed when the lower band falls below 50,000; series need
# at least 30 rows; the last 7 rows are held out; the horizon is 3 days.
FORECAST_MIN_CASH = 50_000
FORECAST_MIN_ROWS = 30
FORECAST_HOLDOUT_ROWS = 7
FORECAST_HORIZON_DAYS = 3
FORECAST_BAND_Z = 1.2816  # two-sided 80 % interval of a normal distribution

# Fault model and clustering hyper-parameters.
GBT_MAX_ITER = 300
GBT_MAX_DEPTH = 5
GBT_STEP_SIZE = 0.05
SPLIT_TEST_FRACTION = 0.2
SEED = 42
KMEANS_K = 3
KMEANS_RESTARTS = 10
SCORE_DISPATCH_THRESHOLD = 0.7

# Card types, fault types and their components, in order.
CARD_TYPES = ["Visa", "Mastercard", "UnionPay", "Local"]
FAULT_TYPES = [
    "card_reader_error",
    "cash_dispenser_jam",
    "receipt_printer_failure",
    "connectivity_loss",
    "screen_fault",
    "power_fluctuation",
    "sensor_error",
]
COMPONENTS = [
    "card_reader",
    "dispenser",
    "printer",
    "network",
    "display",
    "power_unit",
    "sensors",
]
# Only these four components are listed in fault alert texts.
ALERT_COMPONENTS = ["card_reader", "dispenser", "printer", "network"]
NO_COMPONENT_TEXT = "no component data"

# Alert channels and texts.
ALERT_TYPE_CASH = "cash_refill"
ALERT_TYPE_FAULT = "fault_prediction"
RECIPIENT_CASH = "CIT_TEAM"
RECIPIENT_FAULT = "FIELD_ENGINEER"
SENDER = "ATM_OPS"
EMAIL_TO = "ops@bank.example"
CURRENCY = "MWK"

# Alert message templates; {name} is filled from the alert row's column.
CASH_SMS = "[{priority}] ATM {atm_id} ({city}) cash low: {amount} MWK. Refill needed within 24h."
CASH_EMAIL_SUBJECT = "[{priority}] Cash refill required: {atm_id}"
CASH_EMAIL_BODY = ("ATM {atm_id} in {city} ({region}) dropped below minimum.\n"
                   "Current: {amount} MWK\n"
                   "Status: {cash_status}")
FAULT_SMS = ("[{priority}] ATM {atm_id} ({city}) {severity} fault risk. "
             "Components: {components}. Dispatch engineer within 48h.")
FAULT_EMAIL_SUBJECT = "[{priority}] Fault risk: {atm_id}"
FAULT_EMAIL_BODY = ("ATM {atm_id} in {city} ({region})\n"
                    "Model: {atm_model}\n"
                    "Severity: {severity}\n"
                    "Faults: {faults} Warnings: {warnings}\n"
                    "Components: {components}")

# Features of the next-event fault model, in order.
FAULT_FEATURES = [
    "warnings",
    "unresolved",
    "total_downtime_mins",
    "card_reader_events",
    "dispenser_events",
    "printer_events",
    "network_events",
    "display_events",
    "power_unit_events",
    "sensors_events",
    "faults_ma_30d",
]
# Features of the entity clustering, in order.
CLUSTER_FEATURES = [
    "total_tx",
    "failed_tx",
    "failure_rate",
    "avg_withdrawal_mwk",
    "lifetime_faults",
]

# ---------------------------------------------------------------------------
# Run parameters of this build (not from the source pipeline).
# ---------------------------------------------------------------------------

# "Today" for age computations; a literal keeps results repeatable.
DEFAULT_AS_OF = _dt.date(2024, 2, 1)
# Creation time stamped on alerts of a run.
DEFAULT_RUN_TS = "2024-02-01T00:00:00"
