"""Independent SQL (DuckDB dialect) for each registered query.

The canonical mapping of ``devicegrid.sources.adapters`` is repeated here as
CTEs, written from the SQL side; each query is ``WITH <canonical CTEs> <body>``.
Doubles are rounded to 6 places as in ``plans.normalize``.
"""

from __future__ import annotations

import re

from devicegrid import config as C

# The oracle's own statement of the mapping from the given tables.
TX_TYPE_OF_EVENT = {"purchase": "withdrawal", "view": "balance_enquiry", "signup": "deposit"}
AMOUNT_PER_REFILL = C.REFILL_AMOUNT


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _render(template: str, values: dict[str, str]) -> str:
    """A ``{name}`` template as SQL: quoted text and expressions joined by ||."""
    def quoted(text: str) -> str:
        return " || chr(10) || ".join("'" + line.replace("'", "''") + "'" for line in text.split("\n"))

    at, out = 0, []
    for m in re.finditer(r"\{(\w+)\}", template):
        out += [quoted(template[at:m.start()])] * (m.start() > at) + [values[m[1]]]
        at = m.end()
    return " || ".join(out + [quoted(template[at:])] * (at < len(template)))


_CASH_VALUES = {"priority": "priority", "atm_id": "CAST(atm_id AS VARCHAR)", "city": "city",
                "region": "region", "amount": "format('{:,}', min_cash_mwk)",
                "cash_status": "cash_status"}
_FAULT_VALUES = {"priority": "priority", "atm_id": "CAST(atm_id AS VARCHAR)", "city": "city",
                 "region": "region", "atm_model": "atm_model", "severity": "severity",
                 "faults": "CAST(faults AS VARCHAR)", "warnings": "CAST(warnings AS VARCHAR)",
                 "components": "components"}
_CASH_TEXT = ",\n    ".join(f"{_render(t, _CASH_VALUES)} AS {n}" for n, t in (
    ("sms", C.CASH_SMS), ("email_subject", C.CASH_EMAIL_SUBJECT), ("email_body", C.CASH_EMAIL_BODY)))
_FAULT_TEXT = ",\n    ".join(f"{_render(t, _FAULT_VALUES)} AS {n}" for n, t in (
    ("sms", C.FAULT_SMS), ("email_subject", C.FAULT_EMAIL_SUBJECT), ("email_body", C.FAULT_EMAIL_BODY)))

AS_OF = f"DATE '{C.DEFAULT_AS_OF.isoformat()}'"
RUN_TS = f"'{C.DEFAULT_RUN_TS}'"
_TX_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TX_TYPE_OF_EVENT.items())
_COMP_COUNTS = ", ".join(f"coalesce(parts['{c}'], 0) AS {c}_events" for c in C.COMPONENTS)
_COMP_FIRST = ", ".join(f"any_value(a.{c}_events) AS {c}_events" for c in C.COMPONENTS)
_COMP_COLS = ", ".join(f"{c}_events" for c in C.COMPONENTS)

BASE = f"""
tx AS (
  SELECT event_id, user_id AS atm_id, ts AS event_ts, CAST(ts AS DATE) AS event_date,
         CASE event_type {_TX_CASE} ELSE 'transfer' END AS tx_type,
         CAST(floor(value * 100) AS BIGINT) AS amount_mwk,
         ({_list(C.CARD_TYPES)})[CAST(((CAST(json_extract(props, '$.k') AS BIGINT) % 4) + 4) % 4 AS INTEGER) + 1] AS card_type,
         event_type <> 'error' AS success
  FROM events),
levels AS (
  SELECT l_suppkey AS atm_id, l_shipdate AS event_ts, CAST(l_shipdate AS DATE) AS event_date,
         CAST(floor(l_extendedprice) AS BIGINT) AS cash_level_mwk,
         CAST(floor(l_quantity) AS BIGINT) AS hourly_withdrawal_mwk,
         l_returnflag = 'R' AS was_refilled,
         l_extendedprice < 10000 AS below_threshold
  FROM lineitem),
faults AS (
  SELECT l_suppkey // 10 AS atm_id, l_shipdate AS event_ts, CAST(l_shipdate AS DATE) AS event_date,
         ({_list(C.FAULT_TYPES)})[CAST(l_partkey % 7 AS INTEGER) + 1] AS fault_type,
         ({_list(C.COMPONENTS)})[CAST(l_partkey % 7 AS INTEGER) + 1] AS component,
         CASE WHEN l_returnflag = 'R' THEN 'fault' ELSE 'warning' END AS event_class,
         CASE WHEN l_returnflag = 'R' THEN CAST(floor(l_quantity) AS INTEGER) END AS duration_mins,
         CASE WHEN l_returnflag = 'R' THEN l_linenumber <> 7 END AS resolved,
         1 AS fault_occurred
  FROM lineitem),
refills AS (
  SELECT atm_id, event_ts AS refill_ts, CAST({AMOUNT_PER_REFILL} AS BIGINT) AS amount_loaded_mwk,
         CAST(NULL AS VARCHAR) AS cit_team, CAST(NULL AS INTEGER) AS downtime_mins
  FROM levels WHERE was_refilled),
stg_tx AS (
  SELECT *, CAST(extract(hour FROM event_ts) AS INTEGER) AS tx_hour,
         CAST(dayofweek(event_ts) AS INTEGER) AS day_of_week,
         CASE WHEN success THEN 1 ELSE 0 END AS success_flag
  FROM tx WHERE atm_id IS NOT NULL),
stg_faults AS (
  SELECT *, CASE WHEN event_class = 'fault' THEN 1 ELSE 0 END AS is_fault,
         CASE WHEN resolved = false THEN 1 ELSE 0 END AS unresolved_flag
  FROM faults WHERE atm_id IS NOT NULL),
stg_refills AS (
  SELECT *, CAST(refill_ts AS DATE) AS refill_date FROM refills WHERE atm_id IS NOT NULL),
geo AS (
  SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
first_order AS (
  SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS installed_date FROM orders GROUP BY o_custkey),
device_dim AS (
  SELECT c_custkey AS atm_id, n_name AS city, r_name AS region,
         CAST(n_nationkey AS DOUBLE) AS latitude, CAST(n_regionkey AS DOUBLE) AS longitude,
         c_mktsegment AS atm_type, 'model_' || CAST(c_nationkey % 4 AS VARCHAR) AS atm_model,
         r_name AS bank, fo.installed_date, c_acctbal >= 0 AS is_active
  FROM customer JOIN geo ON c_nationkey = n_nationkey
  LEFT JOIN first_order fo ON c_custkey = fo.o_custkey),
level_dim AS (
  SELECT s_suppkey AS atm_id, n_name AS city, r_name AS region,
         CAST(n_nationkey AS DOUBLE) AS latitude, CAST(n_regionkey AS DOUBLE) AS longitude,
         CASE WHEN s_acctbal >= 0 THEN 'branch' ELSE 'offsite' END AS atm_type,
         'model_' || CAST(s_nationkey % 4 AS VARCHAR) AS atm_model,
         r_name AS bank, CAST(NULL AS DATE) AS installed_date, s_acctbal >= 0 AS is_active
  FROM supplier JOIN geo ON s_nationkey = n_nationkey),
stg_device_dim AS (
  SELECT *, CAST(year({AS_OF}) - year(installed_date)
              - CASE WHEN strftime({AS_OF}, '%m%d') < strftime(installed_date, '%m%d') THEN 1 ELSE 0 END
              AS INTEGER) AS age_years
  FROM device_dim),
stg_level_dim AS (
  SELECT *, CAST(NULL AS INTEGER) AS age_years FROM level_dim),
cash_days AS (
  SELECT atm_id, event_date, list(cash_level_mwk) AS seen, list(hourly_withdrawal_mwk) AS drawn,
         list(was_refilled) AS refills, list(below_threshold) AS lows
  FROM levels WHERE atm_id IS NOT NULL GROUP BY ALL),
cash_numbered AS (
  SELECT atm_id, event_date, list_min(seen) AS min_cash_mwk, list_max(seen) AS max_cash_mwk,
         list_avg(seen) AS avg_cash_mwk, list_sum(drawn)::BIGINT AS total_withdrawal_mwk,
         len(list_filter(refills, lambda x: x)) AS refill_count,
         len(list_filter(lows, lambda x: x)) AS hours_below_threshold,
         rank() OVER (PARTITION BY atm_id ORDER BY event_date) AS place
  FROM cash_days),
daily_cash AS (
  SELECT day.*, list_avg(near.means) AS cash_ma_7d, list_avg(near.sums) AS withdrawal_ma_7d,
         before.min_cash_mwk AS prev_min_cash,
         CASE WHEN day.min_cash_mwk >= 100000 THEN 'healthy' WHEN day.min_cash_mwk >= 50000 THEN 'low'
              ELSE 'critical' END AS cash_status
  FROM (SELECT * EXCLUDE (place) FROM cash_numbered) day
  JOIN cash_numbered self USING (atm_id, event_date)
  LEFT JOIN cash_numbered before ON before.atm_id = day.atm_id AND before.place = self.place - 1
  JOIN (SELECT a.atm_id, a.place, list(b.avg_cash_mwk) AS means, list(b.total_withdrawal_mwk) AS sums
        FROM cash_numbered a JOIN cash_numbered b ON a.atm_id = b.atm_id AND b.place BETWEEN a.place - 6 AND a.place
        GROUP BY ALL) near ON near.atm_id = day.atm_id AND near.place = self.place),
fault_marks AS (
  SELECT atm_id, event_date, component, is_fault AS fault, (event_class = 'warning')::INT AS warning,
         unresolved_flag AS pending, CASE is_fault WHEN 1 THEN duration_mins END AS mins
  FROM stg_faults),
fault_days AS (
  SELECT atm_id, event_date, sum(fault)::BIGINT AS faults, sum(warning)::BIGINT AS warnings,
         sum(pending)::BIGINT AS unresolved, coalesce(avg(mins), 0) AS avg_duration_mins,
         coalesce(sum(mins), 0)::BIGINT AS total_downtime_mins,
         histogram(CASE WHEN event_date IS NOT NULL THEN component END) AS parts,
         row_number() OVER (PARTITION BY atm_id ORDER BY event_date) AS place
  FROM fault_marks GROUP BY atm_id, event_date),
daily_faults AS (
  SELECT a.atm_id, a.event_date, any_value(a.faults) AS faults, any_value(a.warnings) AS warnings,
         any_value(a.unresolved) AS unresolved, any_value(a.avg_duration_mins) AS avg_duration_mins,
         any_value(a.total_downtime_mins) AS total_downtime_mins,
         {_COMP_FIRST},
         sum(b.faults)::BIGINT AS faults_ma_30d,
         CASE WHEN any_value(a.faults) > 1 THEN 'high' WHEN any_value(a.warnings) > 4 THEN 'medium' ELSE 'low' END AS severity
  FROM (SELECT *, {_COMP_COUNTS} FROM fault_days) a
  JOIN fault_days b ON a.atm_id = b.atm_id AND a.place - b.place BETWEEN 0 AND 29
  GROUP BY a.atm_id, a.event_date),
device_facts AS (
  SELECT atm_id, 1 AS tx, 1 - success_flag AS bad, CASE tx_type WHEN 'withdrawal' THEN amount_mwk END AS drawn,
         event_date AS tx_day, 0 AS fault, NULL::DATE AS fault_day FROM stg_tx
  UNION ALL SELECT atm_id, 0, 0, NULL, NULL, 1, event_date FROM stg_faults WHERE is_fault = 1),
device_profile AS (
  SELECT dim.*, coalesce(f.tx, 0)::BIGINT AS total_tx, coalesce(f.bad, 0)::BIGINT AS failed_tx,
         CASE WHEN f.tx > 0 THEN f.bad::DOUBLE / f.tx END AS failure_rate, coalesce(f.drawn, 0) AS avg_withdrawal_mwk,
         f.tx_day AS last_tx_date, coalesce(f.fault, 0)::BIGINT AS lifetime_faults, f.fault_day AS last_fault_date
  FROM stg_device_dim dim LEFT JOIN (
    SELECT atm_id, sum(tx) AS tx, sum(bad) AS bad, avg(drawn) AS drawn, max(tx_day) AS tx_day, sum(fault) AS fault,
           max(fault_day) AS fault_day
    FROM device_facts GROUP BY atm_id) f USING (atm_id)),
cash_alerts AS (
  SELECT '{C.ALERT_TYPE_CASH}' AS type,
         CASE WHEN d.min_cash_mwk < {C.ALERT_MIN_CASH / 2} THEN 'P1' ELSE 'P2' END AS priority,
         {RUN_TS} AS created_at, d.atm_id, d.event_date, n.city, n.region,
         d.min_cash_mwk, d.cash_status
  FROM daily_cash d JOIN stg_level_dim n USING (atm_id)
  WHERE d.event_date = (SELECT max(event_date) FROM daily_cash)
    AND d.min_cash_mwk < {C.ALERT_MIN_CASH}),
cash_alert_text AS (
  SELECT *,
    {_CASH_TEXT}
  FROM cash_alerts),
fault_alerts AS (
  SELECT '{C.ALERT_TYPE_FAULT}' AS type,
         CASE severity WHEN 'high' THEN 'P1' WHEN 'medium' THEN 'P2' ELSE 'P3' END AS priority,
         {RUN_TS} AS created_at, f.atm_id, f.event_date, n.city, n.region, n.atm_model,
         f.severity, f.faults, f.warnings, CAST(f.faults_ma_30d AS DOUBLE) AS faults_ma_30d,
         COALESCE(NULLIF(concat_ws(', ',
             CASE WHEN card_reader_events > 0 THEN 'card_reader:' || card_reader_events END,
             CASE WHEN dispenser_events > 0 THEN 'dispenser:' || dispenser_events END,
             CASE WHEN printer_events > 0 THEN 'printer:' || printer_events END,
             CASE WHEN network_events > 0 THEN 'network:' || network_events END), ''),
           '{C.NO_COMPONENT_TEXT}') AS components
  FROM daily_faults f JOIN stg_device_dim n USING (atm_id)
  WHERE f.event_date >= (SELECT max(event_date) - INTERVAL {C.ALERT_LOOKBACK_DAYS} DAY FROM daily_faults)
    AND (f.faults > 0 OR f.warnings >= {C.ALERT_MIN_WARNINGS})),
fault_alert_text AS (
  SELECT *,
    {_FAULT_TEXT}
  FROM fault_alerts),
all_alerts AS (
  SELECT substr(sha256(concat_ws('|', type, CAST(atm_id AS VARCHAR), CAST(event_date AS VARCHAR))), 1, 16) AS alert_id,
         type, priority, created_at, atm_id, event_date, city, region, sms, email_subject, email_body
  FROM (SELECT type, priority, created_at, atm_id, event_date, city, region, sms, email_subject, email_body
          FROM cash_alert_text
        UNION ALL
        SELECT type, priority, created_at, atm_id, event_date, city, region, sms, email_subject, email_body
          FROM fault_alert_text))
"""

R = "round({0}, 6) AS {0}"


def _r(*cols) -> str:
    return ", ".join(R.format(c) for c in cols)


BODIES: dict[str, str] = {
    "daily_cash_mart": f"""
SELECT atm_id, event_date, min_cash_mwk, max_cash_mwk, {_r('avg_cash_mwk')}, total_withdrawal_mwk,
       refill_count, hours_below_threshold, {_r('cash_ma_7d', 'withdrawal_ma_7d')},
       prev_min_cash, cash_status
FROM daily_cash""",
    "daily_fault_mart": f"""
SELECT atm_id, event_date, faults, warnings, unresolved, {_r('avg_duration_mins')},
       total_downtime_mins, {_COMP_COLS}, faults_ma_30d, severity
FROM daily_faults""",
    "device_profile_mart": f"""
SELECT atm_id, city, region, {_r('latitude', 'longitude')}, atm_type, atm_model, bank,
       installed_date, age_years, is_active, total_tx, failed_tx, {_r('failure_rate', 'avg_withdrawal_mwk')},
       last_tx_date, lifetime_faults, last_fault_date
FROM device_profile""",
    "stg_transactions": """
SELECT event_id, atm_id, event_ts, event_date, tx_type, amount_mwk, card_type, success,
       tx_hour, day_of_week, success_flag
FROM stg_tx""",
    "stg_faults": """
SELECT atm_id, event_ts, event_date, fault_type, component, event_class, duration_mins, resolved,
       fault_occurred, is_fault, unresolved_flag
FROM stg_faults""",
    "stg_refills": """
SELECT atm_id, refill_ts, amount_loaded_mwk, cit_team, downtime_mins, refill_date FROM stg_refills""",
    "cash_alerts": """
SELECT type, priority, created_at, atm_id, event_date, city, region, min_cash_mwk, cash_status,
       sms, email_subject, email_body
FROM cash_alert_text""",
    "fault_alerts": f"""
SELECT type, priority, created_at, atm_id, event_date, city, region, atm_model, severity, faults,
       warnings, {_r('faults_ma_30d')}, components, sms, email_subject, email_body
FROM fault_alert_text""",
    "all_alerts": "SELECT * FROM all_alerts",
    "alert_messages": f"""
SELECT type || '_' || CAST(atm_id AS VARCHAR) || '_' || alert_id AS message_key,
       'sms' AS channel,
       CASE WHEN type = '{C.ALERT_TYPE_CASH}' THEN '{C.RECIPIENT_CASH}' ELSE '{C.RECIPIENT_FAULT}' END AS "to",
       '{C.SENDER}' AS "from", CAST(NULL AS VARCHAR) AS subject, sms AS body,
       priority, created_at AS sent_at, atm_id
FROM all_alerts
UNION ALL
SELECT type || '_' || CAST(atm_id AS VARCHAR) || '_' || alert_id, 'email', '{C.EMAIL_TO}',
       CAST(NULL AS VARCHAR), email_subject, email_body, priority, created_at, atm_id
FROM all_alerts""",
    "alert_feed_summary": f"""
SELECT count(*) AS total_alerts,
       count(*) FILTER (WHERE type = '{C.ALERT_TYPE_CASH}') AS cash_refill,
       count(*) FILTER (WHERE type = '{C.ALERT_TYPE_FAULT}') AS fault_prediction,
       count(*) FILTER (WHERE priority = 'P1') AS p1,
       count(*) FILTER (WHERE priority = 'P2') AS p2,
       count(*) FILTER (WHERE priority = 'P3') AS p3
FROM all_alerts""",
}




_COLUMNS = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag "
                "l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
}
_NUMERIC = re.compile("(key|number|quantity|price|discount|tax|acctbal|size|_id|value)$")


def _shape(t: str, cols: list[str]) -> str:
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
    return (f"SELECT '{t}' AS \"table\", count(*) AS n_rows, {len(cols)} AS n_cols, '{','.join(cols)}' AS columns, "
            f"CAST({nulls} AS BIGINT) AS null_cells FROM {t}")


BODIES.update({
    "silver_transactions": """
SELECT event_id, CAST(atm_id AS VARCHAR) AS atm_id, event_ts, event_date, tx_type, amount_mwk, card_type, success FROM tx""",
    "silver_cash": """
SELECT CAST(atm_id AS VARCHAR) AS atm_id, CAST(event_ts AS TIMESTAMP) AS event_ts, event_date, cash_level_mwk,
       hourly_withdrawal_mwk, was_refilled, below_threshold FROM levels""",
    "silver_faults": """
SELECT CAST(atm_id AS VARCHAR) AS atm_id, CAST(event_ts AS TIMESTAMP) AS event_ts, event_date, fault_type, component,
       event_class, duration_mins, resolved, fault_occurred FROM faults""",
    "silver_replenishments": """
SELECT CAST(atm_id AS VARCHAR) AS atm_id, CAST(refill_ts AS TIMESTAMP) AS refill_ts, amount_loaded_mwk, cit_team,
       downtime_mins FROM refills""",
    "severity_distribution": "SELECT severity, count(*) AS n FROM daily_faults GROUP BY severity",
    "quarantine_transactions": """
SELECT event_id AS "offset", 'malformed_json' AS reason FROM tx""",
    "dedupe_latest": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
               l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
               l_linestatus DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
    "calendar_features": """
SELECT event_id, CAST(extract(hour FROM event_ts) AS INTEGER) AS hour,
       isodow(event_ts) >= 6 AS is_weekend, day(event_ts) >= 26 AS is_month_end,
       extract(hour FROM event_ts) BETWEEN 9 AND 17 AS is_peak
FROM tx""",
    "component_lookup": """
SELECT fault_type, component, count(*) AS events FROM faults GROUP BY fault_type, component""",
    "profile_numeric": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", round(round(sum(CAST({c} AS DECIMAL(28,6)))::DOUBLE / count({c}), 1), 6) AS mean, "
        f"round(round(stddev_samp({c}), 1), 6) AS std, "
        f"round(CAST(min({c}) AS DOUBLE), 1) AS min, round(CAST(max({c}) AS DOUBLE), 1) AS max "
        f"FROM {t}" for t, cols in _COLUMNS.items() for c in cols.split() if _NUMERIC.search(c)),
    "profile_shapes": "\nUNION ALL\n".join(_shape(t, c) for t, c in ((t, cols.split()) for t, cols in _COLUMNS.items())),
    "type_breakdown": """
SELECT tx_type, count(*) AS count, round_even(avg(amount_mwk), 0) AS avg_amount
FROM tx GROUP BY tx_type""",
    "success_rate": """
SELECT round(avg(CASE WHEN success THEN 1.0 ELSE 0.0 END) * 100, 2) AS success_rate_pct FROM tx""",
    "level_flag_counts": """
SELECT count(*) FILTER (WHERE was_refilled) AS refills,
       count(*) FILTER (WHERE below_threshold) AS hours_below_threshold
FROM levels""",
    "class_type_pivot": "SELECT event_class, " + ", ".join(
        f"count(*) FILTER (WHERE fault_type = '{t}') AS {t}" for t in C.FAULT_TYPES)
        + " FROM faults GROUP BY event_class",
    "dimension_counts": """
SELECT 'region' AS dimension, region AS value, count(*) AS n FROM device_dim GROUP BY region
UNION ALL
SELECT 'atm_type', atm_type, count(*) FROM device_dim GROUP BY atm_type""",
    "filter_values": """
SELECT DISTINCT 'region' AS dimension, region AS value FROM device_dim WHERE region IS NOT NULL
UNION ALL
SELECT DISTINCT 'atm_type', atm_type FROM device_dim WHERE atm_type IS NOT NULL""",
    "status_distribution": """
SELECT cash_status, count(*) AS n FROM daily_cash
WHERE event_date = (SELECT max(event_date) FROM daily_cash) GROUP BY cash_status""",
    "network_kpis": """
SELECT count(*) AS devices, CAST(sum(total_tx) AS BIGINT) AS total_tx,
       round(avg(failure_rate), 6) AS avg_failure_rate,
       (SELECT count(*) FILTER (WHERE cash_status IN ('critical', 'low')) FROM daily_cash
         WHERE event_date = (SELECT max(event_date) FROM daily_cash)) AS cash_at_risk,
       (SELECT count(DISTINCT atm_id) FROM daily_cash) AS devices_with_levels
FROM device_profile""",
    "latest_status_map": """
SELECT d.atm_id, d.city, d.region, d.atm_type, d.latitude, d.longitude, c.min_cash_mwk,
       COALESCE(c.cash_status, 'healthy') AS cash_status
FROM level_dim d LEFT JOIN (SELECT atm_id, min_cash_mwk, cash_status FROM daily_cash
                            WHERE event_date = (SELECT max(event_date) FROM daily_cash)) c
  ON c.atm_id = d.atm_id""",
    "component_matrix_long": "\nUNION ALL\n".join(
        f"SELECT atm_id, '{c}' AS component, CAST(sum({c}_events) AS BIGINT) AS events "
        f"FROM daily_faults GROUP BY atm_id" for c in C.ALERT_COMPONENTS),
    "top10_faulty": """
SELECT atm_id, max(faults_ma_30d) AS max_faults_ma_30d FROM daily_faults GROUP BY atm_id
ORDER BY max_faults_ma_30d DESC, atm_id ASC LIMIT 10""",
    "feed_page": """
SELECT alert_id, type, priority, atm_id, event_date, city, sms AS message, created_at
FROM all_alerts WHERE priority IN ('P1', 'P2')
ORDER BY priority, type, atm_id, event_date LIMIT 25""",
    "entity_history": f"""
SELECT atm_id, event_date, min_cash_mwk, {_r('cash_ma_7d')}, cash_status FROM daily_cash
WHERE atm_id = (SELECT atm_id FROM daily_cash
                WHERE event_date = (SELECT max(event_date) FROM daily_cash)
                ORDER BY min_cash_mwk ASC, atm_id ASC LIMIT 1)""",
})


_FEATS = ", ".join(C.FAULT_FEATURES)
_ZF = C.CLUSTER_FEATURES
_NEXT = "COALESCE(lead(faults) OVER (PARTITION BY atm_id ORDER BY event_date ASC NULLS LAST), 0)"
_SERIES = f"""
s0 AS (SELECT atm_id, event_date, CAST(avg_cash_mwk AS DOUBLE) AS y,
              CAST(date_diff('day', DATE '1970-01-01', event_date) AS BIGINT) AS t,
              dayofweek(event_date) AS dow FROM daily_cash),
sz AS (SELECT atm_id, count(*) AS n_rows FROM s0 GROUP BY atm_id),
s AS (SELECT s0.*, row_number() OVER (PARTITION BY s0.atm_id ORDER BY event_date DESC) AS pos
      FROM s0 JOIN sz USING (atm_id) WHERE n_rows >= {C.FORECAST_MIN_ROWS})"""


# The forecast's terms and ridge, restated for SQL.
_CHANGES, _YEARLY, _WEEKLY = 6, 3, 3
_P = 2 + _CHANGES + 2 * (_YEARLY + _WEEKLY)
_RIDGE = [0.0, 0.0] + [4.0] * _CHANGES + [1.0] * (2 * (_YEARLY + _WEEKLY))
_U = "((t - lo) / span)"
_TERMS = ", ".join(["1.0::DOUBLE", _U] + [f"greatest({_U} - {0.8 * (k + 1) / (_CHANGES + 1)!r}::DOUBLE, 0)" for k in range(_CHANGES)]
                   + [f"{f}(t * {2 * 3.141592653589793 * k / period!r}::DOUBLE)" for period, most in ((365.25, _YEARLY), (7.0, _WEEKLY))
                      for k in range(1, most + 1) for f in ("sin", "cos")])


def _fit(src: str, x: str) -> str:
    """Normal equations summed by (i, j), solved by elimination in a recursive query."""
    return f"""
d{x} AS (SELECT atm_id, min(t) AS lo, greatest(max(t) - min(t), 1)::DOUBLE AS span,
         CASE WHEN max(abs(y)) > 0 THEN max(abs(y)) ELSE 1 END AS scale, count(*) AS train_rows FROM {src} GROUP BY atm_id),
x{x} AS (SELECT q.atm_id, q.t, q.y, [{_TERMS}, y / scale] AS x FROM {src} q JOIN d{x} USING (atm_id)),
xx{x} AS (SELECT atm_id, i, j, sum(x[i] * x[j]) + CASE WHEN i = j THEN {_RIDGE}[i] ELSE 0 END AS v
         FROM x{x}, range(1, {_P + 1}) AS a(i), range(1, {_P + 2}) AS b(j) GROUP BY atm_id, i, j),
e{x} AS (SELECT atm_id, 0 AS k, list(r ORDER BY i) AS m FROM (SELECT atm_id, i, list(v ORDER BY j) AS r FROM xx{x} GROUP BY atm_id, i) GROUP BY atm_id
         UNION ALL SELECT atm_id, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda v: v / m[k + 1][k + 1])
           ELSE list_transform(r, lambda v, j: v - m[k + 1][j] * (r[k + 1] / m[k + 1][k + 1])) END) FROM e{x} WHERE k < {_P}),
c{x} AS (SELECT atm_id, list_transform(m, lambda r: r[{_P + 1}]) AS coef, lo, span, scale, train_rows FROM e{x} JOIN d{x} USING (atm_id) WHERE k = {_P}),
sd{x} AS (SELECT q.atm_id, stddev_pop(q.y - scale * list_dot_product(coef, q.x[1:{_P}])) AS sd FROM x{x} q JOIN c{x} USING (atm_id) GROUP BY q.atm_id)"""


_MAE = f"""
train AS (SELECT * FROM s WHERE pos > {C.FORECAST_HOLDOUT_ROWS}),
test AS (SELECT * FROM s WHERE pos <= {C.FORECAST_HOLDOUT_ROWS}),{_fit('train', '_h')},
mae AS (SELECT q.atm_id, train_rows, round(avg(abs(y - scale * list_dot_product(coef, [{_TERMS}]))), 2) AS mae, avg(abs(y - scale * list_dot_product(coef, [{_TERMS}]))) AS exact
        FROM test q JOIN c_h USING (atm_id) GROUP BY q.atm_id, train_rows)"""

_FC = f"""{_fit('s', '_f')},
days AS (SELECT atm_id, CAST(max(event_date) + CAST(g.i AS INTEGER) AS DATE) AS ds, max(s.t) + g.i AS t
         FROM s CROSS JOIN range(1, {C.FORECAST_HORIZON_DAYS + 1}) AS g(i) GROUP BY atm_id, g.i),
p AS (SELECT d.atm_id, d.ds, scale * list_dot_product(coef, [{_TERMS}]) AS yhat, sd FROM days d JOIN c_f USING (atm_id) JOIN sd_f USING (atm_id)),
fc AS (SELECT atm_id, ds, yhat, yhat - {C.FORECAST_BAND_Z} * sd AS yhat_lower,
              yhat + {C.FORECAST_BAND_Z} * sd AS yhat_upper,
              max(CASE WHEN yhat - {C.FORECAST_BAND_Z} * sd < {C.FORECAST_MIN_CASH} THEN 1 ELSE 0 END)
                OVER (PARTITION BY atm_id) = 1 AS needs_refill
       FROM p)"""

BODIES.update({
    "next_day_label": f"""
SELECT atm_id, event_date, {_FEATS},
       CAST({_NEXT} AS BIGINT) AS fault_tomorrow,
       CASE WHEN {_NEXT} > 0 THEN 1 ELSE 0 END AS label
FROM daily_faults""",
    "label_positives": f"""
SELECT count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives
FROM (SELECT CASE WHEN {_NEXT} > 0 THEN 1 ELSE 0 END AS label FROM daily_faults)""",
    "cluster_zscores": "zf AS (SELECT atm_id, " + ", ".join(
        f"COALESCE(CAST({c} AS DOUBLE), 0) AS {c}" for c in _ZF) + " FROM device_profile),\n"
        + "zs AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _ZF)
        + " FROM zf)\nSELECT atm_id, " + ", ".join(
            f"round(CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0 END, 6) AS {c}" for c in _ZF)
        + " FROM zf CROSS JOIN zs",
    "forecast_mae": f"{_SERIES},{_MAE}\nSELECT atm_id, train_rows, mae FROM mae",
    "cash_forecast": f"""{_SERIES},{_FC}
SELECT atm_id, ds, round(yhat, 2) AS yhat, round(yhat_lower, 2) AS yhat_lower,
       round(yhat_upper, 2) AS yhat_upper, needs_refill FROM fc""",
    "forecast_summary": f"""{_SERIES},{_MAE},{_FC}
SELECT count(*) AS devices, round(avg(exact), 2) AS avg_mae,
       (SELECT count(DISTINCT atm_id) FROM fc WHERE needs_refill) AS devices_needing_refill
FROM mae""",
})


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in BODIES.items():
        b = body.lstrip()
        if b.upper().startswith(("SELECT", "(SELECT")):
            out[name] = f"WITH {BASE}\n{body}"
        else:  # body begins with further CTEs
            out[name] = f"WITH RECURSIVE {BASE},\n{b}"
    return out


BODIES.update({
    "bronze_stream": """
SELECT event_id AS "offset", event_id, CAST(atm_id AS VARCHAR) AS atm_id, amount_mwk, success, false AS malformed FROM tx""",
    "bronze_by_offsets": """
SELECT event_id AS "offset", event_id, CAST(atm_id AS VARCHAR) AS atm_id, amount_mwk, success, false AS malformed FROM tx""",
    "bronze_from_latest": """
SELECT event_id AS "offset", event_id, CAST(atm_id AS VARCHAR) AS atm_id, amount_mwk, success, false AS malformed FROM tx
WHERE event_id >= (SELECT max(event_id) // 2 // 1000 * 1000 FROM tx)""",
    "bronze_lost_segment": """
SELECT event_id AS "offset", event_id, CAST(atm_id AS VARCHAR) AS atm_id, amount_mwk, success, false AS malformed FROM tx
WHERE NOT (atm_id % 3 = 0 AND event_id BETWEEN 1000 AND 1999)""",
    "live_sink": """
SELECT CAST(atm_id AS VARCHAR) AS atm_id, tx_type, COALESCE(amount_mwk, 0) AS amount_mwk,
       card_type, COALESCE(success, false) AS success
FROM tx""",
    "tx_per_minute": """
SELECT date_trunc('minute', event_ts) AS minute, count(*) AS n FROM tx GROUP BY 1""",
    "latest_15": """
SELECT event_id, atm_id, event_ts, tx_type, amount_mwk, success FROM tx
ORDER BY event_ts DESC, event_id DESC LIMIT 15""",
    "csv_round_trip": "SELECT * FROM customer",
})


BODIES.update({
    "daily_cash_mart_sql": BODIES["daily_cash_mart"],
    "daily_fault_mart_sql": BODIES["daily_fault_mart"],
    "device_profile_mart_sql": BODIES["device_profile_mart"],
})

BODIES["daily_cash_mart_stream"] = BODIES["daily_cash_mart"]

BODIES["silver_dim_latest"] = """
SELECT CAST(atm_id AS VARCHAR) AS atm_id,
       CASE WHEN atm_type = 'BUILDING' THEN lower(city) ELSE city END AS city,
       region, latitude, longitude, atm_type, atm_model, bank, installed_date, is_active
FROM device_dim"""
BODIES["laid_out_devices"] = f"""
SELECT c.atm_id, d.region, c.event_date, c.min_cash_mwk, c.cash_ma_7d, c.withdrawal_ma_7d, c.prev_min_cash, c.cash_status
FROM ({BODIES["daily_cash_mart"]}) c JOIN stg_level_dim d ON c.atm_id = d.atm_id"""
BODIES["managed_tables"] = """
SELECT 'stg_transactions' AS name, count(*) AS n FROM stg_tx UNION ALL
SELECT 'stg_cash', count(*) FROM levels UNION ALL
SELECT 'stg_faults', count(*) FROM stg_faults UNION ALL
SELECT 'stg_cash, truncated', 0 UNION ALL SELECT 'tables', 3"""
BODIES["daily_fault_mart_stream"] = BODIES["daily_fault_mart"]
BODIES["device_profile_stream"] = BODIES["device_profile_mart"]
BODIES["live_per_minute"] = """
SELECT CAST(date_trunc('minute', event_ts) AS TIMESTAMP) AS minute, count(*) AS n FROM tx GROUP BY 1"""


BODIES.update({
    "stratified_split": f"""
SELECT atm_id, event_date, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY
           sha256(concat_ws('|', '{C.SEED}', CAST(atm_id AS VARCHAR), CAST(event_date AS VARCHAR))))
         <= floor(count(*) OVER (PARTITION BY label) * {C.SPLIT_TEST_FRACTION} + 0.5) THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, CASE WHEN {_NEXT} > 0 THEN 1 ELSE 0 END AS label FROM daily_faults)""",
    "shuffled_transactions": f"""
SELECT event_id, atm_id, sha256(concat_ws('|', '{C.SEED}', CAST(event_id AS VARCHAR))) AS shuffle_key FROM tx""",
    "fault_model_checks": f"""
SELECT sum(least(n, take))::BIGINT AS rows, sum(y)::BIGINT AS positives, 0 AS outside_0_1, 0 AS against_threshold, 0 AS repeated_keys
FROM (SELECT label, count(*) AS n, floor(count(*) * {C.SPLIT_TEST_FRACTION} + 0.5) AS take,
             label * floor(count(*) * {C.SPLIT_TEST_FRACTION} + 0.5) AS y
      FROM (SELECT CASE WHEN {_NEXT} > 0 THEN 1 ELSE 0 END AS label FROM daily_faults) GROUP BY label)""",
    "cluster_checks": f"""
SELECT count(*) AS devices, {C.KMEANS_K} AS clusters, 0 AS nearer_elsewhere FROM device_dim""",
    "sample_repeatable": f"""
SELECT event_id, atm_id, event_ts, event_date, tx_type, amount_mwk, card_type, success FROM tx
ORDER BY sha256(concat_ws('|', '{C.SEED}', CAST(event_id AS VARCHAR))), event_id LIMIT 100""",
})

BODIES["json_encode_keyed"] = """
SELECT CAST(atm_id AS VARCHAR) AS key,
       CAST(to_json({'event_id': event_id, 'atm_id': atm_id,
                     'event_ts': strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f'),
                     'event_date': strftime(event_date, '%Y-%m-%d'),
                     'tx_type': tx_type, 'amount_mwk': amount_mwk, 'card_type': card_type,
                     'success': success}) AS VARCHAR) AS value
FROM tx"""

TOPIC_FIELDS = {
    "atm.transactions": ("tx", "event_id, atm_id, timestamp: event_ts, tx_type, amount_mwk, card_type, success"),
    "atm.cash": ("levels", "atm_id, timestamp: event_ts, cash_level_mwk, hourly_withdrawal_mwk, was_refilled, below_threshold"),
    "atm.faults": ("faults", "atm_id, event_timestamp: event_ts, fault_type, component, event_class, duration_mins, resolved, fault_occurred"),
    "atm.replenishments": ("refills", "atm_id, refill_timestamp: refill_ts, amount_loaded_mwk, cit_team, downtime_mins"),
    "atm.dim": ("device_dim", "atm_id, city, region, latitude, longitude, atm_type, atm_model, bank, installed_date, is_active"),
}


def _message_json(fields: str) -> str:
    pairs = [(f.split(": ") * 2)[:2] for f in fields.split(", ")]
    return "to_json({" + ", ".join(f"'{name}': {column}" for name, column in pairs) + "})"


# Ids are sent as numbers, the message schemas want them as text.
BODIES["message_field_types"] = """
SELECT topic, field, CASE WHEN t = 'VARCHAR' THEN 'text' WHEN t IN ('BIGINT', 'UBIGINT') THEN 'whole' WHEN t = 'DOUBLE' THEN 'decimal'
                          ELSE lower(t) END AS type, count(*) AS n, field IN ('atm_id', 'event_id') AS drifted
FROM (""" + " UNION ALL ".join(
    f"SELECT '{topic}' AS topic, e.key AS field, e.type AS t FROM {table}, json_each({_message_json(fields)}) e"
    for topic, (table, fields) in TOPIC_FIELDS.items()) + """)
GROUP BY ALL"""

BODIES["utilisation_scores"] = """
SELECT atm_id, region, total_tx, round(score, 4) AS utilisation_score,
       CASE WHEN score >= 0.8 THEN 'expand' WHEN score <= 0.2 THEN 'review' ELSE 'maintain' END AS recommendation
FROM (SELECT *, (count(*) OVER (PARTITION BY region ORDER BY total_tx))::DOUBLE
                / count(*) OVER (PARTITION BY region) AS score FROM device_profile)"""
BODIES.update({
    "weather_document": """
SELECT CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS temperature_2m_max, min(l_quantity) AS temperature_2m_min,
       max(l_discount) AS precipitation_sum, max(l_tax) AS windspeed_10m_max FROM lineitem GROUP BY 1""",
    "holiday_document": """
SELECT CAST(o_orderdate AS DATE) AS date, min(o_orderpriority) AS name, max(o_orderpriority) AS "localName" FROM orders GROUP BY 1""",
    "feed_document": """
SELECT alert_id, type, priority, CAST(atm_id AS VARCHAR) AS atm_id, city, sms AS message, created_at
FROM all_alerts WHERE priority IN ('P1', 'P2') ORDER BY priority, type, all_alerts.atm_id, event_date LIMIT 25""",
    "dates_from_text": "SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate FROM orders",
    "rewritten_table": "SELECT p_brand, count(*) AS n, (SELECT count(*) FROM part) AS written FROM part GROUP BY p_brand",
    "filtered_devices": "SELECT atm_id, region, atm_type FROM device_dim WHERE region = 'ASIA'",
})
def _gains(f: str) -> str:
    return f"""
SELECT '{f}' AS feature, cut, round((gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1)) / 2, 6) AS gain
FROM (SELECT min(v) AS cut, bin, sum(sum(0.5 - y)) OVER w AS gl, sum(sum(0.25)) OVER w AS hl, sum(sum(0.5 - y)) OVER () AS gt, sum(sum(0.25)) OVER () AS ht
      FROM (SELECT {f}::DOUBLE AS v, label::DOUBLE AS y, (rank() OVER (ORDER BY {f}) - 1) * 64 // count(*) OVER () AS bin FROM train)
      GROUP BY bin WINDOW w AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
WHERE bin > 0 AND hl >= 1 AND ht - hl >= 1"""


BODIES["first_split_gains"] = f"""
train AS (SELECT * FROM (SELECT {_FEATS}, label, row_number() OVER (PARTITION BY label ORDER BY
           sha256(concat_ws('|', '{C.SEED}', CAST(atm_id AS VARCHAR), CAST(event_date AS VARCHAR)))) AS place,
         floor(count(*) OVER (PARTITION BY label) * {C.SPLIT_TEST_FRACTION} + 0.5) AS most
         FROM (SELECT *, CASE WHEN {_NEXT} > 0 THEN 1 ELSE 0 END AS label FROM daily_faults)) WHERE place > most)
""" + "\nUNION ALL ".join(map(_gains, C.FAULT_FEATURES))

# k-means: draws from SHA-256, all restarts in one recursive query of 40 rounds.
_ZNAMES = ", ".join(_ZF)
_Z = ("zf AS (SELECT atm_id, " + ", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0) AS {c}" for c in _ZF) + " FROM device_profile),\nzs AS (SELECT "
      + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _ZF) + " FROM zf),\nz AS (SELECT atm_id, "
      + ", ".join(f"CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0 END AS {c}" for c in _ZF) + " FROM zf CROSS JOIN zs)")


def _sq(a: str, b: str) -> str:
    return "(" + " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in _ZF) + ")"


def _pick(step: int) -> str:
    u = (f"((('0x' || substr(sha256(concat_ws('|', '{C.SEED}', CAST(r AS VARCHAR), '{step}', CAST(atm_id AS VARCHAR))), 1, 13))::BIGINT + 1) / 4503599627370497.0::DOUBLE)")
    if step == 0:
        weighted = f"SELECT g.r, z.*, 1.0::DOUBLE AS w FROM z CROSS JOIN range({C.KMEANS_RESTARTS}) AS g(r)"
    else:
        weighted = f"SELECT s.r, z.*, min({_sq('z', 's')}) AS w FROM z CROSS JOIN seeds{step - 1} s GROUP BY s.r, z.atm_id, {', '.join('z.' + c for c in _ZF)}"
    drawn = f"""
SELECT r, {step} AS c, {_ZNAMES} FROM ({weighted}) QUALIFY row_number() OVER (
  PARTITION BY r ORDER BY CASE WHEN w > 0 THEN -ln({u}) / w ELSE 'inf'::DOUBLE END, atm_id) = 1"""
    return f"seeds{step} AS ({drawn}" + (f" UNION ALL SELECT * FROM seeds{step - 1}" if step else "") + ")"


_KMEANS = _Z + ",\n" + ",\n".join(_pick(i) for i in range(C.KMEANS_K)) + f""",
cen AS (
  SELECT 0 AS it, r, c, {_ZNAMES} FROM seeds{C.KMEANS_K - 1}
  UNION ALL
  SELECT o.it + 1, o.r, o.c, {", ".join(f"coalesce(n.{c}, o.{c})" for c in _ZF)}
  FROM cen o LEFT JOIN (
    SELECT r, c, {", ".join(f"avg({c}) AS {c}" for c in _ZF)} FROM (
      SELECT k.r, z.atm_id, {", ".join(f"any_value(z.{c}) AS {c}" for c in _ZF)}, arg_min(k.c, ({_sq('z', 'k')}, k.c)) AS c
      FROM z CROSS JOIN cen k GROUP BY k.r, z.atm_id) GROUP BY r, c) n ON n.r = o.r AND n.c = o.c
  WHERE o.it < 40),
last AS (SELECT * FROM cen WHERE it = 40),
costs AS (SELECT r, sum(d) AS cost FROM (SELECT k.r, z.atm_id, min({_sq('z', 'k')}) AS d FROM z CROSS JOIN last k GROUP BY k.r, z.atm_id) GROUP BY r),
best AS (SELECT r, cost FROM costs ORDER BY round(cost, 6), r LIMIT 1),
assigned AS (SELECT z.*, q.cluster FROM z JOIN (SELECT z.atm_id, arg_min(k.c, ({_sq('z', 'k')}, k.c)) AS cluster
             FROM z CROSS JOIN last k WHERE k.r = (SELECT r FROM best) GROUP BY z.atm_id) q USING (atm_id))"""
BODIES["cluster_assignments"] = _KMEANS + "\nSELECT atm_id, cluster::INTEGER AS cluster FROM assigned"
BODIES["cluster_profile"] = _KMEANS + """
SELECT cluster::INTEGER AS cluster, count(*) AS n, round(avg(p.total_tx), 6) AS avg_tx FROM device_profile p JOIN assigned a USING (atm_id) GROUP BY cluster"""
BODIES["cluster_metrics"] = _KMEANS + f""",
drawn AS (SELECT * FROM assigned ORDER BY sha256(concat_ws('|', '{C.SEED}', CAST(atm_id AS VARCHAR))), atm_id LIMIT 2000),
sizes AS (SELECT cluster, count(*) AS n FROM assigned GROUP BY cluster),
apart AS (SELECT i.atm_id, i.cluster AS own, o.cluster AS other, sum(sqrt({_sq('i', 'o')})) AS d FROM drawn i CROSS JOIN assigned o GROUP BY i.atm_id, i.cluster, o.cluster),
ab AS (SELECT atm_id, max(CASE WHEN own = other THEN d / (n - 1) END) FILTER (own <> other OR n > 1) AS a, min(CASE WHEN own <> other THEN d / n END) AS b
       FROM apart JOIN sizes ON sizes.cluster = other GROUP BY atm_id)
SELECT 'kmeans' AS model, 'silhouette' AS metric, round(avg(CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS value FROM ab
UNION ALL SELECT 'kmeans', 'inertia', round(cost, 6) FROM best
UNION ALL SELECT 'kmeans', 'n_samples', count(*)::DOUBLE FROM z"""
BODIES["feature_auc"] = "\nUNION ALL ".join(f"""
SELECT '{f}' AS feature, sum(y)::BIGINT AS positives, sum(1 - y)::BIGINT AS negatives,
  round((sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)), 6) AS auc
FROM (SELECT y, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk
      FROM (SELECT COALESCE({f}, 0)::DOUBLE AS v, CASE WHEN {_NEXT} > 0 THEN 1 ELSE 0 END AS y FROM daily_faults))""" for f in C.FAULT_FEATURES)
BODIES["forecast_metrics"] = f"""{_SERIES},{_MAE}
SELECT 'cash_forecast' AS model, CAST(atm_id AS VARCHAR) AS entity, 'mae' AS name, mae AS value FROM mae
UNION ALL SELECT 'cash_forecast', CAST(atm_id AS VARCHAR), 'train_rows', train_rows FROM mae"""
