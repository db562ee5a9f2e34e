"""The gold marts as generated Spark SQL.

For users who keep their models as SQL text, and as a cross-check of the
DataFrame form.  A mart is declared as data - measures, series columns and
tiers over one view - and :func:`daily_sql` / :func:`profile_sql` turn a
declaration into text; the tests and queries run it over temp views.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from devicegrid import config as C
from devicegrid.plans.model import Model


@dataclass(frozen=True)
class Measure:
    """``fn`` of ``what`` over the rows for which ``when`` holds; null results read ``default``."""

    name: str
    fn: str
    what: str = "1"
    when: str | None = None
    default: str | None = None

    def sql(self) -> str:
        if self.fn == "count" and self.when:
            text = f"count_if({self.when})"
        else:
            text = f"{self.fn}({f'if({self.when}, {self.what}, null)' if self.when else self.what})"
        return f"{f'nvl({text}, {self.default})' if self.default else text} {self.name}"


@dataclass(frozen=True)
class Rolling:
    """``fn`` of a measure over the last ``rows`` daily rows; ``lag``: of the row before."""

    name: str
    fn: str
    what: str
    rows: int = 0

    def sql(self, key: str, date: str) -> str:
        frame = f" rows {self.rows - 1} preceding" if self.rows else ""
        return f"{self.fn}({self.what}) over (partition by {key} order by {date} nulls last{frame}) {self.name}"


@dataclass(frozen=True)
class Daily:
    """A mart with one row per key and date."""

    view: str
    measures: tuple[Measure, ...]
    rolling: tuple[Rolling, ...]
    tier: str
    tiers: tuple[tuple[str, str], ...]
    otherwise: str


def daily_sql(mart: Daily, key: str = "atm_id", date: str = "event_date") -> str:
    days = (f"select {key}, {date}, {', '.join(m.sql() for m in mart.measures)} from {mart.view} "
            f"where {key} is not null group by {key}, {date}")
    tier = " ".join(f"when {condition} then '{label}'" for label, condition in mart.tiers)
    return (f"select d.*, {', '.join(r.sql(key, date) for r in mart.rolling)}, "
            f"case {tier} else '{mart.otherwise}' end {mart.tier} from ({days}) d")


def profile_sql(dimension: str, keep: tuple[str, ...], facts: dict[str, tuple[Measure, ...]],
                columns: tuple[str, ...], key: str = "atm_id") -> str:
    """The dimension with totals of each fact view, one aggregate and join per view."""
    joins = " ".join(
        f"left join (select {key}, {', '.join(m.sql() for m in measures)} from {view} group by {key}) using ({key})"
        for view, measures in facts.items())
    return f"select {', '.join((key, *keep, *columns))} from {dimension} {joins}"


FAULT = "is_fault = 1"
DAILY_CASH = Daily(
    "stg_cash",
    (Measure("min_cash_mwk", "min", "cash_level_mwk"), Measure("max_cash_mwk", "max", "cash_level_mwk"),
     Measure("avg_cash_mwk", "avg", "cash_level_mwk"), Measure("total_withdrawal_mwk", "sum", "hourly_withdrawal_mwk"),
     Measure("refill_count", "count", when="was_refilled"), Measure("hours_below_threshold", "count", when="below_threshold")),
    (Rolling("cash_ma_7d", "avg", "avg_cash_mwk", C.CASH_MA_ROWS),
     Rolling("withdrawal_ma_7d", "avg", "total_withdrawal_mwk", C.CASH_MA_ROWS),
     Rolling("prev_min_cash", "lag", "min_cash_mwk")),
    "cash_status",
    (("critical", f"min_cash_mwk < {C.CASH_CRITICAL_BELOW}"), ("low", f"min_cash_mwk < {C.CASH_LOW_BELOW}")), "healthy")
DAILY_FAULTS = Daily(
    "stg_faults",
    (Measure("faults", "count", when=FAULT), Measure("warnings", "count", when="event_class = 'warning'"),
     Measure("unresolved", "count", when="unresolved_flag = 1"),
     Measure("avg_duration_mins", "avg", "duration_mins", FAULT, "0d"),
     Measure("total_downtime_mins", "sum", "bigint(duration_mins)", FAULT, "0L"),
     *(Measure(f"{c}_events", "count", when=f"component = '{c}' and event_date is not null") for c in C.COMPONENTS)),
    (Rolling("faults_ma_30d", "sum", "faults", C.FAULT_ROLLING_ROWS),),
    "severity",
    (("high", f"faults >= {C.SEVERITY_HIGH_FAULTS}"), ("medium", f"warnings >= {C.SEVERITY_MEDIUM_WARNINGS}")), "low")
PROFILE_KEEP = ("city", "region", "latitude", "longitude", "atm_type", "atm_model", "bank", "installed_date",
                "age_years", "is_active")
PROFILE_FACTS = {
    "stg_transactions": (
        Measure("tx_seen", "count"), Measure("tx_bad", "count", when="success_flag = 0"),
        Measure("mean_drawn", "avg", "amount_mwk", "tx_type = 'withdrawal'"), Measure("last_tx_date", "max", "event_date")),
    "stg_faults": (
        Measure("faults_seen", "count", when=FAULT), Measure("last_fault_date", "max", "event_date", FAULT)),
}
PROFILE_COLUMNS = (
    "nvl(tx_seen, 0) total_tx", "nvl(tx_bad, 0) failed_tx", "double(nvl(tx_bad, 0)) / tx_seen failure_rate",
    "nvl(mean_drawn, 0d) avg_withdrawal_mwk", "last_tx_date", "nvl(faults_seen, 0) lifetime_faults", "last_fault_date")


def register_staging(m: Model, suffix: str = "") -> None:
    """Temp views ``stg_cash``, ``stg_faults``, ``stg_transactions``, ``stg_dim``."""
    for name, frame in (("stg_cash", m.stg_cash), ("stg_faults", m.stg_faults),
                        ("stg_transactions", m.stg_transactions), ("stg_dim", m.stg_device_dim)):
        frame.createOrReplaceTempView(name + suffix)


def _run(m: Model, text: str) -> DataFrame:
    register_staging(m)
    return m.spark.sql(text)


def daily_fault_mart_sql(m: Model) -> DataFrame:
    return _run(m, daily_sql(DAILY_FAULTS))


def daily_cash_mart_sql(m: Model) -> DataFrame:
    return _run(m, daily_sql(DAILY_CASH))


def device_profile_mart_sql(m: Model) -> DataFrame:
    return _run(m, profile_sql("stg_dim", PROFILE_KEEP, PROFILE_FACTS, PROFILE_COLUMNS))
