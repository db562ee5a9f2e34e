"""Per-device forecast: grouped ridge regression with trend changes and seasons.

The level of a device is a line whose slope may change at ``changes`` evenly
spaced dates of the first ``change_range`` of its history, plus yearly waves up
to ``yearly`` and weekly waves up to ``weekly`` a period.  Levels are divided by
the largest one; changes of slope and waves are pulled to zero by ridge terms,
line and offset are free.

A device's daily rows (as many as there are days) come together as one array:
the daily mart is partitioned by device already, so that this needs no exchange.
X'X and X'y are sums over those rows again, grouped by device on the same
partitions; the normal equations, positive definite by the ridge, are solved by
elimination, a fold over arrays in the JVM.  The band is +/- z population
standard deviations of the residuals.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicegrid import config as C


@dataclass(frozen=True)
class Season:
    changes: int = 6
    change_range: float = 0.8
    yearly: int = 3
    weekly: int = 3
    change_ridge: float = 4.0
    wave_ridge: float = 1.0

    @property
    def size(self) -> int:
        return 2 + self.changes + 2 * (self.yearly + self.weekly)

    def ridge(self) -> list[float]:
        return [0.0, 0.0] + [self.change_ridge] * self.changes + [self.wave_ridge] * (2 * (self.yearly + self.weekly))

    def terms(self, t: Column, lo: Column, span: Column) -> list[Column]:
        """Values of all terms on day ``t`` (days since 1970)."""
        u = (t - lo) / span
        out = [F.lit(1.0), u]
        out += [F.greatest(u - F.lit(self.change_range * (k + 1) / (self.changes + 1)), F.lit(0.0)) for k in range(self.changes)]
        for period, most in ((365.25, self.yearly), (7.0, self.weekly)):
            for k in range(1, most + 1):
                angle = t * F.lit(2 * math.pi * k / period)
                out += [F.sin(angle), F.cos(angle)]
        return out


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values)


def level_on(model: Column, t: Column, season: Season) -> Column:
    return model["scale"] * _dot(model["coef"], F.array(*season.terms(t, model["lo"], model["span"])))


def _scale(rows: Column) -> Column:
    """(lo, span, scale) of an array of (t, y) by date."""
    lo, hi = F.get(rows, F.lit(0))["t"], F.get(rows, F.size(rows) - 1)["t"]
    top = F.array_max(F.transform(rows, lambda r: F.abs(r["y"])))
    return F.struct(lo.alias("lo"), F.greatest(hi - lo, F.lit(1)).cast("double").alias("span"), F.when(top > 0, top).otherwise(1.0).alias("scale"))


def _solution(matrix: Column, season: Season) -> Column:
    """Coefficients from the rows of (X'X + ridge, X'y), by elimination."""
    def eliminated(m: Column, k: Column) -> Column:
        def step(pivot: Column) -> Column:
            return F.transform(m, lambda row, i: F.when(i == k, F.transform(row, lambda v: v / F.get(pivot, k))).otherwise(
                F.zip_with(row, pivot, lambda v, w: v - w * (F.get(row, k) / F.get(pivot, k)))))
        return bound(F.get(m, k), step)

    m = F.aggregate(F.sequence(F.lit(0), F.lit(season.size - 1)), matrix, eliminated)
    return F.transform(m, lambda row: F.get(row, F.lit(season.size)))


def _deviation(rows: Column, model: Column, season: Season) -> Column:
    """Population standard deviation of the residuals of an array of (t, y)."""
    return bound(F.transform(rows, lambda r: r["y"] - level_on(model, r["t"], season)), lambda left: bound(_mean(left), lambda mean: F.sqrt(
        _mean(F.transform(left, lambda e: (e - mean) * (e - mean))))))


def _valued(rows: Column) -> Column:
    return F.filter(rows, lambda r: r["y"].isNotNull())


def fitted(rows: Column, season: Season) -> Column:
    """Model of an array of (t, y): coef, lo, span, scale, and sd of the residuals.
    One expression, which sums X'X by a fold; for whole tables see :func:`_fits`."""
    p, ridge = season.size, season.ridge()
    start = F.array(*[F.array(*[F.lit(ridge[i] if i == j else 0.0) for j in range(p + 1)]) for i in range(p)])

    def summed(rows: Column, s: Column) -> Column:
        def add(total: Column, r: Column) -> Column:
            x = F.array(*season.terms(r["t"], s["lo"], s["span"]), r["y"] / s["scale"])
            return bound(x, lambda x: F.transform(total, lambda row, i: F.zip_with(row, x, lambda a, b: a + F.get(x, i) * b)))
        return F.aggregate(rows, start, add)

    def solved(rows: Column, s: Column) -> Column:
        model = F.struct(_solution(summed(rows, s), season).alias("coef"), s["lo"].alias("lo"), s["span"].alias("span"), s["scale"].alias("scale"))
        return bound(model, lambda m: F.struct(*(m[c].alias(c) for c in ("coef", "lo", "span", "scale")), _deviation(rows, m, season).alias("sd")))

    return bound(_valued(rows), lambda rows: bound(_scale(rows), lambda s: solved(rows, s)))


def _fits(series: DataFrame, key: str, left_out: dict[str, int], season: Season) -> DataFrame:
    """(key, s) and a model (coef, lo, span, scale) for each name in ``left_out``,
    of all but so many of the last rows of each series.  The sums are those of
    a grouped aggregate over the days of all devices, on the partitions of
    ``series``, so that no row is folded into a matrix by itself."""
    p, own, ridge = season.size, 2 + season.changes, season.ridge()
    series = series.select(key, "s", *[_scale(_valued(F.slice("s", 1, F.size("s") - n))).alias(f"of_{f}") for f, n in left_out.items()])
    # The array goes on in one row of each device.
    days = series.select(key, F.struct(*[c for c in series.columns if c != key]).alias("d"), F.posexplode("s").alias("k", "r"))
    # Waves do not depend on the rows of a fit.
    waves = season.terms(F.col("r.t"), F.lit(0.0), F.lit(1.0))[own:]
    columns = [F.when(F.col("k") == 0, F.col("d")).alias("d"), *[x.alias(f"w{i}") for i, x in enumerate(waves, own)]]
    for f, n in left_out.items():
        lo, span, scale = (F.col(f"d.of_{f}.{c}") for c in ("lo", "span", "scale"))
        on = (F.col("k") < F.size("d.s") - n) & F.col("r.y").isNotNull()
        columns += [F.when(on, x).alias(f"{f}{i}") for i, x in enumerate(season.terms(F.col("r.t"), lo, span)[:own])]
        columns += [F.when(on, F.col("r.y") / scale).alias(f"{f}{p}")]

    def name(f: str, i: int) -> str:
        return f"{f}{i}" if i < own or i == p else f"w{i}"

    # The first term is 1, or null on rows that are left out.  A row without a
    # date comes first: its device has no ``lo``, null sums and a null model.
    sums = [f"sum({f}0 * {name(f, i)} * {name(f, j)}) AS {f}_{i}_{j}" for f in left_out for i in range(p) for j in range(i, p + 1)]
    total = days.select(key, *columns).groupBy(key).agg(F.first("d", ignorenulls=True).alias("d"), *map(F.expr, sums))
    matrices = [F.expr("array(" + ", ".join("array(" + ", ".join(
        f"{f}_{min(i, j)}_{max(i, j)} + {ridge[i] if i == j else 0.0}D" for j in range(p + 1)) + ")" for i in range(p)) + ")").alias(f) for f in left_out]
    return total.select(key, "d", *matrices).select(key, "d.s", *[F.struct(
        _solution(F.col(f), season).alias("coef"), *(F.col(f"d.of_{f}.{c}").alias(c) for c in ("lo", "span", "scale"))).alias(f) for f in left_out])


def _series(daily: DataFrame, key: str, date: str, value: str, min_rows: int) -> DataFrame:
    """(key, s): (t, y) of each device with at least ``min_rows`` rows, by date."""
    pair = F.struct(F.unix_date(date).cast("long").alias("t"), F.col(value).cast("double").alias("y"))
    return daily.groupBy(key).agg(F.array_sort(F.collect_list(pair)).alias("s")).where(F.size("s") >= min_rows)


def _held_out(s: Column, model: Column, holdout: int, season: Season) -> Column:
    """Mean absolute error on the last rows of a model of the others."""
    last = F.filter(F.slice(s, F.size(s) - holdout + 1, holdout), lambda r: r["y"].isNotNull())
    return F.when(F.size(last) > 0, _mean(F.transform(last, lambda r: F.abs(r["y"] - level_on(model, r["t"], season)))))


def _ahead(s: Column, model: Column, horizon: int, z: float, min_cash: float, season: Season) -> Column:
    """(days, needs_refill) of the ``horizon`` days after the last row."""
    def days(sd: Column) -> Column:
        def day(i: Column) -> Column:
            t = F.get(s, F.size(s) - 1)["t"] + i
            return bound(level_on(model, t, season), lambda y: F.struct(
                F.date_from_unix_date(t.cast("int")).alias("ds"), y.alias("yhat"), (y - z * sd).alias("yhat_lower"), (y + z * sd).alias("yhat_upper")))
        return bound(F.transform(F.sequence(F.lit(1), F.lit(horizon)), day), lambda d: F.struct(
            d.alias("days"), F.exists(d, lambda x: x["yhat_lower"] < min_cash).alias("needs_refill")))
    return bound(_deviation(_valued(s), model, season), days)


def forecast_holdout_error(daily: DataFrame, key: str = "atm_id", date: str = "event_date", value: str = "avg_cash_mwk",
                           min_rows: int = C.FORECAST_MIN_ROWS, holdout: int = C.FORECAST_HOLDOUT_ROWS, season: Season = Season()) -> DataFrame:
    """Fit on all but the last ``holdout`` rows of each series, report the mean
    absolute error on those rows: (key, train_rows, mae)."""
    s = _fits(_series(daily, key, date, value, min_rows), key, {"train": holdout}, season)
    return s.select(key, (F.size("s") - holdout).cast("long").alias("train_rows"), bound(F.col("train"), lambda m: _held_out(F.col("s"), m, holdout, season)).alias("mae"))


def forecast_horizon(daily: DataFrame, key: str = "atm_id", date: str = "event_date", value: str = "avg_cash_mwk",
                     min_rows: int = C.FORECAST_MIN_ROWS, horizon: int = C.FORECAST_HORIZON_DAYS, min_cash: int = C.FORECAST_MIN_CASH,
                     season: Season = Season(), z: float = C.FORECAST_BAND_Z) -> DataFrame:
    """Fit on every row and forecast the ``horizon`` days after each series' last
    date: (key, ds, yhat, yhat_lower, yhat_upper, needs_refill).  ``needs_refill``
    holds for all days of a device if any has ``yhat_lower < min_cash``."""
    s = _fits(_series(daily, key, date, value, min_rows), key, {"whole": 0}, season)
    out = s.select(key, bound(F.col("whole"), lambda m: _ahead(F.col("s"), m, horizon, z, min_cash, season)).alias("f"))
    return out.select(key, F.col("f.needs_refill").alias("needs_refill"), F.explode("f.days").alias("d")).select(
        key, "d.ds", "d.yhat", "d.yhat_lower", "d.yhat_upper", "needs_refill")


def forecast_summary(daily: DataFrame, key: str = "atm_id", date: str = "event_date", value: str = "avg_cash_mwk",
                     min_rows: int = C.FORECAST_MIN_ROWS, holdout: int = C.FORECAST_HOLDOUT_ROWS, horizon: int = C.FORECAST_HORIZON_DAYS,
                     min_cash: int = C.FORECAST_MIN_CASH, season: Season = Season(), z: float = C.FORECAST_BAND_Z) -> DataFrame:
    """One row: devices, their mean hold-out error and how many need a refill
    within the horizon; both fits from one pass over the days."""
    s = _fits(_series(daily, key, date, value, min_rows), key, {"train": holdout, "whole": 0}, season)
    per_device = s.select(bound(F.col("train"), lambda m: _held_out(F.col("s"), m, holdout, season)).alias("mae"),
                          bound(F.col("whole"), lambda m: _ahead(F.col("s"), m, horizon, z, min_cash, season))["needs_refill"].alias("need"))
    return per_device.agg(F.count(F.lit(1)).alias("devices"), F.avg("mae").alias("avg_mae"), F.count_if("need").alias("devices_needing_refill"))
