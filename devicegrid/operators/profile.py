"""Data profiles and serving queries over silver tables and marts.

Every statistic is a distributed aggregate (partial + final); results that
reach the driver are single rows or top-k lists whose size is a parameter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicegrid import config as C
from devicegrid.functions.exprs import portable_hash_text

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None,
                    places: int = 1) -> DataFrame:
    """mean / sample std / min / max per numeric column, long format.

    One pass: all statistics of all columns in a single aggregate, then an
    ``unpivot`` of that one row into (column, mean, std, min, max).  A mean is an
    exact decimal sum divided once, so that its last place does not depend on the
    order of the rows.
    """
    cols = list(columns or numeric_columns(df))
    stats = df.agg(*[F.struct((F.sum(F.col(c).cast("decimal(28,6)")).cast("double") / F.count(c)).alias("mean"), F.stddev_samp(c).alias("std"),
                              F.min(c).cast("double").alias("min"),
                              F.max(c).cast("double").alias("max")).alias(c) for c in cols])
    long = stats.unpivot([], cols, "column", "s")
    return long.select("column", *[F.round(F.col("s").getField(k), places).alias(k)
                                   for k in ("mean", "std", "min", "max")])


def shape_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows, n_cols, columns, null_cells) for each table; one pass per table."""
    parts = []
    for name, df in tables.items():
        nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.cast("long").alias("null_cells"))
                       .select(F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_cols"),
                               F.lit(",".join(df.columns)).alias("columns"), "null_cells"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def group_sizes(df: DataFrame, *keys: str) -> DataFrame:
    """``groupBy(keys).count()`` named ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def dimension_counts(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Group sizes of several columns, long format (dimension, value, n)."""
    out = None
    for d in dims:
        g = group_sizes(df, d).select(F.lit(d).alias("dimension"),
                                      F.col(d).cast("string").alias("value"), "n")
        out = g if out is None else out.unionByName(g)
    return out


def crosstab_counts(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Counts of (row, col) unstacked to one column per listed value, missing = 0.

    The value list is given, so ``pivot`` needs no extra job to find it.
    """
    return df.groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1))).fillna(0)


def type_breakdown(tx: DataFrame, type_col: str = "tx_type",
                   amount_col: str = "amount_mwk") -> DataFrame:
    """Count and mean amount per type; the mean rounds half to even."""
    return tx.groupBy(type_col).agg(F.count(F.lit(1)).alias("count"),
                                    F.bround(F.avg(amount_col), 0).alias("avg_amount"))


def rate_percent(df: DataFrame, flag_col: str, places: int = 2, name: str = "rate_pct") -> DataFrame:
    """Share of true values in percent (NULL counts as not true)."""
    v = F.coalesce(F.col(flag_col).cast("double"), F.lit(0.0))
    return df.agg(F.round(F.avg(v) * 100, places).alias(name))


def flag_counts(df: DataFrame, flags: dict[str, str]) -> DataFrame:
    """One row: number of true values per named flag column."""
    return df.agg(*[F.count_if(F.col(c)).alias(n) for n, c in flags.items()])


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values (a filter list), sorted."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def filter_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(dimension, value): the distinct non-null values of several columns
    (filter lists), sorted once, from one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns])
    return (df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
              .orderBy("dimension", "value"))


def optional_filter(df: DataFrame, **equals) -> DataFrame:
    """Equality filters where the value ``"All"`` (or None) means no filter."""
    for c, v in equals.items():
        if v is not None and v != "All":
            df = df.filter(F.col(c) == v)
    return df


def latest_rows(df: DataFrame, date: str = "event_date",
                date_source: DataFrame | None = None) -> DataFrame:
    """Rows at the latest date (uncorrelated scalar subquery).

    ``date_source``: a cheaper frame with the same dates (e.g. a mart's input
    rows), so the latest date does not recompute an aggregated ``df``.
    """
    src = df if date_source is None else date_source
    return df.filter(F.col(date) == src.select(F.max(date)).scalar())


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Counts per value, largest first (ties by value)."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias(name))
              .orderBy(F.col(name).desc(), F.col(column).asc()))


def network_kpis(dim_profile: DataFrame, daily_cash: DataFrame,
                 at_risk: Sequence[str] = ("critical", "low"), key: str = "atm_id",
                 date: str = "event_date") -> DataFrame:
    """Device count, total transactions, mean failure rate (unweighted, NULLs
    skipped), devices at risk on the latest day, distinct devices with levels.

    The level figures come from one pass: each device's last day and status,
    counted per last day; the latest of these days is the network's.
    """
    last = daily_cash.groupBy(key).agg(F.max(date).alias("d"), F.max_by("cash_status", date).alias("s"))
    days = last.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("s").isin(*at_risk)).alias("r"))
    levels = days.agg(F.coalesce(F.max_by("r", "d"), F.lit(0)).alias("cash_at_risk"),
                      F.coalesce(F.sum("n"), F.lit(0)).alias("devices_with_levels"))
    totals = dim_profile.agg(
        F.count(F.lit(1)).alias("devices"),
        F.sum("total_tx").alias("total_tx"),
        F.avg("failure_rate").alias("avg_failure_rate"))
    return totals.select("*", levels.select("cash_at_risk").scalar().alias("cash_at_risk"),
                         levels.select("devices_with_levels").scalar().alias("devices_with_levels"))


def latest_status_map(dim: DataFrame, daily_cash: DataFrame, key: str = "atm_id",
                      default_status: str = "healthy",
                      date_source: DataFrame | None = None) -> DataFrame:
    """Dimension rows with the latest day's minimum level and status
    (devices without a reading that day get ``default_status``)."""
    latest = latest_rows(daily_cash, date_source=date_source).select(key, "min_cash_mwk", "cash_status")
    j = dim.join(latest, key, "left")
    return j.select(key, "city", "region", "atm_type", "latitude", "longitude", "min_cash_mwk",
                    F.coalesce("cash_status", F.lit(default_status)).alias("cash_status"))


def component_matrix_long(daily_faults: DataFrame, components: Sequence[str] = C.ALERT_COMPONENTS,
                          key: str = "atm_id") -> DataFrame:
    """Per device and component the summed events, long format (key, component, events).

    The wide device x component matrix of a dashboard is this frame pivoted on
    the device; kept long so its width does not grow with the device count.
    """
    sums = daily_faults.groupBy(key).agg(*[F.sum(f"{c}_events").alias(c) for c in components])
    return sums.unpivot([key], list(components), "component", "events")


def top_k(df: DataFrame, key: str, value: str, k: int = 10, name: str | None = None) -> DataFrame:
    """Largest per-key maximum of ``value``, top ``k`` (ties by key ascending)."""
    name = name or f"max_{value}"
    per_key = df.groupBy(key).agg(F.max(value).alias(name))
    return per_key.orderBy(F.col(name).desc(), F.col(key).asc()).limit(k)


def first_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """First ``n`` rows in a total ``order`` (a page of a feed)."""
    return df.orderBy(*order).limit(n)


def repeatable_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = C.SEED) -> DataFrame:
    """``n`` rows in a seeded pseudo-random order (same rows on every run and
    in any engine with SHA-256); a top-n, so no global sort is materialised."""
    return df.orderBy(portable_hash_text(*keys, seed=seed), *keys).limit(n)


def shuffled(df: DataFrame, keys: Sequence[str], seed: int = C.SEED) -> DataFrame:
    """All rows in a seeded pseudo-random order, with their place in it."""
    return df.withColumn("shuffle_key", portable_hash_text(*keys, seed=seed)).orderBy("shuffle_key", *keys)
