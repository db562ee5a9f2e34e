"""Staging views: key filter, 0/1 flags and calendar columns on silver tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicegrid import config as C
from devicegrid.functions.exprs import age_years, day_of_week_sunday0, flag


def stg_transactions(tx: DataFrame, key: str = "atm_id", ts: str = "event_ts") -> DataFrame:
    """Adds ``tx_hour``, ``day_of_week`` (0 = Sunday) and ``success_flag``.

    ``success_flag`` is 0 for NULL ``success``: an unknown outcome counts as failed.
    """
    return (tx.filter(F.col(key).isNotNull())
              .withColumns({
                  "tx_hour": F.hour(ts),
                  "day_of_week": day_of_week_sunday0(ts),
                  "success_flag": flag(F.col("success")),
              }))


def stg_faults(faults: DataFrame, key: str = "atm_id") -> DataFrame:
    """Adds ``is_fault`` and ``unresolved_flag`` (NULL ``resolved`` is not unresolved)."""
    return (faults.filter(F.col(key).isNotNull())
                  .withColumns({
                      "is_fault": flag(F.col("event_class") == "fault"),
                      "unresolved_flag": flag(F.col("resolved") == F.lit(False)),
                  }))


def stg_cash(levels: DataFrame, key: str = "atm_id") -> DataFrame:
    return levels.filter(F.col(key).isNotNull())


def stg_refills(refills: DataFrame, key: str = "atm_id") -> DataFrame:
    """Adds ``refill_date``."""
    return (refills.filter(F.col(key).isNotNull())
                   .withColumn("refill_date", F.to_date("refill_ts")))


def stg_dim(dim: DataFrame, as_of: _dt.date = C.DEFAULT_AS_OF) -> DataFrame:
    """Adds ``age_years`` as of ``as_of`` (a literal keeps reruns repeatable)."""
    return dim.withColumn("age_years", age_years("installed_date", as_of))
