"""One lineage of DataFrames from the driver tables to marts, alerts and features.

``Model`` builds every derived table lazily (nothing runs until an action),
so a query pulls in exactly the part of the lineage it needs and Catalyst
prunes columns and pushes filters down to the Parquet scans.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from devicegrid import config as C
from devicegrid.operators import alerts, marts, silver, staging
from devicegrid.sources import adapters
from devicegrid.sources.schemas import BRONZE_SCHEMAS, TOPIC_ENTITY, TX_MESSAGE_SCHEMA
from devicegrid.sources.tables import Tables


class Model:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: _dt.date = C.DEFAULT_AS_OF,
                 run_ts: str = C.DEFAULT_RUN_TS):
        self.spark = spark
        self.tables = Tables(spark, sf_dir)
        self.as_of = as_of
        self.run_ts = run_ts

    # silver-shaped inputs -------------------------------------------------
    @cached_property
    def transactions(self) -> DataFrame:
        return adapters.transactions(self.tables)

    @cached_property
    def cash_levels(self) -> DataFrame:
        return adapters.cash_levels(self.tables)

    @cached_property
    def fault_events(self) -> DataFrame:
        return adapters.fault_events(self.tables)

    @cached_property
    def refills(self) -> DataFrame:
        return adapters.replenishments(self.cash_levels)

    @cached_property
    def device_dim(self) -> DataFrame:
        return adapters.device_dim(self.tables)

    @cached_property
    def level_dim(self) -> DataFrame:
        return adapters.level_dim(self.tables)

    # wire messages -> silver ----------------------------------------------
    def messages(self, topic: str) -> DataFrame:
        return adapters.messages(self.tables, topic)

    def bronze(self, topic: str) -> DataFrame:
        """Decoded messages of a topic (transactions keep their event id)."""
        schema = TX_MESSAGE_SCHEMA if topic == "atm.transactions" else BRONZE_SCHEMAS[topic]
        return silver.decode_json(self.messages(topic), schema, keep=("kafka_ts", "partition", "offset"))

    def silver(self, topic: str) -> DataFrame:
        return silver.silver_from_bronze(TOPIC_ENTITY[topic], self.bronze(topic))

    @cached_property
    def tx_messages(self) -> DataFrame:
        return self.messages("atm.transactions")

    @cached_property
    def tx_quarantine(self) -> DataFrame:
        broken = silver.decode_json(adapters.damaged(self.tx_messages), TX_MESSAGE_SCHEMA, keep=("value", "offset"))
        return silver.quarantine(broken, keep=("offset", "value"))

    # staging --------------------------------------------------------------
    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.transactions)

    @cached_property
    def stg_faults(self) -> DataFrame:
        return staging.stg_faults(self.fault_events)

    @cached_property
    def stg_cash(self) -> DataFrame:
        return staging.stg_cash(self.cash_levels)

    @cached_property
    def stg_refills(self) -> DataFrame:
        return staging.stg_refills(self.refills)

    @cached_property
    def stg_device_dim(self) -> DataFrame:
        return staging.stg_dim(self.device_dim, self.as_of)

    @cached_property
    def stg_level_dim(self) -> DataFrame:
        return staging.stg_dim(self.level_dim, self.as_of)

    # gold -----------------------------------------------------------------
    @cached_property
    def daily_cash(self) -> DataFrame:
        return marts.daily_level_mart(self.stg_cash)

    @cached_property
    def daily_faults(self) -> DataFrame:
        return marts.daily_fault_mart(self.stg_faults)

    @cached_property
    def device_profile(self) -> DataFrame:
        return marts.device_profile_mart(self.stg_device_dim, self.stg_transactions,
                                         self.stg_faults)

    # alerts ---------------------------------------------------------------
    @cached_property
    def cash_alerts(self) -> DataFrame:
        return alerts.cash_alerts(self.daily_cash, self.stg_level_dim, run_ts=self.run_ts,
                                  date_source=self.stg_cash)

    @cached_property
    def fault_alerts(self) -> DataFrame:
        return alerts.fault_alerts(self.daily_faults, self.stg_device_dim, run_ts=self.run_ts,
                                   date_source=self.stg_faults)

    @cached_property
    def all_alerts(self) -> DataFrame:
        return alerts.union_alerts(self.cash_alerts, self.fault_alerts)
