"""Keeping rolling marts current from a stream.

Row-frame windows (7-row averages, 30-row sums, lag) are not allowed on
streaming frames, and a late row changes the following rows of its device
too.  So the work is split where the daily rows are:

1. The mart's aggregate (one row per device and day) is a streaming aggregation:
   Spark's state store holds its partial sums, a late row of any age finds its
   day, and update mode emits the days that a micro-batch changed.  The store is
   RocksDB with a bounded share of memory: its entries, as many as daily rows, lie
   on disk and not in the executors' heap.
2. ``foreachBatch`` adds those daily rows as an epoch (``epochs``), then replays
   the windows of the touched devices over their newest daily rows, from each
   device's first touched day on; the windows look only backwards, so earlier
   rows stand.  The replayed mart rows are an epoch too.

Readers take the newest version per device and day.  Both writes replace their
own epoch when it is retried, and a retry replays the same daily rows (those up
to its epoch).  State is one entry per device and day; the per-batch work is the
touched devices' daily rows, never raw rows.  Rows without a date sort last in
the windows and are replayed with any other day of their device.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from devicegrid.session import written
from devicegrid.streaming import epochs
from devicegrid.streaming.live import ROCKSDB, _triggered

_STORE = "spark.sql.streaming.stateStore."
#: MB that all of an executor's state stores share for writes and cached blocks.
STATE_MB = 256


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB (a query keeps the settings it started with)."""
    conf = {f"{_STORE}providerClass": ROCKSDB, f"{_STORE}rocksdb.boundedMemoryUsage": "true",
            f"{_STORE}rocksdb.maxMemoryUsageMB": str(STATE_MB), f"{_STORE}rocksdb.trackTotalNumberOfRows": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def refresh_batch(changed: DataFrame, epoch_id: int, daily_path: str, mart_path: str,
                  window_fn: Callable[[DataFrame], DataFrame], key: str = "atm_id", date: str = "event_date") -> None:
    """Add an epoch's changed daily rows and replay the windows behind them."""
    spark, run = changed.sparkSession, epochs.query_id(changed)
    epochs.write_epoch(changed, daily_path, run, epoch_id)
    rows = epochs.read_epochs(spark, daily_path, changed.schema).filter((F.col("run") != run) | (F.col("epoch") <= epoch_id))
    this = (F.col("run") == run) & (F.col("epoch") == epoch_id)
    # Written, so that the joins know its size: a row per touched device.
    since = written(rows.filter(this).groupBy(F.col(key).alias("_key")).agg(F.min(date).alias("_since")), "since")
    touched = rows.join(since.select("_key"), F.col(key) == F.col("_key"), "left_semi")
    # Dealt out by device once, which serves the newest rows and the windows.
    daily = epochs.latest(touched.repartition(key), [key, date])
    mart = window_fn(daily.select(*changed.columns))
    replayed = (mart.join(since, F.col(key) == F.col("_key"))
                    .filter(F.col(date).isNull() | (F.col(date) >= F.col("_since"))).select(*mart.columns))
    epochs.write_epoch(replayed, mart_path, run, epoch_id)


def start_mart_refresh(stream: DataFrame, daily_path: str, mart_path: str, checkpoint: str,
                       base_fn: Callable[[DataFrame], DataFrame],
                       window_fn: Callable[[DataFrame], DataFrame],
                       key: str = "atm_id", date: str = "event_date", available_now: bool = True,
                       processing_time: str | None = None) -> StreamingQuery:
    """Aggregate ``stream`` by ``base_fn`` and run ``refresh_batch`` on what each micro-batch changed."""
    def run(changed: DataFrame, epoch_id: int) -> None:
        refresh_batch(changed, epoch_id, daily_path, mart_path, window_fn, key, date)

    w = base_fn(stream).writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint)
    with state_on_disk(stream.sparkSession):
        return _triggered(w, available_now, processing_time).start()


def read_mart(spark: SparkSession, mart_path: str, schema: T.StructType, key: str = "atm_id", date: str = "event_date") -> DataFrame:
    """The mart's newest rows; ``schema``: of the mart's rows."""
    rows = epochs.read_epochs(spark, mart_path, schema).repartition(key, date)  # few versions a row: nothing to combine before
    return epochs.latest(rows, [key, date]).select(*schema.fieldNames())
