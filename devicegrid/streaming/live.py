"""Live path: rows inserted in batches by size or age, per-minute counts, late rows accounted for."""

from __future__ import annotations

import threading
import time
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from devicegrid import config as C
from devicegrid.streaming import epochs

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def live_rows(bronze: DataFrame, key: str = "atm_id") -> DataFrame:
    """Live table rows: arrival time as event time, defaults for missing values
    (amount 0, success false), rows without a key left out; with the message's
    place in its topic."""
    return bronze.filter(F.col(key).isNotNull()).select(
        key,
        F.current_timestamp().alias("event_ts"),
        "tx_type",
        F.coalesce(F.col("amount_mwk"), F.lit(0)).cast("long").alias("amount_mwk"),
        "card_type",
        F.coalesce(F.col("success"), F.lit(False)).alias("success"),
        "partition", "offset",
    )


class InsertBatches(StatefulProcessor):
    """Hold a consumer's rows until there are ``size`` of them or the first has waited ``seconds``.

    List state holds fewer than ``size`` rows between micro-batches, and one
    processing-time timer stands for the oldest of them.  Rows leave in the
    order they came, marked with the offset of their batch's first row.
    """

    def __init__(self, schema: T.StructType, size: int, seconds: float):
        self.schema, self.size, self.wait_ms = schema, size, int(seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.schema)

    def _batch(self, rows: list) -> Iterator[Row]:
        batch = [dict(zip(self.schema.fieldNames(), r)) for r in rows]
        for r in batch:
            yield Row(**r, batch_offset=batch[0]["offset"], batch_rows=len(batch))

    def _no_timer(self) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = list(self.held.get()) if self.held.exists() else []
        waited, names = bool(held), self.schema.fieldNames()
        flushed = False
        for r in rows:
            held.append(tuple(r[n] for n in names))
            if len(held) == self.size:
                yield from self._batch(held)
                held, flushed = [], True
        if held:
            self.held.put(held)
        else:
            self.held.clear()
        if waited and flushed:
            self._no_timer()
        if held and (flushed or not waited):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        held = list(self.held.get()) if self.held.exists() else []
        self.held.clear()
        if held:
            yield from self._batch(held)

    def close(self) -> None:
        pass


def insert_batches(rows: DataFrame, size: int = C.LIVE_BATCH_ROWS, seconds: float = C.LIVE_BATCH_SECONDS,
                   lanes: int = 1) -> DataFrame:
    """``rows`` (with ``partition`` and ``offset``) as insert batches of ``size`` rows or ``seconds``.

    Each source partition is a consumer with batches of its own; ``lanes``
    splits a hot partition's offsets over that many.  The result has
    ``batch_offset`` (offset of the batch's first row) and ``batch_rows`` too.
    """
    schema = T.StructType([*rows.schema.fields])
    out = T.StructType([*schema.fields, T.StructField("batch_offset", T.LongType()), T.StructField("batch_rows", T.IntegerType())])
    return (rows.withColumn("lane", F.pmod("offset", F.lit(lanes))).groupBy("partition", "lane")
                .transformWithState(InsertBatches(schema, size, seconds), out, "Append", "ProcessingTime"))


def start_live_sink(rows: DataFrame, table_path: str, checkpoint: str, processing_time: str = "1 second",
                    size: int = C.LIVE_BATCH_ROWS, seconds: float = C.LIVE_BATCH_SECONDS, lanes: int = 1) -> StreamingQuery:
    """Insert batches appended to Parquet by Spark's file sink: with the checkpoint, each row once.

    Timers need a running trigger, so the query runs until stopped (see :func:`drained`).
    """
    spark = rows.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)  # timers need it; a query keeps the settings it started with
    try:
        return (insert_batches(rows, size, seconds, lanes).writeStream.format("parquet").option("path", table_path)
                .option("checkpointLocation", checkpoint).outputMode("append").trigger(processingTime=processing_time).start())
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def drained(query: StreamingQuery, timeout: float = 3600.0) -> None:
    """Wait until the source gave nothing in two triggers running and no row is held any more, then stop."""
    end, idle = time.monotonic() + timeout, set()
    while len(idle) < 2:
        if time.monotonic() > end:
            query.stop()
            raise TimeoutError(f"rows still held after {timeout} s")
        if not query.isActive:
            raise RuntimeError(f"the query ended early: {query.exception()}")
        p = query.lastProgress
        if p is not None:
            held = sum(s.numRowsTotal for s in p.stateOperators)
            idle = idle | {p.batchId} if p.numInputRows == 0 and held == 0 else set()
        time.sleep(0.2)
    query.stop()


def _triggered(w, available_now: bool, processing_time: str | None):
    if available_now:
        return w.trigger(availableNow=True)
    return w.trigger(processingTime=processing_time) if processing_time else w


def per_minute_counts(df: DataFrame, ts: str = "event_ts", delay: str = "10 minutes",
                      by: tuple[str, ...] = (), where=None) -> DataFrame:
    """Transactions per 1-minute window.

    On a stream the watermark bounds the state; it has to cover the disorder of
    the source (between its files or partitions), as rows behind it are
    dropped - :class:`LateRows` makes that an error.  ``where`` selects the rows
    to count.  It is applied inside the aggregate, not as a filter before it:
    Catalyst would push such a filter below the watermark, and other messages
    must still advance event time.
    """
    if df.isStreaming:
        df = df.withWatermark(ts, delay)
    n = F.count(F.lit(1)) if where is None else F.count_if(where)
    out = (df.groupBy(F.window(ts, "1 minute").alias("w"), *by)
             .agg(n.alias("n"))
             .select(F.col("w.start").alias("minute"), *by, "n"))
    return out if where is None else out.filter(F.col("n") > 0)


def start_minute_counts(counts: DataFrame, table_path: str, checkpoint: str,
                        available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Keep per-minute counts current: update mode, each epoch adds the newest counts of its minutes."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        epochs.write_epoch(batch, table_path, epochs.query_id(batch), epoch_id)

    w = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(w, available_now, processing_time).start()


def minute_counts(spark: SparkSession, table_path: str, schema: T.StructType) -> DataFrame:
    """The counts as they stand; ``schema``: of the counts that were started."""
    return epochs.latest(epochs.read_epochs(spark, table_path, schema), [c for c in schema.fieldNames() if c != "n"])


class LateRows(StreamingQueryListener):
    """Counts the rows that queries drop behind their watermarks, over all their micro-batches.

    ``with LateRows(spark) as late:`` around starting the queries; ``late.finished(query)``
    waits for one and raises if it lost rows.  A query keeps only its last
    progress entries, a listener is told of each.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.lost, self.batches = spark, Counter(), Counter()
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def __enter__(self) -> LateRows:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *failure) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches[str(p.runId)] += 1
        self.lost[str(p.runId)] += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def finished(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Wait for the query's end and for its last event; rows lost are an error."""
        query.awaitTermination()
        if not self._ended[str(query.runId)].wait(timeout):
            raise TimeoutError("the query's last event has not come")
        if lost := self.lost[str(query.runId)]:
            raise RuntimeError(f"{lost} rows came later than the watermark allows; raise its delay and start anew")


def latest_n(df: DataFrame, n: int = 15, ts: str = "event_ts", tie: str = "offset") -> DataFrame:
    """The ``n`` most recent rows (a top-k report; batch frames)."""
    return df.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(n)
