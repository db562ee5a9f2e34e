"""Per-device running statistics kept by Structured Streaming state.

The transaction statistics of the device profile (count, failures, mean
withdrawal, last date) are algebraic, so a streaming ``groupBy(device).agg``
keeps them in the state store (one entry per device, bounded by the number
of devices).  In update mode each micro-batch emits the current totals of
the devices it touched, which are added as an epoch; a retried epoch replaces
itself by the same totals.  Readers take each device's newest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from devicegrid.operators.marts import device_tx_stats
from devicegrid.streaming import epochs
from devicegrid.streaming.live import _triggered


def start_stats_stream(tx_stream: DataFrame, table_path: str, checkpoint: str, key: str = "atm_id",
                       available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Stateful aggregation of ``tx_stream``, its totals added to ``table_path``."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        epochs.write_epoch(batch, table_path, epochs.query_id(batch), epoch_id)

    w = (device_tx_stats(tx_stream, key).writeStream.outputMode("update").foreachBatch(run)
         .option("checkpointLocation", checkpoint))
    return _triggered(w, available_now, processing_time).start()


def read_stats(spark: SparkSession, table_path: str, schema: T.StructType, key: str = "atm_id") -> DataFrame:
    """The newest totals; ``schema``: of ``device_tx_stats``'s rows."""
    return epochs.latest(epochs.read_epochs(spark, table_path, schema), [key])
