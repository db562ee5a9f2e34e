"""A loosely typed producer, for tests of the decoder."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def transaction_messages(tx: DataFrame) -> DataFrame:
    """Wire messages of the transactions topic as a loosely typed producer
    sends them: (key, value, kafka_ts, partition, offset).

    Type drift follows fixed rules on the row's content so both engines can
    reproduce it: deposits carry the amount as a float (``343.0``), transfers
    as text (``"343"``); ``Local`` cards carry ``success`` as ``"True"`` /
    ``"False"``; UnionPay deposits carry an unparsable time and UnionPay
    transfers are not JSON at all.
    """
    amount = F.col("amount_mwk").cast("string")
    amount_json = (F.when(F.col("tx_type") == "deposit", F.concat(amount, F.lit(".0")))
                    .when(F.col("tx_type") == "transfer", F.concat(F.lit('"'), amount, F.lit('"')))
                    .otherwise(amount))
    success_json = F.when(F.col("card_type") == "Local",
                          F.concat(F.lit('"'), F.initcap(F.col("success").cast("string")), F.lit('"'))
                          ).otherwise(F.col("success").cast("string"))
    union_pay = F.col("card_type") == "UnionPay"
    ts_text = F.when(union_pay & (F.col("tx_type") == "deposit"), F.lit("not a time")) \
               .otherwise(F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    body = F.concat(
        F.lit('{"event_id": '), F.col("event_id").cast("string"),
        F.lit(', "atm_id": "'), F.col("atm_id").cast("string"),
        F.lit('", "timestamp": "'), ts_text,
        F.lit('", "tx_type": "'), F.col("tx_type"),
        F.lit('", "amount_mwk": '), amount_json,
        F.lit(', "card_type": "'), F.col("card_type"),
        F.lit('", "success": '), success_json, F.lit("}"))
    value = F.when(union_pay & (F.col("tx_type") == "transfer"), F.lit("junk")).otherwise(body)
    return tx.select(F.col("atm_id").cast("string").alias("key"),
                     value.alias("value"),
                     F.col("event_ts").cast("timestamp").alias("kafka_ts"),
                     F.pmod(F.col("atm_id"), F.lit(3)).cast("int").alias("partition"),
                     F.col("event_id").alias("offset"))
