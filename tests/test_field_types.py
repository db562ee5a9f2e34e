"""Drift report: JSON types found per field."""

from drifting_messages import transaction_messages

from devicegrid.operators import silver
from devicegrid.plans.model import Model
from devicegrid.sources.schemas import TX_MESSAGE_SCHEMA


def _found(rows):
    return {(r.field, r.type): (r.n, r.drifted) for r in rows.collect()}


def test_types_of_awkward_messages(spark):
    texts = ["junk", None, "[1]", '"text"', '{"amount_mwk":1,"b":"x"}', '{"amount_mwk":1.5,"b":null,"atm_id":true}', "{}", "",
             '{"success":"True","amount_mwk":[1]}', '{"success":null,"atm_id":{"a":1}}', '{"amount_mwk":1e300}']
    got = _found(silver.field_types(spark.createDataFrame([(t,) for t in texts], "value string"), TX_MESSAGE_SCHEMA))
    assert got == {
        (None, "malformed"): (4, True),
        ("amount_mwk", "whole"): (1, False), ("amount_mwk", "decimal"): (2, True), ("amount_mwk", "array"): (1, True),
        ("atm_id", "boolean"): (1, True), ("atm_id", "object"): (1, True),
        ("b", "text"): (1, True), ("b", "null"): (1, True),
        ("success", "text"): (1, True), ("success", "null"): (1, False)}
    assert _found(silver.field_types(spark.createDataFrame([], "value string"), TX_MESSAGE_SCHEMA)) == {}


def test_a_loosely_typed_producer(spark, sf_dir):
    tx = Model(spark, sf_dir).transactions
    got = _found(silver.field_types(transaction_messages(tx), TX_MESSAGE_SCHEMA))
    rows = tx.toPandas()
    junk = (rows.card_type == "UnionPay") & (rows.tx_type == "transfer")
    assert got.get((None, "malformed"), (0, True)) == (junk.sum(), True)
    rows = rows[~junk]
    deposit, transfer, local = rows.tx_type == "deposit", rows.tx_type == "transfer", rows.card_type == "Local"
    assert got["amount_mwk", "decimal"] == (deposit.sum(), True) and got["amount_mwk", "text"] == (transfer.sum(), True)
    assert got["amount_mwk", "whole"] == ((~deposit & ~transfer).sum(), False)
    assert got["success", "text"] == (local.sum(), True) and got["success", "boolean"] == ((~local).sum(), False)
