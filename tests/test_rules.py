"""Rule score, reason codes, draws and small scalars on hand-made rows."""

from pyspark.sql import functions as F

from txrisk import schema
from txrisk.functions.draws import congruential_draw, key_draw
from txrisk.functions.risk import drawn_label, reason_codes, risk_score
from txrisk.functions.scalars import (
    log_amount, minutes_before, rounded_amount, transaction_id, transaction_number,
)
from txrisk.operators.predictions import alerts, serving_rows, with_log_amount

ROW = "amount double, device string, merchant string, location string"


def test_risk_score(spark):
    rows = spark.createDataFrame([
        (10.0, "Web", "Fuel", "NY"),
        (3000.0, "Web", "Fuel", "NY"),
        (3000.01, "Web", "Fuel", "NY"),
        (7000.0, "Web", "Fuel", "NY"),
        (7000.01, "Web", "Fuel", "NY"),
        (7000.01, "ATM", "Travel", "TX"),
        (None, None, None, None),
    ], ROW)
    found = [round(r[0], 6) for r in rows.select(risk_score()).collect()]
    assert found == [0.05, 0.05, 0.15, 0.15, 0.25, 0.60, 0.05]


def test_reason_codes(spark):
    rows = spark.createDataFrame([
        (1.0, 9.0, "ATM", "Travel", "TX", "RiskyDevice,RiskyMerchant,RiskyLocation"),
        (1.0, 8000.0, "Web", "Fuel", "NY", "HighAmount"),
        (1.0, 8000.0, "Mobile", "Electronics", "FL",
         "HighAmount,RiskyDevice,RiskyMerchant,RiskyLocation"),
        (1.0, 9.0, "Web", "Fuel", "NY", "ModelDetected"),
        (1.0, None, None, None, None, "ModelDetected"),
        (0.0, 8000.0, "ATM", "Travel", "TX", "Normal"),
        (None, 8000.0, "ATM", "Travel", "TX", "Normal"),
    ], "prediction double, amount double, device string, merchant string, location string, want string")
    for row in rows.withColumn("got", reason_codes(F.col("amount"))).collect():
        assert row.got == row.want


def test_high_amount_is_tested_on_the_log_by_default(spark):
    rows = with_log_amount(spark.createDataFrame(
        [("t1", 1, 9999.0, "NY", "Web", "Fuel", 1.0)],
        "transactionId string, userId long, amount double, location string, device string, "
        "merchant string, prediction double",
    ))
    assert serving_rows(rows).first().fraud_reason == "ModelDetected"
    assert serving_rows(rows, tested="amount").first().fraud_reason == "HighAmount"
    assert round(serving_rows(rows).first().amount, 4) == 9.2103
    assert serving_rows(rows, reported="amount").first().amount == 9999.0
    assert serving_rows(rows).schema.names == schema.PREDICTION.names


def test_log_of_minus_one_and_below_is_null(spark):
    rows = spark.createDataFrame([(-1.0,), (-5.0,), (0.0,)], "amount double")
    assert [r[0] for r in rows.select(log_amount(F.col("amount"))).collect()] == [None, None, 0.0]


def test_rounding_is_half_up(spark):
    rows = spark.createDataFrame([(2.345,), (2.675,), (1.005,), (-2.345,)], "amount double")
    found = [r[0] for r in rows.select(rounded_amount(F.col("amount"))).collect()]
    assert found == [2.35, 2.68, 1.01, -2.35]


def test_minutes_before(spark):
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp")
    found = spark.range(1).select(
        minutes_before(moment, F.lit(90)).cast("string")
    ).first()[0]
    assert found == "2023-12-31 22:30:00"


def test_transaction_ids(spark):
    rows = spark.createDataFrame([(7,), (600000000000,)], "n long")
    ids = rows.select(transaction_id(F.col("n")).alias("id"))
    assert [r.id for r in ids.collect()] == ["txn7", "txn600000000000"]
    assert [r[0] for r in ids.select(transaction_number(F.col("id"))).collect()] == [7, 600000000000]
    other = spark.createDataFrame([("abc",), (None,)], "id string")
    assert [r[0] for r in other.select(transaction_number(F.col("id"))).collect()] == [None, None]


def test_congruential_draw_does_not_overflow_on_large_keys(spark):
    keys = [0, 1, 14999, 600_000_000_000, 2**62]
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    for factor, step, modulus in (
        (1103515245, 12345, 2**31), (22695477, 1, 2**32), (1597334677, 7, 2**32)
    ):
        found = rows.select(congruential_draw(F.col("k"), factor, step, modulus)).collect()
        assert [r[0] for r in found] == [(k * factor + step) % modulus / modulus for k in keys]


def test_key_draw_is_uniform_and_independent_of_partitions(spark):
    rows = spark.range(20000).select(transaction_id(F.col("id")).alias("id"))
    draws = rows.select("id", key_draw(F.col("id"), 42).alias("draw"))
    low, high, mean = draws.agg(F.min("draw"), F.max("draw"), F.avg("draw")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.01
    again = rows.repartition(7).select("id", key_draw(F.col("id"), 42).alias("draw"))
    assert draws.exceptAll(again).count() == 0


def test_drawn_label(spark):
    rows = spark.createDataFrame([(0.1, 0.2), (0.2, 0.2), (0.3, 0.2)], "u double, p double")
    assert [r[0] for r in rows.select(drawn_label(F.col("u"), F.col("p"))).collect()] == [1, 0, 0]


def test_alerts(spark):
    rows = spark.createDataFrame([
        ("t1", 5, 8.123456789, "NY", "Web", "Fuel", 1.0, "ModelDetected"),
        ("t2", 6, 2.0, "NY", "Web", "Fuel", 0.0, "Normal"),
        ("t3", None, 2.0, "NY", "Web", "Fuel", 1.0, "RiskyDevice"),
        ("t4", 6, 2.0, "NY", "Web", "Fuel", None, "Normal"),
    ], schema.PREDICTION)
    found = {r.transactionId: r for r in alerts(rows).collect()}
    assert set(found) == {"t1", "t3"}
    assert found["t1"].subject == "Fraud Alert!"
    assert found["t1"].body == (
        "Fraud detected! Transaction: t1, User: 5, Amount: 8.123456789, Reason: ModelDetected"
    )
    assert alerts(rows, 2).filter("transactionId = 't1'").first().amount == 8.12
    assert "Amount: 8.12," in alerts(rows, 2).filter("transactionId = 't1'").first().body
