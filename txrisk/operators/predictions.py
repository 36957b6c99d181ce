"""From scored rows to the serving table and its alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txrisk import schema, values as V
from txrisk.functions.risk import reason_codes
from txrisk.functions.scalars import alert_body, log_amount


def with_log_amount(transactions: DataFrame) -> DataFrame:
    """Adds ``amount_log`` and keeps the raw ``amount``."""
    return transactions.withColumn("amount_log", log_amount(F.col("amount")))


def serving_rows(
    scored: DataFrame, tested: str = "amount_log", reported: str = "amount_log", keep: tuple[Column, ...] = ()
) -> DataFrame:
    """The eight serving columns of scored rows, explained.

    ``tested`` is the amount the high-amount reason looks at, ``reported`` the one stored as
    ``amount``. Both default to the log amount, so sums and averages over the table are in log
    units; pass ``"amount"`` for currency units. ``keep`` names further columns to carry along.
    """
    return scored.select(
        "transactionId",
        "userId",
        F.col(reported).alias("amount"),
        "location",
        "device",
        "merchant",
        "prediction",
        reason_codes(F.col(tested)).alias("fraud_reason"),
        *keep,
    )


def stored_rows(scored: DataFrame) -> DataFrame:
    """The serving columns, the day of the transaction and the first of its month, null if it has no time."""
    day = F.to_date("timestamp")
    months = day.alias(schema.DAY_COLUMN), F.trunc(day, "month").alias(schema.MONTH_COLUMN)
    return serving_rows(scored, keep=months)


def alerts(predictions: DataFrame, amount_digits: int | None = None) -> DataFrame:
    """One alert per flagged row, subject and text included.

    ``amount_digits`` rounds the amount, in its column and in the text.
    """
    amount = F.col("amount")
    if amount_digits is not None:
        amount = F.round(amount, amount_digits)
    return predictions.filter(F.col("prediction") == 1.0).select(
        "transactionId",
        "userId",
        amount.alias("amount"),
        "fraud_reason",
        F.lit(V.ALERT_SUBJECT).alias("subject"),
        alert_body(amount).alias("body"),
    ).select(*schema.ALERT.names)
