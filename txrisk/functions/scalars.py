"""Small scalar functions around amounts, times and texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from txrisk import values as V


def log_amount(amount: Column) -> Column:
    """Natural log of one plus the amount; null for amounts of -1 and below."""
    return F.log1p(amount)


def rounded_amount(amount: Column, places: int = 2) -> Column:
    """Amount rounded half up. The decimal step keeps binary ties from deciding."""
    return F.round(amount.cast("decimal(18,6)"), places).cast("double")


def minutes_before(moment: Column, minutes: Column) -> Column:
    return moment - F.make_interval(mins=minutes)


def transaction_id(number: Column) -> Column:
    return F.concat(F.lit("txn"), number.cast("string"))


def transaction_number(identifier: Column) -> Column:
    """The number inside a transaction id, null if there is none."""
    return F.substr(identifier, F.lit(4)).try_cast("bigint")


def alert_body(amount: Column) -> Column:
    return F.format_string(
        V.ALERT_BODY,
        F.col("transactionId"),
        F.col("userId").cast("string"),
        amount.cast("string"),
        F.col("fraud_reason"),
    )
