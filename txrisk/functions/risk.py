"""The risk rules: score, label draw, reason codes."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from txrisk import values as V


def risk_score(
    amount: Column | None = None,
    device: Column | None = None,
    merchant: Column | None = None,
    location: Column | None = None,
) -> Column:
    """Probability of fraud the rules assign to a transaction, at most ``MAX_RISK``."""
    amount = F.col("amount") if amount is None else amount
    device = F.col("device") if device is None else device
    merchant = F.col("merchant") if merchant is None else merchant
    location = F.col("location") if location is None else location

    def extra(condition: Column, risk: float) -> Column:
        return F.when(condition, risk).otherwise(0.0)

    # Floating-point addition is not associative: the terms stay in this order.
    terms = [
        F.lit(V.BASE_RISK),
        F.when(amount > V.HIGH_AMOUNT, V.HIGH_AMOUNT_RISK)
        .when(amount > V.RAISED_AMOUNT, V.RAISED_AMOUNT_RISK)
        .otherwise(0.0),
        extra(device.isin(*V.RISKY_DEVICES), V.DEVICE_RISK),
        extra(merchant.isin(*V.RISKY_MERCHANTS), V.MERCHANT_RISK),
        extra(location.isin(*V.RISKY_LOCATIONS), V.LOCATION_RISK),
    ]
    return F.least(reduce(add, terms), F.lit(V.MAX_RISK))


def drawn_label(draw: Column, probability: Column) -> Column:
    """1 where a uniform draw falls below the probability, else 0."""
    return (draw < probability).cast("int")


def reason_codes(tested_amount: Column, prediction: Column | None = None) -> Column:
    """Why a row was flagged: comma-joined codes, ``ModelDetected`` if no rule applies.

    ``tested_amount`` is what the high-amount rule looks at. The serving pipeline passes the log
    amount, for which the rule cannot fire (amounts stay below 10,000, logs below 9.3); pass the raw
    amount to make it count.
    """
    prediction = F.col("prediction") if prediction is None else prediction
    codes = F.concat_ws(
        ",",
        F.when(tested_amount > V.HIGH_AMOUNT, V.REASON_HIGH_AMOUNT),
        F.when(F.col("device").isin(*V.RISKY_DEVICES), V.REASON_DEVICE),
        F.when(F.col("merchant").isin(*V.RISKY_MERCHANTS), V.REASON_MERCHANT),
        F.when(F.col("location").isin(*V.RISKY_LOCATIONS), V.REASON_LOCATION),
    )
    flagged = F.coalesce(F.nullif(codes, F.lit("")), F.lit(V.REASON_MODEL))
    return F.when(prediction == 1.0, flagged).otherwise(V.REASON_NORMAL)
