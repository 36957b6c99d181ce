"""Transactions as keyed JSON messages, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txrisk import schema


def to_envelope(transactions: DataFrame) -> DataFrame:
    """(key, value): the transaction id and the row as a JSON object, timestamp as plain text."""
    fields = [c for c in schema.LABELLED.names if c in transactions.columns]
    payload = F.to_json(F.struct(*(
        F.col(c).cast("string").alias(c) if c == "timestamp" else F.col(c) for c in fields
    )))
    return transactions.select(
        F.col("transactionId").alias("key"), payload.cast("binary").alias("value")
    )


def parse_envelope(messages: DataFrame) -> DataFrame:
    """One row per message: its key, its text, and the payload's fields.

    Nothing fails here: fields the text lacks are null, and text that is no readable object is also
    kept in ``_corrupt_record``. Fields the schema does not know, such as a label, are dropped.

    The payload is flattened by a generator and not by a projection: a later filter on its fields
    would be pushed through a projection, and every field it names would parse the text again.
    """
    options = {"columnNameOfCorruptRecord": schema.CORRUPT_COLUMN, "mode": "PERMISSIVE"}
    texts = messages.selectExpr(
        "CAST(key AS STRING) AS message_key", "CAST(value AS STRING) AS raw"
    )
    payload = F.from_json("raw", schema.MESSAGE, options)
    return texts.select("message_key", "raw", F.inline(F.array(payload)))


def reject_cause() -> Column:
    """Why a parsed message cannot be scored, null if it can.

    The classifier takes numbers only: a null or NaN user or amount would end the whole job, an
    infinite amount would spoil every total it enters, and one of -1 or less has no log. Without an id
    nobody could tell whom an alert is about. A field that is there but cannot be read, such as a broken
    timestamp, is no missing one. Unknown or missing categories are fine, they have an index.
    """
    amount = F.col("amount")
    return (
        F.when(F.col("raw").isNull(), "empty message")
        .when(F.col("userId").isNull() & amount.isNull() & F.col("transactionId").isNull(),
              "unreadable message")
        .when(F.col("transactionId").isNull(), "no transaction")
        .when(F.col("userId").isNull(), "no user")
        .when(amount.isNull(), "no amount")
        .when(F.isnan(amount), "amount is not a number")
        .when(amount == float("inf"), "amount is infinite")
        .when(amount <= -1, "amount has no log")
        .when(F.col(schema.CORRUPT_COLUMN).isNotNull(), "unreadable field")
    )


def checked(messages: DataFrame) -> DataFrame:
    """Parsed messages with their reject ``cause``; only rejects keep their text."""
    return (
        parse_envelope(messages)
        .withColumn("cause", reject_cause())
        .withColumn("raw", F.when(F.col("cause").isNotNull(), F.col("raw")))
        .drop(schema.CORRUPT_COLUMN)
    )


def accepted(checked_rows: DataFrame) -> DataFrame:
    return checked_rows.filter(F.col("cause").isNull()).select(*schema.TRANSACTION.names)


def rejected(checked_rows: DataFrame) -> DataFrame:
    return checked_rows.filter(F.col("cause").isNotNull()).select(*schema.REJECT.names)
