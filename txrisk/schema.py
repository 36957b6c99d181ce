"""Row schemas of the tables and messages.

``userId`` is a bigint everywhere, as JSON inference types it: one type through training, streaming
and serving, and no overflow once there are more than 2^31 users.
"""

from pyspark.sql import types as T

_PAYLOAD = [
    T.StructField("transactionId", T.StringType()),
    T.StructField("userId", T.LongType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("location", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
]

CORRUPT_COLUMN = "_corrupt_record"

# Unlabelled transaction, as carried by a message.
TRANSACTION = T.StructType(_PAYLOAD)

# Labelled transaction, the training input.
LABELLED = T.StructType([*_PAYLOAD, T.StructField("label", T.LongType())])

# Message payload plus the slot where the JSON parser leaves text it could not read.
MESSAGE = T.StructType([*_PAYLOAD, T.StructField(CORRUPT_COLUMN, T.StringType())])

# Message envelope: the part of a Kafka record the engine uses.
ENVELOPE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.BinaryType()),
])

# Row of the serving table. ``amount`` is in log units, see ``operators.predictions``.
PREDICTION = T.StructType([
    T.StructField("transactionId", T.StringType()),
    T.StructField("userId", T.LongType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("location", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("fraud_reason", T.StringType()),
])

# The day of the transaction and the first of its month, by which merged predictions are kept apart.
DAY_COLUMN, MONTH_COLUMN = "event_day", "event_month"
STORED_PREDICTION = T.StructType(
    [*PREDICTION, T.StructField(DAY_COLUMN, T.DateType()), T.StructField(MONTH_COLUMN, T.DateType())]
)

# Figures of a batch or of merged ones; they add up.
SUMMARY = T.StructType([
    *(PREDICTION[c] for c in ("prediction", "merchant", "device", "location", "fraud_reason")),
    T.StructField("row_count", T.LongType()),
    T.StructField("amount_sum", T.DoubleType()),
    T.StructField("amount_count", T.LongType()),
])

# Flagged rows among the top of their user in a batch or in merged ones.
LEADER = T.StructType([
    PREDICTION[c] for c in ("transactionId", "userId", "amount", "location", "device", "merchant", "fraud_reason")
])

ALERT = T.StructType([
    T.StructField("transactionId", T.StringType()),
    T.StructField("userId", T.LongType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("fraud_reason", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("body", T.StringType()),
])

REJECT = T.StructType([
    T.StructField("message_key", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("cause", T.StringType()),
])

BATCH_COUNT = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("accepted", T.LongType()),
    T.StructField("rejected", T.LongType()),
])
