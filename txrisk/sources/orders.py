"""A transactions view over an ``orders`` table (o_orderkey, o_custkey, o_totalprice, o_orderdate).

Attributes and labels are functions of the order key, so the view is the same on any partitioning and
in any engine. ``prediction`` stands in for a model's: a second draw against the rule score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txrisk import schema, values as V
from txrisk.functions.draws import congruential_draw
from txrisk.functions.risk import drawn_label, risk_score
from txrisk.functions.scalars import transaction_id, transaction_number
from txrisk.sources.files import stream_files

# Factor, step and modulus of the label, prediction and split draws.
LABEL_DRAW = (1103515245, 12345, 2**31)
PREDICTION_DRAW = (22695477, 1, 2**32)
SPLIT_DRAW = (1597334677, 7, 2**32)
PRICE_PER_AMOUNT = 50.0


def read_orders(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/orders.parquet")


def stream_orders(spark: SparkSession, folder: str, **options) -> DataFrame:
    """The same table as a stream, file by file.

    Written as a pattern, the path may be one file as well as a folder of files.
    """
    row_schema = read_orders(spark, folder).schema
    return stream_files(spark, f"{folder}/{{orders}}.parquet", row_schema, **options)


def _pick(vocabulary: tuple[str, ...], number: Column) -> Column:
    place = F.pmod(number, F.lit(len(vocabulary))).cast("int") + 1
    return F.element_at(F.array(*map(F.lit, vocabulary)), place)


def _attributes(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    return orders.select(
        transaction_id(key).alias("transactionId"),
        F.col("o_custkey").cast("bigint").alias("userId"),
        (F.col("o_totalprice") / F.lit(PRICE_PER_AMOUNT)).alias("amount"),
        _pick(V.LOCATIONS, key).alias("location"),
        _pick(V.DEVICES, F.expr("o_orderkey div 8")).alias("device"),
        _pick(V.MERCHANTS, F.expr("o_orderkey div 32")).alias("merchant"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        key.alias("key"),
    )


def _drawn(key: Column, draw: tuple[int, int, int]) -> Column:
    return drawn_label(congruential_draw(key, *draw), risk_score())


def transactions(orders: DataFrame) -> DataFrame:
    """Labelled transactions, one per order."""
    label = _drawn(F.col("key"), LABEL_DRAW).cast("bigint")
    return _attributes(orders).withColumn("label", label).select(*schema.LABELLED.names)


def scored_transactions(orders: DataFrame) -> DataFrame:
    """Labelled transactions with the stand-in prediction."""
    return _attributes(orders).withColumns({
        "label": _drawn(F.col("key"), LABEL_DRAW).cast("bigint"),
        "prediction": _drawn(F.col("key"), PREDICTION_DRAW).cast("double"),
    }).select(*schema.LABELLED.names, "prediction")


def with_stand_in_prediction(rows: DataFrame) -> DataFrame:
    """Adds the same ``prediction`` to transactions that only carry their id, as messages do."""
    key = transaction_number(F.col("transactionId"))
    return rows.withColumn("prediction", _drawn(key, PREDICTION_DRAW).cast("double"))


def label_draw() -> Column:
    return congruential_draw(transaction_number(F.col("transactionId")), *LABEL_DRAW)


def split_draw() -> Column:
    return congruential_draw(transaction_number(F.col("transactionId")), *SPLIT_DRAW)
