"""Class balance, class weights, train/test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txrisk import values as V
from txrisk.functions.draws import key_draw
from txrisk.operators.ranges import exact_share


def label_balance(rows: DataFrame, label: str = "label") -> DataFrame:
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def class_counts(rows: DataFrame, label: str = "label") -> DataFrame:
    """One row, one pass: all rows, positives, and the rest (null labels among them)."""
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(label) == 1).alias("positives"),
    ).withColumn("rest", F.col("total") - F.col("positives"))


def with_class_weights(rows: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``weight``: each class gets the other one's share of the rows.

    The counts come from a scalar subquery over the label column alone, so the rows themselves are
    neither joined nor shuffled.
    """
    counts = class_counts(rows, label)
    shares = counts.select(
        F.struct(
            F.try_divide("rest", "total").alias("positive"),
            F.try_divide("positives", "total").alias("rest"),
        )
    ).scalar()
    return rows.withColumn(
        "weight", F.when(F.col(label) == 1, shares["positive"]).otherwise(shares["rest"])
    )


def with_split(rows: DataFrame, draw: Column | None = None, train_share: float = V.TRAIN_SHARE,
               seed: int = V.SPLIT_SEED) -> DataFrame:
    """Adds ``split``: ``train`` where the row's draw is below the share, else ``test``.

    The default draw hashes the transaction id, so a row stays on its side however the data is
    partitioned, re-read or recomputed.
    """
    draw = key_draw(F.col("transactionId"), seed) if draw is None else draw
    return rows.withColumn("split", F.when(draw < train_share, "train").otherwise("test"))


def with_exact_split(rows: DataFrame, draw: Column | None = None, train_share: float = V.TRAIN_SHARE,
                     seed: int = V.SPLIT_SEED) -> DataFrame:
    """Adds ``split`` so that the train side has its share of the rows exactly, rounded half up.

    The rows with the smallest draws are the train side, so a row's side depends on the others; ``with_split`` decides on
    each row alone and meets the share on average.
    """
    draw = key_draw(F.col("transactionId"), seed) if draw is None else draw
    drawn = exact_share(rows, draw, train_share, "_train")
    return drawn.withColumn("split", F.when(F.col("_train"), "train").otherwise("test")).drop("_train")


def with_random_split(rows: DataFrame, train_share: float = V.TRAIN_SHARE, seed: int = V.SPLIT_SEED) -> DataFrame:
    """Adds ``split`` by Spark's own random split. Its result depends on how the rows are partitioned and ordered."""
    sides = rows.randomSplit([train_share, 1.0 - train_share], seed=seed)
    train, test = (side.withColumn("split", F.lit(name)) for side, name in zip(sides, ("train", "test"), strict=True))
    return train.unionByName(test)
