"""Category indices and the feature vector."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from txrisk import values as V
from txrisk.session import work_dir

INDEX_SUFFIX = "_idx"
NUMERIC_FEATURES = ("userId", "amount_log")

# An indexer keeps every distinct value of a column on the driver and in each task, and a tree needs a bin
# for each. A fit on a column with more than this many is refused; the index itself has no limit.
MOST_FITTED = 10_000
# Most frequent values of a column that are broadcast, and shares that their rows are dealt into.
HOT = 1000
SPREAD = 1 << 20


def feature_columns(categories: tuple[str, ...] = V.CATEGORIES) -> list[str]:
    return [*NUMERIC_FEATURES, *(c + INDEX_SUFFIX for c in categories)]


def category_counts(rows: DataFrame, categories: tuple[str, ...] = V.CATEGORIES) -> DataFrame:
    """(column, value, n) of the values that are not null, counted before the shuffle."""
    pairs = F.explode(
        F.array(*(
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in categories
        ))
    )
    return (
        rows.select(pairs.alias("pair")).select("pair.*")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def category_index(rows: DataFrame, categories: tuple[str, ...] = V.CATEGORIES) -> DataFrame:
    """(column, value, index): all values by falling frequency, ties alphabetical, counted from 0.

    The distinct values are sorted into ranges and written; each range numbers its own rows and adds the
    rows of the ranges before it, so no column is ranked in one task.
    """
    ranged = category_counts(rows, categories).repartitionByRange("column", F.desc("n"), "value")
    path = work_dir(rows.sparkSession, "category-ranges")
    ranged.withColumn("part", F.spark_partition_id()).write.parquet(path)
    written = rows.sparkSession.read.parquet(path)
    parts = written.groupBy("column", "part").agg(F.count(F.lit(1)).alias("held"))
    earlier = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("column", "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("column", "part").orderBy(F.desc("n"), F.asc("value"))
    return written.withColumn("place", F.row_number().over(order)).join(offsets, ["column", "part"]).select(
        "column", "value", (F.col("before") + F.col("place") - 1).cast("double").alias("index")
    )


def with_category_index(rows: DataFrame, index: DataFrame, categories: tuple[str, ...] = V.CATEGORIES) -> DataFrame:
    """Adds each category's index by joins with a written index table: any number of values, none on the driver.

    A value that is not in the table, and a missing one, gets the index after the last. The ``HOT`` most frequent values of a
    column are looked up in a broadcast of so many rows at most; rows that found theirs are spread over all tasks of the
    second join, and of the other values none has more than one in ``HOT`` of the rows the index was made from. The planner
    broadcasts the second table, too, below its threshold.
    """
    for column in categories:
        own = index.filter(F.col("column") == column)
        size = F.coalesce(own.agg(F.max("index") + 1).scalar(), F.lit(0.0))
        hot = own.filter(F.col("index") < HOT).select(F.col("value").alias("_hot"), F.col("index").alias("_hot_index"))
        cold = own.filter(F.col("index") >= HOT).select(
            F.col("value").alias("_cold"), F.col("index").alias("_cold_index"), F.lit(0).alias("_spread")
        )
        names, text = rows.columns, F.col(column).cast("string")
        found = rows.join(F.broadcast(hot), text == F.col("_hot"), "left")
        searched = F.col("_hot_index").isNull() & text.isNotNull()
        salt = 1 + F.pmod(F.xxhash64(*(F.col(c) for c in names)), F.lit(SPREAD))
        found = found.withColumn("_key", F.when(searched, text).otherwise("")).withColumn(
            "_salt", F.when(searched, F.lit(0)).otherwise(salt.cast("int"))
        ).join(cold, (F.col("_key") == F.col("_cold")) & (F.col("_salt") == F.col("_spread")), "left")
        rows = found.select(
            *names, F.coalesce("_hot_index", "_cold_index", size).alias(column + INDEX_SUFFIX)
        )
    return rows


def fit_category_indexers(rows: DataFrame, categories: tuple[str, ...] = V.CATEGORIES,
                          most: int = MOST_FITTED) -> list[StringIndexerModel]:
    """One indexer per category column; unseen and null values share the index after the last.

    The labels are those a ``StringIndexer`` with ``frequencyDesc`` would learn. A column with more than
    ``most`` is an error, raised before any label is collected. (A single model for several columns
    cannot be built from label lists of unequal length.)
    """
    index = category_index(rows, categories)
    for column, n in index.groupBy("column").count().collect():
        if n > most:
            raise ValueError(f"{n} distinct values to index in {column}, more than {most}")
    table = index.orderBy("index").collect()
    return [
        StringIndexerModel.from_labels(
            [r["value"] for r in table if r["column"] == c],
            inputCol=c, outputCol=c + INDEX_SUFFIX, handleInvalid="keep",
        )
        for c in categories
    ]


def assembler(categories: tuple[str, ...] = V.CATEGORIES) -> VectorAssembler:
    """Packs the five slots into ``features``; a null or NaN number is an error, see ``messages``."""
    return VectorAssembler(
        inputCols=feature_columns(categories), outputCol="features", handleInvalid="error"
    )


def with_features(rows: DataFrame, indexers: list[StringIndexerModel]) -> DataFrame:
    for indexer in indexers:
        rows = indexer.transform(rows)
    return assembler().transform(rows)


def feature_slots(rows: DataFrame) -> DataFrame:
    """The feature vector spread over one column per slot, named after its source."""
    slots = vector_to_array("features")
    return rows.withColumn("slots", slots).select(
        "transactionId",
        *(F.col("slots")[i].alias("f_" + name) for i, name in enumerate(feature_columns())),
    )
