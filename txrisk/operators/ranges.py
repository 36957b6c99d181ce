"""Running totals over a whole table, and what follows from them: average ranks and exact shares.

Nothing here is ordered in one task: rows are sorted into ranges, each range adds up its own rows, and starts from the total
of the ranges before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txrisk.session import work_dir

PART, VALUE = "_range_part", "_range_value"
# Cells of a draw that are counted to find the one in which a share ends.
CELLS = 1 << 16


def with_running_total(rows: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all rows that come earlier in the order.

    The order has to tell rows apart, as equal ones share a range. The sorted rows are written once, so ranges
    and totals are of the same rows whatever is run again.
    """
    spark = rows.sparkSession
    path = work_dir(spark, "ranges")
    ranged = rows.withColumn(VALUE, value).repartitionByRange(*order).withColumn(PART, F.spark_partition_id())
    ranged.write.parquet(path)
    written = spark.read.schema(ranged.schema).parquet(path)
    # One row per range.
    parts = written.groupBy(PART).agg(F.sum(VALUE).alias("held"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    offsets = parts.select(PART, F.coalesce(F.sum("held").over(before), none).alias("before"))
    within = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        written.withColumn(name, F.coalesce(F.sum(VALUE).over(within), none))
        .join(offsets, PART).withColumn(name, F.col(name) + F.col("before")).drop(PART, VALUE, "before")
    )


def average_ranks(rows: DataFrame, measure: str, *counts: str) -> DataFrame:
    """Per value of ``measure`` its number of rows ``n``, and twice their rank by it as ``twice_rank``, ties averaged.

    Ranks run from 1 by rising value; rows without a value have none, and NaN counts as one. Rows are
    combined by value before anything is sorted, so ties need no room. Columns named in ``counts`` are added up.
    """
    values = rows.filter(F.col(measure).isNotNull()).groupBy(measure).agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(c) for c in counts)
    )
    below = with_running_total(values, [F.col(measure).asc()], F.col("n"), "below")
    return below.withColumn("twice_rank", 2 * F.col("below") + F.col("n") + 1).drop("below")


def exact_share(rows: DataFrame, draw: Column, share: float, name: str) -> DataFrame:
    """Adds ``name``, true for exactly ``floor(share * rows + 0.5)`` rows: those with the smallest draws.

    The rows are not sorted. They are written once with a number each, draws in [0, 1) are counted in cells, and only those in the
    cell in which the share ends are put in order. Rows with one draw are told apart by the hash of all their
    columns, equal rows by their numbers, so that any number of rows may share a draw.
    """
    spark = rows.sparkSession
    path = work_dir(spark, "drawn")
    key = F.struct(draw.alias("draw"), F.xxhash64(*rows.columns).alias("hash"), F.monotonically_increasing_id().alias("row"))
    keyed = rows.withColumn("_key", key)
    keyed.write.parquet(path)
    keyed = spark.read.schema(keyed.schema).parquet(path)
    cell = F.floor(F.col("_key.draw") * CELLS)
    # At most as many rows as there are cells.
    cells = sorted((r["cell"], r["n"]) for r in keyed.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect())
    wanted = int(share * sum(n for _, n in cells) + 0.5)
    last, left = -1, 0
    for number, n in cells:
        if wanted < n:
            last, left = number, wanted
            break
        wanted -= n
    else:
        return keyed.drop("_key").withColumn(name, F.lit(True))
    inside = keyed.filter(cell == last).select("_key")
    ordered = with_running_total(inside, [F.col("_key").asc()], F.lit(1).cast("long"), "place")
    limit = ordered.filter(F.col("place") == left).select("_key").scalar()
    return keyed.withColumn(name, (cell < last) | ((cell == last) & (F.col("_key") < limit))).drop("_key")
