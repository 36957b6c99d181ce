"""Top rows per group, ties kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from txrisk.session import work_dir

# Shares that a group is dealt into, and the names of columns that exist in between only.
SALTS = 32
SALT, PLACE = "_share_salt", "_share_place"


def leading_values(rows: DataFrame, group: str, measure: str, top: int) -> DataFrame:
    """(group, measure, place): the values of ``measure`` that rank in the top of their group.

    Places are those of SQL RANK over the measure descending, nulls first. Numbering rows instead of
    ranking them bounds what leaves each map task at ``top`` rows per group, however large the group
    or its ties; the place of a value is the smallest number one of its copies got.
    """
    order = Window.partitionBy(group).orderBy(F.col(measure).desc_nulls_first())
    return (
        rows.select(group, measure)
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= top)
        .groupBy(group, measure)
        .agg(F.min("place").cast("bigint").alias("place"))
    )


def share_leaders(rows: DataFrame, group: str, measure: str, top: int) -> DataFrame:
    """Rows whose RANK within a salted share of their group is at most ``top``; ties stay.

    The salt hashes the whole row and its input part: equal rows from many parts spread as well, and a
    task that is run again deals its rows out as before.
    """
    salt = F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.lit(SALTS))
    order = Window.partitionBy(group, SALT).orderBy(F.col(measure).desc_nulls_first())
    return (
        rows.withColumn(SALT, salt).withColumn(PLACE, F.rank().over(order))
        .filter(F.col(PLACE) <= top).drop(SALT, PLACE)
    )


def top_ranked(rows: DataFrame, group: str, measure: str, top: int, rank: str, folder: str | None = None) -> DataFrame:
    """Rows whose RANK within their group is at most ``top``, with that rank as a column.

    All rows tied on a place belong to the result, and there may be any number of them. So no task
    gets a whole group: each group is dealt into salted shares, and a row in the top of its group is in
    the top of its share. The leading rows of the shares are pruned before the one large shuffle and
    written, at most ``top`` per share and map task besides ties. The leading values of the groups are
    found among them, and they look up their place. The planner knows the written tables' sizes and
    broadcasts only below its threshold; beyond that it is a sort-merge join, whose hot groups adaptive
    execution splits. Both are written below ``folder``, which the caller may delete when done with the result.
    """
    spark = rows.sparkSession
    folder = folder or work_dir(spark, "top")
    shares, path = f"{folder}/share-leaders", f"{folder}/leading"
    share_leaders(rows, group, measure, top).write.parquet(shares)
    rows = spark.read.parquet(shares)
    leading_values(rows, group, measure, top).write.parquet(path)
    leaders = spark.read.parquet(path).select(
        F.col(group).alias("leader_group"), F.col(measure).alias("leader_measure"),
        F.col("place").alias(rank),
    )
    same = F.col(group).eqNullSafe(F.col("leader_group")) & F.col(measure).eqNullSafe(
        F.col("leader_measure")
    )
    return rows.join(leaders, same).drop("leader_group", "leader_measure")
