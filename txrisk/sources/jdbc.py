"""Relational tables. URL, user, password and driver come from the caller, never from here."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from txrisk import values as V


def read_properties(path: str | None) -> dict[str, str]:
    if path is None:
        return {}
    with open(path, encoding="utf-8") as file:
        return {str(k): str(v) for k, v in json.load(file).items()}


def append_table(rows: DataFrame, url: str, properties: dict[str, str],
                 table: str = V.PREDICTIONS_TABLE) -> None:
    """Appends, creating the table if needed. Each partition is one transaction of its own."""
    rows.write.mode("append").jdbc(url, table, properties=properties)


def read_table(spark: SparkSession, url: str, properties: dict[str, str], partition_column: str,
               lower: int, upper: int, partitions: int, table: str = V.PREDICTIONS_TABLE) -> DataFrame:
    """The table as a DataFrame; filters and column choice are pushed into the database.

    The bounds of the numeric partition column only shape the parts, they leave no row out. They are
    required, as the table would otherwise come through one task.
    """
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=properties,
    )
