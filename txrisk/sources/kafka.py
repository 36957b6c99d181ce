"""Kafka topics, where Spark's Kafka package is on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def _named(options: dict[str, object]) -> dict[str, str]:
    return {k: str(v) for k, v in options.items()}


def read_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
               **options) -> DataFrame:
    """Stream of a topic's records; ``key`` and ``value`` are what ``envelope`` reads.

    ``maxOffsetsPerTrigger`` among the options bounds a micro-batch. ``starting`` counts for the
    first start only: afterwards the checkpoint knows where to go on.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**_named(options))
        .load()
    )


def write_topic(envelopes: DataFrame, servers: str, topic: str, **options) -> None:
    """Sends every (key, value) row, from the executors."""
    (
        envelopes.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**_named(options))
        .save()
    )


def stream_to_topic(envelopes: DataFrame, servers: str, topic: str, checkpoint: str,
                    **options) -> DataStreamWriter:
    return (
        envelopes.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .options(**_named(options))
    )
