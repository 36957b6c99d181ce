"""JSON-lines files of labelled transactions, and files of messages as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from txrisk import schema

# Input of one micro-batch; its parsed rows are kept on the executors while the batch is served.
BATCH_BYTES = 512 * 2**30


def read_json(spark: SparkSession, path: str, infer: bool = False,
              row_schema: T.StructType = schema.LABELLED, keep_unreadable: bool = False) -> DataFrame:
    """JSON lines under the fixed schema, in one pass; ``keep_unreadable`` adds the text of lines with a fault.

    ``infer=True`` lets Spark find the schema, which reads everything once more, sorts the columns
    by name and leaves timestamps as text.
    """
    if infer:
        return spark.read.json(path)
    if keep_unreadable:
        row_schema = T.StructType([*row_schema, T.StructField(schema.CORRUPT_COLUMN, T.StringType())])
    return spark.read.schema(row_schema).option("columnNameOfCorruptRecord", schema.CORRUPT_COLUMN).json(path)


def stream_files(spark: SparkSession, path: str, row_schema: T.StructType = schema.ENVELOPE,
                 batch_bytes: int = BATCH_BYTES, **options) -> DataFrame:
    """Parquet files as a stream; ``path`` is a folder, or a pattern of files or folders.

    A micro-batch takes about ``batch_bytes`` of files (one file at least), so that a long backlog is
    worked off in portions the cluster can hold, however large it is.
    """
    return (
        spark.readStream.schema(row_schema)
        .option("maxBytesPerTrigger", batch_bytes)
        .options(**options)
        .parquet(path)
    )


def write_json(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line; timestamps as ISO text, cut to milliseconds."""
    rows.write.mode(mode).json(path)
