"""One streaming query that checks, scores, explains and serves every message."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from txrisk import schema, values as V
from txrisk.operators import model as classifier
from txrisk.operators.predictions import alerts, stored_rows, with_log_amount
from txrisk.plans import reports
from txrisk.session import work_dir
from txrisk.sources import folders, jdbc
from txrisk.sources.batch_table import (
    BATCH_COLUMN, BLOCK, compact, finished_batches, merged_blocks, read_batch, read_batches, refuse_merged, withdraw_batch,
    write_batch,
)
from txrisk.sources.envelope import accepted, checked, rejected
from txrisk.streaming.watch import observed

# Takes transactions with ``amount`` and ``amount_log``, adds ``prediction``.
Scorer = Callable[[DataFrame], DataFrame]


def model_scorer(model: PipelineModel) -> Scorer:
    return lambda rows: classifier.score(model, rows)


@dataclass(frozen=True)
class ServingTables:
    """The tables a scoring query fills, all below one folder. ``block`` batches are merged at a time.

    A batch's counts are written last and commit it: every table shows committed batches only, so a reader never sees
    predictions without their alerts, figures or counts. Merged predictions are partitioned by the month of their transaction.
    """

    root: str
    block: int = BLOCK

    @property
    def predictions_path(self) -> str:
        return f"{self.root}/{V.PREDICTIONS_TABLE}"

    @property
    def alerts_path(self) -> str:
        return f"{self.root}/alerts"

    @property
    def quarantine_path(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def summaries_path(self) -> str:
        return f"{self.root}/summaries"

    @property
    def leaders_path(self) -> str:
        return f"{self.root}/leaders"

    @property
    def counts_path(self) -> str:
        return f"{self.root}/batch_counts"

    def _committed(self, spark: SparkSession) -> Callable[[int], bool]:
        batches, blocks = finished_batches(spark, self.counts_path), merged_blocks(spark, self.counts_path)
        return lambda batch: batch in batches or batch // self.block in blocks

    def _read(self, spark: SparkSession, path: str, kind: T.StructType) -> DataFrame:
        return read_batches(spark, path, kind, self._committed(spark))

    def predictions(self, spark: SparkSession, days: tuple[date, date] | None = None) -> DataFrame:
        """With ``event_day`` and ``batch_id``; of the first to the last of some ``days``, or all.

        Of merged blocks, those days' months only are read; batches of their own are sorted by day, so the statistics of
        their files tell what can be passed over.
        """
        rows = self._read(spark, self.predictions_path, schema.STORED_PREDICTION)
        if days is None:
            return rows
        first, last = (F.lit(d) for d in days)
        months = F.col(schema.MONTH_COLUMN).between(F.trunc(first, "month"), last)
        return rows.filter(months & F.col(schema.DAY_COLUMN).between(first, last))

    def register(self, spark: SparkSession) -> None:
        """Makes the predictions a view for SQL, under the name of the serving table."""
        rows = self.predictions(spark).select(*schema.PREDICTION.names)
        rows.createOrReplaceTempView(V.PREDICTIONS_TABLE)

    def alerts(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, self.alerts_path, schema.ALERT)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, self.quarantine_path, schema.REJECT)

    def summaries(self, spark: SparkSession) -> DataFrame:
        """The figures of the batches, which the grouped reports add up instead of reading the predictions."""
        return self._read(spark, self.summaries_path, schema.SUMMARY).drop(BATCH_COLUMN)

    def leaders(self, spark: SparkSession) -> DataFrame:
        """The flagged rows that are in the top of their user in their batch or block: those in the top of all are among them."""
        return self._read(spark, self.leaders_path, schema.LEADER).drop(BATCH_COLUMN)

    def batch_counts(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, self.counts_path, schema.BATCH_COUNT)

    def compact(self, spark: SparkSession) -> dict[str, list[int]]:
        """Merges the finished blocks of all tables, the counts last; the numbers of the blocks by path.

        Figures are added up and leaders ranked again, so a merged block holds about as much of them as one batch. Batches
        before the latest committed one are committed as well.
        """
        latest = self.batch_counts(spark).agg(F.max(BATCH_COLUMN)).first()[0]
        if latest is None:
            return {}
        work = work_dir(spark, "merged-leaders")
        tables = {
            self.predictions_path: (schema.STORED_PREDICTION, (schema.MONTH_COLUMN,), None),
            self.alerts_path: (schema.ALERT, (), None),
            self.quarantine_path: (schema.REJECT, (), None),
            self.summaries_path: (schema.SUMMARY, (), reports.add_summaries),
            self.leaders_path: (schema.LEADER, (), lambda rows: reports.leaders(rows, f"{work}/{uuid.uuid4().hex}")),
            self.counts_path: (schema.BATCH_COUNT, (), None),
        }
        merged = {
            path: compact(spark, path, kind, latest, self.block, by, merge) for path, (kind, by, merge) in tables.items()
        }
        folders.delete(spark, work)
        return merged


@dataclass(frozen=True)
class JdbcTarget:
    """A relational copy of the predictions. Appends, so a retried batch may appear twice there.

    With ``with_batch_id`` the rows carry the number of their batch, by which a caller can tell, and
    delete, the first copy of a retried one.
    """

    url: str
    properties: dict[str, str]
    table: str = V.PREDICTIONS_TABLE
    with_batch_id: bool = False


def _counts(summary: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row, from what was written: the batch's figures and the file footers of its rejects. No retry can count twice."""
    def size(rows: DataFrame, n: Column) -> Column:
        return F.coalesce(rows.agg(n).scalar(), F.lit(0))

    return summary.sparkSession.range(1, numPartitions=1).select(
        size(summary, F.sum("row_count")).alias("accepted"), size(quarantine, F.count(F.lit(1))).alias("rejected")
    ).select((F.col("accepted") + F.col("rejected")).alias("row_count"), "accepted", "rejected")


def serve_batch(messages: DataFrame, batch_id: int, scorer: Scorer, tables: ServingTables, **options) -> None:
    """Fills the tables with one micro-batch of messages, see ``serve_checked``."""
    serve_checked(checked(messages), batch_id, scorer, tables, **options)


def serve_checked(rows: DataFrame, batch_id: int, scorer: Scorer, tables: ServingTables,
                  alert_digits: int | None = None, console: bool = False,
                  jdbc_target: JdbcTarget | None = None) -> None:
    """Fills the tables with one micro-batch of checked rows. Running it again gives the same tables.

    Every message is parsed once and every accepted row scored once: the rows are persisted for the two tables they
    go to, and whatever else is needed is read from the written predictions. A batch that is run again is withdrawn
    first and committed last, so that no reader sees a mixture of both runs.
    """
    spark, block = rows.sparkSession, tables.block
    refuse_merged(spark, tables.counts_path, batch_id, block)
    withdraw_batch(spark, tables.counts_path, batch_id, block)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scored = scorer(with_log_amount(accepted(rows)))
        stored = stored_rows(scored).sortWithinPartitions(schema.DAY_COLUMN)
        write_batch(stored, tables.predictions_path, batch_id, block)
        write_batch(rejected(rows), tables.quarantine_path, batch_id, block)
    finally:
        rows.unpersist()

    written = read_batch(spark, tables.predictions_path, schema.STORED_PREDICTION, batch_id, block).select(
        *schema.PREDICTION.names
    )
    write_batch(alerts(written, alert_digits), tables.alerts_path, batch_id, block)
    write_batch(reports.summary(written), tables.summaries_path, batch_id, block)
    work = work_dir(spark, "batch-leaders")
    write_batch(reports.leaders(written, work), tables.leaders_path, batch_id, block)
    folders.delete(spark, work)
    if console:
        first_rows(written).show(V.CONSOLE_ROWS, truncate=False)
    if jdbc_target is not None:
        copied = written.withColumn("batch_id", F.lit(batch_id)) if jdbc_target.with_batch_id else written
        jdbc.append_table(copied, jdbc_target.url, jdbc_target.properties, jdbc_target.table)

    summary = read_batch(spark, tables.summaries_path, schema.SUMMARY, batch_id, block)
    set_aside = read_batch(spark, tables.quarantine_path, schema.REJECT, batch_id, block)
    write_batch(_counts(summary, set_aside), tables.counts_path, batch_id, block)


def first_rows(rows: DataFrame, n: int = V.CONSOLE_ROWS) -> DataFrame:
    """What a console shows of a batch, and one row more to tell whether there are others: by id, so that it is the same each time."""
    return rows.orderBy("transactionId").limit(n + 1)


def start_scoring(messages: DataFrame, scorer: Scorer, tables: ServingTables, checkpoint: str,
                  trigger: dict | None = None, **options) -> StreamingQuery:
    """Starts the scoring query over a stream of (key, value) messages.

    ``checkpoint`` belongs in the shared folder: a restarted query goes on where it stopped.
    ``trigger`` is passed to Spark, such as ``{"availableNow": True}``; by default batches follow one
    another at once. ``options`` go to ``serve_checked``. The batch's counts are observed as it is read, see ``streaming.watch``.
    """

    def serve(batch: DataFrame, batch_id: int) -> None:
        serve_checked(batch, batch_id, scorer, tables, **options)

    writer = observed(checked(messages)).writeStream.foreachBatch(serve).outputMode("append").option(
        "checkpointLocation", checkpoint
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def console_writer(rows: DataFrame, checkpoint: str) -> DataStreamWriter:
    """A console sink of its own for any stream. Scoring shows its rows with ``console=True``."""
    return (
        rows.writeStream.format("console").outputMode("append")
        .option("numRows", V.CONSOLE_ROWS).option("truncate", "false")
        .option("checkpointLocation", checkpoint)
    )
