"""What runs: the counts of each batch as they are observed, and several queries that stand or fall together."""

from __future__ import annotations

import logging
import threading
from collections import OrderedDict
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from txrisk import schema

OBSERVED = "checked_messages"
# Batches whose counts are kept, and seconds between looks at the queries themselves.
KEPT = 10_000
POLL = 1.0
log = logging.getLogger(__name__)


def observed(checked_rows: DataFrame) -> DataFrame:
    """The same rows; all, accepted and rejected ones are counted as they pass, without a job of their own."""
    cause = F.col("cause")
    return checked_rows.observe(
        OBSERVED, F.count(F.lit(1)).alias("row_count"), F.count_if(cause.isNull()).alias("accepted"),
        F.count_if(cause.isNotNull()).alias("rejected"),
    )


class Watch(StreamingQueryListener):
    """Listens to the streaming queries of a session, from before they start: ``with Watch(spark) as watch``.

    Observed counts are for logs and progress. Parts of a batch that are computed again after an executor was lost are
    counted again; the counts table is what a batch holds.
    """

    def __init__(self, spark: SparkSession, kept: int = KEPT) -> None:
        self.spark = spark
        self.kept = kept
        self.batches: OrderedDict[tuple[str, int], tuple[int, int, int]] = OrderedDict()
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def __enter__(self) -> Watch:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        log.info("query %s started", event.name or event.id)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(OBSERVED)
        if counts is None:
            return
        log.info("batch %d: %s", progress.batchId, counts)
        with self.changed:
            # A batch that is run again replaces its counts.
            self.batches[str(progress.runId), progress.batchId] = (counts["row_count"], counts["accepted"], counts["rejected"])
            while len(self.batches) > self.kept:
                self.batches.popitem(last=False)

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def batch_counts(self, query: StreamingQuery) -> DataFrame:
        """The observed counts of a query's last batches, one row each."""
        run = str(query.runId)
        with self.changed:
            rows = [(batch, *counts) for (of, batch), counts in self.batches.items() if of == run]
        return self.spark.createDataFrame(rows, schema.BATCH_COUNT)

    def await_all(self, queries: Iterable[StreamingQuery]) -> None:
        """Waits until all have ended. The first that fails stops the others, and its error is raised.

        A job that waits like this ends with its first failure, and with an exit code that says so, whichever query
        it was. What the others had committed stays.
        """
        running = {str(q.runId): q for q in queries}
        try:
            while running:
                with self.changed:
                    self.changed.wait_for(lambda: self.ended & running.keys(), POLL)
                for run, query in list(running.items()):
                    if query.isActive:
                        continue
                    del running[run]
                    failure = query.exception()
                    if failure is not None:
                        raise failure
                    with self.changed:
                        # Its last progress comes before the news of its end.
                        self.changed.wait_for(lambda run=run: run in self.ended, 10 * POLL)
        finally:
            for query in running.values():
                query.stop()
