"""Scoring job: a stream of messages to predictions, alerts and quarantine.

    python -m txrisk.plans.score --servers host:9092 --topic transactions \\
        --model /models/risk --tables /serving --checkpoint /checkpoints/score
"""

from __future__ import annotations

import argparse

from txrisk.operators import model as classifier
from txrisk.session import get_spark, size_shuffles
from txrisk.sources.envelope import checked
from txrisk.sources.files import BATCH_BYTES, stream_files
from txrisk.sources.jdbc import read_properties
from txrisk.sources.kafka import read_topic
from txrisk.streaming.scoring import JdbcTarget, ServingTables, console_writer, model_scorer, start_scoring
from txrisk.streaming.watch import Watch

# A rate, not a cut: what is left waits for the next batch.
BATCH_RECORDS = 50_000_000


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--topic", help="Kafka topic to read")
    source.add_argument("--files", help="folder of Parquet message files to read instead")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--starting-offsets", default="latest")
    parser.add_argument("--batch-records", type=int, default=BATCH_RECORDS,
                        help="most records of the topic per batch")
    parser.add_argument("--batch-bytes", type=int, default=BATCH_BYTES, help="input files per batch, in bytes")
    parser.add_argument("--model", required=True)
    parser.add_argument("--tables", required=True, help="folder of the serving tables")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--interval", help="such as '10 seconds'; default: batch after batch")
    parser.add_argument("--once", action="store_true", help="take what is there, then stop")
    parser.add_argument("--jdbc-url", help="also append the predictions to a relational table")
    parser.add_argument("--jdbc-properties", help="JSON file with its user, password and driver")
    parser.add_argument("--jdbc-batch-id", action="store_true", help="with the number of the batch in each row")
    parser.add_argument("--console", action="store_true", help="show the first rows of each batch")
    parser.add_argument("--console-messages", action="store_true",
                        help="show the first messages of each batch, in a query of its own")
    options = parser.parse_args()
    if options.topic and not options.servers:
        parser.error("--topic needs --servers")
    spark = get_spark("txrisk-score")
    if options.topic:
        messages = read_topic(spark, options.servers, options.topic, options.starting_offsets,
                              maxOffsetsPerTrigger=options.batch_records)
    else:
        size_shuffles(spark, options.batch_bytes)
        messages = stream_files(spark, options.files, batch_bytes=options.batch_bytes)
    trigger = None
    if options.once:
        trigger = {"availableNow": True}
    elif options.interval:
        trigger = {"processingTime": options.interval}
    target = None
    if options.jdbc_url:
        target = JdbcTarget(options.jdbc_url, read_properties(options.jdbc_properties),
                            with_batch_id=options.jdbc_batch_id)
    with Watch(spark) as watch:
        queries = [start_scoring(
            messages, model_scorer(classifier.load(options.model)), ServingTables(options.tables),
            options.checkpoint, trigger, console=options.console, jdbc_target=target,
        )]
        if options.console_messages:
            shown = console_writer(checked(messages), f"{options.checkpoint.rstrip('/')}-console")
            queries.append((shown.trigger(**trigger) if trigger else shown).start())
        watch.await_all(queries)


if __name__ == "__main__":
    main()
