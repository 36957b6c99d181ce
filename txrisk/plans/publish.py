"""Publishing job: labelled transactions from JSON files to a Kafka topic or to message files.

    python -m txrisk.plans.publish --input /data/labelled --servers host:9092 --topic transactions
"""

from __future__ import annotations

import argparse

from txrisk.session import get_spark
from txrisk.sources.envelope import to_envelope
from txrisk.sources.files import read_json
from txrisk.sources.kafka import write_topic


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="folder of JSON lines")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--topic")
    target.add_argument("--files", help="folder to append Parquet message files to")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    options = parser.parse_args()
    if options.topic and not options.servers:
        parser.error("--topic needs --servers")
    spark = get_spark("txrisk-publish")
    envelopes = to_envelope(read_json(spark, options.input))
    if options.topic:
        write_topic(envelopes, options.servers, options.topic)
    else:
        envelopes.write.mode("append").parquet(options.files)


if __name__ == "__main__":
    main()
