"""Report job: every report over the predictions table, each to its own folder.

    python -m txrisk.plans.report --tables /serving --output /reports

The predictions come from the serving tables or from their relational copy, split by user.
"""

from __future__ import annotations

import argparse

from txrisk import schema
from txrisk.plans import reports
from txrisk.session import get_spark, size_shuffles
from txrisk.sources import folders
from txrisk.sources.jdbc import read_properties, read_table
from txrisk.streaming.scoring import ServingTables


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    place = parser.add_mutually_exclusive_group(required=True)
    place.add_argument("--tables", help="folder of the serving tables")
    place.add_argument("--jdbc-url", help="database with the relational copy instead")
    parser.add_argument("--jdbc-properties", help="JSON file with its user, password and driver")
    parser.add_argument("--users", type=int, nargs=2, metavar=("LOWEST", "HIGHEST"),
                        help="range of user ids, to split the relational read by")
    parser.add_argument("--parts", type=int, help="parts of the relational read")
    parser.add_argument("--output", required=True)
    options = parser.parse_args()
    if options.jdbc_url and not (options.users and options.parts):
        parser.error("--jdbc-url needs --users and --parts")
    spark = get_spark("txrisk-report")
    if options.jdbc_url:
        prepared = ()
        predictions = read_table(spark, options.jdbc_url, read_properties(options.jdbc_properties),
                                 "userId", *options.users, options.parts)
    else:
        tables = ServingTables(options.tables)
        size_shuffles(spark, folders.size(spark, tables.predictions_path))
        predictions = tables.predictions(spark)
        prepared = tables.summaries(spark), tables.leaders(spark)
    reports.write_all(predictions.select(*schema.PREDICTION.names), options.output, *prepared)


if __name__ == "__main__":
    main()
