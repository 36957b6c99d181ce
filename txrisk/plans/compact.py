"""Compaction job: few large files in place of the many folders of finished micro-batches.

    python -m txrisk.plans.compact --tables /serving

Run it now and then beside the scoring job, one at a time. It touches only blocks that the stream has left.
"""

from __future__ import annotations

import argparse

from txrisk.session import get_spark
from txrisk.streaming.scoring import ServingTables


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--tables", required=True, help="folder of the serving tables")
    options = parser.parse_args()
    merged = ServingTables(options.tables).compact(get_spark("txrisk-compact"))
    for name, blocks in merged.items():
        print(f"{name}: {len(blocks)} blocks merged")


if __name__ == "__main__":
    main()
