"""Parquet tables filled batch by batch.

Each micro-batch owns the folder ``recent/block=B/batch_id=N``, and writing it again replaces it. A batch that is
retried after a failure therefore leaves the table as if it had run once.

Merged blocks are sorted by batch, and may be partitioned by columns, so that a filter on these reads their folders only. Batches
of their own are not: one with late rows of many days would be as many small files for each task.

A stream that runs for long leaves many small folders. ``compact`` rewrites each block whose batches are all
committed as a few large files in ``merged/block=B``. A finished merge (with its success marker) stands for its
block from then on; its small folders are no longer read, and go in the next run, when queries planned
before the merge are done with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from txrisk.sources import folders

BATCH_COLUMN = "batch_id"
# Batches per block, and about how large the files of a merged block get.
BLOCK = 1000
FILE_BYTES = 256 << 20


def _with_batch(row_schema: T.StructType) -> T.StructType:
    rest = [f for f in row_schema if f.name != BATCH_COLUMN]
    return T.StructType([*rest, T.StructField(BATCH_COLUMN, T.LongType())])


def _recent(path: str, batch_id: int, block: int) -> str:
    return f"{path}/recent/block={batch_id // block}"


def merged_blocks(spark: SparkSession, path: str) -> set[int]:
    """Numbers of the blocks whose merge is finished."""
    return {int(p.split("/")[-2].split("=")[1]) for p in folders.matching(spark, f"{path}/merged/block=*/_SUCCESS")}


def finished_batches(spark: SparkSession, path: str) -> set[int]:
    """Numbers of the batches that have folders of their own and are written to the end."""
    found = folders.matching(spark, f"{path}/recent/block=*/{BATCH_COLUMN}=*/_SUCCESS")
    return {int(p.split("/")[-2].split("=")[1]) for p in found}


def write_batch(rows: DataFrame, path: str, batch_id: int, block: int = BLOCK) -> None:
    """Writes a batch or replaces it. One that has been merged cannot be replaced: an error."""
    refuse_merged(rows.sparkSession, path, batch_id, block)
    rows.drop(BATCH_COLUMN).write.mode("overwrite").parquet(
        f"{_recent(path, batch_id, block)}/{BATCH_COLUMN}={batch_id}"
    )


def refuse_merged(spark: SparkSession, path: str, batch_id: int, block: int = BLOCK) -> None:
    if folders.exists(spark, f"{path}/merged/block={batch_id // block}/_SUCCESS"):
        raise ValueError(f"batch {batch_id} of {path} is merged already; a new stream needs new tables")


def withdraw_batch(spark: SparkSession, path: str, batch_id: int, block: int = BLOCK) -> None:
    """Deletes a batch that is not merged, if it is there."""
    folders.delete(spark, f"{_recent(path, batch_id, block)}/{BATCH_COLUMN}={batch_id}")


def _read_recent(spark: SparkSession, path: str, row_schema: T.StructType, *places: str) -> DataFrame:
    kind = _with_batch(row_schema)
    return spark.read.schema(kind).option("basePath", f"{path}/recent").parquet(
        *(f"{path}/recent/{p}" for p in places)
    ).select(*kind.names)


def read_batches(spark: SparkSession, path: str, row_schema: T.StructType,
                 wanted: Callable[[int], bool] | None = None) -> DataFrame:
    """All batches, each from its merged block or else its own folder, with ``batch_id`` to filter on.

    ``wanted`` tells which of the batches that are not merged are read.
    """
    kind = _with_batch(row_schema)
    merged = {f"block={b}" for b in merged_blocks(spark, path)}
    recent = [b for b in folders.children(spark, f"{path}/recent") if b not in merged]
    if wanted is not None:
        recent = [
            f"{b}/{n}" for b in recent for n in folders.children(spark, f"{path}/recent/{b}")
            if wanted(int(n.removeprefix(f"{BATCH_COLUMN}=")))
        ]
    frames = []
    if recent:
        frames.append(_read_recent(spark, path, row_schema, *recent))
    if merged:
        blocks = sorted(f"{path}/merged/{b}" for b in merged)
        frames.append(
            spark.read.schema(kind).option("basePath", f"{path}/merged").parquet(*blocks).select(*kind.names)
        )
    if not frames:
        return spark.createDataFrame([], kind)
    return frames[0].unionByName(frames[1]) if len(frames) == 2 else frames[0]


def read_batch(spark: SparkSession, path: str, row_schema: T.StructType, batch_id: int,
               block: int = BLOCK) -> DataFrame:
    """One batch that is not merged yet, without listing the others."""
    return (
        spark.read.schema(_with_batch(row_schema)).option("basePath", path)
        .parquet(f"{_recent(path, batch_id, block)}/{BATCH_COLUMN}={batch_id}")
        .filter(F.col(BATCH_COLUMN) == batch_id)
    )


def compact(spark: SparkSession, path: str, row_schema: T.StructType, latest: int, block: int = BLOCK,
            by: tuple[str, ...] = (), merge: Callable[[DataFrame], DataFrame] | None = None) -> list[int]:
    """Merges the blocks whose batches all come before ``latest``, and returns their numbers.

    A stream begins a batch when those before it are committed, so none of these can be retried. The rows are
    sorted by batch, a batch over as many files as it needs, and partitioned ``by`` columns. ``merge`` may put fewer rows in place of a block's; what
    it returns has no ``batch_id`` unless its rows still belong to one.
    """
    done = merged_blocks(spark, path)
    for name in folders.children(spark, f"{path}/recent"):
        if int(name.removeprefix("block=")) in done:
            folders.delete(spark, f"{path}/recent/{name}")
    numbers = []
    for name in folders.children(spark, f"{path}/recent"):
        number = int(name.removeprefix("block="))
        if (number + 1) * block > latest:
            continue
        files = folders.size(spark, f"{path}/recent/{name}") // FILE_BYTES + 1
        rows = _read_recent(spark, path, row_schema, name)
        if merge is not None:
            rows = merge(rows)
        order = [BATCH_COLUMN] if BATCH_COLUMN in rows.columns else []
        spread = F.xxhash64(*(c for c in rows.columns if c != BATCH_COLUMN))
        rows = rows.repartitionByRange(files, *order, spread)
        if by or order:
            rows = rows.sortWithinPartitions(*by, *order)
        rows.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/merged/{name}")
        numbers.append(number)
    return sorted(numbers)
