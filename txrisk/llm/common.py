"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txrisk.session import work_dir
from txrisk.sources import folders

# White space of all operators, as a Java and RE2 pattern: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
# Spark's setting by which a query's shuffles are deleted when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# The folders staged within the innermost ``scratch``; None outside of any.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(rows: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The rows, written once below the shared folder and read back.

    Cuts lineage, gives each row one value of what is not repeatable (row numbers), and outlives
    any executor.
    """
    return staged_at(rows, purpose, **options)[0]


def staged_at(rows: DataFrame, purpose: str, **options: str) -> tuple[DataFrame, str]:
    """The staged rows and their folder, to be given to ``discard`` when no later step reads them.

    ``options`` are the writer's, with ``__`` for the dots in their names.
    """
    path = work_dir(rows.sparkSession, purpose)
    held = _STAGED.get()
    if held is not None:
        held.append(path)
    rows.write.options(**{name.replace("__", "."): value for name, value in options.items()}).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def discard(spark: SparkSession, folder: str) -> None:
    """Deletes a staged table that nothing lazy refers to any more."""
    folders.delete(spark, folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes the tables that are staged within, when it ends without an error.

    For a step whose result is written before the end: take its folder out of the list, and nothing reads the others
    any more. After an error they stay, as a step that is run again writes folders of its own.
    """
    held: list[str] = []
    token = _STAGED.set(held)
    try:
        yield held
    finally:
        _STAGED.reset(token)
    for path in held:
        discard(spark, path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffles of a write are deleted as it ends, not whenever the driver's memory is next cleaned."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def new_name(rows: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column has it, whatever the case of its letters."""
    taken = {c.lower() for c in rows.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def numbered(rows: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """The rows, staged with a number that no other row has, and the name of that column."""
    name = new_name(rows, "_row")
    return staged(rows.withColumn(name, F.monotonically_increasing_id()), purpose), name


def whole(text: str | Column) -> Column:
    """A text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def sampled(rows: DataFrame, key: str | Column, most: int, total: int | None = None) -> DataFrame:
    """About ``most`` rows at most, chosen by a hash of ``key``; all of them, if there are no more.

    The share taken falls as the table grows, so the sample's size is bounded whatever the input.
    """
    total = rows.count() if total is None else total
    if total <= most:
        return rows
    scale = 1 << 40
    return rows.filter(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(scale)) < int(scale * most / total))
