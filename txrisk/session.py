"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
PARTITIONS_PER_CORE = 3
PARTITION_BYTES = 256 << 20
# Beyond this, bookkeeping per pair of tasks costs more than larger partitions do.
MOST_PARTITIONS = 100_000


def get_spark(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's defaults; ``settings`` use ``__`` for the dots in names."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    size_shuffles(spark)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int = 0) -> None:
    """On a cluster, lets shuffles start with enough partitions for the cores and for the input.

    Adaptive execution merges small partitions but does not split all large ones, so the number it
    starts with has to suit the largest shuffle and not the smallest: one of all input, at ``PARTITION_BYTES``.
    Cores are those at start-up, few under dynamic allocation; jobs call this again with what they will read.
    """
    context = spark.sparkContext
    if not context.master.startswith("local"):
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = max(least, PARTITIONS_PER_CORE * context.defaultParallelism, -(-input_bytes // PARTITION_BYTES))
        spark.conf.set(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(min(wanted, MOST_PARTITIONS))
        )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a local session may go without: driver and executors are then one process on one machine,
    and a temporary folder is set as its checkpoint folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="txrisk-")
        context.setCheckpointDir(folder)
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing folder of its own below the shared one."""
    return f"{shared_dir(spark)}/txrisk/{purpose}-{uuid.uuid4().hex}"
