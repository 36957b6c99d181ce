"""Exact deduplication by Grace hashing.

Texts are equal when they are identical after each run of white space is replaced by one space; null
counts as empty. Of equal texts the row with the smallest id stays (null ids last, then the earlier
row), also where an id repeats.

1. Every map task collapses its equal texts in an open-addressing table of bounded content, so that
   a text with any number of copies leaves a task once per full table. Members and
   representatives are written once.
2. Representatives are partitioned by their hash into buckets, and buckets over ``bucket_bytes`` of
   distinct content again by the next digits of the hash, until each fits. A bucket of a single hash is
   as small as it gets. Shuffle files are the spill files of the method.
3. Each bucket goes through an open-addressing table that compares complete contents, streamed, with
   one copy of each content in memory.
4. Members find their representative's result by a join on its number, on narrow rows.

Empty input gives an empty result. Other columns are ignored, whatever their names. Texts are compared and written whole,
however long: the tasks that collapse and compare one hold it as a value, so Spark's limit of 2 GB a value is the only one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txrisk.llm.common import SPACE, numbered, partitions, staged, whole

BUCKET_BYTES = 64 << 20
TABLE_BYTES = 32 << 20
TABLE_ROWS = 100_000

STAGED = pa.schema([
    ("row", pa.int64()), ("id", pa.int64()), ("rep", pa.int64()), ("h", pa.int64()),
    ("size", pa.int64()), ("n", pa.int64()), ("first_id", pa.int64()), ("first_row", pa.int64()),
    ("text", pa.string()),
])
STAGED_SQL = (
    "row long, id long, rep long, h long, size long, n long, first_id long, first_row long, text string"
)
FOUND = pa.schema([
    ("rep", pa.int64()), ("keep_row", pa.int64()), ("keep_id", pa.int64()),
    ("group_size", pa.int64()), ("text_sha256", pa.string()),
])
FOUND_SQL = "rep long, keep_row long, keep_id long, group_size long, text_sha256 string"


class OpenTable:
    """Open addressing with linear probing; equal means equal hashes and equal complete contents."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def place(self, h: int, content: bytes) -> int:
        """The number of the content, in order of arrival."""
        mask = len(self.slots) - 1
        at = h & mask
        while (found := self.slots[at]) >= 0:
            if self.hashes[found] == h and self.contents[found] == content:
                return found
            at = (at + 1) & mask
        self.slots[at] = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        if 2 * len(self.hashes) > len(self.slots):
            self._grow()
        return len(self.hashes) - 1

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for number, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = number


def first(a: tuple, b: tuple) -> tuple:
    """The smaller of two (id, row), null ids last."""
    return min(a, b, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members with their representative; a representative carries text, count and first member."""
    held, members, reps, size = OpenTable(), [], [], 0

    def flush() -> pa.RecordBatch:
        rows = []
        for row, key, number in members:
            rep, n, (first_id, first_row) = reps[number]
            own = row == rep
            rows.append((
                row, key, rep, held.hashes[number] if own else None,
                len(held.contents[number]) if own else None, n if own else None,
                first_id if own else None, first_row if own else None,
                held.contents[number].decode() if own else None,
            ))
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, STAGED, strict=True)], schema=STAGED
        )

    for batch in batches:
        for row, key, h, text in zip(*(batch.column(c).to_pylist() for c in ("row", "id", "h", "text")), strict=True):
            content = text.encode()
            number = held.place(h, content)
            if number == len(reps):
                reps.append((row, 1, (key, row)))
                size += len(content)
            else:
                rep, n, leader = reps[number]
                reps[number] = rep, n + 1, first(leader, (key, row))
            members.append((row, key, number))
            if size >= TABLE_BYTES or len(members) >= TABLE_ROWS:
                yield flush()
                held, members, reps, size = OpenTable(), [], [], 0
    if members:
        yield flush()


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The result of each representative in one bucket."""
    held, reps, groups = OpenTable(), [], []
    names = ("h", "text", "rep", "n", "first_id", "first_row", "sha")
    for batch in batches:
        for h, text, rep, n, first_id, first_row, sha in zip(
            *(batch.column(c).to_pylist() for c in names), strict=True
        ):
            number = held.place(h, text.encode())
            if number == len(groups):
                groups.append((n, (first_id, first_row), sha))
            else:
                count, leader, sha = groups[number]
                groups[number] = count + n, first(leader, (first_id, first_row)), sha
            reps.append((rep, number))
    rows = [
        (rep, groups[number][1][1], groups[number][1][0], groups[number][0], groups[number][2])
        for rep, number in reps
    ]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), FOUND, strict=True)], schema=FOUND
        )


def bucketed(reps: DataFrame, bucket_bytes: int) -> DataFrame:
    """Adds ``path``, the bucket of each row, such that the distinct content of a bucket fits.

    The first fan-out follows the total size. A bucket that is still too large is partitioned again
    by the next digits of the hash, unless all its rows share one hash.
    """
    spark = reps.sparkSession
    total = reps.agg(F.sum("size")).first()[0] or 0
    fan = max(4 * partitions(spark), 2 * total // bucket_bytes + 1)
    digits = F.col("h")
    path = F.pmod(digits, F.lit(fan)).cast("string")
    reps = reps.withColumn("path", path)
    more = 16
    for level in range(12):
        contents = reps.groupBy("path", "h").agg(F.max("size").alias("size"))
        large = (
            contents.groupBy("path").agg(F.sum("size").alias("held"), F.count("*").alias("hashes"))
            .filter((F.col("held") > bucket_bytes) & (F.col("hashes") > 1)).select("path")
        )
        large = staged(large.withColumn("large", F.lit(True)), f"large-{level}")
        if large.isEmpty():
            break
        # Another seed per level, as the digits of the first are used up.
        nibble = F.pmod(F.xxhash64("h", F.lit(level)), F.lit(more)).cast("string")
        reps = reps.join(large, "path", "left").withColumn(
            "path", F.when(F.col("large"), F.concat_ws(".", "path", nibble)).otherwise(F.col("path"))
        ).drop("large")
    return reps


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: row, id, keep_row, keep_id, group_size, text_sha256.

    ``row_col`` numbers the rows uniquely; without it, numbers are given here.
    """
    text = F.regexp_replace(whole(text_col), f"{SPACE}+", " ")
    keyed = docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).cast("long").alias("row"),
        F.col(id_col).cast("long").alias("id"), text.alias("text"),
    ).withColumn("h", F.xxhash64("text"))
    members = staged(keyed.mapInArrow(collapse, STAGED_SQL), "exact-members")
    reps = members.filter(F.col("n").isNotNull())
    reps = bucketed(reps.select("rep", "h", "size", "n", "first_id", "first_row", "text"), bucket_bytes)
    found = (
        reps.withColumn("sha", F.sha2("text", 256)).drop("size")
        .groupBy("path").applyInArrow(compare, FOUND_SQL)
    )
    return members.select("row", "id", "rep").join(found, "rep").drop("rep")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    return assign(docs, id_col, text_col).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    rows, row = numbered(docs, "exact-docs")
    keep = assign(rows, id_col, text_col, row).filter(F.col("row") == F.col("keep_row"))
    return rows.join(keep.select(F.col("row").alias(row)), row, "left_semi").select(*docs.columns)
