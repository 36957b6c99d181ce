"""Phrase collocations by set-oriented mining (SETM) on sorted occurrence relations.

Per language, the phrases of 2 to ``longest`` words that occur ``least`` times or more, scored by their weakest cut: a phrase that
occurs ``a`` times, whose first words occur ``l`` times and the rest ``r`` times among ``n`` words, scores ``1000 a n / (l r)`` there.

1. Each task reads its documents into blocks of words and persists them: the occurrences of a block, sorted by piece and position,
   as one packed list of word numbers with a zero between pieces, and the block's different words with their counts.
2. Group-count: counts are added up per word over all blocks, and words with ``least`` or more stay. All counts are combined per block
   before they are shuffled, so the commonest word is a row per block, not per occurrence. A group's id is the place of its
   first member, a block and a number there; it needs no join to get back to the members.
3. Semi-join: each block gets the ids of its own frequent groups, packed, drops all other occurrences, and persists what is left.
4. Merge-join: as a block's occurrences are sorted and lie together, those of equal piece and adjacent position are neighbours in its
   list; every two neighbours are an occurrence of a phrase one word longer, made of two ids that overlap in all but one word.
   The block persists its different pairs with their counts, packed by a hash of the pair, and 2 to 4 are repeated.

A longer phrase is so only ever counted where both its parts are frequent, which is exact, as no phrase occurs more often than
its parts. Ids name groups, they are no hashes, so equal means equal. A block holds about ``BLOCK`` words whatever the input's size, and
never more than that and one document; counting words sorts rows and can spill, pairs are counted per bucket, on average of at most
``BUCKET`` words; nothing else is held whole, and the driver holds
nothing but the number of words. Counts of first and last parts are carried along as phrases grow, and scores are exact (38 digits).

Phrases that lie in a longer one with ``share`` percent of their count or more are dropped; one word longer is enough to look at, as
counts never grow with length. Each language's best are ranked in salted shares first, so a language that a third of all phrases
have is spread over many tasks.

Letters A to Z are lowered; pieces end at ``. , ; : ! ?`` and U+000A to U+000D, words are separated by space and tab. A null text is empty, a null
language is ``und``; empty texts have no words. Repeated rows count each for itself. Ties are ordered by count, then by the
phrase's bytes; a cut that ties with another gives way to the earlier one. No rows give none. Very long texts are read in
parts. Only text and language are read, whatever other columns are called.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from txrisk.llm.common import discard, partitions, shuffles_deleted, staged, staged_at

LEAST = 100
LONGEST = 5
SHARE = 100
TOP = 2000
UNKNOWN = "und"
# Words of a block, and different ones after which it ends early.
BLOCK = 1 << 21
DIFFERENT = 1 << 18
# Bytes of a text that are split at a time, rows handed on at a time.
TEXT_BYTES = 1 << 22
ROWS = 1 << 16
SALTS = 32
SEPARATORS = b".,;:!?\n\v\f\r"
# All separators as one, which cannot be part of a word.
ONE_SEPARATOR = bytes.maketrans(SEPARATORS, b"." * len(SEPARATORS))
BLANK = re.compile(rb"[ \t]")
# A block is its task and a number there; a place is a block and a number of one of its groups.
BLOCK_BITS = 11
PLACE_BITS = 29
# Words per packed bucket of pairs, and the most buckets.
BUCKET = 1 << 20
MOST_BUCKETS = 1 << 16
# Members of frequent groups that a task sorts by block at a time.
HELD = 1 << 19
# Pairs of a row, and how relations are written: Spark reads up to 4096 rows of a row group at once, however long they are.
PAIRS_OF_ROW = 1 << 12
WRITTEN = {"compression": "zstd", "parquet__block__size": str(1 << 24)}
WORDS = "block long, code int, lang string, word string, n long, data binary"
PAIRS = "block long, bucket int, base long, data binary"
PAIR_FIELDS = [("block", pa.int64()), ("bucket", pa.int32()), ("base", pa.int64()), ("data", pa.binary())]
MEMBERS = "block long, left long, right long, gid long, own boolean, a long"
KNOWN = "of_block long, data binary"


class Numbers(dict):
    """Numbers of one language's words in a block; the separator is zero."""

    def __init__(self, numbers: Iterator[int]) -> None:
        super().__init__({b".": 0})
        self.numbers = numbers

    def __missing__(self, word: bytes) -> int:
        number = self[word] = next(self.numbers)
        return number


class Block:
    """Occurrences of a task's next documents, and the numbers of their words."""

    def __init__(self) -> None:
        self.numbers = count(1)
        self.langs: dict[str, Numbers] = {}
        self.parts: list[np.ndarray] = []
        self.held = 0

    def add(self, lang: str, text: memoryview) -> None:
        if lang not in self.langs:
            self.langs[lang] = Numbers(self.numbers)
        number, start = self.langs[lang].__getitem__, 0
        while start < len(text):
            blank = BLANK.search(text, start + TEXT_BYTES)
            end = blank.start() if blank else len(text)
            words = bytes(text[start:end]).lower().translate(ONE_SEPARATOR).replace(b".", b" . ").split()
            self.parts.append(np.fromiter(map(number, words), np.int32))
            self.held += len(words)
            start = end
        self.parts.append(np.zeros(1, np.int32))
        self.held += 1

    def full(self) -> bool:
        return self.held >= BLOCK or sum(map(len, self.langs.values())) >= DIFFERENT

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        codes = np.concatenate(self.parts)
        counts = np.bincount(codes)
        names = ["block", "code", "lang", "word", "n", "data"]
        yield pa.RecordBatch.from_arrays([
            pa.array([block], pa.int64()), pa.array([0], pa.int32()), *(pa.nulls(1, pa.string()) for _ in range(2)),
            pa.nulls(1, pa.int64()), pa.array([packed(separated(codes))], pa.binary()),
        ], names=names)
        for lang, numbers in self.langs.items():
            words, found = list(numbers)[1:], np.array(list(numbers.values())[1:], np.int32)
            for at in range(0, len(words), ROWS):
                some = found[at:at + ROWS]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(some), block)), pa.array(some), pa.array([lang] * len(some)),
                    pa.array(words[at:at + ROWS], pa.binary()).cast(pa.string()), pa.array(counts[some].astype(np.int64)),
                    pa.nulls(len(some), pa.binary()),
                ], names=names)


def separated(codes: np.ndarray) -> np.ndarray:
    """Without zeros after a zero: several separate no better than one."""
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    return codes[keep]


def packed(codes: np.ndarray, ids: np.ndarray | None = None) -> bytes:
    """A relation: the ids its codes stand for, none for the first, and the codes; compressed byte by byte of their numbers."""
    ids = np.zeros(0, np.int64) if ids is None else ids
    head = np.array([len(ids), len(codes)], "<i8").tobytes()
    body = b"".join(part.reshape(-1, 1).view(np.uint8).T.tobytes() for part in (ids.astype("<i8"), codes.astype("<i4")))
    return head + pa.compress(body, "zstd", asbytes=True)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The codes and their ids."""
    n_ids, n_codes = np.frombuffer(data, "<i8", 2).tolist()
    body = np.frombuffer(pa.decompress(data[16:], 8 * n_ids + 4 * n_codes, "zstd"), np.uint8)
    ids = np.ascontiguousarray(body[:8 * n_ids].reshape(8, n_ids).T).view("<i8").ravel()
    return np.ascontiguousarray(body[8 * n_ids:].reshape(4, n_codes).T).view("<i4").ravel(), ids


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << BLOCK_BITS
    block = Block()
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = pc.fill_null(batch.column("text"), b"")
        for at, lang in enumerate(langs):
            block.add(lang, memoryview(texts[at].as_buffer()))
            if block.full():
                yield from block.rows(number)
                number, block = number + 1, Block()
    if block.parts:
        yield from block.rows(number)


def semi_joined(codes: np.ndarray, ids: np.ndarray, frequent: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """The relation of a block's frequent groups: words from the codes themselves, longer ones from pairs of neighbours."""
    left, right, gids = frequent
    if words:
        wanted, known = codes.astype(np.int64), left
    else:
        most = len(ids) + 1
        first, second = codes[:-1].astype(np.int64), codes[1:]
        wanted = np.where((first > 0) & (second > 0), first * most + second, 0)
        known = (np.searchsorted(ids, left) + 1) * most + np.searchsorted(ids, right) + 1
    by_id, order = np.argsort(gids), np.argsort(known)
    number = np.empty(len(gids), np.int32)
    number[by_id] = np.arange(1, len(gids) + 1)
    known, number = known[order], number[order]
    found = np.zeros(len(wanted), np.int32)
    for start in range(0, len(wanted), ROWS):
        some = wanted[start:start + ROWS]
        at = np.minimum(np.searchsorted(known, some), len(known) - 1)
        found[start:start + ROWS] = np.where(known[at] == some, number[at], 0)
    return separated(found), gids[by_id]


def bucket_of(left: np.ndarray, right: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (right.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return (((mixed >> np.uint64(33)) * np.uint64(0x165667B1)) >> np.uint64(20)) % np.uint64(buckets)


def merge_joined(block: int, codes: np.ndarray, ids: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The different pairs of neighbours with counts, in rows of one bucket each; their numbers in the block go on from row to row."""
    first, second = codes[:-1].astype(np.int64), codes[1:]
    adjacent = (first > 0) & (second > 0)
    pairs, counts = np.unique(first[adjacent] * (len(ids) + 1) + second[adjacent], return_counts=True)
    left, right = (ids[p - 1] for p in np.divmod(pairs, len(ids) + 1))
    bucket = bucket_of(left, right, buckets)
    order = np.argsort(bucket, kind="stable")
    left, right, counts, bucket = left[order], right[order], counts[order].astype(np.int64), bucket[order]
    cut = np.arange(len(bucket)) % PAIRS_OF_ROW == 0
    starts = np.nonzero(cut | (np.diff(bucket, prepend=np.uint64(buckets)) != 0))[0]
    ends = pa.array(np.append(starts, len(bucket)), pa.int32())
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(starts), block)), pa.array(bucket[starts].astype(np.int32)), pa.array(starts),
        *(pa.ListArray.from_arrays(ends, pa.array(c)) for c in (left, right, counts)),
    ], names=["block", "bucket", "base", "lefts", "rights", "ns"])


def packed_rows(pairs: pa.RecordBatch) -> pa.RecordBatch:
    """The rows of ``merge_joined`` with their lists as one value each."""
    ends = pairs.column("lefts").offsets.to_numpy()
    columns = [pairs.column(c).values.to_numpy() for c in ("lefts", "rights", "ns")]
    data = [packed_pairs(*(c[start:end] for c in columns)) for start, end in zip(ends, ends[1:], strict=False)]
    fields = [pairs.column(c) for c in ("block", "bucket", "base")]
    return pa.RecordBatch.from_arrays([*fields, pa.array(data, pa.binary())], schema=pa.schema(PAIR_FIELDS))


def packed_pairs(left: np.ndarray, right: np.ndarray, numbers: np.ndarray) -> bytes:
    """Pairs and their counts or ids; the left ids rise and are kept as steps. Compressed byte by byte of the numbers."""
    columns = np.stack([np.diff(left, prepend=0), right, numbers]).astype("<i8")
    body = columns.reshape(-1, 1).view(np.uint8).T.tobytes()
    return np.array([len(left)], "<i8").tobytes() + pa.compress(body, "zstd", asbytes=True)


def unpacked_pairs(data: bytes) -> np.ndarray:
    """The left ids, right ids and counts or ids as three rows."""
    n = int(np.frombuffer(data, "<i8", 1)[0])
    body = np.frombuffer(pa.decompress(data[8:], 24 * n, "zstd"), np.uint8)
    columns = np.ascontiguousarray(body.reshape(8, 3 * n).T).view("<i8").reshape(3, n)
    columns[0] = np.cumsum(columns[0])
    return columns


def count_pairs(bucket: pa.Table) -> pa.Table:
    """A bucket's pairs, a row per block that has them, with the pair's count ``a`` and id, as ``counted`` gives words."""
    bucket = bucket.sort_by([("block", "ascending"), ("base", "ascending")])
    parts = [unpacked_pairs(data) for data in bucket.column("data").to_pylist()]
    sizes = [part.shape[1] for part in parts]
    left, right, n = np.concatenate(parts, axis=1)
    del parts
    block, base = (np.repeat(bucket.column(c).to_numpy(), sizes) for c in ("block", "base"))
    place = (block << PLACE_BITS) + base + np.arange(len(n)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    del base
    # Places rise and the sort is stable: the first of equal pairs has the smallest.
    order = np.lexsort((right, left))
    own = np.ones(len(order), bool)
    own[1:] = (np.diff(left[order]) != 0) | (np.diff(right[order]) != 0)
    starts = np.nonzero(own)[0]
    held = np.diff(np.append(starts, len(order)))
    counts = np.repeat(np.add.reduceat(n[order], starts), held)
    members = pa.table({
        "block": block[order], "left": left[order], "right": right[order], "gid": np.repeat(place[order[starts]], held), "own": own,
        "a": counts,
    })
    del left, right, n, block, place, order, own, counts
    # Or the pool keeps the largest bucket's room beside what comes next in this worker.
    pa.default_memory_pool().release_unused()
    return pa.Table.from_batches(members.to_batches(ROWS))


def packed_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of frequent groups for the blocks that have them: a row per block for every ``HELD`` members of a task."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= HELD:
            yield by_block(held)
            held, n = [], 0
    if n:
        yield by_block(held)


def by_block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    block, left, right, gid = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("block", "left", "right", "gid"))
    order = np.lexsort((right, left, block))
    block, left, right, gid = block[order], left[order], right[order], gid[order]
    starts = np.nonzero(np.diff(block, prepend=-1))[0]
    ends = np.append(starts[1:], len(block))
    data = [packed_pairs(left[start:end], right[start:end], gid[start:end]) for start, end in zip(starts, ends, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(block[starts]), pa.array(data, pa.binary())], names=["of_block", "data"])


def grow(words: bool, last: bool, buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Per block: its relation of frequent groups, unless it is the last, and the counted pairs of neighbours in it."""
    def run(relation: pa.Table, frequent: pa.Table) -> pa.Table:
        found = [pa.RecordBatch.from_pylist([], pa.schema(PAIR_FIELDS))]
        if relation.num_rows and frequent.num_rows:
            block = relation.column("block")[0].as_py()
            members = np.concatenate([unpacked_pairs(data) for data in frequent.column("data").to_pylist()], axis=1)
            codes, ids = semi_joined(*unpacked(relation.column("data")[0].as_py()), members, words)
            if not last:
                row = {"block": block, "bucket": -1, "data": packed(codes, ids)}
                found.append(pa.RecordBatch.from_pylist([row], pa.schema(PAIR_FIELDS)))
            found.append(packed_rows(merge_joined(block, codes, ids, buckets)))
        return pa.Table.from_batches(found)
    return run


def counted(members: DataFrame, key: list[str], least: int) -> DataFrame:
    """The members of frequent groups: a row per block that has them, with the group's count ``a`` and id.

    The id is the smallest place of a member; that member alone has ``own``, and stands for the group.
    """
    same = Window.partitionBy(*key)
    rows = members.withColumn("a", F.sum("n").over(same)).withColumn("gid", F.min("place").over(same))
    return rows.filter(F.col("a") >= least).withColumn("own", F.col("place") == F.col("gid"))


def place(number: Column) -> Column:
    return F.shiftleft("block", PLACE_BITS) + number


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                     longest: int = LONGEST) -> tuple[list[DataFrame], DataFrame]:
    """By length from 1, the frequent phrases: gid, lang, phrase, last word, count a, the counts of their first parts and of the
    rests, and for longer ones left and right, the groups they are made of. Beside them, the words ``n`` per language.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col(text_col).cast("string").cast("binary").alias("text"),
    )
    with shuffles_deleted(docs.sparkSession):
        return grown_phrases(rows, least, longest)


def grown_phrases(rows: DataFrame, least: int, longest: int) -> tuple[list[DataFrame], DataFrame]:
    """``frequent_phrases`` of rows of lang and text, null in neither of them but the text."""
    spark = rows.sparkSession
    read, both = staged_at(rows.mapInArrow(read_blocks, WORDS), "phrases-0", **WRITTEN)
    words = read.filter("code > 0")
    totals = staged(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).collect()[0].n
    buckets = min(MOST_BUCKETS, max(partitions(spark), -(-total // BUCKET)))
    # A place holds block and number, which are not shuffled beside it.
    placed = words.select("lang", "word", "n", place(F.col("code")).alias("place"))
    members = staged(
        counted(placed, ["lang", "word"], least).select(
            F.shiftright("place", PLACE_BITS).alias("block"),
            F.col("place").bitwiseAND((1 << PLACE_BITS) - 1).alias("left"), F.lit(0).cast("long").alias("right"), "gid", "own", "a",
            # One member says what the group is.
            *(F.when(F.col("own"), F.col(c)).alias(c) for c in ("lang", "word")),
        ), "phrases-members-1", **WRITTEN,
    )
    # The words have been read for the last time; without them, the first relation is half as large.
    relation, old = staged_at(read.filter("code = 0").select("block", "data"), "phrases-1", **WRITTEN)
    discard(spark, both)
    none = F.array().cast("array<long>")
    found = [members.filter("own").select(
        "gid", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", none.alias("firsts"), none.alias("rests")
    )]
    for length in range(2, longest + 1):
        # Members are shuffled packed by block, not one by one.
        known = members.select("block", "left", "right", "gid").mapInArrow(packed_members, KNOWN)
        grown, folder = staged_at(
            relation.select("block", "data").groupBy("block").cogroup(known.groupBy("of_block"))
            .applyInArrow(grow(length == 2, length == longest, buckets), PAIRS),
            f"phrases-{length}", **WRITTEN,
        )
        # The relation it came from has been read for the last time.
        discard(spark, old)
        old = folder
        relation = grown.filter("bucket = -1")
        # Pairs are brought together by bucket, packed, and unpacked and counted there.
        pairs = grown.filter("bucket >= 0").repartition(buckets, "bucket")
        members = staged(
            pairs.groupBy("bucket").applyInArrow(count_pairs, MEMBERS).filter(F.col("a") >= least),
            f"phrases-members-{length}", **WRITTEN,
        )
        found.append(staged(spelled(members.filter("own"), found[-1]), f"phrases-frequent-{length}"))
    discard(spark, old)
    return found, totals


def spelled(groups: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases with their words and the counts of their parts, from the two they are made of."""
    first = shorter.select(
        F.col("gid").alias("left"), "lang", F.col("phrase").alias("begin"), F.array_append("firsts", F.col("a")).alias("firsts")
    )
    rest = shorter.select(
        F.col("gid").alias("right"), "last", F.array_prepend("rests", F.col("a")).alias("rests")
    )
    return groups.join(first, "left").join(rest, "right").select(
        "gid", "lang", F.concat_ws(" ", "begin", "last").alias("phrase"), "last", "a", "firsts",
        "rests", "left", "right",
    )


def weakest_cut(words: int) -> Column:
    """Of the cuts of a phrase of so many words that with the lowest score, the earliest of equal ones."""
    def exact(number: Column) -> Column:
        return number.cast("decimal(19,0)")

    cuts = []
    for cut in range(1, words):
        l, r = F.get("firsts", F.lit(cut - 1)), F.get("rests", F.lit(cut - 1))
        score = F.call_function("div", exact(1000 * F.col("a")) * exact(F.col("n")), exact(l) * exact(r))
        cuts.append(F.struct(score.alias("score"), F.lit(cut).alias("cut"), l.alias("l"), r.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 longest: int = LONGEST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n and score."""
    found, totals = frequent_phrases(docs, text_col, lang_col, least, longest)
    scored = []
    for words in range(2, longest + 1):
        phrases = found[words - 1]
        if words < longest:
            longer = found[words]
            most = longer.select(F.col("left").alias("gid"), F.col("a").alias("most")).union(
                longer.select("right", "a")
            ).groupBy("gid").agg(F.max("most").alias("most"))
            phrases = phrases.join(most, "gid", "left").filter(
                F.col("most").isNull() | (100 * F.col("most") < share * F.col("a"))
            )
        scored.append(phrases.join(totals, "lang").select("lang", "phrase", "a", "n", weakest_cut(words).alias("cut")))
    rows = reduce(DataFrame.union, scored).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt")
    )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best)))
    rows = rows.filter(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return rows.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
