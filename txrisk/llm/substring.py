"""Substring deduplication by super-k-mers.

A window is ``window`` consecutive words of one document. Every word that a window covers whose words
also start earlier (smaller id, null ids last; within a document, earlier) is removed; windows are judged on the
input. The minimiser of a window is the smallest hash among its runs of ``gram`` words, so equal windows have
equal minimisers. Consecutive windows with one minimiser travel as one packed string to the minimiser's
bucket, where the windows of all its strings are sorted and all but the first of each run are marked.

What keeps that affordable and even:

- A window can only repeat if its minimiser's gram does. Grams are counted first (8 bytes for each minimiser
  of a document, combined before the shuffle), and only strings whose minimiser occurs again are packed.
- Equal strings of one task collapse before they travel: all but the first are removed whole, as the
  first has the same windows earlier. A text with any number of copies so reaches a bucket once per task.
- Very common grams, such as those of a line that many texts hold, come last in the order of minimisers: a
  window takes one only if all its grams are common. They are counted over all documents, each task passing
  on what it meets ``LOCAL`` times or more; the ``COMMON`` largest are what all tasks are sent. They steer the load only.
- A minimiser that still has over ``crowd`` strings has them dealt out by whole windows, equal ones
  collapsed in the same way. Nothing is dropped.
- A string holds ``MOST_WINDOWS`` windows at most: a longer run of windows with one minimiser, such as that of one
  word repeated, is cut, each part with the words its last window needs. No window is lost or in two parts.
- Texts are hashed in blocks of bytes, and words are told by where they stand, so that one very long text takes a
  worker some sixty bytes a word beside its own. Minimisers are written once, as two later steps read them.

Words are separated by space and U+0009 to U+000D. A null text has no words; texts shorter than a window are
kept as they are. Rows that repeat an id are documents of their own, the earlier row first; minimisers are
gathered by id and text, so any number of rows may share an id or have none. No rows give none.
Only id and text are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from txrisk.llm.common import partitions, staged, whole

WINDOW = 20
GRAM = 8
CROWD = 2_048
HELD_BYTES = 32 << 20
COMMON = 65_536
LEAST_COMMON = 64
LOCAL = 8
LAST = np.uint64(1 << 63)
MOST_WINDOWS = 256
BLOCK_BYTES = 1 << 18

PART = pa.schema([
    ("kind", pa.string()), ("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
    ("h", pa.int64()), ("text", pa.binary()),
])
PART_SQL = "kind string, doc_id long, row long, start long, end long, h long, text binary"
DONE, TEXT, GONE, PACKED = "done", "text", "gone", "packed"

Batches = Iterator[pa.RecordBatch]


def part_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, PART, strict=True)], schema=PART
    )


BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1), modulo 2 ** 64."""
    found = np.ones(1, np.uint64)
    while len(found) < n:
        found = np.concatenate([found, found * np.uint64(pow(base, len(found), 1 << 64))])
    return found


class Grams:
    """Hashes of the runs of words of a text: equal words, equal hashes, whatever stands between them.

    Polynomial hashes, so that a word's is the difference of two prefix sums; no word is touched by itself.
    """

    def __init__(self, common: np.ndarray) -> None:
        self.common = common
        self.up, self.down = powers(BASE, BLOCK_BYTES), powers(BASE_INVERSE, BLOCK_BYTES)

    def words(self, text: bytes) -> np.ndarray:
        """One hash for each word. A word that goes on in the next block adds up, so blocks change no hash."""
        data, found, length = np.frombuffer(text, np.uint8), [], 0
        for at in range(0, len(data), BLOCK_BYTES):
            block = data[at:at + BLOCK_BYTES]
            n = len(block)
            in_word = np.zeros(n + 2, np.int8)
            in_word[1:-1] = ~IS_SPACE[block]
            turns = np.diff(in_word)
            starts, ends = np.nonzero(turns == 1)[0], np.nonzero(turns == -1)[0]
            if not len(starts):
                length = 0
                continue
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((block + np.uint64(1)) * self.up[:n], out=sums[1:])
            value = (sums[ends] - sums[starts]) * self.down[starts]
            # ``length``: bytes of the word that the block before ended in, which the first one here goes on with.
            goes_on = length > 0 and starts[0] == 0
            if goes_on:
                found[-1][-1:] += value[:1] * np.uint64(pow(BASE, length, 1 << 64))
            before = length if goes_on and len(starts) == 1 else 0
            length = before + int(ends[-1] - starts[-1]) if ends[-1] == n else 0
            if len(value) > goes_on:
                found.append(value[int(goes_on):])
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    def __call__(self, text: bytes, gram: int) -> np.ndarray:
        """One hash for each place where ``gram`` words start; those of common grams are above all others."""
        of_words = self.words(text)
        count = len(of_words) - gram + 1
        if count < 1:
            return np.zeros(0, np.uint64)
        of_words ^= of_words >> np.uint64(32)
        value = np.zeros(count, np.uint64)
        for i in range(gram):
            value *= np.uint64(BASE)
            value += of_words[i:i + count]
            value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value >>= np.uint64(1)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, value), len(self.common) - 1)
            value[self.common[at] == value] |= LAST
        return value


class Words:
    """A text with one space between words, and where its words stand in it."""

    def __init__(self, text: bytes) -> None:
        data = np.frombuffer(text, np.uint8)
        space = IS_SPACE[data]
        keep = ~space
        # With each word, the first space after it.
        keep[1:] |= ~space[:-1]
        data = data[keep]
        data[space[keep]] = 32
        if len(data) and data[-1] == 32:
            data = data[:-1]
        self.text = data.tobytes()
        gaps = np.nonzero(data == 32)[0]
        self.starts = np.concatenate([[0], gaps + 1]) if len(data) else gaps
        self.ends = np.append(gaps, len(data)) if len(data) else gaps

    def __len__(self) -> int:
        return len(self.starts)

    def part(self, start: int, end: int) -> bytes:
        return self.text[self.starts[start]:self.ends[end - 1]]

    def without(self, gone: list[tuple[int, int]]) -> tuple[bytes, int]:
        """The words outside the (start, end) of ``gone``, which may overlap, and how many went."""
        left, at, removed = [], 0, 0
        for start, end in sorted(gone):
            if start > at:
                left.append(self.part(at, start))
            removed += max(0, end - max(at, start))
            at = max(at, end)
        if at < len(self):
            left.append(self.part(at, len(self)))
        return b" ".join(left), removed


def frequent(window: int, gram: int) -> Callable[[Batches], Batches]:
    """Minimisers with the number of documents that have them, of those met often in one stretch of a task."""
    def run(batches: Batches) -> Batches:
        hashed, held, size = Grams(np.zeros(0, np.uint64)), [], 0

        def often() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            chosen = counts >= LOCAL
            return pa.RecordBatch.from_arrays(
                [pa.array(values[chosen].view(np.int64)), pa.array(counts[chosen].astype(np.int64))], names=["h", "n"]
            )

        for batch in batches:
            for text in batch.column("text").to_pylist():
                grams = hashed(text, gram)
                if len(grams) > window - gram:
                    held.append(np.unique(runs(grams, window - gram + 1)[0]))
                    size += 8 * len(held[-1])
                if size >= HELD_BYTES:
                    yield often()
                    held, size = [], 0
        if held:
            yield often()
    return run


def common_grams(docs: DataFrame, window: int, gram: int) -> np.ndarray:
    """The hashes of the commonest grams, at most ``COMMON``, sorted."""
    found = docs.select("text").mapInArrow(frequent(window, gram), "h long, n long")
    top = found.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COMMON)
    rows = top.orderBy(F.desc("n"), "h").limit(COMMON).select("h").collect()
    return np.sort(np.array([r["h"] for r in rows], np.int64)).view(np.uint64)


def slid(values: np.ndarray, width: int, choose: np.ufunc) -> np.ndarray:
    """``choose`` over each ``width`` neighbours, by doubling spans."""
    span = 1
    while 2 * span <= width:
        values = choose(values[:-span], values[span:])
        span *= 2
    if span < width:
        rest = width - span
        values = choose(values[:-rest], values[rest:])
    return values


def runs(grams: np.ndarray, per_window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers: their minimisers, first windows, and the windows after their last."""
    least = slid(grams, per_window, np.minimum)
    first = np.concatenate([[0], np.nonzero(least[1:] != least[:-1])[0] + 1])
    return least[first], first, np.append(first[1:], len(least))


def chosen(grams: np.ndarray, per_window: int) -> np.ndarray:
    """The minimisers, one for each place that is the smallest of a window."""
    least = slid(grams, per_window, np.minimum)
    # No window around a place has a smallest above its own; where the largest of them equals it, it is one.
    around = np.zeros(len(least) + 2 * (per_window - 1), np.uint64)
    around[per_window - 1:per_window - 1 + len(least)] = least
    return grams[slid(around, per_window, np.maximum) == grams]


def minimisers(window: int, gram: int, common: np.ndarray) -> Callable[[Batches], Batches]:
    """Per document the distinct minimisers of its windows, each with the number of places it is one at."""
    def run(batches: Batches) -> Batches:
        hashed = Grams(common)
        for batch in batches:
            keys, found, times = [], [], []
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                grams = hashed(text, gram)
                if len(grams) <= window - gram:
                    continue
                values, counts = np.unique(chosen(grams, window - gram + 1), return_counts=True)
                found.append(values)
                times.append(counts)
                keys.append(np.full(len(values), key, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(keys)), pa.array(np.concatenate(found).view(np.int64)),
                    pa.array(np.concatenate(times).astype(np.int64)),
                ], names=["doc_id", "h", "n"])
    return run


class Held:
    """Packed strings of one task with their first place; later equal strings are gone at once."""

    def __init__(self) -> None:
        self.first: dict[bytes, tuple] = {}
        self.size = 0
        self.rows: list[tuple] = []

    def add(self, text: bytes, h: int, place: tuple, length: int) -> None:
        """``place`` is (null id, id, row, start)."""
        known = self.first.get(text)
        if known is None:
            self.first[text] = place, h, length
            self.size += len(text)
            return
        if place < known[0]:
            self.first[text], place = (place, h, length), known[0]
        self.rows.append((GONE, None, place[2], place[3], place[3] + length, None, None))

    def full(self) -> bool:
        return self.size >= HELD_BYTES or len(self.rows) >= 100_000

    def flush(self) -> pa.RecordBatch | None:
        rows = self.rows + [
            (PACKED, None if place[0] else place[1], place[2], place[3], place[3] + length, h, text)
            for text, (place, h, length) in self.first.items()
        ]
        self.first, self.size, self.rows = {}, 0, []
        return part_batch(rows) if rows else None


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def pack(window: int, gram: int, common: np.ndarray) -> Callable[[Batches], Batches]:
    """Documents (doc_id, row, text, hs: their minimisers that repeat) as parts of the staged table."""
    def run(batches: Batches) -> Batches:
        hashed, held, rows, size = Grams(common), Held(), [], 0
        for batch in batches:
            names = ("doc_id", "row", "text", "hs")
            for key, row, text, hs in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                words = Words(text)
                if not hs or len(words) < window:
                    digest = sha256(words.text).hexdigest().encode()
                    rows.append((DONE, key, row, 0, len(words), None, digest))
                else:
                    rows.append((TEXT, key, row, 0, len(words), None, words.text))
                    size += len(words.text)
                    found, first, after = runs(hashed(words.text, gram), window - gram + 1)
                    repeated = np.isin(found.view(np.int64), np.array(hs, np.int64))
                    for i in np.nonzero(repeated)[0].tolist():
                        for start in range(int(first[i]), int(after[i]), MOST_WINDOWS):
                            end = min(start + MOST_WINDOWS, int(after[i])) + window - 1
                            place = key is None, key or 0, row, start
                            held.add(words.part(start, end), signed(int(found[i])), place, end - start)
                        if held.full() and (batch_out := held.flush()):
                            yield batch_out
                if size >= HELD_BYTES or len(rows) >= 10_000:
                    yield part_batch(rows)
                    rows, size = [], 0
        if rows:
            yield part_batch(rows)
        if batch_out := held.flush():
            yield batch_out
    return run


def windows_of(words: list[bytes], window: int) -> list[bytes]:
    return list(map(b" ".join, zip(*(words[i:] for i in range(window)), strict=False)))


def deal_windows(window: int) -> Callable[[Batches], Batches]:
    """Packed strings as one string per window, keyed by the whole window."""
    def run(batches: Batches) -> Batches:
        held = Held()
        for batch in batches:
            names = ("doc_id", "row", "start", "text")
            for key, row, start, text in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                for i, words in enumerate(windows_of(text.split(b" "), window)):
                    place = key is None, key or 0, row, start + i
                    held.add(words, signed(xxhash.xxh3_64_intdigest(words)), place, window)
                if held.full():
                    yield held.flush()
        if batch_out := held.flush():
            yield batch_out
    return run


def repeats(strings: list[tuple[tuple, bytes]], window: int) -> Iterator[tuple[int, int, int]]:
    """(row, start, end) of the words to remove within one bucket, by sorting its windows."""
    strings.sort(key=lambda s: (s[1], s[0]))
    firsts, text = [], None
    for place, now in strings:
        if now == text:
            # The same string stands earlier, with all its windows.
            yield place[2], place[3], place[3] + now.count(b" ") + 1
        else:
            firsts.append((place, now))
            text = now
    found = []
    for number, (place, now) in enumerate(firsts):
        found += [(w, place[:3], place[3] + i, number) for i, w in enumerate(windows_of(now.split(b" "), window))]
    found.sort()
    marked = sorted(
        (number, start) for (before, *_), (w, _, start, number) in zip(found, found[1:], strict=False) if before == w
    )
    at = 0
    while at < len(marked):
        number, start = marked[at]
        end = start + window
        while at + 1 < len(marked) and marked[at + 1][0] == number and marked[at + 1][1] <= end:
            at += 1
            end = marked[at][1] + window
        yield firsts[number][0][2], start, end
        at += 1


def judge(window: int) -> Callable[[Batches], Batches]:
    """The repeats of all buckets of a partition, whose rows come sorted by bucket."""
    def run(batches: Batches) -> Batches:
        bucket, strings, gone = None, [], []
        names = ("h", "doc_id", "row", "start", "text")
        for batch in batches:
            for h, key, row, start, text in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if h != bucket:
                    gone += repeats(strings, window)
                    bucket, strings = h, []
                strings.append(((key is None, key or 0, row, start), text))
            if gone:
                yield ranges_batch(gone)
                gone = []
        gone += repeats(strings, window)
        if gone:
            yield ranges_batch(gone)
    return run


def ranges_batch(ranges: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in zip(*ranges, strict=True)], names=["row", "start", "end"]
    )


def strip(batches: Batches) -> Batches:
    """Documents without their repeats: doc_id, n_words, n_removed, text."""
    for batch in batches:
        rows = []
        names = ("doc_id", "text", "gone")
        for key, text, gone in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            words = Words(text)
            left, removed = words.without([(span["start"], span["end"]) for span in gone or ()])
            rows.append((key, len(words), removed, left.decode()))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=["doc_id", "n_words", "n_removed", "text"],
            )


def key_of() -> Column:
    """What gathers a document's minimisers: equal for rows of equal id and text, whose minimisers are equal.

    Where it is equal for other rows by chance, each is given the other's too, which removes nothing more.
    """
    return F.xxhash64("doc_id", "text")


def repeated_minimisers(docs: DataFrame, window: int, gram: int, common: np.ndarray) -> DataFrame:
    """Per key of a document (``key_of``) the minimisers that occur again somewhere: key, hs."""
    keyed = docs.select(key_of().alias("doc_id"), "text")
    found = keyed.mapInArrow(minimisers(window, gram, common), "doc_id long, h long, n long")
    # Written, as both sides of the next join read them.
    found = staged(found, "substring-minimisers")
    again = found.groupBy("h").agg(F.sum("n").alias("times")).filter("times > 1").select("h")
    return found.select("doc_id", "h").join(again, "h", "left_semi").groupBy("doc_id").agg(
        F.collect_set("h").alias("hs")
    ).withColumnRenamed("doc_id", "key")


def removed_ranges(packed: DataFrame, window: int, crowd: int) -> DataFrame:
    """(row, start, end) of what the buckets of all packed strings remove."""
    spark = packed.sparkSession
    crowded = staged(packed.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > crowd).select("h"),
                     "substring-crowded")
    frames = []
    if not crowded.isEmpty():
        dealt = packed.join(crowded, "h", "left_semi").select("doc_id", "row", "start", "text")
        dealt = staged(dealt.mapInArrow(deal_windows(window), PART_SQL), "substring-windows")
        packed = packed.join(crowded, "h", "left_anti").unionByName(dealt.filter(F.col("kind") == PACKED))
        frames.append(dealt.filter(F.col("kind") == GONE).select("row", "start", "end"))
    bucketed = packed.select("h", "doc_id", "row", "start", "text").repartition(partitions(spark), "h")
    ranges = bucketed.sortWithinPartitions("h").mapInArrow(judge(window), "row long, start long, end long")
    for frame in frames:
        ranges = ranges.unionByName(frame)
    return ranges


def parts(docs: DataFrame, id_col: str, text_col: str, window: int, gram: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Finished documents (doc_id, n_words, kept_sha256), and others with ``gone``, what to remove from them."""
    docs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), whole(text_col).cast("binary").alias("text")
    )
    common = common_grams(docs, window, gram)
    again = repeated_minimisers(docs, window, gram, common)
    joined = docs.withColumn("row", F.monotonically_increasing_id()).join(
        again, key_of() == F.col("key"), "left"
    ).select("doc_id", "row", "text", "hs")
    table = staged(joined.mapInArrow(pack(window, gram, common), PART_SQL), "substring-parts")
    packed = table.filter(F.col("kind") == PACKED)
    gone = removed_ranges(packed, window, crowd).unionByName(
        table.filter(F.col("kind") == GONE).select("row", "start", "end")
    ).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("gone"))
    done = table.filter(F.col("kind") == DONE).select(
        "doc_id", F.col("end").alias("n_words"), F.col("text").cast("string").alias("kept_sha256")
    )
    return done, table.filter(F.col("kind") == TEXT).select("doc_id", "row", "text").join(gone, "row", "left")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and kept_sha256 (of the words left, joined by a space)."""
    done, others = parts(docs, id_col, text_col, window, gram, crowd)
    stripped = others.select("doc_id", "text", "gone").mapInArrow(
        strip, "doc_id long, n_words long, n_removed long, text string"
    ).select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    return done.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256").unionByName(stripped)
