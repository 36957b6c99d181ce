"""Periodic runs of words, found online by dyadic square catching.

A run is a stretch of consecutive words that equal those ``period`` words before them, with the smallest such period, at
least ``LEAST_TIMES`` times that period and ``LEAST_LENGTH`` words long, that neither neighbour extends. Of each run a text
needs the first period only: collapsed, it keeps the words that no run holds after its first period.

``Catchers`` takes the words as they are appended and holds, for each power of two L up to what the text's length allows, one
catcher per completed block of L words. A word appended completes one suffix of L words per level, and that is compared
with one catcher, the last block that was complete before the suffix began and lies at a distance p of L to 2 L - 1 words: equal
fingerprints mean that L words repeat at distance p. A run of four periods p holds, whatever its place, at least
``(3 p + 1) // L - 1`` blocks in a row that repeat at p, so only so many in a row are followed up: the words themselves are
compared, and the square is extended in both directions to the run it belongs to. A run that reaches the last word stays open, and
the words appended later extend or end it. Repeats within a run of a smaller period are that run's own and are passed over.

So each word costs one comparison of numbers per level, whatever the text; words are appended many at a time, and the
comparisons of one level are one numpy operation. The texts of a batch are appended one after the other to the same catchers, with
a word between them that occurs once, in groups of similar length so that short texts need few levels.

Each row is handled by itself, without a shuffle. A worker holds the word numbers and fingerprints of one text, or of many short
ones together (24 bytes a word), and of the text itself its different words; very long texts are read in blocks.

Words are separated by space and U+0009 to U+000D. Null, empty and blank texts have no words and no runs. Repeated rows are
found alike, each for itself; rows may share an id or have none. Runs of equal length, start or period are all reported; they are
listed by start, then period. No rows give none. Only id and text are read, whatever other columns are called.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

LEAST_LENGTH = 6
LEAST_TIMES = 4
# Words appended to the catchers at a time, and words of short texts that share catchers.
APPENDED = 1 << 18
TOGETHER = 1 << 19
# Bytes of a long text that are split at a time; different words kept from one group of texts to the next.
BLOCK = 1 << 22
REMEMBERED = 200_000
# Multipliers of the fingerprints' mixing, odd and with evenly spread bits.
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX_NEXT = np.uint64(0xC2B2AE3D27D4EB4F)
SHIFT = np.uint64(29)
SEPARATOR = re.compile(rb"[ \t-\r]")
RUNS = "array<struct<start: long, length: long, period: long>>"
RUN_TYPE = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

Rewrite = Callable[[int | None, np.ndarray], np.ndarray]


class Catchers:
    """The runs of the words appended so far; ``longest`` is the length of the longest text among them."""

    def __init__(self, total: int, longest: int) -> None:
        self.words = np.zeros(total, np.int64)
        self.size = 0
        # No period of four times its length needs a larger block.
        self.levels = max(1, (longest // LEAST_TIMES).bit_length())
        self.prints = [np.zeros(total, np.uint64) for _ in range(self.levels)]
        self.printed = [0] * self.levels
        # By level and distance: last block that repeated, and how many in a row.
        self.rows: list[dict[int, tuple[int, int]]] = [{} for _ in range(self.levels)]
        # By level, the period of the run from a start to an end; open runs end at the last word so far.
        self.found: list[dict[tuple[int, int], int]] = [{} for _ in range(self.levels)]
        self.open: list[tuple[int, int, int]] = []

    def append(self, words: np.ndarray) -> None:
        old, self.size = self.size, self.size + len(words)
        self.words[old:self.size] = words
        still_open, self.open = self.open, []
        for level, start, period in still_open:
            if self.found[level].get((start, old)) == period:
                del self.found[level][start, old]
            self.settle(level, start, self.extended(old, period), period)
        for level in range(self.levels):
            self.advance(level)

    def advance(self, level: int) -> None:
        """Compares the suffixes that the appended words completed with the catchers of one level."""
        block = 1 << level
        first, last = self.printed[level], max(self.printed[level], self.size - block + 1)
        if last == first:
            return
        prints = self.prints[level]
        if level == 0:
            fresh = self.words[first:last].astype(np.uint64) * MIX
        else:
            lower, half = self.prints[level - 1], block >> 1
            fresh = lower[first:last] * MIX_NEXT + lower[first + half:last + half]
        fresh ^= fresh >> SHIFT
        fresh *= MIX
        prints[first:last] = fresh
        self.printed[level] = last
        # Suffixes before the second block have no catcher.
        begin = max(first, block)
        if begin >= last:
            return
        places = np.arange(begin, last)
        caught = places[prints[begin:last] == prints[((places >> level) - 1) << level]]
        if len(caught):
            self.follow(level, caught)

    def follow(self, level: int, ends: np.ndarray) -> None:
        """Counts blocks in a row that repeat at one distance, and follows up those that are enough."""
        block = 1 << level
        numbers = (ends >> level) - 1
        distances = ends - (numbers << level)
        inside = self.inside_smaller(level, numbers << level, ends + block)
        numbers, distances = numbers[~inside], distances[~inside]
        if not len(numbers):
            return
        order = np.lexsort((numbers, distances))
        numbers, distances = numbers[order], distances[order]
        new = np.ones(len(numbers), bool)
        new[1:] = (numbers[1:] != numbers[:-1] + 1) | (distances[1:] != distances[:-1])
        firsts = np.nonzero(new)[0]
        lengths = np.diff(np.append(firsts, len(numbers)))
        rows = self.rows[level]
        newest = (self.size - block >> level) - 1
        alive = {}
        for number, length, distance in zip(
            numbers[firsts].tolist(), lengths.tolist(), distances[firsts].tolist(), strict=True
        ):
            before = rows.get(distance)
            run = length + (before[1] if before and before[0] == number - 1 else 0)
            needed = (3 * distance + 1) // block - 1
            if run >= needed > run - length:
                self.check(level, (number + length - run) << level, distance)
            if number + length - 1 >= newest - 1:
                alive[distance] = (number + length - 1, run)
        # Of the rows from earlier calls, those may go on whose next block has not been compared yet.
        for distance, (number, run) in rows.items():
            if distance not in alive and number >= newest - 1:
                alive[distance] = (number, run)
        self.rows[level] = alive

    def inside_smaller(self, level: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which stretches lie within a run of a lower level."""
        least = int(ends.min())
        runs = sorted(run for found in self.found[:level] for run in found if run[1] >= least)
        if not runs:
            return np.zeros(len(starts), bool)
        reach = np.maximum.accumulate(np.array([end for _, end in runs]))
        at = np.searchsorted(np.array([start for start, _ in runs]), starts, "right") - 1
        return (at >= 0) & (reach[at] >= ends)

    def check(self, level: int, start: int, period: int) -> None:
        """Compares the words of a caught square, and extends it as far as they repeat."""
        end = self.extended(start + period, period)
        if end < start + 2 * period:
            return
        self.settle(level, self.extended_back(start, period), end, period)

    def settle(self, level: int, start: int, end: int, period: int) -> None:
        if end == self.size:
            self.open.append((level, start, period))
        if end - start >= LEAST_TIMES * period:
            self.found[level].setdefault((start, end), period)

    def extended(self, at: int, period: int) -> int:
        """The first place from ``at`` on whose word differs from that one period before, or the end."""
        words, step = self.words, 64
        while at < self.size:
            end = min(at + step, self.size)
            differ = words[at:end] != words[at - period:end - period]
            if differ.any():
                return at + int(differ.argmax())
            at, step = end, step * 2
        return self.size

    def extended_back(self, at: int, period: int) -> int:
        """The first place of the stretch up to ``at`` whose words equal those one period later."""
        words, step = self.words, 64
        while at > 0:
            begin = max(0, at - step)
            differ = (words[begin:at] != words[begin + period:at + period])[::-1]
            if differ.any():
                return at - int(differ.argmax())
            at, step = begin, step * 2
        return 0

    def runs(self) -> list[tuple[int, int, int]]:
        """Start, length and period of all runs, by start and period."""
        smallest: dict[tuple[int, int], int] = {}
        for found in self.found:
            for run, period in found.items():
                smallest[run] = min(period, smallest.get(run, period))
        return sorted(
            (start, end - start, period) for (start, end), period in smallest.items() if end - start >= LEAST_LENGTH
        )


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several texts, whose words are numbers from 0 on."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    groups: dict[int, list[int]] = {}
    for i, words in enumerate(texts):
        if len(words) >= LEAST_LENGTH:
            groups.setdefault(len(words).bit_length(), []).append(i)
    for group in groups.values():
        lengths = [len(texts[i]) for i in group]
        catchers = Catchers(sum(lengths) + len(group), max(lengths))
        starts = np.concatenate([[0], np.cumsum(np.array(lengths) + 1)])
        pending, held = [], 0
        for number, i in enumerate(group):
            # The word between texts is one that no other is.
            pending += [texts[i], np.array([-1 - number])]
            held += len(texts[i]) + 1
            if held >= APPENDED or i == group[-1]:
                words = np.concatenate(pending)
                for at in range(0, len(words), APPENDED):
                    catchers.append(words[at:at + APPENDED])
                pending, held = [], 0
        for start, length, period in catchers.runs():
            number = int(np.searchsorted(starts, start, "right")) - 1
            found[group[number]].append((start - int(starts[number]), length, period))
    return found


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words no run holds after its first period."""
    if not runs:
        return np.ones(n, bool)
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:n] == 0


class WordNumbers(dict):
    """Numbers of words, given out when first asked for."""

    def __init__(self) -> None:
        super().__init__()
        self.next = count()

    def __missing__(self, word: bytes) -> int:
        number = self[word] = next(self.next)
        return number

    def of_text(self, text: memoryview) -> np.ndarray:
        """The numbers of a text's words; bytes.split() without an argument splits at space and U+0009 to U+000D."""
        parts, start = [], 0
        while start < len(text):
            separator = SEPARATOR.search(text, start + BLOCK)
            end = separator.start() if separator else len(text)
            parts.append(np.fromiter(map(self.__getitem__, bytes(text[start:end]).split()), np.int32))
            start = end
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def finding(rewrite: Rewrite | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = pc.fill_null(batch.column("text"), b"")
            first, held, numbers, texts = 0, 0, WordNumbers(), []
            for at in range(batch.num_rows):
                words = numbers.of_text(memoryview(data[at].as_buffer()))
                if rewrite is not None:
                    words = rewrite(batch.column("doc_id")[at].as_py(), words)
                texts.append(words)
                held += len(words) + 1
                if held >= TOGETHER or len(numbers) > REMEMBERED or at == batch.num_rows - 1:
                    yield reported(batch.column("doc_id").slice(first, len(texts)), texts, numbers)
                    first, held, numbers, texts = at + 1, 0, WordNumbers(), []
    return run


def reported(ids: pa.Array, texts: list[np.ndarray], numbers: WordNumbers) -> pa.RecordBatch:
    spelled = list(numbers)
    runs = runs_of(texts)
    collapsed = [
        b" ".join(map(spelled.__getitem__, words[kept_words(len(words), some)].tolist()))
        for words, some in zip(texts, runs, strict=True)
    ]
    return pa.RecordBatch.from_arrays([
        ids,
        pa.array([len(words) for words in texts], pa.int64()),
        pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in some] for some in runs], RUN_TYPE),
        pa.array(collapsed, pa.binary()),
    ], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rewrite: Rewrite | None = None) -> DataFrame:
    """Per document doc_id, n_words, runs by start and period, and the collapsed text, its words joined by one space.

    ``rewrite`` may change a document's words before they are searched: it takes the id and their numbers.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(
        finding(rewrite), f"doc_id {kind}, n_words long, runs {RUNS}, collapsed binary"
    )
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
