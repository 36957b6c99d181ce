"""Best-fit packing of token sequences by a configuration linear program.

A document is its token ids and an end id, cut into pieces of ``capacity`` only if it is longer. A
configuration is a multiset of piece lengths that fits one sequence; the linear program uses as few as can
be so that every length of the histogram is covered.

1. Tokens: each piece's length and checksum are written once, without its text. Words are encoded once per
   worker and remembered, up to a bound; a text's ids are joined from them. That gives the tokenizer's own ids because it
   drops white space and never merges across it.
2. The histogram has at most ``capacity`` lengths, however large the input; it is all that the driver sees.
   Multiplicative weights price the lengths, knapsack dynamic programming finds the best configurations
   at these prices, and lengths that get covered lose weight.
3. Rounding: the program's configurations are used a whole number of times, most used first, as far as pieces
   are left; the rest, a few per configuration, is packed best-fit, longest first. Every sequence is filled by
   exactly the pieces its configuration names.
4. Pieces are numbered within their length, in ranges of a hash so that a length that a third of all pieces have
   is spread over many tasks; number and length give sequence and offset.

A null text counts as empty and is one piece of the end id alone. Repeated rows are packed each for
itself. No rows give none. Only id and text are read, whatever other columns are called. A very long text is encoded whole: its
worker holds it, its words and its ids, and passes on its pieces' lengths and checksums only.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from txrisk.llm.common import partitions, staged

CAPACITY = 2048
END_ID = 0
ROUNDS = 120
REMEMBERED = 200_000
# Latin letters whose lower case is one letter of the same range, then marks; not the apostrophe, which may
# begin a part of its own with the letters after it.
SIMPLE = re.compile(
    r"([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0239\u023b-\u023d\u023f-\u024f]+)"
    r"([.,;:!?*$%&#|\"()]*)"
).fullmatch
PIECES = "doc_id long, row long, piece int, start long, length int, ids_crc32 long"
PLACED = (
    "doc_id long, row long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds(dict):
    """Each word's token ids as little-endian 32-bit numbers, found when first asked for.

    Most words are Latin letters with some marks at their end. For these the tokenizer's pattern gives two parts
    whose ids are independent, and the first goes straight to the tokenizer's merges. The pattern is what costs most.
    All other words go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.parts: dict[str, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        found = SIMPLE(text)
        if found is None:
            ids = self.whole_ids(text)
        else:
            core, marks = found.groups()
            ids = self.core_ids(core.lower())
            if marks:
                tail = self.parts.get(marks)
                if tail is None:
                    tail = self.parts[marks] = self.whole_ids(marks)
                ids += tail
        self[word] = ids
        return ids

    def whole_ids(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def core_ids(self, core: str) -> bytes:
        ids = self.parts.get(core)
        if ids is None:
            # The merges work on bytes written as characters.
            shown = core if core.isascii() else "".join(map(BYTE_CHARACTERS.__getitem__, core.encode()))
            ids = self.parts[core] = packed([token.id for token in self.merges.tokenize(shown)])
        return ids

    def of_text(self, text: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
            self.parts.clear()
        return b"".join(map(self.__getitem__, lowered(text).split()))


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def byte_characters() -> list[str]:
    """How byte-level vocabularies write each byte: printable Latin-1 as it is, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


BYTE_CHARACTERS = byte_characters()


def lowered(text: str) -> bytes:
    """ASCII letters lowered where that cannot change the ids: fewer words to remember.

    The tokenizer composes characters before it lowers them, so a text that composes in either form
    is left alone.
    """
    data = text.encode()
    low = data.lower()
    if text.isascii() or (
        unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low.decode())
    ):
        # Special tokens are matched as written, and have lower case letters only.
        return data if b"<|" in data else low
    return data


ENCODERS: dict[str, WordIds] = {}


def encoder_of(path: str | None) -> WordIds:
    """One encoder per worker process, kept between tasks; without a path, that of the installed vocabulary."""
    path = path or tokenizer_file()
    if path not in ENCODERS:
        ENCODERS[path] = WordIds(path)
    return ENCODERS[path]


def cut(path: str | None, capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A document's pieces: doc_id, row, piece, start, length, checksum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            keys, rows = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
            found = []
            for key, row, text in zip(keys, rows, texts, strict=True):
                data = encoder.of_text(text) + end
                for piece, start in enumerate(range(0, len(data), 4 * capacity)):
                    ids = data[start:start + 4 * capacity]
                    found.append((key, row, piece, start // 4, len(ids) // 4, crc32(ids)))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)],
                names=["doc_id", "row", "piece", "start", "length", "ids_crc32"],
            )
    return run


@dataclass
class Plan:
    """Configurations with their number of sequences, and where each length's pieces go."""

    capacity: int
    used: list[tuple[tuple[int, ...], int]] = field(default_factory=list)

    def add(self, lengths: tuple[int, ...], times: int) -> None:
        self.used.append((lengths, times))

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.used)

    def slots(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By length: the first piece number of each slot, that slot's first sequence, and its offset."""
        found: dict[int, list[tuple[int, int, int]]] = {}
        numbers: dict[int, int] = {}
        sequence = 0
        for lengths, times in self.used:
            offset = 0
            for length in lengths:
                number = numbers.get(length, 0)
                found.setdefault(length, []).append((number, sequence, offset))
                numbers[length] = number + times
                offset += length
            sequence += times
        return {length: tuple(np.array(c) for c in zip(*rows, strict=True)) for length, rows in found.items()}


def price(values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack over lengths 1 to ``capacity``: best value and last length for each room."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    sold = np.nonzero(values > 0)[0]
    for room in range(1, capacity + 1):
        fit = sold[:np.searchsorted(sold, room, "right")]
        best[room], last[room] = best[room - 1], 0
        if len(fit):
            worth = values[fit] + best[room - fit]
            at = int(worth.argmax())
            if worth[at] > best[room]:
                best[room], last[room] = worth[at], fit[at]
    return best, last


def filled(first: int, last: np.ndarray, capacity: int) -> tuple[int, ...]:
    """The best configuration that holds ``first``."""
    lengths, room = [first], capacity - first
    while room > 0:
        if last[room]:
            lengths.append(int(last[room]))
            room -= lengths[-1]
        else:
            room -= 1
    return tuple(sorted(lengths, reverse=True))


def solve(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """A fractional cover of the histogram: how often to use each configuration.

    Prices start in proportion to length. In each round every length is covered by the best configuration that
    holds it, if that is nearly worth the best of all; prices of lengths covered more than the others then fall by
    a factor, and by less and less in later rounds. The cover is the mean of the rounds after the first third.
    """
    lengths = np.nonzero(counts)[0]
    need = counts.astype(float)
    logs = np.where(counts > 0, np.log(np.maximum(1, np.arange(capacity + 1)) / capacity), -np.inf)
    used: dict[tuple[int, ...], float] = {}
    covered = np.zeros(capacity + 1)
    # Few lengths make rounds cheap, and need more of them to settle.
    rounds = rounds * (4 if len(lengths) <= 64 else 1)
    for number in range(rounds):
        best, last = price(np.exp(logs), capacity)
        worth = np.exp(logs[lengths]) + best[capacity - lengths]
        settled = number / rounds
        progress = np.zeros(capacity + 1)
        for length in lengths[worth >= (0.9 + 0.099 * settled) * worth.max()].tolist():
            if progress[length] >= need[length]:
                continue
            chosen = filled(length, last, capacity)
            kinds, times = np.unique(chosen, return_counts=True)
            amount = float((need[kinds] / times).min())
            progress[kinds] += amount * times
            if 3 * number >= rounds:
                used[chosen] = used.get(chosen, 0.0) + amount
        share = progress[lengths] / need[lengths]
        logs[lengths] -= 0.3 * (1 - 0.95 * settled) * (share - share.mean()).clip(-1, 1)
        logs[lengths] -= logs[lengths].max()
        if 3 * number >= rounds:
            covered += progress
    share = covered[lengths] / need[lengths]
    scale = max(1e-9, float(np.average(share, weights=need[lengths] * lengths)))
    return {chosen: amount / scale for chosen, amount in used.items()}


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """A whole-number packing of ``counts[length]`` pieces of each length."""
    plan, left = Plan(capacity), counts.astype(np.int64).copy()
    if left[capacity]:
        plan.add((capacity,), int(left[capacity]))
        left[capacity] = 0
    if not left.any():
        return plan
    fractions = solve(left, capacity)
    configurations = sorted(fractions, key=lambda c: (-sum(c), -fractions[c], c))

    def use(lengths: tuple[int, ...], most: float) -> None:
        kinds, times = np.unique(lengths, return_counts=True)
        number = int(min(most, (left[kinds] // times).min()))
        if number > 0:
            plan.add(lengths, number)
            left[kinds] -= number * times

    for lengths in configurations:
        use(lengths, np.floor(fractions[lengths]))
    # Full configurations as often as pieces are left for them.
    for lengths in configurations:
        if sum(lengths) == capacity:
            use(lengths, np.inf)
    best_fit(plan, left)
    return plan


def best_fit(plan: Plan, left: np.ndarray) -> None:
    """Packs what is left: the longest piece opens a sequence, then the room takes the best fill.

    Each sequence takes the longest piece that fits, and so on; where two pieces fill the room exactly,
    these. Equal sequences are taken many at a time, so the work depends on the histogram alone.
    """
    capacity = plan.capacity
    while left.any():
        lengths = np.nonzero(left)[0]
        first = int(lengths[-1])
        chosen, room = [first], capacity - first
        left[first] -= 1
        while room > 0:
            lengths = np.nonzero(left[:room + 1])[0]
            if not len(lengths):
                break
            longest = int(lengths[-1])
            if longest < room:
                # A pair that fills the room beats the longest piece.
                other = room - lengths
                pair = lengths[(other > 0) & (left[other] > (other == lengths))]
                if len(pair):
                    longest = int(pair[-1])
            chosen.append(longest)
            left[longest] -= 1
            room -= longest
        kinds, times = np.unique(chosen, return_counts=True)
        more = int((left[kinds] // times).min())
        left[kinds] -= more * times
        plan.add(tuple(chosen), more + 1)


def place(slots: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths):
                firsts, sequences, offsets = slots[int(length)]
                mine = np.nonzero(lengths == length)[0]
                slot = np.searchsorted(firsts, numbers[mine], "right") - 1
                sequence[mine] = sequences[slot] + numbers[mine] - firsts[slot]
                offset[mine] = offsets[slot]
            names = ["doc_id", "row", "piece", "start", "length", "ids_crc32"]
            columns = [batch.column(n) for n in names]
            columns[4] = pa.array(lengths.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    spark = docs.sparkSession
    pieces = staged(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.col(text_col).alias("text"),
    ).mapInArrow(cut(tokenizer, capacity), PIECES), "packing-pieces")
    ranges = 4 * partitions(spark)
    pieces = pieces.withColumn("range", F.pmod(F.xxhash64("row", "piece"), F.lit(ranges)).cast("int"))
    cells = staged(pieces.groupBy("length", "range").agg(F.count("*").alias("n")), "packing-cells")
    counts = np.zeros(capacity + 1, np.int64)
    for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    slots = plan_packing(counts, capacity).slots()
    earlier = Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(
        "length", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    order = Window.partitionBy("length", "range").orderBy("row", "piece")
    placed = pieces.withColumn("at", F.row_number().over(order) - 1).join(offsets, ["length", "range"]).withColumn(
        "number", F.col("before") + F.col("at")
    ).mapInArrow(place(slots), PLACED)
    return placed.drop("row")
