"""Byte-level BPE: texts to token ids by a vocabulary of ranks, and ids back to bytes.

A text is split by the vocabulary's pattern, and each part is merged for itself: while two neighbouring tokens together
are a token, the pair of the lowest rank is merged, of equal ones the leftmost. A part that is a token as a whole is that token.

The merging keeps a segment tree over the byte positions of a part. The leaf of a position where a token begins holds
the rank of that token and the next one together, all other leaves hold none; an inner node holds the smaller of its two
children, so the way down from the root that prefers the left child ends at the leftmost lowest pair. A merge joins two live
neighbours and changes three leaves, each in a logarithmic number of steps: n log n for a part of n bytes, with 16 bytes of state
for each of them. Short parts, nearly all there are, are merged many at a time: each has its tree, and each step descends, merges and
climbs in all of them at once.

Parts are remembered by each worker up to a bound of number and length, so most of a corpus is looked up. Texts are split in
blocks that end where the pattern always ends a part, so a long text is never held as a list of all its parts; its ids
are held whole. Each row is encoded by itself: no row depends on others, no shuffle, and nothing is gathered.

A null text counts as empty and has no ids, as has an empty one; a null list of ids decodes to no bytes. Repeated rows, repeated
and null ids are rows of their own; there are no ties. No rows give none. Encoding reads id and text only, whatever other columns
are called; decoding passes all other columns on and adds one whose name is lengthened if it is taken.
"""

from __future__ import annotations

from array import array
from base64 import b64decode
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from txrisk.llm.common import new_name

NONE = (1 << 31) - 1
NO_ID = (1 << 31) - 1
NO_PAIR = (1 << 63) - 1
# Parts a worker remembers; none is longer than those that are merged together, in bytes.
REMEMBERED = 250_000
TOGETHER = 64
# Characters of text that are split at a time, and ids that are decoded at a time.
BLOCK = 1 << 19
# Bytes of ids that are decoded before they are handed on.
BATCH_BYTES = 4 << 20
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    """A line per token: its bytes in base 64, and its rank, which is its id."""
    with open(path, "rb") as lines:
        return {b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(part: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one part, by merging its bytes."""
    n = len(part)
    if n == 1:
        return [ranks[part]]
    size = 1 << (n - 1).bit_length()
    tree = array("i", [NONE]) * (2 * size)
    # Where the token at a position ends, and where the one before it begins.
    after, before = array("i", range(1, n + 2)), array("i", range(-1, n))
    rank_of = ranks.get
    for at in range(n - 1):
        tree[size + at] = rank_of(part[at:at + 2], NONE)
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left <= right else right

    def put(at: int, rank: int) -> None:
        node = size + at
        tree[node] = rank
        while node > 1:
            other = tree[node ^ 1]
            if other < rank:
                rank = other
            node >>= 1
            if tree[node] == rank:
                return
            tree[node] = rank

    while (lowest := tree[1]) != NONE:
        node = 1
        while node < size:
            node *= 2
            if tree[node] != lowest:
                node += 1
        at = node - size
        gone = after[at]
        end = after[gone]
        after[at] = end
        put(gone, NONE)
        if end < n:
            before[end] = at
            put(at, rank_of(part[at:after[end]], NONE))
        else:
            put(at, NONE)
        if (first := before[at]) >= 0:
            put(first, rank_of(part[first:end], NONE))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[part[at:after[at]]])
        at = after[at]
    return ids


class Pairs:
    """Ranks of two tokens together, looked up for many pairs of ids at a time."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        found = [
            (first << 32 | second, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (first := ranks.get(token[:cut])) is not None and (second := ranks.get(token[cut:])) is not None
        ]
        found.sort()
        # A last key that no pair has keeps every search within the table.
        self.keys = np.array([key for key, _ in found] + [NO_PAIR], np.int64)
        self.ranks = np.array([rank for _, rank in found] + [NONE], np.int32)

    def __call__(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        wanted = first.astype(np.int64) << 32 | second
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)


def merged_together(parts: list[bytes], size: int, pairs: Pairs, byte_ids: np.ndarray) -> list[bytes]:
    """The packed ids of many parts of at most ``size`` bytes, a power of two: one tree for each, all merged in step.

    The same tree, moves and changes as in ``merged``, each done for all parts that still have a pair to merge.
    """
    lengths = np.array([len(p) for p in parts])
    text = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in parts), np.uint8).reshape(-1, size)
    at_all = np.arange(size)
    alive = at_all < lengths[:, None]
    # Beyond a part, and before it in the last column, is no token.
    ids = np.full((len(parts), size + 2), NO_ID, np.int32)
    ids[:, :size][alive] = byte_ids[text[alive]]
    after = np.tile(np.arange(1, size + 2, dtype=np.int32), (len(parts), 1))
    before = np.tile(np.arange(-1, size, dtype=np.int32), (len(parts), 1))
    tree = np.full((len(parts), 2 * size), NONE, np.int32)
    tree[:, size:] = pairs(ids[:, :size], ids[:, 1:size + 1])
    for node in range(size - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
    levels = size.bit_length() - 1
    rows = np.arange(len(parts))
    while len(rows := rows[tree[rows, 1] != NONE]):
        lowest = tree[rows, 1]
        node = np.ones(len(rows), np.int64)
        for _ in range(levels):
            node *= 2
            node += tree[rows, node] != lowest
        at = node - size
        gone = after[rows, at]
        end = after[rows, gone]
        after[rows, at] = end
        before[rows, end] = at
        ids[rows, at] = lowest
        alive[rows, gone] = False
        first = before[rows, at]
        tree[rows, size + gone] = NONE
        tree[rows, size + at] = pairs(lowest, ids[rows, end])
        # The first token has none before it; its own leaf is then written a second time, unchanged.
        there = first >= 0
        changed = np.where(there, first, at)
        tree[rows, size + changed] = np.where(there, pairs(ids[rows, first], lowest), tree[rows, size + at])
        for node in (size + gone, size + at, size + changed):
            for _ in range(levels):
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
    packed = ids[:, :size][alive].astype("<u4").tobytes()
    ends = (4 * np.cumsum(alive.sum(1))).tolist()
    return [packed[a:b] for a, b in zip([0, *ends], ends)]


class PartIds(dict):
    """Each part's ids as little-endian 32-bit numbers."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        super().__init__()
        self.ranks = read_ranks(path)
        self.pairs = Pairs(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.parts = regex.compile(pattern).findall

    def learn(self, parts: set[str]) -> None:
        """Finds the ids of those parts that are not remembered."""
        if len(self) > REMEMBERED:
            self.clear()
        together: dict[int, list[str]] = {}
        for part in parts.difference(self):
            data = part.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                self[part] = np.array([rank], "<u4").tobytes()
            elif len(data) > TOGETHER:
                self[part] = np.array(merged(data, self.ranks), "<u4").tobytes()
            else:
                together.setdefault(1 << (len(data) - 1).bit_length(), []).append(part)
        for size, some in together.items():
            self.update(zip(some, merged_together([p.encode() for p in some], size, self.pairs, self.byte_ids)))

    def of_texts(self, texts: list[str]) -> list[bytes]:
        parts = [self.parts(text) for text in texts]
        different = set().union(*parts)
        self.learn(different)
        found = [b"".join(map(self.__getitem__, some)) for some in parts]
        for part in different:
            if len(part) > TOGETHER:
                del self[part]
        return found

    def of_text(self, text: str) -> bytes:
        return b"".join(self.of_texts([block])[0] for block in blocks(text))


def blocks(text: str, size: int | None = None) -> Iterator[str]:
    """The text in blocks of ``size`` characters or a little more, cut between a letter and the blank before another.

    There a part always ends: no part holds a blank after a letter, and none depends on what comes before it.
    """
    start, size = 0, size or BLOCK
    while start < len(text):
        cut = text.find(" ", start + size)
        while 0 < cut < len(text) - 1 and not (text[cut - 1] in LETTERS and text[cut + 1] in LETTERS):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            cut = len(text)
        yield text[start:cut]
        start = cut


@cache
def encoder_of(path: str, pattern: str) -> PartIds:
    """One encoder per worker process and vocabulary, kept between tasks."""
    return PartIds(path, pattern)


@cache
def tokens_of(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}


def bytes_of(ids: bytes, tokens: dict[int, bytes]) -> bytes:
    numbers = np.frombuffer(ids, "<u4")
    return b"".join(
        b"".join(map(tokens.__getitem__, numbers[at:at + BLOCK].tolist())) for at in range(0, len(numbers), BLOCK)
    )


def in_slices(sizes: list[int], most: int) -> Iterator[slice]:
    """Rows in slices whose sizes add up to ``most`` or less; a larger row is a slice of its own."""
    first = held = 0
    for at, size in enumerate(sizes):
        if held and held + size > most:
            yield slice(first, at)
            first = at
            held = 0
        held += size
    if first < len(sizes):
        yield slice(first, len(sizes))


def encoding(path: str | None, pattern: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path or vocabulary_file(), pattern or own_pattern())
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            for rows in in_slices(pc.binary_length(texts).to_pylist(), BLOCK):
                some = texts[rows].to_pylist()
                # A slice is one long text, or several that are split and merged together.
                ids = [encoder.of_text(some[0])] if len(some) == 1 else encoder.of_texts(some)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[rows], pa.array(ids, pa.binary())], names=["doc_id", "token_ids"]
                )
    return run


def decoding(path: str | None, ids_col: str, name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path or vocabulary_file())
        for batch in batches:
            ids = pc.fill_null(batch.column(batch.schema.get_field_index(ids_col)), b"")
            for rows in in_slices(pc.binary_length(ids).to_pylist(), BATCH_BYTES):
                found = pa.array([bytes_of(i, tokens) for i in ids[rows].to_pylist()], pa.binary())
                part = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, name])
    return run


def own_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """One row per document: its id under its own name, and ``token_ids``, little-endian unsigned 32-bit numbers in one binary."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("token_ids", T.BinaryType())])
    return rows.mapInArrow(encoding(vocabulary, pattern), schema).withColumnRenamed("doc_id", id_col)


def decode(rows: DataFrame, ids_col: str = "token_ids", vocabulary: str | None = None) -> tuple[DataFrame, str]:
    """The rows with the bytes of their ids, and the name of that column (``decoded`` unless taken)."""
    name = new_name(rows, "decoded")
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.BinaryType())])
    return rows.mapInArrow(decoding(vocabulary, ids_col, name), schema), name
