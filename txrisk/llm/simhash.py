"""SimHash near-duplicates by vantage-point trees.

A text's words (ASCII letters lowered) form shingles of ``shingle`` words, repeats included; a text with
fewer words is one shingle, one with none has fingerprint zero. A bit of the fingerprint is 1 if it is set in
over half of the shingles' XXH64 hashes (UTF-8, seed 42). Fingerprints at ``distance`` bits or less are
linked, and a component is whatever links reach, equal fingerprints included.

Exact pairs at scale:

1. Equal fingerprints collapse to one, whatever the number of copies.
2. Of two fingerprints within d bits, one of the two 32-bit halves differs in at most d // 2 bits. So
   each half has a vantage-point tree of its own, with Hamming distance on that half. A node splits at the median
   distance mu from its vantage point: within mu + d // 2 goes inside, beyond mu goes outside. By the triangle
   inequality two halves within d // 2 bits then meet in a child, and only the shell between
   is in both. Trees come from a bounded sample; their leaves are shards.
3. A shard goes on splitting in the same way and compares all bits within small leaves. It returns links
   that join what belongs together (a spanning forest), not all pairs.
4. Components: each round every fingerprint is merged into its smallest neighbour, until no link is left.
   Rounds are written out, nothing is gathered on the driver.

Nulls: a null text has no words; null ids take part, and are a component's id only if it has no other. Repeated
rows are equal. No rows give none. Only id and text are read, whatever other columns are called. A very long text is read whole: its
worker holds its words and 8 bytes a shingle, whose bits are counted in blocks, and passes on its fingerprint only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from txrisk.llm.common import numbered, sampled, staged

SHINGLE = 3
DISTANCE = 3
SEED = 42
SAMPLE = 32_768
SHARD = 2_048
SMALL = 256
HALVES = 2
HALF_BITS = 32
LEAST_SHRINK = 0.9


def fingerprint(text: str, shingle: int) -> int:
    """As a signed 64-bit number."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8)
        counts += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"),
                 pa.array([fingerprint(t or "", shingle) for t in texts], pa.int64())],
                names=["row", "doc_id", "fp"],
            )
    return run


def half(prints: np.ndarray, which: int) -> np.ndarray:
    return (prints.view(np.uint64) >> np.uint64(HALF_BITS * which)).astype(np.uint32)


class VantageTree:
    """Vantage points and radii of one half; children may share the shell just beyond the radius."""

    def __init__(self, sample: np.ndarray, reach: int, leaf: int, seed: int) -> None:
        self.reach = reach
        self.nodes: list[tuple[int, int, int, int] | None] = []
        self._build(sample, leaf, np.random.default_rng(seed))

    def _build(self, points: np.ndarray, leaf: int, random: np.random.Generator) -> int:
        number = len(self.nodes)
        self.nodes.append(None)
        if len(points) > leaf:
            split = halved(points, self.reach, random)
            if split:
                point, radius, inside, outside = split
                left = self._build(points[inside], leaf, random)
                right = self._build(points[outside], leaf, random)
                self.nodes[number] = int(point), radius, left, right
        return number

    def shards(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each leaf's number with the places of its points."""
        pending = [(0, np.arange(len(points)))]
        while pending:
            number, places = pending.pop()
            node = self.nodes[number]
            if node is None:
                if len(places):
                    yield number, places
                continue
            point, radius, left, right = node
            far = np.bitwise_count(points[places] ^ np.uint32(point))
            pending.append((left, places[far <= radius + self.reach]))
            pending.append((right, places[far > radius]))


def halved(points: np.ndarray, reach: int, random: np.random.Generator):
    """The best of a few vantage points with radius and both sides; None if no split is worth it."""
    best = None
    for point in points[random.integers(0, len(points), 4)]:
        far = np.bitwise_count(points ^ point).astype(np.int64)
        counts = np.bincount(far, minlength=HALF_BITS + 2)
        upto = counts.cumsum()
        radii = np.arange(HALF_BITS + 1)
        inner = upto[np.minimum(radii + reach, HALF_BITS)]
        outer = len(points) - upto[radii]
        larger = np.maximum(inner, outer)
        # The least work below: both sides, and above all the larger one.
        radius = int(np.argmin(larger + 0.5 * (inner + outer)))
        if outer[radius] and larger[radius] <= LEAST_SHRINK * len(points):
            cost = larger[radius] + 0.5 * (inner[radius] + outer[radius])
            if best is None or cost < best[0]:
                best = cost, point, radius, far
    if best is None:
        return None
    _, point, radius, far = best
    return point, radius, far <= radius + reach, far > radius


def merge(labels: np.ndarray, places: np.ndarray) -> None:
    """Gives all places, and what they were merged with, the smallest of their labels."""
    roots = places
    while ((further := labels[roots]) != roots).any():
        roots = further
    least = roots.min()
    labels[roots] = least
    labels[places] = least


def shard_links(prints: np.ndarray, which: int, distance: int) -> np.ndarray:
    """For each fingerprint of a shard (sorted, distinct), the place of the smallest one it is linked to here."""
    reach, random, labels = distance // HALVES, np.random.default_rng(which), np.arange(len(prints))
    halves, unsigned = half(prints, which), prints.view(np.uint64)
    pending = [np.arange(len(prints))]
    while pending:
        places = pending.pop()
        split = halved(halves[places], reach, random) if len(places) > SMALL else None
        if split:
            pending += [places[split[2]], places[split[3]]]
            continue
        # Whole-fingerprint comparison in blocks: memory stays bounded where no split helps.
        for at in range(0, len(places), SMALL):
            rows = places[at:at + SMALL]
            for to in range(at, len(places), 4096):
                columns = places[to:to + 4096]
                near = np.bitwise_count(unsigned[rows][:, None] ^ unsigned[columns][None, :]) <= distance
                for i in np.nonzero(near.sum(1) > (to == at))[0]:
                    merge(labels, np.append(columns[near[i]], rows[i]))
    while ((further := labels[labels]) != labels).any():
        labels = further
    return labels


def to_shards(trees: list[VantageTree]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fp").to_numpy()
            for which, tree in enumerate(trees):
                for number, places in tree.shards(half(prints, which)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(places), which, np.int32)), pa.array(np.full(len(places), number, np.int32)),
                        pa.array(prints[places]),
                    ], names=["half", "shard", "fp"])
    return run


def link_shard(distance: int) -> Callable[[pa.Table], pa.Table]:
    def run(shard: pa.Table) -> pa.Table:
        prints = np.sort(shard.column("fp").to_numpy())
        roots = shard_links(prints, shard.column("half")[0].as_py(), distance)
        apart = roots != np.arange(len(prints))
        return pa.table({"a": pa.array(prints[apart]), "b": pa.array(prints[roots[apart]])})
    return run


def links(prints: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` whose components are those of all pairs in reach."""
    total = prints.count()
    sample = sampled(prints, "fp", SAMPLE, total).collect()
    points = np.array([r["fp"] for r in sample], np.int64)
    # A leaf of the sample stands for this many fingerprints; the bound on the sample bounds the trees.
    leaf = max(8, SHARD * len(points) // max(1, total))
    trees = [VantageTree(half(points, w), distance // HALVES, leaf, w) for w in range(HALVES)] if sample else []
    sharded = prints.mapInArrow(to_shards(trees), "half int, shard int, fp long")
    return sharded.groupBy("half", "shard").applyInArrow(link_shard(distance), "a long, b long")


def jumped(merge: DataFrame) -> DataFrame:
    """(old, to) with each node's whole way down instead of its next step, halved in each round.

    A step never leads up, so every way ends in a node that stays; a chain of n steps takes log n rounds.
    """
    while True:
        onward = merge.select(F.col("old").alias("to"), F.col("to").alias("next"))
        moved = staged(merge.join(onward, "to").select(
            "old", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")
        ), "simhash-jump")
        merge = moved.select("old", "to")
        if moved.filter("moved").isEmpty():
            return merge


def components(edges: DataFrame) -> DataFrame:
    """Each linked node with the smallest of its component: node, root.

    In each round nodes follow their smallest neighbours all the way down and become one, so that chains collapse at
    once; what is left are the edges between nodes that were smaller than all their neighbours.
    """
    edges = staged(edges, "simhash-links")
    label = staged(
        edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")),
        "simhash-roots",
    )
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        merge = jumped(staged(
            both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")).select(F.col("a").alias("old"), "to"),
            "simhash-merge",
        ))
        label = staged(
            label.join(merge, F.col("root") == F.col("old"), "left")
            .select("node", F.coalesce("to", "root").alias("root")), "simhash-roots"
        )
        ends = edges.join(merge, F.col("a") == F.col("old")).select(F.col("to").alias("a"), "b")
        ends = ends.join(merge, F.col("b") == F.col("old")).select("a", F.col("to").alias("b"))
        edges = staged(ends.filter("a <> b").distinct(), "simhash-links")
    return label


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
           shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """row, doc_id, fp, component_id and first_row (of the smallest id, then the smallest row)."""
    rows = staged(docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
    ).mapInArrow(fingerprints(shingle), "row long, doc_id long, fp long"), "simhash-prints")
    prints = staged(rows.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first")
    ), "simhash-distinct")
    roots = components(links(prints.select("fp"), distance))
    members = prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    smallest = members.groupBy("root").agg(F.min("first").alias("of"))
    members = members.join(smallest, "root").select(
        "fp", F.col("of.doc_id").alias("component_id"), F.col("of.row").alias("first_row")
    )
    return rows.join(members, "fp")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and component_id."""
    return groups(docs, id_col, text_col, None, shingle, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                        distance: int = DISTANCE) -> DataFrame:
    """One document of each group, that with the smallest id, with all its columns."""
    rows, row = numbered(docs, "simhash-docs")
    keep = groups(rows, id_col, text_col, row, shingle, distance).filter(F.col("row") == F.col("first_row"))
    return rows.join(keep.select(F.col("row").alias(row)), row, "left_semi").select(*docs.columns)
