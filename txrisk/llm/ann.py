"""Approximate nearest neighbours by a forest of random-projection trees.

Each tree halves the space again and again, by the plane between two points of a bounded sample, at the
sample's median. Every row is indexed in one leaf of every tree. A query walks all trees with one
priority queue, whose next entry is the subtree with the smallest distance beyond the planes crossed so
far; it goes on until the leaves it took hold ``share`` times as many entries as there are rows (each row
has one per tree, so these are fewer rows) and those of one tree hold ``SURE`` times ``k`` rows besides the query's own,
or until every subtree left lies beyond the query's k-th nearest sample point, which is an exact bound. Candidates of the leaves are
ranked by their exact distance.

Isotropic vectors are the worst case: there, planes bound nothing and recall follows the share searched
(README: over 0.9 at the default). On clustered vectors the bound ends most searches early.

- The sample has about ``SAMPLE`` rows, so trees, sample and leaf sizes (the only things sent to all tasks) are bounded.
- A leaf with over ``BLOCK`` rows is dealt out in blocks that its queries visit all, and one that over ``BLOCK`` queries
  visit has these dealt out, too, so that no group holds more of either. Trees get deeper with the number of rows, as far as the
  sample allows.
- Rows that repeat both id and vector are made one first. Of equal vectors only the ``k`` + 1 smallest ids, all
  different then, can be among the nearest; they are taken before the index is built, so any number of
  copies stays cheap and no result is lost.
- A task returns ``k`` rows per query and block, not all pairs.

Vectors that are null, zero, or hold null or non-finite components take no part, and neither do those of
another length than most (ties to the shorter). Rows that repeat id and vector are one row; those that repeat an id
only are rows of their own, so an id can be found once per vector of it. A query leaves out all rows with its id.
Queries with one id are one query, whose distance to a row is that of its nearest vector. Fewer candidates than ``k``: all of them. No queries: no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from txrisk.llm.common import sampled, staged

NEAREST = 10
EVERY = 100
TREES = 16
DEPTH = 7
SAMPLE = 16_384
LEAST_LEAF = 8
SHARE = 1.0
BLOCK = 4_096
# In small or clustered tables all trees may give a query the same few rows: so many times k different ones are looked at.
SURE = 8

Batches = Iterator[pa.RecordBatch]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and the vector as doubles, of the rows that can take part, whatever their length."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
    ).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return rows.filter(F.forall("v", finite) & F.exists("v", lambda x: x != 0))


def usual_length(rows: DataFrame) -> int:
    found = rows.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return found["length"] if found else 0


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


class Tree:
    """A complete binary tree of planes; node i has children 2i + 1 and 2i + 2."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int) -> None:
        random = np.random.default_rng(seed)
        inner = (1 << depth) - 1
        self.depth = depth
        self.normals, self.offsets = np.zeros((inner, sample.shape[1])), np.zeros(inner)
        held = {0: np.arange(len(sample))}
        for node in range(inner):
            places = held.pop(node)
            points = sample[places]
            normal = np.zeros(sample.shape[1])
            for _ in range(8):
                if len(points) < 2:
                    break
                a, b = points[random.choice(len(points), 2, replace=False)]
                if (a != b).any():
                    normal = (a - b) / np.linalg.norm(a - b)
                    break
            if not normal.any():
                # Nothing left to tell apart: any direction will do.
                normal = random.standard_normal(sample.shape[1])
                normal /= np.linalg.norm(normal)
            sides = points @ normal
            self.normals[node] = normal
            self.offsets[node] = np.median(sides) if len(sides) else 0.0
            right = sides > self.offsets[node]
            held[2 * node + 1], held[2 * node + 2] = places[~right], places[right]

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector, from 0."""
        node = np.zeros(len(vectors), np.int64)
        for _ in range(self.depth):
            side = np.einsum("ij,ij->i", vectors, self.normals[node]) > self.offsets[node]
            node = 2 * node + 1 + side
        return node - ((1 << self.depth) - 1)


def probed(query: np.ndarray, trees: list[Tree], sizes: np.ndarray, bound: float, most: float,
           least: int) -> list[tuple[int, int]]:
    """The (tree, leaf) to visit, by one priority queue over all trees.

    Leaves of one tree have no row in common, so a tree that holds ``least`` entries holds as many rows.
    """
    inner = (1 << trees[0].depth) - 1
    sides = [(t.normals @ query - t.offsets).tolist() for t in trees]
    queue = [(0.0, number, 0) for number in range(len(trees))]
    found, held, of_tree = [], 0, [0] * len(trees)
    while queue and (held < most or max(of_tree) < least):
        beyond, number, node = heapq.heappop(queue)
        if beyond > bound:
            break
        while node < inner:
            side = sides[number][node]
            near, far = (2 * node + 2, 2 * node + 1) if side > 0 else (2 * node + 1, 2 * node + 2)
            heapq.heappush(queue, (max(beyond, abs(side)), number, far))
            node = near
        leaf = node - inner
        if sizes[number, leaf]:
            found.append((number, leaf))
            held += int(sizes[number, leaf])
            of_tree[number] += int(sizes[number, leaf])
    return found


def index(trees: list[Tree]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            vectors = matrix(batch.column("v"))
            for number, tree in enumerate(trees):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(vectors), number, np.int32)), pa.array(tree.leaves(vectors).astype(np.int32)),
                    batch.column("vec_id"), batch.column("row"), batch.column("v"),
                ], names=["tree", "leaf", "vec_id", "row", "v"])
    return run


def probe(trees: list[Tree], sizes: np.ndarray, sample: np.ndarray, sample_ids: np.ndarray, k: int,
          share: float) -> Callable[[Batches], Batches]:
    most = share * sizes.sum() / len(trees)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            queries = matrix(batch.column("v"))
            rows, leaves = [], []
            asked_ids, owns = batch.column("vec_id").to_pylist(), batch.column("own").to_pylist()
            for number, (query, asked, own) in enumerate(zip(queries, asked_ids, owns, strict=True)):
                # Points with the query's id are left out, as it can't find them; a little more for rounding.
                near = np.sqrt(((sample - query) ** 2).sum(1))[sample_ids != asked]
                bound = float(np.partition(near, k - 1)[k - 1]) * (1 + 1e-9) + 1e-12 if len(near) >= k else np.inf
                visits = probed(query, trees, sizes, bound, most, SURE * k + own)
                rows += [number] * len(visits)
                leaves += visits
            if rows:
                taken = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([
                    pa.array([t for t, _ in leaves], pa.int32()), pa.array([x for _, x in leaves], pa.int32()),
                    taken.column("query"), taken.column("vec_id"),
                ], names=["tree", "leaf", "query", "query_id"])
    return run


def rank_block(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Each query's nearest rows of one block, by exact distance."""
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "row", "score"]
        found: list[list[np.ndarray]] = [[], [], [], []]
        if len(queries) and len(rows):
            points, ids = matrix(rows.column("v").combine_chunks()), rows.column("vec_id").to_numpy()
            numbers = rows.column("row").to_numpy()
            for at in range(0, len(queries), 256):
                part = queries.slice(at, 256)
                asked = part.column("query_id").to_numpy()
                wanted = matrix(part.column("q").combine_chunks())
                rough = (points ** 2).sum(1)[None, :] - 2 * wanted @ points.T
                rough[asked[:, None] == ids[None, :]] = np.inf
                width = min(len(ids), k + 8)
                near = np.argpartition(rough, width - 1, axis=1)[:, :width]
                # Rough distances only choose; whatever ties with the last one chosen is looked at as well.
                edge = np.take_along_axis(rough, near, 1).max(1)
                slack = 1e-9 * (1 + np.abs(rough).max(initial=0, where=np.isfinite(rough)))
                for i, query in enumerate(asked):
                    chosen = np.nonzero((rough[i] <= edge[i] + slack) & (ids != query))[0]
                    exact = np.sqrt(((points[chosen] - wanted[i]) ** 2).sum(1))
                    best = np.lexsort((ids[chosen], exact))[:k]
                    found[0].append(np.full(len(best), query))
                    found[1].append(ids[chosen[best]])
                    found[2].append(numbers[chosen[best]])
                    found[3].append(exact[best])
        kinds = (np.int64, np.int64, np.int64, np.float64)
        return pa.table([
            pa.array(np.concatenate(c).astype(t) if c else np.zeros(0, t)) for c, t in zip(found, kinds, strict=True)
        ], names=names)
    return run


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = NEAREST, trees: int = TREES, depth: int = DEPTH, share: float = SHARE,
            sample_rows: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's ``k`` nearest rows found."""
    names = "query_id long, vec_id long, row long, score double"
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    length = usual_length(rows)
    rows = rows.filter(F.size("v") == length)
    # The limit on copies stands below the shuffle.
    copies = Window.partitionBy("v").orderBy("vec_id")
    rows = rows.distinct().withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).drop("copy")
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "ann-vectors")
    total = rows.count()
    # By id and vector, as one id may stand on any share of the rows.
    chosen = sampled(rows, F.struct("vec_id", "v"), sample_rows, total).orderBy("vec_id", "v").collect()
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.array([r["v"] for r in chosen], float)
    sample_ids = np.array([r["vec_id"] for r in chosen], np.int64)
    depth = max(depth, int(np.log2(max(1, total // block))))
    depth = max(0, min(depth, int(np.log2(max(1, len(sample) // LEAST_LEAF)))))
    forest = [Tree(sample, depth, seed) for seed in range(trees)]
    indexed = rows.mapInArrow(index(forest), "tree int, leaf int, vec_id long, row long, v array<double>")
    sizes = np.zeros((trees, 1 << depth), np.int64)
    for r in indexed.groupBy("tree", "leaf").count().collect():
        sizes[r["tree"], r["leaf"]] = r["count"]
    # How many rows each query has to pass over, as they have its id.
    own = rows.groupBy(F.col("vec_id").alias("own_id")).agg(F.count("*").alias("own"))
    asked = usable(queries, id_col, vector_col).filter(F.size("v") == length).distinct()
    asked = staged(
        asked.join(own, F.col("vec_id") == F.col("own_id"), "left")
        .select(F.monotonically_increasing_id().alias("query"), "vec_id", "v", F.coalesce("own", F.lit(0)).alias("own")),
        "ann-queries",
    )
    visits = staged(asked.mapInArrow(
        probe(forest, sizes, sample, sample_ids, k, share), "tree int, leaf int, query long, query_id long"
    ), "ann-visits")
    visitors = visits.groupBy("tree", "leaf").count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("most")).first()["most"]
    asked = visits.join(asked.select("query", F.col("v").alias("q")), "query")
    blocks, shares = int(sizes.max()) // block + 1, visitors // block + 1

    def dealt(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int") if n > 1 else F.lit(0)

    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))) if n > 1 else F.lit(0)

    # Each block of a leaf's rows meets each share of its queries once.
    indexed = indexed.withColumn("block", dealt("row", blocks)).withColumn("share", everywhere(shares))
    asked = asked.withColumn("share", dealt("query", shares)).withColumn("block", everywhere(blocks))
    keys = ("tree", "leaf", "block", "share")
    found = asked.groupBy(*keys).cogroup(indexed.groupBy(*keys)).applyInArrow(rank_block(k), names)
    # A row is found in several trees, and by each vector of its query.
    found = found.groupBy("query_id", "vec_id", "row").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int"), "vec_id", "score"
    )


def hundredth(vectors: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """The stated query set: rows whose id is divisible by 100."""
    return vectors.filter(F.col(id_col) % EVERY == 0)
