"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Ratings become grades: 0 for low quality, 1 for good quality but toxic, 2 for good and not toxic. With one
score s(text) for all grades and ordered thresholds, P(grade <= k) = sigmoid(threshold_k - s). The score is
linear in hashed text features, their weights shared by all thresholds. Expected grade and tail
probabilities follow; a document is kept if P(grade = 2) reaches ``least``.

Features are the words of the whole text as a set (ASCII letters lowered, edge punctuation off) and the first
bytes of longer ones, scaled to unit length so that long texts don't outweigh short ones, and a few shape words: in
steps, the share of words that repeat the one before, that are distinct, that end in a symbol, and the number of
words.

The fit takes about ``max_rated`` rated documents, those chosen by a hash of their ids, with features in at least
``least_documents`` of them: a bound on what reaches the driver, whatever the input. Sampled ids
are broadcast (8 bytes each). Fitting is full-batch gradient descent with per-weight steps and an absolute penalty
that leaves few weights, so it is deterministic. Scoring streams over all documents without a shuffle; the weights are one array of
``2 ** bits`` floats.

A null text counts as empty. Ratings that are null or rate no given document are left out; a document
rated twice counts twice. Without any usable rating nothing is known: every document is kept, with a
null expected grade. Repeated rows are scored alike, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from txrisk.llm.common import new_name, sampled

BITS = 18
MAX_RATED = 10_000
LEAST_DOCUMENTS = 8
STEPS = 300
RATE = 1.0
PENALTY = 1e-5
STEM = 4
LEAST = 0.7
GRADES = 3
REMEMBERED = 150_000
EDGES = b".,;:!?\"'()[]|*$%&#"


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... as columns."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))


def _step(share: float) -> int:
    """0 to 8: how often the share has to be doubled to pass one half; rare things are told apart too."""
    step = 0
    while share < 0.5 and step < 8:
        share, step = share * 2, step + 1
    return step


def word_bucket(word: bytes, bits: int) -> int:
    return crc32(word) & ((1 << bits) - 1)


def shape_words(words: list[bytes], distinct: set[bytes]) -> list[bytes]:
    n = len(words)
    if not n:
        return [b"\0empty"]
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    symbols = sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:!?" for w in words)
    return [
        b"\0repeat%d" % _step(repeats / n), b"\0distinct%d" % _step(len(distinct) / n),
        b"\0symbol%d" % _step(symbols / n), b"\0length%d" % n.bit_length(),
    ]


Features = tuple[Sequence[int], Sequence[int]]


def buckets(text: str, known: dict[bytes, tuple[int, ...]], bits: int) -> Features:
    """The distinct buckets of a text's words, and those of its shape; ``known`` remembers words seen."""
    words = text.encode().lower().split()
    distinct = set(words)
    found = set()
    for word in distinct:
        held = known.get(word)
        if held is None:
            if len(known) > REMEMBERED:
                known.clear()
            bare = word.strip(EDGES)
            held = known[word] = (word_bucket(bare, bits), word_bucket(b"\1" + bare[:STEM], bits))[:1 + (len(bare) > STEM)]
        found.update(held)
    return sorted(found), [word_bucket(s, bits) for s in shape_words(words, distinct)]


def values(features: Features) -> np.ndarray:
    words, shape = features
    return np.concatenate([np.full(len(words), 1 / np.sqrt(max(1, len(words)))), np.ones(len(shape))])


def featurise(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, ...]] = {}
        for batch in batches:
            found = [buckets(t or "", known, bits) for t in batch.column("text").to_pylist()]
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([w for w, _ in found], lists), pa.array([s for _, s in found], lists)],
                names=["doc_id", "words", "shape"],
            )
    return run


def fit_ordinal(features: list[Features], grades: np.ndarray, bits: int = BITS, counts: np.ndarray | None = None,
                steps: int = STEPS, least_documents: int = LEAST_DOCUMENTS) -> OrdinalModel:
    """Maximum likelihood of the cumulative-link model with a small absolute penalty; ``counts`` are ratings per row."""
    size = 1 << bits
    flat = np.concatenate([np.asarray(part, np.int32) for f in features for part in f])
    value = np.concatenate([values(f) for f in features])
    rows = np.repeat(np.arange(len(features), dtype=np.int32), [len(w) + len(s) for w, s in features])
    common = (np.bincount(flat, minlength=size) >= least_documents)[flat]
    rows, flat, value = rows[common], flat[common], value[common]
    counts = np.ones(len(features)) if counts is None else counts
    n = counts.sum()
    weights, moments = np.zeros(size), np.full(size, 1e-8)
    # Start at the grades' own frequencies; absent grades leave thresholds apart, not infinite.
    at_most = (np.bincount(grades, counts, minlength=GRADES).cumsum()[:-1] + 0.5) / (n + 1)
    start = np.log(at_most / (1 - at_most))
    # The first threshold and the logarithms of the gaps keep the thresholds ordered.
    cut = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    cut_moments = np.full(len(cut), 1e-8)
    for _ in range(steps):
        thresholds = np.cumsum(np.concatenate([cut[:1], np.exp(cut[1:])]))
        scores = np.bincount(rows, value * weights[flat], minlength=len(features))
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        with np.errstate(over="ignore"):
            upper = 1 / (1 + np.exp(-(edges[grades + 1] - scores)))
            lower = 1 / (1 + np.exp(-(edges[grades] - scores)))
        chance = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        d_upper, d_lower = counts * d_upper, counts * d_lower
        d_score = (d_upper - d_lower) / n
        slope = np.bincount(flat, value * d_score[rows], minlength=size)
        d_edges = np.zeros(GRADES + 1)
        np.add.at(d_edges, grades + 1, -d_upper / n)
        np.add.at(d_edges, grades, d_lower / n)
        d_thresholds = d_edges[1:-1]
        onward = d_thresholds[::-1].cumsum()[::-1]
        d_cut = np.concatenate([onward[:1], onward[1:] * np.exp(cut[1:])])
        moments += slope ** 2
        cut_moments += d_cut ** 2
        pace = RATE / np.sqrt(moments)
        weights -= pace * slope
        weights = np.sign(weights) * np.maximum(np.abs(weights) - PENALTY * pace, 0)
        cut -= RATE * d_cut / np.sqrt(cut_moments)
    thresholds = np.cumsum(np.concatenate([cut[:1], np.exp(cut[1:])]))
    return OrdinalModel(weights.astype(np.float32), thresholds)


def graded(labels: DataFrame) -> DataFrame:
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.filter(
        F.col("quality").isin(0, 1) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
    ).select(F.col("doc_id").cast("long").alias("rated_id"), grade.alias("grade"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_rated: int = MAX_RATED, bits: int = BITS) -> OrdinalModel | None:
    """Fits on the rated documents, or None if there are none."""
    # Ratings are counted first: an id with any number of them is one of the ids that are drawn, with a row per grade.
    counted = graded(labels).groupBy("rated_id", "grade").agg(F.count("*").alias("n"))
    ids = counted.select("rated_id").distinct().count()
    rated = sorted(sampled(counted, "rated_id", max_rated, ids).collect())
    if not rated:
        return None
    spark = docs.sparkSession
    # At most max_rated ids, so their size is bounded.
    ids = spark.createDataFrame([(i,) for i in sorted({r["rated_id"] for r in rated})], "rated_id long")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(ids), F.col("doc_id") == F.col("rated_id"), "left_semi"
    )
    # A repeated id gives one document, so the sample stays within its bound.
    found = texts.mapInArrow(featurise(bits), "doc_id long, words array<int>, shape array<int>")
    found = found.groupBy("doc_id").agg(F.min(F.struct("words", "shape")).alias("of"))
    found = found.select("doc_id", "of.words", "of.shape").toArrow()
    by_id = {
        key: (words.values.to_numpy(), shape.values.to_numpy())
        for key, words, shape in zip(found["doc_id"].to_pylist(), found["words"], found["shape"], strict=True)
    }
    rated = [(by_id[r["rated_id"]], r["grade"], r["n"]) for r in rated if r["rated_id"] in by_id]
    if not rated:
        return None
    features, grades, counts = zip(*rated, strict=True)
    return fit_ordinal(features, np.array(grades), bits, np.array(counts, float))


def scorer(model: OrdinalModel, text_col: str, bits: int,
           schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the tail probabilities to batches, leaving their own columns as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, ...]] = {}
        weights = model.weights.astype(np.float64)
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            found = [buckets(t or "", known, bits) for t in texts]
            scores = np.array([values(f) @ weights[f[0] + f[1]] for f in found], float)
            tails = model.tails(scores)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(np.ascontiguousarray(tails[:, k])) for k in range(GRADES - 1))],
                names=[*batch.schema.names, *schema.names],
            )
    return run


def scored(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text",
           bits: int = BITS) -> tuple[DataFrame, list[str]]:
    """The documents with P(grade >= k) in new columns, and the names of these."""
    names = []
    for k in range(1, GRADES):
        names.append(new_name(docs, f"p_grade_{k}"))
    if model is None:
        return docs.withColumns({n: F.lit(None).cast("double") for n in names}), names
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    extra = pa.schema([(n, pa.float64()) for n in names])
    return docs.mapInArrow(scorer(model, text_col, bits, extra), schema), names


def quality_grades(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   least: float = LEAST) -> DataFrame:
    """One row per document: doc_id, expected_grade, p_grade_1, p_grade_2 and kept."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows, names = scored(docs, train(docs, labels), "text")
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return rows.select(
        "doc_id", total.alias("expected_grade"), *names, F.coalesce(F.col(names[-1]) >= least, F.lit(True)).alias("kept")
    )


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             least: float = LEAST) -> DataFrame:
    """The documents that are kept, with their own columns."""
    rows, names = scored(docs, train(docs, labels, id_col, text_col), text_col)
    return rows.filter(F.coalesce(F.col(names[-1]) >= least, F.lit(True))).select(*docs.columns)
