"""A training corpus from the documents: judged, deduplicated, mixed and packed.

Each stage takes (spark, docs, folder of the tables) and works on all that the stage before it kept. ``run`` writes each
stage's rows below the shared folder and reads them back for the next; once they are written, what the stage had staged and
the rows it was given go, so that the folder holds two stages at most and in the end the last one's rows.

Nulls, ties and repeats have the result that the stages' operators state: a null text is an empty one, rows that repeat an
id are documents of their own, of equal rows one stays, and an empty table gives no sequences. Whole texts are judged and
compared, and cut by the mix and the packing only. All columns of documents reach the last stage, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txrisk.llm import exact_dedup, mixing, packing, quality, simhash
from txrisk.llm.common import discard, scratch, staged_at, table


def judge_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the ordinal classifier rejects go."""
    return quality.accepted(docs, table(spark, folder, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts that with the smallest id stays."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return simhash.without_near_copies(docs, shingle=simhash.SHINGLE, distance=simhash.DISTANCE)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each source up to its budget of words; small ones may be passed over several times."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every copy of every document in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", judge_quality),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Neither the classifier nor the tokenizer can be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, given = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark) as held:
            docs, path = staged_at(stage(spark, docs, sf_dir), f"pipeline-{name}")
            held.remove(path)
        if given is not None:
            discard(spark, given)
        given = path
    return docs
