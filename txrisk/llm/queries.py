"""The registered queries of this package, one per operator, each over its whole table."""

from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from txrisk.llm import (
    ann, bpe, chat, exact_dedup, line_dedup, mixing, packing, phrases, quality, runs, secrets, simhash, substring,
)
from txrisk.llm.common import table


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, folder, "documents"))


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_plan(table(spark, folder, "documents"))


def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return ann.nearest(vectors, ann.hundredth(vectors))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_report(table(spark, folder, "documents"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_grades(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, folder, "documents"))


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.chat_format(table(spark, folder, "conversations"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.substring_dedup(table(spark, folder, "documents"))


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    rows, decoded = bpe.decode(bpe.encode(table(spark, folder, "documents")))
    return rows.select(
        "doc_id", F.expr("octet_length(token_ids) div 4").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2(decoded, 256).alias("decoded_sha256"),
    )


def echoed(doc_id: int | None, words: np.ndarray) -> np.ndarray:
    """The words that the contract of op12 has searched: a tenth of the documents repeat a part of themselves to their end."""
    h, n = crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    return np.concatenate([words[:start], words[start + np.arange(n - start) % period]])


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, folder, "documents"), rewrite=echoed)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))))["run"]
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_line_dedup, op3_source_mix, op4_nearest_neighbours, op5_secret_scan, op6_packing,
        op7_quality_classifier, op8_simhash_groups, op9_chat_format, op10_substring_dedup,
        op11_byte_bpe, op12_periodic_runs, op13_phrase_collocations,
    )
}
