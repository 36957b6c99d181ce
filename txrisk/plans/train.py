"""Training job: labelled transactions to a saved model and its metrics.

    python -m txrisk.plans.train --input /data/labelled --model /models/risk
"""

from __future__ import annotations

import argparse
import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txrisk import values as V
from txrisk.schema import CORRUPT_COLUMN
from txrisk.functions.draws import key_draw
from txrisk.operators import model as classifier
from txrisk.operators.classes import with_class_weights, with_exact_split, with_random_split, with_split
from txrisk.operators.features import fit_category_indexers
from txrisk.operators.metrics import classification_metrics, score_auroc
from txrisk.operators.predictions import with_log_amount
from txrisk.session import get_spark, shared_dir, size_shuffles, work_dir
from txrisk.sources import folders
from txrisk.sources.files import read_json

# Parts the rows are dealt into for the fit: their number depends on that of the rows alone. Each task of each tree level
# sends its metrics to the driver, so beyond so many parts their number and their rows grow alike, with the root of all rows.
ROWS_PER_PART = 100_000
LEAST_PARTS = 8
EVEN_PARTS = 100

# By the hash of the id row by row, by its order to the exact share, or by Spark's own draw.
SPLITS = ("hash", "exact", "random")
STAGED_COLUMNS = ("transactionId", "userId", "amount", "amount_log", *V.CATEGORIES, "label", "split", "cause")
PLACED_BY = ("transactionId", "userId", "amount_log", *V.CATEGORIES, "label")
REJECTED = "rejected"


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    rejects: DataFrame


def stage(labelled: DataFrame, draw: Column | None = None, folder: str | None = None, split: str = SPLITS[0]) -> DataFrame:
    """Writes the prepared rows once, one folder per side of the split, and reads them back.

    Everything after this is several passes over a few columns: they run on a columnar table in
    shared storage, not on re-parsed input, and a lost executor re-reads its part of it. Rows the
    classifier cannot take make a third side, with their ``cause``. ``folder`` is overwritten; by default
    each call gets a new one below the checkpoint folder. ``split`` is one of ``SPLITS``.
    """
    spark = labelled.sparkSession
    path = folder or work_dir(spark, "training")
    unreadable = F.col(CORRUPT_COLUMN) if CORRUPT_COLUMN in labelled.columns else None
    rows = with_log_amount(labelled)
    rows = {
        "hash": lambda: with_split(rows, draw), "exact": lambda: with_exact_split(rows, draw),
        "random": lambda: with_random_split(rows),
    }[split]().withColumn("cause", classifier.reject_cause(unreadable))
    rows = rows.withColumn("split", F.when(F.col("cause").isNotNull(), REJECTED).otherwise(F.col("split")))
    # The time is no feature, but a JSON reader looks for faults in the fields that are asked for only.
    rows = rows.select(*STAGED_COLUMNS, *(c for c in ("timestamp",) if c in labelled.columns))
    rows.write.mode("overwrite").partitionBy("split").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def sides(staged: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train and test side with their weights, and the rejected rows.

    The classes are counted over all rows, rejected ones among them.
    """
    weighted = with_class_weights(staged)
    train_rows, test_rows = (
        weighted.filter(F.col("split") == side).drop("cause") for side in ("train", "test")
    )
    return train_rows, test_rows, staged.filter(F.col("split") == REJECTED)


def reject_counts(rejects: DataFrame) -> DataFrame:
    """(cause, count)."""
    return rejects.groupBy("cause").agg(F.count(F.lit(1)).alias("count"))


def part_count(rows: int) -> int:
    """Parts for so many rows to fit on."""
    even = -(-rows // ROWS_PER_PART)
    return max(LEAST_PARTS, min(even, math.isqrt(even * EVEN_PARTS)))


def placed(rows: DataFrame, most: int | None = None) -> DataFrame:
    """The rows to fit on, all of them, in parts and an order that follow from the rows alone.

    Subsampling and the choice of bins go by part and place, so the same rows give the same model
    from any files and on any number of cores. Only a caller who names ``most`` gets a share of so many, drawn by the hash
    of the row; no query does.

    They are checkpointed, parts and order as they are: each task of each tree level would otherwise send back the
    metrics of the whole plan behind them, which is most of what a fit sends to the driver.
    """
    shared_dir(rows.sparkSession)
    total = rows.count()
    if most is not None and total > most:
        rows = rows.filter(key_draw(F.struct(*PLACED_BY), V.SPLIT_SEED + 1) < most / total)
        total = most
    return rows.repartition(part_count(total), *PLACED_BY).sortWithinPartitions(*PLACED_BY).checkpoint()


def train(labelled: DataFrame, max_iter: int = V.MAX_ITER, draw: Column | None = None,
          staging: str | None = None, max_fit_rows: int | None = None, split: str = SPLITS[0], **params) -> Trained:
    """Weights, split, category indices (from all rows) and the fitted classifier (from all of the train side)."""
    staged = stage(labelled, draw, staging, split)
    train_rows, test_rows, rejects = sides(staged)
    indexers = fit_category_indexers(staged)
    model = classifier.fit(placed(train_rows, max_fit_rows), indexers, max_iter, **params)
    return Trained(model, train_rows, test_rows, rejects)


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    """One row: the metrics of the hard predictions, and ``auroc_score`` of the raw scores.

    The test side is scored once and written, as both read all of it.
    """
    spark = test.sparkSession
    path = work_dir(spark, "scored-test")
    scores = classifier.score(model, test).withColumn("score", vector_to_array("rawPrediction")[1])
    scores.select("label", "prediction", "score").write.parquet(path)
    scored = spark.read.parquet(path)
    return classification_metrics(scored).withColumn("auroc_score", score_auroc(scored).select("auroc_score").scalar())


def run(spark: SparkSession, source: str, model_path: str, infer: bool = False,
        max_iter: int = V.MAX_ITER, staging: str | None = None, **params) -> DataFrame:
    """Trains, saves the model and returns its metrics; rejects are counted in ``<model>-rejects``."""
    size_shuffles(spark, folders.size(spark, source))
    rows = read_json(spark, source, infer, keep_unreadable=True)
    trained = train(rows, max_iter, staging=staging, **params)
    classifier.save(trained.model, model_path)
    reject_counts(trained.rejects).write.mode("overwrite").json(f"{model_path.rstrip('/')}-rejects")
    return evaluate(trained.model, trained.test)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="folder of JSON lines")
    parser.add_argument("--model", required=True, help="folder to save the model to")
    parser.add_argument("--infer-schema", action="store_true")
    parser.add_argument("--max-iter", type=int, default=V.MAX_ITER)
    parser.add_argument("--max-depth", type=int, default=V.MAX_DEPTH)
    parser.add_argument("--step-size", type=float, default=V.STEP_SIZE)
    parser.add_argument("--subsampling-rate", type=float, default=V.SUBSAMPLING_RATE)
    parser.add_argument("--max-fit-rows", type=int, help="learn from a share of so many rows instead of all")
    parser.add_argument("--split", choices=SPLITS, default=SPLITS[0], help="how the held-out rows are chosen")
    parser.add_argument("--staging", help="folder for the prepared rows, overwritten by each run")
    options = parser.parse_args()
    spark = get_spark("txrisk-train")
    metrics = run(
        spark, options.input, options.model, options.infer_schema, options.max_iter, options.staging,
        max_fit_rows=options.max_fit_rows, split=options.split, maxDepth=options.max_depth, stepSize=options.step_size,
        subsamplingRate=options.subsampling_rate,
    )
    metrics.show(truncate=False)


if __name__ == "__main__":
    main()
