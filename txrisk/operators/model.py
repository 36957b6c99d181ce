"""The classifier: build, fit, save, load, score."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from txrisk import values as V
from txrisk.operators.features import (
    INDEX_SUFFIX, assembler, fit_category_indexers,
)
from txrisk.session import shared_dir

# Columns the fitted pipeline adds. Rows that already have one of them cannot be scored.
SCORE_COLUMNS = (
    *(c + INDEX_SUFFIX for c in V.CATEGORIES),
    "features", "rawPrediction", "probability", "prediction",
)

# The tree learner's own default.
LEAST_BINS = 32

TRAINING_COLUMNS = ("userId", "amount_log", *V.CATEGORIES, "label", "weight")


def classifier(max_iter: int = V.MAX_ITER, **params) -> GBTClassifier:
    """Weighted gradient-boosted trees. ``params`` override the defaults below by name."""
    settings = {
        "maxIter": max_iter,
        "maxDepth": V.MAX_DEPTH,
        "stepSize": V.STEP_SIZE,
        "subsamplingRate": V.SUBSAMPLING_RATE,
        **params,
    }
    return GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", **settings)


def reject_cause(unreadable: Column | None = None) -> Column:
    """Why the classifier cannot learn from a labelled row with ``amount_log``, null if it can.

    The causes are those of a message that cannot be scored, and those of its label. ``unreadable`` is the text that the
    JSON reader could not read, where it was asked to keep it: a field that is there but broken is no missing one.
    """
    amount, label = F.col("amount"), F.col("label")
    fields = [F.col(c).isNull() for c in ("transactionId", "userId", "amount", "label", *V.CATEGORIES)]
    return (
        F.when(reduce(Column.__and__, fields), "unreadable line")
        .when(F.col("transactionId").isNull(), "no transaction")
        .when(label.isNull(), "no label")
        .when(~label.isin(0, 1), "label outside 0 and 1")
        .when(F.col("userId").isNull(), "no user")
        .when(amount.isNull(), "no amount")
        .when(F.isnan(amount.cast("double")), "amount is not a number")
        .when(amount == float("inf"), "amount is infinite")
        .when(F.col("amount_log").isNull(), "amount has no log")
        .when(F.lit(False) if unreadable is None else unreadable.isNotNull(), "unreadable field")
    )


def fit(train: DataFrame, indexers: list[StringIndexerModel] | None = None,
        max_iter: int = V.MAX_ITER, **params) -> PipelineModel:
    """Fits indexers, assembler and classifier on labelled, weighted rows with ``amount_log``.

    Rows with a ``reject_cause`` are an error here, the training job sets them aside before.
    Boosting passes over the training rows once per tree level and keeps them as binned points, in
    the partitions they come in. The shared checkpoint folder cuts the lineage of the per-tree
    errors, so a lost executor costs one interval of trees and not all of them.
    """
    shared_dir(train.sparkSession)
    rows = train.select(*TRAINING_COLUMNS)
    if indexers is None:
        indexers = fit_category_indexers(rows)
    # A bin for each value of the largest column and one for unseen values.
    bins = max((len(i.labels) + 1 for i in indexers), default=0)
    params.setdefault("maxBins", max(LEAST_BINS, bins))
    return Pipeline(stages=[*indexers, assembler(), classifier(max_iter, **params)]).fit(rows)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds the model's columns and ``fraud_probability``, replacing an earlier prediction."""
    stale = [c for c in SCORE_COLUMNS if c in rows.columns]
    scored = model.transform(rows.drop(*stale))
    return scored.withColumn("fraud_probability", vector_to_array("probability")[1])
