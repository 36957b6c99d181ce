"""Classification metrics from one pass over labels and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txrisk.operators.ranges import average_ranks


def confusion(scored: DataFrame) -> DataFrame:
    """(label, prediction, count)."""
    return (
        scored.groupBy(F.col("label").cast("int").alias("label"),
                       F.col("prediction").cast("int").alias("prediction"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def classification_metrics(scored: DataFrame) -> DataFrame:
    """One row: accuracy, precision and recall of both classes, weighted F1, hard-label AUROC.

    Every label and prediction counts, whatever classes there are; rows without one are left out. The rows
    are counted by (label, prediction) once, all else is computed on those few counts. ``auroc_hard`` is
    the area under the curve of the 0/1 predictions, labels above 0.5 being the positives.
    """
    label, guess, n = F.col("label").cast("double"), F.col("prediction").cast("double"), F.col("n")
    cells = (
        scored.select(label.alias("label"), guess.alias("guess")).filter("label IS NOT NULL AND guess IS NOT NULL")
        .groupBy("label", "guess").agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    none = F.lit(0.0)

    def counted(test: Column) -> Column:
        return F.when(test, n).otherwise(none)

    positive, hit = F.col("label") > 0.5, F.col("guess") > 0.5
    sides = F.explode(F.array(
        F.struct(F.col("label").alias("kind"), n.alias("actual"), none.alias("guessed"),
                 counted(F.col("label") == F.col("guess")).alias("right"), counted(positive).alias("positives"),
                 counted(positive & hit).alias("hits"), counted(~positive & hit).alias("false_hits")),
        F.struct(F.col("guess").alias("kind"), none.alias("actual"), n.alias("guessed"), none.alias("right"),
                 none.alias("positives"), none.alias("hits"), none.alias("false_hits")),
    ))
    sums = ("actual", "guessed", "right", "positives", "hits", "false_hits")
    kinds = cells.select(sides.alias("side")).groupBy("side.kind").agg(
        *(F.sum(f"side.{c}").alias(c) for c in sums)
    )
    precision, recall = (_share(F.col("right"), F.col(c)) for c in ("guessed", "actual"))
    f1 = _share(2 * precision * recall, precision + recall)

    def of_kind(kind: int, value: Column) -> Column:
        return F.coalesce(F.max(F.when(F.col("kind") == kind, value)), none)

    totals = kinds.agg(
        *(F.coalesce(F.sum(c), none).alias(c) for c in sums),
        F.coalesce(F.sum(f1 * F.col("actual")), none).alias("weighted"),
        *(of_kind(k, v).alias(f"{name}_{k}")
          for k in (0, 1) for name, v in (("precision", precision), ("recall", recall))),
    )
    negatives = F.col("actual") - F.col("positives")
    # With one class missing the curve degenerates to an edge of the unit square.
    area = (
        F.when(F.col("positives") == 0, 0.0)
        .when(negatives == 0, 1.0)
        .otherwise((1 + F.col("hits") / F.col("positives") - F.col("false_hits") / negatives) / 2)
    )
    return totals.select(
        _share(F.col("right"), F.col("actual")).alias("accuracy"),
        "precision_0", "recall_0", "precision_1", "recall_1",
        _share(F.col("weighted"), F.col("actual")).alias("f1"),
        area.alias("auroc_hard"),
    )


def score_auroc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row: rows, positives, and the area under the curve of the scores, no point of it left out.

    The area is that of the rank sum: the share of pairs of a positive and a negative in which the positive
    scores higher, ties counting half. Rows are combined by score, and ranks come from ranges of scores, so neither
    a score that many rows have nor many scores end up in one task. The sum is exact (38 digits). Rows without a score or
    label are left out; with one class missing the curve degenerates to an edge of the unit square.
    """
    known = scored.select(
        F.col(score).cast("double").alias("score"), (F.col(label).cast("double") > 0.5).cast("long").alias("positives")
    ).filter("score IS NOT NULL AND positives IS NOT NULL")
    ranks = average_ranks(known, "score", "positives")

    def exact(number: Column) -> Column:
        return number.cast("decimal(19,0)")

    sums = ranks.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"),
        F.sum(exact(F.col("positives")) * exact(F.col("twice_rank"))).alias("twice_ranks"),
    )
    positives, negatives = F.col("positives"), F.col("rows") - F.col("positives")
    # Less the ranks that the positives would have among themselves.
    over = (F.col("twice_ranks") - exact(positives) * exact(positives + 1)).cast("double")
    area = F.when(positives == 0, 0.0).when(negatives == 0, 1.0).otherwise(
        over / (2.0 * positives.cast("double") * negatives.cast("double"))
    )
    return sums.select("rows", "positives", area.alias("auroc_score"))
