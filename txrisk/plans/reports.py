"""The reports over the predictions table.

Each report takes either the predictions themselves or their ``summary``. One report alone is best
run on the predictions, where it reads two or three columns; to run them all, summarise first and the
table is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txrisk import values as V
from txrisk.operators.ranking import top_ranked
from txrisk.operators.reductions import last_values, legend_figures, with_share

LEADER_COLUMNS = ("transactionId", "userId", "amount", "location", "device", "merchant", "fraud_reason")
SUMMARY_KEYS = ("prediction", "merchant", "device", "location", "fraud_reason")


def summary(predictions: DataFrame) -> DataFrame:
    """Row count, amount sum and amount count for every combination of the report keys."""
    return predictions.groupBy(*SUMMARY_KEYS).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("amount").alias("amount_sum"),
        F.count("amount").alias("amount_count"),
    )


def add_summaries(summaries: DataFrame) -> DataFrame:
    """One summary of several: counts and sums are added up."""
    figures = ("row_count", "amount_sum", "amount_count")
    return summaries.groupBy(*SUMMARY_KEYS).agg(*(F.sum(c).alias(c) for c in figures))


def _row_count(rows: DataFrame) -> Column:
    return F.sum("row_count") if "row_count" in rows.columns else F.count(F.lit(1))


def _amount_sum(rows: DataFrame) -> Column:
    return F.sum("amount_sum" if "amount_sum" in rows.columns else "amount")


def _amount_mean(rows: DataFrame) -> Column:
    if "amount_sum" in rows.columns:
        return F.try_divide(F.sum("amount_sum"), F.sum("amount_count"))
    return F.avg("amount")


def _flagged(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("prediction") == 1.0)


def _largest_first(rows: DataFrame, measure: str, key: str) -> DataFrame:
    """Descending with nulls first, as the serving database sorts; the key settles ties."""
    return rows.orderBy(F.col(measure).desc_nulls_first(), F.col(key).asc())


def merchant_exposure(rows: DataFrame) -> DataFrame:
    """Flagged amount per merchant."""
    return _flagged(rows).groupBy("merchant").agg(_amount_sum(rows).alias("sum"))


def fraud_transactions(predictions: DataFrame) -> DataFrame:
    """All flagged rows."""
    return _flagged(predictions)


def user_top3(predictions: DataFrame, folder: str | None = None) -> DataFrame:
    """Each user's flagged transactions of rank 3 or better by amount; ties share their rank.

    Takes the predictions or the ``leaders`` of parts of them, as whoever is in the top of all is in that of their part.
    ``folder`` is where it keeps what it writes.
    """
    rows = _flagged(predictions) if "prediction" in predictions.columns else predictions
    return top_ranked(rows.select(*LEADER_COLUMNS), "userId", "amount", V.TOP_RANK, "fraud_rank", folder)


def leaders(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows of ``user_top3`` without their rank, of predictions or of other leaders."""
    return user_top3(rows, folder).drop("fraud_rank")


def device_counts(rows: DataFrame) -> DataFrame:
    """Transactions per device."""
    counts = rows.groupBy("device").agg(_row_count(rows).alias("transaction_count"))
    return _largest_first(counts, "transaction_count", "device")


def merchant_contribution(rows: DataFrame) -> DataFrame:
    """Flagged amount per merchant, largest first."""
    sums = _flagged(rows).groupBy("merchant").agg(_amount_sum(rows).alias("fraud_amount"))
    return _largest_first(sums, "fraud_amount", "merchant")


def prediction_counts(rows: DataFrame) -> DataFrame:
    """Transactions per prediction."""
    return rows.groupBy("prediction").agg(_row_count(rows).alias("total_transactions"))


def reason_breakdown(rows: DataFrame) -> DataFrame:
    """Flagged transactions per reason text."""
    counts = _flagged(rows).groupBy("fraud_reason").agg(_row_count(rows).alias("count"))
    return _largest_first(counts, "count", "fraud_reason")


def average_amount(rows: DataFrame) -> DataFrame:
    """Mean amount of flagged and of normal transactions."""
    return rows.groupBy("prediction").agg(_amount_mean(rows).alias("avg_amount"))


def location_counts(rows: DataFrame) -> DataFrame:
    """Flagged transactions per location."""
    counts = _flagged(rows).groupBy("location").agg(_row_count(rows).alias("fraud_count"))
    return _largest_first(counts, "fraud_count", "location")


def merchant_share(rows: DataFrame) -> DataFrame:
    """Each merchant's part of the flagged amount."""
    sums = _flagged(rows).groupBy("merchant").agg(_amount_sum(rows).alias("fraud_amount"))
    return with_share(sums, "fraud_amount")


def location_share(rows: DataFrame) -> DataFrame:
    """Each location's part of the flagged transactions."""
    counts = _flagged(rows).groupBy("location").agg(_row_count(rows).alias("fraud_count"))
    return with_share(counts, "fraud_count")


def last_not_null(predictions: DataFrame, rows: DataFrame | None = None,
                  ranked: DataFrame | None = None) -> DataFrame:
    """The figures of the three panels that show the last value of each numeric field.

    Last means last by key: user, rank and transaction for the top three, the prediction for the
    other two. ``rows`` may be the summary, ``ranked`` the top-three report if it is at hand.
    """
    rows = predictions if rows is None else rows
    ranked = user_top3(predictions) if ranked is None else ranked
    leaders = last_values(
        ranked,
        [("user_top3", "userId"), ("user_top3", "amount"), ("user_top3", "fraud_rank")],
        ["userId", "fraud_rank", "transactionId"],
    )
    by_prediction = rows.groupBy("prediction").agg(
        _row_count(rows).alias("total_transactions"), _amount_mean(rows).alias("avg_amount")
    )
    grouped = last_values(
        by_prediction,
        [("prediction_counts", "prediction"), ("prediction_counts", "total_transactions"),
         ("average_amount", "prediction"), ("average_amount", "avg_amount")],
        ["prediction"],
    )
    return leaders.unionByName(grouped)


def merchant_legend(rows: DataFrame) -> DataFrame:
    """Least, last (by merchant) and mean flagged amount over the merchants."""
    return legend_figures(merchant_exposure(rows), "sum", "merchant")


# Reports that may also run on the summary.
SUMMARY_REPORTS = {
    "merchant_exposure": merchant_exposure,
    "device_counts": device_counts,
    "merchant_contribution": merchant_contribution,
    "prediction_counts": prediction_counts,
    "reason_breakdown": reason_breakdown,
    "average_amount": average_amount,
    "location_counts": location_counts,
    "merchant_share": merchant_share,
    "location_share": location_share,
    "merchant_legend": merchant_legend,
}

# Reports that list transactions.
ROW_REPORTS = {
    "fraud_transactions": fraud_transactions,
    "user_top3": user_top3,
}


def write_all(predictions: DataFrame, folder: str, summaries: DataFrame | None = None,
              leading: DataFrame | None = None) -> None:
    """Writes every report below ``folder``.

    The grouped reports read the written summary, so together they scan the predictions once, and the
    last values read the written ranking. With the ``summaries`` and leaders (``leading``) of all batches at hand, only the list of
    flagged transactions reads predictions.
    """
    spark = predictions.sparkSession
    figures = summary(predictions) if summaries is None else add_summaries(summaries)
    figures.write.mode("overwrite").parquet(f"{folder}/summary")
    rows = spark.read.parquet(f"{folder}/summary")
    frames = {name: report(rows) for name, report in SUMMARY_REPORTS.items()}
    frames["fraud_transactions"] = fraud_transactions(predictions)
    frames["user_top3"] = user_top3(predictions if leading is None else leading)
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
    ranked = spark.read.parquet(f"{folder}/user_top3")
    last = last_not_null(predictions, rows, ranked)
    last.write.mode("overwrite").parquet(f"{folder}/last_not_null")
