"""Every operator as a query over the ``orders`` table of a folder.

The library itself never rounds. Here amounts are rounded to six places, sums and means to four, as
another engine's logarithm may differ in the last bit and its sums in their order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk import schema, values as V
from txrisk.functions.risk import drawn_label, reason_codes, risk_score
from txrisk.functions.scalars import log_amount, minutes_before, rounded_amount
from txrisk.operators import classes, features, metrics, model as classifier, trees
from txrisk.operators.predictions import alerts, serving_rows, stored_rows, with_log_amount
from txrisk.operators.ranges import average_ranks
from txrisk.plans import reports, train as training
from txrisk.session import work_dir
from txrisk.sources import envelope, folders, orders as source
from txrisk.sources.batch_table import withdraw_batch, write_batch
from txrisk.sources.files import read_json, write_json
from txrisk.streaming.scoring import Scorer, ServingTables, first_rows, model_scorer, serve_batch, start_scoring
from txrisk.streaming.watch import Watch

Query = Callable[[SparkSession, str], DataFrame]

AMOUNT_PLACES = 6
TOTAL_PLACES = 4
SHARE_PLACES = 6
METRIC_PLACES = 9
# How far the fitted model's area under the curve may be from that of the score its labels were drawn by.
BEST_MARGIN = 0.05

# What several queries of a session share, by what it was made from, for the last folder asked for: the fit and the filled tables.
_Made = tuple[str, str, int]
_FITS: dict[_Made, training.Trained] = {}
_SERVED: dict[_Made, ServingTables] = {}
_BATCHED: dict[_Made, ServingTables] = {}

AGE_ANCHOR = "2024-01-01 00:00:00"
MINUTES_BACK = 30 * 24 * 60


def _transactions(spark: SparkSession, folder: str) -> DataFrame:
    return source.transactions(source.read_orders(spark, folder))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return with_log_amount(source.scored_transactions(source.read_orders(spark, folder)))


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    return serving_rows(_scored(spark, folder))


def _raw_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return serving_rows(_scored(spark, folder), reported="amount")


def _rounded(rows: DataFrame, places: int, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.round(c, places) for c in columns})


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _transactions(spark, folder)


def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = work_dir(spark, "json")
    write_json(_transactions(spark, folder), path)
    return read_json(spark, path)


def json_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = work_dir(spark, "json")
    write_json(_transactions(spark, folder), path)
    rows = read_json(spark, path, infer=True)
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def kafka_envelope(spark: SparkSession, folder: str) -> DataFrame:
    parsed = envelope.parse_envelope(envelope.to_envelope(_transactions(spark, folder)))
    return parsed.select("message_key", *schema.TRANSACTION.names)


def _garbled(messages: DataFrame) -> DataFrame:
    """Every hundredth message becomes garbage on the wire."""
    number = source.transaction_number(F.col("key"))
    return messages.withColumn(
        "value", F.when(number % 100 == 0, F.lit("garbage").cast("binary")).otherwise(F.col("value"))
    )


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """All messages are checked; every hundredth is garbage on the wire, and just those are set aside."""
    damaged = _garbled(envelope.to_envelope(_transactions(spark, folder)))
    return envelope.rejected(envelope.checked(damaged))


def quarantine_causes(spark: SparkSession, folder: str) -> DataFrame:
    """A different fault for every merchant but one, and for some of its places, counted by cause."""
    text = F.col("value").cast("string")

    def sold_by(merchant: str) -> Column:
        return text.contains(f'"merchant":"{merchant}"')

    damaged = envelope.to_envelope(_transactions(spark, folder)).withColumn(
        "value",
        F.when(sold_by("Electronics"), F.regexp_replace(text, r"\}$", ""))
        .when(sold_by("Travel"), F.lit(None))
        .when(sold_by("Clothing"), F.regexp_replace(text, r'"userId":\d+', '"userId":"abc"'))
        .when(sold_by("Restaurants"), F.regexp_replace(text, r'"amount":[^,]+,', ""))
        .when(sold_by("Fuel"), F.regexp_replace(text, r'"amount":[^,]+', '"amount":-1.0'))
        .when(text.contains('"location":"NY"'), F.regexp_replace(text, r'"transactionId":"[^"]*",', ""))
        .when(text.contains('"location":"IL"'), F.regexp_replace(text, r'"timestamp":"[^"]*"', '"timestamp":"noon"'))
        .when(text.contains('"location":"FL"'), F.regexp_replace(text, r'"amount":[^,]+', '"amount":1e400'))
        .otherwise(text).cast("binary"),
    )
    return (
        envelope.checked(damaged)
        .groupBy(F.coalesce("cause", F.lit("accepted")).alias("cause"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def log_amounts(spark: SparkSession, folder: str) -> DataFrame:
    rows = _transactions(spark, folder).select(
        "transactionId", "amount", log_amount(F.col("amount")).alias("amount_log")
    )
    return _rounded(rows, AMOUNT_PLACES, "amount_log")


def amount_rounded(spark: SparkSession, folder: str) -> DataFrame:
    return _transactions(spark, folder).select(
        "transactionId", rounded_amount(F.col("amount")).alias("amount")
    )


def age_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    minutes = F.floor(source.label_draw() * MINUTES_BACK).cast("int")
    return _transactions(spark, folder).select(
        "transactionId",
        minutes_before(F.lit(AGE_ANCHOR).cast("timestamp"), minutes).alias("event_time"),
    )


def rule_risk_score(spark: SparkSession, folder: str) -> DataFrame:
    return _transactions(spark, folder).select("transactionId", risk_score().alias("risk"))


def label_draw(spark: SparkSession, folder: str) -> DataFrame:
    draw = source.label_draw()
    return _transactions(spark, folder).select(
        "transactionId", draw.alias("draw"), drawn_label(draw, risk_score()).alias("label")
    )


def label_balance(spark: SparkSession, folder: str) -> DataFrame:
    return classes.label_balance(_transactions(spark, folder))


def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return classes.with_class_weights(_transactions(spark, folder)).select(
        "transactionId", "label", "weight"
    )


def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    return classes.with_split(_transactions(spark, folder), source.split_draw()).select(
        "transactionId", "split"
    )


def exact_split(spark: SparkSession, folder: str) -> DataFrame:
    return classes.with_exact_split(_transactions(spark, folder), source.split_draw()).select("transactionId", "split")


def exact_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The sides of the exact split by the default draw, the hash of the id, as their sizes are known without it."""
    rows = classes.with_exact_split(_transactions(spark, folder))
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("count"), F.countDistinct("transactionId").alias("ids"))


def score_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Average ranks of the amounts, which nearly all differ."""
    ranks = average_ranks(_transactions(spark, folder), "amount")
    return ranks.select("amount", "n", (F.col("twice_rank") / 2).alias("rank"))


def score_auroc(spark: SparkSession, folder: str) -> DataFrame:
    """The area under the curve of the rule score, which has many ties, against the drawn label."""
    rows = _transactions(spark, folder).select("label", risk_score().alias("score"))
    return _rounded(metrics.score_auroc(rows), METRIC_PLACES, "auroc_score")


def features_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Category indices by join, the users among the categories."""
    columns = ("userId", *V.CATEGORIES)
    rows = _transactions(spark, folder)
    path = work_dir(spark, "category-index")
    features.category_index(rows, columns).write.parquet(path)
    indexed = features.with_category_index(rows, spark.read.parquet(path), columns)
    return indexed.select("transactionId", *(c + features.INDEX_SUFFIX for c in columns))


def category_index(spark: SparkSession, folder: str) -> DataFrame:
    return features.category_index(_transactions(spark, folder))


def feature_vector(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_log_amount(_transactions(spark, folder))
    slots = features.feature_slots(
        features.with_features(rows, features.fit_category_indexers(rows))
    )
    return _rounded(slots, AMOUNT_PLACES, "f_amount_log")


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion(_scored(spark, folder))


def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    row = metrics.classification_metrics(_scored(spark, folder))
    return _rounded(row, METRIC_PLACES, *row.columns)


def fraud_reason(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select(
        "transactionId", "prediction", reason_codes(F.col("amount_log")).alias("fraud_reason")
    )


def fraud_reason_raw(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select(
        "transactionId", "prediction", reason_codes(F.col("amount")).alias("fraud_reason")
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_predictions(spark, folder), AMOUNT_PLACES, "amount")


def fraud_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return alerts(_predictions(spark, folder), AMOUNT_PLACES)


def _report(report: Callable[[DataFrame], DataFrame], places: int, *columns: str,
            rows: Query = _predictions) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded(report(rows(spark, folder)), places, *columns)

    return query


def report_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(reports.summary(_predictions(spark, folder)), TOTAL_PLACES, "amount_sum")


def _start(spark: SparkSession, folder: str, scorer: Scorer, tables: ServingTables,
           damage: Callable[[DataFrame], DataFrame] = lambda messages: messages) -> StreamingQuery:
    messages = envelope.to_envelope(source.transactions(source.stream_orders(spark, folder)))
    return start_scoring(
        damage(messages), scorer, tables, work_dir(spark, "stream"), {"availableNow": True}, alert_digits=AMOUNT_PLACES,
    )


def _stream(spark: SparkSession, folder: str, scorer: Scorer,
            damage: Callable[[DataFrame], DataFrame] = lambda messages: messages, times: int = 1) -> ServingTables:
    """Runs the orders through message envelopes and the scoring stream, into new tables."""
    tables = ServingTables(work_dir(spark, "serving"))
    for _ in range(times):
        _start(spark, folder, scorer, tables, damage).awaitTermination()
    return tables


def _shared[Thing](kept: dict[_Made, Thing], spark: SparkSession, folder: str, make: Callable[[], Thing]) -> Thing:
    """What ``make`` makes, once per session and state of the input; what was kept for another folder goes."""
    key = (spark.sparkContext.applicationId, folder, folders.size(spark, f"{folder}/orders.parquet"))
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


def _served(spark: SparkSession, folder: str) -> ServingTables:
    """The tables as the stream with the stand-in model fills them."""
    return _shared(_SERVED, spark, folder, lambda: _stream(spark, folder, source.with_stand_in_prediction))


def _serve_batches(spark: SparkSession, folder: str, tables: ServingTables, numbers: list[int], of: int) -> None:
    """The orders dealt into ``of`` batches by their key, and those of some numbers served in turn."""
    messages = envelope.to_envelope(_transactions(spark, folder))
    batch = source.transaction_number(F.col("key")) % of
    for number in numbers:
        serve_batch(messages.filter(batch == number), number, source.with_stand_in_prediction, tables,
                    alert_digits=AMOUNT_PLACES)


def _batched(spark: SparkSession, folder: str) -> ServingTables:
    """Tables of seven batches, one of them served twice, six of them in merged blocks of two."""
    def make() -> ServingTables:
        tables = ServingTables(work_dir(spark, "serving"), block=2)
        _serve_batches(spark, folder, tables, [0, 1, 2, 3, 3, 4, 5, 6], 7)
        tables.compact(spark)
        return tables

    return _shared(_BATCHED, spark, folder, make)


def _added_summaries(spark: SparkSession, folder: str) -> DataFrame:
    return _batched(spark, folder).summaries(spark)


def report_leaders_user_top3(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(reports.user_top3(_batched(spark, folder).leaders(spark)), AMOUNT_PLACES, "amount")


def stream_uncommitted(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table after two batches, while a third is half written and a fourth withdrawn to be served again."""
    tables = ServingTables(work_dir(spark, "serving"), block=2)
    _serve_batches(spark, folder, tables, [0, 1, 3], 4)
    messages = envelope.to_envelope(_transactions(spark, folder))
    batch = source.transaction_number(F.col("key")) % 4
    scored = source.with_stand_in_prediction(with_log_amount(envelope.accepted(envelope.checked(messages.filter(batch == 2)))))
    write_batch(stored_rows(scored), tables.predictions_path, 2, tables.block)
    withdraw_batch(spark, tables.counts_path, 3, tables.block)
    seen = {
        "predictions": tables.predictions(spark), "alerts": tables.alerts(spark), "quarantine": tables.quarantine(spark),
        "batch_counts": tables.batch_counts(spark),
    }
    counts = [
        rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, rows in seen.items()
    ]
    figures = tables.summaries(spark).agg(F.sum("row_count").alias("rows"))
    return reduce(DataFrame.union, [*counts, figures.select(F.lit("summaries").alias("table"), "rows")])


def day_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """The stored predictions of the first day there is, from its month in the merged blocks and from one batch."""
    first = _transactions(spark, folder).agg(F.min(F.to_date("timestamp"))).first()[0]
    rows = _batched(spark, folder).predictions(spark, (first, first))
    return _rounded(rows, AMOUNT_PLACES, "amount").select(
        F.col(schema.DAY_COLUMN).cast("string").alias("event_day"), *schema.PREDICTION.names
    )


def console_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What the console shows of a batch: the first rows by id."""
    return first_rows(predictions(spark, folder)).limit(V.CONSOLE_ROWS)


def _stored_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return _served(spark, folder).predictions(spark).select(*schema.PREDICTION.names)


def stream_score_table(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_stored_predictions(spark, folder), AMOUNT_PLACES, "amount")


def stream_replay(spark: SparkSession, folder: str) -> DataFrame:
    """The same input twice, under two checkpoints, into the same tables: as if once."""
    tables = _stream(spark, folder, source.with_stand_in_prediction, times=2)
    return _rounded(
        tables.predictions(spark).select(*schema.PREDICTION.names), AMOUNT_PLACES, "amount"
    )


def stream_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The predictions of seven batches, six of them in merged blocks of two."""
    tables = _batched(spark, folder)
    return _rounded(tables.predictions(spark).select(*schema.PREDICTION.names), AMOUNT_PLACES, "amount")


def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    tables = _stream(spark, folder, source.with_stand_in_prediction, _garbled)
    return tables.quarantine(spark).select(*schema.REJECT.names)


def batch_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Counts over all batches of a stream with garbage in it, however it was cut, as they were observed on the way."""
    tables = ServingTables(work_dir(spark, "serving"))
    with Watch(spark) as watch:
        query = _start(spark, folder, source.with_stand_in_prediction, tables, _garbled)
        watch.await_all([query])
        counts = watch.batch_counts(query)
    return counts.agg(*(F.sum(c).alias(c) for c in ("row_count", "accepted", "rejected")))


def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _served(spark, folder).alerts(spark).select(*schema.ALERT.names)


def batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _served(spark, folder).batch_counts(spark).select(*schema.BATCH_COUNT.names)


def _damaged(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled rows with another fault for every merchant but one, and unreadable lines among the rest."""
    rows = _transactions(spark, folder)
    merchant = F.col("merchant")
    lost = (merchant == "Grocery") & (F.col("location") == "NY")
    changed = rows.withColumns({
        "transactionId": F.when(~((merchant == "Grocery") & (F.col("location") == "IL")), F.col("transactionId")),
        "label": F.when(merchant == "Electronics", 2).when(merchant == "Travel", None).otherwise(F.col("label")),
        "userId": F.when(merchant != "Clothing", F.col("userId")),
        "amount": F.when(merchant == "Fuel", float("inf")).when(merchant != "Restaurants", F.col("amount")),
    })
    return changed.select(*(F.when(~lost, F.col(c)).alias(c) for c in rows.columns))


def training_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejects = training.sides(training.stage(_damaged(spark, folder)))[2]
    return training.reject_counts(rejects)


def training_weights(spark: SparkSession, folder: str) -> DataFrame:
    kept, held_out, _ = training.sides(training.stage(_damaged(spark, folder)))
    return kept.unionByName(held_out).select("transactionId", "label", "weight")


def _trained(spark: SparkSession, folder: str) -> training.Trained:
    """The full fit."""
    return _shared(
        _FITS, spark, folder, lambda: training.train(_transactions(spark, folder), draw=source.split_draw())
    )


def gbt_score(spark: SparkSession, folder: str) -> DataFrame:
    trained = _trained(spark, folder)
    return classifier.score(trained.model, trained.test).select(
        "transactionId", "label", "prediction", "fraud_probability"
    )


def gbt_metrics(spark: SparkSession, folder: str) -> DataFrame:
    trained = _trained(spark, folder)
    return training.evaluate(trained.model, trained.test)


def model_save_load_score(spark: SparkSession, folder: str) -> DataFrame:
    trained = _trained(spark, folder)
    path = work_dir(spark, "model")
    classifier.save(trained.model, path)
    return classifier.score(classifier.load(path), trained.test).select(
        "transactionId", "label", "prediction", "fraud_probability"
    )


def stream_gbt_score(spark: SparkSession, folder: str) -> DataFrame:
    tables = _stream(spark, folder, model_scorer(_trained(spark, folder).model))
    return tables.predictions(spark).select(*schema.PREDICTION.names)


def _same(one: str, other: str, *columns: str) -> Column:
    """Whether two aliased frames hold the same values."""
    tests = [F.col(f"{one}.{c}").eqNullSafe(F.col(f"{other}.{c}")) for c in columns]
    return reduce(Column.__and__, tests)


def gbt_score_checks(spark: SparkSession, folder: str) -> DataFrame:
    """What holds for every scored row of any model."""
    probability = F.col("fraud_probability")
    return gbt_score(spark, folder).select(
        "transactionId", "label", probability.between(0, 1).alias("in_range"),
        (F.col("prediction") == (probability > 0.5).cast("double")).alias("by_half"),
    )


def gbt_reload_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a row scores the same after the model was saved and loaded."""
    one, other = gbt_score(spark, folder).alias("a"), model_save_load_score(spark, folder).alias("b")
    return one.join(other, "transactionId", "full").select(
        "transactionId", _same("a", "b", "prediction", "fraud_probability").alias("same")
    )


def stream_gbt_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the stream serves a row as a batch with the same model does."""
    rows = classifier.score(_trained(spark, folder).model, with_log_amount(_transactions(spark, folder)))
    batch, served = serving_rows(rows).alias("a"), stream_gbt_score(spark, folder).alias("b")
    return batch.join(served, "transactionId", "full").select(
        "transactionId", F.round("b.amount", AMOUNT_PLACES).alias("amount"),
        _same("a", "b", "userId", "amount", "prediction", "fraud_reason").alias("same"),
    )


def gbt_tree_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the node table alone gives every held-out row the margin and prediction that the model gives it."""
    trained = _trained(spark, folder)
    nodes, depth = trees.node_table(spark, trained.model), trained.model.stages[-1].getMaxDepth()
    scored = trees.score_by_table(classifier.score(trained.model, trained.test), nodes, depth)
    margin = vector_to_array("rawPrediction")[1]
    return scored.select(
        "transactionId", (F.abs(F.col("table_margin") - margin) < 1e-9).alias("same_margin"),
        (F.col("table_prediction") == F.col("prediction")).alias("same_prediction"), "at_leaves",
        nodes.agg(F.countDistinct("tree")).scalar().alias("trees"), F.lit(depth).cast("long").alias("depth"),
    )


def gbt_metrics_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Size of the held-out side, whether the model beats a guess on it, and whether it ranks it about as well as can be.

    The labels are drawn with the rule score as their probability, so no model ranks better than that
    score on average; a hundred rounds on 12,000 rows learn some noise, too (0.04 at sf0.01).
    """
    test = _trained(spark, folder).test
    best = metrics.score_auroc(test.withColumn("score", risk_score()))
    found = gbt_metrics(spark, folder).select("auroc_score").scalar()
    return best.select(
        F.col("rows").alias("test_rows"), "positives", (found > 0.5).alias("beats_chance"),
        (F.abs(found - F.col("auroc_score")) <= BEST_MARGIN).alias("near_best"),
    )


def gbt_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out rows whose prediction changes if the training rows come in other parts."""
    one = _trained(spark, folder)
    other = training.train(_transactions(spark, folder).repartition(6), draw=source.split_draw())
    a, b = (classifier.score(t.model, one.test).alias(n) for n, t in (("a", one), ("b", other)))
    return a.join(b, "transactionId").agg(
        F.count(F.lit(1)).alias("test_rows"), F.count_if(~_same("a", "b", "prediction")).alias("changed")
    )


# The panels, on the table that the scoring stream has written.
STORED_REPORTS = {
    "merchant_exposure": _report(reports.merchant_exposure, TOTAL_PLACES, "sum", rows=_stored_predictions),
    "fraud_transactions": _report(
        reports.fraud_transactions, AMOUNT_PLACES, "amount", rows=_stored_predictions),
    "user_top3": _report(reports.user_top3, AMOUNT_PLACES, "amount", rows=_stored_predictions),
    "device_counts": _report(reports.device_counts, 0, rows=_stored_predictions),
    "merchant_contribution": _report(
        reports.merchant_contribution, TOTAL_PLACES, "fraud_amount", rows=_stored_predictions),
    "prediction_counts": _report(reports.prediction_counts, 0, rows=_stored_predictions),
    "reason_breakdown": _report(reports.reason_breakdown, 0, rows=_stored_predictions),
    "avg_amount": _report(reports.average_amount, TOTAL_PLACES, "avg_amount", rows=_stored_predictions),
    "location_counts": _report(reports.location_counts, 0, rows=_stored_predictions),
}


# The grouped panels, added up from the figures of the batches.
ADDED_REPORTS = {
    "merchant_exposure": _report(reports.merchant_exposure, TOTAL_PLACES, "sum", rows=_added_summaries),
    "device_counts": _report(reports.device_counts, 0, rows=_added_summaries),
    "merchant_contribution": _report(reports.merchant_contribution, TOTAL_PLACES, "fraud_amount", rows=_added_summaries),
    "prediction_counts": _report(reports.prediction_counts, 0, rows=_added_summaries),
    "reason_breakdown": _report(reports.reason_breakdown, 0, rows=_added_summaries),
    "avg_amount": _report(reports.average_amount, TOTAL_PLACES, "avg_amount", rows=_added_summaries),
    "location_counts": _report(reports.location_counts, 0, rows=_added_summaries),
}


def category_index_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The index of a column with many values: the users."""
    return features.category_index(_transactions(spark, folder), ("userId",))


# What several queries share, for those who time them.
SHARED: dict[str, Callable[[SparkSession, str], object]] = {"fit": _trained, "served": _served, "batched": _batched}

QUERIES: dict[str, Query] = {
    "transactions": transactions,
    "json_roundtrip": json_roundtrip,
    "json_inferred": json_inferred,
    "kafka_envelope": kafka_envelope,
    "quarantine": quarantine,
    "quarantine_causes": quarantine_causes,
    "log_amount": log_amounts,
    "amount_rounded": amount_rounded,
    "age_timestamps": age_timestamps,
    "rule_risk_score": rule_risk_score,
    "label_draw": label_draw,
    "label_balance": label_balance,
    "class_weights": class_weights,
    "train_test_split": train_test_split,
    "category_index": category_index,
    "features": feature_vector,
    "confusion": confusion,
    "metrics": classification_metrics,
    "fraud_reason": fraud_reason,
    "fraud_reason_raw": fraud_reason_raw,
    "predictions": predictions,
    "alerts": fraud_alerts,
    "report_summary": report_summary,
    "report_merchant_exposure": _report(reports.merchant_exposure, TOTAL_PLACES, "sum"),
    "report_merchant_exposure_raw": _report(
        reports.merchant_exposure, TOTAL_PLACES, "sum", rows=_raw_predictions),
    "report_fraud_transactions": _report(reports.fraud_transactions, AMOUNT_PLACES, "amount"),
    "report_user_top3": _report(reports.user_top3, AMOUNT_PLACES, "amount"),
    "report_device_counts": _report(reports.device_counts, 0),
    "report_merchant_contribution": _report(
        reports.merchant_contribution, TOTAL_PLACES, "fraud_amount"),
    "report_merchant_contribution_raw": _report(
        reports.merchant_contribution, TOTAL_PLACES, "fraud_amount", rows=_raw_predictions),
    "report_prediction_counts": _report(reports.prediction_counts, 0),
    "report_reason_breakdown": _report(reports.reason_breakdown, 0),
    "report_avg_amount": _report(reports.average_amount, TOTAL_PLACES, "avg_amount"),
    "report_avg_amount_raw": _report(
        reports.average_amount, TOTAL_PLACES, "avg_amount", rows=_raw_predictions),
    "report_location_counts": _report(reports.location_counts, 0),
    "report_merchant_share": lambda spark, folder: _rounded(
        _report(reports.merchant_share, SHARE_PLACES, "share")(spark, folder),
        TOTAL_PLACES, "fraud_amount"),
    "report_location_share": _report(reports.location_share, SHARE_PLACES, "share"),
    "report_last_not_null": _report(reports.last_not_null, TOTAL_PLACES, "value"),
    "report_merchant_legend": _report(
        reports.merchant_legend, TOTAL_PLACES, "min", "last", "mean"),
    "stream_score_table": stream_score_table,
    "stream_alerts": stream_alerts,
    "batch_counts": batch_counts,
    "gbt_score": gbt_score,
    "gbt_metrics": gbt_metrics,
    "model_save_load_score": model_save_load_score,
    "stream_gbt_score": stream_gbt_score,
    "category_index_wide": category_index_wide,
    "exact_split": exact_split,
    "exact_split_counts": exact_split_counts,
    "score_ranks": score_ranks,
    "score_auroc": score_auroc,
    "features_wide": features_wide,
    "gbt_tree_checks": gbt_tree_checks,
    "training_rejects": training_rejects,
    "training_weights": training_weights,
    "stream_replay": stream_replay,
    "stream_compacted": stream_compacted,
    "stream_quarantine": stream_quarantine,
    "batch_totals": batch_totals,
    "gbt_score_checks": gbt_score_checks,
    "gbt_reload_checks": gbt_reload_checks,
    "stream_gbt_checks": stream_gbt_checks,
    "gbt_metrics_checks": gbt_metrics_checks,
    "gbt_layout": gbt_layout,
    "report_leaders_user_top3": report_leaders_user_top3,
    "stream_uncommitted": stream_uncommitted,
    "day_predictions": day_predictions,
    "console_rows": console_rows,
    **{f"report_stored_{name}": query for name, query in STORED_REPORTS.items()},
    **{f"report_added_{name}": query for name, query in ADDED_REPORTS.items()},
}
