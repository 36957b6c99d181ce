"""Streaming, training and reporting jobs."""

import os

import pytest
from pyspark.sql import functions as F

from txrisk import schema
from txrisk.operators import model as classifier
from txrisk.operators.predictions import serving_rows, with_log_amount
from txrisk.plans import reports, train
from txrisk.sources import jdbc, orders as source
from txrisk.sources.jdbc import read_properties
from txrisk.sources.envelope import to_envelope
from txrisk.sources.files import stream_files, write_json
from txrisk.streaming import scoring
from txrisk.streaming.scoring import JdbcTarget, ServingTables, serve_batch, start_scoring

DATA = "/root/testdata/sf0.001"
ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def transactions(spark):
    return source.transactions(source.read_orders(spark, DATA))


@pytest.fixture(scope="module")
def predictions(spark):
    return serving_rows(with_log_amount(source.scored_transactions(source.read_orders(spark, DATA))))


def message_stream(spark, path, **options):
    return stream_files(spark, path, **options)


def score(spark, stream, folder, checkpoint="checkpoint", **options):
    tables = ServingTables(folder + "/tables")
    start_scoring(stream, source.with_stand_in_prediction, tables, f"{folder}/{checkpoint}", ONCE,
                  **options).awaitTermination()
    return tables


def test_stream_equals_batch(spark, transactions, predictions, folder):
    to_envelope(transactions).write.parquet(folder + "/messages")
    tables = score(spark, message_stream(spark, folder + "/messages"), folder)
    served = tables.predictions(spark).select(*schema.PREDICTION.names)
    assert served.exceptAll(predictions).count() == 0 and predictions.exceptAll(served).count() == 0
    assert tables.alerts(spark).count() == predictions.filter("prediction = 1").count()
    assert tables.quarantine(spark).count() == 0


def test_replayed_batch_leaves_no_duplicates(spark, transactions, folder):
    to_envelope(transactions).write.parquet(folder + "/messages")
    for checkpoint in ("one", "two"):
        tables = score(spark, message_stream(spark, folder + "/messages"), folder, checkpoint)
        assert tables.predictions(spark).count() == 1500
        assert tables.alerts(spark).count() == 514
        assert [tuple(r)[:3] for r in tables.batch_counts(spark).collect()] == [(1500, 1500, 0)]


def test_restart_goes_on_where_it_stopped(spark, transactions, folder):
    halves = transactions.withColumn("half", F.col("label") % 2)
    path = folder + "/messages"
    to_envelope(halves.filter("half = 0")).write.parquet(path)
    score(spark, message_stream(spark, path), folder)
    to_envelope(halves.filter("half = 1")).write.mode("append").parquet(path)
    tables = score(spark, message_stream(spark, path), folder)
    assert tables.predictions(spark).select("transactionId").distinct().count() == 1500
    assert {r.batch_id for r in tables.batch_counts(spark).collect()} == {0, 1}


def test_many_batches(spark, transactions, folder):
    path = folder + "/messages"
    to_envelope(transactions).repartition(4).write.parquet(path)
    tables = score(spark, message_stream(spark, path, batch_bytes=1), folder)
    counts = tables.batch_counts(spark).collect()
    assert sorted(r.batch_id for r in counts) == [0, 1, 2, 3]
    assert sum(r.row_count for r in counts) == tables.predictions(spark).count() == 1500


def test_orders_as_a_stream_from_a_file_or_a_folder(spark, folder):
    orders = source.read_orders(spark, DATA)
    orders.repartition(3).write.parquet(folder + "/orders.parquet")
    for place, batches in ((DATA, 1), (folder, 3)):
        seen = []
        query = source.stream_orders(spark, place, batch_bytes=1).writeStream.foreachBatch(
            lambda rows, n: seen.append(rows.count())
        ).option("checkpointLocation", f"{folder}/checkpoint-{batches}").trigger(**ONCE).start()
        query.awaitTermination()
        assert sum(seen) == 1500 and len(seen) == batches


def test_bad_messages_are_set_aside_and_the_stream_goes_on(spark, transactions, folder):
    damaged = to_envelope(transactions).withColumn(
        "value", F.when(F.col("key") == "txn7", F.lit(b"garbage"))
        .when(F.col("key") == "txn8", F.lit(None)).otherwise(F.col("value")))
    damaged.write.parquet(folder + "/messages")
    tables = score(spark, message_stream(spark, folder + "/messages"), folder)
    assert tables.predictions(spark).count() == 1498
    found = {r.message_key: (r.raw, r.cause) for r in tables.quarantine(spark).collect()}
    assert found == {"txn7": ("garbage", "unreadable message"), "txn8": (None, "empty message")}
    assert [(r.row_count, r.accepted, r.rejected) for r in tables.batch_counts(spark).collect()] == [
        (1500, 1498, 2)]


def test_each_message_is_scored_once(spark, transactions, folder):
    messages = to_envelope(transactions)
    scored = spark.sparkContext.accumulator(0)

    def scorer(rows):
        def count(batches):
            for batch in batches:
                scored.add(len(batch))
                yield batch
        return source.with_stand_in_prediction(rows).mapInPandas(
            count, source.with_stand_in_prediction(rows).schema)

    serve_batch(messages, 0, scorer, ServingTables(folder))
    assert scored.value == 1500


def test_an_empty_batch(spark, transactions, folder):
    tables = ServingTables(folder)
    serve_batch(to_envelope(transactions).limit(0), 3, source.with_stand_in_prediction, tables)
    assert tables.predictions(spark).count() == 0
    assert [(r.batch_id, r.row_count, r.accepted) for r in tables.batch_counts(spark).collect()] == [(3, 0, 0)]


def test_console_and_jdbc_copies(spark, transactions, folder, monkeypatch, capsys):
    sent = []
    monkeypatch.setattr(jdbc, "append_table", lambda rows, url, properties, table: sent.append(
        (rows.count(), rows.columns, url, table)))
    serve_batch(to_envelope(transactions), 0, source.with_stand_in_prediction, ServingTables(folder),
                console=True, jdbc_target=JdbcTarget("jdbc:x", {}))
    assert sent == [(1500, schema.PREDICTION.names, "jdbc:x", "transaction_predictions")]
    serve_batch(to_envelope(transactions), 1, source.with_stand_in_prediction, ServingTables(folder),
                jdbc_target=JdbcTarget("jdbc:x", {}, with_batch_id=True))
    assert sent[1][1] == [*schema.PREDICTION.names, "batch_id"]
    assert "only showing top 20 rows" in capsys.readouterr().out


def test_jdbc_properties_come_from_a_file(folder):
    assert read_properties(None) == {}
    with open(folder + "/p.json", "w") as file:
        file.write('{"user": "u", "fetchsize": 10}')
    assert read_properties(folder + "/p.json") == {"user": "u", "fetchsize": "10"}


def test_console_writer(spark, transactions, folder):
    to_envelope(transactions).write.parquet(folder + "/messages")
    stream = message_stream(spark, folder + "/messages").selectExpr("cast(key as string) k")
    query = scoring.console_writer(stream, folder + "/checkpoint").trigger(**ONCE).start()
    query.awaitTermination()
    assert query.exception() is None


def test_train_save_load_score(spark, transactions, folder):
    trained = train.train(transactions, 3, source.split_draw())
    assert trained.train.count() == 1202 and trained.test.count() == 298
    weights = {r.label: r.weight for r in trained.train.select("label", "weight").distinct().collect()}
    assert weights[1] == pytest.approx((1500 - 432) / 1500) and weights[0] == pytest.approx(432 / 1500)
    classifier.save(trained.model, folder + "/model")
    classifier.save(trained.model, folder + "/model")
    loaded = classifier.load(folder + "/model")
    kept = ["transactionId", "prediction", "fraud_probability"]
    one = classifier.score(trained.model, trained.test).select(*kept)
    other = classifier.score(loaded, trained.test).select(*kept)
    assert one.exceptAll(other).count() == 0 and one.count() == 298
    row = train.evaluate(loaded, trained.test).first()
    assert 0 <= row.auroc_score <= 1 and 0 < row.accuracy < 1


def test_scoring_replaces_an_earlier_prediction(spark, transactions):
    trained = train.train(transactions, 2, source.split_draw())
    again = classifier.score(trained.model, classifier.score(trained.model, trained.test))
    assert again.count() == 298 and again.columns.count("prediction") == 1


def test_model_beats_chance_on_the_held_out_rows(spark):
    rows = source.transactions(source.read_orders(spark, "/root/testdata/sf0.01"))
    trained = train.train(rows, 10, source.split_draw())
    row = train.evaluate(trained.model, trained.test).first()
    assert row.auroc_hard > 0.55 and row.auroc_score > 0.6


def test_training_sets_unusable_rows_aside(spark, transactions):
    bad = spark.createDataFrame([
        ("x1", None, 5.0, "NY", "Web", "Fuel", None, 1), ("x2", 1, None, "NY", "Web", "Fuel", None, 0),
        ("x3", 1, -2.0, "NY", "Web", "Fuel", None, 0), ("x4", 1, 5.0, "NY", "Web", "Fuel", None, None),
        ("x5", 1, float("inf"), "NY", "Web", "Fuel", None, 1), ("x6", 1, 5.0, "NY", "Web", "Fuel", None, 2),
        (None, None, None, None, None, None, None, None),
    ], schema.LABELLED)
    kept, held_out, rejects = train.sides(train.stage(transactions.unionByName(bad)))
    assert kept.count() + held_out.count() == 1500
    assert {r.transactionId: r.cause for r in rejects.collect()} == {
        "x1": "no user", "x2": "no amount", "x3": "amount has no log", "x4": "no label",
        "x5": "amount is infinite", "x6": "label outside 0 and 1", None: "unreadable line"}
    # x1 and x5 are positives, and all 1507 rows count.
    assert kept.filter("label = 1").first().weight == pytest.approx((1507 - 434) / 1507)


def test_fit_rows_do_not_depend_on_layout(spark, transactions):
    staged = train.stage(transactions, source.split_draw())
    rows = train.sides(staged)[0]
    one, other = (train.placed(r).rdd.glom().map(lambda p: [r.transactionId for r in p]).collect()
                  for r in (rows, rows.repartition(6)))
    assert one == other and len(one) == train.LEAST_PARTS
    assert 400 < train.placed(rows, 600).count() < 800


def test_tasks_of_a_fit_send_no_metrics_of_the_plan_behind_it(spark, transactions):
    rows = train.placed(train.sides(train.stage(transactions))[0])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" in plan and "Exchange" not in plan and "FileScan" not in plan


def test_training_job_from_json(spark, transactions, folder):
    write_json(transactions, folder + "/json")
    for infer in (False, True):
        row = train.run(spark, folder + "/json", folder + "/model", infer, max_iter=2).first()
        assert {"accuracy", "precision_0", "recall_0", "f1", "auroc_hard", "auroc_score"} <= set(
            row.asDict())
    assert os.path.isdir(folder + "/model/stages")


def test_stream_with_a_model(spark, transactions, folder):
    trained = train.train(transactions, 2, source.split_draw())
    to_envelope(transactions).write.parquet(folder + "/messages")
    tables = ServingTables(folder + "/tables")
    start_scoring(message_stream(spark, folder + "/messages"), scoring.model_scorer(trained.model),
                  tables, folder + "/checkpoint", ONCE).awaitTermination()
    want = serving_rows(classifier.score(trained.model, with_log_amount(transactions)))
    served = tables.predictions(spark).select(*schema.PREDICTION.names)
    assert served.count() == 1500 and served.exceptAll(want).count() == 0


@pytest.mark.parametrize("name", sorted(reports.SUMMARY_REPORTS))
def test_reports_from_the_summary(spark, predictions, name):
    report = reports.SUMMARY_REPORTS[name]
    summary = reports.summary(predictions)

    def rows(frame):
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                       for r in frame.collect()), key=str)

    assert rows(report(summary)) == rows(report(predictions))


def test_last_not_null_from_the_summary(predictions):
    one = {(r.panel, r.field): r.value for r in reports.last_not_null(predictions).collect()}
    other = reports.last_not_null(predictions, reports.summary(predictions))
    assert {(r.panel, r.field): r.value for r in other.collect()} == pytest.approx(one)


def test_report_job(spark, predictions, folder):
    reports.write_all(predictions, folder)
    names = {*reports.SUMMARY_REPORTS, *reports.ROW_REPORTS, "summary", "last_not_null"}
    assert names == set(os.listdir(folder))
    assert spark.read.parquet(folder + "/user_top3").count() == 369


def test_reports_on_a_stored_table_prune_and_push_down(spark, predictions, folder):
    predictions.write.parquet(folder + "/p")
    stored = spark.read.schema(schema.PREDICTION).parquet(folder + "/p")
    plan = reports.merchant_exposure(stored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<amount:double,merchant:string,prediction:double>" in plan
    assert "EqualTo(prediction,1.0)" in plan
    plan = reports.device_counts(stored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<device:string>" in plan


# The panels as a reporting tool would send them, in SQL on the registered view.
PANELS = {
    "device_counts": """SELECT device, COUNT(*) AS transaction_count FROM transaction_predictions
        GROUP BY device ORDER BY 2 DESC, 1""",
    "reason_breakdown": """SELECT fraud_reason, COUNT(*) AS count FROM transaction_predictions
        WHERE prediction = 1 GROUP BY fraud_reason ORDER BY 2 DESC, 1""",
    "user_top3": """SELECT * FROM (
        SELECT "transactionId", "userId", amount, location, device, merchant, fraud_reason,
               RANK() OVER (PARTITION BY "userId" ORDER BY amount DESC NULLS FIRST) AS fraud_rank
        FROM transaction_predictions WHERE prediction = 1) t WHERE fraud_rank <= 3""",
}


@pytest.mark.parametrize("name", sorted(PANELS))
def test_panels_in_sql(spark, transactions, predictions, folder, name):
    tables = ServingTables(folder)
    serve_batch(to_envelope(transactions), 0, source.with_stand_in_prediction, tables)
    tables.register(spark)
    setting = "spark.sql.ansi.doubleQuotedIdentifiers"
    spark.conf.set(setting, "true")
    try:
        found = spark.sql(PANELS[name]).collect()
    finally:
        spark.conf.unset(setting)
    report = {**reports.SUMMARY_REPORTS, **reports.ROW_REPORTS}[name]
    assert sorted(map(str, found)) == sorted(map(str, report(predictions).collect()))


def test_sorting_puts_nulls_first(spark):
    rows = spark.createDataFrame([
        ("t1", 1, None, "NY", "Web", "Fuel", 1.0, "ModelDetected"),
        ("t2", 1, 2.0, "NY", "Web", "Travel", 1.0, "RiskyMerchant"),
    ], schema.PREDICTION)
    assert [r.merchant for r in reports.merchant_contribution(rows).collect()] == ["Fuel", "Travel"]
