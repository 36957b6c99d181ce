"""Commits, figures, leaders and days of the serving tables; several queries that are watched."""

import datetime
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from txrisk import schema
from txrisk.operators.predictions import alerts, stored_rows, with_log_amount
from txrisk.plans import reports, train
from txrisk.sources import folders, orders as source
from txrisk.sources.batch_table import write_batch
from txrisk.sources.envelope import checked, to_envelope
from txrisk.sources.files import read_json, stream_files
from txrisk.streaming.scoring import ServingTables, serve_batch, start_scoring
from txrisk.streaming.watch import OBSERVED, Watch, observed

DATA = "/root/testdata/sf0.001"
ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def transactions(spark):
    return source.transactions(source.read_orders(spark, DATA)).cache()


@pytest.fixture(scope="module")
def batched(spark, transactions, tmp_path_factory):
    """Five batches, the third served twice, four of them merged."""
    tables = ServingTables(str(tmp_path_factory.mktemp("batched")), block=2)
    serve(transactions, tables, [0, 1, 2, 2, 3, 4], 5)
    merged = tables.compact(spark)
    assert set(map(tuple, merged.values())) == {(0, 1)} and len(merged) == 6
    return tables


def serve(transactions, tables, numbers, of):
    number = F.regexp_extract("transactionId", r"\d+", 0).cast("long")
    for n in numbers:
        rows = transactions.filter(number % of == n)
        serve_batch(to_envelope(rows), n, source.with_stand_in_prediction, tables)


def whole(spark, transactions):
    rows = source.scored_transactions(source.read_orders(spark, DATA))
    return stored_rows(with_log_amount(rows))


def rounded(frame):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("name", sorted(reports.SUMMARY_REPORTS))
def test_reports_add_up_the_figures_of_batches(spark, transactions, batched, name):
    report = reports.SUMMARY_REPORTS[name]
    assert rounded(report(batched.summaries(spark))) == rounded(report(whole(spark, transactions)))


def test_leaders_of_batches_give_the_leaders_of_all(spark, transactions, batched):
    found = reports.user_top3(batched.leaders(spark))
    assert rounded(found) == rounded(reports.user_top3(whole(spark, transactions)))


def test_leaders_keep_ties_and_missing_amounts(spark):
    rows = [(f"t{i}", 1, a, "NY", "Web", "Fuel", 1.0, "x") for i, a in enumerate([5.0, 5.0, None, 4.0, 4.0, 1.0, 5.0])]
    one, other = (spark.createDataFrame(rows[i::2], schema.PREDICTION) for i in (0, 1))
    parts = reports.leaders(one).unionByName(reports.leaders(other))
    assert rounded(reports.user_top3(parts)) == rounded(reports.user_top3(spark.createDataFrame(rows, schema.PREDICTION)))


def test_panels_do_not_read_predictions(spark, batched):
    for frame in (batched.summaries(spark), batched.leaders(spark)):
        files = frame.inputFiles()
        assert files and not any("transaction_predictions" in f for f in files)
    merged = spark.read.parquet(batched.summaries_path + "/merged/block=0")
    keys = merged.select(*reports.SUMMARY_KEYS)
    assert keys.count() == keys.distinct().count()


def test_a_day_is_read_from_its_month(spark, transactions, batched):
    day = datetime.date(1996, 5, 17)
    days = (day, day + datetime.timedelta(20))
    rows = batched.predictions(spark, days)
    want = whole(spark, transactions).filter(F.col("event_day").between(*map(F.lit, days)))
    assert rounded(rows.drop("batch_id")) == rounded(want) and rows.count() > 5
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("event_month" in line.split("PartitionFilters: ")[1].split("]")[0] for line in scans)
    assert any("GreaterThanOrEqual(event_day,1996-05-17)" in line for line in scans)
    for batch in spark.read.parquet(batched.predictions_path + "/merged/block=0").groupBy("batch_id").count().collect():
        assert batch["count"] == 300


def test_rows_without_a_time_are_stored(spark, transactions, folder):
    tables = ServingTables(folder, block=1)
    late = transactions.withColumn("timestamp", F.lit(None).cast("timestamp"))
    serve(late, tables, [0, 1], 2)
    tables.compact(spark)
    assert tables.predictions(spark).filter("event_day IS NULL").count() == 1500


def test_half_written_batches_are_not_seen(spark, transactions, folder):
    tables = ServingTables(folder)
    serve(transactions, tables, [0], 2)
    seen = [tables.predictions, tables.alerts, tables.quarantine, tables.summaries, tables.leaders, tables.batch_counts]
    before = [t(spark).count() for t in seen]
    rows = whole(spark, transactions)
    write_batch(rows, tables.predictions_path, 1)
    write_batch(alerts(rows), tables.alerts_path, 1)
    write_batch(reports.summary(rows), tables.summaries_path, 1)
    assert [t(spark).count() for t in seen] == before
    serve(transactions, tables, [1], 2)
    assert tables.predictions(spark).count() == 1500 and tables.batch_counts(spark).count() == 2


def test_a_batch_that_fails_again_is_withdrawn(spark, transactions, folder):
    tables = ServingTables(folder)
    serve(transactions, tables, [0, 1], 2)

    def broken(rows):
        raise ValueError("no model")

    with pytest.raises(ValueError, match="no model"):
        serve_batch(to_envelope(transactions), 1, broken, tables)
    assert tables.predictions(spark).count() == 750
    assert tables.summaries(spark).agg(F.sum("row_count")).first()[0] == 750


def garbled(transactions):
    return to_envelope(transactions).withColumn(
        "value", F.when(F.col("key").endswith("7"), F.lit(b"garbage")).otherwise(F.col("value")))


def test_observed_counts_are_those_written(spark, transactions, folder):
    path = folder + "/messages"
    garbled(transactions).repartition(3).write.parquet(path)
    tables = ServingTables(folder + "/tables")
    with Watch(spark) as watch:
        # The second run serves the same batches again, under another checkpoint.
        for checkpoint in ("one", "two"):
            query = start_scoring(stream_files(spark, path, batch_bytes=1), source.with_stand_in_prediction, tables,
                                  f"{folder}/{checkpoint}", ONCE)
            watch.await_all([query])
            counts = sorted(map(tuple, watch.batch_counts(query).collect()))
            written = tables.batch_counts(spark).select(*schema.BATCH_COUNT.names)
            assert counts == sorted(map(tuple, written.collect())) and len(counts) == 3
    assert sum(c[1] for c in counts) == 1500 and sum(c[3] for c in counts) == 150


def test_only_so_many_batches_are_kept(spark, transactions, folder):
    to_envelope(transactions).repartition(4).write.parquet(folder + "/messages")
    with Watch(spark, kept=2) as watch:
        rows = observed(checked(stream_files(spark, folder + "/messages", batch_bytes=1)))
        query = rows.writeStream.foreachBatch(lambda batch, n: batch.write.format("noop").mode("append").save()).option(
            "checkpointLocation", folder + "/checkpoint").trigger(**ONCE).start()
        watch.await_all([query])
        assert sorted(r.batch_id for r in watch.batch_counts(query).collect()) == [2, 3]
    assert OBSERVED in query.lastProgress.observedMetrics


def test_the_first_failure_stops_the_others_and_is_raised(spark, transactions, folder):
    path = folder + "/messages"
    to_envelope(transactions).write.parquet(path)
    tables = ServingTables(folder + "/tables")
    gate = {"open": False}

    def fails(batch, number):
        while not gate["open"]:
            time.sleep(0.1)
        raise ValueError("broken sink")

    with Watch(spark) as watch:
        first = start_scoring(stream_files(spark, path), source.with_stand_in_prediction, tables, folder + "/one",
                              {"processingTime": "100 milliseconds"})
        second = stream_files(spark, path).writeStream.foreachBatch(fails).option(
            "checkpointLocation", folder + "/two").start()
        end = time.time() + 60
        while tables.batch_counts(spark).count() == 0 and time.time() < end:
            time.sleep(0.2)
        gate["open"] = True
        with pytest.raises(StreamingQueryException, match="broken sink"):
            watch.await_all([first, second])
        assert not first.isActive and not second.isActive and first.exception() is None
    assert tables.predictions(spark).count() == 1500 == tables.batch_counts(spark).first().accepted


def test_queries_that_end_well_are_all_awaited(spark, transactions, folder):
    path = folder + "/messages"
    to_envelope(transactions).write.parquet(path)
    with Watch(spark) as watch:
        queries = [
            stream_files(spark, path).writeStream.format("noop").option(
                "checkpointLocation", f"{folder}/{n}").trigger(**ONCE).start() for n in range(2)
        ]
        watch.await_all(queries)
    assert not any(q.isActive for q in queries)


def test_a_trigger_by_time_takes_what_comes_later(spark, transactions, folder):
    path = folder + "/messages"
    halves = [to_envelope(transactions.filter(F.col("label") == n)) for n in (0, 1)]
    halves[0].write.parquet(path)
    tables = ServingTables(folder + "/tables")
    query = start_scoring(stream_files(spark, path), source.with_stand_in_prediction, tables, folder + "/checkpoint",
                          {"processingTime": "200 milliseconds"})
    try:
        for n, half in enumerate(halves):
            if n:
                half.write.mode("append").parquet(path)
            end = time.time() + 60
            while tables.batch_counts(spark).count() <= n and time.time() < end:
                time.sleep(0.2)
    finally:
        query.stop()
    assert tables.predictions(spark).count() == 1500 and tables.batch_counts(spark).count() >= 2


def test_lines_with_a_broken_field_are_set_aside(spark, folder):
    good = '{"transactionId":"t%d","userId":%d,"amount":5.0,"location":"NY","device":"Web","merchant":"Fuel","label":0%s}'
    lines = [good % (1, 1, ""), good % (2, 2, ',"timestamp":"noon"'), '{"userId":3,"amount":1.0,"label":1}', "{broken"]
    spark.createDataFrame([(t,) for t in lines], "value string").write.text(folder + "/json")
    rows = read_json(spark, folder + "/json", keep_unreadable=True)
    kept, held_out, rejects = train.sides(train.stage(rows))
    assert {(r.transactionId, r.cause) for r in rejects.collect()} == {
        ("t2", "unreadable field"), (None, "no transaction"), (None, "unreadable line")}
    assert [r.transactionId for r in kept.unionByName(held_out).collect()] == ["t1"]


def test_folders_by_a_pattern(spark, folder):
    for n in range(3):
        spark.range(1).write.parquet(f"{folder}/a/b={n}")
    found = folders.matching(spark, f"{folder}/a/b=*/_SUCCESS")
    assert [f.split("/")[-2] for f in found] == ["b=0", "b=1", "b=2"]
    assert folders.matching(spark, f"{folder}/none/*") == []
