"""JSON files, envelopes, quarantine causes, batch tables, connector options, working folders."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from txrisk import schema
from txrisk.session import shared_dir, size_shuffles, work_dir
from txrisk.sources import folders, jdbc, kafka
from txrisk.sources.batch_table import compact, read_batch, read_batches, write_batch
from txrisk.sources.envelope import accepted, checked, parse_envelope, rejected, to_envelope
from txrisk.sources.files import read_json, write_json

NOON = datetime.datetime(2024, 1, 1, 12, 0, 0, 123456)
ROWS = [
    ("txn1", 1, 10.5, "NY", "Web", "Fuel", NOON, 0),
    ("txn2", 3_000_000_000, 0.1, 'T"X', "ATM", "Travel", NOON, 1),
    ("txn3", 2, 5.0, None, None, "Grocery", None, 1),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, schema.LABELLED)


def messages(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "key string, value string")


def test_json_roundtrip_cuts_to_milliseconds(spark, rows, folder):
    write_json(rows, folder + "/json")
    found = {r.transactionId: r for r in read_json(spark, folder + "/json").collect()}
    assert found["txn1"].timestamp == NOON.replace(microsecond=123000)
    assert found["txn2"].location == 'T"X' and found["txn3"].device is None
    write_json(rows, folder + "/json")
    assert read_json(spark, folder + "/json").count() == 3


def test_json_inference_sorts_columns_and_leaves_timestamps_as_text(spark, rows, folder):
    write_json(rows, folder + "/json")
    types = read_json(spark, folder + "/json", infer=True).dtypes
    assert [n for n, _ in types] == sorted(n for n, _ in types)
    assert dict(types)["userId"] == "bigint" and dict(types)["timestamp"] == "string"


def test_envelope_roundtrip(rows):
    parsed = parse_envelope(to_envelope(rows))
    assert parsed.columns == ["message_key", "raw", *schema.MESSAGE.names]
    back = sorted(tuple(r) for r in parsed.select(*schema.TRANSACTION.names).collect()
                  if r.timestamp is not None)
    assert back == sorted(r[:7] for r in ROWS if r[6] is not None)
    assert parsed.filter("message_key <> transactionId").count() == 0


def test_message_timestamps(spark):
    found = parse_envelope(messages(
        spark,
        '{"userId":1,"timestamp":"2024-01-01 12:00:00.123456789"}',
        '{"userId":1,"timestamp":"2024-01-01 12:00:00.0"}',
        '{"userId":1,"timestamp":"2024-01-01 12:00:00"}',
    )).select("timestamp").collect()
    assert [r[0] for r in found] == [NOON, NOON.replace(microsecond=0), NOON.replace(microsecond=0)]


@pytest.mark.parametrize("text, cause", [
    (None, "empty message"),
    ("", "unreadable message"),
    ("garbage", "unreadable message"),
    ("[]", "unreadable message"),
    ("{}", "unreadable message"),
    ('{"transactionId":"t","userId":1,"amount":5.0', "unreadable message"),
    ('{"transactionId":"t","userId":"abc","amount":5.0}', "no user"),
    ('{"transactionId":"t","amount":5.0}', "no user"),
    ('{"transactionId":"t","userId":1}', "no amount"),
    ('{"transactionId":"t","userId":1,"amount":NaN}', "amount is not a number"),
    ('{"transactionId":"t","userId":1,"amount":1e400}', "amount is infinite"),
    ('{"transactionId":"t","userId":1,"amount":-1.0}', "amount has no log"),
    ('{"transactionId":"t","userId":1,"amount":-0.5}', None),
    ('{"userId":1,"amount":5.0}', "no transaction"),
    ('{"transactionId":"t","userId":1,"amount":5.0,"timestamp":"yesterday"}', "unreadable field"),
    ('{"transactionId":"t","userId":1,"amount":5.0,"location":null}', None),
    ('{"transactionId":"t","userId":1,"amount":5,"label":1,"extra":[1]}', None),
])
def test_reject_causes(spark, text, cause):
    row = checked(messages(spark, text)).collect()
    assert [r.cause for r in row] == [cause]
    assert row[0].raw == (text if cause else None)


def test_bad_field_keeps_the_others(spark):
    row = parse_envelope(messages(
        spark, '{"transactionId":"t","userId":"abc","amount":5.0,"device":"Web"}')).first()
    assert (row.transactionId, row.userId, row.amount, row.device) == ("t", None, 5.0, "Web")


def test_every_message_is_accepted_or_rejected(spark):
    rows = checked(messages(spark, None, "x", '{"transactionId":"t","userId":1,"amount":5.0}', '{"userId":2}'))
    assert accepted(rows).count() == 1 and rejected(rows).count() == 3
    assert accepted(rows).columns == schema.TRANSACTION.names
    assert rejected(rows).columns == schema.REJECT.names


def test_text_is_parsed_once_per_row(spark):
    plan = rejected(checked(messages(spark, "x")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_batches_replace_themselves(spark, folder):
    path = folder + "/t"
    rows = spark.range(10).select(F.col("id").cast("string").alias("message_key"),
                                  F.lit("x").alias("raw"), F.lit("c").alias("cause"))
    write_batch(rows, path, 0)
    write_batch(rows, path, 1)
    write_batch(rows, path, 1)
    assert read_batches(spark, path, schema.REJECT).count() == 20
    assert read_batch(spark, path, schema.REJECT, 1).count() == 10
    assert {r.batch_id for r in read_batch(spark, path, schema.REJECT, 1).collect()} == {1}
    write_batch(rows.limit(0), path, 1)
    assert read_batches(spark, path, schema.REJECT).count() == 10


class Recorder:
    """Stands in for a reader or writer and notes the calls made on it."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self
        return call

    @property
    def option_values(self):
        return {a[0]: a[1] for n, a, _ in self.calls if n == "option"}


class Session:
    def __init__(self):
        self.readStream = self.writeStream = self.read = self.write = Recorder()


def test_kafka_options():
    session = Session()
    kafka.read_topic(session, "h:1", "t", maxOffsetsPerTrigger=5)
    assert session.read.option_values == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest"}
    assert ("options", (), {"maxOffsetsPerTrigger": "5"}) in session.read.calls
    session = Session()
    kafka.write_topic(session, "h:1", "t")
    assert session.write.option_values == {"kafka.bootstrap.servers": "h:1", "topic": "t"}
    session = Session()
    kafka.stream_to_topic(session, "h:1", "t", "/c")
    assert session.writeStream.option_values["checkpointLocation"] == "/c"


def test_jdbc_calls():
    session = Session()
    jdbc.append_table(session, "jdbc:x", {"user": "u"})
    assert session.write.calls == [
        ("mode", ("append",), {}),
        ("jdbc", ("jdbc:x", "transaction_predictions"), {"properties": {"user": "u"}})]
    session = Session()
    jdbc.read_table(session, "jdbc:x", {}, partition_column="userId", lower=0, upper=9, partitions=3)
    assert session.read.calls[0][2]["numPartitions"] == 3
    with pytest.raises(TypeError):
        jdbc.read_table(session, "jdbc:x", {})


def test_working_folders_lie_below_the_shared_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second and first.startswith(shared_dir(spark))


class Bare:
    """A session without a checkpoint folder."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master, self.folder = master, None

    def get(self, name, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shuffles_are_sized_on_clusters_only():
    class Cluster(Bare):
        defaultParallelism = 5000
        settings = {"spark.sql.shuffle.partitions": "200"}

        def get(self, name):
            return self.settings[name]

        def set(self, name, value):
            self.settings[name] = value

    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    size_shuffles(Cluster("local[8]"))
    assert name not in Cluster.settings
    size_shuffles(Cluster("yarn"))
    assert Cluster.settings[name] == "15000"
    size_shuffles(Cluster("yarn"), 5 << 40)
    assert Cluster.settings[name] == "20480"
    size_shuffles(Cluster("yarn"), 100 << 40)
    assert Cluster.settings[name] == "100000"


def test_only_local_sessions_may_lack_a_shared_folder():
    with pytest.raises(ValueError):
        shared_dir(Bare("yarn"))
    local = Bare("local[2]")
    assert shared_dir(local) == local.folder == shared_dir(local)


def test_compaction_keeps_every_batch_once(spark, folder):
    path, kind = f"{folder}/table", schema.BATCH_COUNT
    rows = spark.createDataFrame([(n, n, 0) for n in range(5)], "row_count long, accepted long, rejected long")

    def table():
        return sorted((r.batch_id, r.row_count) for r in read_batches(spark, path, kind).collect())

    assert table() == [] and compact(spark, path, kind, 9, block=3) == []
    for number in range(8):
        write_batch(rows.limit(number), path, number, block=3)
    expected = table()
    assert len(expected) == 0 + 1 + 2 + 3 + 4 + 5 + 5 + 5
    before = read_batches(spark, path, kind)
    # Batch 7 may still be retried, so its block stays.
    assert compact(spark, path, kind, 7, block=3) == [0, 1]
    assert table() == expected == sorted((r.batch_id, r.row_count) for r in before.collect())
    assert sum(1 for _ in os.scandir(f"{path}/recent")) == 3
    assert compact(spark, path, kind, 7, block=3) == []
    assert table() == expected
    assert [f.name for f in os.scandir(f"{path}/recent")] == ["block=2"]
    files = [f for b in os.scandir(f"{path}/merged") for f in os.listdir(b) if f.endswith(".parquet")]
    assert len(files) == 2
    write_batch(rows.limit(1), path, 7, block=3)
    assert len(table()) == len(expected) - 4
    with pytest.raises(ValueError, match="merged already"):
        write_batch(rows, path, 2, block=3)


def test_an_unfinished_merge_is_not_read(spark, folder):
    path, kind = f"{folder}/table", schema.BATCH_COUNT
    rows = spark.createDataFrame([(1, 1, 0)], "row_count long, accepted long, rejected long")
    for number in range(3):
        write_batch(rows, path, number, block=2)
    rows.withColumn("batch_id", rows.row_count).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/merged/block=0")
    assert not os.path.exists(f"{path}/merged/block=0/_SUCCESS")
    assert sorted(r.batch_id for r in read_batches(spark, path, kind).collect()) == [0, 1, 2]
    assert compact(spark, path, kind, 2, block=2) == [0]
    assert sorted(r.batch_id for r in read_batches(spark, path, kind).collect()) == [0, 1, 2]


def test_size_of_a_folder(spark, folder):
    spark.range(10).write.parquet(f"{folder}/a/b")
    files = [e.path for e in os.scandir(f"{folder}/a/b")]
    assert folders.size(spark, f"{folder}/a") == sum(map(os.path.getsize, (
        f for f in files if f.endswith((".parquet", "_SUCCESS"))))) > 0
    assert folders.size(spark, f"{folder}/*") == folders.size(spark, f"{folder}/a")
    assert folders.size(spark, f"{folder}/none") == 0
    assert folders.children(spark, f"{folder}/a") == ["b"] and folders.children(spark, f"{folder}/none") == []
