"""Class weights, split, indices, metrics, ranking and reductions against brute force or Spark's own."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from txrisk.operators import classes, features, model
from txrisk.operators.metrics import classification_metrics, confusion
from txrisk.operators.ranking import leading_values, share_leaders, top_ranked
from txrisk.operators.reductions import last_values, legend_figures, with_share


def scored(spark, pairs):
    return spark.createDataFrame([(float(a), float(b)) for a, b in pairs],
                                 "label double, prediction double")


MIXED = [(random.Random(1).choice([0, 0, 1]), 0)] + [
    (random.Random(i).choice([0, 0, 1]), random.Random(i + 999).choice([0, 1])) for i in range(200)
]


@pytest.mark.parametrize("pairs", [
    MIXED,
    [(0, 0), (1, 1)],
    [(0, 1), (1, 0)],
    [(0, 0), (1, 0), (0, 0)],
    [(0, 1), (1, 1)],
], ids=["mixed", "perfect", "inverted", "never", "always"])
def test_metrics_equal_the_evaluators(spark, pairs):
    rows = scored(spark, pairs)
    found = classification_metrics(rows).first()

    def multi(name, label=0.0):
        return MulticlassClassificationEvaluator(metricName=name, metricLabel=label).evaluate(rows)

    want = {
        "accuracy": multi("accuracy"),
        "precision_0": multi("precisionByLabel"), "recall_0": multi("recallByLabel"),
        "precision_1": multi("precisionByLabel", 1.0), "recall_1": multi("recallByLabel", 1.0),
        "f1": multi("f1"),
        "auroc_hard": BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(rows),
    }
    assert found.asDict() == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("pairs", [[(0, 0), (0, 1)], [(1, 0), (1, 1)]])
def test_hard_auroc_with_one_class(spark, pairs):
    rows = scored(spark, pairs)
    want = BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(rows)
    assert classification_metrics(rows).first().auroc_hard == pytest.approx(want)


def test_metrics_count_other_labels(spark):
    pairs = [(0, 0), (1, 1), (2, 1), (2, 0), (1, 0), (0, 0)]
    rows = scored(spark, pairs)
    found = classification_metrics(rows).first()
    for name, metric in (("accuracy", "accuracy"), ("f1", "f1"), ("precision_1", "precisionByLabel")):
        want = MulticlassClassificationEvaluator(metricName=metric, metricLabel=1.0).evaluate(rows)
        assert found[name] == pytest.approx(want)
    want = BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(rows)
    assert found.auroc_hard == pytest.approx(want)


def test_metrics_leave_unlabelled_rows_out(spark):
    rows = spark.createDataFrame([(0, 0.0), (None, 1.0), (1, 1.0), (1, None)],
                                 "label int, prediction double")
    assert classification_metrics(rows).first().accuracy == 1.0
    assert confusion(rows).count() == 4


def test_class_weights(spark):
    rows = spark.createDataFrame([(1,), (0,), (0,), (None,)], "label int")
    found = sorted(classes.with_class_weights(rows).collect(), key=str)
    assert {(r.label, r.weight) for r in found} == {(1, 0.75), (0, 0.25), (None, 0.25)}
    assert classes.with_class_weights(rows.limit(0)).collect() == []
    assert classes.class_counts(rows).first().asDict() == {"total": 4, "positives": 1, "rest": 3}


def test_class_weights_neither_join_nor_shuffle_the_rows(spark):
    rows = spark.range(100).select((F.col("id") % 2).alias("label"), "id")
    plan = classes.with_class_weights(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_split_does_not_depend_on_partitions(spark):
    rows = spark.range(10000).select(F.concat(F.lit("txn"), "id").alias("transactionId"))
    one, other = classes.with_split(rows), classes.with_split(rows.repartition(5))
    assert one.exceptAll(other).count() == 0
    assert abs(one.filter("split = 'train'").count() - 8000) < 150


CATEGORY_ROWS = [("NY", "Web", "Fuel"), ("NY", "ATM", "Fuel"), ("CA", "ATM", "Fuel"),
                 ("TX", None, "Travel"), (None, "Web", "Travel")]


def test_category_index_is_what_the_indexer_learns(spark):
    rows = spark.createDataFrame(CATEGORY_ROWS, "location string, device string, merchant string")
    columns = ["location", "device", "merchant"]
    learned = StringIndexer(inputCols=columns, outputCols=[c + "_idx" for c in columns],
                            handleInvalid="keep").fit(rows)
    table = features.category_index(rows).collect()
    for column, labels in zip(columns, learned.labelsArray):
        want = {v: float(i) for i, v in enumerate(labels)}
        assert {r.value: r["index"] for r in table if r.column == column} == want
    ours = features.fit_category_indexers(rows)
    assert [m.labels for m in ours] == list(learned.labelsArray)
    found = rows
    for indexer in ours:
        found = indexer.transform(found)
    assert found.exceptAll(learned.transform(rows)).count() == 0


def test_unseen_and_missing_categories_share_the_last_index(spark):
    kind = "transactionId string, userId long, amount_log double, location string, device string, merchant string"
    rows = spark.createDataFrame([
        ("a", 1, 1.0, "NY", "Web", "Fuel"), ("b", 2, 2.0, "CA", "ATM", "Fuel")], kind)
    new = spark.createDataFrame([
        ("c", 1, 1.0, "ZZ", None, "Fuel"), ("d", 1, 1.0, None, "Web", "New")], kind)
    indexer = features.fit_category_indexers(rows)
    found = {r.transactionId: r for r in
             features.feature_slots(features.with_features(new, indexer)).collect()}
    assert found["c"].f_location_idx == found["d"].f_location_idx == 2.0
    assert found["c"].f_device_idx == 2.0 and found["d"].f_merchant_idx == 1.0


def test_all_categories_are_indexed(spark):
    rows = spark.range(5000).select(F.concat(F.lit("v"), F.col("id") % 3000).alias("location"))
    index = features.category_index(rows, ("location",))
    # Counting needs no index column, and loses no row without it.
    assert index.count() == index.select("column", "value").count() == 3000
    expected = sorted((f"v{i}" for i in range(3000)), key=lambda v: (int(v[1:]) >= 2000, v))
    assert [r.value for r in index.orderBy("index").collect()] == expected
    assert [r["index"] for r in index.orderBy("index").collect()] == list(range(3000))


def test_wide_columns_are_refused_before_they_reach_the_driver(spark):
    rows = spark.range(50).select(F.col("id").cast("string").alias("location"),
                                  F.lit("x").alias("device"), F.lit("y").alias("merchant"))
    with pytest.raises(ValueError, match="50 distinct values to index in location"):
        features.fit_category_indexers(rows, most=49)


def test_forty_categories_train(spark):
    rows = spark.range(400).select(
        F.col("id").alias("userId"), F.rand(1).alias("amount_log"), (F.col("id") % 40).cast("string").alias("location"),
        F.lit("x").alias("device"), F.lit("y").alias("merchant"), (F.col("id") % 2).cast("int").alias("label"),
        F.lit(1.0).alias("weight"),
    )
    assert model.fit(rows, max_iter=1).stages[-1].getMaxBins() == 41


def brute_rank(rows, top):
    """SQL RANK by amount descending, nulls first."""
    out = []
    for user, amount, number in rows:
        def before(other):
            if amount is None:
                return False
            return other is None or other > amount
        rank = 1 + sum(before(a) for u, a, _ in rows if u == user)
        if rank <= top:
            out.append((user, amount, number, rank))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def ranking_rows():
    draw = random.Random(7)
    rows = [(draw.choice([1, 2, 3, None]), draw.choice([None, 1.0, 2.0, 2.0, 5.0, 7.5]), i)
            for i in range(300)]
    rows += [(4, None, 900), (4, 1.0, 901), (4, 2.0, 902), (4, 2.0, 903), (4, 0.5, 904)]
    return rows + [(5, 3.0, 950 + i) for i in range(20)]


@pytest.mark.parametrize("top", [1, 3])
@pytest.mark.parametrize("threshold", ["10485760", "-1"], ids=["broadcast", "merge"])
def test_top_ranked_equals_brute_force(spark, top, threshold):
    rows = ranking_rows()
    frame = spark.createDataFrame(rows, "user int, amount double, n int").repartition(5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        result = top_ranked(frame, "user", "amount", top, "place_found")
        found = [tuple(r) for r in result.collect()]
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert ("BroadcastHashJoin" in plan) == (threshold != "-1")
    assert sorted(found, key=key) == sorted(brute_rank(rows, top), key=key)


def test_one_user_with_a_third_of_all_rows_in_one_tie(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 1000).alias("user"),
        F.when(F.col("id") % 3 == 0, 50.0).otherwise(F.col("id").cast("double")).alias("amount"),
        F.col("id").alias("n"),
    )
    # However many rows tie, what is ranked centrally is at most the top rows of each user.
    assert leading_values(rows, "user", "amount", 3).filter("user = -1").count() == 1
    found = top_ranked(rows, "user", "amount", 3, "place_found")
    assert found.filter("user = -1 AND place_found = 1").count() == 10000
    assert found.filter("user <> -1").count() == rows.filter("user <> -1").select("user").distinct().count() * 3


def test_ranking_is_pruned_before_the_shuffle(spark, folder):
    spark.createDataFrame(ranking_rows(), "user int, amount double, n int").write.parquet(folder + "/r")
    plan = leading_values(spark.read.parquet(folder + "/r"), "user", "amount", 3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "ReadSchema: struct<user:int,amount:double>" in text
    assert text.count("Exchange") == 1


def test_the_large_shuffle_gets_pruned_rows(spark, folder):
    spark.createDataFrame(ranking_rows(), "user int, amount double, n int").write.parquet(folder + "/r")
    plan = share_leaders(spark.read.parquet(folder + "/r"), "user", "amount", 3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    above, below = text.split("Exchange")
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below
    tied = spark.range(0, 3000, numPartitions=6).select(F.lit(1).alias("user"), F.lit(2.0).alias("amount"))
    assert share_leaders(tied, "user", "amount", 3).count() == 3000


def test_share(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", None)], "k string, v double")
    assert {r.k: r.share for r in with_share(rows, "v").collect()} == {"a": 0.25, "b": 0.75, "c": None}
    zero = spark.createDataFrame([("a", 0.0)], "k string, v double")
    assert with_share(zero, "v").first().share is None
    assert "Window" not in with_share(rows, "v")._jdf.queryExecution().optimizedPlan().toString()


def test_last_values_skip_nulls(spark):
    rows = spark.createDataFrame([(1, 10.0, 5), (2, 20.0, None), (3, None, None)], "k int, x double, y int")
    found = {(r.panel, r.field): r.value
             for r in last_values(rows, [("p", "x"), ("p", "y"), ("q", "k")], ["k"]).collect()}
    assert found == {("p", "x"): 20.0, ("p", "y"): 5.0, ("q", "k"): 3.0}


def test_legend(spark):
    rows = spark.createDataFrame([("a", 4.0), ("b", 1.0), ("c", 7.0)], "k string, v double")
    assert tuple(legend_figures(rows, "v", "k").first()) == (1.0, 7.0, 4.0)
