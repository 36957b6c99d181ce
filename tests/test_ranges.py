"""Ranks, exact shares, wide category indices and the tree table against brute force or Spark's own."""

import random
from collections import Counter

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txrisk.operators import classes, features, model as classifier, trees
from txrisk.operators.metrics import score_auroc
from txrisk.operators.ranges import average_ranks, exact_share, with_running_total
from txrisk.plans import train
from txrisk.sources import orders as source

DATA = "/root/testdata/sf0.001"


def test_running_totals(spark):
    draw = random.Random(1)
    rows = [(i, draw.randint(-5, 9)) for i in range(3000)]
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, "k int, v long").repartition(5)
    found = {r.k: r.t for r in with_running_total(frame, [F.col("k").desc()], F.col("v"), "t").collect()}
    total = 0
    for k, v in sorted(rows, reverse=True):
        assert found[k] == total
        total += v
    assert with_running_total(frame.limit(0), [F.col("k")], F.col("v"), "t").count() == 0


def test_average_ranks_with_ties_nulls_and_nan(spark):
    values = [3.0, 1.0, 3.0, None, float("nan"), 2.0, 3.0, float("nan"), -0.0, 0.0]
    found = {str(r.v): (r.n, r.twice_rank) for r in average_ranks(spark.createDataFrame([(v,) for v in values], "v double"), "v").collect()}
    assert found == {"0.0": (2, 3), "1.0": (1, 6), "2.0": (1, 8), "3.0": (3, 12), "nan": (2, 17)}


@pytest.mark.parametrize("seed, distinct", [(1, 3), (2, 50), (3, 10**9), (4, 1)])
def test_auroc_is_the_evaluator_s(spark, seed, distinct):
    draw = random.Random(seed)
    rows = [(float(draw.random() < 0.3), draw.randrange(distinct) / distinct) for _ in range(800)]
    frame = spark.createDataFrame(rows, "label double, score double").repartition(6)
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(frame)
    row = score_auroc(frame).first()
    assert row.auroc_score == pytest.approx(want, abs=1e-12)
    assert (row.rows, row.positives) == (800, sum(label for label, _ in rows))


def test_auroc_without_a_class_without_rows_and_with_nulls(spark):
    def area(*rows):
        return tuple(score_auroc(spark.createDataFrame(list(rows), "label double, score double")).first())

    assert area((1.0, 0.2)) == (1, 1, 1.0) and area((0.0, 0.2)) == (1, 0, 0.0)
    assert area((1.0, 0.2), (0.0, 0.1), (None, 0.9), (0.0, None)) == (2, 1, 1.0)
    frame = spark.createDataFrame([], "label double, score double")
    assert tuple(score_auroc(frame).first()) == (0, 0, 0.0)


@pytest.mark.parametrize("n, share", [(0, 0.8), (1, 0.8), (1, 0.2), (7, 0.5), (1000, 0.8), (1001, 0.333), (50, 0.0), (50, 1.0)])
def test_exact_shares(spark, n, share):
    # A third of the rows are equal, another third share an id.
    rows = [("a", 0) if i % 3 == 0 else ("b", i) if i % 3 == 1 else (f"t{i}", i) for i in range(n)]
    frame = spark.createDataFrame(rows, "transactionId string, v int").repartition(4)
    found = classes.with_exact_split(frame, train_share=share).groupBy("split").count().collect()
    sizes = {r.split: r["count"] for r in found}
    assert sizes.get("train", 0) == int(share * n + 0.5) and sum(sizes.values()) == n


def test_the_smallest_draws_are_taken(spark):
    frame = spark.range(5000).withColumn("d", F.pmod(F.col("id") * 7919, F.lit(5000)) / 5000.0)
    found = exact_share(frame, F.col("d"), 0.31, "taken").collect()
    assert {r.d for r in found if r.taken} == {i / 5000.0 for i in range(1550)}


def test_random_split_keeps_all_rows(spark):
    rows = classes.with_random_split(spark.range(1000).withColumnRenamed("id", "transactionId"))
    sizes = {r.split: r["count"] for r in rows.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 1000 and 700 < sizes["train"] < 900


@pytest.mark.parametrize("split", train.SPLITS)
def test_the_job_splits_as_told(spark, split):
    rows = source.transactions(source.read_orders(spark, DATA))
    kept, held_out, _ = train.sides(train.stage(rows, split=split))
    sizes = kept.count(), held_out.count()
    assert sum(sizes) == 1500 and 1100 < sizes[0] < 1300
    assert split != "exact" or sizes == (1200, 300)


def plain_index(values):
    counts = Counter(v for v in values if v is not None)
    return {v: float(i) for i, (v, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0])))}


def test_indices_by_join_with_hot_missing_and_unseen_values(spark, monkeypatch):
    monkeypatch.setattr(features, "HOT", 3)
    draw = random.Random(5)
    values = ["hot"] * 700 + [draw.choice(["a", "b", None, *(f"v{i}" for i in range(300))]) for _ in range(1300)]
    frame = spark.createDataFrame(list(enumerate(values)), "id int, c string").repartition(5)
    want = plain_index(values)
    index = features.category_index(frame, ("c",))
    found = {r.id: r.c_idx for r in features.with_category_index(frame, index, ("c",)).collect()}
    assert found == {i: want.get(v, float(len(want))) for i, v in enumerate(values)}
    unseen = spark.createDataFrame([(1, "new"), (2, ""), (3, None)], "id int, c string")
    assert [r.c_idx for r in features.with_category_index(unseen, index, ("c",)).collect()] == [float(len(want))] * 3
    assert features.with_category_index(unseen, index.limit(0), ("c",)).first().c_idx == 0.0


def test_a_hundred_thousand_values(spark):
    frame = spark.range(130_000).withColumn("c", F.when(F.col("id") % 4 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id"))))
    path = features.work_dir(spark, "test-index")
    features.category_index(frame, ("c",)).write.parquet(path)
    index = spark.read.parquet(path)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        found = features.with_category_index(frame, index, ("c",)).cache()
        assert index.count() == found.agg(F.countDistinct("c_idx")).first()[0] == 97_501
        assert found.filter("c = 'hot'").agg(F.max("c_idx")).first()[0] == 0.0
        assert found.join(index, found.c == index.value).filter("c_idx <> index").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def test_scores_from_the_node_table(spark):
    rows = source.transactions(source.read_orders(spark, DATA))
    trained = train.train(rows, 6, source.split_draw())
    nodes = trees.node_table(spark, trained.model).cache()
    fitted = trained.model.stages[-1]
    assert nodes.select("tree").distinct().count() == 6 and nodes.count() == fitted.totalNumNodes
    assert [r.weight for r in nodes.select("tree", "weight").distinct().orderBy("tree").collect()] == list(fitted.treeWeights)
    scored = trees.score_by_table(classifier.score(trained.model, trained.test), nodes, fitted.getMaxDepth())
    for r in scored.withColumn("margin", vector_to_array("rawPrediction")[1]).collect():
        assert r.table_margin == pytest.approx(r.margin, abs=1e-9)
        assert r.table_prediction == r.prediction and r.at_leaves
    shallow = trees.score_by_table(classifier.score(trained.model, trained.test), nodes, 1)
    assert shallow.filter("at_leaves").count() == 0
