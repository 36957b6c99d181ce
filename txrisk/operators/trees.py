"""The fitted trees as a table, and scores from that table without the ML library.

The node table is what a reader of the model needs to see why a row scored as it did, and it scores rows by itself:
in column expressions, wherever SQL runs.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txrisk.session import work_dir


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """A row per node: tree, node, feature, threshold, categories, left, right, value and the tree's weight.

    Node 0 is the root. A leaf has no feature. A row goes left if its feature is at most the threshold or,
    for an indexed category, among ``categories``.
    """
    path = work_dir(spark, "trees")
    model.stages[-1].write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    node = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner, numeric = F.col("leftChild") >= 0, F.col("split.numCategories") < 0
    limit = F.col("split.leftCategoriesOrThreshold")

    def where(test: Column, value: Column) -> Column:
        return F.when(test, value)

    return node.join(weights, "tree").select(
        "tree", F.col("id").alias("node"), where(inner, F.col("split.featureIndex")).alias("feature"),
        where(inner & numeric, F.get(limit, F.lit(0))).alias("threshold"), where(inner & ~numeric, limit).alias("categories"),
        where(inner, F.col("leftChild")).alias("left"), where(inner, F.col("rightChild")).alias("right"),
        F.col("prediction").alias("value"), "weight",
    )


def forest(nodes: DataFrame) -> Column:
    """The node table as one value, trees in order with their nodes in order: a scalar subquery of a model's size."""
    fields = ("feature", "threshold", "categories", "left", "right", "value")
    trees = nodes.groupBy("tree").agg(
        F.first("weight").alias("weight"),
        F.transform(F.sort_array(F.collect_list(F.struct("node", *fields))), lambda n: F.struct(*(n[f] for f in fields))).alias("nodes"),
    )
    return trees.agg(F.sort_array(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("trees")).scalar()


def leaf(tree: Column, slots: Column, depth: int) -> Column:
    """The number of the node that a row's features lead to, after ``depth`` steps at most."""
    def step(at: Column, _: Column) -> Column:
        node = F.get(tree["nodes"], at)
        value = F.get(slots, node["feature"])
        to_left = F.when(node["categories"].isNotNull(), F.array_contains(node["categories"], value)).otherwise(
            value <= node["threshold"]
        )
        return F.when(node["left"].isNull(), at).when(to_left, node["left"]).otherwise(node["right"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)


def score_by_table(rows: DataFrame, nodes: DataFrame, depth: int, features: str = "features") -> DataFrame:
    """Adds ``table_margin``, ``table_prediction`` and ``at_leaves``, whether each tree's path ended in a leaf."""
    slots = vector_to_array(features)
    ends = F.transform(
        F.col("_trees"), lambda tree: F.struct(tree["weight"].alias("weight"), F.get(tree["nodes"], leaf(tree, F.col("_slots"), depth)).alias("node"))
    )
    margin = F.aggregate("_ends", F.lit(0.0), lambda total, e: total + e["weight"] * e["node"]["value"])
    return (
        rows.withColumn("_slots", slots).withColumn("_trees", forest(nodes)).withColumn("_ends", ends)
        .withColumn("table_margin", margin)
        .withColumn("table_prediction", (F.col("table_margin") > 0).cast("double"))
        .withColumn("at_leaves", F.forall("_ends", lambda e: e["node"]["left"].isNull()))
        .drop("_slots", "_trees", "_ends")
    )
