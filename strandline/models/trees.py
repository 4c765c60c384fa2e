"""A fitted forest as a table of nodes: scores by joins, importances by aggregates."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.models.features import FEATURES, complete, feature_names, numeric_inputs
from strandline.operators.joins import join_checked
from strandline.session import keep, scratch_path

ROOT = 0


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The forest's nodes, stored: tree, node, and what a node knows.

    ``feature`` is the slot an inner node looks at, null for a leaf. A row goes to
    ``left_node`` if its value is among ``left_values``, or, where these are null, if it is
    not above ``threshold``; else to ``right_node``. ``votes`` are the weights of the
    classes among the training rows that came here, ``weight`` is their sum, ``rows`` their
    number, and ``gain`` what the split gained in impurity.
    """
    path = scratch_path(spark, "forest")
    model.stages[-1].save(path)
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0
    nominal = n["split"]["numCategories"] >= 0
    values = n["split"]["leftCategoriesOrThreshold"]
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        n["id"].alias("node"),
        F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        F.when(inner & nominal, values).alias("left_values"),
        F.when(inner & ~nominal, F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner, n["leftChild"]).alias("left_node"),
        F.when(inner, n["rightChild"]).alias("right_node"),
        F.when(inner, n["gain"]).alias("gain"),
        n["impurityStats"].alias("votes"),
        F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, x: a + x).alias("weight"),
        n["rawCount"].alias("rows"),
    )
    return keep(nodes, "forest-nodes")


def leaves(nodes: DataFrame, rows: DataFrame, key: str, values: str, trees: int, depth: int) -> DataFrame:
    """(key, tree, votes, weight) of the leaf that every row reaches in every tree.

    ``values`` is an array of the feature slots. A row goes down all trees at once, a join
    per level. The nodes are at most trees * 2^(depth + 1), and are broadcast if they are
    within the checked size. Rows with equal keys keep leaves of their own.
    """
    at = rows.select(
        F.col(key),
        F.col(values).alias("__x"),
        F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"),
    ).withColumn("node", F.lit(ROOT))
    inner = nodes.where("feature IS NOT NULL").select(
        "tree", "node", "feature", "left_values", "threshold", "left_node", "right_node"
    )
    for _ in range(depth):
        met = join_checked(at, inner, ["tree", "node"], "left")
        x = F.get(F.col("__x"), F.col("feature"))
        left = F.coalesce(F.array_contains("left_values", x), x <= F.col("threshold"))
        child = F.when(left, F.col("left_node")).otherwise(F.col("right_node"))
        # a leaf has no feature; there the row stays
        node = F.when(F.col("feature").isNull(), F.col("node")).otherwise(child)
        at = met.select(key, "__x", "tree", node.alias("node"))
    return join_checked(at, nodes.select("tree", "node", "votes", "weight"), ["tree", "node"]).select(
        key, "tree", "votes", "weight"
    )


def forest_scores(model: PipelineModel, nodes: DataFrame, df: DataFrame, key: str, prefix: str = "") -> DataFrame:
    """(key, trees, ``<prefix>prediction``, ``<prefix>score``) of each row of ``df``, from the node table alone.

    A tree votes with the shares of the classes in the leaf a row reaches, the votes of all
    trees are averaged, and the class with the larger share is the prediction, the lower
    one on a tie. ``key`` must tell the rows apart. Rows that lack one of the model's
    numbers have no scores and are left out.
    """
    encoded = PipelineModel(model.stages[:-1]).transform(df.where(complete(numeric_inputs(model))))
    rows = encoded.select(key, vector_to_array(FEATURES).alias("values"))
    forest = model.stages[-1]
    reached = leaves(nodes, rows, key, "values", forest.getNumTrees, forest.getOrDefault("maxDepth"))
    share = F.try_divide(F.get("votes", F.lit(1)), F.col("weight"))
    scored = reached.groupBy(key).agg(F.count(F.lit(1)).alias("trees"), F.avg(share).alias(f"{prefix}score"))
    return scored.withColumn(f"{prefix}prediction", (F.col(f"{prefix}score") > 0.5).cast("int"))


def node_importance(spark: SparkSession, model: PipelineModel, nodes: DataFrame) -> DataFrame:
    """(feature, importance) per slot of the feature vector, from the nodes' gains.

    A slot's part in a tree is the gain of its nodes times their weight, relative to all
    nodes of the tree; trees count alike, and the slots of the forest sum to one. A slot
    that no node looks at has importance 0, and so have all if no tree has a split.
    """
    names = feature_names(model, numeric_inputs(model))
    slots = spark.createDataFrame(list(enumerate(names)), "slot int, feature string")
    gains = nodes.where("feature IS NOT NULL").groupBy("tree", F.col("feature").alias("slot")).agg(
        F.sum(F.col("gain") * F.col("weight")).alias("gain")
    )
    per_tree = gains.groupBy("tree").agg(F.sum("gain").alias("whole"))
    shares = gains.join(per_tree, "tree").groupBy("slot").agg(
        F.sum(F.coalesce(F.try_divide("gain", "whole"), F.lit(0.0))).alias("share")
    )
    whole = shares.agg(F.sum("share")).scalar()
    return slots.join(shares, "slot", "left").select(
        "feature", F.coalesce(F.try_divide("share", whole), F.lit(0.0)).alias("importance")
    )
