"""Fitted models as tables of rows, and the plain joins and expressions that apply them.

A model run writes what it fitted beside its outputs:

* ``inputs`` (feature, name, mean, scale): how a column becomes a model's number,
  ``(value - mean) * scale``; ``feature`` is its place in the vector.
* ``levels`` (level, place): the number that stands for a subscription level; any other
  level, and none, gets the number of levels.
* ``nodes`` (tree, node, feature, threshold, low, high, share, weight, gain): one row per
  node of a forest. An inner node sends a row to ``low`` where its feature is at most the
  threshold, else to ``high``; ``share`` is the share of label 1 among a node's training
  rows, which decides at leaves (``feature`` null).
* ``centres`` (segment, feature, centre): one row per cluster and feature.

Scores and segments follow from these rows in Spark or in another SQL engine, without
the model's classes. The tables are as large as the model, at most
``trees * 2^(depth + 1)`` nodes, whatever the number of users, so every task gets them.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playlake import fixed
from playlake.functions.labels import risk_band

LEVEL_INPUT = "level_idx"
INPUTS_DDL = "feature INT, name STRING, mean DOUBLE, scale DOUBLE"
LEVELS_DDL = "level STRING, place INT"
NODES_DDL = (
    "tree INT, node INT, feature INT, threshold DOUBLE, low INT, high INT, share DOUBLE, weight DOUBLE, gain DOUBLE"
)
CENTRES_DDL = "segment INT, feature INT, centre DOUBLE"


def input_table(spark: SparkSession, model: PipelineModel | None) -> DataFrame:
    """The scaling of a fitted pipeline, one row per entry of its vector."""
    rows = []
    if model is not None:
        _, assembler, scaler, _ = model.stages
        spread = zip(assembler.getInputCols(), scaler.mean.toArray().tolist(), scaler.std.toArray().tolist(), strict=True)
        rows = [(n, name, mean, 1.0 / std if std else 0.0) for n, (name, mean, std) in enumerate(spread)]
    return spark.createDataFrame(rows, INPUTS_DDL)


def level_table(spark: SparkSession, model: PipelineModel | None) -> DataFrame:
    labels = [] if model is None else model.stages[0].labelsArray[0]
    return spark.createDataFrame([(label, n) for n, label in enumerate(labels)], LEVELS_DDL)


def node_table(spark: SparkSession, model: PipelineModel | None, path: str) -> DataFrame:
    """The nodes of a forest whose pipeline is kept at ``path``, from the rows it was kept as."""
    if model is None:
        return spark.createDataFrame([], NODES_DDL)
    place = len(model.stages) - 1
    held = spark.read.parquet(f"{path}/stages/{place}_{model.stages[place].uid}/data")
    node = F.col("nodeData")
    inner = node["leftChild"] >= 0
    stats = node["impurityStats"]
    weight = F.aggregate(stats, F.lit(0.0), lambda total, each: total + each)
    return held.select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(inner, node["split"]["featureIndex"]).alias("feature"),
        F.when(inner, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner, node["leftChild"]).alias("low"),
        F.when(inner, node["rightChild"]).alias("high"),
        F.try_divide(F.coalesce(F.get(stats, F.lit(1)), F.lit(0.0)), weight).alias("share"),
        weight.alias("weight"),
        F.when(inner, node["gain"]).alias("gain"),
    )


def centre_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    centres = model.stages[-1].clusterCenters()
    rows = [(s, n, float(v)) for s, centre in enumerate(centres) for n, v in enumerate(centre)]
    return spark.createDataFrame(rows, CENTRES_DDL)


def model_vector(inputs: DataFrame, levels: DataFrame) -> Column:
    """The scaled vector of a row, as an expression over its columns.

    One row per input and level is read here: they become constants of the plan.
    """
    places = {row["level"]: row["place"] for row in levels.collect()}
    number = F.lit(len(places))
    for level, place in places.items():
        number = F.when(F.col("level") == level, place).otherwise(number)

    def scaled(row) -> Column:
        value = number if row["name"] == LEVEL_INPUT else F.col(row["name"])
        return (value.cast("double") - F.lit(row["mean"])) * F.lit(row["scale"])

    return F.array(*[scaled(row) for row in sorted(inputs.collect(), key=lambda row: row["feature"])])


def forest_scores(
    rows: DataFrame,
    inputs: DataFrame,
    levels: DataFrame,
    nodes: DataFrame,
    key: str = "userId",
    depth: int = fixed.FOREST_DEPTH,
) -> DataFrame:
    """(key, churn_probability): the mean share of the leaves that a row comes to.

    ``key`` tells the rows apart. Every row descends all trees, one broadcast join per
    level of ``depth``; nothing is shuffled until each task has averaged its own rows.
    """
    trees = nodes.agg(F.max("tree").alias("last")).first()["last"]
    if trees is None:
        return rows.select(key, F.lit(0.0).alias("churn_probability"))
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees))).alias("tree")
    at = rows.select(key, model_vector(inputs, levels).alias("x"), tree).withColumn("node", F.lit(0))
    steps = F.broadcast(nodes.filter("feature is not null").select("tree", "node", "feature", "threshold", "low", "high"))
    leaves = F.broadcast(nodes.filter("feature is null").select("tree", "node", "share"))
    below = F.get("x", F.col("feature")) <= F.col("threshold")
    onward = F.when(F.col("feature").isNull(), F.col("node")).otherwise(F.when(below, F.col("low")).otherwise(F.col("high")))
    for _ in range(depth):
        at = at.join(steps, ["tree", "node"], "left").select(key, "x", "tree", onward.alias("node"))
    reached = at.join(leaves, ["tree", "node"])
    return reached.groupBy(key).agg(F.avg("share").alias("churn_probability"))


def banded(scores: DataFrame) -> DataFrame:
    """Scores with their risk bands."""
    return scores.withColumn("risk_level", risk_band(F.col("churn_probability")))


def importances(nodes: DataFrame, inputs: DataFrame) -> DataFrame:
    """(name, importance): each input's share of the gain, every tree counting alike."""
    split = nodes.filter("feature is not null").withColumn("part", F.col("gain") * F.col("weight"))
    per_tree = split.groupBy("tree").agg(F.sum("part").alias("whole")).filter("whole > 0")
    shares = split.join(per_tree, "tree").groupBy("feature").agg(F.sum(F.col("part") / F.col("whole")).alias("gained"))
    total = shares.agg(F.sum("gained")).scalar()
    named = inputs.select("feature", "name").join(shares, "feature", "left")
    return named.select("name", F.coalesce(F.col("gained") / total, F.lit(0.0)).alias("importance"))


def nearest_segment(inputs: DataFrame, levels: DataFrame, centres: DataFrame) -> Column:
    """The segment whose centre is nearest to a row's vector, the first of equally near ones."""
    found: dict[int, dict[int, float]] = {}
    for row in centres.collect():  # clusters times features
        found.setdefault(row["segment"], {})[row["feature"]] = row["centre"]
    x = model_vector(inputs, levels)

    def away(segment: int) -> Column:
        terms = [F.get(x, F.lit(n)) - F.lit(value) for n, value in sorted(found[segment].items())]
        return F.struct(sum((t * t for t in terms), F.lit(0.0)).alias("distance"), F.lit(segment).alias("segment"))

    options = [away(segment) for segment in sorted(found)]
    return (F.least(*options) if len(options) > 1 else options[0])["segment"]


def assigned(rows: DataFrame, inputs: DataFrame, levels: DataFrame, centres: DataFrame) -> DataFrame:
    """``rows`` with the segment of their nearest centre."""
    return rows.withColumn("segment", nearest_segment(inputs, levels, centres))


def group_centres(rows: DataFrame, names: list[str], by: str) -> tuple[DataFrame, DataFrame]:
    """(inputs, centres) that standardise ``names`` and centre each group of ``by``.

    Groups are numbered by name. For segments that are given, not found: plans, regions.
    """
    spark = rows.sparkSession
    columns = [F.struct(F.avg(n).alias("mean"), F.stddev_samp(n).alias("std")).alias(n) for n in names]
    spread = rows.agg(*columns).first()
    parts = [(n, name, spread[name]["mean"], 1 / spread[name]["std"] if spread[name]["std"] else 0.0) for n, name in enumerate(names)]
    inputs = spark.createDataFrame(parts, INPUTS_DDL)
    means = rows.groupBy(by).agg(*[F.avg(n).alias(n) for n in names]).orderBy(by).collect()
    centres = [
        (s, n, (row[name] - mean) * scale) for s, row in enumerate(means) for n, name, mean, scale in parts
    ]
    return inputs, spark.createDataFrame(centres, CENTRES_DDL)
