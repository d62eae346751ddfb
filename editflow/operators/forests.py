"""Forest layouts: a voting form of a saved forest, and the older per-node layout of saved forests.

Spark ML adds up each tree's class shares. If every node's statistics are the unit vector of its class,
that sum is the number of votes, so a majority-voting forest is Spark ML's own model with other
statistics: no lookup, one function call a row, and the same code path in batch and on a stream. A tie goes
to the lower class.

The older layout (``metadata`` with ``combiningStrategy: Vote`` and one row for each node, numbered 1,
2i, 2i + 1) is read into the same form, so a forest that was saved years ago votes as it did.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editflow.session import scratch_path
from editflow.sources import store

# --- Fixed values: marks of the older layout -----------------------------------------------
OLD_CLASS = "org.apache.spark.mllib.tree.model.RandomForestModel"
OLD_VERSION = "1.0"
OLD_CONTINUOUS, OLD_CATEGORICAL = 0, 1
# --------------------------------------------------------------------------------------------


def one_hot(prediction: Column, classes: int) -> Column:
    """Statistics of a node that gives its whole weight to its class."""
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda k: (k == prediction).cast("double"))


def _text(spark: SparkSession, folder: str) -> str:
    """The one line of a metadata folder."""
    part = next(n for n in store.names(spark, folder) if n.startswith("part-"))
    return store.text(spark, f"{folder}/{part}").strip()


def _write_metadata(spark: SparkSession, folder: str, metadata: dict) -> None:
    store.put(spark, f"{folder}/part-00000", json.dumps(metadata) + "\n")


def _silent(path: str) -> RandomForestClassificationModel:
    """The saved model, giving only its prediction: one function call a row instead of three."""
    return RandomForestClassificationModel.load(path).setRawPredictionCol("").setProbabilityCol("")


def voting_copy(spark: SparkSession, forest_path: str, path: str | None = None) -> RandomForestClassificationModel:
    """The majority-voting form of a forest in Spark ML's layout, written to ``path`` and loaded.

    Every task reads its own copy of the model, so nodes that no vote depends on are left out first.
    """
    path = path or scratch_path(spark, "voting-forest")
    metadata = json.loads(_text(spark, f"{forest_path}/metadata"))
    nodes = spark.read.parquet(f"{forest_path}/data").select("treeID", "nodeData.*")
    _old_nodes(pruned(_heap_nodes(nodes)), int(metadata["numClasses"])).write.mode("overwrite").parquet(f"{path}/data")
    spark.read.parquet(f"{forest_path}/treesMetadata").write.mode("overwrite").parquet(f"{path}/treesMetadata")
    _write_metadata(spark, f"{path}/metadata", metadata)
    return _silent(path)


def _template(spark: SparkSession) -> tuple[dict, dict, list[str]]:
    """(forest metadata, tree metadata, column names) as this Spark version writes them, from a forest of
    one tree over two rows; only their form is used."""
    two = spark.createDataFrame([(0.0, [0.0]), (1.0, [1.0])], "label double, a array<double>")
    model = RandomForestClassifier(numTrees=1, maxDepth=1, seed=1, featuresCol="v").fit(two.select("label", array_to_vector("a").alias("v")))
    path = scratch_path(spark, "forest-template")
    model.save(path)
    trees = spark.read.parquet(f"{path}/treesMetadata")
    tree = json.loads(trees.first()[1])
    forest = json.loads(_text(spark, f"{path}/metadata"))
    store.remove(spark, path)
    return forest, tree, trees.columns


def is_old_layout(spark: SparkSession, path: str) -> bool:
    return json.loads(_text(spark, f"{path}/metadata")).get("class") == OLD_CLASS


def _old_nodes(old: DataFrame, classes: int) -> DataFrame:
    """Nodes numbered 1, 2i, 2i + 1 -> pre-order numbers and Spark ML's node record.

    A node's number in binary, without its first digit, is its path from the root; sorting paths as text
    is pre-order, since a parent's path is a prefix of its children's.
    """
    path = F.substring(F.bin(F.col("nodeId").cast("long")), F.lit(2), F.lit(64))
    order = Window.partitionBy("treeId").orderBy(path)  # a tree's nodes: bounded by the model's depth
    placed = old.select("*", (F.row_number().over(order) - 1).alias("id"))
    child = placed.select("treeId", F.col("nodeId").alias("child"), F.col("id").alias("at"))
    left = child.withColumnsRenamed({"child": "leftNodeId", "at": "left"})
    right = child.withColumnsRenamed({"child": "rightNodeId", "at": "right"})
    joined = placed.join(left, ["treeId", "leftNodeId"], "left").join(right, ["treeId", "rightNodeId"], "left")
    inner = ~F.col("isLeaf")
    categorical = F.col("split.featureType") == OLD_CATEGORICAL
    cats = F.col("split.categories")
    # Categories that the split does not name go right, whatever their number: Spark ML does so while
    # the named ones are at most half of all.
    arity = F.greatest(2 * F.size(cats), F.array_max(cats).cast("int") + 1)
    split = F.struct(
        F.when(inner, F.col("split.feature")).otherwise(-1).alias("featureIndex"),
        F.when(inner & categorical, cats).when(inner, F.array("split.threshold"))
        .otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
        F.when(inner & categorical, arity).otherwise(-1).alias("numCategories"))
    record = F.struct(
        "id", F.col("predict.predict").alias("prediction"), "impurity", one_hot(F.col("predict.predict"), classes).alias("impurityStats"),
        F.lit(-1).cast("long").alias("rawCount"), F.when(inner, F.col("infoGain")).otherwise(-1.0).alias("gain"),
        F.coalesce("left", F.lit(-1)).alias("leftChild"), F.coalesce("right", F.lit(-1)).alias("rightChild"), split.alias("split"))
    return joined.select(F.col("treeId").cast("int").alias("treeID"), record.alias("nodeData"))


def read_old(spark: SparkSession, old_path: str, num_features: int | None = None, features_col: str = "pcaFeatures",
             path: str | None = None) -> RandomForestClassificationModel:
    """A forest saved in the older layout as a majority-voting Spark ML forest (written to ``path``).

    Classification forests combined by vote with equal tree weights are read; anything else raises.
    """
    saved = json.loads(_text(spark, f"{old_path}/metadata"))
    about = saved.get("metadata", {})
    if saved.get("class") != OLD_CLASS or saved.get("version") != OLD_VERSION:
        raise ValueError(f"{old_path} holds {saved.get('class')} {saved.get('version')}, not a forest of the older layout")
    if about.get("algo") != "Classification" or about.get("combiningStrategy") != "Vote" or len(set(about["treeWeights"])) > 1:
        raise ValueError("only classification forests of equal trees that vote are read")
    path = path or scratch_path(spark, "old-forest")
    old = spark.read.parquet(f"{old_path}/data")
    top, feature, trees = old.agg(F.max("predict.predict"), F.max("split.feature"), F.count_distinct("treeId")).first()
    if trees != len(about["treeWeights"]):
        raise ValueError(f"{trees} trees in the data, {len(about['treeWeights'])} weights in the metadata")
    classes = max(2, int(top) + 1)
    _old_nodes(pruned(old), classes).write.mode("overwrite").parquet(f"{path}/data")
    forest, tree, columns = _template(spark)
    rows = [(t, json.dumps(tree | {"uid": f"{tree['uid']}_{t}"}), 1.0) for t in range(trees)]
    names = ", ".join(f"`{c}` {k}" for c, k in zip(columns, ("int", "string", "double"), strict=True))
    spark.createDataFrame(rows, names).coalesce(1).write.mode("overwrite").parquet(f"{path}/treesMetadata")
    forest["paramMap"] |= {"numTrees": trees, "featuresCol": features_col}
    _write_metadata(spark, f"{path}/metadata", forest | {
        "numFeatures": num_features or (feature or 0) + 1, "numClasses": classes, "numTrees": trees})
    return _silent(path)


def _heap_nodes(nodes: DataFrame) -> DataFrame:
    """Spark ML's node records (treeID and the record's fields) in the older layout's columns.

    Node numbers come down from the root, one round a level (the depth is a bound of the model). Numbers
    are 32 bits wide there, which holds thirty levels.
    """
    level = nodes.where("id = 0").withColumn("nodeId", F.lit(1))
    numbered, depth = level, 0
    while not level.isEmpty():
        depth += 1
        if depth > 31:
            raise ValueError("the older layout numbers at most thirty levels")
        down = level.where("leftChild >= 0").select("treeID", F.explode(F.array(
            F.struct(F.col("leftChild").alias("id"), (2 * F.col("nodeId")).alias("nodeId")),
            F.struct(F.col("rightChild").alias("id"), (2 * F.col("nodeId") + 1).alias("nodeId")))).alias("c")).select("treeID", "c.*")
        level = nodes.join(down, ["treeID", "id"])
        numbered = numbered.unionByName(level)
    inner = F.col("leftChild") >= 0
    categorical = F.col("split.numCategories") >= 0
    split = F.struct(
        F.col("split.featureIndex").alias("feature"),
        F.when(categorical, F.lit(0.0)).otherwise(F.element_at("split.leftCategoriesOrThreshold", 1)).alias("threshold"),
        F.when(categorical, OLD_CATEGORICAL).otherwise(OLD_CONTINUOUS).alias("featureType"),
        F.when(categorical, F.col("split.leftCategoriesOrThreshold")).otherwise(F.array().cast("array<double>")).alias("categories"))
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    share = F.try_divide(F.element_at("impurityStats", F.col("prediction").cast("int") + 1), total)
    return numbered.select(
        F.col("treeID").alias("treeId"), "nodeId",
        F.struct(F.col("prediction").alias("predict"), F.coalesce(share, F.lit(1.0)).alias("prob")).alias("predict"),
        "impurity", (~inner).alias("isLeaf"), F.when(inner, split).alias("split"), F.when(inner, 2 * F.col("nodeId")).alias("leftNodeId"),
        F.when(inner, 2 * F.col("nodeId") + 1).alias("rightNodeId"), F.when(inner, F.col("gain")).alias("infoGain"))


def pruned(old: DataFrame) -> DataFrame:
    """The same votes from fewer nodes: a subtree whose leaves all have one class becomes a leaf.

    Every leaf counts for each of its ancestors (halving its number leads up); nodes below a uniform one go.
    """
    up = F.explode(F.sequence(F.lit(0), F.floor(F.log2("nodeId")).cast("int"))).alias("k")
    above = old.where("isLeaf").select("treeId", "nodeId", F.col("predict.predict").alias("class"), up)
    uniform = above.groupBy("treeId", F.expr("shiftright(nodeId, k)").alias("nodeId")).agg(
        F.min("class").alias("low"), (F.min("class") == F.max("class")).alias("uniform"))
    parents = uniform.where("not uniform").select("treeId", F.col("nodeId").alias("parent"))
    kept = old.join(uniform, ["treeId", "nodeId"]).withColumn("parent", F.expr("shiftright(nodeId, 1)")).join(
        parents.withColumn("open", F.lit(True)), ["treeId", "parent"], "left").where("nodeId = 1 or open")
    inner = ~F.col("uniform")
    return kept.select(
        "treeId", "nodeId", F.struct(F.when(inner, F.col("predict.predict")).otherwise(F.col("low")).alias("predict"),
                                     F.col("predict.prob").alias("prob")).alias("predict"),
        "impurity", F.col("uniform").alias("isLeaf"),
        *(F.when(inner, F.col(c)).alias(c) for c in ("split", "leftNodeId", "rightNodeId", "infoGain")))


def write_old(spark: SparkSession, forest_path: str, old_path: str) -> str:
    """A saved Spark ML forest in the older layout: the way back, for readers that know only that one."""
    nodes = spark.read.parquet(f"{forest_path}/data").select("treeID", "nodeData.*")
    _heap_nodes(nodes).write.mode("overwrite").parquet(f"{old_path}/data")
    trees = nodes.agg(F.count_distinct("treeID")).first()[0]
    _write_metadata(spark, f"{old_path}/metadata", {"class": OLD_CLASS, "version": OLD_VERSION, "metadata": {
        "algo": "Classification", "treeAlgo": "Classification", "combiningStrategy": "Vote", "treeWeights": [1.0] * trees}})
    return old_path
