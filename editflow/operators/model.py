"""Model operators: assemble features, PCA (k=3), random forest; fit, save, load, score, vote.

Training and scoring are Spark ML (distributed fit, JVM-side transform). Scoring is a narrow
per-row projection, so it works unchanged on a streaming DataFrame.

Spark ML's forest adds up per-tree class probabilities, while a classic forest model combines
trees by **majority vote**. ``vote`` reproduces the vote exactly with a copy of the saved forest whose
nodes carry the unit vector of their class as statistics (``operators.forests``): Spark ML's own sum
is then the number of votes. ``voter`` computes the same from the leaves that a row reaches
(``leafCol``) and a lookup table leaf -> class, by whole arrays in Python tasks; it needs no second copy
of the model and serves as a check.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.operators.forests import voting_copy
from editflow.schemas import FEATURES, LABEL
from editflow.session import scratch_path

# --- Fixed values: the shape of the source system's model --------------------------------
PCA_K = 3
NUM_TREES = 500
FEATURES_COL, PCA_COL = "features", "pcaFeatures"
# A fit keeps every row with a count of its draws for each tree: at most this many bytes a task.
FIT_TASK_BYTES = 128 << 20
VOTE_ROWS = 1024  # rows whose leaves are looked up together
# ------------------------------------------------------------------------------------------
LEAF_COL = "leaf"


def with_label(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Training label as a double column ``label``."""
    return df.withColumn("label", F.col(label).cast("double"))


def assembler(inputs: list[str] | None = None) -> VectorAssembler:
    """Model inputs -> one vector; rows with NULLs were dropped before, so NULL is an error."""
    return VectorAssembler(inputCols=list(inputs or FEATURES), outputCol=FEATURES_COL, handleInvalid="error")


def build_pipeline(
    num_trees: int = NUM_TREES, k: int = PCA_K, max_depth: int = 5, seed: int = 42
) -> Pipeline:
    """Assembler -> PCA(k) -> random forest classifier on the PCA vector."""
    return Pipeline(
        stages=[
            assembler(),
            PCA(k=k, inputCol=FEATURES_COL, outputCol=PCA_COL),
            RandomForestClassifier(
                featuresCol=PCA_COL, labelCol="label", numTrees=num_trees, maxDepth=max_depth, seed=seed
            ),
        ]
    )


def fit_tasks(rows: int, num_trees: int, task_bytes: int = FIT_TASK_BYTES) -> int:
    """Tasks of a fit: a row takes four bytes for each tree and about a hundred of its own."""
    return max(1, -(-rows * (4 * num_trees + 100) // task_bytes))


def fit_rows(train: DataFrame, num_trees: int = NUM_TREES, task_bytes: int = FIT_TASK_BYTES, slots: int = 1) -> DataFrame:
    """The inputs and the label of all rows, stored once under the shared checkpoint folder (a fit
    reads its rows several times) and dealt evenly over as many tasks as their number asks for; if
    that is more than one, over a multiple of ``slots``, so that the last wave of tasks is full too.

    Each of several tasks sorts its rows, so a task that runs again draws the same for every row, in
    whatever order a shuffle delivers. Rows that fit one task stay in the order of their source.
    """
    spark = train.sparkSession
    columns = [*FEATURES, LABEL]
    path = scratch_path(spark, "fit-rows")
    train.select(*columns).write.parquet(path)
    rows = spark.read.schema(train.select(*columns).schema).parquet(path)
    tasks = fit_tasks(rows.count(), num_trees, task_bytes)
    tasks = -(-tasks // slots) * slots if tasks > 1 else 1
    return rows.repartition(tasks).sortWithinPartitions(*columns) if tasks > 1 else rows.coalesce(1)


def fit(train: DataFrame, num_trees: int = NUM_TREES, k: int = PCA_K, max_depth: int = 5, seed: int = 42) -> PipelineModel:
    """Fit the pipeline on model rows (features + ``isBotEdit``).

    The dealt rows are kept while the stages read them (nine numbers a row): each of five reads would
    deal and sort them again.
    """
    slots = train.sparkSession.sparkContext.defaultParallelism
    rows = with_label(fit_rows(train, num_trees, slots=slots)).persist()
    try:
        return build_pipeline(num_trees, k, max_depth, seed).fit(rows)
    finally:
        rows.unpersist()


def spread(df: DataFrame) -> DataFrame:
    """The same rows dealt evenly over twice as many tasks as the cluster runs at once: hundreds of
    trees a row cost far more than moving it, and a small file has few splits."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def forest(model: PipelineModel) -> RandomForestClassificationModel:
    return model.stages[-1]


def pca_projection(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with the PCA vector (x . PC, the mean is not subtracted)."""
    projected = model.stages[1].transform(model.stages[0].transform(df))
    return projected.withColumn("_pc", vector_to_array(F.col(PCA_COL)))


def score(model: PipelineModel, df: DataFrame, prediction: str = "predicted") -> DataFrame:
    """Spark ML prediction (summed tree probabilities) as an integer column."""
    out = model.transform(df)
    return out.withColumn(prediction, F.col("prediction").cast("int")).drop(
        FEATURES_COL, PCA_COL, "rawPrediction", "probability", "prediction"
    )


def _stage_path(model_path: str, model: PipelineModel) -> str:
    """Folder of the forest stage inside a saved pipeline: ``stages/<index>_<uid>`` with the
    index zero-padded to the number of digits of the stage count."""
    n = len(model.stages)
    idx = n - 1
    return f"{model_path.rstrip('/')}/stages/{idx:0{len(str(n))}d}_{model.stages[idx].uid}"


def leaf_classes(spark: SparkSession, model_path: str, model: PipelineModel) -> list[list[int]]:
    """Per tree, the class of each leaf in pre-order (the order of ``leafCol`` indices).

    Read from the saved forest: nodes are stored with pre-order ids, leaves have no children.
    The result has trees x leaves entries (bounded by the model size).
    """
    nodes = spark.read.parquet(f"{_stage_path(model_path, model)}/data")
    leaves = (
        nodes.where(F.col("nodeData.leftChild") < 0)
        .groupBy("treeID")
        .agg(F.sort_array(F.collect_list(F.struct("nodeData.id", "nodeData.prediction"))).alias("leaves"))
        .orderBy("treeID")
        .collect()
    )
    return [[int(leaf["prediction"]) for leaf in row["leaves"]] for row in leaves]


def vote_column(leaf: Column, table: list[list[int]], num_classes: int = 2) -> Column:
    """Majority class over trees from the leaf-index vector; a tie goes to the lower class.

    The lookup takes whole arrays, some rows at a time: a higher-order function would be interpreted
    once for each row and tree.
    """
    first = np.cumsum([0, *map(len, table)][:-1])
    flat = np.array([c for classes in table for c in classes], dtype=np.int16)

    @F.arrow_udf("int")
    def majority(leaves: pa.Array) -> pa.Array:
        at = leaves.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(first))
        found = []
        for k in range(0, len(at), VOTE_ROWS):
            classes = flat[at[k:k + VOTE_ROWS] + first]
            found.append(np.stack([(classes == c).sum(axis=1) for c in range(num_classes)]).argmax(axis=0))
        return pa.array(np.concatenate(found) if found else [], pa.int32())

    return majority(vector_to_array(leaf).cast("array<int>"))


def voter(model: PipelineModel, table: list[list[int]], prediction: str = "predicted"):
    """A reusable ``DataFrame -> DataFrame`` that adds the majority-vote ``prediction``.

    The forest copy and the vote expression (with its lookup literal) are built once, so a
    streaming job pays for them once rather than in every micro-batch.
    """
    rf = forest(model).copy()
    rf.setLeafCol(LEAF_COL)
    expr = vote_column(F.col(LEAF_COL), table, rf.numClasses)
    assemble, pca = model.stages[0], model.stages[1]

    def apply(df: DataFrame) -> DataFrame:
        with_leaves = rf.transform(pca.transform(assemble.transform(df)))
        return with_leaves.withColumn(prediction, expr).drop(
            FEATURES_COL, PCA_COL, LEAF_COL, "rawPrediction", "probability", "prediction"
        )

    return apply


def forest_voter(model: PipelineModel, voting: RandomForestClassificationModel, prediction: str = "predicted"):
    """A ``DataFrame -> DataFrame`` that adds the majority class of a voting forest (``operators.forests``)
    on top of the pipeline's assembler and PCA."""
    rf = voting.copy()
    rf.setFeaturesCol(PCA_COL)
    rf.setPredictionCol("prediction")
    assemble, pca = model.stages[0], model.stages[1]

    def apply(df: DataFrame) -> DataFrame:
        voted = rf.transform(pca.transform(assemble.transform(df)))
        return voted.withColumn(prediction, F.col("prediction").cast("int")).drop(FEATURES_COL, PCA_COL, "prediction")

    return apply


def saved_voter(spark: SparkSession, model: PipelineModel, model_path: str, prediction: str = "predicted"):
    """The voter of a saved pipeline: its forest is copied into the voting form once."""
    return forest_voter(model, voting_copy(spark, _stage_path(model_path, model)), prediction)


def vote(model: PipelineModel, model_path: str, df: DataFrame, prediction: str = "predicted") -> DataFrame:
    """Majority-vote prediction of the forest (equal tree weights)."""
    return saved_voter(df.sparkSession, model, model_path, prediction)(df)
