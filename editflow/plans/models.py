"""Registered model queries: fit, PCA, assemble, score, vote, and streaming scoring.

Training rows are the enriched edits before the cutoff (the history period); scoring runs
over every edit. The label is ``isBotEdit``, as in the source pipeline.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editflow.operators import model as M
from editflow.operators.features import feature_columns
from editflow.plans import sql as S
from editflow.plans.catalog import enriched, history, register
from editflow.plans.streams import _event_id, _raw_stream
from editflow.schemas import FEATURES
from editflow.session import scratch_path
from editflow.streaming import pipeline as P

TRAIN_CUTOFF = "2024-01-15 00:00:00"

_FITTED: dict[tuple[str, str, int], tuple] = {}


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir)


def scoring_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model rows spread evenly over the cluster, for the forest."""
    return M.spread(model_rows(spark, sf_dir))


def training_rows(spark: SparkSession, sf_dir: str, before: str = TRAIN_CUTOFF) -> DataFrame:
    """Model rows of the training period: events before ``before`` are the labelled rows to fit on."""
    from editflow.sources.tables import read_table

    early = read_table(spark, sf_dir, "events").where(
        F.col("ts") < F.to_timestamp_ntz(F.lit(before))
    ).select("event_id")
    return model_rows(spark, sf_dir).join(early, "event_id", "left_semi")


def fitted(spark: SparkSession, sf_dir: str, num_trees: int = M.NUM_TREES):
    """Fit and save the pipeline; returns (model, path). Fitted once per application and table."""
    key = (spark.sparkContext.applicationId, sf_dir, num_trees)
    if key not in _FITTED:
        model = M.fit(training_rows(spark, sf_dir), num_trees=num_trees)
        _FITTED[key] = (model, M.save(model, scratch_path(spark, "model")))
    return _FITTED[key]


SCORED = ["user", *FEATURES, "isBotEdit", "predicted"]


@register(
    "ml_assemble",
    S.parsed_query(
        "SELECT event_id, " + ", ".join(f'CAST("{c}" AS DOUBLE) AS "v_{c}"' for c in FEATURES) + " FROM enr",
        S.FEATURES, S.HISTORY, S.ENRICHED,
    ),
)
def q_ml_assemble(spark, sf_dir):
    """The eight model inputs assembled into one vector (checked element by element)."""
    rows = model_rows(spark, sf_dir)
    vec = M.assembler(feature_columns(rows)).transform(rows)
    arr = vector_to_array(F.col(M.FEATURES_COL))
    return vec.select("event_id", *[arr.getItem(i).alias(f"v_{c}") for i, c in enumerate(FEATURES)])


@register("ml_pca")
def q_ml_pca(spark, sf_dir):
    """Fitted PCA (k=3) applied to every model row: x . PC, no centring."""
    model, _ = fitted(spark, sf_dir)
    pc = M.pca_projection(model, model_rows(spark, sf_dir))
    return pc.select("event_id", *[F.col("_pc").getItem(i).alias(f"pc{i + 1}") for i in range(M.PCA_K)])


@register("ml_fit_summary")
def q_ml_fit_summary(spark, sf_dir):
    """Fit on the history period; one row: trees, PCA k, features, training rows, training error."""
    model, _ = fitted(spark, sf_dir)
    scored = M.score(model, M.spread(training_rows(spark, sf_dir)))
    return scored.agg(
        F.lit(len(M.forest(model).trees)).alias("num_trees"),
        F.lit(M.PCA_K).alias("pca_k"),
        F.lit(len(FEATURES)).alias("num_features"),
        F.count(F.lit(1)).alias("train_rows"),
        F.round(F.avg((F.col("predicted") != F.col("isBotEdit")).cast("double")), 6).alias("train_error"),
    )


@register("ml_score")
def q_ml_score(spark, sf_dir):
    """Scored rows (Spark ML forest: summed tree probabilities)."""
    model, _ = fitted(spark, sf_dir)
    return M.score(model, scoring_rows(spark, sf_dir)).select("event_id", *SCORED)


@register("ml_vote")
def q_ml_vote(spark, sf_dir):
    """Scored rows with the forest combined by majority vote."""
    model, path = fitted(spark, sf_dir)
    return M.vote(model, path, scoring_rows(spark, sf_dir)).select("event_id", *SCORED)


@register("stream_score")
def q_stream_score(spark, sf_dir):
    """Streaming scorer: per micro-batch raw table, majority-vote scored table and metrics."""
    model, path = fitted(spark, sf_dir)
    scorer = M.saved_voter(spark, model, path)

    base = scratch_path(spark, "stream-score")
    paths = {k: f"{base}/{k}" for k in ("raw", "scored", "metrics")}
    query = P.start_scoring(
        _raw_stream(spark, sf_dir), history(spark, sf_dir), scorer, paths,
        scratch_path(spark, "ckpt"), P.AVAILABLE_NOW, spread=2 * spark.sparkContext.defaultParallelism,
    )
    P.run_to_end(query)
    return spark.read.parquet(paths["scored"]).select(_event_id(), *SCORED)


_ROWS_SQL = S.parsed_query(
    "SELECT event_id, " + ", ".join(f'"{c}"' for c in ["user", *FEATURES, "isBotEdit"]) + ", true AS is_class FROM enr",
    S.FEATURES, S.HISTORY, S.ENRICHED,
)
_NO_MISMATCH = S.parsed_query('SELECT count(*) AS "rows", CAST(0 AS BIGINT) AS mismatches FROM enr', S.FEATURES, S.HISTORY, S.ENRICHED)


def _checked(scored: DataFrame) -> DataFrame:
    return scored.select("event_id", "user", *FEATURES, "isBotEdit", F.col("predicted").isin(0, 1).alias("is_class"))


def _mismatches(wrong) -> list:
    return [F.count(F.lit(1)).alias("rows"), F.count_if(~F.coalesce(wrong, F.lit(False))).alias("mismatches")]


@register("ml_score_rows", _ROWS_SQL)
def q_ml_score_rows(spark, sf_dir):
    """Every model row is scored, with its inputs and label unchanged and a class as prediction."""
    model, _ = fitted(spark, sf_dir)
    return _checked(M.score(model, scoring_rows(spark, sf_dir)))


@register("ml_vote_rows", _ROWS_SQL)
def q_ml_vote_rows(spark, sf_dir):
    model, path = fitted(spark, sf_dir)
    return _checked(M.vote(model, path, scoring_rows(spark, sf_dir)))


@register("ml_saved_score", _NO_MISMATCH)
def q_ml_saved_score(spark, sf_dir):
    """Scores of the model loaded from its folder against those of the model in memory."""
    model, path = fitted(spark, sf_dir)
    rows = scoring_rows(spark, sf_dir)
    here = M.score(model, rows).select("event_id", F.col("predicted").alias("here"))
    loaded = M.score(M.load(path), rows).select("event_id", "predicted")
    return here.join(loaded, "event_id", "full").agg(*_mismatches(F.col("here") == F.col("predicted")))


@register("ml_pca_mismatch", _NO_MISMATCH)
def q_ml_pca_mismatch(spark, sf_dir):
    """The PCA stage against the plain product of the inputs with the fitted 8 x 3 matrix."""
    model, _ = fitted(spark, sf_dir)
    pc = model.stages[1].pc.toArray()
    rows = M.pca_projection(model, model_rows(spark, sf_dir))
    same = F.lit(True)
    for k in range(M.PCA_K):
        product = sum((F.col(c) * float(pc[i, k]) for i, c in enumerate(FEATURES)), F.lit(0.0))
        same = same & (F.abs(F.col("_pc").getItem(k) - product) <= 1e-6 * (1 + F.abs(product)))
    return rows.agg(*_mismatches(same))


@register("ml_vote_mismatch", _NO_MISMATCH)
def q_ml_vote_mismatch(spark, sf_dir):
    """The vote against a majority counted from the saved trees, joined row by tree and leaf."""
    model, path = fitted(spark, sf_dir)
    rows = scoring_rows(spark, sf_dir)
    table = M.leaf_classes(spark, path, model)
    leaves = spark.createDataFrame(
        [(t, i, c) for t, classes in enumerate(table) for i, c in enumerate(classes)], "tree int, leaf int, class int")
    rf = M.forest(model).copy()
    rf.setLeafCol(M.LEAF_COL)
    at = rf.transform(model.stages[1].transform(model.stages[0].transform(rows)))
    each = at.select("event_id", F.posexplode(vector_to_array(F.col(M.LEAF_COL))).alias("tree", "leaf")).select(
        "event_id", "tree", F.col("leaf").cast("int").alias("leaf"))
    # The table of leaves is bounded by the model; it has no size estimate of its own.
    counted = each.join(F.broadcast(leaves), ["tree", "leaf"]).groupBy("event_id").agg(
        F.when(2 * F.sum("class") > F.count("class"), 1).otherwise(0).alias("majority"))
    voted = M.vote(model, path, rows).select("event_id", "predicted")
    return voted.join(counted, "event_id", "full").agg(*_mismatches(F.col("predicted") == F.col("majority")))


@register("ml_score_mismatch", _NO_MISMATCH)
def q_ml_score_mismatch(spark, sf_dir):
    """Predictions against the trees' class shares summed from the saved nodes, joined by tree and leaf.
    Rows whose two sums are equal but for rounding may have either class."""
    model, path = fitted(spark, sf_dir)
    rows = scoring_rows(spark, sf_dir)
    nodes = spark.read.parquet(f"{M._stage_path(path, model)}/data").where("nodeData.leftChild < 0")
    share = F.col("nodeData.impurityStats")
    # A leaf's number is its place among its tree's leaves in pre-order.
    place = F.row_number().over(Window.partitionBy("treeID").orderBy("nodeData.id")) - 1
    leaves = nodes.select(F.col("treeID").alias("tree"), place.alias("leaf"),
                          (F.element_at(share, 2) / (F.element_at(share, 1) + F.element_at(share, 2))).alias("one"))
    rf = M.forest(model).copy()
    rf.setLeafCol(M.LEAF_COL)
    at = rf.transform(model.stages[1].transform(model.stages[0].transform(rows)))
    each = at.select("event_id", F.posexplode(vector_to_array(F.col(M.LEAF_COL))).alias("tree", "leaf")).select(
        "event_id", "tree", F.col("leaf").cast("int").alias("leaf"))
    # The table of leaves is bounded by the model.
    summed = each.join(F.broadcast(leaves), ["tree", "leaf"]).groupBy("event_id").agg(
        (F.sum("one") - F.count("one") / 2).alias("lead"))
    scored = M.score(model, rows).select("event_id", "predicted")
    right = (F.col("predicted") == (F.col("lead") > 0).cast("int")) | (F.abs("lead") < 1e-6)
    return scored.join(summed, "event_id", "full").agg(*_mismatches(right))


@register(
    "ml_fit_facts",
    S.parsed_query(
        f"""SELECT {M.NUM_TREES} AS num_trees, {M.PCA_K} AS pca_k, {len(FEATURES)} AS num_features, 2 AS classes,
              count(*) AS train_rows, count_if(l = 1) AS positives, count_if(l = 0) AS negatives
            FROM (SELECT "isBotEdit" AS l FROM enr JOIN events USING (event_id) WHERE ts < TIMESTAMP '{TRAIN_CUTOFF}')""",
        S.FEATURES, S.HISTORY, S.ENRICHED,
    ),
)
def q_ml_fit_facts(spark, sf_dir):
    """What the fit saw and made: its labelled rows by class, and the shape of the saved and loaded model."""
    _, path = fitted(spark, sf_dir)
    model = M.load(path)
    rows = M.with_label(training_rows(spark, sf_dir))
    return rows.agg(
        F.lit(len(M.forest(model).trees)).alias("num_trees"), F.lit(model.stages[1].pc.numCols).alias("pca_k"),
        F.lit(model.stages[1].pc.numRows).alias("num_features"), F.lit(M.forest(model).numClasses).alias("classes"),
        F.count(F.lit(1)).alias("train_rows"), F.count_if(F.col("label") == 1.0).alias("positives"),
        F.count_if(F.col("label") == 0.0).alias("negatives"))


@register("ml_vote_lookup_mismatch", _NO_MISMATCH)
def q_ml_vote_lookup_mismatch(spark, sf_dir):
    """The voting copy of the forest against the vote looked up leaf by leaf."""
    model, path = fitted(spark, sf_dir)
    rows = M.vote(model, path, scoring_rows(spark, sf_dir)).withColumnRenamed("predicted", "voted")
    both = M.voter(model, M.leaf_classes(spark, path, model))(rows)
    return both.agg(*_mismatches(F.col("predicted") == F.col("voted")))


@register("ml_old_layout_mismatch", _NO_MISMATCH)
def q_ml_old_layout_mismatch(spark, sf_dir):
    """The forest written in the older per-node layout and read back, against the vote of the first one."""
    from editflow.operators import forests

    model, path = fitted(spark, sf_dir)
    old = forests.write_old(spark, M._stage_path(path, model), scratch_path(spark, "forest-old"))
    rows = M.vote(model, path, scoring_rows(spark, sf_dir)).withColumnRenamed("predicted", "voted")
    again = M.forest_voter(model, forests.read_old(spark, old, num_features=M.PCA_K))(rows)
    return again.agg(*_mismatches(F.col("predicted") == F.col("voted")))


@register("stream_score_mismatch", _NO_MISMATCH)
def q_stream_score_mismatch(spark, sf_dir):
    """The scored stream against the batch vote of the same saved model."""
    model, path = fitted(spark, sf_dir)
    voted = M.vote(model, path, scoring_rows(spark, sf_dir)).select("event_id", F.col("predicted").alias("batch"))
    streamed = q_stream_score(spark, sf_dir).select("event_id", "predicted")
    return streamed.join(voted, "event_id", "full").agg(*_mismatches(F.col("predicted") == F.col("batch")))
