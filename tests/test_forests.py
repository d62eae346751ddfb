"""Voting copies of forests and the older saved layout."""

import json

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from editflow.operators import forests
from editflow.sources import store


def _rows(spark):
    return spark.range(600).selectExpr(
        "cast((id * 7 % 11 + id % 5) % 3 = 0 as double) as label",
        "array(cast(id % 7 as double), cast(id * 13 % 101 as double), cast(id % 4 as double)) as a")


def _saved_by_old_api(spark, path, categorical):
    from pyspark.mllib.regression import LabeledPoint
    from pyspark.mllib.tree import RandomForest

    points = _rows(spark).rdd.map(lambda r: LabeledPoint(r.label, r.a))
    model = RandomForest.trainClassifier(points, 2, categorical, 9, seed=3, maxDepth=5)
    model.save(spark.sparkContext, path)
    return model


@pytest.mark.parametrize("categorical", [{}, {2: 4, 0: 7}])
def test_forest_of_the_older_api_votes_equally(spark, scratch, categorical):
    path = scratch("old")
    old = _saved_by_old_api(spark, path, categorical)
    assert forests.is_old_layout(spark, path)
    new = forests.read_old(spark, path, num_features=3, features_col="v")
    rows = _rows(spark).collect()
    want = old.predict(spark.sparkContext.parallelize([list(r.a) for r in rows], 2)).collect()
    got = new.transform(_rows(spark).select(array_to_vector("a").alias("v"), "a")).collect()
    assert len(new.trees) == 9 and [r.prediction for r in got] == want and len(set(want)) == 2


def test_other_models_are_refused(spark, scratch):
    path = scratch("old")
    for metadata in ({"class": "x", "version": "1.0"},
                     {"class": forests.OLD_CLASS, "version": "1.0", "metadata": {
                         "algo": "Regression", "combiningStrategy": "Average", "treeWeights": [1.0]}}):
        store.put(spark, f"{path}/metadata/part-00000", json.dumps(metadata))
        with pytest.raises(ValueError):
            forests.read_old(spark, path)


def test_vote_ties_go_to_the_lower_class(spark, scratch):
    """Two trees of one leaf each that disagree."""
    path = scratch("old")
    nodes = [(t, 1, (float(t), 1.0), 0.0, True, None, None, None, None) for t in (0, 1)]
    spark.createDataFrame(nodes, "treeId int, nodeId int, predict struct<predict:double,prob:double>, impurity double, "
                          "isLeaf boolean, split struct<feature:int,threshold:double,featureType:int,categories:array<double>>, "
                          "leftNodeId int, rightNodeId int, infoGain double").write.parquet(f"{path}/data")
    store.put(spark, f"{path}/metadata/part-00000", json.dumps({"class": forests.OLD_CLASS, "version": "1.0", "metadata": {
        "algo": "Classification", "combiningStrategy": "Vote", "treeWeights": [1.0, 1.0]}}))
    model = forests.read_old(spark, path, num_features=1, features_col="v")
    out = model.transform(spark.range(3).select(array_to_vector(F.array(F.col("id").cast("double"))).alias("v")))
    assert {r.prediction for r in out.collect()} == {0.0}
