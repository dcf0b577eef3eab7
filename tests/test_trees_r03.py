"""Trees whose small nodes grow in one task each are the trees that MLlib grows."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from cohortforge.operators import selection as sel
from cohortforge.operators import trees


def rows_of(spark, n=600, seed=3):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n), rng.integers(0, 2, n), rng.integers(0, 9, n)
    y = ((a + b - 0.2 * c + rng.normal(scale=0.7, size=n)) > 0).astype(int)
    rows = [(i, float(a[i]), int(b[i]), float(c[i]), 0.0, int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "hadm_id long, a double, b int, c double, zero double, hcc_cd_135 int")


def mllib(df, features, min_leaf, min_split, spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    data = sel.assemble(df, features).select("features", F.col("hcc_cd_135").cast("double").alias("__y"))
    model = DecisionTreeClassifier(featuresCol="features", labelCol="__y", impurity="entropy", minInstancesPerNode=min_leaf, maxDepth=30,
                                   seed=42, maxBins=64).fit(data)
    return sel.collapse_small_nodes(model, min_split, spark)


def nodes(model, spark):
    return [(r["id"], r["prediction"], tuple(r["impurityStats"]), r["rawCount"], round(r["gain"], 12), r["leftChild"], r["rightChild"], tuple(r["split"][1]),
             r["split"]["featureIndex"]) for r in sel.tree_nodes(model, spark).orderBy("id").collect()]


@pytest.mark.parametrize("local, min_leaf, min_split", [(20_000, 1, 2), (60, 1, 2), (60, 5, 40), (60, 5, 200)])
def test_nodes_are_mllibs(spark, monkeypatch, local, min_leaf, min_split):
    monkeypatch.setattr(trees, "LOCAL_ROWS", local)
    features = ["a", "b", "c", "zero"]
    df = rows_of(spark)
    tree = sel.tree_fit(df, features, min_leaf=min_leaf, min_split=min_split)
    want = mllib(df, features, min_leaf, min_split, spark)
    assert nodes(tree, spark) == nodes(want, spark)
    assert np.allclose(tree.featureImportances.toArray(), want.featureImportances.toArray())
    assert (tree.numClasses, tree.numFeatures, tree.getOrDefault("minInstancesPerNode")) == (2, 4, min_leaf)


def test_only_large_nodes_are_counted_over_all_rows(spark, monkeypatch):
    """The counts sent for every task are those of nodes with many rows."""
    monkeypatch.setattr(trees, "LOCAL_ROWS", 100)
    seen, plain = [], trees.split_large
    monkeypatch.setattr(trees, "split_large", lambda rows, bins, held, large, leaf: seen.extend(held[i]["n"] for i in large) or plain(rows, bins, held, large, leaf))
    tree = sel.tree_fit(rows_of(spark), ["a", "b", "c"])
    assert seen and min(seen) > 100 and len(seen) < tree.numNodes / 5


def test_one_class_or_constant_features_give_one_leaf(spark):
    df = rows_of(spark, 40)
    assert sel.tree_fit(df.where("hcc_cd_135 = 0"), ["a", "b"]).numNodes == 1
    assert sel.tree_fit(df, ["zero"]).numNodes == 1
    with pytest.raises(ValueError):
        sel.tree_fit(df.where("false"), ["a"])
    with pytest.raises(Exception, match="must not be missing"):
        sel.tree_fit(df.withColumn("a", F.when(F.col("hadm_id") > 5, F.col("a"))), ["a", "b"])
