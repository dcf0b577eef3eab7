"""The kept preprocessing, radix selection, trees with a minimum split size,
components from sums, report sinks."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortforge.operators import dataset as ds
from cohortforge.operators import selection as sel
from cohortforge.operators.preprocess import ModelSetPreprocessor, PreprocessModel
from cohortforge.plans import model_sets as ms
from cohortforge.session import scratch_path
from cohortforge.sources.io import read_report, write_report, write_table


def place(spark, name):
    import uuid
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def frame(spark, n=300):
    rows = [(i, int(i % 3 == 0), None if i % 7 == 0 else float(i % 13), None if i % 5 == 0 else i % 4, None if i % 4 == 0 else i % 8 < 3,
             0, None if i % 2 else 0, 2.5, None, None if i % 6 == 0 else "ab"[i % 2]) for i in range(n)]
    return spark.createDataFrame(rows, "hadm_id int, hcc_cd_135 int, ft_avg_x double, ft_k int, ft_b boolean, ft_zero int, "
                                 "ft_zero_or_null int, ft_const double, ft_avg_none double, note string")


def test_fit_matches_pandas(spark):
    df = frame(spark)
    p = df.toPandas()
    model = ModelSetPreprocessor().fit(df)
    c = {x.name: x for x in model.constants}
    x = p.ft_avg_x.fillna(p.ft_avg_x.mean())
    assert math.isclose(float(c["ft_avg_x"].fill), p.ft_avg_x.mean()) and math.isclose(c["ft_avg_x"].scale, x.std())
    k = p.ft_k.fillna(p.ft_k.mode().iloc[0])
    assert float(c["ft_k"].fill) == p.ft_k.mode().iloc[0]
    assert math.isclose(c["ft_k"].center, k.mean()) and math.isclose(c["ft_k"].scale, k.std())
    assert c["ft_zero"].all_zero and c["ft_zero_or_null"].all_zero and not c["ft_const"].all_zero
    assert c["ft_const"].scale == 0.0 and c["ft_avg_none"].fill is None and c["note"].fill in ("a", "b")
    scaled = model.transform(df).toPandas()
    assert list(scaled.columns) == ["hadm_id", "hcc_cd_135", "ft_avg_x", "ft_k", "ft_b", "ft_const", "ft_avg_none"]
    assert np.allclose(scaled.ft_k, (k - k.mean()) / k.std()) and scaled.ft_const.isna().all()
    filled = model.with_scaled(False).transform(df)
    assert dict(filled.dtypes)["ft_b"] == "boolean" and filled.where("ft_b IS NULL OR ft_k IS NULL OR note IS NULL").count() == 0
    assert model.getOrDefault("scaled") and "ft_zero" not in filled.columns


def test_fit_runs_two_passes(spark):
    """One job for the moments, one for the counts (three with a text column)."""
    df = frame(spark).drop("note")
    tracker, group = spark.sparkContext.statusTracker(), "fit-passes"
    spark.sparkContext.setJobGroup(group, group)
    seen = set(tracker.getJobIdsForGroup(group))
    ModelSetPreprocessor().fit(df)
    jobs = set(tracker.getJobIdsForGroup(group)) - seen
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 5  # an adaptive query runs a job per stage: 2 + 3


def test_model_survives_saving(spark):
    df, path = frame(spark), place(spark, "model")
    model = ModelSetPreprocessor(keyCol="hadm_id", meanHints=["avg"]).fit(df)
    model.write().overwrite().save(path)
    back = PreprocessModel.load(path)
    assert back.constants == model.constants and back.uid == model.uid and back.getOrDefault("meanHints") == ["avg"]
    assert back.transform(df).collect() == model.transform(df).collect()
    est = ModelSetPreprocessor(marker="ft_")
    est.write().overwrite().save(path)
    assert ModelSetPreprocessor.load(path).getOrDefault("marker") == "ft_"


def test_empty_frame(spark):
    df = frame(spark).limit(0)
    model = ModelSetPreprocessor().fit(df)
    assert model.transform(df).count() == 0 and not any(c.all_zero for c in model.constants)


@pytest.mark.parametrize("fit_on", ["self", "train"])
def test_model_sets_are_kept(spark, fit_on):
    df = frame(spark).withColumn("ft_admit_type_newborn", F.when(F.col("hadm_id") % 10 == 3, 1).when(F.col("hadm_id") % 10 != 4, 0))
    folder = place(spark, "sets")
    reports = ms.write_model_sets(df, folder, fit_on=fit_on)
    assert reports["data"]["rows"] == 240 and reports["undersampled"]["positives"] == reports["undersampled"]["negatives"]
    assert {r["report"] for r in read_report(spark, f"{folder}/report").collect()} == set(reports)
    for split in ms.SPLITS:
        for scaled in (True, False):
            kept = ms.read_model_set(spark, folder, split, scaled)
            anew = ms.apply_saved(spark, folder, split, scaled)
            assert kept.columns == anew.columns and sorted(kept.collect(), key=str) == sorted(anew.collect(), key=str)
    models = [PreprocessModel.load(f"{folder}/models/{s}").constants for s in ms.SPLITS]
    assert (models[0] == models[1]) == (fit_on == "train")


def md5(i, seed="42"):
    return hashlib.md5(f"{seed}{i}".encode()).hexdigest()


@pytest.mark.parametrize("digits, small", [(1, 3), (1, 100_000), (2, 1), (4, 4096)])
def test_radix_selection_is_exact(spark, digits, small):
    df = spark.range(3000).withColumnRenamed("id", "hadm_id")
    order = sorted(range(3000), key=md5)
    for n in (1, 2, 17, 1500, 2999):
        got = {r[0] for r in ds.hash_take(df, n, prefix_digits=digits, small=small).collect()}
        assert got == set(order[:n])
    assert ds.hash_take(df, 3000).count() == ds.hash_take(df, 5000).count() == 3000 and ds.hash_take(df, 0).count() == 0
    plan = ds.hash_take(df, 17, prefix_digits=1, small=3)._jdf.queryExecution().toString()
    assert "Sort" not in plan and "Limit" not in plan


def test_radix_selection_with_repeated_keys(spark):
    df = spark.createDataFrame([(i % 7,) for i in range(700)], "hadm_id int")
    order = sorted(range(7), key=md5)
    for n in (1, 99, 100, 101, 250, 699):
        got = [r[0] for r in ds.hash_take(df, n, small=10).collect()]
        assert len(got) == n and [got.count(k) for k in order] == [min(100, max(0, n - 100 * at)) for at in range(7)]


def labelled(spark, n=2000):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(size=n) > 0.4).astype(int)
    return spark.createDataFrame([(i, int(b), *map(float, a)) for i, (a, b) in enumerate(zip(x, y))],
                                 "hadm_id int, hcc_cd_135 int, ft_a double, ft_b double, ft_c double, ft_d double")


def test_minimum_split_size(spark):
    df, feats = labelled(spark), ["ft_a", "ft_b", "ft_c", "ft_d"]
    grown = sel.tree_fit(df, feats, min_leaf=5)
    cut = sel.tree_fit(df, feats, min_leaf=5, min_split=200)
    nodes = {r["id"]: r for r in sel.tree_nodes(cut, spark).collect()}
    inner = [r for r in nodes.values() if r["leftChild"] >= 0]
    assert cut.numNodes == len(nodes) < grown.numNodes and min(r["rawCount"] for r in inner) >= 200
    assert sorted(nodes) == list(range(len(nodes)))
    for r in inner:  # children add up, as grown
        assert nodes[r["leftChild"]]["rawCount"] + nodes[r["rightChild"]]["rawCount"] == r["rawCount"]
    # the top of the tree is the grown one's: every inner node's split occurs there with the same count
    old = {(r["split"]["featureIndex"], tuple(r["split"]["leftCategoriesOrThreshold"]), r["rawCount"]) for r in sel.tree_nodes(grown, spark).collect()}
    assert all((r["split"]["featureIndex"], tuple(r["split"]["leftCategoriesOrThreshold"]), r["rawCount"]) in old for r in inner)
    weight = np.zeros(4)
    for r in inner:
        weight[r["split"]["featureIndex"]] += r["gain"] * r["rawCount"]
    assert np.allclose(cut.featureImportances.toArray(), weight / weight.sum())
    assert sel.tree_fit(df, feats, min_leaf=5, min_split=5000).numNodes == 1


def test_components_from_sums(spark):
    df, feats = labelled(spark), ["ft_a", "ft_b", "ft_c", "ft_d"]
    df = df.withColumn("ft_b", F.col("ft_a") * 2 + F.col("ft_b") + 100)
    x = np.array([r[2:] for r in df.collect()], dtype=float)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    pca = sel.pca_gram(df, feats, 2)
    assert np.allclose(pca.variances, values[::-1]) and math.isclose(sum(pca.ratios), 1.0)
    got = np.array([r[-2:] for r in pca.scores(df, ["pc_0", "pc_1"]).collect()])
    want = (x - x.mean(axis=0)) @ vectors[:, ::-1][:, :2]
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-8)
    sweep = sel.pca_variance_sweep(df, feats, ks=(2, 3)).collect()
    assert len(sweep) == 5 and math.isclose(sweep[0]["variance"], values[-1] / values.sum())


def test_report_sink(spark):
    df, folder = frame(spark), place(spark, "report")
    seen = write_table(df, f"{folder}/t", measure={"known": F.count("ft_avg_x"), "none": F.max("ft_avg_none")})
    assert seen == {"columns": 10, "rows": 300, "known": 257, "none": None}
    assert write_table(df.select("hadm_id", "ft_const"), f"{folder}/c", fmt="csv", measure={"low": F.min("ft_const")})["low"] == 2.5
    write_report(spark, f"{folder}/r", {"t": seen})
    assert {(r["metric"], r["value"]) for r in read_report(spark, f"{folder}/r").collect()} == {
        ("columns", 10.0), ("rows", 300.0), ("known", 257.0), ("none", None)}
