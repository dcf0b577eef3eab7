import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from cohortforge.operators import dataset as ds
from cohortforge.operators import selection as sel


def rows_df(spark, n=200):
    data = []
    for i in range(n):
        y = 1 if i % 4 == 0 else 0
        data.append((i, y, None if i % 7 == 0 else float(i % 13), float(i % 3), None if i % 5 == 0 else i % 2, 0))
    return spark.createDataFrame(data, "hadm_id int, hcc_cd_135 int, ft_avg_x double, ft_b double, ft_c int, ft_zero int")


def test_undersample_exact_and_deterministic(spark):
    df = rows_df(spark)
    out = ds.undersample(df, prefix_digits=1)
    pos = out.where("hcc_cd_135 = 1").count()
    neg = [r["hadm_id"] for r in out.where("hcc_cd_135 = 0").collect()]
    assert pos == 50 and len(neg) == 50
    order = sorted(range(200), key=lambda i: (hashlib.md5(f"42{i}".encode()).hexdigest(), i))
    expected = [i for i in order if i % 4 != 0][:50]
    assert sorted(neg) == sorted(expected)


def test_split_buckets_stable(spark):
    df = rows_df(spark)
    s = {r["hadm_id"]: r["split"] for r in ds.split_buckets(df).collect()}
    for i, v in s.items():
        b = int(hashlib.md5(f"42{i}".encode()).hexdigest()[:8], 16) % 10
        assert v == ("train" if b < 7 else "valid" if b in (7, 8) else "test")


def test_preprocess_chain(spark):
    df = rows_df(spark)
    pre = ds.fit_preprocess(df)
    pdf = df.toPandas()
    assert math.isclose(pre.means["ft_avg_x"], pdf.ft_avg_x.mean())
    assert pre.modes == {"ft_c": 0}             # tie-free mode of the int flag after mean fill
    assert pre.zero_cols == ["ft_zero"]
    scaled, unscaled = pre.transform(df)
    assert "ft_zero" not in scaled.columns and unscaled.where(F.col("ft_c").isNull()).count() == 0
    z = scaled.toPandas()
    assert abs(z.ft_b.mean()) < 1e-9 and math.isclose(z.ft_b.std(ddof=1), 1.0, rel_tol=1e-9)


def test_zero_std_gives_null(spark):
    df = spark.createDataFrame([(1, 0, 2.0), (2, 1, 2.0)], "hadm_id int, hcc_cd_135 int, ft_k double")
    scaled, _ = ds.preprocess(df)
    assert [r["ft_k"] for r in scaled.collect()] == [None, None]


def test_exclude_subgroup_missing_column_noop(spark):
    df = rows_df(spark)
    assert ds.exclude_subgroup(df, "nope").count() == 200


def test_chi2_matches_formula(spark):
    df = rows_df(spark).fillna({"ft_avg_x": 0.0, "ft_c": 0})
    got = {r["feature"]: r["importance"] for r in sel.chi2_scores(df, "hcc_cd_135", ["ft_avg_x", "ft_b", "ft_c"]).collect()}
    p = df.toPandas()
    y = p.hcc_cd_135.values
    Y = np.stack([1 - y, y], axis=1)
    for f in ["ft_avg_x", "ft_b", "ft_c"]:
        x = p[f].astype(float).values
        obs = Y.T @ x
        exp = Y.mean(axis=0) * x.sum()
        assert math.isclose(got[f], float(((obs - exp) ** 2 / exp).sum()), rel_tol=1e-9)


def test_roc_and_auc_match_trapezoid(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 500)
    s = np.round(rng.random(500) + 0.3 * y, 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    roc = sel.roc_points(df, n_buckets=16).orderBy(F.desc("threshold")).toPandas()
    P, N = y.sum(), (1 - y).sum()
    for _, r in roc.iterrows():
        assert r.cum_tp == ((s >= r.threshold) & (y == 1)).sum()
        assert r.cum_fp == ((s >= r.threshold) & (y == 0)).sum()
    fpr = np.concatenate([[0.0], roc.cum_fp.values / N])
    tpr = np.concatenate([[0.0], roc.cum_tp.values / P])
    auc = float(np.trapezoid(tpr, fpr))
    m = sel.auc_precision_recall(df, threshold=0.8).first()
    assert math.isclose(m["auc"], auc, rel_tol=1e-9)
    pred = s >= 0.8
    assert math.isclose(m["precision"], (pred & (y == 1)).sum() / pred.sum())
    assert math.isclose(m["recall"], (pred & (y == 1)).sum() / P)


def test_correlations(spark):
    df = rows_df(spark)
    p = df.toPandas()
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in sel.correlation_matrix(df, ["ft_b", "hcc_cd_135"]).collect()}
    assert math.isclose(got[("ft_b", "hcc_cd_135")], p.ft_b.corr(p.hcc_cd_135), rel_tol=1e-9)
    lc = {r["feature"]: r["importance"] for r in sel.label_correlation(df, "hcc_cd_135", ["ft_avg_x"]).collect()}
    assert math.isclose(lc["ft_avg_x"], p.ft_avg_x.corr(p.hcc_cd_135), rel_tol=1e-9)


def test_feature_usage(spark):
    a = spark.createDataFrame([("x",), ("y",)], "feature string")
    b = spark.createDataFrame([("y",)], "feature string")
    got = {r["feature"]: (r["m1"], r["m2"], r["used"]) for r in sel.feature_usage({"m1": a, "m2": b}).collect()}
    assert got == {"x": (1, 0, 1), "y": (1, 1, 2)}


def test_models_run(spark):
    df = rows_df(spark, 400).fillna({"ft_avg_x": 0.0, "ft_c": 0})
    feats = ["ft_avg_x", "ft_b", "ft_c"]
    tree = sel.tree_fit(df, feats, min_leaf=5)
    imp = sel.importances(tree, feats, spark).collect()
    assert len(imp) == 3 and abs(sum(r["importance"] for r in imp) - 1) < 1e-6
    lr = sel.logistic_fit(df, feats)
    m = sel.evaluate(lr, df, feats, "lr").first()
    assert 0 <= m["auc"] <= 1
    pca = sel.pca_fit(df, feats, 2)
    assert sel.pca_scores(pca, df).count() == 400
    sweep = sel.pca_variance_sweep(df, feats, ks=(1, 2)).collect()
    assert len(sweep) == 3


def test_correlation_is_pairwise_complete(spark):
    df = rows_df(spark)  # holds nulls: pairs use the rows in which both are known
    cols = ["ft_avg_x", "ft_b", "ft_c", "hcc_cd_135"]
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in sel.correlation_matrix(df.repartition(3), cols).collect()}
    assert len(got) == 16
    pdf = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).toPandas().astype(float).corr()
    for (a, b), v in got.items():
        want = pdf.loc[a, b]
        assert v is None if math.isnan(want) else math.isclose(v, want, rel_tol=1e-9, abs_tol=1e-12)


def test_registered_grid_is_the_full_one(monkeypatch):
    import inspect
    from cohortforge.plans import queries as q
    seen = {}
    own = inspect.signature(q.sel.grid_search)

    def search(*args, **kwargs):
        call = own.bind(*args, **kwargs)
        call.apply_defaults()
        seen.update(call.arguments)
    monkeypatch.setattr(q, "_splits", lambda spark, d: (None, None, None, ["ft_total"]))
    monkeypatch.setattr(q.sel, "grid_search", search)
    monkeypatch.setattr(q.sel, "evaluate", lambda *args: None)
    monkeypatch.setattr(q, "tidy", lambda df: df)
    q.q_grid(None, "")
    assert len(seen["cs"]) == 20 and min(seen["cs"]) == 1e-4 and round(max(seen["cs"])) == 10_000
    assert set(seen["penalties"]) == {"l1", "l2"} and seen["folds"] == 5
