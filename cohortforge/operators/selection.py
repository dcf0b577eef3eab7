"""Feature selection, model fitting and evaluation.

Statistics that SQL can state (correlation, chi-square on class sums, ROC
points, AUC, precision, recall) are written as DataFrame aggregations; model
fitting uses MLlib estimators, which train distributed over the partitions.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cohortforge.operators.aggregates import unpivot_features
from cohortforge.session import materialize, scratch_path


# ------------------------------------------------------------------ statistics
def _pair_sums(batches, means: Sequence[float]):
    """Sums over a task's rows for every ordered pair of columns, rows in which
    either is missing left out: four matrix products per batch."""
    import numpy as np
    import pandas as pd
    total = None
    for batch in batches:
        x = batch.to_numpy(dtype=np.float64) - np.asarray(means)
        known = ~np.isnan(x)
        x, m = np.where(known, x, 0.0), known.astype(np.float64)
        now = np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        total = now if total is None else total + now
    if total is not None:
        i, j = np.indices(total.shape[1:])
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "n": total[0].ravel(), "x": total[1].ravel(), "xx": total[2].ravel(),
                            "y": total[1].T.ravel(), "yy": total[2].T.ravel(), "xy": total[3].ravel()})


def _pair_totals(df: DataFrame, cols: Sequence[str]) -> tuple[list[float], DataFrame]:
    """Column means, and for every ordered pair of columns the sums around them."""
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    first = wide.agg(*[F.avg(F.nanvl(c, F.lit(None).cast("double"))).alias(c) for c in wide.columns]).first()
    means = [float(m) if m is not None else 0.0 for m in first]
    sums = wide.mapInPandas(lambda it: _pair_sums(it, means),
                            "i int, j int, n double, x double, xx double, y double, yy double, xy double")
    return means, sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "xx", "y", "yy", "xy")])


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, long form, over the rows in
    which both columns are known (pairwise-complete), whatever the number of
    columns. Columns are centred by their means, then each task reduces its
    rows to the sums of every pair, which are added up: one pass, and columns
    x columns rows per task to shuffle. Null where a column does not vary."""
    cols = list(cols)
    _, sums = _pair_totals(df, cols)
    var_x, var_y = F.col("n") * F.col("xx") - F.col("x") ** 2, F.col("n") * F.col("yy") - F.col("y") ** 2
    real = (var_x > 1e-12 * F.col("n") * F.col("xx")) & (var_y > 1e-12 * F.col("n") * F.col("yy"))
    name = F.array(*[F.lit(c) for c in cols])
    return sums.select(name[F.col("i")].alias("feature_a"), name[F.col("j")].alias("feature_b"),
                       F.when(real, (F.col("n") * F.col("xy") - F.col("x") * F.col("y")) / F.sqrt(var_x * var_y)).alias("corr"))


def label_correlation(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Correlation of each feature with the label as importance."""
    aggs = [F.corr(F.col(f).cast("double"), F.col(label).cast("double")).alias(f"{i}") for i, f in enumerate(features)]
    wide = df.agg(*aggs)
    stack = F.stack(F.lit(len(features)), *[x for i, f in enumerate(features) for x in (F.lit(f), F.col(f"`{i}`"))])
    return wide.select(stack.alias("feature", "importance"))


def chi2_scores(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Chi-square of class sums: observed = sum of x in a class, expected =
    class share x total of x; summed over the two classes. For non-negative
    features (counts or flags), not a test on categories."""
    counts = {r[label]: r["nc"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("nc")).collect()}
    n = float(sum(counts.values())) or 1.0
    share = None
    for cls, nc in counts.items():
        cond = F.col(label).isNull() if cls is None else (F.col(label) == F.lit(cls))
        share = F.when(cond, F.lit(nc / n)) if share is None else share.when(cond, F.lit(nc / n))
    long = unpivot_features(df, features, [label])
    obs = long.groupBy("feature", label).agg(F.sum("value").alias("o"))
    tot = obs.groupBy(F.col("feature").alias("__f")).agg(F.sum("o").alias("t"))
    j = obs.join(tot, obs["feature"] == tot["__f"]).withColumn("p", share)
    e = F.col("p") * F.col("t")
    term = F.try_divide((F.col("o") - e) * (F.col("o") - e), e)
    return j.groupBy("feature").agg(F.sum(term).alias("importance"))


def top_k(scores: DataFrame, k: int, score: str = "importance", name: str = "feature") -> DataFrame:
    """k largest non-null scores (ties by name) - a bounded top-k."""
    return scores.where(F.col(score).isNotNull() & ~F.isnan(score)).orderBy(F.desc(score), F.asc(name)).limit(k)


# ----------------------------------------------------------------------- ROC
def _bucket_offsets(g: DataFrame, score: str, n_buckets: int):
    """Split the distinct scores into at most ``n_buckets`` score ranges and
    return (bucketed frame, offsets frame) where offsets hold the totals of
    all higher-score ranges. Both the range bounds and the offsets table are
    bounded by ``n_buckets``."""
    bounds = sorted(set(g.approxQuantile(score, [i / n_buckets for i in range(1, n_buckets)], 0.001)))
    bcol = F.lit(0)
    for i, b in enumerate(bounds):
        bcol = F.when(F.col(score) > F.lit(b), F.lit(i + 1)).otherwise(bcol)
    gb = g.withColumn("__bucket", bcol)
    totals = gb.groupBy("__bucket").agg(F.sum("tp").alias("btp"), F.sum("fp").alias("bfp"))
    w = Window.orderBy(F.desc("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select("__bucket", F.coalesce(F.sum("btp").over(w), F.lit(0)).alias("otp"),
                         F.coalesce(F.sum("bfp").over(w), F.lit(0)).alias("ofp"))
    return gb, offs


def roc_points(scored: DataFrame, label: str = "label", score: str = "score", n_buckets: int = 256) -> DataFrame:
    """One ROC point per distinct score (threshold), descending: cumulative
    true / false positives and their rates.

    Rows are first grouped by score (a hot score collapses to one row). The
    running sums use two levels: totals of score ranges (a bounded table)
    give each range its offset, then a window inside each range adds the
    local running sum. No window spans all scores."""
    y = F.col(label).cast("int")
    g = scored.where(F.col(score).isNotNull()).groupBy(score).agg(
        F.sum(y).alias("tp"), F.sum(1 - y).alias("fp"))
    gb, offs = _bucket_offsets(g, score, n_buckets)
    w = Window.partitionBy("__bucket").orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    cum = gb.join(F.broadcast(offs), "__bucket").select(
        F.col(score).alias("threshold"), "tp", "fp",
        (F.sum("tp").over(w) + F.col("otp")).alias("cum_tp"),
        (F.sum("fp").over(w) + F.col("ofp")).alias("cum_fp"))
    totals = g.agg(F.sum("tp").alias("P"), F.sum("fp").alias("N")).first()
    p, n = float(totals["P"] or 0), float(totals["N"] or 0)
    return cum.select("threshold", "tp", "fp", "cum_tp", "cum_fp",
                      (F.col("cum_tp") / F.lit(p if p else None)).alias("tpr"),
                      (F.col("cum_fp") / F.lit(n if n else None)).alias("fpr"))


def auc_precision_recall(scored: DataFrame, label: str = "label", score: str = "score",
                         prediction: str | None = None, threshold: float = 0.5, name: str = "model") -> DataFrame:
    """AUC (trapezoid over the ROC points), precision and recall of the
    predicted class (``prediction`` column, or score >= threshold)."""
    roc = roc_points(scored, label, score)
    auc = roc.agg(F.sum(F.col("fp") * (2 * F.col("cum_tp") - F.col("tp"))).alias("a")).first()["a"]
    y = F.col(label).cast("int")
    pred = F.col(prediction).cast("int") if prediction else (F.col(score) >= F.lit(threshold)).cast("int")
    c = scored.agg(F.sum(y).alias("P"), F.sum(1 - y).alias("N"), F.sum(y * pred).alias("tp"),
                   F.sum(pred).alias("pp")).first()
    p, n = float(c["P"] or 0), float(c["N"] or 0)
    auc_v = (auc / (2 * p * n)) if (auc is not None and p and n) else None
    prec = (c["tp"] / c["pp"]) if c["pp"] else 0.0
    rec = (c["tp"] / c["P"]) if c["P"] else 0.0
    schema = StructType([StructField("label", StringType()), StructField("auc", DoubleType()),
                         StructField("precision", DoubleType()), StructField("recall", DoubleType())])
    return scored.sparkSession.createDataFrame([(name, auc_v, float(prec), float(rec))], schema)


# ------------------------------------------------------------------ MLlib models
def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(
        df.select(*[F.col(c).cast("double").alias(c) if c in features else F.col(c) for c in df.columns]))


def pca_fit(df: DataFrame, features: Sequence[str], k: int):
    """Centre (mean only), then PCA with k components. Returns the fitted
    pipeline model; scores are columns pc_0..pc_{k-1}."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    stages = [VectorAssembler(inputCols=list(features), outputCol="__x", handleInvalid="keep"),
              StandardScaler(inputCol="__x", outputCol="__c", withMean=True, withStd=False),
              PCA(k=k, inputCol="__c", outputCol="__pc")]
    return Pipeline(stages=stages).fit(df.select(*[F.col(c).cast("double").alias(c) if c in features else F.col(c)
                                                   for c in df.columns]))


class GramPca:
    """Principal components from the column sums: means, loadings (a column per
    component, signs fixed by the largest loading) and variances of all components."""

    def __init__(self, features: Sequence[str], means, loadings, variances):
        self.features, self.means, self.loadings, self.variances = list(features), means, loadings, variances

    @property
    def ratios(self) -> list[float]:
        total = float(self.variances.sum())
        return [float(v) / total if total else 0.0 for v in self.variances]

    def scores(self, df: DataFrame, names: Sequence[str]) -> DataFrame:
        """The frame with one column per component: a sum of products, no model job."""
        cols = {}
        for j, name in enumerate(names):
            terms = [(F.col(f"`{f}`").cast("double") - F.lit(float(m))) * F.lit(float(w))
                     for f, m, w in zip(self.features, self.means, self.loadings[:, j])]
            cols[name] = functools.reduce(lambda a, b: a + b, terms)
        return df.withColumns(cols)


def pca_gram(df: DataFrame, features: Sequence[str], k: int) -> GramPca:
    """PCA by the eigenvectors of the covariance matrix, which the sums over pairs
    of columns give (the same sums as the correlation matrix): one pass for the means,
    one for the sums, then columns x columns numbers on the driver. Rows with a
    missing value in a pair are left out of that pair."""
    import numpy as np
    means, sums = _pair_totals(df, features)
    d = len(features)
    n, x, y, xy = (np.zeros((d, d)) for _ in range(4))
    for r in sums.select("i", "j", "n", "x", "y", "xy").collect():  # columns x columns
        n[r["i"], r["j"]], x[r["i"], r["j"]], y[r["i"], r["j"]], xy[r["i"], r["j"]] = r["n"], r["x"], r["y"], r["xy"]
    cov = (xy - x * y / np.maximum(n, 1)) / np.maximum(n - 1, 1)
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(values)[::-1]
    values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(d)])
    known = np.diag(n)
    centers = np.asarray(means) + np.diag(x) / np.maximum(known, 1)
    return GramPca(features, centers, (vectors * np.where(signs == 0, 1, signs))[:, :k], values)


def pca_scores(model, df: DataFrame, keep: Sequence[str] = ("hadm_id",), k: int | None = None) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    k = k or model.stages[-1].getK()
    t = model.transform(df).withColumn("__a", vector_to_array("__pc"))
    return t.select(*keep, *[F.col("__a")[i].alias(f"pc_{i}") for i in range(k)])


def pca_variance(model, spark: SparkSession) -> DataFrame:
    ev = model.stages[-1].explainedVariance.toArray().tolist()
    return spark.createDataFrame([(f"pc_{i}", float(v)) for i, v in enumerate(ev)], "component string, variance double")


def pca_variance_sweep(df: DataFrame, features: Sequence[str], ks: Sequence[int] = (5, 6, 7, 8, 9)) -> DataFrame:
    """Explained-variance ratios for several component counts: PCA's leading
    components do not depend on k, so one fit with max(k) serves every k."""
    kmax = min(max(ks), len(features))
    ratios = pca_gram(df, features, kmax).ratios
    rows = [(int(k), f"pc_{i}", ratios[i]) for k in ks for i in range(min(k, kmax))]
    return df.sparkSession.createDataFrame(rows, "n int, component string, variance double")


def tree_fit(df: DataFrame, features: Sequence[str], label: str = "hcc_cd_135", min_leaf: int = 1, min_split: int = 2,
             max_depth: int = 30, max_bins: int = 64, seed: int = 42):
    """Entropy decision tree with at least ``min_leaf`` rows per leaf and
    ``min_split`` rows per inner node, an MLlib model (:mod:`cohortforge.operators.trees`).
    As in MLlib, ``max_bins`` bounds the cut points per feature and a tree has at most 30 levels."""
    from cohortforge.operators import trees
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("y"))
    return trees.fit(wide, int(min_leaf), int(min_split), max_depth, max_bins, seed)


def tree_nodes(model, spark: SparkSession) -> DataFrame:
    """The tree as a table, one row per node: id, prediction, rawCount (training
    rows), gain, leftChild, rightChild (-1 at a leaf), split."""
    path = scratch_path(spark, f"tree-{uuid.uuid4().hex}")
    model.write().save(path)
    return spark.read.parquet(f"{path}/data")


def collapse_small_nodes(model, min_split: int, spark: SparkSession):
    """The tree that a minimum split size would have grown: MLlib knows none, but
    splits do not depend on what is below them, so an inner node with fewer than
    ``min_split`` training rows is turned into a leaf (it holds its own
    prediction and class counts) and its subtree goes. Counts only fall on the way
    down, so a node stays if its parent has enough rows. Importances follow from the
    nodes that are left, as MLlib computes them when it loads a tree.

    The nodes pass through the driver, where MLlib holds the whole model anyway."""
    path = scratch_path(spark, f"tree-{uuid.uuid4().hex}")
    model.write().save(path)
    table = spark.read.parquet(f"{path}/data")
    nodes = {r["id"]: r.asDict() for r in table.collect()}
    splits = {i for i, r in nodes.items() if r["leftChild"] >= 0 and r["rawCount"] >= min_split}
    kept = sorted({0} | {nodes[i][side] for i in splits for side in ("leftChild", "rightChild")})
    new_id = {old: at for at, old in enumerate(kept)}  # ids stay in pre-order, without gaps
    rows = []
    for old in kept:
        r = dict(nodes[old], id=new_id[old])
        if old in splits:
            r["leftChild"], r["rightChild"] = new_id[r["leftChild"]], new_id[r["rightChild"]]
        else:
            r |= {"gain": -1.0, "leftChild": -1, "rightChild": -1, "split": (-1, [], -1)}
        rows.append(tuple(r[c] for c in table.columns))
    out = scratch_path(spark, f"tree-{uuid.uuid4().hex}")
    spark.createDataFrame(rows, table.schema).coalesce(1).write.parquet(f"{out}/data")
    spark.read.text(f"{path}/metadata").coalesce(1).write.text(f"{out}/metadata")
    return type(model).load(out)


def importances(model, features: Sequence[str], spark: SparkSession, k: int | None = 25) -> DataFrame:
    imp = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    return top_k(df, k) if k else df


def logistic_fit(df: DataFrame, features: Sequence[str], label: str = "hcc_cd_135", c: float = 1.0,
                 l1: bool = False, max_iter: int = 100):
    """L2 (or L1) logistic regression with inverse strength C: MLlib's
    regParam is 1 / (C n) for the same objective; no internal standardisation."""
    from pyspark.ml.classification import LogisticRegression
    data = assemble(df, features).withColumn("__y", F.col(label).cast("double"))
    n = data.count()
    return LogisticRegression(featuresCol="features", labelCol="__y", regParam=1.0 / (c * max(n, 1)),
                              elasticNetParam=1.0 if l1 else 0.0, standardization=False,
                              maxIter=max_iter).fit(data)


def score_with(model, df: DataFrame, features: Sequence[str], label: str = "hcc_cd_135",
               keep: Sequence[str] = ("hadm_id",)) -> DataFrame:
    """Positive-class probability and predicted class per row."""
    from pyspark.ml.functions import vector_to_array
    t = model.transform(assemble(df, features))
    return t.select(*keep, F.col(label).cast("int").alias("label"),
                    vector_to_array("probability")[1].alias("score"),
                    F.col("prediction").cast("int").alias("prediction"))


def evaluate(model, df: DataFrame, features: Sequence[str], name: str, label: str = "hcc_cd_135") -> DataFrame:
    s = score_with(model, df, features, label)
    return auc_precision_recall(s, "label", "score", prediction="prediction", name=name)


def grid_search(df: DataFrame, features: Sequence[str], label: str = "hcc_cd_135",
                cs: Sequence[float] = tuple(10 ** (-4 + 8 * i / 19) for i in range(20)),
                penalties: Sequence[str] = ("l2", "l1"), folds: int = 5, parallelism: int = 8, seed: int = 42):
    """k-fold cross-validated search over penalty x C for logistic regression
    (accuracy as the metric); returns the best model refitted on all rows. The vectors
    are written once; the folds and the ``parallelism`` fits at a time read them."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    vectors = assemble(df, features).select("features", F.col(label).cast("double").alias("__y"))
    data = materialize(vectors, "grid-vectors")  # read in about one task per core, which keeps the many short jobs short
    n = max(data.count(), 1)
    lr = LogisticRegression(featuresCol="features", labelCol="__y", standardization=False)
    grid = (ParamGridBuilder().addGrid(lr.regParam, [1.0 / (c * n) for c in cs])
            .addGrid(lr.elasticNetParam, [0.0 if p == "l2" else 1.0 for p in penalties]).build())
    ev = MulticlassClassificationEvaluator(labelCol="__y", predictionCol="prediction", metricName="accuracy")
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=ev, numFolds=folds,
                        parallelism=parallelism, seed=seed)
    return cv.fit(data).bestModel


def make_table(tables: Sequence[DataFrame], extra_rows: Sequence[tuple] = ()) -> DataFrame:
    """Comparison table (label, auc, precision, recall) sorted by auc then
    precision, with externally computed rows appended."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    if extra_rows:
        out = out.unionByName(out.sparkSession.createDataFrame(list(extra_rows), out.schema))
    return out.orderBy(F.desc("auc"), F.desc("precision"))


def feature_usage(selections: Mapping[str, DataFrame], name: str = "feature") -> DataFrame:
    """Feature x selection-method membership (0/1), ``used`` = methods using
    the feature; a long table pivoted with the method list given."""
    methods = list(selections)
    long = None
    for m, df in selections.items():
        part = df.select(F.col(name).alias("feature")).distinct().withColumn("method", F.lit(m))
        long = part if long is None else long.unionByName(part)
    wide = long.groupBy("feature").agg(*[F.max((F.col("method") == m).cast("int")).alias(m) for m in methods])
    return wide.withColumn("used", sum(F.col(m) for m in methods))


def read_external_curve(spark: SparkSession, path: str, column: int = 1) -> DataFrame:
    """One numeric column (by position) of an externally written CSV."""
    df = spark.read.option("header", True).csv(path)
    return df.select(F.col(f"`{df.columns[column]}`").cast("double").alias("value"))
