"""Queries over the model sets of the assembled features: preprocessing kept and
reloaded, reports, feature sets, trees, components, comparison. Registered with
the others by ``queries.py``."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortforge.operators import selection as sel
from cohortforge.plans import model_sets as ms
from cohortforge.plans import presets as P
from cohortforge.plans import queries as Q
from cohortforge.plans.sqlparts import with_ctes
from cohortforge.sources.io import read_report, write_report, write_table

SUBGROUP = "ft_admit_type_5-low"
_WRITTEN: dict[tuple[str, str], str] = {}


def model_sets(spark, d) -> str:
    """Folder of the model sets of a table folder: written by the first query of a
    session that needs them and read by the others, as the sets are meant to be."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _WRITTEN:
        folder = Q._scratch(spark, "model-sets")
        ms.write_model_sets(Q.q_assembly(spark, d), folder, subgroup=SUBGROUP)
        _WRITTEN[at] = folder
    return _WRITTEN[at]


SETS_CTES = [
    f"asm AS ({Q._assembly_sql()})",
    f'kept AS (SELECT * FROM asm WHERE "{SUBGROUP}" = 0)',
    """und AS (SELECT * FROM kept WHERE hcc_cd_135 = 1 UNION ALL SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (ORDER BY md5('42' || CAST(hadm_id AS VARCHAR)), hadm_id) AS rn FROM kept WHERE hcc_cd_135 = 0)
  WHERE rn <= (SELECT count(*) FROM kept WHERE hcc_cd_135 = 1))""",
    f"""sp AS (SELECT {Q._SPLIT_SQL} AS split, hadm_id, hcc_cd_135, CAST(COLUMNS(* EXCLUDE (hadm_id, hcc_cd_135, b)) AS DOUBLE)
  FROM (SELECT *, {Q._BUCKET_SQL} AS b FROM und))""",
    """lg AS (SELECT * FROM sp UNPIVOT INCLUDE NULLS (x FOR feature IN (COLUMNS(* EXCLUDE (split, hadm_id, hcc_cd_135)))))""",
    """cn AS (SELECT split, feature, CASE WHEN regexp_matches(feature, 'age|avg|los') THEN avg(x) END AS m FROM lg GROUP BY split, feature)""",
    """md AS (SELECT split, feature, x AS v FROM (
  SELECT *, row_number() OVER (PARTITION BY split, feature ORDER BY n DESC, x) AS rn FROM (
    SELECT split, feature, x, count(*) AS n FROM lg WHERE x IS NOT NULL GROUP BY ALL)) WHERE rn = 1)""",
    """fl AS (SELECT lg.*, coalesce(x, cn.m, md.v) AS u FROM lg JOIN cn USING (split, feature) LEFT JOIN md USING (split, feature))""",
    """st AS (SELECT split, feature, bool_and(coalesce(u = 0, FALSE)) AS zero, avg(u) AS c, stddev_samp(u) AS s FROM fl GROUP BY ALL)""",
]
SHARED_CTE = "shared AS (SELECT feature FROM st GROUP BY feature HAVING count(*) FILTER (s > 1e-12 * abs(c)) = 3)"


def _long(parts) -> object:
    """(split, hadm_id, feature, value) rows of the splits."""
    out = None
    for name, df in parts:
        feats = [c for c in df.columns if c.startswith("ft_")]
        wide = df.select("hadm_id", *[F.col(f"`{c}`").cast("double").alias(c) for c in feats])
        rows = wide.unpivot(["hadm_id"], feats, "feature", "value").select(F.lit(name).alias("split"), "hadm_id", "feature", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


@Q.query("model_sets_scaled", with_ctes(SETS_CTES, """
SELECT split, hadm_id, feature, round(CASE WHEN s > 1e-12 * abs(c) THEN (u - c) / s END, 6) AS value
FROM fl JOIN st USING (split, feature) WHERE NOT zero""".lstrip()))
def q_sets_scaled(spark, d):
    """Assembly, subgroup, undersampling, split, fill and z-scores, each written; the
    scaled sets as they are read back."""
    folder = model_sets(spark, d)
    return _long((s, ms.read_model_set(spark, folder, s)) for s in ms.SPLITS)


@Q.query("model_sets_filled", with_ctes(SETS_CTES, """
SELECT split, hadm_id, feature, round(u + 1e-9, 6) AS value FROM fl JOIN st USING (split, feature) WHERE NOT zero""".lstrip()))
def q_sets_filled(spark, d):
    """The filled sets, made anew from the saved rows by the reloaded models. (A mean
    may end in 5 at the seventh digit; the offset makes both sides round it alike.)"""
    folder = model_sets(spark, d)
    rows = _long((s, ms.apply_saved(spark, folder, s, scaled=False)) for s in ms.SPLITS)
    return rows.withColumn("value", F.col("value") + 1e-9)


_REPORT_SQL = with_ctes(SETS_CTES, """
SELECT report, metric, CAST(value AS DOUBLE) AS value FROM (
    SELECT 'data' AS report, count(*) AS rows, (SELECT count(DISTINCT feature) FROM lg) + 2 AS columns, count_if(hcc_cd_135 = 1) AS positives,
           count_if(hcc_cd_135 = 0) AS negatives, count_if(hcc_cd_135 IS NULL) AS unlabelled FROM kept
    UNION ALL
    SELECT 'undersampled', count(*), (SELECT count(DISTINCT feature) FROM lg) + 2, count_if(hcc_cd_135 = 1), count_if(hcc_cd_135 = 0), 0 FROM und
    UNION ALL
    SELECT split || suffix, count(*), any_value(k), count_if(hcc_cd_135 = 1), count_if(hcc_cd_135 = 0), 0
    FROM sp JOIN (SELECT split, count(*) + 2 AS k FROM st WHERE NOT zero GROUP BY split) USING (split), (VALUES (''), ('_no_scaled')) v(suffix)
    GROUP BY split, suffix)
  UNPIVOT (value FOR metric IN (rows, columns, positives, negatives, unlabelled))""".lstrip())


@Q.query("model_set_report", _REPORT_SQL)
def q_set_report(spark, d):
    """Shapes and label counts of the written tables, read back from the report file."""
    return read_report(spark, f"{model_sets(spark, d)}/report")


_CODES_REPORT_SQL = with_ctes([Q.A.SQL_DIAGNOSES, Q.A.SQL_CROSSWALK], """
SELECT 'codes' AS report, metric, CAST(value AS DOUBLE) AS value FROM (UNPIVOT (
  SELECT count(*) AS rows, 4 AS columns, count_if(c.icd IS NOT NULL) AS matched, count_if(c.icd IS NULL) AS unmatched,
         count_if(c.icd IS NOT NULL AND c.hcc IS NULL) AS unmapped
  FROM diagnoses_r d LEFT JOIN crosswalk_r c ON d.icd9_code = c.icd)
  ON rows, columns, matched, unmatched, unmapped INTO NAME metric VALUE value)""".lstrip())


@Q.query("code_match_report", _CODES_REPORT_SQL)
def q_code_report(spark, d):
    """Match statistics and unmapped codes of the code join, of the written rows."""
    joined = Q.lookup_join(Q.A.diagnoses(spark, d), Q.A.crosswalk(spark, d), "icd9_code", "icd", indicator="merged")
    joined = joined.select("hadm_id", "icd9_code", "hcc", "merged")
    hit = F.col("merged") == "both"
    folder = Q._scratch(spark, "codes")
    seen = write_table(joined, f"{folder}/rows", measure={"matched": F.count_if(hit), "unmatched": F.count_if(~hit),
                                                          "unmapped": F.count_if(hit & F.col("hcc").isNull())})
    write_report(spark, f"{folder}/report", {"codes": seen})
    return read_report(spark, f"{folder}/report")


_MEMBERSHIP_SQL = with_ctes(SETS_CTES + [SHARED_CTE, f"""
ob AS (SELECT feature, hcc_cd_135 AS y, sum(u) AS o FROM fl JOIN shared USING (feature)
  WHERE split = 'train' AND feature NOT IN ({', '.join(f"'{c}'" for c in P.CHI2_EXCLUDE)}) GROUP BY ALL),
py AS (SELECT hcc_cd_135 AS y, count(*) / (SELECT count(*) FROM sp WHERE split = 'train') AS p FROM sp WHERE split = 'train' GROUP BY ALL),
sc AS (SELECT feature, sum((o - p * t) * (o - p * t) / nullif(p * t, 0)) AS importance
  FROM ob JOIN py USING (y) JOIN (SELECT feature, sum(o) AS t FROM ob GROUP BY feature) USING (feature) GROUP BY feature),
best AS (SELECT feature FROM sc WHERE importance IS NOT NULL AND NOT isnan(importance) ORDER BY importance DESC, feature LIMIT {P.TOP_K}),
mem AS (SELECT feature, 1 AS "baseline-logistic-regression",
  CAST(feature IN ({', '.join(f"'{c}'" for c in P.LITERATURE_FEATURES)}) AS INTEGER) AS "log-reg-literature",
  CAST(feature IN (SELECT feature FROM best) AS INTEGER) AS "log-reg-select-k-best" FROM shared)""".strip()], """
SELECT *, "baseline-logistic-regression" + "log-reg-literature" + "log-reg-select-k-best" AS used FROM mem""".lstrip())


def _sets(spark, d):
    return ms.feature_sets(spark, model_sets(spark, d))


@Q.query("feature_set_membership", _MEMBERSHIP_SQL)
def q_membership(spark, d):
    """Feature x set matrix of the sets that SQL can state too: all, literature, chi-square top 25."""
    return ms.usage(spark, [s for s in _sets(spark, d) if s.name != "log-reg-decision-tree"])


@Q.query("feature_set_usage")
def q_set_usage(spark, d):
    """The same with the tree's top 25; most used first."""
    return ms.usage(spark, _sets(spark, d)).orderBy(F.desc("used"), "feature")


@Q.query("feature_set_models")
def q_set_models(spark, d):
    """Logistic regression on each of the five sets and the three trees on the
    validation split, the last tree on the hold-out split, with external rows; sorted."""
    folder = model_sets(spark, d)
    valid, test = (ms.read_model_set(spark, folder, s) for s in ms.SPLITS[1:])
    rows = ms.SetComparison(spark, folder, _sets(spark, d)).each()
    trees = ms.tree_models(spark, folder)
    rows += [sel.evaluate(tree, valid, features, name) for name, tree, features in trees]
    name, tree, features = trees[-1]
    rows.append(sel.evaluate(tree, test, features, f"{name}: hold-out"))
    return sel.make_table(rows, P.EXTERNAL_MODELS)


@Q.query("feature_set_search")
def q_set_search(spark, d):
    """The feature set as an axis of the cross-validated grid: mean figures of each
    set and the chosen one's metrics on the validation split."""
    sets = _sets(spark, d)
    name, figures, metrics = ms.SetComparison(spark, model_sets(spark, d), sets).best()
    table = spark.createDataFrame([(s.name, float(f), s.name == name) for s, f in zip(sets, figures)], "label string, cv_auc double, chosen boolean")
    return table.withColumns({c: F.lit(v) for c, v in metrics.first().asDict().items() if c != "label"})


_TRAIN_ROWS = "(SELECT count(*) FROM sp WHERE split = 'train')"


@Q.query("tree_min_split", with_ctes(SETS_CTES, f"""
SELECT setting, {_TRAIN_ROWS} AS rows, CAST(0 AS BIGINT) AS small_inner, CAST(0 AS BIGINT) AS small_leaves, CAST(0 AS BIGINT) AS misrouted
FROM (VALUES ({'), ('.join(str(i) for i in range(len(P.TREE_SETTINGS)))})) t(setting)""".lstrip()))
def q_tree_min_split(spark, d):
    """The trees' nodes against the rows: the root's count is the training rows (SQL
    counts them), no inner node is below the split size, no leaf below the leaf size,
    and every leaf's count is the number of rows that reach it."""
    folder, out = model_sets(spark, d), []
    train = ms.read_model_set(spark, folder, "train")
    for i, (setting, (_, tree, features)) in enumerate(zip(P.TREE_SETTINGS, ms.tree_models(spark, folder))):
        nodes = sel.tree_nodes(tree, spark)
        leaf = F.col("leftChild") < 0
        counts = nodes.agg(F.max(F.when(F.col("id") == 0, F.col("rawCount"))).alias("rows"),
                           F.count_if(~leaf & (F.col("rawCount") < setting.get("min_split", 2))).alias("small_inner"),
                           F.count_if(leaf & (F.col("rawCount") < setting["min_leaf"])).alias("small_leaves"))
        reached = tree.setLeafCol("leaf").transform(sel.assemble(train, features)).groupBy("leaf").agg(F.count("*").alias("n"))
        leaves = nodes.where(leaf).orderBy("id").select("rawCount").collect()  # a model's nodes, held by the driver anyway
        held = spark.createDataFrame([(float(at), r["rawCount"]) for at, r in enumerate(leaves)], "leaf double, rawCount long")
        wrong = held.join(reached, "leaf", "full").agg(F.count_if(~F.col("n").eqNullSafe(F.col("rawCount"))).alias("misrouted"))
        row = counts.first()
        out.append((i, row["rows"], row["small_inner"], row["small_leaves"], wrong.first()[0]))
    return spark.createDataFrame(out, "setting int, rows long, small_inner long, small_leaves long, misrouted long")


@Q.query("pca_total_variance", with_ctes(SETS_CTES + [SHARED_CTE], """
SELECT count(*) AS features, round(sum(s * s), 6) AS variance FROM st JOIN shared USING (feature) WHERE split = 'train'""".lstrip()))
def q_pca_total(spark, d):
    """Sum of the variances of all components of the filled training set; it is the
    trace of the covariance matrix."""
    folder = model_sets(spark, d)
    features = ms.shared_features(spark, folder)
    pca = sel.pca_gram(ms.read_model_set(spark, folder, "train", scaled=False), features, 1)
    return spark.createDataFrame([(len(features), float(pca.variances.sum()))], "features long, variance double")


@Q.query("logistic_gradient", with_ctes(SETS_CTES, """
SELECT count(*) AS rows, CAST(count_if(hcc_cd_135 = 1) AS BIGINT) AS positives, TRUE AS stationary FROM sp WHERE split = 'train'""".lstrip()))
def q_logistic_gradient(spark, d):
    """Evidence for the fitted logistic regression: at its coefficients the gradient of
    the penalised loss over the training rows is zero (1e-4 at most in any direction)."""
    from pyspark.ml.functions import vector_to_array
    folder = model_sets(spark, d)
    train = ms.read_model_set(spark, folder, "train")
    features = [c for c in P.LITERATURE_FEATURES if c in ms.shared_features(spark, folder)]
    model = sel.logistic_fit(train, features, max_iter=500)
    scored = model.transform(sel.assemble(train, features)).withColumn("r", vector_to_array("probability")[1] - F.col("hcc_cd_135"))
    sums = scored.agg(F.count("*").alias("n"), F.sum(F.col("hcc_cd_135")).alias("p"), F.sum("r").alias("b"),
                      *[F.sum(F.col("r") * F.col(f)).alias(f"g{i}") for i, f in enumerate(features)]).first()
    n, reg = sums["n"], 1.0 / sums["n"]
    slopes = [sums["b"] / n] + [sums[f"g{i}"] / n + reg * w for i, w in enumerate(model.coefficients.toArray().tolist())]
    return spark.createDataFrame([(n, sums["p"], max(map(abs, slopes)) < 1e-4)], "rows long, positives long, stationary boolean")
