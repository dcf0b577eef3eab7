"""From assembled features to the model sets and the models compared on them.

Every step writes its table and the next one reads it, as the tables are kept
for later sessions: all features, the undersampled rows, and per split the
filled and the scaled set with the fitted preprocessing model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge.operators import dataset as ds
from cohortforge.operators import selection as sel
from cohortforge.operators.preprocess import ModelSetPreprocessor, PreprocessModel
from cohortforge.plans import presets as P
from cohortforge.sources.io import read_features, write_report, write_table

SPLITS = ("train", "valid", "test")


def label_report(label: str) -> dict:
    """Label counts and rows without a label, for the report of a written table."""
    y = F.col(label)
    return {"positives": F.count_if(y == 1), "negatives": F.count_if(y == 0), "unlabelled": F.count_if(y.isNull())}


def write_model_sets(features: DataFrame, folder: str, subgroup: str = "ft_admit_type_newborn", key: str = "hadm_id",
                     label: str = "hcc_cd_135", seed: str = "42", fit_on: str = "self") -> dict[str, dict]:
    """Writes ``data`` (features without the subgroup), ``undersampled``, and for each
    split ``<split>`` (z-scores), ``<split>_no_scaled`` (filled values) and
    ``models/<split>``; ``report`` holds shapes and label counts of all of them.

    ``fit_on="self"`` fits each split on its own, ``"train"`` fits all on the training split."""
    spark, reports = features.sparkSession, {}

    def put(name: str, df: DataFrame) -> DataFrame:
        reports[name] = write_table(df, f"{folder}/{name}", measure=label_report(label))
        return read_features(spark, f"{folder}/{name}", key=key)

    data = put("data", ds.exclude_subgroup(features, subgroup))
    data = put("undersampled", ds.undersample(data, label, key, seed))
    train = None
    for name, part in zip(SPLITS, ds.split_frames(data, key=key, seed=seed)):
        model = train if train is not None and fit_on == "train" else ModelSetPreprocessor(keyCol=key, labelCol=label).fit(part)
        train = train or model
        model.write().overwrite().save(f"{folder}/models/{name}")
        put(f"{name}_no_scaled", model.with_scaled(False).transform(part))
        put(name, model.with_scaled(True).transform(part))
    write_report(spark, f"{folder}/report", reports)
    return reports


def read_model_set(spark: SparkSession, folder: str, split: str, scaled: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    return read_features(spark, f"{folder}/{split}{'' if scaled else '_no_scaled'}", columns)


def apply_saved(spark: SparkSession, folder: str, split: str, scaled: bool = True) -> DataFrame:
    """The split made anew: the saved undersampled rows through the reloaded model."""
    rows = read_features(spark, f"{folder}/undersampled")
    model = PreprocessModel.load(f"{folder}/models/{split}")
    part = ds.split_frames(rows, key=model.getOrDefault("keyCol"))[SPLITS.index(split)]
    return model.with_scaled(scaled).transform(part)


def shared_features(spark: SparkSession, folder: str) -> list[str]:
    """Features that all three splits keep and that vary in each, in order."""
    models = [PreprocessModel.load(f"{folder}/models/{s}") for s in SPLITS]
    varying = [{c.name for c in m.constants if c.scale} for m in models]
    return [c for c in models[0].feature_names() if all(c in v for v in varying)]


@dataclass
class FeatureSet:
    """A named selection: columns of the model set, or principal components of them."""
    name: str
    features: list[str]
    components: int = 0


def feature_sets(spark: SparkSession, folder: str, label: str = "hcc_cd_135", literature: Sequence[str] = P.LITERATURE_FEATURES,
                 k: int = P.TOP_K, not_counted: Sequence[str] = P.CHI2_EXCLUDE, components: int = 5) -> list[FeatureSet]:
    """The five sets: all features, those of the literature, principal components
    of those, the chi-square top k of the filled values, and the top k of the tree."""
    everything = shared_features(spark, folder)
    train, filled = (read_model_set(spark, folder, "train", scaled) for scaled in (True, False))
    lit = [c for c in literature if c in everything]
    scores = sel.chi2_scores(filled, label, [c for c in everything if c not in not_counted])
    best = [r["feature"] for r in sel.top_k(scores, k).collect()]
    tree = sel.tree_fit(train, everything, label, **P.TREE_SETTINGS[1])
    top = [r["feature"] for r in sel.importances(tree, everything, spark, k).collect()]
    return [FeatureSet("baseline-logistic-regression", everything), FeatureSet("log-reg-literature", lit),
            FeatureSet("log-reg-pca-supervised", lit, min(components, len(lit))),
            FeatureSet("log-reg-select-k-best", best), FeatureSet("log-reg-decision-tree", top)]


def usage(spark: SparkSession, sets: Sequence[FeatureSet]) -> DataFrame:
    """Feature x set membership and the number of sets that use a feature; sets of
    components are no sets of features."""
    named = {s.name: spark.createDataFrame([(f,) for f in s.features], "feature string") for s in sets if not s.components}
    return sel.feature_usage(named)


class SetComparison:
    """One pipeline for all sets: the vector holds every feature and every set's
    principal components, and a set is the list of its places (``VectorSlicer.indices``),
    which makes the sets an axis of the cross-validated grid."""

    def __init__(self, spark: SparkSession, folder: str, sets: Sequence[FeatureSet], label: str = "hcc_cd_135"):
        from pyspark.ml.classification import LogisticRegression
        self.sets, self.label = list(sets), label
        self.everything = list(dict.fromkeys(f for s in sets for f in s.features))
        self.train, self.valid = (read_model_set(spark, folder, s).select("hadm_id", label, *self.everything) for s in SPLITS[:2])
        inputs, self.places = list(self.everything), {}
        for s in self.sets:
            if s.components:
                model = sel.pca_gram(self.train, s.features, s.components)
                names = [f"{s.name}_{i}" for i in range(s.components)]
                self.train, self.valid = (model.scores(x, names) for x in (self.train, self.valid))
                self.places[s.name] = [len(inputs) + i for i in range(s.components)]
                inputs += names
            else:
                self.places[s.name] = [self.everything.index(f) for f in s.features]
        self.train, self.valid = (x.withColumn("__y", F.col(label).cast("double")) for x in (self.train, self.valid))
        rows = self.train.count()
        self.slicer = VectorSlicer(inputCol="all_features", outputCol="features")
        self.model = LogisticRegression(labelCol="__y", featuresCol="features", standardization=False, regParam=1.0 / max(rows, 1))
        self.pipeline = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="all_features"), self.slicer, self.model])

    def _metrics(self, fitted, name: str) -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        scored = fitted.transform(self.valid).select(F.col(self.label).cast("int").alias("label"), vector_to_array("probability")[1].alias("score"),
                                                     F.col("prediction").cast("int").alias("prediction"))
        return sel.auc_precision_recall(scored, prediction="prediction", name=name)

    def each(self) -> list[DataFrame]:
        """Metrics on the validation split of the model of each set."""
        return [self._metrics(self.pipeline.copy({self.slicer.indices: self.places[s.name]}).fit(self.train), s.name) for s in self.sets]

    def best(self, folds: int = 3, parallelism: int = 4, seed: int = 42) -> tuple[str, list[float], DataFrame]:
        """The set that cross-validation chooses (area under the ROC curve), the mean
        figures of all sets, and the metrics of its refitted model."""
        from pyspark.ml.evaluation import BinaryClassificationEvaluator
        from pyspark.ml.tuning import CrossValidator
        grid = [{self.slicer.indices: self.places[s.name]} for s in self.sets]
        found = CrossValidator(estimator=self.pipeline, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol="__y"),
                               numFolds=folds, parallelism=parallelism, seed=seed).fit(self.train)
        name = self.sets[max(range(len(self.sets)), key=lambda i: found.avgMetrics[i])].name
        return name, list(found.avgMetrics), self._metrics(found.bestModel, f"cross-validated: {name}")


def tree_models(spark: SparkSession, folder: str, label: str = "hcc_cd_135", settings: Sequence[Mapping] = P.TREE_SETTINGS,
                k: int = P.TOP_K) -> list[tuple[str, object, list[str]]]:
    """(name, tree, features) of the three settings; the last is fitted on the top k
    features of the one before."""
    train, everything = read_model_set(spark, folder, "train"), shared_features(spark, folder)
    names = ("baseline-decision-tree", "optimized-decision-tree", f"optimized-decision-tree-with-top-{k}-features")
    out, features = [], everything
    for name, setting in zip(names, settings):
        if name == names[-1]:
            features = [r["feature"] for r in sel.importances(out[-1][1], everything, spark, k).collect()]
        out.append((name, sel.tree_fit(train, features, label, **setting), features))
    return out
