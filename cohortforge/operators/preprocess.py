"""Preprocessing of a model set as an MLlib estimator and a model that can be
saved: mean fill, mode fill, removal of all-zero columns, standardisation.

Fitting takes two passes over the frame, whatever its width: one that reduces each
task's rows to the moments of every column, and one with the value counts of the columns that
still hold nulls after the mean fill (text columns take one more). Centre and
scale after the fill follow from the moments: the filled rows are a second
group with mean = fill and no spread, merged by the parallel variance formula.
The model is a table with one row per column, saved beside the MLlib metadata.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
MEAN_HINTS = ("age", "avg", "los")
CONSTANTS = ("position int, name string, type string, by_mean boolean, fill string, all_zero boolean, "
             "center double, scale double")
# A spread below this share of the centre is rounding, not variation.
NO_SPREAD = 1e-12


def is_number(kind: str) -> bool:
    return kind in NUMBERS or kind == "boolean" or kind.startswith("decimal")


@dataclass
class ColumnConstants:
    """What is done to one column. ``fill`` is text, cast to the column's type."""
    position: int
    name: str
    type: str
    by_mean: bool
    fill: str | None
    all_zero: bool
    center: float | None
    scale: float | None


def _as_double(c: str) -> Column:
    return F.col(f"`{c}`").cast("double")


def _batch_moments(batches, n_columns: int):
    """A task's known rows, mean, sum of squared deviations, low and high of each column:
    per Arrow batch a few array operations, merged by the parallel variance formula. Nulls
    are left out; NaN is a value, larger than all others, as in Spark's own aggregates."""
    import numpy as np
    import pyarrow as pa
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = np.zeros((5, n_columns))
        for i, column in enumerate(batch.columns):
            x = column.drop_null().to_numpy(zero_copy_only=False)
            mean = x.mean() if len(x) else 0.0
            now[:, i] = (len(x), mean, ((x - mean) ** 2).sum(), np.fmin.reduce(x, initial=np.inf), np.maximum.reduce(x, initial=-np.inf))
        held = now if held is None else _merged(held, now)
    if held is not None:
        names = ("n", "mean", "m2", "low", "high")
        yield pa.RecordBatch.from_arrays([pa.array(range(n_columns), pa.int32()), *map(pa.array, held)], names=["at", *names])


def _merged(a, b):
    """Moments of two parts of the rows together."""
    import numpy as np
    n = a[0] + b[0]
    gap, share = b[1] - a[1], np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    return np.stack([n, np.where(a[0] > 0, a[1] + gap * share, b[1]), a[2] + b[2] + gap * gap * a[0] * share,
                     np.fmin(a[3], b[3]), np.maximum(a[4], b[4])])


def column_moments(df: DataFrame, cols: Sequence[str]) -> tuple[int, dict[str, dict]]:
    """Rows, and for each column its known rows (``n``) and, of numbers and
    flags, ``mean``, ``m2`` (sum of squared deviations), ``low`` and ``high``: one pass.

    A task reduces its rows to one row per column, Arrow batch by Arrow batch; hundreds
    of aggregates in one expression are beyond what Spark compiles. The tasks' rows are
    added up around the mean of the means."""
    kinds = dict(df.dtypes)
    known = [_as_double(c) if is_number(kinds[c]) else F.when(F.col(f"`{c}`").isNotNull(), 0.0) for c in cols]
    wide = df.select(F.lit(0.0).alias("rows"), *[v.alias(f"c{i}") for i, v in enumerate(known)])
    width = len(wide.columns)
    parts = wide.mapInArrow(lambda it: _batch_moments(it, width), "at int, n double, mean double, m2 double, low double, high double")
    each = parts.where("n > 0").withColumn("base", F.avg("mean").over(Window.partitionBy("at"))).withColumn("d", F.col("mean") - F.col("base"))
    sums = each.groupBy("at").agg(F.sum("n").alias("n"), F.first("base").alias("base"), F.sum(F.expr("n * d")).alias("nd"),
                                  F.sum(F.expr("n * d * d")).alias("ndd"), F.sum("m2").alias("m2"), F.min("low").alias("low"), F.max("high").alias("high"))
    found = {r["at"]: r for r in sums.collect()}  # one row per column
    out = {}
    for i, c in enumerate(cols, 1):
        r = found.get(i)
        out[c] = {"n": int(r["n"]) if r else 0}
        if r and is_number(kinds[c]):
            shift = r["nd"] / r["n"]
            m2 = r["m2"] + r["ndd"] - r["nd"] * shift
            out[c] |= {"mean": r["base"] + shift, "m2": 0.0 if m2 < 0 else m2, "low": r["low"], "high": r["high"]}
    return int(found[0]["n"]) if found else 0, out


def modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """Most frequent known value of each column, the smallest on ties: one pass
    for numbers and flags together (as doubles), one for each other type."""
    kinds, classes = dict(df.dtypes), {}
    for c in cols:
        classes.setdefault("double" if is_number(kinds[c]) else kinds[c], []).append(c)
    out = {}
    for kind, names in classes.items():
        long = df.select(*[F.col(f"`{c}`").cast(kind).alias(str(i)) for i, c in enumerate(names)]).unpivot(
            [], [str(i) for i in range(len(names))], "feature", "value")
        counts = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
        out |= {names[int(r["feature"])]: r["mode"] for r in best.collect()}  # one row per column
    return out


def fit_constants(df: DataFrame, key: str, mean_cols: Sequence[str] | None = None, hints: Sequence[str] = MEAN_HINTS,
                  marker: str = "ft_") -> list[ColumnConstants]:
    """Constants of every column but the key, in the frame's order."""
    cols, kinds = [c for c in df.columns if c != key], dict(df.dtypes)
    if mean_cols is None:
        mean_cols = [c for c in cols if any(h in c for h in hints)]
    by_mean = {c for c in mean_cols if is_number(kinds[c])}
    rows, known = column_moments(df, cols)
    wanted = [c for c in cols if known[c]["n"] < rows and not (c in by_mean and known[c]["n"])]
    most = modes(df, wanted) if wanted else {}
    out = []
    for i, c in enumerate(cols):
        m, gaps = known[c], rows - known[c]["n"]
        value = m.get("mean") if c in by_mean else most.get(c) if gaps else None
        fill = None if value is None else repr(float(value)) if is_number(kinds[c]) else str(value)
        center = scale = None
        zero = False
        if "mean" in m:
            n, center, m2 = m["n"], m["mean"], m["m2"]
            low, high = m["low"], m["high"]
            if gaps and value is not None:
                v = float(value)
                center, m2 = (n * center + gaps * v) / rows, m2 + (center - v) ** 2 * n * gaps / rows
                low, high, n = min(low, v), max(high, v), rows
            zero = low == 0 and high == 0 and n == rows
            scale = math.sqrt(m2 / (n - 1)) if n > 1 else None
            if scale is not None and scale <= NO_SPREAD * abs(center):
                scale = 0.0
        if marker not in c:
            center = scale = None
        out.append(ColumnConstants(i, c, kinds[c], c in by_mean, fill, zero, center, scale))
    return out


def filled(c: ColumnConstants) -> Column:
    """The column with its nulls filled; a mean makes it a double."""
    kind = "double" if c.by_mean else c.type
    col = F.col(f"`{c.name}`").cast(kind)
    if c.fill is None:
        return col
    value = F.lit(float(c.fill)) if is_number(c.type) else F.lit(c.fill)
    return F.coalesce(col, value.cast(kind))


class _SetParams(Params):
    keyCol = Param(Params._dummy(), "keyCol", "entity column, passed through", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column, kept beside the scaled features", TypeConverters.toString)
    marker = Param(Params._dummy(), "marker", "text in the names of the features that are scaled", TypeConverters.toString)
    meanHints = Param(Params._dummy(), "meanHints", "texts in the names of the columns filled by their mean", TypeConverters.toListString)
    scaled = Param(Params._dummy(), "scaled", "whether transform() gives z-scores or the filled values", TypeConverters.toBoolean)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(keyCol="hadm_id", labelCol="hcc_cd_135", marker="ft_", meanHints=list(MEAN_HINTS), scaled=True)


class ModelSetPreprocessor(Estimator, _SetParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the constants of a frame; ``fit`` returns a :class:`PreprocessModel`."""

    @keyword_only
    def __init__(self, *, keyCol="hadm_id", labelCol="hcc_cd_135", marker="ft_", meanHints=MEAN_HINTS, scaled=True):
        super().__init__()
        self._set(**{k: list(v) if isinstance(v, tuple) else v for k, v in self._input_kwargs.items()})

    def _fit(self, dataset: DataFrame) -> "PreprocessModel":
        constants = fit_constants(dataset, self.getOrDefault("keyCol"), hints=self.getOrDefault("meanHints"),
                                  marker=self.getOrDefault("marker"))
        return self._copyValues(PreprocessModel(constants))


class PreprocessModel(Model, _SetParams, MLWritable, MLReadable):
    """Fitted constants; ``transform`` is a projection with literals."""

    def __init__(self, constants: Sequence[ColumnConstants] = ()):
        super().__init__()
        self.constants = list(constants)

    def with_scaled(self, scaled: bool) -> "PreprocessModel":
        return self.copy({self.scaled: scaled})

    def copy(self, extra=None):
        that = super().copy(extra)
        that.constants = self.constants
        return that

    def feature_names(self) -> list[str]:
        """The features that are kept, in order."""
        return [c.name for c in self.constants if self.getOrDefault("marker") in c.name and not c.all_zero]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key, label = self.getOrDefault("keyCol"), self.getOrDefault("labelCol")
        kept = [c for c in self.constants if not c.all_zero]
        if not self.getOrDefault("scaled"):
            return dataset.select(F.col(key), *[filled(c).alias(c.name) for c in kept])
        out = [F.col(key)]
        for c in kept:
            if c.name == label:
                out.append(filled(c).alias(label))
            elif self.getOrDefault("marker") in c.name:
                z = (filled(c).cast("double") - F.lit(c.center)) / F.lit(c.scale) if c.scale else F.lit(None).cast("double")
                out.append(z.alias(c.name))
        return dataset.select(*out)

    def table(self, spark) -> DataFrame:
        """The constants, one row per column."""
        return spark.createDataFrame([tuple(vars(c).values()) for c in self.constants], CONSTANTS)

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)


class _ModelWriter(MLWriter):
    def __init__(self, instance: PreprocessModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table(self.sparkSession).coalesce(1).write.parquet(f"{path}/constants")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> PreprocessModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows = self.sparkSession.read.parquet(f"{path}/constants").orderBy("position").collect()  # one per column
        model = self.cls([ColumnConstants(**r.asDict()) for r in rows])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
