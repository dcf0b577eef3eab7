"""Aggregations to the entity grain and column reports."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortforge.functions import flag
from cohortforge.session import scratch_path

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def discover_values(df: DataFrame, col: str | Column) -> list:
    """Sorted distinct non-null values of a category column (one small job).
    They become columns, so this is for category domains; ``onehot_long`` has
    the same content for any number of values."""
    c = F.col(col) if isinstance(col, str) else col
    return [r[0] for r in df.select(c.alias("v")).where(F.col("v").isNotNull()).distinct().orderBy("v").collect()]


def onehot_long(df: DataFrame, keys: str | Sequence[str], col: str | Column, prefix: str) -> DataFrame:
    """The ones of a one-hot encoding, (keys, feature, 1): a row per key and
    value that occurs, with no limit to the number of values."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    c = F.col(col) if isinstance(col, str) else col
    named = df.where(_not_null(keys)).select(*keys, c.cast("string").alias("__v")).where(F.col("__v").isNotNull())
    return named.select(*keys, F.concat(F.lit(f"{prefix}_"), F.col("__v")).alias("feature"), F.lit(1).alias("value")).distinct()


def category_places(df: DataFrame, col: str) -> DataFrame:
    """(value, place) of the distinct non-null values, places from 0 in their order,
    for any number of values: they are sorted by range, and one count per range
    gives the ranges their offsets. Nothing is collected."""
    path = scratch_path(df.sparkSession, f"places-{uuid.uuid4().hex}")
    values = df.select(F.col(col).alias("value")).where(F.col("value").isNotNull()).distinct()
    values.repartitionByRange("value").sortWithinPartitions("value").select(
        "value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row")).write.parquet(path)
    values = df.sparkSession.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = values.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return values.join(F.broadcast(offsets), "part").select("value", (F.col("base") + F.col("row")).alias("place"))


def onehot_sparse(df: DataFrame, keys: str | Sequence[str], col: str, places: DataFrame | None = None) -> DataFrame:
    """One-hot encoding as one sparse vector per key: ``size`` (number of values),
    ``indices`` (ascending places of the values that occur, see
    :func:`category_places`); a key without any value has no index. Serves domains
    that are too large for a column per value; a row holds what occurs of its key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    places = category_places(df, col) if places is None else places
    size = places.count()
    rows = df.where(_not_null(keys)).select(*keys, F.col(col).alias("value")).distinct().join(places, "value", "left")
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.col("place").cast("int"))).alias("indices")).select(
        *keys, F.lit(size).cast("long").alias("size"), "indices")


def to_vectors(sparse: DataFrame, name: str = "vector") -> DataFrame:
    """The same rows with MLlib sparse vectors of ones in place of size and indices."""
    from pyspark.ml.linalg import SparseVector, VectorUDT
    vector = F.udf(lambda n, at: SparseVector(n, at, [1.0] * len(at)), VectorUDT())
    return sparse.withColumn(name, vector("size", "indices")).drop("size", "indices")


def packed_or(flags: Sequence[str], name: str, bits: int = 62) -> list[Column]:
    """Maxima of two-valued, non-null flag columns as a few numbers ``name0``, ``name1``,
    ...: one bit per flag, so that a group holds eight bytes for every ``bits`` flags
    instead of eight for each."""
    out = []
    for n, at in enumerate(range(0, len(flags), bits)):
        terms = [F.when(F.col(f"`{c}`"), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(flags[at:at + bits])]
        out.append(F.bit_or(sum(terms[1:], terms[0])).alias(f"{name}{n}"))
    return out


def unpacked(flags: Sequence[str], name: str, as_bool: bool = False, bits: int = 62) -> list[Column]:
    """The flags that :func:`packed_or` has packed, as 0/1 or as booleans."""
    out = []
    for i, c in enumerate(flags):
        on = F.getbit(F.col(f"{name}{i // bits}"), F.lit(i % bits))
        out.append(((on == 1) if as_bool else on.cast("int")).alias(c))
    return out


def onehot_max_exprs(col: Column, values: Sequence, prefix: str) -> list[Column]:
    """0/1 indicator per value, maxed per group: a null or unlisted value gives
    all zeros, exactly like a dummy row."""
    return [F.max(flag(col == F.lit(v))).alias(f"{prefix}_{v}") for v in values]


def onehot_max(df: DataFrame, keys: str | Sequence[str], col: str | Column, prefix: str,
               values: Sequence | None = None) -> DataFrame:
    """One-hot encode ``col`` and keep the max per key (``groupBy().pivot()``
    with explicit values, written as conditional max in one aggregation)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    c = F.col(col) if isinstance(col, str) else col
    if values is None:
        values = discover_values(df, c)
    return df.where(_not_null(keys)).groupBy(*keys).agg(*onehot_max_exprs(c, values, prefix)) if values else \
        df.where(_not_null(keys)).select(*keys).distinct()


def value_counts(df: DataFrame, col: str, count_name: str = "n") -> DataFrame:
    """Frequency of each non-null value (order by count desc when displayed)."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(count_name))


def value_share(df: DataFrame, col: str, share_name: str = "share") -> DataFrame:
    """Normalised value counts. The total is one scalar aggregate; the per-value
    table is never moved to one task."""
    counts = value_counts(df, col, "n")
    total = df.where(F.col(col).isNotNull()).agg(F.count(F.lit(1))).first()[0] or 0
    return counts.select(col, "n", (F.col("n") / F.lit(float(total) if total else None)).alias(share_name))


def unpivot_features(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Long form (ids..., feature, value) with values cast to double."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(ids), list(cols), "feature", "value")


def exact_quantiles(long: DataFrame, probabilities: Mapping[str, float], group: str = "feature",
                    value: str = "value") -> DataFrame:
    """Quantiles per group with linear interpolation between the two
    neighbouring ranks, exact at every size; nulls are left out.

    Equal values are counted first. The distinct values are sorted by range,
    each range gets its offset from a table of one row per (range, group), and
    only the values that hold a wanted rank are kept: no group is gathered."""
    counts = long.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("g"), F.col(value).alias("v")).agg(
        F.count(F.lit(1)).alias("n"))
    path = scratch_path(long.sparkSession, f"quantiles-{uuid.uuid4().hex}")
    counts.repartitionByRange("g", "v").withColumn("part", F.spark_partition_id()).write.parquet(path)
    counts = long.sparkSession.read.parquet(path)
    sums = counts.groupBy("g", "part").agg(F.sum("n").alias("s"))
    by_part = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("g", "part", F.coalesce(F.sum("s").over(by_part), F.lit(0)).alias("base"),
                       F.sum("s").over(Window.partitionBy("g")).alias("total"))
    inside = Window.partitionBy("part", "g").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("low", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(sums, ["g", "part"])
    first = F.col("base") + F.col("low")
    aggs = []
    for name, p in probabilities.items():
        at = F.lit(float(p)) * (F.col("total") - 1)
        holds = lambda r: (r >= first) & (r < first + F.col("n"))
        low, high = F.max(F.when(holds(F.floor(at)), F.col("v"))), F.max(F.when(holds(F.ceil(at)), F.col("v")))
        share = F.lit(float(p)) * (F.max("total") - 1)
        aggs.append((low + (high - low) * (share - F.floor(share))).alias(name))
    return ranked.groupBy(F.col("g").alias(group)).agg(*aggs)


def profile_columns(df: DataFrame, cols: Sequence[str], quartiles: bool = True, with_sum: bool = True) -> DataFrame:
    """Per-column count, mean, sample std, min, quartiles, max (and sum): the
    transposed ``describe``. Quartiles are exact and linearly interpolated."""
    long = unpivot_features(df, cols)
    aggs = [F.count("value").alias("count"), F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"), F.min("value").alias("min")]
    out = ["feature", "count", "mean", "std", "min", *(["p25", "p50", "p75"] if quartiles else []), "max"]
    aggs.append(F.max("value").alias("max"))
    if with_sum:
        aggs.append(F.sum("value").alias("sum"))
        out.append("sum")
    base = long.groupBy("feature").agg(*aggs)
    if quartiles:
        found = exact_quantiles(long, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
        base = base.join(found, "feature", "left")
    return base.select(*out)


def column_means(df: DataFrame, cols: Sequence[str]) -> dict:
    if not cols:
        return {}
    row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return row.asDict()


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """Most frequent non-null value per column, smallest on ties, in the
    column's own type. One aggregation job per type class over the long form,
    so a wide frame costs one shuffle for each."""
    kinds: dict[str, list[str]] = {}
    for c in cols:
        t = dict(df.dtypes)[c]
        kinds.setdefault("double" if t in _NUMBERS or t.startswith("decimal") else t, []).append(c)
    out = {}
    for kind, names in kinds.items():
        long = df.select(*[F.col(c).cast(kind).alias(c) for c in names]).unpivot([], names, "feature", "value")
        counts = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
        out.update({r["feature"]: r["mode"] for r in best.collect()})
    return out


def null_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns holding at least one null (one pass)."""
    if not cols:
        return []
    row = df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] == 1]


def all_zero_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns whose every value equals 0 or false (a null is not 0; text and
    time columns are never all zero)."""
    types = dict(df.dtypes)
    cols = [c for c in cols if types[c] in _NUMBERS or types[c] == "boolean" or types[c].startswith("decimal")]
    if not cols:
        return []
    row = df.agg(*[F.min(flag(F.col(c).cast("double") == 0)).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] == 1]
