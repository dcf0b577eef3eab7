"""Joins: dictionary lookups, match statistics, the one-shuffle feature merge."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.session import materialize

# A side is broadcast only when the optimizer's size estimate is below this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan (file sizes for scans)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # pragma: no cover - e.g. Spark Connect
        return 1 << 62
    # py4j hands a scala BigInt over either as a Python int or as an object
    return int(size) if isinstance(size, int) else int(size.toString())


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint only where Catalyst's estimate of the size is within the
    limit; otherwise AQE decides at run time from real shuffle sizes. No job runs here."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


class MergeValidationError(ValueError):
    pass


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """m:1 check: fails if a dictionary key repeats. One aggregation job; only
    a single offending key ever reaches the driver."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise MergeValidationError(f"key {list(keys)} is not unique, e.g. {dup[0].asDict()}")


def lookup_join(df: DataFrame, dim: DataFrame, left_on: str | Sequence[str], right_on: str | Sequence[str] | None = None,
                how: str = "left", indicator: str | None = None, validate_m1: bool = False,
                drop_right_keys: bool = False) -> DataFrame:
    """Left join of events to a dimension table.

    ``indicator`` adds a column with 'both' / 'left_only'. ``validate_m1``
    raises if the dimension key repeats. The dimension is broadcast only when
    its estimated size is small."""
    lk = [left_on] if isinstance(left_on, str) else list(left_on)
    rk = lk if right_on is None else ([right_on] if isinstance(right_on, str) else list(right_on))
    if validate_m1:
        assert_unique(dim, rk)
    marker = "__matched"
    d = dim.withColumn(marker, F.lit(True)) if indicator else dim
    d = broadcast_if_small(d)
    if lk == rk:
        out = df.join(d, on=lk, how=how)
    else:
        cond = [df[a] == d[b] for a, b in zip(lk, rk)]
        out = df.join(d, cond, how)
        if drop_right_keys:
            out = out.drop(*[d[b] for b in rk])
    if indicator:
        out = out.withColumn(indicator, F.when(F.col(marker), F.lit("both")).otherwise(F.lit("left_only"))).drop(marker)
    return out


def match_statistics(joined: DataFrame, indicator: str) -> DataFrame:
    """Counts of matched / unmatched rows after ``lookup_join``."""
    return joined.groupBy(indicator).agg(F.count(F.lit(1)).alias("n"))


def merge_features(frames: Iterable[DataFrame], key: str = "hadm_id", how: str = "union",
                   spine: DataFrame | None = None, write: bool = False) -> DataFrame:
    """N-way full outer merge of feature frames on the entity key.

    ``union`` (default): each frame's columns as one struct, the frames' rows
    united and shuffled once by key, and each struct picked per key (chained full joins
    would re-shuffle the growing result once per frame). A row holds its own
    frame's values and one null per other frame, not one per other column. Where a
    key repeats in a frame, the columns' maxima are taken first; frames grouped by
    key need no shuffle for that. With ``write`` each frame is written first, one after
    the other, and the union reads the written rows: the shuffles of one frame or of the
    merge are on disk at a time, not those of all.

    ``spine``: left-join every frame to a key spine (given, or the distinct
    keys of all frames). Left joins keep the spine's hash partitioning and
    ``groupBy(key)`` frames are already partitioned alike, so the chain adds
    no exchange; worth it when a cheap spine of all keys exists."""
    frames = list(frames)
    if how == "union":
        places: dict[str, list] = {}
        u = None
        for i, f in enumerate(frames):
            cols = [c for c in f.columns if c != key]
            per = f.groupBy(key).agg(*[F.max(f"`{c}`").alias(f"c{j}") for j, c in enumerate(cols)])
            per = per.select(key, F.struct(F.lit(True).alias("here"), *[f"c{j}" for j in range(len(cols))]).alias(f"__f{i}"))
            if write:
                per = materialize(per, f"merge-frame-{i}")
            u = per if u is None else u.unionByName(per, allowMissingColumns=True)
            for j, c in enumerate(cols):
                places.setdefault(c, []).append(F.col(f"__f{i}.c{j}"))
        picked = u.repartition(key).groupBy(key).agg(*[F.first(f"__f{i}", ignorenulls=True).alias(f"__f{i}") for i in range(len(frames))])
        return picked.select(key, *[(p[0] if len(p) == 1 else F.greatest(*p)).alias(c) for c, p in places.items()])
    if spine is None:
        keys = frames[0].select(key)
        for f in frames[1:]:
            keys = keys.union(f.select(key))
        spine = keys
    out = spine.select(key).where(F.col(key).isNotNull()).distinct()
    seen = {key}
    for f in frames:
        dup = [c for c in f.columns if c in seen and c != key]
        if dup:
            f = f.drop(*dup)
        seen.update(f.columns)
        out = out.join(f, key, "left")
    return out


def anti_lookup(df: DataFrame, dim: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Rows whose code has no entry in the dimension."""
    d = broadcast_if_small(dim.select(F.col(right_on).alias("__k")).distinct())
    return df.join(d, df[left_on] == d["__k"], "left_anti")
