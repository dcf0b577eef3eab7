"""Order-dependent operators.

Where the result is a per-group pick (first row, de-duplication) it is an
aggregate (``min_by``) or the first rank, which Spark combines map-side, so a hot group
never lands whole in one task. Only genuinely sequential logic (previous row) uses
a window, partitioned by the entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_key(cols: Sequence[str | Column], nulls_last: bool = True) -> Column:
    """A struct that sorts like ``ORDER BY cols ASC NULLS LAST``: each column
    is preceded by an is-null marker."""
    parts = []
    for i, c in enumerate(cols):
        col = F.col(c) if isinstance(c, str) else c
        if nulls_last:
            parts.append(col.isNull().alias(f"n{i}"))
        parts.append(col.alias(f"v{i}"))
    return F.struct(*parts)


def dedupe_first(df: DataFrame, keys: Sequence[str], order: str | Column) -> DataFrame:
    """Keep one row per key combination: the first in ``order`` (file order).
    Null keys form one group each, as in a drop-duplicates; rows without an
    order come last.

    Spark limits the ranks on both sides of the shuffle, so a task sends one row of a
    group, however large that is; the order is only compared inside a group."""
    o = F.col(order) if isinstance(order, str) else order
    w = Window.partitionBy(*keys).orderBy(o.asc_nulls_last())
    rest = [c for c in df.columns if c not in keys]
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).select(*keys, *rest)


def first_n_in_order(df: DataFrame, group: str, order: str, n: int, sub_ranges: int = 64) -> DataFrame:
    """First ``n`` rows of each group in ``order`` without a whole-group window.

    The leading field of the order key (the key itself if it is not a struct)
    is cut into value ranges at quantiles from a sketch; ranges are monotone
    in the full order. Counts per (group, range) form a small table whose
    running sums give each range its offset inside the group; ranges that
    start beyond ``n`` are dropped unread, and rows are ranked only inside
    their (group, range). A hot group is thus spread over many tasks."""
    from pyspark.sql.types import StructType
    dt = df.schema[order].dataType
    lead = F.col(f"{order}.{dt.fields[0].name}") if isinstance(dt, StructType) else F.col(order)
    probe = df.select(lead.cast("double").alias("__v"))
    bounds = sorted(set(b for b in probe.approxQuantile("__v", [i / sub_ranges for i in range(1, sub_ranges)], 0.001)
                        if b is not None))
    rng = F.lit(0)
    for i, b in enumerate(bounds):
        rng = F.when(lead.cast("double") > F.lit(b), F.lit(i + 1)).otherwise(rng)
    r = df.withColumn("__r", rng)
    counts = r.groupBy(group, "__r").agg(F.count(F.lit(1)).alias("__c"))
    wc = Window.partitionBy(group).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(group, "__r", F.coalesce(F.sum("__c").over(wc), F.lit(0)).alias("__off")) \
        .where(F.col("__off") < n)
    j = r.join(offs, [group, "__r"], "inner")
    w = Window.partitionBy(group, "__r").orderBy(F.col(order))
    return (j.withColumn("__rn", F.row_number().over(w) + F.col("__off")).where(F.col("__rn") <= n)
            .drop("__rn", "__r", "__off"))


# ----------------------------------------------------------------------------
# Two-level order operators: a hot entity is split by time bucket.
#
# A window partitioned by the entity alone puts all of a hot entity's rows in
# one task. Here the window runs per (entity, bucket) where the bucket is a
# fixed-width time slot that is monotone in the order; what crosses bucket
# borders is carried by a per-(entity, bucket) summary (an aggregate, combined
# map-side) and a window over those summaries, whose length per entity is
# bounded by the calendar (number of slots spanned), not by the data volume.
#
# Only entities of more than ``hot_rows`` rows need this. All others have one bucket:
# their rows are shuffled once, and no summaries are made or joined for them.
#
# A slot that alone holds more than ``hot_rows`` rows of one entity is cut
# further, by the second inside the slot (``second_of_slot``) and by ranges of the
# tie-break, so that rows of one instant or without a time are cut too: such slots are
# found by a count per (entity, slot), a table of at most rows / hot_rows
# entries (combined map-side, so a hot slot is counted in many tasks). The finer bucket is still
# monotone in the order, so the same two-level scheme applies unchanged.
# ----------------------------------------------------------------------------
NULL_BUCKET = 1 << 62
HOT_SLOT_ROWS = 1_000_000


def hour_bucket(t: Column, hours: int = 1) -> Column:
    """Slot of ``hours`` width of a timestamp_ntz (zone independent); null
    time -> a sentinel after every real slot, so null times sort last."""
    slot = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint") * 24 + F.hour(t)
    if hours != 1:
        slot = F.floor(slot / F.lit(hours)).cast("bigint")
    return F.coalesce(slot, F.lit(NULL_BUCKET).cast("bigint"))


def second_of_slot(t: Column, hours: int = 1) -> tuple[Column, int]:
    """Second inside the ``hours``-wide slot of ``hour_bucket`` (zone
    independent), and the number of seconds in a slot."""
    secs = (F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
            + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t))
    width = hours * 3600
    return F.coalesce(F.pmod(secs, F.lit(width)), F.lit(0)).cast("bigint"), width


MAX_TIE_RANGES = 4096
BUCKET = ["__b", "__t"]


def tie_fields(df: DataFrame, column: str) -> list[Column]:
    """The numeric fields that lead a tie-break column (the column itself, or the
    fields of a struct up to the first that is not numeric), as doubles."""
    from pyspark.sql.types import NumericType, StructType
    kind, out = df.schema[column].dataType, []
    fields = [(F.col(f"{column}.{f.name}"), f.dataType) for f in kind.fields] if isinstance(kind, StructType) else [(F.col(column), kind)]
    for col, t in fields:
        if not isinstance(t, NumericType):
            break
        out.append(col.cast("double"))
    return out


def _with_bucket(df: DataFrame, key: str, bucket: Column, split: tuple[Column, int] | None, hot_rows: int,
                 ties: Sequence[Column] = (), most: Column | None = None) -> DataFrame:
    """``df`` with the bucket columns ``__b`` and ``__t``, together non-decreasing in
    the order within an entity, and ``__big``: whether the entity is bucketed at all.

    Entities of at most ``hot_rows`` rows are one bucket. ``most`` bounds the rows of a
    row's entity; without it they are counted, and the table of the larger ones,
    of at most rows / hot_rows entries, is broadcast. Rows without an entity keep
    their buckets. Slots of an entity holding more than ``hot_rows``
    rows (rows without a time are one slot) are refined by ``split`` = (sub-slot,
    sub-slots per slot), and by ranges of the tie-break, which cut rows of one second
    or of no time.

    The ranges have one width, from the least and largest value in the slot of the
    first of the ``ties`` that varies there; all before it are constant in the slot,
    so the ranges follow the order. They come with the count of the slot."""
    if most is None:
        big = (df.groupBy(F.col(key).alias("__e")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > F.lit(hot_rows))
               .select("__e", F.lit(True).alias("__big")))
        d = df.join(F.broadcast(big), F.col(key) == F.col("__e"), "left").drop("__e")
        d = d.withColumn("__big", F.coalesce("__big", F.lit(False)) | F.col(key).isNull())
    else:
        d = df.withColumn("__big", F.coalesce(most > F.lit(hot_rows), F.lit(True)) | F.col(key).isNull())
    d = d.withColumn("__b", F.when(F.col("__big"), bucket).otherwise(F.lit(0))).withColumn("__t", F.lit(0))
    if split is None:
        return d
    fine, width = split
    ties = list(ties)
    lows = [x for i, c in enumerate(ties) for x in (F.min(c).alias(f"__l{i}"), F.max(c).alias(f"__g{i}"), F.count(c).alias(f"__c{i}"))]
    hot = (d.where(F.col("__big")).groupBy(key, "__b").agg(F.count(F.lit(1)).alias("__n"), *lows).where(F.col("__n") > F.lit(hot_rows))
           .withColumn("__hot", F.lit(1)))
    d = d.join(F.broadcast(hot), [key, "__b"], "left")  # at most rows / hot_rows entries
    no_time = F.col("__b") == F.lit(NULL_BUCKET)
    refined = F.col("__b") * F.lit(width) + F.when(F.col("__hot") == 1, fine).otherwise(F.lit(0))
    ranges = F.least(F.ceil(F.col("__n") / F.lit(hot_rows)), F.lit(MAX_TIE_RANGES))
    part = F.lit(0)
    for i in reversed(range(len(ties))):
        usable = F.col(f"__c{i}") == F.col("__n")
        place = F.floor((ties[i] - F.col(f"__l{i}")) / (F.col(f"__g{i}") - F.col(f"__l{i}")) * ranges)
        part = F.when(~usable, 0).when(F.col(f"__g{i}") > F.col(f"__l{i}"), F.least(place, ranges - 1)).otherwise(part)
    return d.withColumns({"__b": F.when(no_time, F.col("__b")).otherwise(refined),
                          "__t": F.when(F.col("__hot") == 1, part).otherwise(0).cast("int")}).drop(
        "__hot", "__n", *[f"__{x}{i}" for i in range(len(ties)) for x in "lgc"])


def previous_values(df: DataFrame, key: str, bucket: Column, order_cols: Sequence[Column],
                    cols: Sequence[str], prefix: str = "prev_", split: tuple[Column, int] | None = None,
                    hot_rows: int = HOT_SLOT_ROWS, ties: Sequence[Column] = (), most: Column | None = None) -> DataFrame:
    """Previous row's values per entity in ``order_cols`` (nulls last); the
    first row of an entity takes its own values. ``bucket`` must be
    non-decreasing in that order within an entity, and so must ``split``'s
    sub-slot within a slot, and ``ties`` be the numbers that decide the order of rows
    of one instant or none (see ``_with_bucket``)."""
    ordered = [c.asc_nulls_last() for c in order_cols]
    d = _with_bucket(df, key, bucket, split, hot_rows, ties, most)
    w = Window.partitionBy(key, *BUCKET).orderBy(*ordered)
    inner = d.select("*", F.row_number().over(w).alias("__rn"),
                     *[F.lag(c).over(w).alias(f"__lag_{c}") for c in cols])
    last = d.where(F.col("__big")).groupBy(key, *BUCKET).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order_key(order_cols))
                                     .alias("__last"))
    wb = Window.partitionBy(key).orderBy(*BUCKET)
    prevb = last.select(key, *BUCKET, F.lag("__last").over(wb).alias("__pl"))
    j = inner.join(prevb, [key, *BUCKET], "left")
    out = j.select("*", *[F.when(F.col("__rn") > 1, F.col(f"__lag_{c}"))
                          .when(F.col("__pl").isNotNull(), F.col(f"__pl.{c}"))
                          .otherwise(F.col(c)).alias(prefix + c) for c in cols])
    return out.drop(*BUCKET, "__big", "__rn", "__pl", *[f"__lag_{c}" for c in cols])


def running_aggregates(df: DataFrame, key: str, bucket: Column, order_cols: Sequence[Column],
                       sums: dict, maxes: dict, split: tuple[Column, int] | None = None,
                       hot_rows: int = HOT_SLOT_ROWS, ties: Sequence[Column] = (), most: Column | None = None) -> DataFrame:
    """Running (inclusive prefix) sums and maxima per entity in
    ``order_cols``: {output name: Column}. Prefix of earlier buckets from the
    bucket summaries, plus the running value inside the row's bucket."""
    ordered = [c.asc_nulls_last() for c in order_cols]
    d = _with_bucket(df, key, bucket, split, hot_rows, ties, most)
    w = (Window.partitionBy(key, *BUCKET).orderBy(*ordered)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = d.select("*", *[F.sum(c).over(w).alias(f"__is_{n}") for n, c in sums.items()],
                     *[F.max(c).over(w).alias(f"__im_{n}") for n, c in maxes.items()])
    tot = d.where(F.col("__big")).groupBy(key, *BUCKET).agg(*[F.sum(c).alias(f"__ts_{n}") for n, c in sums.items()],
                                    *[F.max(c).alias(f"__tm_{n}") for n, c in maxes.items()])
    wb = Window.partitionBy(key).orderBy(*BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    before = tot.select(key, *BUCKET, *[F.sum(f"__ts_{n}").over(wb).alias(f"__bs_{n}") for n in sums],
                        *[F.max(f"__tm_{n}").over(wb).alias(f"__bm_{n}") for n in maxes])
    j = inner.join(before, [key, *BUCKET], "left")
    out = j.select("*", *[(F.coalesce(F.col(f"__bs_{n}"), F.lit(0)) + F.coalesce(F.col(f"__is_{n}"), F.lit(0)))
                          .alias(n) for n in sums],
                   *[F.greatest(F.col(f"__bm_{n}"), F.col(f"__im_{n}")).alias(n) for n in maxes])
    drop = [*BUCKET, "__big"] + [f"__{p}_{n}" for n in sums for p in ("is", "bs")] + \
        [f"__{p}_{n}" for n in maxes for p in ("im", "bm")]
    return out.drop(*drop)
