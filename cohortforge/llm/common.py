"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortforge.session import scratch_path

WHITE = r"[\x20\x09-\x0D]+"


def text_of(col: Column | str) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ws_words(col: Column | str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null and blank texts have none."""
    return F.array_remove(F.split(text_of(col), WHITE), "")


def n_ws_words(col: Column | str) -> Column:
    """Number of white-space separated words (long)."""
    return F.size(ws_words(col)).cast("long")


def new_scratch(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, in the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet into the shared folder and read it back: it is
    computed once, its lineage is cut and it survives lost executors."""
    path = new_scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not use (names are case-insensitive)."""
    used, name = {c.lower() for c in df.columns}, base
    while name.lower() in used:
        name += "_"
    return name


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Like ``materialize``; the shuffle files of the job that wrote the table go
    with it, since nothing reads them again."""
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        return materialize(df, name)
    finally:
        spark.conf.set(key, before)


def discard(*tables: DataFrame) -> None:
    """Removes scratch tables that no later frame reads; others than those in the
    scratch folder stay."""
    for t in tables:
        spark = t.sparkSession
        base = scratch_path(spark, "")
        for folder in {f.rpartition("/")[0] for f in t.inputFiles()}:
            if base.split(":")[-1].strip("/") in folder:
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """The frame, written, with ``i``, the place of a row within its key (from 0),
    and ``n``, the rows of the key (null is a key). Rows are range-partitioned by
    key and order, so a key with many rows fills many tasks; only one row per
    key and partition is summed up along the partitions."""
    part, row, first, count, shift = (fresh_name(df, x) for x in ("_part", "_row", "_first", "_count", "_shift"))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(k).asc_nulls_first() for k in keys] + order
    rows = write_once(df.repartitionByRange(tasks, *by).sortWithinPartitions(*by).select(
        "*", F.spark_partition_id().alias(part),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias(row)), name)
    per = rows.groupBy(part, *keys).agg(F.min(row).alias(first), F.count("*").alias(count))
    own = Window.partitionBy(*keys)
    before = F.sum(count).over(own.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    own_keys = [fresh_name(df, f"_key{at}") for at in range(len(keys))]
    per = per.select(F.col(part).alias(f"{part}_"), *(F.col(k).alias(o) for k, o in zip(keys, own_keys)),
                     (F.coalesce(before, F.lit(0)) - F.col(first)).alias(shift), F.sum(count).over(own).alias("n"))
    same = F.col(part) == F.col(f"{part}_")
    for k, o in zip(keys, own_keys):
        same = same & F.col(k).eqNullSafe(F.col(o))
    return rows.join(per, same).select(*df.columns, (F.col(row) + F.col(shift)).alias("i"), "n")
