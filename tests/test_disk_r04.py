"""What a job leaves on disk while it runs: written steps, one shuffle per window."""

import datetime as dt
import time

from pyspark.sql import functions as F

from cohortforge.operators import features as fx
from cohortforge.operators.joins import merge_features
from cohortforge.operators.windows import _with_bucket, hour_bucket, previous_values
from cohortforge.session import discard, materialize

T0 = dt.datetime(2020, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {x.rpartition("/")[2] for x in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}


def test_written_steps_take_their_shuffle_files_along(spark):
    before = shuffle_files(spark)
    kept = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "cleanup-test")
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and kept.count() == 7
    folder = kept.inputFiles()[0].rpartition("/")[0]
    discard(kept)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_written_merge_reads_the_frames_and_equals_the_lazy_one(spark):
    a = spark.createDataFrame([(1, 1, 5), (1, 2, None), (None, 3, 4)], "hadm_id long, x int, both int")
    b = spark.createDataFrame([(1, 9.5, 7), (2, None, None)], "hadm_id long, y double, both int")
    lazy, written = merge_features([a, b]), merge_features([a, b], write=True)
    assert written.schema == lazy.schema
    assert plan(written).count("Exchange") == 1 and "parquet" in plan(written)  # before it runs: the merge's shuffle only
    assert sorted(map(str, written.collect())) == sorted(map(str, lazy.collect()))


def test_only_large_entities_are_cut_into_buckets(spark):
    rows = [(k, T0 + dt.timedelta(hours=3 * i)) for k, n in ((1, 3), (2, 6), (None, 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz")
    counted = _with_bucket(df, "k", hour_bucket(F.col("t")), None, 3)
    bounded = _with_bucket(df.withColumn("n", F.when(F.col("k") == 2, 6).otherwise(3)), "k", hour_bucket(F.col("t")), None, 3, most=F.col("n"))
    for d in (counted, bounded):
        assert {r["k"]: r["n"] for r in d.groupBy("k").agg(F.countDistinct("__b", "__t").alias("n")).collect()} == {1: 1, 2: 6, None: 2}


def test_previous_values_shuffle_the_rows_once(spark):
    rows = [(k, T0 + dt.timedelta(hours=5 * i), float(10 * k + i)) for k in range(4) for i in range(3)]
    df = materialize(spark.createDataFrame(rows, "k long, t timestamp_ntz, v double"), "previous-test")
    out = previous_values(df, "k", hour_bucket(F.col("t")), [F.col("t")], ["v"])
    assert {(r["k"], r["v"]): r["prev_v"] for r in out.collect()} == {
        (k, 10.0 * k + i): 10.0 * k + max(i - 1, 0) for k in range(4) for i in range(3)}
    assert set(out.columns) == {"k", "t", "v", "prev_v"}


def test_audit_computes_the_changes_once(spark):
    rows = [(1, T0, 1.0, 1), (1, T0 + dt.timedelta(hours=5), 1.6, 2), (2, T0, 1.0, 3), (2, T0 + dt.timedelta(hours=5), 1.1, 4)]
    ev = spark.createDataFrame([(*r, "creatinine") for r in rows], "hadm_id long, eventtime timestamp_ntz, valuenum double, row_order long, label string")
    out = fx.serial_change_audit(ev)
    assert "Window" not in plan(out)
    assert sorted((r["hadm_id"], r["valuenum"], r["baseline"]) for r in out.collect()) == [(1, 1.0, 1.0), (1, 1.6, 1.0)]
