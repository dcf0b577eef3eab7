"""What keeps a job's growth in line with its input: plans and numbers of batches."""

import datetime as dt

from pyspark.sql import functions as F

from cohortforge.operators import features as fx
from cohortforge.operators.aggregates import packed_or, unpacked
from cohortforge.operators.joins import merge_features
from cohortforge.operators.windows import dedupe_first


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stream_batches_do_not_follow_the_rows():
    from cohortforge.plans.queries import batch_files
    assert [-(-n // batch_files(n)) for n in (1, 4, 10, 64, 128)] == [1, 4, 4, 4, 4]
    assert batch_files(10_000) == 32  # a batch stays bounded


def test_packed_flags_over_several_numbers(spark):
    names = [f"f{i}" for i in range(45)]
    rows = [(k, *[(i * 7 + r) % (5 + k) == 0 for i in range(45)]) for k in (1, 2) for r in range(3)]
    df = spark.createDataFrame(rows, ["k", *names])
    got = df.groupBy("k").agg(*packed_or(names, "p", 20)).select("k", *unpacked(names, "p", bits=20))
    want = df.groupBy("k").agg(*[F.max(F.col(c).cast("int")).alias(c) for c in names])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_keyword_flags_hold_a_few_numbers_per_group(spark):
    words = [f"w{i:02d}" for i in range(40)]
    start = dt.datetime(2020, 1, 1)
    events = spark.createDataFrame([(1, 7, "W03 10mg", start), (1, 7, "w39", None), (2, 8, None, start)],
                                   "hadm_id long, subject_id long, drug string, startdate timestamp_ntz")
    adm = spark.createDataFrame([(1, 7, start), (2, 8, start)], "hadm_id long, subject_id long, admittime timestamp_ntz")
    out = fx.keyword_group_windows(events, adm, {"g": words}, (24, 48, 72))
    assert plan(out).count("max(") == 0
    row = {r["hadm_id"]: r.asDict() for r in out.collect()}
    assert {c for c, v in row[1].items() if v == 1 and c != "hadm_id"} == {
        "ft_any_nephrotoxin_rx", "ft_nephrotoxin_g_rx", "ft_nephrotoxin_w03_rx", "ft_nephrotoxin_w39_rx",
        *[f"{c}_within_{h}" for h in (24, 48, 72) for c in ("ft_any_nephrotoxin_rx", "ft_nephrotoxin_g_rx", "ft_nephrotoxin_w03_rx")]}
    assert set(v for c, v in row[2].items() if c != "hadm_id") == {0}


def test_merge_rows_hold_their_own_frame_only(spark):
    a = spark.createDataFrame([(1, 1, 5), (1, 2, None), (None, 3, 4)], "hadm_id long, x int, both int")
    b = spark.createDataFrame([(1, 9.5, 7), (2, None, None)], "hadm_id long, y double, both int")
    out = merge_features([a, b])
    assert out.columns == ["hadm_id", "x", "both", "y"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 2, 7, 9.5), (2, None, None, None), (None, 3, 4, None)], key=str)
    assert "first(__f0" in plan(out)


def test_dedupe_limits_ranks_before_the_shuffle(spark):
    rows = [(1, None, 3, "c"), (1, None, 2, "b"), (1, 5, None, "late"), (1, 5, 9, "first"), (None, 5, 1, "x"), (None, 5, 0, "y")]
    df = spark.createDataFrame(rows, "k long, t int, o int, v string")
    out = dedupe_first(df, ["k", "t"], "o")
    assert sorted((tuple(r) for r in out.select("k", "t", "v").collect()), key=str) == sorted([(1, None, "b"), (1, 5, "first"), (None, 5, "y")], key=str)
    assert "WindowGroupLimit" in plan(out)


def test_chart_feature_queries_write_their_readings_once(spark):
    from __spark_entry__ import SMOKE_DIR
    from cohortforge.plans.queries import QUERIES
    for name in ("serial_change", "low_value_flags_only", "paired_reading_bands_no_low", "categorical_readings_left", "serial_change_audit"):
        paths = QUERIES[name](spark, SMOKE_DIR).inputFiles()
        assert any("/readings-" in p for p in paths), name


def test_models_read_written_splits(spark):
    from __spark_entry__ import SMOKE_DIR
    from cohortforge.plans.queries import _splits
    for df in _splits(spark, SMOKE_DIR)[:3]:
        assert all("/model-scaled-" in p for p in df.inputFiles())
