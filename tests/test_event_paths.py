"""Reduced event paths against the event-level forms, hot slots cut by the
tie-break, sparse one-hot, the batch writer, and flags that take both values."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import ts
from cohortforge.operators import aggregates as ag
from cohortforge.operators import features as fx
from cohortforge.operators import windows as wn
from cohortforge.plans import pipeline as pl
from cohortforge.plans import presets as P
from cohortforge.plans import queries as Q
from cohortforge.sources import adapters as A
from cohortforge.sources import io

SF = "/root/testdata/sf0.001"


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_anchored_forms_equal_event_level_forms(spark):
    label = Q._label(spark, SF)
    with_time, without = (pl.clean_chart_events(A.charts(spark, SF), A.items(spark, SF), x, item_filter=pl.chart_item_filter()) for x in (label, None))
    assert "admittime" not in without.columns
    r6 = lambda df: Q.tidy(df)
    same(r6(fx.low_value_windows(with_time)), r6(fx.low_value_windows(without, anchors=label)))
    same(fx.low_value_windows(with_time, with_means=False), fx.low_value_windows(without, with_means=False, anchors=label))
    same(fx.paired_reading_bands(with_time), fx.paired_reading_bands(without, anchors=label))
    with pytest.raises(ValueError):
        fx.low_value_windows(without, masked=True, anchors=label)




def test_events_meet_no_admission(spark):
    """The reduced rows join; below a join with admissions there is an aggregate."""
    plan = fx.keyword_group_windows(A.prescriptions(spark, SF), A.admissions(spark, SF), {"g": ["ring", "bolt"]})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    join = text.index("__k")
    assert "Aggregate" in text[:join] and "__w0" in text[:join]


def test_no_time_rows_are_cut(spark):
    """500 rows without a time and 500 of one second spread over buckets, same result."""
    rng = random.Random(1)
    rows = [(1, None, float(rng.randint(1, 50)), i) for i in range(500)]
    rows += [(1, ts("2020-01-01 00:00:05"), float(rng.randint(1, 50)), i) for i in range(500, 1000)] + [(2, None, 1.0, 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "hadm_id int, eventtime timestamp_ntz, v double, row_order int")
    t = F.col("eventtime")
    cut = wn._with_bucket(df, "hadm_id", wn.hour_bucket(t), wn.second_of_slot(t), 50, wn.tie_fields(df, "row_order"))
    sizes = [(r["__b"], r["n"]) for r in cut.where("hadm_id = 1").groupBy("__b", "__t").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 20 and max(n for _, n in sizes) <= 60 and len({b for b, _ in sizes}) == 2
    got = wn.previous_values(df, "hadm_id", wn.hour_bucket(t), [t, F.col("row_order")], ["v"], split=wn.second_of_slot(t),
                             hot_rows=50, ties=wn.tie_fields(df, "row_order"))
    before = {}
    for key in (1, 2):
        own = sorted([r for r in rows if r[0] == key], key=lambda r: (r[1] is None, r[1] or 0, r[3]) if r[1] is None else (False, r[1], r[3]))
        for last, r in zip([own[0], *own], own):
            before[key, r[3]] = last[2]
    assert {(r["hadm_id"], r["row_order"]): r["prev_v"] for r in got.collect()} == before


def test_ties_skip_constant_and_unusable_fields(spark):
    rows = [(1, (7, i % 5, None if i % 3 else i)) for i in range(100)] + [(2, (None if i else 3, i, i)) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, o struct<a:int,b:int,c:int>")
    null = F.lit(None).cast("timestamp_ntz")
    cut = wn._with_bucket(df, "k", wn.hour_bucket(null), wn.second_of_slot(null), 10, wn.tie_fields(df, "o"))
    of = {k: {(r["o"]["b"], r["__t"]) for r in cut.where(f"k = {k}").collect()} for k in (1, 2)}
    assert {t for _, t in of[1]} == {0, 2, 5, 7, 9} and sorted(of[1]) == sorted(of[1], key=lambda x: x[1])
    assert {t for _, t in of[2]} == {0}  # a null before it: that field can't decide
    mixed = spark.createDataFrame([], "o struct<a:int,s:string,c:int>, t string")
    assert len(wn.tie_fields(mixed, "o")) == 1 and wn.tie_fields(mixed, "t") == []


def test_sparse_onehot(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None), (3, "zz"), (None, "a")], "k int, v string")
    places = {r["value"]: r["place"] for r in ag.category_places(df, "v").collect()}
    assert places == {"a": 0, "b": 1, "zz": 2}
    rows = {r["k"]: (r["size"], r["indices"]) for r in ag.onehot_sparse(df, "k", "v").collect()}
    assert rows == {1: (3, [0, 1]), 2: (3, []), 3: (3, [2])}
    vectors = {r["k"]: r["vector"].toArray().tolist() for r in ag.to_vectors(ag.onehot_sparse(df, "k", "v")).collect()}
    assert vectors == {1: [1, 1, 0], 2: [0, 0, 0], 3: [0, 0, 1]}
    many = spark.range(5000).selectExpr("id AS k", "string(id * 7919 % 5000) AS v")
    got = {r["value"]: r["place"] for r in ag.category_places(many, "v").collect()}
    assert got == {v: i for i, v in enumerate(sorted(map(str, range(5000))))}


def test_batch_writer(spark):
    """A hot bin fills several files, and a batch that runs again changes nothing."""
    from cohortforge.streaming import batch_writer
    out = tempfile.mkdtemp(prefix="cf-batches-")
    rows = spark.range(60_000).select(F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id")).alias("HADM_ID"), F.sha2(F.col("id").cast("string"), 256).alias("V"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        write = batch_writer(out, "HADM_ID")
        write(rows, 0)
        first = sorted(os.listdir(out))
        write(rows.limit(10), 1)
        write(rows, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = io.read_bins(spark, out)
    assert back.count() == 60_010 and {r[0] for r in back.select("batch_id").distinct().collect()} == {0, 1}
    hot = back.where("hadm_id = 1 AND batch_id = 0")
    assert hot.select(F.input_file_name()).distinct().count() > 1 and len(first) > 200
    assert io.read_bins(spark, out, ["c4"]).where("hadm_id <> 1").count() == back.where("bin_id = 'c4' AND hadm_id <> 1").count()


def test_every_chart_flag_takes_both_values(spark):
    rows = Q.QUERIES["chart_features_all_bins"](spark, "/root/testdata/sf0.01")
    flags = [c for c, t in rows.dtypes if t == "int" and c.startswith("ft_")]
    row = rows.agg(*[F.count_if(F.col(c) == v).alias(f"{c}:{v}") for c in flags for v in (0, 1)]).first().asDict()
    assert len(flags) > 15 and not [k for k, n in row.items() if not n]
    events = Q._clean(spark, "/root/testdata/sf0.01", item_filter=pl.chart_item_filter())
    assert fx.dedupe_events(events).count() < events.count() and events.where("eventtime IS NULL").count() > 0


def test_every_preset_drug_flag_takes_both_values(spark):
    rows = Q.QUERIES["keyword_groups_preset"](spark, "/root/testdata/sf0.01")
    flags = [c for c in rows.columns if c.startswith("ft_")]
    words = sum(len(ws) for ws in P.DRUG_GROUPS.values())
    assert len(flags) == (1 + words + len(P.DRUG_GROUPS)) * 4
    row = rows.agg(*[F.count_if(F.col(c) == v).alias(f"{c}:{v}") for c in flags for v in (0, 1)]).first().asDict()
    assert not [k for k, n in row.items() if not n]


def test_paired_readings_take_all_events(spark):
    d = "/root/testdata/sf0.001"
    rows = A.paired_readings_input(spark, d)
    assert rows.count() == spark.read.parquet(f"{d}/events.parquet").count()
    assert rows.filter("label IS NULL").count() == 0
    bands = fx.paired_reading_bands(rows)
    assert bands.count() > 0
