"""Properties of the feature frames on the smallest test tables."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def assembly(spark):
    return E.queries()["feature_assembly"](spark, SF).cache()


def test_one_row_per_key(spark, assembly):
    for name in ["feature_assembly", "chart_features_all_bins", "keyword_group_windows", "other_visits_within_days",
                 "demographics", "serial_change", "paired_reading_bands", "group_reference_range"]:
        df = assembly if name == "feature_assembly" else E.queries()[name](spark, SF)
        n, k = df.agg(F.count(F.lit(1)), F.countDistinct("hadm_id")).first()
        assert n == k, name


def test_flags_are_zero_one_or_null(assembly):
    ints = [f.name for f in assembly.schema.fields if f.dataType.typeName() == "integer" and f.name.startswith("ft_")]
    assert len(ints) > 50
    bad = assembly.agg(*[F.sum(F.when(~F.col(f"`{c}`").isin(0, 1), 1).otherwise(0)).alias(f"c{i}")
                         for i, c in enumerate(ints)]).first()
    assert all(v == 0 for v in bad)


def test_within_windows_are_monotone(assembly):
    cols = assembly.columns
    checked = 0
    for c in cols:
        m = re.match(r"(ft_.*_rx)_within_(\d+)$", c)
        if not m:
            continue
        base, hours = m.group(1), int(m.group(2))
        wider = sorted(int(re.match(r".*_within_(\d+)$", x).group(1)) for x in cols
                       if x.startswith(base + "_within_") and int(re.match(r".*_within_(\d+)$", x).group(1)) > hours)
        targets = [f"{base}_within_{w}" for w in wider[:1]] + [base]
        for t in targets:
            assert assembly.where(F.col(c) > F.col(t)).count() == 0, (c, t)
            checked += 1
    assert checked > 10


def test_bins_keep_entities_together(spark):
    from cohortforge.sources import adapters as A
    from cohortforge.sources.io import with_hash_bin
    df = with_hash_bin(A.charts(spark, SF), "hadm_id")
    assert df.groupBy("hadm_id").agg(F.countDistinct("bin_id").alias("b")).where("b > 1").count() == 0
