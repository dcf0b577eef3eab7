"""Moments of all columns of a model set: from one narrow pass, equal to Spark's aggregates."""

import math

import pytest
from pyspark.sql import functions as F

from cohortforge.operators.preprocess import column_moments

NAN = float("nan")


def rows(spark, parts):
    data = [(i, None if i % 3 == 0 else 1e9 + i % 7, NAN if i == 5 else 1.5, None if i % 4 == 0 else i % 2 == 0,
             None if i % 5 else "a", None, 0, -0.25 if i < 20 else None) for i in range(200)]
    return spark.createDataFrame(data, "k int, far double, hole double, flag boolean, note string, none double, zero int, early double").repartitionByRange(parts, "k")


@pytest.mark.parametrize("parts", [1, 7])
def test_moments_equal_sparks_aggregates(spark, parts):
    df = rows(spark, parts)
    n, found = column_moments(df, df.columns)
    assert n == 200 and list(found) == df.columns
    for c in df.columns:
        known = df.where(F.col(c).isNotNull()).count()
        assert found[c]["n"] == known
        if c in ("note", "none"):
            assert found[c] == {"n": known}
            continue
        v = F.col(c).cast("double")
        want = df.agg(F.avg(v), F.var_pop(v) * known, F.min(v), F.max(v)).first()  # its variance is good to 1e-7 far from zero
        for got, w in zip((found[c][x] for x in ("mean", "m2", "low", "high")), want):
            assert math.isnan(got) if math.isnan(w) else got == pytest.approx(w, rel=1e-6, abs=1e-9), c


def test_moments_of_no_rows(spark):
    assert column_moments(rows(spark, 2).where("k < 0"), ["far", "note"]) == (0, {"far": {"n": 0}, "note": {"n": 0}})


def test_moments_need_no_aggregate_per_column(spark, monkeypatch):
    """Five aggregates per column in one expression are not compiled at the width of a model set."""
    df, widths = spark.range(50).select(*[(F.col("id") % (i + 2)).alias(f"ft_{i}") for i in range(40)]), []
    for kind in (type(df), type(df.groupBy())):
        monkeypatch.setattr(kind, "agg", lambda self, *a, f=kind.agg: (widths.append(len(a)), f(self, *a))[1])
    n, found = column_moments(df, df.columns)
    assert n == 50 and found["ft_0"]["mean"] == 0.5 and max(widths) <= 10
