"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.common import materialize


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Links of every node move to the smallest node of its neighbourhood
    (``both_ways``: of larger neighbours, else of smaller ones). The minimum is
    aggregated map-side and joined back, so that a hub with very many links is
    spread over tasks."""
    u, v = F.col("u"), F.col("v")
    if both_ways:
        near = edges.select("u", "v").unionAll(edges.select(v.alias("u"), u.alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = near.groupBy("u").agg(F.min("v").alias("m"))
    pairs = near.join(low, "u")
    if both_ways:
        out = pairs.filter(v > u).select(v.alias("u"), F.least("m", "u").alias("v"))
    else:
        out = pairs.filter(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v")).unionAll(
            low.select("u", F.col("m").alias("v")))
    return out.distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for every node
    that has a link to another one. Links to oneself and repeated links are
    allowed; an empty table gives an empty result. Each round is written to the
    shared folder; rounds end when the links no longer change."""
    cur = materialize(edges.filter(F.col(u) != F.col(v)).select(
        F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "links")
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(cur)
    while before[0]:
        cur = materialize(_star(_star(cur, True), False), "links")
        now = mark(cur)
        if now == before:
            break
        before = now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(
        cur.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
