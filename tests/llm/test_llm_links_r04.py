"""The index of fingerprint variants is never broadcast."""

from cohortforge.llm import simhash
from cohortforge.llm.common import materialize


def test_index_of_variants_is_shuffled_at_any_size(spark):
    fps = [0, 1, 3, 0xF0, 0xF1, 1 << 40, -1]
    nodes = materialize(spark.createDataFrame([(f,) for f in fps], "fp long"), "links-test")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "10m")  # far above the size of the file
    try:
        links = simhash.links(nodes)
        got = {(r["u"], r["v"]) for r in links.collect()}
        plan = links._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert got == {(u, v) for u in fps for v in fps if u < v and bin((u ^ v) & (1 << 64) - 1).count("1") <= 3}
