"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

Every document of a source gets the same expected number of copies, target /
source size; the whole part is fixed and the fraction is a probability. In a
pairing step two documents exchange expected words (probability x size) until
one probability is 0 or 1; the direction is drawn so that no probability
changes in expectation, and the source's expected words stay exact. Steps run
along short lists inside hashed blocks; each block leaves at most one open
document, and the open ones meet in the blocks of the next level, a reduction
tree with one root per source. The root rounds its last document and settles
the difference against the other documents of its list, so that a source's
words end near its target. Draws are hashes of the seed and the ids: reruns agree.

Defined results: a null text has size 0; documents of size 0 are taken 0 words
(their copies are those of the whole part); rows that agree in id, source and
size share one decision; null is a source of its own, ordered last; a null id
is an id like any other; columns other than id, text and source are not looked
at; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortforge.llm.common import fresh_name, materialize, n_ws_words

WEIGHTS, MAX_COPIES, BLOCK = (5, 2, 1), 3, 512


def source_targets(sizes: DataFrame, source: str = "source", size: str = "size", weights: tuple = WEIGHTS,
                   max_copies: int = MAX_COPIES, share: float = 1.0) -> DataFrame:
    """``source``, ``source_size``, ``n_items`` and ``target`` (double) of every source.

    Weights repeat over the sources in code point order, null last. Sources
    that would pass ``max_copies`` times their size stop there and the rest is
    shared again by weight: with the sources ordered by cap / weight, the
    stopped ones are a prefix. The windows here see one row per source."""
    per = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"), F.count("*").alias("n_items"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", (F.col("source_size") * max_copies).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    up_to, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(share)
    left = total - F.coalesce(F.sum("cap").over(up_to), F.lit(0.0))
    per = per.withColumn("level", left / F.sum("weight").over(rest))
    per = per.withColumn("stops", F.col("level") * F.col("weight") >= F.col("cap"))
    free = F.max(F.when(~F.col("stops"), F.col("level"))).over(Window.partitionBy())
    target = F.when(F.col("stops") | free.isNull(), F.col("cap")).otherwise(free * F.col("weight"))
    return per.select("source", "source_size", "n_items", target.alias("target"))


def _blocks(n: str, block: int) -> Column:
    """Blocks for ``n`` items: one while they fit, else half full on average, so
    that hashing does not overfill them."""
    return F.when(F.col(n) <= block, 1).otherwise(F.ceil(F.col(n) / (block // 2))).cast("long")


def _chain(seed: int, level: int) -> Column:
    """Runs the pairing steps along ``items`` (structs id, size, mass; mass =
    probability x size): a struct of ``open`` (the undecided item or null) and
    ``done`` (items with mass 0 or size)."""
    return F.expr(f"""
      aggregate(items,
        struct(cast(null as struct<h:bigint,size:bigint,mass:double>) as open,
               cast(array() as array<struct<h:bigint,size:bigint,mass:double>>) as done),
        (a, x) -> case
          when x.mass <= 0 or x.mass >= x.size
            then struct(a.open as open, concat(a.done, array(x)) as done)
          when a.open is null then struct(x as open, a.done as done)
          else transform(array(struct(a.open as i, x as j,
                 least(a.open.size - a.open.mass, x.mass) as up, least(a.open.mass, x.size - x.mass) as down,
                 shiftrightunsigned(xxhash64({seed}, {level}, a.open.h, x.h), 11) / {float(1 << 53)}D as u)), s ->
               transform(array(case when s.u * (s.up + s.down) < s.down
                 then struct(if(s.up = s.i.size - s.i.mass, cast(s.i.size as double), s.i.mass + s.up) as mi,
                             if(s.up = s.j.mass, 0D, s.j.mass - s.up) as mj)
                 else struct(if(s.down = s.i.mass, 0D, s.i.mass - s.down) as mi,
                             if(s.down = s.j.size - s.j.mass, cast(s.j.size as double), s.j.mass + s.down) as mj) end), m ->
                 transform(array(struct(
                     struct(s.i.h as h, s.i.size as size, m.mi as mass) as i,
                     struct(s.j.h as h, s.j.size as size, m.mj as mass) as j,
                     m.mi <= 0 or m.mi >= s.i.size as shut_i, m.mj <= 0 or m.mj >= s.j.size as shut_j)), r ->
                   struct(case when not r.shut_i then r.i when not r.shut_j then r.j end as open,
                          concat(a.done, case when r.shut_i and r.shut_j then array(r.i, r.j)
                                              when r.shut_i then array(r.i) else array(r.j) end) as done))[0])[0])[0]
        end)""")


def _settle() -> Column:
    """The root's items: the open one is rounded to the nearer side, then items
    of the list, largest first, change sides where that brings the sum nearer."""
    return F.expr("""
      transform(array(case when c.open is null then 0D
                           when 2 * c.open.mass >= c.open.size then c.open.mass - c.open.size else c.open.mass end), g ->
        aggregate(
          reverse(array_sort(transform(c.done, x -> struct(x.size as size, x.h as h, x.mass as mass)))),
          struct(g as gap, cast(array() as array<struct<h:bigint,size:bigint,mass:double>>) as done),
          (a, x) -> case
            when x.mass < x.size and abs(a.gap - x.size) < abs(a.gap)
              then struct(a.gap - x.size as gap, concat(a.done, array(struct(x.h as h, x.size as size, cast(x.size as double) as mass))) as done)
            when x.mass > 0 and abs(a.gap + x.size) < abs(a.gap)
              then struct(a.gap + x.size as gap, concat(a.done, array(struct(x.h as h, x.size as size, 0D as mass))) as done)
            else struct(a.gap as gap, concat(a.done, array(struct(x.h as h, x.size as size, x.mass as mass))) as done) end,
          a -> concat(a.done, case when c.open is null then array() else array(struct(c.open.h as h, c.open.size as size,
                 if(2 * c.open.mass >= c.open.size, cast(c.open.size as double), 0D) as mass)) end)))[0]""")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS,
        max_copies: int = MAX_COPIES, share: float = 1.0, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """One row per input row: ``key``, ``source``, ``size``, ``source_size``,
    ``target``, ``copies`` (int) and ``taken`` = copies x size."""
    rows = materialize(docs.select(F.col(key).alias("k"), F.col(source).alias("source"), n_ws_words(text).alias("size")),
                       "mix-sizes")
    return _mixed(rows, weights, max_copies, share, seed, block).withColumnsRenamed({"k": key, "source": source})


def _mixed(rows: DataFrame, weights: tuple, max_copies: int, share: float, seed: int, block: int) -> DataFrame:
    targets = materialize(source_targets(rows, "source", "size", weights, max_copies, share), "mix-targets")
    most = targets.agg(F.max("n_items")).first()[0] or 0
    # Rows that agree in id, source and size are one item, of their joint size.
    items = rows.groupBy("k", "source", "size").agg(F.count("*").alias("n"))
    per = targets.select(F.col("source").alias("s2"), F.col("source_size"), F.col("n_items"), F.col("target"))
    items = items.join(per, F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_copies)))).otherwise(0.0)
    whole = F.floor(ratio + 1e-12)
    frac = F.greatest(ratio - whole, F.lit(0.0))
    items = materialize(items.select(
        "k", "source", "size", whole.cast("int").alias("whole"), (F.col("size") * F.col("n")).alias("joint"),
        (frac * F.col("size") * F.col("n")).alias("mass"), F.xxhash64(F.lit(seed), "k", F.col("k").isNull(), "size").alias("h"),
        _blocks("n_items", block).alias("blocks")), "mix-items")
    decided, level = None, 0
    now = items.filter("mass > 0").select("source", "blocks", F.struct("h", F.col("joint").alias("size"), "mass").alias("x"))
    while True:
        root = F.col("blocks") <= 1
        hashed = F.pmod(F.xxhash64(F.lit(seed + 7919 * (level + 1)), F.col("x.h")), F.greatest("blocks", F.lit(1).cast("long")))
        met = now.withColumn("block", hashed).groupBy("source", "blocks", "block").agg(F.collect_list("x").alias("items"))
        met = met.withColumn("items", F.sort_array("items"))  # by hash
        met = met.withColumn("c", F.explode_outer(F.array(_chain(seed, level)))).drop("items")
        met = met.select("source", "blocks", F.when(root, F.lit(None)).otherwise(F.col("c.open")).alias("open"),
                         F.when(root, _settle()).otherwise(F.col("c.done")).alias("done"))
        met = materialize(met, f"mix-level-{level}")
        part = met.select("source", F.explode("done").alias("x")).select("source", "x.*")
        decided = part if decided is None else decided.unionAll(part)
        if most <= block:
            break
        most, level = -(-most // (block // 2)), level + 1
        now = met.filter("open is not null").select(
            "source", _blocks("blocks", block).alias("blocks"), F.col("open").alias("x"))
    chosen = decided.groupBy(F.col("source").alias("s3"), F.col("h").alias("h3")).agg(
        F.max((F.col("mass") > 0).cast("int")).alias("extra"))
    copies = items.join(chosen, F.col("source").eqNullSafe(F.col("s3")) & (F.col("h") == F.col("h3")), "left").select(
        F.col("k").alias("k2"), F.col("source").alias("s2"), F.col("size").alias("z2"),
        (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("int").alias("copies"))
    out = rows.join(copies, F.col("k").eqNullSafe(F.col("k2")) & F.col("source").eqNullSafe(F.col("s2"))
                    & (F.col("size") == F.col("z2"))).select("k", "source", "size", "copies")
    out = out.join(per, F.col("source").eqNullSafe(F.col("s2")))
    return out.select("k", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def take_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mix itself: every row as often as it is taken, columns unchanged."""
    names = docs.columns
    n, k, s, z = (fresh_name(docs, x) for x in ("copies", "mix_key", "mix_source", "mix_size"))
    plan = mix(docs, key, text, source, **how).filter("copies > 0").select(
        F.col(key).alias(k), F.col(source).alias(s), F.col("size").alias(z), F.col("copies").alias(n)).distinct()
    sized = docs.withColumn(z + "_", n_ws_words(text))
    found = sized.join(plan, F.col(key).eqNullSafe(F.col(k)) & F.col(source).eqNullSafe(F.col(s)) & (F.col(z + "_") == F.col(z)))
    return found.select(*names, F.explode(F.sequence(F.lit(1), F.col(n))).alias(z + "_")).select(names)
