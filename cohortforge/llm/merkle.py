"""Merkle manifest of a data set: one tree per group, a forest tree over the groups.

A row's leaf is the SHA-256 of its fields, each written as UTF-8 byte count,
colon and value, or ``-`` if null. Within a group leaves ascend by key; every
``ARITY`` consecutive nodes become the hash of their digests, a last run of
fewer (even of one) too, until one node remains, the group's subroot. Subroots
in the order of their groups give the root by the same rule.

Only every ``STEP``-th level is stored. A stored level is cut into aligned
subtrees of ``ARITY ** STEP`` nodes, one row each; the levels between are
regenerated from the nodes of a subtree when a proof needs them, the siblings
along each path go out and the rest is dropped. Proofs go from the top stored
level down, so a node's siblings are found once for all leaves below it.

A group with most of the rows fills as many tasks as its share: places are
counted by range partitions, and no task holds more than a subtree.

Defined results: a null group is a group of its own and comes first; null keys
come first in their group; rows of equal key are ordered by leaf, repeated rows
are leaves of their own; null fields are ``-``, an empty text is ``0:``; a group
of one row has the leaf as subroot, a single group's subroot is the root; a path
without siblings has the hash of the empty text as proof; other columns are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.common import discard, ranked, write_once

ARITY, STEP = 8, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<l:string,r:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(fields: list[Column]) -> Column:
    """Hash of the framed fields."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)))


def _above(nodes: Column, n: Column) -> Column:
    """Nodes one level above those of a subtree, of a group that has ``n`` nodes at
    this level; a group of one node stays as it is."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    up = F.transform(runs, lambda j: digest(F.array_join(F.slice(nodes, j * ARITY + 1, ARITY), "")))
    return F.when(n > 1, up).otherwise(nodes)


def _subtrees(level: DataFrame) -> DataFrame:
    """One row per aligned subtree of a stored level: its nodes in order, and as
    ``up_*`` and ``n_*`` the regenerated levels."""
    rows = level.groupBy("g", F.floor(F.col("i") / ARITY ** STEP).cast("long").alias("b")).agg(
        F.sort_array(F.collect_list(F.struct("i", "h"))).alias("own"), F.max("n").alias("n_0"))
    rows = rows.withColumn("up_0", F.col("own.h"))
    for k in range(1, STEP + 1):  # a level at a time, so that each is computed once
        n = F.col(f"n_{k - 1}")
        rows = rows.withColumns({f"up_{k}": _above(F.col(f"up_{k - 1}"), n), f"n_{k}": F.ceil(n / ARITY).cast("long")})
    return rows


def build(leaves: DataFrame, name: str) -> list[DataFrame]:
    """Stored levels of the trees over ``leaves`` (g, i, n, h): columns ``g``, ``i``,
    ``n``, ``h``; the last level has one node, the subroot, for each group."""
    levels = [leaves]
    while (levels[-1].agg(F.max("n")).first()[0] or 0) > 1:
        up = _subtrees(levels[-1]).select("g", F.col("b").alias("i"), F.col(f"n_{STEP}").alias("n"),
                                          F.col(f"up_{STEP}")[0].alias("h"))
        levels.append(write_once(up, f"{name}-{len(levels) * STEP}"))
    return levels


def _siblings(k: int, at: Column) -> Column:
    """Siblings left and right of the node above place ``at`` at level k, null where
    the group has one node there."""
    nodes, n = F.col(f"up_{k}"), F.col(f"n_{k}")
    place = F.floor(at / ARITY ** k).cast("int")
    run, own = F.floor(place / ARITY).cast("int") * ARITY, place % ARITY
    return F.when(n > 1, F.struct(F.array_join(F.slice(nodes, run + 1, own), "").alias("l"),
                                  F.array_join(F.slice(nodes, place + 2, F.lit(ARITY - 1) - own), "").alias("r")))


def paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """``g``, ``i``, ``path`` (siblings level by level up to the root) and ``subroot``
    of every node of the lowest level; ``above`` has ``g``, ``subroot`` and its ``path``."""
    found = above.select("g", F.lit(0).cast("long").alias("i"), "path", "subroot")
    for level in reversed(levels[:-1]):
        rows = _subtrees(level)
        found = found.withColumnsRenamed({"g": "g_", "i": "i_"})
        rows = rows.join(found, F.col("g").eqNullSafe(F.col("g_")) & (F.col("b") == F.col("i_"))).drop("g_", "i_", "b")
        own = F.transform("own", lambda x, at: F.struct(x["i"].alias("i"), F.concat(
            F.filter(F.array(*(_siblings(k, at) for k in range(STEP))), lambda s: s.isNotNull()), F.col("path")).alias("path")))
        found = rows.select("g", F.explode(own).alias("x"), "subroot").select("g", "x.i", "x.path", "subroot")
    return found


def proof(path: Column) -> Column:
    """Hash of the siblings along a path."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""))


def fold(path: Column, node: Column) -> Column:
    """The root that a leaf's hash and its siblings give."""
    return F.aggregate(path, node, lambda h, s: digest(F.concat(s["l"], h, s["r"])))


def manifest(rows: DataFrame, claimed: Column, key: str = "doc_id", group: str = "lang",
             fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``key``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` of every row, and
    ``folded_root``, what the ``claimed`` leaf (a column over the rows) gives with
    the row's siblings."""
    leaves = write_once(rows.select(F.col(key).alias("k"), F.col(group).alias("g"), leaf([F.col(f) for f in fields]).alias("h"),
                                    claimed.alias("c"), F.monotonically_increasing_id().alias("r")), "merkle-rows")
    order = [F.col("k").asc_nulls_first(), F.col("h"), F.col("c"), F.col("r")]
    leaves = write_once(ranked(leaves, ["g"], order, "merkle-order"), "merkle-0")
    trees = build(leaves.select("g", "i", "n", "h"), "merkle")
    subroots = ranked(trees[-1].select("g", "h"), [], [F.col("g").asc_nulls_first()], "merkle-groups")
    subroots = write_once(subroots.withColumn("all", F.lit(0)), "merkle-subroots")
    forest = build(subroots.select(F.col("all").alias("g"), "i", "n", "h"), "merkle-forest")
    root = forest[-1].select("h").first()  # one hash, or none of an empty table
    top = paths(forest, forest[-1].select("g", F.array().cast(PATH).alias("path"), F.col("h").alias("subroot")))
    tops = write_once(subroots.join(top.select("i", "path"), "i").select("g", F.col("h").alias("subroot"), "path"), "merkle-tops")
    found = paths(trees, tops).withColumnsRenamed({"g": "g_", "i": "i_"})
    rows = leaves.join(found, F.col("g").eqNullSafe(F.col("g_")) & (F.col("i") == F.col("i_")))
    done = write_once(rows.select(
        F.col("k").alias(key), F.col("h").alias("leaf"), "subroot", F.lit(root and root[0]).cast("string").alias("root"),
        proof(F.col("path")).alias("proof_sha256"), fold(F.col("path"), F.col("c")).alias("folded_root")), "merkle-proofs")
    discard(leaves, *trees, subroots, *forest, tops)
    return done


def ascii_lower(col: Column) -> Column:
    return F.translate(col, ascii_uppercase, ascii_lowercase)


def tamper_checks(docs: DataFrame) -> DataFrame:
    """The manifest of documents; where 3 divides the CRC-32 of the id, the claimed
    leaf is that of the text in lower case, and its proof must fail unless the
    text has no A-Z. A null id is not tampered with."""
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    text = F.when(changed, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    claimed = leaf([text if f == "text" else F.col(f) for f in FIELDS])
    return manifest(docs, claimed).withColumn("verified", F.col("folded_root") == F.col("root"))
