"""Repeated line runs found with a suffix array over line ids, later copies deleted.

Lines that hold a word are the letters of one long sequence per document. Their
runs of 1, 2, 4, ... lines get order-preserving ranks by distributed prefix
doubling: a run's rank is the number of runs sorted before it, by the ranks of
its two halves. Runs that occur once drop out of every later round, as no
repeated run can hold them. Suffixes with a common prefix of a given length form
an interval of the suffix array; here that is a pair of ranks of two
overlapping runs. Every line of a later copy of any repeated run of at least
``min_words`` words goes. Judged are the shortest such runs from each line on and
up to each line: of the repeated runs that hold a line, one that cannot be
shortened without losing the line or words below the minimum is either of these,
and what repeats in a run repeats in its parts. Judged runs that meet at the same distance to their first copy are one maximal run.

The first copy in corpus order (key, null last, then row) stays; lines of
later copies are deleted, but never lines of the first copy itself where copies
overlap. Counts per rank combine before they shuffle, and joins on a rank that
very many lines share are left to AQE to split; no group is collected.

Defined results: null stays null and empty stays empty; blank lines are kept
unless the whole text was deleted line by line, then the text is empty; lines are
compared without the white space around them; repeated rows are copies of each
other; other columns are kept and may have any names; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortforge.llm.common import discard, materialize, text_of

MIN_WORDS = 50
LINE = "array<struct<p:int,raw:int,h:binary,r:int,s:int>>"


def _cut(text: str, min_words: int) -> list[tuple]:
    """(position among lines with words, line number, identity, lines from this
    one on until ``min_words`` words are reached or 0, the same up to this one or
    0 if the first of them counts the same lines) of a text's lines."""
    import numpy as np
    import xxhash
    lines = [(i, s.strip(), n) for i, s in enumerate(text.split("\n")) if (n := len(s.split()))]
    if not lines:
        return []
    ends = np.cumsum([n for _, _, n in lines])
    want = np.searchsorted(ends, np.concatenate([[0], ends[:-1]]) + min_words) + 1 - np.arange(len(lines))
    want = np.where(want + np.arange(len(lines)) <= len(lines), want, 0)
    first = np.searchsorted(np.concatenate([[0], ends]), ends - min_words, side="right") - 1
    back = np.where(first >= 0, np.arange(len(lines)) + 1 - first, 0)
    back = np.where(want[first] == back, 0, back)
    return [(p, i, xxhash.xxh3_128_digest(s.encode("utf-8", "surrogatepass")), int(r), int(b))
            for p, ((i, s, _), r, b) in enumerate(zip(lines, want, back))]


def _ranked(positions: DataFrame, by: list[str], name: str) -> DataFrame:
    """The rows whose value of ``by`` occurs twice or more, with its ``rank``
    instead of it; ranks follow the order of ``by``. Only distinct values are sorted:
    ranges per task, and an offset per range from a table of one row a range."""
    values = positions.groupBy(*by).agg(F.count("*").alias("n")).filter("n > 1")
    ordered = materialize(values.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id()), f"{name}-values")
    sums = ordered.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    ranks = ordered.withColumn("low", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(sums), "part")
    ranks = ranks.select(*by, (F.col("base") + F.col("low")).alias("rank"))
    out = materialize(positions.join(ranks, by).drop(*by), name)
    discard(ordered)
    return out


def _worth_it(repeated: DataFrame) -> DataFrame:
    """Repeated lines in unbroken stretches that hold a whole judged run; ``r`` and
    ``s`` are 0 where the stretch does not hold it. The windows see one document's lines."""
    in_doc = Window.partitionBy("d").orderBy("p")
    rows = repeated.withColumn("stretch", F.col("p") - F.row_number().over(in_doc))
    one = Window.partitionBy("d", "stretch")
    rows = rows.withColumn("r", F.when(F.col("p") + F.col("r") - 1 <= F.max("p").over(one), F.col("r")).otherwise(0))
    rows = rows.withColumn("s", F.when(F.col("p") - F.col("s") + 1 >= F.min("p").over(one), F.col("s")).otherwise(0))
    return rows.withColumn("best", F.max("r").over(one)).filter("best > 0").drop("stretch", "best")


def repeated_lines(rows: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """For a materialized frame (``d`` row number, ``k`` key, ``t`` text): the
    lines of later copies (``d``, ``raw``) and the maximal runs they belong to
    (``d``, ``start``, ``lines``, ``first_d``, ``first_start``, in lines with words)."""
    gone, later = _later_copies(rows, min_words)
    return gone, _maximal(later)


def _later_copies(rows: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame]:
    """The lines to delete (over the two written tables that are left) and the judged
    runs they belong to: ``d``, ``p``, ``r`` lines, ``first_d``, ``first_p``."""
    @F.pandas_udf(LINE)
    def cut(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([[dict(zip(("p", "raw", "h", "r", "s"), x)) for x in _cut(t, min_words)] for t in part], dtype="object")

    all_lines = materialize(rows.select("d", "k", F.explode_outer(cut("t")).alias("x")).filter("x is not null").select("d", "k", "x.*"), "lines")
    known = _ranked(all_lines, ["h"], "line-rank-1")
    lines = materialize(_worth_it(known), "repeated-lines")
    discard(all_lines, known)
    judged = lines.select("d", "k", "p", "r").unionAll(
        lines.filter("s > 0").select("d", "k", (F.col("p") - F.col("s") + 1).alias("p"), F.col("s").alias("r")))
    longest = judged.agg(F.max("r")).first()[0] or 0
    level, size, found, levels = lines.select("d", "p", "rank"), 1, None, []
    while size <= longest:
        # Runs of size .. 2 * size - 1 lines: the ranks of their first and of their last ``size`` lines.
        starts = judged.filter((F.col("r") >= size) & (F.col("r") < 2 * size))
        a = level.select("d", "p", F.col("rank").alias("a"))
        b = level.select("d", F.col("p").alias("q"), F.col("rank").alias("b"))
        here = starts.join(a, ["d", "p"]).withColumn("q", F.col("p") + F.col("r") - size).join(b, ["d", "q"]).select(
            "d", "k", "p", "r", "a", "b")
        found = here if found is None else found.unionAll(here)
        if 2 * size <= longest:
            pairs = level.select("d", "p", F.col("rank").alias("a")).join(
                level.select("d", (F.col("p") - size).alias("p"), F.col("rank").alias("b")), ["d", "p"])
            level = _ranked(pairs, ["a", "b"], f"line-rank-{2 * size}")
            levels.append(level)
        size *= 2
    if found is None:
        found = lines.limit(0).select("d", "k", "p", "r", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    found = materialize(found, "line-runs")
    discard(*levels)
    place = F.struct(F.col("k").isNull().alias("no"), F.col("k").alias("k"), F.col("d").alias("d"), F.col("p").alias("p"))
    firsts = found.groupBy("r", "a", "b").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1").select(
        "r", "a", "b", F.col("first.d").alias("first_d"), F.col("first.p").alias("first_p"))
    later = found.join(firsts, ["r", "a", "b"]).filter((F.col("d") != F.col("first_d")) | (F.col("p") != F.col("first_p")))
    later = materialize(later.select("d", "p", "r", "first_d", "first_p"), "later-copies")
    discard(found)
    hit = later.select("d", "first_d", "first_p", "r", F.explode(F.sequence(F.col("p"), F.col("p") + F.col("r") - 1)).alias("p"))
    hit = hit.filter((F.col("d") != F.col("first_d")) | (F.col("p") >= F.col("first_p") + F.col("r"))).select("d", "p").distinct()
    return hit.join(lines.select("d", "p", "raw"), ["d", "p"]).select("d", "raw"), later


def _maximal(later: DataFrame) -> DataFrame:
    """Runs that meet at the same distance to their first copy are one maximal run."""
    chain = Window.partitionBy("d", "first_d", "shift").orderBy("p", "r")
    steps = later.withColumn("shift", F.col("p") - F.col("first_p"))
    reached = F.max(F.col("p") + F.col("r")).over(chain.rowsBetween(Window.unboundedPreceding, -1))
    steps = steps.withColumn("new", F.coalesce((F.col("p") > reached).cast("int"), F.lit(1)))
    steps = steps.withColumn("run", F.sum("new").over(chain.rowsBetween(Window.unboundedPreceding, 0)))
    return steps.groupBy("d", "first_d", "shift", "run").agg(F.min("p").alias("start"), F.max(F.col("p") + F.col("r")).alias("end")).select(
        "d", "start", (F.col("end") - F.col("start")).alias("lines"), "first_d", (F.col("start") - F.col("shift")).alias("first_start"))


def _without(text: pd.Series, gone: pd.Series) -> pd.Series:
    """Texts without the lines of the given numbers."""
    def left(t: str, numbers) -> str:
        drop = set(numbers)
        kept = [s for i, s in enumerate(t.split("\n")) if i not in drop]
        return "\n".join(kept) if any(s.strip() for s in kept) else ""
    return pd.Series([None if t is None else left(t, g) for t, g in zip(text, gone)], dtype="object")


def dedupe_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                 n_removed: str | None = None) -> DataFrame:
    """The rows with later copies of repeated line runs cut out of ``text``; with
    ``n_removed`` also the number of lines cut. Of the scratch tables two stay, which
    the result reads."""
    names = docs.columns
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("d"), F.struct(*[docs[c] for c in names]).alias("row")), "line-documents")
    body = F.col("row")[text]
    found, later = _later_copies(rows.select("d", F.col("row")[key].alias("k"), text_of(body).alias("t")), min_words)
    gone = materialize(found.groupBy("d").agg(F.collect_list("raw").alias("gone")), "lines-gone")
    discard(found, later)
    # The list grows with the documents, so it is never broadcast; the texts move once.
    both = rows.join(gone.hint("merge"), "d", "left")
    without = F.pandas_udf(_without, "string")
    # Texts that lose no line do not go through Python.
    left = F.coalesce(without(F.when(F.col("gone").isNotNull(), body), F.col("gone")), body)
    both = both.select("row", left.alias("body"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n"))
    out = [(F.col("body") if c == text else F.col("row")[c]).alias(c) for c in names]
    return both.select(*out, *([F.when(F.col("n") > 0, F.col("n")).otherwise(F.lit(0)).cast("long").alias(n_removed)] if n_removed else []))
