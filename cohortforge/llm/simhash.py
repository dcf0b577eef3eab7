"""SimHash near-duplicates found through deletion-variant signatures.

A text's fingerprint is the bit majority over the XXH64 hashes of its word
shingles. Fingerprints within ``distance`` bits are cut into distance // 2 + 1
segments, so that one segment of every such pair differs by at most one bit.
Each segment is indexed once per bit with that bit removed; equal variants meet
in an equality join, and the whole fingerprints are compared there. A pair that
meets in several variants is taken in the first only, so each link occurs once.
Texts with equal fingerprints are one node: copies are never paired.

A bucket holds fingerprints that agree in all but one bit of a segment (31 of
32 bits for three bits of distance): at N distinct fingerprints some N / 2**31
unrelated ones. AQE splits buckets that are large.

Defined results: null and blank texts have fingerprint zero and are linked like
any other; rows with a null id belong to a component but never name it (a
component without any id has a null component id); repeated rows each get
their result row; other columns are not looked at; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.common import fresh_name, materialize, text_of
from cohortforge.llm.components import connected_components

SHINGLE, DISTANCE = 3, 3


def fingerprint_bytes(data: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a UTF-8 text as an unsigned integer."""
    import numpy as np
    import xxhash
    words = data.lower().split()  # bytes: A-Z only, and white space \x20 \x09-\x0D
    if not words:
        return 0
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    if len(words) <= shingle:
        return digest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = [0, *(ends[:-shingle] + 1).tolist()]
    total, n = np.zeros(64, dtype=np.int64), len(starts)
    ends = ends[shingle - 1:].tolist()
    for at in range(0, n, 1 << 16):
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[at:at + (1 << 16)], ends[at:at + (1 << 16)])),
                             dtype=np.uint64)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def fingerprint(col: Column | str, shingle: int = SHINGLE) -> Column:
    """Fingerprint of a text column as a long with the same 64 bits."""
    @F.pandas_udf("long")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np
        for part in parts:
            yield pd.Series(np.array([fingerprint_bytes(x, shingle) for x in part], dtype=np.uint64).view(np.int64))
    return of(text_of(col).cast("binary"))


def hex_fingerprint(col: Column | str) -> Column:
    """Sixteen lowercase hex digits."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments of which one differs by at most one bit."""
    n = distance // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _long(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def variants(fp: Column, distance: int) -> Column:
    """Array of (bit, segment value without that bit) for each of the 64 bits."""
    out = []
    for first, width in segments(distance):
        part = F.shiftrightunsigned(fp, first).bitwiseAND(_long((1 << width) - 1))
        out += [F.struct(F.lit(first + b).alias("bit"), part.bitwiseAND(_long(((1 << 64) - 1) ^ (1 << b))).alias("rest"))
                for b in range(width)]
    return F.array(*out)


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``u`` < ``v`` of distinct fingerprints (column ``fp``) within the distance."""
    if distance == 0:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).filter("false")
    index = fps.select("fp", F.explode(variants(F.col("fp"), distance)).alias("x")).select("x.*", "fp")
    a, b = index.withColumnRenamed("fp", "u"), index.withColumnRenamed("fp", "v")
    diff = F.col("u").bitwiseXOR(F.col("v"))
    first_meeting, earlier = F.lit(False), F.lit(True)
    for first, width in segments(distance):
        own = diff.bitwiseAND(_long(((1 << width) - 1) << first))
        here = F.col("bit").between(first, first + width - 1)
        first_meeting = first_meeting | (here & earlier & ((own != 0) | (F.col("bit") == first)))
        earlier = earlier & (F.bit_count(own) > 1)
    b = b.withColumnsRenamed({"bit": "bit_b", "rest": "rest_b"})
    on = ((F.col("bit") == F.col("bit_b")) & (F.col("rest") == F.col("rest_b")) & (F.col("u") < F.col("v"))
          & (F.bit_count(diff) <= distance) & first_meeting)
    # Spark sizes the index by its input, not by the 64 rows of each fingerprint, and
    # would broadcast it: the hint keeps it shuffled at any size.
    return a.hint("merge").join(b, on).select("u", "v")


def components(rows: DataFrame, key: str, distance: int = DISTANCE) -> DataFrame:
    """``fp`` and ``component_id`` (the smallest key of the component) for the
    distinct fingerprints of a materialized frame with columns ``key`` and ``fp``."""
    nodes = materialize(rows.groupBy("fp").agg(F.min(key).alias("low")), "fingerprints")
    labels = connected_components(links(nodes, distance))
    of = nodes.join(labels, nodes["fp"] == labels["node"], "left").select(
        "fp", "low", F.coalesce("label", "fp").alias("label"))
    of = materialize(of, "labels")
    lows = of.groupBy("label").agg(F.min("low").alias("component_id"))
    return of.join(lows, "label").select("fp", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """One row per input row: key, ``fp`` (long) and ``component_id``."""
    rows = materialize(docs.select(F.col(key).alias("k"), fingerprint(text, shingle).alias("fp")), "document-fps")
    found = components(rows, "k", distance)
    return rows.join(found, "fp", "left").select(F.col("k").alias(key), "fp", "component_id")


def dedupe(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
           distance: int = DISTANCE) -> DataFrame:
    """One row of each component, columns unchanged: that with the smallest key
    (null keys last; then the smallest hash of the whole row)."""
    names = docs.columns
    hashed, mark, same = fresh_name(docs, "row_hash"), fresh_name(docs, "mark"), fresh_name(docs, "same")
    whole = docs.withColumn(hashed, F.xxhash64(*[F.col(f"`{c}`") for c in names]))
    rows = materialize(whole.select(F.col(key).alias("k"), F.col(hashed).alias("h"), fingerprint(text, shingle).alias("fp")),
                       "document-fps")
    labels = connected_components(links(materialize(rows.select("fp").distinct(), "fingerprints"), distance))
    of = rows.groupBy("k", "h", "fp").agg(F.count("*").alias("n"))
    of = of.join(labels, of["fp"] == labels["node"], "left").withColumn("label", F.coalesce("label", "fp"))
    stays = of.groupBy("label").agg(F.min(F.struct(F.col("k").isNull().alias("no"), "k", "h", "n")).alias("s")).select(
        F.struct(F.coalesce(F.col("s.k").cast("string"), F.lit("")).alias("a"), F.col("s.no").alias("b")).alias(mark),
        F.col("s.h").alias(hashed), F.col("s.n").alias(same))
    found = whole.withColumn(mark, F.struct(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("a"),
                                            F.col(key).isNull().alias("b"))).join(stays, [mark, hashed])
    once = found.filter(F.col(same) == 1).select(names)
    return once.unionAll(found.filter(F.col(same) > 1).select(names).distinct())
