"""Conversation structure repair by a persistent audit DP.

A conversation is in order if its role initials are ``(s?(ua)+)?``. Rows are
kept (0), reroled to user or assistant (2), deleted (3, a must for blank and
duplicate rows) or preceded or followed by inserted empty rows (2 each); a
truncated row that stays costs 1 more. The cheapest edits win, then the
ASCII-least audit, the string of the edits' initials.

The DP goes row by row over four states: nothing yet, after s, after u, after a.
A state's audit is a linked node that shares its prefix with others and knows
its 2**k-th ancestors and a rolling hash. Audits of equal cost are compared by a
longest-common-prefix search over the ancestors' hashes; the prefix found equal
is verified node by node up to the shared one, and a collision falls back to the
spelled strings. In one state an audit is never the beginning of another of
equal cost (the longer one would hold further insertions), so the lesser prefix
gives the lesser whole.

A long conversation is cut into segments of ``SEGMENT`` rows. Each segment runs
the DP from every state it can start in, so rows of one conversation go through
many tasks; a conversation's segments are then chained by the states at their
borders, from at most 16 audits a segment. Only the SHA-256 of the repaired text,
a chain by its nature, streams through one task a conversation, with the memory
of one segment's audit. Places and duplicates are found by range partitions and
by aggregates that combine before the shuffle.

Defined results: a null conversation id is a conversation; null roles and texts
are one space (:func:`damage` sets them; :func:`repair` does for rows that come
with nulls); null turns come first; rows of equal turn go by role, then by the
text's first 256 characters, then by its hash; repeated rows are duplicates;
other roles than system, user and assistant count by their first character,
case as it is; empty tables give empty results, conversations without rows zeros,
an empty audit and the hash of the empty string; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.common import discard, ranked, write_once

SEGMENT = 4096
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
BASE, MODULUS = 911_382_323, (1 << 61) - 1


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows damaged by the CRC-32 of ``conv:turn``, modulo 20: 0 is dropped, 1 loses
    its text, 2 its ``[.!?]``, 3 stands twice, 4 gets role user. Nulls are one space,
    but a null turn stays null for the order."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))) % 20
    given = F.coalesce(text, space)
    changed = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(given, "[.!?]", "")).otherwise(given)
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.when(kind == 4, "user").otherwise(F.coalesce(role, space)).alias("role"),
        changed.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


def is_blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def is_truncated(text: Column) -> Column:
    """The last character that is not white space is none of ``.!?``."""
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


class Audits:
    """Strings that grow by one character and share their prefixes."""

    def __init__(self):
        self.up: list[list[int]] = [[]]
        self.char, self.depth, self.hash = [""], [0], [0]

    def extend(self, node: int, char: str) -> int:
        up, at, k = self.up, node, 0
        mine = [node]
        while k < len(up[at]):
            at = up[at][k]
            mine.append(at)
            k += 1
        up.append(mine)
        self.char.append(char)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * BASE + ord(char)) % MODULUS)
        return len(up) - 1

    def ancestor(self, node: int, depth: int) -> int:
        left, k = self.depth[node] - depth, 0
        while left:
            if left & 1:
                node = self.up[node][k]
            left, k = left >> 1, k + 1
        return node

    def _same(self, a: int, b: int) -> bool:
        """Whether two audits of one length are equal; they meet at their shared prefix."""
        while a != b:
            if self.char[a] != self.char[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the audit of ``a`` comes before that of ``b`` in ASCII order."""
        shorter = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, shorter), self.ancestor(b, shorter)
        if self.hash[x] == self.hash[y]:
            if self._same(x, y):
                return self.depth[a] < self.depth[b]
            return self.spell(a) < self.spell(b)
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if self._same(self.up[x][0], self.up[y][0]):
            return self.char[x] < self.char[y]
        return self.spell(a) < self.spell(b)

    def spell(self, node: int) -> str:
        out = []
        while node:
            out.append(self.char[node])
            node = self.up[node][0]
        return "".join(reversed(out))


def _follows(state: int) -> int:
    """The state of the user or assistant row that may come next."""
    return ASSISTANT if state == USER else USER


def _keeps(state: int, initial: str) -> int | None:
    """The state after a row that is kept, None where it can't be."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def best_audits(rows: list[tuple[str, int]], start: int, first: bool) -> dict[int, tuple[int, str]]:
    """Cost and audit of the cheapest edits of (initial, fault) rows from state
    ``start`` to each state; ``first``: rows may be inserted before the first."""
    audits = Audits()

    def offer(best: dict, state: int, cost: int, node: int, char: str) -> None:
        known = best.get(state)
        if known is None or cost < known[0]:
            best[state] = cost, audits.extend(node, char)
        elif cost == known[0]:
            other = audits.extend(node, char)
            if audits.less(other, known[1]):
                best[state] = cost, other

    def insert(best: dict) -> None:
        for _ in range(2):  # a third row in between never pays
            for state, (cost, node) in list(best.items()):
                if best[state] == (cost, node):
                    offer(best, _follows(state), cost + INSERT, node, "I")

    best = {start: (0, 0)}
    if first:
        insert(best)
    for initial, fault in rows:
        after: dict[int, tuple[int, int]] = {}
        extra = int(fault == TRUNCATED)
        for state, (cost, node) in best.items():
            offer(after, state, cost + DELETE, node, "D")
            if fault not in (BLANK, DUPLICATE):
                to = _keeps(state, initial)
                if to is not None:
                    offer(after, to, cost + KEEP + extra, node, "K")
                offer(after, _follows(state), cost + REROLE + extra, node, "R")
        insert(after)
        best = after
    return {state: (cost, audits.spell(node)) for state, (cost, node) in best.items()}


SEGMENT_ROW = pa.struct([("seg", pa.int64()), ("illegal", pa.int64()), ("head", pa.string()), ("tail", pa.string()),
                         ("cells", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])
SEGMENTS = "seg long, illegal long, head string, tail string, cells array<struct<s:int,e:int,cost:long,audit:string>>"


def _is_legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, seg, initial, fault), sorted, to one row per segment."""
    key, rows = None, []

    def done() -> dict:
        pairs = zip(rows, rows[1:])
        cells = [{"s": s, "e": e, "cost": cost, "audit": audit}
                 for s in ((START,) if key[1] == 0 else range(4)) for e, (cost, audit) in best_audits(rows, s, key[1] == 0).items()]
        return {"seg": key[1], "illegal": sum(not _is_legal(a[0], b[0]) for a, b in pairs),
                "head": rows[0][0], "tail": rows[-1][0], "cells": cells}

    def out(found: list) -> pa.RecordBatch:
        data = pa.array([x for _, x in found], SEGMENT_ROW)
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], kind), *data.flatten()], ["conv_id", *(f.name for f in SEGMENT_ROW)])

    kind = None
    for batch in batches:
        kind, found = batch.schema.field(0).type, []
        for conv, seg, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (conv, seg):
                if rows:
                    found.append((key[0], done()))
                key, rows = (conv, seg), []
            rows.append((initial, fault))
        if found:
            yield out(found)
    if rows:
        yield out([(key[0], done())])


def _common(texts: list[str]) -> int:
    a, b = min(texts), max(texts)
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def chain(segments: list[dict]) -> tuple[int, list[tuple[int, str]]]:
    """Cost of the best edits of a whole conversation, and the state each segment
    starts in with its part of the audit. What all states' audits begin with is
    cut off as the chain goes on, so comparisons stay short."""
    best: dict[int, tuple[int, str]] = {START: (0, "")}
    back: list[dict[int, tuple[int, str]]] = []
    for segment in segments:
        after, came = {}, {}
        for c in segment["cells"]:
            if c["s"] in best:
                cost, audit = best[c["s"]]
                new = cost + c["cost"], audit + c["audit"]
                if c["e"] not in after or new < after[c["e"]]:
                    after[c["e"]], came[c["e"]] = new, (c["s"], c["audit"])
        cut = _common([audit for _, audit in after.values()])
        best = {e: (cost, audit[cut:]) for e, (cost, audit) in after.items()}
        back.append(came)
    state = min((e for e in (START, ASSISTANT) if e in best), key=lambda e: best[e])
    cost, parts = best[state][0], []
    for came in reversed(back):
        state, audit = came[state]
        parts.append((state, audit))
    return cost, parts[::-1]


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts_type = pa.list_(pa.struct([("seg", pa.int64()), ("start", pa.int32()), ("audit", pa.string())]))
    for batch in batches:
        out = []
        for segments in batch.column(1).to_pylist():
            cost, parts = chain(segments)
            borders = sum(not _is_legal(a["tail"], b["head"]) for a, b in zip(segments, segments[1:]))
            out.append((sum(s["illegal"] for s in segments) + borders, cost, "".join(a for _, a in parts),
                        [{"seg": s["seg"], "start": p[0], "audit": p[1]} for s, p in zip(segments, parts)]))
        columns = list(zip(*out)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), parts_type)))],
            ["conv_id", "illegal", "cost", "audit", "parts"])


class _Writer:
    """SHA-256 of a conversation's repaired lines, as its rows come by."""

    def __init__(self):
        self.sha, self.first, self.state, self.left, self.at = hashlib.sha256(), True, START, "", 0

    def line(self, role: str, text: str) -> None:
        self.sha.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def _next(self) -> str:
        self.state = _follows(self.state)
        return "assistant" if self.state == ASSISTANT else "user"

    def inserts(self) -> None:
        while self.left[self.at:self.at + 1] == "I":
            self.line(self._next(), "")
            self.at += 1

    def segment(self, start: int, audit: str) -> None:
        self.state, self.left, self.at = start, audit, 0
        self.inserts()

    def row(self, role: str, text: str) -> None:
        edit, self.at = self.left[self.at], self.at + 1
        if edit == "K":
            self.state = _keeps(self.state, role[:1])
            self.line(role, text)
        elif edit == "R":
            self.line(self._next(), text)
        self.inserts()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, kind, start, role, text) in order, a segment's audit (kind 0) before its rows."""
    now, writer, kind = None, None, None
    for batch in batches:
        kind, found = batch.schema.field(0).type, []
        for conv, is_row, start, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if writer is None or now != conv:
                if writer is not None:
                    found.append((now, writer.sha.hexdigest()))
                now, writer = conv, _Writer()
            if is_row:
                writer.row(role, text)
            else:
                writer.segment(start, text)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], kind), pa.array([h for _, h in found])], ["conv_id", "sha"])
    if writer is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([writer.sha.hexdigest()])], ["conv_id", "sha"])


def find_faults(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with ``i``, their place, and ``fault``, the
    first that holds of blank, duplicate and truncated."""
    space = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    rows = rows.withColumns({"h": F.sha2("text", 256), "r": F.monotonically_increasing_id()})
    rows = write_once(rows, "conversation-rows")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 256), F.col("h"), F.col("r")]
    rows = write_once(ranked(rows, ["conv_id"], order, "conversation-order"), "conversation-places")
    seen = rows.filter(~is_blank(F.col("text"))).groupBy("conv_id", "role", "h").agg(F.min("i").alias("earliest"), F.count("*").alias("c"))
    seen = seen.filter("c > 1").select("conv_id", "role", "h", "earliest").withColumnsRenamed({"conv_id": "c_", "role": "r_", "h": "h_"})
    same = F.col("conv_id").eqNullSafe(F.col("c_")) & (F.col("role") == F.col("r_")) & (F.col("h") == F.col("h_"))
    fault = (F.when(is_blank(F.col("text")), BLANK).when(F.col("i") > F.col("earliest"), DUPLICATE)
             .when(is_truncated(F.col("text")), TRUNCATED).otherwise(NONE))
    return rows.join(seen, same, "left").select("conv_id", "turn", "role", "text", "i", fault.alias("fault"))


def repair(rows: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows``, and of ``keys`` (conv_id) where given:
    ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost``, ``audit``, ``repaired_sha256``."""
    rows = write_once(find_faults(rows), "conversation-faults")
    kind = rows.schema["conv_id"].dataType.simpleString()
    per_row = rows.select("conv_id", F.floor(F.col("i") / SEGMENT).cast("long").alias("seg"), "i",
                          F.substring("role", 1, 1).alias("initial"), "fault")
    segments = per_row.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "i").select("conv_id", "seg", "initial", "fault")
    segments = segments.mapInArrow(_segments, f"conv_id {kind}, {SEGMENTS}")
    whole = segments.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("seg", "illegal", "head", "tail", "cells"))).alias("s"))
    chains = write_once(whole.mapInArrow(_chains, f"conv_id {kind}, illegal long, cost long, audit string, "
                                         "parts array<struct<seg:long,start:int,audit:string>>"), "conversation-audits")
    parts = chains.select("conv_id", F.explode("parts").alias("p")).select(
        "conv_id", (F.col("p.seg") * SEGMENT).alias("i"), F.lit(False).alias("is_row"), F.col("p.start").alias("start"),
        F.lit("").alias("role"), F.col("p.audit").alias("text"))
    lines = parts.unionByName(rows.select("conv_id", "i", F.lit(True).alias("is_row"), F.lit(0).alias("start"), "role", "text"))
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "i", "is_row").select("conv_id", "is_row", "start", "role", "text")
    hashes = lines.mapInArrow(_hashes, f"conv_id {kind}, sha string")
    count = lambda fault: F.count_if(F.col("fault") == fault)
    span = F.max("turn") - F.min("turn") + 1
    counts = rows.groupBy("conv_id").agg(count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(TRUNCATED).alias("truncated"))
    turns = rows.filter(F.col("turn").isNotNull()).select("conv_id", "turn").distinct()
    spread = turns.groupBy("conv_id").agg((span - F.count("*")).cast("long").alias("gaps"))
    all_keys = rows.select("conv_id") if keys is None else rows.select("conv_id").unionByName(keys.select("conv_id"))
    found = all_keys.distinct()
    for side in (counts, spread, chains.select("conv_id", "illegal", "cost", "audit"), hashes):
        side = side.withColumnRenamed("conv_id", "c_")
        found = found.join(side, F.col("conv_id").eqNullSafe(F.col("c_")), "left").drop("c_")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    done = write_once(found.select("conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
                                   F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256")), "conversation-repairs")
    discard(rows, chains)
    return done
