"""Removal of repeated byte strings by distributed sorting of suffixes.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else, in the same text or another, is removed. Such strings are found as equal
neighbours among sorted suffixes, compared over their first ``length`` bytes.

*Sort.* A suffix stands as two tokens, 64-bit fingerprints of the first half
and of all of the compared bytes. Splitters, taken from a sample of suffixes,
range-partition the suffixes by leading token, then second token, then a hash of
the place; so a string with very many copies is cut over as many buckets as its
share. A bucket sorts locally by multikey quicksort (three-way partitions on one
token after the other) and marks groups of two and more. A bucket's first and
last group may go on in its neighbours: their counts, two rows a bucket, are
added up by token, and members that a bucket could not decide are marked then.

*Fewer suffixes.* Sorting one suffix per byte would shuffle some thirty times
the text. Four sorts with few suffixes decide the same:

1. Each window of ``length`` bytes holds an anchor: of all strings of half its
   length in it, the first with the least fingerprint. Equal windows have equal
   anchors at equal places. Each anchor is a suffix, compared over half the
   length; windows of an anchor that occurs once have no equal. Anchors that agree
   in all their windows' bytes decide them at once, and one stands for all in
   the next sorts; so copies go no further.
2. Of a repeated anchor's windows, those that begin a multiple of ``length // 10``
   bytes before it are sorted. Equal windows are both such ones or neither.
3. The windows between two such ones share a core, ``length // 10 - 2`` bytes
   shorter than a window. The cores are sorted; a group is followed up if it has two
   members and in one of them the windows between could add to the covered
   bytes, i.e. don't lie between equal windows at most ``length`` bytes apart. Again
   members that agree in all bytes are decided, and one stands for them.
4. The windows of those cores are sorted one by one.

The texts are written once, bucketed by row, so that joining them with places
shuffles the places alone. Suffixes are shuffled in blocks, one per task, bucket and
batch. A bucket of suffixes is held in memory; its size falls with the number of
shuffle partitions. A false match needs equal fingerprints: 128 bits for strings
that differ in their first half, 64 for others.

Defined results: null texts are empty; texts shorter than ``length`` lose nothing;
exact copies lose all bytes if they are long enough; rows are told apart by place,
so null and repeated keys are rows of their own; other columns are not looked at;
an empty table gives an empty result. What is kept is bytes: a cut may fall
within a character.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.common import discard, new_scratch, text_of, write_once

LENGTH = 200
BLOCK_BITS = 18
SAMPLE_ROWS, SAMPLE_MOST = 64, 1_000_000
SMALL_SORT = 4096
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)
PIECE_BYTES = 1 << 22
BLOCKS = pa.schema([("b", pa.int32()), ("block", pa.binary())])
SAMPLE = pa.schema([("t0", pa.int64()), ("t1", pa.int64()), ("tie", pa.int64())])
MARKED = pa.schema([("kind", pa.int8()), ("rid", pa.int64()), ("loc", pa.int64()), ("t0", pa.int64()), ("t1", pa.int64()),
                    ("c", pa.int64()), ("need", pa.bool_())])
REPEATED, PENDING, EDGE, COVERED = range(4)


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(29)
    h *= M3
    h ^= h >> np.uint64(32)
    return h


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as an integer, without a copy."""
    return np.ndarray(shape=(max(len(data) - 7, 0),), dtype="<u8", buffer=data, strides=(1,))


def _chain(words: np.ndarray, at: np.ndarray, length: int, multiplier: np.uint64) -> np.ndarray:
    if not len(at):
        return np.zeros(0, np.int64)
    offsets = [*range(0, length - 7, 8)]
    if offsets[-1] + 8 < length:
        offsets.append(length - 8)
    h = np.full(len(at), length, dtype=np.uint64)
    for off in offsets:
        h ^= words[at + off]
        h *= multiplier
        h ^= h >> np.uint64(32)
    return _mix(h).view(np.int64)


def tokens_at(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The two tokens of the suffixes at some places, compared over ``length`` bytes."""
    words = _words(data)
    return _chain(words, at, length // 2, M1), _chain(words, at, length, M2)


def rolling(data: np.ndarray, length: int) -> np.ndarray:
    """Fingerprint of the string of ``length`` bytes (8 at least) at each place."""
    h = _mix(_words(data) * M1)
    span = 8
    while span < length:
        step = min(span, length - span)
        left = h[:len(h) - step] * M2
        left += h[step:]
        h, span = _mix(left), span + step
    return h


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive keys."""
    span = 1
    while span < width:
        step = min(span, width - span)
        keys, span = np.minimum(keys[:len(keys) - step], keys[step:]), span + step
    return keys


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of the texts ``data[starts:ends]``: text, place in the data, first and
    last window that has it, fingerprint. Blocks of windows bound the memory."""
    gram, mask = length // 2, np.uint64((1 << (BLOCK_BITS + 1)) - 1)
    has_window = np.zeros(len(data) + 1, dtype=bool)
    for s, e in zip(starts.tolist(), ends.tolist()):
        if e - s >= length:
            has_window[s:e - length + 1] = True
    last, found = -1, []
    for at in range(0, max(len(data) - length + 1, 0), 1 << BLOCK_BITS):
        to = min(at + (1 << BLOCK_BITS), len(data) - length + 1)
        windows = np.flatnonzero(has_window[at:to])
        if not len(windows):
            continue
        h = rolling(data[at:to + length - 1], gram)
        least = _least((h & ~mask) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
        place = (least[windows] & mask).astype(np.int64)
        new = np.append(place[0] + at != last, place[1:] != place[:-1])
        last = int(place[-1]) + at
        found.append((windows[new] + at, place[new] + at, h[place[new]].view(np.int64)))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    first, place, h = (np.concatenate(c) for c in zip(*found))
    text = np.searchsorted(starts, first, side="right") - 1
    final = ends[text] - length
    follows = text[1:] == text[:-1]
    final[:-1][follows] = first[1:][follows] - 1
    return text, place, first, final, h


def multikey_quicksort(keys: list[np.ndarray]) -> np.ndarray:
    """Order of the rows by the first key, then the next: three-way partitions on
    one key at a time, small parts at once."""
    out, todo = [], [(np.arange(len(keys[0])), 0)]
    while todo:
        rows, k = todo.pop()
        if k == len(keys) or len(rows) < 2:
            out.append(rows)
        elif len(rows) <= SMALL_SORT:
            out.append(rows[np.lexsort([key[rows] for key in reversed(keys[k:])])])
        else:
            own = keys[k][rows]
            pivot = np.sort(own[[0, len(own) // 2, -1]])[1]
            below, above = own < pivot, own > pivot
            todo += [(rows[above], k), (rows[~(below | above)], k + 1), (rows[below], k)]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def bucket_of(keys: list[np.ndarray], splits: list[np.ndarray]) -> np.ndarray:
    """Number of splitters (sorted by all keys) at or before each row."""
    high = np.searchsorted(splits[0], keys[0], side="right")
    if len(keys) == 1:
        return high
    low = np.searchsorted(splits[0], keys[0], side="left")
    out, tied = low.copy(), np.flatnonzero(high > low)
    for at in np.unique(low[tied]).tolist():  # strings that occur in the splitters themselves
        rows = tied[low[tied] == at]
        to = high[rows[0]]
        out[rows] += bucket_of([k[rows] for k in keys[1:]], [s[at:to] for s in splits[1:]])
    return out


def _place_hash(rid: np.ndarray, loc: np.ndarray) -> np.ndarray:
    h = rid.astype(np.uint64) * M1
    h += loc.astype(np.uint64) * M2
    return _mix(h).view(np.int64)


Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with some megabytes of text (column 1), which bounds what a step holds."""
    _, _, ends = _texts(batch.column(1))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, before + PIECE_BYTES, side="right")), at + 1)
        yield batch.slice(at, to - at)
        at = to


def _suffixes(batches: Iterator[pa.RecordBatch], find: Callable[[pa.RecordBatch], Found], splits: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Blocks of suffixes by bucket: tokens, row, and place * 2 + need, column by column."""
    for batch in batches:
        parts = [find(piece) for piece in _pieces(batch)]
        if not parts:
            continue
        t0, t1, rid, loc, need = (np.concatenate(c) for c in zip(*parts))
        b = bucket_of([t0, t1, _place_hash(rid, loc)], splits)
        order = np.argsort(b, kind="stable")
        table, b = np.stack([t0, t1, rid, loc * 2 + need])[:, order], b[order]
        starts = np.flatnonzero(np.append(len(b) > 0, b[1:] != b[:-1]))
        blocks = [table[:, s:e].tobytes() for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(b)])]
        yield pa.RecordBatch.from_arrays([pa.array(b[starts], pa.int32()), pa.array(blocks, pa.binary())], schema=BLOCKS)


def _sampled(batches: Iterator[pa.RecordBatch], find: Callable[[pa.RecordBatch], Found], one_in: int) -> Iterator[pa.RecordBatch]:
    """One suffix in so many, with the hash of its place."""
    for batch in batches:
        for piece in _pieces(batch):
            t0, t1, rid, loc, _ = find(piece)
            tie = _place_hash(rid, loc)
            some = tie.view(np.uint64) % np.uint64(one_in) == 0
            yield pa.RecordBatch.from_arrays([pa.array(c[some]) for c in (t0, t1, tie)], schema=SAMPLE)


def _mark(batches: Iterator[pa.RecordBatch], nested: bool) -> Iterator[pa.RecordBatch]:
    """One bucket of suffixes to the places of its repeated strings, of those it
    can't decide, and the counts of its first and last group. ``nested``: groups
    share the first token; members that share the second too and need it are
    covered, and the first of them stands for them."""
    blocks = [np.frombuffer(x.as_buffer(), np.int64).reshape(4, -1) for b in batches for x in b.column(1)]
    if not blocks:
        return
    t0, t1, rid, x = np.concatenate(blocks, axis=1)
    del blocks
    order = multikey_quicksort([t0, t1])
    t0, t1, rid, x = t0[order], t1[order], rid[order], x[order]
    new = np.append(True, (t0[1:] != t0[:-1]) | (t1[1:] != t1[:-1]))
    firsts = np.flatnonzero(new)
    starts = np.flatnonzero(np.append(True, t0[1:] != t0[:-1])) if nested else firsts
    sizes = np.diff(np.append(starts, len(t0)))
    need = np.bitwise_or.reduceat(x & 1, starts).astype(bool)
    edge = np.zeros(len(starts), dtype=bool)
    edge[[0, -1]] = True
    decided = need & (sizes > 1)

    def rows(kind: int, at: np.ndarray, with_token: bool = False, c: np.ndarray | None = None, needed: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        for cut in range(0, len(at), 200_000):
            part = slice(cut, cut + 200_000)
            i = at[part]
            none = lambda t: pa.nulls(len(i), t)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(i), kind, np.int8)), pa.array(rid[i]), pa.array(x[i] >> 1),
                pa.array(t0[i]) if with_token else none(pa.int64()), pa.array(t1[i]) if with_token and not nested else none(pa.int64()),
                none(pa.int64()) if c is None else pa.array(c[part]), none(pa.bool_()) if needed is None else pa.array(needed[part])], schema=MARKED)

    own = np.repeat(np.arange(len(starts)), sizes)  # the group of each member
    stands = np.ones(len(t0), dtype=bool)
    if nested:
        same = np.repeat(np.diff(np.append(firsts, len(t0))), np.diff(np.append(firsts, len(t0))))
        yield from rows(COVERED, np.flatnonzero((same > 1) & (x & 1 == 1)))
        stands = new
        kinds = np.add.reduceat(new.astype(np.int64), starts)
        decided &= (kinds > 1) | edge  # members that all agree are done
    yield from rows(REPEATED, np.flatnonzero(decided[own] & stands))
    yield from rows(PENDING, np.flatnonzero((edge & ~decided)[own] & stands), True)
    yield from rows(EDGE, starts[edge], True, sizes[edge], need[edge])


def repeated(source: Callable[[bool], DataFrame], find: Callable[[pa.RecordBatch], Found], one_in: int, nested: bool,
             name: str) -> tuple[DataFrame, DataFrame]:
    """``rid`` and ``loc`` of the suffixes that ``find`` makes of the rows of
    ``source(sample)`` and whose string occurs twice, with one member that needs
    it; and the table with all that the buckets found."""
    sample = source(True)
    spark = sample.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = sample.mapInArrow(lambda it: _sampled(it, find, one_in), "t0 long, t1 long, tie long").limit(SAMPLE_MOST).toPandas()
    keys = [seen[c].to_numpy(dtype=np.int64) for c in SAMPLE.names]
    order = np.lexsort(keys[::-1])
    cuts = order[np.linspace(0, len(order), buckets + 1).astype(np.int64)[1:-1]] if len(order) else order
    splits = [k[cuts] for k in keys]
    blocks = source(False).mapInArrow(lambda it: _suffixes(it, find, splits), "b int, block binary")
    marked = write_once(blocks.repartitionById(buckets, F.col("b")).mapInArrow(
        lambda it: _mark(it, nested), "kind byte, rid long, loc long, t0 long, t1 long, c long, need boolean"), name)
    key = ["t0"] if nested else ["t0", "t1"]
    edges = marked.filter(F.col("kind") == EDGE).groupBy(*key).agg(F.sum("c").alias("c"), F.max("need").alias("need"))
    edges = edges.filter("c > 1 and need").select(*key)  # two rows a bucket at most
    late = marked.filter(F.col("kind") == PENDING).select(*key, "rid", "loc").join(F.broadcast(edges), key, "left_semi")
    return marked.filter(F.col("kind") == REPEATED).select("rid", "loc").unionByName(late.select("rid", "loc")), marked


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a binary column and where its texts start and end."""
    _, offsets, data = column.buffers()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(offsets, wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0]:ends[-1]], ends[:-1] - ends[0], ends[1:] - ends[0]


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of a list column; null lists are empty."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), sizes), values


def _span_token(data: np.ndarray, first: np.ndarray, final: np.ndarray, sides: np.ndarray, length: int) -> np.ndarray:
    """Fingerprint of the bytes of all windows from ``first`` to ``final`` (which
    overlap) and of where they lie."""
    words = _words(data)
    h = _chain(words, first, length, M2).view(np.uint64) * M1
    h += _chain(words, final, length, M1).view(np.uint64)
    h ^= sides.astype(np.uint64) * M3
    return _mix(h).view(np.int64)


def find_anchors(batch: pa.RecordBatch, length: int) -> Found:
    """loc: place << 16 | bytes from the first window << 8 | bytes from the last window."""
    data, starts, ends = _texts(batch.column(1))
    text, place, first, final, h = anchors(data, starts, ends, length)
    rid = batch.column(0).to_numpy()[text]
    sides = (place - first << 8) | (place - final)
    loc = (place - starts[text] << 16) | sides
    return h, _span_token(data, first, final, sides, length), rid, loc, np.ones(len(h), np.int64)


def find_lattice(batch: pa.RecordBatch, length: int) -> Found:
    """Windows of repeated anchors a multiple of the step before them; loc: place."""
    step = length // 10
    data, starts, _ = _texts(batch.column(1))
    row, loc = _lists(batch.column(2))
    before = np.arange(0, length - length // 2 + 1, step)
    which, k = np.nonzero((before >= (loc & 255)[:, None]) & (before <= (loc >> 8 & 255)[:, None]))
    row, at = row[which], (loc >> 16)[which] - before[k]
    t0, t1 = tokens_at(data, starts[row] + at, length)
    return t0, t1, batch.column(0).to_numpy()[row], at, np.ones(len(at), np.int64)


def find_cores(batch: pa.RecordBatch, length: int) -> Found:
    """Cores between those windows; loc: first window << 8 | number of windows."""
    step = length // 10
    data, starts, _ = _texts(batch.column(1))
    row, loc = _lists(batch.column(2))
    known_row, known = _lists(batch.column(3))
    far = np.int64(1 << 40)
    known = np.sort(known_row * far + known)
    q = np.arange(0, length - length // 2, step)
    nearest = np.maximum((loc & 255)[:, None], q + 1)
    farthest = np.minimum((loc >> 8 & 255)[:, None], q + step - 1)
    which, k = np.nonzero(nearest <= farthest)
    row, place = row[which], (loc >> 16)[which]
    first, last = place - farthest[which, k], place - nearest[which, k]
    core = place - q[k] - 1
    base = starts[row]
    t0 = _chain(_words(data), base + core, length - step + 2, M1)
    t1 = _span_token(data, base + first, base + last, (core - first << 8) | (core - last), length)
    padded = np.concatenate([[-far], known, [np.int64(1 << 62)]])
    after = np.searchsorted(padded, row * far + first)
    need = padded[after] - padded[after - 1] > length
    return t0, t1, batch.column(0).to_numpy()[row], (first << 8) | (last - first + 1), need.astype(np.int64)


def find_windows(batch: pa.RecordBatch, length: int) -> Found:
    """All windows of the cores; loc: place."""
    data, starts, _ = _texts(batch.column(1))
    row, loc = _lists(batch.column(2))
    n = loc & 255
    ends = np.cumsum(n)
    at = np.repeat((loc >> 8) - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
    row = np.repeat(row, n)
    t0, t1 = tokens_at(data, starts[row] + at, length)
    return t0, t1, batch.column(0).to_numpy()[row], at, np.ones(len(at), np.int64)


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    for batch in (piece for whole in batches for piece in _pieces(whole)):
        out = []
        for text, places in zip(batch.column(1).to_pylist(), batch.column(2)):
            if not places.is_valid:
                out.append((len(text), 0, 0, text))
                continue
            at = np.unique(places.values.to_numpy())
            new = np.flatnonzero(np.append(True, np.diff(at) > length))
            first, last = at[new], at[np.append(new[1:] - 1, len(at) - 1)] + length
            kept = b"".join(text[a:b] for a, b in zip([0, *last.tolist()], [*first.tolist(), len(text)]))
            out.append((len(text), len(text) - len(kept), len(first), kept))
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, schema))], ["k", *schema.names])


def dedupe(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and
    ``kept`` (the remaining bytes) of every row. ``length`` is a multiple of ten, 100
    to 500 (places before an anchor take a byte)."""
    if length % 10 or not 100 <= length <= 500:
        raise ValueError("length must be a multiple of ten from 100 to 500")
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("k"), text_of(text).cast("binary").alias("t"))
    table, folder = f"cohortforge_{uuid.uuid4().hex}", new_scratch(spark, "suffix-texts")
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup)
    spark.conf.set(cleanup, "true")
    rows.repartition(buckets, "rid").write.bucketBy(buckets, "rid").option("compression", "zstd").option("path", folder).saveAsTable(table)
    spark.conf.set(cleanup, before)
    texts = spark.table(table)
    n = texts.count()
    wanted = max(500, 2 * buckets)
    # Splitters only balance the buckets; a document in so many gives the sample.
    some = write_once(texts.filter(F.pmod(F.xxhash64("rid"), F.lit(max(n // wanted, 1))) == 0).select("rid", "t"), "suffix-sample")
    one_in = max(1, 50 * min(n, wanted) // min(SAMPLE_ROWS * buckets, SAMPLE_MOST))

    def lists(**places: DataFrame):
        both = None
        for column, frame in places.items():
            own = frame.groupBy("rid").agg(F.collect_list("loc").alias(column))
            both = own if both is None else both.join(own, "rid", "left")

        def source(sample: bool) -> DataFrame:
            return (some if sample else texts).select("rid", "t").join(both, "rid").select("rid", "t", *places)
        return source

    def step(find, source, name, nested=False, thin=max(one_in // 4, 1)):
        return repeated(source, lambda batch: find(batch, length), thin, nested, name)

    def ends(marked, first, last):
        """First and last window of the members that are covered as a whole."""
        both = F.explode(F.array(F.expr(first), F.expr(last))).alias("loc")
        return marked.filter(F.col("kind") == COVERED).select("rid", both)

    anchored, t_1 = step(find_anchors, lambda sample: (some if sample else texts).select("rid", "t"), "suffix-anchors", True, one_in)
    lattice, t_2 = step(find_lattice, lists(a=anchored), "suffix-lattice")
    known = ends(t_1, "(loc >> 16) - ((loc >> 8) & 255)", "(loc >> 16) - (loc & 255)").unionByName(lattice)
    cores, t_3 = step(find_cores, lists(a=anchored, k=known), "suffix-cores", True)
    windows, t_4 = step(find_windows, lists(c=cores), "suffix-windows")
    known = known.unionByName(ends(t_3, "loc >> 8", "(loc >> 8) + (loc & 255) - 1")).unionByName(windows)
    places = known.groupBy("rid").agg(F.collect_list("loc").alias("p"))
    kind = docs.schema[key].dataType.simpleString()
    found = texts.join(places, "rid", "left").select("k", "t", "p").mapInArrow(
        lambda it: _cut(it, length), f"k {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    discard(some)
    return found.withColumnRenamed("k", key)
