"""Token ids as length-delimited binary records with an offset index.

A shard holds framed records in ascending key order:

    length   u64   bytes of the payload
    check    u32   masked CRC-32 of the length's 8 bytes
    payload  u8 flags (1: key present, 2: ids of 4 bytes, else of 2), i64 key, ids
    check    u32   masked CRC-32 of the payload

all little-endian; masked is ((crc >> 15 | crc << 17) + 0xa282ead8) mod 2**32, so
that the checksum of data that hold checksums stays strong. Beside each shard
lies an index, (u64 offset, u64 length) per record, for shuffled reads.

Rows are range-partitioned by (key, hash of the text, row number), so that a key
that repeats does not fill one task; each task sorts its range, encodes it and
writes one shard under a temporary name that is renamed at the end. A task that
runs again writes the same shard again.

Defined results: null texts are empty and hold the end id only; null keys come
first; rows that share a key are ordered by a hash of their text, repeated rows
follow each other; other columns are not looked at; an empty table writes no shard and gives
an empty result. Keys are integers. Paths are those of ``pyarrow.fs``.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from string import punctuation as PUNCTUATION
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortforge.llm.common import materialize, new_scratch, text_of

MASK_DELTA = 0xA282EAD8
HAS_KEY, WIDE = 1, 2
HEAD = struct.Struct("<Bq")
MAX_CACHED, MAX_CACHED_CHARS, WORDS_AT_ONCE, GROUP_CHARS, ROWS_OUT = 800_000, 40, 2_000, 1 << 22, 10_000
MARKS = frozenset(PUNCTUATION)
# Letters that every Unicode version knows; marks after them are a piece of their own.
LETTERS = f"^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af]{{1,{MAX_CACHED_CHARS}}}$"
SPACE_RUN, CUT = re.compile(r" (?:\s|$)"), re.compile(r" (?=\S)")
# The byte-level alphabet writes the bytes that are no printable Latin-1 character from U+0100 on:
# 33 below 0x21, then 0x7F to 0xA0 and 0xAD.
HIGH_BYTES = {b: 0x100 + 33 + i for i, b in enumerate([*range(0x7F, 0xA1), 0xAD])}
NEWLINE_RUN = re.compile(r"\n(?:\s|\Z|(?<=\s\n))")


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


class Encoder:
    """Encodes texts with a tokenizer file and returns the ids as bytes.

    A byte-level tokenizer starts a new piece at every space that a non-space
    follows. Such texts are encoded word by word: Arrow splits a group of texts and
    finds its distinct words, the library encodes those not seen before, and one
    ``take`` lays the ids of all words in a row. Words of Latin letters, less the
    marks behind them, are one piece each and go to the library's model without its
    pattern; they are remembered in an Arrow table (beyond ``MAX_CACHED`` only those
    of the last group stay), other short words in a dict (at most two times
    ``MAX_CACHED``). A text with the string of an added token goes to the library
    whole, as do all texts of any other tokenizer."""

    def __init__(self, path: str, end_id: int):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (spec.get("normalizer") is None and spec["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel"
                        and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
        self.wide = max(self.model.get_vocab_size(), end_id + 1) > 1 << 16
        self.end = struct.pack("<I" if self.wide else "<H", end_id)
        self.opens = self.newline = None
        if self.by_word:  # ids whose piece begins with a space, which the byte-level alphabet writes as U+0120
            import numpy as np
            self.newline = self.model.token_to_id("\u010a")
            from tokenizers import Tokenizer, pre_tokenizers
            self.pieces = Tokenizer(self.model.model)  # white space cuts the pieces, already in the byte-level alphabet
            self.pieces.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.opens = np.zeros(self.model.get_vocab_size(), dtype=bool)
            for piece, i in self.model.get_vocab().items():
                self.opens[i] = piece.startswith("\u0120")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'I' if self.wide else 'H'}", *ids)

    def _batch(self, texts: list[str]) -> list[bytes]:
        return [self._pack(e.ids) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text with the end id, in groups of some megabytes of text."""
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= GROUP_CHARS:
                yield from self._group(group)
                group, size = [], 0
        if group:
            yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        import numpy as np
        import pyarrow.compute as pc
        whole = [t for t in texts if not self.by_word or any(a in t for a in self.added)]
        if whole:  # strings of added tokens may reach over spaces
            whole = dict(zip(whole, self._batch(whole)))
        plan, heads, rests, odd, odd_ends = [], {}, [], [], [0]  # words after the first, by texts
        for t in texts:
            if whole and t in whole:
                plan.append((None, None))
                continue
            if SPACE_RUN.search(t):
                head, *cut = CUT.split(t)
                odd += cut
                odd_ends.append(len(odd))
                place = -len(odd_ends) + 1
            else:
                if not NEWLINE_RUN.search(t):  # a line feed between two words is a piece of its own
                    t = t.replace("\n", " \n")
                head, space, rest = t.partition(" ")
                place = 0
                if space:
                    rests.append(rest)
                    place = len(rests)
            heads[head] = b""
            plan.append((head, place))
        heads = dict(zip(heads, self._batch(list(heads))))
        lists = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        words = pa.concat_arrays([lists.values, pa.array(odd, pa.large_string())]).dictionary_encode()
        ids = self._distinct(words.dictionary).take(words.indices)
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int64) if len(ids) else np.zeros(1, dtype=np.int64)
        data = memoryview(ids.buffers()[2] or b"")
        first = ends[lists.offsets.to_numpy()].tolist()
        odd_first = ends[np.array(odd_ends) + len(lists.values)].tolist()
        for t, (head, place) in zip(texts, plan):
            if place is None:
                yield whole[t] + self.end
            elif place == 0:
                yield heads[head] + self.end
            else:
                a, b = first[place - 1:place + 1] if place > 0 else odd_first[-place - 1:-place + 1]
                yield b"".join((heads[head], data[a:b], self.end))

    def _distinct(self, words: pa.Array) -> pa.Array:
        """Ids of space + word, or of a word that begins with a line feed, for distinct words."""
        import numpy as np
        import pyarrow.compute as pc
        stems = pc.utf8_rtrim(words, PUNCTUATION)
        plain = pc.match_substring_regex(stems, LETTERS)
        marks = pc.subtract(pc.binary_length(words), pc.binary_length(stems)).filter(plain).to_numpy()
        of_letters = stems.filter(plain).dictionary_encode()
        ids = self._letters(of_letters.dictionary).take(of_letters.indices)
        if marks.any():
            rows = words.filter(plain)
            tails = pa.array(np.zeros(len(rows), dtype="U1"), pa.large_string())
            for n in np.unique(marks[marks > 0]).tolist():
                some = pa.array(marks == n)
                tails = pc.replace_with_mask(tails, some, pc.utf8_slice_codeunits(rows.filter(some), -n))
            tails = tails.dictionary_encode()
            of_tails = pa.array([self._tail(w) for w in tails.dictionary.to_pylist()], pa.large_binary())
            ids = pc.binary_join_element_wise(ids, of_tails.take(tails.indices), pa.scalar(b"", pa.large_binary()))
        others = words.filter(pc.invert(plain)).to_pylist()
        passing = self._learn(set(others))
        more = pa.array([self.known[w] for w in others], pa.large_binary())
        for w in passing:
            del self.known[w]
        if len(self.known) > MAX_CACHED:  # words that come again move over, the others go
            self.known, self.older = {}, self.known
        if len(self.tails) > MAX_CACHED:
            self.tails = {}
        own = plain.to_numpy(zero_copy_only=False)
        place = np.empty(len(words), dtype=np.int64)
        place[own], place[~own] = np.arange(len(ids)), len(ids) + np.arange(len(more))
        return pa.concat_arrays([ids, more]).take(pa.array(place))

    def _tail(self, marks: str) -> bytes:
        if marks not in self.tails:
            self.tails[marks] = self._batch([marks])[0]
        return self.tails[marks]

    def _letters(self, words: pa.Array) -> pa.Array:
        """Ids of space + word for distinct words of letters."""
        import numpy as np
        import pyarrow.compute as pc
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(at))
        narrow = pc.string_is_ascii(new)
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        at[at < 0] = len(self.words) + np.argsort(np.argsort(~narrow.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
        order, fresh = [self.words], [self.ids]
        for some, wide in ((new.filter(narrow), False), (new.filter(pc.invert(narrow)), True)):
            order.append(some)
            for first in range(0, len(some), WORDS_AT_ONCE):
                chunk = some.slice(first, WORDS_AT_ONCE)
                text = " ".join(chunk.to_pylist())
                if wide:
                    text = text.encode().decode("latin-1").translate(HIGH_BYTES)
                text = "\u0120" + text.replace(" ", " \u0120")
                ids = np.array(self.pieces.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4" if self.wide else "<u2")
                ends = np.append(np.flatnonzero(self.opens[ids]), len(ids)).astype(np.int64) * ids.itemsize
                fresh.append(pa.Array.from_buffers(pa.large_binary(), len(chunk), [None, pa.py_buffer(ends), pa.py_buffer(ids)]))
        self.words, self.ids = pa.concat_arrays(order), pa.concat_arrays(fresh)
        ids = self.ids.take(pa.array(at))
        if len(self.words) > MAX_CACHED:
            self.words, self.ids = words, ids
        return ids

    def _learn(self, words: set[str]) -> list[str]:
        """Makes the ids of space + word, or of a word that begins with a line feed,
        known for all the words; returns those that are too long to be remembered."""
        known, older = self.known, self.older

        def unknown(some: set[str]) -> set[str]:
            some = some.difference(known)
            again = {w: older[w] for w in some if w in older}
            known.update(again)
            return some.difference(again)

        new = unknown(words)
        odd = [w for w in new if len(w) > MAX_CACHED_CHARS or " " in w or not w]
        new.difference_update(odd)
        tailed = {w: w.rstrip(PUNCTUATION) for w in new if w[-1] in MARKS}
        tailed = {w: stem for w, stem in tailed.items() if stem.lstrip("\n").isalpha()}  # marks after letters are a piece of their own
        new.difference_update(tailed)
        new |= unknown(set(tailed.values()))
        broken = {w for w in new if w[0] == "\n"}
        for some, first in ((list(new - broken), " "), (list(broken), "\n")):
            for at in range(0, len(some), WORDS_AT_ONCE):
                chunk = some[at:at + WORDS_AT_ONCE]
                known.update(zip(chunk, self._words(chunk, first)))
        ends = {w[len(stem):] for w, stem in tailed.items()}.difference(self.tails)
        self.tails.update(zip(ends, self._batch(list(ends))))
        known.update({w: known[stem] + self.tails[w[len(stem):]] for w, stem in tailed.items()})
        known.update(zip(odd, self._batch([w if w[:1] == "\n" else " " + w for w in odd])))
        return odd

    def _words(self, words: list[str], first: str) -> Iterator[bytes]:
        """Ids of words without white space inside, all after a space or all beginning
        with a line feed, encoded as one text and cut where a word's ids begin."""
        import numpy as np
        text = " " + " ".join(words) if first == " " else "".join(words)
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int64)
        width = 4 if self.wide else 2
        at = (np.flatnonzero(self.opens[ids] if first == " " else ids == self.newline) * width).tolist()
        data = ids.astype("<u4" if self.wide else "<u2").tobytes()
        return (data[a:b] for a, b in zip(at, [*at[1:], len(data)]))


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(path: str, end_id: int) -> Encoder:
    """One encoder per worker process and file."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]


def _fs(folder: str):
    from pyarrow import fs
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def _write_shard(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    fs, base = _fs(folder)
    task = TaskContext.get()
    name = f"{base}/part-{task.partitionId():06d}"
    mine = f"{name}.{task.taskAttemptId()}"
    encoder, out, index, at, rows, tokens = _encoder(tokenizer, end_id), None, None, 0, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if out is None:
            fs.create_dir(base, recursive=True)
            out, index = fs.open_output_stream(f"{mine}.rec"), fs.open_output_stream(f"{mine}.idx")
        keys = batch.column(0).to_pylist()
        for key, ids in zip(keys, encoder.encode(batch.column(1).to_pylist())):
            flags = (HAS_KEY if key is not None else 0) | (WIDE if encoder.wide else 0)
            payload = HEAD.pack(flags, key or 0) + ids
            size = struct.pack("<Q", len(payload))
            out.write(b"".join((size, struct.pack("<I", masked_crc(size)), payload, struct.pack("<I", masked_crc(payload)))))
            index.write(struct.pack("<QQ", at, len(payload)))
            at, rows, tokens = at + len(payload) + 16, rows + 1, tokens + len(ids) // (4 if encoder.wide else 2)
    if out is not None:
        out.close()
        index.close()
        for end in ("rec", "idx"):
            fs.move(f"{mine}.{end}", f"{name}.{end}")
        yield pa.RecordBatch.from_pydict({"part": [task.partitionId()], "n_records": [rows], "n_tokens": [tokens], "n_bytes": [at]},
                                         schema=pa.schema([("part", pa.int32()), ("n_records", pa.int64()),
                                                           ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]))


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the shards and their index into ``folder``; the manifest, one row
    per shard: ``part``, ``n_records``, ``n_tokens``, ``n_bytes``, and ``first``,
    the tokens in all shards before it."""
    rows = docs.select(F.col(key).cast("long").alias("k"), text_of(text).alias("t"))
    rows = rows.select("k", "t", F.xxhash64("t").alias("h"), F.monotonically_increasing_id().alias("r"))
    ordered = rows.repartitionByRange("k", "h", "r").sortWithinPartitions("k", "h").select("k", "t")
    manifest = materialize(ordered.mapInArrow(
        lambda it: _write_shard(it, folder, tokenizer, end_id), "part int, n_records long, n_tokens long, n_bytes long"), "token-manifest")
    # One row per shard, whatever the number of documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_shard(folder: str, part: int, offsets: list[int] | None = None) -> Iterator[tuple[int | None, bytes, int]]:
    """(key, ids, bytes per id) of a shard's records in order, or of those at the
    given positions of its index. A wrong checksum or length raises."""
    fs, base = _fs(folder)
    with fs.open_input_file(f"{base}/part-{part:06d}.idx") as f:
        index = f.read()
    places = list(struct.iter_unpack("<QQ", index))
    with fs.open_input_file(f"{base}/part-{part:06d}.rec") as f:
        end = 0
        for at, size in places if offsets is None else [places[i] for i in offsets]:
            if offsets is not None or at != end:
                f.seek(at)
            frame = f.read(size + 16)
            end = at + size + 16
            head, payload = frame[:8], frame[12:-4]
            if (len(frame) != size + 16 or struct.unpack("<QI", frame[:12]) != (size, masked_crc(head))
                    or struct.unpack("<I", frame[-4:])[0] != masked_crc(payload)):
                raise ValueError(f"damaged record at {at} of shard {part} in {folder}")
            flags, key = HEAD.unpack(payload[:HEAD.size])
            yield key if flags & HAS_KEY else None, payload[HEAD.size:], 4 if flags & WIDE else 2


def _digests(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    import numpy as np
    schema = pa.schema([("k", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for part, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows: list[tuple] = []
            for key, ids, width in read_shard(folder, part):
                wide = ids if width == 4 else np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes()
                rows.append((key, first, len(wide) // 4, zlib.crc32(wide)))
                first += len(wide) // 4
                if len(rows) == ROWS_OUT:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_digests(manifest: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """From the files: key, ``start`` (ids of all records before), ``n_tokens``
    and ``ids_crc32`` (of the ids as little-endian u32) of every record."""
    last = manifest.agg(F.max("part")).first()[0]
    shards = manifest.select("part", "first").repartitionById((last or 0) + 1, F.col("part"))  # a task for each shard
    return shards.mapInArrow(lambda it: _digests(it, folder), "k long, start long, n_tokens long, ids_crc32 long") \
        .withColumnRenamed("k", key)


def token_records(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the records (into the shared scratch folder unless one is named)
    and returns what reading them back gives."""
    folder = folder or new_scratch(spark, "token-records")
    return read_digests(write_records(docs, folder, tokenizer, end_id, key, text), folder, key)
