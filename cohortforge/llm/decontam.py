"""Benchmark decontamination with a hash set of test n-grams (DataFrame functions only).

Texts are lower-cased (A-Z only) and cut into words; every run of ``n`` item
words is a window, an item with fewer words is one window. The hash set of all
item windows is broadcast when its counted size is below a bound (beyond it the
same join shuffles), every window of every document is looked up, and a hit
counts only after its words compare equal.

Defined results: null texts and texts without words have no windows and no
hits; items without words are ignored; a repeated item or a repeated item id
counts once; items with a null id mark words but are not counted; repeated
document rows each get their row; other columns are kept as they are and may
have any names; with an empty table on either side nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.common import materialize, text_of

NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A broadcast window takes some 300 bytes in memory: 60 MB at most.
MAX_BROADCAST_WINDOWS = 200_000


def lower_ascii(col: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def norm_words(col: Column | str) -> Column:
    """Normalised words of a text in order."""
    return F.array_remove(F.split(lower_ascii(text_of(col)), NOT_WORD), "")


def item_windows(bench: DataFrame, item_id: str = "item_id", text: str = "text", n: int = 10) -> DataFrame:
    """Distinct windows of the test items: ``win_len``, ``win`` (its words), their
    hash ``win_hash`` and ``items`` (ids as sorted strings)."""
    words = bench.select(F.col(item_id).cast("string").alias("item"), norm_words(text).alias("w")).filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(n))
    wins = words.select("item", length.alias("win_len"), F.explode(F.expr(
        f"transform(sequence(1, greatest(size(w) - {n - 1}, 1)), i -> slice(w, i, {n}))")).alias("win"))
    return wins.groupBy("win_len", "win").agg(F.sort_array(F.collect_set("item")).alias("items")).select(
        "win_len", F.expr("xxhash64(transform(win, x -> xxhash64(x)))").alias("win_hash"), "win", "items")


def scan(docs: DataFrame, bench: DataFrame, keys: list[str], text: str = "text", item_id: str = "item_id",
         item_text: str = "text", n: int = 10, max_broadcast: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """One row per distinct (``keys``, text): ``n_rows`` input rows, ``n_words``,
    ``spans`` (hit word ranges, merged, [start, end) from 0), ``n_hit`` words and
    ``items`` (ids with an occurring window, sorted as strings)."""
    wins = materialize(item_windows(bench, item_id, item_text, n), "bench-windows")
    sizes = wins.groupBy("win_len").agg(F.count("*").alias("n")).collect()  # n lengths at most
    small = sum(r["n"] for r in sizes) <= max_broadcast
    lengths = [0] + sorted(r["win_len"] for r in sizes)  # 0: a row for the document itself

    base = docs.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)],
                       F.xxhash64(text_of(text)).alias("text_hash"), norm_words(text).alias("w"))
    base = base.select("*", F.expr("transform(w, x -> xxhash64(x))").alias("g"))
    base = base.select("*", F.explode(F.array(*[F.lit(x) for x in lengths])).alias("len"))
    names = [f"k{i}" for i in range(len(keys))] + ["text_hash"]
    base = base.select(*names, "w", "len", F.expr("""
        case when len = 0 then array(cast(null as bigint)) when size(g) < len then array()
             else transform(sequence(1, size(g) - len + 1), i -> xxhash64(slice(g, i, len))) end""").alias("hashes"))
    # The outer form: else Catalyst filters on the array's size first and computes it twice.
    seen = base.select(*names, "len", F.size("w").alias("size"), "w", F.posexplode_outer("hashes").alias("pos", "hash"))
    seen = seen.select(*names, "len", "size", "pos", "hash", F.expr("slice(w, pos + 1, len)").alias("seen"))
    # Only the hash is a join key; the words are compared where it matches.
    found = seen.join(F.broadcast(wins.drop("win_len")) if small else wins.drop("win_len"),
                      (F.col("hash") == F.col("win_hash")) & F.arrays_overlap(F.array("seen"), F.array("win")), "left")
    found = found.filter((F.col("len") == 0) | F.col("win_hash").isNotNull())
    own = F.col("len") == 0
    per_doc = found.groupBy(*names).agg(
        F.sum(F.when(own, 1).otherwise(0)).alias("n_rows"), F.max("size").cast("long").alias("n_words"),
        F.collect_set(F.when(~own, F.struct(F.col("pos").alias("s"), (F.col("pos") + F.col("len")).alias("e")))).alias("at"),
        F.collect_set("items").alias("items"))
    merged = F.expr("""
        aggregate(sort_array(at), cast(array() as array<struct<s:int,e:int>>), (m, x) ->
          case when size(m) > 0 and get(m, size(m) - 1).e >= x.s
               then concat(slice(m, 1, size(m) - 1),
                           array(struct(get(m, size(m) - 1).s as s, greatest(get(m, size(m) - 1).e, x.e) as e)))
               else concat(m, array(struct(x.s as s, x.e as e))) end)""")
    hit = F.expr("""
        aggregate(sort_array(at), struct(0L as c, 0 as e),
          (a, x) -> struct(a.c + greatest(0, x.e - greatest(a.e, x.s)) as c, greatest(a.e, x.e) as e), a -> a.c)""")
    return per_doc.select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "text_hash", "n_rows", "n_words",
        merged.alias("spans"), hit.alias("n_hit"), F.sort_array(F.array_distinct(F.flatten("items"))).alias("items"))


def decontaminate(docs: DataFrame, bench: DataFrame, mode: str = "documents", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", n: int = 10) -> DataFrame:
    """The documents without test passages, columns unchanged. ``documents``
    drops every row with a hit; ``spans`` cuts the hit words (and what stands
    between them) out of the text."""
    names, other = docs.columns, F.xxhash64(text_of(text), F.lit(n))  # with the first hash 128 bits of the text
    texts = docs.select(F.col(text).alias("t"), other.alias("text_hash_2"))
    hits = scan(texts, bench, ["text_hash_2"], "t", item_id, item_text, n).filter("n_hit > 0").select("text_hash", "text_hash_2", "spans")
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), F.xxhash64(text_of(text)).alias("text_hash"), other.alias("text_hash_2"))
    on = ["text_hash", "text_hash_2"]
    if mode == "documents":
        return rows.join(hits, on, "left_anti").select("row.*")
    joined = rows.join(hits, on, "left").withColumn("body", F.col("row")[text])
    cut = F.expr(f"""
        transform(array(struct(split(body, r'{WORD}') as g, array_remove(split(body, r'{NOT_WORD}'), '') as w)), p ->
          concat(get(p.g, 0), array_join(transform(p.w, (x, i) ->
            case when exists(spans, s -> i >= s.s and i < s.e)
                 then case when exists(spans, s -> i + 1 >= s.s and i + 1 < s.e) then '' else get(p.g, i + 1) end
                 else concat(x, get(p.g, i + 1)) end), '')))[0]""")
    body = F.when(F.col("spans").isNull(), F.col("body")).otherwise(cut)
    return joined.select(*[(body if c == text else F.col("row")[c]).alias(c) for c in names])
