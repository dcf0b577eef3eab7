"""Repeated byte strings against a plain search, and the parts of the sort."""

import random

import numpy as np
import pytest

from cohortforge.llm import suffixes as sx


def plain(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of each text by a dictionary of all strings."""
    texts = [(t or "").encode() for t in texts]
    count = {}
    for t in texts:
        for p in range(len(t) - length + 1):
            count[t[p:p + length]] = count.get(t[p:p + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if count[t[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), len(t) - len(kept), spans, kept))
    return out


def run(spark, texts, length=sx.LENGTH, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sx.dedupe(df, length=length, **kw).collect()
    assert len(found) == len(texts)
    return [tuple(r)[1:] for r in sorted(found)]


def corpus(seed, n, length):
    """Texts that share pieces of about ``length`` bytes at random places, at text
    starts and ends, with changed letters, repeats inside one text and copies."""
    rng = random.Random(seed)
    letters = "abcdefgé "

    def noise(k):
        return "".join(rng.choice(letters) for _ in range(k))
    shared = [noise(rng.choice([length - 30, length - 1, length, length + 1, length + 40, 3 * length])) for _ in range(8)]
    out = ["", "a", None, "ab" * 300, "x" * (length + 50), "x" * (length - 1)]
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(noise(rng.randint(0, 2 * length)) if rng.random() < 0.5 else rng.choice(shared))
        text = list("".join(parts))
        for _ in range(rng.randint(0, 2)):
            if text:
                text[rng.randrange(len(text))] = "#"
        out.append("".join(text))
    return out + out[10:16]


@pytest.mark.parametrize("seed, length", [(1, 200), (2, 100), (3, 150), (4, 200)])
def test_equals_plain_search(spark, seed, length):
    texts = corpus(seed, 60, length)
    assert run(spark, texts, length) == plain(texts, length)


def test_hot_strings_cross_buckets(spark, monkeypatch):
    """One passage in most texts: its suffixes fill several buckets, each group at a border."""
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(700))
    texts = ["".join(rng.choice("ijklmnop ") for _ in range(rng.randint(0, 150))) + passage[rng.randint(0, 60):] for _ in range(150)]
    texts += [passage[:300]] * 40 + ["only once " + str(i) * 120 for i in range(10, 30)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert run(spark, texts) == plain(texts, 200)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_blocks_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(sx, "BLOCK_BITS", 8)
    rng = random.Random(6)
    noise = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    texts = [noise[:3000], noise[1500:], noise[700:1300] + "#" + noise[1301:1600], "q" * 2000]
    data = "".join(texts).encode()
    ends = np.cumsum([len(t) for t in texts])
    got = sx.anchors(np.frombuffer(data, np.uint8), ends - [len(t) for t in texts], ends, 200)
    for text, first, final in zip(*(got[i].tolist() for i in (0, 2, 3))):
        assert first <= final and final + 200 <= ends[text]
    assert int((got[3] - got[2] + 1).sum()) == sum(len(t) - 199 for t in texts)  # each window has one anchor
    assert run(spark, texts) == plain(texts, 200)


def test_quicksort_and_buckets():
    rng = np.random.default_rng(7)
    keys = [rng.integers(-5, 5, 30_000), rng.integers(-40, 40, 30_000), rng.integers(-9, 9, 30_000)]
    order = sx.multikey_quicksort(keys)
    assert sorted(order.tolist()) == list(range(30_000))
    rows = list(zip(*(k[order].tolist() for k in keys)))
    assert rows == sorted(rows)
    cuts = np.sort(rng.choice(30_000, 12, replace=False))
    splits = [k[order][cuts] for k in keys]
    want = [sum(s <= row for s in zip(*(x.tolist() for x in splits))) for row in zip(*(k.tolist() for k in keys))]
    assert sx.bucket_of(keys, splits).tolist() == want
    assert len(sx.multikey_quicksort([np.zeros(0, np.int64)] * 2)) == 0


def test_edges(spark):
    assert run(spark, []) == []
    assert run(spark, [None, "", "short"]) == [(0, 0, 0, b""), (0, 0, 0, b""), (5, 0, 0, b"short")]
    text = "0123456789" * 30_000  # periodic and long
    assert run(spark, [text]) == [(300_000, 300_000, 1, b"")]
    df = spark.createDataFrame([(None, "z" * 99 + str(i), 1, 2, "t") for i in range(3)] + [(7, None, 0, 0, None)],
                               "doc_id long, text string, rid int, loc int, k string")
    found = sx.dedupe(df).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in found) == [(0, 100, 0)] * 3 + [(7, 0, 0)]
    with pytest.raises(ValueError):
        sx.dedupe(df, length=64)
