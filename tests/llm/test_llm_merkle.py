"""The Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest

from cohortforge.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*fields):
    return H(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def plain_tree(leaves):
    """(root, proof and fold function of each leaf) by whole levels."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])

    def siblings(i):
        out = []
        for level in levels[:-1]:
            run = i // 8 * 8
            out.append((level[run:i], level[i + 1:run + 8]))
            i //= 8
        return out
    return levels[-1][0], [siblings(i) for i in range(len(leaves))]


def plain(rows):
    groups = {}
    for doc, text, lang, source, n in rows:
        leaf = plain_leaf(doc, source, lang, n, text)
        low = text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        groups.setdefault(lang, []).append((doc is not None, doc or 0, leaf, plain_leaf(doc, source, lang, n, low) if hit else leaf))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: plain_tree([r[2] for r in sorted(groups[x])]) for x in langs}
    root, above = plain_tree([trees[x][0] for x in langs])
    out = []
    for x, up in zip(langs, above):
        subroot, own = trees[x]
        for (known, doc, leaf, claimed), path in zip(sorted(groups[x]), own):
            fold = claimed
            for left, right in path + up:
                fold = H(*left, fold, *right)
            out.append((doc if known else None, leaf, subroot, root, H(*(s for p in path + up for side in p for s in side)), fold, fold == root))
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = merkle.tamper_checks(df).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted(map(tuple, found), key=str)


@pytest.mark.parametrize("sizes", [(1,), (2, 1), (8, 9, 1), (64, 65, 3, 1), (700, 513, 512)])
def test_equals_plain_tree(spark, sizes):
    rng = random.Random(sum(sizes))
    rows = []
    for at, n in enumerate(sizes):
        lang = [None, "en", "é", "Z", ""][at]
        for _ in range(n):
            doc = rng.choice([None, rng.randrange(10_000), rng.randrange(10_000)])
            rows.append((doc, rng.choice([None, "", "Text É", "low é", "A"]), lang, rng.choice([None, "s"]), rng.choice([None, 3])))
    want = plain(rows)
    assert run(spark, rows) == sorted(want, key=str)
    if len(rows) > 100:
        assert {r[-1] for r in want} == {True, False}


def test_levels_between_are_not_stored(spark):
    leaves = spark.range(1500).selectExpr("0 AS g", "id AS i", "1500L AS n", "sha2(string(id), 256) AS h")
    levels = merkle.build(leaves, "t")
    assert [x.count() for x in levels] == [1500, 3, 1]
    assert plain_tree([H(str(i)) for i in range(1500)])[0] == levels[-1].first()["h"]


def test_many_groups_and_repeated_rows(spark):
    rows = [(i, "T", f"lang{i % 90}", "s", 1) for i in range(300)] + [(5, "T", "lang5", "s", 1)] * 20
    assert run(spark, rows) == sorted(plain(rows), key=str)


def test_empty_and_other_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "T", "en", "s", 1, "x", "y")], "doc_id long, text string, lang string, source string, n_chars long, g string, path string")
    row = merkle.tamper_checks(df).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == H()
