"""SimHash, line dedup, token records, pages, toxicity, token counts and the
pipeline against plain Python or library results."""

import os
import random
import re
import struct
import zlib

import numpy as np
import pytest

from cohortforge.llm import html_extract, linededup, simhash, tokens, toxicity, unigram
from cohortforge.llm.common import new_scratch
from cohortforge.llm.components import connected_components

P = pytest.importorskip("public_tokenizers")
CLASH = "doc_id long, text string, fp string, label string, row string, gone string"
SF = "/root/testdata/sf0.001"
W = re.compile(r"[^\x20\x09-\x0D]+")


def groups(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(80)] + [(i, i + 1) for i in range(200, 260)] + [(7, 7), (300, 301), (301, 300)]
    out = connected_components(spark.createDataFrame(edges, "u long, v long"))
    real = [e for e in edges if e[0] != e[1]]
    want = groups({n for e in real for n in e}, real)
    assert {r["node"]: r["label"] for r in out.collect()} == want and out.count() == len(want)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def fingerprint(t):
    import xxhash
    w = W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    s = [" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 5])
def test_links_are_complete(spark, distance):
    rnd = random.Random(distance)
    base = [rnd.getrandbits(64) for _ in range(25)] + [0, (1 << 64) - 1]
    fps = set(base)
    for b in base:
        for _ in range(6):
            for bit in rnd.sample(range(64), rnd.randint(0, distance + 1)):
                b ^= 1 << bit
            fps.add(b)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    out = [(r["u"], r["v"]) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), distance).collect()]
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & ((1 << 64) - 1)).count("1") <= distance}
    assert set(out) == (want if distance else set()) and len(out) == len(set(out))


def test_near_duplicates_and_dedupe(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 80))) for _ in range(60)]
    near = [t.replace(" w1", " W1") for t in texts[:20]] + [t + " extra" for t in texts[20:40]]
    rows = [(i, t) for i, t in enumerate(texts + near)] + [(500, None), (501, ""), (502, " \n"), (None, texts[0]), (3, texts[3]), (600, "X " * 30000), (600, "x " * 30000)]
    rows = [(d, t, "a", "b", None, "c") for d, t in rows]
    docs = spark.createDataFrame(rows, CLASH)
    f = {r: fingerprint(r[1]) for r in rows}
    near_pairs = [(f[a], f[b]) for a in set(rows) for b in set(rows) if bin(f[a] ^ f[b]).count("1") <= 3]
    of = groups(set(f.values()), near_pairs)
    low = {}
    for r in rows:
        if r[0] is not None:
            low[of[f[r]]] = min(low.get(of[f[r]], r[0]), r[0])
    out = simhash.near_duplicates(docs).collect()
    assert sorted((str(r["doc_id"]), r["fp"] & ((1 << 64) - 1), r["component_id"]) for r in out) == \
        sorted((str(r[0]), f[r], low[of[f[r]]]) for r in rows)
    kept = simhash.dedupe(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(low.values())
    assert simhash.dedupe(docs.limit(0)).count() == 0 and simhash.near_duplicates(docs.limit(0)).count() == 0


def runs_by_hand(rows, least):
    """Lines of later copies of every run of enough words that occurs twice."""
    found, lines = {}, {}
    for at, (d, t) in sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[0])):
        lines[at] = [(i, x.strip(), len(x.split())) for i, x in enumerate((t or "").split("\n")) if x.split()]
        for p in range(len(lines[at])):
            for e in range(p + 1, len(lines[at]) + 1):
                if sum(x[2] for x in lines[at][p:e]) >= least:
                    found.setdefault(tuple(x[1] for x in lines[at][p:e]), []).append((at, p))
    gone = {at: set() for at in lines}
    for run, at in found.items():
        for d, p in at[1:]:
            gone[d] |= {lines[d][q][0] for q in range(p, p + len(run)) if d != at[0][0] or q >= at[0][1] + len(run)}
    return gone


def test_line_dedup_matches_brute_force(spark):
    rnd = random.Random(8)
    pool = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 4))) for _ in range(9)] + ["", "  ", "long " * 12]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 14)))) for i in range(40)]
    rows += [(99, None), (100, ""), (None, rows[0][1]), (101, "a b c d\n" * 12), (102, " a b c d \n" * 5 + "\nx")]
    docs = spark.createDataFrame([(d, t, "a", "b", "c", None) for d, t in rows], CLASH).coalesce(1)
    out = linededup.dedupe_lines(docs, min_words=10, n_removed="n_removed")
    gone, want = runs_by_hand(rows, 10), []
    for at, (d, t) in enumerate(rows):
        kept = [x for i, x in enumerate((t or "").split("\n")) if i not in gone[at]]
        new = t if not gone[at] else "\n".join(kept) if any(x.strip() for x in kept) else ""
        want.append((str(d), new, len(gone[at])))
    assert out.columns == docs.columns + ["n_removed"]
    assert sorted(map(str, ((str(r["doc_id"]), r["text"], r["n_removed"]) for r in out.collect()))) == sorted(map(str, want))
    assert linededup.dedupe_lines(docs.limit(0)).count() == 0


def test_line_dedup_of_a_long_text(spark):
    """Of one line 4,000 times the first run of ten words stays."""
    docs = spark.createDataFrame([(1, "z\n" * 4000), (2, "y")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in linededup.dedupe_lines(docs, min_words=10, n_removed="n").collect()}
    assert (out[1]["text"], out[1]["n"], out[2]["text"], out[2]["n"]) == ("z\n" * 10, 3990, "y", 0)


def test_line_runs_are_maximal(spark):
    block = "\n".join(f"line {i} of the passage" for i in range(12))
    rows = [(0, 1, f"own start\n{block}\nend one"), (1, 2, f"{block}\nother end"), (2, 3, "nothing here")]
    _, runs = linededup.repeated_lines(spark.createDataFrame(rows, "d long, k long, t string"), min_words=10)
    assert [tuple(r) for r in runs.collect()] == [(1, 0, 12, 0, 1)]


def test_whole_line_runs_go(spark):
    rnd = random.Random(11)
    pool = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 5))) for _ in range(7)] + ["", "long " * 12]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 14)))) for i in range(60)]
    block = "\n".join(f"{i} " * n for i, n in enumerate([10, 22, 93, 2]))
    rows += [(100, block), (101, block), (102, "z\n" * 40), (103, "q " * 15 + "\nshort"), (104, "q " * 15 + "\nlast"), (105, "q " * 15 + "\nlast")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = {r["doc_id"]: r for r in linededup.dedupe_lines(docs, min_words=10, n_removed="n").collect()}
    gone = runs_by_hand(rows, 10)
    assert {d: out[d]["n"] for d, _ in rows} == {d: len(gone[at]) for at, (d, _) in enumerate(rows)}
    assert out[101]["text"] == "" and out[104]["text"] == "last" and out[105]["text"] == ""
    for at, (d, t) in enumerate(rows):
        kept = [x for i, x in enumerate(t.split("\n")) if i not in gone[at]]
        assert out[d]["text"] == (t if not gone[at] else "\n".join(kept) if any(x.strip() for x in kept) else "")
    _, runs = linededup.repeated_lines(spark.createDataFrame([(0, 1, block), (1, 2, block)], "d long, k long, t string"), 10)
    assert [tuple(r) for r in runs.collect()] == [(1, 0, 4, 0, 0)]


def test_encoder_equals_library():
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    plain, mine = Tokenizer.from_file(path), tokens.Encoder(path, 2)
    rnd = random.Random(1)
    alphabet = ["a", "the", " ", " ", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "'s", "1", "!", ",", "　", "日", "\r", "<|endoftext|>", "​", "\x00"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(8000)] + ["", "x" * 30000, "word, " * 9000]
    texts += ["one\ntwo, three.\n\nfour\n five \nsix\t\nseven", "\nlead\n", "a\nb\n\n\nc", "\n" + "y" * 60 + "\n" + "z" * 60, "a <|endoftext|>\nb c"]
    for t, ids in zip(texts, mine.encode(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == plain.encode(t, add_special_tokens=False).ids + [2], repr(t)
    other = tokens.Encoder(P.path("word_bpe_49k.json"), 2)
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for t, ids in zip(texts[:50], other.encode(texts[:50])):
        assert np.frombuffer(ids, "<u2").tolist() == lib.encode(t, add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("remembered", [tokens.MAX_CACHED, 5])
def test_encoder_words_and_marks_equal_library(monkeypatch, remembered):
    from tokenizers import Tokenizer
    monkeypatch.setattr(tokens, "MAX_CACHED", remembered)
    path = P.path("byte_bpe_50k.json")
    plain, mine = Tokenizer.from_file(path), tokens.Encoder(path, 2)
    rnd = random.Random(4)

    def word():
        letters = "".join(chr(rnd.choice([rnd.randint(97, 122), rnd.randint(0xC0, 0x2FF)])) for _ in range(rnd.randint(1, 6)))
        return letters + rnd.choice(["", "", ",", "...", "'s", ")\"", "9", "\xad", "\u0120", "x" * 45])
    for _ in range(12):
        texts = [rnd.choice([" ", "\n", "  "]).join(word() for _ in range(rnd.randint(0, 30))) for _ in range(40)]
        got = list(mine.encode(texts))
        assert len(got) == len(texts)
        for t, ids in zip(texts, got):
            assert np.frombuffer(ids, "<u2").tolist() == plain.encode(t, add_special_tokens=False).ids + [2], repr(t)
    assert list(mine.encode([])) == [] and [len(x) for x in mine.encode(["", ""])] == [2, 2]


def test_token_records_round_trip(spark):
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    rows = [(5, "five words are in here"), (1, None), (None, "no id"), (2, ""), (5, "five words are in here"), (-3, "first"), (7, "long " * 20000)]
    docs = spark.createDataFrame([(d, t, "a", "b", "c", "e") for d, t in rows], CLASH)
    folder = new_scratch(spark, "test-records")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # more than one shard for few rows
    manifest = tokens.write_records(docs, folder, path, 2)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    out = sorted(tokens.read_digests(manifest, folder).collect(), key=lambda r: r["start"])
    start, want = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in out] == want
    part = manifest.orderBy("part").first()["part"]
    n = manifest.filter(f"part = {part}").first()["n_records"]
    shards = manifest.agg({"part": "max"}).first()[0] + 1  # each shard is read in a task of its own
    assert shards > 1 and tokens.read_digests(manifest, folder).rdd.getNumPartitions() == shards
    all_of = list(tokens.read_shard(folder, part))
    assert len(all_of) == n and list(tokens.read_shard(folder, part, [n - 1, 0])) == [all_of[-1], all_of[0]]
    name = f"{folder.removeprefix('file:')}/part-{part:06d}.rec"
    data = bytearray(open(name, "rb").read())
    assert struct.unpack("<Q", data[:8])[0] == len(all_of[0][1]) + tokens.HEAD.size
    data[14] ^= 1
    open(name, "wb").write(data)
    with pytest.raises(ValueError, match="damaged"):
        list(tokens.read_shard(folder, part))
    assert tokens.token_records(spark, docs.limit(0), path).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>x="<p>no</p>"</script></head><body><nav><ul><li><a>Menu {i}</a></li></ul></nav>
<header><h2>Site</h2></header><div class="cookie-notice">We use cookies</div><div class="ad">Buy {i}</div><article><h1>Title &amp; {i}</h1><p><b>First
 para {i}&nbsp;end<br><p>Second &lt;{i}&gt;</p><div class="share">Share</div><p>tail {i}<form><input><button>Send</button></form>
<section id="comments"><p>Nice {i}</p></section></article><aside>Side</aside><footer>&copy; all</footer></body>"""


def test_pages_of_all_kinds(spark):
    bare = "<body><div><p>Site notice everywhere</p></div><section><p>Own text {i}</p><p>More of {i}</p></section>"
    rows = [(i, f"https://A.example/{i}", PAGE.replace("{i}", str(i))) for i in range(12)]
    rows += [(100 + i, f"http://b.example:80/{i}", bare.replace("{i}", str(i))) for i in range(12)]
    rows += [(200, None, None), (201, "", ""), (202, "x", "plain text &eacute; <b>bold</b>\n x"), (203, "u", "<p>a<p>b<ul><li>c<li>d</ul><script>never closed"),
             (204, "u", "<article>x < y <!-- c --> z</i></article"), (0, "https://A.example/0", rows[0][2]), (205, "u", "<p>" + "long " * 50000 + "</p>")]
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "page_id long, url string, html string, host string, block string, text string")
    out = {(r["page_id"], r["url"]): r for r in html_extract.extract(docs).collect()}
    assert html_extract.extract(docs).count() == len(rows)
    for i in range(12):
        assert out[i, f"https://A.example/{i}"]["text"] == f"Title & {i}\nFirst para {i} end\nSecond <{i}>\ntail {i}"
        assert out[100 + i, f"http://b.example:80/{i}"]["text"] == f"Own text {i}\nMore of {i}"
    assert out[200, None]["text"] == "" and out[201, ""]["n_chars"] == 0
    assert out[202, "x"]["text"] == "plain text é bold x" and out[203, "u"]["text"] == "a\nb\nc\nd"
    assert out[204, "u"]["text"] == "x < y z" or out[204, "u"]["text"].startswith("x < y")
    assert out[205, "u"]["n_chars"] == 5 * 50000 - 1
    assert html_extract.extract(docs.limit(0)).count() == 0


def test_articles_survive_loose_names_and_page_forms():
    def text(body):
        return "\n".join(b[0] for b in html_extract.parse(f"<html><body><nav>Menu</nav><div class=ad>Buy</div>{body}</body></html>")[2])
    story = "<article><h1>Title</h1><p>Own story</p><div class='share-buttons'>Share</div><div id=comments><article>Nice</article></div></article>"
    plain = "<h1>Title</h1><p>Own story</p>"
    for name in ("content with-sidebar", "layout no-sidebar", "elementor-widget", "social-policy", "has-header-image", "widget", "sidebar-wrapper"):
        assert text(f"<div class='{name}'>{story}</div>") == "Title\nOwn story", name
        assert text(f"<main><p>Home</p><div class='{name}'>{story}</div></main>") == "Home\nTitle\nOwn story", name
        assert text(f"<div class='{name}'>{plain}</div>") == ("Title\nOwn story" if name not in ("widget", "sidebar-wrapper") else "Buy\nTitle\nOwn story"), name
    assert text(f"<form id=aspnetForm><nav>x</nav><input>{story}<button>Go</button></form>") == "Title\nOwn story"
    assert text(f"<p>Skip</p><form id=aspnetForm><div class=ad>Buy</div>{plain}</form>") == "Skip\nTitle\nOwn story"
    # Small parts that name noise, forms and articles of others stay out.
    assert text(f"{story}<div class=promo><article>Ad</article></div><aside><article>Side</article></aside>") == "Title\nOwn story"
    assert text(f"<div>{plain}</div><form><label>Mail</label></form><div class='related'><article>Other story</article></div>") == "Title\nOwn story"
    for name in ("ad-container", "cookie-notice", "main-menu", "page-header", "sidebar_2"):
        assert text(f"<div>{plain}</div><div class='{name}'>Noise</div>") == "Title\nOwn story", name


def test_style_tree_importance(spark):
    bare = "<body><div class=top><p>Same text</p></div><div class=main><p>Own {i}</p></div>"
    rows = [(i, "http://h/", bare.replace("{i}", str(i))) for i in range(20)]
    df = spark.createDataFrame(rows, "page long, url string, html string").selectExpr("page", "url", "'h' as host", "html")
    tree = html_extract.style_tree(df.mapInArrow(html_extract._parse_batches, html_extract.PARSED)).collect()
    deep = sorted(r["importance"] for r in tree if r["depth"] == 3)
    assert deep[0] == pytest.approx(0, abs=1e-6) and deep[1] == pytest.approx(1)


def test_parts_by_their_names_and_breaks():
    def text(body):
        return "\n".join(b[0] for b in html_extract.parse(f"<body>{body}</body>")[2])
    for name in ("article-comments", "user-comments", "ad_300x250", "google-ads", "post-footer", "ad-728x90", "reader_comments2"):
        assert text(f"<article><p>Own</p><div class='{name}'><p>Noise</p></div><p>story</p></article>") == "Own\nstory", name
    assert text("<p>one<br>two<br/>three</p><p>four") == "one two three\nfour"
    assert text("<p title='a > b'>x</p><p title=\"<i>\">y</p><a href='z>w") == "x\ny\n<a href='z>w"


def test_parse_takes_linear_time_and_bounded_depth():
    import time
    pages = ["<a " * 350_000, "<a" * 500_000, "<a ' " * 200_000 + ">", "</script" * 125_000, "<script>" + "</script" * 125_000, "<p " * 300_000 + "<!-- x",
             "<i>" * 300_000 + "</b>" * 50_000, "<p>x</i>" * 100_000]
    for page in pages:
        t = time.process_time()
        html_extract.parse(page)
        assert time.process_time() - t < 6, page[:10]
    t = time.process_time()
    assert len(html_extract.parse("<a " * 350_000)[2][0][0]) == 350_000 * 3 - 1 and time.process_time() - t < 1
    nodes, _, blocks = html_extract.parse("<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>after")
    assert len(nodes) <= html_extract.MAX_DEPTH + 1 and [b[0] for b in blocks] == ["deep", "after"]
    assert html_extract.parse("<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>after")[2][1][1] in nodes


def plain_importance(pages):
    """Importance of every style node of one host by plain recursion."""
    import math
    from collections import Counter, defaultdict
    parsed = [html_extract.parse(p) for p in dict.fromkeys(pages)]
    sigs, ups, texts = defaultdict(Counter), {}, defaultdict(Counter)
    for nodes, leaves, _ in parsed:
        for h, (up, _, sig) in nodes.items():
            sigs[h][sig] += 1
            ups[h] = up
        for h, t in set(leaves):
            texts[h][t] += 1
    kids = defaultdict(list)
    for h, up in ups.items():
        kids[up].append(h)

    def value(h):
        n = sum(sigs[h].values())
        shown = -sum(c / n * math.log(c / n) for c in sigs[h].values()) / math.log(n) if n > 1 else 1.0
        said = (1 - sum(math.log(c) for c in texts[h].values()) / len(texts[h]) / math.log(n) if n > 1 else 1.0) if h in texts else None
        parts = [(value(k), sum(sigs[k].values())) for k in kids[h]] + ([(said, n)] if said is not None else [])
        if not kids[h]:
            return 1.0 if said is None else said
        damped = html_extract.DAMPING ** len(sigs[h])
        return (1 - damped) * shown + damped * sum(v * w for v, w in parts) / sum(w for _, w in parts)
    return {h: value(h) for h in ups}


def test_style_tree_equals_recursion(spark):
    rnd = random.Random(8)
    blocks = ["<div class=a><p>{t}</p><ul><li>{t}</li><li>{t}</li></ul></div>", "<section>{t}<div><p>Fixed</p></div></section>", "<p>Always</p>", "<div class=b>{t}</div>"]
    hosts = {h: ["<body><div class=top><p>Same menu</p></div>" + "".join(rnd.choice(blocks).replace("{t}", rnd.choice("uvwxyz")) for _ in range(rnd.randint(1, 6)))
                 for _ in range(n)] for h, n in (("h1", 30), ("h2", 9), ("h3", 1))}
    rows = [(i, "u", h, p) for h, pages in hosts.items() for i, p in enumerate(pages + pages[:3])]
    parsed = spark.createDataFrame(rows, "page long, url string, host string, html string").mapInArrow(html_extract._parse_batches, html_extract.PARSED)
    tree = html_extract.style_tree(parsed)
    got = {(r["host"], r["node"]): r["importance"] for r in tree.collect()}
    want = {(h, n): v for h, pages in hosts.items() for n, v in plain_importance(pages).items()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    noisy = {r["host"]: set(r["noisy"]) for r in html_extract.noisy_branches(tree).collect()}
    ups = {(r["host"], r["node"]): (r["up"], r["depth"], r["pages"]) for r in tree.collect()}

    def out(k):
        up, depth, pages = ups[k]
        return (want[k] < html_extract.LOW and pages >= html_extract.MIN_PAGES and depth >= 3) or ((k[0], up) in ups and out((k[0], up)))
    assert {(h, n) for h, ns in noisy.items() for n in ns} == {k for k in ups if out(k)} and noisy


def test_subsequence_kernel_by_definition():
    def plain(a, b):
        n, lam = toxicity.ORDER, toxicity.DECAY
        from itertools import combinations
        spans = lambda s: [(tuple(s[i] for i in c), c[-1] - c[0] + 1) for c in combinations(range(len(s)), n)]
        return sum(lam ** (x + y) for u, x in spans(a) for v, y in spans(b) if u == v)
    words = ["idiot", "idxiot", "abcabc", "aaaa", "nation", "xy"]
    for a in words:
        for b in words:
            got = toxicity.subsequence_kernel(toxicity.encode([a, "zz"]), toxicity.encode([b, "qq"]))[0]
            assert got == pytest.approx(plain(a, b), rel=1e-4)


def toxic_table(n=500):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randint(3, 40))]
        y = int(i % 4 == 0)
        if y:
            text.insert(rnd.randrange(len(text)), rnd.choice(["moron", "wurzelzwerg", "stinky"]))
        rows.append((i, ". ".join([" ".join(text[:5]).capitalize(), " ".join(text[5:])]), y))
    return rows


def test_toxicity_learns_and_tolerates_insertions(spark):
    rows = toxic_table()
    docs = spark.createDataFrame([(d, t, "a", "b", "c", "e") for d, t, _ in rows] + [(None, None, "", "", "", ""), (9000, "", "", "", "", ""), (9000, "", "", "", "", "")], CLASH)
    labels = spark.createDataFrame([(d, y) for d, _, y in rows] + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(rows) + 3
    want = {d: y for d, _, y in rows}
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out if r["doc_id"] is not None)
    assert np.mean([r["predicted"] == want.get(r["doc_id"], 0) for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    p = {w: model.probability(toxicity.Scorer(model).margins([w])[0]) for w in
         ["moron", "MORON!", "m.o.r.o.n", "m o r o n", "m0ron", "wurzel-zwerg", "wurzelzwxerg", "abcdef", "", "stink" * 400]}
    assert all(p[w] > 0.5 for w in ["moron", "MORON!", "m.o.r.o.n", "m o r o n", "m0ron", "wurzel-zwerg", "wurzelzwxerg"]), p
    assert p["abcdef"] < 0.5 and p[""] < 0.5
    none = toxicity.train(docs, labels.limit(0))
    assert {round(r["score"], 6) for r in toxicity.score(docs, none).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_reads_all_scripts(spark):
    rnd = random.Random(5)
    insults = {"абвгдежзик": "придурок", "αβγδεζηθικ": "μαλάκας", "אבגדהוזחט": "מטומטם", "ابتثجحخدذر": "غبيالحمار", "कखगघचछजझ": "मूरखगधा",
               "天地日月山川水火木": "傻逼", "กขคงจฉช": "ควาย"}
    rows = []
    for s, (alphabet, bad) in enumerate(insults.items()):
        spaced = s < 5
        words = ["".join(rnd.choice(alphabet) for _ in range(5)) for _ in range(40)]
        for i in range(120):
            text = rnd.choices(words, k=6)
            y = int(i % 3 == 0)
            rows.append((1000 * s + i, (" " if spaced else "").join(text[:3] + [bad] * y + text[3:]), y))
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int"))
    out = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect() if r["held_out"]}
    right = {s: np.mean([out[d] == y for d, _, y in rows if d in out and d // 1000 == s]) for s in range(len(insults))}
    assert min(right.values()) > 0.9, right


def test_toxicity_learns_more_than_64_insults(spark):
    rnd = random.Random(9)
    insults = ["".join(rnd.sample("klmnopqrstuvwxyz", 7)) for _ in range(90)]
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(60)]
    clean = lambda: " ".join(rnd.choices(words, k=8))
    rows = [(i, f"{clean()} {insults[i // 10]}", 1) for i in range(10 * 90)] + [(2000 + i, clean(), 0) for i in range(1500)]
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int"))
    caught = [model.probability(m) > 0.5 for m in toxicity.Scorer(model).margins(insults)]
    # Fewer than MIN_TOXIC training documents may be left of a few.
    assert len(model.landmarks) > 64 and sum(caught) >= 85
    assert model.probability(toxicity.Scorer(model).margins([clean()])[0]) < 0.5


def library_counts(pieces, fallback, texts):
    from tokenizers import Tokenizer, models
    vocab = [("<unk>", 0.0)] + ([(f"<0x{i:02X}>", 0.0) for i in range(256)] if fallback else []) + pieces
    model = Tokenizer(models.Unigram(vocab, 0, fallback))
    return [len(model.encode(unigram.SPACE + t.replace(" ", unigram.SPACE)).ids) if t else 0 for t in texts]


def test_unigram_counts_equal_library():
    rnd = random.Random(2)
    real = unigram.sentencepiece_pieces(P.path("piece_bpe_32k.model"))
    alphabet = list("aeinst  \n.é日ab▁") + ["the", "ing", " "]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))) for _ in range(3000)] + ["", " ", "a" * 5000]
    counter = unigram.Counter(real)
    assert counter.by_chunk and [counter.count(t) for t in texts] == library_counts(real, True, texts)
    s = unigram.SPACE
    ties = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("abc", -2.5), ("c", -0.5), ("bc", -1.5), (s, -1.0), (s + "a", -2.0), ("a" + s, -1.75)]
    texts = ["".join(rnd.choice("abcxé ") for _ in range(rnd.randint(0, 12))) for _ in range(4000)]
    for fallback in (True, False):
        counter = unigram.Counter(ties, fallback)
        assert not counter.by_chunk and [counter.count(t) for t in texts] == library_counts(ties, fallback, texts)


def test_unigram_column(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "some words"), (3, "some words"), (4, "w " * 20000)], "doc_id long, text string")
    out = docs.select("doc_id", unigram.token_count("text", P.path("piece_bpe_32k.model")).alias("n")).collect()
    assert sorted((r["doc_id"], r["n"]) for r in out)[:4] == [(1, 0), (2, 0), (3, out[2]["n"]), (3, out[2]["n"])]
    assert docs.limit(0).select(unigram.token_count("text", P.path("piece_bpe_32k.model"))).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_pipeline_stages(spark):
    import corpus_pipeline
    from cohortforge.llm import decontam, mixing, quality
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = quality.apply_policy(quality.build_ledger(docs)).filter("kept")
    comp = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs.join(want.select("doc_id"), "doc_id")).collect()}
    keep = {d for d, c in comp.items() if d == c}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    leaks = {r["doc_id"] for r in decontam.scan(docs, bench, ["doc_id"]).filter("n_hit > 0").collect()}
    left = docs.filter(docs.doc_id.isin(sorted(keep - leaks)))
    n = {r["doc_id"]: r["copies"] for r in mixing.mix(left).collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    got = {}
    for r in out:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {d: c for d, c in n.items() if c}
    out.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in out] == sorted(r["doc_id"] for r in out)
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(out, out[1:]))
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [s for s, _ in corpus_pipeline.STAGES]
