"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged into one tree of style nodes: a node is
the path of block elements with their class, id and role. Presentation
importance of a node is the entropy of the child sequences that its pages show;
content importance falls as its texts repeat over the pages; both combine
bottom-up. Branches of low importance are noise on the whole site and are
removed from each page, like the branches that their markup names as menus,
adverts, forms and so on. Where a page has an article (or main) element, its
text is what stands in it, also where a form or a part named like noise stands
around it. A class or id names noise as a whole (``cookie-notice``, ``sidebar``),
not by one of its words (``with-sidebar``). A form that holds most of a page's
text is a plain block, and a page that has text in parts named like noise only
keeps it.

The merge is a count per (host, node, signature) that combines before it
shuffles; identical pages of a host count once. Importance is linear in the
importances below a node, so it is summed by pointer jumping: each round doubles the
height that a node's sum covers, and ten rounds cover any page. Only the list of a
host's noisy nodes meets its pages again, so a host with a third of all pages is
spread over tasks.

Parsing takes time in proportion to the page: a tag's end is looked up in a table of
the page's quotes and brackets, which is made once. Elements nested deeper than
``MAX_DEPTH`` belong to the last one above.

Defined results: null and empty html give an empty text; a page without url
belongs to the host ''; malformed html is read as far as it goes (unclosed
elements end with their parent, stray end tags are ignored, a tag without an end is
text); a line break inside a block is white space; repeated rows each
get their row; other columns are not looked at; an empty table gives an empty
result. Hosts with fewer than ``MIN_PAGES`` distinct pages have no noisy nodes.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.common import materialize

DAMPING, LOW, MIN_PAGES, MAX_DEPTH = 0.9, 0.2, 8, 512

# Element names of the HTML standard and words that pages use for parts beside the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes noembed iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split())
SKIP = frozenset(
    "head script style noscript template iframe svg canvas object applet audio video map nav footer aside button input "
    "select option textarea fieldset datalist menu dialog noframes noembed".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner banners "
    "cookie cookies consent gdpr notice notices alert alerts popup popups modal overlay newsletter subscribe subscription signup "
    "signin login register sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar "
    "share sharing social related recommended recommendations widget widgets comment comments commentlist disqus reply replies "
    "respond pagination pager search skip".split())
HEADER = frozenset(["header"])
OTHERS = frozenset("comment comments commentlist disqus reply replies respond related recommended recommendations".split())
NEUTRAL = frozenset(
    "area article bar block blog bottom box buttons container entry form global google inner item items left links list main outer page "
    "post posts primary reader readers right secondary section site slot story top unit user users wrap wrapper".split())
# Why a branch is no main text, weakest reason first. An article ends the first two.
PLAIN, FORM, NAMED, NEVER = range(4)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split())
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",)}
LIST_SCOPE = frozenset("ul ol dl table body article section div".split())

# A tag whose attributes hold neither < nor > is found at once, others by ``_TagEnds``.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']|"[^"<>]*"|'[^'<>]*')*+)>|[^<]+|<""", re.S)
OPENING = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*+)")
SPECIAL, MARKED = re.compile("[>\"']"), re.compile(r"<[!?]")
ATTR = re.compile(r"""(?<![^\s"'])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
NAME, SIZES = re.compile(r"[a-z]+"), re.compile(r"\d+(?:x\d+)?")
DIGITS = re.compile(r"\d+|\b[0-9a-f]{8,}\b")


def _hash(*parts) -> int:
    import xxhash
    h = xxhash.xxh64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _named(names: str, noise: frozenset) -> int:
    """What the classes and ids of an element say of it: ``PLAIN``, ``NAMED``, or
    ``NEVER`` for parts whose articles are not the page's own."""
    found = PLAIN
    for name in names.split():
        words = set(NAME.findall(SIZES.sub(" ", name)))
        if words & noise and words <= noise | NEUTRAL:
            found = max(found, NEVER if words & OTHERS else NAMED)
    return found


class _Node:
    __slots__ = ("tag", "h", "skip", "main", "article", "freed", "depth", "up", "kids", "block")

    def __init__(self, tag: str, style: str, up: _Node | None, skip: int, main: bool, article: bool = False, freed: bool = False):
        self.tag, self.up, self.skip, self.main, self.kids = tag, up, skip, main, []
        self.article, self.freed = article, freed  # inside an article; inside one that stands in a NAMED branch
        self.block = tag not in INLINE
        if up is None:
            self.h, self.depth = _hash(style), 0
        elif self.block:
            self.h, self.depth = _hash(up.h, style), up.depth + 1
        else:
            self.h, self.depth = up.h, up.depth


class _TagEnds:
    """The first ``>`` outside quotes after a place: for each quote and bracket of the
    page the end that a tag has whose attributes go on there, made from the back."""

    def __init__(self, page: str):
        found = [(m.start(), m[0]) for m in SPECIAL.finditer(page)]
        self.places = [at for at, _ in found]
        self.ends, following = [-1] * (len(found) + 1), {'"': -1, "'": -1}
        for i in range(len(found) - 1, -1, -1):
            at, sign = found[i]
            if sign == ">":
                self.ends[i] = at
            else:
                partner = following[sign]
                self.ends[i] = self.ends[partner + 1] if partner >= 0 else -1
                following[sign] = i

    def after(self, at: int) -> int:
        return self.ends[bisect_left(self.places, at)]


def _main_blocks(blocks: list) -> list:
    """The blocks of a page that can be main text: those in articles, else those
    in plain parts, else all. Forms and articles that stand in NAMED branches
    count where they hold more than half of that text."""
    for inside in (True, False):
        here = [b for b in blocks if b[2] == inside and b[3] <= FORM]
        sure = [b for b in here if b[3] == PLAIN and not b[4]]
        if here:
            return sure if 2 * sum(len(b[0]) for b in sure) >= sum(len(b[0]) for b in here) else here
    return blocks


def parse(page: str) -> tuple[dict, list, list]:
    """Style nodes {hash: (parent, depth, child signature)}, texts of all leaves
    as (node, text hash), and the blocks that can be main text as (text, node,
    inside an article, reason, freed)."""
    root = _Node("", "", None, PLAIN, False)
    stack, texts, blocks, seen, run = [root], [], [], {root.h: root}, []
    opened, too_deep = Counter(), Counter()
    tag_ends, last = None, page.rfind(">")

    def flush() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            node = stack[-1]
            texts.append((node.h, _hash(text)))
            if node.skip < NEVER:
                blocks.append((text, node.h, node.main, node.skip, node.freed))

    def pop_to(at: int) -> None:
        if any(n.block for n in stack[at:]):
            flush()
        for n in stack[at:]:
            opened[n.tag] -= 1
        del stack[at:]

    def find(tags: tuple, scope: frozenset) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in scope:
                return 0
        return 0

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.match(page, at)
        ending, tag, attributes, to = m[1], m[2], m[3], m.end()
        opening = OPENING.match(page, at) if m[0] == "<" else None
        if opening and at > last:  # no tag ends any more: text up to a comment or declaration, which takes the rest
            rest = MARKED.search(page, at)
            run.append(entities.unescape(page[at:rest.start() if rest else end]))
            break
        if opening:
            tag_ends = tag_ends or _TagEnds(page)
            close = tag_ends.after(opening.end())
            if close >= 0:
                ending, tag, attributes, to = opening[1], opening[2], page[opening.end():close], close + 1
        at = to
        if tag is None:
            if m[0][:2] not in ("<!", "<?"):
                run.append(entities.unescape(m[0]) if "&" in m[0] else m[0])
            continue
        tag = tag.lower()
        if ending:
            if too_deep[tag]:
                too_deep[tag] -= 1
                continue
            i = opened[tag] and next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if i:
                pop_to(i)
            elif tag == "p":
                flush()
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag == "hr":
            flush()
            continue
        if tag in CLOSES_P and opened["p"] and (i := find(("p",), LIST_SCOPE)):
            pop_to(i)
        if tag in SAME_ENDS and any(opened[t] for t in SAME_ENDS[tag]) and (i := find(SAME_ENDS[tag], LIST_SCOPE)):
            pop_to(i)
        up = stack[-1]
        named = {k.lower(): entities.unescape(v.strip("\"'")).lower() for k, v in ATTR.findall(attributes)} if attributes else {}
        own = tag in ("article", "main") or named.get("role") == "main"
        main, article, freed, skip = up.main or own, up.article or tag == "article", up.freed, up.skip
        if own and skip < NEVER and not up.article:
            skip, freed = PLAIN, freed or skip == NAMED
        said = _named(named.get("class", "") + " " + named.get("id", ""), NOISE if main else NOISE | HEADER)
        if tag in SKIP or named.get("role") in ROLES:
            skip = NEVER
        elif own or tag in ("html", "body"):
            pass
        elif said:
            skip = max(skip, said)
        elif not main and tag == "header":
            skip = max(skip, NAMED)
        elif tag == "form" or named.get("role") == "form":
            skip = max(skip, FORM)
        if tag not in INLINE:
            flush()
        if tag in VOID:
            continue
        if tag in RAW:  # up to its end tag, whatever stands in it
            close = re.compile(f"</{re.escape(tag)}[^<>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if len(stack) >= MAX_DEPTH:
            too_deep[tag] += 1
            continue
        style = f"{tag}.{DIGITS.sub('', named.get('class', ''))}#{DIGITS.sub('', named.get('id', ''))}@{named.get('role', '')}"
        node = _Node(tag, style, up, skip, main, article, freed)
        if node.block:
            first = seen.setdefault(node.h, node)
            kids = seen[up.h].kids
            if not kids or kids[-1] != first.h:
                kids.append(first.h)
        stack.append(node)
        opened[tag] += 1
    flush()
    nodes = {h: (n.up.h if n.up else 0, n.depth, _hash(*n.kids)) for h, n in seen.items()}
    return nodes, texts, _main_blocks(blocks)


PARSED = ("page long, url string, host string, same long, node array<long>, up array<long>, depth array<int>, sig array<long>, "
          "leaf array<long>, leaf_text array<long>, block array<string>, block_node array<long>")


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longs = pa.list_(pa.int64())
    schema = pa.schema([("page", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("same", pa.int64()), ("node", longs),
                        ("up", longs), ("depth", pa.list_(pa.int32())), ("sig", longs), ("leaf", longs), ("leaf_text", longs),
                        ("block", pa.list_(pa.string())), ("block_node", longs)])
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            batch = whole.slice(at, 500)
            rows = []
            for page, url, host, text in zip(*(c.to_pylist() for c in batch.columns)):
                nodes, texts, blocks = parse(text)
                up, depth, sig = zip(*nodes.values())
                texts = list(dict.fromkeys(texts))
                rows.append((page, url, host, _hash(text), list(nodes), up, depth, sig, [t[0] for t in texts],
                             [t[1] for t in texts], [b[0] for b in blocks], [b[1] for b in blocks]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def style_tree(parsed: DataFrame, damping: float = DAMPING) -> DataFrame:
    """``host``, ``node``, ``up``, ``depth``, ``pages`` and ``importance`` of every
    style node, from a frame of parsed pages."""
    kept = ("node", "up", "depth", "sig", "leaf", "leaf_text")
    once = materialize(parsed.groupBy("host", "same").agg(F.any_value(F.struct(*kept)).alias("x")).select("host", "x.*"), "style-pages")
    at_base = lambda x, n: F.when(n > 1, F.log(x) / F.log(n))
    styles = once.select("host", F.explode(F.arrays_zip("node", "up", "depth", "sig")).alias("x")).select("host", "x.*")
    styles = styles.groupBy("host", "node", "sig").agg(F.count("*").alias("n"), F.min("up").alias("up"), F.min("depth").alias("depth"))
    styles = styles.groupBy("host", "node").agg(
        F.sum("n").alias("pages"), F.count("*").alias("kinds"), F.sum(F.col("n") * F.log("n")).alias("nlogn"),
        F.min("up").alias("up"), F.min("depth").alias("depth"))
    pages = F.col("pages").cast("double")
    # Entropy of the child sequences, in units of log(pages).
    styles = styles.withColumn("shown", F.coalesce(at_base(F.exp(F.log(pages) - F.col("nlogn") / pages), pages), F.lit(1.0)))
    texts = once.select("host", F.explode(F.arrays_zip(F.col("leaf").alias("node"), F.col("leaf_text").alias("text"))).alias("x"))
    texts = texts.select("host", "x.node", "x.text").groupBy("host", "node", "text").agg(F.count("*").alias("n"))
    texts = texts.groupBy("host", "node").agg(F.sum(F.log("n")).alias("logs"), F.count("*").alias("texts"))
    nodes = materialize(styles.join(texts, ["host", "node"], "left").withColumn(
        "said", F.when(F.col("texts").isNotNull(), F.when(pages > 1, 1 - F.col("logs") / F.col("texts") / F.log(pages)).otherwise(1.0)))
        .select("host", "node", "up", "depth", "pages", "kinds", "shown", "said"), "style-nodes")
    # The node's own text counts like one more child; a node's importance is its own
    # part and a share of each child's.
    weights = nodes.groupBy("host", F.col("up").alias("node")).agg(F.sum("pages").cast("double").alias("weight"))
    own = F.when(F.col("said").isNotNull(), pages).otherwise(0.0)
    damped, inside = F.pow(F.lit(damping), F.col("kinds").cast("double")), F.col("weight") > 0
    said = F.coalesce("said", F.lit(0.0))
    nodes = nodes.join(weights, ["host", "node"], "left").withColumns({
        "share": F.when(inside, damped / (F.col("weight") + own)),
        "s": F.when(inside, (1 - damped) * F.col("shown") + damped * said * own / (F.col("weight") + own)).otherwise(F.coalesce("said", F.lit(1.0)))})
    above = nodes.select("host", F.col("node").alias("up"), "share").filter("share is not null")
    state = nodes.drop("share").join(above, ["host", "up"], "left").select(
        "host", "node", "up", "depth", "pages", "s", F.when(F.col("share").isNotNull(), F.col("up")).alias("anc"), (F.col("share") * pages).alias("coef"))
    state = materialize(state, "style-sums-0")
    for round_ in range(_rounds(state)):
        below = state.filter("anc is not null").groupBy("host", F.col("anc").alias("node")).agg(F.sum(F.col("coef") * F.col("s")).alias("more"))
        hop = state.select("host", F.col("node").alias("anc"), F.col("anc").alias("next"), F.col("coef").alias("by"))
        state = materialize(state.join(below, ["host", "node"], "left").join(hop, ["host", "anc"], "left").select(
            "host", "node", "up", "depth", "pages", (F.col("s") + F.coalesce("more", F.lit(0.0))).alias("s"),
            F.col("next").alias("anc"), (F.col("coef") * F.col("by")).alias("coef")), f"style-sums-{round_ + 1}")
    return state.select("host", "node", "up", "depth", "pages", F.col("s").alias("importance"))


def _rounds(nodes: DataFrame) -> int:
    """Doublings that cover the height of the deepest node; ``MAX_DEPTH`` bounds it."""
    return int(nodes.agg(F.max("depth")).first()[0] or 0).bit_length()


def noisy_branches(tree: DataFrame, low: float = LOW, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host`` and ``noisy``, the nodes of low importance and all nodes below them."""
    state = tree.select("host", "node", F.col("up").alias("anc"), "depth", (
        (F.col("importance") < low) & (F.col("pages") >= min_pages) & (F.col("depth") >= 3)).alias("out"))
    state = materialize(state, "style-noise-0")
    for round_ in range(_rounds(state) if state.filter("out").limit(1).count() else 0):
        hop = state.select("host", F.col("node").alias("anc"), F.col("anc").alias("next"), F.col("out").alias("too"))
        state = materialize(state.join(hop, ["host", "anc"], "left").select(
            "host", "node", F.col("next").alias("anc"), "depth", (F.col("out") | F.coalesce("too", F.lit(False))).alias("out")), f"style-noise-{round_ + 1}")
    return state.filter("out").groupBy("host").agg(F.collect_set("node").alias("noisy"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", low: float = LOW,
            min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per page: key, url, ``text`` and ``n_chars``."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(key).cast("long").alias("page"), F.col(url).alias("url"), host.alias("host"),
                        F.coalesce(F.col(html), F.lit("")).alias("html"))
    parsed = materialize(rows.mapInArrow(_parse_batches, PARSED), "parsed-pages")
    noisy = materialize(noisy_branches(style_tree(parsed), low, min_pages), "noisy-nodes")
    found = parsed.select("page", "url", "host", "block", "block_node").join(noisy, "host", "left")
    kept = F.expr("transform(filter(arrays_zip(block, block_node), x -> not array_contains(noisy, x.block_node)), x -> x.block)")
    text = F.array_join(F.when(F.col("noisy").isNull(), F.col("block")).otherwise(kept), "\n")
    return found.select(F.col("page").alias(key), F.col("url").alias(url), text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))
