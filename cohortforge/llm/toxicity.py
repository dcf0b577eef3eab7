"""Toxicity by a subsequence string-kernel SVM with Nyström landmarks.

A sentence is a bag of words and as toxic as its worst word, a document as its
worst sentence. Words are compared by the gapped subsequence kernel:
common subsequences of ``ORDER`` letters, each weighted by ``DECAY`` to the power
of the stretch it spans in either word; the beginning of a word is a letter. Gaps
cost weight but not the match, so many inserted letters keep a word close to the
insult; a left-out letter does only where the landmark has six different letters
or more (README has figures). Before that, letters lose case and accents, digits and
signs inside a word become the letters they stand for or go, and spelled-out
letters (``a b c``) are joined. Letters of all scripts count; where a script has no
spaces between words, every two to four of its letters in a row are a word.

Landmarks are words and word beginnings that toxic training sentences have and
clean ones do not: for each toxic document those whose counts are least due to
chance, as many as the sample shows. Kernel values against
the landmarks are mapped by the inverse square root of the landmarks' own
kernel matrix (Nyström); a linear SVM is trained on the words of the sentences,
insults of toxic documents against all words of clean ones, each weighted by its
documents. A document's worst margin becomes a probability by a logistic fit.

Words that clean documents use as well can still mark a toxic one by their share of
it. Word beginnings that make up at least ``DENSE`` of a document's words, mostly in
toxic training documents, are a second set of landmarks; a document shows one if that share
of its words resembles it by the same kernel. The logistic fit takes both, the worst
word and whether such a share is reached.

Training uses at most ``MAX_DOCS`` labelled documents of the training fold, the
ones with the smallest hashed ids. Scoring reads all texts whole; the score of a
word is remembered per worker in a bounded table.

Defined results: null, empty and wordless texts get the score of a document
whose words resemble no landmark; a null id is not held out and never trains;
documents with several labels train as toxic if one label says so; repeated rows
each get their score; other columns are not looked at; without toxic or without
clean training documents every score is the share of toxic ones (0.5 without any).
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.common import materialize, text_of

ORDER, DECAY = 3, 0.6
MAX_LETTERS, MAX_START, MAX_DOCS = 24, 10, 8_000
MIN_TOXIC, PURE, STRONG, NEAR, SURE = 4, 0.75, 0.3, 0.9, 0.8
DENSE, MIN_DENSE, PURE_DENSE = 0.01, 12, 0.85
WIDTH, MAX_KNOWN = MAX_LETTERS + 1, 400_000

# Signs that stand for letters.
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
                       "!": "i", "|": "l", "+": "t", "€": "e", "£": "l"})
SPELLED = re.compile(r"(?<!\S)\S[.,*_-]?(?:\s\S[.,*_-]?){2,}(?!\S)")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
OTHER = re.compile(r"[^a-z]+")
# Scripts without spaces between words (Thai, Lao, Tibetan, Burmese, Khmer, kana and Han).
UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")
GRAMS = (2, 3, 4)
# Codes: a-z 1-26, the beginning 27, other letters their code points. Bits of a word's letters: a code below 28 has its own.
START, LETTER_BITS = 27, ~np.uint64(1 | 1 << 27)


def letters(token: str) -> str:
    """Letters of a lower-cased token: signs at its ends go, those inside are read as letters."""
    token = EDGES.sub("", token)
    if token.isascii() and token.isalpha():
        return token
    if not token.isascii():
        token = "".join(c for c in unicodedata.normalize("NFKD", token.replace("ß", "ss")) if not unicodedata.combining(c))
    if any(c.isalpha() for c in token):
        token = token.translate(SIGNS)
    if token.isascii():
        return OTHER.sub("", token)
    # Vowel signs of Indic and other scripts are marks.
    return "".join(c for c in token if c.isalpha() or unicodedata.category(c)[0] == "M")


def words_of(token: str) -> list[str]:
    """The words that a token is compared by."""
    word = letters(token)
    if word.isascii() or not UNSPACED.search(word):
        return [word] if len(word) >= ORDER else []
    runs = [r for r in UNSPACED.split(word) if len(r) >= ORDER]
    return runs + [r[i:i + n] for r in UNSPACED.findall(word) for n in GRAMS for i in range(len(r) - n + 1)]


def accented_words_of(token: str) -> list[str]:
    """The same with accents, which a share is counted by: letters that clean words
    have without the accent are others there."""
    if token.isascii() or UNSPACED.search(token):
        return words_of(token)
    word = "".join(c for c in unicodedata.normalize("NFC", token) if c.isalpha() or unicodedata.category(c)[0] == "M")
    return [word] if len(word) >= ORDER else []


def tokens(text: str) -> list[str]:
    """Lower-cased tokens; runs of single letters are one token."""
    text = text.lower()
    return SPELLED.sub(lambda m: re.sub(r"[\s.,*_-]", "", m[0]), text).split()


def pieces(word: str) -> list[str]:
    """A word behind the sign of its beginning, in overlapping pieces of at most ``MAX_LETTERS`` letters."""
    if len(word) <= MAX_LETTERS:
        return ["{" + word]
    step = MAX_LETTERS // 2
    return [("" if i else "{") + word[i:i + MAX_LETTERS] for i in range(0, len(word) - step, step)]


def encode(words: list[str]) -> np.ndarray:
    """Words as rows of codes, 0 after the end."""
    codes = np.array(words or [""], dtype=f"U{WIDTH}")[:len(words)].view(np.uint32).reshape(len(words), WIDTH)
    return np.where((codes > 96) & (codes < 124), codes - 96, codes)


def masks(codes: np.ndarray) -> np.ndarray:
    """Bit set of the letters of each word; letters beside a-z share bits."""
    bits = np.where(codes > START, START + 1 + codes % 36, codes).astype(np.uint64)
    return np.bitwise_or.reduce(np.where(codes > 0, np.uint64(1) << bits, np.uint64(0)), axis=1)


def subsequence_kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Kernel of row i of ``a`` with row i of ``b``, for common subsequences of
    ``ORDER`` letters. The usual recursion over the orders, with letters of ``a``
    outside, letters of ``b`` inside and all rows at once."""
    n = len(a)
    la, lb = int((a > 0).sum(axis=1).max(initial=0)), int((b > 0).sum(axis=1).max(initial=0))
    a, b = a[:, :la], b[:, :lb]
    # inner[p][j]: weight of common subsequences of p letters in the prefixes, up to their ends
    inner = [np.ones((lb + 1, n), dtype=np.float32)] + [np.zeros((lb + 1, n), dtype=np.float32) for _ in range(ORDER - 1)]
    total = np.zeros(n, dtype=np.float32)
    bt = np.ascontiguousarray(b.T)
    for i in range(la):
        same = ((bt == a[:, i]) & (bt > 0)).astype(np.float32)
        total += DECAY * DECAY * (same * inner[ORDER - 1][:lb]).sum(axis=0)
        for p in range(ORDER - 1, 0, -1):
            run, below, own = np.zeros(n, dtype=np.float32), inner[p - 1], inner[p]
            for j in range(lb):
                run = DECAY * run + DECAY * DECAY * same[j] * below[j]
                own[j + 1] = DECAY * own[j + 1] + run
    return total


@dataclass
class Model:
    """A trained model: landmarks, their own kernel values, the weights on kernel
    values (SVM weights through the Nyström map), the landmarks whose share counts,
    and the logistic fit on margin and share."""
    landmarks: np.ndarray
    norms: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    dense: np.ndarray
    dense_norms: np.ndarray
    dense_slope: float = 0.0

    def margins(self, kernel: np.ndarray) -> np.ndarray:
        return kernel @ self.weights + self.bias

    def probability(self, margin: float, share: float = 0.0) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.dense_slope * share + self.offset, -40, 40))))


def landmark_kernel(words: list[str], landmarks: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Kernel of words with landmarks, as a share of the landmark's own, at most 1. A
    landmark answers only to words that have all of its different letters, but
    for one if it has six or more."""
    codes = encode(words)
    own, asked = masks(codes), masks(landmarks)
    lacks = np.bitwise_count((asked & LETTER_BITS)[None, :] & ~own[:, None])
    i, j = np.nonzero(lacks <= (np.bitwise_count(asked & LETTER_BITS) >= 6)[None, :])
    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    for at in range(0, len(i), 16384):
        s = slice(at, at + 16384)
        out[i[s], j[s]] = np.minimum(subsequence_kernel(codes[i[s]], landmarks[j[s]]) / norms[j[s]], 1)
    return out


class Scorer:
    """Evidence of texts by a model, that of tokens remembered."""

    def __init__(self, model: Model):
        self.model, self.none = model, float(model.bias)
        self.known: dict[str, float] = {}
        self.older: dict[str, float] = {}
        self.hits: dict[str, list[int]] = {}  # tokens like a landmark whose share counts
        self.older_hits: dict[str, list[int]] = {}

    def _learn(self, cut: list[list[str]]) -> None:
        known, older, none, model = self.known, self.older, self.none, self.model
        owners, words, marked, accented = [], [], [], []
        for t in set().union(*cut).difference(known):
            if t in older:
                known[t] = older[t]
                if t in self.older_hits:
                    self.hits[t] = self.older_hits[t]
                continue
            known[t] = none
            for w in words_of(t):
                for piece in pieces(w):
                    owners.append(t)
                    words.append(piece)
            if len(model.dense):
                for w in accented_words_of(t):
                    marked.append(t)
                    accented.append("{" + w[:MAX_LETTERS])
        for at in range(0, len(words), 4096):
            values = model.margins(landmark_kernel(words[at:at + 4096], model.landmarks, model.norms))
            for i in np.flatnonzero(values > none):
                known[owners[at + i]] = max(known[owners[at + i]], float(values[i]))
        for at in range(0, len(accented), 4096):
            alike = landmark_kernel(accented[at:at + 4096], model.dense, model.dense_norms) >= NEAR
            for i, j in zip(*np.nonzero(alike)):
                mine = self.hits.setdefault(marked[at + i], [])
                if j not in mine:
                    mine.append(int(j))

    def evidence(self, texts: list[str]) -> tuple[list[float], list[np.ndarray]]:
        """Worst margin of each text, and for each dense landmark the share of its
        words that resemble it, in units of ``DENSE``, one at most."""
        cut = [tokens(t) for t in texts]
        self._learn(cut)
        known, hits, none = self.known, self.hits, self.none
        margins = [max(max(map(known.__getitem__, c), default=none), none) for c in cut]
        shares = []
        for c in cut:
            own = np.zeros(len(self.model.dense))
            for t in filter(hits.__contains__, c) if hits else ():
                own[hits[t]] += 1
            shares.append(np.minimum(own / max(DENSE * len(c), 1e-9), 1))
        if len(known) > MAX_KNOWN:  # tokens that come again move over, the others go
            self.known, self.older, self.hits, self.older_hits = {}, known, {}, hits
        return margins, shares

    def margins(self, texts: list[str]) -> list[float]:
        return self.evidence(texts)[0]


def _features(col: Column | str, landmarks: np.ndarray, norms: np.ndarray) -> Column:
    """Kernel values of a column of words."""
    @F.pandas_udf("array<double>")
    def values(part: pd.Series) -> pd.Series:
        return pd.Series(list(landmark_kernel(["{" + w for w in part], landmarks, norms).astype(float)), dtype="object")
    return values(F.col(col) if isinstance(col, str) else col)


def evidence_column(col: Column | str, model: Model, whole: bool = False) -> Column:
    """Worst-word margin ``m`` of a text column, and ``d``, 1 where the share of a dense
    landmark is reached; ``whole``: the shares of all of them instead."""
    kind = "array<double>" if whole else "double"

    @F.pandas_udf(f"struct<m:double,d:{kind}>")
    def evidence(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for part in parts:
            texts, m, d = part.tolist(), [], []
            for i in range(0, len(texts), 500):
                margins, shares = scorer.evidence(texts[i:i + 500])
                m += margins
                d += [x.tolist() if whole else float(x.max(initial=0.0) >= 1) for x in shares]
            yield pd.DataFrame({"m": np.array(m, dtype="float64"), "d": pd.Series(d, dtype="object" if whole else "float64")})
    return evidence(text_of(col))


def _invsqrt(k: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(k.astype(np.float64))
    return vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 1.0, rounds: int = 100) -> tuple[np.ndarray, float]:
    """Linear SVM by dual coordinate descent; the bias is one more feature."""
    x = np.hstack([x, np.ones((len(x), 1))])
    norms, alpha, w = (x * x).sum(axis=1), np.zeros(len(x)), np.zeros(x.shape[1])
    order = np.random.default_rng(7)
    live = np.arange(len(x))
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(live):
            gradient = y[i] * (x[i] @ w) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), c * weight[i])
            if new != alpha[i]:
                moved = max(moved, abs(new - alpha[i]))
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
        # words that never come near the margin are left out of later rounds
        live = np.flatnonzero((alpha > 0) | (y * (x @ w) < 1.5))
        if moved < 1e-3 or not len(live):
            break
    return w[:-1], float(w[-1])


def _logistic(evidence: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Slopes and offset of the probability, by Newton steps on smoothed targets."""
    good, bad = float(n @ y), float(n @ (1 - y))
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.column_stack([evidence, np.ones(len(evidence))])
    theta = np.zeros(x.shape[1])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (n * q * (1 - q))[:, None]) + 1e-3 * np.eye(x.shape[1]), x.T @ (n * (q - target)) + 1e-3 * theta)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return theta


def training_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                       max_docs: int = MAX_DOCS) -> DataFrame:
    """At most ``max_docs`` labelled documents of the training fold: ``k``, ``y``, ``t``."""
    fold = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
    fold = fold.groupBy(F.col(key).alias("k")).agg(F.max(F.col(label).cast("int")).alias("y"))
    some = fold.orderBy(F.xxhash64("k"), "k").limit(max_docs)
    return docs.select(F.col(key).alias("k"), text_of(text).alias("t")).join(some, "k")


def held_out(key: Column) -> Column:
    """crc32 of the id's text is a multiple of five."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _starts(text: str) -> list[str]:
    """Whole words (ended by ``}``) and word beginnings of a text."""
    words = {w for t in set(tokens(text)) for w in words_of(t)}
    out = {w[:n] for w in words for n in range(min(ORDER, len(w)), min(len(w), MAX_START) + 1)}
    return sorted(out | {w + "}" for w in words if len(w) <= MAX_LETTERS})


def _dense_starts(text: str) -> list[str]:
    """Word beginnings that make up at least ``DENSE`` of a text's words."""
    cut, found = tokens(text), {}
    for t, n in Counter(cut).items():
        for w in {w[:n] for w in accented_words_of(t) for n in range(min(ORDER, len(w)), min(len(w), MAX_START) + 1)}:
            found[w] = found.get(w, 0) + n
    return sorted(w for w, n in found.items() if n >= DENSE * len(cut))


def _apart(ranked: list[str]) -> list[str]:
    """Of words that begin alike the first."""
    chosen: list[str] = []
    for w in ranked:
        if not any(w.startswith(c) or c.startswith(w) for c in chosen):
            chosen.append(w)
    return chosen


def _no_model(toxic: int, clean: int) -> Model:
    share = toxic / (toxic + clean) if toxic + clean else 0.5
    nothing = np.zeros((0, WIDTH), dtype=np.uint32)
    return Model(nothing, np.zeros(0), np.zeros(0), 0.0, 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))), nothing, np.zeros(0))


def _collected(rows: DataFrame, *more: str) -> tuple:
    """Distinct values of ``v`` with the sums of other columns; the sample bounds them."""
    found = rows.groupBy("v").agg(*[F.sum(c).alias(c) for c in more]).collect()
    return tuple(np.array([r[c] for r in found], dtype=np.float64) for c in ("v", *more))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          max_docs: int = MAX_DOCS) -> Model:
    """Fits the model; Spark counts the sample's words, the driver gets bounded
    lists of words and the kernel values of sampled documents."""
    sample = materialize(training_documents(docs, labels, key, text, label, max_docs), "toxic-sample")
    split = F.pandas_udf(lambda part: part.map(_starts), "array<string>")
    dense = F.pandas_udf(lambda part: part.map(_dense_starts), "array<string>")
    # Copies of a text count once.
    texts = materialize(sample.groupBy(F.xxhash64("t").alias("d")).agg(F.max("y").alias("y"), F.first("t").alias("t"))
                        .select("d", "y", split("t").alias("w"), dense("t").alias("dense")), "toxic-words")
    n_docs = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n_docs.get(1, 0), n_docs.get(0, 0)
    if not toxic or not clean:
        return _no_model(toxic, clean)
    rows = texts.select("d", "y", F.explode_outer("w").alias("w")).filter("w is not null")
    counts = materialize(rows.groupBy("w").agg(F.sum("y").alias("bad"), F.count("*").alias("n")), "toxic-counts")
    q = toxic / (toxic + clean)
    bad, good = F.col("bad"), F.col("n") - F.col("bad")
    bad_docs = bad
    # Log-likelihood ratio of a word's toxic share against that of all documents.
    ratio = 2 * (bad * F.log(bad / (F.col("n") * q)) + F.when(good > 0, good * F.log(good / (F.col("n") * (1 - q)))).otherwise(0.0))
    suspects = counts.filter((bad >= MIN_TOXIC) & (bad >= PURE * F.col("n"))).select("w", ratio.alias("llr"))
    suspects = materialize(suspects, "toxic-suspects")
    found = [(r["d"], r["w"].rstrip("}"), r["llr"]) for r in  # toxic sampled documents x suspects
             rows.filter("y = 1").join(F.broadcast(suspects), "w").select("d", "w", "llr").collect()]
    top: dict[int, float] = {}
    for d, _, llr in found:
        top[d] = max(top.get(d, 0.0), llr)
    # Witnesses: not much weaker than the strongest one of some document. Of
    # words that begin alike the strongest stays, of equal ones the longest.
    strong = {w: llr for d, w, llr in found if llr >= STRONG * top[d]}
    chosen = _apart(sorted(strong, key=lambda w: (-strong[w], -len(w), w)))
    if not chosen:
        return _no_model(toxic, clean)
    landmarks = encode(["{" + w for w in chosen])
    norms = subsequence_kernel(landmarks, landmarks)
    # Every word of the sample with the numbers of toxic and clean documents that hold it.
    whole = counts.filter(F.col("w").endswith("}")).select(F.expr("rtrim('}', w)").alias("w"), "bad", (F.col("n") - F.col("bad")).alias("good"))
    raw, bad, good = _collected(whole.select(_features("w", landmarks, norms).alias("v"), "bad", "good"), "bad", "good")
    near = raw >= NEAR
    sure = (near.T @ bad) >= SURE * (near.T @ (bad + good))
    if not sure.any():
        return _no_model(toxic, clean)
    chosen, landmarks, norms, raw = [w for w, ok in zip(chosen, sure) if ok], landmarks[sure], norms[sure], raw[:, sure]
    own = landmark_kernel(["{" + w for w in chosen], landmarks, norms)
    whiten = _invsqrt((own + own.T) / 2)
    insult = (raw.max(axis=1) >= NEAR) & (bad > 0)
    x = np.vstack([raw[insult], raw[good > 0]])
    y = np.concatenate([np.ones(insult.sum()), -np.ones((good > 0).sum())])
    w, bias = _svm(x @ whiten, y, np.concatenate([bad[insult], good[good > 0]]))
    # Beginnings whose share tells toxic documents; those stay that do so by the kernel too.
    by_share = texts.select("y", F.explode("dense").alias("w")).groupBy("w").agg(F.sum("y").alias("bad"), F.count("*").alias("n"))
    by_share = by_share.filter((bad_docs >= MIN_DENSE) & (bad_docs >= PURE_DENSE * F.col("n"))).select("w", ratio.alias("llr")).collect()
    starts = _apart([r["w"] for r in sorted(by_share, key=lambda r: (-r["llr"], -len(r["w"]), r["w"]))])
    dense_marks = encode(["{" + w for w in starts])
    model = Model(landmarks, norms, whiten @ w, bias, 1.0, 0.0, dense_marks, subsequence_kernel(dense_marks, dense_marks))
    if starts:
        shown = sample.select("y", F.posexplode(evidence_column("t", model, whole=True)["d"]).alias("at", "share")).filter("share >= 1")
        kept = {r["at"] for r in shown.groupBy("at").agg(F.sum("y").alias("bad"), F.count("*").alias("n")).collect()
                if r["bad"] >= PURE_DENSE * r["n"]}
        stay = np.array([i in kept for i in range(len(starts))])
        model.dense, model.dense_norms = model.dense[stay], model.dense_norms[stay]
    e = sample.select("y", evidence_column("t", model).alias("e")).groupBy("e.m", "e.d", "y").agg(F.count("*").alias("n")).collect()
    fit = np.array([(r["m"], r["d"], r["y"], r["n"]) for r in e], dtype=np.float64)  # one row a sampled document at most
    model.slope, model.dense_slope, model.offset = map(float, _logistic(fit[:, :2], fit[:, 2], fit[:, 3]))
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, ``held_out``, ``score`` and ``predicted``."""
    logit = F.col("e.m") * model.slope + F.col("e.d") * model.dense_slope + model.offset
    logit = F.least(F.greatest(logit, F.lit(-40.0)), F.lit(40.0))
    rows = docs.select(F.col(key), held_out(F.col(key)).alias("held_out"), evidence_column(text, model).alias("e"))
    rows = rows.withColumn("score", 1 / (1 + F.exp(-logit)))
    return rows.select(key, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
