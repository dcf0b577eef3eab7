"""Quality rules as a bitmask ledger (DataFrame functions only).

``build_ledger`` evaluates every rule once per document and stores the
measurements and one bit per failed rule. A policy is a versioned set of rules:
applying one, or asking what each of its rules costs, reads only the ledger.

Defined results: a null text counts as empty; an empty text has no words and
fails ``few_words``; repeated rows each get their own ledger row; columns of the
input other than the key and the text are not looked at; an empty table gives
an empty ledger. Nothing is shuffled: all measures come from the row itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.common import WHITE, text_of, ws_words

WINDOW = 8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]


@dataclass(frozen=True)
class Rule:
    """A condition on the measures that a document must not meet; ``fails`` is
    SQL that both Spark and other engines read, over integers only."""
    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "5 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 20 * n_words"),
    Rule(6, "upper_case", "2 * n_upper > word_chars"),
)

# Versioned policies: a document is kept if no rule of the policy failed.
POLICIES = {
    1: ("few_words", "repeated_windows"),
    2: ("few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words", "upper_case"),
}
BASE_POLICY, CURRENT_POLICY = 1, 2


def policy_mask(version: int) -> int:
    """The bits of a policy's rules."""
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[name] for name in POLICIES[version])


def _repeat_words(words: str) -> Column:
    """Words inside 8-word windows that occur twice or more in the text.

    Windows are sorted by hash inside the row, equal neighbours are compared
    word by word, and the union of the covered positions is counted: n log n
    in the words of the text. ``transform(array(x), v -> ...)[0]`` names an
    intermediate value so that lambdas do not compute it again."""
    same = (f"(get(s, {{o}}).h = x.h and slice(w, get(s, {{o}}).i + 1, {WINDOW}) = slice(w, x.i + 1, {WINDOW}))")
    covered = f"""
      transform(array(sort_array(transform(
          filter(s, (x, j) -> coalesce({same.format(o='j - 1')}, false) or coalesce({same.format(o='j + 1')}, false)),
          x -> x.i))), p ->
        aggregate(transform(p, (a, j) -> least({WINDOW}, coalesce(get(p, j + 1) - a, {WINDOW}))), 0L, (t, x) -> t + x))[0]"""
    return F.expr(f"""
      case when size({words}) < {WINDOW} then 0L else
      transform(array({words}), w ->
        transform(array(transform(w, x -> xxhash64(x))), g ->
          transform(array(transform(sequence(1, size(w) - {WINDOW - 1}), i -> xxhash64(slice(g, i, {WINDOW})))), k ->
            case when size(array_distinct(k)) = size(k) then 0L else
              transform(array(sort_array(transform(k, (h, i) -> struct(h as h, i as i)))), s -> {covered})[0]
            end)[0])[0])[0] end""")


def with_measures(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per input row: the ``keep`` columns and the measures."""
    keep = keep or []
    t = text_of(text)
    base = docs.select(*[F.col(c) for c in keep], t.alias("_t"), ws_words(text).alias("_w"))
    lines = F.filter(F.split(F.col("_t"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    upper = F.length("_t") - F.length(F.regexp_replace("_t", "[A-Z]+", ""))
    mid = base.select(
        *keep, "_w", F.size("_w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_t", WHITE, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        upper.cast("long").alias("n_upper"), lines.alias("_l"))
    return mid.select(
        *keep, "n_words", "word_chars", "n_symbols",
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _repeat_words("_w").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"), "n_upper")


def build_ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The ledger: key, every measure and ``fail_bits`` (long), one row per input row."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in RULES]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return with_measures(docs, text, [key]).withColumn("fail_bits", mask)


def apply_policy(ledger: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return ledger.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(policy_mask(version)).cast("long")) == 0)


def ablations(ledger: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    """What each rule of a policy does: documents it fails, documents only it
    rejects (kept again if the rule is left out), and how many the policy keeps
    without it. Works on the counts per distinct bit mask, at most 2**rules rows."""
    mask = policy_mask(version)
    rules = [r for r in RULES if r.name in POLICIES[version]]
    counts = ledger.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    n_if = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    parts = []
    for r in rules:
        bit, rest = F.lit(1 << r.bit).cast("long"), F.lit(mask & ~(1 << r.bit)).cast("long")
        parts.append(F.struct(
            F.lit(r.name).alias("rule"), n_if(F.col("bits").bitwiseAND(bit) != 0).alias("n_fails"),
            n_if(F.col("bits") == bit).alias("n_only_this"),
            n_if(F.col("bits").bitwiseAND(rest) == 0).alias("n_kept_without")))
    return counts.agg(F.array(*parts).alias("a")).select(F.explode("a").alias("a")).select("a.*")


def quality_filter(docs: DataFrame, version: int = CURRENT_POLICY, text: str = "text") -> DataFrame:
    """The rows whose text passes a policy, with their columns unchanged."""
    names = docs.columns
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs[text].alias("body"))
    ledger = build_ledger(packed, key="row", text="body")
    return apply_policy(ledger, version).filter("kept").select("row.*")
