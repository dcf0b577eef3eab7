"""Registered queries of this subpackage and the SQL that states their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge.llm import (conversation, decontam, html_extract, linededup, merkle, mixing, pii, quality, simhash,
                             suffixes, tokens, toxicity, unigram)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; the model learns from the training fold."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, failed rules and the current policy's verdict of every document."""
    ledger = quality.build_ledger(_table(spark, sf_dir, "documents"))
    base = F.lit(quality.policy_mask(quality.BASE_POLICY)).cast("long")
    judged = quality.apply_policy(ledger, quality.CURRENT_POLICY)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (F.col("fail_bits").bitwiseAND(base) != 0).alias("base_failed"), "kept", "fail_bits")


def _op3_sql() -> str:
    bits = " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in quality.RULES)
    base, current = (quality.policy_mask(v) for v in (quality.BASE_POLICY, quality.CURRENT_POLICY))
    n = quality.WINDOW
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
                      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
               FROM documents),
    win AS (SELECT rid, unnest(range(1, len(w) - {n - 2})) AS i, w FROM d),
    rep AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, array_to_string(w[i:i + {n - 1}], ' ')) AS c FROM win),
    pos AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + {n})) AS p FROM rep WHERE c > 1) GROUP BY rid),
    m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                 (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                 (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(pos.n, 0)::BIGINT AS n_repeat_words,
                 len(l)::BIGINT AS n_lines, (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_upper
          FROM d LEFT JOIN pos USING (rid)),
    f AS (SELECT *, ({bits})::BIGINT AS fail_bits FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           (fail_bits & {base}) <> 0 AS base_failed, (fail_bits & {current}) = 0 AS kept, fail_bits FROM f"""


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a 10-word window of a benchmark item."""
    hits = decontam.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), ["doc_id"])
    rows = hits.select("*", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))).alias("copy"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP4_SQL = r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[i:i + 9], ' ') AS win
           FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    lens AS (SELECT DISTINCT l FROM bw),
    dw AS (SELECT rid, l, i, array_to_string(w[i:i + l - 1], ' ') AS win
           FROM (SELECT rid, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, lens)),
    hit AS (SELECT rid, dw.l, i, item_id FROM dw JOIN bw USING (l, win)),
    h AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + l)) AS p FROM hit) GROUP BY rid),
    t AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
          FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hit) GROUP BY rid)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
           sha256(coalesce(t.s, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
    FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)"""


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of all documents without later copies of repeated line runs."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedupe_lines(docs, n_removed="n_removed")


def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of all documents with personal data replaced by pseudonyms."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, pii.session_key(spark), n_found="n_replaced")


def byte_bpe() -> str:
    """The tokenizer file of the contract."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as binary records and read back."""
    return tokens.token_records(spark, _table(spark, sf_dir, "documents"), byte_bpe())


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram tokens of every document."""
    import public_tokenizers
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", unigram.token_count("text", public_tokenizers.path("piece_bpe_32k.model")).alias("n_tokens"),
                       F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_characters"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without the bytes of repeated 200-byte strings."""
    found = suffixes.dedupe(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# Window starts p of a text with an equal window elsewhere; removed runs are islands of
# starts at most a window apart. Bytes are pairs of hexadecimal digits.
OP11_SQL = """
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    w AS (SELECT rid, p, md5(substr(x, (2 * p + 1)::BIGINT, 400)) AS s
          FROM (SELECT rid, x, unnest(range(0, strlen(x) // 2 - 199)) AS p FROM d)),
    r AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY s) AS c FROM w) WHERE c > 1),
    k AS (SELECT *, sum(gap) OVER (PARTITION BY rid ORDER BY p) AS run FROM
          (SELECT *, (p - lag(p, 1, -1000) OVER (PARTITION BY rid ORDER BY p) > 200)::INT AS gap FROM r)),
    s AS (SELECT rid, min(p) AS a, max(p) + 200 AS b FROM k GROUP BY rid, run),
    f AS (SELECT rid, count(*) AS n, sum(b - a) AS m, max(b) AS last,
                 string_agg(piece, '' ORDER BY a) AS kept
          FROM (SELECT s.*, substr(x, (2 * prev + 1)::BIGINT, (2 * (a - prev))::BIGINT) AS piece
                FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS prev FROM s) s JOIN d USING (rid))
          GROUP BY rid)
    SELECT doc_id, (strlen(x) // 2)::BIGINT AS n_bytes, coalesce(m, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
           sha256(unhex(coalesce(kept, '') || substr(x, (2 * coalesce(last, 0) + 1)::BIGINT))) AS kept_sha256
    FROM d LEFT JOIN f USING (rid)"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    rows = _table(spark, sf_dir, "conversations")
    found = conversation.repair(conversation.damage(rows), keys=rows.select("conv_id"))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the check of tampered ones."""
    return merkle.tamper_checks(_table(spark, sf_dir, "documents"))


def _op13_sql() -> str:
    def leaf(*fields: str) -> str:
        return "sha256(" + " || ".join(
            f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}::VARCHAR) || ':' || {f}::VARCHAR END" for f in fields) + ")"

    def tree(name: str, leaves: str) -> str:
        """Nodes of all levels over (g, i, h), and the siblings of each."""
        return f"""{name} AS (SELECT 0 AS lvl, g, i, h, count(*) OVER (PARTITION BY g) AS n FROM {leaves}
                 UNION ALL SELECT lvl + 1, g, i // {merkle.ARITY}, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8
                 FROM {name} WHERE n > 1 GROUP BY lvl, g, i // {merkle.ARITY}, n),
        {name}_sib AS (SELECT lvl, g, i, coalesce(string_agg(h, '' ORDER BY i) OVER (own ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                 coalesce(string_agg(h, '' ORDER BY i) OVER (own ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
                 FROM {name} WHERE n > 1 WINDOW own AS (PARTITION BY lvl, g, i // {merkle.ARITY} ORDER BY i))"""

    def walk(name: str, sibs: str, start: str) -> str:
        return f"""{name} AS ({start} UNION ALL
                 SELECT w.rid, w.lvl + 1, w.g, w.i // {merkle.ARITY}, sha256(l || w.h || r), w.acc || l || r
                 FROM {name} w JOIN {sibs} s ON s.lvl = w.lvl AND s.g IS NOT DISTINCT FROM w.g AND s.i = w.i)"""

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, lang AS g, {leaf(*merkle.FIELDS)} AS h,
        {leaf("doc_id", "source", "lang", "n_chars", lower)} AS low,
        list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
            lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))) AS crc FROM documents),
    e AS (SELECT rid, doc_id, g, h, CASE WHEN xor(crc, 4294967295::BIGINT) % 3 = 0 THEN low ELSE h END AS c FROM d),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h, c, rid) - 1 AS i FROM e),
    {tree("node", "leaves")},
    subroots AS (SELECT g AS lang, h, 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i FROM node WHERE n = 1),
    {tree("top", "subroots")},
    {walk("up", "node_sib", "SELECT rid, 0 AS lvl, g, i, c AS h, '' AS acc FROM leaves")},
    low AS (SELECT u.rid, u.h, u.acc, s.i, s.h AS subroot FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY lvl DESC) AS k FROM up) u
            JOIN subroots s ON s.lang IS NOT DISTINCT FROM u.g WHERE k = 1),
    {walk("over", "top_sib", "SELECT rid, 0 AS lvl, 0 AS g, i, h, acc FROM low")},
    done AS (SELECT rid, h, acc FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY lvl DESC) AS k FROM over) WHERE k = 1),
    root AS (SELECT h AS root FROM top WHERE n = 1)
    SELECT leaves.doc_id, leaves.h AS leaf, subroot, (SELECT root FROM root) AS root, sha256(done.acc) AS proof_sha256,
           done.h AS folded_root, done.h = (SELECT root FROM root) AS verified
    FROM leaves JOIN low USING (rid) JOIN done USING (rid)"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_decontamination": op4_decontamination,
    "op5_mixing": op5_mixing,
    "op6_line_dedup": op6_line_dedup,
    "op7_pii_pseudonyms": op7_pii_pseudonyms,
    "op8_token_records": op8_token_records,
    "op9_html_extraction": op9_html_extraction,
    "op10_token_counts": op10_token_counts,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE = {
    "op3_quality_rules": _op3_sql(),
    "op4_decontamination": OP4_SQL,
    "op11_suffix_dedup": OP11_SQL,
    "op13_merkle_manifest": _op13_sql(),
}
