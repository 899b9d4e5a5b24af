"""Queries of the llm operators over the driver tables, with SQL oracles where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnbook.llm import decontamination, hnsw, line_dedup, mixing, ns_bounds, odd_sketch, packing, pii, preference, quality_ledger, suffix_dedup, toxicity, whitening
from cairnbook.operators.ranking import number_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


QUERIES["op1_packing"] = _op1


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    held_out = F.coalesce(toxicity.learn_fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES["op10_toxicity"] = _op10


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=4)


QUERIES["op2_odd_sketch"] = _op2


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


QUERIES["op7_pii"] = _op7


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = quality_ledger.ledger(quality_ledger.measure(_table(spark, sf_dir, "documents")))
    base = quality_ledger.POLICIES["base"]
    judged = quality_ledger.apply_policy(written, base).withColumn("base_failed", ~F.col("kept"))
    return quality_ledger.apply_policy(judged, quality_ledger.POLICIES["1"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failures")


QUERIES["op8_quality_ledger"] = _op8
ORACLES["op8_quality_ledger"] = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM hit, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cov USING (r)),
f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
             + CASE WHEN word_chars < 2 * n_words OR word_chars > 12 * n_words THEN 16 ELSE 0 END)::BIGINT AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures FROM f
"""


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


QUERIES["op9_suffix_array"] = _op9


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(_table(spark, sf_dir, "embeddings"))


QUERIES["op6_hnsw"] = _op6


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates, domains = mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return rates.select("doc_id", F.col("tokens").alias("n_tokens"), *(F.col("p")[k].alias(f"p_{name}") for k, name in enumerate(domains.names)), "rate")


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_units", "n_removed", "removed", F.length("kept_text").cast("long").alias("n_kept_chars"), F.md5("kept_text").alias("kept_md5"))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen: every conversation, whole. Rejected: its turns before the last reply (all turns, without one) and then the last
    reply of the next conversation by id, if that has one. Null turns come first; rows with a null conv_id are left out."""
    said = _table(spark, sf_dir, "conversations").where("conv_id is not null")
    turns = said.select(F.col("conv_id").alias("pair_id"), F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), "role", "text")
    reply = F.when(F.col("role") == "assistant", F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))
    known = number_rows(turns.groupBy("pair_id").agg(F.max("turn").alias("top"), F.max(reply).alias("last")), ["pair_id"], name="n")
    follows = known.select((F.col("n") - 1).alias("n"), F.col("last.text").alias("other"))
    ends = known.join(follows, "n", "left").select("pair_id", F.col("last.turn").alias("last"), "top", "other")
    before = turns.join(ends.select("pair_id", "last"), "pair_id").where("last is null or turn < last").select(*turns.columns)
    swapped = ends.where("other is not null").select("pair_id", F.coalesce("last", F.col("top") + 1).alias("turn"), F.lit("assistant").alias("role"), F.col("other").alias("text"))
    return preference.format_pairs(turns, before.union(swapped))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ns_bounds.cluster(_table(spark, sf_dir, "embeddings"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(_table(spark, sf_dir, "embeddings")))


QUERIES |= {"op11_decontamination": _op11, "op12_ns_bounds": _op12, "op13_whitening": _op13}
ORACLES |= {"op11_decontamination": decontamination.ORACLE, "op12_ns_bounds": ns_bounds.oracle()}
QUERIES |= {"op3_mixing": _op3, "op4_line_dedup": _op4, "op5_preference": _op5}
ORACLES["op4_line_dedup"] = line_dedup.ORACLE
ORACLES["op5_preference"] = r"""
WITH t AS (SELECT conv_id AS pair_id, coalesce(turn, -1)::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT pair_id, turn AS last, max(text) AS reply FROM t JOIN (SELECT pair_id, max(turn) AS turn FROM t WHERE role = 'assistant' GROUP BY 1) USING (pair_id, turn)
      WHERE role = 'assistant' GROUP BY 1, 2),
k AS (SELECT *, lead(reply) OVER (ORDER BY pair_id) AS other FROM (SELECT pair_id, max(turn) AS top FROM t GROUP BY 1) LEFT JOIN l USING (pair_id)),
c AS (SELECT pair_id, row_number() OVER (PARTITION BY pair_id ORDER BY turn, role, text) AS i, role, text FROM t),
r0 AS (SELECT t.* FROM t JOIN k USING (pair_id) WHERE last IS NULL OR turn < last
       UNION ALL SELECT pair_id, coalesce(last, top + 1), 'assistant', other FROM k WHERE other IS NOT NULL),
r AS (SELECT pair_id, row_number() OVER (PARTITION BY pair_id ORDER BY turn, role, text) AS i, role, text FROM r0),
b AS (SELECT pair_id, min(i) FILTER (NOT same) AS first_apart, max(i) FILTER (c_has) AS n_c
      FROM (SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.i, r.i) AS i, c.i IS NOT NULL AS c_has,
                   c.i IS NOT NULL AND r.i IS NOT NULL AND c.role = r.role AND c.text = r.text AS same
            FROM c FULL JOIN r ON c.pair_id = r.pair_id AND c.i = r.i) GROUP BY pair_id),
n AS (SELECT pair_id, CASE WHEN first_apart IS NULL THEN n_c ELSE first_apart - 1 END AS n FROM b),
x AS (SELECT side, pair_id, i, role, i <= n AS in_prompt, '<|' || replace(role, '<|', '< |') || '|>' || chr(10) AS head, replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
      FROM (SELECT 'c' AS side, * FROM c UNION ALL SELECT 'r' AS side, * FROM r) JOIN n USING (pair_id)),
s AS (SELECT pair_id, side, in_prompt, string_agg(head || body, '' ORDER BY i) AS txt,
             string_agg(length(head)::VARCHAR || ':0,' || length(body)::VARCHAR || CASE WHEN role = 'assistant' THEN ':1' ELSE ':0' END, ',' ORDER BY i) AS mask
      FROM x GROUP BY pair_id, side, in_prompt)
SELECT n.pair_id, n.n::BIGINT AS n_prompt_turns, coalesce(p.txt, '') AS prompt, coalesce(a.txt, '') AS chosen, coalesce(a.mask, '') AS chosen_mask,
       coalesce(z.txt, '') AS rejected, coalesce(z.mask, '') AS rejected_mask
FROM n LEFT JOIN s p ON p.pair_id = n.pair_id AND p.side = 'c' AND p.in_prompt
LEFT JOIN s a ON a.pair_id = n.pair_id AND a.side = 'c' AND NOT a.in_prompt
LEFT JOIN s z ON z.pair_id = n.pair_id AND z.side = 'r' AND NOT z.in_prompt
"""
