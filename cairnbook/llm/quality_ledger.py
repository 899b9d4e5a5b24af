"""Quality rules as a ledger: every rule is evaluated once, its failure is a bit beside the measurements.

Policies are masks over the bits with a version, applied to a ledger that stays as it is; what each
rule costs a policy is computed from counts of bit patterns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\f\r"
#: Distinct repeated windows up to which membership is a scan; beyond it positions are found by sorting. Both give the same.
_SCAN = 48

#: Rule names in the order of their bits. Fixed: a bit keeps its meaning over versions.
RULES = ("few_words", "repeated_windows", "symbols", "duplicate_lines", "word_length")


@dataclass(frozen=True)
class Policy:
    """A version of the rules that reject, and how many of them a text may fail."""

    version: str
    rules: tuple[str, ...]
    allowed: int = 0

    @property
    def mask(self) -> int:
        return sum(1 << RULES.index(rule) for rule in self.rules)


POLICIES = {p.version: p for p in (
    Policy("base", ("few_words", "repeated_windows")),
    Policy("1", RULES),
)}


def _covered(hashes: str, n: str) -> Column:
    """Words in windows found twice or more, from the column of window hashes of a text."""
    return F.expr(f"""
        CASE WHEN size(repeated) = 0 THEN 0L ELSE
          aggregate(transform(positions, (p, k) -> least(3, coalesce(get(positions, k + 1) - p, 3))), 0L, (a, x) -> a + x) END""")


def measure(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    One pass without a shuffle; null text measures as empty. Each stage is a projection of its own,
    so that arrays which later expressions use several times are computed once.
    """
    text = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    split = text.select("doc_id", "text", F.btrim("text", F.lit(_BLANKS)).alias("trimmed")).select(
        "doc_id", "text", F.when(F.col("trimmed") == "", F.expr("array()").cast("array<string>")).otherwise(F.split("trimmed", _SPACE)).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(_BLANKS)) != "").alias("lines"))
    counted = split.select(
        "doc_id", "words", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    kept = [c for c in counted.columns if c != "words"]
    windows = counted.select(*kept, F.expr(
        "CASE WHEN size(words) < 3 THEN cast(array() AS array<bigint>) ELSE transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])) END").alias("windows"))
    ordered = windows.select(*kept, "windows", F.sort_array("windows").alias("ordered"))
    repeated = ordered.select(*kept, "windows", F.array_distinct(F.filter("ordered", lambda h, i: F.coalesce(h == F.get("ordered", i - 1), F.lit(False)))).alias("repeated"))
    marked = repeated.select(*kept, "repeated", F.expr(f"""
        CASE WHEN size(repeated) = 0 THEN cast(array() AS array<int>)
             WHEN size(repeated) <= {_SCAN} THEN filter(transform(windows, (h, i) -> IF(array_contains(repeated, h), i, NULL)), p -> p IS NOT NULL)
             ELSE cast(NULL AS array<int>) END""").alias("positions"), F.expr(f"""
        CASE WHEN size(repeated) > {_SCAN} THEN sort_array(transform(windows, (h, i) -> struct(h, i))) END""").alias("pairs"))
    placed = marked.select(*kept, "repeated", F.expr("""
        CASE WHEN pairs IS NULL THEN positions ELSE
          sort_array(filter(transform(pairs, (x, k) -> IF(coalesce(x.h = get(pairs, k - 1).h, false) OR coalesce(x.h = get(pairs, k + 1).h, false), x.i, NULL)), p -> p IS NOT NULL)) END""").alias("positions"))
    return placed.select(*kept, _covered("windows", "n_words").alias("n_repeat_words"))


def ledger(measured: DataFrame) -> DataFrame:
    """`measured` with `failures`: bit k is set where rule k of RULES fails."""
    n = F.col("n_words")
    fails = {
        "few_words": n < 50,
        "repeated_windows": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "duplicate_lines": 100 * F.col("n_dup_lines") > 50 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 12 * n),
    }
    bits = [F.when(fails[rule], F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k, rule in enumerate(RULES)]
    return measured.withColumn("failures", sum(bits[1:], bits[0]))


def apply_policy(written: DataFrame, policy: Policy) -> DataFrame:
    """A ledger with `kept`: at most `policy.allowed` of the policy's rules fail."""
    return written.withColumn("kept", F.bit_count(F.col("failures").bitwiseAND(F.lit(policy.mask).cast("long"))) <= policy.allowed)


def patterns(written: DataFrame) -> DataFrame:
    """failures, n_docs: how often each pattern of failure bits occurs; at most two to the number of rules rows."""
    return written.groupBy("failures").agg(F.count("*").alias("n_docs"))


def ablations(written: DataFrame, policy: Policy) -> DataFrame:
    """rule, n_failed, n_only, n_kept_without of each of the policy's rules: texts that fail it, that would be
    kept without it, and all that are kept without it."""
    rules = F.array(*(F.struct(F.lit(rule).alias("rule"), F.lit(1 << RULES.index(rule)).cast("long").alias("bit")) for rule in policy.rules))
    masked = F.col("failures").bitwiseAND(F.lit(policy.mask).cast("long"))
    kept, without = F.bit_count(masked) <= policy.allowed, F.bit_count(masked.bitwiseAND(F.bitwise_not("bit"))) <= policy.allowed
    failed = F.col("failures").bitwiseAND(F.col("bit")) != 0
    def n(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n_docs"))), F.lit(0)).alias

    table = patterns(written).select("failures", "n_docs", F.inline(rules))
    return table.groupBy("rule").agg(n(failed)("n_failed"), n(~kept & without)("n_only"), n(without)("n_kept_without"))
