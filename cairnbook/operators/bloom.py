"""Bloom filters as columns: the keys of a small side tell which rows of a large side may meet them.

A filter is one array of 64-bit words, made by partial ``bit_or`` sums and read as a scalar subquery, so it reaches the
tasks without a join. It has two bits per key and 16 bits of room per key, up to 4 MB: beyond that more rows pass, and
as every row that passes is verified by a join, results never depend on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of the least and the largest filter, as powers of two.
LEAST, MOST = 10, 25


def bits_for(keys: int) -> int:
    """Bits of a filter for so many keys: a power of two, about 1.5 % of foreign keys pass."""
    return 1 << min(MOST, max(LEAST, (16 * max(keys, 1) - 1).bit_length()))


def _spots(key: Column, bits: int) -> list[Column]:
    return [key.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(bits - 1))]


def build(keys: DataFrame, key: Column, bits: int) -> Column:
    """The filter of the 64-bit hashes ``key`` over the rows of ``keys``, as a scalar."""
    spots = keys.select(F.explode(F.array(*_spots(key, bits))).alias("at"))
    words = spots.groupBy(F.expr("at div 64").alias("id")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 AS int)))").alias("word"))
    dense = keys.sparkSession.range(bits // 64).join(words, "id", "left").select(F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word")).alias("w"))
    # A row per word, whose number is bounded by MOST.
    return dense.agg(F.transform(F.sort_array(F.collect_list("w")), lambda w: w["word"]).alias("words")).scalar()


def may_hold(words: Column, key: Column, bits: int) -> Column:
    """Whether a filter may hold a key: false is certain."""
    first, second = (F.getbit(F.get(words, F.floor(at / 64).cast("int")), F.pmod(at, F.lit(64)).cast("int")) == 1 for at in _spots(key, bits))
    return first & second
