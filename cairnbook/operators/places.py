"""Place names in texts, for name lists of any size: one form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnbook.operators import bloom

GRAM = 3
WORD = r"(?U)\w+"
MARK = r"(?U)[^\w\s]"


def _tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def _whole_word(text: Column, name: Column) -> Column:
    """Case-insensitive whole-word occurrence of a literal name."""
    pattern = F.concat(F.lit(r"(?iU)\b\Q"), F.replace(name, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E\b"))
    return F.contains(F.lower(text), F.lower(name)) & F.regexp_like(text, pattern)


def offered_runs(texts: DataFrame, keyed: DataFrame, offers: list[Column], bits: int) -> DataFrame:
    """``doc_id, gram``: the distinct runs of a text that a Bloom filter over the names' runs lets through."""
    known = bloom.build(keyed, F.xxhash64("gram"), bits)
    return (texts.select("doc_id", "text", _tokens(F.col("text")).alias("w"), known.alias("known"))
            .select("doc_id", F.explode(F.filter(F.array_distinct(F.flatten(F.array(*offers))),
                                                 lambda g: bloom.may_hold(F.col("known"), F.xxhash64(g), bits))).alias("gram")))


def match_places(texts: DataFrame, names: DataFrame) -> DataFrame:
    """``doc_id, name`` for every name (column ``name``) found as a whole word in ``doc_id, text``.

    A name is known by its first (up to three) words, or by its first mark if it has no word. A text offers
    its runs of one to three words and its marks; a Bloom filter over the names' first runs takes out the others inside
    the text's own row, so that little more than the hits becomes rows, and the few candidates are verified on
    the text. Spark chooses how the names are joined, by their measured size."""
    words = _tokens(F.col("name"))
    mark = F.regexp_extract("name", MARK, 0)
    gram = F.when(F.size(words) > 0, F.array_join(F.slice(words, 1, GRAM), " ")).otherwise(mark)
    keyed = names.select("name").distinct().withColumn("gram", gram).where("gram <> ''")
    runs = lambda n: F.transform(F.sequence(F.lit(1), F.size("w") - n + 1),
                                 lambda i: F.array_join(F.slice(F.col("w"), i, n), " "))
    none = F.array().cast("array<string>")
    marks = F.regexp_extract_all("text", F.lit(MARK), F.lit(0))
    # At most four rows: what kinds of first run the names have at all, and how many names.
    used = {r["n"]: r["count"] for r in keyed.groupBy(F.least(F.size(words), F.lit(GRAM)).alias("n")).count().collect()}
    offers = [F.when(F.size("w") >= n, runs(n)).otherwise(none) if n else marks for n in sorted(used)] or [none]
    offered = offered_runs(texts, keyed, offers, bloom.bits_for(sum(used.values())))
    candidates = offered.join(keyed, "gram").select("doc_id", "name").distinct()
    return (texts.select("doc_id", "text").join(candidates, "doc_id")
            .where(_whole_word(F.col("text"), F.col("name"))).select("doc_id", "name"))
