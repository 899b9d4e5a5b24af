"""Repeated lines and sentences: normalise, digest, keep the earliest ranked occurrence, remove the rest by their offsets.

Every line with a word is a unit. A passage that was pasted into a longer line is no line of its own, so
a line of several sentences is cut further and its sentences of `min_words` words or more are units too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnbook.session import new_run_dir

#: Words of a sentence that is a unit of its own.
SENTENCE_WORDS = 8
_END = re.compile(r"[.!?][\x20\x09-\x0D]+")


def normalised(line: str) -> list[bytes]:
    """Words of a line: A-Z lower-cased, split at ASCII white space."""
    return line.encode("utf-8", "surrogatepass").lower().split()


def row_key() -> Column:
    """Digest of the text."""
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def sentences(line: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a line, which they fill: each ends behind the white space after `.`, `!` or `?`."""
    ends = [m.end() for m in _END.finditer(line)]
    if not ends or ends[-1] != len(line):
        ends.append(len(line))
    return list(zip([0, *ends], ends))


def units(docs: DataFrame, *, min_words: int) -> DataFrame:
    """doc_id, row_key, digest, unit, start, end, whole, again: the units of a document.

    unit: number of the line (cut at \\n); start and end: code points of the text; whole: the unit is the line,
    not a sentence of it; again: the document has the unit before. row_key tells texts of a repeated doc_id apart."""
    schema = "doc_id long, row_key binary, digest binary, unit long, start long, end long, whole boolean, again boolean"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in schema.split(", ")])

        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text, key in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = text.as_py() or ""
                met, at = set(), 0
                for unit, line in enumerate(text.split("\n")):
                    parts = sentences(line)
                    spans = [(0, len(line), True), *((s, e, False) for s, e in parts if len(parts) > 1)]
                    for start, end, whole in spans:
                        words = normalised(line[start:end])
                        if len(words) < (1 if whole else min_words):
                            continue
                        digest = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
                        rows.append((doc_id, key, digest, unit, at + start, at + end, whole, digest in met))
                        met.add(digest)
                    at += len(line) + 1
                if len(rows) > 50_000:
                    yield batch_of(rows)
                    rows = []
            yield batch_of(rows)

    return docs.select(F.col("doc_id").cast("long"), "text", row_key()).mapInArrow(cut, schema)


def repeated_units(docs: DataFrame, *, min_words: int = SENTENCE_WORDS) -> DataFrame:
    """doc_id, row_key, unit, start, end, whole of the units to remove.

    The rank of an occurrence is its doc_id (null last), its text, and its place in it; the first stays. Rows
    with equal id and text have one rank and keep the same units. The earliest holder of a digest is a partial
    aggregate, and the join back is one that Spark can split, so a line that a third of all documents have is spread."""
    path = new_run_dir(docs.sparkSession, "units")
    units(docs, min_words=min_words).write.parquet(path)
    found = docs.sparkSession.read.parquet(path)
    holder = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    earliest = found.groupBy("digest").agg(F.min(holder).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = F.col("again") | ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row_key") == F.col("first.row_key")))
    return found.join(earliest, "digest").where(later).select("doc_id", "row_key", "unit", "start", "end", "whole")


def remove_repeats(docs: DataFrame, *, min_words: int = SENTENCE_WORDS) -> DataFrame:
    """doc_id, n_units (lines), n_removed (units), removed (start:end of each, comma-joined, in code points of the text) and
    kept_text of every row of `docs`: the other lines less their removed sentences, joined by \\n. A line that goes whole is
    told as a line only; one whose sentences all go leaves an empty line. A null text is one empty unit."""
    text = F.coalesce("text", F.lit(""))
    gone = repeated_units(docs, min_words=min_words).distinct().groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_list(F.struct("unit", (~F.col("whole")).alias("part"), "start", "end"))).alias("gone"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), row_key().alias("row_key"))
    there = gone.withColumnsRenamed({"doc_id": "gone_id", "row_key": "gone_key"})
    held = keyed.join(there, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("row_key") == F.col("gone_key")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, gone in zip(*(batch.column(k).to_pylist() for k in range(3))):
                lines = {g["unit"] for g in gone or () if not g["part"]}
                spans = [g for g in gone or () if not g["part"] or g["unit"] not in lines]
                kept, at = [], 0
                for g in spans:
                    kept.append(text[at:g["start"]])
                    # A line goes with the break after it, the last one with the break before it.
                    at = g["end"] + (0 if g["part"] else 1)
                kept = "".join([*kept, text[at:]])
                if spans and not spans[-1]["part"] and spans[-1]["end"] == len(text):
                    kept = kept[:-1]
                rows.append((doc_id, text.count("\n") + 1, len(spans), ",".join(f"{g['start']}:{g['end']}" for g in spans), kept))
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_units", "n_removed", "removed", "kept_text"])

    return held.select("doc_id", "text", "gone").mapInArrow(cut, "doc_id long, n_units long, n_removed long, removed string, kept_text string")


ORACLE = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
u AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
l AS (SELECT doc_id, i, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s,
             list_filter(string_split(regexp_replace(line, '([.!?][\x20\x09-\x0D]+)', '\1' || chr(1114111), 'g'), chr(1114111)), lambda x: x <> '') AS parts FROM u),
p AS (SELECT doc_id, i, 0 AS k, s, line AS piece FROM l
      UNION ALL SELECT doc_id, i, k, s + coalesce(list_sum(list_transform(parts[:k - 1], lambda x: length(x))), 0)::BIGINT, parts[k]
      FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS k FROM l WHERE len(parts) > 1)),
n AS (SELECT *, list_filter(regexp_split_to_array(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM p),
r AS (SELECT *, len(ws) >= (CASE WHEN k = 0 THEN 1 ELSE 8 END) AS unit FROM n),
f AS (SELECT *, unit AND row_number() OVER (PARTITION BY unit, ws ORDER BY doc_id, i, k) > 1 AS gone FROM r),
w AS (SELECT *, bool_or(gone AND k = 0) OVER (PARTITION BY doc_id, i) AS line_gone FROM f),
g AS (SELECT *, gone AND (k = 0 OR NOT line_gone) AS told FROM w),
t AS (SELECT doc_id, i, any_value(line_gone) AS line_gone, coalesce(string_agg(piece, '' ORDER BY k) FILTER (NOT gone AND (k > 0 OR NOT many)), '') AS txt
      FROM (SELECT *, max(k) OVER (PARTITION BY doc_id, i) > 0 AS many FROM g) GROUP BY doc_id, i),
k AS (SELECT doc_id, coalesce(string_agg(txt, chr(10) ORDER BY i) FILTER (NOT line_gone), '') AS kept FROM t GROUP BY doc_id)
SELECT doc_id, count(*) FILTER (k = 0)::BIGINT AS n_units, count(*) FILTER (told)::BIGINT AS n_removed,
       coalesce(string_agg(s::VARCHAR || ':' || (s + length(piece))::VARCHAR, ',' ORDER BY i, k) FILTER (told), '') AS removed,
       any_value(length(kept))::BIGINT AS n_kept_chars, any_value(md5(kept)) AS kept_md5
FROM g JOIN k USING (doc_id) GROUP BY doc_id
"""
