"""The ledger: one current row per source address."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cairnbook.constants import CANONICAL_FIELDS, ONE_LINE_FIELDS, URL_LIST_FIELDS
from cairnbook.functions import jsons as J
from cairnbook.functions.strings import squeeze, third_segment
from cairnbook.operators.ranking import keep_best

METADATA = ("domain", "ts", "artifact_json")


def descending(c: Column) -> Column:
    """A string whose ascending order is the descending order of ``c`` (bytes complemented, end marked)."""
    return F.concat(F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def newest_per_url(records: DataFrame, ts: str = "extracted_at", order: str = "record_id") -> DataFrame:
    """Newest row per address; of equally new ones the first in ``order``. A missing address counts as ''.

    Texts that are no time stamps rank below real ones, in text order. Only addresses and ranks are aggregated;
    the winners' long texts are fetched by a join (``keep_best``)."""
    text = F.col(ts).cast("string")
    at = F.try_to_timestamp(text)
    place = F.coalesce(F.lpad(F.col(order).cast("string"), 20, "0") if dict(records.dtypes)[order] in ("int", "bigint") else F.col(order).cast("string"), F.lit(""))
    shown = F.when(at.isNull(), F.nullif(text, F.lit("")))
    # Later first: a missing time or text comes last.
    rank = F.struct(F.coalesce(-F.unix_micros(at.cast("timestamp")), F.lit((1 << 63) - 1)).alias("a"), shown.isNull().alias("n"), descending(F.coalesce(shown, F.lit(""))).alias("t"), place.alias("o"))
    rank_id = F.concat(F.coalesce(F.concat(F.lit("a"), F.unix_micros(at.cast("timestamp")).cast("string")), F.concat(F.lit("t"), F.coalesce(shown, F.lit("")))), F.lit("|"), place)
    keyed = records.withColumn("source_url", F.coalesce("source_url", F.lit("")))
    return keep_best(keyed, ["source_url"], rank, rank_id).select(*records.columns)


def project(artifacts: DataFrame) -> DataFrame:
    """Canonical fields and metadata of ``artifact_json`` rows; nested values as JSON text."""
    df = artifacts.withColumn("_f", J.fields(F.col("artifact_json")))
    get = lambda k: F.try_element_at("_f", F.lit(k)).cast("string")
    cols = [(F.coalesce(get(k), F.lit("")) if k == "source_url" else get(k)).alias(k) for k in CANONICAL_FIELDS]
    return df.select(*cols, third_segment(F.coalesce(get("source_url"), F.lit(""))).alias("domain"),
                     get("extracted_at").alias("ts"), "artifact_json",
                     *[c for c in artifacts.columns if c in ("record_id", "file_path")])


def list_length(c: Column, dtype: str = "string") -> Column:
    """Length of an array or of a JSON array text; anything else counts 0."""
    if dtype.startswith("array"):
        return F.coalesce(F.when(c.isNotNull(), F.size(c)), F.lit(0))
    return F.coalesce(F.json_array_length(c), F.lit(0))


def add_counts(ledger: DataFrame) -> DataFrame:
    types = dict(ledger.dtypes)
    sources = {"people_count": "people", "rescue_teams_count": "rescue_teams_involved",
               **{f"{k}_count": k for k in URL_LIST_FIELDS}}
    return ledger.select("*", *[list_length(F.col(src), types[src]).alias(out) for out, src in sources.items() if src in types])


def incoming_rows(records: DataFrame) -> DataFrame:
    """Ledger rows of arriving records; the record's own score and mountain fill gaps of the artifact."""
    held = records.select(F.struct("mountain_name", F.col("extraction_confidence_score").cast("string").alias("score"), "record_id").alias("record_id"), "artifact_json")
    rows = project(held)
    own = F.col("record_id")
    fill = {"mountain_name": own["mountain_name"], "extraction_confidence_score": own["score"], "record_id": own["record_id"]}
    return rows.select(*((F.coalesce(F.col(c), fill[c]) if c != "record_id" else fill[c]).alias(c) if c in fill else F.col(c) for c in rows.columns))


def upsert(current: DataFrame, incoming: DataFrame, sequence: str = "seq") -> DataFrame:
    """Insert or replace by address: the last arrival wins whatever its time stamp; an address is required.

    Only addresses and sequence numbers are aggregated, see ``keep_best``."""
    base = current.withColumn(sequence, F.lit(-1).cast("bigint"))
    every = base.unionByName(incoming.where(F.col("source_url") != "")).withColumn("source_url", F.coalesce("source_url", F.lit("")))
    last = F.coalesce(F.col(sequence).cast("long"), F.lit(-(1 << 62)))
    return keep_best(every, ["source_url"], -last, last).select(*current.columns)


def rebuild(artifacts: DataFrame, order: str = "record_id") -> DataFrame:
    """Whole ledger from all artifacts: newest per address, canonical columns, counts."""
    rows = project(artifacts)
    return add_counts(newest_per_url(rows, ts="ts", order=order)).drop(order)


def query(ledger: DataFrame, filters: Mapping[str, object] | None = None) -> DataFrame:
    """Conjunction of equalities; no filter returns everything. Plain predicates, so they reach the scan."""
    tests = [F.col(k) == F.lit(v) for k, v in (filters or {}).items()]
    return ledger.where(reduce(lambda a, b: a & b, tests)) if tests else ledger


def with_artifact(ledger: DataFrame) -> DataFrame:
    return ledger.withColumn("artifact", F.try_parse_json("artifact_json"))


def search(ledger: DataFrame, predicate: Column | Mapping[str, object] | None = None) -> DataFrame:
    if predicate is None:
        return ledger
    return query(ledger, predicate) if isinstance(predicate, Mapping) else ledger.where(predicate)


def header(counts: bool = True) -> list[str]:
    cols = list(CANONICAL_FIELDS) + list(METADATA)
    return cols + ["people_count", "rescue_teams_count"] + [f"{k}_count" for k in URL_LIST_FIELDS] if counts else cols


def csv_cells(ledger: DataFrame) -> DataFrame:
    """All columns as text: nested as JSON, null as '', the long texts on one line."""
    types = dict(ledger.dtypes)

    def cell(name: str) -> Column:
        c = F.col(name)
        nested = types[name].startswith(("array", "map", "struct", "variant"))
        text = F.to_json(c) if nested else c.cast("string")
        text = squeeze(text) if name in ONE_LINE_FIELDS else text
        return F.coalesce(text, F.lit("")).alias(name)

    return ledger.select(*[cell(c) for c in ledger.columns])
