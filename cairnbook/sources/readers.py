"""Readers of the ledger's file formats."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cairnbook.functions import jsons as J
from cairnbook.functions.strings import base_name, strip
from cairnbook.operators.ledger import header

PATH = "_metadata.file_path"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table; one in fewer splits than there are cores is dealt out evenly.

    A row group cannot be split, so a small file of many rows would be one task, however long its rows take."""
    table, cores = spark.read.parquet(path), spark.sparkContext.defaultParallelism
    return table if table.rdd.getNumPartitions() >= cores else table.repartition(2 * cores)


def _documents(spark: SparkSession, path: str, pattern: str, whole: bool = True) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.text(path, wholetext=whole).select(F.col("value"), F.col(PATH).alias("file_path"))


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


@contextmanager
def last_key_wins(spark: SparkSession) -> Iterator[None]:
    """Frames made and streams started inside read the last value of a repeated JSON key instead of refusing the document."""
    name = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def judged_documents(docs: DataFrame) -> DataFrame:
    """``file_path, artifact_json, reason, value`` of raw documents ``file_path, value``.

    ``reason`` is null for a JSON object. A document that repeats keys is written anew with the last value of each, so whatever
    reads ``artifact_json`` later takes it. Else it is ``unreadable`` (no JSON, or beyond what a JSON value may hold) or ``no object``."""
    plain = docs.select("*", F.try_parse_json("value").isNotNull().alias("_plain"))
    with last_key_wins(docs.sparkSession):
        kept = plain.select("*", F.when(~F.col("_plain"), F.to_json(F.try_parse_json("value"))).alias("_last"))
    text = F.when(F.col("_plain"), F.col("value")).otherwise(F.col("_last"))
    reason = F.when(text.isNull(), "unreadable").when(J.fields(text).isNull(), "no object")
    return kept.select("file_path", text.alias("artifact_json"), reason.alias("reason"), "value")


def scan_artifacts(spark: SparkSession, path: str, pattern: str = "accident_info.json", whole: bool = True) -> DataFrame:
    """All readable artifacts below a folder: ``file_path, run_dir, artifact_json``; of a repeated key the last value counts.

    ``whole`` reads one JSON object per file; otherwise one per line."""
    docs = judged_documents(_documents(spark, path, pattern, whole))
    return docs.where("reason IS NULL").select("file_path", _folder(F.col("file_path")).alias("run_dir"), "artifact_json")


def rejected_artifacts(spark: SparkSession, path: str, pattern: str = "accident_info.json", whole: bool = True) -> DataFrame:
    """What ``scan_artifacts`` leaves out: ``file_path, reason, n_chars, value``, see ``judged_documents``."""
    docs = judged_documents(_documents(spark, path, pattern, whole))
    return docs.where("reason IS NOT NULL").select("file_path", "reason", F.length("value").alias("n_chars"), "value")


def scan_sidecars(spark: SparkSession, path: str, pattern: str = "captions.json", whole: bool = True) -> DataFrame:
    """Caption documents beside artifacts, of any JSON shape: ``run_dir, sidecar_json``."""
    docs = _documents(spark, path, pattern, whole)
    return docs.where(F.try_parse_json("value").isNotNull()).select(
        _folder(F.col("file_path")).alias("run_dir"), F.col("value").alias("sidecar_json"))


def with_sidecars(artifacts: DataFrame, sidecars: DataFrame) -> DataFrame:
    return artifacts.join(sidecars, "run_dir", "left")


def scan_url_list(spark: SparkSession, path: str) -> DataFrame:
    """Addresses, one or several (comma) per line; blank lines and ``#`` lines are skipped."""
    return split_url_lines(spark.read.text(path))


def split_url_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    line = strip(F.col(column))
    used = lines.where((line != "") & ~line.startswith("#"))
    return used.select(F.explode(F.transform(F.split(line, ",", -1), strip)).alias("url")).where("url <> ''")


def scan_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "array<string>")).alias("name"))


def scan_reports(spark: SparkSession, path: str, pattern: str = "*.md", folder_key: str | None = None) -> DataFrame:
    """Markdown files as ``id, markdown`` with unified line ends; the id is the file name, or the value of a ``folder_key=`` folder."""
    docs = _documents(spark, path, pattern)
    name = F.regexp_replace(base_name(F.col("file_path")), r"\.[^.]*$", "")
    if folder_key is not None:
        name = F.regexp_extract("file_path", rf"/{folder_key}=([^/]*)/", 1)
    return docs.select(name.alias("id"), F.regexp_replace("value", "\r\n?", "\n").alias("markdown"))


def manifest_items(texts: DataFrame, column: str = "value") -> DataFrame:
    """Items of list documents: a JSON array, or an object with ``reports``."""
    v = F.try_parse_json(column)
    listed = F.coalesce(J.items(v), F.try_variant_get(v, "$.reports", "array<variant>"))
    names = ("id", "title", "peak", "date_of_event", "date", "activity", "region", "summary")
    rows = texts.select(F.explode(listed).alias("r")).where(J.kind(F.col("r")) == "OBJECT")
    return rows.select(*[F.try_variant_get("r", f"$.{n}", "string").alias(n) for n in names])


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    return manifest_items(spark.read.text(path, wholetext=True))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger CSV keyed by address: the last of equal addresses wins, by file name and place in the file.

    A missing path is an empty ledger; any other fault is raised."""
    try:
        rows = spark.read.csv(path, header=True, multiLine=True, escape='"', quote='"')
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in header()))
    kept = [c for c in rows.columns if c != "source_url"]
    place = F.struct(F.col(PATH), F.monotonically_increasing_id())  # a file with multi-line cells is read by one task
    numbered = rows.select("*", place.alias("_n")).where(F.col("source_url").isNotNull())
    return (numbered.groupBy("source_url").agg(F.max_by(F.struct(*kept), "_n").alias("r"))
            .select("source_url", "r.*").select(*rows.columns))


