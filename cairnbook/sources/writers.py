"""Writers of the ledger's file formats. Partition columns are spread by a rebalance, which splits hot values."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cairnbook.functions import jsons as J
from cairnbook.functions.dates import run_stamp
from cairnbook.functions.strings import bare_domain, slug
from cairnbook.operators.ledger import csv_cells
from cairnbook.session import ensure_checkpoint_dir

def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything can be read at a path."""
    try:
        spark.read.text(path).schema  # noqa: B018  analysis alone looks for the path
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


DYNAMIC = {"partitionOverwriteMode": "dynamic"}


def write_ledger(ledger: DataFrame, path: str) -> None:
    csv_cells(ledger).write.mode("overwrite").csv(path, header=True, escape='"', quote='"', emptyValue="")


def write_artifacts(artifacts: DataFrame, path: str, zone: str = "UTC") -> None:
    """``source_url, extracted_at TIMESTAMP, artifact_json`` as JSON lines below domain and run folders.

    Line breaks between the parts of a document become spaces. Only touched folders are replaced; in them documents of
    other addresses stay, so a repeated run replaces its own documents and no others."""
    line = F.regexp_replace("artifact_json", r"[\r\n]+", " ")
    rows = artifacts.select(slug(bare_domain(F.col("source_url"))).alias("domain_slug"),
                            run_stamp(F.col("extracted_at"), zone).alias("run_ts"), line.alias("value"), "source_url")
    folders = ["domain_slug", "run_ts"]
    new = rows.select(*folders, "value")
    if path_exists(artifacts.sparkSession, path):
        ensure_checkpoint_dir(artifacts.sparkSession)
        address = F.try_element_at(J.fields(F.col("value")), F.lit("source_url")).cast("string")
        held = artifacts.sparkSession.read.schema("value string, domain_slug string, run_ts string").text(path)
        held = held.join(new.select(*folders).distinct(), folders, "left_semi").withColumn("source_url", address)
        others = held.join(rows.select(*folders, "source_url").distinct(), [*folders, "source_url"], "left_anti").join(new.distinct(), [*folders, "value"], "left_anti")
        # The checkpoint ends the reading of folders that are about to be replaced.
        new = new.union(others.select(*folders, "value").checkpoint())
    new.hint("rebalance", *folders).write.mode("overwrite").options(**DYNAMIC).partitionBy(*folders).text(path)


def write_events(events: DataFrame, path: str) -> None:
    """Event rows partitioned by the first two characters of ``event_id``; only touched partitions are replaced."""
    rows = events.withColumn("shard", F.substring("event_id", 1, 2))
    rows.hint("rebalance", "shard").write.mode("overwrite").options(**DYNAMIC).partitionBy("shard").parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("shard")


def write_reports(reports: DataFrame, path: str, per_event: bool = False) -> None:
    """Reports as a table by shard of the id, or (for small sets) one Markdown text folder per event."""
    if per_event:
        reports.select("event_id", F.col("markdown").alias("value")).write.mode("overwrite").partitionBy("event_id").text(path)
        return
    write_events(reports.select("event_id", "markdown"), path)


def write_lines(lines: DataFrame, path: str) -> None:
    """``event_id, line_no, line`` by shard of the id, range-partitioned and sorted: an event is a run of rows in one file or
    several, whatever its size. Only touched shards are replaced."""
    rows = lines.withColumn("shard", F.substring("event_id", 1, 2))
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["shard", "event_id", "line_no"]
    rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).write.mode("overwrite").options(**DYNAMIC).partitionBy("shard").parquet(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("event_id string, line_no long, line string").parquet(path).select("event_id", "line_no", "line")


def write_manifest(items: DataFrame, path: str) -> None:
    """List of reports as JSON lines, in order of id within and between files, at every size."""
    items.orderBy("id").write.mode("overwrite").json(path)


def import_index(artifacts: DataFrame, path: str, dry_run: bool = False, skip_existing: bool = False) -> DataFrame:
    """Write the four index columns; the result counts what was imported. A dry run only counts.

    With ``skip_existing`` an index that is there stays, and nothing counts as imported."""
    field = lambda k: F.try_element_at(J.fields(F.col("artifact_json")), F.lit(k)).cast("string")
    index = artifacts.select(F.col("file_path").alias("path"), field("source_url").alias("source_url"),
                             field("mountain_name").alias("mountain_name"),
                             field("extraction_confidence_score").try_cast("double").alias("extraction_confidence_score"))
    if skip_existing and not dry_run and path_exists(artifacts.sparkSession, path):
        return index.agg(F.lit(0).cast("long").alias("artifacts"))
    if not dry_run:
        index.write.mode("overwrite").json(path)
    return index.agg(F.count(F.lit(1)).alias("artifacts"))
