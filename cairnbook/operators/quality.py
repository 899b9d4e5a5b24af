"""Checks over reports and lists. Every check returns ``check, severity, id, detail`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnbook.constants import LIST_ITEM_REQUIRED, OPTIONAL_META_KEYS, REQUIRED_META_KEYS
from cairnbook.functions.dates import parse_date
from cairnbook.functions.strings import strip

FRONT_MATTER = r"(?s)^---\n(.*?)\n---\n"
ISSUE = "array<struct<check:string,severity:string,detail:string>>"


def _issue(test: Column, check: str, severity: str, detail: Column) -> Column:
    return F.when(test, F.struct(F.lit(check).alias("check"), F.lit(severity).alias("severity"), detail.alias("detail")))


def _meta_pairs(reports: DataFrame) -> DataFrame:
    block = F.when(F.col("markdown").rlike(FRONT_MATTER), F.regexp_extract("markdown", FRONT_MATTER, 1))
    lines = F.filter(F.split(block, "\n", -1), lambda l: strip(l) != "")
    keyed = F.transform(F.filter(lines, lambda l: l.contains(":")), lambda l: F.struct(
        strip(F.substring_index(l, ":", 1)).alias("key"),
        strip(F.substring(l, F.instr(l, ":") + 1, F.length(l))).alias("value")))
    return reports.select("id", block.alias("block"), keyed.alias("pairs"),
                          F.filter(lines, lambda l: ~l.contains(":")).alias("malformed"))


def check_reports(reports: DataFrame, strict_region: bool = False, strict_date: bool = False) -> DataFrame:
    """Front matter rules per report, and event ids used by more than one report."""
    df = _meta_pairs(reports)
    keys = F.transform("pairs", lambda p: p["key"])
    value = lambda k: F.coalesce(F.try_element_at(F.transform(
        F.filter("pairs", lambda p: p["key"] == k), lambda p: p["value"]), F.lit(-1)), F.lit(""))
    df = df.withColumn("event_id", F.when(F.col("block").isNotNull(), value("event_id")))
    level = lambda strict: "error" if strict else "warning"
    single = [
        *[_issue(~F.array_contains(keys, k), "missing_key", "error", F.lit(k)) for k in REQUIRED_META_KEYS],
        _issue(F.col("event_id") == "", "event_id_empty", "error", F.lit("")),
        _issue(value("region") == "", "region_empty", level(strict_region), F.lit("")),
        _issue(value("date_of_event") == "", "date_empty", level(strict_date), F.lit("")),
    ]
    unknown = F.array_distinct(F.filter(keys, lambda k: ~k.isin(*REQUIRED_META_KEYS, *OPTIONAL_META_KEYS)))
    listed = lambda items, check: F.transform(items, lambda x: F.struct(
        F.lit(check).alias("check"), F.lit("error").alias("severity"), x.alias("detail")))
    absent = F.array(_issue(F.lit(True), "front_matter_missing", "error", F.lit("")))
    issues = F.when(F.col("block").isNull(), absent.cast(ISSUE)).otherwise(F.concat(
        F.array_compact(F.array(*single)), listed(F.col("malformed"), "malformed_line"),
        listed(unknown, "unexpected_key")).cast(ISSUE))
    rows = df.select("id", F.explode(issues).alias("i")).select("i.check", "i.severity", "id", "i.detail")
    used = df.where(F.col("event_id") != "").select("id", "event_id")
    first = used.groupBy("event_id").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = used.join(first, "event_id").where(F.col("id") != F.col("first_id")).select(
        F.lit("duplicate_event_id").alias("check"), F.lit("error").alias("severity"), "id", F.col("event_id").alias("detail"))
    return rows.unionByName(repeated)


def check_count(manifest: DataFrame, declared: int | None) -> DataFrame:
    """An issue row when the declared number of reports is not the actual one."""
    counted = manifest.agg(F.count(F.lit(1)).alias("n"))
    wrong = counted.where(F.col("n") != F.lit(declared)) if declared is not None else counted.where(F.lit(False))
    return wrong.select(F.lit("manifest_count").alias("check"), F.lit("error").alias("severity"), F.lit("").alias("id"),
                        F.concat(F.lit(f"{declared} != "), F.col("n").cast("string")).alias("detail"))


def check_missing_reports(manifest: DataFrame, reports: DataFrame) -> DataFrame:
    return manifest.select("id").join(reports.select("id"), "id", "left_anti").select(
        F.lit("missing_report").alias("check"), F.lit("error").alias("severity"), "id", F.lit("").alias("detail"))


def check_list_items(items: DataFrame) -> DataFrame:
    """List schema: required fields present, texts not empty, date a full ISO date."""
    have = lambda k: F.col(k) if k in items.columns else F.lit(None).cast("string")
    iso_day = have("date").rlike(r"^\d{4}-\d{2}-\d{2}$") & parse_date(have("date")).isNotNull()
    tests = [_issue(have(k).isNull(), "required", "error", F.lit(k)) for k in LIST_ITEM_REQUIRED]
    tests += [_issue(have(k) == "", "min_length", "error", F.lit(k)) for k in ("region", "activity", "title")]
    tests += [_issue(have("date").isNotNull() & ~iso_day, "date_format", "error", F.lit("date"))]
    issues = F.array_compact(F.array(*tests)).cast(ISSUE)
    return items.select("id", F.explode(issues).alias("i")).select("i.check", "i.severity", "id", "i.detail")


def check_report_items(items: DataFrame) -> DataFrame:
    tests = [_issue(F.col(k).isNull(), "required", "error", F.lit(k)) for k in ("id", "content_markdown")]
    return (items.select("id", F.explode(F.array_compact(F.array(*tests)).cast(ISSUE)).alias("i"))
            .select("i.check", "i.severity", "id", "i.detail"))


def check_min_count(manifest: DataFrame, minimum: int) -> DataFrame:
    n = F.count(F.lit(1))
    return manifest.agg(n.alias("reports"), F.lit(minimum).cast("bigint").alias("expected_min"), (n >= minimum).alias("ok"))
