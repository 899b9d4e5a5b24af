"""The list of published reports: front matter, list rows, search, paging, lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnbook.constants import ACTIVITY, MANIFEST_ID, PAGE_SIZE, PEAK, REPORT_ID, SUMMARY_SECTION
from cairnbook.functions import jsons as J
from cairnbook.functions.blocks import first_index
from cairnbook.functions.html import first_of
from cairnbook.functions.strings import first_match, none_if_blank, strip
from cairnbook.operators.ranking import number_rows

SEARCHED = ("id", "title", "date_of_event", "peak", "activity", "summary")
_STATE = "struct<pairs:array<struct<key:string,value:string>>,key:string,buffer:array<string>>"
NO_PAIRS = "array<struct<key:string,value:string>>"


def _pair(key: Column, value: Column) -> Column:
    return F.array(F.struct(key.alias("key"), value.alias("value")))


def _unquoted(v: Column) -> Column:
    return F.regexp_replace(v, r"""(?s)^"(.*)"$|^'(.*)'$""", "$1$2")


def _flushed(s: Column) -> Column:
    """Pairs with the continuation lines gathered so far as the value of the open key."""
    waiting = s["key"].isNotNull() & (F.size(s["buffer"]) > 0)
    return F.when(waiting, F.concat(s["pairs"], _pair(s["key"], strip(F.array_join(s["buffer"], " "))))).otherwise(s["pairs"])


def _read_line(s: Column, line: Column) -> Column:
    none = F.array().cast("array<string>")
    indented = line.rlike(r"^[ \t]") & s["key"].isNotNull()
    colon = F.instr(line, ":")
    key = strip(F.substring(line, F.lit(1), colon - 1))
    value = _unquoted(strip(F.substring(line, colon + 1, F.length(line))))
    key_after = F.when(F.size(s["buffer"]) > 0, F.lit(None).cast("string")).otherwise(s["key"])
    state = lambda pairs, k, buffer: F.struct(pairs.alias("pairs"), k.alias("key"), buffer.alias("buffer")).cast(_STATE)
    return (F.when(indented, state(s["pairs"], s["key"], F.concat(s["buffer"], F.array(strip(line)))))
            .when(colon > 0, state(F.concat(_flushed(s), _pair(key, value)), key, none))
            .otherwise(state(_flushed(s), key_after, none)))


def parse_front_matter(reports: DataFrame) -> DataFrame:
    """Add ``pairs`` (key/value in order, null without front matter) and ``body``. Row by row, no shuffle.

    Lines, fences and pairs are columns of their own: each is found once, and later rules read it."""
    at, to = F.col("_at"), F.col("_to")
    fence = lambda l: strip(l) == "---"
    df = reports.withColumn("_lines", F.split("markdown", "\n", -1))
    df = df.withColumn("_fences", F.transform("_lines", fence)).withColumn("_at", F.array_position("_fences", F.lit(True)).cast("int"))
    after = F.array_position(F.slice("_fences", at + 1, F.greatest(F.size("_fences") - at, F.lit(0))), F.lit(True)).cast("int")
    df = _built_once(df.withColumn("_to", F.when(F.col("markdown").startswith("---") & (at > 0) & (after > 0), at + after)).drop("_fences"))
    useful = F.filter(F.slice("_lines", at + 1, to - at - 1), lambda l: (strip(l) != "") & ~strip(l).startswith("#"))
    zero = F.struct(F.array().cast(NO_PAIRS).alias("pairs"), F.lit(None).cast("string").alias("key"),
                    F.array().cast("array<string>").alias("buffer")).cast(_STATE)
    body = F.array_join(F.slice("_lines", to + 1, F.size("_lines") - to), "\n")
    df = (df.withColumn("pairs", F.when(to.isNotNull(), F.aggregate(useful, zero, _read_line, _flushed)))
          .withColumn("body", F.when(to.isNotNull(), body).otherwise(F.col("markdown"))))
    return _built_once(df.select(*reports.columns, "pairs", "body"))


def meta(pairs: Column, key: str) -> Column:
    """Value of a front matter key; the last one counts."""
    hits = F.filter(pairs, lambda p: p["key"] == key)
    return F.try_element_at(F.transform(hits, lambda p: p["value"]), F.lit(-1))


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _labelled(lines: Column, pattern: str) -> Column:
    return first_of(F.filter(F.transform(lines, lambda l: strip(first_match(l, pattern))), lambda v: v.isNotNull()))


def fallback_items(reports: DataFrame) -> DataFrame:
    """Minimal rows for reports that cannot be read: first useful line as title, labelled lines for the rest."""
    raw = strip(F.regexp_replace("markdown", "^﻿", ""))
    fenced = F.split(raw, "---", 3)
    text = F.when(raw.startswith("---") & (F.size(fenced) > 2), strip(F.try_element_at(fenced, F.lit(3)))).otherwise(raw)
    lines = F.transform(F.split(text, "\n", -1), strip)
    cleaned = F.transform(F.filter(lines, lambda l: ~l.startswith("---")),
                          lambda l: strip(F.regexp_replace(l, r"^#*\**-*", "")))
    title = first_of(F.filter(cleaned, lambda l: l != ""))
    blank = F.lit("")
    return reports.select(
        "id", F.coalesce(title, F.col("id")).alias("title"), F.coalesce(_labelled(lines, PEAK), blank).alias("peak"),
        blank.alias("date_of_event"), blank.alias("date"), F.coalesce(_labelled(lines, ACTIVITY), blank).alias("activity"))


def manifest_rows(reports: DataFrame) -> DataFrame:
    """List rows of readable reports (``id, markdown``)."""
    m = lambda k: _some(meta(F.col("pairs"), k))
    df = parse_front_matter(reports).withColumn("_lines", F.transform(F.split("body", "\n", -1), strip))
    heading = first_of(F.filter("_lines", lambda l: l.startswith("#")))
    df = df.withColumn("_heading", heading).withColumn("_lines", F.transform("_lines", lambda l: strip(F.regexp_replace(l, r"^[-*] ", ""))))
    date, lines = F.coalesce(m("date_of_event"), m("date"), F.lit("")), F.col("_lines")
    return df.select(
        "id",
        F.coalesce(m("title"), _some(strip(F.regexp_replace("_heading", "^#+", ""))), F.col("id")).alias("title"),
        F.coalesce(m("peak"), _labelled(lines, PEAK), F.lit("")).alias("peak"),
        date.alias("date_of_event"), date.alias("date"),
        F.coalesce(_labelled(lines, ACTIVITY), m("activity"), m("audience"), F.lit("")).alias("activity")).transform(_built_once)


def _built_once(rows: DataFrame) -> DataFrame:
    """The same rows behind a generator: a later filter sees finished columns instead of repeating their rules."""
    return rows.select(F.explode(F.array(F.struct(*rows.columns))).alias("r")).select("r.*")


def drop_empty(items: DataFrame) -> DataFrame:
    return items.where(F.coalesce(_some(F.col("title")), _some(F.col("activity")), _some(F.col("peak"))).isNotNull())


def build_manifest(reports: DataFrame) -> DataFrame:
    return drop_empty(manifest_rows(reports))


# --- viewer ----------------------------------------------------------------------------------

def _summary_bullets(body: Column) -> Column:
    lines = F.transform(F.split(F.regexp_extract(body, SUMMARY_SECTION, 1), "\n", -1), strip)
    return F.transform(F.filter(lines, lambda l: l.startswith("- ")), lambda l: F.regexp_replace(l, r"^-\s*", ""))


def _named(pairs: Column, key: str) -> Column:
    return none_if_blank(F.nullif(meta(pairs, key), F.lit("None")))


def viewer_fields(parsed: DataFrame) -> DataFrame:
    """``id, title, region, date, activity, summary`` as the reader sees them; input of ``parse_front_matter``."""
    body, pairs = F.col("body"), F.col("pairs")
    bullet = first_of(_summary_bullets(body))
    title = _named(pairs, "title")
    title = F.when(~title.rlike(r"^None\s+—\s+Incident"), title)
    heading = _some(strip(first_match(body, r"(?m)^#\s+(.+)$")))
    plain = F.regexp_replace(body, r"(?is)<script.*?</script>", "")
    paragraphs = F.filter(F.transform(F.split(plain, r"\n{2,}", -1), strip),
                          lambda p: (p != "") & ~p.startswith("#") & ~p.startswith("<") & ~p.rlike(r"^[-*]\s"))
    summary = F.coalesce(_named(pairs, "summary"), _some(strip(bullet)), first_of(paragraphs), F.lit(""))
    plain_meta = lambda k: F.coalesce(F.nullif(meta(pairs, k), F.lit("None")), F.lit(""))
    return parsed.select(
        "id", F.coalesce(title, heading, _some(F.substring(bullet, 1, 80)), F.col("id")).alias("title"),
        plain_meta("region").alias("region"),
        F.coalesce(F.nullif(meta(pairs, "date_of_event"), F.lit("None")), F.nullif(meta(pairs, "date"), F.lit("None")), F.lit("")).alias("date"),
        plain_meta("activity").alias("activity"),
        F.when(F.length(summary) > 240, F.concat(F.substring(summary, 1, 237), F.lit("..."))).otherwise(summary).alias("summary"))


def valid_manifest_ids(items: DataFrame) -> DataFrame:
    return items.where(F.col("id").rlike(MANIFEST_ID))


def is_report_id(c: Column) -> Column:
    return c.rlike(REPORT_ID) & ~c.contains(".")


def search(items: DataFrame, text: str | None) -> DataFrame:
    """Rows where a shown field contains the text, ignoring case; a blank text keeps all."""
    wanted = (text or "").strip().lower()
    if not wanted:
        return items
    hit = F.lit(False)
    for name in SEARCHED:
        if name in items.columns:
            hit = hit | F.coalesce(F.contains(F.lower(F.col(name).cast("string")), F.lit(wanted)), F.lit(False))
    return items.where(hit)


def page_bounds(items: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """``page, first_id``: where each page begins. Ids alone are range-partitioned; each range counts its rows and is shifted by
    the counts of those before it. Write it once to serve many pages."""
    numbered = number_rows(items.select("id"), ["id"], name="_n").where((F.col("_n") - 1) % size == 0)
    return numbered.select(((F.col("_n") - 1) / size + 1).cast("bigint").alias("page"), F.col("id").alias("first_id"))


def page(items: DataFrame, number: int, size: int = PAGE_SIZE, bounds: DataFrame | None = None) -> DataFrame:
    """One page in ``id`` order (ids are unique): the rows between two bounds, so a late page costs what the first does."""
    starts = (page_bounds(items, size) if bounds is None else bounds).where(F.col("page").isin(number, number + 1))
    begin = lambda n: F.max(F.when(F.col("page") == n, F.col("first_id")))
    ends = starts.agg(begin(number).alias("_from"), begin(number + 1).alias("_to"))  # one row
    met = items.join(F.broadcast(ends), (F.col("id") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("id") < F.col("_to"))))
    return met.select(*items.columns).orderBy("id").limit(size)


def page_count(items: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    n = F.count(F.lit(1))
    return items.agg(n.alias("items"), F.greatest(F.lit(1), F.ceil(n / size)).cast("bigint").alias("pages"))


def manifest_pages(items: DataFrame, size: int = PAGE_SIZE, version: int = 1) -> DataFrame:
    """The published envelope in pages: ``page, reports`` (JSON array of at most ``size`` items), ``count, version``.

    One JSON document of all reports would pass through one task; a page never holds more than ``size`` rows."""
    numbered = number_rows(valid_manifest_ids(items), ["id"], name="_n")
    paged = numbered.withColumn("page", F.floor((F.col("_n") - 1) / size) + 1)
    total = numbered.agg(F.count(F.lit(1)).alias("count"))  # one row, from the checkpointed slices: the items are not made again
    rows = F.transform(F.array_sort(F.collect_list(F.struct("_n", F.to_json(F.struct(*items.columns)).alias("j")))), lambda r: r["j"])
    pages = paged.groupBy("page").agg(J.array_text(rows).alias("reports"))
    return pages.join(F.broadcast(total)).withColumn("version", F.lit(version))


def report_by_id(reports: DataFrame, report_id: str) -> DataFrame:
    return reports.where((F.col("id") == report_id) & is_report_id(F.col("id")))
