"""Event reports in Markdown: inferred date, links, sections, front matter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cairnbook.constants import AGENCY_FIELDS, MONTHS, REGION_FIELDS, SOURCES_NOTE, SOURCES_SECTION, URL_IN_TEXT, WEEKDAYS
from cairnbook.functions.dates import checked_date, month_number
from cairnbook.functions.strings import first_match, none_if_blank, ordered_union, publisher_label, strip
from cairnbook.operators.ranking import number_rows
from cairnbook.session import ensure_checkpoint_dir

_MONTH = "(" + "|".join(m.capitalize() for m in MONTHS) + ")"
MONTH_DAY = rf"(?i){_MONTH}\s+([0-3]?\d)(?:,?\s+(\d{{4}}))?"
MONTH_YEAR = rf"(?i){_MONTH}\s+(\d{{4}})"
MONTH_ONLY = rf"(?i){_MONTH}"


def publication_day(raw: Column) -> Column:
    head = F.substring(raw, 1, 19)
    dashed = first_match(head, r"^(\d{4}-\d{1,2}-\d{1,2})(?:[T ]\d{1,2}:\d{1,2}:\d{1,2})?$")
    return F.coalesce(F.try_to_date(dashed, "yyyy-M-d"),
                      F.try_to_date(first_match(head, r"^(\d{4}/\d{1,2}/\d{1,2})$"), "yyyy/M/d"),
                      F.try_to_date(first_match(head, r"^(\d{1,2} [A-Za-z]{3} \d{4})$"), "d MMM yyyy"))


def infer_event_date(accident_date: Column, published: Column, text: Column) -> Column:
    """Best statement of the event's date, from explicit to unknown."""
    pub, low = publication_day(published), F.lower(text)
    weekday = F.coalesce(*[F.when(low.rlike(rf"(?U)\b{w}\b"), F.lit(w)) for w in WEEKDAYS])
    # The seven days ending on the publication day hold each weekday once.
    on_weekday = F.coalesce(*[F.when(weekday == w, F.next_day(F.date_sub(pub, 7), w[:3])) for w in WEEKDAYS])
    name, day, year = (F.regexp_extract(text, MONTH_DAY, i) for i in (1, 2, 3))
    month = month_number(name)
    this_year = checked_date(F.year(pub), month, day)
    guess = F.when(this_year > pub, checked_date(F.year(pub) - 1, month, day)).otherwise(this_year)
    lone = month_number(F.regexp_extract(text, MONTH_ONLY, 1))
    lone_start = checked_date(F.year(pub), lone, F.lit(1))
    lone_guess = F.when(lone_start > pub, checked_date(F.year(pub) - 1, lone, F.lit(1))).otherwise(lone_start)
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    day_known = F.concat(F.lit("Specific date known (month/day: "), name, F.lit(" "), day, F.lit(", year unknown)"))
    has_day = text.rlike(MONTH_DAY)
    return (
        F.when(none_if_blank(accident_date).isNotNull(), strip(accident_date))
        .when(pub.isNotNull() & weekday.isNotNull(),
              F.concat(F.date_format(on_weekday, "yyyy-MM-dd"), F.lit(" (approx, inferred from weekday reference)")))
        .when(has_day & (year != ""), F.concat(year, F.lit("-"), two(month), F.lit("-"), two(day.try_cast("int"))))
        .when(has_day & guess.isNotNull(), F.concat(F.date_format(guess, "yyyy-MM-dd"), F.lit(" (year inferred)")))
        .when(has_day, day_known)
        .when(text.rlike(MONTH_YEAR), F.concat(F.lit("Specific date known (month/year: "),
              F.regexp_extract(text, MONTH_YEAR, 1), F.lit(" "), F.regexp_extract(text, MONTH_YEAR, 2), F.lit(")")))
        .when(text.rlike(MONTH_ONLY) & pub.isNotNull(),
              F.concat(F.date_format(lone_guess, "yyyy-MM"), F.lit(" (month inferred)")))
        .otherwise(F.lit("Specific date unknown")))


def first_named(df: DataFrame, names: Sequence[str] = REGION_FIELDS, default: str = "") -> Column:
    """First non-blank of the given columns (missing ones are skipped), trimmed."""
    have = [none_if_blank(F.col(n)) for n in names if n in df.columns]
    return F.coalesce(*have, F.lit(default))


def extract_links(source_urls: Column, source_url: Column, sources: Column, text: Column) -> Column:
    web = lambda a: F.transform(F.filter(a, lambda u: u.startswith("http")), strip)
    in_text = F.transform(F.regexp_extract_all(text, F.lit(URL_IN_TEXT), F.lit(0)),
                          lambda u: F.regexp_replace(u, r"[).,]+$", ""))
    return ordered_union(web(source_urls), web(F.array_compact(F.array(strip(source_url)))), web(sources), in_text)


def agencies(df: DataFrame) -> Column:
    have = [F.filter(F.col(n), lambda a: a.isNotNull()) for n in AGENCY_FIELDS if n in df.columns]
    return ordered_union(*have)


def sources_block(links: Column, agency_names: Column) -> Column:
    """The Sources section; '' when there is neither a link nor an agency."""
    crew = F.concat(F.lit("Agencies: "), F.array_join(agency_names, "; "))
    listed = F.transform(links, lambda u: F.concat(F.lit("- "), publisher_label(u), F.lit(": "), u))
    lines = F.concat(F.array(F.lit("## Sources")), listed,
                     F.when(F.size(agency_names) > 0, F.array(crew)).otherwise(F.array().cast("array<string>")),
                     F.array(F.lit(SOURCES_NOTE)))
    return (F.when(F.size(links) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n")))
            .when(F.size(agency_names) > 0, F.concat(F.lit("## Sources\n"), crew, F.lit("\n")))
            .otherwise(F.lit("")))


def splice_sources(markdown: Column, block: Column) -> Column:
    """Replace the Sources section up to the next heading, or append the block."""
    literal = F.replace(F.replace(F.concat(strip(block), F.lit("\n")), F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    return (F.when(F.coalesce(block, F.lit("")) == "", markdown)
            .when(markdown.rlike(SOURCES_SECTION), F.regexp_replace(markdown, F.lit(SOURCES_SECTION), literal))
            .when(markdown.contains("## Sources") & F.contains(markdown, block), markdown)
            .otherwise(F.concat(markdown, F.lit("\n"), block)))


def short_title(region: Column, accident_type: Column) -> Column:
    return strip(F.concat_ws(" ", F.coalesce(F.nullif(region, F.lit("")), F.lit("Mountaineering")),
                             F.coalesce(F.nullif(accident_type, F.lit("")), F.lit("Incident"))))


def front_matter(pairs: Sequence[tuple[str, Column]]) -> Column:
    """``--- key: value ---`` header; nested values are passed as JSON text, null is written None."""
    lines = [F.concat(F.lit(f"{k}: "), F.coalesce(v.cast("string"), F.lit("None"))) for k, v in pairs]
    return F.concat_ws("\n", F.lit("---"), *lines, F.lit("---\n"))


def timeline(events: Column) -> Column:
    """Bullets from array<struct<ts_iso,approx_time,description,type>>."""
    pick = lambda *cs: F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], F.lit(""))
    line = lambda e: F.concat(F.lit("- "), pick(e["ts_iso"], e["approx_time"]), F.lit(" — "), pick(e["description"], e["type"]))
    return F.coalesce(F.array_join(F.transform(events, line), "\n"), F.lit(""))


def table(rows: Column) -> Column:
    """Pipe table from array<map<string,string>>; columns are the sorted keys of all rows."""
    keys = F.array_sort(F.array_distinct(F.flatten(F.transform(rows, F.map_keys))))
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    head = F.concat(line(keys), F.lit("\n|"), F.array_join(
        F.transform(keys, lambda k: F.lit("---|")), ""), F.lit("\n"))
    body = F.transform(rows, lambda r: line(F.transform(keys, lambda k: F.coalesce(F.try_element_at(r, k), F.lit("")))))
    return F.when(F.size(rows) > 0, F.concat(head, F.array_join(body, "\n"))).otherwise(F.lit(""))


def bullets(items: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(items, lambda i: F.concat(F.lit("- "), i)), "\n"), F.lit(""))


def json_ld(df: DataFrame) -> Column:
    col = lambda n: F.col(n) if n in df.columns else F.lit(None).cast("string")
    headline = F.concat(F.coalesce(col("mountain_name"), F.lit("Unknown")), F.lit(" — "),
                        F.coalesce(col("accident_type"), F.lit("Incident")), F.lit(" ("),
                        F.coalesce(col("accident_date"), F.lit("")), F.lit(")"))
    data = F.struct(
        F.lit("https://schema.org").alias("@context"), F.lit("Article").alias("@type"), headline.alias("headline"),
        F.coalesce(F.nullif(col("article_date_published"), F.lit("")), col("accident_date")).alias("datePublished"),
        F.array(col("activity_type"), col("region")).alias("about"), col("event_id").alias("identifier"))
    return F.concat(F.lit('<script type="application/ld+json">'), F.to_json(data, {"ignoreNullFields": "false"}),
                    F.lit("</script>\n"))


def targets(events: DataFrame, event_id: str | None = None) -> DataFrame:
    return events if event_id is None else events.where(F.col("event_id") == event_id)


def report_links(events: DataFrame, urls: DataFrame) -> DataFrame:
    """``event_id, link, place``: distinct links of each event with the place of the first use.

    ``urls`` is as ``fusion.source_urls`` gives it: addresses in fusion order. Then come the event's own
    ``source_url`` and the addresses in its ``article_text``. The first use is a partial aggregate."""
    place = lambda kind, s, o, pos: F.struct(F.lit(kind).alias("kind"), s.cast("double").alias("s"), o.alias("o"), pos.alias("pos"))
    record = F.col("record_id").cast("string")
    ordered = F.lpad(record, 20, "0") if dict(urls.dtypes)["record_id"] in ("int", "bigint") else record
    listed = urls.select("event_id", strip(F.col("source_url")).alias("link"), place(0, -F.col("score"), ordered, F.lit(0)).alias("place"))
    col = lambda n: F.col(n) if n in events.columns else F.lit(None).cast("string")
    empty = F.array().cast("array<string>")
    own = extract_links(empty, col("source_url"), empty, F.coalesce(col("article_text"), F.lit("")))
    more = events.select("event_id", F.posexplode(own).alias("pos", "link")).select("event_id", "link", place(1, F.lit(0.0), F.lit(""), F.col("pos")).alias("place"))
    return listed.unionByName(more).where(F.col("link").startswith("http")).groupBy("event_id", "link").agg(F.min("place").alias("place"))


def render_lines(events: DataFrame, links: DataFrame, steps: DataFrame | None = None, audience: str = "climbers") -> DataFrame:
    """``event_id, line_no, line``: reports in long form, for events with any number of links and steps.

    ``events`` is as for ``render_reports`` with one row per event; its ``source_urls`` and ``events`` are not
    looked at: links come from ``report_links``, steps as ``event_id``, a number or text ``at`` to sort by
    and ``ts_iso, approx_time, description, type``."""
    df = events
    for name in ("accident_type", "accident_date", "article_date_published", "article_text", "accident_summary_text", "num_fatalities"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    # One row per event from either side, so that the sections know whether they are there.
    df = df.join(links.groupBy("event_id").agg(F.count("*").alias("_links")), "event_id", "left")
    if steps is not None:
        df = df.join(steps.groupBy("event_id").agg(F.count("*").alias("_steps")), "event_id", "left")
    else:
        df = df.withColumn("_steps", F.lit(None).cast("long"))
    region, crew = first_named(df), agencies(df)
    title = short_title(region, F.col("accident_type"))
    date = infer_event_date(F.col("accident_date"), F.col("article_date_published"), F.coalesce("article_text", F.lit("")))
    header = front_matter([("title", title), ("date_of_event", date), ("region", region), ("audience", F.lit(audience)), ("event_id", F.col("event_id"))])
    section = lambda name, body: F.when(F.coalesce(body, F.lit("")) != "", F.concat(F.lit(f"## {name}\n"), body, F.lit("\n")))
    head = F.concat_ws("\n", header, F.concat(F.lit("# "), title, F.lit("\n")),
                       section("Executive Summary", F.when(F.col("accident_summary_text") != "", F.concat(F.lit("- "), F.col("accident_summary_text")))),
                       section("Location and Context", F.when(region != "", F.concat(F.lit("- Peak/Area: "), region))))
    outcome = section("Outcome", F.concat(F.lit("- Fatalities: "), F.col("num_fatalities").cast("string")))
    told, listed, crewed = F.col("_steps") > 0, F.coalesce("_links", F.lit(0)) > 0, F.size(crew) > 0
    agency_line = F.when(crewed, F.concat(F.lit("Agencies: "), F.array_join(crew, "; ")))
    tail = F.when(listed | crewed, F.concat_ws("\n", agency_line, F.when(listed, F.lit(SOURCES_NOTE)), F.lit("")))
    parts = {0: head, 1: F.when(told, F.lit("## Timeline of Events")), 3: F.when(told, F.lit("")), 4: outcome, 5: F.when(listed | crewed, F.lit("## Sources")), 7: tail}
    # A text is cut at its line breaks; the break after its last line gives the empty line between sections.
    blocks = F.array_compact(F.array(*(F.when(text.isNotNull(), F.struct(F.lit(part).alias("part"), F.split(text, "\n").alias("lines"))) for part, text in parts.items())))
    none = {"s": "double", "o": "string", "q": "int"}
    rows = df.select("event_id", F.explode(blocks).alias("b")).select("event_id", "b.part", F.posexplode("b.lines").alias("pos", "line"), *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
    label = F.concat(F.lit("- "), publisher_label(F.col("link")), F.lit(": "), F.col("link"))
    every = rows.unionByName(links.select("event_id", F.lit(6).alias("part"), F.col("place.kind").alias("pos"), label.alias("line"),
                                          F.col("place.s").alias("s"), F.col("place.o").alias("o"), F.col("place.pos").alias("q")))
    if steps is not None:
        pick = lambda *cs: F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in cs), F.lit(""))
        at = F.lpad(F.col("at").cast("string"), 20, "0") if dict(steps.dtypes)["at"] in ("int", "bigint") else F.col("at").cast("string")
        text = F.concat(F.lit("- "), pick("ts_iso", "approx_time"), F.lit(" — "), pick("description", "type"))
        every = every.unionByName(steps.select("event_id", F.lit(2).alias("part"), F.lit(0).alias("pos"), text.alias("line"), F.lit(None).cast("double").alias("s"), at.alias("o"), F.lit(None).cast("int").alias("q")))
    ensure_checkpoint_dir(df.sparkSession)
    # Held once: the range partitions of the numbering read their input twice.
    return number_rows(every.checkpoint(), ["part", "pos", "s", "o", "q", "line"], by=["event_id"], name="line_no").select("event_id", "line_no", "line")


def render_reports(events: DataFrame, audience: str = "climbers") -> DataFrame:
    """``event_id, markdown`` from event rows.

    Expects ``event_id, source_urls`` and uses, where present, ``mountain_name, accident_type,
    accident_date, article_date_published, article_text, accident_summary_text, num_fatalities,
    events`` and the agency lists. Prose is limited to the data the event carries."""
    df = events
    for name in ("accident_type", "accident_date", "article_date_published", "article_text", "accident_summary_text", "source_url"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    text = F.coalesce("article_text", F.lit(""))
    region = first_named(df)
    links = extract_links(F.col("source_urls"), F.col("source_url"), F.array().cast("array<string>"), text)
    df = (df.withColumn("_region", region)
          .withColumn("_title", short_title(F.col("_region"), F.col("accident_type")))
          .withColumn("_date", infer_event_date(F.col("accident_date"), F.col("article_date_published"), text))
          .withColumn("_block", sources_block(links, agencies(df))))
    header = front_matter([("title", F.col("_title")), ("date_of_event", F.col("_date")), ("region", F.col("_region")),
                           ("audience", F.lit(audience)), ("event_id", F.col("event_id"))])
    section = lambda title, body: F.when(F.coalesce(body, F.lit("")) != "", F.concat(F.lit(f"## {title}\n"), body, F.lit("\n")))
    outcome = (F.when(F.col("num_fatalities").isNotNull(), F.concat(F.lit("- Fatalities: "), F.col("num_fatalities").cast("string")))
               if "num_fatalities" in df.columns else F.lit(None).cast("string"))
    line = timeline(F.col("events")) if dict(df.dtypes).get("events", "").startswith("array<struct") else F.lit("")
    draft = F.concat_ws(
        "\n", F.concat(F.lit("# "), F.col("_title"), F.lit("\n")),
        section("Executive Summary", F.when(F.col("accident_summary_text") != "", F.concat(F.lit("- "), F.col("accident_summary_text")))),
        section("Location and Context", F.when(F.col("_region") != "", F.concat(F.lit("- Peak/Area: "), F.col("_region")))),
        section("Timeline of Events", line), section("Outcome", outcome))
    return df.select("event_id", splice_sources(F.concat(header, F.lit("\n"), draft), F.col("_block")).alias("markdown"))
