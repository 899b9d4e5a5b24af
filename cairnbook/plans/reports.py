"""Image, report, manifest and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnbook import constants as C
from cairnbook.operators import images as I, manifest as M, pages as P, quality as Q, reports as R
from cairnbook.plans.bridges import bridge, with_bridges
from cairnbook.plans.events import assigned, events_sql
from cairnbook.plans.registry import query, table
from cairnbook.plans.text import LANDING


def img(spark, sf_dir):
    return bridge(spark, sf_dir, "bridge_images")


def img_sql(body: str, **extra: str) -> str:
    return with_bridges(body, "bridge_images", **extra)


_tokens = "|".join(C.STRAY_HOST_TOKENS + C.IRRELEVANT_IMAGE_TOKENS).replace(".", r"\.")
STRAY = f"(starts_with(image_url, 'data:image') OR regexp_matches(lower(image_url), '{_tokens}'))"
SCORE = (f"CASE WHEN trim(regexp_replace(caption_raw, '\\s+', ' ', 'g')) <> '' THEN 5 + CASE WHEN regexp_matches(caption_raw, '(?i){'|'.join(C.RELEVANT_CAPTION_WORDS)}') THEN 10 ELSE 0 END ELSE 0 END"
         f" + CASE WHEN regexp_matches(image_url, '(?i){C.UPLOAD_PATH}') THEN 5 ELSE 0 END + CASE WHEN regexp_matches(image_url, '(?i){C.IMAGE_EXTENSION}') THEN 5 ELSE 0 END")

# --- I: images -------------------------------------------------------------------------------------------

PICTURES = """
SELECT page_id, url, concat(html, '<figure><img src="/media/f', cast(page_id AS string), '.jpg"><figcaption>Rescue on the ridge ', cast(page_id AS string),
  '</figcaption></figure><div><img data-src="b.png" alt="A cliff"></div><p>A paragraph after the block</p><img srcset="s1.webp 300w, s2.webp 600w" alt="Snow field">',
  '<img src="/img/site-logo.png" alt="x"><meta property="og:image" content="https://cdn.example.net/media/og.jpg">',
  '<div style="background: url(''/media/bg.jpg'')"></div><script>var u = "https://x.example/wp-content/uploads/z.gif";</script>') AS html FROM pages"""


def pictures(spark, sf_dir):
    table(spark, sf_dir, "pages").createOrReplaceTempView("cairnbook_pages")
    return spark.sql(PICTURES.replace("FROM pages", "FROM cairnbook_pages"))


@query("image_candidates", """
WITH base AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS origin, regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') AS folder FROM pages)
SELECT page_id, 0 AS pos, origin || '/media/f' || page_id || '.jpg' AS image_url FROM base
UNION ALL SELECT page_id, 1, folder || 'b.png' FROM base UNION ALL SELECT page_id, 2, folder || 's2.webp' FROM base
UNION ALL SELECT page_id, 3, origin || '/img/site-logo.png' FROM base UNION ALL SELECT page_id, 4, 'https://cdn.example.net/media/og.jpg' FROM base
UNION ALL SELECT page_id, 5, origin || '/media/bg.jpg' FROM base UNION ALL SELECT page_id, 6, 'https://x.example/wp-content/uploads/z.gif' FROM base""")
def image_candidates(spark, sf_dir):
    found = I.candidate_urls(P.with_elements(pictures(spark, sf_dir)))
    return found.select("page_id", F.posexplode("candidates").alias("pos", "image_url"))


@query("attach_captions", f"""
WITH base AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS origin, regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') AS folder FROM pages),
found AS (SELECT page_id, origin || '/media/f' || page_id || '.jpg' AS image_url, 'Rescue on the ridge ' || page_id AS caption_clean FROM base
UNION ALL SELECT page_id, folder || 'b.png', cast(NULL AS varchar) FROM base UNION ALL SELECT page_id, folder || 's2.webp', NULL FROM base
UNION ALL SELECT page_id, 'https://cdn.example.net/media/og.jpg', NULL FROM base UNION ALL SELECT page_id, origin || '/media/bg.jpg', NULL FROM base)
SELECT * FROM found WHERE NOT {STRAY}""")
def attach_captions(spark, sf_dir):
    return I.captions(P.with_elements(pictures(spark, sf_dir))).select("page_id", "image_url", "caption_clean")


@query("page_captions", f"""
WITH base AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS origin, regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') AS folder FROM pages WHERE page_id % 9 NOT BETWEEN 1 AND 6),
found AS (SELECT page_id, origin || '/media/f' || page_id || '.jpg' AS image_url, 'Rescue on the ridge ' || page_id AS caption_raw FROM base
UNION ALL SELECT page_id, folder || 'b.png', cast(NULL AS varchar) FROM base UNION ALL SELECT page_id, folder || 's2.webp', NULL FROM base
UNION ALL SELECT page_id, 'https://cdn.example.net/media/og.jpg', NULL FROM base UNION ALL SELECT page_id, origin || '/media/bg.jpg', NULL FROM base)
SELECT page_id, image_url, caption_raw, caption_raw AS caption_clean, 'html' AS method, ({SCORE})::int AS score FROM found WHERE NOT {STRAY} AND ({SCORE}) >= 5""")
def page_captions(spark, sf_dir):
    """Pages with pictures, two thirds of them landing pages, which are skipped."""
    table(spark, sf_dir, "pages").createOrReplaceTempView("cairnbook_pages")
    pages = spark.sql(PICTURES.replace("FROM pages", f"FROM ({LANDING.replace('FROM pages', 'FROM cairnbook_pages')})"))
    found = I.score_images(I.captions(P.with_elements(pages)))
    return found.select("page_id", "image_url", "caption_raw", "caption_clean", "method", F.col("score").cast("int").alias("score"))


@query("srcset_last", "SELECT p_partkey AS id, 'b' || p_size || '.jpg' AS src FROM part")
def srcset_last(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    srcset = F.concat(F.lit(" a.jpg 1x , b"), p.p_size.cast("string"), F.lit(".jpg  2x, "))
    return p.select(F.col("p_partkey").alias("id"), I.srcset_last(srcset).alias("src"))


@query("image_src", """
SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 's.jpg' WHEN p_size % 3 = 0 THEN 'd.jpg' WHEN p_size % 5 = 0 THEN 'z.jpg' ELSE 'pic.jpg' END AS src FROM part""")
def image_src(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    n = p.p_size
    src = I.image_source(F.when(n % 2 == 0, "s.jpg").otherwise(""), F.when(n % 3 == 0, "d.jpg"), F.lit("logo.jpg"), F.lit(None).cast("string"),
                         F.when(n % 5 == 0, "a.jpg 1x, z.jpg 2x"), F.array(F.lit("pic.jpg")))
    return p.select(F.col("p_partkey").alias("id"), src.alias("src"))


@query("stray_images", img_sql(f"SELECT page_id, pos, {STRAY} AS stray FROM bridge_images"))
def stray_images(spark, sf_dir):
    return img(spark, sf_dir).select("page_id", "pos", I.is_stray(F.col("image_url")).alias("stray"))


@query("clean_caption", img_sql(r"""
SELECT page_id, pos, trim(regexp_replace(regexp_replace(caption_raw, '\|\s*Image:[^\n]*$', ''), '\s+', ' ', 'g')) AS caption FROM bridge_images"""))
def clean_caption(spark, sf_dir):
    return img(spark, sf_dir).select("page_id", "pos", I.clean_caption(F.col("caption_raw")).alias("caption"))


@query("dedupe_images", img_sql("SELECT page_id, image_url, min(pos) AS pos FROM bridge_images GROUP BY 1, 2"))
def dedupe_images(spark, sf_dir):
    return I.distinct_images(img(spark, sf_dir)).select("page_id", "image_url", "pos")


@query("image_relevance", img_sql(f"SELECT page_id, pos, score FROM (SELECT *, cast({SCORE} AS int) AS score FROM bridge_images WHERE NOT {STRAY}) WHERE score >= 5"))
def image_relevance(spark, sf_dir):
    return I.score_images(img(spark, sf_dir)).select("page_id", "pos", "score")


@query("image_eligible", img_sql(f"""
SELECT page_id, pos FROM bridge_images WHERE starts_with(content_type, 'image') AND coalesce(content_length >= {C.MIN_IMAGE_BYTES}, true)
  AND (replace(split_part(image_url, '/', 3), 'www.', '') = replace(split_part(page_url, '/', 3), 'www.', '') OR regexp_matches(image_url, '(?i){C.UPLOAD_PATH}')
    OR trim(regexp_replace(coalesce(caption_raw, ''), '\\s+', ' ', 'g')) <> '')"""))
def image_eligible(spark, sf_dir):
    return I.eligible(img(spark, sf_dir)).select("page_id", "pos")


@query("image_min_size", img_sql("SELECT page_id, pos FROM bridge_images WHERE width >= 300 AND height >= 200"))
def image_min_size(spark, sf_dir):
    return I.large_enough(img(spark, sf_dir)).select("page_id", "pos")


@query("enrich_captions", img_sql("""
SELECT i.page_id, i.pos, p.p_name AS summary FROM bridge_images i
LEFT JOIN part p ON i.content_type IS NOT NULL AND p.p_partkey = i.pos % 100000"""))
def enrich_captions(spark, sf_dir):
    rows = img(spark, sf_dir).withColumn("local_image_path", F.when(F.col("content_type").isNotNull(), F.col("pos") % 100000))
    analysis = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("local_image_path"), F.col("p_name").alias("summary"))
    return I.enrich(rows, analysis).select("page_id", "pos", "summary")


@query("latest_run", "SELECT event_type AS domain, max(strftime(ts, '%Y%m%d_%H%M%S')) AS run_ts FROM events GROUP BY 1")
def latest_run(spark, sf_dir):
    return I.latest_runs(table(spark, sf_dir, "events").select(
        F.col("event_type").alias("domain"), F.date_format("ts", "yyyyMMdd_HHmmss").alias("run_ts")))


@query("image_cap", img_sql("""
SELECT page_id, pos, image_url FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos, image_url) AS rn FROM bridge_images) WHERE rn <= 3"""))
def image_cap(spark, sf_dir):
    return I.first_per_page(img(spark, sf_dir), 3).select("page_id", "pos", "image_url")


# --- J: reports ----------------------------------------------------------------------------------------------

STORIES = """
SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_partkey % 13 = 0 THEN ' 2024-02-02 ' ELSE '' END AS accident_date,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE substring(cast(l_shipdate AS string), 1, 10) END AS published,
  CASE l_partkey % 6 WHEN 0 THEN concat('It happened on ', CASE l_suppkey % 2 WHEN 0 THEN 'Tuesday' ELSE 'SUNDAY' END, ' night')
    WHEN 1 THEN concat('On July ', cast(l_partkey % 28 + 1 AS string), ', 2023 they fell') WHEN 2 THEN concat('On august ', cast(l_partkey % 28 + 1 AS string), ' they fell')
    WHEN 3 THEN 'Sometime in November they left' WHEN 4 THEN 'No hint at all' ELSE 'A Mondayish time' END AS story FROM lineitem"""
_next = "cast(published AS date) - cast((isodow(cast(published AS date)) - {n} + 7) % 7 AS int)"
_aug = "CASE WHEN make_date(year(pub), 8, d) > pub THEN make_date(year(pub) - 1, 8, d) ELSE make_date(year(pub), 8, d) END"


def stories(spark, sf_dir):
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("cairnbook_lineitem")
    return spark.sql(STORIES.replace("FROM lineitem", "FROM cairnbook_lineitem"))


@query("infer_event_date", f"""
SELECT id, accident_date, published, story, CASE WHEN trim(accident_date) <> '' THEN trim(accident_date)
  WHEN pub IS NOT NULL AND regexp_matches(story, 'Tuesday') THEN strftime({_next.format(n=2)}, '%Y-%m-%d') || ' (approx, inferred from weekday reference)'
  WHEN pub IS NOT NULL AND regexp_matches(story, 'SUNDAY') THEN strftime({_next.format(n=7)}, '%Y-%m-%d') || ' (approx, inferred from weekday reference)'
  WHEN contains(story, 'July') THEN '2023-07-' || lpad(cast(d AS varchar), 2, '0')
  WHEN contains(story, 'august') THEN CASE WHEN pub IS NULL THEN 'Specific date known (month/day: august ' || d || ', year unknown)' ELSE strftime({_aug}, '%Y-%m-%d') || ' (year inferred)' END
  WHEN contains(story, 'November') AND pub IS NOT NULL THEN strftime(CASE WHEN make_date(year(pub), 11, 1) > pub THEN make_date(year(pub) - 1, 11, 1) ELSE make_date(year(pub), 11, 1) END, '%Y-%m') || ' (month inferred)'
  ELSE 'Specific date unknown' END AS event_date
FROM (SELECT *, cast(published AS date) AS pub, coalesce(try_cast(regexp_extract(story, '(?:July|august) (\\d+)', 1) AS int), 1) AS d FROM ({STORIES}))""")
def infer_event_date(spark, sf_dir):
    return stories(spark, sf_dir).withColumn("event_date", R.infer_event_date(F.col("accident_date"), F.col("published"), F.col("story")))


@query("infer_region", with_bridges("SELECT record_id, coalesce(trim(mountain_name), source_url) AS region FROM bridge_artifacts", "bridge_artifacts"))
def infer_region(spark, sf_dir):
    df = bridge(spark, sf_dir, "bridge_artifacts").withColumn("peak", F.lit("  ")).withColumn("region", F.col("source_url"))
    return df.select("record_id", R.first_named(df).alias("region"))


LINKS = "SELECT doc_id, 'https://a.example/' || doc_id % 3 || '|http://b.example|https://www.gripped.com/n/' || c % 50 AS links FROM bridge_articles JOIN (SELECT o_orderkey AS doc_id, o_custkey AS c FROM orders) USING (doc_id)"


def linked(spark, sf_dir):
    df = bridge(spark, sf_dir, "bridge_articles")
    own = F.concat(F.lit("https://a.example/"), (F.col("doc_id") % 3).cast("string"))
    links = R.extract_links(F.array(own, F.lit("ftp://x"), own), F.lit(" http://b.example "), F.array(F.lit("http://b.example")), F.col("text"))
    return df.select("doc_id", links.alias("links"))


@query("extract_links", with_bridges(LINKS, "bridge_articles"))
def extract_links(spark, sf_dir):
    return linked(spark, sf_dir).select("doc_id", F.array_join("links", "|").alias("links"))


def crews(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    name = F.concat(F.lit("SAR "), (F.col("s_suppkey") % 4).cast("string"))
    return s.select("s_suppkey", F.array(F.lit("RCMP"), name).alias("response_agencies"),
                    F.when(F.col("s_suppkey") % 2 == 0, F.array(F.lit("RCMP"), F.lit("EMS"))).alias("rescue_teams_involved"))


@query("agencies", "SELECT s_suppkey, 'RCMP|SAR ' || s_suppkey % 4 || CASE WHEN s_suppkey % 2 = 0 THEN '|EMS' ELSE '' END AS agencies FROM supplier")
def agencies(spark, sf_dir):
    df = crews(spark, sf_dir)
    return df.select("s_suppkey", F.array_join(R.agencies(df), "|").alias("agencies"))


NOTE = R.SOURCES_NOTE


@query("sources_block", f"""
SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE '## Sources' || chr(10) END || CASE WHEN s_suppkey % 5 = 0 THEN ''
  WHEN s_suppkey % 3 = 0 THEN 'Agencies: RCMP; SAR ' || s_suppkey % 4 || CASE WHEN s_suppkey % 2 = 0 THEN '; EMS' ELSE '' END || chr(10)
  ELSE '- Gripped: https://www.gripped.com/' || s_suppkey || chr(10) || 'Agencies: RCMP; SAR ' || s_suppkey % 4 || CASE WHEN s_suppkey % 2 = 0 THEN '; EMS' ELSE '' END || chr(10) || '{NOTE}' || chr(10) END AS block FROM supplier""")
def sources_block(spark, sf_dir):
    df = crews(spark, sf_dir)
    k = F.col("s_suppkey")
    none = F.array().cast("array<string>")
    links = F.when(k % 3 == 0, none).otherwise(F.array(F.concat(F.lit("https://www.gripped.com/"), k.cast("string"))))
    return df.select("s_suppkey", R.sources_block(F.when(k % 5 == 0, none).otherwise(links),
                                                  F.when(k % 5 == 0, none).otherwise(R.agencies(df))).alias("block"))


def reports(spark, sf_dir):
    return bridge(spark, sf_dir, "bridge_reports")


def rep_sql(body: str, **extra: str) -> str:
    return with_bridges(body, "bridge_reports", **extra)


@query("splice_sources", rep_sql("""
SELECT id, CASE WHEN contains(markdown, '## Sources') THEN replace(markdown, '## Sources' || chr(10) || '- old: http://old.example/x' || chr(10), '## Sources' || chr(10) || '- new: $1' || chr(10))
  ELSE markdown || chr(10) || '## Sources' || chr(10) || '- new: $1' || chr(10) END AS markdown FROM bridge_reports"""))
def splice_sources(spark, sf_dir):
    return reports(spark, sf_dir).select("id", R.splice_sources(F.col("markdown"), F.lit("## Sources\n- new: $1\n")).alias("markdown"))


@query("short_title", "SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE 'Mountaineering' END || ' ' || CASE WHEN p_size % 3 = 0 THEN 'fall' ELSE 'Incident' END AS title FROM part")
def short_title(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), R.short_title(F.when(p.p_size % 2 == 0, p.p_brand).otherwise(""),
                                                                  F.when(p.p_size % 3 == 0, "fall")).alias("title"))


@query("front_matter", "SELECT p_partkey AS id, '---' || chr(10) || 'title: ' || p_name || chr(10) || 'tags: [\"' || p_brand || '\"]' || chr(10) || 'region: None' || chr(10) || '---' || chr(10) AS header FROM part")
def front_matter(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), R.front_matter([
        ("title", F.col("p_name")), ("tags", F.to_json(F.array("p_brand"))), ("region", F.lit(None).cast("string"))]).alias("header"))


@query("render_timeline", "SELECT p_partkey AS id, '- 06:00 — ' || p_name || chr(10) || '- dawn — ' || p_type AS timeline FROM part")
def render_timeline(spark, sf_dir):
    event = lambda ts, approx, text, kind: F.struct(ts.alias("ts_iso"), approx.alias("approx_time"), text.alias("description"), kind.alias("type"))
    none = F.lit(None).cast("string")
    steps = F.array(event(F.lit("06:00"), none, F.col("p_name"), F.lit("x")), event(F.lit(""), F.lit("dawn"), none, F.col("p_type")))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), R.timeline(steps).alias("timeline"))


@query("render_table", "SELECT p_partkey AS id, '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| ' || p_name || ' |  |' || chr(10) || '|  | ' || p_brand || ' |' AS tbl FROM part")
def render_table(spark, sf_dir):
    rows = F.array(F.create_map(F.lit("a"), F.col("p_name")), F.create_map(F.lit("b"), F.col("p_brand")))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), R.table(rows).alias("tbl"))


@query("render_bullets", "SELECT p_partkey AS id, '- ' || p_name || chr(10) || '- ' || p_brand AS bullets FROM part")
def render_bullets(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), R.bullets(F.array("p_name", "p_brand")).alias("bullets"))


@query("json_ld", with_bridges("""
SELECT record_id, coalesce(mountain_name, 'Unknown') || ' — Incident (' || coalesce(accident_date, '') || ')' AS headline,
  coalesce(article_date_published, accident_date) AS published FROM bridge_artifacts""", "bridge_artifacts"))
def json_ld(spark, sf_dir):
    df = bridge(spark, sf_dir, "bridge_artifacts")
    script = df.select("record_id", F.regexp_extract(R.json_ld(df), r"<script[^>]*>(.*)</script>\n", 1).alias("j"))
    return script.select("record_id", F.get_json_object("j", "$.headline").alias("headline"), F.get_json_object("j", "$.datePublished").alias("published"))


def report_lines(spark, sf_dir):
    """Reports of all events, with the timeline that the dated records of an event make."""
    from cairnbook.operators import fusion as U
    df = assigned(spark, sf_dir)
    events = U.fused_scalars(df, F.max("num_fatalities").alias("num_fatalities"))
    steps = df.where("record_id % 4 = 1").select("event_id", F.col("record_id").alias("at"), F.col("accident_date").alias("ts_iso"), F.lit("undated").alias("approx_time"),
                                                 F.lit("").alias("description"), F.col("article_title").alias("type"))
    return R.render_lines(events, R.report_links(events, U.source_urls(df)), steps)


REPORT_LINES = {
    "heads": """SELECT event_id, arg_min(mountain_name, pos) FILTER (mountain_name <> '') AS region, min(accident_date) AS day, max(num_fatalities) AS dead,
  arg_min(accident_summary_text, pos - length(accident_summary_text) * 1000000) FILTER (accident_summary_text <> '') AS summary FROM ranked GROUP BY 1""",
    "links": "SELECT event_id, source_url, min(pos) AS pos FROM ranked GROUP BY 1, 2",
    "steps": "SELECT event_id, record_id, '- ' || coalesce(accident_date, 'undated') || ' — ' || article_title AS line FROM ranked WHERE record_id % 4 = 1",
    "parts": """SELECT event_id, 0 AS part, 0 AS pos, '---' || chr(10) || 'title: ' || coalesce(region, 'Mountaineering') || ' Incident' || chr(10) || 'date_of_event: ' || coalesce(day, 'Specific date unknown')
    || chr(10) || 'region: ' || coalesce(region, '') || chr(10) || 'audience: climbers' || chr(10) || 'event_id: ' || event_id || chr(10) || '---' || chr(10) || chr(10)
    || '# ' || coalesce(region, 'Mountaineering') || ' Incident' || chr(10)
    || coalesce(chr(10) || '## Executive Summary' || chr(10) || '- ' || trim(summary, chr(10)) || chr(10), '') || coalesce(chr(10) || '## Location and Context' || chr(10) || '- Peak/Area: ' || region || chr(10), '') AS txt FROM heads
  UNION ALL SELECT event_id, 1, 0, '## Timeline of Events' FROM steps GROUP BY 1
  UNION ALL SELECT event_id, 2, record_id, line FROM steps
  UNION ALL SELECT event_id, 3, 0, '' FROM steps GROUP BY 1
  UNION ALL SELECT event_id, 4, 0, '## Outcome' || chr(10) || '- Fatalities: ' || dead || chr(10) FROM heads WHERE dead IS NOT NULL
  UNION ALL SELECT event_id, 5, 0, '## Sources' FROM links GROUP BY 1
  UNION ALL SELECT event_id, 6, pos, '- ' || regexp_extract(source_url, '^https://www[.]([^/]+)', 1) || ': ' || source_url FROM links
  UNION ALL SELECT event_id, 7, 0, '(All original source URLs listed above; labels inferred from domains.)' || chr(10) FROM links GROUP BY 1""",
    "cut": "SELECT event_id, part, pos, string_split(txt, chr(10)) AS lines FROM parts",
    "report_lines": """SELECT event_id, row_number() OVER (PARTITION BY event_id ORDER BY part, pos, i) AS line_no, lines[i] AS line
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM cut)""",
}


@query("render_report", events_sql("SELECT * FROM report_lines", **REPORT_LINES))
def render_report(spark, sf_dir):
    """Every line of the reports of all events; links and steps of an event may be of any number."""
    return report_lines(spark, sf_dir)


@query("report_targets", events_sql("SELECT DISTINCT event_id FROM assigned WHERE event_id = substring(md5('Mount 4|2024-01-05'), 1, 12)"))
def report_targets(spark, sf_dir):
    ids = assigned(spark, sf_dir).select("event_id").distinct()
    from hashlib import md5
    return R.targets(ids, md5(b"Mount 4|2024-01-05").hexdigest()[:12])


# --- J: manifest ------------------------------------------------------------------------------------------------

FM = r"""SELECT *, starts_with(markdown, '---') AS has,
  CASE WHEN starts_with(markdown, '---') THEN regexp_extract(markdown, '(?s)^---\n(.*?)\n---\n', 1) ELSE '' END AS block,
  regexp_replace(markdown, '(?s)^---\n.*?\n---\n', '') AS body FROM bridge_reports"""
field = lambda k: f"trim(regexp_extract(block, '(?m)^{k}:[ ]*([^\\n]*)$', 1), '\"')"
DATE = field("date_of_event")
ROWS = f"""SELECT id, coalesce(nullif({field('title')}, ''), trim(regexp_extract(body, '(?m)^#\\s+(.*)$', 1))) AS title,
  trim(regexp_extract(body, '(?m)^- Peak/Area: (.*)$', 1)) AS peak, {DATE} AS date_of_event, {DATE} AS date,
  coalesce(nullif(trim(regexp_extract(body, '(?m)^\\* Activity/Style - (.*)$', 1)), ''), {field('audience')}) AS activity FROM fm"""


@query("parse_front_matter", rep_sql(f"""
SELECT id, nullif({field('title')}, '') AS title, CASE WHEN has THEN 'climbers' END AS audience, nullif({field('event_id')}, '') AS event_id, md5(body) AS body FROM fm""", fm=FM))
def parse_front_matter(spark, sf_dir):
    df = M.parse_front_matter(reports(spark, sf_dir))
    get = lambda k: M.meta(F.col("pairs"), k)
    return df.select("id", get("title").alias("title"), get("audience").alias("audience"), get("event_id").alias("event_id"), F.md5("body").alias("body"))


@query("manifest_rows", rep_sql("SELECT * FROM mrows", fm=FM, mrows=ROWS))
def manifest_rows(spark, sf_dir):
    return M.manifest_rows(reports(spark, sf_dir))


@query("manifest_fallback", rep_sql(r"""
SELECT id, trim(regexp_extract(body, '(?m)^#\s+(.*)$', 1)) AS title, '' AS peak, '' AS activity FROM fm""", fm=FM))
def manifest_fallback(spark, sf_dir):
    return M.fallback_items(reports(spark, sf_dir)).select("id", "title", "peak", "activity")


@query("manifest_filter", """
SELECT p_partkey AS id FROM part WHERE p_size % 2 = 0 OR p_size % 3 = 0 OR p_size % 5 = 0""")
def manifest_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    some = lambda n: F.when(p.p_size % n == 0, "x").otherwise("")
    return M.drop_empty(p.select(F.col("p_partkey").alias("id"), some(2).alias("title"), some(3).alias("activity"), some(5).alias("peak"))).select("id")


@query("viewer_title", rep_sql(f"SELECT id, coalesce(nullif({field('title')}, ''), trim(regexp_extract(body, '(?m)^#\\s+(.*)$', 1))) AS title FROM fm", fm=FM))
def viewer_title(spark, sf_dir):
    return M.viewer_fields(M.parse_front_matter(reports(spark, sf_dir))).select("id", "title")


@query("viewer_summary", rep_sql(r"SELECT id, trim(regexp_extract(body, '(?m)^- (A .* reported\.)$', 1)) AS summary FROM fm", fm=FM))
def viewer_summary(spark, sf_dir):
    return M.viewer_fields(M.parse_front_matter(reports(spark, sf_dir))).select("id", "summary")


@query("valid_ids", rep_sql("SELECT id, regexp_matches(id, '(?i)^[a-z0-9]{4,}$') AS is_report FROM bridge_reports WHERE regexp_matches(id, '(?i)^[a-f0-9]{6,}$')"))
def valid_ids(spark, sf_dir):
    return M.valid_manifest_ids(reports(spark, sf_dir)).select("id", M.is_report_id(F.col("id")).alias("is_report"))


@query("manifest_envelope", rep_sql("""
SELECT page, count(*) AS n_items, max(total) AS count, 1 AS version, min(id) AS first_id FROM (
  SELECT id, cast(ceil(row_number() OVER (ORDER BY id) / 20) AS bigint) AS page, count(*) OVER () AS total FROM mrows WHERE regexp_matches(id, '^[a-f0-9]{6,}$')) GROUP BY 1""", fm=FM, mrows=ROWS))
def manifest_envelope(spark, sf_dir):
    pages = M.manifest_pages(M.manifest_rows(reports(spark, sf_dir)))
    return pages.select("page", F.json_array_length("reports").cast("bigint").alias("n_items"), "count", "version",
                        F.get_json_object("reports", "$[0].id").alias("first_id"))


@query("search_manifest", rep_sql("""
SELECT * FROM mrows WHERE contains(lower(concat_ws(chr(1), id, title, date_of_event, peak, activity)), 'red')""", fm=FM, mrows=ROWS))
def search_manifest(spark, sf_dir):
    return M.search(M.manifest_rows(reports(spark, sf_dir)), "  RED ")


@query("paginate", rep_sql("SELECT id, title FROM mrows ORDER BY id LIMIT 20 OFFSET 40", fm=FM, mrows=ROWS))
def paginate(spark, sf_dir):
    return M.page(M.manifest_rows(reports(spark, sf_dir)), 3).select("id", "title")


@query("page_count", rep_sql("SELECT count(*) AS items, greatest(1, ceil(count(*) / 20))::bigint AS pages FROM bridge_reports"))
def page_count(spark, sf_dir):
    return M.page_count(reports(spark, sf_dir))


@query("report_by_id", rep_sql("SELECT id, md5(markdown) AS body FROM bridge_reports WHERE id = substring(md5('15'), 1, 12)"))
def report_by_id(spark, sf_dir):
    from hashlib import md5
    return M.report_by_id(reports(spark, sf_dir), md5(b"15").hexdigest()[:12]).select("id", F.md5("markdown").alias("body"))


# --- J: quality ----------------------------------------------------------------------------------------------------

ISSUES = f"""
SELECT 'front_matter_missing' AS check, 'error' AS severity, id, '' AS detail FROM fm WHERE NOT has
UNION ALL SELECT 'missing_key', 'error', id, 'title' FROM fm WHERE has AND NOT contains(block, 'title:')
UNION ALL SELECT 'missing_key', 'error', id, 'event_id' FROM fm WHERE has AND NOT contains(block, 'event_id:')
UNION ALL SELECT 'event_id_empty', 'error', id, '' FROM fm WHERE has AND NOT contains(block, 'event_id:')
UNION ALL SELECT 'region_empty', 'warning', id, '' FROM fm WHERE has AND NOT contains(block, 'region:')
UNION ALL SELECT 'date_empty', 'warning', id, '' FROM fm WHERE has AND {DATE} = ''
UNION ALL SELECT 'malformed_line', 'error', id, 'odd line without colon mark' FROM fm WHERE has AND contains(block, 'odd line')
UNION ALL SELECT 'unexpected_key', 'error', id, 'colour' FROM fm WHERE has AND contains(block, 'colour:')
UNION ALL SELECT 'duplicate_event_id', 'error', id, e FROM (SELECT id, {field('event_id')} AS e, row_number() OVER (PARTITION BY {field('event_id')} ORDER BY id) AS rn
  FROM fm WHERE has AND {field('event_id')} <> '') WHERE rn > 1"""


@query("dq_reports", rep_sql(ISSUES, fm=FM))
def dq_reports(spark, sf_dir):
    return Q.check_reports(reports(spark, sf_dir))


@query("dq_manifest_count", rep_sql("SELECT 'manifest_count' AS check, 'error' AS severity, '' AS id, '7 != ' || count(*) AS detail FROM bridge_reports HAVING count(*) <> 7"))
def dq_manifest_count(spark, sf_dir):
    return Q.check_count(reports(spark, sf_dir), 7)


@query("dq_missing_reports", rep_sql("""
SELECT 'missing_report' AS check, 'error' AS severity, 'e' || p_partkey AS id, '' AS detail FROM part
WHERE 'e' || p_partkey NOT IN (SELECT id2 FROM (SELECT 'e' || p_partkey AS id2 FROM part WHERE p_size > 10))"""))
def dq_missing_reports(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("id", F.concat(F.lit("e"), F.col("p_partkey").cast("string")))
    return Q.check_missing_reports(p, p.where("p_size > 10"))


@query("dq_list_schema", rep_sql("""
SELECT 'required' AS check, 'error' AS severity, id, 'region' AS detail FROM mrows
UNION ALL SELECT 'min_length', 'error', id, 'activity' FROM mrows WHERE activity = ''
UNION ALL SELECT 'date_format', 'error', id, 'date' FROM mrows WHERE NOT regexp_matches(date, '^\\d{4}-\\d{2}-\\d{2}$') OR try_cast(date AS date) IS NULL""".replace("\\\\d", "\\d"), fm=FM, mrows=ROWS))
def dq_list_schema(spark, sf_dir):
    return Q.check_list_items(M.manifest_rows(reports(spark, sf_dir)))


@query("dq_report_schema", rep_sql("SELECT 'required' AS check, 'error' AS severity, id, 'content_markdown' AS detail FROM bridge_reports WHERE contains(markdown, '## Sources')"))
def dq_report_schema(spark, sf_dir):
    df = reports(spark, sf_dir)
    return Q.check_report_items(df.withColumn("content_markdown", F.when(~F.col("markdown").contains("## Sources"), F.col("markdown"))))


@query("dq_min_count", rep_sql("SELECT count(*) AS reports, 100::bigint AS expected_min, count(*) >= 100 AS ok FROM bridge_reports"))
def dq_min_count(spark, sf_dir):
    return Q.check_min_count(reports(spark, sf_dir), 100)
