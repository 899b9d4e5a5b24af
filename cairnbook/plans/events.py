"""Clustering, fusion and ledger queries over ``bridge_artifacts`` and ``bridge_json``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairnbook.operators import clustering as K, fusion as U, ledger as L
from cairnbook.plans.bridges import bridge, with_bridges
from cairnbook.plans.registry import query, table

# --- the same steps in SQL, as building blocks of the oracles ---------------------------------
REC = ("SELECT *, coalesce(trim(mountain_name), '') AS mt, "
       "coalesce(nullif(accident_date, ''), article_date_published, '') AS dt FROM bridge_artifacts")
KEYED = ("SELECT *, CASE WHEN dt <> '' AND mt <> '' THEN lower(mt) || '|' || dt "
         "ELSE substring(md5(source_url), 1, 16) END AS cluster_key FROM rec")
FIRSTS = "SELECT cluster_key, min(record_id) AS first_seen FROM keyed GROUP BY 1"
EVENT_KEYS = ("SELECT f.cluster_key, substring(md5(CASE WHEN k.mt <> '' OR k.dt <> '' THEN k.mt || '|' || k.dt "
              "ELSE coalesce(nullif(k.article_title, ''), k.source_url) END), 1, 12) AS event_id "
              "FROM firsts f JOIN keyed k ON k.record_id = f.first_seen")
ASSIGNED = "SELECT k.*, e.event_id FROM keyed k JOIN event_keys e USING (cluster_key)"
RANKED = ("SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY coalesce(extraction_confidence_score, 0) DESC, "
          "record_id) AS pos FROM assigned")
NEWEST = ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY extracted_at DESC, record_id) AS rn "
          "FROM bridge_artifacts) WHERE rn = 1")


def events_sql(body: str, *views: str, **extra: str) -> str:
    return with_bridges(body, "bridge_artifacts", *views, rec=REC, keyed=KEYED, firsts=FIRSTS, event_keys=EVENT_KEYS,
                        assigned=ASSIGNED, ranked=RANKED, **extra)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge(spark, sf_dir, "bridge_artifacts")


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.assign_event_ids(records(spark, sf_dir))


# --- F: clustering ---------------------------------------------------------------------------

@query("record_signature", events_sql(
    "SELECT record_id, md5(concat_ws('|', record_id, trim(article_title), dt, mt, '', '')) AS signature FROM rec"))
def record_signature(spark, sf_dir):
    return K.with_signature(records(spark, sf_dir)).select("record_id", "signature")


# The tree with five levels written out; levels that are deeper than the corpus asks for change nothing.
TREE = {
    "signed": "SELECT md5(concat_ws('|', record_id, trim(article_title), dt, mt, '', '')) AS signature FROM rec",
    "leaves": "SELECT signature, count(*) AS n FROM signed GROUP BY 1",
    "deep": "SELECT count(*) AS depth FROM range(1, 15) t(d) WHERE (SELECT count(*) FROM leaves) > pow(16, d)",
    "l5": """SELECT left(signature, depth) AS bucket, md5(string_agg(signature || ':' || n, '|' ORDER BY signature || ':' || n)) AS part, sum(n) AS n FROM leaves, deep GROUP BY 1""",
    **{f"l{k - 1}": f"""SELECT CASE WHEN length(bucket) = {k} THEN left(bucket, {k - 1}) ELSE bucket END AS bucket,
  CASE WHEN bool_or(length(bucket) = {k}) THEN md5(string_agg(part, '|' ORDER BY bucket)) ELSE any_value(part) END AS part, sum(n) AS n FROM l{k} GROUP BY 1""" for k in range(5, 0, -1)},
}


@query("corpus_key", events_sql("SELECT part AS corpus_key, cast(n AS bigint) AS n_records FROM l0", **TREE))
def corpus_key(spark, sf_dir):
    return K.corpus_key(K.with_signature(records(spark, sf_dir)))


@query("grouping_batch", with_bridges("""
SELECT record_id, article_title AS title, coalesce(nullif(accident_date, ''), article_date_published) AS date,
  mountain_name AS mountain, cast(NULL AS varchar) AS region, source_url, '' AS excerpt FROM bridge_artifacts""", "bridge_artifacts"))
def grouping_batch(spark, sf_dir):
    return K.grouping_batch(records(spark, sf_dir))


@query("cluster_deterministic", events_sql("""
SELECT k.record_id, n.cluster_id FROM keyed k JOIN (
  SELECT cluster_key, row_number() OVER (ORDER BY first_seen) - 1 AS cluster_id FROM firsts) n USING (cluster_key)"""))
def cluster_deterministic(spark, sf_dir):
    return K.cluster_deterministic(records(spark, sf_dir))


@query("cluster_split", events_sql("""
SELECT record_id, cluster_id, CASE WHEN split THEN cluster_key END AS split_key FROM given JOIN (
  SELECT cluster_id, count(DISTINCT nullif(lower(mt), '')) > 1 OR count(DISTINCT nullif(dt, '')) > 1 AS split FROM given GROUP BY 1) USING (cluster_id)""",
    given="SELECT *, cast(trunc(record_id / 3) AS bigint) AS cluster_id FROM keyed"))
def cluster_split(spark, sf_dir):
    df = records(spark, sf_dir)
    given = df.select("record_id", F.floor(F.col("record_id") / 3).alias("cluster_id"))
    return K.split_conflicts(df, given)


@query("event_ids", events_sql("SELECT record_id, event_id FROM assigned"))
def event_ids(spark, sf_dir):
    return assigned(spark, sf_dir).select("record_id", "event_id")


@query("event_ids_strict", events_sql("SELECT record_id, substring(md5(cluster_key), 1, 12) AS event_id FROM keyed"))
def event_ids_strict(spark, sf_dir):
    return K.assign_event_ids(records(spark, sf_dir), strict=True).select("record_id", "event_id")


@query("writeback_ids", events_sql("""
SELECT r.record_id, CASE WHEN r.mountain_name IS NOT NULL THEN a.event_id ELSE 'old' || r.num_fatalities END AS event_id
FROM bridge_artifacts r JOIN assigned a USING (record_id)"""))
def writeback_ids(spark, sf_dir):
    old = records(spark, sf_dir).withColumn("event_id", F.concat(F.lit("old"), F.col("num_fatalities").cast("string")))
    fresh = assigned(spark, sf_dir).where(F.col("mountain_name").isNotNull()).select("record_id", "event_id")
    return K.write_back(old, fresh).select("record_id", "event_id")


@query("validate_clusters", """
SELECT o_orderkey AS run_id, o_custkey % 5 + 10 AS cluster_id, cast(unnest([o_orderkey % 7, o_custkey % 3 + 1]) AS int) AS record_index FROM orders
UNION ALL SELECT o_orderkey, 1, 4 FROM orders""")
def validate_clusters(spark, sf_dir):
    text = lambda c: c.cast("string")
    answers = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.concat(
        F.lit('[{"cluster_id":'), text(F.col("o_custkey") % 5 + 10), F.lit(',"indices":['), text(F.col("o_orderkey") % 7),
        F.lit(',"x",'), text(F.col("o_custkey") % 3 + 1), F.lit('.7]},{"indices":[4]},{"cluster_id":3},{"indices":"5"},9]')).alias("raw"))
    return K.valid_clusters(answers)


@query("cache_misses", events_sql("""
SELECT record_id, CASE WHEN extraction_confidence_score IS NULL THEN 'computed' ELSE 'cached' END AS result FROM rec"""))
def cache_misses(spark, sf_dir):
    signed = K.with_signature(records(spark, sf_dir))
    cache = signed.where(F.col("extraction_confidence_score").isNotNull()).select("signature", F.lit("cached").alias("result"))
    return K.with_cache(signed.select("record_id", "signature"), cache,
                        lambda miss: miss.withColumn("result", F.lit("computed"))).select("record_id", "result")


@query("service_stats", events_sql(
    "SELECT count(*) AS files, count(DISTINCT event_id) AS clusters, count(event_id) AS written FROM assigned"))
def service_stats(spark, sf_dir):
    return K.service_stats(assigned(spark, sf_dir))


# --- G: merge and fusion ---------------------------------------------------------------------------

@query("group_events", events_sql(
    "SELECT event_id, count(*) AS n_records, min(record_id) AS first_record FROM assigned GROUP BY 1"))
def group_events(spark, sf_dir):
    return U.group_events(assigned(spark, sf_dir))


@query("baseline", events_sql("SELECT event_id, record_id, article_title, source_url FROM ranked WHERE pos = 1"))
def baseline(spark, sf_dir):
    return U.baselines(assigned(spark, sf_dir), "record_id", "article_title", "source_url")


def sidecar_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assigned(spark, sf_dir).withColumn("run_dir", F.col("record_id").cast("string"))


@query("sidecar_choice", events_sql("""
SELECT event_id, arg_min(sidecar_json, record_id) AS sidecar_json FROM assigned
JOIN bridge_sidecars s ON s.run_dir = cast(record_id AS varchar)
WHERE json_type(sidecar_json) = 'OBJECT' AND coalesce(try_cast(json_extract_string(sidecar_json, '$.extraction_confidence_score') AS double), 0) >= 0.1
  AND (coalesce(json_extract_string(sidecar_json, '$.derived_metrics'), '{}') <> '{}' OR coalesce(json_extract_string(sidecar_json, '$.events'), '[]') <> '[]')
GROUP BY 1""", "bridge_sidecars"))
def sidecar_choice(spark, sf_dir):
    return U.choose_sidecar(sidecar_records(spark, sf_dir), bridge(spark, sf_dir, "bridge_sidecars"))


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = sidecar_records(spark, sf_dir).select("record_id", "event_id", "run_dir")
    return bridge(spark, sf_dir, "bridge_json").join(ids, "record_id")


@query("merge_sidecar", with_bridges("""
SELECT cast(j.record_id AS varchar) AS run_dir,
  json_extract_string(j.artifact_json, '$.source_url') AS source_url,
  CASE WHEN o_orderkey % 5 IN (3, 4) THEN list_distinct_ordered ELSE base_list END AS photo_urls,
  CASE WHEN o_orderkey % 5 IN (3, 4) THEN coalesce(cast(o_custkey % 9 AS varchar), '') ELSE json_extract_string(j.artifact_json, '$.derived_metrics.m0') END AS m0,
  json_extract_string(j.artifact_json, '$.derived_metrics.m1') AS m1
FROM (SELECT record_id, artifact_json, o_orderkey, o_custkey,
        'p' || record_id % 6 || CASE WHEN record_id % 6 <> record_id % 4 THEN ',p' || record_id % 4 ELSE '' END || ',side' || o_custkey % 4 AS list_distinct_ordered,
        'p' || record_id % 6 || ',p' || record_id % 4 AS base_list
      FROM bridge_json LEFT JOIN orders ON o_orderkey = record_id) j""", "bridge_json"))
def merge_sidecar(spark, sf_dir):
    pairs = bridge(spark, sf_dir, "bridge_json").withColumn("run_dir", F.col("record_id").cast("string")).join(
        bridge(spark, sf_dir, "bridge_sidecars"), "run_dir", "left")
    usable = F.when(U.usable_sidecar(F.col("sidecar_json")), F.col("sidecar_json"))
    merged = U.merge_documents(pairs.withColumn("side", usable), "artifact_json", "side", "merged")
    merged = merged.select("run_dir", F.parse_json("merged").alias("m"))
    get = lambda p, t="string": F.try_variant_get("m", p, t)
    return merged.select("run_dir", get("$.source_url").alias("source_url"),
                         F.array_join(get("$.photo_urls", "array<string>"), ",").alias("photo_urls"),
                         get("$.derived_metrics.m0").alias("m0"), get("$.derived_metrics.m1").alias("m1"))


@query("fusion_order", events_sql("SELECT event_id, record_id, pos AS fusion_pos FROM ranked"))
def fusion_order(spark, sf_dir):
    return U.fusion_order(assigned(spark, sf_dir).select("event_id", "record_id", "extraction_confidence_score")).drop(
        "extraction_confidence_score")


def _scalar(spark, sf_dir, rule, column):
    rank = U.fusion_rank(F.col("extraction_confidence_score"), F.lit(1), F.col("record_id"))
    return (assigned(spark, sf_dir).groupBy("event_id").agg(rule(U.filled(F.col(column)), rank).alias(column)))


def _pick_sql(column: str, order: str) -> str:
    return events_sql(f"""
SELECT e.event_id, p.{column} FROM (SELECT DISTINCT event_id FROM assigned) e LEFT JOIN (
  SELECT event_id, {column} FROM (SELECT event_id, {column}, row_number() OVER (PARTITION BY event_id ORDER BY {order}) AS rn
    FROM ranked WHERE {column} IS NOT NULL AND {column} <> '') WHERE rn = 1) p USING (event_id)""")


@query("fuse_first", _pick_sql("mountain_name", "pos"))
def fuse_first(spark, sf_dir):
    return _scalar(spark, sf_dir, U.first_filled, "mountain_name")


@query("fuse_longest", _pick_sql("accident_summary_text", "length(accident_summary_text) DESC, pos"))
def fuse_longest(spark, sf_dir):
    return _scalar(spark, sf_dir, U.longest, "accident_summary_text")


@query("fuse_title", _pick_sql("article_title", "contains(article_title, 'None'), length(article_title) DESC, pos"))
def fuse_title(spark, sf_dir):
    return _scalar(spark, sf_dir, U.best_title, "article_title")


@query("fuse_date", _pick_sql("accident_date", "NOT starts_with(accident_date, '20'), accident_date, pos"))
def fuse_date(spark, sf_dir):
    return _scalar(spark, sf_dir, U.earliest_date, "accident_date")


@query("fuse_score", events_sql(
    "SELECT event_id, max(extraction_confidence_score) AS extraction_confidence_score FROM assigned GROUP BY 1"))
def fuse_score(spark, sf_dir):
    return assigned(spark, sf_dir).groupBy("event_id").agg(
        F.max("extraction_confidence_score").alias("extraction_confidence_score"))


@query("fuse_scalars", events_sql("""
SELECT event_id,
  arg_min(mountain_name, pos) FILTER (mountain_name <> '') AS mountain_name,
  max(extraction_confidence_score) AS extraction_confidence_score, count(*) AS n_records,
  min(accident_date) AS accident_date,
  arg_min(article_title, (contains(article_title, 'None')::int * 1000 - length(article_title)) * 1000000 + pos) AS article_title,
  arg_min(accident_summary_text, pos - length(accident_summary_text) * 1000000) FILTER (accident_summary_text <> '') AS accident_summary_text
FROM ranked GROUP BY 1"""))
def fuse_scalars(spark, sf_dir):
    return U.fused_scalars(assigned(spark, sf_dir))


@query("fuse_lists", events_sql("""
SELECT event_id, item, score, record_id, item_pos FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id, item ORDER BY pos, item_pos) AS rn FROM (
    SELECT event_id, pos, record_id, coalesce(extraction_confidence_score, 0) AS score,
      unnest(photo_urls) AS item, cast(generate_subscripts(photo_urls, 1) - 1 AS int) AS item_pos FROM ranked)) WHERE rn = 1"""))
def fuse_lists(spark, sf_dir):
    return U.fuse_lists(assigned(spark, sf_dir), "photo_urls")


def map_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = U.fusion_rank(F.col("extraction_confidence_score"), F.lit(1), F.col("record_id"))
    return assigned(spark, sf_dir).select("event_id", rank.alias("rank"), F.col("source_url").alias("subkey"),
                                          F.col("article_title").alias("value"))


@query("fuse_maps", events_sql(
    "SELECT event_id, source_url AS subkey, arg_max(article_title, pos) AS value FROM ranked GROUP BY 1, 2"))
def fuse_maps(spark, sf_dir):
    return U.merge_maps(map_entries(spark, sf_dir), ["event_id"])


@query("fuse_maps_first", events_sql(
    "SELECT event_id, source_url AS subkey, arg_min(article_title, pos) AS value FROM ranked GROUP BY 1, 2"))
def fuse_maps_first(spark, sf_dir):
    return U.merge_maps(map_entries(spark, sf_dir), ["event_id"], policy="first")


# A JSON number without a fraction is written without one.
NUM = "regexp_replace({}, '[.]0$', '')"
FUSED = {
    "docs": "SELECT r.event_id, r.pos, r.record_id, j.artifact_json AS j FROM ranked r JOIN bridge_json j USING (record_id)",
    "every": "SELECT event_id, pos, j FROM docs",
    "scalars": "\n  UNION ALL ".join(
        [f"SELECT event_id, '{k}' AS key, json_extract(j, '$.{k}')::VARCHAR AS value FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY pos) AS n FROM docs WHERE json_exists(j, '$.{k}')) WHERE n = 1"
         for k in ("source_url", "extracted_at", "article_title", "num_fatalities", "article_text", "mountain_name")]
        + ["SELECT event_id, 'accident_date', min(json_extract(j, '$.accident_date')::VARCHAR) FROM docs WHERE json_exists(j, '$.accident_date') GROUP BY 1",
           f"SELECT event_id, 'extraction_confidence_score', {NUM.format('max(json_extract(j, $$$.extraction_confidence_score$$)::DOUBLE)::VARCHAR')} FROM docs WHERE json_exists(j, '$.extraction_confidence_score') GROUP BY 1",
           "SELECT event_id, 'video_urls', '\"none\"' FROM docs GROUP BY 1 HAVING bool_and(json_type(j, '$.video_urls') = 'VARCHAR')"]),
    "listed": """SELECT event_id, key, item, row_number() OVER (PARTITION BY event_id, key ORDER BY min(pos * 1000 + p)) AS n FROM (
    SELECT event_id, key, pos, unnest(items)::VARCHAR AS item, generate_subscripts(items, 1) AS p FROM (
      SELECT event_id, pos, unnest(['photo_urls', 'people', 'video_urls', 'events', 'source_urls']) AS key,
        unnest([json_extract(j, '$.photo_urls[*]'), json_extract(j, '$.people[*]'), json_extract(j, '$.video_urls[*]'), json_extract(j, '$.events[*]'), [json_extract(j, '$.source_url')]]) AS items FROM every))
  WHERE item IS NOT NULL GROUP BY 1, 2, 3""",
    "mapped": """SELECT event_id, key, sub, arg_max(value, pos) AS value, row_number() OVER (PARTITION BY event_id, key ORDER BY sub) AS n FROM (
    SELECT event_id, pos, 'derived_metrics' AS key, unnest(json_keys(j, '$.derived_metrics')) AS sub, json_extract(j, '$.derived_metrics.' || unnest(json_keys(j, '$.derived_metrics')))::VARCHAR AS value FROM every)
  GROUP BY 1, 2, 3""",
}
#: The lines of the objects, from the parts above.
FUSED_LINES = {
    "texts": """SELECT DISTINCT event_id, 0 AS part, '' AS key, 0 AS piece, 0::BIGINT AS n, '{"event_id": "' || event_id || '"' AS line FROM docs
  UNION ALL SELECT DISTINCT event_id, 2, '', 0, 0, '}' FROM docs
  UNION ALL SELECT event_id, 1, key, 0, 0, ', "' || key || '": ' || value FROM scalars
  UNION ALL SELECT DISTINCT event_id, 1, key, 0, 0, ', "' || key || '": [' FROM listed
  UNION ALL SELECT event_id, 1, key, 1, n, CASE WHEN n = 1 THEN '  ' ELSE ', ' END || item FROM listed
  UNION ALL SELECT DISTINCT event_id, 1, key, 2, 0, ']' FROM listed
  UNION ALL SELECT DISTINCT event_id, 1, key, 0, 0, ', "' || key || '": {' FROM mapped
  UNION ALL SELECT event_id, 1, key, 1, n, CASE WHEN n = 1 THEN '  ' ELSE ', ' END || '"' || sub || '": ' || value FROM mapped
  UNION ALL SELECT DISTINCT event_id, 1, key, 2, 0, '}' FROM mapped""",
}


@query("fuse_events", events_sql("""
SELECT event_id, row_number() OVER (PARTITION BY event_id ORDER BY part, key, piece, n) AS line_no, line FROM texts""",
    "bridge_json", **FUSED, **FUSED_LINES))
def fuse_events(spark, sf_dir):
    """Every line of the fused JSON objects."""
    return U.fuse_events(json_records(spark, sf_dir).select("event_id", "record_id", "extraction_confidence_score", "artifact_json"))


# The chosen sidecar of an event comes behind its best record and before the record's own turn in the order.
SIDES = """SELECT event_id, arg_min(sidecar_json, record_id) AS j FROM assigned JOIN bridge_sidecars s ON s.run_dir = cast(record_id AS varchar)
WHERE json_type(sidecar_json) = 'OBJECT' AND coalesce(try_cast(json_extract_string(sidecar_json, '$.extraction_confidence_score') AS double), 0) >= 0.1
  AND (coalesce(json_extract_string(sidecar_json, '$.derived_metrics'), '{}') <> '{}' OR coalesce(json_extract_string(sidecar_json, '$.events'), '[]') <> '[]') GROUP BY 1"""
EVERY = "SELECT event_id, pos::DOUBLE AS pos, j FROM docs UNION ALL SELECT event_id, 0, j FROM docs WHERE pos = 1 UNION ALL SELECT event_id, 0.5, j FROM sides"


@query("fuse_events_long", events_sql("""
SELECT event_id, key, 'scalar' AS kind, NULL AS subkey, value, false AS head FROM scalars
UNION ALL SELECT DISTINCT event_id, key, 'list', NULL, NULL, false FROM listed
UNION ALL SELECT event_id, key, 'list', NULL, item, n = 1 FROM listed
UNION ALL SELECT DISTINCT event_id, key, 'map', NULL, NULL, false FROM mapped
UNION ALL SELECT event_id, key, 'map', sub, value, n = 1 FROM mapped""", "bridge_json", "bridge_sidecars", sides=SIDES, **{**FUSED, "every": EVERY}))
def fuse_events_long(spark, sf_dir):
    """Every piece of the fused events, best records merged with their sidecars first."""
    return U.fuse_long(json_records(spark, sf_dir), bridge(spark, sf_dir, "bridge_sidecars")).drop("at")


@query("source_urls", events_sql("""
SELECT event_id, source_url, coalesce(extraction_confidence_score, 0) AS score, record_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id, source_url ORDER BY pos) AS rn FROM ranked) WHERE rn = 1"""))
def source_urls(spark, sf_dir):
    return U.source_urls(assigned(spark, sf_dir))


@query("conflicts", events_sql("""
SELECT event_id, count(DISTINCT nullif(accident_summary_text, '')) > 1 AS has_conflict FROM assigned GROUP BY 1"""))
def conflicts(spark, sf_dir):
    return U.conflicts(assigned(spark, sf_dir))


@query("object_signature", with_bridges("""
SELECT run_dir, md5(CASE WHEN run_dir::bigint % 5 IN (3, 4) THEN
    '{"derived_metrics":{"m0":' || json_extract_string(sidecar_json, '$.derived_metrics.m0') || '},"extraction_confidence_score":"0.4","photo_urls":["' || json_extract_string(sidecar_json, '$.photo_urls[0]') || '"]}'
  WHEN run_dir::bigint % 5 = 2 THEN '{"derived_metrics":{},"extraction_confidence_score":0.9}'
  WHEN run_dir::bigint % 5 = 1 THEN '{"events":[{"t":1}],"extraction_confidence_score":' || CASE json_extract_string(sidecar_json, '$.extraction_confidence_score') WHEN '0.0' THEN '0' ELSE json_extract_string(sidecar_json, '$.extraction_confidence_score') END || '}'
  ELSE sidecar_json END) AS signature FROM bridge_sidecars""", "bridge_sidecars"))
def object_signature(spark, sf_dir):
    return bridge(spark, sf_dir, "bridge_sidecars").select("run_dir", U.object_signature(F.col("sidecar_json")).alias("signature"))


@query("stale_events", events_sql("""
SELECT i.event_id, i.m AS newest_input FROM (SELECT event_id, max(extracted_at) AS m FROM assigned GROUP BY 1) i
LEFT JOIN (SELECT event_id, max(extracted_at) AS m FROM assigned WHERE num_fatalities < 3 GROUP BY 1) o USING (event_id)
WHERE o.m IS NULL OR o.m < i.m"""))
def stale_events(spark, sf_dir):
    df = assigned(spark, sf_dir).withColumn("modified", F.col("extracted_at"))
    written = df.where(F.col("num_fatalities") < 3)
    return U.stale_events(df.select("event_id", "modified"), written.select("event_id", "modified"))


@query("relative_paths", """
SELECT page_id, CASE WHEN starts_with(path, '/srv/site') THEN CASE WHEN substring(path, 10, 1) = '/' THEN substring(path, 10) ELSE '/' || substring(path, 10) END ELSE path END AS path
FROM (SELECT page_id, CASE WHEN contains(url, 'www.') THEN '/srv/site/a/' || page_id WHEN contains(url, 'blog.') THEN '/srv/sites/' || page_id ELSE url END AS path FROM pages)""")
def relative_paths(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    path = (F.when(p.url.contains("www."), F.concat(F.lit("/srv/site/a/"), p.page_id.cast("string")))
            .when(p.url.contains("blog."), F.concat(F.lit("/srv/sites/"), p.page_id.cast("string"))).otherwise(p.url))
    doc = F.to_json(F.struct(path.alias("file"), F.array(path).alias("files")))
    rel = U.relative_paths_json(doc, "/srv/site")
    return p.select("page_id", F.get_json_object(rel, "$.files[0]").alias("path"))


# --- H: ledger ---------------------------------------------------------------------------------------

@query("ledger_newest", with_bridges("SELECT source_url, record_id, extracted_at, article_title FROM newest",
                                     "bridge_artifacts", newest=NEWEST))
def ledger_newest(spark, sf_dir):
    return L.newest_per_url(records(spark, sf_dir).select("source_url", "record_id", "extracted_at", "article_title"))


@query("ledger_projection", with_bridges(r"""
SELECT record_id, json_extract_string(artifact_json, '$.extracted_at') AS ts, source_url, split_part(source_url, '/', 3) AS domain,
  json_extract_string(artifact_json, '$.mountain_name') AS mountain_name, json_extract_string(artifact_json, '$.photo_urls') AS photo_urls,
  json_extract_string(artifact_json, '$.people') AS people, cast(NULL AS varchar) AS region FROM bridge_json""", "bridge_json"))
def ledger_projection(spark, sf_dir):
    return L.project(bridge(spark, sf_dir, "bridge_json").select("artifact_json", "record_id")).select(
        "record_id", "ts", "source_url", "domain", "mountain_name", "photo_urls", "people", "region")


@query("ledger_counts", with_bridges("""
SELECT record_id, 1 AS people_count, 0 AS rescue_teams_count, 2 AS photo_urls_count,
  CASE WHEN json_type(artifact_json, '$.video_urls') = 'ARRAY' THEN 1 ELSE 0 END AS video_urls_count, 0 AS related_articles_urls_count FROM bridge_json""", "bridge_json"))
def ledger_counts(spark, sf_dir):
    rows = L.project(bridge(spark, sf_dir, "bridge_json").select("artifact_json", "record_id"))
    return L.add_counts(rows).select("record_id", "people_count", "rescue_teams_count", "photo_urls_count",
                                     "video_urls_count", "related_articles_urls_count")


@query("ledger_incoming", with_bridges("""
SELECT record_id, source_url, coalesce(mountain_name, 'from record') AS mountain_name,
  coalesce(cast(extraction_confidence_score AS double), 0.5) AS score FROM bridge_json""", "bridge_json"))
def ledger_incoming(spark, sf_dir):
    df = bridge(spark, sf_dir, "bridge_json").select(
        "record_id", "artifact_json", F.lit("from record").alias("mountain_name"), F.lit(0.5).alias("extraction_confidence_score"))
    return L.incoming_rows(df).select("record_id", "source_url", "mountain_name",
                                      F.col("extraction_confidence_score").cast("double").alias("score"))


@query("ledger_upsert", with_bridges("""
SELECT source_url, coalesce(arg_max(record_id, record_id) FILTER (num_fatalities >= 2), arg_min(record_id, rn)) AS record_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY extracted_at DESC, record_id) AS rn FROM bridge_artifacts) GROUP BY 1""",
    "bridge_artifacts"))
def ledger_upsert(spark, sf_dir):
    df = records(spark, sf_dir).select("source_url", "record_id", "extracted_at", "num_fatalities")
    incoming = df.where(F.col("num_fatalities") >= 2).withColumn("seq", F.col("record_id"))
    return L.upsert(L.newest_per_url(df), incoming).select("source_url", "record_id")


@query("ledger_rebuild", with_bridges("""
SELECT source_url, strftime(extracted_at, '%Y-%m-%d %H:%M:%S') AS ts, article_title, 2 AS photo_urls_count FROM (
  SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY date_trunc('second', extracted_at) DESC, record_id) AS rn FROM bridge_artifacts) WHERE rn = 1""",
    "bridge_artifacts"))
def ledger_rebuild(spark, sf_dir):
    return L.rebuild(bridge(spark, sf_dir, "bridge_json").select("artifact_json", "record_id")).select(
        "source_url", "ts", "article_title", "photo_urls_count")


@query("ledger_query", with_bridges("""
SELECT record_id, source_url, num_fatalities FROM bridge_artifacts WHERE num_fatalities = 2 AND mountain_name = 'Mount 4'""", "bridge_artifacts"))
def ledger_query(spark, sf_dir):
    return L.query(records(spark, sf_dir), {"num_fatalities": 2, "mountain_name": "Mount 4"}).select(
        "record_id", "source_url", "num_fatalities")


@query("ledger_search", with_bridges("""
SELECT record_id FROM bridge_artifacts WHERE extraction_confidence_score > 0.9 OR num_people_involved = 4""", "bridge_artifacts"))
def ledger_search(spark, sf_dir):
    return L.search(records(spark, sf_dir), (F.col("extraction_confidence_score") > 0.9)
                    | (F.col("num_people_involved") == 4)).select("record_id")


@query("event_overview", events_sql("""
SELECT event_id, arg_min(mountain_name, pos) FILTER (mountain_name <> '') AS mountain_name,
  max(extraction_confidence_score) AS score, count(*) AS n_records, count(DISTINCT source_url) AS n_sources
FROM ranked GROUP BY 1"""))
def event_overview(spark, sf_dir):
    """Records to events in one plan: cluster, id, fuse, count sources."""
    df = assigned(spark, sf_dir)
    sources = df.groupBy("event_id", "source_url").agg(F.lit(1).alias("x")).groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n_sources"))
    return U.fused_scalars(df).join(sources, "event_id").select(
        "event_id", "mountain_name", F.col("extraction_confidence_score").alias("score"), "n_records", "n_sources")
