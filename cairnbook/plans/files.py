"""Sources, sinks and incremental jobs: each query writes what Spark derives from the tables and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnbook.operators import fusion as U, ledger as L, manifest as M
from cairnbook.plans.bridges import bridge, with_bridges
from cairnbook.plans.events import NEWEST, assigned, events_sql, json_records
from cairnbook.plans.registry import query, table
from cairnbook.plans.reports import FM, REPORT_LINES, ROWS, rep_sql, report_lines
from cairnbook.session import new_run_dir
from cairnbook.sources import readers as R, writers as W
from cairnbook.streaming import incremental as T

JSON_FIELDS = "json_extract_string(artifact_json, '$.source_url') AS source_url, json_extract_string(artifact_json, '$.article_title') AS article_title"


def documents(spark, sf_dir):
    return bridge(spark, sf_dir, "bridge_json")


def artifact_dir(spark, sf_dir, label: str) -> str:
    """Artifacts below one folder per domain and day."""
    path = new_run_dir(spark, label)
    W.write_artifacts(documents(spark, sf_dir).withColumn("extracted_at", F.date_trunc("day", "extracted_at")), path)
    return path


def fields(df, *names):
    v = F.parse_json("artifact_json")
    return [F.try_variant_get(v, f"$.{n}", "string").alias(n) for n in names]


@query("scan_artifacts", with_bridges(f"SELECT {JSON_FIELDS} FROM bridge_json", "bridge_json"))
def scan_artifacts(spark, sf_dir):
    df = R.scan_artifacts(spark, artifact_dir(spark, sf_dir, "scan"), pattern="*.txt", whole=False)
    return df.select(*fields(df, "source_url", "article_title"))


JUDGED = """
SELECT CASE record_id % 10 WHEN 3 THEN 'unreadable' WHEN 5 THEN 'no object' ELSE 'kept' END AS verdict,
  CASE WHEN record_id % 10 NOT IN (3, 5) THEN source_url END AS source_url, count(*) AS n FROM bridge_artifacts GROUP BY 1, 2"""


def mixed_documents(spark, sf_dir, label: str) -> str:
    """The documents as lines; of ten one is cut short, one is a list, and one has its address twice."""
    raw, r = F.col("artifact_json"), F.col("record_id") % 10
    text = (F.when(r == 3, F.expr("substring(artifact_json, 1, length(artifact_json) - 3)")).when(r == 5, F.concat(F.lit("["), raw, F.lit("]")))
            .when(r == 7, F.concat(F.lit('{"source_url":"http://old.example/",'), F.expr("substring(artifact_json, 2)"))).otherwise(raw))
    path = new_run_dir(spark, label)
    documents(spark, sf_dir).select(text.alias("value")).repartition(4).write.text(path)
    return path


def verdicts(kept, rejected):
    rows = kept.select(F.lit("kept").alias("verdict"), *fields(kept, "source_url")).unionByName(rejected.select(F.col("reason").alias("verdict"), F.lit(None).cast("string").alias("source_url")))
    return rows.groupBy("verdict", "source_url").agg(F.count(F.lit(1)).alias("n"))


@query("scan_rejects", with_bridges(JUDGED, "bridge_artifacts"))
def scan_rejects(spark, sf_dir):
    path = mixed_documents(spark, sf_dir, "mixed")
    return verdicts(R.scan_artifacts(spark, path, pattern="*.txt", whole=False), R.rejected_artifacts(spark, path, pattern="*.txt", whole=False))


@query("stream_rejects", with_bridges(JUDGED, "bridge_artifacts"))
def stream_rejects(spark, sf_dir):
    out = new_run_dir(spark, "judged")
    T.ingest_judged(T.document_stream(spark, mixed_documents(spark, sf_dir, "mixed"), pattern="*.txt", whole=False, files_per_batch=2), f"{out}/log", f"{out}/rejects", f"{out}/checkpoint")
    return verdicts(spark.read.parquet(f"{out}/log"), spark.read.parquet(f"{out}/rejects"))


@query("write_artifacts", with_bridges("""
SELECT replace(replace(replace(split_part(source_url, '/', 3), 'www.', ''), '.', '_'), ':', '_') AS domain_slug,
  strftime(date_trunc('day', extracted_at), '%Y%m%d_000000') AS run_ts, count(*) AS n FROM bridge_json GROUP BY 1, 2""", "bridge_json"))
def write_artifacts(spark, sf_dir):
    rows = spark.read.text(artifact_dir(spark, sf_dir, "write"))
    return rows.groupBy("domain_slug", "run_ts").agg(F.count(F.lit(1)).alias("n"))


@query("scan_sidecars", with_bridges("SELECT sidecar_json, count(*) AS n FROM bridge_sidecars GROUP BY 1", "bridge_sidecars"))
def scan_sidecars(spark, sf_dir):
    path = new_run_dir(spark, "sidecars")
    bridge(spark, sf_dir, "bridge_sidecars").select("sidecar_json").write.text(path)
    found = R.scan_sidecars(spark, path, pattern="*.txt", whole=False)
    return found.groupBy("sidecar_json").agg(F.count(F.lit(1)).alias("n"))


@query("scan_url_list", "SELECT url FROM pages UNION ALL SELECT 'https://extra.example/' || page_id FROM pages")
def scan_url_list(spark, sf_dir):
    path = new_run_dir(spark, "urls")
    p = table(spark, sf_dir, "pages")
    lines = F.array(F.lit("# addresses of a page"), F.lit("   "), F.concat(F.lit("  "), p.url, F.lit(" , ,https://extra.example/"), p.page_id.cast("string")))
    p.select(F.explode(lines).alias("value")).write.text(path)
    return R.scan_url_list(spark, path)


@query("scan_gazetteer", "SELECT name FROM (SELECT DISTINCT p_brand, p_name AS name FROM part)")
def scan_gazetteer(spark, sf_dir):
    path = new_run_dir(spark, "gazetteer")
    """One list file per brand."""
    listed = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.to_json(F.collect_set("p_name")).alias("value"))
    listed.repartition("p_brand").write.partitionBy("p_brand").text(path)
    return R.scan_gazetteer(spark, path)


@query("scan_reports", "SELECT cast(s_suppkey AS varchar) AS id, '---' || chr(10) || 'title: ' || s_name || chr(10) || '---' || chr(10) || 'Body' || chr(10) AS markdown FROM supplier")
def scan_reports(spark, sf_dir):
    """One report folder per event, read back as whole texts."""
    path = new_run_dir(spark, "reports")
    s = table(spark, sf_dir, "supplier")
    text = F.concat(F.lit("---\ntitle: "), s.s_name, F.lit("\n---\nBody"))
    W.write_reports(s.select(s.s_suppkey.cast("string").alias("event_id"), text.alias("markdown")), path, per_event=True)
    return R.scan_reports(spark, path, pattern="*.txt", folder_key="event_id")


@query("write_reports", events_sql("SELECT event_id, substring(event_id, 1, 2) AS shard, line_no, line FROM report_lines", **REPORT_LINES))
def write_reports(spark, sf_dir):
    """Reports as sorted lines in a table by shard of the id, read back."""
    path = new_run_dir(spark, "reports")
    W.write_lines(report_lines(spark, sf_dir), path)
    back = spark.read.option("basePath", path).parquet(path)
    return back.select("event_id", F.lpad(F.col("shard").cast("string"), 2, "0").alias("shard"), "line_no", "line")


@query("write_manifest", rep_sql("SELECT id, title, date_of_event, peak, activity FROM mrows WHERE coalesce(nullif(title, ''), nullif(activity, ''), nullif(peak, '')) IS NOT NULL", fm=FM, mrows=ROWS))
def write_manifest(spark, sf_dir):
    path = new_run_dir(spark, "manifest")
    rows = M.build_manifest(bridge(spark, sf_dir, "bridge_reports"))
    W.write_manifest(rows, path)
    back = spark.read.schema("id string, title string, date_of_event string, peak string, activity string").json(path)
    return back.select("id", "title", "date_of_event", "peak", "activity")


@query("scan_manifest", "SELECT p_partkey::varchar AS id, p_name AS title FROM part UNION ALL SELECT 'o' || p_partkey, p_brand FROM part")
def scan_manifest(spark, sf_dir):
    """Both accepted shapes: an array, and an object with ``reports``."""
    p = table(spark, sf_dir, "part")
    item = lambda i, t: F.to_json(F.array(F.struct(i.alias("id"), t.alias("title"))))
    array = item(p.p_partkey.cast("string"), p.p_name)
    wrapped = F.concat(F.lit('{"count":1,"reports":'), item(F.concat(F.lit("o"), p.p_partkey.cast("string")), p.p_brand), F.lit("}"))
    return R.manifest_items(p.select(F.explode(F.array(array, wrapped)).alias("value"))).select("id", "title")


LEDGER_SQL = """
SELECT source_url, strftime(extracted_at, '%Y-%m-%d %H:%M:%S') AS ts, 'line one of ' || record_id || ' line two' AS article_text, '["p' || record_id % 6 || '","p' || record_id % 4 || '"]' AS photo_urls, '2' AS photo_urls_count
FROM (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY date_trunc('second', extracted_at) DESC, record_id) AS rn FROM bridge_artifacts) WHERE rn = 1"""


def written_ledger(spark, sf_dir) -> str:
    path = new_run_dir(spark, "ledger")
    rows = L.rebuild(documents(spark, sf_dir).select("artifact_json", "record_id"))
    W.write_ledger(rows.select(*L.header()), path)
    return path


@query("write_ledger", with_bridges(LEDGER_SQL, "bridge_artifacts"))
def write_ledger(spark, sf_dir):
    back = spark.read.csv(written_ledger(spark, sf_dir), header=True, multiLine=True, escape='"')
    return back.select("source_url", "ts", "article_text", "photo_urls", "photo_urls_count")


@query("read_ledger", with_bridges(LEDGER_SQL, "bridge_artifacts"))
def read_ledger(spark, sf_dir):
    return R.read_ledger(spark, written_ledger(spark, sf_dir)).select("source_url", "ts", "article_text", "photo_urls", "photo_urls_count")


@query("write_events", events_sql("SELECT event_id, count(*) AS n_records FROM assigned GROUP BY 1"))
def write_events(spark, sf_dir):
    """Written twice: the second run replaces the partitions of the first."""
    path = new_run_dir(spark, "events")
    rows = U.fused_scalars(assigned(spark, sf_dir)).select("event_id", "n_records")
    W.write_events(rows, path)
    W.write_events(rows, path)
    return W.read_events(spark, path)


@query("import_index", with_bridges("SELECT source_url, mountain_name, extraction_confidence_score::double AS extraction_confidence_score FROM bridge_json", "bridge_json"))
def import_index(spark, sf_dir):
    path = new_run_dir(spark, "index")
    docs = documents(spark, sf_dir).select("artifact_json", F.concat(F.lit("f"), F.col("record_id").cast("string")).alias("file_path"))
    W.import_index(docs, path).collect()
    W.import_index(docs.limit(0), path, skip_existing=True).collect()
    return spark.read.schema("source_url string, mountain_name string, extraction_confidence_score double").json(path)


# --- K: incremental jobs -------------------------------------------------------------------------------------

def stream(spark, sf_dir, label: str):
    """Records as a file stream of several micro-batches."""
    path = new_run_dir(spark, label)
    json_records(spark, sf_dir).select("event_id", "record_id", "source_url", "extracted_at", "extraction_confidence_score", "artifact_json").repartition(
        4, "record_id").write.parquet(f"{path}/in")
    source = spark.readStream.schema(spark.read.parquet(f"{path}/in").schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    return path, source


@query("stream_ingest", with_bridges(f"SELECT {JSON_FIELDS} FROM bridge_json", "bridge_json"))
def stream_ingest(spark, sf_dir):
    source = artifact_dir(spark, sf_dir, "ingest")
    out = new_run_dir(spark, "ingest-log")
    T.ingest(T.artifact_stream(spark, source, pattern="*.txt", whole=False, files_per_batch=20), f"{out}/log", f"{out}/checkpoint")
    df = spark.read.parquet(f"{out}/log")
    return df.select(*fields(df, "source_url", "article_title"))


@query("stream_upsert", with_bridges("SELECT source_url, record_id, extracted_at FROM newest", "bridge_artifacts", newest=NEWEST))
def stream_upsert(spark, sf_dir):
    path, source = stream(spark, sf_dir, "upsert")
    T.upsert_ledger(source, f"{path}/log", f"{path}/checkpoint")
    return T.current_ledger(spark, f"{path}/log").select("source_url", "record_id", "extracted_at")


@query("stream_refuse", events_sql("""
SELECT event_id, count(DISTINCT source_url) AS n_urls, arg_min(source_url, pos) AS first_url FROM ranked GROUP BY 1"""))
def stream_refuse(spark, sf_dir):
    path, source = stream(spark, sf_dir, "refuse")
    T.refuse_touched(source, f"{path}/artifacts", f"{path}/fused", f"{path}/checkpoint")
    urls = T.latest_fused(spark, f"{path}/fused").where("key = 'source_urls' AND value IS NOT NULL")
    return urls.groupBy("event_id").agg(F.count("*").alias("n_urls"), F.get_json_object(F.concat(F.lit("["), F.max(F.when(F.col("head"), F.col("value"))), F.lit("]")), "$[0]").alias("first_url"))


@query("stream_publish_once", with_bridges("SELECT record_id, source_url FROM bridge_artifacts", "bridge_artifacts"))
def stream_publish_once(spark, sf_dir):
    path, source = stream(spark, sf_dir, "publish")
    few = source.where("record_id % 3 = 0").select("record_id", "source_url")  # the other rows arrive between the runs
    T.publish_once(few, f"{path}/out", f"{path}/checkpoint")
    T.publish_once(source.select("record_id", "source_url"), f"{path}/out", f"{path}/checkpoint-lost")
    return spark.read.parquet(f"{path}/out").select("record_id", "source_url")
