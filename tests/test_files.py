"""Readers, writers, incremental jobs."""

import json

import pytest
from pyspark.sql import functions as F

from cairnbook.operators import fusion as U, ledger as L
from cairnbook.sources import readers as R, writers as W
from cairnbook.streaming import incremental as T


def put(root, path, text):
    f = root / path
    f.parent.mkdir(parents=True, exist_ok=True)
    f.write_text(text, encoding="utf-8")


def test_scan_artifacts_and_sidecars(spark, tmp_path):
    put(tmp_path, "a/1/accident_info.json", json.dumps({"source_url": "u1"}, indent=2))
    put(tmp_path, "b/accident_info.json", '{"source_url":"u2"}')
    put(tmp_path, "c/accident_info.json", "{broken")
    put(tmp_path, "a/1/captions.json", '[{"image_url":"x"}]')
    found = R.scan_artifacts(spark, str(tmp_path))
    assert sorted(json.loads(r.artifact_json)["source_url"] for r in found.collect()) == ["u1", "u2"]
    joined = R.with_sidecars(found, R.scan_sidecars(spark, str(tmp_path)))
    assert sorted(r.sidecar_json or "" for r in joined.collect()) == ["", '[{"image_url":"x"}]']


def test_lists(spark, tmp_path):
    put(tmp_path, "urls.txt", "# note\n\nhttps://a, https://b\n https://c \n")
    assert sorted(r.url for r in R.scan_url_list(spark, str(tmp_path / "urls.txt")).collect()) == ["https://a", "https://b", "https://c"]
    put(tmp_path, "g.json", '["X",\n"Y"]')
    assert sorted(r.name for r in R.scan_gazetteer(spark, str(tmp_path / "g.json")).collect()) == ["X", "Y"]
    put(tmp_path, "r/e1.md", "# a\n")
    assert [tuple(r) for r in R.scan_reports(spark, str(tmp_path / "r")).collect()] == [("e1", "# a\n")]


def test_ledger_file(spark, tmp_path):
    rows = spark.createDataFrame([("u1", 'say "hi", ok', ["a"], None), ("u2", "two\nlines", [], 1.5)], "source_url string, article_text string, photo_urls array<string>, score double")
    W.write_ledger(rows, str(tmp_path / "l"))
    back = {r.source_url: r for r in R.read_ledger(spark, str(tmp_path / "l")).collect()}
    assert back["u1"].article_text == 'say "hi", ok' and back["u1"].photo_urls == '["a"]' and back["u2"].article_text == "two lines"
    assert R.read_ledger(spark, str(tmp_path / "missing")).count() == 0


def test_import_modes(spark, tmp_path):
    docs = spark.createDataFrame([("f", '{"source_url":"u","extraction_confidence_score":0.5}')], "file_path string, artifact_json string")
    out = str(tmp_path / "index")
    assert W.import_index(docs, out, dry_run=True).collect()[0].artifacts == 1 and not (tmp_path / "index").exists()
    assert W.import_index(docs, out, skip_existing=True).collect()[0].artifacts == 1
    assert W.import_index(docs.union(docs), out, skip_existing=True).collect()[0].artifacts == 0
    assert spark.read.json(out).collect()[0].source_url == "u"


def test_manifest_has_one_form(spark, tmp_path):
    items = spark.createDataFrame([(f"{i}", "t") for i in range(5)], "id string, title string")
    W.write_manifest(items, str(tmp_path / "m"))
    assert sorted(r.id for r in spark.read.json(str(tmp_path / "m")).collect()) == ["0", "1", "2", "3", "4"]


def test_artifacts_keep_their_lines_and_repeat(spark, tmp_path):
    doc = json.dumps({"source_url": "https://x.example/1", "text": "a\nb"}, indent=2)
    rows = spark.createDataFrame([("https://x.example/1", doc)], "source_url string, artifact_json string").withColumn("extracted_at", F.lit("2024-01-01").cast("timestamp"))
    for _ in range(2):
        W.write_artifacts(rows, str(tmp_path / "a"))
    back = R.scan_artifacts(spark, str(tmp_path / "a"), pattern="*.txt", whole=False).collect()
    assert [json.loads(r.artifact_json) for r in back] == [json.loads(doc)]


def test_unreadable_artifacts_are_told(spark, tmp_path):
    for name, text in (("a", '{"k":1}'), ("b", "[1]"), ("c", "{")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "accident_info.json").write_text(text)
    assert R.scan_artifacts(spark, str(tmp_path)).count() == 1
    assert sorted(r.reason for r in R.rejected_artifacts(spark, str(tmp_path)).collect()) == ["no object", "unreadable"]


def test_report_line_ends(spark, tmp_path):
    (tmp_path / "r.md").write_bytes(b"---\r\ntitle: x\r\n---\rbody")
    assert R.scan_reports(spark, str(tmp_path)).collect()[0].markdown == "---\ntitle: x\n---\nbody"


def test_publish_once_by_content(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for run, ids in enumerate(([1, 2], [3, 4, 4])):
        spark.createDataFrame([(i,) for i in ids], "record_id long").write.mode("append").parquet(src)
        T.publish_once(spark.readStream.schema("record_id long").parquet(src), out, str(tmp_path / f"checkpoint{run}"))
    assert sorted(r.record_id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4]


def test_publish_reads_only_what_a_batch_may_meet(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "name string, n long"
    for run, rows in enumerate(([(f"k{i}", i) for i in range(500)] + [(None, 1)], [("k7", 99), (None, 2), ("new", 3)])):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{src}{run}")
        T.publish_once(spark.readStream.schema(schema).parquet(f"{src}{run}"), out, str(tmp_path / f"cp{run}"), keys=["name"])
    got = {r.name: r.n for r in spark.read.parquet(out).collect()}
    assert len(got) == spark.read.parquet(out).count() == 502 and (got["k7"], got[None], got["new"]) == (7, 1, 3)
    fresh = spark.read.parquet(out).where("name = 'k7'")
    held = T.held_keys(fresh, out, ["name"])
    assert "PartitionFilters: [isnotnull(shard" in held._jdf.queryExecution().executedPlan().toString()
    names = [r.name for r in held.collect()]
    assert "k7" in names and len(names) <= 3
    assert T.held_keys(fresh.limit(0), out, ["name"]).count() == 0


def test_full_tiers_of_the_ledger_log_are_folded(spark, tmp_path):
    log, schema = str(tmp_path / "log"), "source_url string, extracted_at string, record_id bigint"
    rows = [[("u1", f"2024-01-{b + 10}", b), (f"only{b}", "2024-01-01", 100 + b)] for b in range(7)]
    for b, part in enumerate(rows):
        spark.createDataFrame(part, schema).write.mode("overwrite").parquet(f"{log}/batch_id={b}")
        T.compact_tiers(spark, log, fan=2)
    want = {"u1": 6} | {f"only{b}": 100 + b for b in range(7)}
    ledger = lambda: {r.source_url: r.record_id for r in T.current_ledger(spark, log).collect()}
    assert ledger() == want
    assert sorted(p.name for p in (tmp_path / "log").iterdir() if p.is_dir()) == ["batch_id=3_t2", "batch_id=5_t1", "batch_id=6"]
    # A batch that is repeated after its folder was folded, and parts that a broken run left, change nothing.
    spark.createDataFrame(rows[0], schema).write.mode("overwrite").parquet(f"{log}/batch_id=0")
    assert ledger() == want
    T.compact_tiers(spark, log, fan=2)
    assert ledger() == want
    with pytest.raises(ValueError):
        T.compact_tiers(spark, log, fan=1)


def test_stream_upsert_in_two_runs(spark, tmp_path):
    schema = "source_url string, extracted_at string, record_id bigint"
    src, log, cp = (str(tmp_path / n) for n in ("in", "log", "cp"))
    batches = [[("u1", "2024-01-01", 1), ("u2", "2024-01-01", 2)], [("u1", "2024-03-01", 3), ("u2", "2023-01-01", 4)]]
    for b in batches:
        spark.createDataFrame(b, schema).write.mode("append").parquet(src)
        T.upsert_ledger(spark.readStream.schema(schema).parquet(src), log, cp)
    assert sorted((r.source_url, r.record_id) for r in T.current_ledger(spark, log).collect()) == [("u1", 3), ("u2", 2)]
    T.compact(spark, log, str(tmp_path / "log2"))
    assert T.current_ledger(spark, str(tmp_path / "log2")).count() == 2
    assert L.query(T.current_ledger(spark, log), {"source_url": "u1"}).count() == 1


def test_refuse_touches_only_changed_events(spark, tmp_path):
    schema = "event_id string, record_id bigint, extraction_confidence_score double, artifact_json string"
    src, art, fused, cp = (str(tmp_path / n) for n in ("in", "art", "fused", "cp"))
    doc = lambda u: json.dumps({"source_url": u, "extraction_confidence_score": 0.5})
    for b in ([("a", 1, 0.5, doc("u1")), ("b", 2, 0.5, doc("u2"))], [("a", 3, 0.5, doc("u3"))]):
        spark.createDataFrame(b, schema).write.mode("append").parquet(src)
        T.refuse_touched(spark.readStream.schema(schema).parquet(src), art, fused, cp)
    latest = {r.event_id: json.loads(r.value) for r in U.fold_keys(T.latest_fused(spark, fused)).where("key = 'source_urls'").collect()}
    assert latest == {"a": ["u1", "u3"], "b": ["u2"]}
    assert {r.event_id: r.n for r in spark.read.parquet(fused).groupBy("event_id").agg(F.countDistinct("batch_id").alias("n")).collect()} == {"a": 2, "b": 1}
    met = [r.shard for r in spark.read.parquet(f"{art}/batch_id=1").select("shard").distinct().collect()]
    log = T.touched_log(spark, art, met)
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert len(met) == 1 and "PartitionFilters" in plan and sorted(r.record_id for r in log.collect()) == [1, 3]


def test_every_document_is_kept_or_rejected_with_its_reason(spark, tmp_path):
    src, log, bad, cp = (str(tmp_path / n) for n in ("in", "log", "bad", "cp"))
    lines = ['{"source_url":"u1"}', '{"source_url":"old","x":{"a":1,"a":2},"source_url":"u2"}', '{"source_url":', "[1]", "7", ""]
    for part in (lines[:3], lines[3:]):
        spark.createDataFrame([(x,) for x in part], "value string").coalesce(1).write.mode("append").text(src)
        T.ingest_judged(T.document_stream(spark, src, pattern="*.txt", whole=False), log, bad, cp)
    kept = [json.loads(r.artifact_json) for r in spark.read.parquet(log).collect()]
    assert sorted(k["source_url"] for k in kept) == ["u1", "u2"] and [k["x"] for k in kept if "x" in k] == [{"a": 2}]
    rejected = sorted((r.value, r.reason) for r in spark.read.parquet(bad).collect())
    assert rejected == [("", "unreadable"), ("7", "no object"), ("[1]", "no object"), ('{"source_url":', "unreadable")]
    again = sorted(json.loads(r.artifact_json)["source_url"] for r in R.scan_artifacts(spark, src, pattern="*.txt", whole=False).join(
        R.scan_artifacts(spark, src, pattern="*.txt", whole=False).select("artifact_json"), "artifact_json").collect())
    assert again == ["u1", "u2"]


def test_lines_of_one_event_lie_in_order_over_files(spark, tmp_path):
    path = str(tmp_path / "lines")
    rows = [("ab1", k, f"line {k}") for k in range(1, 5001)] + [("ab2", 1, "x"), ("cd1", 1, "y")]
    W.write_lines(spark.createDataFrame(rows, "event_id string, line_no long, line string").repartition(5), path)
    files = spark.read.parquet(path).where("event_id = 'ab1'").groupBy(F.input_file_name().alias("f")).agg(F.min("line_no").alias("a"), F.max("line_no").alias("b"), F.count("*").alias("n")).orderBy("a").collect()
    assert len(files) > 1 and all(f.b - f.a + 1 == f.n for f in files) and sum(f.n for f in files) == 5000
    assert sorted(tuple(r) for r in W.read_lines(spark, path).collect()) == sorted(rows)
    W.write_lines(spark.createDataFrame([("cd1", 1, "z")], "event_id string, line_no long, line string"), path)
    assert {r.line for r in W.read_lines(spark, path).where("event_id = 'cd1'").collect()} == {"z"} and W.read_lines(spark, path).count() == 5002


def test_two_calls_keep_both_documents_and_a_repeated_one_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "a")

    def write(url, n):
        rows = spark.createDataFrame([(url, json.dumps({"source_url": url, "n": n}))], "source_url string, artifact_json string")
        W.write_artifacts(rows.withColumn("extracted_at", F.lit("2024-05-01 10:00:00").cast("timestamp")), path)

    write("https://x.org/1", 1)
    write("https://x.org/2", 2)
    write("https://x.org/2", 3)
    write("https://y.org/1", 4)
    back = R.scan_artifacts(spark, path, pattern="*.txt", whole=False).collect()
    found = sorted((json.loads(r.artifact_json)["source_url"], json.loads(r.artifact_json)["n"]) for r in back)
    assert found == [("https://x.org/1", 1), ("https://x.org/2", 3), ("https://y.org/1", 4)]


def test_of_different_rows_with_one_key_the_first_is_published(spark, tmp_path):
    for k, batch in enumerate(([(1, "b"), (1, "a"), (2, "z"), (None, "n"), (None, "m")], [(1, "0"), (3, "c")])):
        spark.createDataFrame(batch, "record_id long, v string").coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
        stream = spark.readStream.schema("record_id long, v string").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        T.publish_once(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = {(r.record_id, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, "a"), (2, "z"), (3, "c"), (None, "m")}


def test_a_small_table_is_dealt_to_every_core(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    dealt = R.read_table(spark, str(tmp_path / "t"))
    assert dealt.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
    assert min(dealt.rdd.glom().map(len).collect()) > 0 and dealt.count() == 1000
