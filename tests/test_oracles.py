"""Registered queries against DuckDB at the smallest scale."""

import importlib
import os
import sys

import duckdb
import pytest

from cairnbook.operators import pages

SF = "/root/testdata/sf0.001"
KEYS = ("cluster_deterministic", "cluster_split", "event_ids", "fusion_order", "fuse_lists", "fuse_events", "source_urls", "ledger_newest",
        "ledger_rebuild", "block_dedupe", "focus_window", "trim_tail_run", "publication_date", "gazetteer_join", "coerce_scalars", "clean_causes",
        "confidence", "assign_batches", "align_responses", "image_relevance", "attach_captions", "infer_event_date", "manifest_rows", "dq_reports",
        "event_overview", "landing_page", "html_meta")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def tools():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, os.path.join(root, "scripts"))
    return importlib.import_module("check_oracles")


@pytest.fixture(scope="module")
def db(tools):
    con = duckdb.connect()
    for t in tools.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_sql(spark, tools, db, key):
    df = tools.entry.queries()[key](spark, SF)
    cur = db.execute(tools.entry.oracle_sql()[key])
    assert tools.table(df.columns, df.collect()) == tools.table([d[0] for d in cur.description], cur.fetchall())


def test_registry(tools):
    queries, oracles = tools.entry.queries(), tools.entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 150


def test_html_meta_of_pages_that_begin_with_a_byline(spark, tools, tmp_path):
    html = ["<p>By Ann Lee</p><p>It fell.</p>", "<title>By By By</title><b>By Ann Lee</b>", "<p>" + "x" * 1185 + "</p><p>- By Ann Lee</p>", "<p></p>", "<p>One</p>"]
    spark.createDataFrame([(5 * i + 2, "u", h) for i, h in enumerate(html)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    df = tools.entry.queries()["html_meta"](spark, str(tmp_path))
    cur = con.execute(tools.entry.oracle_sql()["html_meta"])
    found = tools.table(df.columns, df.collect())
    assert found == tools.table([d[0] for d in cur.description], cur.fetchall())
    assert sum(r[0] is not None for r in found[1]) >= 3


@pytest.mark.parametrize("key", ["page_blocks", "articles", "fetched_articles"])
def test_titles_that_end_in_a_cut_reference(spark, tools, tmp_path, key):
    page = "<html><body><article>\n<h1>{}</h1>\n<p>The climber fell &lt;far&gt; from the upper ridge &amp; died.</p>\n<script>if (a &&b) {{}}</script><p>R&D said the rest of it.</p>\n</article></body></html>"
    rows = [(i, f"https://a.example/{i}", page.format(t)) for i, t in enumerate(["The ridge of snow &amp; ice", "The ridge of snow &amp", "The ridge of snow &am", "The ridge &amp;amp", "Snow and ice &quot"])]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    df = tools.entry.queries()[key](spark, str(tmp_path))
    cur = con.execute(tools.entry.oracle_sql()[key])
    assert tools.table(df.columns, df.collect()) == tools.table([d[0] for d in cur.description], cur.fetchall())


def test_landing_pages_with_many_scripts(spark, tools, tmp_path):
    text = "<p>" + "The climber fell from the ridge. " * 10 + "</p>"
    rows = [(9 * n + 2, f"https://a.example/{n}", text + "<script>let x = 1</script>" * n) for n in (0, 5, 6, 40)] + [(9, "https://a.example/x", text + "<script>let x = 1</script>" * 8)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    df = tools.entry.queries()["landing_page"](spark, str(tmp_path))
    cur = con.execute(tools.entry.oracle_sql()["landing_page"])
    assert tools.table(df.columns, df.collect()) == tools.table([d[0] for d in cur.description], cur.fetchall())
    late = pages.landing_pages(spark.createDataFrame([(1, "u", text + "<script></script>" * n + "<script>window.location = 1</script>") for n in (5, 6)], "page_id long, url string, html string"))
    assert [r.landing_reason for r in late.collect()] == ["js-redirect", None]
