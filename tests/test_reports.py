"""Event dates, links, Markdown, manifest, checks, images."""

import pytest
from pyspark.sql import functions as F

from cairnbook.operators import images as I, manifest as M, pages as P, quality as Q, reports as R


@pytest.mark.parametrize("acc,pub,text,expected", [
    (" 2024-01-05 ", "2024-01-07", "x", "2024-01-05"),
    ("", "2024-01-10", "It was Wednesday", "2024-01-10 (approx, inferred from weekday reference)"),
    ("", "2024-01-10T08:00:00", "last thursday", "2024-01-04 (approx, inferred from weekday reference)"),
    ("", "", "on July 23, 2022 they", "2022-07-23"),
    ("", "2024-01-10", "on July 23 they", "2023-07-23 (year inferred)"),
    ("", "10 Jan 2024", "on January 3 they", "2024-01-03 (year inferred)"),
    ("", "", "on July 3 they", "Specific date known (month/day: July 3, year unknown)"),
    ("", "2024-01-10", "back in November", "2023-11 (month inferred)"),
    ("", "", "back in November", "Specific date unknown")])
def test_event_date(spark, acc, pub, text, expected):
    df = spark.createDataFrame([(acc, pub, text)], "a string, p string, t string")
    assert df.select(R.infer_event_date(F.col("a"), F.col("p"), F.col("t")).alias("d")).collect()[0].d == expected


def test_report(spark):
    rows = [("e1", "Mount X", ["https://gripped.com/a"], ["RCMP"], "They fell on July 4, 2023. See https://b.example/x)."),
            ("e2", None, [], [], "")]
    df = spark.createDataFrame(rows, "event_id string, mountain_name string, source_urls array<string>, response_agencies array<string>, article_text string")
    md = {r.event_id: r.markdown for r in R.render_reports(df).collect()}
    assert md["e1"].startswith("---\ntitle: Mount X Incident\ndate_of_event: 2023-07-04\nregion: Mount X\naudience: climbers\nevent_id: e1\n---\n")
    assert "- Gripped: https://gripped.com/a\n- b.example: https://b.example/x\nAgencies: RCMP\n" in md["e1"]
    assert "## Sources" not in md["e2"] and "title: Mountaineering Incident" in md["e2"]
    parsed = M.manifest_rows(R.render_reports(df).select(F.col("event_id").alias("id"), "markdown"))
    assert {r.id: (r.title, r.peak, r.date) for r in parsed.collect()}["e1"] == ("Mount X Incident", "Mount X", "2023-07-04")


def test_splice(spark):
    block = "## Sources\n- n$1\n"
    old = "# T\n## Sources\n- a\n- b\n## Notes\nx"
    df = spark.createDataFrame([(old,), ("# T",), ("# T\n## Sources\n- a",)], "m string")
    got = [r.o for r in df.select(R.splice_sources(F.col("m"), F.lit(block)).alias("o")).collect()]
    assert got == ["# T\n## Sources\n- n$1\n\n## Notes\nx", "# T\n" + block, "# T\n" + block]


def test_front_matter_lines(spark):
    text = "---\ntitle: \"A: b\"\n# comment\nnote: first\n  second\n\tthird\nodd\nkey: 'v'\n---\nBody\n"
    df = M.parse_front_matter(spark.createDataFrame([("a", text), ("b", "no matter"), ("c", "---\nopen: 1\n")], "id string, markdown string"))
    rows = {r.id: r for r in df.collect()}
    last = {p.key: p.value for p in rows["a"].pairs}
    assert last == {"title": "A: b", "note": "second third", "key": "v"} and rows["a"].body == "Body\n"
    assert rows["b"].pairs is None and rows["b"].body == "no matter" and rows["c"].pairs is None


def test_fallback_and_viewer(spark):
    df = spark.createDataFrame([("a", "---\nbroken\n---\n\n* First line\nPeak/Area: Big Peak\nactivity/style - ice"), ("b", ""),
                                ("c", "---\ntitle: None\n---\n<script>x</script>\n\n# Head\n\nA paragraph.")], "id string, markdown string")
    rows = {r.id: r for r in M.fallback_items(df).collect()}
    assert (rows["a"].title, rows["a"].peak, rows["a"].activity) == ("First line", "Big Peak", "ice") and rows["b"].title == "b"
    view = {r.id: r for r in M.viewer_fields(M.parse_front_matter(df)).collect()}
    assert view["c"].title == "Head" and view["c"].summary == "A paragraph." and view["b"].title == "b"


def test_search_and_pages(spark):
    df = spark.createDataFrame([(f"{i:06x}", f"Fall {i}", "climbing" if i % 2 else None) for i in range(45)], "id string, title string, activity string")
    assert M.search(df, " CLIMB ").count() == 22 and M.search(df, "  ").count() == 45
    assert [r.id for r in M.page(df, 3).collect()] == [f"{i:06x}" for i in range(40, 45)]
    assert M.page_count(df).collect()[0].pages == 3 and M.page_count(df.limit(0)).collect()[0].pages == 1
    assert sum(r.n for r in M.manifest_pages(df).select(F.json_array_length("reports").alias("n")).collect()) == 45


def test_checks(spark):
    good = "---\ntitle: T\nevent_id: e1\nregion: r\ndate_of_event: d\n---\n"
    df = spark.createDataFrame([("a", good), ("b", good), ("c", "x"), ("d", "---\ntitle T\ncolor: x\n---\n")], "id string, markdown string")
    got = sorted((r.check, r.id, r.detail) for r in Q.check_reports(df, strict_date=True).collect())
    assert got == [("date_empty", "d", ""), ("duplicate_event_id", "b", "e1"), ("event_id_empty", "d", ""), ("front_matter_missing", "c", ""),
                   ("malformed_line", "d", "title T"), ("missing_key", "d", "event_id"), ("missing_key", "d", "title"),
                   ("region_empty", "d", ""), ("unexpected_key", "d", "color")]
    assert Q.check_count(df, 4).count() == 0 and Q.check_count(df, 5).count() == 1


def test_captions(spark):
    html = ('<figure><a><img src="/media/rescue.jpg"></a><figcaption>Rescue <b>team</b> | Image: X</figcaption></figure>'
            '<img src="logo.png" alt="l"><picture><source srcset="a.webp 1x, b.webp 2x"><img data-src="c.jpg" alt="Peak"></picture>')
    pages = spark.createDataFrame([(1, "https://n.example/s/t", html)], "page_id int, url string, html string")
    rows = {r.image_url: r for r in I.captions(P.with_elements(pages)).collect()}
    assert rows["https://n.example/media/rescue.jpg"].caption_raw == "Rescueteam| Image: X"
    assert rows["https://n.example/media/rescue.jpg"].caption_clean == "Rescueteam"
    assert not any("logo" in u for u in rows)
    assert "https://n.example/s/b.webp" in rows and "https://n.example/s/c.jpg" in rows
    scored = {r.image_url: r.score for r in I.score_images(I.captions(P.with_elements(pages))).collect()}
    assert scored["https://n.example/media/rescue.jpg"] == 25


def test_late_pages_read_between_two_bounds(spark):
    items = spark.range(1000).select(F.format_string("%06d", "id").alias("id"), F.col("id").alias("n"))
    bounds = M.page_bounds(items, 7)
    assert bounds.count() == 143
    for number in (1, 2, 80, 143, 144):
        assert [r.n for r in M.page(items, number, 7, bounds).collect()] == list(range((number - 1) * 7, min(number * 7, 1000)))
    plan = M.page(items, 140, 7, bounds)._jdf.queryExecution().executedPlan().toString()
    assert "offset=973" not in plan and "limit=7" in plan
    assert M.page(items.limit(0), 1).count() == 0


def test_landing_pages_have_no_captions(spark):
    picture = '<figure><img src="/a.jpg"><figcaption>Rescue on the ridge</figcaption></figure>'
    rows = [(1, "https://x.org/1", picture), (2, "https://x.org/2", '<meta http-equiv="refresh" content="0">' + picture)]
    parsed = P.with_elements(spark.createDataFrame(rows, "page_id int, url string, html string"))
    assert {r.page_id for r in I.captions(parsed).collect()} == {1}


def test_front_matter_is_read_once_and_whole(spark):
    texts = [("a", "---x\n --- \nk: 1\n# no\n\n---\nbody\n---\nend"), ("b", "---\n---\n"), ("c", "---\nk: 1"), ("d", ""), ("e", None)]
    df = M.parse_front_matter(spark.createDataFrame(texts, "id string, markdown string"))
    got = {r.id: (None if r.pairs is None else [tuple(p) for p in r.pairs], r.body) for r in df.collect()}
    assert got == {"a": ([("k", "1")], "body\n---\nend"), "b": ([], ""), "c": (None, "---\nk: 1"), "d": (None, ""), "e": (None, None)}
    plan = df.select(M.meta(F.col("pairs"), "k"), M.meta(F.col("pairs"), "l"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
