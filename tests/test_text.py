"""Text, date, block and extraction rules."""

import re

import pytest
from pyspark.sql import functions as F

from cairnbook.constants import GAZETTEER
from cairnbook.functions import blocks as B, dates as D, extract as X, strings as S
from cairnbook.functions.html_tokens import page_elements
from cairnbook.operators import bloom, pages as P, places
from cairnbook.operators.extraction import pre_extract


def one(spark, value, make, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(make(F.col("x")).alias("y")).collect()[0]["y"]


@pytest.mark.parametrize("said,iso", [
    ("2025-10-01", "2025-10-01"), ("Oct 1, 2025", "2025-10-01"), ("1 October 2025", "2025-10-01"), ("n/a", None),
    ("2025-10-01Z", "2025-10-01"), ("2025-10-01T23:30:00-05:00", "2025-10-01"), ("2024/02/03", "2024-02-03"),
    ("Sept. 9, 2024", "2024-09-09"), ("10/02/24", "2024-10-02"), ("23-04-2021", "2021-04-23"), ("May 5", None),
    ("2024-13-01", None), ("2024-02-30", None)])
def test_iso_date(spark, said, iso):
    assert one(spark, said, D.iso_date) == iso


def test_byline_and_publication_date(spark):
    text = ("By Jane Doe and John Smith | Published: Oct 3, 2025 Updated: Oct 4, 2025 "
            "Climber survived fall. Further details pending.")
    assert one(spark, text, X.report_author) == "Jane Doe"
    assert one(spark, text, X.publication_date) == "2025-10-03"
    assert one(spark, "Published 2025-09-30 Incident details follow.", X.publication_date) == "2025-09-30"
    assert one(spark, "By AP, a wire story", X.report_author) is None


def test_hints_of_a_sentence(spark):
    row = pre_extract(spark.createDataFrame([("Climber, 28, fell 100 feet. SAR responded.",)], "text string")).collect()[0]
    assert (row.fall_height_feet_pre, row.fall_height_meters_pre) == (100, 30.5)
    assert row.rescue_teams_pre == ["SAR"]
    assert row.people_pre is None and row.pre_dates is None
    assert row.lead_sentences == ["Climber, 28, fell 100 feet.", "SAR responded."]


def test_hints_rules(spark):
    text = ("On July 4, 2023 Alan Reed, 28 and Bo Van Dyke, 31 met a 41-year-old woman near Mount Rainier. "
            "Three people died; 2 injured, 5 hurt. Killed 9. They climbed 5.10a, class 4, V3 and Grade V on the ridge route "
            "with rope in Garibaldi Provincial Park. It is 45 degrees and NE facing.")
    row = pre_extract(spark.createDataFrame([(text,), ("",), (None,)], "text string"), names=GAZETTEER).collect()
    r = row[0]
    assert r.pre_dates == ["July 4, 2023"]
    assert [(p.name, p.age, p.sex) for p in r.people_pre] == [
        ("Alan Reed", 28, None), ("Bo Van Dyke", 31, None), ("Unknown", 41, "female")]
    assert (r.num_fatalities_pre, r.num_injured_pre) == (3, 5)
    assert r.area_pre == "Garibaldi Provincial"  # the shortest run up to a closing word
    assert r.gazetteer_matches == ["Garibaldi Provincial Park", "Mount Rainier"]
    assert r.route_difficulty_pre == ["5.10a", "class 4", "V3", "Grade V"]
    assert r.route_types_pre == ["ridge", "route"] and r.equipment_pre == ["rope"]
    assert r.slope_angle_deg_pre == 45.0 and r.aspect_cardinal_pre == "NE"
    assert all(v is None for v in row[1]) and all(v is None for v in row[2])


def test_aspect_modes(spark):
    assert one(spark, "the climber's rope", X.aspect) == "S"
    assert one(spark, "the climber's rope", lambda c: X.aspect(c, strict=True)) is None
    assert one(spark, "a NW-facing wall", lambda c: X.aspect(c, strict=True)) == "NW"
    assert one(spark, "killed 4 there", lambda c: X.fatalities(c, reversed_order=True)) == 4
    assert one(spark, "killed 4 there", X.fatalities) is None


def test_block_rules(spark):
    long = "x" * 40
    texts = ["short", long, "Related: " + long, "by Jane Doe " + long, "Subscribe now " + long, long, "Comments below " + long, "after " + long]
    run = lambda rule: one(spark, texts, rule, "array<string>")
    assert len(run(B.long_enough)) == 7
    assert run(B.before_comments) == texts[:6]
    assert "Subscribe now " + long not in run(B.without_boilerplate)
    assert run(B.distinct_blocks) == texts[:5] + texts[6:]
    assert "Related: " + long not in run(B.second_filter) and "by Jane Doe " + long in run(B.second_filter)
    found = ["a", "he fell", "b", "body found", "c"]
    assert one(spark, found, B.until_last_substantive, "array<string>") == found[:4]
    assert one(spark, ["a", "b"], B.until_last_substantive, "array<string>") == ["a", "b"]
    many = [f"b{i}" for i in range(12)]
    many[4] = "RCMP came"
    assert one(spark, many, B.focus_window, "array<string>") == many[3:10]
    many[0] = "he died"
    assert one(spark, many, B.focus_window, "array<string>") == many[0:6]


def test_text_cuts(spark):
    assert one(spark, "One.\n\nMail a.b@c.org now\n\nTwo.", B.cut_after_email) == "One.\n\nMail a.b@c.org"
    assert one(spark, "One.\n\nHe fell.\n\nTwo.", B.cut_after_email) == "One.\n\nHe fell."
    body = " ".join(["word"] * 13)
    assert one(spark, f"{body}\n\na\n\nb\n\nc", B.trim_tail_run) == body
    assert one(spark, f"{body}\n\na\n\nb", B.trim_tail_run) == f"{body}\n\na\n\nb"
    joined = one(spark, ["first", "By signing up you agree.", "last"], lambda t: B.assemble(F.lit("Head"), t), "array<string>")
    assert joined == "Head\n\nfirst\n\nlast"


PAGE = """<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><nav><li>menu</li></nav>
<div class="box entry-content"><h1>Climber rescued on peak</h1><p>First paragraph with <b>bold</b> text about the long rescue.</p>
<p>Open paragraph <i>one<p>inner paragraph that is closed, long enough to keep</p></div><p>outside</p></body></html>"""


def test_page_parse_and_container(spark):
    pages = spark.createDataFrame([(1, "https://a.example/x", PAGE)], "page_id int, url string, html string")
    row = P.page_blocks(P.with_elements(pages)).collect()[0]
    assert row.container.kind == "div"
    assert [(b.tag, b.text) for b in row.blocks] == [
        ("h1", "Climber rescued on peak"), ("p", "First paragraph with bold text about the long rescue."),
        ("p", "Open paragraph one inner paragraph that is closed, long enough to keep"),
        ("p", "inner paragraph that is closed, long enough to keep")]
    art = P.articles(pages).collect()[0]
    assert art.title == "Climber rescued on peak"
    assert art.focused_text.startswith("First paragraph with bold text")


def test_container_fallbacks(spark):
    para = "<p>" + "y" * 120 + "</p>"
    html = [f"<body><section><p>short</p></section><div>{para}{para}</div></body>", "<body><div><p>tiny</p></div></body>", "<p>bare</p>"]
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate(html)], "page_id int, url string, html string")
    kinds = {r.page_id: r.container.kind for r in P.page_blocks(P.with_elements(pages)).collect()}
    assert kinds == {0: "div", 1: "body", 2: "document"}


def test_interval_encoding_against_brute_force():
    """Every element's interval holds exactly the elements opened before it is closed."""
    elements = page_elements(PAGE)["elements"]
    assert [e["pos"] for e in elements] == list(range(1, len(elements) + 1))
    for e in elements:
        parents = {x["pos"]: x["parent"] for x in elements}
        for other in elements:
            up, chain = parents[other["pos"]], []
            while up:
                chain.append(up)
                up = parents[up]
            assert (e["pos"] < other["pos"] < e["end"]) == (e["pos"] in chain)


@pytest.mark.parametrize("html,author,date", [
    ('<html><head><meta name="author" content="Jane Doe" /><meta property="article:published_time" content="2025-10-02T14:30:00Z" />'
     "</head><body><article><p>Body text here.</p></article></body></html>", "Jane Doe", "2025-10-02"),
    ('<html><body><time datetime="2025-09-28">September 28, 2025</time><p>Story body</p></body></html>', None, "2025-09-28"),
    ('<html><head><script type="application/ld+json">{"@type": "NewsArticle", "author": {"@type": "Person", "name": "Staff Writer"}, '
     '"datePublished": "2025-09-30T11:12:00-05:00"}</script></head><body><p>Some content</p></body></html>', "Staff Writer", "2025-09-30")])
def test_html_meta(spark, html, author, date):
    pages = spark.createDataFrame([(1, "u", html)], "page_id int, url string, html string")
    row = P.html_meta(P.with_elements(pages)).collect()[0]
    assert (row.html_author, row.html_date) == (author, date)


def test_places_agree_with_brute_force(spark):
    names = ["R&D", "&", "#", "Mount Rainier", "Rain", "North Cascades", "Lake O'Hara Lodge Road", "North Cascades National Park", "Été Blanc"]
    texts = {1: "near mount RAINIER today", 2: "North Cascades National Park, rain", 3: "the Lake O'Hara Lodge Road is open", 4: "un été blanc", 5: "", 6: "R&D team", 7: "a & b # c"}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    nm = spark.createDataFrame([(n,) for n in names], "name string")
    expected = sorted((d, n) for d, t in texts.items() for n in names if re.search(rf"\b{re.escape(n)}\b", t, re.I))
    assert sorted((r.doc_id, r.name) for r in places.match_places(df, nm).collect()) == expected


def test_url_functions(spark):
    f = lambda base, ref: one(spark, ref, lambda r: S.resolve_url(F.lit(base), r))
    assert f("https://a.example/x/y?q=1", "img.png") == "https://a.example/x/img.png"
    assert f("https://a.example/x/y", "/img.png") == "https://a.example/img.png"
    assert f("https://a.example", "//cdn.example/i.png") == "https://cdn.example/i.png"
    assert f("https://a.example/x", "http://b.example/i.png") == "http://b.example/i.png"
    assert one(spark, "https://www.gripped.com/a", S.publisher_label) == "Gripped"
    assert one(spark, "nonsense", S.third_segment) == ""
    assert one(spark, "/srv/site/a.json", lambda c: S.relative_path(c, "/srv/site")) == "/a.json"


def test_addresses_equal_urljoin(spark):
    from urllib.parse import urljoin

    from cairnbook.functions.strings import resolve_url
    bases = ["https://h.example/a/b/c.html?q=1#f", "https://h.example/a/b/", "https://h.example", "http://h.example/x"]
    refs = ["../i.jpg", "./i.jpg", "../../../i.jpg", "d/../i.jpg?x=../y", "/p/./q/../i.jpg", "..", ".", "a//b.jpg", "/a//b.jpg", "i.jpg#z/..", "?n=2", "#top", "//o.example/../i", "https://o.example/a/../i", "../", "/.."]
    df = spark.createDataFrame([(b, r) for b in bases for r in refs if (b, r[:1]) != ("https://h.example", "?")], "b string, r string")
    for row in df.select("b", "r", resolve_url(F.col("b"), F.col("r")).alias("u")).collect():
        assert row.u == urljoin(row.b, row.r), row


def test_tokeniser_is_linear_on_unclosed_elements(spark):
    import time

    from cairnbook.functions.html_tokens import page_elements
    page = lambda n: "<ul>" + "<li>item </b>" * n + "</ul> tail"
    seconds = []
    for n in (25_000, 100_000):
        t = time.perf_counter()
        found = page_elements(page(n))
        seconds.append(time.perf_counter() - t)
        assert len(found["elements"]) == n + 1 and len(found["strings"]) == n + 1
    assert found["elements"][-1]["first"] == found["elements"][-1]["last"] == 100_000 and found["elements"][1]["last"] == 100_000
    assert seconds[1] < 12 * seconds[0] + 0.5


def test_element_texts_skip_hidden_parts(spark):
    from cairnbook.functions import html as H
    from cairnbook.operators import pages as P
    html = "<p>one <b>two</b><script>var x = '</p>';</script> three<p>four</p> five</p><style>p{}</style><script type='a'>code</script>"
    rows = P.with_elements(spark.createDataFrame([(1, html)], "page_id int, html string"))
    got = rows.select(F.transform("elements", lambda e: F.struct(e["tag"], H.text_of(e, F.col("strings")), H.script_of(e))).alias("x"), "visible_text").first()
    assert [tuple(e) for e in got.x] == [("p", "one two three four five", ""), ("b", "two", ""), ("script", "", "var x = '</p>';"), ("p", "four", ""), ("style", "", ""), ("script", "", "code")]
    assert got.visible_text == "one two three four five"


def test_a_longer_reading_replaces_both_texts_of_a_short_page(spark):
    body = "<html><body><article><h1>A climber on the ridge</h1><p>The climber was rescued from the ridge at noon.</p></article></body></html>"
    rows = [(1, "u", body, "x" * 900, "focus"), (2, "u", body, "short", "focus"), (3, "u", body, None, "focus"), (4, "u", "", "only this reading", None)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, alternative_full string, alternative_focused string")
    got = {r.page_id: (r.full_text, r.focused_text) for r in P.articles(pages).collect()}
    plain = P.articles(pages.drop("alternative_full", "alternative_focused")).where("page_id = 2").first()
    assert got[1] == ("x" * 900, "focus")
    assert got[2] == got[3] == (plain.full_text, plain.focused_text) and "rescued" in plain.full_text
    assert got[4] == ("only this reading", None)


def test_bloom_filter_holds_every_key_and_few_others(spark):
    keys = spark.range(3000)
    bits = bloom.bits_for(3000)
    words = bloom.build(keys, F.xxhash64("id"), bits)
    passed = spark.range(30000).where(bloom.may_hold(words, F.xxhash64("id"), bits))
    own, foreign = passed.where("id < 3000").count(), passed.where("id >= 3000").count()
    assert own == 3000 and foreign < 0.04 * 27000
    none = bloom.build(keys.limit(0), F.xxhash64("id"), bloom.bits_for(0))
    assert keys.where(bloom.may_hold(none, F.xxhash64("id"), bloom.bits_for(0))).count() == 0
    assert bloom.bits_for(1 << 40) == 1 << bloom.MOST


def test_runs_that_no_name_has_never_become_rows(spark):
    texts = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(2000)) + " Mount Rainier"), (2, None), (3, ""), (4, "near mount rainier, a&b more")], "doc_id long, text string")
    names = spark.createDataFrame([("Mount Rainier",), ("&",), (None,), ("",), ("Lake Louise Ski Area",)], "name string")
    found = {(r.doc_id, r.name) for r in places.match_places(texts, names).collect()}
    assert found == {(1, "Mount Rainier"), (4, "Mount Rainier"), (4, "&")}
    keyed = spark.createDataFrame([("mount rainier",)], "gram string")
    runs = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.array_join(F.slice("w", i, 2), " "))
    offered = places.offered_runs(texts.where("doc_id = 1"), keyed, [runs], bloom.bits_for(1))
    assert offered.where("gram = 'mount rainier'").count() == 1 and offered.count() < 20


def test_articles_of_blocked_pages_come_from_the_first_longer_variant(spark):
    text = "A climber fell on the north face on Sunday and was found by a rescue team the next morning. " * 2
    page = lambda t: f"<html><body><article><p>{t}</p></article></body></html>"
    pages = spark.createDataFrame([
        (1, "http://a.example/x", page(text + "open"), 200), (2, "http://a.example/y", "<p>Access denied</p>", 200),
        (3, "http://a.example/z", page(text + "status"), 403), (4, "http://a.example/none", "<p>short</p>", 200), (5, None, None, None)],
        "page_id long, url string, html string, status int")
    fetched = spark.createDataFrame([
        ("http://a.example/x/amp", page(text * 9)), ("http://a.example/y/amp", "<p>no</p>"), ("http://a.example/y?outputType=amp", page(text + "second")),
        ("http://a.example/z/amp", page(text + "third, longer than before")), ("http://a.example/z/amp", page(text)), (None, "x" * 999)], "url string, html string")
    got = {r.page_id: (r.url, r.full_text) for r in P.fetched_articles(pages, fetched).collect()}
    assert len(got) == 5
    assert got[1][0] == "http://a.example/x" and got[1][1].endswith("open")
    assert got[2][0] == "http://a.example/y?outputType=amp" and got[2][1].endswith("second")
    assert got[3][0] == "http://a.example/z/amp" and got[3][1].endswith("longer than before")
    assert got[4] == ("http://a.example/none", "") and got[5][0] is None
    assert P.fetched_articles(pages.limit(0), fetched).count() == 0


def test_pages_leave_a_batch_in_pieces(spark, monkeypatch):
    import pyarrow as pa

    from cairnbook.functions import html_tokens as T
    monkeypatch.setattr(T, "PIECE", 20)
    pages = ["<p>one</p>", None, "<p>two</p>" * 3, "", "<h1>end</h1>"]
    pieces = list(T.page_batches(iter([pa.array(pages), pa.array([], "string")])))
    assert len(pieces) > 2 and sum(map(len, pieces)) == len(pages)
    assert [p["strings"] if p else None for piece in pieces for p in piece.to_pylist()] == [["one"], None, ["two"] * 3, [], ["end"]]
