"""Pages to article text. Input: ``page_id, url, html``; one row per page throughout, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairnbook.constants import (
    PAGE_BYLINE, JS_REDIRECT, REDIRECT_SCRIPTS,
    BLOCK_TAGS, CONTAINER_SELECTORS, LANDING_TOKENS, META_AUTHOR_KEYS, META_DATE_KEYS,
)
from cairnbook.functions import blocks as B, html as H
from cairnbook.functions.dates import iso_date
from cairnbook.functions.strings import (
    first_match, host, none_if_blank, resolve_url, squeeze, strip,
)

WHOLE_PAGE = "struct<pos:int,end:int,kind:string>"


def with_elements(pages: DataFrame, html: str = "html", closed: bool = False) -> DataFrame:
    """Add ``elements``, ``strings`` and ``visible_text``. The one place where markup is read.

    As in HTML a reference without its semicolon (a title cut to end in ``&amp``) is read; with ``closed`` it stays as written."""
    parsed = pages.withColumn("_page", H.parse_html(F.col(html), closed))
    return (parsed.withColumn("elements", F.col("_page.elements")).withColumn("strings", F.col("_page.strings"))
            .withColumn("visible_text", F.array_join("_page.strings", " ")).drop("_page"))


def _selector_rank(e: Column) -> Column:
    rank = F.lit(None).cast("int")
    for i, (tag, key, value) in reversed(list(enumerate(CONTAINER_SELECTORS))):
        hit = e["tag"] == tag
        if key == "class":
            hit = hit & F.coalesce(F.array_contains(F.split(H.attr(e, "class"), r"\s+", -1), value), F.lit(False))
        elif key == "id":
            hit = hit & F.coalesce(H.attr(e, "id") == value, F.lit(False))
        rank = F.when(hit, F.lit(i)).otherwise(rank)
    return rank


def _paragraphs(elements: Column, strings: Column) -> Column:
    return F.transform(H.with_tag(elements, "p"), lambda p: F.struct(
        p["pos"].alias("pos"), F.length(H.text_of(p, strings)).alias("n")))


def container(elements: Column, paras: Column) -> Column:
    """Article element: best selector, else the section with most paragraph text (> 200), else the body.

    ``paras`` is the ``_paragraphs`` column; as a column it is not computed anew inside the lambda."""
    ranked = F.filter(
        F.transform(elements, lambda e: F.struct(
            _selector_rank(e).alias("rank"), e["pos"].alias("pos"), e["end"].alias("end"), e["tag"].alias("kind"))),
        lambda r: r["rank"].isNotNull())
    selected = F.array_min(ranked)
    weighed = F.transform(H.with_tag(elements, "article", "section", "div"), lambda e: F.struct(
        F.aggregate(F.filter(paras, lambda p: H.inside(p, e)), F.lit(0), lambda s, p: s + p["n"]).alias("n"),
        (-e["pos"]).alias("order"), e["end"].alias("end"), e["tag"].alias("kind")))
    heaviest = F.array_max(weighed)
    body = H.first_of(H.with_tag(elements, "body"))

    def area(pos: Column, end: Column, kind: Column) -> Column:
        return F.struct(pos.cast("int").alias("pos"), end.cast("int").alias("end"), kind.alias("kind"))

    return (
        F.when(selected.isNotNull(), area(selected["pos"], selected["end"], selected["kind"]))
        .when(heaviest["n"] > 200, area(-heaviest["order"], heaviest["end"], heaviest["kind"]))
        .when(body.isNotNull(), area(body["pos"], body["end"], F.lit("body")))
        .otherwise(area(F.lit(0), F.size(elements) + 1, F.lit("document")))
    )


def _blocks(elements: Column, strings: Column, keep) -> Column:
    found = F.filter(elements, lambda e: e["tag"].isin(*BLOCK_TAGS) & keep(e))
    return F.transform(found, lambda e: F.struct(
        e["pos"].alias("pos"), e["tag"].alias("tag"), H.text_of(e, strings).alias("text")))


def page_blocks(parsed: DataFrame) -> DataFrame:
    """Add ``container``, its ``blocks`` and the document's headings."""
    out = (parsed.withColumn("_paras", _paragraphs(F.col("elements"), F.col("strings")))
           .withColumn("container", container(F.col("elements"), F.col("_paras"))).drop("_paras"))
    return (out
            .withColumn("blocks", _blocks(F.col("elements"), F.col("strings"), lambda e: H.inside(e, F.col("container"))))
            .withColumn("headings", _blocks(F.col("elements"), F.col("strings"), lambda e: e["tag"].isin("h1", "h2"))))


def article_texts(paged: DataFrame, alternative: Column | None = None, alternative_focused: Column | None = None) -> DataFrame:
    """Full and focused text of each page from ``blocks`` and ``headings``.

    ``alternative`` is another reading of the page: when the full text is short and it is longer, it replaces the full
    text, and ``alternative_focused`` (itself, if not given) the focused one."""
    usable = B.distinct_blocks(B.without_boilerplate(B.before_comments(B.long_enough(F.col("texts")))))
    out = (paged
           .withColumn("title", B.page_title(F.col("blocks"), F.col("headings")))
           .withColumn("texts", F.transform("blocks", lambda b: b["text"]))
           .withColumn("texts", usable)
           .withColumn("full_text", B.assemble(
               F.coalesce(F.col("title"), F.lit("")), B.until_last_substantive(B.second_filter(F.col("texts")))))
           .withColumn("full_text", B.cut_after_email(F.col("full_text")))
           .withColumn("full_text", squeeze(B.trim_tail_run(F.col("full_text"))))
           .withColumn("focused_text", B.clean_focus(B.focus_window(F.col("texts")))))
    if alternative is not None:
        longer = B.is_longer(F.col("full_text"), alternative)
        focused = alternative if alternative_focused is None else alternative_focused
        out = out.withColumns({"full_text": F.when(longer, alternative).otherwise(F.col("full_text")),
                               "focused_text": F.when(longer, focused).otherwise(F.col("focused_text"))})
    return out


def articles(pages: DataFrame, closed: bool = False) -> DataFrame:
    """Pages to ``page_id, url, title, full_text, focused_text``. Columns ``alternative_full`` and ``alternative_focused``,
    if ``pages`` has them, are another reading of the page, see ``article_texts``; ``closed`` as in ``with_elements``."""
    paged = page_blocks(with_elements(pages, closed=closed))
    other = [F.col(c) if c in pages.columns else None for c in ("alternative_full", "alternative_focused")]
    return article_texts(paged, *other).select("page_id", "url", "title", "full_text", "focused_text")


# --- page variants ------------------------------------------------------------------

def amp_urls(url: Column, amp_link: Column | None = None) -> Column:
    """Alternative addresses worth fetching for a blocked page, in the order they are tried."""
    bare = F.regexp_replace(url, r"/+$", "")
    guesses = F.array_compact(F.array(
        F.when(~bare.endswith("/amp"), F.concat(bare, F.lit("/amp"))),
        F.when(~url.contains("?outputType=amp"), F.concat(
            url, F.when(url.contains("?"), F.lit("&")).otherwise(F.lit("?")), F.lit("outputType=amp")))))
    if amp_link is None:
        return guesses
    return F.when(amp_link.isNotNull(), F.array(resolve_url(url, amp_link))).otherwise(guesses)


def amp_link(elements: Column) -> Column:
    links = F.filter(H.with_tag(elements, "link"), lambda e: H.attr(e, "rel").contains("amphtml"))
    return F.nullif(H.attr(H.first_of(links), "href"), F.lit(""))


def best_variant(variants: DataFrame) -> DataFrame:
    """``page_id, rank, html`` with rank 0 the original: the first variant, by rank, longer than the original wins.

    Gives one row per page, with the rank that won. The pick is made on ranks and lengths; the page's text is fetched by the winning rank."""
    size = F.coalesce(F.length("html"), F.lit(0))
    # Only ranks and lengths are aggregated and shuffled; a rank that repeats goes by its longest text.
    sizes = variants.groupBy("page_id", "rank").agg(F.max(size).alias("size"))
    original = F.max(F.when(F.col("rank") == 0, F.col("size")))
    ranked = sizes.groupBy("page_id").agg(F.coalesce(original, F.lit(0)).alias("own"), F.min("rank").alias("_"))
    longer = (sizes.where("rank > 0").join(ranked.select("page_id", "own"), "page_id").where("size > own").groupBy("page_id").agg(F.min("rank").alias("best")))
    picked = ranked.select("page_id").join(longer, "page_id", "left").select("page_id", F.coalesce("best", F.lit(0)).alias("rank"))
    chosen = picked.join(sizes, ["page_id", "rank"], "left")
    texts = variants.select("page_id", "rank", size.alias("size"), "html").join(chosen.where("size IS NOT NULL"), ["page_id", "rank", "size"], "left_semi")
    order = Window.partitionBy("page_id", "rank", "size").orderBy(F.desc("html"))
    one = texts.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("page_id", "html")
    return picked.join(one, "page_id", "left")


def fetched_articles(pages: DataFrame, fetched: DataFrame, closed: bool = False) -> DataFrame:
    """``articles`` of pages, where a blocked page gives way to the first of its variants that is longer.

    ``pages`` has ``page_id, url, html`` and, if known, the answer's ``status``; ``fetched`` has the answers ``url, html`` of
    alternative addresses. A blocked page without an answer that is longer stays as it is; one that is replaced carries the
    address of its variant. Only blocked pages and the variants of their addresses are shuffled before the pick."""
    parsed = with_elements(pages, closed=closed)
    status = F.col("status") if "status" in pages.columns else None
    blocked = (parsed.where(B.blocked_page(F.col("visible_text"), status))
               .select("page_id", "html", F.posexplode(amp_urls(F.col("url"), amp_link(F.col("elements")))).alias("rank", "url")))
    tries = blocked.select("page_id", (F.col("rank") + 1).alias("rank"), "url")
    own = blocked.where("rank = 0").select("page_id", F.lit(0).alias("rank"), "html")
    answers = tries.join(fetched.select("url", "html"), "url").select("page_id", "rank", "html")
    won = best_variant(own.unionByName(answers)).where("rank > 0").join(tries, ["page_id", "rank"])
    won = won.select("page_id", F.col("url").alias("won_url"), F.col("html").alias("won_html"))
    mended = pages.join(won, "page_id", "left")
    return articles(mended.withColumns({c: F.coalesce(f"won_{c}", c) for c in ("url", "html")}).drop("won_url", "won_html"), closed)


# --- landing pages --------------------------------------------------------------------

def landing_features(parsed: DataFrame, near_top: int | None = REDIRECT_SCRIPTS) -> DataFrame:
    """What ``landing_reason`` looks at. A redirect is looked for in the ``near_top`` first scripts (the rule), in all of them if None."""
    scripts = H.with_tag(F.col("elements"), "script")
    top = scripts if near_top is None else F.slice(scripts, 1, near_top)
    page_host = F.coalesce(host(F.col("url")), F.lit(""))
    hosts = F.filter(F.transform(scripts, lambda s: first_match(H.attr(s, "src"), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]+)")),
                     lambda h: h.isNotNull() & ~F.contains(page_host, h))
    return parsed.select(
        "*",
        F.exists(H.with_tag(F.col("elements"), "meta"),
                 lambda m: F.coalesce(F.lower(H.attr(m, "http-equiv")) == "refresh", F.lit(False))).alias("meta_refresh"),
        F.array_join(F.transform(top, H.script_of), " ").alias("top_scripts"),
        F.size(H.with_tag(F.col("elements"), "img")).alias("img_count"),
        F.size(H.with_tag(F.col("elements"), "iframe")).alias("iframe_count"),
        F.size(hosts).alias("third_party_scripts"),
    )


def landing_reason(df: DataFrame) -> Column:
    """Why a page looks like a landing page; null for an article."""
    text = F.lower(F.col("visible_text"))
    token = F.coalesce(*[F.when(text.contains(t), F.lit(f"landing-token:{t}")) for t in LANDING_TOKENS])
    moved = F.lit(False)
    if {"first_url", "final_url"} <= set(df.columns):
        moved = F.coalesce(host(F.col("first_url")) != host(F.col("final_url")), F.lit(False))
    return (
        F.when(F.col("meta_refresh"), "meta-refresh")
        .when(F.col("top_scripts").rlike(JS_REDIRECT), "js-redirect")
        .when(moved, "redirect-chain")
        .when((F.length("visible_text") < 200) & (F.col("img_count") > 8), "low-text-many-images")
        .when(token.isNotNull(), token)
        .when(F.col("iframe_count") > 6, "many-iframes")
        .when(F.col("third_party_scripts") > 10, "many-third-party-scripts")
    )


def landing_pages(pages: DataFrame, near_top: int | None = REDIRECT_SCRIPTS) -> DataFrame:
    featured = landing_features(with_elements(pages), near_top)
    reason = landing_reason(featured)
    return featured.withColumn("landing_reason", reason).withColumn("is_landing", reason.isNotNull())


def without_landing_pages(parsed: DataFrame) -> DataFrame:
    """The pages that do not look like landing pages, with the columns they came with; row by row."""
    featured = landing_features(parsed)
    return featured.where(landing_reason(featured).isNull()).select(*parsed.columns)


# --- html metadata -----------------------------------------------------------------------

def _json_ld_objects(elements: Column) -> Column:
    scripts = F.filter(H.with_tag(elements, "script"),
                       lambda s: F.lower(H.attr(s, "type")).contains("ld+json"))
    parsed = F.transform(scripts, lambda s: F.try_parse_json(H.script_of(s)))
    lists = F.transform(parsed, lambda v: F.coalesce(
        F.try_variant_get(v, "$", "array<variant>"), F.when(v.isNotNull(), F.array(v))))
    kind = lambda o: F.lower(F.try_variant_get(o, "$['@type']", "string"))
    return F.filter(F.flatten(F.array_compact(lists)),
                    lambda o: F.coalesce(kind(o).contains("article") | kind(o).contains("report"), F.lit(False)))


def _json_ld_author(o: Column) -> Column:
    text = lambda v: F.when(F.schema_of_variant(v) == "STRING", v.cast("string"))
    author = F.try_variant_get(o, "$.author", "variant")
    many = F.transform(F.try_variant_get(o, "$.author", "array<variant>"),
                       lambda a: F.coalesce(F.try_variant_get(a, "$.name", "string"), text(a)))
    return F.coalesce(
        F.try_variant_get(o, "$.author.name", "string"), F.try_variant_get(o, "$.author['@name']", "string"),
        F.nullif(F.array_join(F.array_compact(many), ", "), F.lit("")), text(author))


def _first_value(values: Column) -> Column:
    return H.first_of(F.filter(values, lambda v: v.isNotNull() & (v != "")))


def html_meta(parsed: DataFrame) -> DataFrame:
    """Author and ISO date: JSON-LD before meta tags before ``time`` before a byline."""
    e = F.col("elements")
    name = lambda m: F.lower(F.coalesce(F.nullif(H.attr(m, "name"), F.lit("")), H.attr(m, "property"), F.lit("")))
    metas = H.with_tag(e, "meta")
    ld = _json_ld_objects(e)
    ld_date = lambda o: iso_date(F.coalesce(
        F.try_variant_get(o, "$.datePublished", "string"), F.try_variant_get(o, "$.dateCreated", "string")))
    meta_author = F.transform(F.filter(metas, lambda m: name(m).isin(*META_AUTHOR_KEYS)),
                              lambda m: strip(H.attr(m, "content")))
    meta_date = F.transform(F.filter(metas, lambda m: name(m).isin(*META_DATE_KEYS)),
                            lambda m: iso_date(H.attr(m, "content")))
    clock = H.first_of(H.with_tag(e, "time"))
    clock_attr = F.coalesce(F.nullif(H.attr(clock, "datetime"), F.lit("")), H.attr(clock, "content"))
    byline = strip(first_match(F.substring("visible_text", 1, 1200), PAGE_BYLINE))
    return parsed.select(
        "*",
        F.coalesce(_first_value(F.transform(ld, _json_ld_author)), _first_value(meta_author), byline).alias("html_author"),
        F.coalesce(_first_value(F.transform(ld, ld_date)), _first_value(meta_date),
                   iso_date(clock_attr), iso_date(H.text_of(clock, F.col("strings")))).alias("html_date"),
    )


def meta_precedence(df: DataFrame, mode: str = "batch") -> DataFrame:
    """Final author and date from ``model_*``, ``text_*`` and ``html_*`` columns.

    ``batch``: the model's value wins. ``single``: a found author replaces the model's."""
    found = lambda k: F.coalesce(none_if_blank(F.col(f"text_{k}")), none_if_blank(F.col(f"html_{k}")))
    author = F.coalesce(F.col("model_author"), found("author"))
    if mode == "single":
        author = F.coalesce(found("author"), F.col("model_author"))
    elif mode != "batch":
        raise ValueError(f"unknown mode {mode!r}")
    return (df.withColumn("report_author", author)
            .withColumn("article_date_published", F.coalesce(F.col("model_date"), found("date"))))
