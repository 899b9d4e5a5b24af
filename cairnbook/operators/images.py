"""Image candidates and captions of a page, their score and the filters before a download."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairnbook.constants import (
    IMAGE_URL_IN_TEXT, UPLOAD_IN_TEXT,
    IMAGE_EXTENSION, IRRELEVANT_IMAGE_TOKENS, MIN_IMAGE_BYTES, MIN_IMAGE_HEIGHT, MIN_IMAGE_WIDTH,
    RELEVANT_CAPTION_WORDS, STRAY_HOST_TOKENS, UPLOAD_PATH,
)
from cairnbook.functions import html as H
from cairnbook.functions.strings import (
    any_token, bare_domain, base_name, contains_any, resolve_url, squeeze, strip, url_path,
)
from cairnbook.operators.pages import without_landing_pages

CAPTION = "array<struct<image_url:string,caption_raw:string>>"


def srcset_last(srcset: Column) -> Column:
    """URL of the last (largest) entry of a srcset."""
    entries = F.filter(F.transform(F.split(srcset, ",", -1), strip), lambda p: p != "")
    return F.nullif(F.regexp_extract(F.try_element_at(entries, F.lit(-1)), r"^(\S+)", 1), F.lit(""))


def image_source(src: Column, data_src: Column, lazy: Column, original: Column, srcset: Column,
                 picture: Column | None = None) -> Column:
    """First usable address of an img tag; ``picture`` holds the enclosing picture's sources."""
    own = F.array(src, data_src, lazy, original, srcset_last(srcset))
    tries = own if picture is None else F.concat(own, F.coalesce(picture, F.array().cast("array<string>")))
    return H.first_of(F.filter(tries, lambda c: c.isNotNull() & (c != "") & ~is_stray(c)))


def has_irrelevant_token(c: Column) -> Column:
    return F.coalesce(contains_any(c, IRRELEVANT_IMAGE_TOKENS), F.lit(False))


def is_stray(url: Column) -> Column:
    return url.startswith("data:image") | contains_any(url, STRAY_HOST_TOKENS + IRRELEVANT_IMAGE_TOKENS)


def clean_caption(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, r"(?U)\|\s*Image:[^\n]*$", ""))


def relevance(caption: Column, url: Column) -> Column:
    words = "(?i)(?:" + any_token(RELEVANT_CAPTION_WORDS) + ")"
    points = lambda test, n: F.when(F.coalesce(test, F.lit(False)), n).otherwise(0)
    return (points(caption.rlike(r"(?U)\S"), 5) + points(caption.rlike(words), 10)
            + points(url.rlike("(?i)" + UPLOAD_PATH), 5) + points(url.rlike("(?i)" + IMAGE_EXTENSION), 5))


# --- candidates ------------------------------------------------------------------------

def _filled(e: Column, *names: str) -> Column:
    return F.coalesce(*[F.nullif(H.attr(e, n), F.lit("")) for n in names])


def candidate_urls(parsed: DataFrame) -> DataFrame:
    """Add ``candidates``: distinct absolute image addresses in order of discovery."""
    e, base = F.col("elements"), F.col("url")
    tags = F.transform(H.with_tag(e, "img", "source"), lambda i: F.coalesce(
        _filled(i, "src", "data-src", "data-lazy-src", "data-original"),
        srcset_last(_filled(i, "srcset", "data-srcset", "data-lazy-srcset"))))
    og = H.first_of(F.filter(H.with_tag(e, "meta"), lambda m: H.attr(m, "property") == "og:image"))
    rel = H.first_of(F.filter(H.with_tag(e, "link"), lambda m: F.array_contains(F.split(H.attr(m, "rel"), " "), "image_src")))
    styles = F.transform(F.filter(e, lambda x: H.attr(x, "style").rlike(r"url\([^)]+\)")), lambda x:
                         F.regexp_replace(F.regexp_extract(H.attr(x, "style"), r"url\(([^)]+)\)", 1), "^[\"']+|[\"']+$", ""))
    relative = F.concat(tags, F.array(_filled(og, "content"), _filled(rel, "href")), styles)
    scripts = F.filter(H.with_tag(e, "script"), lambda s: F.coalesce(H.attr(s, "type") == "application/ld+json", F.lit(True)))
    embedded = F.filter(
        F.flatten(F.transform(scripts, lambda s: F.regexp_extract_all(H.script_of(s), F.lit(IMAGE_URL_IN_TEXT), F.lit(0)))),
        lambda u: u.contains("wp-content/uploads") | F.lower(u).rlike(r"\.(jpg|jpeg|png|webp)$"))
    raw = F.regexp_extract_all("html", F.lit(UPLOAD_IN_TEXT), F.lit(0))
    return (parsed
            .withColumn("og_image", _filled(og, "content"))
            .withColumn("candidates", F.array_distinct(F.concat(
                F.transform(F.array_compact(relative), lambda r: resolve_url(base, r)), embedded, raw))))


def _caption_text(e: Column) -> Column:
    return F.nullif(H.text_of(e, F.col("strings"), ""), F.lit(""))


def _inner_caption(elements: Column, outer: Column) -> Column:
    """First figcaption inside an element; null without one."""
    return F.when(outer.isNotNull(), H.first_of(F.filter(H.with_tag(elements, "figcaption"), lambda c: H.inside(c, outer))))


def _struct(**fields: Column) -> Column:
    return F.struct(*[c.alias(k) for k, c in fields.items()])


def _candidate_rows(df: DataFrame) -> DataFrame:
    """Add ``_first``: candidates with the caption of the image tag that shows them.

    Each step adds one fact to the candidate, so nothing is searched twice."""
    e = F.col("elements")
    src = lambda i: H.attr(i, "src")
    df = df.withColumn("_imgs", F.filter(H.with_tag(e, "img"), lambda i: F.length(src(i)) > 0))
    by_url = lambda c: H.first_of(F.filter("_imgs", lambda i: F.contains(c, src(i)) | F.contains(src(i), c)))
    by_name = lambda c: H.first_of(F.filter("_imgs", lambda i: F.contains(src(i), base_name(url_path(c)))))
    df = df.withColumn("_c", F.transform(F.filter("candidates", lambda c: ~is_stray(c)), lambda c: _struct(
        url=c, img=F.coalesce(by_url(c), by_name(c)))))
    df = df.withColumn("_c", F.transform("_c", lambda x: _struct(
        url=x["url"], alt=_filled(x["img"], "alt"), figure=H.ancestor(e, x["img"], "figure"), sibling=H.next_sibling(e, x["img"]))))
    df = df.withColumn("_c", F.transform("_c", lambda x: _struct(
        url=x["url"], alt=x["alt"], sibling=x["sibling"], fig=_inner_caption(e, x["figure"]))))
    near = lambda x: (F.when(x["fig"].isNotNull(), _caption_text(x["fig"]))
                      .when(x["sibling"]["tag"] == "p", _caption_text(x["sibling"])).otherwise(x["alt"]))
    styled = lambda x: _caption_text(H.first_of(F.array_compact(F.transform(
        F.filter(H.with_tag(e, "figure", "div"), lambda f: H.attr(f, "style").contains(x["url"])), lambda f: _inner_caption(e, f)))))
    df = df.withColumn("_c", F.transform("_c", lambda x: _struct(image_url=x["url"], caption_raw=F.coalesce(near(x), styled(x)))))
    relevant = lambda r: F.when(r["caption_raw"].isNotNull(), ~has_irrelevant_token(r["caption_raw"])
                                & ~has_irrelevant_token(base_name(url_path(r["image_url"])))).otherwise(
        ~has_irrelevant_token(r["image_url"]))
    return df.withColumn("_first", F.filter("_c", relevant).cast(CAPTION)).drop("_c", "_imgs")


def _tag_rows(df: DataFrame) -> DataFrame:
    """Add ``_second``: image tags with a caption from their figure, a later paragraph or their alt text."""
    e, base = F.col("elements"), F.col("url")
    df = df.withColumn("_t", F.transform(H.with_tag(e, "img"), lambda i: _struct(
        img=i, figure=H.ancestor(e, i, "figure"), picture=H.ancestor(e, i, "picture"),
        s1=H.next_sibling(e, H.element(e, i["parent"])))))
    df = df.withColumn("_t", F.transform("_t", lambda x: _struct(
        img=x["img"], fig=_inner_caption(e, x["figure"]), s1=x["s1"], s2=H.next_sibling(e, x["s1"]),
        sources=F.filter(H.with_tag(e, "source"), lambda s: H.inside(s, x["picture"])))))

    def address(x: Column) -> Column:
        a = lambda n: H.attr(x["img"], n)
        shown = F.flatten(F.transform(x["sources"], lambda s: F.array_compact(F.array(
            srcset_last(_filled(s, "srcset", "data-srcset")), _filled(s, "src", "data-src")))))
        return image_source(a("src"), a("data-src"), a("data-lazy-src"), a("data-original"),
                            _filled(x["img"], "srcset", "data-srcset", "data-lazy-srcset"), shown)

    paragraph = lambda x: F.coalesce(*[F.when(s["tag"] == "p", s) for s in (x["s1"], x["s2"], H.next_sibling(e, x["s2"]))])
    df = df.withColumn("_t", F.transform("_t", lambda x: _struct(
        own=address(x), alt=_filled(x["img"], "alt"), fig=x["fig"], para=paragraph(x))))
    df = df.withColumn("_t", F.transform("_t", lambda x: _struct(
        image_url=resolve_url(base, F.coalesce(x["own"], F.col("og_image"))), alt=x["alt"],
        caption_raw=F.when(x["fig"].isNotNull(), _caption_text(x["fig"])).otherwise(F.coalesce(_caption_text(x["para"]), x["alt"])))))
    usable = lambda x: (x["image_url"].isNotNull() & x["caption_raw"].isNotNull() & ~is_stray(x["image_url"])
                        & ~has_irrelevant_token(x["alt"]))
    rows = F.transform(F.filter("_t", usable), lambda x: _struct(image_url=x["image_url"], caption_raw=x["caption_raw"]))
    return df.withColumn("_second", rows.cast(CAPTION)).drop("_t")


def captions(parsed: DataFrame) -> DataFrame:
    """Image rows of a page: candidates with their caption, then captioned img tags; one row per address. Landing pages give none."""
    df = _tag_rows(_candidate_rows(candidate_urls(without_landing_pages(parsed))))
    found = df.select("page_id", "url", F.posexplode(F.concat("_first", "_second")).alias("pos", "r"))
    rows = found.select("page_id", "url", "pos", "r.image_url", "r.caption_raw",
                        clean_caption(F.col("r.caption_raw")).alias("caption_clean"), F.lit("html").alias("method"))
    return distinct_images(rows)


def distinct_images(rows: DataFrame) -> DataFrame:
    """First row (by ``pos``) per page and address; combines before the shuffle."""
    kept = [c for c in rows.columns if c not in ("page_id", "image_url")]
    best = F.min_by(F.struct(*kept), F.col("pos")).alias("_r")
    return rows.groupBy("page_id", "image_url").agg(best).select("page_id", "image_url", "_r.*").select(*rows.columns)


def score_images(rows: DataFrame) -> DataFrame:
    """Score, drop stray images and anything below five points."""
    scored = rows.where(~is_stray(F.col("image_url"))).withColumn(
        "score", relevance(F.col("caption_raw"), F.col("image_url")))
    return scored.where(F.col("score") >= 5)


def eligible(rows: DataFrame) -> DataFrame:
    """Keep what is worth a download: own or upload images, others with a caption; known type and size must fit."""
    own = bare_domain(F.col("image_url")) == bare_domain(F.col("page_url"))
    upload = url_path(F.col("image_url")).rlike("(?i)" + UPLOAD_PATH)
    captioned = F.coalesce(F.col("caption_raw").rlike(r"(?U)\S"), F.lit(False))
    right_type = F.coalesce(F.col("content_type").startswith("image"), F.lit(False))
    big_enough = F.coalesce(F.col("content_length") >= MIN_IMAGE_BYTES, F.lit(True))
    return rows.where((own | upload | captioned) & right_type & big_enough)


def large_enough(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("width") >= MIN_IMAGE_WIDTH) & (F.col("height") >= MIN_IMAGE_HEIGHT))


def enrich(rows: DataFrame, analysis: DataFrame) -> DataFrame:
    """Attach per-image analysis results; an image without a local file keeps none."""
    return rows.join(analysis, "local_image_path", "left")


def latest_runs(runs: DataFrame) -> DataFrame:
    return runs.groupBy("domain").agg(F.max("run_ts").alias("run_ts"))


def first_per_page(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` candidates of a page (a limit of the feature).

    Spark's window group limit keeps ``n`` rows per page and task before the shuffle, so a hot page stays small."""
    order = Window.partitionBy("page_id").orderBy("pos", "image_url")
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n")
