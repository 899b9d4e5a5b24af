"""Text, url and hash expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from cairnbook.constants import PUBLISHER_LABELS


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def none_if_blank(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group; null when the pattern does not match (or the group is empty)."""
    found = F.regexp_extract(c, pattern, group)
    return F.when(found != "", found)


def all_matches(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def any_token(tokens: Iterable[str]) -> str:
    """Alternation of literal tokens, to be used with ``rlike``."""
    return "|".join(re.escape(t) for t in tokens)


def contains_any(c: Column, tokens: Iterable[str]) -> Column:
    """Case-insensitive substring test against a token list (one pass over the text)."""
    return F.lower(c).rlike(any_token(t.lower() for t in tokens))


def starts_with_any(c: Column, prefixes: Iterable[str]) -> Column:
    return F.lower(c).rlike("^(?:" + any_token(p.lower() for p in prefixes) + ")")


def whole_word(words: Iterable[str]) -> str:
    return r"(?iU)\b(?:" + any_token(words) + r")\b"


def slug(c: Column) -> Column:
    return F.regexp_replace(c, "[^a-zA-Z0-9_-]", "_")


def short_md5(c: Column, n: int = 10) -> Column:
    return F.substring(F.md5(c), 1, n)


def host(url: Column) -> Column:
    """Authority part of a url, lower case kept as written."""
    return first_match(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)")


def bare_domain(url: Column) -> Column:
    return F.replace(text_or_empty(host(url)), F.lit("www."), F.lit(""))


def third_segment(url: Column) -> Column:
    """``scheme://host/..`` split on slashes, third piece; empty when there is none."""
    return F.coalesce(F.try_element_at(F.split(url, "/", -1), F.lit(3)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def _without_dots(segments: Column) -> Column:
    """Path from its segments: ``.`` says nothing, ``..`` takes the segment before it away."""
    none = F.array().cast("array<string>")
    walked = F.aggregate(segments, none, lambda seen, x: F.when(x == "..", F.slice(seen, F.lit(1), F.greatest(F.size(seen) - 1, F.lit(0))))
                         .when(x == ".", seen).otherwise(F.concat(seen, F.array(x))))
    folder = F.element_at(segments, -1).isin(".", "..")
    path = F.array_join(F.concat(walked, F.when(folder, F.array(F.lit(""))).otherwise(none)), "/")
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def resolve_url(base: Column, ref: Column) -> Column:
    """Absolute form of ``ref`` seen from ``base``, without dot segments.

    An address with a scheme or host of its own stays as written; in a path relative to the base's folder empty segments go too."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.split(F.regexp_replace(url_path(base), r"[^/]*$", ""), "/")
    own, rest = F.split(F.regexp_extract(ref, r"^([^?#]*)", 1), "/"), F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    # The outer segments may be empty: they stand for the slashes at the ends.
    joined = F.concat(F.slice(folder, F.lit(1), F.greatest(F.size(folder) - 1, F.lit(0))), own)
    inner = F.filter(joined, lambda x, i: (i == 0) | (i == F.size(joined) - 1) | (x != ""))
    return (
        F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
        .when(ref.startswith("/"), F.concat(origin, _without_dots(own), rest))
        .when(ref.startswith("?"), F.concat(origin, url_path(base), ref))
        .when(ref.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), ref))
        .otherwise(F.concat(origin, _without_dots(inner), rest))
    )


def publisher_label(url: Column) -> Column:
    domain = F.lower(bare_domain(url))
    pairs = F.create_map(*[F.lit(x) for pair in PUBLISHER_LABELS for x in pair])
    return F.coalesce(F.try_element_at(pairs, domain), domain)


def prefix(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def words_in(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"(?U)\w+"))


def relative_path(c: Column, root: str) -> Column:
    """Strip the project root from an absolute path, keeping a leading slash."""
    rest = F.substring(c, len(root) + 1, 1 << 30)
    rooted = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(c.startswith(root), rooted).otherwise(c)


def ordered_union(*arrays: Column) -> Column:
    """Concatenate, keep the first of equal elements; a missing array counts as empty."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(empty, *[F.coalesce(a, empty) for a in arrays]))
