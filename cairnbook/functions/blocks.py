"""Article text rules over the block list of one page.

A page's blocks travel as one array inside the page's row, so none of these rules shuffles.
``texts`` is array<string> in document order; ``blocks`` is array<struct<pos,tag,text>>."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cairnbook.constants import (
    BLOCK_BYLINE, HEADLINE, SIGN_UP, EMAIL,
    ANCHOR_WORDS, BOILERPLATE_TOKENS, FOCUS_DROP_TOKENS, SECTION_STOP_PREFIXES,
    SECTION_STOP_TOKENS, STOP_MARKER_PREFIXES, STOP_MARKER_TOKENS, SUBSTANTIVE_TOKENS,
)
from cairnbook.functions.strings import contains_any, squeeze, starts_with_any, strip, whole_word, words_in



def first_index(items: Column, test) -> Column:
    """1-based index of the first element passing ``test``; 0 when there is none."""
    return F.array_position(F.transform(items, lambda x: F.coalesce(test(x), F.lit(False))), F.lit(True)).cast("int")


def last_index(items: Column, test) -> Column:
    at = first_index(F.reverse(items), test)
    return F.when(at > 0, F.size(items) - at + 1).otherwise(F.lit(0))


def take(items: Column, n: Column) -> Column:
    return F.slice(items, F.lit(1), n)


def page_title(blocks: Column, all_blocks: Column) -> Column:
    """First h1/h2 longer than ten characters in the container, else anywhere in the document."""
    def heading(bs: Column) -> Column:
        heads = F.filter(bs, lambda b: b["tag"].isin("h1", "h2") & (F.length(b["text"]) > 10))
        return F.try_element_at(F.transform(heads, lambda b: b["text"]), F.lit(1))
    return F.coalesce(heading(blocks), heading(all_blocks))


def long_enough(texts: Column, minimum: int = 30) -> Column:
    return F.filter(texts, lambda t: F.length(t) >= minimum)


def is_stop_marker(t: Column) -> Column:
    return starts_with_any(t, STOP_MARKER_PREFIXES) | contains_any(t, STOP_MARKER_TOKENS)


def before_comments(texts: Column) -> Column:
    at = first_index(texts, is_stop_marker)
    return F.when(at > 0, take(texts, at - 1)).otherwise(texts)


def without_boilerplate(texts: Column) -> Column:
    return F.filter(texts, lambda t: ~contains_any(t, BOILERPLATE_TOKENS))


def distinct_blocks(texts: Column) -> Column:
    return F.array_distinct(texts)


def keep_second(t: Column) -> Column:
    stopped = starts_with_any(t, SECTION_STOP_PREFIXES) | contains_any(t, SECTION_STOP_TOKENS)
    short = (F.length(strip(t)) < 30) & ~strip(t).rlike(HEADLINE)
    return strip(t).rlike(BLOCK_BYLINE) | ~(stopped | short)


def second_filter(texts: Column) -> Column:
    return F.filter(texts, keep_second)


def is_substantive(t: Column) -> Column:
    return contains_any(t, SUBSTANTIVE_TOKENS)


def until_last_substantive(texts: Column) -> Column:
    at = last_index(texts, is_substantive)
    return F.when(at > 0, take(texts, at)).otherwise(texts)


def assemble(title: Column, texts: Column) -> Column:
    """Title and blocks joined by blank lines, without newsletter sign-up paragraphs."""
    head = F.when(F.length(title) > 0, F.array(strip(title))).otherwise(F.array().cast("array<string>"))
    body = F.filter(F.transform(texts, strip), lambda t: t != "")
    joined = F.array_join(F.concat(F.coalesce(head, F.array().cast("array<string>")), body), "\n\n")
    return F.regexp_replace(F.regexp_replace(joined, SIGN_UP, ""), r"\n{3,}", "\n\n")


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n\n", -1), strip), lambda p: p != "")


def cut_after_email(text: Column) -> Column:
    """Text up to the end of the first e-mail address; without one, up to the last substantive paragraph."""
    address = F.regexp_extract(text, EMAIL, 0)
    end = F.regexp_instr(text, F.lit(EMAIL)) + F.length(address) - 1
    paras = paragraphs(text)
    last = last_index(paras, is_substantive)
    by_paragraph = F.when(last > 0, F.array_join(take(paras, last), "\n\n")).otherwise(text)
    return F.when(text.rlike(EMAIL), strip(F.substring(text, F.lit(1), end))).otherwise(by_paragraph)


def trim_tail_run(text: Column, max_words: int = 12, min_run: int = 3) -> Column:
    """Drop the trailing run of short paragraphs when it has at least three members."""
    paras = paragraphs(text)
    last_long = last_index(paras, lambda p: words_in(p) > max_words)
    run = F.size(paras) - last_long
    return F.array_join(F.when(run >= min_run, take(paras, last_long)).otherwise(paras), "\n\n")


def focus_window(texts: Column) -> Column:
    """From one block before the first anchor word to five blocks after it; no anchor keeps all."""
    at = first_index(texts, lambda t: t.rlike(whole_word(ANCHOR_WORDS)))
    start = F.greatest(at - 1, F.lit(1))
    return F.when(at > 0, F.slice(texts, start, at + 6 - start)).otherwise(texts)


def keep_focused(t: Column) -> Column:
    headline = (F.length(t) < 60) & t.rlike(HEADLINE) & t.contains(" ")
    return ~(contains_any(t, FOCUS_DROP_TOKENS) | headline)


def clean_focus(texts: Column) -> Column:
    return squeeze(F.array_join(F.filter(texts, keep_focused), " "))


def is_longer(a: Column, b: Column, short: int = 800) -> Column:
    """Whether ``a`` is short and ``b`` longer."""
    return F.coalesce((F.length(a) < short) & (F.length(b) > F.length(a)), F.lit(False))


def prefer_longer(a: Column, b: Column, short: int = 800) -> Column:
    return F.when(is_longer(a, b, short), b).otherwise(a)


def blocked_page(visible_text: Column, status: Column | None = None) -> Column:
    low = F.lower(visible_text)
    denied = (F.length(visible_text) < 100) | low.contains("access denied") | low.contains("403 forbidden")
    return denied if status is None else F.coalesce(status.isin(202, 403), F.lit(False)) | denied
