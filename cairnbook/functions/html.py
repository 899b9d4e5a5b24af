"""One pass over a page's markup: the element list every page rule is expressed on.

Python only tokenises. Elements come out in document order with the interval they
cover, so "inside", "next sibling" and "parent" become integer comparisons in Spark:
element ``e`` sits at index ``e.pos`` (1-based), its descendants at ``pos+1 .. end-1``. The page's
visible strings are kept once; those inside ``e`` stand at ``first .. last``."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from cairnbook.functions import html_tokens

cloudpickle.register_pickle_by_value(html_tokens)

ELEMENT = ("struct<pos:int,end:int,parent:int,tag:string,"
           "attrs:map<string,string>,first:int,last:int,script:string>")
PAGE = f"struct<elements:array<{ELEMENT}>,strings:array<string>>"


def parse_html(html: Column, closed: bool = False) -> Column:
    """``PAGE`` of a page; with ``closed``, character references without a semicolon stay as written."""
    return F.arrow_udf(html_tokens.closed_page_batches if closed else html_tokens.page_batches, PAGE)(html)


# --- expressions over the element list -------------------------------------------

def attr(e: Column, name: str) -> Column:
    return F.try_element_at(e["attrs"], F.lit(name))


def text_of(e: Column, strings: Column, between: str = " ") -> Column:
    """Visible text inside an element, ``strings`` being those of its page."""
    return F.array_join(F.slice(strings, e["first"], e["last"] - e["first"] + 1), between)


def script_of(e: Column) -> Column:
    """What a script element holds; '' for other elements."""
    return F.coalesce(e["script"], F.lit(""))


def element(elements: Column, pos: Column) -> Column:
    """Element at a position; null for the root (position 0) and past the end."""
    return F.when(pos > 0, F.try_element_at(elements, pos))


def inside(e: Column, outer: Column) -> Column:
    return (e["pos"] > outer["pos"]) & (e["pos"] < outer["end"])


def with_tag(elements: Column, *tags: str) -> Column:
    return F.filter(elements, lambda e: e["tag"].isin(*tags))


def first_of(items: Column) -> Column:
    return F.try_element_at(items, F.lit(1))


def next_sibling(elements: Column, e: Column) -> Column:
    candidate = element(elements, e["end"])
    return F.when(candidate["parent"] == e["parent"], candidate)


def ancestor(elements: Column, e: Column, tag: str) -> Column:
    """Nearest enclosing element with a tag."""
    around = F.filter(elements, lambda o: (o["tag"] == tag) & (o["pos"] < e["pos"]) & (e["pos"] < o["end"]))
    return F.try_element_at(around, F.lit(-1))
