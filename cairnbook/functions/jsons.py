"""JSON expressions on VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FIELDS = "map<string,variant>"


def fields(raw: Column) -> Column:
    """Top-level fields of a JSON object; null for anything else."""
    return F.try_variant_get(F.try_parse_json(raw), "$", FIELDS)


def kind(v: Column) -> Column:
    """STRING, BOOLEAN, ARRAY, OBJECT, VOID (JSON null), or '' for numbers.

    Kept to a single look at the value: inside lambdas nothing is shared between branches."""
    return F.regexp_extract(F.schema_of_variant(v), "^(ARRAY|OBJECT|STRING|BOOLEAN|VOID)", 1)


NUMBER = ""


def quoted(c: Column) -> Column:
    """A string as JSON text."""
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def array_text(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def object_text(pairs: Column) -> Column:
    """JSON object with sorted keys from array<struct<key,value>> whose values are JSON text."""
    entries = F.transform(F.array_sort(pairs), lambda p: F.concat(quoted(p["key"]), F.lit(":"), p["value"]))
    return F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}"))


def canonical(raw: Column) -> Column:
    """The same JSON with sorted keys and no blanks."""
    return F.to_json(F.parse_json(raw))


def items(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def members(v: Column) -> Column:
    return F.map_entries(F.try_variant_get(v, "$", FIELDS))
