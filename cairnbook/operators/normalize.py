"""Typed records from loosely typed extraction results.

Input is one JSON object per row. It is parsed once into ``map<string,variant>``; every
rule then looks at the kind of a value before converting it, so the number 3 never
passes as the text "3" unless the rule says so. Value, kind and text of each key are
columns of their own: each is computed once and the rules stay small expressions. With
over a hundred keys the rules are written as SQL text, which builds the plan in one step
per key."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from cairnbook import constants as C
from cairnbook.functions import jsons as J
from cairnbook.functions.dates import iso_date
from cairnbook.functions.strings import none_if_blank

FLOAT_TEXT = r"(?i)^[+-]?(?:\d+\.?\d*(?:e[+-]?\d+)?|\.\d+(?:e[+-]?\d+)?|nan|inf|infinity)$"


class Value(NamedTuple):
    """SQL for a JSON value, its kind, and its text (the content of a string, else JSON)."""

    v: str
    kind: str
    text: str


def kind_sql(v: str) -> str:
    return f"regexp_extract(schema_of_variant({v}), '^(ARRAY|OBJECT|STRING|BOOLEAN|VOID)', 1)"


def value_of(v: str) -> Value:
    return Value(v, kind_sql(v), f"cast({v} AS string)")


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, r'(?U)^\s+|\s+$', '')"


def _items(x: Value) -> str:
    return f"CASE WHEN {x.kind} = 'ARRAY' THEN try_variant_get({x.v}, '$', 'array<variant>') END"


def _words(words: Sequence[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def as_string(x: Value) -> str:
    return f"CASE WHEN {x.kind} = 'STRING' THEN nullif({_strip(x.text)}, '') END"


def _float_text(t: str) -> str:
    return f"CASE WHEN {_strip(t)} RLIKE r'{FLOAT_TEXT}' THEN try_cast({_strip(t)} AS double) END"


def as_int(x: Value) -> str:
    """Numbers cut toward zero, truth values 1 and 0, whole-number texts."""
    return (f"CASE {x.kind} WHEN '' THEN try_cast(try_cast({x.text} AS double) AS int) "
            f"WHEN 'BOOLEAN' THEN cast({x.text} = 'true' AS int) "
            rf"WHEN 'STRING' THEN CASE WHEN {_strip(x.text)} RLIKE r'^[+-]?\d+$' THEN try_cast({_strip(x.text)} AS int) END END")


def as_float(x: Value) -> str:
    return (f"CASE {x.kind} WHEN '' THEN try_cast({x.text} AS double) WHEN 'BOOLEAN' THEN cast({x.text} = 'true' AS double) "
            f"WHEN 'STRING' THEN {_float_text(x.text)} END")


def as_bool(x: Value) -> str:
    said = f"lower({_strip(x.text)})"
    return (f"CASE {x.kind} WHEN 'BOOLEAN' THEN {x.text} = 'true' WHEN 'STRING' THEN "
            f"CASE WHEN {said} IN ({_words(C.TRUE_WORDS)}) THEN true WHEN {said} IN ({_words(C.FALSE_WORDS)}) THEN false END END")


def _strings(x: Value) -> str:
    """Trimmed non-blank strings of a list; a single string counts as a list of one."""
    return (f"CASE {x.kind} WHEN 'ARRAY' THEN array_compact(transform({_items(x)}, i -> {as_string(value_of('i'))})) "
            f"WHEN 'STRING' THEN array_compact(array({as_string(x)})) END")


def as_object_list(x: Value) -> str:
    """Objects of a list as JSON text, blank strings pruned, empty objects dropped."""
    keep = f"NOT ({kind_sql('e.value')} = 'STRING' AND {_strip('cast(e.value AS string)')} = '')"
    members = f"filter(map_entries(try_variant_get(o, '$', 'map<string,variant>')), e -> {keep})"
    text = (f"concat('{{', array_join(transform(array_sort(transform({members}, e -> struct(e.key AS k, to_json(e.value) AS j))), "
            "p -> concat(substring(to_json(array(p.k)), 2, length(to_json(array(p.k))) - 2), ':', p.j)), ','), '}')")
    return f"filter(transform(filter({_items(x)}, o -> {kind_sql('o')} = 'OBJECT'), o -> {text}), t -> t <> '{{}}')"


def as_list(x: Value) -> str:
    """A list of strings, or of objects (as JSON text) as soon as one item is no string."""
    mixed = f"coalesce(exists({_items(x)}, i -> {kind_sql('i')} <> 'STRING'), false)"
    return f"CASE WHEN {mixed} THEN {as_object_list(x)} ELSE array_distinct({_strings(x)}) END"


def as_people(x: Value) -> str:
    get = lambda k: value_of(f"try_variant_get(p, '$.{k}', 'variant')")
    said = lambda k: f"CASE WHEN {get(k).kind} = 'STRING' THEN {_strip(get(k).text)} END AS {k}"
    person = f"struct({as_string(get('name'))} AS name, {as_int(get('age'))} AS age, {said('outcome')}, {said('injuries')})"
    return (f"filter(transform(filter({_items(x)}, o -> {kind_sql('o')} = 'OBJECT'), p -> {person}), "
            "q -> coalesce(q.name, cast(q.age AS string), q.outcome, q.injuries) IS NOT NULL)")


def as_object(x: Value) -> str:
    return f"CASE WHEN {x.kind} = 'OBJECT' AND {x.text} <> '{{}}' THEN {x.text} END"


def keep_enum(x: Value, allowed: Sequence[str]) -> str:
    low = f"lower({_strip(x.text)})"
    return f"CASE WHEN {x.kind} = 'STRING' AND {low} IN ({_words(allowed)}) THEN {low} END"


# --- causes -------------------------------------------------------------------------------

def _cause_part(x: Value, kind: str, allowed) -> str:
    lower_distinct = f"array_distinct(transform({_strings(x)}, s -> lower(s)))"
    return {
        "enum": lambda: keep_enum(x, allowed),
        "int": lambda: f"CASE WHEN {x.kind} IN ('', 'STRING') THEN try_cast({_float_text(x.text)} AS int) END",
        "bool": lambda: f"CASE WHEN {x.kind} = 'BOOLEAN' THEN {x.text} = 'true' END",
        "text": lambda: as_string(x),
        "list": lambda: _strings(x),
        "lower_list": lambda: lower_distinct,
        "enum_list": lambda: f"filter({lower_distinct}, s -> s IN ({_words(allowed)}))",
    }[kind]()


CAUSE_LISTS = (("proximate_causes", "enum_list", C.PROXIMATE_CAUSES),
               ("contributing_factors", "enum_list", C.CONTRIBUTING_FACTORS))
CAUSE_PARTS = [(None, *rule) for rule in CAUSE_LISTS] + [
    (group, *rule) for group, rules in C.CAUSE_OBJECTS.items() for rule in rules]
LISTY = ("list", "lower_list", "enum_list")


def _cause_name(group: str | None, field: str) -> str:
    return f"c_{group}_{field}" if group else f"c_{field}"


def _not_empty(name: str) -> str:
    return f"CASE WHEN size({name}) > 0 THEN {name} END"


def _causes_struct() -> str:
    """Cause object from the converted parts; a part without a valid value, or an object without parts, is null."""
    def field(group, name, kind):
        c = _cause_name(group, name)
        return f"{_not_empty(c) if kind in LISTY else c} AS {name}"

    def present(group, name, kind):
        c = _cause_name(group, name)
        return f"coalesce(size({c}) > 0, false)" if kind in LISTY else f"{c} IS NOT NULL"

    parts = [field(None, n, k) for n, k, _ in CAUSE_LISTS]
    for group, rules in C.CAUSE_OBJECTS.items():
        some = " OR ".join(present(group, n, k) for n, k, _ in rules)
        parts.append(f"CASE WHEN {some} THEN struct({', '.join(field(group, n, k) for n, k, _ in rules)}) END AS {group}")
    some = " OR ".join(present(g, n, k) for g, n, k, _ in CAUSE_PARTS)
    return f"CASE WHEN {some} THEN struct({', '.join(parts)}) END"


# --- scores ----------------------------------------------------------------------------------

def valid_score(c: Column) -> Column:
    return F.when(c.between(0.0, 1.0), c)


def clamp(c: Column) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))  # both skip nulls


def clamp_map(x: Value) -> str:
    members = f"map_entries(CASE WHEN {x.kind} = 'OBJECT' THEN try_variant_get({x.v}, '$', 'map<string,variant>') END)"
    pairs = f"transform({members}, e -> struct(e.key AS key, {as_float(value_of('e.value'))} AS value))"
    kept = f"filter({pairs}, p -> p.value IS NOT NULL)"
    return f"map_from_entries(transform({kept}, p -> struct(p.key, greatest(0.0D, least(1.0D, p.value)))))"


KNOWN_KEYS = (C.STRING_KEYS + C.INT_KEYS + C.FLOAT_KEYS + C.BOOL_KEYS + C.LIST_KEYS + C.DICT_KEYS
              + ("people", "accident_causes"))


def extras(fields: Column) -> Column:
    """Unknown keys with a non-blank string; their date fields must be dates."""
    text = F.transform(F.filter(F.map_entries(fields), lambda e: ~e["key"].isin(*KNOWN_KEYS) & (J.kind(e["value"]) == "STRING")),
                       lambda e: F.struct(e["key"].alias("key"), none_if_blank(e["value"].cast("string")).alias("value")))
    dated = F.transform(text, lambda e: F.struct(
        e["key"].alias("key"), F.when(e["key"].isin(*C.DATE_KEYS), iso_date(e["value"])).otherwise(e["value"]).alias("value")))
    return F.map_from_entries(F.filter(dated, lambda e: e["value"].isNotNull()))


def normalize_artifacts(raw: DataFrame, column: str = "raw") -> DataFrame:
    """One typed row per raw extraction; columns of ``raw`` other than ``column`` stay in front.

    Four projections over the same row, no shuffle: parse, pick values, kinds and texts, convert."""
    others = [c for c in raw.columns if c != column]
    df = raw.select(*others, F.try_parse_json(F.col(column)).alias("_v"))
    # Each key is looked up in the parsed object; only the unknown keys need a map of all of them.
    df = df.selectExpr("*", *[f"try_variant_get(_v, '$.{k}', 'variant') AS v_{k}" for k in KNOWN_KEYS])
    paths = {_cause_name(g, n): f"$.{g}.{n}" if g else f"$.{n}" for g, n, _, _ in CAUSE_PARTS}
    df = df.selectExpr("*", *[f"try_variant_get(v_accident_causes, '{p}', 'variant') AS v_{n}" for n, p in paths.items()])
    names = [*KNOWN_KEYS, *paths]
    df = df.selectExpr("*", *[f"{kind_sql(f'v_{n}')} AS k_{n}" for n in names], *[f"cast(v_{n} AS string) AS t_{n}" for n in names])
    val = lambda n: Value(f"v_{n}", f"k_{n}", f"t_{n}")

    rules = {k: as_string(val(k)) for k in C.STRING_KEYS}
    rules.update({k: as_int(val(k)) for k in C.INT_KEYS})
    rules.update({k: as_float(val(k)) for k in C.FLOAT_KEYS})
    rules.update({k: as_bool(val(k)) for k in C.BOOL_KEYS})
    rules["people"] = as_people(val("people"))
    rules.update({k: as_list(val(k)) for k in C.LIST_KEYS})
    rules.update({k: clamp_map(val(k)) if k == "confidences" else as_object(val(k)) for k in C.DICT_KEYS})
    causes = {_cause_name(g, n): _cause_part(val(_cause_name(g, n)), kind, allowed) for g, n, kind, allowed in CAUSE_PARTS}
    df = df.select(*others, *[F.expr(c).alias(k) for k, c in {**rules, **causes}.items()], extras(F.try_variant_get(F.col("_v"), "$", J.FIELDS)).alias("extras"))

    last = {k: F.col(k) for k in rules}
    last.update({k: F.expr(_not_empty(k)) for k in (*C.LIST_KEYS, "people", "confidences")})
    last.update({k: iso_date(F.col(k)) for k in C.DATE_KEYS if k in rules})
    last["extraction_confidence_score"] = valid_score(last["extraction_confidence_score"])
    last["route_confidence_score"] = clamp(last["route_confidence_score"])
    return df.select(*others, *[c.alias(k) for k, c in last.items()], F.expr(_causes_struct()).alias("accident_causes"), "extras")


def fatality_warnings(records: DataFrame) -> DataFrame:
    """Records that report more dead than people involved; the values themselves stay as they are."""
    return records.where(F.col("num_fatalities") > F.col("num_people_involved"))


# --- confidence ---------------------------------------------------------------------------------

def confidence(hints: Column, record: Column) -> Column:
    """Agreement of rule-based hints with the extracted record, 0 to 1 in hundredths."""
    h, r = hints, record
    points = lambda test, n: F.when(F.coalesce(test, F.lit(False)), F.lit(n)).otherwise(F.lit(0.0))
    dates = F.exists(F.transform(h["pre_dates"], iso_date), lambda d: F.coalesce(d == r["accident_date"], F.lit(False))
                     | F.coalesce(d == r["article_date_published"], F.lit(False)))
    place = F.lower(F.try_element_at(h["gazetteer_matches"], F.lit(1)))
    meters = r["fall_height_meters_estimate"]
    fall = F.abs(h["fall_height_feet_pre"] * F.lit(C.FEET_TO_METERS) - meters) / F.greatest(meters, F.lit(1.0)) < 0.15
    ages = lambda people: F.array_compact(F.transform(people, lambda p: p["age"]))
    score = (points(dates, 0.25) + points(F.lower(r["mountain_name"]).contains(place), 0.2) + points(fall, 0.2)
             + points(h["num_fatalities_pre"] == r["num_fatalities"], 0.15)
             + points(F.arrays_overlap(ages(h["people_pre"]), ages(r["people"])), 0.2))
    return F.least(F.lit(1.0), F.round(score, 2))


def blend(model: Column, rules: Column) -> Column:
    return F.coalesce(F.round(F.lit(0.4) * model + F.lit(0.6) * rules, 2), rules)


def batch_score(model: Column, rules: Column) -> Column:
    return F.coalesce(model, rules)
