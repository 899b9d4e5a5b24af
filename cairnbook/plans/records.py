"""Normalisation, scoring and extractor answers."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from cairnbook import constants as C
from cairnbook.operators import normalize as N, responses as R
from cairnbook.operators.extraction import pre_extract
from cairnbook.plans.bridges import bridge, with_bridges
from cairnbook.plans.registry import query, table
from cairnbook.plans.text import CANDIDATE_DATE, author_sql, iso_sql

def raw_sql(select: str) -> str:
    return with_bridges(f"SELECT record_id, {select} FROM (SELECT *, record_id AS o FROM bridge_raw) JOIN (SELECT o_orderkey AS o, o_custkey AS c, o_orderpriority AS prio FROM orders) USING (o)", "bridge_raw")


def raw(spark, sf_dir):
    return bridge(spark, sf_dir, "bridge_raw")


def normalized(spark, sf_dir):
    return N.normalize_artifacts(raw(spark, sf_dir))


@query("coerce_scalars", raw_sql("""
  'https://news.example.com/' || c AS source_url, CASE WHEN o % 4 = 3 THEN 'BC' END AS region,
  CASE o % 5 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 4 THEN 1 END AS num_people_involved,
  CASE c % 3 WHEN 0 THEN 4 WHEN 1 THEN 1 END AS num_fatalities,
  CASE c % 4 WHEN 0 THEN 30.5::double WHEN 1 THEN 12::double WHEN 3 THEN 7.25::double END AS fall_height_meters_estimate,
  CASE c % 5 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false END AS self_rescue_boolean"""))
def coerce_scalars(spark, sf_dir):
    return normalized(spark, sf_dir).select("record_id", "source_url", "region", "num_people_involved", "num_fatalities",
                                            "fall_height_meters_estimate", "self_rescue_boolean")


@query("clean_lists", raw_sql("CASE o % 4 WHEN 0 THEN 'one.jpg' WHEN 1 THEN 'a|b' END AS photo_urls"))
def clean_lists(spark, sf_dir):
    return normalized(spark, sf_dir).select("record_id", F.array_join("photo_urls", "|").alias("photo_urls"))


@query("clean_dict_lists", raw_sql("""'{"kind":"bolt"}' AS anchors"""))
def clean_dict_lists(spark, sf_dir):
    return normalized(spark, sf_dir).select("record_id", F.array_join("anchors", "|").alias("anchors"))


@query("clean_people", raw_sql("'P' || c % 50 AS name, cast(o % 70 AS int) AS age, 'Minor' AS outcome, cast(NULL AS varchar) AS injuries"))
def clean_people(spark, sf_dir):
    """The outer form brings no test of the list's size, which would read the people once more for each mention."""
    return normalized(spark, sf_dir).select("record_id", F.explode_outer("people").alias("p")).where("p IS NOT NULL").select("record_id", "p.*")


CAUSES = ["Rockfall", " ICEFALL ", "unknown", "Avalanche", "fatigue"]


def cause_docs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    pick = lambda n: F.try_element_at(F.array(*[F.lit(c) for c in CAUSES]), (F.col("o_orderkey") % n + 1).cast("int"))
    doc = F.concat(F.lit('{"accident_causes":{"proximate_causes":["'), pick(5), F.lit('","'), pick(3), F.lit('"],"anchor_system":{"anchor_type":"'),
                   F.when(F.col("o_orderkey") % 2 == 0, "BOLT").otherwise("glue"), F.lit('","num_points":"'), (F.col("o_custkey") % 4).cast("string"),
                   F.lit('.7","redundancy_present":'), F.when(F.col("o_custkey") % 2 == 0, "true").otherwise('"yes"'),
                   F.lit('},"human_factors":{"communication_method":["radio"," Radio "]},"rope_system":{"rope_type":"steel"}}}'))
    return o.select(F.col("o_orderkey").alias("record_id"), doc.alias("raw"))


@query("enum_keep", """
SELECT o_orderkey AS record_id, CASE WHEN o_orderkey % 2 = 0 THEN 'bolt' END AS anchor_type FROM orders""")
def enum_keep(spark, sf_dir):
    return N.normalize_artifacts(cause_docs(spark, sf_dir)).select("record_id", "accident_causes.anchor_system.anchor_type")


@query("clean_causes", """
SELECT record_id, concat_ws('|', CASE WHEN a IN ('rockfall', 'icefall', 'avalanche') THEN a END, CASE WHEN b IN ('rockfall', 'icefall') AND b <> a THEN b END) AS proximate,
  cast(points AS int) AS num_points, CASE WHEN redundant THEN true END AS redundancy_present, 'radio' AS communication, true AS no_rope
FROM (SELECT o_orderkey AS record_id, lower(trim(['Rockfall', ' ICEFALL ', 'unknown', 'Avalanche', 'fatigue'][o_orderkey % 5 + 1])) AS a,
  lower(trim(['Rockfall', ' ICEFALL ', 'unknown', 'Avalanche', 'fatigue'][o_orderkey % 3 + 1])) AS b, o_custkey % 4 AS points, o_custkey % 2 = 0 AS redundant FROM orders)""")
def clean_causes(spark, sf_dir):
    c = N.normalize_artifacts(cause_docs(spark, sf_dir)).select("record_id", "accident_causes.*")
    return c.select("record_id", F.coalesce(F.array_join("proximate_causes", "|"), F.lit("")).alias("proximate"), "anchor_system.num_points",
                    "anchor_system.redundancy_present", F.array_join("human_factors.communication_method", "|").alias("communication"),
                    F.col("rope_system").isNull().alias("no_rope"))


@query("normalize_dates", raw_sql("""
  CASE o % 5 WHEN 0 THEN '2025-10-01' WHEN 1 THEN '2025-10-03' WHEN 2 THEN '2025-10-04' WHEN 4 THEN '2025-10-05' END AS article_date_published,
  CASE WHEN o % 2 = 0 THEN '2025-09-30' END AS missing_since"""))
def normalize_dates(spark, sf_dir):
    return normalized(spark, sf_dir).select("record_id", "article_date_published",
                                            F.try_element_at("extras", F.lit("missing_since")).alias("missing_since"))


@query("clamp_scores", raw_sql("""
  CASE o % 3 WHEN 1 THEN 0.5::double WHEN 2 THEN 0.75::double END AS extraction_confidence_score,
  CASE o % 3 WHEN 0 THEN 1.0::double WHEN 1 THEN 0.0::double ELSE 0.25::double END AS route_confidence_score"""))
def clamp_scores(spark, sf_dir):
    return normalized(spark, sf_dir).select("record_id", "extraction_confidence_score", "route_confidence_score")


@query("dq_fatalities", with_bridges(
    "SELECT record_id, num_fatalities, num_people_involved FROM bridge_artifacts WHERE num_fatalities > num_people_involved", "bridge_artifacts"))
def dq_fatalities(spark, sf_dir):
    return N.fatality_warnings(bridge(spark, sf_dir, "bridge_artifacts")).select("record_id", "num_fatalities", "num_people_involved")


@query("extras_map", raw_sql("'cold' AS weather_note, cast(CASE WHEN o % 2 = 0 THEN 2 ELSE 1 END AS int) AS n"))
def extras_map(spark, sf_dir):
    return normalized(spark, sf_dir).select("record_id", F.try_element_at("extras", F.lit("weather_note")).alias("weather_note"),
                                            F.size("extras").alias("n"))


# --- the whole record, every field as text ---

def shown_fields(df, columns) -> list:
    """Fields of columns as text columns ``a.b`` -> ``a_b``: lists with bars, people with colons, maps as sorted k=v."""
    out = []

    def add(name: str, c, t) -> None:
        if isinstance(t, T.StructType):
            for f in t.fields:
                add(f"{name}_{f.name}", c[f.name], f.dataType)
        elif isinstance(t, T.MapType):
            pairs = F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))))
            out.append(F.array_join(pairs, "|").alias(name))
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType):
            one = lambda x: F.concat_ws(":", *[x[f.name].cast("string") for f in t.elementType.fields])
            out.append(F.array_join(F.transform(c, one), "|").alias(name))
        elif isinstance(t, T.ArrayType):
            out.append(F.array_join(c, "|").alias(name))
        else:
            out.append(c.cast("string").alias(name))

    for k in columns:
        add(k, F.col(k), df.schema[k].dataType)
    return out


# What the rules make of `bridge_raw`; every other field of a record is null.
RECORD = {
    "source_url": "'https://news.example.com/' || c", "region": "CASE WHEN o % 4 = 3 THEN 'BC' END", "consensus_state": "prio",
    "article_date_published": "CASE o % 5 WHEN 0 THEN '2025-10-01' WHEN 1 THEN '2025-10-03' WHEN 2 THEN '2025-10-04' WHEN 4 THEN '2025-10-05' END",
    "num_people_involved": "CASE o % 5 WHEN 0 THEN '3' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 4 THEN '1' END",
    "num_fatalities": "CASE c % 3 WHEN 0 THEN '4' WHEN 1 THEN '1' END",
    "fall_height_meters_estimate": "CASE c % 4 WHEN 0 THEN '30.5' WHEN 1 THEN '12.0' WHEN 3 THEN '7.25' END",
    "self_rescue_boolean": "CASE c % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'true' WHEN 2 THEN 'false' END",
    "extraction_confidence_score": "CASE o % 3 WHEN 1 THEN '0.5' WHEN 2 THEN '0.75' END",
    "route_confidence_score": "CASE o % 3 WHEN 0 THEN '1.0' WHEN 1 THEN '0.0' ELSE '0.25' END",
    "photo_urls": "CASE o % 4 WHEN 0 THEN 'one.jpg' WHEN 1 THEN 'a|b' END", "anchors": """'{"kind":"bolt"}'""",
    "people": "'P' || c % 50 || ':' || o % 70 || ':Minor'",
    "extras": "CASE WHEN o % 2 = 0 THEN 'missing_since=2025-09-30|' ELSE '' END || 'weather_note=cold'",
}
CAUSE_FIELDS = [*[(name, kind, allowed) for name, kind, allowed in N.CAUSE_LISTS],
                *[(f"{group}_{name}", kind, allowed) for group, rules in C.CAUSE_OBJECTS.items() for name, kind, allowed in rules]]
_PLAIN = [k for k in N.KNOWN_KEYS if k != "accident_causes"]
RECORD_FIELDS = [*_PLAIN, *(f"accident_causes_{name}" for name, _, _ in CAUSE_FIELDS), "extras"]


@query("normalize_artifact", raw_sql(", ".join(f"{RECORD.get(k, 'cast(NULL AS varchar)')} AS {k}" for k in RECORD_FIELDS)))
def normalize_artifact(spark, sf_dir):
    found = normalized(spark, sf_dir)
    return found.select("record_id", *shown_fields(found, [*_PLAIN, "accident_causes", "extras"]))


def _cause_value(kind: str, allowed) -> tuple[str, str]:
    """A value as JSON (SQL text over ``o``, run by both engines) and what the rule makes of it."""
    return {
        "enum": lambda: (f"""CASE WHEN o % 2 = 0 THEN '" {allowed[0].upper()} "' ELSE '"no such"' END""", f"CASE WHEN o % 2 = 0 THEN '{allowed[0]}' END"),
        "int": lambda: ("""concat('"', cast(o % 5 AS string), '.7"')""", "cast(o % 5 AS varchar)"),
        "bool": lambda: ("""CASE WHEN o % 3 = 0 THEN 'true' WHEN o % 3 = 1 THEN 'false' ELSE '"yes"' END""", "CASE o % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END"),
        "text": lambda: ("""CASE WHEN o % 2 = 0 THEN '" some words "' ELSE '"  "' END""", "CASE WHEN o % 2 = 0 THEN 'some words' END"),
        "list": lambda: ("""CASE WHEN o % 2 = 0 THEN '["x ", " ", "y"]' ELSE '" z "' END""", "CASE WHEN o % 2 = 0 THEN 'x|y' ELSE 'z' END"),
        "lower_list": lambda: ("""'["Radio", " radio ", "Flag"]'""", "'radio|flag'"),
        "enum_list": lambda: (f"""'["{allowed[0].upper()}", "no such", " {allowed[-1]} "]'""", f"'{allowed[0]}|{allowed[-1]}'" if len(allowed) > 1 else f"'{allowed[0]}'"),
    }[kind]()


def _cause_docs_sql() -> str:
    member = lambda name, kind, allowed: f"""'"{name}":', {_cause_value(kind, allowed)[0]}"""
    listed = lambda rules: ", ',', ".join(member(*r) for r in rules)
    groups = ", ',', ".join(f"""'"{group}":{{', {listed(rules)}, '}}'""" for group, rules in C.CAUSE_OBJECTS.items())
    return f"""SELECT o AS record_id, concat('{{"confidences":{{"a":1.5,"b":"0.5","c":"x","d":-1,"e":0.', cast(o % 10 AS string), '}},"accident_causes":{{', {listed(N.CAUSE_LISTS)}, ',', {groups}, '}}}}') AS raw
FROM (SELECT o_orderkey AS o FROM orders)"""


@query("normalize_causes", "SELECT o AS record_id, 'a=1.0|b=0.5|d=0.0|e=0.' || o % 10 AS confidences, "
       + ", ".join(f"{_cause_value(kind, allowed)[1]} AS accident_causes_{name}" for name, kind, allowed in CAUSE_FIELDS) + " FROM (SELECT o_orderkey AS o FROM orders)")
def normalize_causes(spark, sf_dir):
    """Every sub-field of the causes, with a value that its rule takes and one that it does not."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("cairnbook_orders")
    found = N.normalize_artifacts(spark.sql(_cause_docs_sql().replace("FROM orders", "FROM cairnbook_orders")))
    return found.select("record_id", *shown_fields(found, ["confidences", "accident_causes"]))


# --- confidence -------------------------------------------------------------------------------------------

def scored(spark, sf_dir):
    hints = pre_extract(bridge(spark, sf_dir, "bridge_articles")).withColumnRenamed("doc_id", "record_id")
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("record_id"), F.concat(F.lit("2024-07-"), F.lpad((F.col("o_orderkey") % 28 + 1).cast("string"), 2, "0")).alias("accident_date"),
        F.lit(None).cast("string").alias("article_date_published"), F.when(F.col("o_custkey") % 2 == 0, "Upper Garibaldi Provincial Park").alias("mountain_name"),
        ((F.col("o_orderkey") % 900 + 100) * F.lit(0.3048) + F.col("o_custkey") % 60).alias("fall_height_meters_estimate"),
        (F.col("o_custkey") % 3).cast("int").alias("num_fatalities"),
        F.array(F.struct((F.col("o_custkey") % 61 + 18).cast("int").alias("age"))).alias("people"))
    both = hints.join(o, "record_id")
    both = both.withColumn("h", F.struct(*[c for c in hints.columns if c != "record_id"])).withColumn(
        "r", F.struct(*[c for c in o.columns if c != "record_id"]))
    return both.select("record_id", N.confidence(F.col("h"), F.col("r")).alias("score"))


SCORED = r"""
SELECT o_orderkey AS record_id, round(least(1.0::double,
  CASE WHEN o_orderkey % 4 = 2 AND o_orderkey % 9 <> 0 THEN 0.25 ELSE 0 END
  + CASE WHEN o_custkey % 3 = 0 AND o_custkey % 2 = 0 THEN 0.2 ELSE 0 END
  + CASE WHEN o_orderkey % 3 < 2 AND abs((o_orderkey % 900 + 100) * 0.3048 - m) / greatest(m, 1.0) < 0.15 THEN 0.2 ELSE 0 END
  + CASE WHEN killed = o_custkey % 3 THEN 0.15 ELSE 0 END
  + CASE WHEN o_custkey % 61 = o_orderkey % 60 OR o_custkey % 61 = o_custkey % 60 THEN 0.2 ELSE 0 END), 2)::double AS score
FROM (SELECT *, (o_orderkey % 900 + 100) * 0.3048::double + o_custkey % 60 AS m,
  CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE o_orderkey % 4 END AS killed FROM orders)"""


@query("confidence", SCORED)
def confidence(spark, sf_dir):
    return scored(spark, sf_dir)


@query("confidence_blend", with_bridges("""
SELECT record_id, coalesce(round(0.4::double * extraction_confidence_score + 0.6::double * (num_fatalities / 4), 2), num_fatalities / 4)::double AS score FROM bridge_artifacts""", "bridge_artifacts"))
def confidence_blend(spark, sf_dir):
    return bridge(spark, sf_dir, "bridge_artifacts").select(
        "record_id", N.blend(F.col("extraction_confidence_score"), F.col("num_fatalities") / F.lit(4.0)).alias("score"))


@query("confidence_batch", with_bridges("""
SELECT record_id, coalesce(extraction_confidence_score::double, num_fatalities / 4)::double AS score FROM bridge_artifacts""", "bridge_artifacts"))
def confidence_batch(spark, sf_dir):
    return bridge(spark, sf_dir, "bridge_artifacts").select(
        "record_id", N.batch_score(F.col("extraction_confidence_score"), F.col("num_fatalities") / F.lit(4.0)).alias("score"))


# --- E: batches and answers -----------------------------------------------------------------------------------

@query("assign_batches", """
SELECT page_id, cast(ceil(row_number() OVER (ORDER BY page_id) / 3) AS bigint) AS batch_id, cast((row_number() OVER (ORDER BY page_id) - 1) % 3 AS int) AS pos FROM pages""")
def assign_batches(spark, sf_dir):
    return R.assign_batches(table(spark, sf_dir, "pages").select("page_id"), 3, "page_id")


def items(spark, sf_dir):
    return bridge(spark, sf_dir, "bridge_items")


@query("batch_payload", with_bridges("""
SELECT batch_id, count(*) AS n_items, arg_min(url, pos) AS first_url, sum(length(left(focused_text, 12000)))::bigint AS chars, arg_max(left(full_text, 16000), pos) AS last_full
FROM bridge_items GROUP BY 1""", "bridge_items"))
def batch_payload(spark, sf_dir):
    with_hints = items(spark, sf_dir).withColumn("hints", F.create_map(F.lit("n"), F.length("focused_text").cast("string")))
    payload = F.from_json("payload", "items array<struct<url:string,pre_extracted:string,article_focused:string,article_full:string>>")
    p = R.batch_payloads(with_hints).select("batch_id", payload.alias("p"))
    return p.select("batch_id", F.size("p.items").cast("bigint").alias("n_items"), F.try_element_at("p.items", F.lit(1))["url"].alias("first_url"),
                    F.aggregate("p.items", F.lit(0).cast("bigint"), lambda s, x: s + F.length(x["article_focused"])).alias("chars"),
                    F.try_element_at("p.items", F.lit(-1))["article_full"].alias("last_full"))


ANSWERS = """SELECT batch_id, unnest([0, 1])::int AS pos, unnest(['{"n":' || batch_id || '}', CASE WHEN batch_id % 3 = 0 THEN '{}' ELSE '{"a":"x","b":2}' END]) AS item_json
FROM bridge_answers WHERE batch_id % 7 <> 3"""


@query("parse_responses", with_bridges("SELECT * FROM answers", "bridge_answers", answers=ANSWERS))
def parse_responses(spark, sf_dir):
    return R.parse_responses(bridge(spark, sf_dir, "bridge_answers"))


def aligned(spark, sf_dir):
    return R.align(items(spark, sf_dir), R.parse_responses(bridge(spark, sf_dir, "bridge_answers")))


@query("align_responses", with_bridges(
    "SELECT i.batch_id, i.pos, i.url, a.item_json FROM bridge_items i LEFT JOIN answers a USING (batch_id, pos)",
    "bridge_items", "bridge_answers", answers=ANSWERS))
def align_responses(spark, sf_dir):
    return aligned(spark, sf_dir).select("batch_id", "pos", "url", "item_json")


@query("minimal_artifacts", with_bridges(f"""
SELECT batch_id, pos, url AS source_url, coalesce({author_sql()}) AS report_author, {iso_sql('s')} AS article_date_published, full_text AS scraped_full_text
FROM (SELECT *, {CANDIDATE_DATE} AS s FROM (SELECT i.*, coalesce(nullif(i.full_text, ''), i.focused_text) AS text
  FROM bridge_items i LEFT JOIN answers a USING (batch_id, pos) WHERE a.item_json IS NULL))""", "bridge_items", "bridge_answers", answers=ANSWERS))
def minimal_artifacts(spark, sf_dir):
    found = R.minimal_artifacts(aligned(spark, sf_dir))
    return found.select("batch_id", "pos", "source_url", "report_author", "article_date_published", "scraped_full_text")


@query("admit_batches", with_bridges("SELECT batch_id, pos, batch_id <= 20 AS admitted FROM bridge_items", "bridge_items"))
def admit_batches(spark, sf_dir):
    return R.admit_batches(items(spark, sf_dir), 20).select("batch_id", "pos", "admitted")


@query("token_totals", """
SELECT role AS model, sum(length(text))::bigint AS prompt, sum(turn)::bigint AS completion, (sum(length(text)) + sum(turn))::bigint AS total
FROM conversations GROUP BY ROLLUP (role)""")
def token_totals(spark, sf_dir):
    return R.token_totals(table(spark, sf_dir, "conversations").select(
        F.col("role").alias("model"), F.length("text").alias("prompt"), F.col("turn").alias("completion")))
