"""Merge of sidecar results and fusion of several sources into one event.

Fusion order inside an event: higher score first, then ``seq`` (0 for the enriched
record), then ``record_id``. The order travels as a sortable struct ``rank``; picks are
``min_by``/``max_by`` over it, which combine before the shuffle, so neither a window nor
a collected group is needed and a hot event only costs its partial results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnbook.constants import (
    CONFLICT_KEYS, LONGEST_WINS_KEYS, SIDECAR_LIST_KEYS, SIDECAR_MAP_KEYS, SIDECAR_MIN_SCORE,
)
from cairnbook.functions import jsons as J
from cairnbook.functions.strings import relative_path, strip
from cairnbook.operators.ledger import descending
from cairnbook.operators.ranking import keep_best, number_rows
from cairnbook.session import ensure_checkpoint_dir


def score_of(c: Column) -> Column:
    return F.coalesce(c.cast("string").try_cast("double"), F.lit(0.0))


def fusion_rank(score: Column, seq: Column, order: Column) -> Column:
    return F.struct((F.lit(0.0) - score_of(score)).alias("s"), seq.alias("q"), order.alias("o"))


def assigned_only(records: DataFrame) -> DataFrame:
    return records.where(F.col("event_id").isNotNull() & (F.col("event_id") != ""))


def group_events(records: DataFrame) -> DataFrame:
    return assigned_only(records).groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n_records"), F.min("record_id").alias("first_record"))


def baselines(records: DataFrame, *columns: str) -> DataFrame:
    """Best-scored record of each event, the first of equals; its long columns are fetched after the choice."""
    keep = [c for c in (columns or records.columns) if c != "event_id"]
    needed = list(dict.fromkeys(["event_id", *keep, "extraction_confidence_score", "record_id"]))
    rows = assigned_only(records).select(*needed)
    rank = fusion_rank(F.col("extraction_confidence_score"), F.lit(0), F.col("record_id"))
    rank_id = F.concat(score_of(F.col("extraction_confidence_score")).cast("string"), F.lit("|"), F.coalesce(F.col("record_id").cast("string"), F.lit("")))
    return keep_best(rows, ["event_id"], rank, rank_id).select("event_id", *keep)


def fusion_order(records: DataFrame) -> DataFrame:
    """Records with their 1-based position ``fusion_pos`` inside the event."""
    ranked = assigned_only(records).withColumn("_score", score_of(F.col("extraction_confidence_score")))
    order = [F.desc("_score"), "seq", "record_id"] if "seq" in records.columns else [F.desc("_score"), "record_id"]
    return number_rows(ranked, order, by=["event_id"], name="fusion_pos").drop("_score")


# --- scalar rules as aggregates ---------------------------------------------------------

def filled(v: Column) -> Column:
    return F.when(v != "", v)


def _min_by(v: Column, *order: Column) -> Column:
    key = F.struct(*[o.alias(f"k{i}") for i, o in enumerate(order)])
    return F.min_by(v, F.when(v.isNotNull(), key))


def first_filled(v: Column, rank: Column) -> Column:
    return _min_by(v, rank)


def longest(v: Column, rank: Column) -> Column:
    return _min_by(v, -F.length(v), rank)


def best_title(v: Column, rank: Column) -> Column:
    """Titles with the word None come last; longer is better."""
    return _min_by(v, v.contains("None").cast("int"), -F.length(v), rank)


def earliest_date(v: Column, rank: Column) -> Column:
    return F.coalesce(F.min(F.when(v.startswith("20"), v)), _min_by(v, rank))


# --- list and map rules in long form -------------------------------------------------------

def distinct_items(items: DataFrame, keys: list[str], item: str, rank: Column) -> DataFrame:
    """One row per distinct item with the place of its first occurrence (``at``)."""
    return items.groupBy(*keys, item).agg(F.min(rank).alias("at"))


def merge_maps(entries: DataFrame, keys: list[str], policy: str = "last") -> DataFrame:
    """One value per sub-key: the *last* source in fusion order overwrites earlier ones, or the first is kept."""
    pick = {"last": F.max_by, "first": F.min_by}[policy]
    return entries.groupBy(*keys, "subkey").agg(pick("value", "rank").alias("value"))


def fuse_lists(records: DataFrame, column: str) -> DataFrame:
    """Union of an array column per event, long form: ``event_id, item, score, record_id, item_pos``.

    The last three columns order the items; they stand for the list position without numbering a hot event."""
    ranked = assigned_only(records).select(
        "event_id", fusion_rank(F.col("extraction_confidence_score"), F.lit(1), F.col("record_id")).alias("rank"),
        F.posexplode(column).alias("pos", "item"))
    at = F.struct(F.col("rank.s").alias("s"), F.col("rank.o").alias("o"), F.col("pos").alias("p"))
    return distinct_items(ranked, ["event_id"], "item", at).select(
        "event_id", "item", (F.lit(0.0) - F.col("at.s")).alias("score"), F.col("at.o").alias("record_id"),
        F.col("at.p").alias("item_pos"))


def source_urls(records: DataFrame) -> DataFrame:
    """Distinct trimmed source addresses per event in long form, with the place of first use."""
    urls = assigned_only(records).select(
        "event_id", "extraction_confidence_score", "record_id", F.array(strip(F.col("source_url"))).alias("urls"))
    return fuse_lists(urls, "urls").where(F.col("item") != "").withColumnRenamed("item", "source_url").drop("item_pos")


def fused_scalars(records: DataFrame, *more: Column) -> DataFrame:
    """The fixed scalar columns of an event, and ``more`` aggregates, in one pass."""
    rank = fusion_rank(F.col("extraction_confidence_score"), F.lit(1), F.col("record_id"))
    text = lambda c: filled(F.col(c))
    return assigned_only(records).groupBy("event_id").agg(
        first_filled(text("mountain_name"), rank).alias("mountain_name"),
        best_title(text("article_title"), rank).alias("article_title"),
        longest(text("accident_summary_text"), rank).alias("accident_summary_text"),
        earliest_date(text("accident_date"), rank).alias("accident_date"),
        F.max("extraction_confidence_score").alias("extraction_confidence_score"),
        F.count(F.lit(1)).alias("n_records"), *more)


def conflicts(records: DataFrame) -> DataFrame:
    """Events whose sources disagree on a narrative field (more than one distinct non-empty text)."""
    present = [k for k in CONFLICT_KEYS if k in records.columns]
    differ = [F.coalesce(F.min(filled(F.col(k))) != F.max(filled(F.col(k))), F.lit(False)) for k in present]
    verdict = differ[0]
    for d in differ[1:]:
        verdict = verdict | d
    return assigned_only(records).groupBy("event_id").agg(verdict.alias("has_conflict"))


def object_signature(raw: Column) -> Column:
    return F.md5(J.canonical(raw))


def stale_events(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Events to recompute: no output yet, or an input newer than it. Both have ``event_id, modified``."""
    newest = inputs.groupBy("event_id").agg(F.max("modified").alias("newest_input"))
    written = outputs.groupBy("event_id").agg(F.max("modified").alias("written_at"))
    return (newest.join(written, "event_id", "left")
            .where(F.col("written_at").isNull() | (F.col("written_at") < F.col("newest_input")))
            .select("event_id", "newest_input"))


# --- sidecars -------------------------------------------------------------------------------

def _truthy(v: Column) -> Column:
    return F.coalesce(~F.to_json(v).isin("null", '""', "[]", "{}", "0", "false"), F.lit(False))


def usable_sidecar(raw: Column) -> Column:
    """Object-shaped, score at least 0.1, with derived metrics or events."""
    v = F.try_parse_json(raw)
    get = lambda k: F.try_variant_get(v, f"$.{k}", "variant")
    score = F.coalesce(F.try_variant_get(v, "$.extraction_confidence_score", "double"), F.lit(0.0))
    return F.coalesce(
        F.schema_of_variant(v).startswith("OBJECT") & (score >= SIDECAR_MIN_SCORE)
        & (_truthy(get("derived_metrics")) | _truthy(get("events")) | _truthy(get("event_chain"))), F.lit(False))


def choose_sidecar(records: DataFrame, sidecars: DataFrame) -> DataFrame:
    """First usable sidecar (``run_dir, sidecar_json``) of each event, in record order."""
    usable = sidecars.where(usable_sidecar(F.col("sidecar_json"))).select("run_dir", "sidecar_json")
    return (assigned_only(records).select("event_id", "run_dir", "record_id").join(usable, "run_dir")
            .groupBy("event_id").agg(F.min_by("sidecar_json", "record_id").alias("sidecar_json")))


def merge_documents(df: DataFrame, base: str, sidecar: str, out: str) -> DataFrame:
    """Base record with the sidecar's maps laid over and its lists united; row by row, no shuffle.

    Intermediate arrays are columns of their own, because an expression captured by a
    lambda would be computed again for every element."""
    get = lambda m, k: F.try_element_at(m, F.lit(k))
    pairs_type, item_type = "array<struct<key:string,value:string>>", "array<struct<id:string,json:string>>"
    as_items = lambda v: F.coalesce(F.transform(J.items(v), lambda x: F.struct(
        F.coalesce(x.cast("string"), F.lit("None")).alias("id"), F.to_json(x).alias("json"))), F.array().cast(item_type))
    as_pairs = lambda v: F.coalesce(F.transform(J.members(v), lambda e: F.struct(
        e["key"].alias("key"), F.to_json(e["value"]).alias("value"))), F.array().cast(pairs_type))
    step = df.withColumn("_b", J.fields(F.col(base))).withColumn("_s", J.fields(F.col(sidecar)))
    step = step.withColumns({f"_all_{k}": F.concat(as_items(get("_b", k)), as_items(get("_s", k))) for k in SIDECAR_LIST_KEYS})
    step = step.withColumns({f"_over_{k}": as_pairs(get("_s", k)) for k in SIDECAR_MAP_KEYS})
    step = step.withColumns({f"_ids_{k}": F.transform(f"_all_{k}", lambda x: x["id"]) for k in SIDECAR_LIST_KEYS})
    step = step.withColumns({f"_ids_{k}": F.transform(f"_over_{k}", lambda e: e["key"]) for k in SIDECAR_MAP_KEYS})

    def united(k: str) -> Column:
        first = F.filter(f"_all_{k}", lambda x, i: F.array_position(f"_ids_{k}", x["id"]) == i + 1)
        return J.array_text(F.transform(first, lambda x: x["json"]))

    def laid_over(k: str) -> Column:
        kept = F.filter(as_pairs(get("_b", k)), lambda e: ~F.array_contains(f"_ids_{k}", e["key"]))
        return J.object_text(F.concat(kept, F.col(f"_over_{k}")))

    pair = lambda k, test, text: F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(k).alias("key"), text.alias("value")))
    step = step.withColumn("_changed", F.array_compact(F.array(
        *[pair(k, J.kind(get("_s", k)) == "OBJECT", laid_over(k)) for k in SIDECAR_MAP_KEYS],
        *[pair(k, _truthy(get("_s", k)), united(k)) for k in SIDECAR_LIST_KEYS])))
    step = step.withColumn("_names", F.transform("_changed", lambda e: e["key"]))
    kept = F.transform(F.filter(F.map_entries("_b"), lambda e: ~F.array_contains("_names", e["key"])),
                       lambda e: F.struct(e["key"].alias("key"), F.to_json(e["value"]).alias("value")))
    merged = F.when(F.col("_s").isNull(), F.col(base)).otherwise(J.object_text(F.concat(kept, "_changed")))
    return step.withColumn(out, merged).select(*df.columns, *([out] if out not in df.columns else []))


def enriched_records(records: DataFrame, sidecars: DataFrame | None = None) -> DataFrame:
    """``event_id, artifact_json`` of the baseline, merged with the event's sidecar when it has one."""
    base = baselines(records, "artifact_json")
    if sidecars is None:
        return base
    joined = base.join(choose_sidecar(records, sidecars), "event_id", "left")
    return merge_documents(joined, "artifact_json", "sidecar_json", "artifact_json").select("event_id", "artifact_json")


# --- fusion over open keys ----------------------------------------------------------------------

def _field_rows(records: DataFrame, enriched: DataFrame | None) -> DataFrame:
    """One row per event, source and top-level key: ``event_id, rank, key, value VARIANT, kind``.

    Without sidecars the enriched record is the best one itself and says nothing that its own row does not."""
    score = lambda m: F.try_element_at(m, F.lit("extraction_confidence_score")).cast("string")
    sources = assigned_only(records).select("event_id", F.lit(1).alias("seq"), F.col("record_id").cast("string").alias("o"),
                                            F.lpad(F.col("record_id").cast("string"), 20, "0").alias("_pad"), "artifact_json")
    order = F.col("_pad") if dict(records.dtypes)["record_id"] in ("bigint", "int") else F.col("o")
    sources = sources.withColumn("o", order).drop("_pad")
    if enriched is not None:
        sources = enriched.select("event_id", F.lit(0).alias("seq"), F.lit("").alias("o"), "artifact_json").unionByName(sources)
    every = sources.withColumn("m", J.fields(F.col("artifact_json")))
    # Keys that are always there; a missing value marks them. One record of an event would do, but each task keeps one of each anyway.
    entry = "array<struct<key:string,value:variant>>"
    always = F.array(*(F.struct(F.lit(k).alias("key"), F.lit(None).cast("variant").alias("value")) for k in ("source_urls", "source_url")))
    none = F.array().cast(entry)
    entries = F.concat(F.coalesce(F.map_entries("m").cast(entry), none), always.cast(entry))
    ranked = every.select("event_id", fusion_rank(score(F.col("m")), F.col("seq"), F.col("o")).alias("rank"), entries.alias("entries"))
    return (ranked.select("event_id", "rank", F.explode("entries").alias("e"))
            .select("event_id", "rank", F.col("e.key").alias("key"), F.col("e.value").alias("value"),
                    J.kind(F.col("e.value")).alias("kind")))


# What a piece is; of several for one key the lowest wins: addresses gathered from
# source_url, list items, map members, plain values, and what stands for a key that no source has.
URLS, LIST, MAP, SCALAR, NO_URLS, NO_TEXT = range(6)
_PIECE = "array<struct<cls:int,key:string,sub:string,e:boolean,l:int,z:double,a:string,p:int,json:string>>"


def _pieces(key: Column, value: Column, kind: Column) -> Column:
    """Atomic pieces of one field, each with the sort fields of its rule (smaller wins)."""
    def piece(cls, json, sub=F.lit(None), at=F.lit(0), name=key, e=F.lit(False), l=F.lit(0), z=F.lit(0.0), a=F.lit("")):
        return F.struct(F.lit(cls).alias("cls"), name.alias("key"), sub.cast("string").alias("sub"), e.alias("e"),
                        l.alias("l"), z.alias("z"), a.alias("a"), at.alias("p"), json.cast("string").alias("json"))

    text = value.cast("string")
    empty = F.to_json(value).isin("null", '""')
    dated = F.coalesce(text.startswith("20"), F.lit(False)) & (kind == "STRING")
    late = (F.when(key == "title", F.coalesce(text.contains("None"), F.lit(False)).cast("int"))
            .when(key == "accident_date", (~dated).cast("int")).otherwise(0))
    size = (F.when(key.isin("title", *LONGEST_WINS_KEYS), -F.length(text).cast("double"))
            .when(key == "extraction_confidence_score", F.lit(0.0) - score_of(text)).otherwise(0.0))
    alpha = F.when((key == "accident_date") & dated, text).otherwise("")
    blank = lambda c, zero: F.when(empty, F.lit(zero)).otherwise(c)
    plain = piece(SCALAR, F.to_json(value), e=empty, l=blank(late, 0), z=blank(size, 0.0), a=blank(alpha, ""))
    mark = lambda cls: F.array(piece(cls, F.lit(None)))  # keeps an empty list or map alive
    listed = F.transform(J.items(value), lambda x, i: piece(
        LIST, F.to_json(x), sub=F.coalesce(x.cast("string"), F.lit("None")), at=i))
    members = F.transform(J.members(value), lambda e: piece(MAP, F.to_json(e["value"]), sub=e["key"]))
    raw = F.when(kind == "STRING", F.array(text)).when(kind == "ARRAY", F.transform(
        J.items(value), lambda x: F.when(J.kind(x) == "STRING", x.cast("string"))))
    urls = F.filter(F.transform(raw, lambda u, i: piece(URLS, J.quoted(strip(u)), sub=strip(u), at=i, name=F.lit("source_urls"))),
                    lambda u: u["sub"] != "")
    none = F.array().cast(_PIECE)
    own = (F.when(kind.isNull(), F.when(key == "source_urls", mark(NO_URLS).cast(_PIECE)).otherwise(F.array(piece(NO_TEXT, F.lit('""'))).cast(_PIECE)))
           .when(kind == "ARRAY", F.concat(mark(LIST).cast(_PIECE), listed.cast(_PIECE)))
           .when(kind == "OBJECT", F.concat(mark(MAP).cast(_PIECE), members.cast(_PIECE)))
           .otherwise(F.array(plain).cast(_PIECE)))
    head = F.array(piece(URLS, F.lit(None), name=F.lit("source_urls"))).cast(_PIECE)
    gathered = F.when(F.size(urls) > 0, F.concat(head, urls.cast(_PIECE)))
    return F.concat(own, F.when(key == "source_url", F.coalesce(gathered, none)).otherwise(none))


def fuse_long(records: DataFrame, sidecars: DataFrame | None = None, map_policy: str = "last") -> DataFrame:
    """Fused events, one row per atomic piece: ``event_id, key, kind, subkey, at, value`` (JSON text) and ``head``.

    ``kind`` is scalar, list or map; ``at`` orders list items; a list or map has one row without a value that
    stands for itself, also when it is empty, and ``head`` tells its first item. One shuffle, on event, key
    and piece, after a local minimum; complete for events of any size. The reduced pieces
    are checkpointed since they are read twice. ``source_urls`` and ``source_url`` are always there."""
    ensure_checkpoint_dir(records.sparkSession)
    rows = _field_rows(records, enriched_records(records, sidecars) if sidecars is not None else None)
    each = rows.select("event_id", "rank", F.explode(_pieces(F.col("key"), F.col("value"), F.col("kind"))).alias("x"))
    backwards = (F.col("x.cls") == MAP) if map_policy == "last" else F.lit(False)
    s, q, o = F.col("rank.s"), F.col("rank.q"), F.col("rank.o")
    order = [F.col(f"x.{n}").alias(n) for n in "elza"] + [
        F.when(backwards, F.lit(0.0) - s).otherwise(s).alias("s"), F.when(backwards, -q).otherwise(q).alias("q"),
        F.when(backwards, descending(o)).otherwise(o).alias("o"), F.col("x.p").alias("p")]
    reduced = (each.groupBy("event_id", F.col("x.key").alias("key"), F.col("x.cls").alias("cls"), F.col("x.sub").alias("sub"))
               .agg(F.min(F.struct(*order, F.col("x.json").alias("json"))).alias("w")).checkpoint())
    listed = F.col("cls").isin(URLS, LIST, NO_URLS)
    at = F.when(listed & F.col("sub").isNotNull(), F.struct("w.s", "w.q", "w.o", "w.p"))
    place = F.when(F.col("sub").isNotNull(), F.struct("cls", at.alias("at"), "sub"))
    # The winning class of a key and its first item are one aggregate; keys with one plain value need neither.
    groups = (reduced.groupBy("event_id", "key").agg(F.min("cls").alias("winner"), F.max("cls").alias("worst"), F.min(place).alias("first"))
              .where((F.col("winner") != F.col("worst")) | F.col("first").isNotNull()).drop("worst"))
    kept = reduced.join(groups, ["event_id", "key"], "left").where("winner IS NULL OR cls = winner")
    kind = F.when(listed, "list").when(F.col("cls") == MAP, "map").otherwise("scalar")
    return kept.select("event_id", "key", kind.alias("kind"), F.when(F.col("cls") == MAP, F.col("sub")).alias("subkey"),
                       at.alias("at"), F.col("w.json").alias("value"), F.coalesce(place == F.col("first"), F.lit(False)).alias("head"))


def fuse_lines(long: DataFrame) -> DataFrame:
    """``event_id, line_no, line``: the lines of one JSON object per event, from long form.

    A list item and a map member are lines of their own, a comma begins a line, and the first member is
    ``event_id``. Nothing of an event comes together in one row, so it may be of any size."""
    key, none = J.quoted(F.col("key")), F.lit(None)
    line = lambda piece, text: F.struct(F.lit(piece).alias("piece"), text.alias("line"))
    bracket = lambda a, b: F.when(F.col("kind") == "list", F.lit(a)).otherwise(F.lit(b))
    holds = F.col("kind").isin("list", "map")
    around = F.array(line(0, F.concat(F.lit(", "), key, bracket(": [", ": {"))), line(2, bracket("]", "}")))
    named = F.when(F.col("subkey").isNotNull(), F.concat(J.quoted(F.col("subkey")), F.lit(": "))).otherwise(F.lit(""))
    item = line(1, F.concat(F.when(F.col("head"), F.lit("  ")).otherwise(F.lit(", ")), named, F.col("value")))
    plain = line(0, F.concat(F.lit(", "), key, F.lit(": "), F.coalesce("value", F.lit("null"))))
    lines = F.when(holds & F.col("value").isNull(), around).when(holds, F.array(item)).otherwise(F.array(plain))
    inner = long.where("key <> 'event_id'").select("event_id", F.lit(1).alias("part"), "key", "at", "subkey", F.explode(lines).alias("x"))
    outer = F.array(F.struct(F.lit(0).alias("part"), F.concat(F.lit('{"event_id": '), J.quoted(F.col("event_id"))).alias("line")),
                    F.struct(F.lit(2).alias("part"), F.lit("}").alias("line")))
    ends = long.select("event_id").distinct().select("event_id", F.explode(outer).alias("x")).select(
        "event_id", "x.part", none.cast("string").alias("key"), none.cast(long.schema["at"].dataType).alias("at"),
        none.cast("string").alias("subkey"), F.lit(0).alias("piece"), "x.line")
    every = inner.select("event_id", "part", "key", "at", "subkey", "x.piece", "x.line").unionByName(ends)
    # Held once: the range partitions of the numbering read their input twice.
    return number_rows(every.checkpoint(), ["part", "key", "piece", "at.s", "at.q", "at.o", "at.p", "subkey"], by=["event_id"], name="line_no").select("event_id", "line_no", "line")


def fold_keys(long: DataFrame) -> DataFrame:
    """``event_id, key, value``: the JSON text of each key of an event, from long form. For keys that fit one row; ``fuse_lines`` has no such bound."""
    piece = F.struct("at", F.col("subkey").alias("key"), "value")
    per_key = long.groupBy("event_id", "key", "kind").agg(F.array_sort(F.collect_list(F.when(F.col("value").isNotNull(), piece))).alias("pieces"))
    pairs = F.transform("pieces", lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value")))
    text = (F.when(F.col("kind") == "list", J.array_text(F.transform("pieces", lambda p: p["value"])))
            .when(F.col("kind") == "map", J.object_text(pairs))
            .otherwise(F.coalesce(F.try_element_at("pieces", F.lit(1))["value"], F.lit("null"))))
    return per_key.select("event_id", "key", text.alias("value"))


def export_objects(keys: DataFrame) -> DataFrame:
    """``event_id, fused_json``: one JSON object per event from ``event_id, key, value``. An export of whole
    objects: an event must fit one row."""
    folded = keys.groupBy("event_id").agg(F.collect_list(F.struct("key", "value")).alias("pairs"))
    return folded.select("event_id", J.object_text(F.col("pairs")).alias("fused_json"))


def relative_paths_json(raw: Column, root: str) -> Column:
    """Strings of a JSON text that start with the project root, made relative to it; keys stay."""
    start = r'(?<!\\)"' + "\\Q" + root + "\\E"
    rooted = F.regexp_replace(raw, start + r'(/(?:[^"\\]|\\.)*)"(?!\s*:)', r'"$1"')
    return F.regexp_replace(rooted, start + r'((?:[^"\\/]|\\.)(?:[^"\\]|\\.)*|)"(?!\s*:)', r'"/$1"')


def fuse_events(records: DataFrame, sidecars: DataFrame | None = None, map_policy: str = "last") -> DataFrame:
    """``event_id, line_no, line`` of fused events, see ``fuse_long`` and ``fuse_lines``."""
    return fuse_lines(fuse_long(records, sidecars, map_policy))
