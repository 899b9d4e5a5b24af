"""Record identity, clustering into events and stable event ids.

Records have ``record_id`` (defines the order in which records are seen),
``source_url, article_title, mountain_name, accident_date, article_date_published``
and, where present, ``region, article_text, scraped_full_text, file_path``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnbook.functions.strings import short_md5, strip
from cairnbook.operators.ranking import number_rows


def _given(df: DataFrame, *names: str) -> Column:
    """First non-empty of some columns (missing columns count as empty), '' if none."""
    present = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*present, F.lit(""))


def record_date(df: DataFrame) -> Column:
    return strip(_given(df, "accident_date", "article_date_published"))


def record_mountain(df: DataFrame) -> Column:
    return strip(_given(df, "mountain_name"))


def excerpt(df: DataFrame, n: int) -> Column:
    return F.substring(_given(df, "article_text", "scraped_full_text"), 1, n)


def with_signature(df: DataFrame) -> DataFrame:
    seed = F.concat_ws("|", _given(df, "file_path", "record_id"), strip(_given(df, "article_title")), record_date(df),
                       record_mountain(df), strip(_given(df, "region")), strip(excerpt(df, 200)))
    return df.withColumn("signature", F.md5(seed))


#: Children of a node of the hash tree, and entries of a leaf on average.
FAN_IN = 16


def corpus_key(signed: DataFrame, by: str | None = None) -> DataFrame:
    """Order-insensitive key of a set of records.

    Equal signatures are counted first. They are the leaves of a tree over the hexadecimal digits of a signature,
    so deep that a leaf holds ``FAN_IN`` entries or fewer on average; then each level hashes the at most
    ``FAN_IN`` nodes that share a prefix. No list grows with the corpus."""
    group = [by] if by else []
    counted = signed.groupBy(*group, "signature").agg(F.count(F.lit(1)).alias("n"))
    sizes = counted.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    # The least depth whose leaves are enough; whole numbers, so every run finds the same.
    depth = F.size(F.filter(F.sequence(F.lit(1), F.lit(14)), lambda d: F.col("_size") > F.pow(F.lit(float(FAN_IN)), d)))
    if by:
        same = F.col(by).eqNullSafe(F.col("_by"))
        placed = counted.join(sizes.select(F.col(by).alias("_by"), depth.alias("_depth")), same).drop("_by")
        deepest = sizes.agg(F.max(depth)).first()[0] or 0
    else:
        deepest = sizes.select(depth).first()[0]
        placed = counted.withColumn("_depth", F.lit(deepest))
    entry = F.concat_ws(":", "signature", F.col("n").cast("string"))
    nodes = (placed.groupBy(*group, F.expr("substring(signature, 1, _depth)").alias("bucket"))
             .agg(F.md5(F.array_join(F.array_sort(F.collect_list(entry)), "|")).alias("part"), F.sum("n").alias("n")))
    for level in range(deepest, 0, -1):
        here = F.length("bucket") == level
        above = F.when(here, F.substring("bucket", 1, level - 1)).otherwise(F.col("bucket"))
        pairs = F.array_sort(F.collect_list(F.struct(here.alias("here"), "bucket", "part")))
        # A node of a shallower group waits as it is.
        part = F.when(pairs[0]["here"], F.md5(F.array_join(F.transform(pairs, lambda p: p["part"]), "|"))).otherwise(pairs[0]["part"])
        nodes = nodes.groupBy(*group, above.alias("bucket")).agg(part.alias("part"), F.sum("n").alias("n"))
    return nodes.select(*group, F.col("part").alias("corpus_key"), F.col("n").alias("n_records"))


def grouping_batch(df: DataFrame) -> DataFrame:
    return df.select(
        "record_id", F.col("article_title").alias("title"),
        F.coalesce(F.nullif("accident_date", F.lit("")), F.col("article_date_published")).alias("date"),
        F.col("mountain_name").alias("mountain"),
        (F.col("region") if "region" in df.columns else F.lit(None).cast("string")).alias("region"),
        "source_url", excerpt(df, 600).alias("excerpt"))


def cluster_key(df: DataFrame) -> Column:
    mountain, date = F.lower(record_mountain(df)), record_date(df)
    seed = _given(df, "source_url", "article_title", "file_path", "record_id")
    return F.when((date != "") & (mountain != ""), F.concat_ws("|", mountain, date)).otherwise(short_md5(seed, 16))


def cluster_deterministic(df: DataFrame) -> DataFrame:
    """``record_id, cluster_id``: same mountain and date, else same source; ids in first-seen order."""
    keyed = df.select("record_id", cluster_key(df).alias("cluster_key"))
    clusters = keyed.groupBy("cluster_key").agg(F.min("record_id").alias("first_seen"))
    numbered = number_rows(clusters, ["first_seen"], name="n").select("cluster_key", (F.col("n") - 1).alias("cluster_id"))
    return keyed.join(numbered, "cluster_key").select("record_id", "cluster_id")


def split_conflicts(df: DataFrame, clusters: DataFrame) -> DataFrame:
    """Split clusters that mix mountains or dates; ``clusters`` is ``record_id, cluster_id``.

    "More than one distinct non-empty value" is "smallest differs from largest", which needs no set."""
    keyed = df.select("record_id", cluster_key(df).alias("key"), F.lower(record_mountain(df)).alias("mt"),
                      record_date(df).alias("dt")).join(clusters, "record_id")
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    mixed = lambda c: F.coalesce(F.min(some(c)) != F.max(some(c)), F.lit(False))
    verdict = keyed.groupBy("cluster_id").agg((mixed("mt") | mixed("dt")).alias("split"))
    return (keyed.join(verdict, "cluster_id")
            .select("record_id", "cluster_id", F.when(F.col("split"), F.col("key")).alias("split_key")))


def event_id_seed(mountain: Column, date: Column, title: Column, url: Column, path: Column) -> Column:
    some = lambda c: F.nullif(c, F.lit(""))
    return F.when((mountain != "") | (date != ""), F.concat_ws("|", mountain, date)).otherwise(
        F.coalesce(some(title), some(url), some(path), F.lit("")))


def cluster_event_ids(df: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """One event id per cluster, seeded by the cluster's first record.

    With ``strict`` the cluster key itself is the seed: records that share only a date
    (or only a mountain) then keep ids of their own."""
    facts = df.select(*keys, "record_id", record_mountain(df).alias("mt"), record_date(df).alias("dt"),
                      _given(df, "article_title").alias("title"), _given(df, "source_url").alias("url"),
                      _given(df, "file_path", "record_id").alias("path"))
    first = facts.groupBy(*keys).agg(F.min_by(F.struct("mt", "dt", "title", "url", "path"), "record_id").alias("f"))
    seed = event_id_seed(F.col("f.mt"), F.col("f.dt"), F.col("f.title"), F.col("f.url"), F.col("f.path"))
    if strict:
        seed = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return first.select(*keys, short_md5(seed, 12).alias("event_id"))


def assign_event_ids(df: DataFrame, strict: bool = False) -> DataFrame:
    """Records with ``event_id``: one aggregate over clusters and one join back, no cluster numbering."""
    keyed = df.withColumn("cluster_key", cluster_key(df))
    return keyed.join(cluster_event_ids(keyed, ["cluster_key"], strict), "cluster_key")


def write_back(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Records with the new ``event_id`` where there is one, else the one they had."""
    had = F.col("event_id") if "event_id" in records.columns else F.lit(None).cast("string")
    fresh = ids.select("record_id", F.col("event_id").alias("_new_id"))
    joined = records.join(fresh, "record_id", "left")
    return joined.withColumn("event_id", F.coalesce("_new_id", had)).drop("_new_id")


def valid_clusters(answers: DataFrame) -> DataFrame:
    """Members named by an external clustering (``run_id, raw`` JSON): entries without an index list are dropped."""
    entries = F.try_variant_get(F.try_parse_json("raw"), "$", "array<variant>")
    listed = F.filter(entries, lambda c: F.coalesce(
        F.schema_of_variant(F.try_variant_get(c, "$.indices", "variant")).startswith("ARRAY"), F.lit(False)))
    rows = answers.select("run_id", F.posexplode(listed).alias("pos", "c"))
    member = rows.select(
        "run_id", F.coalesce(F.try_variant_get("c", "$.cluster_id", "int"), F.col("pos")).alias("cluster_id"),
        F.explode(F.try_variant_get("c", "$.indices", "array<variant>")).alias("i"))
    numeric = F.schema_of_variant("i").rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return member.where(numeric).select("run_id", "cluster_id", F.col("i").cast("double").cast("int").alias("record_index"))


def with_cache(signed: DataFrame, cache: DataFrame, compute) -> DataFrame:
    """Results by signature: cached where known, computed for the rest only."""
    known = signed.join(cache, "signature")
    fresh = compute(signed.join(cache, "signature", "left_anti"))
    return known.unionByName(fresh)


def service_stats(assigned: DataFrame) -> DataFrame:
    per_event = assigned.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    return per_event.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("files"), F.count(F.lit(1)).alias("clusters"),
                         F.coalesce(F.sum(F.when(F.col("event_id").isNotNull(), F.col("n"))), F.lit(0)).alias("written"))
