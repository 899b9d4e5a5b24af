"""Batches of records and the extractor's answers to them, as tables.

A batch answer is ``batch_id, raw``; batch items are ``batch_id, pos`` (0-based) and the item's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnbook.functions import jsons as J
from cairnbook.functions.extract import publication_date, report_author
from cairnbook.functions.strings import prefix, strip
from cairnbook.operators.ranking import number_rows


def assign_batches(df: DataFrame, size: int, order: str) -> DataFrame:
    """Consecutive groups of ``size`` rows: ``batch_id`` from 1, ``pos`` from 0."""
    numbered = number_rows(df, [order], name="_n")
    return (numbered.withColumn("batch_id", F.floor((F.col("_n") - 1) / size) + 1)
            .withColumn("pos", ((F.col("_n") - 1) % size).cast("int")).drop("_n"))


def batch_payloads(items: DataFrame) -> DataFrame:
    """Request body per batch from ``url, hints, focused_text, full_text``; a batch is small by construction."""
    item = F.struct(F.col("url"), F.to_json("hints").alias("pre_extracted"),
                    prefix(F.col("focused_text"), 12000).alias("article_focused"),
                    prefix(F.coalesce("full_text", F.lit("")), 16000).alias("article_full"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", item.alias("item"))))
    return items.groupBy("batch_id").agg(
        F.to_json(F.struct(F.transform(ordered, lambda x: x["item"]).alias("items"))).alias("payload"))


def answer_items(raw: Column) -> Column:
    """Items of an answer as array<variant>: the text as it is, else from the first ``[`` to the last ``]``."""
    text = strip(raw)
    inner = F.regexp_extract(text, r"(?s)\[.*\]", 0)
    return F.coalesce(J.items(F.try_parse_json(text)), J.items(F.try_parse_json(inner)))


def answer_object(raw: Column) -> Column:
    """A single object answer, with the same fallback to the braces."""
    text = strip(raw)
    is_object = lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), v)
    return F.coalesce(is_object(F.try_parse_json(text)), is_object(F.try_parse_json(F.regexp_extract(text, r"(?s)\{.*\}", 0))))


def parse_responses(responses: DataFrame) -> DataFrame:
    """``batch_id, pos, item_json`` of all readable answers; an item that is no object counts as ``{}``."""
    rows = responses.select("batch_id", F.posexplode(answer_items(F.col("raw"))).alias("pos", "item"))
    return rows.select("batch_id", "pos", F.when(J.kind(F.col("item")) == "OBJECT", F.to_json("item"))
                       .otherwise(F.lit("{}")).alias("item_json"))


def unreadable(responses: DataFrame) -> DataFrame:
    return responses.where(answer_items(F.col("raw")).isNull()).select("batch_id")


def align(items: DataFrame, answers: DataFrame) -> DataFrame:
    """Every batch item once, with the answer at its position or null; surplus answers are ignored."""
    return items.join(answers, ["batch_id", "pos"], "left")


def minimal_artifacts(aligned: DataFrame) -> DataFrame:
    """Records for items without an answer: texts, hints and what the text rules find."""
    body = F.coalesce(F.nullif("full_text", F.lit("")), F.col("focused_text"))
    return aligned.where(F.col("item_json").isNull()).select(
        "batch_id", "pos", F.col("url").alias("source_url"), F.col("focused_text").alias("article_text"),
        F.col("full_text").alias("scraped_full_text"), report_author(body).alias("report_author"),
        publication_date(body).alias("article_date_published"))


def admit_batches(items: DataFrame, cap: int) -> DataFrame:
    """``admitted`` tells whether a batch is within the cap of calls; 0 means no cap."""
    return items.withColumn("admitted", F.lit(True) if cap <= 0 else F.col("batch_id") <= cap)


def token_totals(calls: DataFrame) -> DataFrame:
    """Token sums per model and overall (``model`` null)."""
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return (calls.rollup("model").agg(zero("prompt").alias("prompt"), zero("completion").alias("completion"))
            .withColumn("total", F.col("prompt") + F.col("completion")))
