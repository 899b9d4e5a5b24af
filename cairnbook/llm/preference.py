"""Preference pairs: the common turns of a chosen and a rejected conversation once as prompt, the rest as masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def turn_lists(turns: DataFrame, name: str) -> DataFrame:
    """pair_id and `name`: its turns in order of (turn, role, text). Null roles and texts are empty."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.groupBy("pair_id").agg(F.sort_array(F.collect_list(turn)).alias(name))


def _inner(text: Column) -> Column:
    """A text cannot open a marker: a space goes between its two characters."""
    return F.replace(text, F.lit(OPEN), F.lit("< |"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _inner(turn["role"]), F.lit(CLOSE))


def _body(turn: Column) -> Column:
    return F.concat(_inner(turn["text"]), F.lit(END))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def mask(turns: Column, trained_role: str) -> Column:
    """Run lengths (code points) and 0 or 1 of a rendering: 1 over the text and end marker of `trained_role`."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.length(_head(t)).cast("string"), F.lit(":0,"), F.length(_body(t)).cast("string"), F.when(t["role"] == trained_role, F.lit(":1")).otherwise(F.lit(":0")))), ",")


def format_pairs(chosen: DataFrame, rejected: DataFrame, *, trained_role: str = "assistant") -> DataFrame:
    """pair_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask.

    Inputs hold pair_id, turn, role, text. Turns agree if role and text do; turn numbers only order
    them. A pair that one side lacks has an empty completion there and no prompt; equal conversations
    are all prompt. Rows with a null pair_id are left out. One shuffle per side, on pair_id.
    """
    sides = turn_lists(chosen.where("pair_id is not null"), "c").join(turn_lists(rejected.where("pair_id is not null"), "r"), "pair_id", "full")
    empty = F.expr("cast(array() as array<struct<turn:bigint,role:string,text:string>>)")
    both = sides.select("pair_id", *(F.coalesce(F.transform(x, lambda t: F.struct(t["turn"].cast("long").alias("turn"), t["role"].alias("role"), t["text"].alias("text"))), empty).alias(x) for x in ("c", "r")))
    apart = F.array_position(F.zip_with("c", "r", lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])), F.lit(False))
    cut = both.select("pair_id", "c", "r", F.when(apart > 0, apart - 1).otherwise(F.size("c")).cast("int").alias("n"))
    rest = cut.select("pair_id", "n", F.slice("c", F.lit(1), F.col("n")).alias("p"), *(F.slice(x, F.col("n") + 1, F.greatest(F.size(x), F.lit(1))).alias(x) for x in ("c", "r")))
    return rest.select("pair_id", F.col("n").cast("long").alias("n_prompt_turns"), rendered(F.col("p")).alias("prompt"),
                       rendered(F.col("c")).alias("chosen"), mask(F.col("c"), trained_role).alias("chosen_mask"),
                       rendered(F.col("r")).alias("rejected"), mask(F.col("r"), trained_role).alias("rejected_mask"))
