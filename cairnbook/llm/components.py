"""Connected components over edge tables by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnbook.session import ensure_checkpoint_dir


#: Edges of a partition of a small graph; without it the rounds of a small graph are mostly empty tasks.
EDGES = 500_000


def compact(rows: DataFrame, most: int = EDGES) -> DataFrame:
    """A checkpoint of rows in as few partitions as they fill, `most` to each: narrow ones by default.

    What fills one partition is grouped and joined in it, without exchanges."""
    held = rows.checkpoint()
    return held.coalesce(-(-max(1, held.count()) // most))


def _starred(edges: DataFrame, small: bool, single: bool = False) -> DataFrame:
    """One star step over (u, v), u > v: every neighbour is tied to the smallest of them.

    The smallest neighbour is a partial aggregate; the join back is one that Spark can split, so a
    node with a third of all edges does not meet in one task. `single`: the edges lie in one partition and stay there."""
    joined = (lambda df: df.coalesce(1)) if single else (lambda df: df)
    both = edges if small else joined(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = both.join(least, "u")
    if small:
        out = joined(tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))))
    else:
        out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (columns a, b: longs); component is its smallest node.

    Loops, repeats and either direction are allowed; nodes without edges are not returned."""
    ensure_checkpoint_dir(edges.sparkSession)
    at = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    state = None
    while True:
        now = tuple(at.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
        parts = -(-max(1, now[0]) // EDGES)
        at = at.coalesce(parts)
        at = _starred(_starred(at, False, parts == 1), True, parts == 1).checkpoint()
    at = at.coalesce(-(-max(1, now[0]) // EDGES))
    found = at.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").union(
        at.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    return found.coalesce(1) if now[0] <= EDGES else found
