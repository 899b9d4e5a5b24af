"""Row numbers over large or skewed groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairnbook.session import ensure_checkpoint_dir


def number_rows(df: DataFrame, order: Sequence, by: Sequence[str] = (), name: str = "row_num") -> DataFrame:
    """Dense number 1.. of each row inside its group, in ``order``.

    A plain window would put a whole group (without ``by``: the whole table) into one
    task. Here the rows are range-partitioned by group *and* order, so a hot group is
    spread over many slices; each slice counts its own rows and is shifted by the rows
    of the slices before it. The slices are checkpointed, because slice bounds are
    sampled and both uses must see the same ones. ``order`` should be unique in a group."""
    ensure_checkpoint_dir(df.sparkSession)
    by = list(by)
    keys = [F.col(k) for k in by] + [F.col(o) if isinstance(o, str) else o for o in order]
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(slices, *keys).sortWithinPartitions(*keys)
              .withColumn("_slice", F.spark_partition_id())
              .withColumn("_seq", F.monotonically_increasing_id())
              .checkpoint())
    counts = ranged.groupBy(*by, "_slice").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # At most one row per group and slice, so this window stays small whatever the skew.
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    counts = counts.select(*[F.col(k).alias(f"_k_{k}") for k in by], F.col("_slice").alias("_k_slice"), "_first", "_before")
    same = F.col("_slice") == F.col("_k_slice")
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = ranged.join(counts if by else F.broadcast(counts), same)  # without groups: one row per slice
    return joined.withColumn(name, F.col("_seq") - F.col("_first") + F.col("_before") + 1).select(*df.columns, name)


def keep_best(df: DataFrame, keys: Sequence[str], rank: Column, rank_id: Column) -> DataFrame:
    """The row with the lowest ``rank`` of each group of ``keys``; all columns, no null key.

    The ranking aggregate sees keys, rank and ``rank_id`` only (a text or number, never null, that is equal for
    equal ranks alone), so long columns are neither sorted nor aggregated; the winners' rows are then fetched by a join on keys and
    ``rank_id``. Rows that share a group and a rank are told apart by their content; one of them stays."""
    keys = list(keys)
    marked = df.withColumn("_rank_id", rank_id)
    best = df.select(*keys, rank.alias("_rank"), rank_id.alias("_rank_id")).groupBy(*keys).agg(F.min_by("_rank_id", "_rank").alias("_rank_id"))
    found = marked.join(best, [*keys, "_rank_id"], "left_semi")
    # The join has dealt and sorted the rows by these columns already.
    order = Window.partitionBy(*keys, "_rank_id").orderBy(F.xxhash64(*(c for c, t in df.dtypes if "map<" not in t and "variant" not in t)))
    return found.withColumn("_n", F.row_number().over(order)).where("_n = 1").select(*df.columns)
