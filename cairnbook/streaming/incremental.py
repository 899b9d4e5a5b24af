"""Incremental ingest, ledger upsert, re-fusion and publication.

Sinks of state write the folder ``batch_id=N`` of their micro-batch in overwrite mode: a batch
that is repeated after a lost executor or driver replaces its own output, so results
are counted once. Current state is a query over these folders (newest per address,
latest per event); ``compact_tiers`` folds them when they have become many."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cairnbook.operators import bloom
from cairnbook.operators.fusion import fuse_long
from cairnbook.operators.ledger import newest_per_url
from cairnbook.sources.readers import judged_documents, last_key_wins
from cairnbook.sources.writers import path_exists


#: Folders that the events of a log are dealt into.
SHARDS = 64
#: Folders of one tier of the ledger log that are folded into one of the next.
FAN = 8


def document_stream(spark: SparkSession, path: str, pattern: str = "accident_info.json", whole: bool = True,
                    files_per_batch: int = 1000) -> DataFrame:
    """Documents of a growing folder as a stream: ``file_path, artifact_json, reason, value``, see ``judged_documents``."""
    reader = (spark.readStream.format("text").option("wholetext", whole).option("recursiveFileLookup", True)
              .option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch))
    return judged_documents(reader.load(path).select(F.col("_metadata.file_path").alias("file_path"), "value"))


def artifact_stream(spark: SparkSession, path: str, pattern: str = "accident_info.json", whole: bool = True,
                    files_per_batch: int = 1000) -> DataFrame:
    """Artifacts of a growing folder as a stream: ``file_path, artifact_json``."""
    return document_stream(spark, path, pattern, whole, files_per_batch).where("reason IS NULL").select("file_path", "artifact_json")


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything that has arrived, batch by batch, and stop."""
    with last_key_wins(stream.sparkSession):
        query = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()


def ingest(stream: DataFrame, log: str, checkpoint: str) -> None:
    """Append the stream to a parquet log, exactly once."""
    with last_key_wins(stream.sparkSession):
        query = (stream.writeStream.format("parquet").option("path", log).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()


def ingest_judged(documents: DataFrame, log: str, rejects: str, checkpoint: str) -> None:
    """Readable documents to ``log`` and the others, with their reason, to ``rejects``: every document is in one of them.

    Both write the batch's own folder in overwrite mode, so a repeated batch replaces itself."""
    def each(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        held.where("reason IS NULL").select("file_path", "artifact_json").write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")
        held.where("reason IS NOT NULL").select("file_path", "reason", "value").write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        held.unpersist()
    _run(documents, each, checkpoint)


def upsert_ledger(rows: DataFrame, log: str, checkpoint: str, ts: str = "extracted_at", order: str = "record_id", fan: int = FAN) -> None:
    """Add the newest row per address of each micro-batch to the ledger log, and fold full tiers of it."""
    def each(batch: DataFrame, batch_id: int) -> None:
        newest_per_url(batch, ts, order).write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")
        compact_tiers(batch.sparkSession, log, ts, order, fan)
    _run(rows, each, checkpoint)


def current_ledger(spark: SparkSession, log: str, ts: str = "extracted_at", order: str = "record_id") -> DataFrame:
    return newest_per_url(spark.read.parquet(log).drop("batch_id"), ts, order)


def compact(spark: SparkSession, log: str, target: str, ts: str = "extracted_at", order: str = "record_id") -> None:
    """Write the current ledger as the first folder of a new log."""
    current_ledger(spark, log, ts, order).write.mode("overwrite").parquet(f"{target}/batch_id=-1")


def _folders(spark: SparkSession, log: str) -> tuple[object, dict[int, list[tuple[int, str]]]]:
    """The file system of a log, and its folders by tier: last batch and path, oldest first. A plain batch is tier 0."""
    root = spark._jvm.org.apache.hadoop.fs.Path(log)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    tiers: dict[int, list[tuple[int, str]]] = {}
    for entry in files.listStatus(root):
        name = re.fullmatch(r"batch_id=(-?\d+)(?:_t(\d+))?", entry.getPath().getName())
        if name and entry.isDirectory():
            tiers.setdefault(int(name[2] or 0), []).append((int(name[1]), entry.getPath().toString()))
    return files, {tier: sorted(found) for tier, found in tiers.items()}


def compact_tiers(spark: SparkSession, log: str, ts: str = "extracted_at", order: str = "record_id", fan: int = FAN) -> None:
    """Fold the oldest ``fan`` folders of every full tier into one folder of the next, newest row per address.

    A row is written again once per tier, and a log of n batches has at most ``fan - 1`` folders in each of log(n) tiers.
    The folded folder is complete before its parts are deleted, and rows that stand in both count once, so a run that
    breaks off anywhere leaves the same ledger. One writer at a time, and readers start anew if a part goes under them."""
    if fan < 2:
        raise ValueError("a tier needs two folders at least")
    tier = 0
    while True:
        files, tiers = _folders(spark, log)
        if tier > max(tiers, default=-1):
            return
        parts = tiers.get(tier, [])[:fan]
        if len(parts) < fan:
            tier += 1
            continue
        paths = [path for _, path in parts]
        newest_per_url(spark.read.parquet(*paths), ts, order).write.mode("overwrite").parquet(f"{log}/batch_id={parts[-1][0]}_t{tier + 1}")
        for path in paths:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)


def _shard(event_id: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(event_id), F.lit(shards)).cast("int")


def refuse_touched(rows: DataFrame, artifacts: str, fused: str, checkpoint: str, shards: int = SHARDS) -> None:
    """Keep the artifact log and fuse again only the events a micro-batch touches.

    ``rows`` has ``event_id, record_id, extraction_confidence_score, artifact_json``. The log is dealt by a hash of
    the event into ``shards`` folders, and a batch reads only those of its own events, whatever the history; the
    numbers of these folders are all that comes to the driver. Fused events are kept in long form, dealt alike."""
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"{artifacts}/batch_id={batch_id}"
        batch.withColumn("shard", _shard(F.col("event_id"), shards)).hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(own)
        now = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("shard", T.IntegerType())])).parquet(own)
        met = sorted(r.shard for r in now.select("shard").distinct().collect())
        seen = touched_log(spark, artifacts, met).where(F.col("batch_id") <= batch_id)
        again = seen.join(now.select("event_id").distinct(), "event_id", "left_semi").drop("batch_id", "shard")
        long = fuse_long(again).withColumn("shard", _shard(F.col("event_id"), shards))
        long.hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(f"{fused}/batch_id={batch_id}")
    _run(rows, each, checkpoint)


def touched_log(spark: SparkSession, artifacts: str, met: Sequence[int]) -> DataFrame:
    """The artifact log of some shards; the others' folders are not read."""
    return spark.read.parquet(artifacts).where(F.col("shard").isin(list(met)))


def latest_fused(spark: SparkSession, fused: str) -> DataFrame:
    """The long form of each event from the last batch that fused it."""
    rows = spark.read.parquet(fused)
    last = rows.groupBy("shard", "event_id").agg(F.max("batch_id").alias("batch_id"))
    return rows.join(last, ["shard", "event_id", "batch_id"]).drop("batch_id", "shard")


def publish_once(rows: DataFrame, target: str, checkpoint: str, keys: Sequence[str] = ("record_id",), shards: int = SHARDS) -> None:
    """Publish each row one time, told by ``keys``: rows whose keys the target holds are left out. Of different rows
    with the same keys in one batch the first in order of their JSON text counts.

    The target is dealt by a hash of the keys into ``shards`` folders (column ``shard``), always the same number. A batch reads
    the keys of its own shards, and of those only what a Bloom filter over its keys lets through meets it in the join.
    The guard is content, so a lost checkpoint, repeated batches and rows that arrive between runs are all
    right; a batch that failed midway left nothing that can be read."""
    keys = list(keys)

    def each(batch: DataFrame, batch_id: int) -> None:
        first = Window.partitionBy(*keys).orderBy(F.to_json(F.struct(*batch.columns)))
        fresh = (batch.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
                 .withColumn("shard", F.pmod(F.xxhash64(*keys), F.lit(shards)).cast("int"))).persist()
        out = fresh
        if path_exists(batch.sparkSession, target):
            held = held_keys(fresh, target, keys)
            same = [F.col(f"new.{k}").eqNullSafe(F.col(f"held.{k}")) for k in keys]
            out = fresh.alias("new").join(held.alias("held"), same, "left_anti")
        out.hint("rebalance", "shard").write.mode("append").partitionBy("shard").parquet(target)
        fresh.unpersist()
    _run(rows, each, checkpoint)


def held_keys(fresh: DataFrame, target: str, keys: Sequence[str]) -> DataFrame:
    """Keys in ``target`` that rows of ``fresh`` (with their ``shard``) may meet. One count per shard comes to the driver."""
    met = {r["shard"]: r["count"] for r in fresh.groupBy("shard").count().collect()}
    bits = bloom.bits_for(sum(met.values()))
    may = bloom.may_hold(bloom.build(fresh, F.xxhash64(*keys), bits), F.xxhash64(*keys), bits)
    held = fresh.sparkSession.read.schema(fresh.schema).parquet(target)
    return held.where(F.col("shard").isin(sorted(met))).where(may).select(*keys)
