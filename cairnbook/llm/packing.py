"""Packing of token sequences: first-fit decreasing over a tournament tree of bin capacities."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnbook.llm import tokens

END_OF_TEXT = 1
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class CapacityTree:
    """Tournament tree over bins: each inner node holds the larger capacity of its two children."""

    def __init__(self, n_bins: int, capacity: int):
        self.leaves = 1 << max(0, (n_bins - 1).bit_length())
        self.best = [capacity] * (2 * self.leaves)

    def take(self, size: int) -> tuple[int, int]:
        """Put `size` into the first bin that has room; the bin and the room it had."""
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < size:
                node += 1
        had = best[node]
        best[node] = had - size
        chosen = node - self.leaves
        node //= 2
        while node:
            best[node] = max(best[2 * node], best[2 * node + 1])
            node //= 2
        return chosen, had


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in the bin) of each length; ties are taken in the order given."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree = CapacityTree(len(lengths), capacity)
    for i in np.argsort(-lengths, kind="stable").tolist():
        bins[i], had = tree.take(int(lengths[i]))
        offsets[i] = capacity - had
    return bins, offsets


def pieces(docs: DataFrame, *, capacity: int = 2048, ranks_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Tokenise whole texts (null: empty), add the end token and cut at multiples of `capacity`.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, ids.
    A row of `docs` is a document of its own even if its doc_id is null or repeated.
    """
    path = ranks_path or tokens.default_ranks()
    specials = None if ranks_path else tokens.default_specials()
    schema = _PIECES + (", ids array<long>" if with_ids else "")
    end = np.asarray([END_OF_TEXT], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.UnitEncoder(path, specials)
        for batch in batches:
            rows, ids = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                buffer = encoder.encode(text.as_py() or "") + end
                total = len(buffer) // 4
                for start in range(0, total, capacity):
                    part = buffer[4 * start:4 * (start + capacity)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int64))
            columns = [pa.array(column, pa.int64()) for column in (zip(*rows) if rows else [[]] * 5)]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, schema)


def pack(cut: DataFrame, *, capacity: int = 2048, group_pieces: int = 4096, seed: int = 7) -> DataFrame:
    """Add sequence_id and offset to pieces of at most `capacity` tokens.

    Pieces are dealt out at random (a hash of what identifies them and `seed`), read in that order
    and packed in groups of `group_pieces`, so a task holds one group whatever the input's size.
    A sequence's pieces follow each other without a gap from offset 0; sequence_id is unique.
    Repeated rows are packed as often as they occur; an empty input gives no row.
    """
    names = cut.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields) + ", sequence_id long, offset long"

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_sequence, waiting, held = TaskContext.get().partitionId() << 40, [], 0

        def flush(table: pa.Table) -> pa.RecordBatch:
            nonlocal next_sequence
            bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), capacity)
            sequence = pa.array(bins + next_sequence, pa.int64())
            next_sequence += int(bins.max()) + 1
            table = table.append_column("sequence_id", sequence).append_column("offset", pa.array(offsets, pa.int64()))
            return table.combine_chunks().to_batches(max_chunksize=group_pieces)[0]

        for batch in batches:
            waiting.append(batch.select(names))
            held += batch.num_rows
            while held >= group_pieces:
                table = pa.Table.from_batches(waiting)
                yield flush(table.slice(0, group_pieces))
                waiting = table.slice(group_pieces).to_batches()
                held -= group_pieces
        if held:
            yield flush(pa.Table.from_batches(waiting))

    dealt = (cut.withColumn("_deal", F.xxhash64("doc_id", "start", "ids_crc32", F.lit(seed))).repartition("_deal")
             .sortWithinPartitions("_deal", "doc_id", "start", "ids_crc32", "length"))
    return dealt.mapInArrow(fill, schema)


def materialize(packed: DataFrame) -> DataFrame:
    """Sequences with their ids in order, from packed pieces that carry ids: sequence_id, n_tokens, ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Tokenise, cut and pack `docs`; see `pieces` and `pack`."""
    of_pack = {k: options.pop(k) for k in ("group_pieces", "seed") if k in options}
    return pack(pieces(docs, **options), capacity=options.get("capacity", 2048), **of_pack)
