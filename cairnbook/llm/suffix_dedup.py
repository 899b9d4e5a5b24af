"""Exact substring removal by sorted suffixes.

A byte goes if a string of `LENGTH` bytes over it also starts anywhere else. Every start of such a
string is a suffix; its anchor is the leftmost least token of `TOKEN` bytes inside the string, so
equal strings have equal anchors at equal distances. Only suffixes whose anchor token occurs twice
can repeat. They are range-partitioned by the anchor token with sampled splitters; a bucket sorts its
suffixes by multikey quicksort over four tokens of 100 bytes, and suffixes that stay equal to the
fourth are repeats. A token that too many places share is cut across buckets by the tokens around
the anchor, with counts instead of a sort. Compared are 64-bit fingerprints of the strings.

Passages of `PASSAGE` words that another text has too are told beside that, and nothing is removed for
them: they may have fewer than `LENGTH` bytes. They are found the same way, with words for bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnbook.session import ensure_checkpoint_dir

LENGTH, TOKEN = 400, 64
KMERS = LENGTH - TOKEN + 1
LEVELS = 4
#: Words of a passage that is told, and of its anchor token.
PASSAGE, SHINGLE = 51, 10
#: Bytes worked on at once in a task; positions in it take this many bits.
POSITION_BITS = 22
CHUNK = 1 << POSITION_BITS
#: Places that share an anchor token beyond which they are not brought to one bucket.
HOT = 2048
#: Distances from the anchor that a block of the hot way covers.
BLOCK = 21
#: Most ids that are broadcast to pick texts; more of them are joined.
BROADCAST_IDS = 4_000_000
SPLITTERS = 512

_random = np.random.default_rng(9)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + _random.integers(0, 2, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for the worker's life."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.ones(max(n, 1 << 16), np.uint64)
        step, done = np.asarray([base], np.uint64), 1
        while done < len(held):
            more = min(done, len(held) - done)
            held[done:done + more] = held[:more] * step
            step, done = step * step, done + more
        _powers[base] = held
    return held[:n]


class Fingerprints:
    """Fingerprints of any substrings of a buffer of bytes, or of 64-bit values, from sums over its prefixes."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_BYTE[data] if data.dtype == np.uint8 else data) * _power(_INVERSE, len(data)), out=self.sums[1:])
        self.shift = _power(_BASE, len(data) + 1)

    def of(self, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        h = (self.sums[starts + length] - self.sums[starts]) * self.shift[starts]
        return (h ^ (h >> np.uint64(31))) * _MIX


def _window_anchors(h: np.ndarray, kmers: int) -> np.ndarray:
    """Place of the leftmost least of the `kmers` fingerprints from each place on."""
    packed = (h & np.uint64(~(CHUNK - 1) & 0xFFFFFFFFFFFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    blocks = -(-len(packed) // kmers)
    padded = np.full(blocks * kmers, 0xFFFFFFFFFFFFFFFF, np.uint64)
    padded[:len(packed)] = packed
    grid = padded.reshape(blocks, kmers)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = len(h) - kmers + 1
    return (np.minimum(after[:starts], before[kmers - 1:kmers - 1 + starts]) & np.uint64(CHUNK - 1)).astype(np.int64)


def merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of intervals, sorted; runs that touch are one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])]


def multikey_quicksort(n: int, key_at, levels: int) -> np.ndarray:
    """Indices 0 .. n - 1 that share all `levels` keys with another index.

    Sorted by the first key; runs of equal keys alone are sorted on by the next. `key_at(level,
    indices)` gives the keys."""
    alive, run = np.arange(n), np.zeros(n, np.int64)
    for level in range(levels):
        key = key_at(level, alive)
        order = np.argsort(key, kind="quicksort") if level == 0 else np.lexsort((key, run))
        alive, run, key = alive[order], run[order], key[order]
        new = np.concatenate([[True], (run[1:] != run[:-1]) | (key[1:] != key[:-1])])[:len(alive)]
        last = np.concatenate([new[1:], [True]])[:len(alive)]
        equal = ~(new & last)
        run = np.cumsum(new)[equal]
        alive = alive[equal]
    return alive


def _anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token, position, first start, last start) of the anchors of one buffer of a text, and the
    (start, end) runs that repeat inside it."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none, none
    prints = Fingerprints(data)
    at = _window_anchors(prints.of(np.arange(len(data) - TOKEN + 1), TOKEN), KMERS)
    low = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    high = np.concatenate([low[1:] - 1, [len(at) - 1]])
    at = at[low]
    token = prints.of(at, TOKEN)
    if len(np.unique(token)) == len(token):
        return token.view(np.int64), at, low, high, none, none
    starts = np.arange(len(data) - LENGTH + 1)
    again = np.sort(multikey_quicksort(len(starts), lambda level, i: prints.of(i + level * (LENGTH // LEVELS), LENGTH // LEVELS), LEVELS))
    own = merge(again, again + LENGTH)
    around = prints.of(low, high - low + LENGTH)
    _, first = np.unique(np.column_stack([token, around, (at - low).astype(np.uint64)]), axis=0, return_index=True)
    first.sort()
    return token[first].view(np.int64), at[first], low[first], high[first], *own


def word_prints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint, start, end) of the words of a text, cut at ASCII white space."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _WHITE[data], [True]])))
    start, end = edges[::2], edges[1::2]
    prints, i = [np.zeros(0, np.uint64)], 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + CHUNK, side="right")))
        prints.append(Fingerprints(data[start[i]:end[j - 1]]).of(start[i:j] - start[i], end[i:j] - start[i:j]))
        i = j
    return np.concatenate(prints), start, end


def passage_prints(words: np.ndarray) -> np.ndarray:
    """Fingerprints of the passages that start at each word."""
    parts = [words[b:b + CHUNK] for b in range(0, len(words) - PASSAGE + 1, CHUNK - PASSAGE + 1)]
    return np.concatenate([np.zeros(0, np.uint64), *(Fingerprints(p).of(np.arange(len(p) - PASSAGE + 1), PASSAGE) for p in parts)])


def _passage_anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, first start, number of starts) of the anchors of a text's passages; of what repeats in the text the first."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32))]
    for begin in range(0, len(words) - PASSAGE + 1, CHUNK - PASSAGE + 1):
        prints = Fingerprints(part := words[begin:begin + CHUNK])
        at = _window_anchors(prints.of(np.arange(len(part) - SHINGLE + 1), SHINGLE), PASSAGE - SHINGLE + 1)
        low = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        n = np.diff(np.concatenate([low, [len(at)]]))
        at = at[low]
        token = prints.of(at, SHINGLE)
        if len(np.unique(token)) < len(token):
            _, first = np.unique(np.column_stack([token, prints.of(low, n - 1 + PASSAGE), (at - low).astype(np.uint64)]), axis=0, return_index=True)
            token, low, n = token[first], low[first], n[first]
        found.append((token.view(np.int64), (low + begin).astype(np.int32), n.astype(np.int32)))
    return tuple(np.concatenate(x) for x in zip(*found))


def _key(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def _keyed(docs: DataFrame) -> DataFrame:
    """rid (the doc_id; a hash of the text for a null id), key and text, null as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.xxhash64("text")).alias("rid"), _key(F.col("text")).alias("key"), "text")


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, rid, key, sha256, n_bytes, its anchors, the runs that repeat inside it, n_words and the anchors of its passages."""
    schema = "doc_id long, rid long, key binary, sha256 string, n_bytes long, token array<long>, at array<long>, low array<long>, high array<long>, own_start array<long>, own_end array<long>, n_words long, word_token array<long>, word_low array<int>, word_n array<int>"

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list] = [[] for _ in range(11)]
            for text in batch.column(4):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                parts = []
                for begin in range(0, max(1, len(data) - LENGTH + 1), CHUNK - LENGTH + 1):
                    part = _anchors(data[begin:begin + CHUNK])
                    parts.append((part[0], *(x + begin for x in part[1:])))
                found[0].append(len(data))
                for k in range(6):
                    found[k + 1].append(parts[0][k] if len(parts) == 1 else np.concatenate([p[k] for p in parts]))
                words = word_prints(data)[0]
                for column, x in zip(found[7:], (len(words), *_passage_anchors(words))):
                    column.append(x)
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 6, pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 2]
            arrays = [pa.array(x, k) for x, k in zip(found, kinds)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), *arrays], names=[x.split()[0] for x in schema.split(", ")])

    rows = _keyed(docs).select("doc_id", "rid", "key", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), "text")
    return rows.mapInArrow(scanned, schema)


def _texts(docs: DataFrame, ids: DataFrame, by_key: DataFrame) -> DataFrame:
    """`by_key` (key, ...) with the text of its key; only texts whose rid is in `ids` are moved."""
    only = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return _keyed(docs).join(only, "rid", "left_semi").select("key", "text").join(by_key, "key")


_HITS = "collect_list(struct(token, at, low, high)) AS hits"


def _contexts(docs: DataFrame, hits: DataFrame, reps: DataFrame, splitters: np.ndarray) -> DataFrame:
    """bucket, token, key, at (of the anchor in the context), low (of the context in the text), n (strings that
    start in it), context: each hit with the bytes of all strings that it anchors."""
    schema = "bucket int, token long, key binary, at int, low long, n int, context binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, hits_of in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = text.as_buffer().to_pybytes()
                for begin in range(0, len(hits_of), 2000):
                    some = hits_of[begin:begin + 2000]
                    token = np.asarray([h["token"] for h in some], np.int64)
                    columns = [pa.array(np.searchsorted(splitters, token, side="right").astype(np.int32)), pa.array(token), pa.array([key] * len(some), pa.binary()),
                               pa.array([h["at"] - h["low"] for h in some], pa.int32()), pa.array([h["low"] for h in some], pa.int64()),
                               pa.array([h["high"] - h["low"] + 1 for h in some], pa.int32()), pa.array([data[h["low"]:h["high"] + LENGTH] for h in some], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    by_key = hits.groupBy("key").agg(F.expr(_HITS))
    ids = reps.join(by_key.select("key"), "key", "left_semi").select("rid").distinct().checkpoint()
    return _texts(docs, ids, by_key).select("key", "text", "hits").mapInArrow(cut, schema)


def _starts(contexts: list[bytes], n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joined bytes of contexts, the start of every string in them, and which context it is of."""
    begins = np.cumsum([0, *map(len, contexts)])[:-1]
    owner = np.repeat(np.arange(len(contexts)), n)
    return np.frombuffer(b"".join(contexts), np.uint8), np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + begins[owner], owner


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of whole tokens (the first column, by which rows lie sorted; the last is bytes), many tokens at once; a token with one row is left out."""
    group: list[tuple] = []
    waiting: list[tuple] = []
    held = 0
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if group and row[0] != group[-1][0]:
                if len(group) > 1:
                    waiting += group
                    held += sum(len(r[-1]) for r in group)
                group = []
                if held >= CHUNK // 2:
                    yield waiting
                    waiting, held = [], 0
            group.append(row)
    if len(group) > 1:
        waiting += group
    if waiting:
        yield waiting


def _repeats(buckets: DataFrame) -> DataFrame:
    """key, start, end of what repeats, from contexts that lie sorted by token in their bucket."""

    def sort_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            n = np.asarray([r[3] for r in rows])
            data, starts, owner = _starts([r[4] for r in rows], n)
            prints = Fingerprints(data)
            size = LENGTH // LEVELS
            again = multikey_quicksort(len(starts), lambda level, i: prints.of(starts[i] + level * size, size), LEVELS)
            first, last = np.full(len(rows), len(data)), np.full(len(rows), -1)
            np.minimum.at(first, owner[again], starts[again])
            np.maximum.at(last, owner[again], starts[again])
            shift = np.asarray([r[2] for r in rows]) - np.cumsum([0, *(len(r[4]) for r in rows)])[:-1]
            hit = np.flatnonzero(last >= 0)
            yield pa.RecordBatch.from_arrays([pa.array([rows[i][1] for i in hit], pa.binary()), pa.array(first[hit] + shift[hit]), pa.array(last[hit] + shift[hit] + LENGTH)], names=["key", "start", "end"])

    return buckets.select("token", "key", "low", "n", "context").mapInArrow(sort_bucket, "key binary, start long, end long")


def _marked(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """`rows` with `name`: true where the values of `by`, none null, occur more than once.

    Rows without a value are left out of the join, and groups of more than HOT rows are sent to the tasks, so that no task gets a group."""
    some = rows.dropna(subset=by)
    groups = some.groupBy(*by).count().where("count > 1").checkpoint()
    often = groups.where(F.col("count") > HOT).select(*by, F.lit(True).alias(name))
    often = F.broadcast(often) if often.count() <= BROADCAST_IDS else often
    few = groups.where(F.col("count") <= HOT).select(*by, F.lit(True).alias(name))
    none = rows.where(" or ".join(f"{c} is null" for c in by)).withColumn(name, F.lit(None).cast("boolean"))
    rest = some.join(often, by, "left_anti").join(few, by, "left")
    return rest.unionByName(some.join(often, by)).unionByName(none)


def _hot_repeats(contexts: DataFrame) -> DataFrame:
    """key, start, end of what repeats around anchor tokens that very many places share.

    The strings of an anchor are cut into blocks of neighbouring distances. A block whose whole
    bytes occur twice repeats; one whose common bytes occur once does not; of the rest each
    string is counted. All are counts with partial sums, so no place holds a token's occurrences."""
    contexts = contexts.checkpoint()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for token, key, at, low, n, context in zip(*(batch.column(k).to_pylist() for k in range(6))):
                prints = Fingerprints(np.frombuffer(context, np.uint8))
                for b in range((at - n + 1) // BLOCK, at // BLOCK + 1):
                    near, far = b * BLOCK, (b + 1) * BLOCK - 1
                    core = int(prints.of(np.asarray([at - near]), LENGTH - BLOCK + 1).view(np.int64)[0])
                    whole = int(prints.of(np.asarray([at - far]), LENGTH + BLOCK - 1).view(np.int64)[0]) if far <= at and near >= at - n + 1 else None
                    rows.append((token, key, low, b, core, whole, low + max(0, at - far), low + min(n - 1, at - near) + LENGTH))
            columns = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["token", "key", "low", "block", "core", "whole", "start", "end"])

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, at, low, n, context, block in zip(*(batch.column(k).to_pylist() for k in range(6))):
                starts = np.arange(max(0, at - (block + 1) * BLOCK + 1), min(n - 1, at - block * BLOCK) + 1)
                prints = Fingerprints(np.frombuffer(context, np.uint8)).of(starts, LENGTH)
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(starts), pa.binary()), pa.array(starts + low), pa.array(prints.view(np.int64))], names=["key", "start", "print"])

    cut = contexts.select("token", "key", "at", "low", "n", "context").mapInArrow(blocks, "token long, key binary, low long, block int, core long, whole long, start long, end long").checkpoint()
    judged = _marked(_marked(cut, ["whole"], "repeats").checkpoint(), ["token", "block", "core"], "open").checkpoint()
    unsure = judged.where("repeats is null and open")
    # A string of an unsure block may equal one inside a block that repeats whole: one of each such kind is counted too.
    partners = judged.where("repeats").join(unsure.select("token", "block", "core").distinct(), ["token", "block", "core"], "left_semi").dropDuplicates(["whole"])
    open_ = unsure.select("key", "low", "token", "block").union(partners.select("key", "low", "token", "block"))
    single = contexts.join(open_, ["key", "low", "token"]).select("key", "at", "low", "n", "context", "block").mapInArrow(strings, "key binary, start long, print long").checkpoint()
    again = _marked(single, ["print"], "repeats").where("repeats")
    return judged.where("repeats").select("key", "start", "end").union(again.select("key", "start", (F.col("start") + LENGTH).alias("end")))


def find_repeats(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """key, start, end: byte runs of distinct texts that repeat; runs of a key may overlap."""
    own = texts.select("key", F.explode(F.arrays_zip("own_start", "own_end")).alias("x")).select("key", F.col("x.own_start").alias("start"), F.col("x.own_end").alias("end"))
    anchors = texts.select("key", F.explode(F.arrays_zip("token", "at", "low", "high")).alias("x")).select("key", "x.*")
    shared = anchors.groupBy("token").agg(F.count("*").alias("places")).where("places > 1")
    hits = anchors.join(shared, "token").checkpoint()
    sampled = hits.select("token").where(F.pmod(F.xxhash64("token"), F.lit(64)) == 0).approxQuantile("token", [k / SPLITTERS for k in range(1, SPLITTERS)], 0.0005)
    splitters = np.unique(np.asarray(sampled, np.float64)).astype(np.int64)
    reps = texts.select("key", "rid")
    buckets = _contexts(docs, hits.where(F.col("places") <= HOT).drop("places"), reps, splitters).repartition("bucket").sortWithinPartitions("token")
    found = _repeats(buckets).union(own)
    hot = hits.where(F.col("places") > HOT)
    return found.union(_hot_repeats(_contexts(docs, hot.drop("places"), reps, splitters))) if hot.limit(1).count() else found


def find_passages(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """key, start, end: runs of words (numbers of words) in which every `PASSAGE` words are in another text too; of
    passages that a text repeats, the first at least. Runs of a key may overlap."""

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, hits_of in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                prints = passage_prints(word_prints(np.frombuffer(text.as_buffer(), np.uint8))[0])
                for begin in range(0, len(hits_of), 20000):
                    some = hits_of[begin:begin + 20000]
                    columns = [pa.array([h["token"] for h in some], pa.int64()), pa.array([h["hot"] for h in some], pa.bool_()), pa.array([key] * len(some), pa.binary()),
                               pa.array([h["low"] for h in some], pa.int32()), pa.array([prints[h["low"]:h["low"] + h["n"]].tobytes() for h in some], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["token", "hot", "key", "low", "prints"])

    def sort_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            prints = np.frombuffer(b"".join(r[3] for r in rows), np.uint64)
            n = np.asarray([len(r[3]) // 8 for r in rows])
            owner = np.repeat(np.arange(len(rows)), n)
            numbers: dict[bytes, int] = {}
            text = np.asarray([numbers.setdefault(r[1], len(numbers)) for r in rows])[owner]
            again = multikey_quicksort(len(prints), lambda level, i: prints[i], 1)
            if not len(again):
                continue
            run = np.flatnonzero(np.concatenate([[True], prints[again][1:] != prints[again][:-1]]))
            several = np.minimum.reduceat(text[again], run) != np.maximum.reduceat(text[again], run)
            hit = np.sort(again[np.repeat(several, np.diff(np.concatenate([run, [len(again)]])))])
            first = np.flatnonzero(np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])])[:len(hit)])
            last = np.concatenate([first[1:] - 1, [len(hit) - 1]])[:len(first)]
            shift = (np.asarray([r[2] for r in rows]) - (np.cumsum(n) - n))[owner]
            yield pa.RecordBatch.from_arrays([pa.array([rows[i][1] for i in owner[hit[first]]], pa.binary()), pa.array(hit[first] + shift[hit[first]]),
                                              pa.array(hit[last] + shift[hit[last]] + PASSAGE)], names=["key", "start", "end"])

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
            starts = [low + np.arange(len(x)) for low, x in zip(batch.column(1).to_pylist(), prints)]
            keys = batch.column(0).take(pa.array(np.repeat(np.arange(len(prints)), [len(x) for x in prints])))
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.concatenate([none, *starts])), pa.array(np.concatenate([none, *prints]))], names=["key", "start", "print"])

    anchors = texts.select("key", F.explode(F.arrays_zip("word_token", "word_low", "word_n")).alias("x")).select(
        "key", F.col("x.word_token").alias("token"), F.col("x.word_low").alias("low"), F.col("x.word_n").alias("n"))
    shared = anchors.groupBy("token").agg(F.count("*").alias("places")).where("places > 1").select("token", (F.col("places") > HOT).alias("hot"))
    by_key = anchors.join(shared, "token").groupBy("key").agg(F.expr("collect_list(struct(token, hot, low, n)) AS hits")).checkpoint()
    ids = texts.select("key", "rid").join(by_key.select("key"), "key", "left_semi").select("rid").distinct().checkpoint()
    found = _texts(docs, ids, by_key).select("key", "text", "hits").mapInArrow(passages, "token long, hot boolean, key binary, low int, prints binary").checkpoint()
    cold = found.where("not hot").select("token", "key", "low", "prints").repartition("token").sortWithinPartitions("token").mapInArrow(sort_tokens, "key binary, start long, end long")
    # Of tokens that very many places share the passages are counted, with partial sums.
    alone = found.where("hot").select("key", "low", "prints").mapInArrow(single, "key binary, start long, print long")
    number = F.xxhash64("key")
    common = alone.groupBy("print").agg(F.min(number).alias("a"), F.max(number).alias("b")).where("a <> b").select("print").checkpoint()
    n = common.count()
    if not n:
        return cold
    return cold.union(alone.join(F.broadcast(common) if n <= BROADCAST_IDS else common, "print").select("key", "start", F.col("start") + PASSAGE))


def remove_repeats(docs: DataFrame, *, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_words of every row of `docs` (doc_id, text), and
    on demand kept (the bytes left), spans (removed runs in bytes) and passages (runs of passage words in bytes).

    Null text is empty. Rows with the same text are copies of each other: with LENGTH bytes or more
    they are removed whole. Rows that repeat a doc_id are documents of their own. n_passage_words are the
    words in passages of PASSAGE words that another row has too, whatever is between the words; they
    are told, not removed, unless a repeated string covers them.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    scanned = scan(docs).checkpoint()
    texts = scanned.where((F.size("token") > 0) | (F.size("word_token") > 0)).drop("doc_id", "sha256", "n_bytes", "n_words").dropDuplicates(["key"]).checkpoint()
    copies = scanned.where((F.col("n_bytes") >= LENGTH) | (F.col("n_words") >= PASSAGE)).groupBy("key").count().where("count > 1").select("key", F.lit(True).alias("copied"))
    found = find_repeats(docs, texts).withColumn("words", F.lit(False)).union(find_passages(docs, texts).withColumn("words", F.lit(True)))
    runs = found.groupBy("key").agg(F.expr("collect_list(struct(words, start, end)) AS runs")).join(copies, "key", "left_anti").checkpoint()
    pairs = "array<struct<start:bigint,end:bigint>>"
    extra = f", kept binary, spans {pairs}, passages {pairs}" if with_text else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(data: np.ndarray, found: list[dict]) -> tuple[int, list[dict]]:
            if not found:
                return 0, []
            prints, begins, ends = word_prints(data)
            prints = passage_prints(prints)
            known = np.zeros(len(prints), bool)
            for r in found:
                known[r["start"]:r["end"] - PASSAGE + 1] = True
            again = np.flatnonzero(np.isin(prints, prints[known]))
            first, last = merge(again, again + PASSAGE)
            return int((last - first).sum()), [{"start": s, "end": e} for s, e in zip(begins[first].tolist(), ends[last - 1].tolist())]

        for batch in batches:
            rows = []
            for key, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = text.as_buffer().to_pybytes()
                bytes_ = [r for r in found if not r["words"]]
                starts, ends = merge(np.asarray([r["start"] for r in bytes_]), np.asarray([r["end"] for r in bytes_]))
                left, at = [], 0
                for start, end in zip(starts.tolist(), ends.tolist()):
                    left.append(data[at:start])
                    at = end
                left = b"".join([*left, data[at:]])
                n, passages = told(np.frombuffer(data, np.uint8), [r for r in found if r["words"]])
                rows.append((key, len(data) - len(left), len(starts), hashlib.sha256(left).hexdigest(), n, left, [{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist())], passages))
            columns = list(zip(*rows)) if rows else [[]] * 8
            runs_of = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary(), runs_of, runs_of]
            names = ["key", "n_removed", "n_spans", "kept_sha256", "n_passage_words", "kept", "spans", "passages"][:8 if with_text else 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)][:len(names)], names=names)

    ids = scanned.select("key", "rid").join(runs.select("key"), "key", "left_semi").groupBy("key").agg(F.min("rid").alias("rid"))
    cutting = _texts(docs, ids.select("rid").distinct().checkpoint(), runs).select("key", "text", "runs").mapInArrow(
        cut, "key binary, n_removed long, n_spans long, kept_sha256 string, n_passage_words long" + extra).dropDuplicates(["key"])
    copied = F.coalesce("copied", F.lit(False))
    whole = copied & (F.col("n_bytes") >= LENGTH)
    out = scanned.select("doc_id", "key", "sha256", "n_bytes", "n_words").join(copies, "key", "left").join(cutting, "key", "left")
    columns = [F.col("doc_id"), F.col("n_bytes"), F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
               F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
               F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
               F.when(copied & (F.col("n_words") >= PASSAGE), F.col("n_words")).otherwise(F.coalesce("n_passage_words", F.lit(0))).alias("n_passage_words")]
    return out.select(*columns, *([F.when(whole, True).alias("copied"), "kept", "spans", "passages"] if with_text else []))
