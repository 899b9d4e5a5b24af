"""Verbatim benchmark passages in documents, found in suffix arrays of the training side.

Documents are read in shards of neighbouring words. A shard's words become their numbers in the
benchmark's vocabulary and all its suffixes that begin with such a word are sorted into a suffix
array (first a few words packed into one key, then prefix doubling over ties). Every suffix of every
item is searched in it by bisection, word by word, which gives its longest verbatim match in the shard
and all places of it; the interval at the depth of a window gives the places of the window. Words are
compared as 64-bit fingerprints. A shard is built, searched and let go inside one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnbook.llm.suffix_dedup import Fingerprints, merge
from cairnbook.session import ensure_checkpoint_dir

#: Words of a window; a shorter item is one window of its own length.
WINDOW = 10
#: Bytes of text whose words are numbered at once, and words of a shard.
BYTES, SHARD = 1 << 22, 1 << 20
#: Words of one block of items, which is sent to every task; more items make more passes.
BLOCK_WORDS = 1 << 20

_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, first byte) of the words of UTF-8 bytes: runs of digits, letters and bytes beyond ASCII, A-Z lower-cased."""
    prints, firsts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    begin = 0
    while begin < len(data):
        end = min(begin + BYTES, len(data))
        while end < len(data) and _IS_WORD[data[end - 1]] and _IS_WORD[data[end]]:
            end += 1  # no cut inside a word
        part = data[begin:end]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = _IS_WORD[part]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if len(starts):
            prints.append(Fingerprints(_LOWER[part]).of(starts, ends - starts))
            firsts.append(starts + begin)
        begin = end
    return np.concatenate(prints), np.concatenate(firsts)


@dataclass
class Items:
    """A block of items: their words as numbers from 1 (0 ends an item), and which windows belong to which items."""

    vocabulary: np.ndarray  # sorted fingerprints; number = place + 1
    words: np.ndarray
    left: np.ndarray  # words from here to the item's end
    windows: np.ndarray  # one place of each distinct window
    sizes: np.ndarray  # its words
    owners: np.ndarray  # items of all windows, one after another
    owners_to: np.ndarray  # where those of each window begin
    ids: list[str | None]
    places: list[tuple[int, int]]  # first word and number of words of each item

    @property
    def enough(self) -> np.ndarray:
        """Words of the window that begins at each word, 0 where none does."""
        out = np.zeros(len(self.words), np.int64)
        for at, n in self.places:
            out[at:at + max(0, n - min(n, WINDOW) + 1)] = min(n, WINDOW)
        return out


def index_items(rows: list[tuple[str | None, np.ndarray]]) -> Items:
    """`rows`: (id as text, word fingerprints) of items."""
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for _, h in rows)]))
    words, left, places, at = [], [], [], 0
    starts, sizes, owner = [], [], []
    for k, (_, h) in enumerate(rows):
        n = len(h)
        words += [np.searchsorted(vocabulary, h) + 1, np.zeros(1, np.int64)]
        left.append(np.concatenate([np.arange(n, 0, -1), [0]]))
        places.append((at, n))
        if n:
            size = min(n, WINDOW)
            starts.append(at + np.arange(n - size + 1))
            sizes.append(np.full(n - size + 1, size))
            owner.append(np.full(n - size + 1, k))
        at += n + 1
    join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
    words, left, starts, sizes, owner = join(words), join(left), join(starts), join(sizes), join(owner)
    padded = np.concatenate([words, np.zeros(WINDOW, np.int64)])
    grid = padded[starts[:, None] + np.arange(WINDOW)] * (np.arange(WINDOW) < sizes[:, None]) if len(starts) else np.zeros((0, WINDOW), np.int64)
    if not len(starts):
        return Items(vocabulary, words, left, starts, sizes, owner, np.zeros(1, np.int64), [i for i, _ in rows], places)
    _, first, of = np.unique(np.column_stack([grid, sizes]).astype(np.int32), axis=0, return_index=True, return_inverse=True)
    pairs = np.unique(np.column_stack([of.ravel(), owner]), axis=0)
    owners_to = np.searchsorted(pairs[:, 0], np.arange(len(first) + 1))
    return Items(vocabulary, words, left, starts[first], sizes[first], pairs[:, 1], owners_to, [i for i, _ in rows], places)


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Places of `words` that are no 0, ordered by the suffixes there, compared over `depth` words at least or until a 0, which ends a suffix."""
    starts = np.flatnonzero(words)
    bits = max(1, int(words.max(initial=0)).bit_length())
    packed = min(62 // bits, depth)
    padded = np.concatenate([words, np.zeros(depth + packed, np.int64)])
    key = np.zeros(len(words), np.int64)
    open_ = np.ones(len(words), bool)
    for k in range(packed):
        at = padded[k:k + len(words)]
        open_ &= at > 0
        key = (key << bits) | np.where(open_, at, 0)
    order = np.argsort(key[starts], kind="stable")
    array = starts[order]
    held = key[array]
    done = packed
    new = np.concatenate([[True], held[1:] != held[:-1]])[:len(array)]
    rank = np.zeros(len(words) + depth + packed, np.int64)
    run = np.maximum.accumulate(np.where(new, np.arange(len(array)), 0))
    rank[array] = run + 1
    while done < depth and len(array):
        tied = ~(new & np.concatenate([new[1:], [True]]))
        # A suffix that has ended is equal to all it is tied with.
        places = np.flatnonzero(tied)
        places = places[padded[array[places] + done - 1] > 0] if done - 1 < depth + packed else places
        if not len(places):
            break
        at = array[places]
        second = rank[np.minimum(at + done, len(rank) - 1)]
        order = np.lexsort((second, run[places]))
        array[places] = at[order]
        group, second = run[places][order], second[order]
        fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        new[places] |= fresh
        run = np.maximum.accumulate(np.where(new, np.arange(len(array)), 0))
        rank[array] = run + 1
        done *= 2
    return array


def _bisect(words: np.ndarray, array: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray, right: bool) -> np.ndarray:
    """Per query the first place in [low, high) of the array whose word at `depth` is not below (`right`: is above) `word`."""
    low, high = low.copy(), high.copy()
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        mid = (low[live] + high[live]) >> 1
        at = words[array[mid] + depth]
        less = at <= word[live] if right else at < word[live]
        low[live[less]] = mid[less] + 1
        high[live[~less]] = mid[~less]


def search(words: np.ndarray, array: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every suffix of the items against one array: (length of its longest match, first and last + 1 place of that match
    in the array) and (first, last + 1 place) of each distinct window. `words` ends in a 0."""
    n = len(items.words)
    low, high, length = np.zeros(n, np.int64), np.full(n, len(array)), np.zeros(n, np.int64)
    window_low, window_high = np.zeros(len(items.windows), np.int64), np.zeros(len(items.windows), np.int64)
    live = np.flatnonzero(items.words > 0)
    window_of = np.full(n, -1)
    window_of[items.windows] = np.arange(len(items.windows))
    size_at = np.zeros(n, np.int64)
    size_at[items.windows] = items.sizes
    depth = 0
    while len(live):
        word = items.words[live + depth]
        first = _bisect(words, array, low[live], high[live], depth, word, right=False)
        last = _bisect(words, array, first, high[live], depth, word, right=True)
        found = first < last
        live, first, last = live[found], first[found], last[found]
        low[live], high[live], length[live] = first, last, depth + 1
        depth += 1
        whole = live[size_at[live] == depth]
        window_low[window_of[whole]], window_high[window_of[whole]] = low[whole], high[whole]
        live = live[items.left[live] > depth]
    return length, low, high, window_low, window_high


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which interval, place) of all places of the intervals."""
    sizes = high - low
    which = np.repeat(np.arange(len(low)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]


def _find(numbers: np.ndarray, items: Items, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per shard of `numbers` (0 where no item has the word, and between texts): (start, window) of the windows
    that occur, and (start, item word, words) of the longest matches of item suffixes, of a window at least. Item
    suffixes with the same longest match are told once, so the places do not multiply by the items that share a passage."""
    padded = np.concatenate([numbers, np.zeros(depth + 2, np.int64)])
    enough = items.enough
    for begin in range(0, len(numbers), SHARD):
        # Suffixes begin in the shard, but are read as far beyond it as an item is long.
        part = padded[begin:begin + SHARD + depth + 2]
        array = suffix_array(part, depth)
        array = array[array < SHARD]
        length, low, high, window_low, window_high = search(part, array, items)
        which, place = _spread(window_low, window_high)
        long = np.flatnonzero((enough > 0) & (length >= enough))
        long = long[np.unique(np.column_stack([low[long], high[long]]), axis=0, return_index=True)[1]]
        of, where = _spread(low[long], high[long])
        yield array[place] + begin, which, array[where] + begin, long[of], length[long[of]]


_FOUND = "key binary, doc_id long, text_bytes long, n_words long, spans array<struct<start:long,end:long>>, items array<string>, matches array<struct<item_row:int,item_start:int,start:long,n_words:int>>"


def _scan(docs: DataFrame, items: Items, keyed: bool, hits_only: bool) -> DataFrame:
    """Every row of `docs` with its hit runs (in words), the items that have a window there, and the longest matches."""
    depth = max([1, *(n for _, n in items.places)])
    item_at = np.asarray([at for at, _ in items.places], np.int64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = batch.column(2), batch.num_rows
            begin = 0
            while begin < rows:
                end, held = begin, 0
                parts = []
                while end < rows and (end == begin or held + len(texts[end].as_buffer() or b"") <= BYTES):
                    parts.append(np.frombuffer(texts[end].as_buffer(), np.uint8))
                    held += len(parts[-1]) + 1
                    end += 1
                yield from _judge(batch.slice(begin, end - begin), parts)
                begin = end

    def _judge(batch: pa.RecordBatch, parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        gap = np.zeros(1, np.uint8)
        data = np.concatenate([x for part in parts for x in (part, gap)])
        prints, at = words_of(data)
        place = np.searchsorted(items.vocabulary, prints)
        place[place == len(items.vocabulary)] = 0
        known = items.vocabulary[place] == prints if len(items.vocabulary) else np.zeros(len(prints), bool)
        bytes_to = np.cumsum([0, *(len(p) + 1 for p in parts)])
        word_to = np.searchsorted(at, bytes_to)  # first word of each text
        # A 0 after each text keeps matches inside it.
        owner = np.repeat(np.arange(len(parts)), np.diff(word_to))
        numbers = np.zeros(len(prints) + len(parts), np.int64)
        numbers[np.arange(len(prints)) + owner] = np.where(known, place + 1, 0)
        text_to = word_to + np.arange(len(parts) + 1)
        found = list(_find(numbers, items, depth))
        join = lambda k: np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)])
        start, window, where, item_word, length = (join(k) for k in range(5))
        n_words = np.diff(word_to)
        hit_rows = np.searchsorted(text_to, start, side="right") - 1
        match_rows = np.searchsorted(text_to, where, side="right") - 1
        order, by = np.argsort(hit_rows, kind="stable"), np.argsort(match_rows, kind="stable")
        cut, match_cut = np.searchsorted(hit_rows[order], np.arange(len(parts) + 1)), np.searchsorted(match_rows[by], np.arange(len(parts) + 1))
        spans, named, matches = [], [], []
        for r in range(len(parts)):
            own = order[cut[r]:cut[r + 1]]
            if not len(own):
                spans.append([])
                named.append([])
                matches.append([])
                continue
            begins = start[own] - text_to[r]
            first, last = merge(begins, begins + items.sizes[window[own]])
            spans.append([{"start": a, "end": b} for a, b in zip(first.tolist(), last.tolist())])
            hit = np.unique(window[own])
            of = np.unique(items.owners[_spread(items.owners_to[hit], items.owners_to[hit + 1])[1]])
            named.append(sorted({items.ids[i] for i in of.tolist()} - {None}))
            own = by[match_cut[r]:match_cut[r + 1]]
            row = np.searchsorted(item_at, item_word[own], side="right") - 1
            # A match that is the tail of a longer one, one word on in both texts, is told by that one.
            shape = np.column_stack([row, item_word[own] - item_at[row], where[own] - text_to[r], length[own]])
            matches.append([{"item_row": a, "item_start": b, "start": c, "n_words": d} for a, b, c, d in _heads(shape).tolist()])
        rows = np.flatnonzero([bool(s) for s in spans]) if hits_only else np.arange(len(parts))
        pick = lambda values: [values[i] for i in rows.tolist()]
        kinds = [f.type for f in _arrow_fields()]
        columns = [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(pick([len(p) for p in parts]), pa.int64()), pa.array(n_words[rows], pa.int64()),
                   pa.array(pick(spans), kinds[4]), pa.array(pick(named), kinds[5]), pa.array(pick(matches), kinds[6])]
        yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in _arrow_fields()])

    text = F.coalesce("text", F.lit(""))
    key = F.unhex(F.sha2(text.cast("binary"), 256)) if keyed else F.lit(None).cast("binary")
    return docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).mapInArrow(scan, _FOUND)


def _arrow_fields() -> list[pa.Field]:
    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    match = pa.struct([("item_row", pa.int32()), ("item_start", pa.int32()), ("start", pa.int64()), ("n_words", pa.int32())])
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pair), pa.list_(pa.string()), pa.list_(match)]
    return [pa.field(part.split()[0], kind) for part, kind in zip(("key", "doc_id", "text_bytes", "n_words", "spans", "items", "matches"), kinds)]


def _heads(shape: np.ndarray) -> np.ndarray:
    """Rows (item, item start, start, words) without those that continue a row one word before them in item and text."""
    if not len(shape):
        return shape
    order = np.lexsort((shape[:, 1], shape[:, 1] - shape[:, 2], shape[:, 0]))
    s = shape[order]
    goes_on = (s[1:, 0] == s[:-1, 0]) & (s[1:, 1] == s[:-1, 1] + 1) & (s[1:, 2] == s[:-1, 2] + 1) & (s[1:, 3] == s[:-1, 3] - 1)
    return s[np.concatenate([[True], ~goes_on])]


def item_blocks(benchmark: DataFrame, block_words: int | None = None) -> Iterator[tuple[list[tuple[str | None, np.ndarray]], int]]:
    """Rows of `benchmark` (item_id, text) in blocks of at most `block_words` words, with the number of rows before
    each; the driver holds one block. A longer item is cut into pieces that share WINDOW - 1 words."""
    most = block_words or BLOCK_WORDS
    block: list[tuple[str | None, np.ndarray]] = []
    held = before = 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("i"), F.coalesce("text", F.lit("")).alias("t")).toLocalIterator():
        prints, _ = words_of(np.frombuffer(row.t.encode(), np.uint8))
        step = max(1, most - WINDOW + 1)
        for begin in range(0, max(1, len(prints) - WINDOW + 1), step):
            piece = prints[begin:begin + step + WINDOW - 1]
            if block and held + len(piece) > most:
                yield block, before
                before += len(block)
                block, held = [], 0
            block.append((row.i, piece))
            held += len(piece)
    yield block, before


def find(docs: DataFrame, benchmark: DataFrame, *, block_words: int | None = None) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (runs of hit words),
    items (ids), matches (row of an item that has it, first word in it and in the document, words): the longest verbatim
    matches of item suffixes within the shard.

    Words are runs of digits, letters and characters beyond ASCII with A-Z lower-cased. A window is WINDOW
    words of an item, or the whole of a shorter one; an item without words has none. Null texts have no
    words; rows that repeat an id are documents of their own; items that repeat an id are one item; an item
    with a null id hits words but is no id to tell. Texts of any length are read whole; other columns are ignored.

    One block of items goes to the tasks at a time. A benchmark beyond BLOCK_WORDS words takes more passes, each of which
    leaves only the documents that it hits; a match across pieces of one very long item is told in parts."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    blocks = item_blocks(benchmark, block_words)
    block, _ = next(blocks)
    following = next(blocks, None)
    if following is None:
        return _digest(_scan(docs, index_items(block), keyed=False, hits_only=False))
    hits = _scan(docs, index_items(block), keyed=True, hits_only=True).drop("n_words").dropDuplicates(["doc_id", "key"]).checkpoint()
    while following is not None:
        block, before = following
        more = _scan(docs, index_items(block), keyed=True, hits_only=True).drop("n_words").dropDuplicates(["doc_id", "key"])
        shifted = F.transform("matches", lambda m: m.withField("item_row", (m["item_row"] + before).cast("int")))
        hits = hits.union(more.withColumn("matches", shifted).checkpoint())
        following = next(blocks, None)
    # At most one row a pass and document comes together here.
    joined = hits.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("matches")).alias("matches"))
    all_rows = _scan(docs, index_items([]), keyed=True, hits_only=False).select("doc_id", "key", "n_words").alias("a")
    same = F.col("a.doc_id").eqNullSafe(F.col("j.doc_id")) & (F.col("a.key") == F.col("j.key"))
    none = lambda name, kind: F.coalesce(F.col(f"j.{name}"), F.array().cast(kind)).alias(name)
    return _digest(all_rows.join(joined.alias("j"), same, "left").select("a.doc_id", "a.n_words", none("spans", "array<struct<start:long,end:long>>"), none("items", "array<string>"),
                   none("matches", "array<struct<item_row:int,item_start:int,start:long,n_words:int>>")), merged=False)


def _digest(found: DataFrame, merged: bool = True) -> DataFrame:
    spans = F.col("spans")
    if not merged:
        ordered = F.array_sort("spans")
        start = F.struct(F.lit(0).cast("long").alias("end"), F.array().cast("array<struct<start:long,end:long>>").alias("done"))
        step = lambda acc, s: F.when((F.size(acc["done"]) > 0) & (s["start"] <= acc["end"]), F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"),
            F.concat(F.slice(acc["done"], 1, F.size(acc["done"]) - 1), F.array(F.struct(F.element_at(acc["done"], -1)["start"].alias("start"), F.greatest(acc["end"], s["end"]).alias("end")))).alias("done"),
        )).otherwise(F.struct(s["end"].alias("end"), F.concat(acc["done"], F.array(s)).alias("done")))
        spans = F.aggregate(ordered, start, step, lambda acc: acc["done"])
        found = found.withColumn("spans", spans)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"), "spans", "items", "matches")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, block_words: int | None = None) -> DataFrame:
    """Rows of `docs` whose id and text no contaminated document has; all columns stay."""
    ensure_checkpoint_dir(docs.sparkSession)
    name = max(docs.columns, key=len) + "_key"  # no column has it
    gone = None
    for block, _ in item_blocks(benchmark, block_words):
        hit = _scan(docs, index_items(block), keyed=True, hits_only=True).select(F.col("key").alias(name)).distinct().checkpoint()
        gone = hit if gone is None else gone.union(hit)
    key = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    return docs.withColumn(name, key).join(gone, name, "left_anti").drop(name)


ORACLE = r"""
WITH i AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
g AS (SELECT DISTINCT item_id, n, array_to_string(ws[k:k + n - 1], ' ') AS w
      FROM (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS k FROM i WHERE len(ws) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
x AS (SELECT r, n, k, array_to_string(ws[k:k + n - 1], ' ') AS w FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM g) WHERE len(ws) >= n)),
h AS (SELECT r, k, x.n, item_id FROM x JOIN g ON x.n = g.n AND x.w = g.w),
c AS (SELECT r, count(DISTINCT k + j)::BIGINT AS n_hit FROM (SELECT r, k, unnest(range(0, n)) AS j FROM (SELECT DISTINCT r, k, n FROM h)) GROUP BY r),
t AS (SELECT r, count(*)::BIGINT AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""
