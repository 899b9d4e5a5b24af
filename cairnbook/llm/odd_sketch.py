"""Near-duplicates by MinHash bands, odd sketches and a check on full shingle sets.

MinHash samples give band keys that find candidates and an odd sketch, a bitmap in which each sample
flips one bit: the population count of the XOR of two sketches tells how many samples differ. The
sketch only sorts out pairs far below the threshold; every link is confirmed on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from cairnbook.llm.components import compact, components
from cairnbook.operators.ranking import number_rows
from cairnbook.session import ensure_checkpoint_dir

ROWS, BANDS = 6, 40
SAMPLES = ROWS * BANDS
SKETCH_BITS = 512
#: Pairs whose sketches differ in more bits are not checked. At similarity 0.8, 80 bits differ on average with a deviation of about 10.
SKETCH_MOST = 130
#: Most candidate ids that are broadcast to pick texts; more of them are joined.
BROADCAST_IDS = 4_000_000
#: Documents, and digests in their sets, that are brought together at once.
BLOCK, BLOCK_ITEMS = 192, 400_000
#: Nodes, with bands and sketch, of a partition.
NODES = 16_384
_MIX = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(20)
_FACTORS = _random.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _random.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_BAND_FACTORS = _random.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND_SALTS = _random.integers(0, 1 << 63, BANDS, dtype=np.uint64)
_BIT_FACTORS = _random.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) | np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit digests of the distinct `size`-word shingles of a text.

    A-Z are lower-cased, words end at ASCII white space; fewer words than `size` make one shingle,
    no word none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digests = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    count = len(words) - size + 1
    h = np.full(count, size, np.uint64)
    for k in range(size):
        h = _mixed(h * _MIX + digests[k:k + count])
    return np.unique(h)


def samples(found: np.ndarray) -> np.ndarray:
    """MinHash samples of a set of digests."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 256):
        least = np.minimum(least, (np.multiply.outer(x[at:at + 256], _FACTORS) + _SHIFTS).min(axis=0))
    return least


def bands(least: np.ndarray) -> np.ndarray:
    return _mixed((least.astype(np.uint64).reshape(BANDS, ROWS) * _BAND_FACTORS).sum(axis=1) + _BAND_SALTS).view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples, as longs."""
    bit = (_mixed((least.astype(np.uint64) + np.uint64(1)) * _BIT_FACTORS) >> np.uint64(64 - 9)).astype(np.int64)
    parity = (np.bincount(bit, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the set; null if empty), bands and sketch of each row."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, band_keys, sketches = [], [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), size)
                counts.append(len(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                least = samples(found) if len(found) else None
                band_keys.append(bands(least) if len(found) else None)
                sketches.append(odd_sketch(least) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(band_keys, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(signed, "doc_id long, n_shingles long, set_key binary, bands array<long>, sketch array<long>")


def _differing(a: str, b: str) -> Column:
    """Population count of the XOR of two sketches."""
    return sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(1, SKETCH_BITS // 64)), F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))


def _may_link(percent: int) -> Column:
    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return (least * 100 >= most * percent) & (_differing("s_a", "s_b") <= SKETCH_MOST)


def _sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """rep, items: sorted shingle digests of the sets in `ids` (rep, doc_id, set_key)."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(text.as_py(), size).tobytes() for text in batch.column(1)]
            keys = [hashlib.blake2b(x, digest_size=16).digest() for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(found, pa.binary())], names=["doc_id", "set_key", "items"])

    only = ids.select("doc_id").distinct()
    only = F.broadcast(only) if ids.count() <= BROADCAST_IDS else only
    return (docs.select(F.col("doc_id").cast("long"), "text").join(only, "doc_id", "left_semi").mapInArrow(kept, "doc_id long, set_key binary, items binary")
            .join(ids, ["doc_id", "set_key"]).dropDuplicates(["rep"]).select("rep", "items"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    with_a = pairs.select("a", "b").join(sets.select(F.col("rep").alias("a"), F.col("items").alias("items_a")), "a")
    return (with_a.join(sets.select(F.col("rep").alias("b"), F.col("items").alias("items_b")), "b")
            .select("a", "b", "items_a", "items_b").mapInArrow(linked, "a long, b long"))


def _candidates(bucket_parts: DataFrame, percent: int) -> DataFrame:
    """low, high (blocks), a, b (lists of equal length): pairs of a bucket's two parts that may link and lie in different components.

    A pair is named only in the first band that it shares, and only if its sketches are near."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y = ({"rep": np.asarray([r["rep"] for r in side]), "block": np.asarray([r["block"] for r in side]), "component": np.asarray([r["component"] for r in side]),
                         "n": np.asarray([r["n_shingles"] for r in side]), "sketch": np.asarray([r["sketch"] for r in side]), "bands": np.asarray([r["bands"] for r in side])}
                        for side in (row["x"], row["y"]))
                n_x, n_y = x["n"][:, None], y["n"][None, :]
                can = (x["component"][:, None] != y["component"][None, :]) & (100 * np.minimum(n_x, n_y) >= percent * np.maximum(n_x, n_y))
                if row["same"]:
                    can &= x["rep"][:, None] < y["rep"][None, :]
                i, j = np.nonzero(can)
                near = np.bitwise_count((x["sketch"][i] ^ y["sketch"][j]).view(np.uint64)).sum(axis=1, dtype=np.int64) <= SKETCH_MOST
                i, j = i[near], j[near]
                shared = x["bands"][i] == y["bands"][j]
                here = x["bands"][:1] == row["band"]
                first = shared.argmax(axis=1) == here.argmax() if len(i) else np.zeros(0, bool)
                i, j = i[first], j[first]
                swap = x["block"][i] > y["block"][j]
                ends = [np.where(swap, y[c][j], x[c][i]) for c in ("block", "rep")] + [np.where(swap, x[c][i], y[c][j]) for c in ("block", "rep")]
                order = np.lexsort((ends[2], ends[0]))
                low, a, high, b = (e[order] for e in ends)
                cuts = np.flatnonzero((low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
                for at, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(low)]):
                    if end > at:
                        yield pa.RecordBatch.from_arrays([pa.array(low[at:at + 1]), pa.array(high[at:at + 1]), pa.array([a[at:end]], pa.list_(pa.int64())), pa.array([b[at:end]], pa.list_(pa.int64()))],
                                                         names=["low", "high", "a", "b"])

    x = bucket_parts.select("band", F.col("part").alias("x_part"), F.col("members").alias("x"))
    y = bucket_parts.select(F.col("band").alias("y_band"), F.col("part").alias("y_part"), F.col("members").alias("y"))
    parts = x.join(y, (F.col("band") == F.col("y_band")) & (F.col("x_part") <= F.col("y_part")))
    found = parts.select("band", (F.col("x_part") == F.col("y_part")).alias("same"), "x", "y").mapInArrow(met, "low long, high long, a array<long>, b array<long>")
    return found.groupBy("low", "high").agg(F.flatten(F.collect_list("a")).alias("a"), F.flatten(F.collect_list("b")).alias("b"))


def _clusters(near: DataFrame) -> DataFrame:
    """rep, cluster: the smallest document met from one to its centre, the centre's centre and so on, four steps.

    Only for dealing documents that are compared to the same blocks; every document has one."""
    at = near.select("rep", "centre", F.least("rep", "centre").alias("cluster"))
    for _ in range(2):
        ahead = at.select(F.col("rep").alias("via"), F.col("centre").alias("next"), F.col("cluster").alias("beyond"))
        at = at.join(ahead, F.col("centre") == F.col("via"), "left").select("rep", F.coalesce("next", "centre").alias("centre"), F.least("cluster", "beyond").alias("cluster"))
    return at.select("rep", "cluster")


def _across(nodes: DataFrame, near: DataFrame, ids: DataFrame, sets: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """a, b: links between components, enough of them to join what links join.

    Only buckets that hold several components are looked at, part by part (a part is bounded). Candidates
    are checked on full sets between blocks of documents, also bounded; a pair whose components the
    block has already joined needs no check."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                members = {r["rep"]: r for r in row["x"] + row["y"]}
                items = {rep: np.frombuffer(r["items"], np.uint64) for rep, r in members.items()}
                parent = {r["component"]: r["component"] for r in members.values()}

                def root(c: int) -> int:
                    while parent[c] != c:
                        parent[c] = c = parent[parent[c]]
                    return c

                edges = []
                for a, b in zip(row["a"], row["b"]):
                    c_a, c_b = root(members[a]["component"]), root(members[b]["component"])
                    if c_a == c_b:
                        continue
                    both = np.concatenate([items[a], items[b]])
                    both.sort(kind="stable")
                    common = int((both[1:] == both[:-1]).sum())
                    if 100 * common >= percent * (len(both) - common):
                        edges.append((a, b))
                        parent[max(c_a, c_b)] = min(c_a, c_b)
                if edges:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*edges)], names=["a", "b"])

    known = (ids.select("rep").join(nodes.drop("set_key", "doc_id"), "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
             .withColumn("component", F.coalesce("component", "rep")).join(_clusters(near), "rep"))
    sizes = known.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_ITEMS)).alias("chunks"))
    placed = compact(known.join(sizes, "cluster").withColumn("block", F.xxhash64("cluster", F.pmod(F.xxhash64("rep"), F.col("chunks")))).drop("cluster", "chunks"), NODES)
    banded = placed.select("rep", "component", F.explode("bands").alias("band"))
    mixed = banded.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).where("low <> high").select("band", F.ceil(F.col("n") / BLOCK).alias("parts"))
    open_ = banded.join(mixed, "band").select("rep", "band", F.pmod(F.xxhash64("rep"), F.col("parts")).alias("part"))
    bucket_parts = open_.join(placed, "rep").groupBy("band", "part").agg(F.collect_list(F.struct("rep", "block", "component", "n_shingles", "sketch", "bands")).alias("members"))
    pairs = _candidates(bucket_parts, percent).checkpoint()
    needed = pairs.select(F.explode(F.array("low", "high")).alias("block")).distinct()
    packs = placed.join(needed, "block", "left_semi").join(sets, "rep").groupBy("block").agg(F.collect_list(F.struct("rep", "component", "items")).alias("members"))
    held = pairs.join(packs.toDF("low", "x"), "low").join(packs.toDF("high", "y"), "high")
    return held.select("a", "b", "x", "y").mapInArrow(linked, "a long, b long")


def _numbered_sets(signed: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """set_key, doc_id (the smallest that has the set) and rep, the set's number: that doc_id, or a number beyond all ids
    for further sets of it. And, if an id has several sets, links a, b between their numbers."""
    sets = signed.where("set_key is not null and doc_id is not null").select("set_key", "doc_id")
    first = sets.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"))
    several = sets.groupBy("doc_id").agg(F.min("set_key").alias("lead"), F.max("set_key").alias("last")).where("lead <> last").select("doc_id").checkpoint()
    if not several.limit(1).count():
        return first.withColumn("rep", F.col("doc_id")), None
    first = first.checkpoint()
    leads = first.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("set_key").alias("lead"))
    further = first.join(leads, "doc_id").where("set_key <> lead").select("set_key").checkpoint()
    top = sets.agg(F.max("doc_id")).first()[0]
    numbers = further.select("set_key", (F.monotonically_increasing_id() + F.lit(top + 1)).alias("number")).checkpoint()
    first = first.join(numbers, "set_key", "left").select("set_key", "doc_id", F.coalesce("number", "doc_id").alias("rep")).checkpoint()
    of = sets.join(several, "doc_id", "left_semi").distinct().join(first.select("set_key", "rep"), "set_key").select("doc_id", "rep")
    same = of.join(of.groupBy("doc_id").agg(F.min("rep").alias("b")), "doc_id").select(F.col("rep").alias("a"), "b").where("a <> b")
    # A number beyond all ids is tied to its own id, so the smallest of a component is an id.
    own = first.where("rep <> doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    return first, same.union(own)


def near_duplicates(docs: DataFrame, *, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id, text).

    Texts with 100 * intersection >= `percent` * union of their shingle sets are linked;
    component_id is the smallest doc_id reachable. Equal sets are one node, so a group of copies
    costs one. Every document is checked against one of its candidates: of the first and last members
    of its buckets the one met in most bands. Where that leaves several components in a bucket, its
    members are checked across components, so no link that matters is lost. A pair at the threshold
    shares no band with a probability below 1e-5.

    Null or empty text: no shingles, linked with nothing. A null doc_id has a null component_id and
    is kept. Rows that repeat a doc_id share its component: unequal texts of an id are sets of their own, and
    what any of them is linked with is reachable from the id.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    signed = signatures(docs, shingle_words).checkpoint()
    first, same_id = _numbered_sets(signed)
    nodes = compact(signed.select("set_key", "doc_id", "n_shingles", "bands", "sketch").join(first, ["set_key", "doc_id"])
                    .dropDuplicates(["set_key"]), NODES)
    buckets = nodes.select("rep", F.explode("bands").alias("band"))
    ends = buckets.groupBy("band").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high")
    met = buckets.join(ends, "band").select("rep", F.explode(F.array("low", "high")).alias("centre")).where("rep <> centre").groupBy("rep", "centre").count()
    near = compact(met.groupBy("rep").agg(F.max(F.struct("count", (-F.col("centre")).alias("less"))).alias("best")).select("rep", (-F.col("best.less")).alias("centre")))
    met = compact(near.select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct())
    ids = compact(near.select("rep").join(nodes.select("rep", "doc_id", "set_key"), "rep"))
    sets = _sets(docs, ids, shingle_words).checkpoint()

    def side(x: str) -> DataFrame:
        return nodes.select(F.col("rep").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))

    star = _confirmed(met.join(side("a"), "a").join(side("b"), "b").where(_may_link(percent)), sets, percent)
    star = compact(star)
    joined = components(star)

    links = star.union(compact(_across(nodes, near, ids, sets, joined, percent)))

    if same_id is not None:
        links = links.union(same_id)
    by_set = first.join(components(links).withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_key", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "set_key").join(by_set, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, all columns, that `near_duplicates` keeps. Unequal texts of one doc_id are documents of their own,
    ranked by id and text; of rows with equal id and text one stays. Rows with a null id all stay."""
    ensure_checkpoint_dir(docs.sparkSession)
    if not docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        placed = near_duplicates(docs.select("doc_id", "text"), **options)
        dropped = placed.where(~F.col("kept")).select("doc_id").distinct().checkpoint()
        return docs.join(F.broadcast(dropped) if dropped.count() <= BROADCAST_IDS else dropped, "doc_id", "left_anti").select(*docs.columns)
    key = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    rows = docs.where("doc_id is not null").select(F.col("doc_id").alias("id"), key.alias("key"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["id", "key"])
    numbered = number_rows(rows, ["id", "key"], name="doc_id").checkpoint()
    kept = near_duplicates(numbered.select("doc_id", "text"), **options).where("kept").select("doc_id")
    kept = numbered.drop("text").join(kept, "doc_id").select("id", "key")
    own = docs.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    held = own.join(kept, (own["doc_id"] == kept["id"]) & (F.unhex(F.sha2(F.coalesce(own["text"], F.lit("")).cast("binary"), 256)) == kept["key"]), "left_semi")
    return held.union(docs.where("doc_id is null"))
