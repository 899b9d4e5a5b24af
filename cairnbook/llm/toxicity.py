"""Toxicity by class-conditional Kneser-Ney character models with shared backoff counts.

Text is lower-cased, white space becomes one symbol and each code point a 12-bit symbol, so a run of
five symbols is one long. Counts over all rows to learn from are Spark aggregations. Orders 5 to 3
keep a distribution per class (order 5 of counts, 4 and 3 of continuation counts); orders 2 and 1
are continuation counts of both classes together, so an expression that neither class has seen
falls back to the same probability in both.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnbook.llm.components import compact
from cairnbook.session import ensure_checkpoint_dir

ORDER, BITS = 5, 12
LOW_SYMBOLS = 3072
#: Absolute discount of every order.
DISCOUNT = 0.75
#: Symbols worked on at once in a task.
CHUNK = 1 << 21
#: Most labelled ids that are broadcast; more of them are joined.
BROADCAST_LABELS = 2_000_000
#: Most runs of five whose tables are sent to the tasks (some 30 bytes a run with the shorter runs); more of them are joined.
SENT_RUNS = 1 << 22
#: Tables of up to so many runs are made in one partition each.
ONE_PART_RUNS = 1 << 19
#: Distinct words a task remembers before it starts over.
MET_WORDS = 300_000
N_FEATURES = 4
#: Labelled folds that the curve is fitted to.
CURVE_FOLDS = (3, 4)
#: Log-ratios beyond this say no more than this.
LARGEST = 40.0
_SPACES = np.asarray([9, 10, 11, 12, 13, 32, 0x85, 0xA0], np.int64)


def symbols(text: str | None) -> np.ndarray:
    """12-bit symbols; code points from 3072 on share the upper 1024 symbols by remainder."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    folded = np.where(points < LOW_SYMBOLS, points, LOW_SYMBOLS + points % (4096 - LOW_SYMBOLS))
    folded[np.isin(points, _SPACES)] = 32
    return folded


def grams(ids: np.ndarray) -> np.ndarray:
    """The run of five symbols that ends at each position; spaces stand before the first."""
    padded = np.concatenate([np.full(ORDER - 1, 32, np.int64), ids])
    packed = np.zeros(len(ids), np.int64)
    for k in range(ORDER):
        packed = (packed << BITS) | padded[k:k + len(ids)]
    return packed


def learn_fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out, null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic (0 or 1) of labelled rows outside the held-out fold, with the fold.

    Of several labels of an id the highest counts; a null label is none."""
    own = (labels.select("doc_id", "toxic").where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (learn_fold(F.col("doc_id")) != 0))
           .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    side = F.broadcast(own) if labels.count() <= BROADCAST_LABELS else own
    return docs.select("doc_id", "text").join(side, "doc_id").select(learn_fold(F.col("doc_id")).alias("fold"), "text", "toxic")


def gram_counts(rows: DataFrame) -> DataFrame:
    """gram, fold, n1 (toxic), n0 (ordinary) over all rows of (fold, text, toxic); tasks count before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def reduced(parts: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            keys, where = np.unique(np.concatenate(parts), return_inverse=True)
            return keys, np.bincount(where, weights=np.concatenate(sums), minlength=len(keys)).astype(np.int64)

        def out(held: dict) -> Iterator[pa.RecordBatch]:
            for (fold_of, label), (keys, sums) in held.items():
                for at in range(0, len(keys), 100_000):
                    part = pa.array(sums[at:at + 100_000])
                    none = pa.array(np.zeros(len(part), np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(keys[at:at + 100_000]), pa.repeat(fold_of, len(part)).cast(pa.int64()), part if label else none, none if label else part], names=["gram", "fold", "n1", "n0"])

        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[tuple[int, int], list[np.ndarray]] = defaultdict(list)
        size: Counter = Counter()

        def gather(group: tuple[int, int]) -> None:
            fresh, waiting[group], size[group] = waiting[group], [], 0
            if fresh:
                keys, sums = reduced(fresh, [np.ones(sum(map(len, fresh)))])
                held[group] = reduced([keys, held[group][0]], [sums, held[group][1]]) if group in held else (keys, sums)

        for batch in batches:
            for text, *group in zip(batch.column(0), batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                ids, group = symbols(text.as_py()), tuple(group)
                for at in range(0, len(ids), CHUNK):
                    lead = max(0, at - ORDER + 1)
                    waiting[group].append(grams(ids[lead:at + CHUNK])[at - lead:])
                    size[group] += len(waiting[group][-1])
                    if sum(size.values()) >= CHUNK:
                        for of in list(waiting):
                            gather(of)
            if sum(len(x[0]) for x in held.values()) > 2 * CHUNK:
                yield from out(held)
                held.clear()
        for of in list(waiting):
            gather(of)
        yield from out(held)

    counted = rows.select("text", "toxic", F.col("fold").cast("long")).mapInArrow(count, "gram long, fold long, n1 long, n0 long")
    return counted.groupBy("gram", "fold").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def _lower(counts: DataFrame, order: int) -> DataFrame:
    """Continuation counts of the order below: how many kinds of symbol stand before each run."""
    suffix = F.col("gram").bitwiseAND(F.lit((1 << (BITS * (order - 1))) - 1))
    return counts.groupBy(suffix.alias("gram")).agg(*(F.sum((F.col(n) > 0).cast("long")).alias(n) for n in ("n1", "n0")), F.count("*").alias("n"))


def _totals(counts: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    context = F.shiftright("gram", BITS).alias("context")
    return counts.groupBy(context).agg(*(f for n in columns for f in (F.sum(n).alias(f"sum_{n}"), F.sum((F.col(n) > 0).cast("long")).alias(f"kinds_{n}"))))


def _weight(n: str) -> Column:
    """Share of the order below in a context; all of it where the context is unseen."""
    return F.when(F.col(f"sum_{n}") > 0, DISCOUNT * F.col(f"kinds_{n}") / F.col(f"sum_{n}")).otherwise(F.lit(1.0))


def _seen(n: str) -> Column:
    return F.when(F.col(f"sum_{n}") > 0, F.greatest(F.col(n) - DISCOUNT, F.lit(0.0)) / F.col(f"sum_{n}")).otherwise(F.lit(0.0))


class RatioTables:
    """Sorted keys and log-ratios of each order, for scoring in tasks."""

    def __init__(self, tables: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]):
        self.tables = tables

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(table[0], keys)
        at[at == len(table[0])] = 0
        hit = table[0][at] == keys if len(table[0]) else np.zeros(len(keys), bool)
        return hit, np.where(hit, table[1][at], 0.0) if len(table[0]) else np.zeros(len(keys))

    def ratios(self, packed: np.ndarray) -> np.ndarray:
        """Toxic less ordinary log-likelihood of each run's last symbol."""
        keys, where = np.unique(packed, return_inverse=True)
        total, open_ = np.zeros(len(keys)), np.arange(len(keys))
        for order in range(ORDER, 2, -1):
            own = keys[open_] & ((1 << (BITS * order)) - 1)
            hit, value = self._find(self.tables["gram", order], own)
            total[open_[hit]] += value[hit]
            open_, own = open_[~hit], own[~hit]
            total[open_] += self._find(self.tables["context", order], own >> BITS)[1]
        return total[where]


class JoinedRatios:
    """The log-ratios of each order as tables k, v: for scoring by joins, whatever their size."""

    def __init__(self, frames: dict[tuple[str, int], DataFrame]):
        self.frames = frames

    def ratios(self, keys: DataFrame) -> DataFrame:
        """gram, ratio of each row of `keys` (distinct grams), as `RatioTables.ratios` has it."""
        at, value = keys.select("gram"), F.lit(0.0)
        for order in range(3, ORDER + 1):
            own = F.col("gram").bitwiseAND(F.lit((1 << (BITS * order)) - 1))
            for kind, key in (("gram", own), ("context", F.shiftright(own, BITS))):
                found = self.frames[kind, order].select(F.col("k").alias(f"{kind}{order}_k"), F.col("v").alias(f"{kind}{order}"))
                at = at.join(found, key == F.col(f"{kind}{order}_k"), "left").drop(f"{kind}{order}_k")
            value = F.coalesce(F.col(f"gram{order}"), F.coalesce(F.col(f"context{order}"), F.lit(0.0)) + value)
        return at.select("gram", value.alias("ratio"))


def fit_ratios(counted: DataFrame, *, without: tuple[int, ...] = (), max_entries: int = SENT_RUNS) -> RatioTables | JoinedRatios:
    """The log-ratio tables of orders 5 to 3 from `gram_counts`, every counted run in them; `without` leaves folds out.

    Up to `max_entries` runs of five, which no other table exceeds, the tables are sent to the
    tasks; more of them are joined, with the same ratios. Runs grow far slower than the rows, joins of each
    text's words with them as the rows do. Tables of up to `ONE_PART_RUNS` are made in one partition each, larger ones in as many as they fill.
    """
    ensure_checkpoint_dir(counted.sparkSession)
    some = counted.where(~F.col("fold").isin(*without)) if without else counted
    summed = some.groupBy("gram").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    counts = {ORDER: compact(summed.withColumn("n", F.col("n1") + F.col("n0")))}
    size = counts[ORDER].count()
    sent = size <= max_entries
    if sent and size <= ONE_PART_RUNS:
        counts[ORDER] = counts[ORDER].coalesce(1)
    for order in range(ORDER, 1, -1):
        counts[order - 1] = compact(_lower(counts[order], order))
    n_all, n_kinds = counts[1].agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    below = counts[1].select("gram", ((F.col("n") + 0.5) / (n_all + 0.5 * (n_kinds + 1))).alias("p"))
    two = counts[2].join(_totals(counts[2], ("n",)), F.shiftright("gram", BITS) == F.col("context"))
    mask = F.col("gram").bitwiseAND(F.lit((1 << BITS) - 1))
    p2 = two.join(below.withColumnRenamed("gram", "suffix"), mask == F.col("suffix")).select("gram", (_seen("n") + _weight("n") * F.col("p")).alias("p1"))
    below = p2.withColumn("p0", F.col("p1"))
    frames: dict[tuple[str, int], DataFrame] = {}
    found: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}

    def take(key: tuple[str, int], table: DataFrame, value: Column) -> None:
        kept = table.select(F.col(table.columns[0]).alias("k"), value.cast("double").alias("v"))
        if sent:
            got = kept.toArrow().sort_by("k")
            found[key] = got["k"].to_numpy().astype(np.int64), got["v"].to_numpy().astype(np.float64)
        else:
            frames[key] = kept.checkpoint()

    for order in range(3, ORDER + 1):
        totals = _totals(counts[order], ("n1", "n0"))
        mask = F.col("gram").bitwiseAND(F.lit((1 << (BITS * (order - 1))) - 1))
        joined = (counts[order].join(totals, F.shiftright("gram", BITS) == F.col("context"))
                  .join(below.withColumnRenamed("gram", "suffix"), mask == F.col("suffix")))
        below = joined.select("gram", *((_seen(f"n{c}") + _weight(f"n{c}") * F.col(f"p{c}")).alias(f"p{c}") for c in (1, 0))).checkpoint()
        take(("gram", order), below, F.log("p1") - F.log("p0"))
        take(("context", order), totals, F.log(_weight("n1")) - F.log(_weight("n0")))
    return RatioTables(found) if sent else JoinedRatios(frames)


def word_starts(ids: np.ndarray) -> np.ndarray:
    """Where the words of a text begin: a word is a run of symbols with the space before it."""
    return np.flatnonzero(np.concatenate([[True], (ids[1:] == 32) & (ids[:-1] != 32)]))


def features(ratio: np.ndarray, ids: np.ndarray) -> list[float]:
    """Length-normalised log-likelihood ratios of a text: over all of it, and of its words.

    A word is a run of symbols with the space before it. Words are summed up by how many of them
    per word, per square root of words and at most lie above an even ratio."""
    if not len(ids):
        return [0.0] * N_FEATURES
    word = np.add.reduceat(ratio, word_starts(ids))
    high = np.sort(word)[::-1]
    return [float(ratio.sum() / len(ratio)), float(word.sum() / math.sqrt(len(word))), float(high[0]), float(high[:3].mean())]


def text_features(tables: RatioTables, text: str | None) -> list[float]:
    ids = symbols(text)
    ratio = np.zeros(len(ids))
    for at in range(0, len(ids), CHUNK):
        lead = max(0, at - ORDER + 1)
        ratio[at:at + CHUNK] = tables.ratios(grams(ids[lead:at + CHUNK])[at - lead:])
    return features(ratio, ids)


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def text_words(text: str | None) -> Counter:
    """Words of a text with the four symbols before each, two bytes a symbol, and how often each occurs."""
    ids = symbols(text)
    if not len(ids):
        return Counter()
    held = np.concatenate([np.full(ORDER - 1, 32), ids]).astype("<u2").tobytes()
    cuts = [*word_starts(ids).tolist(), len(ids)]
    return Counter(held[2 * at:2 * (end + ORDER - 1)] for at, end in zip(cuts, cuts[1:]))


def _word_keys(words: Iterable[bytes]) -> np.ndarray:
    """Digests of words as two longs each."""
    return np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=16).digest() for w in words), "<i8").reshape(-1, 2)


def joined_features(rows: DataFrame, tables: JoinedRatios) -> DataFrame:
    """f_id, f_key (doc_id, hash of the text) and x, the features of `features`, of each distinct (doc_id, text) with a symbol.

    A document's distinct words are joined with the words' ratios; these are sums over the runs of
    each distinct word, which are joined with the tables. A word or run that many have is spread by
    joins that Spark can split; only a document's own words meet in one row."""

    def gathered(parts: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for part in parts:
            waiting.append(part)
            held += len(part[-1])
            if held >= 100_000:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*waiting)], names=names)
                waiting, held = [], 0
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*waiting)], names=names)

    def doc_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, key, text in zip(*(batch.column(k) for k in range(3))):
                    if found := text_words(text.as_py()):
                        keys = _word_keys(found)
                        yield pa.repeat(doc_id, len(found)), pa.repeat(key, len(found)), pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), pa.array(list(found.values()), pa.int64())

        return gathered(parts(), ["f_id", "f_key", "w1", "w2", "n"])

    def word_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple]:
            met: set[bytes] = set()
            for batch in batches:
                for text in batch.column(0):
                    fresh = [w for w in text_words(text.as_py()) if w not in met]
                    met.update(w for w in fresh if len(w) <= 64)
                    if len(met) > MET_WORDS:
                        met.clear()
                    if not fresh:
                        continue
                    found = [np.unique(grams(np.frombuffer(w, "<u2").astype(np.int64))[ORDER - 1:], return_counts=True) for w in fresh]
                    keys = np.repeat(_word_keys(fresh), [len(runs) for runs, _ in found], axis=0)
                    yield pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), *(pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found))

        return gathered(parts(), ["w1", "w2", "gram", "times"])

    keyed = rows.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), "text")
    runs = keyed.select("text").mapInArrow(word_runs, "w1 long, w2 long, gram long, times long").distinct().checkpoint()
    words = (runs.join(tables.ratios(runs.select("gram").distinct()), "gram").groupBy("w1", "w2")
             .agg(F.sum(F.col("times") * F.col("ratio")).alias("ratio"), F.sum("times").alias("size")))
    met = keyed.mapInArrow(doc_words, "f_id long, f_key long, w1 long, w2 long, n long").join(words, ["w1", "w2"])
    # Equal rows bring the same entries, and a set holds each once.
    held = met.groupBy("f_id", "f_key").agg(F.sort_array(F.collect_set(F.struct("ratio", "n", "size", "w1", "w2")), asc=False).alias("e"))
    total = lambda f: F.aggregate("e", F.lit(0.0), lambda a, e: a + f(e))
    first = F.slice(F.flatten(F.transform(F.slice("e", 1, 3), lambda e: F.array_repeat(e["ratio"], F.least(e["n"], F.lit(3)).cast("int")))), 1, 3)
    summed = held.select("f_id", "f_key", total(lambda e: e["n"] * e["ratio"]).alias("all"), total(lambda e: e["n"].cast("double")).alias("words"),
                         total(lambda e: (e["n"] * e["size"]).cast("double")).alias("size"), first.alias("high"))
    mean = F.aggregate("high", F.lit(0.0), lambda a, r: a + r) / F.size("high")
    return summed.select("f_id", "f_key", F.array(F.col("all") / F.col("size"), F.col("all") / F.sqrt("words"), F.col("high")[0], mean).alias("x"))


def with_features(rows: DataFrame, tables: JoinedRatios) -> DataFrame:
    """`rows` with f_x, the features of each row's text."""
    found = joined_features(rows, tables).withColumnRenamed("x", "f_x")
    keyed = rows.withColumn("f_text", text_key())
    met = keyed.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("f_id")) & (F.col("f_text") == F.col("f_key")), "left")
    return met.select(*rows.columns, F.coalesce("f_x", F.array(*[F.lit(0.0)] * N_FEATURES)).alias("f_x"))


def fit_logistic(x: np.ndarray, y: np.ndarray, *, ridge: float = 1.0, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(weights with the constant last, scale) of a ridge logistic regression by Newton steps, no feature's weight below zero.

    A higher log-ratio never speaks against toxicity: the feature with the lowest weight goes until none is negative."""
    scale = np.maximum(np.abs(x).mean(axis=0), 1e-9)
    a = np.column_stack([x / scale, np.ones(len(x))])
    hold = np.diag([ridge] * x.shape[1] + [1e-6])
    free = list(range(a.shape[1]))
    while True:
        w = np.zeros(a.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            slope, bend = a.T @ (p - y) + hold @ w, (a.T * (p * (1 - p))) @ a + hold
            w[free] -= np.linalg.solve(bend[np.ix_(free, free)], slope[free])
        lowest = min(free[:-1], key=lambda k: w[k], default=None)
        if lowest is None or w[lowest] >= 0:
            return w, scale
        free.remove(lowest)


class ToxicityModel:
    """Log-ratio tables and the logistic curve that turns features into a score."""

    def __init__(self, tables: RatioTables | JoinedRatios, weights: np.ndarray, scale: np.ndarray):
        self.tables, self.weights, self.scale = tables, weights, scale

    @property
    def joined(self) -> bool:
        return isinstance(self.tables, JoinedRatios)

    def scored(self, rows: DataFrame) -> DataFrame:
        """`rows` with f_score, by joins."""
        clipped = [F.least(F.greatest(F.col("f_x")[k], F.lit(-LARGEST)), F.lit(LARGEST)) for k in range(N_FEATURES)]
        z = sum((x / float(s) * float(w) for x, s, w in zip(clipped, self.scale, self.weights)), F.lit(float(self.weights[-1])))
        return with_features(rows, self.tables).select(*rows.columns, (1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))).alias("f_score"))

    def score(self, text: str | None) -> float:
        x = np.clip(np.asarray(text_features(self.tables, text)), -LARGEST, LARGEST)
        z = float((x / self.scale) @ self.weights[:-1] + self.weights[-1])
        return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))


def fit(docs: DataFrame, labels: DataFrame, *, curve_rows: int = 20_000, max_entries: int = SENT_RUNS) -> ToxicityModel:
    """Learn from labelled rows outside the held-out fold.

    Folds 1 to 4 are counted, every row of them, and all of them are in the tables that score. The logistic curve
    is fitted to folds 3 and 4 with tables that have not seen them, on a sample by hash of at most about `curve_rows`
    rows. Without labelled rows of both classes the score is the share of toxic labels (0 without labels).
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    rows = labelled(docs, labels)
    counted = compact(gram_counts(rows))
    unseen = fit_ratios(counted, without=CURVE_FOLDS, max_entries=max_entries)
    tables = fit_ratios(counted, max_entries=max_entries)
    share = min(1.0, curve_rows / max(1, labels.where(learn_fold(F.col("doc_id")).isin(*CURVE_FOLDS) & F.col("toxic").isNotNull()).count()))
    sample = rows.where(F.col("fold").isin(*CURVE_FOLDS) & (F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000))).select(F.lit(None).cast("long").alias("doc_id"), "text", "toxic")

    def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(sent.value, text.as_py()) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    if isinstance(unseen, JoinedRatios):
        got = with_features(sample, unseen).select(F.col("f_x").alias("x"), "toxic").toArrow()
    else:
        sent = spark.sparkContext.broadcast(unseen)
        got = sample.select("text", "toxic").mapInArrow(feature_rows, "x array<double>, toxic int").toArrow()
        sent.unpersist()
    y = np.asarray(got["toxic"].to_pylist(), float)
    if not len(y) or y.min() == y.max():
        mean = float(y.mean()) if len(y) else 0.0
        flat = np.zeros(N_FEATURES + 1)
        flat[-1] = math.log((mean + 1e-9) / (1 - mean + 1e-9))
        return ToxicityModel(tables, flat, np.ones(N_FEATURES))
    x = np.asarray(got["x"].to_pylist())
    # The rows come in any order; a sorted sum does not depend on it.
    order = np.lexsort((*x.T, y))
    return ToxicityModel(tables, *fit_logistic(np.clip(x[order], -LARGEST, LARGEST), y[order]))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score of every row of `docs`, by the whole text; null text scores as empty."""
    if model.joined:
        return model.scored(docs.select(F.col("doc_id").cast("long"), "text")).select("doc_id", F.col("f_score").alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([sent.value.score(text.as_py()) for text in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scored, "doc_id long, score double")


def keep_ordinary(docs: DataFrame, model: ToxicityModel, *, reject: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, whose score is below `reject`."""
    if model.joined:
        return model.scored(docs).where(F.col("f_score") < reject).select(*docs.columns)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([sent.value.score(text.as_py()) < reject for text in batch.column("text")], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
