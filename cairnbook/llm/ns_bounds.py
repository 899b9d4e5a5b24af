"""k-means with bounds that are loosened by the norm of a sum.

A row keeps, for every centroid, a lower bound of its distance and the round it was taken in, and
the same as an upper bound for its own centroid. All centroids of all rounds are retained, so a
bound taken in round t is loosened in round T by |c(T) - c(t)|, the norm of the whole displacement,
which never exceeds the sum of the drifts of the rounds between. Centroids whose loosened bound no
longer rules them out are measured again, with whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnbook.session import new_run_dir

#: Components beyond it have squared distances that a long may not hold.
LARGEST = 1 << 27
#: Slack of the bounds: they are doubles, the distances behind them whole numbers.
SLACK = 1e-9


def kept_vectors(vectors: DataFrame, dims: int = 64, scale: int = 1024) -> DataFrame:
    """vec_id, x array<int>: floor(scale * component) of vectors with exactly `dims` finite components.

    A null vector, one with another length, a null, an infinite or a NaN component is left out; so is a
    component at or beyond LARGEST, whose squared distances no long holds. Rows that repeat an id stay."""
    raw = F.col("embedding").cast("array<double>")
    scaled = F.transform(raw, lambda c: F.floor(c * F.lit(float(scale))))
    fine = (F.size(raw) == dims) & F.forall(raw, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * F.lit(float(scale))) < F.lit(float(LARGEST))))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.cast("array<int>").alias("x"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of `seed:vec_id`; a null id comes last, equal ids go by their vectors."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select("x", rank.alias("h")).orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()
    return np.asarray([r.x for r in rows], np.int64)


def assign(x: np.ndarray, own: np.ndarray, high: np.ndarray, high_at: np.ndarray, low: np.ndarray, low_at: np.ndarray, history: np.ndarray) -> tuple[np.ndarray, ...]:
    """The state of rows after one assignment to the last centroids of `history` (rounds, k, dims), and how many distances were measured.

    `own` is the row's centroid (-1: none yet), `high` bounds its distance from above as of round
    `high_at`, `low` all distances from below as of the rounds `low_at`."""
    now = len(history) - 1
    at = history[now]
    moved = np.sqrt(((history - at).astype(np.float64) ** 2).sum(axis=2))  # (round, centroid)
    rows = np.arange(len(x))
    held = np.maximum(own, 0)
    upper = np.where(own < 0, np.inf, high + moved[high_at, held])
    lower = low - moved[low_at, np.arange(len(at))]
    lower[rows, held] = np.inf
    lower[own < 0] = -np.inf

    def measure(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i), np.int64)
        for begin in range(0, len(i), 8192):
            part = slice(begin, begin + 8192)
            out[part] = ((x[i[part]] - at[j[part]]) ** 2).sum(axis=1)
        return out

    own, high, high_at, low, low_at = own.copy(), high.copy(), high_at.copy(), low.copy(), low_at.copy()
    measured = 0
    best = np.full(len(x), -1, np.int64)
    # The upper bound of rows that some bound does not settle is taken anew first: that alone settles many.
    unsure = np.flatnonzero((own >= 0) & (lower.min(axis=1) <= upper * (1 + SLACK) + SLACK))
    best[unsure] = measure(unsure, own[unsure])
    measured += len(unsure)
    high[unsure], high_at[unsure] = np.sqrt(best[unsure]), now
    low[unsure, own[unsure]], low_at[unsure, own[unsure]] = high[unsure], now
    upper[unsure] = high[unsure]
    i, j = np.nonzero(lower <= (upper * (1 + SLACK) + SLACK)[:, None])
    d = measure(i, j)
    measured += len(i)
    low[i, j], low_at[i, j] = np.sqrt(d), now
    found = np.full((len(x), len(at)), np.iinfo(np.int64).max)
    found[i, j] = d
    again = np.unique(i)
    has = again[own[again] >= 0]
    found[has, own[has]] = best[has]
    own[again] = found[again].argmin(axis=1)  # the first of equal distances is the smaller number
    high[again], high_at[again] = np.sqrt(found[again, own[again]]), now
    return own, high, high_at, low, low_at, measured


_STATE = "vec_id long, x array<int>, before int, own int, high double, high_at int, low array<double>, low_at array<int>, measured int"


def _round(state: DataFrame, history: np.ndarray, exact: bool) -> DataFrame:
    """The next state of every row; with `exact`, vec_id, own, x and distance as whole numbers."""
    k, dims = history.shape[1:]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            flat = lambda name, kind, width: column(name).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(n, width)
            plain = lambda name, kind: column(name).to_numpy(zero_copy_only=False).astype(kind)
            x, before = flat("x", np.int64, dims), plain("own", np.int64)
            own, high, high_at, low, low_at, measured = assign(x, before, plain("high", np.float64), plain("high_at", np.int64), flat("low", np.float64, k), flat("low_at", np.int64, k), history)
            listed = lambda values, width, kind: pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(values.ravel(), kind))
            if exact:
                distance = ((x - history[-1][own]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([column("vec_id"), pa.array(own, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])
                continue
            share = np.zeros(n, np.int64)
            share[0] = measured
            yield pa.RecordBatch.from_arrays(
                [column("vec_id"), column("x"), pa.array(before, pa.int32()), pa.array(own, pa.int32()), pa.array(high), pa.array(high_at, pa.int32()), listed(low, k, pa.float64()), listed(low_at, k, pa.int32()), pa.array(share, pa.int32())],
                names=[part.split()[0] for part in _STATE.split(", ")])

    return state.mapInArrow(step, "vec_id long, cluster int, distance long" if exact else _STATE)


def _moves(state: DataFrame, dims: int) -> list:
    """Per centroid: rows and component sums that came minus those that went; rows that stayed take no part."""
    moved = state.where("own <> before").select("x", F.explode(F.array(
        F.struct(F.col("own").alias("j"), F.lit(1).alias("sign")), F.struct(F.col("before").alias("j"), F.lit(-1).alias("sign")))).alias("m"))
    sums = [F.sum(F.col("x")[d].cast("long") * F.col("m.sign")).alias(f"s{d}") for d in range(dims)]
    return moved.where("m.j >= 0").groupBy(F.col("m.j").alias("j")).agg(F.sum(F.col("m.sign").cast("long")).alias("n"), *sums).collect()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def fit(vectors: DataFrame, *, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> tuple[DataFrame | None, np.ndarray, list[int]]:
    """State of all kept rows after `rounds` rounds, the centroids of every round, and the distances measured by round.

    The state of a round is a table in the shared folder; the one before the last is deleted. Only k sums
    of `dims` components come to the driver. Without a kept vector the state is None."""
    spark = vectors.sparkSession
    folder = new_run_dir(spark, "ns-bounds")
    kept_vectors(vectors, dims, scale).write.parquet(f"{folder}/kept")
    kept = spark.read.parquet(f"{folder}/kept")
    at = first_centroids(kept, k, seed)
    if not len(at):
        return None, np.zeros((1, 0, dims), np.int64), []
    k = len(at)
    history, counts, sums, measured = [at], [0] * k, [[0] * dims for _ in range(k)], []
    # Bounds of the first round rule nothing out.
    state = kept.withColumns({"before": F.lit(-1), "own": F.lit(-1), "high": F.lit(0.0), "high_at": F.lit(0), "low": F.array_repeat(F.lit(0.0), k), "low_at": F.array_repeat(F.lit(0), k), "measured": F.lit(0)})
    for r in range(rounds):
        _round(state, np.asarray(history), exact=False).write.parquet(f"{folder}/{r}")
        state = spark.read.parquet(f"{folder}/{r}")
        _delete(spark, f"{folder}/{r - 1 if r else 'kept'}")
        for row in _moves(state, dims):
            counts[row.j] += row.n
            sums[row.j] = [s + row[f"s{d}"] for d, s in enumerate(sums[row.j])]
        measured.append(state.agg(F.sum(F.col("measured").cast("long"))).first()[0])
        history.append(np.asarray([[s // n for s in of] if n else old for n, of, old in zip(counts, sums, history[-1].tolist())], np.int64))
    return state, np.asarray(history), measured


def _total(values: Column) -> Column:
    return F.sum(values.cast("decimal(38,0)"))


def cluster(vectors: DataFrame, *, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of every kept row of `vectors` (vec_id, embedding).

    Null ids and repeated rows are rows of their own; with fewer than k vectors there are fewer
    centroids; an empty table gives no rows; ties go to the smaller number; other columns are ignored.
    A sum of distances that no long holds is null."""
    spark = vectors.sparkSession
    state, history, _ = fit(vectors, k=k, rounds=rounds, dims=dims, scale=scale, seed=seed)
    kinds = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if state is None:
        return spark.createDataFrame([], kinds)
    path = new_run_dir(spark, "ns-bounds-assigned")
    _round(state, history, exact=True).write.parquet(path)
    assigned = spark.read.parquet(path)
    of = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(_total(F.col("distance")).alias("total")).collect()}
    fits = lambda v: v if v < 1 << 63 else None
    rows = [(j, fits(of.get(j, 0)), fits(sum(of.values())), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(history[-1].tolist())]
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(told), "cluster").select(*(part.split()[0] for part in kinds.split(", ")))


def oracle(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """DuckDB SQL of the same rounds, every distance measured."""
    steps = [f"""
e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
f AS MATERIALIZED (SELECT r, vec_id, list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM e
      WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS MATERIALIZED (SELECT r, d, x[d] AS x FROM f, range(1, {dims + 1}) AS t(d)),
i AS (SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR) NULLS LAST, x) - 1 AS j FROM f),
c0 AS MATERIALIZED (SELECT j, d, x FROM i JOIN v USING (r) WHERE j < {k})"""]
    for t in range(rounds + 1):
        steps.append(f"a{t} AS MATERIALIZED (SELECT r, arg_min(j, (s, j)) AS j, min(s) AS s FROM (SELECT r, j, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS s FROM v JOIN c{t} c USING (d) GROUP BY r, j) GROUP BY r)")
        if t < rounds:
            steps.append(f"m{t} AS (SELECT j, d, sum(x)::BIGINT AS s, count(*) AS n FROM v JOIN a{t} USING (r) GROUP BY j, d)")
            steps.append(f"c{t + 1} AS MATERIALIZED (SELECT j, d, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x) AS x FROM c{t} c LEFT JOIN m{t} m USING (j, d))")
    steps.append(f"h AS (SELECT j, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS sha FROM c{rounds} GROUP BY j)")
    return "WITH " + reduce(lambda a, b: f"{a},\n{b}", steps) + f"""
SELECT vec_id, a.j::INTEGER AS cluster, s AS distance, (sum(s) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia, (sum(s) OVER ())::BIGINT AS inertia, sha AS centroid_sha256
FROM f JOIN a{rounds} a USING (r) JOIN h USING (j)
"""
