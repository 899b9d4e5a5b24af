"""Embedding near-duplicates: one hierarchical navigable small-world graph per shard.

Vectors of a label are dealt to shards of bounded size and each shard builds its graph in one task.
Every vector then queries every shard of its label: one task meets two shards and asks in both
directions, so a pair of graphs is sent and decoded once. A query's beam doubles while all it holds lies
within the threshold; a shard's first beam doubles until an audit passes: vectors of the shard moved
to just above the threshold must be found again, and neighbours found by brute force too.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnbook.llm.components import components
from cairnbook.session import ensure_checkpoint_dir

#: Links per node above the ground layer (twice as many on it), beam while building.
LINKS, BUILD_BEAM = 12, 64
#: Most rows of a shard, and most bytes of its vectors as doubles.
SHARD_ROWS, SHARD_BYTES = 8192, 64 << 20
#: Rows of a link matrix that are summed at once.
SUM_ROWS = 512
#: Nodes of a beam whose links are followed at once.
EXPAND = 8


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


class Graph:
    """Layers of neighbour lists over unit vectors; layer 0 holds every node."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], entry: int):
        self.vectors, self.layers, self.entry = vectors, layers, entry
        self._seen = np.zeros(len(vectors), np.int64)
        self._round = 0

    def beam(self, q: np.ndarray, starts: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The up to `width` best nodes met and their cosines, best first."""
        links, seen = self.layers[layer], self._seen
        self._round += 1
        nodes = np.unique(starts)
        seen[nodes] = self._round
        near = self.vectors[nodes] @ q
        order = np.argsort(-near, kind="stable")[:width]
        nodes, near, fresh = nodes[order], near[order], np.ones(min(len(order), width), bool)
        while True:
            open_ = np.flatnonzero(fresh)[:EXPAND]
            if not len(open_):
                return nodes, near
            fresh[open_] = False
            met = links[nodes[open_]].ravel()
            met = np.unique(met[met >= 0])
            met = met[seen[met] != self._round]
            if not len(met):
                continue
            seen[met] = self._round
            value = self.vectors[met] @ q
            if len(nodes) >= width:
                better = value > near[-1]
                met, value = met[better], value[better]
                if not len(met):
                    continue
            nodes, near, fresh = np.concatenate([nodes, met]), np.concatenate([near, value]), np.concatenate([fresh, np.ones(len(met), bool)])
            order = np.argsort(-near, kind="stable")[:width]
            nodes, near, fresh = nodes[order], near[order], fresh[order]

    def descend(self, q: np.ndarray, to: int) -> np.ndarray:
        """Start nodes on layer `to`, from the entry down one best node per layer."""
        at = np.asarray([self.entry])
        for layer in range(len(self.layers) - 1, to, -1):
            at = self.beam(q, at, layer, 1)[0]
        return at

    def within(self, q: np.ndarray, threshold: float, width: int, starts: np.ndarray) -> np.ndarray:
        """Nodes found at `threshold` or nearer; a beam full of them is widened, one over all nodes is exact."""
        while True:
            if width >= len(self.vectors):
                return np.flatnonzero(self.vectors @ q >= threshold)
            nodes, near = self.beam(q, starts, 0, width)
            if near[-1] < threshold or len(nodes) < width:
                return nodes[near >= threshold]
            width, starts = 2 * width, nodes


def _diverse(vectors: np.ndarray, nodes: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Of nodes, best first, those not nearer to one already taken than to the point; filled up with the rest."""
    if len(nodes) <= most:
        return nodes
    nodes, near = nodes[:4 * most], near[:4 * most]
    among = vectors[nodes] @ vectors[nodes].T
    taken, worst = [], np.full(len(nodes), -np.inf)
    for i in range(len(nodes)):
        if near[i] >= worst[i]:
            taken.append(i)
            worst = np.maximum(worst, among[i])
            if len(taken) == most:
                break
    rest = [i for i in range(len(nodes)) if i not in set(taken)][:most - len(taken)]
    return nodes[taken + rest]


def build(vectors: np.ndarray, seed: int = 5) -> Graph:
    """Insert unit vectors one by one."""
    n = len(vectors)
    level = np.minimum((-np.log(np.random.default_rng(seed).random(n).clip(1e-12)) / np.log(LINKS)).astype(int), 6)
    level[0] = 0
    graph = Graph(vectors, [np.full((n, 2 * LINKS), -1, np.int32)], 0)
    for i in range(1, n):
        q, top = vectors[i], len(graph.layers) - 1
        at = graph.descend(q, min(int(level[i]), top))
        for layer in range(min(int(level[i]), top), -1, -1):
            links = graph.layers[layer]
            at, near = graph.beam(q, at, layer, BUILD_BEAM)
            chosen = _diverse(vectors, at, near, LINKS)
            links[i, :len(chosen)] = chosen
            for j in chosen.tolist():
                row = links[j]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = i
                else:
                    held = np.append(row, i)
                    value = vectors[held] @ vectors[j]
                    order = np.argsort(-value, kind="stable")
                    links[j] = _diverse(vectors, held[order], value[order], 2 * LINKS)
        if level[i] > top:
            graph.layers += [np.full((n, 2 * LINKS), -1, np.int32) for _ in range(int(level[i]) - top)]
            graph.entry = i
    return graph


def audited_beam(graph: Graph, threshold: float, *, probes: int = 256, recall: float = 0.99, first: int = 32, seed: int = 3) -> tuple[int, float]:
    """The first beam, doubled from `first`, at which `recall` of the audit's links are found, and that share.

    Audited from the entry, as a vector of another shard would search."""
    n = len(graph.vectors)
    random = np.random.default_rng(seed)
    picked = random.permutation(n)[:probes]
    noise = random.standard_normal((len(picked), graph.vectors.shape[1]))
    x = graph.vectors[picked]
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    size = np.linalg.norm(noise, axis=1, keepdims=True)
    cosine = min(1.0, threshold + 0.005)
    moved = cosine * x + np.sqrt(1 - cosine ** 2) * noise / np.maximum(size, 1e-12)
    queries = np.concatenate([moved, x])
    true = [set(np.flatnonzero(row >= threshold).tolist()) for row in queries @ graph.vectors.T]
    width, share = first, 1.0
    while width < n:
        found = sum(len(t & set(graph.within(q, threshold, width, graph.descend(q, 0)).tolist())) for q, t in zip(queries, true))
        share = found / max(1, sum(map(len, true)))
        if share >= recall:
            return width, share
        width *= 2
    return width, 1.0


def _shards(vectors: DataFrame) -> DataFrame:
    """label, dims, shard, rep, embedding of vectors that can link."""
    sizes = vectors.groupBy("label", "dims").agg(F.count("*").alias("n"))
    rows = F.least(F.lit(SHARD_ROWS), F.greatest(F.lit(64), (F.lit(SHARD_BYTES) / (8 * F.col("dims"))).cast("int")))
    return vectors.join(sizes, ["label", "dims"]).withColumn("shard", F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / rows)).cast("int"))


def build_index(vectors: DataFrame, *, threshold: float) -> DataFrame:
    """One row per shard: label, dims, shard, ids, copies, vectors, layers, entry, beam, recall. All vectors are indexed.

    `vectors` holds label, dims, node (a number of the vector), rep, copies, embedding; recall is what the audit measured."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rep", "node"])
        raw = np.asarray(pdf["embedding"].tolist(), np.float64)
        graph = build(unit(raw))
        beam, recall = audited_beam(graph, threshold)
        held = {name: [pdf[column].to_numpy(np.int64).tobytes()] for name, column in (("ids", "node"), ("copies", "copies"))}
        return pd.DataFrame({"label": pdf["label"].iloc[:1], "dims": pdf["dims"].iloc[:1], "shard": pdf["shard"].iloc[:1], **held,
                             "vectors": [raw.tobytes()], "layers": [[x.tobytes() for x in graph.layers]], "entry": [graph.entry], "beam": [beam], "recall": [recall]})

    return _shards(vectors).select("label", "dims", "shard", "node", "rep", "copies", "embedding").groupBy("label", "dims", "shard").applyInPandas(
        one, "label int, dims int, shard int, ids binary, copies binary, vectors binary, layers array<binary>, entry int, beam int, recall double")


def link_matrix(a: Graph, b: Graph, beams: tuple[int, int], threshold: float) -> np.ndarray:
    """Whether node i of `a` and node j of `b` link, found from either side; `a` may be `b`."""
    same = a is b
    hit = np.zeros((len(a.vectors), len(b.vectors)), bool)
    for i, q in enumerate(a.vectors):
        starts = b.descend(q, 0)
        hit[i, b.within(q, threshold, beams[1], np.append(starts, i) if same else starts)] = True
    if same:
        hit |= hit.T
        np.fill_diagonal(hit, False)
    else:
        for j, q in enumerate(b.vectors):
            hit[a.within(q, threshold, beams[0], a.descend(q, 0)), j] = True
    return hit


def tied(hit: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each row and column reaches over the links of a matrix. Rows and columns without links keep theirs."""
    rows, cols = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    sub, of_a, of_b = hit[np.ix_(rows, cols)], ids_a[rows], ids_b[cols]
    least = lambda m, ids: np.concatenate([np.where(m[k:k + SUM_ROWS], ids[None, :], np.iinfo(np.int64).max).min(axis=1) for k in range(0, len(m), SUM_ROWS)])
    while len(rows):
        new_a = np.minimum(of_a, least(sub, of_b))
        new_b = new_a if same else np.minimum(of_b, least(sub.T, new_a))
        done = np.array_equal(new_a, of_a) and np.array_equal(new_b, of_b)
        of_a, of_b = new_a, new_b
        if done:
            break
    all_a, all_b = ids_a.copy(), ids_b.copy()
    all_a[rows], all_b[cols] = of_a, of_b
    return all_a, all_b


def search(index: DataFrame, *, threshold: float) -> DataFrame:
    """node, linked, tied: for each vector and each shard it was compared with, the number of vectors (copies counted) that it
    links with there, and the smallest node that it reaches over the links of the two shards. Links themselves stay in the task."""
    keys = ["label", "dims"]
    shards = index.select(*keys, "shard")
    # Pairs are made of numbers; each graph is then fetched by its own key, so a label's graphs are spread over tasks.
    pairs = shards.withColumnRenamed("shard", "shard_a").join(shards.withColumnRenamed("shard", "shard_b"), keys).where("shard_a <= shard_b")
    side = lambda x: index.select(*keys, F.col("shard").alias(f"shard_{x}"), F.struct("ids", "copies", "vectors", "layers", "entry", "beam").alias(x))
    met = pairs.join(side("a"), [*keys, "shard_a"]).join(side("b"), [*keys, "shard_b"])

    def decoded(row: dict) -> tuple[Graph, np.ndarray, np.ndarray]:
        ids = np.frombuffer(row["ids"], np.int64)
        vectors = unit(np.frombuffer(row["vectors"]).reshape(len(ids), -1))
        return Graph(vectors, [np.frombuffer(x, np.int32).reshape(len(ids), -1) for x in row["layers"]], row["entry"]), ids, np.frombuffer(row["copies"], np.int64)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        same = bool(row["shard_a"] == row["shard_b"])
        a, ids_a, copies_a = decoded(row["a"])
        b, ids_b, copies_b = (a, ids_a, copies_a) if same else decoded(row["b"])
        hit = link_matrix(a, b, (row["a"]["beam"], row["b"]["beam"]), threshold)
        total = lambda m, copies: np.concatenate([m[k:k + SUM_ROWS].astype(np.int64) @ copies for k in range(0, len(m), SUM_ROWS)])
        of_a, of_b = tied(hit, ids_a, ids_b, same)
        out = [(ids_a, total(hit, copies_b), of_a)] + ([] if same else [(ids_b, total(hit.T, copies_a), of_b)])
        found = pd.DataFrame({name: np.concatenate([part[k] for part in out]) for k, name in enumerate(("node", "linked", "tied"))})
        return found[found["linked"] > 0]

    return met.groupBy(*keys, "shard_a", "shard_b").applyInPandas(one, "node long, linked long, tied long")


def near_duplicates(vectors: DataFrame, *, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of `vectors` (vec_id, embedding, label).

    Only vectors of equal, non-null labels and equal length are compared, by cosine in double precision. Equal vectors
    are one node that counts as often as it occurs. A null, zero or empty vector, or one with a null or non-finite component,
    a null label or a null vec_id links with nothing (null vec_id: null component_id, kept).
    Rows that repeat a vec_id are vectors of their own, with their own links and component.
    """
    ensure_checkpoint_dir(vectors.sparkSession)
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("int").alias("label"))
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False))
    can = rows.where(usable)
    nodes = can.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")).withColumn(
        "dims", F.size("embedding")).withColumn("node", F.monotonically_increasing_id()).checkpoint()
    index = build_index(nodes, threshold=threshold).checkpoint()
    found = search(index, threshold=threshold).checkpoint()
    grouped = components(found.select(F.col("node").alias("a"), F.col("tied").alias("b")))
    least = grouped.join(nodes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("component_id"))
    links = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    of_node = nodes.select("node", "rep", "copies").join(links, "node", "left").join(grouped.join(least, "component").select("node", "component_id"), "node", "left").select(
        "node", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    # A vector's own row finds its node by label and vector; rows that cannot link have no node.
    placed = can.select("vec_id", "label", "embedding").join(nodes.select("label", "embedding", "node"), ["label", "embedding"]).select("vec_id", "node")
    linked = placed.join(of_node, "node").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.union(alone)
