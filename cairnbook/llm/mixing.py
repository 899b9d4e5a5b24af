"""Mixing to target weights by soft membership: domain posteriors of each text, then rates by projected gradient.

A classifier over hashed words, learned from labelled rows, gives every text a posterior over
domains. Rates are the nonnegative least-squares fit of expected domain token totals to targets;
a step needs the totals only, one row, and the rate of a text follows from its own posterior and
the steps so far. All of it is DataFrame expressions.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnbook.session import ensure_checkpoint_dir

#: Hash buckets of words.
BUCKETS = 4096
#: Most labelled ids that are broadcast; more of them are joined.
BROADCAST_LABELS = 2_000_000
_SPACE = r"[\x20\x09-\x0D]+"


@dataclass
class Domains:
    """Names, and per bucket the log-likelihood of each domain (less the mean over domains)."""

    names: list[str]
    weights: np.ndarray
    prior: np.ndarray


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more).withColumn("text_key", F.xxhash64("text"))


def _words(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per word: the kept columns and the word's bucket."""
    return rows.select(*keep, F.explode(F.split(F.lower("text"), _SPACE)).alias("word")).where("word <> ''").select(*keep, F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int").alias("bucket"))


def learn(docs: DataFrame, labels: DataFrame, *, domain: str = "lang", rows: int = 20_000) -> Domains:
    """Learn every domain that occurs in about `rows` labelled rows at most, a sample by hash of the id.

    A row is labelled if its doc_id is in `labels` and `domain` is not null; the domain of other
    rows is never looked at."""
    ensure_checkpoint_dir(docs.sparkSession)
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    n = ids.count()
    share = min(1.0, rows / max(1, n))
    ids = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    known = _keyed(docs, F.col(domain).cast("string").alias("domain")).where("domain is not null").join(F.broadcast(ids) if n * share <= BROADCAST_LABELS else ids, "doc_id")
    counts = _words(known, "domain").groupBy("domain", "bucket").count().checkpoint()
    totals = counts.groupBy("domain").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "domain").collect()
    names = [r["domain"] for r in totals] or ["all"]
    table = np.full((BUCKETS, len(names)), 0.5)
    for r in counts.collect():
        table[r["bucket"], names.index(r["domain"])] += r["count"]
    likely = np.log(table / table.sum(axis=0))
    prior = np.asarray([r["n"] for r in totals] or [1], float)
    return Domains(names, likely - likely.mean(axis=1, keepdims=True), np.log(prior / prior.sum()))


def memberships(docs: DataFrame, domains: Domains, *, evidence_words: float = 3.0) -> DataFrame:
    """doc_id, text_key, tokens (words) and p (array, one per domain) of every distinct (doc_id, text).

    The evidence of a text is its mean per word times `evidence_words`, so long texts stay soft. A
    text without words has the prior. Sums per text are partial before the shuffle."""
    spark, d = docs.sparkSession, len(domains.names)
    table = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(domains.weights)], "bucket int, " + ", ".join(f"w{k} double" for k in range(d)))
    rows = _keyed(docs)
    sums = (_words(rows, "doc_id", "text_key").join(F.broadcast(table), "bucket").groupBy("doc_id", "text_key")
            .agg(F.count("*").alias("words"), *(F.sum(f"w{k}").alias(f"s{k}") for k in range(d))))
    # Equal rows add up to one entry; how many they are divides its words.
    each = rows.groupBy("doc_id", "text_key").agg(F.count("*").alias("rows"))
    joined = each.join(sums.withColumnsRenamed({"doc_id": "s_id", "text_key": "s_key"}), F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("text_key") == F.col("s_key")), "left")
    logs = [F.lit(float(domains.prior[k])) + evidence_words * F.coalesce(F.col(f"s{k}") / F.col("words"), F.lit(0.0)) for k in range(d)]
    scored = joined.select("doc_id", "text_key", "rows", (F.coalesce("words", F.lit(0)) / F.col("rows")).cast("long").alias("tokens"), F.array(*logs).alias("z"))
    raised = scored.select("doc_id", "text_key", "rows", "tokens", F.transform("z", lambda z: F.exp(z - F.array_max("z"))).alias("e"))
    total = sum((F.col("e")[k] for k in range(1, d)), F.col("e")[0])
    return raised.select("doc_id", "text_key", "rows", "tokens", F.array(*(F.col("e")[k] / total for k in range(d))).alias("p"))


def rate(steps: list[np.ndarray], *, least: float = 0.0) -> Column:
    """The rate after projected steps from one, from the posterior `p`; none lies below `least`."""
    r = F.lit(1.0)
    for u in steps:
        r = F.greatest(F.lit(least), r - sum((F.col("p")[k] * float(u[k]) for k in range(1, len(u))), F.col("p")[0] * float(u[0])))
    return r


def fit_rates(members: DataFrame, targets: np.ndarray | None, *, temper: float = 0.0, most_steps: int = 30, tolerance: float = 1e-4, least: float = 0.0) -> list[np.ndarray]:
    """Steps whose `rate` minimises the squared distance of expected domain totals to targets.

    `targets` are token totals; without them each domain's share of the present total is its share
    to the power `temper` (0: equal). The first steps are scaled by each domain's curvature: they reach targets that
    can be met, whose distance is zero by any scale, in few passes. If they come to rest short of the targets, plain
    gradient steps follow, whose resting point is the least-squares fit itself. Each kind ends when a step
    lowers the distance by less than `tolerance` of it, after `most_steps` at most; a fit that still moves then is warned of."""
    d = len(members.select("p").first()["p"]) if members.limit(1).count() else 0
    if not d:
        return []
    tokens = F.col("tokens") * F.col("rows")
    p = [F.col("p")[k] for k in range(d)]
    moments = members.agg(*(F.sum(tokens * p[k]) for k in range(d)), *(F.sum(tokens * p[i] * p[j]) for i in range(d) for j in range(d))).first()
    held = np.asarray([x or 0.0 for x in moments], float)
    now, curve = held[:d], held[d:].reshape(d, d)
    if now.sum() <= 0:
        return []
    if targets is None:
        share = np.where(now > 0, (now / now.sum()) ** temper, 0.0)
        targets = now.sum() * share / share.sum()
    diagonal = np.maximum(np.diag(curve), 1e-12 * now.sum())
    scaled = 1 / np.linalg.eigvalsh(curve / np.sqrt(np.outer(diagonal, diagonal)))[-1] / diagonal
    plain = np.full(d, 1 / np.linalg.eigvalsh(curve)[-1])
    near = tolerance * max(float(np.sum(targets)), 1e-9)
    steps: list[np.ndarray] = []
    for pace in (scaled, plain):
        resting = False
        for _ in range(most_steps):
            left = now - targets
            if np.abs(left).max() <= near:
                return steps
            steps.append(pace * left)
            now = np.asarray([x or 0.0 for x in members.agg(*(F.sum(tokens * p[k] * rate(steps, least=least)) for k in range(d))).first()], float)
            gain = left @ left - (now - targets) @ (now - targets)
            if resting := gain <= tolerance * (left @ left):
                break
    if not resting and np.abs(now - targets).max() > near:
        warnings.warn(f"rates still move after {len(steps)} steps; totals miss their targets by up to {np.abs(now - targets).max():.6g} tokens", stacklevel=2)
    return steps


def mix(docs: DataFrame, labels: DataFrame, *, domain: str = "lang", targets: dict[str, float] | None = None, temper: float = 0.0, grow: bool = False) -> tuple[DataFrame, Domains]:
    """doc_id, text_key, rows, tokens, p and rate of every distinct (doc_id, text), and the domains.

    `targets`: token totals by domain, 0 for those left out; a domain that is not modelled is an error.
    `grow`: totals are raised together, as far as the smallest rate of a text asks for, and no rate is
    below one, so that no text goes. They are at most doubled for that; where domains are so much alike
    that this falls short, the rates are the best fit from one on."""
    domains = learn(docs, labels, domain=domain)
    if unknown := sorted(set(targets or ()) - set(domains.names)):
        raise ValueError(f"no labelled text of the domains {', '.join(unknown)}")
    members = memberships(docs, domains).checkpoint()
    wanted = np.asarray([float(targets.get(name, 0.0)) for name in domains.names]) if targets is not None else None
    if wanted is None and grow:
        d = len(domains.names)
        now = np.asarray([x or 0.0 for x in members.agg(*(F.sum(F.col("tokens") * F.col("rows") * F.col("p")[k]) for k in range(d))).first()], float)
        share = np.where(now > 0, (now / max(now.sum(), 1e-9)) ** temper, 0.0)
        held = now > 0
        wanted = share * (now[held] / share[held]).max() if held.any() else now
    steps, least = fit_rates(members, wanted, temper=temper), 0.0
    if grow and targets is None and steps:
        lowest, least = members.agg(F.min(rate(steps))).first()[0], 1.0
        if lowest < 1:
            steps = fit_rates(members, wanted / max(lowest, 0.5), least=least)
    return members.withColumn("rate", rate(steps, least=least)), domains


def draw(docs: DataFrame, rates: DataFrame, *, seed: int = 11) -> DataFrame:
    """`docs`, all columns, each row as often as its rate says: the whole part, and the rest by a hash of id and text."""
    names = docs.columns
    rest = F.pmod(F.xxhash64("r_id", "r_key", F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    copies = rates.select(F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_key"), "rate").select(
        "r_id", "r_key", (F.floor("rate") + (rest < F.col("rate") - F.floor("rate")).cast("long")).cast("int").alias("r_copies")).where("r_copies > 0")
    keyed = docs.withColumn("r_text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    met = keyed.join(copies, F.col("doc_id").cast("long").eqNullSafe(F.col("r_id")) & (F.col("r_text_key") == F.col("r_key")))
    return met.select(*names, F.explode(F.expr("sequence(1, r_copies)")).alias("r_copy")).select(*names)
