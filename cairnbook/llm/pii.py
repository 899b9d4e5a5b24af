"""Personal data: pattern spans, and spans added by a skip-chain conditional random field.

Tokens with a digit or an @ are the nodes of a graph per document; any other token is certainly no
entity and serves as context. Neighbouring tokens share a transition potential; a token and its next
repeat (same letters and digits) share a potential for equal labels, however far apart. Loopy
message passing gives each token's label probabilities, so what is plain in one place carries over
to repeats that the patterns miss. Weights are learned from the pattern spans of a bounded sample.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
MASKS = {kind: f"[{kind.upper()}]" for kind in KINDS}
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is never entered in its middle, which keeps long runs linear; the matches are those of the plain pattern.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NODE = re.compile(r"[0-9@]")
_CORE = re.compile(r"[\w+(].*[\w)]|\w", re.S)
FEATURE_BITS = 12

Span = tuple[int, int]


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum((2 * d) // 10 + (2 * d) % 10 for d in map(int, digits[-2::-2]))) % 10 == 0


def _emails(text: str) -> list[Span]:
    found, end, at = [], 0, text.find("@")
    low = 0
    while at >= 0:
        start = max(low, end)
        local = _LOCAL.match(text[start:at][::-1])
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            found.append((at - local.end(), domain.end()))
            end = domain.end()
        low, at = at + 1, text.find("@", at + 1)
    return found


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of each kind by its pattern, leftmost and not overlapping; failing matches are dropped."""
    cards, phones = [], []
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 38 and 16 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and _luhn(digits):
            cards.append(m.span())
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            phones.append(m.span())
    ips = [m.span() for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    return {"email": _emails(text), "ip": ips, "card": cards, "phone": phones}


def _joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind in KINDS for start, end in sorted(spans[kind]))


@dataclass
class Graph:
    """Candidate tokens of one text: spans, hashed features, edges (i, j, is a skip edge), and whether a token follows the one before."""

    spans: list[Span]
    features: np.ndarray
    edges: list[tuple[int, int, bool]]
    follows: list[bool]


def _hashed(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(parts).encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little") & ((1 << FEATURE_BITS) - 1)


def _shape(token: str) -> str:
    """Character classes with runs cut to one, of a token's first 64 characters."""
    kinds = ["0" if c in "0123456789" else "a" if c.isalpha() else c for c in token[:64]]
    return "".join(k for i, k in enumerate(kinds) if not i or kinds[i - 1] != k)


def graph(text: str) -> Graph:
    """Only tokens with a digit or @ become nodes; each is tied to the next node and to its next repeat."""
    spans, rows, edges, follows = [], [], [], []
    last_seen: dict[str, int] = {}
    previous, waiting, last_end = "", None, -1
    for m in _WORD.finditer(text):
        token = m[0]
        if waiting is not None:
            rows[waiting].append(_hashed("next", token[:1] if _NODE.search(token) else "w"))
            waiting = None
        if _NODE.search(token):
            core = _CORE.search(token)
            start, end = (m.start() + core.start(), m.start() + core.end()) if core else m.span()
            inner, node = text[start:end], len(spans)
            digits = len(_NOT_DIGIT.sub("", inner))
            rows.append([_hashed("shape", _shape(inner)), _hashed("digits", str(min(digits, 24))), _hashed("length", str(min(len(inner), 48) // 4)),
                         _hashed("first", inner[:1] if not inner[:1].isalnum() else _shape(inner[:1])), _hashed("dots", str(min(inner.count("."), 5))),
                         _hashed("at", str("@" in inner)), _hashed("before", previous[-1:] if not previous[-1:].isalnum() else "w")])
            adjacent = bool(spans) and last_end == m.start() - 1
            if spans:
                edges.append((node - 1, node, False)) if adjacent else None
            follows.append(adjacent)
            key = re.sub(r"\W+", "", inner).lower()
            if len(key) >= 6:
                if key in last_seen:
                    edges.append((last_seen[key], node, True))
                last_seen[key] = node
            spans.append((start, end))
            waiting, last_end = node, m.end()
        previous = token
    if waiting is not None:
        rows[waiting].append(_hashed("next", ""))
    return Graph(spans, np.asarray(rows, np.int64).reshape(len(rows), -1), edges, follows)


def _labels_of(nodes: Graph, base: dict[str, list[Span]]) -> np.ndarray:
    """Label of each token: the kind whose pattern span it touches, the first listed of several."""
    out = np.zeros(len(nodes.spans), np.int64)
    for label in range(len(KINDS), 0, -1):
        found = sorted(base[KINDS[label - 1]])
        if found and nodes.spans:
            ends, starts = np.asarray([e for _, e in found]), np.asarray([s for s, _ in found])
            at = np.searchsorted(ends, [s for s, _ in nodes.spans], side="right")
            inside = at < len(found)
            touch = np.zeros(len(out), bool)
            touch[inside] = starts[at[inside]] < np.asarray([e for _, e in nodes.spans])[inside]
            out[touch] = label
    return out


@dataclass
class Field:
    """Learned potentials (logs): features by label, transitions of neighbours, agreement of repeats."""

    weights: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, nodes: Graph, *, rounds: int = 30, tolerance: float = 1e-4) -> np.ndarray:
        """Label probabilities of each token by loopy sum-product messages with damping."""
        own = self.weights[nodes.features].sum(axis=1)
        if nodes.edges:
            i, j, skip = (np.asarray(x) for x in zip(*nodes.edges))
            pair = np.where(skip[:, None, None], self.skip, self.chain)
            source, target = np.concatenate([i, j]), np.concatenate([j, i])
            forward = np.concatenate([pair, pair.transpose(0, 2, 1)])
            opposite = np.concatenate([np.arange(len(i)) + len(i), np.arange(len(i))])
            sent = np.zeros((len(source), len(LABELS)))
            for _ in range(rounds):
                belief = own.copy()
                np.add.at(belief, target, sent)
                incoming = (belief[source] - sent[opposite])[:, :, None] + forward
                top = incoming.max(axis=1, keepdims=True)
                fresh = np.log(np.exp(incoming - top).sum(axis=1)) + top[:, 0]
                fresh -= fresh.max(axis=1, keepdims=True)
                moved, sent = np.abs(fresh - sent).max(), 0.5 * (fresh + sent)
                if moved < tolerance:
                    break
            np.add.at(own, target, sent)
        own = np.exp(own - own.max(axis=1, keepdims=True))
        return own / own.sum(axis=1, keepdims=True)


def train(samples: list[tuple[np.ndarray, np.ndarray, list[tuple[int, int, bool]]]], *, steps: int = 200, ridge: float = 1e-3) -> Field:
    """Potentials from (features, labels, edges) of sample texts: a softmax regression for features,
    log ratios of pair counts against chance for neighbours and repeats. Without samples every token is none."""
    n = len(LABELS)
    weights = np.zeros((1 << FEATURE_BITS, n))
    chain, skip = np.ones((n, n)), np.eye(n) * 4 + 1
    samples = [s for s in samples if len(s[0])]
    if not samples:
        weights[:, 0] = 1.0
        return Field(weights, np.zeros((n, n)), np.log(skip))
    x, y = np.concatenate([s[0] for s in samples]), np.concatenate([s[1] for s in samples])
    pace = np.full_like(weights, 1e-8)
    for _ in range(steps):
        z = weights[x].sum(axis=1)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        slope = np.stack([np.bincount(x.ravel(), np.repeat(p[:, k], x.shape[1]), 1 << FEATURE_BITS) for k in range(n)], axis=1) / len(y) + ridge * weights / len(y)
        pace += slope ** 2
        weights -= 0.5 * slope / np.sqrt(pace)
    for _, label, edges in samples:
        for i, j, repeat in edges:
            (skip if repeat else chain)[label[i], label[j]] += 1
    def against_chance(counts: np.ndarray) -> np.ndarray:
        share = counts / counts.sum()
        return np.log(share / np.outer(share.sum(axis=1), share.sum(axis=0)))

    return Field(weights, against_chance(chain), against_chance(skip))


def _overlaps(span: Span, spans: list[Span]) -> bool:
    return any(s < span[1] and span[0] < e for s, e in spans)


def added_spans(text: str, field: Field, base: dict[str, list[Span]], sure: float = 0.9) -> dict[str, list[Span]]:
    """Tokens outside every base span whose label is an entity with probability `sure` at least; neighbours of one kind are joined."""
    out: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    nodes = graph(text)
    if not nodes.spans:
        return out
    p, taken = field.marginals(nodes), _labels_of(nodes, base) > 0
    last = None
    for node, span in enumerate(nodes.spans):
        label = int(p[node].argmax())
        if taken[node] or not label or p[node, label] < sure:
            last = None
            continue
        spans = out[KINDS[label - 1]]
        if last == label and nodes.follows[node]:
            spans[-1] = (spans[-1][0], span[1])
        else:
            spans.append(span)
        last = label
    return out


def _candidates(docs: DataFrame) -> DataFrame:
    """doc_id and the text where it can hold a span, else null: anything found needs a digit or an @."""
    return docs.select(F.col("doc_id").cast("long"), F.when(F.col("text").rlike("[0-9@]"), F.col("text")).alias("text"))


def fit(docs: DataFrame, *, sample_docs: int = 20_000, sample_tokens: int = 64) -> Field:
    """Learn from the pattern spans of a sample by hash of about `sample_docs` documents at most, up to
    `sample_tokens` tokens of each."""
    share = min(1.0, sample_docs / max(1, docs.count()))
    picked = _candidates(docs.where(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1_000_000)) < int(share * 1_000_000))).where("text is not null")

    def observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys, es = [], [], []
            for text in batch.column(1).to_pylist():
                nodes = graph(text)
                labels = _labels_of(nodes, base_spans(text))[:sample_tokens]
                xs.append(nodes.features[:sample_tokens].ravel())
                ys.append(labels)
                es.append([v for i, j, skip in nodes.edges if j < sample_tokens for v in (i, j, int(skip))])
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.list_(pa.int64())) for v in (xs, ys, es)], names=["x", "y", "e"])

    got = picked.mapInArrow(observed, "x array<long>, y array<long>, e array<long>").toArrow()
    samples = []
    for x, y, e in zip(got["x"].to_pylist(), got["y"].to_pylist(), got["e"].to_pylist()):
        if y:
            samples.append((np.asarray(x).reshape(len(y), -1), np.asarray(y), [(e[k], e[k + 1], bool(e[k + 2])) for k in range(0, len(e), 3)]))
    return train(samples)


def find(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, counts of base spans, base_sha256, spans (base and added) for every row of `docs`.

    Null text has no spans; repeated rows are answered each."""
    sent = docs.sparkSession.sparkContext.broadcast(field)
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
        for batch in batches:
            rows = []
            for text in batch.column(1):
                if not text.is_valid:
                    rows.append(nothing)
                    continue
                text = text.as_py()
                base = base_spans(text)
                added = added_spans(text, sent.value, base)
                rows.append((*(len(base[k]) for k in KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined({k: base[k] + added[k] for k in KINDS})))
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=[x.split()[0] for x in schema.split(", ")])

    return _candidates(docs).mapInArrow(found, schema)


def masked(text: str, field: Field) -> str:
    """The text with every span replaced by its kind's mask; overlapping spans take the mask of the first."""
    base = base_spans(text)
    added = added_spans(text, field, base)
    spans = sorted((start, -end, kind) for kind in KINDS for start, end in base[kind] + added[kind])
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], MASKS[kind]]
        at = max(at, -end)
    return "".join(parts) + text[at:]


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """`docs` with all its columns, personal data masked in `text` and n_chars, if there, made to agree."""
    sent = docs.sparkSession.sparkContext.broadcast(field)
    schema = docs.schema

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [masked(t, sent.value) if t and _NODE.search(t) else t for t in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(done, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
