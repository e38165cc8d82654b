"""Personal data by fixed patterns and a skip-chain conditional random field.

The fixed patterns give base spans.  The field adds what they miss: its
nodes are the tokens of a document that hold a digit or an ``@`` (neighbouring groups of
digits are one token), its labels
the kinds and "none".  Node potentials are a softmax regression over the
token's shape and context; neighbours share chain potentials; repeated or
similar tokens (same letters, or the same last seven digits in another notation), however far
apart, share skip potentials.  Base spans clamp their tokens.  Loopy
sum-product message passing, run on all documents of a batch as one graph of
separate parts, then carries labels to the other occurrences, so an entity is
labelled consistently across its document.

A token is added if its belief in a kind is at least ``least_belief``, where no like token is a base span of that
kind ``alone_belief``, and if it can be of that kind (digits, checksum).

Occurrences of a token are linked to the next one only, so the graph grows
with the text.  Training uses the base spans as labels, and each phone number and card again in notations that the
patterns don't match, on about ``max_rows`` distinct documents chosen by hash (a parameter): tasks turn them into feature
rows, the driver gets the distinct ones with their counts.  Every document is scanned whole, however long.

Defined results: null is an empty text; empty texts have no spans; repeated
rows give equal rows; empty tables give empty results; without any base span
in the training rows nothing is added.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabula.llm.common import hash_sample, outside, replace_spans

KINDS = ("email", "ip", "card", "phone")
#: The patterns.  Possessive repeats and look-behinds leave the matches as they
#: are (they only spare attempts that must fail).
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
NODE_CHARS = LOCAL_CHARS | frozenset("@()")
NODE_RUN = re.compile(r"[A-Za-z0-9+@._%()-]+")
GROUP = re.compile(r"\+?\(?[0-9](?:[0-9 ()-]|\.(?=[0-9]{3}))*")
SUFFIX = 7                       # digits that notations of one number share
FEATURES = 1 << 12
LABELS = 1 + len(KINDS)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) << (i & 1)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """For each @: the longest local part before it (not into the last match), the longest domain after it."""
    spans, last = [], 0
    at = text.find("@")
    while at >= 0:
        if at >= last:
            start = at
            while start > last and text[start - 1] in LOCAL_CHARS:
                start -= 1
            m = DOMAIN.match(text, at + 1) if start < at else None
            if m:
                spans.append(("email", start, m.end()))
            last = m.end() if m else at + 1
        at = text.find("@", at + 1)
    return spans


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and kind."""
    spans = _emails(text)
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            spans.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def nodes_of(text: str) -> list[tuple[int, int]]:
    """Tokens with a digit or an @, without punctuation at their ends; groups of digits with a blank
    between them are one token of up to 15 digits."""
    out, last = [], 0
    for m in re.finditer("[0-9@]", text):
        if m.start() < last:
            continue
        start = m.start()
        while start > last and text[start - 1] in NODE_CHARS:
            start -= 1
        end = last = NODE_RUN.match(text, m.start()).end()
        while end > m.start() + 1 and text[end - 1] in ".-_%(":
            end -= 1
        while start < m.start() and text[start] in ".-_%)":
            start += 1
        if out and text[out[-1][1]:start] == " " and GROUP.fullmatch(text, start, end) and GROUP.fullmatch(text, *out[-1]) \
                and digits_of(text[out[-1][0]:end]) <= 15:
            out[-1] = out[-1][0], end
        else:
            out.append((start, end))
    return out


def digits_of(token: str) -> int:
    return sum(c in "0123456789" for c in token)


def _shape(token: str) -> str:
    shape = re.sub("[A-Za-z]+", "a", token)
    return re.sub("[0-9]+", lambda m: f"9{min(len(m[0]), 20)}", shape)


def features(text: str, start: int, end: int) -> list[int]:
    token = text[start:end]
    shape = _shape(token)
    digits = sum(c.isdigit() for c in token)
    before = re.findall(r"\w+", text[max(0, start - 24):start])
    after = re.findall(r"\w+", text[end:end + 24])
    names = (f"s{shape}", f"f{shape[:4]}", f"d{min(digits, 24)}", f"@{'@' in token}", f".{min(token.count('.'), 4)}",
             f"b{before[-1].lower() if before else ''}", f"a{_shape(after[0]) if after else ''}", f"p{text[max(0, start - 1):start]}", "1")
    return [zlib.crc32(n.encode("utf-8", "replace")) % FEATURES for n in names]


def likeness(token: str) -> str | None:
    """What repeated or similar tokens have in common; None for tokens too short to tell."""
    digits = "".join(c for c in token if c in "0123456789")
    if "@" not in token and len(digits) >= 6 and not re.search("[A-Za-z]", token):
        # notations of one number differ in what stands between and before; addresses in dots don't
        return token if IP.fullmatch(token) else digits[-SUFFIX:]
    return token.lower() if len(token) >= 5 else None


@dataclass
class Graph:
    """Nodes of several documents: labels fixed by base spans (-1: free), features, edges."""

    doc: list[int]
    span: list[tuple[int, int]]
    fixed: list[int]
    feats: list[list[int]]
    like: list[str | None]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def build_graph(texts: list[str | None], bases: list[list[Span]]) -> Graph:
    g = Graph([], [], [], [], [], [], [])
    for d, (text, base) in enumerate(zip(texts, bases)):
        if not text:
            continue
        found, b, last_like = nodes_of(text), 0, {}
        for start, end in found:
            i = len(g.doc)
            while b < len(base) and base[b][2] <= start:
                b += 1
            label = next((1 + KINDS.index(k) for k, s, e in base[b:b + 8] if s < end and start < e), -1)
            key = likeness(text[start:end])
            g.doc.append(d)
            g.span.append((start, end))
            g.fixed.append(label)
            g.feats.append(features(text, start, end))
            g.like.append(key)
            if i and g.doc[i - 1] == d and start - g.span[i - 1][1] <= 2 and not text[g.span[i - 1][1]:start].strip(" -"):
                g.chain.append((i - 1, i))
            if key is not None:
                if key in last_like:
                    g.skip.append((last_like[key], i))
                last_like[key] = i
    return g


@dataclass
class Field:
    unary: np.ndarray      # FEATURES x LABELS
    chain: np.ndarray      # LABELS x LABELS, log potentials
    skip: np.ndarray

    def beliefs(self, g: Graph, rounds: int = 20, damping: float = 0.3) -> np.ndarray:
        """Label probabilities of all nodes by loopy sum-product in the log domain."""
        n = len(g.doc)
        local = self.unary[np.array(g.feats, np.int64).reshape(n, -1)].sum(axis=1)
        fixed = np.array(g.fixed)
        at = np.flatnonzero(fixed >= 0)
        local[at] = -50.0
        local[at, fixed[at]] = 0.0
        local -= _logsum(local)
        edges = np.array(g.chain + g.skip, np.int64).reshape(-1, 2)
        if len(edges):
            pot = np.concatenate([np.repeat(self.chain[None], len(g.chain), 0), np.repeat(self.skip[None], len(g.skip), 0)])
            src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
            pot = np.concatenate([pot, pot.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
            message = np.zeros((len(src), LABELS))
            for _ in range(rounds):
                into = local.copy()
                np.add.at(into, dst, message)
                cavity = into[src] - message[back]
                new = np.logaddexp.reduce(cavity[:, :, None] + pot, axis=1)
                new = (1 - damping) * (new - _logsum(new)) + damping * message
                change = np.abs(new - message).max()
                message = new
                if change < 1e-3:
                    break
            local = local.copy()
            np.add.at(local, dst, message)
        return np.exp(local - _logsum(local))


def _logsum(x: np.ndarray) -> np.ndarray:
    return np.logaddexp.reduce(x, axis=-1, keepdims=True)


def _pair_potentials(seen: np.ndarray) -> np.ndarray:
    """Log ratio of seen to expected label pairs, symmetric, smoothed and bounded."""
    seen = seen + seen.T + 0.5
    rows = seen.sum(axis=1, keepdims=True)
    return np.clip(np.log(seen * seen.sum() / (rows * rows.T)), -4, 4)


def variants(kind: str, token: str) -> list[str]:
    """Notations of a phone number or card that the fixed patterns don't match."""
    groups = re.findall("[0-9]+", token)
    digits = "".join(groups)
    if kind == "phone":
        if len(groups) > 1 and len(groups[0]) <= 3:
            digits = digits[len(groups[0]):]
        else:
            digits = digits[-10:]
        if len(digits) < 7:
            return []
        a, b, c = digits[:-7], digits[-7:-4], digits[-4:]
        if not a:
            return [f"{b}-{c}"]
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"1-{a}-{b}-{c}", f"0{a} {b}{c}"]
    if kind == "card":
        parts = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return [".".join(parts), "_".join(parts)]
    return []


def examples(texts: list[str | None]) -> tuple[list[list[int]], list[int], np.ndarray]:
    """Feature rows and labels of the nodes of training texts, two variants of every number among them, and the
    label pairs counted on chain and skip edges."""
    bases = [base_spans(t) if t else [] for t in texts]
    g = build_graph(texts, bases)
    x, y, pairs = list(g.feats), [max(f, 0) for f in g.fixed], np.zeros((2, LABELS, LABELS))
    for i, (d, (start, end), label) in enumerate(zip(g.doc, g.span, g.fixed)):
        if label > 0:
            text = texts[d]
            forms = variants(KINDS[label - 1], text[start:end])
            at = zlib.crc32(text[start:end].encode("utf-8", "replace"))
            for form in {forms[(at + j) % len(forms)] for j in (0, 1)} if forms else ():
                near = text[max(0, start - 30):start]
                x.append(features(near + form + text[end:end + 30], len(near), len(near) + len(form)))
                y.append(label)
    for k, edges in enumerate((g.chain, g.skip)):
        for a, b in edges:
            pairs[k, max(g.fixed[a], 0), max(g.fixed[b], 0)] += 1
    return x, y, pairs


def fit_rows(x: np.ndarray, y: np.ndarray, times: np.ndarray, pairs: np.ndarray, steps: int = 150, rate: float = 0.1, l2: float = 1e-4) -> Field | None:
    """Node potentials by softmax regression on rows that occur ``times``, pair potentials by counts."""
    if not y.any():
        return None
    w, m, v = (np.zeros((FEATURES, LABELS)) for _ in range(3))
    onehot, share = np.eye(LABELS)[y], (times / times.sum())[:, None]
    for step in range(1, steps + 1):
        s = w[x].sum(axis=1)
        r = (np.exp(s - _logsum(s)) - onehot) * share
        grad = l2 * w
        for f in range(x.shape[1]):
            for c in range(LABELS):
                grad[:, c] += np.bincount(x[:, f], weights=r[:, c], minlength=FEATURES)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Field(w, _pair_potentials(pairs[0]), _pair_potentials(pairs[1]))


def train(texts: list[str]) -> Field | None:
    """A field from texts in memory; their base spans are the labels."""
    x, y, pairs = examples(texts)
    return fit_rows(np.array(x, np.int64).reshape(len(y), -1), np.array(y, np.int64), np.ones(len(y)), pairs)


def possible(kind: str, token: str, alone: bool) -> bool:
    """Whether a token can be of a kind at all; ``alone``: without a like base span, short numbers can't."""
    digits = "".join(c for c in token if c in "0123456789")
    if kind == "email":
        return bool(re.fullmatch(r"[^@]+@[^@]+", token))
    if re.search("[A-Za-z@]", token):
        return False
    if kind == "ip":
        parts = re.findall("[0-9]+", token)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return (9 if alone else 7) <= len(digits) <= 15


def find(texts: list[str | None], model: Field | None, least_belief: float = 0.6, alone_belief: float = 0.95) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans, and all spans, by start and kind."""
    bases = [base_spans(t) if t else [] for t in texts]
    added: list[list[Span]] = [[] for _ in texts]
    if model is not None:
        g = build_graph(texts, bases)
        if any(f < 0 for f in g.fixed):
            belief = model.beliefs(g)
            kind = belief.argmax(axis=1)
            known = {(d, k, f) for d, k, f in zip(g.doc, g.like, g.fixed) if f > 0 and k is not None}
            for i in np.flatnonzero((np.array(g.fixed) < 0) & (kind > 0) & (belief.max(axis=1) >= min(least_belief, alone_belief))).tolist():
                d, name, (start, end) = g.doc[i], KINDS[kind[i] - 1], g.span[i]
                alone = (d, g.like[i], int(kind[i])) not in known
                if belief[i, kind[i]] >= (alone_belief if alone else least_belief) and possible(name, texts[d][start:end], alone):
                    added[d].append((name, start, end))
    order = {k: i for i, k in enumerate(KINDS)}
    return [(b, sorted(b + outside(a, b), key=lambda s: (s[1], order[s[0]]))) for a, b in zip(added, bases)]


def _example_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes as (features, label, -1), label pairs of edges as ([kind of edge, label], label, count)."""
    schema = pa.schema([("x", pa.list_(pa.int32())), ("y", pa.int32()), ("pairs", pa.int64())])
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            x, y, pairs = examples(batch.column(0).slice(at, 200).to_pylist())
            edges = np.argwhere(pairs > 0).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(x + [e[:2] for e in edges], pa.list_(pa.int32())), pa.array(y + [e[2] for e in edges], pa.int32()),
                 pa.array([-1] * len(x) + [int(pairs[tuple(e)]) for e in edges], pa.int64())], schema=schema)


def fit(docs: DataFrame, max_rows: int = 4000) -> Field | None:
    """Train on about ``max_rows`` of the distinct texts with a digit or an @."""
    texts = docs.select("text").filter(F.col("text").rlike("[0-9@]"))
    rows = hash_sample(texts, max_rows).mapInArrow(_example_rows, "x array<int>, y int, pairs long")
    rows = rows.groupBy("x", "y", (F.col("pairs") >= 0).alias("edge")).agg(F.sum(F.abs("pairs")).alias("times")).collect()
    nodes, edges = [r for r in rows if not r["edge"]], [r for r in rows if r["edge"]]
    if not nodes:
        return None
    pairs = np.zeros((2, LABELS, LABELS))
    for r in edges:
        pairs[r["x"][0], r["x"][1], r["y"]] += r["times"]
    order = sorted(nodes, key=lambda r: (r["x"], r["y"]))            # sums in the same order on every run
    return fit_rows(np.array([r["x"] for r in order], np.int64), np.array([r["y"] for r in order], np.int64),
                    np.array([r["times"] for r in order], float), pairs)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, model: Field | None) -> DataFrame:
    """doc_id, counts of base spans by kind, base and all spans as strings."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find(batch.column(1).to_pylist(), model)
            n = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *n, pa.array([joined(b) for b, _ in found], pa.string()), pa.array([joined(e) for _, e in found], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base string, spans string")


def redact(docs: DataFrame, mark: str = "[PII]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``."""
    model = fit(docs)

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        rows = texts.to_pylist()
        return pa.array([replace_spans(t, spans, mark) for t, (_, spans) in zip(rows, find(rows, model))], pa.string())

    return docs.withColumn("text", cleaned(F.col("text")))


def op7(docs: DataFrame) -> DataFrame:
    out = scan(docs, fit(docs))
    return out.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")
