"""Toxicity by cumulative-link ordinal regression on sparse text features.

Severity grades 0..3: rows labelled not toxic have grade 0; labelled toxic rows
have 1, 2 or 3 by how many markers they hold, where markers are the words, or
stems repeated inside words, whose share among toxic labelled rows far exceeds
that among the others.  P(grade <= j) = logistic(theta_j - w.x): one weight
vector for all thresholds, x the set of hashed words and the counts of hashed
character n-grams inside words.  The output is the expected grade.

The model is fitted on about ``max_rows`` labelled rows, chosen by hash within
each label and weighted by the label's share (the bound is a parameter); every
document is then scored whole.

Defined results: null, empty and wordless texts have no features and get the
intercepts' severity; repeated rows score alike; without labelled rows of both
kinds every severity is 0; empty tables give empty results.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tabula.llm.common import hash_sample

WORD = re.compile(r"\w+")
BITS = 18
#: Buckets: words first, then as many for the n-grams inside words.
BUCKETS = 2 << BITS
GRAM_SIZES = (4, 5)
GRADES = 4


class _Buckets(dict):
    """Word -> (its bucket, buckets of its n-grams), remembered for up to 200,000 words."""

    def __missing__(self, word: str) -> tuple[int, list[int]]:
        def bucket(s: str) -> int:
            return zlib.crc32(s.encode("utf-8", "replace")) & ((1 << BITS) - 1)

        value = bucket(word), [(1 << BITS) + bucket(word[i:i + n]) for n in GRAM_SIZES for i in range(len(word) - n + 1)]
        if len(self) >= 200_000:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


_BUCKETS = _Buckets()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's words and of the n-grams inside them, ascending, and how often each occurs."""
    counts: Counter = Counter()
    for word, n in Counter(WORD.findall(text.lower()) if text else []).items():
        own, grams = _BUCKETS[word]
        counts[own] += n
        for b in grams:
            counts[b] += n
    idx = np.fromiter(counts.keys(), np.int32, len(counts))
    cnt = np.fromiter(counts.values(), np.int32, len(counts))
    order = np.argsort(idx)
    return idx[order], cnt[order]


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"toxic": batch.column(1).to_pylist(), "idx": [], "cnt": []}
        for text in batch.column(0).to_pylist():
            idx, cnt = features(text)
            out["idx"].append(zlib.compress(np.diff(idx, prepend=0).astype("<i4").tobytes(), 1))
            out["cnt"].append(zlib.compress(cnt.astype("<i4").tobytes(), 1))
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
            [("toxic", pa.int32()), ("idx", pa.binary()), ("cnt", pa.binary())]))


@dataclass
class OrdinalModel:
    weights: np.ndarray      # one per bucket, shared by all thresholds
    thresholds: np.ndarray   # ascending, GRADES - 1 of them

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > j) for every score (rows) and threshold (columns)."""
        z = np.clip(self.thresholds[None, :] - np.asarray(score)[:, None], -40, 40)
        return 1.0 / (1.0 + np.exp(z))


def values(idx: np.ndarray, cnt: np.ndarray) -> np.ndarray:
    """What a row's features count in the sum: words by presence, n-grams by number."""
    return np.where(idx < 1 << BITS, 1, cnt)


def grade_rows(idx: list[np.ndarray], cnt: list[np.ndarray], toxic: np.ndarray, ratio: float = 20.0) -> np.ndarray:
    """Grades 0..3 of labelled rows from their label and their number of marker words or of the
    commonest marker stem (an n-gram that rows repeat, counted as held from 3 times on)."""
    df = np.zeros((2, BUCKETS))
    for i, c, t in zip(idx, cnt, toxic):
        df[t][i[(i < 1 << BITS) | (c >= 3)]] += 1
    n = np.bincount(toxic, minlength=2)
    share = (df[1] + 0.1) / (n[1] + 1), (df[0] + 0.5) / (n[0] + 1)
    markers = (share[0] / share[1] > ratio) & (df[1] >= 3)
    held = np.zeros(len(idx))
    for r, (i, c) in enumerate(zip(idx, cnt)):
        word = i < 1 << BITS
        held[r] = max(c[word & markers[i]].sum(), c[~word & markers[i]].max(initial=0))
    return np.where(toxic == 0, 0, 1 + (held >= 3) + (held >= 6))


class _Rows:
    """Rows of buckets and values, end to end; sums are taken over some rows at a time to spare the driver's memory."""

    def __init__(self, idx: list[np.ndarray], cnt: list[np.ndarray] | None, part: int = 1 << 19):
        self.sizes = np.array([len(i) for i in idx], np.int64)
        self.col = np.concatenate(idx).astype(np.int32, copy=False) if len(idx) else np.zeros(0, np.int32)
        self.value = np.ones(self.col.size, np.float32)
        at = np.concatenate([[0], np.cumsum(self.sizes)])
        if cnt is not None:
            for i, c, a, b in zip(idx, cnt, at, at[1:]):
                self.value[a:b] = values(i, c)
        self.parts: list[tuple[slice, slice]] = []
        first = 0
        for r in range(1, len(idx) + 1):
            if r == len(idx) or at[r + 1] - at[first] > part:
                self.parts.append((slice(first, r), slice(at[first], at[r])))
                first = r

    def by_row(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.sizes.size)
        for r, e in self.parts:
            n = r.stop - r.start
            out[r] = np.bincount(np.repeat(np.arange(n), self.sizes[r]), weights=weights[self.col[e]] * self.value[e], minlength=n)
        return out

    def by_bucket(self, of_row: np.ndarray, power: int = 1) -> np.ndarray:
        out = np.zeros(BUCKETS)
        for r, e in self.parts:
            out += np.bincount(self.col[e], weights=np.repeat(of_row[r], self.sizes[r]) * self.value[e] ** power, minlength=BUCKETS)
        return out


def trust(x: _Rows, grade: np.ndarray, weight: np.ndarray, half_z: float = 5.0) -> np.ndarray:
    """Share in 0..1 of each bucket's weight that counts, by how far its rows' grades are from all
    rows': half at ``half_z`` standard errors.  The penalty on a bucket's weight is the larger the
    smaller its share; no bucket is left out."""
    above = np.array(grade) > 0
    p = np.average(above, weights=weight)
    num = x.by_bucket((above - p) * weight)
    var = x.by_bucket(weight * weight * np.where(above, (1 - p) ** 2, p * p), 2)
    z2 = num * num / np.maximum(var, 1e-12)
    return z2 / (z2 + half_z * half_z)


def fit_ordinal(idx: list[np.ndarray], grade: np.ndarray, l2: float = 1e-3, steps: int = 300, rate: float = 0.1,
                cnt: list[np.ndarray] | None = None, weight: np.ndarray | None = None) -> OrdinalModel:
    """Full-batch Adam on the cumulative-link log likelihood of the rows (times ``weight``), L2 on the
    weights before they are scaled by their bucket's share of trust."""
    x = _Rows(idx, cnt)
    weight = np.ones(len(idx)) if weight is None else weight / weight.mean()
    scale = trust(x, grade, weight)
    n, d, k = len(idx), BUCKETS, GRADES - 1
    share = np.array([(np.sum(weight * (grade <= j)) + 0.5) / (n + 1.0) for j in range(k)])
    first = np.log(share / (1 - share))
    # theta_0 and the logs of the gaps: thresholds stay in order
    par = np.concatenate([np.zeros(d), first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    m, v = np.zeros_like(par), np.zeros_like(par)
    at = np.arange(n)
    for step in range(1, steps + 1):
        w, gaps = par[:d], np.exp(par[d + 1:])
        theta = par[d] + np.concatenate([[0.0], np.cumsum(gaps)])
        s = x.by_row(w * scale)
        cdf = np.concatenate([np.zeros((n, 1)), 1 / (1 + np.exp(-np.clip(theta[None, :] - s[:, None], -40, 40))),
                              np.ones((n, 1))], axis=1)
        pdf = cdf * (1 - cdf)
        p = np.maximum(cdf[at, grade + 1] - cdf[at, grade], 1e-12)
        up, low = weight * pdf[at, grade + 1] / p, weight * pdf[at, grade] / p
        by_score = (up - low) / n                       # d(-loglik)/ds
        by_theta = np.zeros(k)
        for j in range(k):
            by_theta[j] = -(up[grade == j].sum() - low[grade == j + 1].sum()) / n
        tail = np.cumsum(by_theta[::-1])[::-1]
        g = np.concatenate([x.by_bucket(by_score) * scale + l2 * w, [by_theta.sum()],
                            tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        par = par - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return OrdinalModel(par[:d] * scale, par[d] + np.concatenate([[0.0], np.cumsum(np.exp(par[d + 1:]))]))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 10_000) -> OrdinalModel | None:
    """Fit on about ``max_rows`` labelled rows, up to half of them toxic; None if a kind of label is missing."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return None
    most = {1: max(max_rows // 2, max_rows - n[0]), 0: max(max_rows - max_rows // 2, max_rows - n[1])}
    part = [hash_sample(known.filter(F.col("toxic") == t), most[t]) for t in (0, 1)]
    got = docs.select("doc_id", "text").join(F.broadcast(part[0].unionAll(part[1])), "doc_id").select("text", "toxic").mapInArrow(
        _featurise, "toxic int, idx binary, cnt binary").collect()
    toxic = np.array([r["toxic"] for r in got], np.int64)
    if len(set(toxic.tolist())) < 2:
        return None
    idx = [np.cumsum(np.frombuffer(zlib.decompress(r["idx"]), "<i4"), dtype=np.int32) for r in got]
    cnt = [np.minimum(np.frombuffer(zlib.decompress(r["cnt"]), "<i4"), 60_000).astype(np.uint16) for r in got]
    del got
    # a label sampled more thinly than the other stands for more rows
    weight = np.array([max(n[t] / part[t].count(), 1.0) for t in (0, 1)])[toxic]
    return fit_ordinal(idx, grade_rows(idx, cnt, toxic), cnt=cnt, weight=weight)


def predict(docs: DataFrame, model: OrdinalModel | None) -> DataFrame:
    """doc_id, expected_severity, grade (most likely), p_toxic and toxic (p_toxic >= 0.5)."""
    if model is None:
        model = OrdinalModel(np.zeros(BUCKETS), np.full(GRADES - 1, 40.0))
    weights, thresholds = model.weights.astype(np.float32), model.thresholds

    @pandas_udf("struct<severity:double,grade:int,p_toxic:double>")
    def severity(texts: pd.Series) -> pd.DataFrame:
        known: dict[str, tuple[int, float]] = {}       # word -> its bucket, sum of its n-grams' weights
        score = np.zeros(len(texts))
        for i, text in enumerate(texts):
            present, total = set(), 0.0
            for word, n in sorted(Counter(WORD.findall(text.lower())).items()) if text else ():
                if word not in known:
                    own, grams = _BUCKETS[word]
                    known[word] = own, float(weights[grams].sum(dtype=np.float64))
                own, inside = known[word]
                present.add(own)
                total += n * inside
            score[i] = total + sum(weights[b] for b in sorted(present))
        above = OrdinalModel(weights, thresholds).above(score)
        each = np.concatenate([np.ones((len(score), 1)), above], axis=1) - np.concatenate(
            [above, np.zeros((len(score), 1))], axis=1)
        return pd.DataFrame({"severity": above.sum(axis=1), "grade": each.argmax(axis=1).astype(np.int32),
                             "p_toxic": above[:, 0]})

    out = docs.select("doc_id", severity(F.col("text")).alias("s"))
    return out.select("doc_id", F.col("s.severity").alias("expected_severity"), F.col("s.grade").alias("grade"),
                      F.col("s.p_toxic").alias("p_toxic"), (F.col("s.p_toxic") >= 0.5).alias("toxic"))


def op2(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return predict(docs, fit(docs, labels))
