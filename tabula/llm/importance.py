"""Quality classifier by importance resampling over hashed n-grams.

Two multinomial models over hashed n-grams are counted: one over the target
text (rows labelled good), one over the raw text (all documents).  A document's
log importance weight is the mean log ratio of the two models over its n-grams
times ``effective_length`` (as if every document were a text of that many
n-grams, so long documents are not favoured).  Gumbel noise is added and the k largest keys are selected: a sample without replacement in
proportion to the weights.

Every row has its own noise, a hash of its number, id and text; the number is written once
with the keys.  Exactly k rows are selected: of those that tie with the k-th key, the ones of smallest number.

Defined results: null and empty texts have no n-grams and weight 0; repeated rows are
chosen independently; without any target row all weights are 0, and without a k everything is selected; an empty table
gives an empty result.  Other columns pass through untouched.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tabula.llm.common import free_name, hash_sample, kth_largest, maybe_broadcast, written

BITS = 14
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
#: Keys are fixed-point numbers with this many fraction bits.
FRACTION = 32


class _Tokens(dict):
    """Token -> 32-bit hash and 8-bit shape, remembered for up to 300,000 tokens."""

    def __missing__(self, token: str) -> int:
        if token.islower():
            shape = 1
        elif token.isupper() and len(token) > 1:
            shape = 3
        elif token[0].isupper():
            shape = 2
        elif token[0].isdigit():
            shape = 4
        elif token[0].isalpha():
            shape = 5
        else:
            shape = 16 + zlib.crc32(token.encode("utf-8", "replace")) % 240
        value = zlib.crc32(token.encode("utf-8", "replace")) << 8 | shape
        if len(self) >= 300_000:
            self.clear()
        self[token] = value
        return value


_TOKENS = _Tokens()


def grams(text: str | None, bits: int = BITS) -> np.ndarray:
    """Buckets of a text's n-grams: words, word pairs, and pairs of word shapes.

    A shape pair also says whether both words are equal, which a pair of hashed
    rare words cannot show.
    """
    found = TOKEN.findall(text) if text else []
    v = np.fromiter(map(_TOKENS.__getitem__, found), np.uint64, len(found))
    word, shape = v >> np.uint64(8), v & np.uint64(255)
    same = (v[1:] == v[:-1]).astype(np.uint64)
    parts = (
        word * np.uint64(3),
        word[:-1] * np.uint64(0x9E3779B1) + word[1:] * np.uint64(5) + np.uint64(1),
        (shape[:-1] << np.uint64(9)) + (shape[1:] << np.uint64(1)) + same + np.uint64(1 << 50),
    )
    mixed = np.concatenate(parts)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _counter(bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            for text, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = grams(text, bits)
                for row in (0, 1) if target else (0,):
                    np.add.at(total[row], found, 1) if found.size < 256 else np.add(
                        total[row], np.bincount(found, minlength=1 << bits), out=total[row])
        there = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_pydict({"bucket": there, "raw": total[0][there], "target": total[1][there]})
    return count


def fit_log_ratio(docs: DataFrame, target_flag: str, text_col: str = "text", bits: int = BITS,
                  smoothing: float = 1.0) -> np.ndarray:
    """Log ratio of the target to the raw model for each of the ``2**bits`` buckets.

    Counts cover every document; a task sends at most ``2**bits`` rows to the
    shuffle and the driver gets that many in all.
    """
    counted = docs.select(F.col(text_col), F.col(target_flag)).mapInArrow(
        _counter(bits), "bucket long, raw long, target long")
    got = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.full(1 << bits, smoothing), np.full(1 << bits, smoothing)
    for r in got:
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    if target.sum() <= smoothing * (1 << bits):
        return np.zeros(1 << bits)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def score(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          effective_length: float = 100.0, bits: int = BITS, seed: int = 11,
          max_targets: int = 200_000, carry: list[str] | None = None) -> tuple[DataFrame, str, str, str, str]:
    """All columns and rows of ``docs`` with target flag, log weight, Gumbel key and row number.

    ``target_ids`` (one column ``id_col``) names the target rows; the target model
    and the calibration use about ``max_targets`` of them.  ``carry`` names the
    columns to keep (all).  Returns the written table and the names of the four
    added columns.
    """
    ids = target_ids.select(F.col(id_col).alias("target_id")).dropna().distinct()
    ids = written(hash_sample(ids, max_targets), "targets")
    n_ids = ids.count()
    flag, weight, key = (free_name(docs.columns, c) for c in ("is_target", "log_weight", "gumbel_key"))
    tid = free_name([*docs.columns, flag], "target_id")
    ids = ids.withColumnRenamed("target_id", tid)
    flagged = docs.join(maybe_broadcast(ids, n_ids, 40), docs[id_col] == ids[tid], "left")
    flagged = flagged.withColumn(flag, F.col(tid).isNotNull()).drop(tid)
    ratio = fit_log_ratio(flagged, flag, text_col, bits)
    number = free_name([*docs.columns, flag, weight, key], "row_number")
    flagged = flagged.withColumn(number, F.monotonically_increasing_id())

    @pandas_udf("double")
    def log_weight(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            found = grams(text, bits)
            if found.size:
                out[i] = ratio[found].mean() * effective_length
        return pd.Series(out)

    row = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col), F.col(number))
    uniform = (F.shiftrightunsigned(row, 11).cast("double") + 0.5) / float(1 << 53)
    scored = flagged.withColumn(weight, log_weight(F.col(text_col)))
    gumbel = F.col(weight) - F.log(-F.log(uniform))
    scored = scored.withColumn(key, F.round(gumbel * float(1 << FRACTION)).cast("long"))
    kept = scored.select(*(docs.columns if carry is None else carry), flag, weight, key, number)
    return written(kept, "importance"), flag, weight, key, number


def resample(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             k: int | None = None, miss: float = 0.002, **options) -> tuple[DataFrame, str, str, str]:
    """``docs`` with log weight, key and a boolean: is the row one of the ``k`` of largest keys?

    Without ``k`` it is the number of documents whose plain log weight is not below
    the ``miss`` quantile of the target rows' log weights.
    """
    scored, flag, weight, key, number = score(docs, target_ids, id_col, text_col, **options)
    if k is None:
        plain = F.round(F.col(weight) * float(1 << FRACTION)).cast("long").alias("plain")
        goods = scored.filter(F.col(flag)).select(plain)
        n_good = goods.count()
        cut = kth_largest(goods, "plain", n_good - int(miss * n_good))
        k = scored.count() if cut is None else scored.select(plain).filter(F.col("plain") >= cut).count()
    last = kth_largest(scored, key, k)
    chosen = free_name(scored.columns, "selected")
    if last is None:                                   # k below one, or beyond the rows
        taken = F.lit(k > 0)
    else:
        above = scored.filter(F.col(key) > F.lit(last)).count()
        ties = scored.filter(F.col(key) == F.lit(last)).select((-F.col(number)).alias("n"))
        taken = (F.col(key) > F.lit(last)) | ((F.col(key) == F.lit(last)) & (-F.col(number) >= F.lit(kth_largest(ties, "n", k - above))))
    return scored.withColumn(chosen, taken).drop(flag, number), weight, key, chosen


def op1(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, log_weight, gumbel_key, selected of every document; target: quality = 1."""
    good = labels.filter(F.col("quality") == 1).select("doc_id")
    out, weight, key, chosen = resample(docs.select("doc_id", "text"), good, carry=["doc_id"])
    return out.select("doc_id", F.col(weight).alias("log_weight"),
                      (F.col(key) / float(1 << FRACTION)).alias("gumbel_key"), F.col(chosen).alias("selected"))


def keep_selected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the resampling selects, with their columns."""
    good = labels.filter(F.col("quality") == 1).select("doc_id")
    out, _, _, chosen = resample(docs, good)
    return out.filter(F.col(chosen)).select(*docs.columns)
