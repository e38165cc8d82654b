"""Principal components (M5) and uncentred SVD scores (M6).

M5 centres and scales: one pass for the means, one for the sums of products
about them (tiles summed in a tree; p x p to the driver), the eigenvectors of
the correlations, and a row-local product of the rows' matrix with the basis.

M6 (``prcomp(x, center=FALSE, scale=FALSE)``) uses the same distributed
Gram pass as soft-impute (tiles of xᵀx summed in a tree), an eigen-decomposition of the p x p matrix on the driver, and
a row-local projection.  For wide rows and few components there is a truncated
form that needs a few p x (k + 10) matrices only (block Krylov iteration).

Component signs are arbitrary in any SVD; both operators normalise each
component so that its largest-magnitude loading is positive, which makes
scores reproducible across runs and engines.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabula.operators.impute import gram_and_change, gram_tiles
from tabula.operators.partials import array_matrix, column_matrix, reduced, tiles


def _sign_fix(v: np.ndarray) -> np.ndarray:
    idx = np.argmax(np.abs(v), axis=0)
    signs = np.sign(v[idx, np.arange(v.shape[1])])
    signs[signs == 0] = 1
    return v * signs


def _project(df: DataFrame, vec, basis: np.ndarray, prefix: str, keep: Sequence[str]) -> DataFrame:
    """Scores = x · basis as named columns in one projection (basis is p x k, small).

    Each score is ``aggregate(zip_with(x, literal basis column))``: a flat
    expression whatever p is (a nested sum of p terms would overflow the
    analyzer for wide tables).  A basis column is one array literal, not p
    literals, so building and analysing the plan does not grow with p times k expressions.
    """
    p, k = basis.shape
    scores = []
    for j in range(k):
        b = F.lit(np.ascontiguousarray(basis[:, j], float))
        prod = F.zip_with(vec, b, lambda x, w: x * w)
        scores.append(F.aggregate(prod, F.lit(0.0), lambda acc, y: acc + y).alias(f"{prefix}{j + 1}"))
    return df.select(*keep, *scores)


def pca_scores(df: DataFrame, cols: Sequence[str], k: int, keep: Sequence[str] = (), prefix: str = "PC") -> DataFrame:
    """Centred and scaled PCA scores (``prcomp(scale=TRUE, center=TRUE)$x[, 1:k]``)."""
    cols, keep = list(cols), list(keep)
    x = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    mean, spread, n = _location(x, cols)
    if n < 2:
        raise ValueError(f"pca_scores: {n:.0f} rows have no covariance")
    scale = np.where(spread, _centred_gram(x, cols, mean), 0.0)
    sd = np.sqrt(np.diag(scale) / (n - 1))
    unit = np.divide(1.0, sd, out=np.zeros_like(sd), where=sd > 0)
    value, vector = np.linalg.eigh(scale / (n - 1) * unit[:, None] * unit)
    basis = _sign_fix(vector[:, np.argsort(value)[::-1][:k]]) * unit[:, None]

    schema = T.StructType([*[x.schema[c] for c in keep], *[T.StructField(f"{prefix}{j + 1}", T.DoubleType()) for j in range(basis.shape[1])]])
    out = to_arrow_schema(schema)

    def scores(batches):
        for batch in batches:
            if batch.num_rows:
                z = (column_matrix(batch.select(cols))[0] - mean) @ basis
                yield pa.RecordBatch.from_arrays([*[batch.column(c).cast(out.field(c).type) for c in keep], *[pa.array(s) for s in z.T]], schema=out)
    return x.mapInArrow(scores, schema)


def _location(x: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray, float]:
    """(mean, whether there are two values, rows) of columns without null or NaN."""
    def kernel(batches):
        state = np.array([np.zeros(len(cols)), np.zeros(len(cols)), np.full(len(cols), np.inf), np.full(len(cols), -np.inf)])
        for batch in batches:
            if batch.num_rows:
                v, there = column_matrix(batch)
                if not there.all() or np.isnan(v).any():
                    raise ValueError("pca_scores: a null or NaN among the columns")
                state = merge(state, np.array([v.sum(0), there.sum(0), v.min(0), v.max(0)]))
        yield 0, state

    def merge(a, b):
        a, b = a.reshape(4, -1), b.reshape(4, -1)
        return np.array([a[0] + b[0], a[1] + b[1], np.minimum(a[2], b[2]), np.maximum(a[3], b[3])])

    def flat(a, b):
        return merge(a, b).ravel()
    found = reduced(x.select(*cols), kernel, flat).collect()
    if not found:
        return np.zeros(len(cols)), np.zeros(len(cols), bool), 0.0
    total, n, low, high = np.frombuffer(found[0]["state"], float).reshape(4, -1)
    return total / np.maximum(n, 1), low < high, float(n[0])


def _centred_gram(x: DataFrame, cols: Sequence[str], mean: np.ndarray) -> np.ndarray:
    """p x p sums of products about the mean, on the driver (bounded by the column count)."""
    p = len(cols)

    def kernel(batches):
        sums = {}
        for batch in batches:
            if batch.num_rows:
                v = column_matrix(batch)[0] - mean
                for tile, i, j in tiles(p):
                    got = v[:, i].T @ v[:, j]
                    sums[tile] = sums[tile] + got if tile in sums else got
        yield from sums.items()
    spans, out = {tile: (i, j) for tile, i, j in tiles(p)}, np.zeros((p, p))
    for r in reduced(x.select(*cols), kernel).collect():
        i, j = spans[r["tile"]]
        out[i, j] = np.frombuffer(r["state"], float).reshape(i.stop - i.start, j.stop - j.start)
        out[j, i] = out[i, j].T
    return out


def svd_scores(df: DataFrame, cols: Sequence[str], k: int, keep: Sequence[str] = (), prefix: str = "PC") -> DataFrame:
    """Uncentred, unscaled SVD scores x · V_k (``prcomp(center=FALSE, scale=FALSE)``)."""
    cols = list(cols)
    arr = df.select(*keep, F.array(*[F.col(c).cast("double") for c in cols]).alias("__x"))
    return svd_scores_array(arr, "__x", len(cols), k, keep, prefix)


def svd_scores_array(df: DataFrame, vec: str, p: int, k: int, keep: Sequence[str] = (),
                     prefix: str = "PC") -> DataFrame:
    g, _ = gram_and_change(df, vec, p)
    evals, evecs = np.linalg.eigh(g)
    order = np.argsort(evals)[::-1][:k]
    basis = _sign_fix(evecs[:, order])
    return _project(df, F.col(vec), basis, prefix, keep)


def gram_long(df: DataFrame, vec: str, p: int) -> DataFrame:
    """Σ x xᵀ as a long (i, j, value) DataFrame, 1-based indices, made from the tiles in the tasks."""
    spans = {tile: (i, j) for tile, i, j in tiles(p)}

    def rows(batches):
        for pdf in batches:
            for tile, state in zip(pdf["tile"], pdf["state"]):
                if tile < 0:
                    continue
                i, j = spans[tile]
                g = np.frombuffer(state, float).reshape(i.stop - i.start, j.stop - j.start)
                a, b = np.indices(g.shape)
                a, b = (a + i.start + 1).ravel(), (b + j.start + 1).ravel()
                mirror = slice(None) if i != j else slice(0)       # tiles below the diagonal are not kept
                yield pd.DataFrame({"i": np.concatenate([a, b[mirror]]), "j": np.concatenate([b, a[mirror]]),
                                    "value": np.concatenate([g.ravel(), g.ravel()[mirror]])})
    return gram_tiles(df, vec, p).mapInPandas(rows, "i int, j int, value double")


#: Blocks of directions that ``leading_directions`` holds at most.
_BLOCKS = 6


def leading_directions(df: DataFrame, vec: str, p: int, k: int, extra: int = 10, max_iter: int = 100,
                       tol: float = 1e-6, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, p x k right singular vectors) of the rows, without a p x p matrix anywhere.

    Block Krylov iteration with ``extra`` directions beside the k wanted ones: a round is one pass over
    the rows that sums x (x'V), a p x (k + extra) matrix (``partials``); V is what X'X added to the best
    directions so far.  They are the best ones of all V's span, so close singular values take few rounds;
    after ``_BLOCKS`` of them only the 2 (k + extra) best are kept, and p directions are the whole space.
    Settled when every wanted direction v satisfies X'X v = s^2 v up to ``tol`` of the largest s^2; raises
    after ``max_iter`` rounds.  With fewer than k directions in the data the rest is an arbitrary orthonormal
    completion with value 0.
    """
    width = min(p, k + extra)
    v = np.linalg.qr(np.random.default_rng(seed).normal(size=(p, width)))[0]
    axes = images = np.zeros((p, 0))

    def kernel(v):
        def run(batches):
            total = np.zeros(v.shape)
            for batch in batches:
                if batch.num_rows:
                    x = array_matrix(batch.column(0), p)
                    total += x.T @ (x @ v)
            yield 0, total
        return run

    for _ in range(max_iter):
        found = reduced(df.select(vec), kernel(v)).collect()
        y = np.frombuffer(found[0]["state"], float).reshape(v.shape) if found else np.zeros(v.shape)
        axes, images = np.hstack([axes, v]), np.hstack([images, y])
        # the rows' squares within the span, and its axes in order of their size
        small = axes.T @ images
        value, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(value)[::-1]
        value, axes, images = np.clip(value[order], 0, None), axes @ turn[:, order], images @ turn[:, order]
        rest = (images - axes * value)[:, :width]
        if np.linalg.norm(rest[:, :k], axis=0).max(initial=0) <= tol * value[0]:
            return np.sqrt(value[:k]), axes[:, :k]
        if axes.shape[1] >= _BLOCKS * width:
            axes, images = axes[:, :2 * width], images[:, :2 * width]
        for _ in range(2):                          # twice: the first leaves rounding
            rest = rest - axes @ (axes.T @ rest)
        side, size, _ = np.linalg.svd(rest, full_matrices=False)
        v = side[:, size > 1e-12 * value[0]][:, :p - axes.shape[1]]
        v = np.linalg.qr(v - axes @ (axes.T @ v))[0]
    raise RuntimeError(f"leading_directions: not settled to {tol} after {max_iter} rounds")


def svd_scores_truncated(df: DataFrame, vec: str, p: int, k: int, keep: Sequence[str] = (), prefix: str = "PC",
                         **settings) -> DataFrame:
    """The first ``k`` uncentred SVD scores of wide rows (e.g. one-hot indicators); null elements are not allowed."""
    _, basis = leading_directions(df, vec, p, k, **settings)
    return _project(df, F.col(vec), _sign_fix(basis), prefix, keep)


__all__ = ["pca_scores", "svd_scores", "svd_scores_array", "gram_long", "leading_directions", "svd_scores_truncated", "array_to_vector"]
