"""Imputation (M3, M7).

``mean_impute`` — ``na.aggregate``: one aggregation computes every column
mean (one row, p values, to the driver), then one projection fills nulls;
columns that are entirely null are filled with ``fill`` (the reference's
follow-up ``[is.na] <- 0``).

``soft_impute`` — low-rank matrix completion by iterative soft-thresholded
SVD (Mazumder, Hastie, Tibshirani 2010), "svd" type: X̂ ← P_Ω(X) + P_Ω⊥(S_λ(X̂)).
Each iteration is one distributed pass: tiles of the Gram matrix of the
current completed rows, summed in a tree (``partials``); the p x p eigen-decomposition runs on the driver (p = number of
columns); the refill is row-local.  Lineage is cut with a reliable
checkpoint in the session's checkpoint folder every few iterations, so a
lost executor recomputes at most those iterations.

``als_impute`` — the same completion problem by alternating ridge steps
(Hastie, Mazumder, Lee, Zadeh 2015), see there.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.operators.partials import array_matrix, column_matrix, reduced, tiles
from tabula.session import checkpoint_dir


#: Columns from which sums are taken by matrix columns instead of one aggregate expression each.
WIDE = 100


def column_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    if len(cols) > WIDE:
        total, n = column_sums(df, cols)
        return {c: float(t / k) if k else None for c, t, k in zip(cols, total, n)}
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def column_sums(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sum and count of the non-null values of each column, in one scan (``partials``)."""
    def kernel(batches):
        sums = np.zeros((2, len(cols)))
        for batch in batches:
            if batch.num_rows:
                x, there = column_matrix(batch)
                sums += [x.sum(0), there.sum(0)]
        yield 0, sums
    found = reduced(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), kernel).collect()
    total, n = np.frombuffer(found[0]["state"], float).reshape(2, -1) if found else np.zeros((2, len(cols)))
    return total, n


def mean_impute(df: DataFrame, cols: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    means = column_means(df, cols)
    exprs = {}
    for c in cols:
        m = means[c] if means[c] is not None else fill
        exprs[c] = F.col(c).cast("double") if m is None else F.coalesce(F.col(c).cast("double"), F.lit(float(m)))
    return df.withColumns(exprs)


def _matrix(col) -> np.ndarray:
    """pandas Series of float arrays (Arrow list<double>, nulls as NaN) -> 2-d array."""
    return np.vstack([np.asarray(v, dtype=float) for v in col.to_numpy()])


def _gram_kernel(p: int, with_change: bool):
    def run(batches):
        sums, change = {}, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = array_matrix(batch.column(0), p)
            if with_change:
                change += float(np.sum(batch.column(1).to_numpy(zero_copy_only=False)))
            for tile, i, j in tiles(p):
                got = x[:, i].T @ x[:, j]
                sums[tile] = sums[tile] + got if tile in sums else got
        yield from sums.items()
        yield -1, np.array([change])
    return run


def gram_tiles(df: DataFrame, vec: str, p: int, change: str | None = None) -> DataFrame:
    """The tiles of Σ x xᵀ on and above the diagonal (``partials``); tile -1: the sum of ``change``."""
    return reduced(df.select(vec, *([change] if change else [])), _gram_kernel(p, change is not None))


def gram_and_change(df: DataFrame, vec: str, p: int, change: str | None = None) -> tuple[np.ndarray, float]:
    """Σ x xᵀ over rows of an array<double> column (+ optional sum of a per-row change column) on the driver."""
    found = {r["tile"]: np.frombuffer(r["state"], float) for r in gram_tiles(df, vec, p, change).collect()}
    g = np.zeros((p, p))
    for tile, i, j in tiles(p):
        if tile in found:
            g[i, j] = found[tile].reshape(i.stop - i.start, j.stop - j.start)
            g[j, i] = g[i, j].T
    return g, float(found[-1][0]) if -1 in found else 0.0


def soft_impute(df: DataFrame, key: str, cols: Sequence[str], rank: int = 3, lam: float = 1.9,
                max_iter: int = 100, tol: float = 1e-5, checkpoint_every: int = 5,
                unfinished: str = "error") -> DataFrame:
    """Fill nulls in ``cols`` with a rank-``rank`` soft-thresholded SVD reconstruction.

    Observed cells are never changed.  Returns ``key`` + completed ``cols``.
    If ``max_iter`` rounds do not reach ``tol`` it raises, or warns
    (``unfinished='warn'``).
    Columns are used as given (no scaling), like the reference.
    """
    cols = list(cols)
    p = len(cols)
    spark = df.sparkSession
    checkpoint_dir(spark)
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, x array<double>, xh array<double>, delta double"
    state = df.select(F.col(key), F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    state = state.select(key, "x", F.transform("x", lambda v: F.coalesce(v, F.lit(0.0))).alias("xh"),
                         F.lit(float("inf")).alias("delta")).persist()
    norm2 = None
    stale = None
    for it in range(max_iter):
        g, change = gram_and_change(state, "xh", p, "delta" if it else None)   # materialises ``state``
        if stale is not None:
            stale.unpersist()
        if it and norm2 and change / norm2 < tol:
            break
        norm2 = float(np.trace(g))
        evals, evecs = np.linalg.eigh(g)
        order = np.argsort(evals)[::-1][:rank]
        d = np.sqrt(np.clip(evals[order], 0, None))
        v = evecs[:, order]
        shrink = np.divide(np.clip(d - lam, 0, None), d, out=np.zeros_like(d), where=d > 0)
        op = (v * shrink) @ v.T          # x -> x V diag((d - λ)+ / d) Vᵀ

        def refill(it_, op=op):
            for pdf in it_:
                if not len(pdf):
                    continue
                x = _matrix(pdf["x"])
                xh = _matrix(pdf["xh"])
                new = np.where(np.isnan(x), xh @ op, x)
                yield pd.DataFrame({key: pdf[key], "x": list(x), "xh": list(new),
                                    "delta": ((new - xh) ** 2).sum(axis=1)})
        nxt = state.mapInPandas(refill, schema).persist()
        if (it + 1) % checkpoint_every == 0:
            nxt = nxt.checkpoint(eager=True)    # reliable: survives executor loss, cuts lineage
        stale, state = state, nxt
    else:
        message = f"soft_impute: not converged to {tol} after {max_iter} rounds"
        if unfinished == "error":
            raise RuntimeError(message)
        warnings.warn(message, stacklevel=2)
    return state.select(key, *[F.element_at("xh", i + 1).alias(c) for i, c in enumerate(cols)])


@dataclass
class Factors:
    """The column factors (p x rank) of a completion, the objective of every round, and whether it settled."""

    v: np.ndarray
    objective: list[float] = field(default_factory=list)
    converged: bool = False


def _row_factors(x: np.ndarray, v: np.ndarray, lam: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values with 0 for NaN, presence, ridge factors) of rows, given the column factors."""
    there = (~np.isnan(x)).astype(float)
    x0 = np.where(there > 0, x, 0.0)
    p, r = v.shape
    squares = there @ (v[:, :, None] * v[:, None, :]).reshape(p, r * r)
    u = np.linalg.solve(squares.reshape(-1, r, r) + lam * np.eye(r), (x0 @ v)[:, :, None])[:, :, 0]
    return x0, there, u


def _balanced(v: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """The column factors of the same product U V' with the least ||U||^2 + ||V||^2, given U'U (``squares``)."""
    axes, d, turn = np.linalg.svd(v, full_matrices=False)
    inner = d[:, None] * (turn @ squares @ turn.T) * d          # its eigenvalues: the squared singular values of U V'
    value, vectors = np.linalg.eigh((inner + inner.T) / 2)
    even = (axes @ vectors) * np.clip(value, 0, None) ** 0.25
    return np.pad(even, ((0, 0), (0, v.shape[1] - even.shape[1])))      # more factors than columns: the rest are zero


def als_fit(df: DataFrame, vec: str, p: int, rank: int = 3, lam: float = 1.9, max_iter: int = 500,
            tol: float = 1e-9, seed: int = 0) -> Factors:
    """Column factors V minimising ||P(X - U V')||^2 + lam (||U||^2 + ||V||^2), P: observed cells only.

    At its minimum U V' is the low-rank soft-thresholded completion of ``soft_impute``.  A round is one
    pass over the unchanged input: the ridge factors of a row follow from V alone, so they are computed
    in the task and not kept; each column's ridge system (rank x rank) is summed over the rows
    (``partials``) and solved on the driver.  Nothing is stored between rounds but V (p x rank), so
    there is no lineage to cut.  The length of U and V is balanced after each round (``_balanced``), else
    they creep towards their balance, the more slowly the more rows there are.  All steps lower the
    objective, so it never rises.  Settled when a round lowers it by less than ``tol`` of itself; rows or
    columns without values have zero factors.
    """
    v = np.random.default_rng(seed).normal(size=(p, rank))
    fit = Factors(v)

    def kernel(v):
        def run(batches):
            a, b, squares, loss = np.zeros((p, rank * rank)), np.zeros((p, rank)), np.zeros((rank, rank)), 0.0
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, there, u = _row_factors(array_matrix(batch.column(0), p), v, lam)
                a += there.T @ (u[:, :, None] * u[:, None, :]).reshape(len(u), rank * rank)
                b += x.T @ u
                squares += u.T @ u
                loss += float((((x - u @ v.T) * there) ** 2).sum() + lam * (u ** 2).sum())
            yield 0, np.concatenate([a.ravel(), b.ravel(), squares.ravel(), [loss]])
        return run

    for _ in range(max_iter):
        found = reduced(df.select(vec), kernel(fit.v)).collect()
        if not found:
            fit.v, fit.converged = np.zeros((p, rank)), True
            break
        sums = np.frombuffer(found[0]["state"], float)
        fit.objective.append(float(sums[-1] + lam * (fit.v ** 2).sum()))
        a = sums[:p * rank * rank].reshape(p, rank, rank)
        b = sums[a.size:a.size + p * rank].reshape(p, rank)
        v = np.linalg.solve(a + lam * np.eye(rank), b[:, :, None])[:, :, 0]
        fit.v = _balanced(v, sums[a.size + p * rank:-1].reshape(rank, rank))
        last = fit.objective[-2:]
        if len(last) == 2 and last[0] - last[1] <= tol * abs(last[0]):
            fit.converged = True
            break
    return fit


def als_impute(df: DataFrame, key: str, cols: Sequence[str], rank: int = 3, lam: float = 1.9, max_iter: int = 500,
               tol: float = 1e-9) -> tuple[DataFrame, Factors]:
    """``key`` + ``cols`` with nulls and NaN filled from the factors of ``als_fit``, and the factors.

    Observed cells are never changed; a row without any value is filled with zeros.  Raises if
    ``max_iter`` rounds do not settle.  ``lam`` > 0.  The input is read once a round: give a written
    or cheap table.
    """
    cols = list(cols)
    if not lam > 0:
        raise ValueError("lam must be positive")
    x = F.array(*[F.col(c).cast("double") for c in cols]).alias("x")
    fit = als_fit(df.select(x), "x", len(cols), rank, lam, max_iter, tol)
    if not fit.converged:
        raise RuntimeError(f"als_impute: not settled to {tol} after {max_iter} rounds")
    v = fit.v

    def fill(batches):
        for pdf in batches:
            if len(pdf):
                rows = _matrix(pdf["x"])
                _, there, u = _row_factors(rows, v, lam)
                yield pd.DataFrame({key: pdf[key], "x": list(np.where(there > 0, rows, u @ v.T))})
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, x array<double>"
    full = df.select(F.col(key), x).mapInPandas(fill, schema)
    return full.select(key, *[F.element_at("x", i + 1).alias(c) for i, c in enumerate(cols)]), fit
