"""Pairwise-complete correlations of many columns in one scan (M2, M9).

For every pair of columns the rows where both have a value give a count, two means, two sums of
squares and one of products.  A task gets them for all its rows as six products of the value and
presence matrices; tiles of pairs are merged by the rule for central moments (``partials``), so wide
tables with nulls need one scan, and no p x p table passes through the driver.

Values are taken relative to a middle value of the task's first batch, which keeps large offsets
from cancelling and gives constant columns a spread of exactly zero.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.operators.partials import column_matrix, reduced, tiles


def _middle(x: np.ndarray, there: np.ndarray) -> np.ndarray:
    """A value of each column near its median (0 without values)."""
    out = np.zeros(x.shape[1])
    for j in range(x.shape[1]):
        v = np.sort(x[there[:, j] > 0, j])
        if v.size and np.isfinite(v[v.size // 2]):
            out[j] = v[v.size // 2]
    return out


def _merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two sets of (count, mean x, mean y, xx, yy, xy) per pair as one."""
    a, b = a.reshape(6, -1), b.reshape(6, -1)
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    # a side without rows has no mean of its own
    dx = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
    dy = np.where((a[0] > 0) & (b[0] > 0), b[2] - a[2], 0.0)
    weight = a[0] * share
    return np.stack([n, np.where(a[0] > 0, a[1], b[1]) + dx * share, np.where(a[0] > 0, a[2], b[2]) + dy * share,
                     a[3] + b[3] + dx * dx * weight, a[4] + b[4] + dy * dy * weight, a[5] + b[5] + dx * dy * weight]).ravel()


def _kernel(p: int):
    def run(batches):
        middle, sums = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, m = column_matrix(batch)
            if middle is None:
                middle = _middle(x, m)
            x = (x - middle) * m
            xx = x * x
            for tile, i, j in tiles(p):
                got = np.stack([m[:, i].T @ m[:, j], x[:, i].T @ m[:, j], m[:, i].T @ x[:, j],
                                xx[:, i].T @ m[:, j], m[:, i].T @ xx[:, j], x[:, i].T @ x[:, j]])
                sums[tile] = sums[tile] + got if tile in sums else got
        for tile, i, j in tiles(p):
            if tile in sums:
                n, sx, sy, xx, yy, xy = sums[tile]
                d = np.maximum(n, 1.0)
                yield tile, np.stack([n, middle[i][:, None] + sx / d, middle[j][None, :] + sy / d,
                                      np.maximum(xx - sx * sx / d, 0.0), np.maximum(yy - sy * sy / d, 0.0), xy - sx * sy / d])
    return run


def pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col_a, col_b, n, cov, corr) of every pair a < b in list order, over the rows where both are there.

    ``corr`` is null without spread in one of the columns, or with a NaN or an infinity in one of them;
    ``cov`` is the population covariance, null without rows.
    """
    cols = list(cols)
    p = len(cols)
    spans = {tile: (i, j) for tile, i, j in tiles(p)}

    def rows(batches):
        for pdf in batches:
            for tile, state in zip(pdf["tile"], pdf["state"]):
                i, j = spans[tile]
                shape = (i.stop - i.start, j.stop - j.start)
                n, _, _, xx, yy, xy = np.frombuffer(state, float).reshape(6, *shape)
                with np.errstate(all="ignore"):
                    corr = np.where((xx > 0) & (yy > 0), xy / (np.sqrt(xx) * np.sqrt(yy)), np.nan)
                    cov = np.where(n > 0, xy / n, np.nan)
                a, b = np.indices(shape)
                a, b = a + i.start, b + j.start
                at = np.nonzero(a < b)
                yield pd.DataFrame({"col_a": [cols[k] for k in a[at]], "col_b": [cols[k] for k in b[at]],
                                    "n": n[at].astype("int64"), "cov": cov[at], "corr": corr[at]})

    states = reduced(df.select(*[F.col(c).cast("double") for c in cols]), _kernel(p), _merge)
    found = states.mapInPandas(rows, "col_a string, col_b string, n long, cov double, corr double")
    null_nan = [F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("cov", "corr")]
    return found.select("col_a", "col_b", "n", *null_nan)
