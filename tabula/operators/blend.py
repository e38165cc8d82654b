"""Score blending.

Score files are aligned by key with inner equi-joins (never by position),
then combined with one projection: weighted two-level blends and the
row-wise median.  ``score_correlation`` replaces the reference's pairwise
plot with pairwise Pearson correlations in long form.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.functions.rowwise import row_median
from tabula.operators.joins import align_on_key
from tabula.operators.selection import correlation_long


def weighted(groups: Sequence[tuple[float, Mapping[str, float]]]) -> Column:
    """Σ_g w_g · Σ_i w_gi · score_i, e.g. ``[(0.8, {'t1': .3, ...}), (0.2, {...})]``."""
    total = None
    for w, members in groups:
        inner = None
        for name, wi in members.items():
            term = F.col(name) * F.lit(float(wi))
            inner = term if inner is None else inner + term
        part = F.lit(float(w)) * inner
        total = part if total is None else total + part
    return total


def blend(scores: Mapping[str, DataFrame], key: str, score: str, how: str = "weighted",
          groups: Sequence[tuple[float, Mapping[str, float]]] | None = None, out: str = "TARGET") -> DataFrame:
    wide = align_on_key(dict(scores), key, score)
    if how == "median":
        expr = row_median(list(scores))
    else:
        expr = weighted(groups or [])
    return wide.select(F.col(key), expr.alias(out))


def score_correlation(scores: Mapping[str, DataFrame], key: str, score: str) -> DataFrame:
    return correlation_long(align_on_key(dict(scores), key, score), list(scores))
