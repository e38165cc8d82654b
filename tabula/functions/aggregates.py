"""Aggregate functions and function bundles.

A *bundle* is an ordered list of function names; ``bundle_exprs`` expands it
over columns into ``<col>_<fn>`` aggregate expressions.  Two null modes:

``propagate``  (canonical bundle, N1/N3) a group containing a null gives null
               for mean / var / sd / min / max / sum / median / moments, and
               ``n_distinct`` counts null as one more value.
``skip``       (``na.rm = TRUE`` bundles, N2) nulls are ignored; an all-null
               group gives sum 0 and n_distinct 0, other functions null.

Every function is a built-in declarative / imperative aggregate with partial
(map-side) aggregation, so a hot key is pre-combined on every mapper before
the shuffle.  ``n_distinct`` uses ``count(DISTINCT)``, which Catalyst rewrites
into an Expand + two-level aggregation keyed by (group, value): a hot group's
distinct values are spread over all reducers instead of being collected into
one set.  ``median`` is Spark's exact ``percentile`` aggregate (value->count
map buffer merged per group).

Users can register more functions: ``register('p90', lambda c: ...)``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The function bundles used by the reference scripts, in their order.
BUNDLES: dict[str, list[str]] = {
    "canonical": ["mean", "var", "min", "max", "sum", "n_distinct"],
    "mean_var_sum": ["mean", "var", "sum"],
    "sd": ["mean", "sd", "min", "max", "sum", "n_distinct"],
    "median": ["median", "sd", "min", "max", "sum", "n_distinct"],
    "moments": ["median", "sd", "skewness", "min", "max", "sum", "n_distinct", "kurtosis"],
    "nine": ["mean", "median", "sd", "skewness", "min", "max", "sum", "n_distinct", "kurtosis"],
}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _d(c) -> Column:
    return _c(c).cast("double")


_BASE: dict[str, Callable[[Column], Column]] = {
    "mean": lambda c: F.avg(_d(c)),
    "var": lambda c: F.var_samp(_d(c)),
    "sd": lambda c: F.stddev_samp(_d(c)),
    "min": lambda c: F.min(_c(c)),
    "max": lambda c: F.max(_c(c)),
    "sum": lambda c: F.sum(_c(c)),
    "median": lambda c: F.median(_d(c)),
    "skewness": lambda c: F.skewness(_d(c)),
    # Spark's kurtosis is excess kurtosis; the reference uses m4/m2^2 (normal = 3).
    "kurtosis": lambda c: F.kurtosis(_d(c)) + F.lit(3.0),
    "count": lambda c: F.count(_c(c)),
}


def register(name: str, fn: Callable[[Column], Column]) -> None:
    _BASE[name] = fn


def agg_expr(fn: str, c, nulls: str = "propagate") -> Column:
    """One aggregate with the chosen null semantics."""
    c = _c(c)
    if fn == "n_distinct":
        if nulls == "propagate":
            return (F.count_distinct(c) + F.max(c.isNull().cast("long"))).cast("long")
        return F.count_distinct(c).cast("long")
    base = _BASE[fn](c)
    if nulls == "propagate":
        return F.when(F.count(c) == F.count(F.lit(1)), base)
    if nulls == "skip":
        return F.coalesce(base, F.lit(0)) if fn == "sum" else base
    raise ValueError(f"unknown null mode {nulls!r}")


def bundle_exprs(cols: Sequence[str], fns: Sequence[str] | str, nulls: str = "propagate",
                 prune: Mapping[str, Sequence[str]] | None = None, sep: str = "_") -> list[Column]:
    """``[agg(c).alias(f'{c}_{fn}') for c in cols for fn in fns]`` minus pruned outputs.

    ``prune`` maps a column regex to function names that are never computed
    for matching columns (instead of computing and dropping them later).
    """
    import re

    fns = BUNDLES[fns] if isinstance(fns, str) else list(fns)
    pruned = [(re.compile(p), set(f)) for p, f in (prune or {}).items()]
    out = []
    for c in cols:
        for fn in fns:
            if any(rx.search(c) and fn in fs for rx, fs in pruned):
                continue
            out.append(agg_expr(fn, c, nulls).alias(f"{c}{sep}{fn}"))
    return out
