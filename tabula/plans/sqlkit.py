"""DuckDB spellings of the reference semantics, for the oracle queries.

These are written independently in SQL (CASE expressions, window functions,
DuckDB aggregates) rather than generated from the Spark expressions, so the
oracle is a second implementation of the same definition.
"""

from __future__ import annotations

from collections.abc import Sequence


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def div(a: str, b: str) -> str:
    """IEEE division (DuckDB already returns +-inf / nan for a double zero divisor)."""
    return f"(({a})::DOUBLE / ({b})::DOUBLE)"


def nonfinite_null(x: str) -> str:
    return f"(CASE WHEN isnan(({x})::DOUBLE) OR isinf(({x})::DOUBLE) THEN NULL ELSE ({x}) END)"


def clamp0(x: str) -> str:
    return f"(CASE WHEN ({x}) > 0 THEN ({x})::DOUBLE WHEN ({x}) <= 0 THEN 0.0 END)"


def cut(x: str, breaks: Sequence[float]) -> str:
    arms = " ".join(f"WHEN ({x}) > {float(breaks[i - 1])!r} AND ({x}) <= {float(breaks[i])!r} THEN {i}"
                    for i in range(1, len(breaks)))
    return f"(CASE {arms} END)::INTEGER"


def veltkamp(x: str, bits: int) -> str:
    k = float(2 ** (53 - bits) + 1)
    return f"(({x}) * {k!r} + (({x}) - ({x}) * {k!r}))"


def sig(x: str, bits: int = 30) -> str:
    """Keep ``bits`` significant binary digits (same definition as ``sig_round``)."""
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) OR isinf({x}) THEN {x} "
            f"WHEN abs({x}) < 1e-9 THEN 0.0 ELSE {veltkamp(x, bits)} + 0.0 END)")


def stable(inner: str, double_cols: Sequence[str]) -> str:
    """Wrap a query so its double columns are rounded like ``tabula.functions.sig_round``."""
    if not double_cols:
        return inner
    rep = ", ".join(f"{sig(q(c))} AS {q(c)}" for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) AS __s"


def agg(fn: str, x: str, nulls: str = "propagate", mean: str | None = None, integer: bool = False) -> str:
    """One bundle aggregate with the reference's null semantics.

    ``mean`` names a column holding the group mean of ``x`` (see
    ``with_group_means``); skewness and kurtosis are computed from central
    moments around it, which is numerically stable for large values.
    """
    xd = f"({x})::DOUBLE"
    dev = f"({xd} - ({mean}))" if mean else None
    const = f"min({x}) = max({x})"
    base = {
        "mean": f"avg({xd})",
        "var": f"var_samp({xd})",
        "sd": f"stddev_samp({xd})",
        "min": f"min({x})",
        "max": f"max({x})",
        "sum": f"sum({x})",
        "median": f"median({xd})",
        "count": f"count({x})",
    }
    if dev:
        # population skewness m3 / m2^1.5 and Pearson kurtosis m4 / m2^2; null for a constant group
        base["skewness"] = (f"(CASE WHEN {const} THEN NULL ELSE "
                            f"avg(pow({dev}, 3)) / pow(avg(pow({dev}, 2)), 1.5) END)")
        base["kurtosis"] = (f"(CASE WHEN {const} THEN NULL ELSE "
                            f"avg(pow({dev}, 4)) / pow(avg(pow({dev}, 2)), 2) END)")
    if fn == "n_distinct":
        key = x if integer else f"({x})::DOUBLE"
        if nulls == "propagate":
            return f"(count(DISTINCT {key}) + max(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END))::BIGINT"
        return f"count(DISTINCT {key})::BIGINT"
    b = base[fn]
    if nulls == "propagate":
        return f"(CASE WHEN count({x}) = count(*) THEN {b} END)"
    if fn == "sum":
        return f"coalesce({b}, 0)"
    return b


MOMENTS = {"skewness", "kurtosis"}


def mean_col(c: str) -> str:
    return q("__m_" + c)


def with_group_means(table_sql: str, keys: Sequence[str], cols: Sequence[str]) -> str:
    """Detail rows plus ``__m_<col>`` = group mean of each column (window over the keys)."""
    part = ", ".join(q(k) for k in keys)
    means = ", ".join(f"avg(({q(c)})::DOUBLE) OVER (PARTITION BY {part}) AS {mean_col(c)}" for c in cols)
    return f"SELECT *, {means} FROM ({table_sql}) AS __t"


def bundle(cols: Sequence[str], fns: Sequence[str], nulls: str = "propagate", sep: str = "_",
           int_cols: Sequence[str] = ()) -> list[str]:
    """Aggregate list; if a moment is requested the input must come from ``with_group_means``.

    ``int_cols`` are integer inputs: their sum is cast to BIGINT (DuckDB would
    widen it to HUGEINT; Spark's sum of integers is a long).
    """
    need = bool(MOMENTS & set(fns))
    ints = set(int_cols)
    out = []
    for c in cols:
        for fn in fns:
            e = agg(fn, q(c), nulls, mean_col(c) if need else None, integer=c in ints)
            if fn == "sum" and c in ints:
                e = f"({e})::BIGINT"
            out.append(f"{e} AS {q(c + sep + fn)}")
    return out


FLOAT_FNS = {"mean", "var", "sd", "median", "skewness", "kurtosis"}


def bundle_doubles(cols: Sequence[str], fns: Sequence[str], int_cols: Sequence[str] = (), sep: str = "_") -> list[str]:
    """Names of the double-typed outputs of ``bundle``."""
    ints = set(int_cols)
    return [c + sep + fn for c in cols for fn in fns
            if fn in FLOAT_FNS or (fn in ("min", "max", "sum") and c not in ints)]
