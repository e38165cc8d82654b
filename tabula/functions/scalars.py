"""Scalar column expressions with the reference's numeric semantics.

All return ``Column`` objects, so they stay inside whole-stage codegen.
Spark runs with ANSI mode on, where ``x / 0`` raises; the reference (R)
yields IEEE results instead, hence ``ieee_divide``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
NAN = float("nan")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c) -> Column:
    return col(c).cast("double")


def ieee_divide(a, b) -> Column:
    """a / b with IEEE results for a zero divisor: +-Inf, NaN for 0/0.

    Null in either operand gives null.  The division itself sits in a guarded
    CASE branch, so ANSI mode never sees a zero divisor.
    """
    a, b = dbl(a), dbl(b)
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(b != 0, a / b)
            .when(a.isNaN() | (a == 0), F.lit(NAN))
            .when(a > 0, F.lit(INF))
            .otherwise(F.lit(-INF)))


def null_if(c, cond: Column) -> Column:
    """Sentinel cleaning (F2): null where ``cond`` holds; a null condition keeps the value."""
    return F.when(cond, F.lit(None)).otherwise(col(c))


def clamp0(c) -> Column:
    """``ifelse(x > 0, x, 0)`` with null staying null."""
    c = dbl(c)
    return F.when(c > 0, c).when(c <= 0, F.lit(0.0)).otherwise(F.lit(None).cast("double"))


def flag(cond: Column) -> Column:
    """Logical -> 0/1 integer, null stays null."""
    return cond.cast("int")


def is_non_finite(c) -> Column:
    c = dbl(c)
    return c.isNaN() | (F.abs(c) == F.lit(INF))


def non_finite_to_null(c) -> Column:
    """NaN and +-Inf become null."""
    c = col(c)
    return F.when(is_non_finite(c), F.lit(None)).otherwise(c)


def cut_right_closed(c, breaks: Sequence[float]) -> Column:
    """R ``cut(x, breaks)``: bin index 1..len(breaks)-1 of the right-closed bins (a, b].

    Values on or below the first break, above the last, or null give null.
    (Spark's Bucketizer is left-closed and rejects out-of-range values, so it
    does not fit.)
    """
    c = dbl(c)
    expr = None
    for i in range(1, len(breaks)):
        cond = (c > float(breaks[i - 1])) & (c <= float(breaks[i]))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(None).cast("int"))


def cut_labels(breaks: Sequence[float]) -> list[str]:
    """Interval labels in R's default format, e.g. ``(-1,0]``."""
    def fmt(x):
        return f"{x:g}"
    return [f"({fmt(breaks[i - 1])},{fmt(breaks[i])}]" for i in range(1, len(breaks))]


def safe_sqrt(c) -> Column:
    """sqrt with NaN for negative input (Spark already does this; kept explicit)."""
    return F.sqrt(dbl(c))


def safe_log1p(c) -> Column:
    """log1p with R semantics: -Inf at -1, NaN below (Spark returns null there)."""
    c = dbl(c)
    return (F.when(c.isNull(), F.lit(None).cast("double"))
            .when(c == -1, F.lit(-INF)).when(c < -1, F.lit(NAN))
            .otherwise(F.log1p(c)))


def power(c, exponent: float) -> Column:
    """x ^ e with IEEE results (0 ^ negative = Inf, negative ^ fraction = NaN)."""
    return F.pow(dbl(c), F.lit(float(exponent)))


def days_since(c, epoch: str = "2002-01-01") -> Column:
    """Integer day offset relative to an application date (negative in the past)."""
    return F.datediff(F.to_date(col(c)), F.to_date(F.lit(epoch)))


def _veltkamp(c: Column, bits: int) -> Column:
    """``c`` rounded to ``bits`` significant bits by Veltkamp splitting.

    hi = c*K + (c - c*K) with K = 2^(53-bits) + 1 uses only IEEE-exact
    multiply / subtract / add, so every IEEE-754 engine (the JVM, DuckDB,
    numpy) returns the same bits — no logarithms, powers or decimal rounding.
    """
    k = F.lit(float(2 ** (53 - bits) + 1))
    return (c * k) + (c - c * k)


def sig_round(c, bits: int = 30) -> Column:
    """Round a double to ``bits`` significant binary digits (~9 decimal digits).

    Makes outputs engine-independent despite different summation orders.
    Binary (not decimal) rounding: decimal-valued data such as money amounts
    often sits exactly on a decimal rounding tie, never on a binary one.
    Magnitudes below 1e-9 become 0 and -0.0 becomes 0.0.
    """
    c = dbl(c)
    # null -> null and NaN -> NaN fall out of the arithmetic; +-Inf is kept by the guard
    return (F.when(F.abs(c) < F.lit(1e-9), F.lit(0.0))
            .when(F.abs(c) == F.lit(INF), c)
            .otherwise(_veltkamp(c, bits) + F.lit(0.0)))
