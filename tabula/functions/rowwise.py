"""Row-wise statistics over a list of columns.

Built as expressions over ``array(cols)`` with higher-order functions so the
generated code stays small for long column lists.  Like R's ``apply`` without
``na.rm``, any null in the row makes sum / mean / sd / kurtosis / median null
(N16); ``row_null_count`` counts the nulls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabula.functions.scalars import dbl


def _arr(cols: Sequence) -> Column:
    return F.array(*[dbl(c) for c in cols])


def _any_null(cols: Sequence) -> Column:
    return F.exists(_arr(cols), lambda x: x.isNull())


def row_null_count(cols: Sequence) -> Column:
    nulls = F.array(*[F.col(c).isNull().cast("int") if isinstance(c, str) else c.isNull().cast("int") for c in cols])
    return F.size(F.array_remove(nulls, 0))


def row_sum(cols: Sequence) -> Column:
    s = F.aggregate(_arr(cols), F.lit(0.0), lambda acc, x: acc + x)
    return F.when(_any_null(cols), F.lit(None).cast("double")).otherwise(s)


def row_mean(cols: Sequence) -> Column:
    return row_sum(cols) / F.lit(float(len(cols)))


def _central_sum(cols: Sequence, power: int) -> Column:
    # the mean is bound as a lambda variable, so it is computed once per row and not once per element
    sums = F.transform(F.array(row_mean(cols)), lambda m: F.aggregate(
        _arr(cols), F.lit(0.0), lambda acc, x: acc + F.pow(x - m, F.lit(float(power)))))
    return F.element_at(sums, 1)


def row_sd(cols: Sequence) -> Column:
    """Sample standard deviation (n - 1), null when fewer than 2 columns."""
    n = len(cols)
    if n < 2:
        return F.lit(None).cast("double")
    return F.sqrt(_central_sum(cols, 2) / F.lit(float(n - 1)))


def row_kurtosis(cols: Sequence) -> Column:
    """Pearson kurtosis m4 / m2^2 (normal = 3) over the row; NaN when the row is constant."""
    n = float(len(cols))
    m2 = _central_sum(cols, 2) / F.lit(n)
    m4 = _central_sum(cols, 4) / F.lit(n)
    return F.when(m2 == 0, F.lit(float("nan"))).otherwise(m4 / (m2 * m2))


def row_median(cols: Sequence) -> Column:
    """Median across the row (odd: middle, even: mean of the two middles); null if any null."""
    n = len(cols)
    s = F.array_sort(_arr(cols))
    if n % 2:
        med = F.element_at(s, n // 2 + 1)
    else:
        med = (F.element_at(s, n // 2) + F.element_at(s, n // 2 + 1)) / F.lit(2.0)
    return F.when(_any_null(cols), F.lit(None).cast("double")).otherwise(med)
