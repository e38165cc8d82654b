"""Column statistics and column filters (M1, M2, M4, M9).

The data work is distributed (value counts + aggregations, one pass for all pairs);
only per-column summaries (bounded by the number of columns) and the p x p
correlation matrix reach the driver, where the drop decision is made.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.functions.scalars import ieee_divide
from tabula.operators.moments import pair_moments
from tabula.session import keep

# Near-zero-variance defaults (frequency ratio 95/5, 10 % unique).
FREQ_CUT = 95 / 5
UNIQUE_CUT = 10.0

#: Columns whose pairs are one aggregation; it plans well up to about a hundred pairs.
WIDE = 14


#: Cells whose values a task counts before it hands them on.
CELLS = 4_000_000


def _value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, v, n) for the non-null cells of the chosen columns, values as doubles, counted for some rows at a time."""
    out = pa.schema([("i", pa.int32()), ("v", pa.float64()), ("n", pa.int64())])

    def counted(held):
        table = pa.Table.from_batches(held)
        for i in range(table.num_columns):
            values = table.column(i).drop_null().cast(pa.float64(), safe=False).to_numpy()
            if values.size:
                v, n = np.unique(values + 0.0, return_counts=True)         # 0.0 for -0.0, one NaN
                yield pa.RecordBatch.from_arrays([pa.array(np.full(v.size, i, np.int32)), pa.array(v, from_pandas=False), pa.array(n.astype(np.int64))], schema=out)

    def run(batches):
        held, cells = [], 0
        for batch in batches:
            held.append(batch)
            cells += batch.num_rows * batch.num_columns
            if cells >= CELLS:
                yield from counted(held)
                held, cells = [], 0
        if held:
            yield from counted(held)
    plain = ("integer", "long", "double", "float", "short", "byte")
    rows = df.select(*[F.col(c) if df.schema[c].dataType.typeName() in plain else F.col(c).cast("double").alias(c) for c in cols])
    return rows.mapInArrow(run, "i int, v double, n long")


def nzv_metrics(df: DataFrame, cols: Sequence[str] | None = None, freq_cut: float = FREQ_CUT,
                unique_cut: float = UNIQUE_CUT) -> DataFrame:
    """Per column: freq_ratio, percent_unique, zero_var, nzv (caret ``nearZeroVar`` rule).

    freq_ratio = count of the most frequent value / count of the second most
    frequent (0 with fewer than two distinct values); percent_unique = 100 *
    distinct non-null values / all rows (nulls count in the denominator);
    zero_var = one distinct value or all null; nzv = zero_var or
    (freq_ratio > freq_cut and percent_unique <= unique_cut).

    Plan: value counts per (column, value), counted a set of rows at a time in
    the tasks (no row per cell) and summed -> per-column max count ->
    per-column second count, distinct count and total.  No window, no
    per-column set: every step is a combinable aggregation.
    """
    cols = list(cols) if cols is not None else [f.name for f in df.schema.fields
                                                 if f.dataType.typeName() in ("integer", "long", "double", "float",
                                                                              "short", "byte")]
    n_rows = df.count()
    counts = keep(_value_counts(df, cols).groupBy("i", "v").agg(F.sum("n").alias("cnt")))
    top = counts.groupBy("i").agg(F.max("cnt").alias("top1"))
    per_col = (counts.join(F.broadcast(top), "i")   # one row per column: bounded by the column count
               .groupBy("i").agg(F.first("top1").alias("top1"),
                                 F.sum((F.col("cnt") == F.col("top1")).cast("long")).alias("n_top"),
                                 F.max(F.when(F.col("cnt") < F.col("top1"), F.col("cnt"))).alias("second"),
                                 F.count(F.lit(1)).alias("n_unique")))
    names = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(i), F.lit(c))])
    all_cols = df.sparkSession.createDataFrame([(i,) for i in range(len(cols))], "i int")
    m = all_cols.join(per_col, "i", "left")
    top2 = F.when(F.col("n_top") >= 2, F.col("top1")).otherwise(F.col("second"))
    n_unique = F.coalesce(F.col("n_unique"), F.lit(0))
    freq = F.when(n_unique <= 1, F.lit(0.0)).otherwise(F.col("top1") / top2)
    pct = F.lit(100.0) * n_unique / F.lit(float(max(n_rows, 1)))
    zero_var = (n_unique <= 1)
    out = m.select(names[F.col("i")].alias("column"), freq.alias("freq_ratio"), pct.alias("percent_unique"),
                   zero_var.cast("int").alias("zero_var"))
    return out.withColumn("nzv", ((F.col("zero_var") == 1) |
                                  ((F.col("freq_ratio") > freq_cut) & (F.col("percent_unique") <= unique_cut)))
                          .cast("int"))


def nzv_columns(df: DataFrame, cols: Sequence[str] | None = None, **kw) -> list[str]:
    """Names of near-zero-variance columns (driver list bounded by the column count)."""
    return [r["column"] for r in nzv_metrics(df, cols, **kw).where(F.col("nzv") == 1).collect()]


def drop_nzv(df: DataFrame, cols: Sequence[str] | None = None, **kw) -> DataFrame:
    drop = nzv_columns(df, cols, **kw)
    return df.drop(*drop) if drop else df


def correlation_long(df: DataFrame, cols: Sequence[str], wide: int = WIDE) -> DataFrame:
    """Pearson correlation of every column pair (a < b in list order), each over the rows where both are there.

    Up to ``wide`` columns are one aggregation of central moments inside Catalyst; more come from
    one scan with matrix products (``moments``).  A pair with a constant column gives null, an empty
    table no correlation at all (null or no rows).
    """
    cols = list(cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if len(cols) > wide:
        return pair_moments(df, cols).select("col_a", "col_b", "corr")

    def safe_corr(a, b):
        # corr() itself raises under ANSI mode for a constant column; build it from
        # combinable moments and divide with IEEE semantics (0/0 -> NaN -> null below)
        # all moments over the rows where both values are there
        a, b = F.col(a).cast("double"), F.col(b).cast("double")
        both = a.isNotNull() & b.isNotNull()
        # merged means of a constant such as 0.1 may differ in the last digit: no spread by its range
        spread = [F.min(F.when(both, c)) < F.max(F.when(both, c)) for c in (a, b)]
        return F.when(spread[0] & spread[1], ieee_divide(F.covar_pop(a, b), F.stddev_pop(F.when(both, a)) * F.stddev_pop(F.when(both, b))))

    row = df.agg(*[safe_corr(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs])
    stacked = row.select(F.explode(F.array(*[
        F.struct(F.lit(cols[i]).alias("col_a"), F.lit(cols[j]).alias("col_b"), F.col(f"c{i}_{j}").alias("corr"))
        for i, j in pairs])).alias("p")).select("p.*")
    return stacked.withColumn("corr", F.when(F.col("corr").isNaN(), F.lit(None)).otherwise(F.col("corr")))


def correlation_matrix(df: DataFrame, cols: Sequence[str], wide: int = WIDE) -> np.ndarray:
    """p x p matrix on the driver (bounded by the column count); NA -> 0, unit diagonal."""
    cols = list(cols)
    idx = {c: i for i, c in enumerate(cols)}
    m = np.eye(len(cols))
    for r in correlation_long(df, cols, wide).collect() if len(cols) > 1 else []:
        v = 0.0 if r["corr"] is None else float(r["corr"])
        m[idx[r["col_a"]], idx[r["col_b"]]] = m[idx[r["col_b"]], idx[r["col_a"]]] = v
    return m


def find_correlation(corr: np.ndarray, cutoff: float = 0.9, exact: bool = True) -> list[int]:
    """Indices of columns to drop so that no remaining pair has |r| above ``cutoff``.

    Of a pair above the cutoff, the column that is more correlated with the others goes.
    ``exact``: columns are visited by decreasing mean |r|, and the first of a pair goes if its
    mean |r| with the columns still there exceeds the mean |r| of the other remaining columns.
    Otherwise the two columns' means over all columns, taken once, decide.
    """
    r = np.abs(np.asarray(corr, dtype=float))
    p = r.shape[0]
    if p < 2:
        return []
    if not exact:
        mean = r.mean(axis=0)
        pairs = np.argwhere(np.triu(r > cutoff, 1))
        return sorted({int(j if mean[j] > mean[i] else i) for i, j in pairs})
    r = r.copy()
    np.fill_diagonal(r, 0.0)
    there = np.ones(p, dtype=bool)
    visit = np.argsort(-(r.sum(axis=0) / (p - 1)), kind="stable")
    for at, first in enumerate(visit):
        for second in visit[at + 1:]:
            if not there[first]:
                break
            if not there[second] or r[first, second] <= cutoff:
                continue
            others = there.sum() - 1
            own = r[first, there].sum() / others
            without_second = there.copy()
            without_second[second] = False
            rest = r[np.ix_(without_second, there)].sum() / others ** 2
            there[first if own > rest else second] = False
    return np.flatnonzero(~there).tolist()


def correlation_filter(df: DataFrame, cols: Sequence[str], cutoff: float = 0.9,
                       protect: Sequence[str] = (), exact: bool = True) -> list[str]:
    """Names of columns to drop (M4); ``protect`` keeps named columns even if flagged."""
    cols = list(cols)
    drop = [cols[i] for i in find_correlation(correlation_matrix(df, cols), cutoff, exact)]
    return [c for c in drop if c not in set(protect)]
