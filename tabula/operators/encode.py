"""Categorical encoders.

E1 ``label_encode``: ``factor(x) %>% as.integer`` — 1-based code of the
   value among the column's sorted distinct non-null values (binary string
   order), null stays null.
E2 ``onehot``: every string column with at most ``max_levels`` levels becomes
   one 0/1 column per level, wider string columns are dropped, other columns
   pass through; null is not a level (its indicators are null).
E3/E4 ``fit_dummies`` / ``apply_dummies``: levels fitted on one frame (the
   training split) and applied to any frame; unseen levels give all zeros.
E5 ``ints_as_category``: integer columns are treated as categories.

Level dictionaries are needed on the driver only to *name* output columns
(E2/E3).  Label encoding ranks every dictionary with a range-partitioned
distributed dense rank, so none goes through the driver or a single task.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabula.functions.columns import string_columns
from tabula.operators.joins import WIDE_ROW, checked_broadcast, packed
from tabula.session import checkpoint_dir


def _distinct_levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long (col, value) table of distinct non-null values of several columns in one pass."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.col", "kv.value")
    return stacked.where(F.col("value").isNotNull()).distinct()


def level_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Exact number of distinct non-null values per column (one aggregation)."""
    if not cols:
        return {}
    row = df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in cols]).first()
    return {c: int(row[c]) for c in cols}


def ranked_levels(levels: DataFrame) -> DataFrame:
    """Dense rank of (col, value) by value within col without a single-task window.

    Range-partition on (col, value), rank inside each range partition, then
    add the per-partition offsets (one small row per partition and column).
    The partitioning is checkpointed first: ranks and offsets see the same one
    even if executors are lost in between.
    """
    spark = levels.sparkSession
    checkpoint_dir(spark)
    n = max(1, spark.sparkContext.defaultParallelism)
    ranged = levels.repartitionByRange(n, "col", "value").withColumn("__pid", F.spark_partition_id()).checkpoint()
    local = ranged.withColumn("__local", F.row_number().over(Window.partitionBy("__pid", "col").orderBy("value")))
    sizes = ranged.groupBy("__pid", "col").count()
    offsets = sizes.withColumn(
        "__offset", F.coalesce(F.sum("count").over(
            Window.partitionBy("col").orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (local.join(offsets.select("__pid", "col", "__offset"), ["__pid", "col"])
            .select("col", "value", (F.col("__local") + F.col("__offset")).cast("int").alias("code")))


def label_encode(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Replace each string column by its 1-based sorted-level code.

    Dictionaries of every size take the same way: a ranked table, joined to
    each column, broadcast only if its measured size allows.
    """
    cols = list(cols) if cols is not None else string_columns(df)
    if not cols:
        return df
    ranked = ranked_levels(_distinct_levels(df, cols)).checkpoint()
    wide = len(df.columns) > WIDE_ROW
    out = packed(df, cols) if wide else df
    for i, c in enumerate(cols):
        d = ranked.where(F.col("col") == c).select(F.col("value").alias(f"__v_{i}"), F.col("code").alias(f"__c_{i}"))
        d, _ = checked_broadcast(d)
        out = out.join(d, out[c].cast("string") == d[f"__v_{i}"], "left")
    codes = {c: f"__c_{i}" for i, c in enumerate(cols)}
    return out.select(*[F.col(codes[c]).alias(c) if c in codes else F.col(f"__packed.`{c}`") if wide else out[c] for c in df.columns])


def _safe(level: str) -> str:
    return re.sub(r"[^0-9A-Za-z]+", "_", str(level)).strip("_") or "blank"


def dummy_names(levels: Sequence[str]) -> list[str]:
    """Column-name parts of the levels: letters and digits; levels that look alike are numbered in their order."""
    names, seen = [], set()
    for name in map(_safe, levels):
        own, n = name, 1
        while own.lower() in seen:
            n += 1
            own = f"{name}__{n}"
        seen.add(own.lower())
        names.append(own)
    return names


#: A table cannot have more columns than this from one dictionary; refused, not cut.
DUMMY_LEVEL_CAP = 10_000


def fit_dummies(df: DataFrame, cols: Sequence[str], max_levels: int | None = None,
                cap: int = DUMMY_LEVEL_CAP) -> dict[str, list[str]]:
    """Sorted levels per column; with ``max_levels`` wider columns are left out (E2 rule).

    Level counts are always measured first, so only columns within the bound
    have their values collected: at most ``max_levels`` each, and never more
    than ``cap`` (a column with more levels cannot become dummy columns; it is
    refused instead of being pulled through the driver).
    """
    cols = list(cols)
    counts = level_counts(df, cols)
    if max_levels is not None:
        cols = [c for c in cols if counts[c] <= max_levels]
    too_wide = [c for c in cols if counts[c] > cap]
    if too_wide:
        raise ValueError(f"columns {too_wide} have more than {cap} levels; use label_encode instead")
    if not cols:
        return {}
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in _distinct_levels(df, cols).collect():
        levels[r["col"]].append(r["value"])
    return {c: sorted(v) for c, v in levels.items()}


def apply_dummies(df: DataFrame, levels: Mapping[str, Sequence[str]], drop_source: bool = True,
                  sep: str = "_", dtype: str = "int") -> DataFrame:
    """One 0/1 column per fitted level in ONE projection; null input -> null indicators."""
    new_cols = []
    for c, vals in levels.items():
        for v, name in zip(vals, dummy_names(vals)):
            new_cols.append((F.col(c).cast("string") == F.lit(v)).cast(dtype).alias(f"{c}{sep}{name}"))
    keep = [F.col(c) for c in df.columns if not (drop_source and c in levels)]
    return df.select(*keep, *new_cols)


def onehot(df: DataFrame, max_levels: int = 10, cols: Sequence[str] | None = None, dtype: str = "double") -> DataFrame:
    """Encode all string columns with <= ``max_levels`` levels, drop the wider ones."""
    cols = list(cols) if cols is not None else string_columns(df)
    levels = fit_dummies(df, cols, max_levels)
    dropped = [c for c in cols if c not in levels]
    return apply_dummies(df.drop(*dropped), levels, dtype=dtype)


def ints_as_category(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """E5: integer columns become string categories (then E3 applies)."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols})
