"""Column selectors and whole-frame projections.

Column *selection* is decided on the driver from ``df.schema`` (bounded by the
number of columns); the data work is always one ``select``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FLOATING = (T.FloatType, T.DoubleType)


def regex_columns(df: DataFrame, pattern: str) -> list[str]:
    """Columns whose name matches a Python regex anywhere (``str_subset`` semantics, P3)."""
    rx = re.compile(pattern)
    return [c for c in df.columns if rx.search(c)]


def columns_of_type(df: DataFrame, *types) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [c for c in columns_of_type(df, *NUMERIC) if c not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [c for c in columns_of_type(df, T.StringType) if c not in ex]


def exclude(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns in a set (P4/P5/M8).  An empty list drops nothing (unlike R's ``-integer(0)``)."""
    drop = set(cols)
    return df.select(*[F.col(c) for c in df.columns if c not in drop]) if drop else df


def prefix_rename(df: DataFrame, prefix: str, keys: Sequence[str] = ()) -> DataFrame:
    """Prefix every non-key column."""
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in set(keys)})


def map_columns(df: DataFrame, fn: Callable[[Column, str], Column], cols: Iterable[str] | None = None) -> DataFrame:
    """Apply ``fn`` to chosen columns (all by default) in ONE projection."""
    chosen = set(df.columns if cols is None else cols)
    return df.select(*[(fn(F.col(c), c).alias(c) if c in chosen else F.col(c)) for c in df.columns])


def map_floating(df: DataFrame, fn: Callable[[Column, str], Column]) -> DataFrame:
    return map_columns(df, fn, columns_of_type(df, *FLOATING))


def column_difference(a: DataFrame | Sequence[str], b: DataFrame | Sequence[str]) -> list[str]:
    """``setdiff(colnames(a), colnames(b))`` in a's order."""
    ac = a.columns if isinstance(a, DataFrame) else list(a)
    bc = set(b.columns if isinstance(b, DataFrame) else b)
    return [c for c in ac if c not in bc]


def free_name(columns: Sequence[str], base: str) -> str:
    """``base``, lengthened until no column (in any case) has that name."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base
