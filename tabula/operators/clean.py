"""Row filters and cell cleaning.

All are single projections / filters; Catalyst pushes the ``!=`` filters of
``filter_not_equal`` into the parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.functions.columns import FLOATING, columns_of_type, map_columns, string_columns
from tabula.functions.scalars import non_finite_to_null


def filter_not_equal(df: DataFrame, conditions: Mapping[str, object]) -> DataFrame:
    """``df[df$c != v, ]`` for every (c, v); rows whose comparison is null are dropped."""
    cond = None
    for c, v in conditions.items():
        term = F.col(c) != F.lit(v)
        cond = term if cond is None else cond & term
    return df if cond is None else df.filter(cond)


def null_out(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Sentinel cleaning (F2): ``{col: condition}`` sets the column null where the condition holds.

    Conditions are evaluated on the *input* row, so rules do not see each
    other's nulls.
    """
    return map_columns(df, lambda c, name: F.when(rules[name], F.lit(None)).otherwise(c), list(rules))


def fill_category(df: DataFrame, value: str = "nadata", cols: Sequence[str] | None = None) -> DataFrame:
    """Replace null strings with a category."""
    return df.fillna(value, subset=list(cols) if cols is not None else string_columns(df))


def fill_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Replace numeric nulls with 0."""
    return df.fillna(0, subset=list(cols)) if cols is not None else df.fillna(0)


def dropna_any(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any null."""
    return df.dropna(how="any", subset=cols)


def clean_non_finite(df: DataFrame, cols: Sequence[str] | None = None, by_batch: bool = False) -> DataFrame:
    """NaN / +-Inf -> null on floating columns.

    ``by_batch``: whole Arrow columns at a time instead of an expression for each column, whose generated
    code is too large to be compiled for hundreds of columns; for tables that are written next, since all
    columns are computed whichever are read.
    """
    targets = columns_of_type(df, *FLOATING) if cols is None else cols
    if by_batch:
        chosen = set(targets)

        def run(batches):
            for batch in batches:
                columns = []
                for name, c in zip(batch.schema.names, batch.columns):
                    if name in chosen:
                        finite = pc.is_finite(c)
                        c = c if pc.all(finite).as_py() in (True, None) else pc.if_else(finite, c, pa.scalar(None, c.type))
                    columns.append(c)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
        return df.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]))
    return map_columns(df, lambda c, _: non_finite_to_null(c), targets)


def select_split(df: DataFrame, split: str, col: str = "split") -> DataFrame:
    """Row subset by membership flag."""
    return df.filter(F.col(col) == F.lit(split))
