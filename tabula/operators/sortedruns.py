"""The canonical bundle over rows that arrive sorted by key (A1, A2).

A roll-up of fifty columns keeps several hundred aggregate buffers and fifty hash sets a group inside Catalyst,
and every row touches all of them.  Here a task gets the rows of its keys sorted by key, as Arrow batches; groups
of equal size lie side by side as one (columns, groups, rows) array and every column is sorted within its groups:
minimum and maximum are the ends, distinct values the steps.  Sums and variances take the rows in their order, one
of each group at a time.

Held in a task: the rows of about ``CELLS`` cells, or of one group if that is larger.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Cells (rows times columns) that are aggregated at once.
CELLS = 2_000_000

FUNCTIONS = ("mean", "var", "sd", "min", "max", "sum", "n_distinct")
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTION = (T.FloatType, T.DoubleType)
_KEYS = (*_WHOLE, T.StringType, T.BooleanType, T.DateType, T.TimestampType)


def fits(df: DataFrame, keys: Sequence[str], cols: Sequence[str], fns: Sequence[str], nulls: str) -> bool:
    """Whether the bundle can be computed here: numeric columns, keys equal exactly if their values are, nulls propagated."""
    return (nulls == "propagate" and bool(cols) and set(fns) <= set(FUNCTIONS)
            and all(isinstance(df.schema[c].dataType, _WHOLE + _FRACTION) for c in cols)
            and all(type(df.schema[k].dataType) in _KEYS and getattr(df.schema[k].dataType, "collation", "UTF8_BINARY") == "UTF8_BINARY"
                    for k in keys))


def _starts(keys: Sequence[pa.Array]) -> np.ndarray:
    """Where the groups of the sorted keys begin; null is a key like any other."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        if n > 1:
            differ = pc.not_equal(k[1:], k[:-1]).fill_null(False).to_numpy(zero_copy_only=False)
            void = pc.is_null(k).to_numpy(zero_copy_only=False)
            new[1:] |= differ | (void[1:] != void[:-1])
    return np.flatnonzero(new)


def _steps(x: np.ndarray, kind: str, n_null: np.ndarray) -> np.ndarray:
    """Distinct values of sorted groups (last axis); null is one more."""
    size = x.shape[-1]
    step = x[..., 1:] != x[..., :-1]
    if kind == "f" and np.isnan(x[..., -1]).any():                   # nulls were put there as NaN
        nan = np.isnan(x)
        n_nan = nan.sum(-1)
        return (step & ~nan[..., 1:]).sum(-1) + ~nan[..., 0] + (n_nan > n_null) + (n_null > 0)
    if kind == "i" and n_null.any():                                 # nulls are the last ones
        valid = size - n_null[..., None]
        return (step & (np.arange(1, size) < valid)).sum(-1) + (valid[..., 0] > 0) + (n_null > 0)
    return step.sum(-1) + 1


def _running(x: np.ndarray, starts: np.ndarray, sizes: np.ndarray, spread: bool) -> tuple[np.ndarray, np.ndarray]:
    """(sums, squared deviations) of the groups' rows (rows x columns), row by row as Spark's own aggregates take them.

    ``sizes`` falls: step j takes the j-th row of all groups that have one.
    """
    total = np.zeros((len(starts), x.shape[1]))
    mean, m2 = np.zeros_like(total), np.zeros_like(total)
    left = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")        # groups with more than j rows
    for j, m in enumerate(left.tolist()):
        row = x[starts[:m] + j]
        total[:m] += row
        if spread:
            delta = row - mean[:m]
            part = delta / (j + 1)
            mean[:m] += part
            m2[:m] += delta * (delta - part)
    return total, m2


def _ordered(x: np.ndarray, kind: str, n_null: np.ndarray, fns: Sequence[str]) -> dict[str, np.ndarray]:
    """The functions of the sorted values of a (columns, groups, rows) array, which is sorted in place."""
    x.sort(axis=-1)
    out = {"min": x[..., 0], "max": x[..., -1]}
    if "n_distinct" in fns:
        out["n_distinct"] = _steps(x, kind, n_null)
    if "sum" in fns and kind == "i":
        out["sum"] = x.sum(-1)
        far = (n_null == 0) & (np.abs(x.sum(-1, dtype=float)) > 2.0 ** 62)
        if any(not -2 ** 63 <= sum(map(int, group)) < 2 ** 63 for group in x[far]):
            raise ArithmeticError("the sum of a long column does not fit a long")
    return out


def _filled(column: pa.Array, kind: str) -> np.ndarray:
    if kind == "f":
        return column.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    return column.cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def _groups(table: pa.Table, n_keys: int, kinds: Sequence[str], wanted: Sequence[tuple[int, str]], schema: pa.Schema):
    """One batch for a set of whole groups; ``wanted``: (column, function) of each output column after the keys."""
    keys = [table.column(i).combine_chunks() for i in range(n_keys)]
    starts = _starts(keys)
    sizes = np.diff(np.append(starts, table.num_rows))
    order = np.argsort(-sizes, kind="stable")                         # groups of equal size side by side
    starts, sizes = starts[order], sizes[order]
    bounds = np.flatnonzero(np.diff(sizes, prepend=-1, append=-1))
    outputs: dict = {}
    for kind in sorted(set(kinds)):
        at = [i for i, k in enumerate(kinds) if k == kind]
        fns = {f for i, f in wanted if i in at}
        columns = [table.column(n_keys + i).combine_chunks() for i in at]
        x = np.stack([_filled(c, kind) for c in columns])
        n_null = np.zeros((len(at), len(starts)), np.int64)
        if any(c.null_count for c in columns):
            void = np.stack([c.is_null().to_numpy(zero_copy_only=False) for c in columns]).astype(np.int64)
            in_order = np.argsort(starts)
            n_null[:, in_order] = np.add.reduceat(void, starts[in_order], axis=1)
        found: dict = {}
        if fns & {"min", "max", "n_distinct"} or "sum" in fns and kind == "i":
            parts = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                rows = starts[a:b, None] + np.arange(sizes[a])
                parts.append(_ordered(x[:, rows], kind, n_null[:, a:b], fns))
            found = {fn: np.concatenate([p[fn] for p in parts], axis=1) for fn in parts[0]}
        with np.errstate(all="ignore"):
            if fns & {"mean", "var", "sd", "sum"}:
                total, m2 = _running(np.ascontiguousarray(x.T, dtype=float), starts, sizes, bool(fns & {"var", "sd"}))
                found.setdefault("sum", total.T)
                found["mean"] = total.T / sizes
                found["var"] = m2.T / np.maximum(sizes - 1, 1)
                found["sd"] = np.sqrt(found["var"])
        for row, i in enumerate(at):
            gone = n_null[row] > 0
            for fn in fns:
                outputs[i, fn] = found[fn][row], None if fn == "n_distinct" else gone | (sizes < 2) if fn in ("var", "sd") else gone
    first = pa.array(starts)
    arrays = [k.take(first) for k in keys]
    for i, fn in wanted:
        values, gone = outputs[i, fn]
        arrays.append(pa.array(np.ascontiguousarray(values), mask=gone, from_pandas=False))
    return pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)


def _kernel(n_keys: int, kinds: Sequence[str], wanted: Sequence[tuple[int, str]], schema: pa.Schema):
    rows_at_once = max(1, CELLS // len(kinds))

    def run(batches):
        held, n, due = [], 0, rows_at_once
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < due:
                continue
            table = pa.Table.from_batches(held)
            last = int(_starts([table.column(i).combine_chunks() for i in range(n_keys)])[-1])
            if last:
                yield _groups(table.slice(0, last), n_keys, kinds, wanted, schema)
                held = table.slice(last).to_batches()
                n -= last
                due = rows_at_once
            due = max(due, 2 * n)                                      # a group that is larger than all that
        if n:
            yield _groups(pa.Table.from_batches(held), n_keys, kinds, wanted, schema)
    return run


def bundle(df: DataFrame, keys: Sequence[str], wanted: Sequence[tuple[str, str]]) -> DataFrame:
    """(keys, ``<col>_<fn>`` for each wanted pair): the rows are shuffled by key once and sorted in their tasks."""
    cols = list(dict.fromkeys(c for c, _ in wanted))
    kinds = ["f" if isinstance(df.schema[c].dataType, _FRACTION) else "i" for c in cols]
    types = {"n_distinct": lambda t: T.LongType(), "min": lambda t: t, "max": lambda t: t,
             "sum": lambda t: T.LongType() if isinstance(t, _WHOLE) else T.DoubleType()}
    fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    fields += [T.StructField(f"{c}_{fn}", types.get(fn, lambda t: T.DoubleType())(df.schema[c].dataType)) for c, fn in wanted]
    schema = T.StructType(fields)
    numbers = [(cols.index(c), fn) for c, fn in wanted]
    rows = df.select(*keys, *cols).repartition(*keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(_kernel(len(keys), kinds, numbers, to_arrow_schema(schema)), schema)
