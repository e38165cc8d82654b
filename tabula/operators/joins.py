"""Joins (J1-J6) and the size check that guards every broadcast.

Broadcasting is only done for a side whose size was *measured*: the side is
kept, measured (rows and the length of its strings), and broadcast only when
that stays under a byte budget; otherwise the plain (shuffled sort-merge) join is used and AQE
may still switch strategy at runtime from real shuffle statistics.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.session import keep

BROADCAST_BYTES = 64 * 1024 * 1024


def _row_width(df: DataFrame) -> int:
    """Bytes per row of the fixed-width part: 8 per field and 16 for the row."""
    return 8 * len(df.schema.fields) + 16


def _measured_bytes(df: DataFrame) -> int:
    """Rows times fixed width plus the measured length of strings, binaries and nested values."""
    loose = [f.name for f in df.schema.fields
             if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))]
    length = sum((F.coalesce(F.length(c) if isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType))
                             else F.length(F.to_json(F.struct(c))), F.lit(0)) for c in loose), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(length), F.lit(0)).alias("b")).first()
    return int(row["n"]) * _row_width(df) + 4 * int(row["b"])


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Return ``(broadcast(df), True)`` if its measured size fits, else ``(df, False)``.

    ``df`` is persisted (memory and disk, recomputable from lineage if an
    executor is lost) so counting it does not recompute it for the join.
    """
    df = keep(df)
    if _measured_bytes(df) <= max_bytes:
        return F.broadcast(df), True
    return df, False


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                        right_small: bool | None = None) -> DataFrame:
    """Left join matching null keys to null keys (N4; J3/J4/J5).

    ``right_small=True`` asserts a fixed bound (e.g. a stats table over a
    fixed set of bins) and broadcasts directly; ``None`` measures it.
    """
    keys = list(keys)
    renamed = right.withColumnsRenamed({k: f"__rk_{i}" for i, k in enumerate(keys)})
    if right_small is None:
        renamed, _ = checked_broadcast(renamed)
    elif right_small:
        renamed = F.broadcast(renamed)
    cond = None
    for i, k in enumerate(keys):
        term = left[k].eqNullSafe(renamed[f"__rk_{i}"])
        cond = term if cond is None else cond & term
    out = left.join(renamed, cond, "left")
    return out.drop(*[f"__rk_{i}" for i in range(len(keys))])


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``right`` with its keys renamed, and the condition that matches null keys to null keys."""
    right = right.withColumnsRenamed({k: f"__rk_{i}" for i, k in enumerate(keys)})
    return right, reduce(Column.__and__, [left[k].eqNullSafe(right[f"__rk_{i}"]) for i, k in enumerate(keys)])


def keys_in(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join by keys, null being a key like any other."""
    renamed, on = null_safe_on(df, other.select(*keys), keys)
    return df.join(renamed, on, how)


#: Columns from which a row travels through a chain of joins as one struct.
WIDE_ROW = 100


def packed(df: DataFrame, apart: Sequence[str], name: str = "__packed") -> DataFrame:
    """``apart`` and all columns as one struct ``name``.

    A join copies its rows column by column; through several joins in a row that is a projection
    of all columns (compiled and run) for each of them, of a struct it is one copy.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name), *apart)


def rollup_join(base: DataFrame, rollups: Sequence[DataFrame], key: str) -> DataFrame:
    """``base ⟕ r1 ⟕ r2 ...`` on one entity key (J1, entity merge).

    A roll-up that leaves its aggregation hash-partitioned on ``key`` is not
    shuffled again; AQE turns a roll-up into a broadcast at runtime when it is
    small.  Wide rows are joined as one struct per table.
    """
    if len(base.columns) + sum(len(r.columns) for r in rollups) <= WIDE_ROW:
        out = base
        for r in rollups:
            out = out.join(r, key, "left")
        return out
    out = packed(base, [key], "__p")
    for i, r in enumerate(rollups):
        out = out.join(packed(r, [key], f"__p{i}"), key, "left")
    taken = [(f"__p{i}", c) for i, r in enumerate(rollups) for c in r.columns if c != key]
    return out.select(key, *[F.col(f"__p.`{c}`") for c in base.columns if c != key], *[F.col(f"{p}.`{c}`") for p, c in taken])


def align_on_key(frames: dict[str, DataFrame], key: str, value: str, missing: str = "error") -> DataFrame:
    """Key-aligned column bind of several (key, value) frames.

    Replaces the reference's positional ``data.frame(t1$v, t2$v, ...)``: all
    frames go through ONE aggregation by key, output column per frame name.
    A key that is absent from a frame, or there twice, fails the query
    (``missing='error'``); ``'keep'`` leaves nulls, ``'drop'`` the complete keys.
    """
    long = None
    for name, f in frames.items():
        part = f.select(F.col(key), F.lit(name).alias("__src"), F.col(value).alias("__v"))
        long = part if long is None else long.unionByName(part)
    seen = [F.sum((F.col("__src") == n).cast("int")) for n in frames]
    out = long.groupBy(key).agg(*[F.max(F.when(F.col("__src") == n, F.col("__v"))).alias(n) for n in frames],
                                F.array(*seen).alias("__seen"))
    once = F.forall("__seen", lambda n: n == 1)
    if missing == "error":
        message = F.concat(F.lit(f"{key} "), F.coalesce(F.col(key).cast("string"), F.lit("null")),
                           F.lit(f" is not exactly once in each of {list(frames)}"))
        out = out.where(F.when(once, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    elif missing == "drop":
        out = out.where(once)
    return out.drop("__seen")
