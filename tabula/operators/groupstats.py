"""Category / group statistics joined back onto detail rows.

Semantically ``agg(x) OVER (PARTITION BY keys)``, but built as a grouped
aggregation plus a null-safe left join: the statistics table has one row per
key combination (low cardinality by construction), so after a measured size
check it is broadcast and the wide detail table is never shuffled.  A window
would shuffle every detail column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.functions.aggregates import agg_expr
from tabula.operators.joins import WIDE_ROW, keys_in, left_join_null_safe, packed


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def category_stats(df: DataFrame, keys, cols: Sequence[str] | None = None,
                   fns: Sequence[str] = ("mean",), nulls: str = "propagate",
                   prefix: str = "") -> DataFrame:
    """``group_by(keys) %>% summarise_all(fns)``, outputs renamed ``prefix + name``.

    With one function the output keeps the column name (``summarise_all(mean)``);
    with several it is ``<col>_<fn>``.
    """
    keys = _keys(keys)
    cols = [c for c in (cols if cols is not None else df.columns) if c not in keys]
    exprs = []
    for c in cols:
        for fn in fns:
            name = c if len(fns) == 1 else f"{c}_{fn}"
            exprs.append(agg_expr(fn, c, nulls).alias(prefix + name))
    return df.groupBy(*keys).agg(*exprs)


def add_category_stats(df: DataFrame, keys, cols: Sequence[str] | None = None,
                       fns: Sequence[str] = ("mean",), nulls: str = "propagate", prefix: str = "",
                       drop: Sequence[str] = (), small: bool | None = None) -> DataFrame:
    """Category statistics joined back by the (null-safe) keys; ``drop`` removes named outputs."""
    stats = category_stats(df, keys, cols, fns, nulls, prefix)
    if drop:
        stats = stats.drop(*drop)
    return left_join_null_safe(df, stats, _keys(keys), right_small=small)


def group_stats(df: DataFrame, keys, named: Mapping[str, Column]) -> DataFrame:
    """Named aggregate expressions by keys (A9/A10), e.g. ``{'age_sex_credit': F.avg('x')}``."""
    return df.groupBy(*_keys(keys)).agg(*[e.alias(n) for n, e in named.items()])


def add_group_stats(df: DataFrame, keys, named: Mapping[str, Column], small: bool | None = None) -> DataFrame:
    return left_join_null_safe(df, group_stats(df, keys, named), _keys(keys), right_small=small)


def add_group_blocks(df: DataFrame, blocks: Sequence[tuple[Sequence[str], Mapping[str, Column]]]) -> DataFrame:
    """Several ``add_group_stats`` at once; every block is aggregated from ``df`` itself, so no
    statistics table repeats the joins of the blocks before it."""
    tables = [(_keys(keys), group_stats(df, keys, named)) for keys, named in blocks]
    wide = len(df.columns) > WIDE_ROW
    out = packed(df, list(dict.fromkeys(k for keys, _ in tables for k in keys))) if wide else df
    for keys, stats in tables:
        out = left_join_null_safe(out, stats, keys)
    if not wide:
        return out
    return out.select("__packed.*", *[c for keys, stats in tables for c in stats.columns if c not in keys])


def mean_stats(prefix: str, exprs: Mapping[str, Column], with_var: bool = False,
               nulls: str = "propagate") -> dict[str, Column]:
    """``{prefix+name: mean(expr)}`` (+ ``_var`` twins) with the reference's null propagation."""
    out: dict[str, Column] = {}
    for name, e in exprs.items():
        out[prefix + name] = agg_expr("mean", e, nulls)
        if with_var:
            out[prefix + name + "_var"] = agg_expr("var", e, nulls)
    return out


def median_lookup(df: DataFrame, key: str, value: str, out: str, nulls: str = "propagate") -> DataFrame:
    """Per-category median joined back as a new column (A11 + J5 ``recode``).

    The lookup table has one row per category; its size is measured before
    it is broadcast (``left_join_null_safe``).  Categories above ``HOT_ROWS``
    rows get ``quantile.exact_median`` instead of Spark's per-group value map.
    The null category is a category like any other, also when it is hot.
    """
    from tabula.operators.bundles import HOT_ROWS, hot_keys
    from tabula.operators.quantile import exact_median

    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    hot = hot_keys(sizes, [key], "__rows", HOT_ROWS)
    if hot is None:
        med = df.groupBy(key).agg(agg_expr("median", value, nulls).alias(out))
    else:
        # categories are few but large: those above HOT_ROWS get the exact distributed median
        normal = keys_in(df, hot, [key], "left_anti").groupBy(key).agg(agg_expr("median", value, nulls).alias(out))
        heavy = keys_in(df, hot, [key], "left_semi")
        m = exact_median(heavy, [key], value, out)
        if nulls == "propagate":
            flags = heavy.groupBy(key).agg(F.max(F.col(value).isNull().cast("int")).alias("__null"))
            m = left_join_null_safe(flags, m, [key]).select(key, F.when(F.col("__null") == 0, F.col(out)).alias(out))
        med = normal.unionByName(m)
    if len(df.columns) <= WIDE_ROW:
        return left_join_null_safe(df, med, [key])
    return left_join_null_safe(packed(df, [key]), med, [key]).select("__packed.*", out)
