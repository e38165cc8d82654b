"""Entity roll-ups with aggregate bundles.

``rollup`` is ``group_by(keys) %>% summarise_all(bundle)``: output
``<col>_<fn>``.  Physical shape:

* groups are split by their size, which one count per key measures first:
  - the rows of groups up to ``hot_rows`` rows are shuffled by key as they
    are and aggregated in the task of their key, distinct counts as
    ``size(collect_set(c))``, so each set is bounded by ``hot_rows`` values;
    the rows are narrower than their partial aggregates, of which nearly
    every row would have its own; numeric columns under the canonical functions
    are aggregated from rows sorted by key (``sortedruns``);
  - hot groups (a key may hold a third of all rows): values with partial
    aggregation, and a narrow long form
    (key, column index, value) is de-duplicated with a shuffle on all three,
    so the hot key is spread over every reducer by value, then counted per
    (key, column) with partial aggregation, pivoted back and joined on the key.
  Catalyst's own multi-distinct rewrite (Expand of the wide row once per
  distinct column) was ~4x slower than either path here;
* ``median`` (Spark's ``percentile``, a value map per group) is bounded the
  same way: when a bundle has a median, a count-per-key pass finds the hot
  keys first; their groups get ``quantile.exact_median`` (iterative
  quantile-bucket narrowing, distributed) and are unioned with the normal
  groups.

``nested_rollup`` rolls a grandchild up to the child, joins it to the child
and rolls the child up to the parent, giving ``<col>_<f1>_<f2>`` names.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.functions.aggregates import BUNDLES, agg_expr, bundle_exprs
from tabula.operators import sortedruns
from tabula.operators.joins import checked_broadcast, keys_in, left_join_null_safe
from tabula.operators.quantile import exact_median
from tabula.session import keep


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _is_pruned(c: str, fn: str, prune) -> bool:
    import re
    return any(re.search(p, c) and fn in fs for p, fs in (prune or {}).items())


HOT_ROWS = 200_000


def _value_key(df: DataFrame, c: str):
    """Distinctness key: the value itself; -0.0 counts as 0.0."""
    dt = df.schema[c].dataType
    return F.col(c) + F.lit(0.0).cast(dt) if isinstance(dt, (T.FloatType, T.DoubleType)) else F.col(c)


def _melted_distinct(df: DataFrame, keys: Sequence[str], cols: Sequence[str], nulls: str) -> DataFrame:
    """Skew-safe exact distinct counts: melt -> distinct -> count -> pivot (wide, one row per key)."""
    # one long form per type: values are never cast, so both paths count alike
    by_type: dict[str, list[int]] = {}
    for i, c in enumerate(cols):
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(i)
    parts = []
    for group in by_type.values():
        melted = df.select(*keys, F.explode(F.array(*[
            F.struct(F.lit(i).alias("__i"), _value_key(df, cols[i]).alias("__v")) for i in group
        ])).alias("__kv")).select(*keys, "__kv.__i", "__kv.__v")
        if nulls != "propagate":
            melted = melted.where(F.col("__v").isNotNull())
        parts.append(melted.distinct().groupBy(*keys, "__i").agg(F.count(F.lit(1)).alias("__n")))
    long = reduce(DataFrame.unionByName, parts)
    # pivot over the known index list: no extra pass to discover pivot values
    wide = long.groupBy(*keys).pivot("__i", list(range(len(cols)))).agg(F.first("__n"))
    return wide.select(*keys, *[F.coalesce(F.col(str(i)), F.lit(0)).alias(f"__nd{i}") for i in range(len(cols))])


def _set_exprs(df: DataFrame, cols: Sequence[str], nulls: str, suffix: str = "_n_distinct"):
    """Distinct counts via map-side de-duplicated sets; only for groups of bounded size."""
    exprs = []
    for c in cols:
        n = F.size(F.collect_set(_value_key(df, c)))
        if nulls == "propagate":
            n = n + F.max(F.col(c).isNull().cast("int"))
        exprs.append(n.cast("long").alias(c + suffix))
    return exprs


def hot_keys(sizes: DataFrame, keys: Sequence[str], rows_col: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys whose group has more than ``hot_rows`` rows, as a measured broadcastable table, or None.

    ``sizes`` is a per-key table with a row count (the value aggregation
    already has it).  There are at most rows / hot_rows hot keys; the table
    is broadcast only after its size is checked.
    """
    hot, _ = checked_broadcast(sizes.where(F.col(rows_col) > hot_rows).select(*keys))
    return hot if hot.take(1) else None


def distinct_counts(df: DataFrame, keys: Sequence[str], cols: Sequence[str], nulls: str = "propagate",
                    hot: DataFrame | None = None, suffix: str = "_n_distinct") -> DataFrame:
    """Exact per-group distinct counts of many columns.

    ``hot`` (a small key table) selects the groups that take the skew-safe
    melted path; all other groups use bounded sets.  With
    ``nulls='propagate'`` a null counts as one more distinct value (R's
    ``n_distinct`` without ``na.rm``).
    """
    keys = list(keys)
    if hot is None:
        return df.groupBy(*keys).agg(*_set_exprs(df, cols, nulls, suffix))
    normal = keys_in(df, hot, keys, "left_anti").groupBy(*keys).agg(*_set_exprs(df, cols, nulls, suffix))
    melted = _melted_distinct(keys_in(df, hot, keys, "left_semi"), keys, cols, nulls)
    melted = melted.select(*keys, *[F.col(f"__nd{i}").cast("long").alias(c + suffix) for i, c in enumerate(cols)])
    return normal.unionByName(melted)


def _order(keys, cols, fns, prune, nd_cols) -> list[str]:
    """The bundle's column order: per column, functions in bundle order."""
    return list(keys) + [f"{c}_{fn}" for c in cols for fn in fns
                         if not _is_pruned(c, fn, prune) and (fn != "n_distinct" or c in nd_cols)]


def _hot_rollup(heavy: DataFrame, keys, fns, nulls, cols, prune) -> DataFrame:
    """Roll-up of the hot groups only: exact distributed medians, melted distinct counts."""
    rest = [f for f in fns if f != "median"]
    out = rollup(heavy, keys, rest, nulls, cols, prune=prune, hot_rows=0, _sized=True) if rest else \
        heavy.select(*keys).distinct()
    med_cols = [c for c in cols if not _is_pruned(c, "median", prune)]
    if med_cols:
        flags = heavy.groupBy(*keys).agg(*[F.max(F.col(c).isNull().cast("int")).alias(f"__null_{c}")
                                           for c in med_cols])
        out = left_join_null_safe(out, flags, keys, right_small=False)
        for c in med_cols:
            out = left_join_null_safe(out, exact_median(heavy, keys, c, f"{c}_median"), keys, right_small=False)
            if nulls == "propagate":       # a group containing a null has a null median
                out = out.withColumn(f"{c}_median", F.when(F.col(f"__null_{c}") == 0, F.col(f"{c}_median")))
    return out


def rollup(df: DataFrame, keys, fns: Sequence[str] | str = "canonical", nulls: str = "propagate",
           cols: Sequence[str] | None = None, exclude: Sequence[str] = (),
           prune: Mapping[str, Sequence[str]] | None = None, hot_rows: int = HOT_ROWS,
           _sized: bool = False) -> DataFrame:
    keys = _keys(keys)
    fns = BUNDLES[fns] if isinstance(fns, str) else list(fns)
    skip = set(keys) | set(exclude)
    cols = [c for c in (cols if cols is not None else df.columns) if c not in skip]
    nd_all = [c for c in cols if "n_distinct" in fns and not _is_pruned(c, "n_distinct", prune)]
    if "median" in fns and not _sized:
        # Spark's median keeps a value map per group: hot groups are measured first
        # (one count per key) and get the exact distributed median instead
        df = keep(df)
        hot = hot_keys(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")), keys, "__rows", hot_rows)
        if hot is not None:
            normal = rollup(keys_in(df, hot, keys, "left_anti"), keys, fns, nulls, cols, prune=prune,
                            hot_rows=hot_rows, _sized=True)
            heavy = _hot_rollup(keys_in(df, hot, keys, "left_semi"), keys, fns, nulls, cols, prune)
            order = _order(keys, cols, fns, prune, nd_all)
            return normal.select(*order).unionByName(heavy.select(*order))
    value_fns = [f for f in fns if f != "n_distinct"]
    value_exprs = bundle_exprs(cols, value_fns, nulls, prune)
    nd_cols = [c for c in cols if "n_distinct" in fns and not _is_pruned(c, "n_distinct", prune)]
    # one narrow count per key finds the hot groups; the rows of all others go to the task of their key once,
    # where one aggregation makes values and distinct counts (partial aggregates would be a row of many
    # columns for nearly every input row, and the two results would have to be joined)
    order = _order(keys, cols, fns, prune, nd_cols)
    hot = hot_keys(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")), keys, "__rows", hot_rows)
    normal = df if hot is None else keys_in(df, hot, keys, "left_anti")
    if sortedruns.fits(df, keys, cols, fns, nulls):
        normal = sortedruns.bundle(normal, keys, [(c, fn) for c in cols for fn in fns if not _is_pruned(c, fn, prune)])
    else:
        normal = normal.repartition(*keys).groupBy(*keys).agg(*value_exprs, *_set_exprs(df, nd_cols, nulls)).select(*order)
    if hot is None:
        return normal
    # hot groups: values with partial aggregation (there are few rows of partial aggregates), melted distinct counts
    heavy = keys_in(df, hot, keys, "left_semi")
    if not nd_cols:
        return normal.unionByName(heavy.groupBy(*keys).agg(*value_exprs).select(*order))
    heavy = keep(heavy)
    main = heavy.groupBy(*keys).agg(*value_exprs, F.count(F.lit(1)).alias("__rows")).drop("__rows")
    melted = _melted_distinct(heavy, keys, nd_cols, nulls)
    melted = melted.select(*keys, *[F.col(f"__nd{i}").cast("long").alias(c + "_n_distinct") for i, c in enumerate(nd_cols)])
    return normal.unionByName(left_join_null_safe(main, melted, keys, right_small=False).select(*order))


def nested_rollup(grandchild: DataFrame, child: DataFrame, child_key: str, parent_key: str,
                  fns_inner: Sequence[str] | str = "canonical", fns_outer: Sequence[str] | str = "canonical",
                  nulls: str = "propagate", child_exclude: Sequence[str] = (),
                  inner_map: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """grandchild -> child roll-up, left-joined to the child, then child -> parent roll-up.

    ``child`` must carry ``child_key`` and ``parent_key``; the child key
    itself is not aggregated (the reference drops the child id).  ``inner_map``
    is applied to the inner roll-up, e.g. to round computed doubles before the
    outer bundle counts their distinct values.
    """
    inner = rollup(grandchild, child_key, fns_inner, nulls)
    if inner_map is not None:
        inner = inner_map(inner)
    joined = child.join(inner, child_key, "left").drop(child_key)
    return rollup(joined, parent_key, fns_outer, nulls, exclude=child_exclude)


__all__ = ["rollup", "nested_rollup", "distinct_counts", "agg_expr"]
