"""One-scan moments, Gram tiles, truncated SVD and alternating completion against numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabula.operators import bundles, clean, encode, groupstats, impute, joins, moments, partials, reduce, selection, sortedruns


def frame(spark, x, parts=4):
    """(id, c0, c1, ...) with null for NaN."""
    cols = [f"c{j}" for j in range(x.shape[1])]
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in cols)).repartition(parts, "id"), cols


def holey(rng, n, p):
    x = rng.normal(size=(n, p)) + 1e6 * np.arange(p)        # large offsets
    x[:, 2] = 0.1                                           # constant
    x[:, 5] = x[:, 4] * 2 + 0.01 * rng.normal(size=n)
    x[rng.random((n, p)) < 0.3] = np.nan
    x[:, 7] = np.nan                                        # no value at all
    return x


def test_pair_moments_equal_the_rows_where_both_are_there(spark):
    x = holey(np.random.default_rng(0), 300, 9)
    df, cols = frame(spark, x)
    got = {(r["col_a"], r["col_b"]): r for r in moments.pair_moments(df, cols).collect()}
    assert len(got) == 36
    for i in range(9):
        for j in range(i + 1, 9):
            r = got[cols[i], cols[j]]
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert r["n"] == both.sum()
            if {i, j} & {2, 7}:
                assert r["corr"] is None and (r["cov"] is None) == (7 in (i, j))
            else:
                assert r["corr"] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
                assert r["cov"] == pytest.approx(np.cov(x[both, i], x[both, j], bias=True)[0, 1], rel=1e-6, abs=1e-9)


def test_one_scan_equals_the_aggregation(spark):
    df, cols = frame(spark, holey(np.random.default_rng(1), 200, 9))
    one, many = [{(r["col_a"], r["col_b"]): r["corr"] for r in selection.correlation_long(df, cols, wide=w).collect()} for w in (0, 9)]
    assert one.keys() == many.keys()
    for pair, corr in one.items():
        assert corr == pytest.approx(many[pair], abs=1e-9) if corr is not None else many[pair] is None
    assert selection.correlation_long(df.limit(0), cols, wide=0).count() == 0


def test_wide_tables_with_nulls_are_read_once(spark):
    rng = np.random.default_rng(2)
    p, n = 600, 60                                          # three by three tiles
    x = rng.normal(size=(n, p))
    x[rng.random((n, p)) < 0.1] = np.nan
    df = spark.createDataFrame([(list(map(float, r)),) for r in x], "v array<double>").repartition(3)
    wide = df.select(*[F.nanvl(F.col("v")[j], F.lit(None).cast("double")).alias(f"c{j}") for j in range(p)])
    out = selection.correlation_long(wide, wide.columns)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1
    some = {("c3", "c599"), ("c255", "c256"), ("c0", "c1"), ("c511", "c513")}
    rows = out.toPandas()
    assert len(rows) == p * (p - 1) // 2
    corr = dict(zip(zip(rows["col_a"], rows["col_b"]), rows["corr"]))
    for a, b in some:
        i, j = int(a[1:]), int(b[1:])
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert corr[a, b] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_gram_tiles_equal_the_product(spark):
    x = np.random.default_rng(3).normal(size=(50, 300))
    df = spark.createDataFrame([(list(map(float, r)),) for r in x], "v array<double>").repartition(5)
    g, _ = impute.gram_and_change(df, "v", 300)
    assert np.allclose(g, x.T @ x)
    long = reduce.gram_long(df, "v", 300).toPandas()
    assert len(long) == 300 * 300 and not long.duplicated(["i", "j"]).any()
    assert np.allclose(long.sort_values(["i", "j"])["value"].to_numpy().reshape(300, 300), x.T @ x)
    assert reduce.gram_long(df.limit(0), "v", 300).count() == 0


def test_truncated_scores_equal_the_full_svd(spark):
    rng = np.random.default_rng(4)
    hot = np.zeros((400, 120))                              # indicators of three category columns
    for start, size in ((0, 60), (60, 40), (100, 20)):
        hot[np.arange(400), start + (size * rng.random(400) ** 3).astype(int)] = 1.0
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(hot)], "id long, v array<double>").repartition(4)
    got = reduce.svd_scores_truncated(df, "v", 120, 10, ["id"], tol=1e-7).toPandas().sort_values("id")
    _, s, vt = np.linalg.svd(hot, full_matrices=False)
    want = hot @ reduce._sign_fix(vt[:10].T)
    value, _ = reduce.leading_directions(df, "v", 120, 10)
    assert np.allclose(value, s[:10], rtol=1e-6)
    assert np.allclose(got.drop(columns="id").to_numpy(), want, atol=1e-3)
    with pytest.raises(RuntimeError, match="not settled"):
        reduce.leading_directions(df, "v", 120, 10, max_iter=1)


def plain_completion(x, lam, rounds=20000):
    """Soft-thresholded completion in plain numpy, run until it stands still."""
    there = ~np.isnan(x)
    full = np.where(there, x, 0.0)
    for _ in range(rounds):
        u, d, vt = np.linalg.svd(full, full_matrices=False)
        new = np.where(there, x, (u * np.maximum(d - lam, 0)) @ vt)
        if np.abs(new - full).max() < 1e-10:
            break
        full = new
    return full


def test_alternating_completion_equals_plain_numpy(spark):
    rng = np.random.default_rng(5)
    true = rng.normal(size=(60, 2)) @ rng.normal(size=(2, 6))
    x = true + 0.05 * rng.normal(size=true.shape)
    x[rng.random(x.shape) < 0.25] = np.nan
    x[7] = np.nan                                           # a row without values
    df, cols = frame(spark, x)
    out, fit = impute.als_impute(df, "id", cols, rank=5, lam=0.8, tol=1e-12, max_iter=2000)
    got = out.toPandas().sort_values("id").drop(columns="id").to_numpy()
    assert fit.converged and all(b <= a * (1 + 1e-12) for a, b in zip(fit.objective, fit.objective[1:]))
    seen = ~np.isnan(x)
    assert (got[seen] == x[seen]).all() and not np.isnan(got).any() and (got[7] == 0).all()
    want = plain_completion(x, 0.8)
    assert np.abs(got - want).max() < 5e-3
    assert np.abs(got - true)[~seen & ~np.isnan(x).all(axis=1)[:, None]].mean() < 0.3
    with pytest.raises(RuntimeError, match="not settled"):
        impute.als_impute(df, "id", cols, max_iter=1)
    empty, fit = impute.als_impute(df.limit(0), "id", cols)
    assert fit.converged and empty.count() == 0


def test_alternating_completion_settles_on_many_rows(spark):
    """Without balancing the factors, these rows take more than 500 rounds, the limit."""
    rng = np.random.default_rng(6)
    x = 3 * rng.random((3000, 5)) * [10, 1, 1, 1, 2]
    x[rng.random(x.shape) < 0.05] = np.nan
    x = np.tile(x, (20, 1))
    df = spark.createDataFrame(pd.DataFrame({"v": list(x)}))
    fit = impute.als_fit(df, "v", 5)
    assert fit.converged and len(fit.objective) < 200
    assert all(b <= a * (1 + 1e-12) for a, b in zip(fit.objective, fit.objective[1:]))
    v, squares = rng.normal(size=(6, 3)), rng.normal(size=(9, 3))
    even = impute._balanced(v, squares.T @ squares)
    product = squares @ v.T
    length = np.linalg.svd(product, compute_uv=False).sum()
    assert np.isclose((even ** 2).sum(), length) and np.allclose(product @ even @ np.linalg.pinv(even), product)


def test_truncated_directions_of_close_values_settle(spark):
    """Plain subspace iteration took more than 100 rounds, the limit, for singular values this close."""
    rng = np.random.default_rng(9)
    want = np.sqrt(1 - 0.001 * np.arange(300))
    x = want[:, None] * np.linalg.qr(rng.normal(size=(300, 300)))[0]
    df = spark.createDataFrame(pd.DataFrame({"v": list(x)}))
    value, v = reduce.leading_directions(df, "v", 300, 10)
    assert np.allclose(value, want[:10], rtol=1e-6)
    assert np.allclose(v.T @ v, np.eye(10), atol=1e-9) and np.allclose(x.T @ (x @ v), v * value ** 2, atol=1e-5)
    few = spark.createDataFrame([([1.0, 2.0, 0.0, 0.0],), ([2.0, 4.0, 0.0, 0.0],)], "v array<double>")
    value, v = reduce.leading_directions(few, "v", 4, 2, extra=0)
    assert np.allclose(value, [5.0, 0.0], atol=1e-6) and np.allclose(v.T @ v, np.eye(2))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _frame(spark):
    rows = [(k, b, x, i, f) for k, b, x, i, f in [
        (1, "a", 0.1, 3, 1.5), (1, "a", 0.1, -3, 1.5), (1, "a", 0.1, 3, None), (2, "a", float("nan"), 1, 2.5), (2, "a", None, 1, 2.5),
        (None, "a", 2.0, 7, 0.5), (None, "b", -0.0, 7, 0.5), (None, "b", 0.0, 8, 0.25), (3, None, float("inf"), None, 1.0), (3, "b", 1.0, 2 ** 62, 4.0)]]
    return spark.createDataFrame(rows, "k int, b string, x double, i long, f float")


@pytest.mark.parametrize("keys", [["k"], ["k", "b"]])
@pytest.mark.parametrize("fns", ["canonical", "sd", "mean_var_sum"])
@pytest.mark.parametrize("cells", [2_000_000, 6])
def test_numeric_bundles_come_from_sorted_rows(spark, monkeypatch, keys, fns, cells):
    """Hundreds of buffers and sets a group were kept and touched by every row."""
    df = _frame(spark)
    monkeypatch.setattr(sortedruns, "CELLS", cells)
    got = bundles.rollup(df, keys, fns, cols=["x", "i", "f"])
    assert "ObjectHashAggregate" not in _plan(got) and "MapInArrow" in _plan(got)
    monkeypatch.setattr(sortedruns, "fits", lambda *a: False)
    want = bundles.rollup(df, keys, fns, cols=["x", "i", "f"])
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    # of a zero with both signs either may be the smallest
    rows = [sorted(str(r).replace("-0.0", "0.0") for r in df.collect()) for df in (got, want)]
    assert rows[0] == rows[1]


def test_sum_that_does_not_fit_a_long_is_refused(spark):
    df = spark.createDataFrame([(1, 2 ** 62), (1, 2 ** 62)], "k int, i long")
    with pytest.raises(Exception, match="does not fit a long"):
        bundles.rollup(df, "k").collect()


def test_near_zero_variance_makes_no_row_of_a_cell(spark):
    df = spark.createDataFrame([(0.0, 1, True), (-0.0, 1, None), (float("nan"), 2, False), (float("nan"), None, False)], "a double, b int, c boolean")
    out = selection.nzv_metrics(df, ["a", "b", "c"])
    assert "Generate" not in _plan(out)
    got = {r["column"]: (r["freq_ratio"], r["percent_unique"], r["zero_var"]) for r in out.collect()}
    assert got == {"a": (1.0, 50.0, 0), "b": (2.0, 50.0, 0), "c": (2.0, 50.0, 0)}


def test_wide_rows_are_joined_as_one_struct(spark):
    wide = spark.range(3).select(F.col("id").alias("k"), *[(F.col("id") + j).cast("double").alias(f"c.{j}") for j in range(120)])
    other = spark.createDataFrame([(0, 1.0, "x"), (0, 2.0, "y"), (2, None, "x")], "k long, v double, s string")
    out = joins.rollup_join(wide, [other, other.select("k", F.col("v").alias("w"))], "k")
    assert out.columns == [*wide.columns, "v", "s", "w"] and _plan(out).count("`c.7`") + _plan(out).count("c.7") < 12
    rows = sorted([(r["k"], r["v"], r["s"], r["w"], r["c.119"]) for r in out.collect()], key=str)
    assert rows == sorted([(0, a, s, b, 119.0) for a, s in ((1.0, "x"), (2.0, "y")) for b in (1.0, 2.0)] + [(1, None, None, None, 120.0), (2, None, "x", None, 121.0)], key=str)
    coded = encode.label_encode(out)
    assert coded.columns == out.columns
    assert sorted(str(r["s"]) for r in coded.collect()) == ["1", "1", "1", "2", "2", "None"]
    means = groupstats.add_group_blocks(out, [(["s"], {"m": F.avg("w")}), (["k", "s"], {"n": F.count("w")})])
    assert means.columns == [*out.columns, "m", "n"]
    assert sorted((str(r["s"]), r["m"], r["n"]) for r in means.collect()) == [
        ("None", None, 0), ("x", 1.5, 0), ("x", 1.5, 2), ("x", 1.5, 2), ("y", 1.5, 2), ("y", 1.5, 2)]
    middle = groupstats.median_lookup(out, "s", "k", "med")
    assert sorted((str(r["s"]), r["med"]) for r in middle.collect()) == [("None", 1.0), ("x", 0.0), ("x", 0.0), ("x", 0.0), ("y", 0.0), ("y", 0.0)]


def test_cleaning_by_batch_is_the_same(spark):
    df = _frame(spark)
    got, want = clean.clean_non_finite(df, by_batch=True), clean.clean_non_finite(df)
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "isnan" not in _plan(got).lower()


def test_wide_means_and_components(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 130)) @ np.diag(np.linspace(1, 9, 130))
    x[:, 5] = 0.1
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["id", *[f"c{j}" for j in range(130)]])
    cols = df.columns[1:]
    holes = df.withColumn("c7", F.when(F.col("id") > 3, F.col("c7"))).withColumn("c8", F.lit(None).cast("double"))
    means = impute.column_means(holes, cols)
    assert means["c8"] is None and np.isclose(means["c7"], x[4:, 7].mean()) and np.isclose(means["c0"], x[:, 0].mean())
    out = reduce.pca_scores(df, cols, 3, keep=["id"])
    assert "UDF" not in _plan(out) and out.columns == ["id", "PC1", "PC2", "PC3"]
    z = (x - x.mean(0)) / np.where(np.arange(130) == 5, 1, x.std(0, ddof=1))
    z[:, 5] = 0
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    got = np.array([list(r)[1:] for r in out.orderBy("id").collect()])
    assert np.allclose(np.abs(got), np.abs(u[:, :3] * s[:3]))
    with pytest.raises(Exception, match="null or NaN"):
        reduce.pca_scores(holes, cols, 3).collect()
