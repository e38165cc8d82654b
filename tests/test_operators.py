"""Operator tests on hand-built frames (FIXTURES §3) and invariants for non-SQL operators."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabula.operators import blend, bundles, encode, groupstats, impute, knn, metrics, reduce, selection, split
from tabula.operators.joins import left_join_null_safe


def test_null_safe_join_matches_null_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, w int")
    out = {r["v"]: r["w"] for r in left_join_null_safe(left, right, ["k"]).collect()}
    assert out == {1: 10, 2: 20, 3: None}


def test_category_stats_joined_back_with_null_group(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), (None, 5.0), (None, 7.0)], "k string, v double")
    out = groupstats.add_category_stats(df, "k", ["v"], prefix="K_").collect()
    got = sorted((r["k"] or "", r["K_v"]) for r in out)
    assert got == [("", 6.0), ("", 6.0), ("x", 2.0), ("x", 2.0)]


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_rollup_hot_and_normal_paths_agree(spark, hot_rows):
    rng = np.random.default_rng(0)
    rows = [(1, float(rng.integers(0, 5)), None if i % 7 == 0 else "s%d" % (i % 3)) for i in range(40)]
    rows += [(2, 1.0, "a"), (2, None, "a"), (3, 2.0, None)]
    df = spark.createDataFrame(rows, "k long, x double, c string")
    nd = {r["k"]: r.asDict() for r in bundles.rollup(df, "k", ["n_distinct"], "propagate",
                                                     hot_rows=hot_rows).collect()}
    mean = {r["k"]: r.asDict() for r in bundles.rollup(df.select("k", "x"), "k", ["mean", "n_distinct"], "propagate",
                                                       hot_rows=hot_rows).collect()}
    got = {k: {**nd[k], **mean[k]} for k in nd}
    pdf = pd.DataFrame(rows, columns=["k", "x", "c"])
    for k, g in pdf.groupby("k"):
        assert got[k]["x_n_distinct"] == g["x"].nunique() + int(g["x"].isna().any())
        assert got[k]["c_n_distinct"] == g["c"].nunique() + int(g["c"].isna().any())
        expect = None if g["x"].isna().any() else g["x"].mean()
        assert got[k]["x_mean"] == (pytest.approx(expect) if expect is not None else None)


def test_label_encode_sorted_levels_and_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "s string")
    assert [r["s"] for r in encode.label_encode(df).collect()] == [2, 1, None, 3, 1]


def test_label_encode_distributed_path(spark):
    df = spark.createDataFrame([(f"v{i:03d}",) for i in range(50)] + [(None,)], "s string")
    codes = [r["s"] for r in encode.label_encode(df).collect()]
    assert codes[:50] == list(range(1, 51)) and codes[50] is None


def test_onehot_drops_wide_columns(spark):
    rows = [("a", "p", 1.0), ("b", "q", 2.0), ("a", "r", 3.0), (None, "s", 4.0), ("c", "t", 5.0), ("a", "u", 6.0)]
    df = spark.createDataFrame(rows, "small string, wide string, x double")
    out = encode.onehot(df, max_levels=5)
    assert set(out.columns) == {"x", "small_a", "small_b", "small_c"}
    assert [r["small_a"] for r in out.orderBy("x").collect()] == [1.0, 0.0, 1.0, None, 0.0, 1.0]


def test_dummies_unseen_level_is_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([("a",), ("z",)], "c string")
    out = encode.apply_dummies(test, encode.fit_dummies(train, ["c"])).collect()
    assert [(r["c_a"], r["c_b"]) for r in out] == [(1, 0), (0, 0)]


def test_nzv_rules(spark):
    n = 100
    pdf = pd.DataFrame({
        "const": [1.0] * n,
        "r99": [0.0] * 99 + [1.0],                  # ratio 99 > 19, 2 % unique -> nzv
        "r95": [0.0] * 95 + [1.0] * 5,              # ratio exactly 19 -> kept
        "uniq": [float(i) for i in range(n)],
    })
    out = {r["column"]: r for r in selection.nzv_metrics(spark.createDataFrame(pdf)).collect()}
    assert out["const"]["nzv"] == 1 and out["const"]["zero_var"] == 1
    assert out["r99"]["nzv"] == 1 and out["r99"]["freq_ratio"] == 99.0
    assert out["r95"]["nzv"] == 0 and out["r95"]["freq_ratio"] == 19.0
    assert out["uniq"]["nzv"] == 0 and out["uniq"]["percent_unique"] == 100.0


def _caret_exact(x, cutoff):
    """Independent brute-force reading of the exact findCorrelation procedure."""
    x = np.abs(x)
    p = len(x)
    avg = [np.mean([x[i, j] for j in range(p) if j != i]) for i in range(p)]
    order = sorted(range(p), key=lambda i: -avg[i])
    deleted = set()
    for a_pos, a in enumerate(order):
        if a in deleted:
            continue
        for b in order[a_pos + 1:]:
            if a in deleted or b in deleted or x[a, b] <= cutoff:
                continue
            keep = [i for i in range(p) if i not in deleted]
            m1 = np.mean([x[a, j] for j in keep if j != a])
            rows = [i for i in keep if i != b]
            m2 = np.mean([x[i, j] for i in rows for j in keep if j != i])
            deleted.add(a if m1 > m2 else b)
    return sorted(deleted)


def test_find_correlation_matches_brute_force():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(200, 3))
    m = np.column_stack([base[:, 0], 2 * base[:, 0] + 0.01 * rng.normal(size=200), -base[:, 0] + 0.3 * rng.normal(size=200),
                         base[:, 1], base[:, 1] + 0.05 * rng.normal(size=200), base[:, 2]])
    c = np.corrcoef(m, rowvar=False)
    got = selection.find_correlation(c, 0.9)
    assert got == _caret_exact(c, 0.9)
    kept = [i for i in range(6) if i not in got]
    assert all(abs(c[i, j]) <= 0.9 for i, j in itertools.combinations(kept, 2))


def test_correlation_long_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 7.0, 5.0)], "a double, b double, c double")
    out = {(r["col_a"], r["col_b"]): r["corr"] for r in selection.correlation_long(df, ["a", "b", "c"]).collect()}
    assert out[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1])
    assert out[("a", "c")] is None


def test_mean_impute(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None)], "a double, b double")
    out = impute.mean_impute(df, ["a", "b"]).collect()
    assert [r["a"] for r in out] == [1.0, 3.0, 2.0] and [r["b"] for r in out] == [0.0, 0.0, 0.0]


def test_soft_impute_invariants(spark):
    rng = np.random.default_rng(7)
    u, v = rng.normal(size=(50, 2)), rng.normal(size=(2, 6))
    m = u @ v
    mask = rng.random(m.shape) < 0.1
    rows = [(i, *[None if mask[i, j] else float(m[i, j]) for j in range(6)]) for i in range(50)]
    cols = [f"c{j}" for j in range(6)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in cols))
    out = impute.soft_impute(df, "id", cols, rank=3, lam=0.1, max_iter=60).orderBy("id").toPandas()
    got = out[cols].to_numpy()
    assert not np.isnan(got).any()
    np.testing.assert_allclose(got[~mask], m[~mask])                  # observed cells unchanged
    err = np.abs(got[mask] - m[mask]).mean()
    assert err < np.abs(m[mask]).mean()                                # better than filling with 0


def test_pca_scores_invariants(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4))
    pdf = pd.DataFrame(x, columns=list("abcd"))
    pdf["id"] = range(300)
    out = reduce.pca_scores(spark.createDataFrame(pdf), list("abcd"), k=3, keep=["id"]).orderBy("id").toPandas()
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    evals = np.sort(np.linalg.eigvalsh(np.cov(z, rowvar=False)))[::-1]
    scores = out[["PC1", "PC2", "PC3"]].to_numpy()
    np.testing.assert_allclose(scores.var(0, ddof=1), evals[:3], rtol=1e-6)   # score variance = eigenvalue
    c = np.corrcoef(scores, rowvar=False)
    np.testing.assert_allclose(c - np.diag(np.diag(c)), 0, atol=1e-8)         # uncorrelated scores


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    n = 60
    x = rng.normal(size=(n, 4))
    labels = rng.integers(0, 3, n)
    folds = rng.integers(0, 3, n)
    is_train = rng.random(n) < 0.7
    pdf = pd.DataFrame({"id": range(n), "x": list(x), "label": labels,
                        "fold": np.where(is_train, folds, -1), "is_train": is_train})
    df = spark.createDataFrame(pdf, "id long, x array<double>, label long, fold long, is_train boolean")
    k = 3
    got = knn.knn_distance_sums(df.where("is_train"), df, "id", "x", "label", k, fold="fold", block_rows=16)
    got = {(r["id"], r["label"], r["j"]): r["dist_sum"] for r in got.collect()}
    expect = {}
    for q in range(n):
        for c in range(3):
            d = sorted(np.linalg.norm(x[q] - x[t]) for t in range(n)
                       if is_train[t] and labels[t] == c and (not is_train[q] or folds[q] != folds[t]))
            for j in range(1, min(k, len(d)) + 1):
                expect[(q, c, j)] = sum(d[:j])
    assert got.keys() == expect.keys()
    for key, v in expect.items():
        assert got[key] == pytest.approx(v, rel=1e-9)


def test_knn_shuffles_no_training_rows(spark):
    """Rows were copied once per block of the other side; repeated and null keys share their neighbours."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(40, 3))
    ids = [0, 0, None, *range(3, 40)]
    rows = [(i, v.tolist(), None if j == 9 else f"c{j % 2}") for j, (i, v) in enumerate(zip(ids, x))]
    df = spark.createDataFrame(rows, "id long, x array<double>, label string")
    got = knn.knn_distance_sums(df, df, "id", "x", "label", 2, block_rows=8)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "Generate explode(sequence" not in plan
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    want = {}
    for key in set(ids):
        for c in (0, 1):
            near = sorted(d[q, t] for q in range(40) if ids[q] == key for t in range(40) if t % 2 == c and t != 9)
            want.update({(key, f"c{c}", j): sum(near[:j]) for j in (1, 2)})
    got = {(r["id"], r["label"], r["j"]): r["dist_sum"] for r in got.collect()}
    assert got.keys() == want.keys()
    for key, v in want.items():
        assert got[key] == pytest.approx(v, rel=1e-9, abs=1e-6)


def test_hash_split_deterministic_and_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = split.hash_split(df, "k", 0.85).collect()
    b = split.hash_split(df.repartition(7), "k", 0.85).collect()
    assert {r["k"]: r["split"] for r in a} == {r["k"]: r["split"] for r in b}
    share = sum(r["split"] == "train" for r in a) / 2000
    assert 0.82 < share < 0.88


@pytest.mark.parametrize("case", ["ties", "perfect", "reversed"])
def test_auc(spark, case):
    if case == "ties":
        rows = [(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1), (0, 0.5)]
        expect = (1.0 * (1 + 0.5 * 2) + 1.0 * 3) / (2 * 3)
    elif case == "perfect":
        rows = [(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)]
        expect = 1.0
    else:
        rows = [(1, 0.1), (1, 0.2), (0, 0.8), (0, 0.9)]
        expect = 0.0
    df = spark.createDataFrame(rows, "y int, s double")
    assert metrics.auc(df, "y", "s", buckets=2).first()["auc"] == pytest.approx(expect)


def test_blend_is_key_aligned(spark):
    a = spark.createDataFrame([(1, 0.2), (2, 0.4), (3, 0.6)], "id long, TARGET double")
    b = spark.createDataFrame([(3, 0.0), (1, 1.0), (2, 0.5)], "id long, TARGET double")
    c = spark.createDataFrame([(2, 0.1), (3, 0.9), (1, 0.3)], "id long, TARGET double")
    w = blend.blend({"a": a, "b": b}, "id", "TARGET", groups=[(1.0, {"a": 0.5, "b": 0.5})])
    assert {r["id"]: r["TARGET"] for r in w.collect()} == pytest.approx({1: 0.6, 2: 0.45, 3: 0.3})
    m = blend.blend({"a": a, "b": b, "c": c.repartition(3)}, "id", "TARGET", how="median")
    assert {r["id"]: r["TARGET"] for r in m.collect()} == pytest.approx({1: 0.3, 2: 0.4, 3: 0.6})


@pytest.mark.parametrize("nulls", ["skip", "propagate"])
def test_rollup_median_hot_path_matches_normal_path(spark, nulls):
    rng = np.random.default_rng(2)
    rows = [(1, float(v)) for v in rng.normal(size=301).round(1)] + [(1, None)]
    rows += [(2, float(v)) for v in rng.integers(0, 4, 200)] + [(3, 5.0), (3, 7.0)]
    df = spark.createDataFrame(rows, "k long, x double")
    fns = ["median", "mean", "n_distinct"]
    normal = {r["k"]: r.asDict() for r in bundles.rollup(df, "k", fns, nulls).collect()}
    hot = {r["k"]: r.asDict() for r in bundles.rollup(df, "k", fns, nulls, hot_rows=10).collect()}
    assert normal.keys() == hot.keys()
    for k in normal:
        for c in ("x_median", "x_mean", "x_n_distinct"):
            a, b = normal[k][c], hot[k][c]
            assert (a is None and b is None) or a == pytest.approx(b), (k, c, a, b)


def test_median_lookup_hot_categories(spark, monkeypatch):
    rows = [("a", float(i)) for i in range(101)] + [("b", 1.0), ("b", 3.0), (None, 4.0), ("c", None), ("c", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    normal = {r["k"]: r["m"] for r in groupstats.median_lookup(df, "k", "v", "m").collect()}
    monkeypatch.setattr(bundles, "HOT_ROWS", 1)
    hot = {r["k"]: r["m"] for r in groupstats.median_lookup(df, "k", "v", "m").collect()}
    assert normal == hot == {"a": 50.0, "b": 2.0, None: 4.0, "c": None}


@pytest.mark.parametrize("categorical_max", [None, 4])
def test_gbt_trains_scores_and_ranks_features(spark, categorical_max):
    from tabula.operators import train
    rng = np.random.default_rng(4)
    n = 400
    cat = rng.integers(0, 3, n)
    x = rng.normal(size=n)
    y = ((x + (cat == 2) * 1.5 + rng.normal(scale=0.3, size=n)) > 0.7).astype(int)
    pdf = pd.DataFrame({"id": range(n), "x": x, "cat": cat.astype(float), "noise": rng.normal(size=n), "y": y,
                        "split": np.where(np.arange(n) % 5 == 0, "val", "train")})
    df = spark.createDataFrame(pdf)
    res = train.train_gbt(df, ["x", "cat", "noise"], label="y", split_col="split", maxIter=10, maxDepth=3,
                          stepSize=0.3, subsamplingRate=1.0, featureSubsetStrategy="all", minInfoGain=0.0,
                          categorical_max=categorical_max)
    assert res.valid_auc > 0.8
    scores = train.score(res, df, "id").toPandas()
    assert len(scores) == n and scores["TARGET"].between(0, 1).all()
    imp = train.importance(res, spark).toPandas()
    assert imp.iloc[0]["feature"] == "x"


@pytest.mark.parametrize("fns", [["mean", "max", "n_distinct"], ["mean", "max"]])
def test_rollup_shuffles_rows_once(spark, fns):
    """Partial aggregates of many columns were shuffled, and distinct counts joined to the values."""
    rows = [(None if i % 5 == 4 else i % 5, float(i % 7), i % 3) for i in range(100)]
    df = spark.createDataFrame(rows, "k long, x double, y long")
    for hot_rows in (1000, 10):                              # all groups normal, all groups hot
        out = bundles.rollup(df, "k", fns, hot_rows=hot_rows)
        if hot_rows == 1000:
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "Join" not in plan and plan.count("Exchange") == 1 and "REPARTITION_BY_COL" in plan
        got = {r["k"]: r for r in out.collect()}
        assert set(got) == {0, 1, 2, 3, None}
        for k, r in got.items():
            x = [v for key, v, _ in rows if key == k]
            assert r["x_mean"] == pytest.approx(sum(x) / len(x)) and r["x_max"] == max(x)
            assert "n_distinct" not in fns or (r["x_n_distinct"], r["y_n_distinct"]) == (len(set(x)), 3)
