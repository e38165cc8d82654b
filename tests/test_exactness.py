"""Exact counts, null keys and complete results, whatever the size of a group."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.operators.bundles import rollup
from tabula.operators.encode import apply_dummies, dummy_names
from tabula.operators.joins import align_on_key
from tabula.operators.metrics import auc
from tabula.operators.selection import correlation_long, correlation_matrix
from tabula.sources import read_score_files


@pytest.mark.parametrize("hot_rows", [200_000, 1])
def test_distinct_counts_are_exact_for_all_types_and_null_keys(spark, hot_rows):
    close = [1.0, 1.0 + 2 ** -40, 1e9 + 0.01, 1e9 + 0.02]
    big = [2 ** 53, 2 ** 53 + 1, 2 ** 53, 5]
    rows = [(k, d, n, s) for k in ("a", None) for d, n, s in zip(close, big, ["x", "y", "x", "z"])]
    df = spark.createDataFrame(rows, "k string, d double, n long, s string").withColumn("m", F.col("n").cast("decimal(30,3)"))
    out = rollup(df, "k", ["mean", "n_distinct"], cols=["d", "n"], hot_rows=hot_rows).collect()
    assert {r["k"] for r in out} == {"a", None}
    for r in out:
        assert (r["d_n_distinct"], r["n_n_distinct"]) == (4, 3)
        assert r["d_mean"] == pytest.approx(np.mean(close))
    out = rollup(df, "k", ["n_distinct"], cols=["s", "m"], hot_rows=hot_rows).collect()
    assert {(r["s_n_distinct"], r["m_n_distinct"]) for r in out} == {(3, 3)}


def test_correlation_uses_the_rows_where_both_are_there(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (100.0, None), (None, -50.0)], "a double, b double")
    assert correlation_long(df, ["a", "b"]).first()["corr"] == pytest.approx(1.0)
    some = df.select(*[F.col("a" if i % 2 else "b").alias(f"c{i}") for i in range(5)])
    for wide in (4, 5):         # beyond and within the width of the null-free pass
        assert np.allclose(correlation_matrix(some, some.columns, wide), 1.0)


def test_lost_keys_fail_unless_allowed(spark):
    a = spark.createDataFrame([(1, 0.1), (2, 0.2)], "k long, v double")
    b = spark.createDataFrame([(1, 0.3)], "k long, v double")
    with pytest.raises(Exception, match="not exactly once"):
        align_on_key({"a": a, "b": b}, "k", "v").collect()
    assert sorted(map(tuple, align_on_key({"a": a, "b": b}, "k", "v", missing="keep").collect())) == [(1, 0.1, 0.3), (2, 0.2, None)]
    assert align_on_key({"a": a, "b": b}, "k", "v", missing="drop").count() == 1


def test_dummy_names_are_injective(spark):
    assert dummy_names(["a b", "a-b", "A_b", "c"]) == ["a_b", "a_b__2", "A_b__3", "c"]
    df = spark.createDataFrame([("a b",), ("a-b",)], "c string")
    assert apply_dummies(df, {"c": ["a b", "a-b"]}).columns == ["c_a_b", "c_a_b__2"]


def test_rows_without_score_or_label_have_no_rank(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (None, 0.5), (0, None)], "y int, s double")
    r = auc(df, "y", "s").first()
    assert (r["n_pos"], r["n_neg"], r["auc"]) == (1, 1, 1.0)


def test_score_files_in_one_folder_keep_their_names(spark, tmp_path):
    for n, v in (("a_1", 0.1), ("b_1", 0.2)):
        (tmp_path / f"{n}.csv").write_text(f"SK_ID_CURR,TARGET\n7,{v}\n")
    out = read_score_files(spark, {"a": os.path.join(tmp_path, "a_*.csv"), "b": os.path.join(tmp_path, "b_*.csv")})
    assert sorted(map(tuple, out.collect())) == [("a", 7, 0.1), ("b", 7, 0.2)]


def test_median_of_hot_null_category(spark, monkeypatch):
    from tabula.operators import bundles, groupstats
    rows = [(None, float(v)) for v in (5, 1, 9, 3)] + [("a", float(v)) for v in (2, 8, 4)] + [("b", 7.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    want = {None: 4.0, "a": 4.0, "b": 7.0}
    for hot in (bundles.HOT_ROWS, 2):
        monkeypatch.setattr(bundles, "HOT_ROWS", hot)
        got = groupstats.median_lookup(df, "k", "x", "m").select("k", "m").distinct().collect()
        assert {r["k"]: r["m"] for r in got} == want and len(got) == 3


def test_hot_rollup_median_of_the_null_key(spark):
    from tabula.operators.bundles import rollup
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 4), (1, 3), (1, 5)], "k int, x long")
    normal = {tuple(r) for r in rollup(df, "k", ["mean", "median", "n_distinct"]).collect()}
    hot = {tuple(r) for r in rollup(df, "k", ["mean", "median", "n_distinct"], hot_rows=1).collect()}
    assert normal == hot and (None, 7 / 3, 2.0, 3) in hot


def test_row_kurtosis_equals_numpy(spark):
    import numpy as np
    from tabula.functions import rowwise
    df = spark.createDataFrame([(1.0, 2.0, 4.0, 9.0), (3.0, -1.0, 0.5, 2.0)], "a double, b double, c double, d double")
    for r in df.withColumn("k", rowwise.row_kurtosis(list("abcd"))).withColumn("s", rowwise.row_sd(list("abcd"))).collect():
        x = np.array(r[:4])
        assert abs(r["k"] - ((x - x.mean()) ** 4).mean() / x.var() ** 2) < 1e-12
        assert abs(r["s"] - x.std(ddof=1)) < 1e-12
