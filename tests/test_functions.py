"""Scalar, row-wise and aggregate semantics on hand-built edge frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.functions import (agg_expr, clamp0, cut_right_closed, ieee_divide, non_finite_to_null,
                              row_kurtosis, row_mean, row_median, row_null_count, row_sd, row_sum, sig_round)


def _vals(df, col):
    return [r[col] for r in df.collect()]


def test_ieee_divide_zero_divisors(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (1.0, None), (6.0, 3.0)], "a double, b double")
    out = _vals(df.select(ieee_divide("a", "b").alias("r")), "r")
    assert out[0] == math.inf and out[1] == -math.inf and math.isnan(out[2])
    assert out[3] is None and out[4] is None and out[5] == 2.0


def test_non_finite_to_null(spark):
    df = spark.createDataFrame([(math.inf,), (-math.inf,), (math.nan,), (1.5,), (None,)], "x double")
    assert _vals(df.select(non_finite_to_null("x").alias("x")), "x") == [None, None, None, 1.5, None]


def test_cut_right_closed_edges(spark):
    breaks = [-1, 0, 1, 5, 10, 30, 100, 300, 1000, 3000]
    xs = [-1.0, -0.5, 0.0, 0.5, 1.0, 5.0, 3000.0, 3000.1, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    # (-1,0] is bin 1; -1 itself and anything above 3000 fall outside
    assert _vals(df.select(cut_right_closed("x", breaks).alias("b")), "b") == [None, 1, 1, 2, 2, 3, 9, None, None]


def test_clamp0_keeps_null(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,), (2.0,), (None,)], "x double")
    assert _vals(df.select(clamp0("x").alias("x")), "x") == [0.0, 0.0, 2.0, None]


def test_row_statistics(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0, 1.0), (1.0, 2.0, 2.0, 7.0, 11.0), (1.0, None, 3.0, 4.0, 5.0)],
                               "f1 double, f2 double, f3 double, f4 double, f5 double")
    cols = ["f1", "f2", "f3", "f4", "f5"]
    r = df.select(row_null_count(cols).alias("na"), row_sum(cols).alias("s"), row_mean(cols).alias("m"),
                  row_sd(cols).alias("sd"), row_kurtosis(cols).alias("k"), row_median(cols).alias("med")).collect()
    assert [x["na"] for x in r] == [0, 0, 1]
    assert r[1]["s"] == 23.0 and r[1]["m"] == pytest.approx(4.6)
    assert r[1]["sd"] == pytest.approx(np.std([1, 2, 2, 7, 11], ddof=1))
    assert r[1]["k"] == pytest.approx(1.8385, abs=1e-4)            # Pearson kurtosis, normal = 3 scale
    assert math.isnan(r[0]["k"])                                   # constant row: 0/0
    assert r[1]["med"] == 2.0
    assert r[2]["s"] is None and r[2]["med"] is None               # any null -> null (N16)


def test_bundle_null_modes(spark):
    rows = [("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", None), ("c", None), ("c", None), ("d", 5.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    fns = ["mean", "var", "sum", "n_distinct", "median"]
    prop = {r["k"]: r for r in df.groupBy("k").agg(*[agg_expr(f, "x", "propagate").alias(f) for f in fns]).collect()}
    skip = {r["k"]: r for r in df.groupBy("k").agg(*[agg_expr(f, "x", "skip").alias(f) for f in fns]).collect()}
    assert prop["a"]["mean"] == 1.5 and prop["b"]["mean"] is None and prop["b"]["sum"] is None  # N1
    assert prop["b"]["n_distinct"] == 2 and prop["c"]["n_distinct"] == 1                      # N3
    assert skip["b"]["mean"] == 1.0 and skip["c"]["sum"] == 0 and skip["c"]["n_distinct"] == 0  # N2
    assert prop["d"]["var"] is None                                                              # N11
    assert None in prop                                                                          # N5


def test_moments_match_reference_values(spark):
    df = spark.createDataFrame([(1, x) for x in [1.0, 2.0, 2.0, 7.0, 11.0]] + [(2, 4.0), (2, 4.0), (3, 9.0)],
                               "g int, x double")
    r = {x["g"]: x for x in df.groupBy("g").agg(agg_expr("skewness", "x", "skip").alias("s"),
                                                agg_expr("kurtosis", "x", "skip").alias("k")).collect()}
    assert r[1]["s"] == pytest.approx(0.6932, abs=1e-4)
    assert r[1]["k"] == pytest.approx(1.8385, abs=1e-4)
    assert r[2]["s"] is None and r[3]["k"] is None          # constant / one-row groups


def test_sig_round_is_stable(spark):
    df = spark.createDataFrame([(0.1 + 0.2,), (0.3,), (-0.0,), (1e-12,), (math.inf,), (None,)], "x double")
    r = df.select(sig_round("x").alias("s")).collect()
    assert r[0]["s"] == r[1]["s"]
    assert math.copysign(1, r[2]["s"]) == 1.0 and r[3]["s"] == 0.0
    assert r[4]["s"] == math.inf and r[5]["s"] is None
