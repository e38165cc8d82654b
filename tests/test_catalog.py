"""Catalog-level checks: entry() smoke run, oracle agreement on a query subset, sources round trip."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK, SF_SMALL
from tests.oracle_compare import compare, duck

FAST = ["sentinel_null_out", "ratio_ieee", "cut_right_closed", "row_kurtosis", "bundle_moments",
        "category_means_two_keys", "label_encode", "onehot_max_levels", "blend_median", "auc_rank",
        "nzv_columns", "knn_class_distance_sums", "knn_columns_by_split", "gram_matrix_long",
        "svd_full_lengths", "pca_full_lengths", "blend_score_files", "group_median_lookup",
        "corr_wide_with_nulls", "corr_matrix_long"]


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and "SK_ID_CURR" in df.columns


def test_every_query_has_sql_or_is_declared_rows_only():
    import __spark_entry__ as e
    from tabula.plans.catalog import CATALOG
    qs, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(qs)
    rows_only = set(CATALOG) - set(sql)
    assert rows_only == {"corr_filter_pairwise", "pca_scores", "svd_scores_uncentered", "soft_impute",
                         "gbt_scores", "gbt_scores_weighted", "train_score_write", "importance_topk", "feature_table_pipeline",
                         "auc_by_round", "gbt_best_round_scores", "train_on_feature_table", "declared_categories",
                         "svd_truncated_onehot", "als_completion"}


@pytest.mark.parametrize("name", FAST)
def test_oracle_agreement(spark, name):
    import __spark_entry__ as e
    res = compare(spark, duck(SF_CHECK), name, SF_CHECK, e.queries()[name], e.oracle_sql()[name])
    assert res["status"] == "ok", res


def test_rows_only_queries_run(spark):
    import __spark_entry__ as e
    for name in ["pca_scores", "svd_scores_uncentered", "corr_filter_pairwise"]:
        assert e.queries()[name](spark, SF_SMALL).count() >= 0


def test_train_score_write(spark):
    import __spark_entry__ as e
    got = e.queries()["train_score_write"](spark, SF_SMALL).collect()
    assert got and len({r["SK_ID_CURR"] for r in got}) == len(got)
    assert all(0 <= r["TARGET"] <= 1 for r in got)
    assert len({r["source"] for r in got}) == 1 and f"{round(got[0]['valid_auc'], 4)}"[:5] in got[0]["source"]


def test_score_files_round_trip(spark):
    from tabula.sources import read_score_files, write_scores
    d = tempfile.mkdtemp(prefix="tabula-scores-")
    template = spark.createDataFrame([(i,) for i in range(5)], "SK_ID_CURR long")
    paths = {}
    for n, off in (("s1", 0.1), ("s2", 0.2)):
        preds = spark.createDataFrame([(i, i / 10 + off) for i in range(5)], "SK_ID_CURR long, TARGET double")
        paths[n] = os.path.join(d, n)
        write_scores(template, preds, paths[n])
    long = read_score_files(spark, {n: os.path.join(p, "*.csv") for n, p in paths.items()})
    got = {(r["source"], r["SK_ID_CURR"]): r["TARGET"] for r in long.collect()}
    assert len(got) == 10 and got[("s2", 3)] == pytest.approx(0.5)


def test_csv_scan_with_declared_schema(spark):
    from tabula.sources import read_csv
    d = tempfile.mkdtemp(prefix="tabula-csv-")
    p = os.path.join(d, "bureau.csv")
    with open(p, "w") as f:
        f.write("SK_ID_CURR,AMT_CREDIT_SUM,CREDIT_ACTIVE\n1,10.5,Closed\n2,,Active\n")
    df = read_csv(spark, p, schema="SK_ID_CURR long, AMT_CREDIT_SUM double, CREDIT_ACTIVE string")
    rows = df.orderBy("SK_ID_CURR").collect()
    assert dict(df.dtypes) == {"SK_ID_CURR": "bigint", "AMT_CREDIT_SUM": "double", "CREDIT_ACTIVE": "string"}
    assert rows[0]["AMT_CREDIT_SUM"] == 10.5 and rows[1]["AMT_CREDIT_SUM"] is None
