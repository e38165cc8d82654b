"""Catalog part 7: wide tables with nulls, truncated SVD of indicators, alternating completion."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.operators import encode, impute, moments, reduce
from tabula.plans import analog
from tabula.plans.queries_model import _SOFT, NUMERIC_SQL, embedding_vectors, soft_input
from tabula.plans.registry import query
from tabula.sources.sinks import materialize

#: Vector components below this count as missing in the wide query.
_LOW = -0.125
_WIDTH = 64


@query("corr_wide_with_nulls", ops="M2 M9", doubles=["corr"], sql=f"""
    WITH u AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    v AS (SELECT * FROM u WHERE x >= {_LOW})
    SELECT 'x' || a.i AS col_a, 'x' || b.i AS col_b, count(*) AS n, CASE WHEN isnan(corr(a.x, b.x)) THEN NULL ELSE corr(a.x, b.x) END AS corr
    FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i""")
def corr_wide_with_nulls(t, spark):
    """Pairwise-complete correlations of 64 columns with nulls, in one scan."""
    x = embedding_vectors(t)
    wide = x.select(*[F.when(F.col("x")[i] >= _LOW, F.col("x")[i]).alias(f"x{i + 1}") for i in range(_WIDTH)])
    return moments.pair_moments(wide, wide.columns).where("n > 0").select("col_a", "col_b", "n", "corr")


@query("svd_truncated_onehot", ops="M6 E2")
def svd_truncated_onehot(t, spark):
    """The first ten uncentred SVD scores of all applicants' one-hot indicators."""
    cats = ["CODE_GENDER", "ORGANIZATION_TYPE", "NAME_EDUCATION_TYPE", "OCCUPATION_TYPE"]
    base = materialize(analog.applicant_base(t).select("SK_ID_CURR", *cats), "indicators")
    levels = encode.fit_dummies(base, cats)
    hot = encode.apply_dummies(base, levels, dtype="double")
    names = [c for c in hot.columns if c != "SK_ID_CURR"]
    rows = hot.select("SK_ID_CURR", F.array(*[F.coalesce(F.col(c), F.lit(0.0)) for c in names]).alias("x"))
    return reduce.svd_scores_truncated(rows, "x", len(names), 10, keep=["SK_ID_CURR"])


@query("als_completion", ops="M7")
def als_completion(t, spark):
    """The applicants' missing scores completed by alternating ridge steps; raises if they do not settle."""
    return impute.als_impute(materialize(soft_input(t), "completion"), "SK_ID_CURR", _SOFT)[0]


#: An invariant only: observed cells come back unchanged and no cell is left null.
@query("als_completion_observed", ops="M7", doubles=_SOFT,
       sql=f"""SELECT SK_ID_CURR, AMT_INCOME_TOTAL::DOUBLE / 10000 AS income, EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3,
                      CNT_CHILDREN::DOUBLE / 10 AS children, 0 AS n_null FROM ({NUMERIC_SQL}) n""")
def als_completion_observed(t, spark):
    rows = materialize(soft_input(t), "completion")
    full, _ = impute.als_impute(rows, "SK_ID_CURR", _SOFT)
    seen = rows.select("SK_ID_CURR", *[F.col(c).isNotNull().alias(f"seen_{c}") for c in _SOFT])
    n_null = sum((F.col(c).isNull().cast("int") for c in _SOFT), F.lit(0))
    return full.join(seen, "SK_ID_CURR").select(
        "SK_ID_CURR", *[F.when(F.col(f"seen_{c}"), F.col(c)).alias(c) for c in _SOFT], n_null.alias("n_null"))
