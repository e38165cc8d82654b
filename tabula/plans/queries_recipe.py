"""Catalog part 5: the recipes R1-R3 and R7-R9 from their configuration, and the merged table before reduction.

The SQL spells every formula out again; only the entities' own aggregates are shared.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.functions import columns as C
from tabula.functions import rowwise as R
from tabula.operators import clean, groupstats, split
from tabula.operators.bundles import rollup
from tabula.operators.joins import rollup_join
from tabula.plans import loan
from tabula.plans import sqlkit as S
from tabula.plans.queries_model import _TRAIN_P
from tabula.plans.queries_stats import split_sql
from tabula.plans.recipe import Recipe, apply, keep_rows
from tabula.plans.registry import query



def _finite_sql(table, doubles):
    return f"SELECT * REPLACE ({', '.join(f'{S.nonfinite_null(S.q(c))} AS {S.q(c)}' for c in doubles)}) FROM ({table}) f0"


# ---------------------------------------------------------------------------
# R1, R2
# ---------------------------------------------------------------------------


def application(t):
    """Filters on the training part only, sentinels and power transforms on both."""
    a = split.hash_split(loan.applicants(t), "SK_ID_CURR", _TRAIN_P, labels=("train", "test"))
    rows = keep_rows(a.where(F.col("split") == "train"), loan.TRAIN_FILTERS)
    both = split.union_train_test(rows.drop("split"), a.where(F.col("split") == "test").drop("split"))
    return apply(both, loan.R1 + loan.R2)


_R2_SQL = {
    "DAYS_LAST_PHONE_CHANGE": "CASE WHEN DAYS_LAST_PHONE_CHANGE = 0 THEN NULL ELSE DAYS_LAST_PHONE_CHANGE END",
    "REGION_POPULATION_RELATIVE": "sqrt(REGION_POPULATION_RELATIVE)", "DAYS_REGISTRATION": "sqrt(abs(DAYS_REGISTRATION))",
    "APARTMENTS_AVG": "ln(1 + 50 * APARTMENTS_AVG)", "YEARS_BEGINEXPLUATATION_AVG": "pow(YEARS_BEGINEXPLUATATION_AVG, 30)",
    "YEARS_BUILD_AVG": "YEARS_BUILD_AVG * YEARS_BUILD_AVG * YEARS_BUILD_AVG",
    "COMMONAREA_AVG": "CASE WHEN COMMONAREA_AVG = 0 THEN 'inf'::DOUBLE ELSE pow(COMMONAREA_AVG, -0.005::DOUBLE) END", "ELEVATORS_AVG": "pow(ELEVATORS_AVG, 0.025::DOUBLE)",
    "ENTRANCES_AVG": "pow(ENTRANCES_AVG, 1::DOUBLE / 3)", "FLOORSMAX_AVG": "pow(FLOORSMAX_AVG, 0.4::DOUBLE)", "FLOORSMIN_AVG": "pow(FLOORSMIN_AVG, 1 / 2.2::DOUBLE)",
    "LIVINGAREA_AVG": "pow(LIVINGAREA_AVG, 1 / 3.5::DOUBLE)", "NONLIVINGAPARTMENTS_AVG": "pow(NONLIVINGAPARTMENTS_AVG, 1::DOUBLE / 7)",
    "NONLIVINGAREA_AVG": "pow(NONLIVINGAREA_AVG, 0.2::DOUBLE)", "TOTALAREA_MODE": "pow(TOTALAREA_MODE, 1::DOUBLE / 3)",
    **{c: f"pow({c}, 1::DOUBLE / 7)" for c in ("OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE")},
}
APPLICATION_SQL = f"""
    SELECT * REPLACE ({', '.join(f'{e} AS {n}' for n, e in _R2_SQL.items())}),
           pow(LANDAREA_AVG, 0.2::DOUBLE) AS LANDAREA_VG, pow(LIVINGAPARTMENTS_AVG, 1::DOUBLE / 3) AS LIVINGAPRTMENTS_AVG,
           CASE WHEN {split_sql('SK_ID_CURR', _TRAIN_P)} THEN 1 ELSE 0 END AS is_train
    FROM ({loan.APPLICANTS_SQL}) a
    WHERE NOT {split_sql('SK_ID_CURR', _TRAIN_P)} OR (CODE_GENDER <> 'MACHINERY' AND NAME_FAMILY_STATUS <> 'MIDDLE EAST' AND NAME_INCOME_TYPE NOT IN ('NATION_3', 'NATION_7'))"""
_INTEGERS = {"DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_REGISTRATION"}
_APP_DOUBLES = ["AMT_INCOME_TOTAL", *(c for c in (*loan.ORDER_COLUMNS, *loan.LINE_COLUMNS) if c not in _INTEGERS and not c.startswith("FLAG_")),
                "DAYS_REGISTRATION", "LANDAREA_VG", "LIVINGAPRTMENTS_AVG"]


@query("recipe_application", ops="R1 R2 F1 F2 C9 U1", sql=_finite_sql(APPLICATION_SQL, _APP_DOUBLES), doubles=_APP_DOUBLES)
def recipe_application(t, spark):
    return clean.clean_non_finite(application(t))


# ---------------------------------------------------------------------------
# R3
# ---------------------------------------------------------------------------
_MEANS = [c for c in (*loan.BUREAU_DAYS, *loan.BUREAU_AMOUNTS)]


def _propagated_mean(c, keys, name):
    part = ", ".join(keys)
    return f"CASE WHEN count({c}) OVER (PARTITION BY {part}) = count(*) OVER (PARTITION BY {part}) THEN avg({c}::DOUBLE) OVER (PARTITION BY {part}) END AS {name}"


_BUREAU_PREFIXES = {"TYPE_": ["CREDIT_TYPE"], "CURRENCY_": ["CREDIT_CURRENCY"], "CURRENCY_TYPE_": ["CREDIT_CURRENCY", "CREDIT_TYPE"]}
_BUREAU_RATIOS_SQL = ", ".join(f"{S.div(a, b)} AS NEW_{name}" for name, a, b in (
    ("AMT_CREDIT_SUM_DEBT_DIVIDE_AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM"),
    ("AMT_CREDIT_SUM_LIMIT_DIVIDE_AMT_CREDIT_SUM", "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM"),
    ("AMT_CREDIT_SUM_OVERDUE_DIVIDE_AMT_CREDIT_SUM", "AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM"),
    ("AMT_CREDIT_SUM_DEBT_DIVIDE_AMT_ANNUITY", "AMT_CREDIT_SUM_DEBT", "AMT_ANNUITY"),
    ("AMT_CREDIT_SUM_LIMIT_DIVIDE_AMT_ANNUITY", "AMT_CREDIT_SUM_LIMIT", "AMT_ANNUITY"),
    ("AMT_CREDIT_SUM_OVERDUE_DIVIDE_AMT_ANNUITY", "AMT_CREDIT_SUM_OVERDUE", "AMT_ANNUITY"),
    ("AMT_CREDIT_SUM_OVERDUE_DIVIDE_AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM_DEBT"),
    ("AMT_CREDIT_MAX_OVERDUE_DIVIDE_AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_MAX_OVERDUE", "AMT_CREDIT_SUM_DEBT")))
BUREAU_FEATURES_SQL = f"""
    WITH raw AS (SELECT *, {', '.join(f'CASE WHEN {c} < -40000 THEN NULL ELSE {c} END AS c_{c}' for c in loan.BUREAU_DAYS)} FROM ({loan.BUREAU_SQL}) b),
    f AS (SELECT *, (CREDIT_ACTIVE <> 'Closed')::INTEGER AS credit_active_binary, (c_DAYS_CREDIT_ENDDATE > 40)::INTEGER AS credit_enddate_binary FROM raw),
    m AS (SELECT *, {', '.join(_propagated_mean(c, keys, prefix + c) for prefix, keys in _BUREAU_PREFIXES.items() for c in (*_MEANS, *loan.BUREAU_FLAGS))} FROM f)
    SELECT * EXCLUDE ({', '.join('c_' + c for c in loan.BUREAU_DAYS)}) REPLACE ({', '.join(f'c_{c} AS {c}' for c in loan.BUREAU_DAYS)}), {_BUREAU_RATIOS_SQL} FROM m"""
_BUREAU_DOUBLES = [*loan.BUREAU_AMOUNTS, *loan.BUREAU_RATIOS, *(p + c for p in loan.BUREAU_MEANS for c in (*_MEANS, *loan.BUREAU_FLAGS))]


@query("recipe_bureau", ops="R3 A6 J4 F2 C6 N6", sql=_finite_sql(BUREAU_FEATURES_SQL, _BUREAU_DOUBLES), doubles=_BUREAU_DOUBLES)
def recipe_bureau(t, spark):
    return clean.clean_non_finite(loan.bureau_features(t))


# ---------------------------------------------------------------------------
# R7
# ---------------------------------------------------------------------------
PREVIOUS_FEATURES_SQL = f"""
    SELECT * REPLACE ({', '.join(f'CASE WHEN {c} = 365243 THEN NULL ELSE {c} END AS {c}' for c in loan.PREVIOUS_DAYS)}),
           {S.div('AMT_APPLICATION', 'AMT_CREDIT')} AS APP_CREDIT_PERC FROM ({loan.PREVIOUS_SQL}) p"""


_PREVIOUS_DOUBLES = ["AMT_APPLICATION", "AMT_CREDIT", "APP_CREDIT_PERC"]


@query("recipe_previous", ops="R7 F2 N6", sql=_finite_sql(PREVIOUS_FEATURES_SQL, _PREVIOUS_DOUBLES), doubles=_PREVIOUS_DOUBLES)
def recipe_previous(t, spark):
    return clean.clean_non_finite(apply(loan.previous(t), loan.R7))


# ---------------------------------------------------------------------------
# R8, R9
# ---------------------------------------------------------------------------
def with_features(table):
    """Null count of the row, then R8."""
    counted = table.withColumn("na", R.row_null_count([c for c in table.columns if c not in ("SK_ID_CURR", "is_train")]))
    return apply(counted, loan.R8)


def _sqrt(x):
    return f"CASE WHEN {x} < 0 THEN 'nan'::DOUBLE ELSE sqrt({x}) END"


def _features_sql(table, columns):
    na = " + ".join(f"({S.q(c)} IS NULL)::INTEGER" for c in columns)
    return f"""
    SELECT *, {_sqrt('DAYS_EMPLOYED / DAYS_BIRTH::DOUBLE')} AS DAYS_EMPLOYED_PERC, AMT_INCOME_TOTAL / AMT_CREDIT AS INCOME_CREDIT_PERC,
           CASE WHEN AMT_INCOME_TOTAL / CNT_FAM_MEMBERS = -1 THEN '-inf'::DOUBLE WHEN AMT_INCOME_TOTAL / CNT_FAM_MEMBERS < -1 THEN 'nan'::DOUBLE ELSE ln(1 + AMT_INCOME_TOTAL / CNT_FAM_MEMBERS) END AS INCOME_PER_PERSON,
           {_sqrt('AMT_ANNUITY / (1 + AMT_INCOME_TOTAL)')} AS ANNUITY_INCOME_PERC, AMT_CREDIT / AMT_INCOME_TOTAL AS LOAN_INCOME_RATIO, AMT_ANNUITY / AMT_CREDIT AS PAYMENT_RATE,
           CNT_CHILDREN / CNT_FAM_MEMBERS AS CHILDREN_RATIO, CNT_FAM_MEMBERS - CNT_CHILDREN AS cnt_non_child, AMT_CREDIT / AMT_GOODS_PRICE AS CREDIT_TO_GOODS_RATIO,
           AMT_CREDIT / CNT_FAM_MEMBERS AS credit_per_person, AMT_CREDIT / (1 + CNT_CHILDREN) AS credit_per_child, AMT_CREDIT / (1 + CNT_CHILDREN) / (1 + CNT_CHILDREN) AS INC_PER_CHLD,
           EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3 AS SOURCES_PROD, OWN_CAR_AGE / DAYS_BIRTH AS CAR_TO_BIRTH_RATIO, OWN_CAR_AGE / DAYS_EMPLOYED AS CAR_TO_EMPLOY_RATIO,
           DAYS_LAST_PHONE_CHANGE / DAYS_EMPLOYED AS PHONE_TO_BIRTH_RATIO, CNT_CHILDREN / (CNT_FAM_MEMBERS - CNT_CHILDREN) AS child_to_non_child_ratio,
           AMT_CREDIT / (CNT_FAM_MEMBERS - CNT_CHILDREN) AS credit_per_non_child, (DAYS_BIRTH < -14000)::INTEGER AS retirement_age, (DAYS_EMPLOYED < -2000)::INTEGER AS long_employment
    FROM (SELECT * REPLACE (CASE WHEN DAYS_EMPLOYED = 365243 THEN NULL ELSE DAYS_EMPLOYED END AS DAYS_EMPLOYED), {na} AS na FROM ({table}) t0) t1"""


_R8_NEW = ["DAYS_EMPLOYED_PERC", "INCOME_CREDIT_PERC", "INCOME_PER_PERSON", "ANNUITY_INCOME_PERC", "LOAN_INCOME_RATIO", "PAYMENT_RATE", "CHILDREN_RATIO",
           "cnt_non_child", "CREDIT_TO_GOODS_RATIO", "credit_per_person", "credit_per_child", "INC_PER_CHLD", "SOURCES_PROD", "CAR_TO_BIRTH_RATIO", "CAR_TO_EMPLOY_RATIO",
           "PHONE_TO_BIRTH_RATIO", "child_to_non_child_ratio", "credit_per_non_child"]
_APP_COLUMNS = ["CODE_GENDER", "NAME_FAMILY_STATUS", "NAME_INCOME_TYPE", "ORGANIZATION_TYPE", "AMT_INCOME_TOTAL", *loan.ORDER_COLUMNS, *loan.LINE_COLUMNS,
                "LANDAREA_VG", "LIVINGAPRTMENTS_AVG"]


@query("recipe_applicant_features", ops="R8 C10 F2 N6", doubles=[*_APP_DOUBLES, *_R8_NEW],
       sql=_finite_sql(_features_sql(APPLICATION_SQL, _APP_COLUMNS), [*_APP_DOUBLES, *_R8_NEW]))
def recipe_applicant_features(t, spark):
    return clean.clean_non_finite(with_features(application(t)))


def with_row_statistics(table):
    """Row statistics, the organisation's median income, non-finite values to null; the summed flags go."""
    docs, live = C.regex_columns(table, loan.DOC_FLAGS), C.regex_columns(table, loan.LIVE_FLAGS)
    recipe = loan.row_recipe(docs, live)
    table = apply(table, Recipe(steps=recipe.steps))
    table = groupstats.median_lookup(table, "ORGANIZATION_TYPE", "AMT_INCOME_TOTAL", "NEW_INC_BY_ORG")
    return clean.clean_non_finite(table).drop(*recipe.drop)


_DOCS, _LIVE = [f"FLAG_DOCUMENT_{i}" for i in (2, 3, 4, 5)], ["FLAG_MOBIL", "FLAG_PHONE", "FLAG_EMAIL"]
_R9_NEW = ["DOC_IND_KURT", "LIVE_IND_SUM", "NEW_EXT_SOURCES_MEAN", "NEW_SCORES_STD", "NEW_INC_BY_ORG"]


def _row_stats_sql(table, doubles):
    mean, n = f"(({' + '.join(_DOCS)}) / 4::DOUBLE)", len(_DOCS)
    m2, m4 = (f"(({' + '.join(f'pow({c} - {mean}, {p})' for c in _DOCS)}) / {n})" for p in (2, 4))
    ext = "((EXT_SOURCE_1 + EXT_SOURCE_2 + EXT_SOURCE_3) / 3)"
    sd = f"sqrt(({' + '.join(f'pow(EXT_SOURCE_{i} - {ext}, 2)' for i in (1, 2, 3))}) / 2)"
    org = "(PARTITION BY ORGANIZATION_TYPE)"
    return f"""
    SELECT * EXCLUDE ({', '.join(_LIVE)}) REPLACE ({', '.join(f'{S.nonfinite_null(S.q(c))} AS {S.q(c)}' for c in doubles)})
    FROM (SELECT *, CASE WHEN {m2} > 0 THEN {m4} / ({m2} * {m2}) END AS DOC_IND_KURT, ({' + '.join(_LIVE)})::DOUBLE AS LIVE_IND_SUM, {ext} AS NEW_EXT_SOURCES_MEAN, {sd} AS NEW_SCORES_STD,
                 CASE WHEN count(AMT_INCOME_TOTAL) OVER {org} = count(*) OVER {org} THEN median(AMT_INCOME_TOTAL) OVER {org} END AS NEW_INC_BY_ORG FROM ({table}) r0) r1"""


@query("recipe_row_statistics", ops="R9 C14 C15 A11 J5 F3 P3", doubles=[*_APP_DOUBLES, *_R8_NEW, *_R9_NEW],
       sql=_row_stats_sql(_features_sql(APPLICATION_SQL, _APP_COLUMNS), [*_APP_DOUBLES, *_R8_NEW]))
def recipe_row_statistics(t, spark):
    return with_row_statistics(with_features(application(t)))


# ---------------------------------------------------------------------------
# The merged table before reduction
# ---------------------------------------------------------------------------
_BUREAU_VALUES = [*loan.BUREAU_DAYS, *loan.BUREAU_AMOUNTS, *loan.BUREAU_FLAGS, *(p + c for p in loan.BUREAU_MEANS for c in (*_MEANS, *loan.BUREAU_FLAGS)), *loan.BUREAU_RATIOS]
_BUREAU_WHOLE = [*loan.BUREAU_DAYS, *loan.BUREAU_FLAGS]
_PREV_VALUES = ["AMT_APPLICATION", "AMT_CREDIT", *loan.PREVIOUS_DAYS, "APP_CREDIT_PERC"]
_MERGE_FNS = ["mean", "min", "max", "sum"]


def _child(df, values, prefix):
    out = clean.clean_non_finite(rollup(df, "SK_ID_CURR", _MERGE_FNS, "propagate", cols=values))
    return C.prefix_rename(out, prefix, ["SK_ID_CURR"])


def merged_table(t):
    """The applicants with their children's roll-ups, before any column selection."""
    children = [_child(loan.bureau_features(t), _BUREAU_VALUES, "BURO_"), _child(apply(loan.previous(t), loan.R7), _PREV_VALUES, "PREV_")]
    return with_row_statistics(with_features(rollup_join(application(t), children, "SK_ID_CURR")))


def _child_sql(table, values, whole, prefix):
    aggs = S.bundle(values, _MERGE_FNS, "propagate", int_cols=whole)
    doubles = S.bundle_doubles(values, _MERGE_FNS, whole)
    return (f"SELECT SK_ID_CURR AS {prefix}k, COLUMNS(* EXCLUDE (SK_ID_CURR)) AS \"{prefix}\\0\" FROM (SELECT * REPLACE ({', '.join(f'{S.nonfinite_null(S.q(c))} AS {S.q(c)}' for c in doubles)}) "
            f"FROM (SELECT SK_ID_CURR, {', '.join(aggs)} FROM ({table}) GROUP BY SK_ID_CURR))"), [prefix + c for c in doubles], [f"{prefix}{c}_{f}" for c in values for f in _MERGE_FNS]


_B_SQL, _B_DOUBLES, _B_NAMES = _child_sql(BUREAU_FEATURES_SQL, _BUREAU_VALUES, _BUREAU_WHOLE, "BURO_")
_P_SQL, _P_DOUBLES, _P_NAMES = _child_sql(PREVIOUS_FEATURES_SQL, _PREV_VALUES, loan.PREVIOUS_DAYS, "PREV_")
_MERGED_INNER = f"SELECT * EXCLUDE (BURO_k, PREV_k) FROM ({APPLICATION_SQL}) app LEFT JOIN ({_B_SQL}) bu ON BURO_k = SK_ID_CURR LEFT JOIN ({_P_SQL}) pr ON PREV_k = SK_ID_CURR"
_MERGED_DOUBLES = [*_APP_DOUBLES, *_B_DOUBLES, *_P_DOUBLES, *_R8_NEW]


@query("merged_before_reduction", ops="R1 R2 R3 R7 R8 R9 J1 A1", doubles=[*_MERGED_DOUBLES, *_R9_NEW],
       sql=_row_stats_sql(_features_sql(_MERGED_INNER, [*_APP_COLUMNS, *_B_NAMES, *_P_NAMES]), _MERGED_DOUBLES))
def merged_before_reduction(t, spark):
    return merged_table(t)
