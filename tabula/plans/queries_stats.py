"""Catalog part 2: bundles, nested roll-up, encoders, group statistics, column statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.functions import columns as C
from tabula.functions.aggregates import BUNDLES
from tabula.operators import clean, groupstats
from tabula.operators.bundles import nested_rollup, rollup
from tabula.operators.encode import apply_dummies, fit_dummies, ints_as_category, label_encode, onehot
from tabula.operators.split import hash_split
from tabula.plans import analog
from tabula.plans import sqlkit as S
from tabula.plans.registry import query
from tabula.session import keep

A = analog.SQL
SPLIT_SQL = "(('0x' || substr(md5(concat({k}::VARCHAR, ':', '42')), 1, 8))::BIGINT < {thr})"


def split_sql(key: str, p: float) -> str:
    return SPLIT_SQL.format(k=key, thr=int(p * 2 ** 32))


# ---------------------------------------------------------------------------
# Encoded bureau (E1 + F2): the input of the bundle queries
# ---------------------------------------------------------------------------
def bureau_encoded(t):
    b = analog.bureau(t)
    b = clean.null_out(b, {"AMT_CREDIT_SUM": F.col("AMT_CREDIT_SUM") < 10000})
    return label_encode(b, ["CREDIT_ACTIVE", "CREDIT_TYPE"])


def _codes_sql(src: str, col: str) -> str:
    return (f"SELECT v, row_number() OVER (ORDER BY v)::INTEGER AS code "
            f"FROM (SELECT DISTINCT {col} AS v FROM {src} WHERE {col} IS NOT NULL) d")


BUREAU_ENC_SQL = f"""
    WITH b AS ({A['bureau']})
    SELECT b.SK_ID_CURR, b.SK_ID_BUREAU, ca.code AS CREDIT_ACTIVE, ct.code AS CREDIT_TYPE, b.DAYS_CREDIT,
           CASE WHEN b.AMT_CREDIT_SUM < 10000 THEN NULL ELSE b.AMT_CREDIT_SUM END AS AMT_CREDIT_SUM
    FROM b LEFT JOIN ({_codes_sql('b', 'CREDIT_ACTIVE')}) ca ON b.CREDIT_ACTIVE = ca.v
           LEFT JOIN ({_codes_sql('b', 'CREDIT_TYPE')}) ct ON b.CREDIT_TYPE = ct.v"""
_B_COLS = ["CREDIT_ACTIVE", "CREDIT_TYPE", "DAYS_CREDIT", "AMT_CREDIT_SUM"]
_B_INTS = ["CREDIT_ACTIVE", "CREDIT_TYPE", "DAYS_CREDIT"]


@query("label_encode", ops="E1 C8", sql=BUREAU_ENC_SQL, doubles=["AMT_CREDIT_SUM"])
def label_encode_q(t, spark):
    return bureau_encoded(t)


@query("conditional_mutate_by_type", ops="P9 E1",
       sql=f"""WITH a AS ({A['applicant_base']})
               SELECT a.SK_ID_CURR, g.code AS CODE_GENDER, o.code AS ORGANIZATION_TYPE, e.code AS NAME_EDUCATION_TYPE,
                      oc.code AS OCCUPATION_TYPE, a.AMT_INCOME_TOTAL, a.c_acctbal
               FROM a LEFT JOIN ({_codes_sql('a', 'CODE_GENDER')}) g ON a.CODE_GENDER = g.v
                      LEFT JOIN ({_codes_sql('a', 'ORGANIZATION_TYPE')}) o ON a.ORGANIZATION_TYPE = o.v
                      LEFT JOIN ({_codes_sql('a', 'NAME_EDUCATION_TYPE')}) e ON a.NAME_EDUCATION_TYPE = e.v
                      LEFT JOIN ({_codes_sql('a', 'OCCUPATION_TYPE')}) oc ON a.OCCUPATION_TYPE = oc.v""",
       doubles=["AMT_INCOME_TOTAL", "c_acctbal"])
def conditional_mutate_by_type(t, spark):
    a = analog.applicant_base(t)
    return label_encode(a, C.string_columns(a))


@query("prefix_rename", ops="P6 P1",
       sql=f"SELECT SK_ID_CURR, {', '.join(f'{c} AS BUREAU_{c}' for c in _B_COLS)} FROM ({BUREAU_ENC_SQL}) b",
       doubles=["BUREAU_AMT_CREDIT_SUM"])
def prefix_rename(t, spark):
    return C.prefix_rename(bureau_encoded(t).drop("SK_ID_BUREAU"), "BUREAU_", keys=["SK_ID_CURR"])


# ---------------------------------------------------------------------------
# Bundles A1-A5 (by applicant over the encoded bureau)
# ---------------------------------------------------------------------------
def _bundle_sql(fns, nulls):
    src = f"SELECT * EXCLUDE (SK_ID_BUREAU) FROM ({BUREAU_ENC_SQL}) b"
    if S.MOMENTS & set(fns):
        src = S.with_group_means(src, ["SK_ID_CURR"], _B_COLS)
    return f"SELECT SK_ID_CURR, {', '.join(S.bundle(_B_COLS, fns, nulls, int_cols=_B_INTS))} FROM ({src}) s GROUP BY SK_ID_CURR"


def _register_bundle(name, bundle, nulls, ops):
    fns = BUNDLES[bundle]

    def build(t, spark):
        return rollup(bureau_encoded(t).drop("SK_ID_BUREAU"), "SK_ID_CURR", bundle, nulls)
    query(name, ops=ops, sql=_bundle_sql(fns, nulls), doubles=S.bundle_doubles(_B_COLS, fns, _B_INTS))(build)


_register_bundle("bundle_mean_var_min_max_sum_nd", "canonical", "propagate", "A1 N1 N3 N11")
_register_bundle("bundle_skip_nulls_sd", "sd", "skip", "A2 N2")
_register_bundle("bundle_median", "median", "skip", "A3")
_register_bundle("bundle_moments", "moments", "skip", "A4 N12 N13")
_register_bundle("bundle_nine", "nine", "skip", "A5")


# ---------------------------------------------------------------------------
# Nested roll-up A12 + J2: bureau_balance -> bureau -> applicant
# ---------------------------------------------------------------------------
_BB_LEVELS = ["A", "N", "R"]
_BB_COLS = ["MONTHS_BALANCE", "AMT_BALANCE"] + [f"STATUS_{v}" for v in _BB_LEVELS]
_CANON = BUNDLES["canonical"]
_INNER_OUT = [f"{c}_{f}" for c in _BB_COLS for f in _CANON]
_INNER_INTS = ["MONTHS_BALANCE_min", "MONTHS_BALANCE_max", "MONTHS_BALANCE_sum"] + \
    [f"{c}_n_distinct" for c in _BB_COLS]
_OUTER_COLS = _B_COLS + _INNER_OUT
_OUTER_INTS = _B_INTS + _INNER_INTS


def _nested_sql() -> str:
    bb = (f"SELECT SK_ID_BUREAU, MONTHS_BALANCE, AMT_BALANCE, "
          + ", ".join(f"(STATUS = '{v}')::DOUBLE AS STATUS_{v}" for v in _BB_LEVELS)
          + f" FROM ({A['bureau_balance']}) x")
    inner = (f"SELECT SK_ID_BUREAU, {', '.join(S.bundle(_BB_COLS, _CANON, int_cols=['MONTHS_BALANCE']))} "
             f"FROM ({bb}) bb GROUP BY SK_ID_BUREAU")
    # the outer bundle counts distinct computed doubles: round them openly, as the Spark side does
    inner = S.stable(inner, S.bundle_doubles(_BB_COLS, _CANON, ["MONTHS_BALANCE"]))
    child = (f"SELECT b.* EXCLUDE (SK_ID_BUREAU), i.* EXCLUDE (SK_ID_BUREAU) FROM ({BUREAU_ENC_SQL}) b "
             f"LEFT JOIN ({inner}) i ON b.SK_ID_BUREAU = i.SK_ID_BUREAU")
    return (f"SELECT SK_ID_CURR, {', '.join(S.bundle(_OUTER_COLS, _CANON, int_cols=_OUTER_INTS))} "
            f"FROM ({child}) c GROUP BY SK_ID_CURR")


def rounded_doubles(df):
    return C.map_columns(df, lambda c, _: X.sig_round(c), C.columns_of_type(df, *C.FLOATING))


@query("nested_rollup", ops="E2 A12 J2 A1", sql=_nested_sql(),
       doubles=S.bundle_doubles(_OUTER_COLS, _CANON, _OUTER_INTS))
def nested_rollup_q(t, spark):
    bb = onehot(analog.bureau_balance(t), max_levels=10)
    return nested_rollup(bb, bureau_encoded(t), "SK_ID_BUREAU", "SK_ID_CURR", inner_map=rounded_doubles)


# ---------------------------------------------------------------------------
# Encoders E2-E5
# ---------------------------------------------------------------------------
def previous_apps(t):
    """Categorical application history analog: lineitem ⋈ part ⋈ orders."""
    l, p, o = t["lineitem"], t["part"], t["orders"]
    j = (l.join(p, F.col("l_partkey") == F.col("p_partkey"))
         .join(o, F.col("l_orderkey") == F.col("o_orderkey")))
    return j.select(F.col("o_custkey").alias("SK_ID_CURR"), F.col("l_orderkey").alias("SK_ID_PREV"),
                    "l_linenumber", "l_quantity", "p_size", "l_returnflag", "l_linestatus", "o_orderpriority",
                    "p_type", "p_brand")


PREV_SQL = """
    SELECT o.o_custkey AS SK_ID_CURR, l.l_orderkey AS SK_ID_PREV, l.l_linenumber, l.l_quantity, p.p_size,
           l.l_returnflag, l.l_linestatus, o.o_orderpriority, p.p_type, p.p_brand
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey"""
# Levels present in the provided tables (used only to spell out the oracle's columns).
_PRIO = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _dummy_sql(col, levels, dtype="DOUBLE"):
    import re
    return [f"({col} = '{v}')::{dtype} AS {col}_{re.sub(r'[^0-9A-Za-z]+', '_', v).strip('_')}" for v in levels]


_ONEHOT_DUMMIES = (_dummy_sql("l_returnflag", ["A", "N", "R"]) + _dummy_sql("l_linestatus", ["F", "O"])
                   + _dummy_sql("o_orderpriority", _PRIO))


@query("onehot_max_levels", ops="E2",
       sql=f"SELECT SK_ID_CURR, SK_ID_PREV, l_linenumber, l_quantity, p_size, {', '.join(_ONEHOT_DUMMIES)} FROM ({PREV_SQL}) x",
       doubles=["l_quantity"] + [d.rsplit(" AS ", 1)[1] for d in _ONEHOT_DUMMIES])
def onehot_max_levels(t, spark):
    return onehot(previous_apps(t), max_levels=5)


_APP_DUMMIES = _dummy_sql("CODE_GENDER", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"], "INTEGER") + \
    _dummy_sql("NAME_EDUCATION_TYPE", ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"], "INTEGER")


@query("dummies_fit_transform", ops="E3 E4 L2",
       sql=f"""SELECT SK_ID_CURR, CASE WHEN {split_sql('SK_ID_CURR', 0.8)} THEN 'train' ELSE 'test' END AS split,
                      {', '.join(_APP_DUMMIES)} FROM ({A['applicant_base']}) a""")
def dummies_fit_transform(t, spark):
    a = hash_split(analog.applicant_base(t), "SK_ID_CURR", 0.8, labels=("train", "test"))
    cols = ["CODE_GENDER", "NAME_EDUCATION_TYPE"]
    levels = fit_dummies(a.where(F.col("split") == "train"), cols)      # fit on train only
    return apply_dummies(a.select("SK_ID_CURR", "split", *cols), levels)  # apply to every split


@query("int_flags_as_category", ops="E5 E3",
       sql=f"""SELECT l_orderkey, {', '.join(f"(l_linenumber = {i})::INTEGER AS l_linenumber_{i}" for i in range(1, 8))}
               FROM lineitem""")
def int_flags_as_category(t, spark):
    li = ints_as_category(t["lineitem"].select("l_orderkey", "l_linenumber"), ["l_linenumber"])
    return apply_dummies(li, fit_dummies(li, ["l_linenumber"]))


# ---------------------------------------------------------------------------
# Category statistics joined back (A6-A8 + J3/J4, recipe R3)
# ---------------------------------------------------------------------------
def bureau_flags(t):
    b = analog.bureau(t)
    b = clean.null_out(b, {"AMT_CREDIT_SUM": F.col("AMT_CREDIT_SUM") < 10000})
    return b.select("SK_ID_BUREAU", "CREDIT_ACTIVE", "CREDIT_TYPE", "DAYS_CREDIT", "AMT_CREDIT_SUM",
                    (F.col("CREDIT_ACTIVE") != "F").cast("int").alias("CREDIT_ACTIVE_BINARY"),
                    (F.col("DAYS_CREDIT") > -1000).cast("int").alias("DAYS_CREDIT_RECENT"))


BUREAU_FLAGS_SQL = f"""
    SELECT SK_ID_BUREAU, CREDIT_ACTIVE, CREDIT_TYPE, DAYS_CREDIT,
           CASE WHEN AMT_CREDIT_SUM < 10000 THEN NULL ELSE AMT_CREDIT_SUM END AS AMT_CREDIT_SUM,
           (CREDIT_ACTIVE <> 'F')::INTEGER AS CREDIT_ACTIVE_BINARY, (DAYS_CREDIT > -1000)::INTEGER AS DAYS_CREDIT_RECENT
    FROM ({A['bureau']}) b"""
_BF_VALS = ["DAYS_CREDIT", "AMT_CREDIT_SUM", "CREDIT_ACTIVE_BINARY", "DAYS_CREDIT_RECENT"]
_BF_INTS = ["DAYS_CREDIT", "CREDIT_ACTIVE_BINARY", "DAYS_CREDIT_RECENT"]


def _cat_sql(keys, prefix, fns):
    names = [(c, c if len(fns) == 1 else f"{c}_{fn}", fn) for c in _BF_VALS for fn in fns]
    exprs = []
    for c, n, fn in names:
        e = S.agg(fn, S.q(c))
        if fn == "sum" and c in _BF_INTS:
            e = f"({e})::BIGINT"
        exprs.append(f"{e} AS {prefix}{n}")
    stats = f"SELECT {', '.join(keys)}, {', '.join(exprs)} FROM bf GROUP BY {', '.join(keys)}"
    on = " AND ".join(f"bf.{k} IS NOT DISTINCT FROM s.{k}" for k in keys)
    cols = ", ".join(f"s.{prefix}{n}" for _, n, _ in names)
    sql = f"WITH bf AS ({BUREAU_FLAGS_SQL}) SELECT bf.*, {cols} FROM bf LEFT JOIN ({stats}) s ON {on}"
    doubles = ["AMT_CREDIT_SUM"] + [f"{prefix}{n}" for c, n, fn in names
                                    if fn != "sum" or c not in _BF_INTS]
    return sql, doubles


def _register_cat(name, keys, prefix, fns, ops):
    sql, doubles = _cat_sql(keys, prefix, fns)

    def build(t, spark):
        return groupstats.add_category_stats(bureau_flags(t), keys, _BF_VALS, fns, "propagate", prefix)
    query(name, ops=ops, sql=sql, doubles=doubles)(build)


_register_cat("category_means_joinback", ["CREDIT_TYPE"], "TYPE_", ("mean",), "R3 A6 P6 J3")
_register_cat("category_means_two_keys", ["CREDIT_ACTIVE", "CREDIT_TYPE"], "CURRENCY_TYPE_", ("mean",), "A7 J4")
_register_cat("category_mean_var_sum", ["CREDIT_TYPE"], "TYPE_", ("mean", "var", "sum"), "A8 J3")


# ---------------------------------------------------------------------------
# Applicant features and group statistics (R8 subset, R10: A9/A10 + J4, A11 + J5)
# ---------------------------------------------------------------------------
from tabula.functions import rowwise as R  # noqa: E402
from tabula.functions import scalars as X  # noqa: E402
from tabula.plans import recipes  # noqa: E402


def applicant_features(t):
    a = analog.applicants(t)
    a = a.withColumns({
        "age_bucket": X.cut_right_closed(-F.col("DAYS_BIRTH") / 50, recipes.AGE_BREAKS),
        "credit_per_person": X.ieee_divide("AMT_CREDIT", "CNT_FAM_MEMBERS"),
        "credit_per_child": X.ieee_divide(F.col("AMT_CREDIT"), F.col("CNT_CHILDREN") + 1),
        "PAYMENT_RATE": X.ieee_divide("AMT_ANNUITY", "AMT_CREDIT"),
        "NEW_EXT_SOURCES_MEAN": R.row_mean(["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]),
    })
    return a


APP_FEATURES_SQL = f"""
    SELECT *, {S.cut('(-DAYS_BIRTH / 50)', recipes.AGE_BREAKS)} AS age_bucket,
           {S.div('AMT_CREDIT', 'CNT_FAM_MEMBERS')} AS credit_per_person,
           {S.div('AMT_CREDIT', 'CNT_CHILDREN + 1')} AS credit_per_child,
           {S.div('AMT_ANNUITY', 'AMT_CREDIT')} AS PAYMENT_RATE,
           (EXT_SOURCE_1 + EXT_SOURCE_2 + EXT_SOURCE_3) / 3 AS NEW_EXT_SOURCES_MEAN
    FROM ({A['applicants']}) a"""

# The ten group statistics of the recipe (output suffix -> input column).
# The last one averages credit_per_child although it is named after the car age.
GROUP_STAT_INPUTS = {
    "credit": "AMT_CREDIT", "INCOME_TOTAL": "AMT_INCOME_TOTAL", "credit_per_person": "credit_per_person",
    "credit_per_child": "credit_per_child", "PAYMENT_RATE": "PAYMENT_RATE",
    "NEW_EXT_SOURCES_MEAN": "NEW_EXT_SOURCES_MEAN", "EXT_SOURCE_1_MEAN": "EXT_SOURCE_1",
    "EXT_SOURCE_2_MEAN": "EXT_SOURCE_2", "EXT_SOURCE_3_MEAN": "EXT_SOURCE_3", "OWN_CAR_AGE": "credit_per_child",
}
# The grouping blocks (output prefix -> keys).
GROUP_BLOCKS = {
    "age_sex_": ["age_bucket", "CODE_GENDER"],
    "edu_sex_": ["NAME_EDUCATION_TYPE", "CODE_GENDER"],
    "org_sex_": ["ORGANIZATION_TYPE", "CODE_GENDER"],
    "org_edu_": ["ORGANIZATION_TYPE", "NAME_EDUCATION_TYPE"],
    "occ_": ["OCCUPATION_TYPE"],
}
VAR_BLOCKS = {"age_": ["age_bucket"], **GROUP_BLOCKS}
_KEYS = ["age_bucket", "CODE_GENDER", "NAME_EDUCATION_TYPE", "ORGANIZATION_TYPE", "OCCUPATION_TYPE"]


def _group_sql(blocks, with_var):
    joins, cols, doubles = [], [], []
    for i, (prefix, keys) in enumerate(blocks.items()):
        exprs = []
        for suffix, src in GROUP_STAT_INPUTS.items():
            exprs.append(f"{S.agg('mean', src)} AS {prefix}{suffix}")
            cols.append(f"g{i}.{prefix}{suffix}")
            doubles.append(prefix + suffix)
            if with_var:
                exprs.append(f"{S.agg('var', src)} AS {prefix}{suffix}_var")
                cols.append(f"g{i}.{prefix}{suffix}_var")
                doubles.append(prefix + suffix + "_var")
        stats = f"SELECT {', '.join(keys)}, {', '.join(exprs)} FROM af GROUP BY {', '.join(keys)}"
        on = " AND ".join(f"af.{k} IS NOT DISTINCT FROM g{i}.{k}" for k in keys)
        joins.append(f"LEFT JOIN ({stats}) g{i} ON {on}")
    sql = (f"WITH af AS ({APP_FEATURES_SQL}) SELECT af.SK_ID_CURR, {', '.join('af.' + k for k in _KEYS)}, "
           f"{', '.join(cols)} FROM af {' '.join(joins)}")
    return sql, doubles


def _build_group(blocks, with_var):
    def build(t, spark):
        # read by every statistics table and by the joins: keep it instead of
        # recomputing the orders roll-up once per block
        a = keep(applicant_features(t))
        exprs = {suffix: F.col(src) for suffix, src in GROUP_STAT_INPUTS.items()}
        a = groupstats.add_group_blocks(a, [(keys, groupstats.mean_stats(prefix, exprs, with_var))
                                            for prefix, keys in blocks.items()])
        names = [f"{p}{s}{v}" for p in blocks for s in GROUP_STAT_INPUTS for v in (("", "_var") if with_var else ("",))]
        return a.select("SK_ID_CURR", *_KEYS, *names)
    return build


for _name, _blocks, _var, _ops in (("group_mean_stats", GROUP_BLOCKS, False, "R10 A9 J4 N1 N4"),
                                   ("group_mean_var_stats", VAR_BLOCKS, True, "A10 J3 N4")):
    _sql, _doubles = _group_sql(_blocks, _var)
    query(_name, ops=_ops, sql=_sql, doubles=_doubles)(_build_group(_blocks, _var))


@query("group_median_lookup", ops="A11 J5",
       sql=f"""WITH a AS ({A['applicant_base']})
               SELECT a.SK_ID_CURR, a.ORGANIZATION_TYPE, m.NEW_INC_BY_ORG
               FROM a LEFT JOIN (SELECT ORGANIZATION_TYPE, {S.agg('median', 'c_acctbal')} AS NEW_INC_BY_ORG
                                 FROM a GROUP BY ORGANIZATION_TYPE) m
                      ON a.ORGANIZATION_TYPE IS NOT DISTINCT FROM m.ORGANIZATION_TYPE""",
       doubles=["NEW_INC_BY_ORG"])
def group_median_lookup(t, spark):
    a = analog.applicant_base(t)
    return groupstats.median_lookup(a, "ORGANIZATION_TYPE", "c_acctbal", "NEW_INC_BY_ORG") \
        .select("SK_ID_CURR", "ORGANIZATION_TYPE", "NEW_INC_BY_ORG")


# ---------------------------------------------------------------------------
# Bundle outputs pruned by column pattern (never computed)
# ---------------------------------------------------------------------------
_PRUNE = {"^CREDIT_(ACTIVE|TYPE)$": ["skewness", "kurtosis", "median"], "^DAYS_": ["n_distinct"]}


def _pruned_sql():
    import re
    fns = BUNDLES["nine"]
    keep = [(c, f) for c in _B_COLS for f in fns
            if not any(re.search(p, c) and f in fs for p, fs in _PRUNE.items())]
    src = S.with_group_means(f"SELECT * EXCLUDE (SK_ID_BUREAU) FROM ({BUREAU_ENC_SQL}) b", ["SK_ID_CURR"], _B_COLS)
    exprs = []
    for c, f in keep:
        e = S.agg(f, S.q(c), "skip", S.mean_col(c), integer=c in _B_INTS)
        if f == "sum" and c in _B_INTS:
            e = f"({e})::BIGINT"
        exprs.append(f"{e} AS {S.q(c + '_' + f)}")
    doubles = [f"{c}_{f}" for c, f in keep if f in S.FLOAT_FNS or (f in ("min", "max", "sum") and c not in _B_INTS)]
    return f"SELECT SK_ID_CURR, {', '.join(exprs)} FROM ({src}) s GROUP BY SK_ID_CURR", doubles


_PR_SQL, _PR_DOUBLES = _pruned_sql()


@query("bundle_pruned", ops="A13 A5", sql=_PR_SQL, doubles=_PR_DOUBLES)
def bundle_pruned(t, spark):
    return rollup(bureau_encoded(t).drop("SK_ID_BUREAU"), "SK_ID_CURR", "nine", "skip", prune=_PRUNE)
