"""Catalog part 1: the flagship roll-up, cleaning, scalar and row-wise operators, bundles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.operators.bundles import rollup
from tabula.plans import analog, recipes
from tabula.plans import sqlkit as S
from tabula.plans.registry import query

A = analog.SQL

# ---------------------------------------------------------------------------
# Flagship: payments roll-up joined to the applicant (R4 + A1 + J1)
# ---------------------------------------------------------------------------
_PAY_BASE = ["NUM_INSTALMENT_NUMBER", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT",
             "PAYMENT_PERC", "PAYMENT_DIFF"]
_PAY_MEANS = _PAY_BASE  # columns whose per-bin means are joined back
_PAY_ALL = _PAY_BASE + ["DPD", "DBD", "DPD_cut", "DBD_cut"] + \
    [f"DBD_cut_{c}" for c in _PAY_MEANS] + [f"DPD_cut_{c}" for c in _PAY_MEANS]
_PAY_INTS = ["NUM_INSTALMENT_NUMBER", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "DPD_cut", "DBD_cut"]
_CANON = ["mean", "var", "min", "max", "sum", "n_distinct"]
_APP_COLS = ["SK_ID_CURR", "CODE_GENDER", "ORGANIZATION_TYPE", "AMT_INCOME_TOTAL", "AMT_CREDIT"]


def _payments_rollup_sql() -> str:
    rows = f"""
      SELECT SK_ID_CURR, NUM_INSTALMENT_NUMBER, DAYS_INSTALMENT, DAYS_ENTRY_PAYMENT, AMT_INSTALMENT, AMT_PAYMENT,
             {S.div('AMT_PAYMENT', 'AMT_INSTALMENT')} AS PAYMENT_PERC,
             AMT_INSTALMENT - AMT_PAYMENT AS PAYMENT_DIFF,
             {S.clamp0('DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT')} AS DPD,
             {S.clamp0('DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT')} AS DBD
      FROM ({A['installments']}) i"""
    cuts = f"""SELECT *, {S.cut('DPD', recipes.DPD_BREAKS)} AS DPD_cut, {S.cut('DBD', recipes.DBD_BREAKS)} AS DBD_cut
               FROM ({rows}) r"""
    means = {
        cut: f"SELECT {cut} AS __k, " + ", ".join(f"{S.agg('mean', c)} AS {cut}_{c}" for c in _PAY_MEANS)
             + f" FROM pay GROUP BY {cut}"
        for cut in ("DBD_cut", "DPD_cut")
    }
    codes = {
        cut: f"SELECT v, row_number() OVER (ORDER BY v)::INTEGER AS code FROM "
             f"(SELECT DISTINCT {cut} AS v FROM pay WHERE {cut} IS NOT NULL) d"
        for cut in ("DBD_cut", "DPD_cut")
    }
    joined = f"""
      SELECT p.* REPLACE (cdpd.code AS DPD_cut, cdbd.code AS DBD_cut),
             {", ".join(f"mb.DBD_cut_{c}" for c in _PAY_MEANS)},
             {", ".join(f"mp.DPD_cut_{c}" for c in _PAY_MEANS)}
      FROM pay p
      LEFT JOIN ({means['DBD_cut']}) mb ON p.DBD_cut IS NOT DISTINCT FROM mb.__k
      LEFT JOIN ({means['DPD_cut']}) mp ON p.DPD_cut IS NOT DISTINCT FROM mp.__k
      LEFT JOIN ({codes['DBD_cut']}) cdbd ON p.DBD_cut = cdbd.v
      LEFT JOIN ({codes['DPD_cut']}) cdpd ON p.DPD_cut = cdpd.v"""
    agg = f"SELECT SK_ID_CURR, {', '.join(S.bundle(_PAY_ALL, _CANON, int_cols=_PAY_INTS))} FROM enriched GROUP BY SK_ID_CURR"
    doubles = S.bundle_doubles(_PAY_ALL, _CANON, _PAY_INTS)
    cleaned = "SELECT * REPLACE (" + ", ".join(f"{S.nonfinite_null(S.q(c))} AS {S.q(c)}" for c in doubles) + ") FROM rolled"
    return f"""
      WITH pay AS ({cuts}), enriched AS ({joined}), rolled AS ({agg}), cleaned AS ({cleaned})
      SELECT {", ".join('a.' + c for c in _APP_COLS)}, c.* EXCLUDE (SK_ID_CURR)
      FROM ({A['applicants']}) a LEFT JOIN cleaned c ON a.SK_ID_CURR = c.SK_ID_CURR"""


@query("payments_rollup_to_applicant", ops="R4 S1 F2 C1 C5 C7 A6 J3 E1 A1 C12 J1",
       sql=_payments_rollup_sql(),
       doubles=["AMT_INCOME_TOTAL", "AMT_CREDIT"] + S.bundle_doubles(_PAY_ALL, _CANON, _PAY_INTS))
def payments_rollup_to_applicant(t, spark):
    app = analog.applicants(t).select(*_APP_COLS)
    return app.join(recipes.payments_rollup(analog.installments(t)), "SK_ID_CURR", "left")


# ---------------------------------------------------------------------------
# Cleaning (F1-F7)
# ---------------------------------------------------------------------------
from tabula.functions import columns as C  # noqa: E402
from tabula.functions import rowwise as R  # noqa: E402
from tabula.functions import scalars as X  # noqa: E402
from tabula.operators import clean  # noqa: E402
from tabula.operators.encode import apply_dummies, label_encode, onehot  # noqa: E402

_LI_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LI_DOUBLES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LI_SENTINEL_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS l_quantity, l_extendedprice,
           CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS l_discount,
           CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS l_tax
    FROM lineitem"""


def _lineitem_sentinels(t):
    li = t["lineitem"].select(*_LI_COLS)
    return clean.null_out(li, {"l_quantity": F.col("l_quantity") > 45,
                               "l_discount": F.col("l_discount") == 0,
                               "l_tax": F.col("l_tax") == 0})


@query("sentinel_null_out", ops="F2", sql=_LI_SENTINEL_SQL, doubles=_LI_DOUBLES)
def sentinel_null_out(t, spark):
    return _lineitem_sentinels(t)


@query("dropna_any", ops="F2 F4", sql=f"SELECT * FROM ({_LI_SENTINEL_SQL}) s "
       "WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL", doubles=_LI_DOUBLES)
def dropna_any(t, spark):
    return clean.dropna_any(_lineitem_sentinels(t))


@query("filter_not_equal", ops="F1 N15",
       sql=f"""SELECT SK_ID_CURR, CODE_GENDER, ORGANIZATION_TYPE, OCCUPATION_TYPE FROM ({A['applicant_base']}) a
               WHERE CODE_GENDER <> 'HOUSEHOLD' AND ORGANIZATION_TYPE <> 'NATION_3' AND OCCUPATION_TYPE <> 'NATION_7'""")
def filter_not_equal(t, spark):
    a = analog.applicant_base(t).select("SK_ID_CURR", "CODE_GENDER", "ORGANIZATION_TYPE", "OCCUPATION_TYPE")
    return clean.filter_not_equal(a, {"CODE_GENDER": "HOUSEHOLD", "ORGANIZATION_TYPE": "NATION_3",
                                      "OCCUPATION_TYPE": "NATION_7"})


@query("fill_category", ops="F5",
       sql=f"""SELECT SK_ID_CURR, CODE_GENDER, coalesce(OCCUPATION_TYPE, 'nadata') AS OCCUPATION_TYPE
               FROM ({A['applicant_base']}) a""")
def fill_category(t, spark):
    a = analog.applicant_base(t).select("SK_ID_CURR", "CODE_GENDER", "OCCUPATION_TYPE")
    return clean.fill_category(a, "nadata")


@query("fill_zero", ops="J1 F6",
       sql="""SELECT c.c_custkey AS SK_ID_CURR, coalesce(e.n_events, 0) AS n_events, coalesce(e.value_sum, 0) AS value_sum
              FROM customer c LEFT JOIN (SELECT user_id, count(*) AS n_events, sum(value) AS value_sum
                                         FROM events GROUP BY user_id) e ON c.c_custkey = e.user_id""",
       doubles=["value_sum"])
def fill_zero(t, spark):
    ev = t["events"].groupBy(F.col("user_id").alias("SK_ID_CURR")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("value_sum"))
    c = t["customer"].select(F.col("c_custkey").alias("SK_ID_CURR"))
    return clean.fill_zero(c.join(ev, "SK_ID_CURR", "left"))


# ---------------------------------------------------------------------------
# Scalars (C1-C7, C11, C12)
# ---------------------------------------------------------------------------
# The power-transform exponents of the application recipe.
_POWERS = {"p30": 30.0, "p3": 3.0, "pm200": -1 / 200, "p40": 1 / 40, "p3r": 1 / 3, "p25": 1 / 2.5,
           "p22": 1 / 2.2, "p5": 1 / 5, "p35": 1 / 3.5, "p7": 1 / 7}


def _power_exprs_sql() -> list[str]:
    base = {"p30": "1 - l_discount", "p3": "l_tax", "pm200": "l_tax", "p40": "l_discount",
            "p3r": "l_quantity / 50", "p25": "l_discount * 10", "p22": "l_tax * 10", "p5": "l_discount",
            "p35": "l_extendedprice / 100000", "p7": "l_tax - 0.04"}
    out = [f"sqrt(l_tax) AS sqrt_tax",
           f"sqrt(abs((l_shipdate::DATE - DATE '{analog.EPOCH}')::INTEGER)) AS sqrt_abs_days",
           "ln(1 + 50 * l_discount) AS log1p_disc"]
    out += [f"pow(({base[k]})::DOUBLE, {e!r}) AS {k}" for k, e in _POWERS.items()]
    return out


_POW_OUT = ["sqrt_tax", "sqrt_abs_days", "log1p_disc"] + list(_POWERS)


def power_transforms(t, spark):
    li = t["lineitem"]
    base = {"p30": F.lit(1.0) - F.col("l_discount"), "p3": F.col("l_tax"), "pm200": F.col("l_tax"),
            "p40": F.col("l_discount"), "p3r": F.col("l_quantity") / 50, "p25": F.col("l_discount") * 10,
            "p22": F.col("l_tax") * 10, "p5": F.col("l_discount"), "p35": F.col("l_extendedprice") / 100000,
            "p7": F.col("l_tax") - 0.04}
    out = li.select(
        "l_orderkey", "l_linenumber",
        X.safe_sqrt("l_tax").alias("sqrt_tax"),
        X.safe_sqrt(F.abs(X.days_since("l_shipdate", analog.EPOCH))).alias("sqrt_abs_days"),
        X.safe_log1p(F.col("l_discount") * 50).alias("log1p_disc"),
        *[X.power(base[k], e).alias(k) for k, e in _POWERS.items()])
    return clean.clean_non_finite(out)


_POWER_SQL = ("SELECT l_orderkey, l_linenumber, "
              + ", ".join(S.nonfinite_null(e.rsplit(" AS ", 1)[0]) + " AS " + e.rsplit(" AS ", 1)[1]
                          for e in _power_exprs_sql())
              + " FROM lineitem")
query("power_transforms", ops="R2 C2 C3 C4 C12 N9 N10", sql=_POWER_SQL, doubles=_POW_OUT)(power_transforms)


@query("ratio_ieee", ops="C1 N6 C12",
       sql=f"""SELECT l_orderkey, l_linenumber, {S.nonfinite_null('r')} AS ratio,
                      CASE WHEN isnan(r) THEN 'nan' WHEN r = 'inf'::DOUBLE THEN 'inf'
                           WHEN r = '-inf'::DOUBLE THEN '-inf' ELSE 'finite' END AS kind
               FROM (SELECT l_orderkey, l_linenumber, {S.div('l_tax - 0.04', 'l_discount')} AS r FROM lineitem) x""",
       doubles=["ratio"])
def ratio_ieee(t, spark):
    r = X.ieee_divide(F.col("l_tax") - 0.04, F.col("l_discount"))
    li = t["lineitem"].select("l_orderkey", "l_linenumber", r.alias("r"))
    kind = (F.when(F.col("r").isNaN(), "nan").when(F.col("r") == float("inf"), "inf")
            .when(F.col("r") == float("-inf"), "-inf").otherwise("finite"))
    return li.select("l_orderkey", "l_linenumber", X.non_finite_to_null("r").alias("ratio"), kind.alias("kind"))


_PAY_ROWS_SQL = f"""
    SELECT SK_ID_CURR, NUM_INSTALMENT_NUMBER, DAYS_INSTALMENT, DAYS_ENTRY_PAYMENT,
           {S.clamp0('DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT')} AS DPD,
           {S.clamp0('DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT')} AS DBD
    FROM ({A['installments']}) i"""


@query("clamp_dpd_dbd", ops="C5", sql=_PAY_ROWS_SQL, doubles=["DPD", "DBD"])
def clamp_dpd_dbd(t, spark):
    return recipes.payment_rows(analog.installments(t)).select(
        "SK_ID_CURR", "NUM_INSTALMENT_NUMBER", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "DPD", "DBD")


@query("cut_right_closed", ops="C7",
       sql=f"""SELECT SK_ID_CURR, NUM_INSTALMENT_NUMBER, DPD, DBD, {S.cut('DPD', recipes.DPD_BREAKS)} AS DPD_cut,
                      {S.cut('DBD', recipes.DBD_BREAKS)} AS DBD_cut FROM ({_PAY_ROWS_SQL}) p""",
       doubles=["DPD", "DBD"])
def cut_right_closed(t, spark):
    return recipes.payment_rows(analog.installments(t)).select(
        "SK_ID_CURR", "NUM_INSTALMENT_NUMBER", "DPD", "DBD", "DPD_cut", "DBD_cut")


@query("age_buckets", ops="C11 C7",
       sql=f"""SELECT SK_ID_CURR, age, {S.cut('age', recipes.AGE_BREAKS)} AS age_bucket
               FROM (SELECT SK_ID_CURR, (c_acctbal / 100) + 20 AS age FROM ({A['applicant_base']}) a) x""",
       doubles=["age"])
def age_buckets(t, spark):
    a = analog.applicant_base(t).select("SK_ID_CURR", (F.col("c_acctbal") / 100 + 20).alias("age"))
    return a.withColumn("age_bucket", X.cut_right_closed("age", recipes.AGE_BREAKS))


@query("flags_from_threshold", ops="C6",
       sql=f"""SELECT SK_ID_BUREAU, (CREDIT_ACTIVE <> 'F')::INTEGER AS CREDIT_ACTIVE_BINARY,
                      (DAYS_CREDIT > -1000)::INTEGER AS DAYS_CREDIT_RECENT FROM ({A['bureau']}) b""")
def flags_from_threshold(t, spark):
    b = analog.bureau(t)
    return b.select("SK_ID_BUREAU", X.flag(F.col("CREDIT_ACTIVE") != "F").alias("CREDIT_ACTIVE_BINARY"),
                    X.flag(F.col("DAYS_CREDIT") > -1000).alias("DAYS_CREDIT_RECENT"))


@query("non_finite_to_null", ops="C12 F3",
       sql=f"""SELECT l_orderkey, l_linenumber,
                      {S.nonfinite_null(S.div('l_tax', 'l_discount'))} AS tax_per_disc,
                      {S.nonfinite_null('pow(l_tax::DOUBLE, -0.005)')} AS tax_pow
               FROM lineitem""", doubles=["tax_per_disc", "tax_pow"])
def non_finite_to_null(t, spark):
    li = t["lineitem"].select("l_orderkey", "l_linenumber",
                              X.ieee_divide("l_tax", "l_discount").alias("tax_per_disc"),
                              X.power("l_tax", -0.005).alias("tax_pow"))
    return clean.clean_non_finite(li)


# ---------------------------------------------------------------------------
# Row-wise statistics and regex column selection (R9: C14, C15, P3, P4)
# ---------------------------------------------------------------------------
# Flag columns named like the application's document / contact flags.
_FLAG_DEFS_SQL = {
    "FLAG_DOCUMENT_R": "(l_returnflag = 'R')::INTEGER", "FLAG_DOCUMENT_A": "(l_returnflag = 'A')::INTEGER",
    "FLAG_DOCUMENT_F": "(l_linestatus = 'F')::INTEGER", "FLAG_DOCUMENT_D": "(l_discount > 0.05)::INTEGER",
    "FLAG_EMP_PHONE": "(l_tax > 0.04)::INTEGER", "FLAG_OWN_QTY": "(l_quantity > 25)::INTEGER",
    "NFLAG_LAST_LINE": "(l_linenumber = 1)::INTEGER", "REG_FLAG_SHIP": "(l_shipdate > TIMESTAMP '1998-01-01')::INTEGER",
}


def _flag_frame(t):
    l = t["lineitem"]
    defs = {"FLAG_DOCUMENT_R": F.col("l_returnflag") == "R", "FLAG_DOCUMENT_A": F.col("l_returnflag") == "A",
            "FLAG_DOCUMENT_F": F.col("l_linestatus") == "F", "FLAG_DOCUMENT_D": F.col("l_discount") > 0.05,
            "FLAG_EMP_PHONE": F.col("l_tax") > 0.04, "FLAG_OWN_QTY": F.col("l_quantity") > 25,
            "NFLAG_LAST_LINE": F.col("l_linenumber") == 1,
            "REG_FLAG_SHIP": F.col("l_shipdate") > F.lit("1998-01-01").cast("timestamp")}
    return l.select("l_orderkey", "l_linenumber", *[X.flag(c).alias(n) for n, c in defs.items()])


# The two column-name patterns of the row statistics recipe.
DOC_PATTERN = "FLAG_DOC"
LIVE_PATTERN = "(?!NFLAG_)(?!FLAG_DOC)(?!_FLAG_)FLAG_"


def _regex_sets():
    import re
    names = list(_FLAG_DEFS_SQL)
    return [n for n in names if re.search(DOC_PATTERN, n)], [n for n in names if re.search(LIVE_PATTERN, n)]


@query("regex_select", ops="P3 P4",
       sql=f"""SELECT l_orderkey, l_linenumber, {', '.join(f'{_FLAG_DEFS_SQL[c]} AS {c}' for c in _regex_sets()[1])}
               FROM lineitem""")
def regex_select(t, spark):
    f = _flag_frame(t)
    live = C.regex_columns(f, LIVE_PATTERN)
    return f.select("l_orderkey", "l_linenumber", *live)


def _row_stats_sql() -> str:
    docs, live = _regex_sets()
    flags = ", ".join(f"{e} AS {n}" for n, e in _FLAG_DEFS_SQL.items())
    n = len(docs)
    mean = f"(({' + '.join(docs)})::DOUBLE / {n})"
    m2 = " + ".join(f"pow({d} - {mean}, 2)" for d in docs)
    m4 = " + ".join(f"pow({d} - {mean}, 4)" for d in docs)
    kurt = f"CASE WHEN ({m2}) = 0 THEN NULL ELSE (({m4}) / {n}) / pow(({m2}) / {n}, 2) END"
    return f"""SELECT l_orderkey, l_linenumber, {kurt} AS DOC_IND_KURT, ({' + '.join(live)})::DOUBLE AS LIVE_IND_SUM
               FROM (SELECT l_orderkey, l_linenumber, {flags} FROM lineitem) f"""


@query("row_kurtosis", ops="R9 P3 C14 C12", sql=_row_stats_sql(), doubles=["DOC_IND_KURT", "LIVE_IND_SUM"])
def row_kurtosis(t, spark):
    f = _flag_frame(t)
    docs, live = C.regex_columns(f, DOC_PATTERN), C.regex_columns(f, LIVE_PATTERN)
    out = f.select("l_orderkey", "l_linenumber", R.row_kurtosis(docs).alias("DOC_IND_KURT"),
                   R.row_sum(live).alias("LIVE_IND_SUM"))
    return clean.clean_non_finite(out)


_EXT = ["l_quantity", "l_discount", "l_tax"]


@query("row_null_count", ops="C10 C14",
       sql=f"""SELECT l_orderkey, l_linenumber, ((l_quantity IS NULL)::INTEGER + (l_extendedprice IS NULL)::INTEGER
                      + (l_discount IS NULL)::INTEGER + (l_tax IS NULL)::INTEGER) AS na
               FROM ({_LI_SENTINEL_SQL}) s""")
def row_null_count(t, spark):
    s = _lineitem_sentinels(t)
    return s.select("l_orderkey", "l_linenumber",
                    R.row_null_count(["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).alias("na"))


@query("row_sum_mean_sd", ops="C14 N16",
       sql=f"""SELECT l_orderkey, l_linenumber, (l_quantity + l_discount + l_tax) AS row_sum,
                      (l_quantity + l_discount + l_tax) / 3 AS row_mean,
                      sqrt((pow(l_quantity - (l_quantity + l_discount + l_tax) / 3, 2)
                          + pow(l_discount - (l_quantity + l_discount + l_tax) / 3, 2)
                          + pow(l_tax - (l_quantity + l_discount + l_tax) / 3, 2)) / 2) AS row_sd
               FROM ({_LI_SENTINEL_SQL}) s""", doubles=["row_sum", "row_mean", "row_sd"])
def row_sum_mean_sd(t, spark):
    s = _lineitem_sentinels(t)
    return s.select("l_orderkey", "l_linenumber", R.row_sum(_EXT).alias("row_sum"),
                    R.row_mean(_EXT).alias("row_mean"), R.row_sd(_EXT).alias("row_sd"))


_MED_SQL = ["l_discount * 10", "l_tax * 10", "l_quantity / 50", "l_extendedprice / 100000", "l_linenumber / 7"]


@query("row_median", ops="C15",
       sql=f"""SELECT l_orderkey, l_linenumber, list_sort([{', '.join(f'({e})::DOUBLE' for e in _MED_SQL)}])[3] AS row_median
               FROM lineitem""", doubles=["row_median"])
def row_median(t, spark):
    cols = [F.col("l_discount") * 10, F.col("l_tax") * 10, F.col("l_quantity") / 50,
            F.col("l_extendedprice") / 100000, F.col("l_linenumber") / 7]
    return t["lineitem"].select("l_orderkey", "l_linenumber", R.row_median(cols).alias("row_median"))
