"""The canonical recipes R1-R3 and R7-R9 as configuration, and the wide entities they read.

The entities are derived from the given tables like those of ``analog``, with all columns that the recipes
name.  Their aggregates are written in SQL that both engines read, ``{day}`` being the day offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.functions import rowwise as R
from tabula.functions import scalars as X
from tabula.operators import groupstats
from tabula.functions.aggregates import agg_expr
from tabula.plans.analog import EPOCH
from tabula.plans.recipe import Recipe, Step, apply, sentinel
from tabula.session import keep


def _share(test: str) -> str:
    return f"avg(CASE WHEN {test} THEN 1e0 ELSE 0e0 END)"


def _any(test: str) -> str:
    return f"max(CASE WHEN {test} THEN 1 ELSE 0 END)"


def _number(test: str) -> str:
    return f"sum(CASE WHEN {test} THEN 1e0 ELSE 0e0 END)"


#: Missing day offsets are written as this value (fixed value of the recipes).
NO_DAY = 365243

ORDER_COLUMNS = {
    "AMT_CREDIT": "sum(o_totalprice)", "AMT_ANNUITY": "avg(o_totalprice)", "AMT_GOODS_PRICE": "max(o_totalprice)",
    "CNT_FAM_MEMBERS": "CAST(count(*) AS DOUBLE)", "CNT_CHILDREN": _number("o_orderstatus = 'O'"),
    "DAYS_BIRTH": "min({day}) * 8", "DAYS_EMPLOYED": f"CASE WHEN {_any('o_orderstatus = ' + chr(39) + 'P' + chr(39))} = 0 THEN {NO_DAY} ELSE max({{day}}) END",
    "DAYS_REGISTRATION": "max({day})", "DAYS_LAST_PHONE_CHANGE": "-" + _number("o_orderstatus = 'P'"),
    "REGION_POPULATION_RELATIVE": "avg(o_totalprice) / 500000",
    "OWN_CAR_AGE": "CASE WHEN " + _any("o_orderpriority = '5-LOW'") + " = 1 THEN " + _number("o_orderpriority = '5-LOW'") + " END",
    "EXT_SOURCE_1": _share("o_orderpriority = '1-URGENT'"), "EXT_SOURCE_2": _share("o_orderpriority = '2-HIGH'"),
    "EXT_SOURCE_3": "CASE WHEN count(*) > 5 THEN " + _share("o_orderstatus = 'F'") + " END",
    "FLAG_MOBIL": _any("o_totalprice > 1000"), "FLAG_PHONE": _any("o_totalprice > 400000"), "FLAG_EMAIL": _any("o_orderpriority = '3-MEDIUM'"),
    "FLAG_DOCUMENT_2": _any("o_orderstatus = 'F'"), "FLAG_DOCUMENT_3": _any("o_orderpriority = '4-NOT SPECIFIED'"),
    "FLAG_DOCUMENT_4": _any("o_totalprice > 450000"), "FLAG_DOCUMENT_5": _any("o_totalprice < 20000"),
    "OBS_30_CNT_SOCIAL_CIRCLE": _number("o_totalprice > 250000"), "DEF_30_CNT_SOCIAL_CIRCLE": _number("o_totalprice > 400000"),
    "OBS_60_CNT_SOCIAL_CIRCLE": _number("o_totalprice > 200000"), "DEF_60_CNT_SOCIAL_CIRCLE": _number("o_totalprice > 350000"),
}
LINE_COLUMNS = {
    "APARTMENTS_AVG": "avg(l_discount)", "YEARS_BEGINEXPLUATATION_AVG": _share("l_quantity > 2"), "YEARS_BUILD_AVG": _share("l_quantity > 10"),
    "COMMONAREA_AVG": "avg(l_tax)", "ELEVATORS_AVG": _share("l_returnflag = 'R'"), "ENTRANCES_AVG": _share("l_returnflag = 'A'"),
    "FLOORSMAX_AVG": "max(l_discount)", "FLOORSMIN_AVG": "min(l_discount)", "LANDAREA_AVG": "avg(l_quantity) / 50",
    "LIVINGAPARTMENTS_AVG": "max(l_tax)", "LIVINGAREA_AVG": "min(l_tax)", "NONLIVINGAPARTMENTS_AVG": "min(l_quantity) / 50",
    "NONLIVINGAREA_AVG": "CASE WHEN max(l_quantity) > 45 THEN avg(l_tax) END", "TOTALAREA_MODE": "avg(l_quantity * l_discount) / 5",
}
BUREAU_LINE_COLUMNS = {
    "AMT_CREDIT_SUM_DEBT": "sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice ELSE 0e0 END)", "AMT_CREDIT_SUM_LIMIT": "max(l_extendedprice)",
    "AMT_CREDIT_SUM_OVERDUE": "sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0e0 END)",
    "AMT_CREDIT_MAX_OVERDUE": "max(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0e0 END)",
    "AMT_ANNUITY": "CASE WHEN count(*) > 1 THEN sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0e0 END) END",
}
BUREAU_COLUMNS = {
    "SK_ID_CURR": "o_custkey", "CREDIT_ACTIVE": "CASE WHEN o_orderstatus = 'F' THEN 'Closed' ELSE o_orderstatus END",
    "CREDIT_CURRENCY": "concat('currency_', CAST(o_custkey % 4 AS STRING))", "CREDIT_TYPE": "o_orderpriority",
    "DAYS_CREDIT_ENDDATE": "CASE WHEN o_orderstatus = 'P' THEN -41000 ELSE {day} + 1500 END",
    "DAYS_CREDIT_UPDATE": "CASE WHEN o_custkey % 9 = 0 THEN -40500 ELSE {day} END",
    "DAYS_ENDDATE_FACT": "CASE WHEN o_orderstatus = 'O' THEN -42000 ELSE {day} END", "AMT_CREDIT_SUM": "o_totalprice",
}
PREVIOUS_DAYS = ("DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION")
PREVIOUS_COLUMNS = {
    "AMT_APPLICATION": "l_extendedprice", "AMT_CREDIT": "CASE WHEN l_tax <= 0 THEN 0e0 ELSE l_extendedprice * (1e0 - l_discount) END",
    **{c: f"CASE WHEN l_linenumber = {i + 1} THEN {NO_DAY} ELSE {{day}} + {i} END" for i, c in enumerate(PREVIOUS_DAYS)},
}


def _day(column: str, duck: bool) -> str:
    return f"(CAST({column} AS DATE) - DATE '{EPOCH}')" if duck else f"datediff({column}, DATE'{EPOCH}')"


def _texts(columns: dict, column: str, duck: bool) -> dict:
    return {n: e.replace("{day}", _day(column, duck)).replace("{{", "{").replace("}}", "}") for n, e in columns.items()}


def _spark(columns: dict, column: str = "o_orderdate"):
    return [F.expr(e).alias(n) for n, e in _texts(columns, column, False).items()]


def _duck(columns: dict, column: str = "o_orderdate") -> str:
    return ", ".join(f"{e} AS {n}" for n, e in _texts(columns, column, True).items())


def applicants(t) -> DataFrame:
    """One row per customer, with every column that R1, R2, R8 and R9 name."""
    c = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    base = c.select(F.col("c_custkey").alias("SK_ID_CURR"), F.col("c_mktsegment").alias("CODE_GENDER"), F.col("r_name").alias("NAME_FAMILY_STATUS"),
                    F.col("n_name").alias("NAME_INCOME_TYPE"), F.concat_ws("_", "n_name", "c_mktsegment").alias("ORGANIZATION_TYPE"),
                    X.null_if("c_acctbal", F.col("c_acctbal") < -500).alias("AMT_INCOME_TOTAL"))
    o = t["orders"]
    lines = t["lineitem"].join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    per_order = o.groupBy(F.col("o_custkey").alias("SK_ID_CURR")).agg(*_spark(ORDER_COLUMNS))
    per_line = lines.groupBy(F.col("o_custkey").alias("SK_ID_CURR")).agg(*_spark(LINE_COLUMNS))
    return base.join(per_order, "SK_ID_CURR", "left").join(per_line, "SK_ID_CURR", "left")


APPLICANTS_SQL = f"""
    SELECT c.c_custkey AS SK_ID_CURR, c_mktsegment AS CODE_GENDER, r_name AS NAME_FAMILY_STATUS, n_name AS NAME_INCOME_TYPE,
           n_name || '_' || c_mktsegment AS ORGANIZATION_TYPE, CASE WHEN c_acctbal < -500 THEN NULL ELSE c_acctbal END AS AMT_INCOME_TOTAL,
           o.* EXCLUDE (k), l.* EXCLUDE (k)
    FROM customer c JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
         LEFT JOIN (SELECT o_custkey AS k, {_duck(ORDER_COLUMNS)} FROM orders GROUP BY o_custkey) o ON o.k = c_custkey
         LEFT JOIN (SELECT o_custkey AS k, {_duck(LINE_COLUMNS)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey) l ON l.k = c_custkey"""


def bureau(t) -> DataFrame:
    """One row per order."""
    per = t["lineitem"].groupBy(F.col("l_orderkey").alias("SK_ID_BUREAU")).agg(*_spark(BUREAU_LINE_COLUMNS))
    return t["orders"].select(F.col("o_orderkey").alias("SK_ID_BUREAU"), *_spark(BUREAU_COLUMNS)).join(per, "SK_ID_BUREAU", "left")


BUREAU_SQL = f"""
    SELECT o.*, l.* EXCLUDE (k) FROM (SELECT o_orderkey AS SK_ID_BUREAU, {_duck(BUREAU_COLUMNS)} FROM orders) o
    LEFT JOIN (SELECT l_orderkey AS k, {_duck(BUREAU_LINE_COLUMNS)} FROM lineitem GROUP BY l_orderkey) l ON l.k = o.SK_ID_BUREAU"""


def previous(t) -> DataFrame:
    """One row per line."""
    j = t["lineitem"].join(t["orders"].select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(F.col("o_custkey").alias("SK_ID_CURR"), *_spark(PREVIOUS_COLUMNS, "l_shipdate"))


PREVIOUS_SQL = f"SELECT o_custkey AS SK_ID_CURR, {_duck(PREVIOUS_COLUMNS, 'l_shipdate')} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


# ---------------------------------------------------------------------------
# Application rows
# ---------------------------------------------------------------------------
def _power(name: str, exponent: float, of: str | None = None) -> Step:
    return Step(name, [of or name], lambda c: X.power(c, exponent))


#: Values of the analog columns that stand for the three excluded ones; rows of the training part only.
TRAIN_FILTERS = {"CODE_GENDER": "MACHINERY", "NAME_FAMILY_STATUS": "MIDDLE EAST", "NAME_INCOME_TYPE": ["NATION_3", "NATION_7"]}

R1 = Recipe(steps=[sentinel("DAYS_LAST_PHONE_CHANGE", lambda c: c == 0)])

# The exponents.  Two results go to misspelt names, so their sources stay as they are.
R2 = Recipe(steps=[
    Step("REGION_POPULATION_RELATIVE", ["REGION_POPULATION_RELATIVE"], X.safe_sqrt),
    Step("DAYS_REGISTRATION", ["DAYS_REGISTRATION"], lambda c: X.safe_sqrt(F.abs(c))),
    Step("APARTMENTS_AVG", ["APARTMENTS_AVG"], lambda c: X.safe_log1p(50 * c)),
    _power("YEARS_BEGINEXPLUATATION_AVG", 30),
    _power("YEARS_BUILD_AVG", 3),
    _power("COMMONAREA_AVG", -1 / 200),
    _power("ELEVATORS_AVG", 1 / 40),
    _power("ENTRANCES_AVG", 1 / 3),
    _power("FLOORSMAX_AVG", 1 / 2.5),
    _power("FLOORSMIN_AVG", 1 / 2.2),
    _power("LANDAREA_VG", 1 / 5, of="LANDAREA_AVG"),
    _power("LIVINGAPRTMENTS_AVG", 1 / 3, of="LIVINGAPARTMENTS_AVG"),
    _power("LIVINGAREA_AVG", 1 / 3.5),
    _power("NONLIVINGAPARTMENTS_AVG", 1 / 7),
    _power("NONLIVINGAREA_AVG", 1 / 5),
    _power("TOTALAREA_MODE", 1 / 3),
    *[_power(f"{kind}_{days}_CNT_SOCIAL_CIRCLE", 1 / 7) for days in (30, 60) for kind in ("OBS", "DEF")],
])

# ---------------------------------------------------------------------------
# Bureau rows
# ---------------------------------------------------------------------------
BUREAU_DAYS = ("DAYS_CREDIT_ENDDATE", "DAYS_CREDIT_UPDATE", "DAYS_ENDDATE_FACT")
BUREAU_AMOUNTS = ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_MAX_OVERDUE", "AMT_ANNUITY")
BUREAU_FLAGS = ("credit_active_binary", "credit_enddate_binary")
# Prefixes of the category means and their keys.
BUREAU_MEANS = {"TYPE_": ["CREDIT_TYPE"], "CURRENCY_": ["CREDIT_CURRENCY"], "CURRENCY_TYPE_": ["CREDIT_CURRENCY", "CREDIT_TYPE"]}
# The eight ratios; the last is named after another divisor than it has.
BUREAU_RATIOS = {
    "NEW_AMT_CREDIT_SUM_DEBT_DIVIDE_AMT_CREDIT_SUM": ("AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM"),
    "NEW_AMT_CREDIT_SUM_LIMIT_DIVIDE_AMT_CREDIT_SUM": ("AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM"),
    "NEW_AMT_CREDIT_SUM_OVERDUE_DIVIDE_AMT_CREDIT_SUM": ("AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM"),
    "NEW_AMT_CREDIT_SUM_DEBT_DIVIDE_AMT_ANNUITY": ("AMT_CREDIT_SUM_DEBT", "AMT_ANNUITY"),
    "NEW_AMT_CREDIT_SUM_LIMIT_DIVIDE_AMT_ANNUITY": ("AMT_CREDIT_SUM_LIMIT", "AMT_ANNUITY"),
    "NEW_AMT_CREDIT_SUM_OVERDUE_DIVIDE_AMT_ANNUITY": ("AMT_CREDIT_SUM_OVERDUE", "AMT_ANNUITY"),
    "NEW_AMT_CREDIT_SUM_OVERDUE_DIVIDE_AMT_CREDIT_SUM_DEBT": ("AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM_DEBT"),
    "NEW_AMT_CREDIT_MAX_OVERDUE_DIVIDE_AMT_CREDIT_SUM_OVERDUE": ("AMT_CREDIT_MAX_OVERDUE", "AMT_CREDIT_SUM_DEBT"),
}


def _raw(c: str) -> str:
    return f"raw {c}"


R3_CLEAN = Recipe(steps=[
    *[Step(_raw(c), [c], lambda x: x) for c in BUREAU_DAYS],
    *[sentinel(c, lambda x: x < -40000) for c in BUREAU_DAYS],
    Step("credit_active_binary", ["CREDIT_ACTIVE"], lambda c: X.flag(c != "Closed")),
    Step("credit_enddate_binary", ["DAYS_CREDIT_ENDDATE"], lambda c: X.flag(c > 40)),
])
R3_RATIOS = Recipe(steps=[Step(n, [a, b], X.ieee_divide) for n, (a, b) in BUREAU_RATIOS.items()], drop=[_raw(c) for c in BUREAU_DAYS])


def bureau_features(t) -> DataFrame:
    """R3 up to the roll-up.  The category means are those of the days before the sentinels went."""
    b = keep(apply(bureau(t), R3_CLEAN))        # read by every block of means
    source = {c: _raw(c) if c in BUREAU_DAYS else c for c in (*BUREAU_DAYS, *BUREAU_AMOUNTS, *BUREAU_FLAGS)}
    b = groupstats.add_group_blocks(b, [(keys, {prefix + c: agg_expr("mean", s, "propagate") for c, s in source.items()}) for prefix, keys in BUREAU_MEANS.items()])
    return apply(b, R3_RATIOS)


# ---------------------------------------------------------------------------
# Previous applications
# ---------------------------------------------------------------------------
R7 = Recipe(steps=[*[sentinel(c, lambda x: x == NO_DAY) for c in PREVIOUS_DAYS],
                   Step("APP_CREDIT_PERC", ["AMT_APPLICATION", "AMT_CREDIT"], X.ieee_divide)])

# ---------------------------------------------------------------------------
# The merged applicant table
# ---------------------------------------------------------------------------
def _ratio(name: str, a: str, b: str) -> Step:
    return Step(name, [a, b], X.ieee_divide)


# Names and formulas.  PHONE_TO_BIRTH_RATIO is written twice and keeps the second.
R8 = Recipe(steps=[
    sentinel("DAYS_EMPLOYED", lambda c: c == NO_DAY),
    Step("DAYS_EMPLOYED_PERC", ["DAYS_EMPLOYED", "DAYS_BIRTH"], lambda a, b: X.safe_sqrt(X.ieee_divide(a, b))),
    _ratio("INCOME_CREDIT_PERC", "AMT_INCOME_TOTAL", "AMT_CREDIT"),
    Step("INCOME_PER_PERSON", ["AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"], lambda a, b: X.safe_log1p(X.ieee_divide(a, b))),
    Step("ANNUITY_INCOME_PERC", ["AMT_ANNUITY", "AMT_INCOME_TOTAL"], lambda a, b: X.safe_sqrt(X.ieee_divide(a, 1 + b))),
    _ratio("LOAN_INCOME_RATIO", "AMT_CREDIT", "AMT_INCOME_TOTAL"),
    _ratio("PAYMENT_RATE", "AMT_ANNUITY", "AMT_CREDIT"),
    _ratio("CHILDREN_RATIO", "CNT_CHILDREN", "CNT_FAM_MEMBERS"),
    Step("cnt_non_child", ["CNT_FAM_MEMBERS", "CNT_CHILDREN"], lambda a, b: a - b),
    _ratio("CREDIT_TO_GOODS_RATIO", "AMT_CREDIT", "AMT_GOODS_PRICE"),
    _ratio("credit_per_person", "AMT_CREDIT", "CNT_FAM_MEMBERS"),
    Step("credit_per_child", ["AMT_CREDIT", "CNT_CHILDREN"], lambda a, b: X.ieee_divide(a, 1 + b)),
    Step("INC_PER_CHLD", ["credit_per_child", "CNT_CHILDREN"], lambda a, b: X.ieee_divide(a, 1 + b)),
    Step("SOURCES_PROD", ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"], lambda a, b, c: a * b * c),
    _ratio("CAR_TO_BIRTH_RATIO", "OWN_CAR_AGE", "DAYS_BIRTH"),
    _ratio("CAR_TO_EMPLOY_RATIO", "OWN_CAR_AGE", "DAYS_EMPLOYED"),
    _ratio("PHONE_TO_BIRTH_RATIO", "DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
    _ratio("PHONE_TO_BIRTH_RATIO", "DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
    _ratio("child_to_non_child_ratio", "CNT_CHILDREN", "cnt_non_child"),
    _ratio("credit_per_non_child", "AMT_CREDIT", "cnt_non_child"),
    Step("retirement_age", ["DAYS_BIRTH"], lambda c: X.flag(c < -14000)),
    Step("long_employment", ["DAYS_EMPLOYED"], lambda c: X.flag(c < -2000)),
])
#: Fixed value: what a flag column that is summed and dropped looks like (not the document flags).
LIVE_FLAGS = r"(?!NFLAG_)(?!FLAG_DOC)(?!_FLAG_)FLAG_"
DOC_FLAGS = "FLAG_DOC"


def row_recipe(docs: list[str], live: list[str]) -> Recipe:
    """R9 before the organisation median: statistics over the columns of a row; the summed flags end with it."""
    sources = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
    return Recipe(steps=[Step("DOC_IND_KURT", docs, lambda *c: R.row_kurtosis(c)), Step("LIVE_IND_SUM", live, lambda *c: R.row_sum(c)),
                         Step("NEW_EXT_SOURCES_MEAN", sources, lambda *c: R.row_mean(c)), Step("NEW_SCORES_STD", sources, lambda *c: R.row_sd(c))],
                  drop=live)
