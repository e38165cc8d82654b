"""Reference entities derived from the provided tables.

The loan-application files of the reference are not available; each entity
is derived by Spark from the given tables, so its size grows with them:

applicants       customer ⋈ nation ⋈ region, plus application amounts and day
                 offsets rolled up from the customer's orders
bureau           orders (one credit record per order)
bureau_balance   lineitem (monthly status rows of a credit record)
installments     lineitem ⋈ orders (one instalment per line)
pos_cash         events (status rows per user)
previous_apps    lineitem ⋈ part ⋈ orders (categorical application history)

Each builder has a DuckDB twin in ``SQL`` (used by the oracle queries).
Day offsets are relative to 2002-01-01 (negative = in the past), like the
reference's ``DAYS_*`` columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.functions.scalars import days_since, null_if

EPOCH = "2002-01-01"


def applicant_base(t: dict[str, DataFrame]) -> DataFrame:
    """Applicant categorical attributes only (customer ⋈ nation ⋈ region)."""
    c = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return c.select(
        F.col("c_custkey").alias("SK_ID_CURR"),
        F.col("c_mktsegment").alias("CODE_GENDER"),
        F.col("n_name").alias("ORGANIZATION_TYPE"),
        F.col("r_name").alias("NAME_EDUCATION_TYPE"),
        null_if(F.col("n_name"), F.col("n_regionkey") == 0).alias("OCCUPATION_TYPE"),
        null_if(F.col("c_acctbal"), F.col("c_acctbal") < 0).alias("AMT_INCOME_TOTAL"),
        F.col("c_acctbal"),
    )


def labels(t: dict[str, DataFrame]) -> DataFrame:
    """Binary TARGET per applicant: more than 40 % of the applicant's lines were returned."""
    l, o = t["lineitem"], t["orders"]
    j = l.select("l_orderkey", "l_returnflag").join(o.select("o_orderkey", "o_custkey"),
                                                    F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy(F.col("o_custkey").alias("SK_ID_CURR")).agg(
        (F.avg((F.col("l_returnflag") == "R").cast("double")) > 0.4).cast("int").alias("TARGET"))


def applicants(t: dict[str, DataFrame]) -> DataFrame:
    o = t["orders"]
    amounts = o.groupBy(F.col("o_custkey").alias("SK_ID_CURR")).agg(
        F.sum("o_totalprice").alias("AMT_CREDIT"),
        F.avg("o_totalprice").alias("AMT_ANNUITY"),
        F.max("o_totalprice").alias("AMT_GOODS_PRICE"),
        F.count(F.lit(1)).cast("double").alias("CNT_FAM_MEMBERS"),
        F.sum((F.col("o_orderstatus") == "O").cast("int")).alias("CNT_CHILDREN"),
        F.min(days_since("o_orderdate", EPOCH)).alias("DAYS_BIRTH"),
        F.max(days_since("o_orderdate", EPOCH)).alias("DAYS_EMPLOYED"),
        F.avg((F.col("o_orderpriority") == "1-URGENT").cast("double")).alias("EXT_SOURCE_1"),
        F.avg((F.col("o_orderpriority") == "2-HIGH").cast("double")).alias("EXT_SOURCE_2"),
        F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("EXT_SOURCE_3"),
    )
    c = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    base = c.select(
        F.col("c_custkey").alias("SK_ID_CURR"),
        F.col("c_mktsegment").alias("CODE_GENDER"),
        F.col("n_name").alias("ORGANIZATION_TYPE"),
        F.col("r_name").alias("NAME_EDUCATION_TYPE"),
        null_if(F.col("n_name"), F.col("n_regionkey") == 0).alias("OCCUPATION_TYPE"),
        null_if(F.col("c_acctbal"), F.col("c_acctbal") < 0).alias("AMT_INCOME_TOTAL"),
    )
    return base.join(amounts, "SK_ID_CURR", "left")


def installments(t: dict[str, DataFrame]) -> DataFrame:
    l, o = t["lineitem"], t["orders"]
    j = l.join(o.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    disc = null_if(F.col("l_discount"), F.col("l_discount") == 0)
    return j.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("l_linenumber").alias("NUM_INSTALMENT_NUMBER"),
        days_since("o_orderdate", EPOCH).alias("DAYS_INSTALMENT"),
        days_since("l_shipdate", EPOCH).alias("DAYS_ENTRY_PAYMENT"),
        F.col("l_extendedprice").alias("AMT_INSTALMENT"),
        (F.col("l_extendedprice") * (F.lit(1.0) - disc)).alias("AMT_PAYMENT"),
    )


def bureau(t: dict[str, DataFrame]) -> DataFrame:
    o = t["orders"]
    return o.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_BUREAU"),
        F.col("o_orderstatus").alias("CREDIT_ACTIVE"),
        F.col("o_orderpriority").alias("CREDIT_TYPE"),
        days_since("o_orderdate", EPOCH).alias("DAYS_CREDIT"),
        F.col("o_totalprice").alias("AMT_CREDIT_SUM"),
    )


def bureau_balance(t: dict[str, DataFrame]) -> DataFrame:
    l = t["lineitem"]
    return l.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        (-F.col("l_linenumber")).alias("MONTHS_BALANCE"),
        F.col("l_returnflag").alias("STATUS"),
        F.col("l_quantity").alias("AMT_BALANCE"),
    )


def pos_cash(t: dict[str, DataFrame]) -> DataFrame:
    e = t["events"]
    return e.select(
        F.col("user_id").alias("SK_ID_CURR"),
        F.col("event_type").alias("NAME_CONTRACT_STATUS"),
        F.col("value").alias("SK_DPD"),
        days_since("ts", EPOCH).alias("MONTHS_BALANCE"),
    )


# DuckDB twins of the builders above (same column names and semantics).
SQL = {
    "applicant_base": """
        SELECT c.c_custkey AS SK_ID_CURR, c.c_mktsegment AS CODE_GENDER, n.n_name AS ORGANIZATION_TYPE,
               r.r_name AS NAME_EDUCATION_TYPE,
               CASE WHEN n.n_regionkey = 0 THEN NULL ELSE n.n_name END AS OCCUPATION_TYPE,
               CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal END AS AMT_INCOME_TOTAL,
               c.c_acctbal
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
             JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "labels": """
        SELECT o.o_custkey AS SK_ID_CURR, (avg((l.l_returnflag = 'R')::DOUBLE) > 0.4)::INTEGER AS TARGET
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey""",
    "applicants": f"""
        SELECT c.c_custkey AS SK_ID_CURR, c.c_mktsegment AS CODE_GENDER, n.n_name AS ORGANIZATION_TYPE,
               r.r_name AS NAME_EDUCATION_TYPE,
               CASE WHEN n.n_regionkey = 0 THEN NULL ELSE n.n_name END AS OCCUPATION_TYPE,
               CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal END AS AMT_INCOME_TOTAL,
               a.AMT_CREDIT, a.AMT_ANNUITY, a.AMT_GOODS_PRICE, a.CNT_FAM_MEMBERS, a.CNT_CHILDREN,
               a.DAYS_BIRTH, a.DAYS_EMPLOYED, a.EXT_SOURCE_1, a.EXT_SOURCE_2, a.EXT_SOURCE_3
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
             JOIN region r ON n.n_regionkey = r.r_regionkey
             LEFT JOIN (
               SELECT o_custkey AS SK_ID_CURR, sum(o_totalprice) AS AMT_CREDIT, avg(o_totalprice) AS AMT_ANNUITY,
                      max(o_totalprice) AS AMT_GOODS_PRICE, count(*)::DOUBLE AS CNT_FAM_MEMBERS,
                      sum((o_orderstatus = 'O')::INTEGER)::BIGINT AS CNT_CHILDREN,
                      min((o_orderdate::DATE - DATE '{EPOCH}')::INTEGER) AS DAYS_BIRTH,
                      max((o_orderdate::DATE - DATE '{EPOCH}')::INTEGER) AS DAYS_EMPLOYED,
                      avg((o_orderpriority = '1-URGENT')::DOUBLE) AS EXT_SOURCE_1,
                      avg((o_orderpriority = '2-HIGH')::DOUBLE) AS EXT_SOURCE_2,
                      avg((o_orderstatus = 'F')::DOUBLE) AS EXT_SOURCE_3
               FROM orders GROUP BY o_custkey) a ON a.SK_ID_CURR = c.c_custkey""",
    "installments": f"""
        SELECT o.o_custkey AS SK_ID_CURR, l.l_orderkey AS SK_ID_PREV, l.l_linenumber AS NUM_INSTALMENT_NUMBER,
               ((o.o_orderdate::DATE - DATE '{EPOCH}')::INTEGER) AS DAYS_INSTALMENT,
               ((l.l_shipdate::DATE - DATE '{EPOCH}')::INTEGER) AS DAYS_ENTRY_PAYMENT,
               l.l_extendedprice AS AMT_INSTALMENT,
               l.l_extendedprice * (1.0 - CASE WHEN l.l_discount = 0 THEN NULL ELSE l.l_discount END) AS AMT_PAYMENT
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "bureau": f"""
        SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU, o_orderstatus AS CREDIT_ACTIVE,
               o_orderpriority AS CREDIT_TYPE, ((o_orderdate::DATE - DATE '{EPOCH}')::INTEGER) AS DAYS_CREDIT,
               o_totalprice AS AMT_CREDIT_SUM
        FROM orders""",
    "bureau_balance": """
        SELECT l_orderkey AS SK_ID_BUREAU, -l_linenumber AS MONTHS_BALANCE, l_returnflag AS STATUS,
               l_quantity AS AMT_BALANCE
        FROM lineitem""",
    "pos_cash": f"""
        SELECT user_id AS SK_ID_CURR, event_type AS NAME_CONTRACT_STATUS, value AS SK_DPD,
               ((ts::DATE - DATE '{EPOCH}')::INTEGER) AS MONTHS_BALANCE
        FROM events""",
}
