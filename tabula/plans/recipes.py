"""Domain recipes of the reference, as DataFrame functions.

Each recipe is a lazy plan over analog entities; the only actions are the
bounded driver decisions inside encoders (observed bin levels).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabula.functions.scalars import clamp0, cut_right_closed, ieee_divide
from tabula.operators.bundles import rollup
from tabula.operators.clean import clean_non_finite
from tabula.functions.aggregates import agg_expr
from tabula.operators.joins import left_join_null_safe

# Bin breaks of the payment delay features (right-closed bins).
DPD_BREAKS = [-1, 0, 1, 5, 10, 30, 100, 300, 1000, 3000]
DBD_BREAKS = [-1, 0, 1, 5, 10, 30, 100, 300, 3500]
# Bin breaks of the age buckets.
AGE_BREAKS = [20, 24, 29, 34, 39, 44, 49, 54, 59, 64, 70]


def payment_rows(installments: DataFrame) -> DataFrame:
    """R4 per-row features: payment share/difference, clamped days past/before due, delay bins."""
    pay = installments.drop("SK_ID_PREV")
    pay = pay.withColumns({
        "PAYMENT_PERC": ieee_divide("AMT_PAYMENT", "AMT_INSTALMENT"),
        "PAYMENT_DIFF": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
        "DPD": clamp0(F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")),
        "DBD": clamp0(F.col("DAYS_INSTALMENT") - F.col("DAYS_ENTRY_PAYMENT")),
    })
    return pay.withColumns({
        "DPD_cut": cut_right_closed("DPD", DPD_BREAKS),
        "DBD_cut": cut_right_closed("DBD", DBD_BREAKS),
    })


def payment_bin_means(pay: DataFrame) -> DataFrame:
    """Per-bin means of every column joined back (prefixes ``DBD_cut_`` / ``DPD_cut_``).

    Both statistics tables come from the same pre-join rows in ONE pass: a
    grouping-sets aggregation (``{DBD_cut}, {DPD_cut}``) scans the payment
    rows once; ``grouping_id`` tells the two sets apart (a bin may be null).
    Each table has at most one row per bin (+ the null bin) — a fixed bound —
    so it is broadcast.  The stats table also carries the bin's code among
    the *observed* bins (``factor(.) %>% as.integer`` drops unused levels),
    computed with a window over that tiny table, so encoding needs no driver
    round-trip.  The key and the delay columns themselves are not joined back.
    """
    value_cols = [c for c in pay.columns if c not in ("DPD_cut", "DBD_cut")]
    kept = [c for c in value_cols if c not in ("SK_ID_CURR", "DPD", "DBD")]
    both = pay.groupingSets([["DBD_cut"], ["DPD_cut"]], "DBD_cut", "DPD_cut").agg(
        F.grouping_id().alias("__gid"), *[agg_expr("mean", c, "propagate").alias(c) for c in kept])
    both = both.persist()          # <= 2 * (bins + 1) rows; read by both broadcasts
    out = pay
    # grouping_id bit order follows (DBD_cut, DPD_cut): set {DBD_cut} -> 1, set {DPD_cut} -> 2
    for cut, gid in (("DBD_cut", 1), ("DPD_cut", 2)):
        stats = both.where(F.col("__gid") == gid).select(
            cut, *[F.col(c).alias(f"{cut}_{c}") for c in kept])
        code = F.when(F.col(cut).isNotNull(), F.dense_rank().over(Window.orderBy(F.col(cut).asc_nulls_last())))
        stats = stats.withColumn("__code", code.cast("int"))
        out = left_join_null_safe(out, stats, [cut], right_small=True)
        out = out.withColumn(cut, F.col("__code")).drop("__code")
    return out


def payments_rollup(installments: DataFrame) -> DataFrame:
    """Per-applicant canonical bundle of the enriched payment rows, non-finite -> null."""
    pay = payment_bin_means(payment_rows(installments))
    return clean_non_finite(rollup(pay, "SK_ID_CURR", "canonical", "propagate"), by_batch=True)
