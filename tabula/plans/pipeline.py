"""End-to-end feature pipeline (recipes R1-R12) over the analog entities.

One declarative plan per stage; the only driver round-trips are the bounded
schema decisions (one-hot levels, near-zero-variance drop list, correlation
drop list, PCA basis).  The wide applicant table is written to the session's
shared checkpoint folder before the column statistics (S5) and read back
(S4), which both cuts a long lineage and gives the feature-table restart
point of the reference.

Stages
  R1  cleaning: configured train-row filters and sentinel null-outs
  R2  power transforms of application columns
  R3  bureau: flags, category means, one-hot, ratios, nested bureau_balance
      roll-up, bundle by applicant, near-zero-variance filter
  R4  payments roll-up (``recipes.payments_rollup``)
  R5  POS cash: overdue flags, one-hot, bundle
  R6  card balance: one-hot, bundle
  R7  previous applications: one-hot, ratio, bundle, near-zero-variance filter
  U1+J1 union of labelled and unlabelled applicants, five left joins
  R8  application ratios, null count of the joined row
  R9  row statistics, organisation median lookup, non-finite -> null
  R10 group statistics joined back
  R11 label encoding, cleaning, NZV, mean imputation, correlation filter on
      the un-imputed table, PCA on the imputed unfiltered table, append scores
  R12 split, boosted trees, validation AUC, importance, scoring (``train_and_score``)
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.functions import columns as C
from tabula.functions import rowwise as R
from tabula.functions import scalars as X
from tabula.operators import clean, encode, groupstats, impute, reduce, selection, split, train
from tabula.operators.bundles import nested_rollup, rollup
from tabula.operators.joins import rollup_join
from tabula.plans import analog, recipes
from tabula.plans.queries_stats import GROUP_BLOCKS, GROUP_STAT_INPUTS, previous_apps
from tabula.sources import sinks
from tabula.sources.sinks import materialize


@dataclass
class PipelineConfig:
    # Train-row filters (column -> value to exclude); analog data has none of them
    train_filters: dict = field(default_factory=lambda: {"CODE_GENDER": "XNA", "NAME_EDUCATION_TYPE": "Unknown"})
    train_share: float = 0.8
    valid_share: float = 0.85
    bundle: str = "canonical"
    nulls: str = "propagate"
    onehot_levels: int = 5
    corr_cutoff: float = 0.9
    pca_k: int = 30
    group_stats: bool = True


def _bureau(t, cfg: PipelineConfig) -> DataFrame:
    b = analog.bureau(t)
    b = clean.null_out(b, {"DAYS_CREDIT": F.col("DAYS_CREDIT") < -40000})
    b = b.withColumns({"CREDIT_ACTIVE_BINARY": X.flag(F.col("CREDIT_ACTIVE") != "F"),
                       "CREDIT_ENDDATE_BINARY": X.flag(F.col("DAYS_CREDIT") > -1000)})
    nums = ["DAYS_CREDIT", "AMT_CREDIT_SUM", "CREDIT_ACTIVE_BINARY", "CREDIT_ENDDATE_BINARY"]
    b = groupstats.add_category_stats(b, ["CREDIT_TYPE"], nums, prefix="TYPE_")
    b = groupstats.add_category_stats(b, ["CREDIT_ACTIVE", "CREDIT_TYPE"], nums, prefix="CURRENCY_TYPE_")
    b = encode.onehot(b, max_levels=cfg.onehot_levels)
    b = b.withColumn("AMT_CREDIT_SUM_PER_DAY", X.ieee_divide("AMT_CREDIT_SUM", F.abs(F.col("DAYS_CREDIT"))))
    bb = encode.onehot(analog.bureau_balance(t), max_levels=10)
    out = nested_rollup(bb, b, "SK_ID_BUREAU", "SK_ID_CURR", cfg.bundle, cfg.bundle, cfg.nulls)
    # the filter reads the roll-up twice and the merge once more: written once, never computed again
    out = materialize(clean.clean_non_finite(out, by_batch=True), "bureau-rollup")
    return C.prefix_rename(selection.drop_nzv(out, [c for c in out.columns if c != "SK_ID_CURR"]), "BURO_",
                           ["SK_ID_CURR"])


def _pos(t, cfg) -> DataFrame:
    p = analog.pos_cash(t).withColumns({"pos_cash_paid_late": X.flag(F.col("SK_DPD") > 100),
                                        "pos_cash_paid_late_with_tolerance": X.flag(F.col("SK_DPD") > 200)})
    p = encode.onehot(p, max_levels=cfg.onehot_levels)
    return C.prefix_rename(clean.clean_non_finite(rollup(p, "SK_ID_CURR", cfg.bundle, cfg.nulls)), "POS_",
                           ["SK_ID_CURR"])


def _card(t, cfg) -> DataFrame:
    e = analog.pos_cash(t).where(F.col("NAME_CONTRACT_STATUS").isin("purchase", "click"))
    e = clean.null_out(e, {"SK_DPD": F.col("SK_DPD") < 0})
    e = encode.onehot(e.withColumnRenamed("SK_DPD", "AMT_DRAWINGS_CURRENT"), max_levels=cfg.onehot_levels)
    return C.prefix_rename(clean.clean_non_finite(rollup(e, "SK_ID_CURR", cfg.bundle, cfg.nulls)), "CC_",
                           ["SK_ID_CURR"])


def _previous(t, cfg) -> DataFrame:
    # the rows of three joined tables are read for the levels, the group sizes and the roll-up: written once
    p = sinks.materialize(previous_apps(t).drop("SK_ID_PREV"), "previous-rows")
    p = p.withColumn("APP_SIZE_PERC", X.ieee_divide("l_quantity", "p_size"))
    p = encode.onehot(p, max_levels=cfg.onehot_levels)
    out = materialize(clean.clean_non_finite(rollup(p, "SK_ID_CURR", cfg.bundle, cfg.nulls), by_batch=True), "previous-rollup")
    return C.prefix_rename(selection.drop_nzv(out, [c for c in out.columns if c != "SK_ID_CURR"]), "PREV_",
                           ["SK_ID_CURR"])


def _applicant_rows(t, cfg) -> DataFrame:
    a = analog.applicants(t)
    a = split.hash_split(a, "SK_ID_CURR", cfg.train_share, labels=("train", "test"))
    train_rows = clean.filter_not_equal(a.where(F.col("split") == "train"), cfg.train_filters) \
        .join(analog.labels(t), "SK_ID_CURR", "left")
    test_rows = a.where(F.col("split") == "test")
    u = split.union_train_test(train_rows.drop("split"), test_rows.drop("split"))
    # R2: power transforms (identical for train and test rows)
    return u.withColumns({"EXT_SOURCE_1": X.power("EXT_SOURCE_1", 1 / 3),
                          "AMT_INCOME_SQRT": X.safe_sqrt("AMT_INCOME_TOTAL")})


def build_feature_table(spark: SparkSession, t: dict, cfg: PipelineConfig | None = None) -> DataFrame:
    cfg = cfg or PipelineConfig()
    a = _applicant_rows(t, cfg)
    # every table of the merge is written before it: the lookup below reads the merge several times
    merged = rollup_join(materialize(a, "applicant-rows"), [
        _bureau(t, cfg), materialize(_card(t, cfg), "card-rollup"),
        materialize(recipes.payments_rollup(materialize(analog.installments(t), "instalment-rows")), "payments-rollup"),
        materialize(_pos(t, cfg), "pos-rollup"), _previous(t, cfg)], "SK_ID_CURR")
    # Null count of the joined row, then ratios
    merged = merged.withColumn("na", R.row_null_count([c for c in merged.columns if c not in ("TARGET",)]))
    merged = clean.null_out(merged, {"DAYS_EMPLOYED": F.col("DAYS_EMPLOYED") == 365243})
    merged = merged.withColumns({
        "age_bucket": X.cut_right_closed(-F.col("DAYS_BIRTH") / 50, recipes.AGE_BREAKS),
        "DAYS_EMPLOYED_PERC": X.safe_sqrt(X.ieee_divide("DAYS_EMPLOYED", "DAYS_BIRTH")),
        "INCOME_CREDIT_PERC": X.ieee_divide("AMT_INCOME_TOTAL", "AMT_CREDIT"),
        "ANNUITY_INCOME_PERC": X.safe_sqrt(X.ieee_divide(F.col("AMT_ANNUITY"), F.col("AMT_INCOME_TOTAL") + 1)),
        "LOAN_INCOME_RATIO": X.ieee_divide("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "PAYMENT_RATE": X.ieee_divide("AMT_ANNUITY", "AMT_CREDIT"),
        "CHILDREN_RATIO": X.ieee_divide("CNT_CHILDREN", "CNT_FAM_MEMBERS"),
        "CREDIT_TO_GOODS_RATIO": X.ieee_divide("AMT_CREDIT", "AMT_GOODS_PRICE"),
        "credit_per_person": X.ieee_divide("AMT_CREDIT", "CNT_FAM_MEMBERS"),
        "credit_per_child": X.ieee_divide(F.col("AMT_CREDIT"), F.col("CNT_CHILDREN") + 1),
        "SOURCES_PROD": F.col("EXT_SOURCE_1") * F.col("EXT_SOURCE_2") * F.col("EXT_SOURCE_3"),
        "retirement_age": X.flag(F.col("DAYS_BIRTH") < -2000),
        "NEW_EXT_SOURCES_MEAN": R.row_mean(["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]),
        "NEW_SCORES_STD": R.row_sd(["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]),
    })
    merged = merged.withColumn("INC_PER_CHLD", X.ieee_divide(F.col("credit_per_child"), F.col("CNT_CHILDREN") + 1))
    # Organisation median lookup, then non-finite -> null
    merged = groupstats.median_lookup(merged, "ORGANIZATION_TYPE", "AMT_INCOME_TOTAL", "NEW_INC_BY_ORG")
    # the merged applicant table feeds several measured decisions below: write it
    # once (shared checkpoint folder) so none of them recomputes the joins
    merged = materialize(clean.clean_non_finite(merged, by_batch=True), "applicant-merged")
    # Group statistics joined back
    if cfg.group_stats:
        exprs = {suffix: F.col(src) for suffix, src in GROUP_STAT_INPUTS.items()}
        merged = groupstats.add_group_blocks(merged, [(keys, groupstats.mean_stats(prefix, exprs))
                                                      for prefix, keys in GROUP_BLOCKS.items()])
    # Encode, clean; write the wide table once (lineage cut, restart point)
    merged = clean.clean_non_finite(encode.label_encode(merged), by_batch=True)
    wide = materialize(merged, "feature-table-wide")
    ids = ["SK_ID_CURR", "TARGET", "is_train"]
    feats = [c for c in wide.columns if c not in ids]
    wide = wide.drop(*selection.nzv_columns(wide, feats))
    feats = [c for c in wide.columns if c not in ids]
    imputed = impute.mean_impute(wide, feats)
    # the reference's default: averages are taken anew after each drop below a hundred columns only
    drop = selection.correlation_filter(imputed, feats, cfg.corr_cutoff, exact=len(feats) < 100)
    k = min(cfg.pca_k, len(feats))
    pcs = reduce.pca_scores(imputed, feats, k, keep=["SK_ID_CURR"])
    return materialize(wide.drop(*drop).join(pcs, "SK_ID_CURR", "left"), "feature-table")


def train_and_score(feature_table: DataFrame, cfg: PipelineConfig | None = None, **gbt) -> tuple:
    """Validation split inside labelled rows, GBT with early stopping, AUC, importance, test scores."""
    cfg = cfg or PipelineConfig()
    ids = ["SK_ID_CURR", "TARGET", "is_train"]
    feats = [c for c in feature_table.columns if c not in ids]
    data = impute.mean_impute(feature_table, feats)
    data = split.hash_split(data, "SK_ID_CURR", cfg.valid_share, seed=7)
    data = data.withColumn("split", F.when(F.col("is_train") == 0, F.lit("test")).otherwise(F.col("split")))
    params = dict(maxIter=30, maxDepth=5, stepSize=0.1, subsamplingRate=0.87, featureSubsetStrategy="0.95")
    params.update(gbt)
    res = train.train_gbt(data.where((F.col("split") != "test") & F.col("TARGET").isNotNull()), feats, label="TARGET", split_col="split",
                          valid_value="val", **params)
    scores = train.score(res, data.where(F.col("split") == "test"), "SK_ID_CURR")
    return res, scores, train.importance(res, feature_table.sparkSession, top=30)
