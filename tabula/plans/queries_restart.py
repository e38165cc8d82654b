"""Catalog part 6: restart from written stages, training on the feature table, declared categories, and column and
source choices that the other parts only use inside larger plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.functions import columns as C
from tabula.operators import categories, impute, selection, split, staged, train
from tabula.plans import analog, loan
from tabula.plans.queries_model import _IMPUTED_SQL, _UNION_SQL, _VALID_P, NUM_COLS, POS_WEIGHT, labelled_union, numeric_applicants
from tabula.plans.queries_recipe import APPLICATION_SQL, _APP_DOUBLES, _finite_sql, merged_table, application
from tabula.operators.clean import clean_non_finite
from tabula.plans.registry import query
from tabula.session import checkpoint_dir
from tabula.sources.restart import Restart
from tabula.sources.sinks import scratch_folder, write_table
from tabula.sources.tables import table

# ---------------------------------------------------------------------------
# S3, S4, S5
# ---------------------------------------------------------------------------


def restart_of(spark):
    return Restart(spark, f"{checkpoint_dir(spark).rstrip('/')}/stages")


def inputs_of(t, *names):
    return {n: t[n] for n in names}


@query("restarted_application", ops="S4 S5 R1 R2", sql=_finite_sql(APPLICATION_SQL, _APP_DOUBLES), doubles=_APP_DOUBLES)
def restarted_application(t, spark):
    """The applicants from their written stage; a second run over the same files reads it back."""
    stages = restart_of(spark)
    inputs = inputs_of(t, "customer", "nation", "region", "orders", "lineitem")
    return clean_non_finite(stages.stage("application", inputs, lambda: application(t)))


@query("alternative_source", ops="S3 S1", doubles=["total"],
       sql="SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS total FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_orderstatus")
def alternative_source(t, spark):
    """The logical table ``orders`` read from another file than the default one."""
    other = scratch_folder(spark, "orders-urgent")
    write_table(t["orders"].where(F.col("o_orderpriority") == "1-URGENT"), other)
    orders = table(spark, "", "orders", overrides={"orders": other})
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))


# ---------------------------------------------------------------------------
# P4, P13, U2, U3
# ---------------------------------------------------------------------------
@query("exclude_columns", ops="P4", sql="SELECT * EXCLUDE (o_custkey, o_orderdate) FROM orders", doubles=["o_totalprice"])
def exclude_columns(t, spark):
    return C.exclude(t["orders"], {"o_custkey", "o_orderdate", "not_there"})


@query("column_difference", ops="U3 P1", sql="SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders", doubles=["o_totalprice"])
def column_difference(t, spark):
    """The columns of one frame that another does not have."""
    other = t["orders"].select("o_custkey", "o_orderdate", "o_orderstatus")
    return t["orders"].select(*C.column_difference(t["orders"], other))


@query("split_back", ops="U2 U1", sql=f"SELECT SK_ID_CURR, TARGET, CASE WHEN is_train = 1 THEN 'train' ELSE 'test' END AS side FROM ({_UNION_SQL}) u")
def split_back(t, spark):
    """The union of both parts taken apart again."""
    first, second = split.split_back(labelled_union(t).select("SK_ID_CURR", "TARGET", "is_train"))
    return first.withColumn("side", F.lit("train")).unionByName(second.withColumn("side", F.lit("test"))).drop("is_train")


_PROTECTED = ["AMT_CREDIT"]
_FILTER_CUTOFF = 0.5
_PAIRS = " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, abs(coalesce(CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END, 0)) AS r FROM s"
                            for i, a in enumerate(NUM_COLS) for j, b in enumerate(NUM_COLS) if i < j)


@query("corr_filter_wide_protected", ops="M4 P13 M8", sql=f"""
    WITH s AS ({_IMPUTED_SQL}), p AS ({_PAIRS}), names AS (SELECT unnest({NUM_COLS!r}) AS name, unnest(range({len(NUM_COLS)})) AS i),
    m AS (SELECT i, (1 + (SELECT sum(r) FROM p WHERE p.i = n.i OR p.j = n.i)) / {len(NUM_COLS)} AS mean FROM names n),
    d AS (SELECT DISTINCT CASE WHEN b.mean > a.mean THEN p.j ELSE p.i END AS i FROM p JOIN m a ON a.i = p.i JOIN m b ON b.i = p.j WHERE r > {_FILTER_CUTOFF})
    SELECT name AS dropped_column FROM d JOIN names USING (i) WHERE name NOT IN ({', '.join(repr(c) for c in _PROTECTED)})""")
def corr_filter_wide_protected(t, spark):
    """The filter's form for a hundred columns and more (means taken once), some columns protected from it."""
    imputed = impute.mean_impute(numeric_applicants(t), NUM_COLS)
    drop = selection.correlation_filter(imputed, NUM_COLS, cutoff=_FILTER_CUTOFF, protect=_PROTECTED, exact=False)
    return spark.createDataFrame([(c,) for c in drop], "dropped_column string")


# ---------------------------------------------------------------------------
# R12 on the feature table, E6
# ---------------------------------------------------------------------------
@query("train_on_feature_table", ops="R12 S4 S5 L2 L3 L4 L5 U2")
def train_on_feature_table(t, spark):
    """The merged table from its stage, split by label, boosted with patience, its test rows scored."""
    stages = restart_of(spark)
    inputs = inputs_of(t, "customer", "nation", "region", "orders", "lineitem")
    wide = stages.stage("merged", inputs, lambda: merged_table(t))
    first, second = split.split_back(wide)
    first = first.join(analog.labels(t), "SK_ID_CURR")
    feats = [c for c in C.numeric_columns(wide, ["SK_ID_CURR", "is_train"]) if c != "TARGET"]
    tagged = split.stratified_split(first, "SK_ID_CURR", "TARGET", _VALID_P, seed=7)
    both = tagged.unionByName(second.withColumns({"TARGET": F.lit(None).cast("int"), "split": F.lit("test")}))
    data = stages.stage("training", {"merged": "merged"}, lambda: impute.mean_impute(both, feats))
    got = staged.train_with_patience(data.where("split != 'test'"), feats, "TARGET", 20, 5, pos_weight=POS_WEIGHT, maxDepth=4, stepSize=0.1,
                                     maxBins=64, subsamplingRate=0.87, featureSubsetStrategy="0.95")
    scores = train.score(got.result, data.where("split = 'test'"), "SK_ID_CURR")
    return scores.withColumns({"best_round": F.lit(got.best), "valid_auc": F.lit(got.result.valid_auc).cast("double")})


DECLARED = ["NAME_INCOME_TYPE", "CODE_GENDER", "CNT_CHILDREN"]
_OTHERS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "FLAG_PHONE", "EXT_SOURCE_1"]


@query("declared_categories", ops="E6 L3")
def declared_categories(t, spark):
    """How the trees split each feature: declared ones by level sets only, others by thresholds only."""
    rows = loan.applicants(t).join(analog.labels(t), "SK_ID_CURR").select("TARGET", *DECLARED, *_OTHERS)
    rows = impute.mean_impute(rows, _OTHERS)
    model, _, _ = categories.fit_declared(rows, [*DECLARED, *_OTHERS], DECLARED, "TARGET", 10, maxDepth=4, stepSize=0.1, minInfoGain=0.0)
    kinds = categories.split_kinds(model, [*DECLARED, *_OTHERS], spark)
    return kinds.withColumn("declared", F.col("feature").isin(DECLARED))
