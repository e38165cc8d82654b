"""Catalog part 4: bucketed kNN, exact stratified split, boosting rounds with patience."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.operators import knn_index, split, staged, train
from tabula.plans.queries_model import _KNN_FOLDS, _VALID_P, NUM_COLS, POS_WEIGHT, embedding_vectors, training_table
from tabula.plans.queries_stats import split_sql
from tabula.plans.registry import query
from tabula.session import keep

#: Fixed value: the larger number of neighbours of the reference's runs.
KNN_MANY = 100
_STEPS = (1, 10, 40, 100)
_CLASSES = range(10)                # of the embeddings table; the Spark side reads them from the table
_COLUMNS = [f"knn_{c}_{j}" for c in _CLASSES for j in _STEPS]


def knn_sides(t):
    """(training rows, all rows) with the folds of the out-of-fold features."""
    v = split.hash_split(embedding_vectors(t), "vec_id", _VALID_P, labels=("train", "test"))
    v = v.withColumn("fold", F.when(F.col("split") == "train", split.hash_fold("vec_id", _KNN_FOLDS, seed=7)).otherwise(F.lit(-1)))
    return v.where(F.col("split") == "train"), v


_FOLD_SQL = f"((('0x' || substr(md5(concat(vec_id::VARCHAR, ':', '7')), 1, 8))::BIGINT % {_KNN_FOLDS})::INTEGER)"

#: The exact neighbours: at this size the search of the index covers all rows of every class.
_MANY_SQL = f"""
    WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x, label, {split_sql('vec_id', _VALID_P)} AS is_train, {_FOLD_SQL} AS fold FROM embeddings),
    pairs AS (SELECT q.vec_id, t.label, list_distance(q.x, t.x) AS d FROM e q JOIN e t ON t.is_train AND (NOT q.is_train OR q.fold <> t.fold)),
    ranked AS (SELECT vec_id, label, row_number() OVER w AS j, sum(d) OVER (w ROWS UNBOUNDED PRECEDING) AS s FROM pairs WINDOW w AS (PARTITION BY vec_id, label ORDER BY d))
    SELECT vec_id, {', '.join(f"max(CASE WHEN label = {c} AND j = {j} THEN s END) AS knn_{c}_{j}" for c in _CLASSES for j in _STEPS)}
    FROM ranked GROUP BY vec_id"""


@query("knn_bucketed_many", ops="L1 O3 J7", sql=_MANY_SQL, doubles=_COLUMNS)
def knn_bucketed_many(t, spark):
    train_rows, rows = knn_sides(t)
    sums = knn_index.knn_sums(train_rows, rows, "vec_id", "x", "label", KNN_MANY, fold="fold")
    return knn_index.class_columns(sums, "vec_id", "label", _STEPS)


# ---------------------------------------------------------------------------
# L2: exact stratified split
# ---------------------------------------------------------------------------
def _strata(table, key, label):
    return f"""SELECT {key}, {label}, CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY ('0x' || substr(md5(concat({key}::VARCHAR, ':', '42')), 1, 8))::BIGINT, {key})
                   <= ceil({_VALID_P} * count(*) OVER (PARTITION BY {label}) - 1e-9) THEN 'train' ELSE 'val' END AS split FROM {table}"""


@query("stratified_split", ops="L2 F7", sql=_strata("orders", "o_orderkey", "o_orderpriority"))
def stratified_split(t, spark):
    return split.stratified_split(t["orders"].select("o_orderkey", "o_orderpriority"), "o_orderkey", "o_orderpriority", _VALID_P)


@query("stratified_split_counts", ops="L2", sql="""
    SELECT o_orderpriority, o_orderstatus, ceil(0.85 * count(*) - 1e-9)::BIGINT AS n_train, (count(*) - ceil(0.85 * count(*) - 1e-9))::BIGINT AS n_val
    FROM orders GROUP BY ALL""")
def stratified_split_counts(t, spark):
    """Classes of two columns at once: exactly the share of each."""
    rows = t["orders"].select("o_orderkey", "o_orderpriority", "o_orderstatus", F.concat_ws("|", "o_orderpriority", "o_orderstatus").alias("stratum"))
    tagged = split.stratified_split(rows, "o_orderkey", "stratum", _VALID_P)
    count = {f"n_{s}": F.count(F.when(F.col("split") == s, F.lit(1))) for s in ("train", "val")}
    return tagged.groupBy("o_orderpriority", "o_orderstatus").agg(*[c.alias(n) for n, c in count.items()])


# ---------------------------------------------------------------------------
# AUC by round, patience, best round
# ---------------------------------------------------------------------------
ROUNDS, PATIENCE = 40, 8


def staged_fit(t):
    data = keep(training_table(t))
    labelled = data.where((F.col("split") != "test") & F.col("TARGET").isNotNull())
    got = staged.train_with_patience(labelled, NUM_COLS, "TARGET", ROUNDS, PATIENCE, pos_weight=POS_WEIGHT, maxDepth=4, stepSize=0.1,
                                     subsamplingRate=0.87, featureSubsetStrategy="0.95")
    return got, data


@query("auc_by_round", ops="L3 L4 L6")
def auc_by_round(t, spark):
    """Validation AUC after each round; ``best`` marks the round that scores are taken from."""
    got, _ = staged_fit(t)
    rows = [(r, None if a is None else float(a), r == got.best) for r, a in got.curve]
    return spark.createDataFrame(rows, "round int, auc double, best boolean")


@query("gbt_best_round_scores", ops="L3 L4 L5 S7")
def gbt_best_round_scores(t, spark):
    got, data = staged_fit(t)
    return train.score(got.result, data.where(F.col("split") == "test"), "SK_ID_CURR").withColumn("best_round", F.lit(got.best))
