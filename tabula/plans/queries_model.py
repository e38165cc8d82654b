"""Catalog part 3: split/union, entity merge, scores and blends, AUC, column statistics,
imputation, Gram / PCA / SVD, kNN, soft-impute and the boosted-tree trainer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.functions import scalars as X
from tabula.operators import blend as B
from tabula.operators import impute, knn, metrics, reduce, selection, split, train
from tabula.operators.bundles import rollup
from tabula.plans import analog, recipes
from tabula.plans import sqlkit as S
from tabula.plans.registry import query
from tabula.plans.queries_stats import PREV_SQL, previous_apps, split_sql
from tabula.session import keep
from tabula.sources.sinks import fill_template, materialize, score_file_name, scratch_folder, write_scores
from tabula.sources.tables import read_score_files

A = analog.SQL

# ---------------------------------------------------------------------------
# Union / split
# ---------------------------------------------------------------------------
_TRAIN_P = 0.8          # share of applicants that carry a label ("application_train")
_VALID_P = 0.85         # train / validation split inside the labelled rows


def labelled_union(t):
    base = analog.applicant_base(t).select("SK_ID_CURR", "CODE_GENDER", "AMT_INCOME_TOTAL")
    tagged = split.hash_split(base, "SK_ID_CURR", _TRAIN_P, labels=("train", "test"))
    tr = tagged.where(F.col("split") == "train").join(analog.labels(t), "SK_ID_CURR", "left").drop("split")
    te = tagged.where(F.col("split") == "test").drop("split")
    return split.union_train_test(tr, te)


_UNION_SQL = f"""
    WITH a AS (SELECT SK_ID_CURR, CODE_GENDER, AMT_INCOME_TOTAL FROM ({A['applicant_base']}) x),
         lab AS ({A['labels']})
    SELECT a.SK_ID_CURR, a.CODE_GENDER, a.AMT_INCOME_TOTAL, lab.TARGET, 1 AS is_train
    FROM a LEFT JOIN lab ON a.SK_ID_CURR = lab.SK_ID_CURR WHERE {split_sql('a.SK_ID_CURR', _TRAIN_P)}
    UNION ALL
    SELECT SK_ID_CURR, CODE_GENDER, AMT_INCOME_TOTAL, NULL AS TARGET, 0 AS is_train
    FROM a WHERE NOT {split_sql('SK_ID_CURR', _TRAIN_P)}"""


@query("union_split", ops="U1 U2 L2 F7", sql=_UNION_SQL, doubles=["AMT_INCOME_TOTAL"])
def union_split(t, spark):
    return labelled_union(t)


@query("hash_split", ops="L2 F7",
       sql=f"""SELECT SK_ID_CURR, CASE WHEN NOT {split_sql('SK_ID_CURR', _TRAIN_P)} THEN 'test'
                                       WHEN {split_sql('SK_ID_CURR', _VALID_P).replace("':', '42'", "':', '7'")} THEN 'train'
                                       ELSE 'val' END AS split
               FROM customer c JOIN (SELECT c_custkey AS SK_ID_CURR FROM customer) k ON c.c_custkey = k.SK_ID_CURR""")
def hash_split_q(t, spark):
    u = labelled_union(t).select("SK_ID_CURR", "is_train")
    u = split.hash_split(u, "SK_ID_CURR", _VALID_P, seed=7)
    return u.select("SK_ID_CURR", F.when(F.col("is_train") == 0, F.lit("test")).otherwise(F.col("split")).alias("split"))


# ---------------------------------------------------------------------------
# Entity merge J1: applicant ⟕ five child roll-ups
# ---------------------------------------------------------------------------
def _child_rollups(t):
    bureau = rollup(analog.bureau(t).select("SK_ID_CURR", "DAYS_CREDIT", "AMT_CREDIT_SUM"), "SK_ID_CURR",
                    ["mean", "max"]).withColumnsRenamed({"DAYS_CREDIT_mean": "BUR_DAYS_CREDIT_mean",
                                                         "DAYS_CREDIT_max": "BUR_DAYS_CREDIT_max",
                                                         "AMT_CREDIT_SUM_mean": "BUR_AMT_CREDIT_SUM_mean",
                                                         "AMT_CREDIT_SUM_max": "BUR_AMT_CREDIT_SUM_max"})
    pos = rollup(analog.pos_cash(t).select("SK_ID_CURR", "SK_DPD"), "SK_ID_CURR", ["mean", "max", "sum"])
    cc = rollup(analog.pos_cash(t).where(F.col("NAME_CONTRACT_STATUS") == "purchase")
                .select("SK_ID_CURR", F.col("SK_DPD").alias("AMT_DRAWINGS")), "SK_ID_CURR", ["sum"])
    pay = rollup(recipes.payment_rows(analog.installments(t)).select("SK_ID_CURR", "DPD", "DBD"),
                 "SK_ID_CURR", ["mean"])
    prev = rollup(previous_apps(t).select("SK_ID_CURR", "l_quantity", "p_size"), "SK_ID_CURR", ["mean", "max"])
    return [bureau, cc, pay, pos, prev]


_MERGE_SQL = f"""
    SELECT a.SK_ID_CURR, a.CODE_GENDER, b.*, cc.*, p.*, pos.*, pr.*
    FROM ({A['applicant_base']}) a
    LEFT JOIN (SELECT SK_ID_CURR AS __k1, avg(DAYS_CREDIT) AS BUR_DAYS_CREDIT_mean, max(DAYS_CREDIT) AS BUR_DAYS_CREDIT_max,
                      avg(AMT_CREDIT_SUM) AS BUR_AMT_CREDIT_SUM_mean, max(AMT_CREDIT_SUM) AS BUR_AMT_CREDIT_SUM_max
               FROM ({A['bureau']}) x GROUP BY SK_ID_CURR) b ON a.SK_ID_CURR = b.__k1
    LEFT JOIN (SELECT SK_ID_CURR AS __k2, sum(SK_DPD) AS AMT_DRAWINGS_sum FROM ({A['pos_cash']}) x
               WHERE NAME_CONTRACT_STATUS = 'purchase' GROUP BY SK_ID_CURR) cc ON a.SK_ID_CURR = cc.__k2
    LEFT JOIN (SELECT SK_ID_CURR AS __k3, {S.agg('mean', 'DPD')} AS DPD_mean, {S.agg('mean', 'DBD')} AS DBD_mean
               FROM (SELECT SK_ID_CURR, {S.clamp0('DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT')} AS DPD,
                            {S.clamp0('DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT')} AS DBD FROM ({A['installments']}) i) x
               GROUP BY SK_ID_CURR) p ON a.SK_ID_CURR = p.__k3
    LEFT JOIN (SELECT SK_ID_CURR AS __k4, avg(SK_DPD) AS SK_DPD_mean, max(SK_DPD) AS SK_DPD_max, sum(SK_DPD) AS SK_DPD_sum
               FROM ({A['pos_cash']}) x GROUP BY SK_ID_CURR) pos ON a.SK_ID_CURR = pos.__k4
    LEFT JOIN (SELECT SK_ID_CURR AS __k5, avg(l_quantity) AS l_quantity_mean, max(l_quantity) AS l_quantity_max,
                      avg(p_size) AS p_size_mean, max(p_size) AS p_size_max
               FROM ({PREV_SQL}) x GROUP BY SK_ID_CURR) pr ON a.SK_ID_CURR = pr.__k5"""
_MERGE_SQL = f"SELECT * EXCLUDE (__k1, __k2, __k3, __k4, __k5) FROM ({_MERGE_SQL}) m"
_MERGE_DOUBLES = ["BUR_DAYS_CREDIT_mean", "BUR_AMT_CREDIT_SUM_mean", "BUR_AMT_CREDIT_SUM_max", "AMT_DRAWINGS_sum",
                  "DPD_mean", "DBD_mean", "SK_DPD_mean", "SK_DPD_max", "SK_DPD_sum", "l_quantity_mean",
                  "l_quantity_max", "p_size_mean"]


@query("entity_merge", ops="J1 A1 U3", sql=_MERGE_SQL, doubles=_MERGE_DOUBLES)
def entity_merge(t, spark):
    from tabula.operators.joins import rollup_join
    base = analog.applicant_base(t).select("SK_ID_CURR", "CODE_GENDER")
    return rollup_join(base, _child_rollups(t), "SK_ID_CURR")


# ---------------------------------------------------------------------------
# Score tables, template fill, blends, AUC
# ---------------------------------------------------------------------------
_NAMES = [f"t{i}" for i in range(1, 8)]


def score_wide(t):
    """All seven scores as columns of one derivation."""
    return analog.applicants(t).select(
        "SK_ID_CURR",
        F.col("EXT_SOURCE_1").alias("t1"), F.col("EXT_SOURCE_2").alias("t2"), F.col("EXT_SOURCE_3").alias("t3"),
        X.ieee_divide("CNT_CHILDREN", "CNT_FAM_MEMBERS").alias("t4"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("AMT_ANNUITY") / 100000))).alias("t5"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("DAYS_BIRTH") / 1000))).alias("t6"),
        ((F.col("EXT_SOURCE_1") + F.col("EXT_SOURCE_2") + F.col("EXT_SOURCE_3")) / 3).alias("t7"))


def score_tables(t) -> dict:
    wide = keep(score_wide(t))              # seven tables of one derivation
    return {n: wide.select("SK_ID_CURR", F.col(n).alias("TARGET")) for n in _NAMES}


SCORES_SQL = f"""
    SELECT SK_ID_CURR, EXT_SOURCE_1 AS t1, EXT_SOURCE_2 AS t2, EXT_SOURCE_3 AS t3,
           {S.div('CNT_CHILDREN', 'CNT_FAM_MEMBERS')} AS t4,
           1.0 / (1.0 + exp(-AMT_ANNUITY / 100000)) AS t5, 1.0 / (1.0 + exp(DAYS_BIRTH / 1000)) AS t6,
           (EXT_SOURCE_1 + EXT_SOURCE_2 + EXT_SOURCE_3) / 3 AS t7
    FROM ({A['applicants']}) a"""
# The two blend weightings of the score-mixing script.
BLEND_80_20 = [(0.8, {"t1": 0.3, "t2": 0.3, "t3": 0.3, "t6": 0.1}), (0.2, {"t7": 0.5, "t4": 0.4, "t5": 0.1})]
BLEND_90_10 = [(0.9, {"t1": 0.3, "t2": 0.3, "t3": 0.3, "t6": 0.1}), (0.1, {"t7": 0.5, "t4": 0.4, "t5": 0.1})]


def _blend_sql(groups):
    outer = " + ".join(f"{w!r} * ({' + '.join(f'{n} * {wi!r}' for n, wi in m.items())})" for w, m in groups)
    return f"SELECT SK_ID_CURR, {outer} AS TARGET FROM ({SCORES_SQL}) s"


for _name, _groups in (("blend_80_20", BLEND_80_20), ("blend_90_10", BLEND_90_10)):
    def _b(t, spark, groups=_groups):
        return B.blend(score_tables(t), "SK_ID_CURR", "TARGET", "weighted", groups)
    query(_name, ops="S8 J6 L8 C16", sql=_blend_sql(_groups), doubles=["TARGET"])(_b)


@query("blend_median", ops="J6 L9 C15",
       sql=f"SELECT SK_ID_CURR, list_sort([t1, t2, t3, t4, t5, t6, t7])[4] AS TARGET FROM ({SCORES_SQL}) s "
           "WHERE t1 IS NOT NULL AND t2 IS NOT NULL AND t3 IS NOT NULL AND t4 IS NOT NULL AND t5 IS NOT NULL "
           "AND t6 IS NOT NULL AND t7 IS NOT NULL "
           f"UNION ALL SELECT SK_ID_CURR, NULL FROM ({SCORES_SQL}) s WHERE t1 IS NULL OR t2 IS NULL OR t3 IS NULL "
           "OR t4 IS NULL OR t5 IS NULL OR t6 IS NULL OR t7 IS NULL",
       doubles=["TARGET"])
def blend_median(t, spark):
    return B.blend(score_tables(t), "SK_ID_CURR", "TARGET", "median")


def written_score_files(t, spark) -> dict:
    """Each score table written as a file of its own (key, score); name -> path."""
    folder = scratch_folder(spark, "score-files")
    wide = materialize(score_wide(t), "scores")
    for n in _NAMES:
        write_scores(wide, wide.select("SK_ID_CURR", F.col(n).alias("TARGET")), f"{folder}/{n}")
    return {n: f"{folder}/{n}" for n in _NAMES}


@query("score_files_long", ops="S8 S6 S7", doubles=["TARGET"], sql=" UNION ALL ".join(
    f"SELECT '{n}' AS source, SK_ID_CURR, {n} AS TARGET FROM ({SCORES_SQL}) s" for n in _NAMES))
def score_files_long(t, spark):
    return read_score_files(spark, written_score_files(t, spark))


@query("blend_score_files", ops="S8 J6 L8 C16", sql=_blend_sql(BLEND_80_20), doubles=["TARGET"])
def blend_score_files(t, spark):
    files = written_score_files(t, spark)
    frames = {n: read_score_files(spark, {n: path}) for n, path in files.items()}
    return B.blend(frames, "SK_ID_CURR", "TARGET", "weighted", BLEND_80_20)


@query("score_correlation", ops="M9 M2 J6",
       sql=" UNION ALL ".join(
           f"SELECT '{a}' AS col_a, '{b}' AS col_b, {S.nonfinite_null(f'corr({a}, {b})')} AS corr FROM ({SCORES_SQL}) s"
           for i, a in enumerate(_NAMES) for b in _NAMES[i + 1:]),
       doubles=["corr"])
def score_correlation(t, spark):
    return B.score_correlation(score_tables(t), "SK_ID_CURR", "TARGET")


@query("template_scores", ops="S7 J1",
       sql=f"""SELECT a.SK_ID_CURR::INTEGER AS SK_ID_CURR, s.t3 AS TARGET
               FROM ({A['applicant_base']}) a LEFT JOIN ({SCORES_SQL}) s ON a.SK_ID_CURR = s.SK_ID_CURR
               WHERE NOT {split_sql('a.SK_ID_CURR', _TRAIN_P)}""", doubles=["TARGET"])
def template_scores(t, spark):
    base = split.hash_split(analog.applicant_base(t), "SK_ID_CURR", _TRAIN_P, labels=("train", "test"))
    template = base.where(F.col("split") == "test").select("SK_ID_CURR")
    return fill_template(template, score_tables(t)["t3"])


def _auc_sql():
    parts = []
    for n in _NAMES:
        parts.append(f"""
          SELECT '{n}' AS score_name, s.{n} AS s, l.TARGET AS y FROM ({SCORES_SQL}) s
          JOIN ({A['labels']}) l ON s.SK_ID_CURR = l.SK_ID_CURR""")
    long = " UNION ALL ".join(parts)
    return f"""
      WITH d AS ({long}),
      c AS (SELECT score_name, s, sum((y = 1)::BIGINT) AS pos, sum((y = 0)::BIGINT) AS neg FROM d GROUP BY score_name, s),
      r AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY score_name ORDER BY s
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)
      SELECT score_name, sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg,
             sum(pos * below + pos * neg * 0.5) / (sum(pos) * sum(neg)) AS auc
      FROM r GROUP BY score_name"""


@query("auc_rank", ops="L6", sql=_auc_sql(), doubles=["auc"])
def auc_rank(t, spark):
    # one derivation of all scores, then one row per (score, applicant)
    wide = score_wide(t).join(analog.labels(t).withColumnRenamed("TARGET", "y"), "SK_ID_CURR")
    pairs = F.array(*[F.struct(F.lit(n).alias("score_name"), F.col(n).cast("double").alias("s")) for n in _NAMES])
    long = wide.select("y", F.explode(pairs).alias("p")).select("p.score_name", "p.s", "y")
    return metrics.auc(long, "y", "s", by=["score_name"])


# ---------------------------------------------------------------------------
# Column statistics (M1-M4) on the applicant numeric table
# ---------------------------------------------------------------------------
NUM_COLS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS", "CNT_CHILDREN",
            "DAYS_BIRTH", "DAYS_EMPLOYED", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "FLAG_MOBIL",
            "FLAG_RICH", "CREDIT_TOTAL_AND_GOODS"]


def numeric_applicants(t):
    a = analog.applicants(t)
    return a.select("SK_ID_CURR", *NUM_COLS[:11], F.lit(1).alias("FLAG_MOBIL"),
                    (F.col("AMT_INCOME_TOTAL") > 9700).cast("int").alias("FLAG_RICH"),
                    (F.col("AMT_CREDIT") + F.col("AMT_GOODS_PRICE")).alias("CREDIT_TOTAL_AND_GOODS"))


NUMERIC_SQL = f"""
    SELECT SK_ID_CURR, {', '.join(NUM_COLS[:11])}, 1 AS FLAG_MOBIL, (AMT_INCOME_TOTAL > 9700)::INTEGER AS FLAG_RICH,
           AMT_CREDIT + AMT_GOODS_PRICE AS CREDIT_TOTAL_AND_GOODS
    FROM ({A['applicants']}) a"""


def _nzv_sql():
    casts = ", ".join(f"{c}::DOUBLE AS {c}" for c in NUM_COLS)
    names = ", ".join(f"('{c}')" for c in NUM_COLS)
    return f"""
      WITH src AS (SELECT {casts} FROM ({NUMERIC_SQL}) n),
      u AS (UNPIVOT src ON {', '.join(NUM_COLS)} INTO NAME col VALUE v),
      cnt AS (SELECT col, v, count(*) AS c FROM u GROUP BY col, v),
      r AS (SELECT col, c, row_number() OVER (PARTITION BY col ORDER BY c DESC) AS rn FROM cnt),
      agg AS (SELECT col, max(CASE WHEN rn = 1 THEN c END) AS top1, max(CASE WHEN rn = 2 THEN c END) AS top2,
                     count(*) AS nu FROM r GROUP BY col),
      names AS (SELECT * FROM (VALUES {names}) t(col)),
      m AS (SELECT names.col AS "column",
                   CASE WHEN coalesce(nu, 0) <= 1 THEN 0.0 ELSE top1::DOUBLE / top2 END AS freq_ratio,
                   100.0 * coalesce(nu, 0) / (SELECT count(*) FROM src) AS percent_unique,
                   (coalesce(nu, 0) <= 1)::INTEGER AS zero_var
            FROM names LEFT JOIN agg ON names.col = agg.col)
      SELECT *, (zero_var = 1 OR (freq_ratio > {selection.FREQ_CUT!r} AND percent_unique <= {selection.UNIQUE_CUT!r}))::INTEGER AS nzv
      FROM m"""


@query("nzv_columns", ops="M1 A15", sql=_nzv_sql(), doubles=["freq_ratio", "percent_unique"])
def nzv_columns(t, spark):
    return selection.nzv_metrics(numeric_applicants(t), NUM_COLS)


_IMPUTED_SQL = f"""
    SELECT SK_ID_CURR, {', '.join(f'coalesce({c}::DOUBLE, avg({c}::DOUBLE) OVER (), 0.0) AS {c}' for c in NUM_COLS)}
    FROM ({NUMERIC_SQL}) n"""


@query("mean_impute", ops="M3 F6 A14", sql=_IMPUTED_SQL, doubles=NUM_COLS)
def mean_impute(t, spark):
    return impute.mean_impute(numeric_applicants(t), NUM_COLS)


@query("corr_matrix_long", ops="M2 M3",
       sql=" UNION ALL ".join(
           f"SELECT '{a}' AS col_a, '{b}' AS col_b, {S.nonfinite_null(f'corr({a}, {b})')} AS corr FROM ({_IMPUTED_SQL}) s"
           for i, a in enumerate(NUM_COLS) for b in NUM_COLS[i + 1:]),
       doubles=["corr"])
def corr_matrix_long(t, spark):
    return selection.correlation_long(impute.mean_impute(numeric_applicants(t), NUM_COLS), NUM_COLS)


@query("corr_filter_pairwise", ops="M4 M2 P13 M8")
def corr_filter_pairwise(t, spark):
    imputed = impute.mean_impute(numeric_applicants(t), NUM_COLS)
    drop = selection.correlation_filter(imputed, NUM_COLS, cutoff=0.9)
    return spark.createDataFrame([(c,) for c in drop], "dropped_column string")


# ---------------------------------------------------------------------------
# Gram / PCA / SVD (M5, M6) and kNN (L1) over the embeddings table
# ---------------------------------------------------------------------------
def embedding_vectors(t):
    e = t["embeddings"]
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"), "label")


@query("gram_matrix_long", ops="M5 M6 core",
       sql="""WITH u AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i
                         FROM embeddings)
              SELECT a.i::INTEGER AS i, b.i::INTEGER AS j, sum(a.x * b.x) AS value
              FROM u a JOIN u b ON a.vec_id = b.vec_id GROUP BY a.i, b.i""",
       doubles=["value"])
def gram_matrix_long(t, spark):
    return reduce.gram_long(embedding_vectors(t), "x", 64)


@query("pca_scores", ops="M5 M3")
def pca_scores(t, spark):
    imputed = impute.mean_impute(numeric_applicants(t), NUM_COLS)
    cols = [c for c in NUM_COLS if c != "FLAG_MOBIL"]          # a constant column has no scale
    return reduce.pca_scores(imputed, cols, k=5, keep=["SK_ID_CURR"])


@query("svd_scores_uncentered", ops="M6")
def svd_scores_uncentered(t, spark):
    return reduce.svd_scores_array(embedding_vectors(t), "x", 64, 3, keep=["vec_id"])


def _row_length(scores, key, k):
    return scores.select(key, sum((F.col(f"PC{i}") * F.col(f"PC{i}") for i in range(1, k + 1)), F.lit(0.0)).alias("sq_length"))


#: With as many components as columns, scores are a rotation of the rows and keep their lengths.
@query("svd_full_lengths", ops="M6", doubles=["sq_length"],
       sql="SELECT vec_id, list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) AS sq_length FROM embeddings")
def svd_full_lengths(t, spark):
    return _row_length(reduce.svd_scores_array(embedding_vectors(t), "x", 64, 64, keep=["vec_id"]), "vec_id", 64)


_SCALED = [c for c in NUM_COLS if c != "FLAG_MOBIL"]


@query("pca_full_lengths", ops="M5 M3", doubles=["sq_length"], sql="SELECT SK_ID_CURR, " + " + ".join(
    f"pow(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 2)" for c in _SCALED) + f" AS sq_length FROM ({_IMPUTED_SQL}) i")
def pca_full_lengths(t, spark):
    imputed = impute.mean_impute(numeric_applicants(t), NUM_COLS)
    scores = reduce.pca_scores(imputed, _SCALED, k=len(_SCALED), keep=["SK_ID_CURR"])
    return _row_length(scores, "SK_ID_CURR", len(_SCALED))


_KNN_K = 5
_KNN_FOLDS = 5


def _fold_sql(k):
    return f"((('0x' || substr(md5(concat({k}::VARCHAR, ':', '7')), 1, 8))::BIGINT % {_KNN_FOLDS})::INTEGER)"


_KNN_SQL = f"""
    WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x, label,
                      {split_sql('vec_id', _VALID_P)} AS is_train, {_fold_sql('vec_id')} AS fold FROM embeddings),
    pairs AS (SELECT q.vec_id AS qid, t.label AS label, t.vec_id AS tid, list_distance(q.x, t.x) AS d
              FROM e q JOIN e t ON t.is_train AND (NOT q.is_train OR q.fold <> t.fold)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY qid, label ORDER BY d, tid) AS j FROM pairs)
    SELECT qid AS vec_id, label, j::INTEGER AS j,
           sum(d) OVER (PARTITION BY qid, label ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dist_sum
    FROM ranked WHERE j <= {_KNN_K}"""


@query("knn_class_distance_sums", ops="L1 O3", sql=_KNN_SQL, doubles=["dist_sum"])
def knn_class_distance_sums(t, spark):
    return knn_distance_frame(t)


def knn_distance_frame(t):
    v = split.hash_split(embedding_vectors(t), "vec_id", _VALID_P, labels=("train", "test"))
    v = v.withColumn("fold", F.when(F.col("split") == "train", split.hash_fold("vec_id", _KNN_FOLDS, seed=7))
                     .otherwise(F.lit(-1)))
    train_rows = v.where(F.col("split") == "train")
    return knn.knn_distance_sums(train_rows, v, "vec_id", "x", "label", _KNN_K, fold="fold")


_KNN_CLASSES = range(10)                # the classes of the embeddings table
_KNN_COLUMNS = [f"knn_{c}_{j}" for c in _KNN_CLASSES for j in range(1, _KNN_K + 1)]


@query("knn_columns_by_split", ops="L1 L10 O3 L2", doubles=_KNN_COLUMNS, sql=f"""
    SELECT e.vec_id, CASE WHEN {split_sql('e.vec_id', _VALID_P)} THEN 'train' ELSE 'test' END AS split,
           {', '.join(f"max(CASE WHEN k.label = {c} AND k.j = {j} THEN k.dist_sum END) AS knn_{c}_{j}"
                      for c in _KNN_CLASSES for j in range(1, _KNN_K + 1))}
    FROM embeddings e LEFT JOIN ({_KNN_SQL}) k ON e.vec_id = k.vec_id GROUP BY e.vec_id""")
def knn_columns_by_split(t, spark):
    table = split.hash_split(t["embeddings"].select("vec_id"), "vec_id", _VALID_P, labels=("train", "test"))
    columns = knn.distance_columns(knn_distance_frame(t), "vec_id", "label", _KNN_K, list(_KNN_CLASSES))
    return knn.with_columns(table, columns, "vec_id")


_SOFT = ["income", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "children"]


def soft_input(t):
    return numeric_applicants(t).select("SK_ID_CURR", (F.col("AMT_INCOME_TOTAL") / 10000).alias("income"),
                                        "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
                                        (F.col("CNT_CHILDREN") / 10).alias("children"))


@query("soft_impute", ops="M7")
def soft_impute(t, spark):
    return impute.soft_impute(soft_input(t), "SK_ID_CURR", _SOFT, rank=3, lam=1.9, max_iter=30, unfinished="warn")


#: An invariant only: observed cells come back unchanged and no cell is left null.
@query("soft_impute_observed", ops="M7", doubles=_SOFT,
       sql=f"""SELECT SK_ID_CURR, AMT_INCOME_TOTAL::DOUBLE / 10000 AS income, EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3,
                      CNT_CHILDREN::DOUBLE / 10 AS children, 0 AS n_null FROM ({NUMERIC_SQL}) n""")
def soft_impute_observed(t, spark):
    full = soft_impute(t, spark)
    seen = soft_input(t).select("SK_ID_CURR", *[F.col(c).isNotNull().alias(f"seen_{c}") for c in _SOFT])
    n_null = sum((F.col(c).isNull().cast("int") for c in _SOFT), F.lit(0))
    return full.join(seen, "SK_ID_CURR").select(
        "SK_ID_CURR", *[F.when(F.col(f"seen_{c}"), F.col(c)).alias(c) for c in _SOFT], n_null.alias("n_null"))


# ---------------------------------------------------------------------------
# Trainer (L3-L5, L7, O1)
# ---------------------------------------------------------------------------
def training_table(t):
    u = labelled_union(t).select("SK_ID_CURR", "TARGET", "is_train")
    u = split.hash_split(u, "SK_ID_CURR", _VALID_P, seed=7)
    u = u.withColumn("split", F.when(F.col("is_train") == 0, F.lit("test")).otherwise(F.col("split")))
    feats = impute.mean_impute(numeric_applicants(t), NUM_COLS)
    return u.join(feats, "SK_ID_CURR")


#: Fixed value: weight of the positive class in the weighted run.
POS_WEIGHT = 11.0


def fitted(t, pos_weight=None):
    """A model fitted on the given tables, and the table it was fitted on."""
    data = keep(training_table(t))
    labelled = data.where((F.col("split") != "test") & F.col("TARGET").isNotNull())
    return train.train_gbt(labelled, NUM_COLS, label="TARGET", split_col="split", valid_value="val", pos_weight=pos_weight,
                           maxIter=20, maxDepth=4, stepSize=0.1, subsamplingRate=1.0, featureSubsetStrategy="all"), data


@query("gbt_scores", ops="L3 L5 S7")
def gbt_scores(t, spark):
    res, data = fitted(t)
    return train.score(res, data.where(F.col("split") == "test"), "SK_ID_CURR")


@query("gbt_scores_weighted", ops="L3 L4 L5")
def gbt_scores_weighted(t, spark):
    res, data = fitted(t, POS_WEIGHT)
    return train.score(res, data.where(F.col("split") == "test"), "SK_ID_CURR")


@query("train_score_write", ops="L3 L4 L5 S6 S7 S8 C17")
def train_score_write(t, spark):
    """Fit, score the test rows, write the score file named by the validation AUC, read it back."""
    res, data = fitted(t, POS_WEIGHT)
    test = data.where(F.col("split") == "test")
    auc = float("nan") if res.valid_auc is None else res.valid_auc
    name = score_file_name("scores_", auc)
    path = f"{scratch_folder(spark, 'submission')}/{name}"
    write_scores(test.select("SK_ID_CURR"), train.score(res, test, "SK_ID_CURR"), path)
    return read_score_files(spark, {name: path}).withColumn("valid_auc", F.lit(auc))


@query("importance_topk", ops="L7 O1")
def importance_topk(t, spark):
    res, _ = fitted(t)
    return train.importance(res, spark, top=30)


# ---------------------------------------------------------------------------
# End-to-end feature pipeline R1-R11 (+ S4/S5): rows-only
# ---------------------------------------------------------------------------
@query("feature_table_pipeline", ops="R1 R2 R3 R4 R5 R6 R7 R8 R9 R10 R11 S4 S5 U1 J1 E2 M1 M3 M4 M5")
def feature_table_pipeline(t, spark):
    from tabula.plans.pipeline import build_feature_table
    return build_feature_table(spark, t)
