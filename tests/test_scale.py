"""Bucketed kNN, stratified split and boosting rounds against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.operators import knn, knn_index, split, staged, train
from tabula.plans.queries_scale import knn_sides
from tabula.sources.tables import load_tables


def clustered(n=1500, d=8, classes=3, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 4, (20, d))
    which = rng.integers(0, 20, n)
    x = centers[which] + rng.normal(0, 1, (n, d))
    label = np.where(rng.random(n) < 0.02, classes - 1, which % (classes - 1))       # one rare class
    return x, label, rng.integers(0, 4, n)


def plain_sums(x, label, fold, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    d[fold[:, None] == fold[None]] = np.inf
    out = {}
    for i in range(len(x)):
        for c in np.unique(label):
            near = np.sort(d[i, label == c])
            out[i, int(c)] = np.cumsum(near[np.isfinite(near)][:k])
    return out


@pytest.fixture(scope="module")
def points(spark):
    x, label, fold = clustered()
    rows = [(i, [float(v) for v in x[i]], int(label[i]), int(fold[i])) for i in range(len(x))]
    return spark.createDataFrame(rows, "id long, x array<double>, label int, fold int"), plain_sums(x, label, fold, 100)


@pytest.mark.parametrize("k", [10, 100])
def test_bucketed_knn_finds_nine_of_ten_neighbours(points, k):
    df, exact = points
    got = knn_index.knn_sums(df, df, "id", "x", "label", k, fold="fold", oversample=4, cell_rows=40).collect()
    assert len(got) == len(exact)
    found = wanted = 0
    for r in got:
        want = exact[r.id, r.label][:k]
        have = np.array(r.sums)
        assert len(have) <= len(want) and (have >= want[:len(have)] - 1e-9).all()
        # a found distance up to the exact k-th is a true neighbour
        last = np.diff(want, prepend=0)[-1]
        found += (np.diff(have, prepend=0) <= last + 1e-9).sum()
        wanted += len(want)
    assert found / wanted >= 0.9


def test_bucketed_knn_in_blocks_and_whole_is_exact(points):
    df, exact = points
    for sizes in (dict(cell_rows=5000), dict(cell_rows=40, oversample=1e6, query_rows=100, candidate_rows=300)):
        got = knn_index.knn_sums(df, df, "id", "x", "label", 7, fold="fold", **sizes).collect()
        assert len(got) == len(exact)
        for r in got:
            assert np.allclose(r.sums, exact[r.id, r.label][:7])


def test_bucketed_knn_columns_and_nulls(spark):
    rows = [(1, [0.0, 0.0], "a"), (2, [3.0, 4.0], "a"), (3, None, "a"), (4, [0.0, 1.0], None), (5, [0.0, 2.0], "b")]
    df = spark.createDataFrame(rows, "id long, x array<double>, label string")
    got = knn_index.class_columns(knn_index.knn_sums(df, df, "id", "x", "label", 2), "id", "label", (1, 2))
    assert {r.id: tuple(r)[1:] for r in got.collect()}[4] == pytest.approx((1.0, 1.0 + np.sqrt(18), 1.0, None))
    assert got.count() == 4 and got.columns == ["id", "knn_a_1", "knn_a_2", "knn_b_1", "knn_b_2"]
    assert knn_index.knn_sums(df.limit(0), df, "id", "x", "label", 2).collect() == []


def test_bucketed_knn_recall_on_the_embeddings(spark):
    train_rows, rows = knn_sides(load_tables(spark, "/root/testdata/sf0.1"))
    exact = knn.knn_distance_sums(train_rows, rows, "vec_id", "x", "label", 20, fold="fold").where("j = 20").select("vec_id", "label", "dist_sum")
    got = knn_index.knn_sums(train_rows, rows, "vec_id", "x", "label", 20, fold="fold", oversample=4, cell_rows=64)
    both = exact.join(got, ["vec_id", "label"]).select((F.col("dist_sum") / F.get("sums", F.lit(19))).alias("r")).agg(F.avg("r"), F.min("r"), F.count("r")).first()
    assert both[2] == exact.count() and both[0] > 0.9 and both[1] <= 1 + 1e-9


# stratified split

@pytest.mark.parametrize("p", [0.85, 0.5, 0.0, 1.0])
def test_stratified_split_counts(spark, p):
    rows = [(i, "hot" if i % 3 else ["x", "y", None][i % 7 % 3], i) for i in range(900)] + [(1000, "single", 0)]
    df = spark.createDataFrame(rows, "id long, label string, `hash` int")
    got = split.stratified_split(df, "id", "label", p).collect()
    assert sorted(r.id for r in got) == sorted(r[0] for r in rows)
    for c in {r[1] for r in rows}:
        own = [r for r in got if r.label == c]
        assert sum(r.split == "train" for r in own) == int(np.ceil(p * len(own) - 1e-9))
    assert got[0].__fields__ == ["id", "label", "hash", "split"]


def test_stratified_split_on_nothing(spark):
    assert split.stratified_split(spark.createDataFrame([], "id long, label string"), "id", "label").collect() == []


# boosting rounds

def test_best_round():
    assert staged.best_round([.5, .6, .6, .7, .65, .64, .8], 3) == 7
    assert staged.best_round([.5, .6, .6, .7, .65, .64, .8], 2) == 4
    assert staged.best_round([None, .5, float("nan"), .4], 5) == 2
    assert staged.best_round([], 5) == 1


def test_staged_margins_equal_the_model_and_its_truncations(spark):
    rng = np.random.default_rng(2)
    x, c = rng.normal(size=(600, 3)), rng.integers(0, 5, 600)
    y = (x[:, 0] + (c % 2) + rng.normal(0, .7, 600) > .5).astype(int)
    df = spark.createDataFrame([(i, *map(float, x[i]), float(c[i]), int(y[i]), "val" if i % 4 == 0 else "train") for i in range(600)],
                               "id long, a double, b double, c double, d double, TARGET int, split string")
    feats = ["a", "b", "c", "d"]
    got = staged.train_with_patience(df, feats, "TARGET", 12, 4, maxDepth=3, stepSize=0.3, minInstancesPerNode=5)
    assert len(got.curve) == 12 and got.best == staged.best_round([a for _, a in got.curve], 4)
    assert got.result.trees.getNumTrees == got.best and got.result.valid_auc == max(a for _, a in got.curve[:got.best])
    # the truncated model's own AUC is the curve's
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    val = train.assemble(df.where("split = 'val'"), feats)
    auc = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol="TARGET").evaluate(got.result.trees.transform(val))
    assert auc == pytest.approx(got.result.valid_auc, abs=1e-3)
    # categorical splits too: margins after all rounds are the model's raw predictions
    whole = train.train_gbt(df, feats, label="TARGET", categorical_max=6, maxDepth=4, maxIter=5, stepSize=0.3)
    ready = whole.model.stages[0].transform(train.assemble(df, feats)).drop("features").withColumnRenamed("__features_cat", "features")
    margins = staged.staged_margins(ready, staged.tree_tables(whole.trees, spark), whole.trees.treeWeights, "features", ["id"])
    raw = {r.id: r.rawPrediction[1] for r in whole.trees.transform(ready).collect()}
    for r in margins.collect():
        assert r.margins[-1] == pytest.approx(raw[r.id] / 1.0, rel=1e-9) or r.margins[-1] == pytest.approx(raw[r.id] / 2, rel=1e-9)


def test_only_distances_below_the_kth_are_moved():
    """Every pair's distance was rooted, copied and partitioned, 27 ns a pair where the product takes about 6."""
    rng = np.random.default_rng(5)
    best, d2 = np.sort(rng.random((50, 3)), axis=1), rng.random((50, 40)) + 0.9
    best[7], d2[9, 4], d2[9, 30] = np.inf, 0.0, 0.0
    want = np.sort(np.concatenate([best, d2], axis=1), axis=1)[:, :3]
    got = knn._keep_smallest(best, d2, 3)
    assert got is best and np.array_equal(np.sort(got, axis=1), want)
    assert knn._keep_smallest(best, d2 + 9, 3) is best and np.array_equal(np.sort(best, axis=1), want)


def test_vectors_of_unequal_length_are_refused():
    import pyarrow as pa
    with pytest.raises(ValueError, match="one length"):
        knn._vectors(pa.array([[1.0, 2.0], [3.0, 4.0, 5.0]]))
    assert np.array_equal(knn._vectors(pa.chunked_array([[[1.0, 2.0]], [[3.0, None]]])), [[1, 2], [3, np.nan]], equal_nan=True)
