"""Bucketed kNN distance features (L1 at scale): an inverted index over learned cells.

k-means centroids, fitted on a bounded sample, cut the space into cells of about ``cell_rows``
training rows.  Queries of one cell search the same cells: for every class the cells nearest to
theirs until these hold ``oversample * k`` of its rows, so a rare class is searched farther out and a
class of fewer rows is searched whole.  Training rows travel to the query cells that search them;
a query gets its k nearest of every class in one task.  Large query cells and candidate sets are
dealt into blocks, whose sorted distances are merged, so neither a dense cell nor a large class
makes a large task.

Work per query depends on k, the number of classes and ``oversample``, not on the number of rows.  The result is
exact where the search covers all rows; otherwise neighbours may be missed, and sums can only be
larger than the exact ones.

Rows with a null vector or label are no training rows; query rows with a null vector get no row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.operators.joins import checked_broadcast
from tabula.sources.sinks import materialize

#: Largest centroid table that tasks are sent.
CENTROID_BYTES = 32 << 20


def learn_cells(train: DataFrame, vec: str, n: int, cell_rows: int, sample_rows: int, seed: int = 7) -> np.ndarray:
    """Centroids of about n / cell_rows cells, fitted on about ``sample_rows`` rows chosen by their hash."""
    if n <= cell_rows:
        return np.zeros((1, 1))
    width = train.select(F.size(vec)).first()[0]
    cells = min(math.ceil(n / cell_rows), CENTROID_BYTES // (8 * width), max(sample_rows // 8, 2))
    part = train.select(F.col(vec).alias("v"))
    if n > sample_rows:
        bound = -(1 << 63) + int((1 << 64) * (sample_rows / n))
        part = part.where(F.xxhash64("v", F.lit(seed)) < F.lit(bound))
    model = KMeans(k=cells, maxIter=10, seed=seed, initSteps=2).fit(part.select(array_to_vector("v").alias("features")))
    return np.vstack(model.clusterCenters())


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.clip((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T), 0.0, None))


def assign_cells(df: DataFrame, vec: str, centers: np.ndarray) -> DataFrame:
    """``df`` with ``cell``, the number of the nearest centroid."""
    if len(centers) == 1:
        return df.withColumn("cell", F.lit(0).cast("long"))

    @F.pandas_udf("long")
    def nearest(v: pd.Series) -> pd.Series:
        x = np.vstack(v.to_numpy()).astype(float)
        return pd.Series(np.concatenate([_distances(x[i:i + 1024], centers).argmin(1) for i in range(0, len(x), 1024)]))

    return df.withColumn("cell", nearest(vec))


def search_plan(counts: DataFrame, centers: np.ndarray, label: str, need: int) -> DataFrame:
    """(group, cell, label): the cells and classes that the queries of cell ``group`` search.

    ``counts``: (cell, label, n).  The cells of each class are taken by their distance from the group's centroid until they
    hold ``need`` rows.
    """
    spark = counts.sparkSession
    rows = counts.collect()                        # one per cell and class: as many as the centroids allow
    kind = counts.schema[label].dataType.simpleString()
    by_class: dict = {}
    for r in rows:
        by_class.setdefault(r[label], []).append((r["cell"], r["n"]))
    table = {c: (np.array([x for x, _ in cells]), np.array([n for _, n in cells])) for c, cells in by_class.items()}

    def plan(batches):
        for batch in batches:
            for g in batch["group"]:
                away = _distances(centers[g:g + 1], centers)[0]
                out = []
                for c, (cells, n) in table.items():
                    order = np.lexsort((cells, away[cells]))
                    enough = int(np.searchsorted(np.cumsum(n[order]), need)) + 1
                    out.append(pd.DataFrame({"group": g, "cell": cells[order[:enough]], label: c, "n": n[order[:enough]]}))
                yield pd.concat(out)
    groups = spark.range(len(centers)).withColumnRenamed("id", "group")
    return groups.mapInPandas(plan, f"group long, cell long, {label} {kind}, n long") if table else \
        spark.createDataFrame([], f"group long, cell long, {label} {kind}, n long")


def _nearest(k: int, key: str, label: str):
    def fn(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if q.empty or t.empty:
            return pd.DataFrame({key: [], label: [], "chunks": [], "dists": []})
        classes = t[label].to_numpy()
        sides = [(c, np.flatnonzero(classes == c)) for c in pd.unique(classes)]
        xt, folds, out = np.vstack(t["vec"].to_numpy()).astype(float), t["fold"].to_numpy(), []
        xq_all, q_folds, keys = np.vstack(q["vec"].to_numpy()).astype(float), q["fold"].to_numpy(), q[key].to_numpy()
        chunks = q["chunks"].to_numpy()
        for at in range(0, len(xq_all), 256):
            part = slice(at, at + 256)
            dist = _distances(xq_all[part], xt)
            dist[q_folds[part][:, None] == folds[None, :]] = np.inf
            for c, cols in sides:
                d = dist[:, cols]
                d = np.sort(np.partition(d, k - 1, axis=1)[:, :k] if k < d.shape[1] else d, axis=1)
                out.append(pd.DataFrame({key: keys[part], label: c, "chunks": chunks[part], "dists": [r[np.isfinite(r)] for r in d]}))
        return pd.concat(out, ignore_index=True)
    return fn


def knn_sums(train: DataFrame, query: DataFrame, key: str, vec: str, label: str, k: int, fold: str | None = None, oversample: float = 8.0,
             cell_rows: int = 512, sample_rows: int = 100_000, query_rows: int = 2048, candidate_rows: int = 16_384) -> DataFrame:
    """One row per query row and class: (key, label, sums): sums[j - 1] is the sum of the distances to the j
    nearest training rows of the class, as long as j of them were found.

    With ``fold``, rows never see training rows of their own fold.
    """
    fold_t, fold_q = (F.col(fold).cast("int"),) * 2 if fold else (F.lit(-2), F.lit(-1))
    t = train.where(F.col(vec).isNotNull() & F.col(label).isNotNull()).select(key, F.col(vec).alias("vec"), label, fold_t.alias("fold"))
    q = query.where(F.col(vec).isNotNull()).select(key, F.col(vec).alias("vec"), fold_q.alias("fold"))
    centers = learn_cells(t, "vec", t.count(), cell_rows, sample_rows)
    t = materialize(assign_cells(t, "vec", centers), "knn-train")
    q = materialize(assign_cells(q, "vec", centers).withColumnRenamed("cell", "group"), "knn-query")
    counts = t.groupBy("cell", label).agg(F.count(F.lit(1)).alias("n"))
    # a row's own fold is no neighbour: look for some rows more
    plan = materialize(search_plan(counts, centers, label, math.ceil(oversample * k)), "knn-plan")
    size = plan.groupBy("group").agg(F.ceil(F.sum("n") / candidate_rows).alias("chunks")).join(
        q.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / query_rows).alias("blocks")), "group")
    size, _ = checked_broadcast(size)
    plan, _ = checked_broadcast(plan.drop("n").join(size, "group"))
    some = F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    t = t.join(plan, ["cell", label]).withColumn("chunk", F.pmod(F.xxhash64(key, F.lit("t")), "chunks")).withColumn("block", F.explode(some[1]))
    q = q.join(size, "group").withColumn("block", F.pmod(F.xxhash64(key, F.lit("q")), "blocks")).withColumn("chunk", F.explode(some[0]))
    task = ["group", "block", "chunk"]
    kind = {c: train.schema[c].dataType.simpleString() for c in (key, label)}
    found = q.select(*task, key, "vec", "fold", "chunks").groupBy(*task).cogroup(t.select(*task, label, "vec", "fold").groupBy(*task)).applyInPandas(
        _nearest(k, key, label), f"{key} {kind[key]}, {label} {kind[label]}, chunks long, dists array<double>")
    found = materialize(found, "knn-found")
    # only queries whose candidates were dealt into several chunks have lists to merge
    merged = found.where(F.col("chunks") > 1).groupBy(key, label).agg(F.flatten(F.collect_list("dists")).alias("dists"))
    found = found.where(F.col("chunks") == 1).select(key, label, "dists").unionByName(merged)
    nearest = F.slice(F.array_sort("dists"), 1, k)
    return found.select(key, label, running_sums(nearest).alias("sums"))


def running_sums(values) -> F.Column:
    """Prefix sums of an array of doubles."""
    @F.pandas_udf("array<double>")
    def add(x: pd.Series) -> pd.Series:
        return x.map(np.cumsum)
    return add(values)


def class_columns(sums: DataFrame, key: str, label: str, steps: Sequence[int], classes: Sequence | None = None, prefix: str = "knn") -> DataFrame:
    """One row per key with columns ``<prefix>_<class>_<j>`` for j in ``steps``; null if fewer than j neighbours were found.

    Without ``classes`` they are read from the table: each makes ``len(steps)`` columns, so they are as few as columns.
    """
    if classes is None:
        classes = sorted(r[0] for r in sums.select(label).distinct().collect())
    return sums.groupBy(key).agg(*[
        F.max(F.when(F.col(label) == F.lit(c), F.get("sums", F.lit(j - 1)))).alias(f"{prefix}_{c}_{j}") for c in classes for j in steps])
