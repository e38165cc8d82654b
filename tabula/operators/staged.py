"""Boosting by rounds (L3, L5): validation AUC after every tree, patience, the best round.

Spark ML stops by the change of its loss and keeps all trees.  Here the ensemble is fitted to its full number of rounds; its trees become
small node tables; one pass over the validation rows gives every row's margin after each round, and
one grouped exact AUC gives the curve.  The best round is the one a trainer with ``patience`` would return: the highest
AUC seen before ``patience`` rounds in a row brought none higher.  ``truncate`` cuts the model to it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.operators import metrics, train
from tabula.sources.sinks import scratch_folder


@dataclass
class Tree:
    """Nodes by number: split feature (-1: leaf), threshold, left categories (None: threshold split), children, prediction."""

    feature: np.ndarray
    threshold: np.ndarray
    categories: list
    left: np.ndarray
    right: np.ndarray
    prediction: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.feature[node] >= 0)
            if not inner.size:
                return self.prediction[node]
            at = node[inner]
            value = x[inner, self.feature[at]]
            goes_left = value <= self.threshold[at]
            for n in np.unique(at):
                if self.categories[n] is not None:
                    goes_left[at == n] = np.isin(value[at == n], self.categories[n])
            node[inner] = np.where(goes_left, self.left[at], self.right[at])


def tree_tables(model: GBTClassificationModel, spark: SparkSession) -> list[Tree]:
    """The ensemble's trees from its saved form (as many rows as the model has nodes)."""
    path = scratch_folder(spark, "model")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    d = nodes.select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
                     "nodeData.split.leftCategoriesOrThreshold", "nodeData.split.numCategories").toPandas()
    out = []
    for _, t in d.sort_values(["treeID", "id"]).groupby("treeID"):
        split = t["leftCategoriesOrThreshold"].tolist()
        is_category = (t["numCategories"] >= 0).to_numpy() & (t["leftChild"] >= 0).to_numpy()
        threshold = [s[0] if len(s) and not c else np.nan for s, c in zip(split, is_category)]
        out.append(Tree(np.where(t["leftChild"] >= 0, t["featureIndex"], -1).astype(np.int64), np.array(threshold),
                        [np.asarray(s) if c else None for s, c in zip(split, is_category)],
                        t["leftChild"].to_numpy(np.int64), t["rightChild"].to_numpy(np.int64), t["prediction"].to_numpy(float)))
    return out


def staged_margins(rows: DataFrame, trees: Sequence[Tree], weights: Sequence[float], features: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and ``margins``: the ensemble's margin after each round."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.vstack(batch["x"].to_numpy())
                steps = np.stack([w * t.margins(x) for t, w in zip(trees, weights)], axis=1)
                yield batch.drop(columns="x").assign(margins=list(np.cumsum(steps, axis=1)))
    rows = rows.select(*keep, vector_to_array(features).alias("x"))
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInPandas(run, f"{fields}, margins array<double>")


def auc_by_round(rows: DataFrame, model: GBTClassificationModel, label: str, features: str = "features") -> DataFrame:
    """(round, n_pos, n_neg, auc) for rounds 1, 2, .. on ``rows``; exact, in one pass over the rows."""
    trees = tree_tables(model, rows.sparkSession)
    staged = staged_margins(rows, trees, model.treeWeights, features, [label])
    long = staged.select(label, F.posexplode("margins").alias("i", "margin"))
    return metrics.auc(long.select(label, (F.col("i") + 1).alias("round"), "margin"), label, "margin", by=["round"])


def best_round(curve: Sequence[float | None], patience: int) -> int:
    """The round (from 1) that early stopping returns: the first of the highest value before ``patience`` rounds
    without a higher one.  Rounds without a value (no AUC) don't count as higher."""
    best, top = 1, None
    for i, value in enumerate(curve, 1):
        if value is not None and value == value and (top is None or value > top):
            best, top = i, value
        elif i - best >= patience:
            break
    return best


def truncate(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The ensemble's first ``rounds`` trees, with its parameters."""
    java = model._java_obj
    jvm = SparkSession.active()._jvm
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees = SparkSession.active().sparkContext._gateway.new_array(kind, rounds)
    weights = SparkSession.active().sparkContext._gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = java.trees()[i], float(model.treeWeights[i])
    short = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    java.copyValues(short, jvm.org.apache.spark.ml.param.ParamMap())
    return GBTClassificationModel(short)


@dataclass
class StagedResult:
    result: train.TrainResult           # the truncated model; valid_auc is that of its best round
    curve: list                         # (round, auc), whole
    best: int


def fit_rounds(df: DataFrame, features: Sequence[str], label: str, rounds: int, pos_weight: float | None = None, **params) -> GBTClassificationModel:
    """All ``rounds`` rounds, without the library's own early stopping; ``pos_weight``: weight of positive rows."""
    p = {**train.DEFAULTS, **params, "maxIter": rounds}
    data = train.assemble(df, features).withColumn("__label", F.col(label).cast("double"))
    if pos_weight is not None:
        p["weightCol"] = "__weight"
        data = data.withColumn("__weight", F.when(F.col("__label") == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0)))
    return GBTClassifier(featuresCol="features", labelCol="__label", **p).fit(data)


def train_with_patience(df: DataFrame, features: Sequence[str], label: str, rounds: int, patience: int, split_col: str = "split",
                        valid_value: str = "val", pos_weight: float | None = None, **params) -> StagedResult:
    """Fit ``rounds`` rounds on the rows that aren't ``valid_value``, choose the best round on those that are, cut the model there."""
    fitted = fit_rounds(df.where(F.col(split_col) != valid_value), features, label, rounds, pos_weight, **params)
    rows = train.assemble(df.where(F.col(split_col) == valid_value), features).withColumn("__label", F.col(label).cast("double"))
    curve = sorted((r["round"], r["auc"]) for r in auc_by_round(rows, fitted, "__label").collect())     # one row per round
    best = best_round([a for _, a in curve], patience)
    best_auc = dict(curve).get(best)
    return StagedResult(train.TrainResult(truncate(fitted, best), list(features), best_auc), curve, best)
