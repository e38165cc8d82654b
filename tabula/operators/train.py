"""Boosted-tree training, scoring and importance (L3-L7, O1) on Spark ML.

The reference's leaf-wise boosting library is re-aimed to
``GBTClassifier`` (parameter map in SURVEY §4.4): learning rate ->
``stepSize``, rounds -> ``maxIter``, early stopping -> a validation
indicator column with ``validationTol``, class weighting -> ``weightCol``.
Trees in Spark ML do not accept nulls, so features are mean-imputed first
(the caller's responsibility; see ``impute.mean_impute``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Trainer settings of the canonical run, mapped to Spark ML names.
DEFAULTS = dict(stepSize=0.02, maxDepth=8, maxBins=255, minInstancesPerNode=10, subsamplingRate=0.87,
                featureSubsetStrategy="0.95", minInfoGain=0.02, maxIter=100, validationTol=1e-4, seed=0)


@dataclass
class TrainResult:
    model: GBTClassificationModel | PipelineModel
    features: list[str]
    valid_auc: float | None
    indexed: bool = False

    @property
    def trees(self) -> GBTClassificationModel:
        return self.model.stages[-1] if self.indexed else self.model


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def train_gbt(df: DataFrame, features: Sequence[str], label: str = "label", split_col: str = "split",
              valid_value: str = "val", pos_weight: float | None = None, categorical_max: int | None = None,
              **params) -> TrainResult:
    """Fit on rows of ``df`` whose ``split_col`` is train or ``valid_value`` (the latter for early stopping).

    ``categorical_max`` (E6): features with at most that many distinct values
    are declared categorical to the trees (``VectorIndexer`` writes the ML
    attribute metadata; one distributed pass counts the distinct values).
    """
    p = dict(DEFAULTS)
    p.update(params)
    data = assemble(df, features).withColumn("__is_val", F.col(split_col) == F.lit(valid_value)) \
        .withColumn("__label", F.col(label).cast("double"))
    indexer = None
    if categorical_max:
        indexer = VectorIndexer(inputCol="features", outputCol="__features_cat", maxCategories=categorical_max,
                                handleInvalid="keep").fit(data)
        data = indexer.transform(data).drop("features").withColumnRenamed("__features_cat", "features")
        p["maxBins"] = max(p.get("maxBins", 32), categorical_max + 1)
    kwargs = dict(featuresCol="features", labelCol="__label", validationIndicatorCol="__is_val", **p)
    if pos_weight is not None:
        data = data.withColumn("__w", F.when(F.col("__label") == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0)))
        kwargs["weightCol"] = "__w"
    trees = GBTClassifier(**kwargs).fit(data)
    val = data.where(F.col("__is_val"))
    auc = None
    if val.take(1):
        auc = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol="__label",
                                            metricName="areaUnderROC").evaluate(trees.transform(val))   # val is already indexed
    model = PipelineModel(stages=[indexer, trees]) if indexer is not None else trees
    return TrainResult(model, list(features), auc, indexer is not None)


def score(result: TrainResult, df: DataFrame, key: str, out: str = "TARGET") -> DataFrame:
    """Positive-class probability per key."""
    data = assemble(df, result.features)
    if result.indexed:
        idx = result.model.stages[0].transform(data).drop("features").withColumnRenamed("__features_cat", "features")
        scored = result.trees.transform(idx)
    else:
        scored = result.model.transform(data)
    return scored.select(F.col(key), vector_to_array("probability")[1].alias(out))


def importance(result: TrainResult, spark, top: int | None = 30) -> DataFrame:
    """Gain-style importance table (L7), normalised to sum 1, optionally top-k (O1)."""
    imp = result.trees.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(result.features, imp)]
    df = spark.createDataFrame(rows, "feature string, gain double").orderBy(F.desc("gain"), "feature")
    return df.limit(top) if top else df
