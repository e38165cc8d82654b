"""Categorical features declared by name.

A declared column is coded by the distributed dictionary (E1) and carries a nominal ML attribute with its number of
levels, so the trees split it by sets of levels; all other features split by thresholds, however few values they
have.  Null is a level of its own.  The bins are as many as the largest dictionary needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.operators import staged
from tabula.operators.encode import label_encode


def declare_categories(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """``df`` with the named columns coded 0 (null), 1, 2, .. as nominal attributes, and their numbers of levels."""
    coded = label_encode(df.withColumns({c: F.col(c).cast("string") for c in cols}), cols)
    coded = coded.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("double") for c in cols})
    most = coded.agg(*[F.max(c).alias(c) for c in cols]).first()
    sizes = {c: int(most[c] or 0) + 1 for c in cols}
    for c, n in sizes.items():
        coded = coded.withColumn(c, F.col(c).alias(c, metadata={"ml_attr": {"type": "nominal", "name": c, "num_vals": n}}))
    return coded, sizes


def fit_declared(df: DataFrame, features: Sequence[str], declared: Sequence[str], label: str, rounds: int,
                 **params) -> tuple[GBTClassificationModel, DataFrame, dict[str, int]]:
    """A model whose trees split ``declared`` features by level sets; returns the coded rows and the level counts too."""
    coded, sizes = declare_categories(df, declared)
    bins = max([params.pop("maxBins", 255), *sizes.values()])
    return staged.fit_rounds(coded, features, label, rounds, maxBins=bins, **params), coded, sizes


def split_kinds(model: GBTClassificationModel, features: Sequence[str], spark) -> DataFrame:
    """(feature, by_levels, by_threshold): how many splits of the trees there are of each kind."""
    counts = {f: [0, 0] for f in features}
    for tree in staged.tree_tables(model, spark):
        for i, sets in zip(tree.feature.tolist(), tree.categories):
            if i >= 0:
                counts[features[i]][sets is None] += 1
    return spark.createDataFrame([(f, a, b) for f, (a, b) in counts.items()], "feature string, by_levels long, by_threshold long")
