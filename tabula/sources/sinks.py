"""Sinks and lineage cuts.

S5  intermediate tables are written as parquet and read back, which both
    persists them for a restart (the feature-table restart entry point) and
    cuts lineage so a lost executor does not recompute the whole upstream.
S6  score files carry the validation metric in the name.
S7  a submission template is filled by *key* (left join), never by position.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.session import checkpoint_dir


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def materialize(df: DataFrame, name: str | None = None) -> DataFrame:
    """Write ``df`` under the session's shared checkpoint folder and read it back.

    Used instead of ``localCheckpoint`` (which dies with its executor): the
    written parquet survives executor loss and the returned DataFrame has a
    one-node lineage.  The folder comes from the session (``checkpoint_dir``).
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name or "tbl")
    df.write.mode("overwrite").parquet(path)
    # the shuffle files behind it go when the driver's plans are collected, which a large heap puts off for long
    spark.sparkContext._jvm.System.gc()
    return spark.read.parquet(path)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path under the session's shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def score_file_name(prefix: str, metric: float, digits: int = 5) -> str:
    return f"{prefix}{round(float(metric), digits)}.csv"


def fill_template(template: DataFrame, predictions: DataFrame, key: str = "SK_ID_CURR",
                  score: str = "TARGET") -> DataFrame:
    """Template row set with its score column taken from ``predictions`` by key."""
    return (template.select(key)
            .join(predictions.select(key, F.col(score).alias("__score")), key, "left")
            .select(F.col(key).cast("int").alias(key), F.col("__score").alias(score)))


def write_scores(template: DataFrame, predictions: DataFrame, path: str, key: str = "SK_ID_CURR",
                 score: str = "TARGET") -> DataFrame:
    """Fill the template by key and write it as a CSV with header."""
    filled = fill_template(template, predictions, key, score)
    filled.write.mode("overwrite").option("header", True).csv(path)
    return filled
