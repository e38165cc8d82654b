"""Table scans.

S1  CSV with header and a *declared* schema (schema inference is a full extra
    pass over the data at scale, so it is only the fallback), or parquet.
S2  a second derivation from the same source reuses one lazy DataFrame;
    Catalyst's ReuseExchange / scan reuse removes the double read.
S3  a logical table may be re-pointed at an alternative file by config.
S4  a materialised feature table is read back as parquet.
S8  several score files become one long DataFrame tagged with the file name
    (never a positional column bind).
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """One logical table; ``overrides`` maps a logical name to another path (S3)."""
    path = (overrides or {}).get(name) or os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def load_tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES,
                overrides: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Lazy dict of DataFrames; nothing is read until an action runs."""
    return {n: table(spark, sf_dir, n, overrides) for n in names}


def read_csv(spark: SparkSession, path: str, schema=None, header: bool = True) -> DataFrame:
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    else:  # fallback only: inference scans the data once more
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_feature_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_score_files(spark: SparkSession, paths: Mapping[str, str], key: str = "SK_ID_CURR",
                     score: str = "TARGET", fmt: str = "csv") -> DataFrame:
    """Long form (source, key, score) of many score files.

    ``paths`` maps a logical name to a file, directory or glob of any store
    Spark reads; each name is one scan with its name as a literal tag.
    """
    out = None
    for name, path in paths.items():
        reader = spark.read.option("header", True)
        df = reader.schema(f"`{key}` long, `{score}` double").csv(path) if fmt == "csv" else reader.parquet(path)
        df = df.select(F.lit(name).alias("source"), F.col(key), F.col(score).cast("double").alias(score))
        out = df if out is None else out.unionByName(df)
    return out
