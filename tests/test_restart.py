"""Restartable stages and declared categories."""

import os
import time

from pyspark.sql import functions as F

from tabula.operators import categories
from tabula.sources.restart import Restart


def test_second_run_skips_and_changed_input_recomputes(spark, tmp_path):
    source, base = str(tmp_path / "in.parquet"), str(tmp_path / "stages")
    spark.range(10).write.parquet(source)
    calls = []

    def run(version="1"):
        stages = Restart(spark, base)
        first = stages.stage("first", {"in": spark.read.parquet(source)}, lambda: calls.append("first") or spark.read.parquet(source).withColumn("x", F.col("id") * 2))
        second = stages.stage("second-part", {"first": "first"}, lambda: calls.append("second") or first.groupBy().agg(F.sum("x").alias("s")), version)
        return stages, second.first()["s"]

    stages, s = run()
    assert (s, calls, stages.built) == (90, ["first", "second"], ["first", "second-part"])
    manifest = stages.manifest("first")
    assert manifest["fingerprint"] == stages.fingerprints["first"] and [f["name"] for f in manifest["schema"]["fields"]] == ["id", "x"]
    stages, s = run()
    assert (s, len(calls), stages.reused) == (90, 2, ["first", "second-part"])
    stages, s = run(version="2")
    assert (s, calls[2:], stages.reused) == (90, ["second"], ["first"])
    time.sleep(1.1)
    spark.range(11).write.mode("overwrite").parquet(source)
    stages, s = run(version="2")
    assert (s, calls[3:], stages.reused) == (110, ["first", "second"], [])
    # one version of each stage is left, with its manifest
    assert len([f for f in os.listdir(base) if not f.startswith(".")]) == 4


def test_an_unfinished_stage_is_built_again(spark, tmp_path):
    source, base = str(tmp_path / "in.parquet"), str(tmp_path / "stages")
    spark.range(3).write.parquet(source)

    def run():
        stages = Restart(spark, base)
        stages.stage("only", {"in": spark.read.parquet(source)}, lambda: spark.range(3))
        return stages
    path = run().manifest("only")["path"]
    os.remove(f"{path}/_SUCCESS")
    assert run().built == ["only"] and run().reused == ["only"]


def test_declared_columns_split_by_levels_only(spark):
    rows = [(["x", "y", "z", None][i % 4], i % 3, float(i % 2), float(i % 50), int(i % 4 == 1 or i % 50 > 40)) for i in range(400)]
    df = spark.createDataFrame(rows, "a string, b int, few double, many double, TARGET int")
    model, coded, sizes = categories.fit_declared(df, ["a", "b", "few", "many"], ["a", "b"], "TARGET", 6, maxDepth=4, minInfoGain=0.0, stepSize=0.3, minInstancesPerNode=1)
    assert sizes == {"a": 4, "b": 4} and coded.where("a is null").count() == 0
    kinds = {r.feature: (r.by_levels, r.by_threshold) for r in categories.split_kinds(model, ["a", "b", "few", "many"], spark).collect()}
    assert kinds["a"][0] > 0 and kinds["many"][1] > 0
    assert kinds["a"][1] == kinds["b"][1] == kinds["few"][0] == kinds["many"][0] == 0
