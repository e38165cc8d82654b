"""Restartable intermediates (S4, S5): stages written once under a fingerprint of what they were made from.

A stage's table lies in ``<base>/<name>-<fingerprint>``; beside it ``<name>-<fingerprint>.json`` is its manifest:
inputs, schema, version.  The fingerprint covers the inputs' files (path, length, time of change), the
fingerprints of stages read, and a version that the caller raises when the code or its settings change.  A finished
stage with an equal fingerprint is read back instead of built; after a new one is finished the stage's older versions are removed.
All files are reached through Spark's file systems, so the base may be in any store that executors share.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tabula.sources.tables import read_feature_table


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def files_fingerprint(df: DataFrame) -> str:
    """Digest of the files that ``df`` reads: path, length and time of change of each."""
    spark, parts = df.sparkSession, []
    for name in sorted(df.inputFiles()):
        fs, jpath = _fs(spark, name)
        status = fs.getFileStatus(jpath)
        parts.append(f"{name}:{status.getLen()}:{status.getModificationTime()}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


@dataclass
class Restart:
    """Stages under one shared folder; ``built`` and ``reused`` name what this run did."""

    spark: SparkSession
    base: str
    built: list[str] = field(default_factory=list)
    reused: list[str] = field(default_factory=list)
    fingerprints: dict[str, str] = field(default_factory=dict)

    def stage(self, name: str, inputs: Mapping[str, DataFrame | str], build: Callable[[], DataFrame], version: str = "1") -> DataFrame:
        """The table of stage ``name``: read back if it is there for the same inputs, else built and written.

        ``inputs``: tables (their files count) or names of stages of this run (their fingerprints count).
        """
        known = {n: self.fingerprints[i] if isinstance(i, str) else files_fingerprint(i) for n, i in sorted(inputs.items())}
        mark = hashlib.sha256(json.dumps([name, version, known]).encode()).hexdigest()
        self.fingerprints[name] = mark
        path = f"{self.base.rstrip('/')}/{name}-{mark[:24]}"
        if self._finished(path):
            self.reused.append(name)
            return read_feature_table(self.spark, path)
        df = build()
        df.write.mode("overwrite").parquet(path)
        self._write(f"{path}.json", json.dumps({"name": name, "fingerprint": mark, "version": version, "inputs": known,
                                               "schema": json.loads(df.schema.json()), "path": path}, indent=1))
        self.built.append(name)
        self._remove_others(name, path)
        return read_feature_table(self.spark, path)

    def manifest(self, name: str) -> dict:
        """The manifest of a stage of this run."""
        path = f"{self.base.rstrip('/')}/{name}-{self.fingerprints[name][:24]}.json"
        return json.loads("\n".join(r[0] for r in self.spark.read.text(path).collect()))

    def _finished(self, path: str) -> bool:
        """A table counts once it is committed and its manifest is written after it."""
        return all(_fs(self.spark, p)[0].exists(_fs(self.spark, p)[1]) for p in (f"{path}/_SUCCESS", f"{path}.json"))

    def _write(self, path: str, text: str) -> None:
        fs, jpath = _fs(self.spark, path)
        out = fs.create(jpath, True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    def _remove_others(self, name: str, path: str) -> None:
        fs, base = _fs(self.spark, self.base)
        own = {path.rsplit("/", 1)[1], path.rsplit("/", 1)[1] + ".json"}
        for status in fs.listStatus(base):
            found = status.getPath().getName()
            stem, _, mark = found.removesuffix(".json").rpartition("-")
            if stem == name and len(mark) == 24 and found not in own:
                fs.delete(status.getPath(), True)
