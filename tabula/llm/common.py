"""Helpers shared by the training-data operators.

Written tables go to the shared folder of ``spark.checkpoint.dir``; they cut
lineage, survive lost executors and are removed when the driver's JVM ends.
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabula.session import checkpoint_dir

#: Largest relation (estimated bytes) that is broadcast after measuring it.
BROADCAST_BYTES = 32 << 20


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(jpath)
    return path


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], base: str) -> str:
    """``base``, lengthened until no column (in any case) has that name."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def maybe_broadcast(df: DataFrame, rows: int, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint if ``rows`` (counted) times ``row_bytes`` stays within ``limit``."""
    return F.broadcast(df) if rows * row_bytes <= limit else df


def hash_sample(df: DataFrame, rows: int, seed: int = 7) -> DataFrame:
    """At least ``rows`` of the distinct rows (all, if there are no more), and not many more.

    The choice is by the rows' 64-bit hashes, so a recomputed partition chooses alike, and however
    often a row is repeated it is chosen once or not at all.
    """
    value = F.xxhash64(F.lit(seed), *(F.col(c) for c in df.columns))
    n = df.agg(F.approx_count_distinct(value, 0.02)).collect()[0][0]
    # room for the count's error (three times 2 %) and the spread of the choice
    want = 1.07 * (rows + 6 * math.sqrt(rows) + 10)
    if n > want:
        df = df.filter(value < F.lit(hash_bound(want, n)))
    return df.distinct()


def hash_bound(rows: float, n: int) -> int:
    """The signed 64-bit value below which ``rows`` of ``n`` hashes are expected."""
    return -(1 << 63) + int((1 << 64) * min(rows / n, 1 - 2 ** -53))


def kth_largest(df: DataFrame, col: str, k: int, step: int = 12) -> int | None:
    """The k-th largest value of a long column, by radix selection.

    Each round counts the values by a prefix of their bits and descends into the
    prefix that holds the k-th; a round brings at most ``2**step`` counts to the
    driver (the first: as many prefixes as the values have above bit 40).
    None if there are fewer than ``k`` non-null values or ``k`` is below 1.
    """
    if k < 1:
        return None
    rest, shift, prefix = k, 40, None
    while True:
        part = df.filter(F.col(col).isNotNull())
        if prefix is not None:
            part = part.filter(F.shiftright(F.col(col), shift + step) == F.lit(prefix))
        cells = part.groupBy(F.shiftright(F.col(col), shift).alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()
        for cell, n in sorted(((r["cell"], r["n"]) for r in cells), reverse=True):
            if rest <= n:
                prefix = cell
                break
            rest -= n
        else:
            return None
        if shift == 0:
            return prefix
        step = min(step, shift)
        shift -= step


def outside(spans: list[tuple[str, int, int]], others: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The (kind, start, end) ``spans`` that overlap none of ``others``."""
    starts: list[int] = []
    ends: list[int] = []
    for _, a, b in sorted(others, key=lambda s: s[1]):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return [s for s in spans if not ((i := bisect_left(starts, s[2]) - 1) >= 0 and ends[i] > s[1])]


def replace_spans(text: str | None, spans: list[tuple[str, int, int]], mark: str) -> str | None:
    """The text with its spans (sorted by start; overlapping ones as one) replaced by ``mark``."""
    if not spans:
        return text
    parts, at, end = [], 0, -1
    for _, a, b in spans:
        if a >= end:
            parts += [text[at:a], mark]
        end = at = max(end, b)
    return "".join(parts) + text[at:]


def join_counted(left: DataFrame, right: DataFrame, key: str, count: str, share: int = 2000) -> DataFrame:
    """Inner join of ``left`` with ``right`` (one row per key; ``count``: rows of ``left`` with it).

    Keys that hold more than a ``share``-th of the counted rows are at most ``share``: their rows of ``right``
    are broadcast, the others' joined by a shuffle, so no key makes a large task.
    """
    total = right.agg(F.sum(count)).collect()[0][0] or 0
    hot = F.col(count) > total / share
    few = F.broadcast(right.filter(hot))
    return left.join(few, key).unionByName(left.join(F.broadcast(right.filter(hot).select(key)), key, "left_anti").join(right.filter(~hot), key))
