"""Train / validation / test membership.

Rows have no position in Spark, so the reference's row-index vectors become
explicit columns.  ``hash_split`` is deterministic per key and seed: the first
32 bits of ``md5("<key>:<seed>")`` compared with ``p * 2^32`` — a pure
row-local expression (no shuffle, no sampling job), reproducible in any
engine and stable under repartitioning or executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.functions.columns import free_name
from tabula.operators.joins import checked_broadcast


def hash_unit(key, seed: int = 42) -> Column:
    """Unsigned 32-bit hash of ``"<key>:<seed>"`` as a long in [0, 2^32)."""
    k = F.col(key) if isinstance(key, str) else key
    hexd = F.substring(F.md5(F.concat_ws(":", k.cast("string"), F.lit(str(seed)))), 1, 8)
    return F.conv(hexd, 16, 10).cast("long")


def hash_split(df: DataFrame, key: str, p: float = 0.85, seed: int = 42, col: str = "split",
               labels: tuple[str, str] = ("train", "val")) -> DataFrame:
    """Tag each row with ``labels[0]`` (share ~p) or ``labels[1]``."""
    return df.withColumn(col, F.when(hash_unit(key, seed) < F.lit(int(p * 2 ** 32)), F.lit(labels[0]))
                         .otherwise(F.lit(labels[1])))


def stratified_split(df: DataFrame, key: str, label: str, p: float = 0.85, seed: int = 42, col: str = "split",
                     labels: tuple[str, str] = ("train", "val")) -> DataFrame:
    """Tag exactly ``ceil(p * n)`` rows of every class (null is one) with ``labels[0]``: those of the smallest hashes.

    The hash at which a class is cut is found by radix rounds over 12, 12 and 8 bits: each counts rows by
    class and bits and keeps, per class, the cell that holds the wanted rank (a window over at most
    4096 cells).  Rows are never sorted or gathered by class; only those with the very hash of the cut are
    ranked, by key, so keys have to be unique (two of them share a 32-bit hash now and then).
    """
    h, c, rest = (free_name(df.columns, x) for x in ("hash", "class", "rest"))
    rows = df.withColumn(h, hash_unit(key, seed))
    narrow = rows.select(F.col(label).alias(c), h)
    cut = narrow.groupBy(c).agg(F.ceil(F.lit(p) * F.count(F.lit(1)) - F.lit(1e-9)).alias(rest)).withColumn("cell", F.lit(0).cast("long"))
    for shift, bits in ((20, 12), (8, 12), (0, 8)):
        cut, _ = checked_broadcast(cut)
        state = cut.select(F.col(c).alias("c_"), F.col(rest), F.col("cell").alias("above"))
        within = narrow.join(state, F.col(c).eqNullSafe(F.col("c_")) & (F.shiftright(h, shift + bits) == F.col("above")))
        cells = within.groupBy(c, rest, F.shiftright(h, shift).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy(c).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        cells = cells.withColumn("before", before).where((F.col("before") < F.col(rest)) & (F.col(rest) <= F.col("before") + F.col("n")))
        cut = cells.select(c, (F.col(rest) - F.col("before")).alias(rest), "cell")
    cut, _ = checked_broadcast(cut)
    state = cut.select(F.col(c).alias("c_"), F.col(rest).alias("rest_"), F.col("cell").alias("cut_"))
    rows = rows.join(state, F.col(label).eqNullSafe(F.col("c_")), "left")
    on = rows.where(F.col(h) == F.col("cut_"))
    rank = F.row_number().over(Window.partitionBy(label, h).orderBy(key))
    on = on.withColumn(col, F.when(rank <= F.col("rest_"), F.lit(labels[0])).otherwise(F.lit(labels[1])))
    off = rows.where(~F.col(h).eqNullSafe(F.col("cut_"))).withColumn(col, F.when(F.col(h) < F.col("cut_"), F.lit(labels[0])).otherwise(F.lit(labels[1])))
    return off.unionByName(on).drop(h, "c_", "rest_", "cut_")


def hash_fold(key: str, k: int, seed: int = 42) -> Column:
    """Fold number 0..k-1 from the same hash (used for out-of-fold features)."""
    return (hash_unit(key, seed) % F.lit(k)).cast("int")


def union_train_test(train: DataFrame, test: DataFrame, flag: str = "is_train") -> DataFrame:
    """``bind_rows(train without target, test)`` keeping the target column (null for test)."""
    return (train.withColumn(flag, F.lit(1))
            .unionByName(test.withColumn(flag, F.lit(0)), allowMissingColumns=True))


def split_back(df: DataFrame, flag: str = "is_train") -> tuple[DataFrame, DataFrame]:
    """Inverse of ``union_train_test``."""
    return df.filter(F.col(flag) == 1), df.filter(F.col(flag) == 0)
