"""Exact median for hot groups without collecting a group into one task.

Spark's ``median`` keeps a value -> count map per group; for a key holding a
third of all rows that map is unbounded.  For such (few, measured) keys the
median is found by iterative narrowing:

1. per hot key: n and the two target ranks k1 = floor((n+1)/2), k2 = floor(n/2)+1;
2. while a key still has more than ``limit`` candidate values: cut its
   candidates into ``buckets`` ranges at approximate quantiles (a bounded
   sketch per key), count candidates per range (combinable aggregation), keep
   the range(s) holding k1..k2 and add the counts below them to the rank
   offset — candidates shrink by ~``buckets`` per round;
3. the remaining (bounded) candidates are ranked with a window per key and
   the median is (v_k1 + v_k2) / 2, which equals Spark's interpolated median.

Only per-key bound tables (one row per hot key) travel to the driver, after
their size is checked; rebuilding them each round also keeps the plan from
growing with the number of rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabula.operators.joins import checked_broadcast
from tabula.session import keep


def exact_median(df: DataFrame, keys: Sequence[str], col: str, out: str, limit: int = 1_000_000,
                 buckets: int = 512, max_rounds: int = 64) -> DataFrame:
    """Per-key exact median of ``col`` (nulls ignored); meant for a small set of hot keys.

    A null key is a key like any other: the keys are compared inside a struct, whose equality
    holds for null fields.  Raises if ``max_rounds`` do not narrow every key to ``limit``
    candidates (a round divides them by about ``buckets``) rather than rank more in one window.
    """
    packed = df.select(F.struct(*keys).alias("__key"), F.col(col).cast("double").alias("__x"))
    med = _median(packed.where(F.col("__x").isNotNull()), limit, buckets, max_rounds, out)
    return med.select(*[F.col("__key").getField(k).alias(k) for k in keys], out)


def _median(x: DataFrame, limit: int, buckets: int, max_rounds: int, out: str) -> DataFrame:
    keys = ["__key"]
    x = keep(x)
    state = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).select(
        *keys, F.floor((F.col("__n") + 1) / 2).cast("long").alias("__k1"),
        (F.floor(F.col("__n") / 2) + 1).cast("long").alias("__k2"),
        F.lit(None).cast("double").alias("__lo"), F.lit(None).cast("double").alias("__hi"),
        F.lit(0).cast("long").alias("__below"), F.col("__n").alias("__cand"), F.lit(False).alias("__single"))
    probs = [i / buckets for i in range(1, buckets)]
    spark = x.sparkSession
    for _ in range(max_rounds):
        # one row per (hot) key: cut its lineage each round by rebuilding it from
        # its rows (size measured first), otherwise the plan compounds per round
        state, small = checked_broadcast(state)
        if small:
            state = F.broadcast(spark.createDataFrame(state.collect(), state.schema))
        # stop when every key's candidate range is small or holds a single value
        if not state.where((F.col("__cand") > limit) & ~F.col("__single")).take(1):
            break
        cand = x.join(state, keys).where((F.col("__lo").isNull() | (F.col("__x") > F.col("__lo"))) &
                                         (F.col("__hi").isNull() | (F.col("__x") <= F.col("__hi"))))
        bounds = cand.groupBy(*keys).agg(F.percentile_approx("__x", probs, 10 * buckets).alias("__b"))
        tagged = cand.join(checked_broadcast(bounds)[0], keys).withColumn(
            "__bk", F.size(F.filter("__b", lambda v: v < F.col("__x"))))
        per = tagged.groupBy(*keys, "__bk").agg(F.count(F.lit(1)).alias("__c"), F.min("__x").alias("__mn"),
                                                F.max("__x").alias("__mx"))
        w = Window.partitionBy(*keys).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
        per = per.withColumn("__cum", F.coalesce(F.sum("__c").over(w), F.lit(0)))
        per = per.join(state.select(*keys, "__k1", "__k2", "__below"), keys)
        start = F.col("__below") + F.col("__cum")
        # buckets overlapping the target rank interval [k1, k2]
        hit = per.where((start + F.col("__c") >= F.col("__k1")) & (start < F.col("__k2")))
        nxt = hit.groupBy(*keys).agg(F.min("__bk").alias("__b0"), F.min(start).alias("__nb"),
                                     F.min("__mn").alias("__mn"), F.max("__mx").alias("__mx"),
                                     F.sum("__c").alias("__cand"))
        prev_hi = per.join(nxt.select(*keys, "__b0"), keys).where(F.col("__bk") < F.col("__b0")) \
            .groupBy(*keys).agg(F.max("__mx").alias("__lo"))
        # no bucket below the hit ones: the previous lower bound still applies
        state = (state.select(*keys, "__k1", "__k2", F.col("__lo").alias("__lo_prev")).join(nxt, keys)
                 .join(prev_hi, keys, "left")
                 .select(*keys, "__k1", "__k2", F.coalesce("__lo", "__lo_prev").alias("__lo"),
                         F.col("__mx").alias("__hi"),
                         F.col("__nb").alias("__below"), "__cand", (F.col("__mn") == F.col("__mx")).alias("__single")))
    else:
        raise RuntimeError(f"median: more than {limit} candidates left after {max_rounds} rounds")
    cand = x.join(state, keys).where((F.col("__lo").isNull() | (F.col("__x") > F.col("__lo"))) &
                                     (F.col("__hi").isNull() | (F.col("__x") <= F.col("__hi"))))
    # rank DISTINCT candidate values by cumulative count (duplicates collapse map-side)
    vals = cand.groupBy(*keys, "__x", "__below", "__k1", "__k2").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(*keys).orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)
    vals = vals.withColumn("__end", F.col("__below") + F.sum("__c").over(w))
    vals = vals.withColumn("__start", F.col("__end") - F.col("__c") + 1)
    v1 = F.when((F.col("__start") <= F.col("__k1")) & (F.col("__k1") <= F.col("__end")), F.col("__x"))
    v2 = F.when((F.col("__start") <= F.col("__k2")) & (F.col("__k2") <= F.col("__end")), F.col("__x"))
    return vals.groupBy(*keys).agg(((F.max(v1) + F.max(v2)) / 2).alias(out))
