"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is mapped to the bit counts of its 16 segments of 4 bits.  The
Manhattan distance of two embeddings never exceeds the Hamming distance of the
fingerprints.  The range join "Manhattan distance <= 2" runs on the integer
grid: every distinct fingerprint is entered in its own cell and in the 32 cells
one step away; two points within distance 2 share such a cell.  Each shared
cell is then verified exactly on the fingerprints.

Copies collapse to one fingerprint before any join.  A cell of two is verified
directly, cells up to ``pair_cell`` members pair by pair; in fuller cells the
members are verified through the fingerprints one bit away: two members are
within two bits exactly if they share one of these, so members meet in stars
and no cell is ever expanded into all its pairs.

Components are found by alternating large-star and small-star rounds on tables
checkpointed in the shared folder.

Defined results: null and empty texts have fingerprint zero, linked like any
other; component_id is the smallest non-null doc_id reachable, null only if all
are null; repeated rows share a component; empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tabula.llm.common import free_name, maybe_broadcast, written
from tabula.session import checkpoint_dir

SHINGLE = 3
SEED = 42
DISTANCE = 2
SEGMENT_BITS = 4
PAIR_CELL = 32


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash (unsigned) of the word shingles of a text, repeats included."""
    words = (text or "").encode("utf-8", "replace").lower().split()   # ASCII only, as the contract asks
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())), ">u8", len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, h.size, 65536):
        bits = np.unpackbits(h[at:at + 65536].view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > h.size).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> tuple[DataFrame, str]:
    """``docs`` and a signed 64-bit fingerprint column; returns its name too."""
    name = free_name(docs.columns, "fp")

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64).view(np.int64))

    return docs.withColumn(name, simhash(F.col(text_col))), name


def _cells(fp: Column) -> Column:
    """Grid cells of a fingerprint: its embedding packed 4 bits a segment, and all one step away."""
    n = 64 // SEGMENT_BITS
    counts = [F.bit_count(F.shiftrightunsigned(fp, SEGMENT_BITS * i).bitwiseAND(F.lit(15))).cast("long") for i in range(n)]
    quads = reduce(Column.bitwiseOR, [F.shiftleft(c, SEGMENT_BITS * i) for i, c in enumerate(counts)])
    around = [quads]
    for i, count in enumerate(counts):
        around += [F.when(count < SEGMENT_BITS, quads.bitwiseXOR(_xor_step(count, i, 1))),
                   F.when(count > 0, quads.bitwiseXOR(_xor_step(count, i, -1)))]
    return F.filter(F.array(*around), lambda c: c.isNotNull())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _xor_step(count: Column, i: int, by: int) -> Column:
    """What to XOR to the packed counts so that segment i goes from ``count`` to ``count + by``."""
    return F.shiftleft(count.bitwiseXOR(count + by), SEGMENT_BITS * i)


def candidate_links(fps: DataFrame, pair_cell: int = PAIR_CELL) -> DataFrame:
    """Links (a > b) between distinct fingerprints (column fp) whose components are those of
    "two or fewer differing bits"."""
    # a fingerprint becomes 33 rows: deal the few input files out to all tasks first
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entered = fps.repartition(tasks, "fp").select("fp", _cells(F.col("fp")).alias("cells"))
    entered = entered.select("fp", F.explode("cells").alias("cell"))
    busy = entered.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("b"), F.max("fp").alias("a")).filter("n > 1")
    busy = written(busy, "cells")
    two = busy.filter("n = 2").select("a", "b")
    fuller = busy.filter("n > 2").select("cell", "n")
    more = written(entered.join(maybe_broadcast(fuller, fuller.count(), 40), "cell"), "members")
    small = more.filter(F.col("n") <= pair_cell).groupBy("cell").agg(F.array_sort(F.collect_list("fp")).alias("m"))
    small = small.select("m", F.posexplode("m").alias("i", "b")).select(
        "b", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("a"))
    close = two.unionByName(small.select("a", "b")).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)
    # full cells: members meet at the fingerprints one bit away (or at themselves)
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    full = more.filter(F.col("n") > pair_cell).select("fp").distinct().select("fp", F.explode(flips).alias("hub"))
    hub = full.groupBy("hub").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("hub", "b")
    star = full.join(written(hub, "hubs"), "hub").filter(F.col("fp") > F.col("b")).select(F.col("fp").alias("a"), "b")
    return close.unionByName(star).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): smallest node of each node's component, for the nodes of ``links`` (a > b).

    Alternates large-star and small-star until nothing changes; raises if
    ``rounds`` do not suffice rather than return unfinished components.
    """
    checkpoint_dir(links.sparkSession)
    edges, before = links.checkpoint(), None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).checkpoint()
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct().checkpoint()
        least = large.groupBy("a").agg(F.min("b").alias("m")).checkpoint()
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = small.unionByName(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct().checkpoint()
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0]
        if before is not None and tuple(now) == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(now)
    raise RuntimeError(f"components: not finished after {rounds} rounds")


def near_duplicates(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame, str]:
    """The written table of ``docs`` with a fingerprint column, a table (fp, root) of every
    distinct fingerprint's component, and the name of the fingerprint column."""
    marked, name = with_fingerprint(docs, text_col, shingle)
    marked = written(marked, "fingerprints")
    fps = written(marked.select(F.col(name).alias("fp")).distinct(), "distinct")
    roots = components(candidate_links(fps))
    of = fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return marked, written(of, "roots"), name


def op5(docs: DataFrame) -> DataFrame:
    marked, of, name = near_duplicates(docs.select("doc_id", "text"))
    # per fingerprint first (copies collapse), then per component
    least = written(marked.groupBy(F.col(name).alias("fp")).agg(F.min("doc_id").alias("least")).join(of, "fp"), "least")
    root = written(least.groupBy("root").agg(F.min("least").alias("component_id")), "component")
    ids = written(least.select("fp", "root").join(root, "root").select(F.col("fp").alias("fp_of"), "component_id"), "ids")
    out = marked.join(ids, F.col(name) == F.col("fp_of"))
    return out.select("doc_id", F.lpad(F.lower(F.hex(F.col(name))), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component: that of the smallest doc_id (null last; of repeated
    rows one).  Columns stay."""
    row = free_name(docs.columns, "row_nr")
    # the number becomes a value of the written table, so later reads agree on it
    marked, of, name = near_duplicates(docs.withColumn(row, F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), F.col("doc_id").alias("id"), F.col(row).alias("nr"))).alias("first")
    least = written(marked.groupBy(F.col(name).alias("fp")).agg(first).join(of, "fp"), "least")
    kept = written(least.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.nr").alias("nr")), "kept")
    # the dropped rows are fewer than the kept ones: texts are not shuffled while their numbers can be broadcast
    gone = marked.select(F.col(row).alias("nr")).join(kept, "nr", "left_anti")
    gone = written(gone.withColumnRenamed("nr", free_name(marked.columns, "gone_nr")), "gone")
    return marked.join(maybe_broadcast(gone, gone.count(), 40), F.col(row) == gone[gone.columns[0]], "left_anti").select(*docs.columns)
