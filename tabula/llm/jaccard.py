"""Exact n-gram Jaccard join: T-occurrence search with DivideSkip.

A document's set holds the 64-bit hashes (XXH64) of its distinct word shingles.  Equal sets are one class from the start.
Of two linked sets the larger, of n shingles, shares at least T = ceil(0.8 n) of them, the smaller more
than that of its own.  Three steps use it:

1. Sieve.  Any two linked sets share their smallest common hashes among the first n - T + m hashes of either,
   m of them (m: a twentieth of n, one at least).  Only these hashes, a quarter of all, are shuffled; classes with too few hashes that another
   class has too are linked with nothing.
2. Families.  The remaining classes' shingles are ordered by how many classes hold them, rarest first; linked
   sets share one of their first n - T + 1.  Classes that share such a shingle, directly or through others, are a family;
   links never leave a family.
3. Search.  Families travel to tasks, small ones several to a task, large ones in pairs of
   blocks.  A task builds inverted lists.  A query sets its T - 1 longest lists aside, heap-merges the others,
   binary-probes the long ones for what the merge found, and drops a candidate once too few lists
   are left.  What reaches T is decided by 100 * intersection >= 80 * union.

A task returns a component and a number of links per class, never pairs; components are joined afterwards.

Exactness: two different shingles have one hash with probability 2**-64 a pair, two different sets one
128-bit key.  Defined results: null texts and texts without words are empty sets, each linked with nothing (not with each
other); component_id is the smallest non-null doc_id reachable, null if there is none; repeated rows are documents each;
texts of any length are taken whole; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tabula.llm.common import free_name, join_counted, maybe_broadcast, written
from tabula.llm.simhash import components

SHINGLE = 5
PERCENT = 80
SIEVE = 20                       # a set of n must share an n / SIEVE-th of its shingles in the sieve
BLOCK = 400_000                  # shingles of a task's index
MERGE = 20_000                   # postings up to which lists are merged by a heap


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text (fewer words: all of them as one; none: empty)."""
    words = (text or "").encode("utf-8", "replace").lower().split()       # ASCII case and blanks only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = max(len(words) - width + 1, 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(starts[:n], ends[min(width, len(words)) - 1:])), np.uint64, n))


def least_overlap(n, percent: int = PERCENT):
    """ceil(percent % of n)."""
    return -(-n * percent // 100)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([a.size for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.uint64), *arrays]).view(np.int64)))


def _sets(width: int, percent: int, sieve: int | None):
    """Rows (doc_id, th, text) -> the same with a set's size and key, and its shingles: all, or those the sieve reads."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(t, width) for t in part.column(2).to_pylist()]
                keys = np.array([[d >> 64, d & (1 << 64) - 1] for d in (xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets)], np.uint64).view(np.int64)
                n = np.array([s.size for s in sets], np.int64)
                if sieve:
                    sets = [s[:s.size - least_overlap(s.size, percent) + max(1, s.size // sieve)] for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n), pa.array(keys[:, 0]), pa.array(keys[:, 1]), _lists(sets)],
                                                 names=["doc_id", "th", "n", "k1", "k2", "shingles"])
    return run


def _with_sets(docs: DataFrame, width: int, percent: int, sieve: int | None, name: str) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(
        _sets(width, percent, sieve), f"doc_id {kind}, th long, n long, k1 long, k2 long, shingles array<long>")
    return written(out.withColumn("nr", F.monotonically_increasing_id()), name)


def _one_each(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows of a written table with a row number ``nr``: of equal keys that of the smallest number."""
    first = written(df.groupBy(*key).agg(F.min("nr").alias("nr")).select("nr"), "first")
    gone = written(df.select("nr").join(first, "nr", "left_anti"), "copies")
    return df.join(maybe_broadcast(gone, gone.count(), 40), "nr", "left_anti")


def _least_overlap(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / F.lit(100)).cast("long")


def candidates(sets: DataFrame, percent: int = PERCENT, sieve: int = SIEVE) -> DataFrame:
    """Step 1: (nr, n, doc_id, th) of the classes that may be linked, from one row a class."""
    rows = sets.filter("n > 0").select("nr", F.explode("shingles").alias("t"))
    shared = rows.groupBy("t").agg(F.min("nr").alias("low"), F.max("nr").alias("high"), F.count(F.lit(1)).alias("df"))
    shared = written(shared.filter("low < high").select("t", "df"), "shared")
    met = join_counted(rows, shared, "t", "df").groupBy("nr").agg(F.count(F.lit(1)).alias("met"))
    # a partner may be as small as T, and only as many of its hashes are sure to be read
    enough = F.greatest(F.lit(1), F.floor(_least_overlap(F.col("n"), percent) / sieve))
    return sets.select("nr", "n", "doc_id", "th").join(met, "nr").filter(F.col("met") >= enough).drop("met")


def families(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Step 2: (nr, n, family) of the classes (nr, n, shingles) that have possible partners."""
    rows = members.select("nr", F.explode("shingles").alias("t"))
    held = written(rows.groupBy("t").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "held")
    own = join_counted(rows, held, "t", "df").groupBy("nr").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("live"))
    # shingles that no other class holds come first in the order and are no use
    first = F.size("live") - _least_overlap(F.col("n"), percent) + 1
    own = own.join(members.select("nr", "n"), "nr").filter(first > 0).select("nr", "n", F.slice("live", F.lit(1), F.greatest(first, F.lit(0)).cast("int")).alias("live"))
    early = written(own.select("nr", "n", F.explode("live.t").alias("t")), "early")
    hub = written(early.groupBy("t").agg(F.min("nr").alias("hub"), F.count(F.lit(1)).alias("df")).filter("df > 1"), "hubs")
    near = join_counted(early, hub, "t", "df").select("nr", "n", "hub").distinct()
    near = written(near, "near")
    roots = components(near.filter("nr > hub").select(F.col("nr").alias("a"), F.col("hub").alias("b")))
    known = near.select("nr", "n").distinct()
    return known.join(roots, F.col("nr") == F.col("node"), "left").select("nr", "n", F.coalesce("root", "nr").alias("family"))


class Index:
    """Inverted lists over sets in order of size, and the T-occurrence search on them."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        """``sets``: ascending by size; a set's place is its rank."""
        self.sets, self.percent = sets, percent
        self.size = np.array([s.size for s in sets], np.int64)
        tokens, rank = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.size)
        order = np.lexsort((rank, tokens))
        ordered = tokens[order]
        self.postings = rank[order]
        # where each set's shingles stand in the postings, and where their lists begin
        begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if ordered.size else np.empty(0, np.int64)
        place = np.empty(tokens.size, np.int64)
        place[order] = np.arange(tokens.size)
        self.place = np.split(place, np.cumsum(self.size)[:-1])
        self.begin = [begin[np.searchsorted(begin, p, side="right") - 1] for p in self.place]

    def search(self, x: int) -> np.ndarray:
        """Ranks before ``x`` (no larger sets) that are linked with it."""
        least = int(least_overlap(self.size[x], self.percent))
        lists = [(a, b) for a, b in zip(self.begin[x].tolist(), self.place[x].tolist()) if a < b]
        if len(lists) < least:
            return np.empty(0, np.int64)
        # too small a set can't be linked: ranks go by size
        low = int(np.searchsorted(self.size, least))
        lists = [self.postings[a:b] for a, b in lists]
        if low:
            lists = [s for s in (s[np.searchsorted(s, low):] for s in lists) if s.size]
            if len(lists) < least:
                return np.empty(0, np.int64)
        lists.sort(key=len)
        short, long = lists[:len(lists) - least + 1], lists[len(lists) - least + 1:]
        found, count = merge(short)
        for i, probed in enumerate(long):
            keep = count + len(long) - i >= least
            found, count = found[keep], count[keep]
            if not found.size:
                return found
            at = np.searchsorted(probed, found)
            count = count + (probed[np.minimum(at, probed.size - 1)] == found)
        return found[100 * count >= self.percent * (self.size[x] + self.size[found] - count)]


def merge(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Values of sorted lists with the number of lists that hold each: by a heap, or beyond ``MERGE`` values by
    the library's merge of sorted runs."""
    if sum(map(len, lists)) <= MERGE:
        got = [(v, sum(1 for _ in same)) for v, same in groupby(heapq.merge(*(s.tolist() for s in lists)))]
        return np.array([v for v, _ in got], np.int64), np.array([c for _, c in got], np.int64)
    return np.unique(np.sort(np.concatenate(lists), kind="stable"), return_counts=True)


def _search(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Links between the sets of a task: within it, or only between its two sides."""
        order = np.lexsort((table["nr"].to_numpy(), table["n"].to_numpy()))
        nr, n, copies, side = (table[c].to_numpy()[order] for c in ("nr", "n", "copies", "side"))
        flat = table["shingles"].combine_chunks()
        values, starts = flat.values.to_numpy().view(np.uint64), flat.offsets.to_numpy()
        index = Index([values[starts[i]:starts[i + 1]] for i in order.tolist()], percent)
        root, links = np.arange(nr.size), np.zeros(nr.size, np.int64)
        two = table["family"][0].as_py() >= 0 and table["i"][0].as_py() != table["j"][0].as_py()      # one block against another

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x
        for x in range(nr.size):
            found = index.search(x)
            if two:
                found = found[side[found] != side[x]]
            links[x] += copies[found].sum()
            links[found] += copies[x]
            for y in found.tolist():
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
        linked = np.flatnonzero(links)
        return pa.table({"nr": nr[linked], "head": nr[[find(x) for x in linked.tolist()]] if linked.size else np.empty(0, np.int64), "links": links[linked]})
    return run


def class_links(members: DataFrame, family: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """Step 3: (nr, head, links) of linked classes, a row per task that found links: a class of the same component, and
    the number of documents linked there.  ``members``: nr, copies, shingles."""
    sizes = written(family.groupBy("family").agg(F.sum("n").alias("size")), "sizes")
    total = sizes.filter(F.col("size") <= block).agg(F.sum("size")).collect()[0][0] or 0
    bins = -(-total // block) or 1
    parts = F.when(F.col("size") > block, F.ceil(2 * F.col("size") / block)).otherwise(0).cast("int")
    dealt = join_counted(family.withColumnRenamed("family", "f"), sizes.withColumn("f", F.col("family")), "f", "size")
    dealt = dealt.select("nr", "n", "family", parts.alias("parts")).withColumn("mine", F.pmod(F.xxhash64("nr"), F.greatest("parts", F.lit(1))).cast("int"))
    dealt = members.join(dealt, "nr")
    # (task, side): a small family's bin (family -1), or one row for every pair of blocks that holds the class's own
    small = F.struct(F.lit(-1).cast("long").alias("family"), F.pmod(F.xxhash64("family"), F.lit(bins)).cast("int").alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"))

    def pair(other: Column) -> Column:
        return F.struct(F.col("family").alias("family"), F.least("mine", other).alias("i"), F.greatest(F.col("mine"), other).alias("j"),
                        (F.col("mine") > other).cast("int").alias("side"))
    task = F.when(F.col("parts") == 0, F.array(small)).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.col("parts") - 1, F.lit(0))), pair))
    dealt = dealt.select("nr", "n", "copies", "shingles", F.explode(task).alias("task"))
    dealt = dealt.select("nr", "n", "copies", "shingles", "task.family", "task.i", "task.j", "task.side")
    return dealt.groupBy("family", "i", "j").applyInArrow(_search(percent), "nr long, head long, links long")


def linked_documents(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links (documents linked with it, copies included)."""
    sets = _with_sets(docs, width, percent, SIEVE, "sieve")
    key = ["k1", "k2"]
    classes = sets.filter("n > 0").groupBy(*key).agg(F.min("nr").alias("nr"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"))
    classes = written(classes, "classes")
    maybe = written(candidates(_one_each(sets.filter("n > 0"), key), percent), "maybe")
    # their whole sets, from the texts again
    spare = free_name(docs.columns, "doc")
    wanted = maybe_broadcast(maybe.select(F.col("doc_id").alias(spare), F.col("th").alias(spare + "_th")).distinct(), maybe.count(), 48)
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col(spare)) & (F.xxhash64("text") == F.col(spare + "_th")), "left_semi")
    members = _one_each(_with_sets(texts, width, percent, None, "members"), key)
    members = members.select("k1", "k2", "n", "shingles").join(classes, key).select("nr", "n", "copies", "shingles")
    members = written(members, "classes-sets")
    family = written(families(members, percent), "families")
    found = written(class_links(members.select("nr", "copies", "shingles"), family, percent, block), "links")
    roots = components(found.filter("nr != head").select(F.greatest("nr", "head").alias("a"), F.least("nr", "head").alias("b")).distinct())
    per = found.groupBy("nr").agg(F.sum("links").alias("links"))
    per = classes.join(per, "nr", "left").join(roots, F.col("nr") == F.col("node"), "left")
    per = written(per.select(*key, "copies", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "nr").alias("root"))
                  .filter("copies > 1 or links > 0"), "linked")
    least = per.groupBy("root").agg(F.min("least").alias("component_id"))
    per = written(per.join(least, "root").withColumn("n_links", F.col("links") + F.col("copies") - 1).withColumn("key", F.struct(*key))
                  .select("key", "copies", "component_id", "n_links"), "component")
    rows = sets.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.struct(*key)).alias("key"))
    some = join_counted(rows, per, "key", "copies").drop("copies", "key")
    alone = rows.join(maybe_broadcast(per.select("key"), per.count(), 64), "key", "left_anti").select("doc_id", "n_shingles")
    return some.unionByName(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")))


def op11(docs: DataFrame) -> DataFrame:
    return linked_documents(docs).select("doc_id", "n_shingles", "component_id", "n_links")


#: DuckDB SQL for op11: all pairs that share a shingle, then reachability.
OP11_SQL = r"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM d),
e AS (SELECT rid, unnest(g) AS t, len(g) AS n FROM s),
c AS (SELECT a.rid AS x, b.rid AS y, a.n, b.n AS m, count(*) AS o FROM e a JOIN e b ON a.t = b.t AND a.rid <> b.rid GROUP BY ALL),
k AS (SELECT x, y FROM c WHERE 100 * o >= 80 * (n + m - o)),
r AS (SELECT rid, rid AS other FROM s UNION SELECT r.rid, k.y FROM r JOIN k ON k.x = r.other),
comp AS (SELECT r.rid, min(s.doc_id) AS component_id FROM r JOIN s ON s.rid = r.other GROUP BY r.rid)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, CAST((SELECT count(*) FROM k WHERE k.x = s.rid) AS BIGINT) AS n_links
FROM s JOIN comp USING (rid)
"""
