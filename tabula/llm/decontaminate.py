"""Benchmark decontamination with a broadcast hash set, DataFrame operations only.

Benchmark texts become windows of ``width`` words (a shorter text is one
window).  Every word position of a document is hashed together with the next
words (up to three) and looked up in the broadcast windows; a candidate counts
only if the document's words at that place equal the window's (verified hit).

The window table is measured before it is broadcast.  Beyond
``block_bytes`` it is split by hash into blocks that are scanned for one after
the other, so no broadcast grows past that size.

Rows are told apart by (id, hash of text), so repeated rows each get the same
result.  Null and empty texts have no words.  Null item ids mark hits but are
not counted as items.  Empty tables give empty results.  Extra columns of documents,
whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabula.llm.common import free_name, maybe_broadcast, written

#: What separates words, in a Java regular expression class.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
RAW_SEPARATORS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"      # before lower-casing
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WIDTH = 13
ANCHOR = 3


def words_of(text: Column) -> Column:
    """Normalised words of a text, as an array (empty for null)."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), f"[{SEPARATORS}]+")
    return F.filter(parts, lambda w: w != F.lit(""))


def windows_of(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct windows: anchor length, anchor hash, length, words, items that hold it."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w"))
    w = w.filter(F.size("w") > 0).select(
        "item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))).alias("at"))
    w = w.select("item", F.slice("w", F.col("at"), F.lit(width)).alias("window"))
    w = w.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))
    w = w.withColumn("len", F.size("window")).withColumn("anchor", F.least(F.col("len"), F.lit(ANCHOR)))
    return w.withColumn("key", _anchor(F.col("window"), F.lit(0), F.col("anchor")))


def _anchor(words: Column, at: Column, size: Column) -> Column:
    """Hash of ``size`` (1 to 3) words from position ``at`` (from 0)."""
    word = [F.get(words, at + i) for i in range(ANCHOR)]
    return F.xxhash64(size, word[0], F.when(size >= 2, word[1]), F.when(size >= 3, word[2]))


def _hits(docs: DataFrame, windows: DataFrame, anchors: list[int], marked: bool) -> DataFrame:
    """(doc_id, th, n_words, pos, len, items) of verified hits; with ``marked`` also one
    row of null position for each document."""
    d = docs.select("doc_id", F.xxhash64("text").alias("th"), words_of(F.col("text")).alias("w"))
    d = d.withColumn("n_words", F.size("w"))
    d = d.select("doc_id", "th", "n_words", "w", F.posexplode(F.concat(F.col("w"), F.array(F.lit("")))).alias("pos", "_word"))
    last = F.col("pos") == F.col("n_words")
    size = F.lit(anchors[0])
    if len(anchors) > 1:
        d = d.withColumn("size", F.explode(F.when(F.col("pos") == F.col("n_words"), F.array(F.lit(anchors[0])))
                                           .otherwise(F.array(*[F.lit(a) for a in anchors]))))
        size = F.col("size")
    d = d.withColumn("dkey", F.when(last, F.lit(None).cast("long")).otherwise(_anchor(F.col("w"), F.col("pos"), size)))
    cond = (F.col("dkey") == F.col("key")) & (F.slice(F.col("w"), F.col("pos") + 1, F.col("len")) == F.col("window"))
    found = d.join(F.broadcast(windows.select("key", "len", "window", "items")), cond, "left")
    found = found.filter(F.col("key").isNotNull() | (last if marked else F.lit(False)))
    return found.select("doc_id", "th", "n_words", F.when(~last, F.col("pos")).alias("pos"), "len", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: int = 20,
                  block_bytes: int = 16 << 20) -> DataFrame:
    """One row per document: doc_id, th (hash of the text), n_words, n_hit, spans of hit
    words, item list, contaminated (hit words are at least a ``share``-th of all)."""
    windows = written(windows_of(benchmark, width), "windows")
    size = windows.agg(F.sum(F.length(F.concat_ws(" ", "window", "items")) + 16 * F.col("len") + 64).alias("b"),
                       F.collect_set("anchor").alias("a")).collect()[0]
    anchors = sorted(size["a"]) or [ANCHOR]
    n_blocks = -(-(size["b"] or 0) // block_bytes) or 1
    hits = None
    for block in range(n_blocks):
        part = windows if n_blocks == 1 else windows.filter(F.pmod("key", F.lit(n_blocks)) == block)
        rows = _hits(docs, part, anchors, marked=block == 0)
        hits = rows if hits is None else hits.unionByName(rows)
    per = hits.groupBy("doc_id", "th").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count(F.when(F.col("pos").isNull(), F.lit(1))).alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("pos").isNotNull(), F.struct("pos", (F.col("pos") + F.col("len")).alias("end"))))).alias("found"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    # hits in order of position: join those that touch, count each word once
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("found", start, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["end"], x["pos"]))).cast("long").alias("n"),
        F.greatest(a["end"], x["end"]).alias("end")), lambda a: a["n"])
    per = per.withColumn("n_hit", covered)
    per = per.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
    return per.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("_copy", "copies")


def op3(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    per = contamination(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    return per.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def remove_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents; columns stay."""
    bad = contamination(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    bad_id, bad_th = free_name(docs.columns, "bad_id"), free_name(docs.columns, "bad_th")
    bad = bad.filter("contaminated").select(F.col("doc_id").alias(bad_id), F.col("th").alias(bad_th)).distinct()
    bad = written(bad, "contaminated")
    bad = maybe_broadcast(bad, bad.count(), 48)        # beyond the bound, a shuffled join
    on = docs["doc_id"].eqNullSafe(F.col(bad_id)) & (F.xxhash64(docs["text"]) == F.col(bad_th))
    return docs.join(bad, on, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with every hit word (and the separators after it) cut from the text."""
    per = contamination(docs.select("doc_id", "text"), benchmark.select("item_id", "text")).filter("n_hit > 0")
    hit_id, hit_th, found = (free_name(docs.columns, c) for c in ("hit_id", "hit_th", "found"))
    per = per.select(F.col("doc_id").alias(hit_id), F.col("th").alias(hit_th), F.col("found").alias(found)).dropDuplicates([hit_id, hit_th])
    on = docs["doc_id"].eqNullSafe(F.col(hit_id)) & (F.xxhash64(docs["text"]) == F.col(hit_th))
    word, sep = f"[^{RAW_SEPARATORS}]+", f"[{RAW_SEPARATORS}]*"
    chunks = F.regexp_extract_all(F.col("text"), F.lit(f"({word}{sep})"), 1)
    kept = F.filter(chunks, lambda c, i: ~F.exists(found, lambda x: (x["pos"] <= i) & (i < x["end"])))
    cut = F.concat(F.regexp_extract(F.col("text"), f"^({sep})", 1), F.array_join(kept, ""))
    out = docs.join(per, on, "left")
    return out.withColumn("text", F.when(F.col(found).isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)


#: DuckDB SQL for op3 (RE2 classes are the same).
OP3_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bp AS (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, list_slice(w, i, i + 12) AS win, len(list_slice(w, i, i + 12)) AS n, w[i] AS w1 FROM bp),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM d),
dc AS (SELECT rid, i, n, list_slice(w, i, i + n - 1) AS win FROM dw JOIN (SELECT DISTINCT w1, n FROM win) f ON dw.w[dw.i] = f.w1 WHERE i + n - 1 <= len(w)),
hit AS (SELECT rid, i, dc.n, item FROM dc JOIN win ON dc.win = win.win),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hit WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""
