"""Merkle manifest of a table: a tree of SHA-256 digests over its rows, eight children to a node.

Leaves are ranked inside their group by a range-partitioned sort: the rank is a row's place in
its partition plus the rows that earlier partitions hold of its group, so no group passes
through one task.  Aligned blocks of 512 nodes then keep every level as one hex string of
64 characters a node.  Fixed-width substrings of 512 characters hash to the next level; a
node's siblings are the two substrings beside it.  A block's root is a node of the next tier,
which is built alike, until a group has one node.  The groups' roots, in order, make the tree on top.

Proofs come back down: a block receives the sibling segments above it once, and each of its
nodes adds its own.  Only digests are shuffled, never texts.

Defined results: nulls in any column are hashed as ``-``; null ids come first; equal ids are
ordered by leaf and equal rows are leaves each; a null group comes first; a single leaf is
its group's root, a single group's root the root of all, and the digest of no siblings is
that of an empty string.  Texts are hashed whole, however long.  Empty tables give empty results;
extra columns are not part of the leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabula.llm.common import maybe_broadcast, written

ARITY = 8
HEX = 64
RUN = ARITY * HEX
LEVELS = 3                       # levels a block climbs
BLOCK = ARITY ** LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(*columns: Column) -> Column:
    """Digest of a row: each value as byte count, colon, value; null as ``-``."""
    def field(c: Column) -> Column:
        c = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
    return F.sha2(F.concat(*map(field, columns)), 256)


def ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """Written ``df`` with ``idx`` (rank from 0 in its ``grp`` by ``order``) and ``total`` (rows of the group)."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # equal rows are told apart by their place, so that many of them don't share one partition
    keys = ["grp", *order, "place"]
    df = df.withColumn("place", F.monotonically_increasing_id())
    df = df.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).drop("place")
    df = written(df.withColumn("at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("at", 33)
    parts = df.groupBy("grp", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("grp")
    before = F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = written(parts.select(F.col("grp").alias("grp_"), F.col("part").alias("part_"), "first",
                                 F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(group).alias("total")), "ranks")
    parts = maybe_broadcast(parts, parts.count(), 200)
    out = df.join(parts, (F.col("grp") == F.col("grp_")) & (part == F.col("part_")))
    return out.withColumn("idx", F.col("at") - F.col("first") + F.col("before")).drop("at", "grp_", "part_", "first", "before")


def _parents(level: Column) -> Column:
    """The next level's hex string: each run of eight nodes hashed."""
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / RUN).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * RUN + 1, F.lit(RUN)), 256)), "")


def _flanks(level: Column, i: Column) -> Column:
    """What stands before and after node ``i`` in its run."""
    nth = i % ARITY
    return F.struct(F.substring(level, (i - nth) * HEX + 1, nth * HEX).alias("before"),
                    F.substring(level, (i + 1) * HEX + 1, (ARITY - 1 - nth) * HEX).alias("after"))


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Tiers of blocks over ``nodes`` (grp, total, idx, node, item), lowest first.

    A block has its nodes' levels as hex strings l0, l1, l2, the levels it climbs (up), its root
    and its nodes' items in order.
    """
    tiers = []
    while True:
        blocks = nodes.groupBy("grp", "total", F.expr(f"idx div {BLOCK}").alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("idx", "node", "item"))).alias("members"))
        blocks = blocks.withColumn("l0", F.array_join(F.col("members.node"), ""))
        for k in range(1, LEVELS + 1):
            blocks = blocks.withColumn(f"l{k}", _parents(F.col(f"l{k - 1}")))
        # a whole group in one block stops where one node is left
        up = F.lit(LEVELS)
        for k in reversed(range(LEVELS)):
            up = F.when(F.col("total") <= ARITY ** k, F.lit(k)).otherwise(up)
        blocks = blocks.withColumn("up", up)
        root = F.element_at(F.array(*(F.col(f"l{k}") for k in range(LEVELS + 1))), F.col("up") + 1)
        blocks = written(blocks.select("grp", "total", "block", F.col("members.item").alias("items"),
                                       *(f"l{k}" for k in range(LEVELS)), "up", root.alias("root")), "blocks")
        tiers.append(blocks)
        higher = blocks.filter(F.col("total") > BLOCK)
        if higher.isEmpty():
            return tiers
        nodes = higher.select("grp", F.ceil(F.col("total") / BLOCK).cast("long").alias("total"), F.col("block").alias("idx"),
                              F.col("root").alias("node"), F.lit(0).alias("item"))


def roots(tiers: list[DataFrame]) -> DataFrame:
    """(grp, root) of every group."""
    out = None
    for blocks in tiers:
        done = blocks.filter(F.col("total") <= BLOCK).select("grp", "root")
        out = done if out is None else out.unionByName(done)
    return out


def with_paths(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """One row per lowest node: grp, item, node, path (sibling segments from the node's level up,
    then ``upper`` of its group), and the further columns of ``above`` (grp, upper, ..), one row per group."""
    extra = [c for c in above.columns if c not in ("grp", "upper")]
    above = above.withColumn("block", F.lit(0).cast("long"))
    got = None
    for t in reversed(range(len(tiers))):
        blocks = tiers[t]
        whole = blocks.filter(F.col("total") <= BLOCK).join(above, ["grp", "block"])
        if got is not None:
            whole = whole.unionByName(blocks.filter(F.col("total") > BLOCK).join(got, ["grp", "block"]))
        levels = [F.col(f"l{k}") for k in range(LEVELS)]

        def node(item: Column, i: Column) -> Column:
            own = F.slice(F.array(*(_flanks(s, F.floor(i / ARITY ** k).cast("int")) for k, s in enumerate(levels))), F.lit(1), F.col("up"))
            return F.struct(item.alias("item"), F.substring(levels[0], i * HEX + 1, F.lit(HEX)).alias("node"),
                            (F.col("block") * BLOCK + i).alias("nr"), F.concat(own, F.col("upper")).alias("path"))
        rows = whole.select("grp", *extra, F.explode(F.transform("items", node)).alias("x"))
        if t:
            got = written(rows.select("grp", F.col("x.nr").alias("block"), F.col("x.path").alias("upper"), *extra), "paths")
    return rows.select("grp", *extra, "x.item", "x.node", "x.path")


def proof(path: Column) -> Column:
    """Digest of all siblings of a path."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""), 256)


def fold(path: Column, node: Column) -> Column:
    """The root that a leaf digest and its path lead to."""
    return F.aggregate(path, node, lambda acc, p: F.sha2(F.concat(p["before"], acc, p["after"]), 256))


def manifest(leaves: DataFrame, group: str, order: list[str]) -> DataFrame:
    """One row per leaf: the columns of ``leaves`` (group, order columns, ``leaf`` and others) in the
    struct ``item``, ``subroot`` of its group, ``root`` of all and ``path`` (sibling segments up to the root)."""
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))       # null first, then by bytes
    leaves = written(leaves.withColumn("grp", name), "leaves")
    cols = [c for c in leaves.columns if c != "grp"]
    nodes = ranked(leaves, [*order, "leaf"]).select("grp", "total", "idx", F.col("leaf").alias("node"), F.struct(*cols).alias("item"))
    tiers = climb(nodes)
    subroots = written(roots(tiers), "subroots").select(F.lit("").alias("grp"), F.col("grp").alias("name"), "root")
    top = climb(ranked(subroots, ["name"]).select("grp", "total", "idx", F.col("root").alias("node"), F.struct("name").alias("item")))
    peak = roots(top).select("grp", F.col("root").alias("top"), F.array().cast("array<struct<before:string,after:string>>").alias("upper"))
    groups = with_paths(top, peak)
    groups = written(groups.select(F.col("item.name").alias("grp"), F.col("path").alias("upper"), F.col("node").alias("subroot"), "top"), "groups")
    return with_paths(tiers, groups).select("item", "subroot", F.col("top").alias("root"), "path")


def op12(docs: DataFrame) -> DataFrame:
    cols = [F.col(c) for c in COLUMNS]
    lowered = [*cols[:-1], F.translate("text", UPPER, LOWER)]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select("doc_id", "lang", leaf(*cols).alias("leaf"), F.when(tampered, leaf(*lowered)).alias("changed"))
    out = manifest(leaves, "lang", ["doc_id"])
    folded = fold(F.col("path"), F.coalesce("item.changed", "item.leaf"))
    out = out.select("item.doc_id", "item.leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}) || ':' || {f} END" for f in fields) + ")"


#: DuckDB SQL for op12; crc32 bit by bit: a byte is xored in, eight steps follow (-1).
OP12_SQL = f"""
WITH RECURSIVE
c AS (SELECT *, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) AS r FROM documents),
l AS (SELECT doc_id, lang, {_sql_leaf('text')} AS leaf,
        CASE WHEN xor(r, 4294967295) % 3 = 0 THEN {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_sql_leaf('text')} END AS claimed FROM c),
d AS (SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l),
n AS (SELECT 0 AS lvl, lang, i, leaf AS h, count(*) OVER (PARTITION BY lang) AS c FROM d
      UNION ALL
      SELECT lvl, lang, p, h, count(*) OVER (PARTITION BY lang) FROM (
        SELECT lvl + 1 AS lvl, lang, i // 8 AS p, sha256(string_agg(h, '' ORDER BY i)) AS h FROM n WHERE c > 1 GROUP BY lvl, lang, i // 8)),
s AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j FROM n WHERE c = 1),
m AS (SELECT 0 AS lvl, j, subroot AS h, count(*) OVER () AS c FROM s
      UNION ALL
      SELECT lvl, p, h, count(*) OVER () FROM (
        SELECT lvl + 1 AS lvl, j // 8 AS p, sha256(string_agg(h, '' ORDER BY j)) AS h FROM m WHERE c > 1 GROUP BY lvl, j // 8)),
seg AS (SELECT rid, n.lvl AS step, coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i < d.i // (8 ** n.lvl)::BIGINT), '') AS b,
               coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i > d.i // (8 ** n.lvl)::BIGINT), '') AS a
        FROM d JOIN n ON n.lang IS NOT DISTINCT FROM d.lang AND n.c > 1 AND n.i // 8 = d.i // (8 ** (n.lvl + 1))::BIGINT GROUP BY rid, n.lvl
        UNION ALL
        SELECT rid, 100 + m.lvl, coalesce(string_agg(m.h, '' ORDER BY m.j) FILTER (m.j < s.j // (8 ** m.lvl)::BIGINT), ''),
               coalesce(string_agg(m.h, '' ORDER BY m.j) FILTER (m.j > s.j // (8 ** m.lvl)::BIGINT), '')
        FROM d JOIN s ON s.lang IS NOT DISTINCT FROM d.lang JOIN m ON m.c > 1 AND m.j // 8 = s.j // (8 ** (m.lvl + 1))::BIGINT GROUP BY rid, m.lvl),
path AS (SELECT rid, sha256(string_agg(b || a, '' ORDER BY step)) AS proof, list({{'b': b, 'a': a}} ORDER BY step) AS p FROM seg GROUP BY rid)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM (SELECT doc_id, leaf, subroot, proof, (SELECT h FROM m WHERE c = 1) AS root,
             list_reduce(list_prepend({{'b': claimed, 'a': ''}}, coalesce(p, [])), lambda x, y: {{'b': sha256(y.b || x.b || y.a), 'a': ''}}).b AS folded
      FROM d JOIN s ON s.lang IS NOT DISTINCT FROM d.lang LEFT JOIN path USING (rid))
"""
