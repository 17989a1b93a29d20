"""Operator 11: a Merkle manifest of a table, by a rollup of nested structs.

A row is a leaf; the leaves of a group (lang), in order, make a tree in which
every `arity` consecutive nodes become their hash; the groups' subroots, in
order, make one more tree, whose root stands for the table.

1. Leaves are hashed in one pass over the rows.  What goes on is a hash or two
   per row, never a text.
2. Ranks: leaves are dealt by ranges of (group, order, hash), and a rank is the
   place in a range plus the sizes of the group's ranges before it.
3. Blocks of arity^levels consecutive ranks meet in one partition, and their
   rank digits are grouped away one by one: each step nests the child structs
   in their parent's and hashes them.  A block ends as one bounded row.  Blocks
   are the leaves of the next rollup, so each has a bounded number of children,
   until every group is one block.
4. A block row carries its path above; transforms push it down through the
   nested structs, adding each run's other hashes, and an explode emits a row
   per leaf.  No join is made by leaf: only block rows are joined, with the
   paths of the rollup above (one row a block).

Defined cases: a NULL group is a group of its own and comes first, a NULL order
value comes first in its group; ties are ordered by leaf hash, and equal leaves
get a proof each.  A run of one node is hashed like any other; a group of one
leaf has that leaf as its subroot.  An empty table has no rows.  Columns not
named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import materialize, partitions

#: Rows meant for one range of the ranking.
RANGE = 1 << 19
_PATH = "array<struct<before: string, after: string>>"


def leaf_hash(columns: list[Column]) -> Column:
    """Lowercase hex sha256 of the columns, each `-` if NULL, else its UTF-8 byte count, `:` and value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


def _joined(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds _rank (from 0, in the row's group _g by `order`) and _n (rows of the group) to a written table."""
    order = ["_g", *order, "_row"]
    ranges = max(partitions(rows.sparkSession), -(-rows.count() // RANGE))
    dealt = materialize(rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_range", "_g").agg(F.count("*").alias("_size"))
    group = Window.partitionBy("_g")
    before = F.coalesce(F.sum("_size").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_range", "_g", before.alias("_before"), F.sum("_size").over(group).alias("_n"))
    place = F.row_number().over(Window.partitionBy("_range", "_g").orderBy(*order))
    return dealt.withColumn("_place", place).join(sizes, ["_range", "_g"]).withColumn("_rank", F.col("_before") + F.col("_place") - 1).drop("_range", "_row", "_place", "_before")


@dataclass
class Rollup:
    arity: int = 2
    levels: int = 7

    def _many(self, level: int) -> Column:
        """Whether the group still has several nodes below this level (level 1 stands on the leaves)."""
        return F.col("_n") > self.arity ** (level - 1)

    def blocks(self, leaves: DataFrame, payload: list[str]) -> DataFrame:
        """(_g, _n, _rank, hash, *payload) -> one row per block: _g, _n, _block, _node with its nested children."""
        a, deep = self.arity, self.levels
        block = F.expr(f"_rank div {a**deep}").alias("_block")
        digits = [F.expr(f"cast(pmod(_rank div {a**i}, {a}) as int)").alias(f"_d{i}") for i in range(deep)]
        node = F.struct("hash", *payload).alias("_node")
        rows = leaves.select("_g", "_n", block, *digits, node).repartition("_g", "_block")
        for level in range(1, deep + 1):
            keys = ["_g", "_n", "_block", *[f"_d{i}" for i in range(deep - 1, level - 1, -1)]]
            kids = F.sort_array(F.collect_list(F.struct(F.col(f"_d{level - 1}").alias("digit"), F.col("_node").alias("node"))))
            rows = rows.groupBy(*keys).agg(kids.alias("_kids"))
            below = F.transform("_kids", lambda k: k["node"]["hash"])
            own = F.when(self._many(level), F.sha2(_joined(below), 256)).otherwise(below[0])
            rows = rows.select(*keys, F.struct(own.alias("hash"), F.col("_kids").alias("kids")).alias("_node"))
        return rows

    def _down(self, nodes: Column, level: int) -> Column:
        """Nodes of a level with their paths -> their children with theirs, one step longer where hashing took place."""

        def children(e: Column) -> Column:
            kids, size = e["node"]["kids"], F.size(e["node"]["kids"])
            hashes = lambda a, n: _joined(F.transform(F.slice(kids, a, n), lambda k: k["node"]["hash"]))
            step = lambda i: F.struct(hashes(F.lit(1), i).alias("before"), hashes(i + 2, size).alias("after"))
            path = lambda i: F.when(self._many(level), F.concat(F.array(step(i)), e["path"])).otherwise(e["path"])
            return F.transform(kids, lambda k, i: F.struct(k["node"].alias("node"), path(i).alias("path")))

        return F.flatten(F.transform(nodes, children))

    def rise(self, leaves: DataFrame, payload: list[str]) -> list[DataFrame]:
        """(_g, _n, _rank, hash, *payload) -> written tables of blocks, each made of the roots of those before it; in the
        last one every group is one block."""
        size, tables = self.arity**self.levels, []
        while True:
            tables.append(materialize(self.blocks(leaves, payload), "blocks"))
            if (tables[-1].agg(F.max("_n").alias("n")).first()["n"] or 0) <= size:
                return tables
            more = F.expr(f"(_n + {size - 1}) div {size}").alias("_n")
            leaves, payload = tables[-1].select("_g", F.col("_block").alias("_rank"), more, F.col("_node.hash").alias("hash"), "_block"), ["_block"]

    def descend(self, tables: list[DataFrame], payload: list[str], above: DataFrame | None = None) -> DataFrame:
        """Tables of rise() -> _g, hash, *payload, path (from the leaf up), top (its group's last node).

        above: _g, path and top to go on with, where the groups' last nodes are leaves of another tree."""
        up = None
        for k in range(len(tables) - 1, -1, -1):
            if up is not None:
                blocks = tables[k].join(up.select("_g", "_block", F.col("path").alias("_up"), "top"), ["_g", "_block"])
            elif above is not None:
                blocks = tables[k].join(above.select("_g", F.col("path").alias("_up"), "top"), "_g")
            else:
                blocks = tables[k].withColumns({"_up": F.array().cast(_PATH), "top": F.col("_node.hash")})
            nodes = F.array(F.struct(F.col("_node").alias("node"), F.col("_up").alias("path")))
            for level in range(self.levels, 0, -1):
                nodes = self._down(nodes, level)
            out = blocks.select("_g", "_n", "top", F.explode(nodes).alias("_e"))
            names = ["_block"] if k else payload
            up = out.select("_g", "_e.node.hash", *[f"_e.node.{p}" for p in names], "_e.path", "top")
        return up


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda acc, p: F.sha2(F.concat(p["before"], acc, p["after"]), 256))


def manifest(rows: DataFrame, leaf: Column, group: Column, order: Column, payload: list[Column], arity: int = 2, levels: int = 7) -> DataFrame:
    """leaf, subroot, root, path (other hashes of each run from the leaf up, before and after it) and the payload columns.

    Row by row of `rows`; payload columns need aliases, and must not be large: they travel with the leaves."""
    tree, small = Rollup(arity, levels), Rollup(arity, min(levels, 4))
    names = [rows.select(p).columns[0] for p in payload]
    # a group's key: '' for NULL, else a mark and the value, so that NULL comes first
    key = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    leaves = materialize(rows.select(key.alias("_g"), order.alias("_o"), leaf.alias("hash"), *payload), "leaves")
    tables = tree.rise(ranked(leaves, ["_o", "hash"]), names)
    subroots = materialize(tables[-1].select(F.lit("").alias("_g"), F.col("_g").alias("_of"), F.col("_node.hash").alias("hash")), "subroots")
    above = small.descend(small.rise(ranked(subroots, ["_of"]), ["_of"]), ["_of"])
    above = materialize(above.select(F.col("_of").alias("_g"), "path", F.struct(F.col("hash").alias("subroot"), F.col("top").alias("root")).alias("top")), "above")
    out = tree.descend(tables, names, above)
    return out.select(*names, F.col("hash").alias("leaf"), "top.subroot", "top.root", "path")


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [F.col(c) if c != "n_chars" else F.col(c).cast("decimal(20)") + 1 for c in fields]
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = F.when(hit & F.col("n_chars").isNotNull(), leaf_hash(tampered)).alias("_changed")
    made = manifest(docs, leaf_hash([F.col(c) for c in fields]), F.col("lang"), F.col("doc_id"), [F.col("doc_id"), changed])
    proof = F.sha2(_joined(F.transform("path", lambda p: F.concat(p["before"], p["after"]))), 256)
    folded = fold(F.coalesce("_changed", "leaf"), F.col("path"))
    out = made.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: crc32(decimal doc_id), a bit at a time over the digits' bytes.
_CRC = "list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT), lambda c, b: {})"
_BYTE = "xor(c, b)"
for _ in range(8):
    _BYTE = f"list_transform([{_BYTE}], lambda z: xor(z >> 1, (z & 1) * 3988292384))[1]"

ORACLE_SQL = rf"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos,
    doc_id IS NOT NULL AND xor({_CRC.format(_BYTE)}, 4294967295) % 7 = 0 AND n_chars IS NOT NULL AS hit,
    list_transform([doc_id::VARCHAR, source, lang], lambda x: coalesce(strlen(x)::VARCHAR || ':' || x, '-')) AS head,
    n_chars, coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS tail
  FROM documents
), d AS (
  SELECT doc_id, lang, pos, sha256(array_to_string(head, '') || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') || tail) AS leaf,
    CASE WHEN hit THEN sha256(array_to_string(head, '') || strlen((n_chars::HUGEINT + 1)::VARCHAR)::VARCHAR || ':' || (n_chars::HUGEINT + 1)::VARCHAR || tail) END AS changed
  FROM f
), t AS (
  SELECT lang, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM d
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY lang, level, pos // 2, n
), s AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM t WHERE n = 1
), u AS (
  SELECT 0 AS level, pos, subroot AS h, count(*) OVER () AS n FROM s
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY level, pos // 2, n
), steps AS (
  SELECT d.doc_id, 0 AS part, t.level, coalesce(o.h, '') AS h, o.pos < (d.pos >> t.level) AS before
  FROM d JOIN (SELECT DISTINCT lang, level FROM t WHERE n > 1) AS t ON d.lang IS NOT DISTINCT FROM t.lang
  LEFT JOIN t AS o ON o.lang IS NOT DISTINCT FROM d.lang AND o.level = t.level AND o.pos = xor(d.pos >> t.level, 1)
  UNION ALL
  SELECT d.doc_id, 1, l.level, coalesce(o.h, ''), o.pos < (s.pos >> l.level)
  FROM d JOIN s ON d.lang IS NOT DISTINCT FROM s.lang JOIN (SELECT DISTINCT level FROM u WHERE n > 1) AS l ON true
  LEFT JOIN u AS o ON o.level = l.level AND o.pos = xor(s.pos >> l.level, 1)
), p AS (
  SELECT doc_id, string_agg(h, '' ORDER BY part, level) AS proof, list({{'h': h, 'before': coalesce(before, false), 'leaf': NULL}} ORDER BY part, level) AS path FROM steps GROUP BY doc_id
), o AS (
  SELECT d.doc_id, leaf, subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce([{{'h': coalesce(changed, leaf), 'before': false}}] || list_transform(coalesce(path, []), lambda x: {{'h': x.h, 'before': x.before}}),
      lambda a, x: {{'h': sha256(CASE WHEN x.before THEN x.h || a.h ELSE a.h || x.h END), 'before': false}}).h AS folded_root
  FROM d JOIN s ON d.lang IS NOT DISTINCT FROM s.lang LEFT JOIN p ON p.doc_id = d.doc_id
)
SELECT *, folded_root = root AS verified FROM o
"""
