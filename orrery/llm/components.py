"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is an aggregation (combined before its shuffle) and a join that
adaptive execution can split on a hub; each round is written to shared storage,
and the one before is deleted.  The rounds end when every node has either one
smaller neighbour or only larger ones, that is, when the edges are stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import discard, materialize


def _is_stars(e: DataFrame) -> bool:
    ends = e.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (a long, b long) -> (node, root): root is the smallest node reachable; roots themselves have no row.

    Loops, repeated and reversed edges are harmless; NULL ends are dropped; an empty table gives an empty one."""
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _is_stars(e):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b"), F.col("a")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        before, e = e, materialize(small.union(least.select("u", "m")).distinct(), "edges")
        discard(before)
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
