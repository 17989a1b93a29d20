"""Operator 4: exact top-k inner products by a three-phase uniform threshold.

A vector's dimensions are split into BLOCKS parts; a part's inner product is a
local score, and a row's score is the sum of its local scores.

1. Each task gathers, per query and part, its rows with the highest local
   scores, and keeps the k best of them by whole score.  The k-th best over all
   tasks is a lower bound of the true k-th score, `t`.
2. `t` is broadcast as a cutoff: a row that reaches t has a local score of t /
   BLOCKS or more in some part (BLOCKS * local >= t, in integers).  Tasks collect
   those entries.
3. Their remaining local scores are added exactly; rows below t go, the k best
   of a task are kept (ties to the smaller id), and a ranking over all tasks ends it.

Queries are read in blocks of about QUERY_BLOCK components: a block's vectors and
cutoffs are broadcasts of bounded size, which go once its result is written, and
every block goes over all rows.  A
task scores tiles of rows against tiles of queries, so its memory is bounded by
tiles and the k rows that it holds per query.

Defined cases: vectors that are NULL or hold NULL or non-finite components, and
rows with a NULL id, take no part; shorter vectors are padded with zeros; rows
that repeat an id count once, with their best score; of different query vectors
under one id the greatest in array order asks; a score beyond the range of a long
is clipped to it; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import materialize

BLOCKS = 4
#: Components in a block of queries (a broadcast of 32 MB), queries and rows in a tile.
QUERY_BLOCK = 1 << 22
QUERY_TILE = 512
TILE = 1024
_LOW, _HIGH = -(2**63), 2**63 - 1


def valid_vectors(df: DataFrame) -> DataFrame:
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False))).select("vec_id", "embedding")


def _quantise(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """Rows of floor(scale * x) as floats, exact; padded or cut to `width` (the queries' zeros need no partner)."""
    offsets = column.offsets.to_numpy()
    values = np.floor(scale * column.values.to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(column), width))
    lengths = np.minimum(np.diff(offsets), width)
    rows = np.repeat(np.arange(len(column)), lengths)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, within] = values[np.repeat(offsets[:-1], lengths) + within]
    return out


def _local_scores(q: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    """For each part the (query x row) inner products; exact integers (objects where doubles would round)."""
    parts = [p for p in np.array_split(np.arange(q.shape[1]), BLOCKS) if len(p)] or [np.arange(0)]
    most = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1]) * BLOCKS
    if most < 2**52:
        return [(q[:, p] @ x[:, p].T).astype(np.int64) for p in parts]
    to_int = np.vectorize(int, otypes=[object])
    return [to_int(q[:, p]) @ to_int(x[:, p]).T if q[:, p].size and x.size else np.zeros((len(q), len(x)), object) for p in parts]


def _best(query: np.ndarray, row: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best distinct rows of each query: higher scores first, ties to the smaller id."""
    order = np.lexsort((row, -score, query)) if score.dtype != object else np.array(sorted(range(len(score)), key=lambda i: (query[i], -score[i], row[i])), np.int64)
    query, row, score = query[order], row[order], score[order]
    pair = np.lexsort((np.arange(len(row)), row, query))
    same = np.zeros(len(row), bool)
    same[pair[1:]] = (query[pair[1:]] == query[pair[:-1]]) & (row[pair[1:]] == row[pair[:-1]])
    query, row, score = query[~same], row[~same], score[~same]
    start = np.searchsorted(query, query, "left")
    keep = np.arange(len(query)) - start < k
    return query[keep], row[keep], score[keep]


def _tiles(batches) -> Iterator[tuple[np.ndarray, pa.Array]]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a in range(0, len(ids), TILE):
            part = batch.column(1).slice(a, TILE)
            yield ids[a : a + TILE], pa.concat_arrays([part])


def _emit(held, qid: np.ndarray) -> Iterator[pa.RecordBatch]:
    q, r, s = held
    clipped = np.array([min(max(int(v), _LOW), _HIGH) for v in s], np.int64) if s.dtype == object else s
    yield pa.RecordBatch.from_arrays([pa.array(qid[q]), pa.array(r), pa.array(clipped, pa.int64())], names=["query_id", "vec_id", "score"])


def _collect(batches, shared, cutoffs, k: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Phase 1 without cutoffs, phases 2 and 3 with them."""
    qid, qs = shared.value
    cuts = range(0, len(qid), QUERY_TILE)
    none = np.zeros(0, np.int64)
    held = [(none, none, none) for _ in cuts]
    for ids, column in _tiles(batches):
        x = _quantise(column, qs.shape[1], scale)
        for t, a in enumerate(cuts):
            some = qid[a : a + QUERY_TILE]
            local = _local_scores(qs[a : a + QUERY_TILE], x)
            if cutoffs is None:
                top = min(k + 1, len(ids))
                picks = [np.argpartition(-s, top - 1, axis=1)[:, :top] if s.dtype != object else np.argsort(-s, axis=1)[:, :top] for s in local]
                at = np.concatenate(picks, 1)
                q, r = np.repeat(np.arange(len(some)), at.shape[1]), at.ravel()
            else:
                limit, free = (c[a : a + QUERY_TILE] for c in cutoffs.value)
                hit = np.repeat(free[:, None], len(ids), 1)
                for s in local:
                    hit |= (s * len(local) >= limit[:, None]).astype(bool)
                q, r = np.nonzero(hit)
            score = sum(s[q, r] for s in local)
            keep = ids[r] != some[q]
            if cutoffs is not None:
                keep &= free[q] | (score >= limit[q]).astype(bool)
            q, r, score = q[keep], ids[r[keep]], score[keep]
            held[t] = _best(np.concatenate([held[t][0], q]), np.concatenate([held[t][1], r]), np.concatenate([held[t][2], score]), k)
    for t, a in enumerate(cuts):
        yield from _emit(held[t], qid[a : a + QUERY_TILE])


def _query_blocks(queries: DataFrame, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of about QUERY_BLOCK components each, every id once."""
    one = materialize(queries.groupBy("vec_id").agg(F.max("embedding").alias("embedding")), "queries")
    size = one.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("w")).first()
    blocks = max(1, -(-size["n"] * max(1, size["w"] or 0) // QUERY_BLOCK))
    for b in range(blocks):
        got = one.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()  # distinct ids, dealt evenly
        if not got.num_rows and blocks > 1:
            continue
        column = got.column("embedding").combine_chunks()
        column = column if isinstance(column, pa.ListArray) else pa.array([], pa.list_(pa.float32()))
        width = int(np.diff(column.offsets.to_numpy()).max(initial=1)) if got.num_rows else 1
        yield got.column("vec_id").to_numpy().astype(np.int64), _quantise(column, width, scale) if got.num_rows else np.zeros((0, width))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest integer inner products for each query row."""
    spark = vectors.sparkSession
    rows = valid_vectors(vectors)
    done = []
    rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best_of = lambda lists: lists.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    for ids, qs in _query_blocks(rows.where(is_query), scale):
        shared = spark.sparkContext.broadcast((ids, qs))
        kind = "query_id long, vec_id long, score long"
        best = best_of(rows.mapInArrow(lambda it, shared=shared: _collect(it, shared, None, k, scale), kind))
        found = {r["query_id"]: r["t"] for r in best.groupBy("query_id").agg(F.min("score").alias("t"), F.count("*").alias("n")).where(F.col("n") == k).collect()}
        # a bound that was clipped, or no bound, lets every row through
        limit = np.array([found.get(i, _LOW) for i in ids.tolist()], np.int64)
        free = (limit == _LOW) | (limit == _HIGH)
        cutoffs = spark.sparkContext.broadcast((np.where(free, 0, limit), free))
        lists = rows.mapInArrow(lambda it, shared=shared, cutoffs=cutoffs: _collect(it, shared, cutoffs, k, scale), kind)
        done.append(materialize(best_of(lists).select("query_id", "rank", "vec_id", "score"), "top"))
        shared.destroy()  # the block's result is written
        cutoffs.destroy()
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def op4_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""
