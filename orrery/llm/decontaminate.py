"""Operator 8: benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of `window` words (a shorter item is one window).
A window occurs in a document only if all its shingles (3 words, or fewer in a
shorter window) do:

1. Shingles are ordered by rarity, their count over all documents.  Where all of a
   set must be contained, its necessary prefix in that order is one shingle long: a
   window's key is its rarest shingle.  A window whose key occurs nowhere is done.
2. Documents emit the places that hold a key, each with the words around it that a
   window through this place can cover.
3. Places and windows are joined on the key.  The key's offset in the window gives
   the one place where the window could start; it must lie in the document with all
   its words (positional and length bounds), and then the words are compared.

Two passes over the documents do that, whatever the benchmark's size: what a pass
looks for is broadcast as a hashed bit filter of at most 2^max_bits bits (16 MB),
and the joins settle what the filter lets through by chance.  The join is salted by
document, in as many parts as the most frequent key needs, so a passage that a third
of all documents hold is spread.  Documents that hold the same set of windows are
one class; items are listed per class, so a window that many items and many
documents share costs no product of both.

Words are compared by 64-bit hashes.  Defined cases: NULL or empty texts and
items have no words and match nothing; an item with a NULL id still marks words
but is not listed; repeated items are listed once per distinct id; a long item is
read in pieces; rows of equal id and text get equal results; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import NULL_ID, id_or_sentinel, materialize
from ._text import PUNCTUATION, grams, text_blocks, tokenize, valid_starts

_U = np.uint64
SHINGLE = 3
#: Bits of the largest filter, windows of an item in a piece, places of a key in one part of the join.
MAX_BITS, PIECE, PLACES = 27, 1 << 14, 1 << 17


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """Distinct (item as text, word hashes of a window, hashes of its shingles); items without words have none."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in text_blocks(batch.column(1)):
                w = tokenize(data, off, PUNCTUATION, lower=True)
                for r, (a, b) in enumerate(zip(w.ptr[:-1].tolist(), w.ptr[1:].tolist(), strict=True)):
                    size = min(window, b - a)
                    for s in range(a, b - size + 1 if size else a, PIECE):
                        n, short = min(PIECE, b - size + 1 - s), min(SHINGLE, size)
                        g = grams(w.hash[s : s + n + size - 1], short)
                        lists = [x[np.arange(n)[:, None] + np.arange(k)].view(np.int64) for x, k in ((w.hash[s:], size), (g, size - short + 1))]
                        ids = batch.column(0).take(pa.array(np.full(n, i + r)))
                        yield pa.RecordBatch.from_arrays([ids, *[pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * x.shape[1], pa.int32()), pa.array(x.ravel())) for x in lists]], names=["item", "words", "shingles"])

    got = items.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(run, "item string, words array<long>, shingles array<long>")
    return got.distinct()


def bit_filter(keys: DataFrame, count: int, max_bits: int) -> tuple[int, np.ndarray]:
    """(bits, cells) of a filter over the top bits of a column `key` of hashes, about `count` of them: some 16 bits a key,
    2^max_bits at most."""
    bits = max(6, min(max_bits, int(16 * count).bit_length()))
    place = keys.select(F.shiftrightunsigned("key", 64 - bits).alias("p"))
    cell = place.select(F.shiftrightunsigned("p", 6).cast("int").alias("c"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b"))
    got = cell.groupBy("c").agg(F.bit_or("b").alias("b")).toArrow()  # a row per 64 bits at most
    cells = np.zeros(1 << (bits - 6), _U)
    cells[got.column("c").to_numpy()] = got.column("b").to_numpy().view(_U)
    return bits, cells


def _passes(g: np.ndarray, bits: int, cells: np.ndarray) -> np.ndarray:
    at = g >> _U(64 - bits)
    return (cells[at >> _U(6)] >> (at & _U(63)) & _U(1)).astype(bool)


def _count(batches, shared, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """Counts of the shingles that pass the filter, combined within the task by and by."""
    keys, counts, held = [], [], 0

    def merge() -> tuple[np.ndarray, np.ndarray]:
        k, n = np.concatenate(keys), np.concatenate(counts)
        u, inverse = np.unique(k, return_inverse=True)
        return u, np.bincount(inverse, n, len(u)).astype(np.int64)

    for batch in batches:
        for _, _, data, off in text_blocks(batch.column(0)):
            w = tokenize(data, off, PUNCTUATION, lower=True)
            for s in sizes:
                g = grams(w.hash, s)[valid_starts(w, s)]
                u, n = np.unique(g[_passes(g, *shared.value)], return_counts=True)
                keys.append(u)
                counts.append(n)
                held += len(u)
            if held > 1 << 20:
                u, n = merge()
                if 2 * len(u) > held:  # hardly anything repeats: let it go
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], names=["key", "n"])
                    u, n = u[:0], n[:0]
                keys, counts, held = [u], [n], len(u)
    if keys:
        u, n = merge()
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], names=["key", "n"])


_PLACES = "_k long, _h long, n_words long, places array<struct<key:long,at:int,lead:int,words:array<long>>>"


def _emit_places(batches, shared, sizes: list[int], window: int) -> Iterator[pa.RecordBatch]:
    """Per row: its number of words, and the places of keys with the words around them."""
    for batch in batches:
        for i, j, data, off in text_blocks(batch.column(2)):
            w = tokenize(data, off, PUNCTUATION, lower=True)
            doc_of = w.doc()
            at, key = [np.zeros(0, np.int64)], [np.zeros(0, _U)]
            for s in sizes:
                g = grams(w.hash, s)
                hit = np.flatnonzero(valid_starts(w, s) & _passes(g, *shared.value)) if len(g) else np.zeros(0, np.int64)
                at.append(hit)
                key.append(g[hit])
            at, key = np.concatenate(at), np.concatenate(key)
            order = np.argsort(at, kind="stable")
            at, key = at[order], key[order]
            doc = doc_of[at]
            first, last = np.maximum(w.ptr[doc], at - (window - 1)), np.minimum(w.ptr[doc + 1], at + window)
            length = last - first
            ptr = np.concatenate([[0], np.cumsum(length)])
            around = w.hash[np.repeat(first - ptr[:-1], length) + np.arange(int(ptr[-1]))]
            fields = [pa.array(key.view(np.int64)), pa.array((at - w.ptr[doc]).astype(np.int32)), pa.array((at - first).astype(np.int32)), pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(around.view(np.int64)))]
            places = pa.StructArray.from_arrays(fields, names=["key", "at", "lead", "words"])
            cuts = pa.array(np.searchsorted(doc, np.arange(j - i + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(w.counts(), pa.int64()), pa.ListArray.from_arrays(cuts, places)], names=["_k", "_h", "n_words", "places"])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(id_or_sentinel("doc_id").alias("_k"), F.xxhash64("text").alias("_h"), "text")


def window_keys(docs: DataFrame, windows: DataFrame, max_bits: int) -> tuple[DataFrame, list[int]]:
    """(words, offset, key, n of each distinct window that can occur; sizes of shingles)."""
    sc = docs.sparkSession.sparkContext
    known = windows.agg(F.collect_set(F.least(F.lit(SHINGLE), F.size("words"))).alias("sizes"), F.sum(F.size("shingles")).alias("n")).first()
    sizes = sorted(known["sizes"])
    each = windows.select("words", "shingles").distinct().select("words", F.posexplode("shingles").alias("offset", "key"))
    shared = sc.broadcast(bit_filter(each.select("key"), known["n"] or 0, max_bits))
    counts = docs.select("text").mapInArrow(lambda it: _count(it, shared, sizes), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    rarest = each.join(counts, "key", "left").groupBy("words").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "key")).alias("r"))
    return rarest.where("r.n > 0").select("words", "r.offset", "r.key", "r.n"), sizes


def find_windows(docs: DataFrame, items: DataFrame, window: int, max_bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows _k, _h, n_words of all documents; occurrences _k, _h, w (a window's hash), begin, end; windows item, w)."""
    sc = docs.sparkSession.sparkContext
    windows = materialize(_item_windows(items, window), "windows")
    keys, sizes = window_keys(docs, windows, max_bits)
    keys = materialize(keys, "keys")
    s = keys.agg(F.count("*").alias("n"), F.max("n").alias("most")).first()
    shared = sc.broadcast(bit_filter(keys.select("key"), s["n"], max_bits))
    rows = materialize(_keyed(docs).mapInArrow(lambda it: _emit_places(it, shared, sizes, window), _PLACES), "places")
    places = rows.where(F.size("places") > 0).select("_k", "_h", F.explode("places").alias("p")).select("_k", "_h", "p.key", "p.at", "p.lead", F.col("p.words").alias("around"))
    salts, on = -(-(s["most"] or 0) // PLACES), ["key"]
    if salts > 1:
        places, on = places.withColumn("salt", F.pmod(F.xxhash64("_k", "_h"), F.lit(salts))), ["key", "salt"]
        keys = keys.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    met = places.join(keys.drop("n"), on)
    start = F.col("lead") - F.col("offset")
    fits = (start >= 0) & (start + F.size("words") <= F.size("around"))
    same = F.slice("around", F.greatest(F.lit(1), start + 1), F.size("words")) == F.col("words")
    begin = F.col("at") - F.col("offset")
    found = met.where(fits & same).select("_k", "_h", F.xxhash64("words").alias("w"), begin.alias("begin"), (begin + F.size("words")).alias("end"))
    return rows.select("_k", "_h", "n_words"), found, windows.select("item", F.xxhash64("words").alias("w"))


def covered(begin: list[int], end: list[int]) -> int:
    """Words in any of the spans."""
    last = total = 0
    for s, e in sorted(zip(begin, end, strict=True)):
        total += max(0, e - max(s, last))
        last = max(last, e)
    return total


def _hits(batches) -> Iterator[pa.RecordBatch]:
    """_k, _h, n_words, begins, ends, more columns -> the same with n_hit and contaminated."""
    for batch in batches:
        n, begins, ends = (batch.column(c).to_pylist() for c in (2, 3, 4))
        hit = [covered(b or [], e or []) for b, e in zip(begins, ends, strict=True)]
        bad = [h > 0 and 20 * h >= words for h, words in zip(hit, n, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit, pa.int64()), pa.array(bad, pa.bool_())], names=[*batch.schema.names, "n_hit", "contaminated"])


def _judged(docs: DataFrame, items: DataFrame, window: int, max_bits: int) -> DataFrame:
    rows, found, windows = find_windows(docs, items, window, max_bits)
    held = found.groupBy("_k", "_h").agg(F.collect_set(F.struct("begin", "end")).alias("s"), F.sort_array(F.collect_set("w")).alias("ws"))
    held = materialize(held.withColumn("class", F.xxhash64("ws")), "found")
    of_class = held.groupBy("class").agg(F.first("ws").alias("ws")).select("class", F.explode("ws").alias("w"))
    listed = of_class.join(windows.where("item IS NOT NULL"), "w").groupBy("class").agg(F.sort_array(F.collect_set("item")).alias("items"))
    listed = listed.select("class", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "items")
    one = rows.join(held.select("_k", "_h", F.col("s.begin").alias("begin"), F.col("s.end").alias("end"), "class").join(listed, "class", "left"), ["_k", "_h"], "left")
    none = F.sha2(F.lit(""), 256)
    one = one.select("_k", "_h", "n_words", "begin", "end", F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("items_sha256", none).alias("items_sha256"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return one.mapInArrow(_hits, "_k long, _h long, n_words long, begin array<int>, end array<int>, n_items long, items_sha256 string, items array<string>, n_hit long, contaminated boolean")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 13, max_bits: int = MAX_BITS, with_spans: bool = False) -> DataFrame:
    """A row per document: n_words, n_hit, n_items, items_sha256, contaminated (and begin, end: word spans, which may
    overlap; items: their ids as text).

    contaminated: any word is hit, and hit words are at least a twentieth of all words."""
    more = ["begin", "end", "items"] if with_spans else []
    return _judged(docs, items, window, max_bits).select(F.nullif("_k", F.lit(NULL_ID)).alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated", *more)


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 13, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of `docs`, with all their columns, that are not contaminated."""
    bad = materialize(_judged(docs, items, window, max_bits).where("contaminated").select("_k", "_h").distinct(), "contaminated")
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = {c: F.col(f"c{names.index(c)}") for c in ("doc_id", "text")}
    on = (id_or_sentinel(at["doc_id"]) == bad["_k"]) & (F.xxhash64(at["text"]) == bad["_h"])
    return plain.join(bad, on, "left_anti").toDF(*names)


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    return decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents
), b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark
), q AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[s.i:s.i + 12], ' ') AS g
  FROM b, unnest(range(1, greatest(2, len(w) - 11))) AS s(i) WHERE len(w) > 0
), p AS (
  SELECT doc_id, s.i AS i, l.n AS n, array_to_string(w[s.i:s.i + l.n - 1], ' ') AS g
  FROM d, (SELECT DISTINCT n FROM q) AS l, unnest(range(1, len(w) - l.n + 2)) AS s(i)
), h AS (
  SELECT p.doc_id, p.i, p.n, q.item_id FROM p JOIN q ON p.n = q.n AND p.g = q.g
), c AS (
  SELECT doc_id, count(DISTINCT x.j) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM h), unnest(range(i, i + n)) AS x(j) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM h GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
