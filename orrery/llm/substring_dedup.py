"""Operator 10: substring dedup over prefix-partitioned suffix trees.

A suffix starts at every word that has `window` (20) words of its document left.
In the tree of all suffixes, those under one internal node of depth `window` or
more share a repeated passage; the earliest of them stays.  The suffixes are split
by prefixes of variable length into memory-sized groups, and a group's subtree is
built on its own:

1. A suffix's prefix runs up to the end of its anchor, the smallest `prefix`-gram
   (5 words) among its first `window` words; so it has 5 to 20 words, and
   suffixes with equal first 20 words have equal prefixes.  Neighbouring suffixes
   mostly share an anchor.  Anchors are counted: one that occurs once in the
   corpus rules out all its suffixes.  Only anchors travel here, one per run of
   suffixes.
2. The other suffixes go into groups: all prefixes that end with one anchor
   together, which lets a run travel as one piece of text (word numbers in a
   dictionary of the piece's package).  Where an anchor is so frequent that its
   group would not fit memory, its prefixes grow to the whole `window`.  Each map
   task first builds the subtrees of the suffixes that it has read and sends one
   leaf of each deep node, so a passage held by a third of all documents adds one
   row per task, not per document.
3. A group's subtree is its sorted suffixes with the lengths of the prefixes that
   neighbours share (a suffix array with its LCP array).  Runs of LCP >= `window`
   are the leaves under one deep internal node; all but the earliest are repeats.
   Consecutive repeats of a document form one maximal repeat (a span).

Suffixes are compared word by word; a word stands for itself by a 64-bit hash.
Hashes of several words only choose groups.

Defined cases: NULL and empty texts have no words and are kept as they are; a
NULL doc_id sorts before all others; rows that repeat a doc_id with the same
text are one document, which goes through the steps once, and get equal rows;
different texts under one doc_id are
separate documents, the smaller text hash first.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import NULL_ID, id_or_sentinel, materialize, partitions
from ._text import SPACES, grams, mix, pack, sliding_min, split_by_bucket, text_blocks, tokenize, valid_starts

_U = np.uint64
#: Suffixes held by a map task before it deals them out, and suffixes meant for one group.
FLUSH = 1 << 19
GROUP = 1 << 19
#: Packages that leave a map task at a time.
PACKAGES = 32
#: Equal rows that are written by one task at a time.
COPIES = 10_000


def _anchors(words, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, their anchors, whether the window holds its anchor twice)."""
    ok = valid_starts(words, window)
    g = grams(words.hash, prefix)
    width = window - prefix + 1
    low = sliding_min(g, width)[: len(ok)]
    starts = np.flatnonzero(ok)
    low = low[starts]
    twice = np.zeros(len(starts), np.int8)
    for o in range(width):
        twice += g[starts + o] == low
    return starts, low, twice > 1


def _anchor_runs(batches, window: int, prefix: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("_k", pa.int64()), ("_h", pa.int64()), ("anchor", pa.list_(pa.int64())), ("times", pa.list_(pa.int8()))])
    for batch in batches:
        ids, hs = batch.column(0), batch.column(1)
        for i, j, data, off in text_blocks(batch.column(2)):
            words = tokenize(data, off, SPACES)
            starts, low, twice = _anchors(words, window, prefix)
            if not len(starts):
                continue
            doc = np.searchsorted(words.ptr, starts, "right") - 1
            new = np.empty(len(starts), bool)
            new[0] = True
            new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(new)
            length = np.diff(np.append(at, len(starts)))
            many = np.maximum.reduceat(twice.astype(np.int8), at).astype(bool) | (length > window - prefix + 1)
            has, first = np.unique(doc[at], return_index=True)
            cuts = pa.array(np.append(first, len(at)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(has + i)),
                    hs.take(pa.array(has + i)),
                    pa.ListArray.from_arrays(cuts, pa.array(low[at].view(np.int64))),
                    pa.ListArray.from_arrays(cuts, pa.array(np.where(many, 2, 1).astype(np.int8))),
                ],
                schema=schema,
            )


#: A package: documents (dk, dh), segments (doc, at, n: first suffix and how many follow one by one), their words as
#: numbers in `vocab`; or spans found already (rk, rs, re).
_GROUPED = pa.schema([("bucket", pa.int64())] + [(c, pa.binary()) for c in ("dk", "dh", "doc", "at", "n", "vocab", "word", "rk", "rs", "re")])
_GROUPED_TYPES = "bucket long, dk binary, dh binary, doc binary, at binary, n binary, vocab binary, word binary, rk binary, rs binary, re binary"


def _spans(k: np.ndarray, start: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal repeats: (row of the document, first word, end word) of runs of consecutive repeated windows.

    k and start are sorted by document and place."""
    if not len(k):
        z = np.zeros(0, np.int64)
        return z, z, z
    new = np.empty(len(k), bool)
    new[0] = True
    new[1:] = (k[1:] != k[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(k)) - 1
    return k[at], start[at], start[last] + window


def suffix_tree(word: np.ndarray, at: np.ndarray, rank: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): suffixes sorted by their first `window` words, then by rank, and how many words each shares with
    the one before it (0 for the first).  Suffix i is word[at[i] : at[i] + window]."""
    if not len(at):
        return at, at
    bits = max(1, int(word.max()).bit_length())
    per = 64 // bits
    keys = []
    # a column of words at a time: all of them side by side would be the largest array of a group
    for c in range(0, window, per):
        key = np.zeros(len(at), _U)
        for w in range(c, min(window, c + per)):
            key = key << _U(bits) | word[at + w].astype(_U)
        keys.append(key)
    order = np.lexsort((rank, *keys[::-1]))
    del keys
    at = at[order]
    lcp = np.zeros(len(at), np.int64)
    same = np.ones(len(at) - 1, bool)
    for w in range(window):
        column = word[at + w]
        same &= column[1:] == column[:-1]
        lcp[1:] += same
    return order, lcp


def _first_of_each(order: np.ndarray, lcp: np.ndarray, rank: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(the earliest leaf of each node of depth `window`, all later leaves by place).

    Each place counts once: rows that repeat a document hold its places, they don't repeat its suffixes."""
    r = rank[order]
    later = lcp >= window
    first = order[~later]
    later[1:] &= r[1:] != r[:-1]
    lose = order[later]
    return np.sort(first), lose[np.argsort(rank[lose], kind="stable")]


def _place(k: np.ndarray, h: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rank of (doc_id, text hash, start); doc points into k and h."""
    order = np.lexsort((h, k))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    same = np.zeros(len(order), bool)
    ks, hs = k[order], h[order]
    same[1:] = (ks[1:] == ks[:-1]) & (hs[1:] == hs[:-1])
    dense = np.cumsum(~same) - 1
    rank[order] = dense
    return (rank[doc] << np.int64(32)) | start


def _ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (length[i] numbers) for each i, in one array."""
    return np.repeat(first - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


def _number(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct words, each word's number among them)."""
    vocab, number = np.unique(words, return_inverse=True)
    return vocab, number.astype(np.uint32)


def _repeated(k, h, doc, start, word, at, window: int) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """(suffixes that stay, spans of the others: _k, _h, first word, end word)."""
    rank = _place(k, h, doc, start)
    kept, lose = _first_of_each(*suffix_tree(word, at, rank, window), rank, window)
    d, s, e = _spans((rank[lose] >> 32), start[lose], window)
    head = doc[lose[np.searchsorted(rank[lose] >> 32, d)]] if len(d) else lose[:0]
    return kept, (k[head], h[head], s.astype(np.int32), e.astype(np.int32))


def _packed(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _GROUPED, strict=True)], schema=_GROUPED)


def _deal(k, h, doc, key, count, win, start, at, words, window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    vocab, word = _number(words)
    kept, (sk, sh, s, e) = _repeated(k, h, doc, start, word, at, window)
    split = (count // (1 << 16) + 1).astype(_U)
    bucket = (mix(key + (win % split) * _U(0x9E3779B97F4A7C15)) % _U(buckets)).astype(np.int64)
    rows = []
    for b, part in split_by_bucket(bucket[kept]):
        p = kept[part]
        new = np.ones(len(p), bool)
        new[1:] = (doc[p[1:]] != doc[p[:-1]]) | (start[p[1:]] != start[p[:-1]] + 1)
        head = np.flatnonzero(new)
        n = np.diff(np.append(head, len(p)))
        head = p[head]
        used, local = np.unique(doc[head], return_inverse=True)
        own, number = _number(word[_ranges(at[head], n + window - 1)])
        small = number.astype(np.uint16 if len(own) <= 1 << 16 else np.uint32)
        rows.append([b, pack(k[used]), pack(h[used]), pack(local.astype(np.int32)), pack(start[head].astype(np.int32)), pack(n.astype(np.int32)), pack(vocab[own]), pack(small), b"", b"", b""])
        if len(rows) == PACKAGES:
            yield _packed(rows)
            rows = []
    if len(s):
        rows.append([int(mix(np.array([len(s)], _U))[0] % _U(buckets)), b"", b"", b"", b"", b"", b"", b"", pack(np.stack([sk, sh])), pack(s), pack(e)])
    if rows:
        yield _packed(rows)


def _windows(batches, window: int, prefix: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of documents with their repeated anchors -> packages of suffixes by group."""
    held: list[tuple] = []
    size = docs = length = 0

    def flush():
        nonlocal held, size, docs, length
        if held:
            yield from _deal(*(np.concatenate(c) for c in zip(*held, strict=True)), window, buckets)
        held, size, docs, length = [], 0, 0, 0

    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        hs = batch.column(1).to_numpy(zero_copy_only=False)
        for i, j, data, off in text_blocks(batch.column(2)):
            lists = [batch.column(c).slice(i, j - i).flatten().to_numpy(zero_copy_only=False) for c in (3, 4)]
            keys, at = np.unique(lists[0].view(_U), return_index=True)
            if not len(keys):
                continue
            counts = lists[1][at].astype(np.int64)
            words = tokenize(data, off, SPACES)
            starts, low, _ = _anchors(words, window, prefix)
            pos = np.minimum(np.searchsorted(keys, low), len(keys) - 1)
            sel = np.flatnonzero(keys[pos] == low)
            starts, pos = starts[sel], pos[sel]
            doc = np.searchsorted(words.ptr, starts, "right") - 1
            win = grams(words.hash, window)[starts]
            # only words of such suffixes are held; those of one suffix stay together
            depth = np.zeros(len(words.hash) + 1, np.int32)
            np.add.at(depth, starts, 1)
            np.add.at(depth, starts + window, -1)
            needed = np.cumsum(depth[:-1]) > 0
            place = np.cumsum(needed) - 1
            held.append((ids[i:j], hs[i:j], doc + docs, keys[pos], counts[pos], win, starts - words.ptr[doc], place[starts] + length, words.hash[needed]))
            docs += j - i
            size += len(starts)
            length += int(needed.sum())
            if size >= FLUSH:
                yield from flush()
    yield from flush()


def _repeats(pdf: pd.DataFrame, window: int) -> pd.DataFrame:
    """One group: its subtree's nodes of depth `window` and the spans of all their leaves but the first."""
    ks, hs, docs, starts, ats, words, vocabs, out = [], [], [], [], [], [], [], []
    base = length = known = 0
    for row in pdf.itertuples(index=False):
        if row.rk:
            kh = np.frombuffer(row.rk, np.int64).reshape(2, -1)
            out.append((kh[0], kh[1], np.frombuffer(row.rs, np.int32), np.frombuffer(row.re, np.int32)))
            continue
        vocab, n = np.frombuffer(row.vocab, _U), np.frombuffer(row.n, np.int32).astype(np.int64)
        wide = np.frombuffer(row.word, np.uint16 if len(vocab) <= 1 << 16 else np.uint32)
        k, long = np.frombuffer(row.dk, np.int64), n + window - 1
        ks.append(k)
        hs.append(np.frombuffer(row.dh, np.int64))
        docs.append(np.repeat(np.frombuffer(row.doc, np.int32).astype(np.int64) + base, n))
        starts.append(_ranges(np.frombuffer(row.at, np.int32).astype(np.int64), n))
        ats.append(_ranges(np.cumsum(long) - long + length, n))
        words.append(wide.astype(np.uint32) + np.uint32(known))
        vocabs.append(vocab)
        known += len(vocab)
        base += len(k)
        length += len(wide)
    if words:
        k, h, doc, start, at = (np.concatenate(x) for x in (ks, hs, docs, starts, ats))
        # every word of a vocabulary is used, so numbering the vocabularies numbers the words
        word = _number(np.concatenate(vocabs))[1][np.concatenate(words)]
        del words, vocabs
        out.append(_repeated(k, h, doc, start, word, at, window)[1])
    if not out:
        return pd.DataFrame({"_k": [], "_h": [], "s": [], "e": []})
    return pd.DataFrame({name: np.concatenate(c) for name, c in zip(("_k", "_h", "s", "e"), zip(*out, strict=True), strict=True)})


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(id_or_sentinel("doc_id").alias("_k"), F.xxhash64("text").alias("_h"), F.col("text"))


def repeated_spans(docs: DataFrame, window: int = 20, prefix: int = 5) -> tuple[DataFrame, DataFrame]:
    """(keyed documents dealt by document, spans (_k, _h, s, e) of words to remove; spans may overlap)."""
    found = _repeated_spans(docs, window, prefix)
    return found[0] if found[1] is None else found[0].unionByName(found[1]), found[3]


def _repeated_spans(docs: DataFrame, window: int, prefix: int) -> tuple[DataFrame, DataFrame | None, DataFrame, DataFrame]:
    """(documents of one row, documents of several rows or None, those documents' numbers of rows, spans).

    A document of several rows is there once, however many rows it has.  Both joins read the dealt documents with the
    same columns, so their texts are shuffled once."""
    spark = docs.sparkSession
    keyed = _keyed(docs)
    runs = materialize(
        keyed.select("_k", "_h", "text").mapInArrow(lambda it: _anchor_runs(it, window, prefix), "_k long, _h long, anchor array<long>, times array<tinyint>"),
        "anchors",
    )
    again = materialize(runs.groupBy("_k", "_h").agg(F.count("*").alias("rows")).where("rows > 1"), "repeated_documents")
    if some := not again.isEmpty():
        one = runs.join(again, ["_k", "_h"], "left_semi").groupBy("_k", "_h").agg(F.first("anchor").alias("anchor"), F.first("times").alias("times"))
        runs = runs.join(again, ["_k", "_h"], "left_anti").unionByName(one)
    each = runs.select("_k", "_h", F.explode(F.arrays_zip("anchor", "times")).alias("x")).select("_k", "_h", F.col("x.anchor").alias("anchor"), F.col("x.times").alias("times"))
    repeated = materialize(each.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1"), "repeated")
    total = repeated.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(partitions(spark), -(-int(total) * (window - prefix) // 2 // GROUP))
    lists = (
        each.select("_k", "_h", "anchor").join(repeated, "anchor")
        .groupBy("_k", "_h").agg(F.collect_list(F.struct("anchor", "n")).alias("a"))
    )
    dealt, several = keyed.repartition("_k", "_h"), None
    if some:
        several = keyed.join(again, ["_k", "_h"], "left_semi").groupBy("_k", "_h").agg(F.first("text").alias("text"))
        dealt = keyed.join(again, ["_k", "_h"], "left_anti").repartition("_k", "_h")
    parts = [
        d.select("_k", "_h", "text").join(lists, ["_k", "_h"]).select("_k", "_h", "text", F.col("a.anchor").alias("anchor"), F.col("a.n").alias("n"))
        for d in (dealt, several) if d is not None
    ]
    grouped = (parts[0].unionByName(parts[1]) if some else parts[0]).mapInArrow(lambda it: _windows(it, window, prefix, buckets), _GROUPED_TYPES)
    spans = grouped.groupBy("bucket").applyInPandas(lambda pdf: _repeats(pdf, window), "_k long, _h long, s int, e int")
    return dealt, several, again, spans


def _cut(batches, digest_only: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        more = range(4, batch.num_columns)
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ([] if digest_only else ["kept_text"]) + [batch.schema.names[c] for c in more]
        for i, j, data, off in text_blocks(batch.column(1)):
            words = tokenize(data, off, SPACES)
            starts = [batch.column(c).slice(i, j - i) for c in (2, 3)]
            removed, shas, texts = [], [], []
            raw = data.tobytes()
            for r in range(j - i):
                a, b = int(words.ptr[r]), int(words.ptr[r + 1])
                s = starts[0][r].as_py()
                if s:
                    depth = np.zeros(b - a + 1, np.int32)
                    np.add.at(depth, np.asarray(s), 1)
                    np.add.at(depth, np.asarray(starts[1][r].as_py()), -1)
                    keep = np.cumsum(depth[:-1]) == 0
                    idx = np.flatnonzero(keep) + a
                    kept = b" ".join([raw[x:y] for x, y in zip(words.start[idx].tolist(), words.end[idx].tolist(), strict=True)])
                    removed.append(b - a - len(idx))
                else:
                    kept = b" ".join(raw[off[r] : off[r + 1]].split())
                    removed.append(0)
                shas.append(hashlib.sha256(kept).hexdigest())
                if not digest_only:
                    texts.append(kept.decode("utf-8", "replace"))
            cols = [batch.column(0).slice(i, j - i), pa.array(words.counts(), pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string())]
            if not digest_only:
                cols.append(pa.array(texts, pa.string()))
            cols += [batch.column(c).slice(i, j - i) for c in more]
            yield pa.RecordBatch.from_arrays(cols, names=names)


def substring_dedup(docs: DataFrame, window: int = 20, prefix: int = 5, digest_only: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and (unless digest_only) kept_text, a row per row of `docs`."""
    dealt, several, again, spans = _repeated_spans(docs, window, prefix)
    cuts = spans.groupBy("_k", "_h").agg(F.collect_list(F.struct("s", "e")).alias("c"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ("" if digest_only else ", kept_text string")

    def cut(joined: DataFrame, *more: str) -> DataFrame:
        rows = joined.select(F.nullif("_k", F.lit(NULL_ID)).alias("doc_id"), "text", F.col("c.s").alias("s"), F.col("c.e").alias("e"), *more)
        return rows.mapInArrow(lambda it: _cut(it, digest_only), ", ".join([schema, *[f"{c} long" for c in more]]))

    out = cut(dealt.join(cuts, ["_k", "_h"], "left"))
    if several is None:
        return out
    # as many equal rows as there were, in pieces that are dealt out anew
    made = cut(several.join(cuts, ["_k", "_h"], "left"), "_k", "_h")
    pieces = again.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(rows - 1) div {COPIES}"))))
    dealt_out = made.join(pieces, ["_k", "_h"]).repartition(partitions(docs.sparkSession))
    copies = F.least(F.lit(COPIES).cast("long"), F.col("rows") - F.col("piece") * COPIES)
    each = dealt_out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    return out.unionByName(each.select(*out.columns))


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest_only=True)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), p AS (
  SELECT doc_id, s.i AS i, sha256(array_to_string(w[s.i:s.i + 19], ' ')) AS g
  FROM d, unnest(range(1, len(w) - 18)) AS s(i)
), f AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM p
), c AS (
  SELECT DISTINCT doc_id, x.j AS j FROM f, unnest(range(i, i + 20)) AS x(j) WHERE r > 1
), k AS (
  SELECT doc_id, list(j) AS js FROM c GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(w, lambda x, i: js IS NULL OR NOT list_contains(js, i)), ' ')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
