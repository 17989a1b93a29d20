"""Operator 5: n-gram Jaccard join over size-banded tiles with bitmap signatures.

Links are pairs of documents whose sets of distinct word shingles reach the
similarity; the result is each document's component.  All links are found.

1. Equal sets collapse into one class (a combined aggregation on a 128-bit
   fingerprint), so thousands of copies cost one representative.
2. What may link, so that tiles need not hold all sets of a size band.  Sizes fall
   into bands; for a band, `H` bounds how many elements two linkable sets can
   differ in.  The hash space is cut into G = H + 1 + e parts, so linked sets agree
   on e + 1 parts at least.  A set emits one signature per non-empty part (and, if
   it has more than e empty parts, one for each of the first of them); `need` is how
   many signatures it shares with any set that it links with, at least.  Signatures
   meet in memory-sized buckets.  Those of more than COLD sets are hot (passages
   that many documents hold, or large groups of near copies): each set leaves out
   its need - 1 most frequent hot signatures (prefix filter), and the sets under a
   kept one form a star around the smallest.  Under the others all pairs are listed,
   and dropped if they agree too rarely.  So two linked sets are in one star or are
   a listed pair.
3. Tiles hold the sorted sets of a bounded number of documents.  There, hashed
   bitmaps bound the overlap from above (|x & y| <= (|x| + |y| - popcount(Bx ^ By))
   / 2), and what passes is intersected exactly.  Pairs already connected are
   skipped, since only components are asked for.  First, components of stars and
   pairs that fit a tile (families) are one tile each; larger ones are taken star by
   star, a set in the LEADS stars with the smallest centres, in chunks that each hold
   that centre too.  So a group of near copies costs a few tiles per document,
   whatever its size.
4. Components over the links.  Where a star's members are then still in several
   components, those outside its largest one meet all members, in tiles of chunk x
   chunk; listed pairs in different components are compared one by one; and the
   components are joined.

Shingles are compared by 64-bit hashes.  Defined cases: NULL or wordless texts
have the empty set, and are linked with nothing; a text of fewer words than a
shingle is one shingle; rows that share a doc_id are one node; rows without a
doc_id are linked by their texts alone (equal texts are one node), and their
component is the smallest id that it has, NULL if it has none; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import materialize, partitions
from ._text import SPACES, grams, mix, pack, split_by_bucket, text_blocks, tokenize
from .components import connected_components

_U = np.uint64
#: Largest group of equal signatures whose pairs are listed; larger ones are hot.
COLD = 16
#: Signatures in one bucket; documents and shingles in one side of a tile.
BUCKET, TILE_DOCS, TILE_SHINGLES = 1 << 19, 512, 1 << 21
#: Stars in which a member of a large family is compared first; what they leave open is settled afterwards.
LEADS = 6
#: Members of hot signatures that travel together.
CHUNK = 1 << 13
#: Tiles of a document that are listed in one row, and bytes of sets in one batch.
SEATS, BATCH = 1024, 1 << 26
#: What `need` is cut to (a lower one lets more pairs through, none less).
MOST_NEED = 2**15 - 1


class Bands:
    """Size bands and their signature schemes for a similarity of percent / 100."""

    def __init__(self, percent: int):
        self.percent = percent
        edges = [1]
        while edges[-1] < 1 << 31:  # a band is wide enough for links to join the same or neighbouring bands
            edges.append(max(edges[-1] + 1, -(-edges[-1] * 10 // 7), -(-edges[-1] * 100 // percent)))
        self.edges = np.array(edges, np.int64)
        self.known: dict[int, tuple[int, int]] = {}

    def home(self, n: int) -> int:
        return int(np.searchsorted(self.edges, n, "right")) - 1

    def scheme(self, band: int) -> tuple[int, int]:
        """(H, e) for pairs whose smaller set lies in the band.  e exceeds the number of empty parts that sets of the
        band's least size usually have (mean and three deviations)."""
        if band not in self.known:
            top = int(self.edges[band + 1]) - 1
            both = top + top * 100 // self.percent
            h = both * (100 - self.percent) // (100 + self.percent)
            extra = 2
            while extra < 2 * h + 2:
                g = h + 1 + extra
                mean = g * math.exp(-int(self.edges[band]) / g)
                if mean + 3 * math.sqrt(mean) <= extra:
                    break
                extra += 1
            self.known[band] = (h, extra)
        return self.known[band]

    def schemes(self, n: int) -> list[int]:
        """The home band, and the one below if a set of n words can be the larger of a pair from there."""
        b = self.home(n)
        return [b, b - 1] if b and n <= (int(self.edges[b]) - 1) * 100 // self.percent else [b]


def shingle_sets(words, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a block."""
    g = grams(words.hash, n)
    out = []
    for a, b in zip(words.ptr[:-1].tolist(), words.ptr[1:].tolist(), strict=True):
        if b - a >= n:
            x = np.sort(g[a : b - n + 1])
            keep = np.empty(len(x), bool)
            keep[0] = True
            np.not_equal(x[1:], x[:-1], out=keep[1:])
            out.append(x[keep])
        else:
            out.append(grams(words.hash[a:b], b - a) if b > a else g[:0])
    return out


def signatures(sets: list[np.ndarray], bands: Bands) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Per document: part signatures, how many of them a linked set must share at least, and their bands."""
    sigs, needs, homes = [], [], []
    for x in sets:
        own_s, own_n, own_b = [], [], []
        for band in bands.schemes(len(x)) if len(x) else []:
            h, extra = bands.scheme(band)
            if not h:
                continue  # only equal sets can link, and those are one class
            g = h + 1 + extra
            part = ((x >> _U(32)) * _U(g)) >> _U(32)
            head = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
            tag = _U((band * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1))
            own = mix(np.add.reduceat(x * (x >> _U(7) | _U(1)), head) + tag + part[head] * _U(0xC2B2AE3D27D4EB4F))
            empty = g - len(head)
            if empty > extra:  # all agreeing parts might be empty: the common ones show in the first empty - e of either
                free = np.setdiff1d(np.arange(g), part[head].astype(np.int64))[: empty - extra]
                own = np.concatenate([own, mix(mix(free.astype(_U) + _U(1)) + tag)])
            own_s.append(own)
            own_n.append(np.full(len(own), min(MOST_NEED, max(1, extra + 1 - empty)), np.int16))
            own_b.append(np.full(len(own), band, np.int16))
        sigs.append(np.concatenate(own_s) if own_s else x[:0])
        needs.append(np.concatenate(own_n) if own_n else np.zeros(0, np.int16))
        homes.append(np.concatenate(own_b) if own_b else np.zeros(0, np.int16))
    return sigs, needs, homes


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ptr = np.concatenate([[0], np.cumsum([len(x) for x in arrays])])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(flat.view(np.int64) if flat.dtype == _U else flat, kind))


def _describe(batches, n: int, bands: Bands) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, off in text_blocks(batch.column(2)):
            sets = shingle_sets(tokenize(data, off, SPACES, lower=True), n)
            sigs, needs, homes = signatures(sets, bands)
            f1 = np.array([np.add.reduce(x, dtype=_U) for x in sets], _U)
            f2 = np.array([np.bitwise_xor.reduce(mix(x)) if len(x) else 0 for x in sets], _U)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).slice(i, j - i) for c in (0, 1)], pa.array([len(x) for x in sets], pa.int64()), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.array([len(x) for x in sigs], pa.int64()), _lists(sigs, pa.int64()), _lists(needs, pa.int16()), _lists(homes, pa.int16())],
                names=["k", "nameless", "n", "f1", "f2", "parts", "sig", "need", "band"],
            )


_ROW = np.dtype([("sig", "u8"), ("k", "i8"), ("need", "i2"), ("band", "i2")])
_DEALT = pa.schema([("bucket", pa.int64()), ("rows", pa.binary()), ("hot", pa.binary()), ("members", pa.binary())])


def _groups(sig: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first position of each group in it, group sizes); within a group by k."""
    order = np.lexsort((k, sig))
    s = sig[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    at = np.flatnonzero(new)
    return order, at, np.diff(np.append(at, len(s)))


def _deal(batches, buckets: int) -> Iterator[pa.RecordBatch]:
    """Packs signatures by bucket.  A group that is hot in this task already sends one marked row to its bucket; its
    members need no company, and go in chunks to buckets that depend on who they are, so that a signature of all tasks
    is spread over all buckets."""
    held: list[np.ndarray] = []
    size = 0

    def flush():
        nonlocal held, size
        if not held:
            return
        rows = np.concatenate(held)
        held, size = [], 0
        order, at, length = _groups(rows["sig"], rows["k"])
        rows = rows[order]
        big = np.repeat(length > COLD, length)
        mark = np.zeros(len(rows), np.int8)
        mark[at[length > COLD]] = 1
        out = []
        sent = np.flatnonzero(~big | (mark > 0))
        for bucket, part in split_by_bucket((rows["sig"][sent] % _U(buckets)).astype(np.int64)):
            p = sent[part]
            out.append([bucket, pack(rows[p]), pack(mark[p]), b""])
        members = rows[big]
        for c in range(0, len(members), CHUNK):
            part = members[c : c + CHUNK]
            who = mix(part["sig"][:1] ^ mix(part["k"][:1].view(_U)))[0]
            out.append([int(who % _U(buckets)), b"", b"", pack(part)])
        for c in range(0, len(out), 256):
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out[c : c + 256], strict=True), _DEALT, strict=True)], schema=_DEALT)

    for batch in batches:
        lists = [batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (1, 2, 3)]
        rows = np.empty(len(lists[0]), _ROW)
        rows["sig"], rows["need"], rows["band"] = lists[0].view(_U), lists[1], lists[2]
        rows["k"] = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), np.diff(batch.column(1).offsets.to_numpy()))
        held.append(rows)
        size += len(rows)
        if size >= BUCKET:
            yield from flush()
    yield from flush()


_FOUND = "kind int, a long, b long, agree long, need int, band int"


def _candidates(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bucket's pairs under cold signatures (kind 0: how many agree, how many must) and members of hot ones (kind 1: a
    is the set, b the signature)."""
    members = [np.frombuffer(x, _ROW) for x in pdf.members if x]
    pairs = []
    packed = [np.frombuffer(x, _ROW) for x in pdf.rows if x]
    if packed:
        rows = np.concatenate(packed)
        mark = np.concatenate([np.frombuffer(x, np.int8) for x in pdf.hot if x])
        order, at, length = _groups(rows["sig"], rows["k"])
        rows, mark = rows[order], mark[order]
        hot = (np.add.reduceat(mark.astype(np.int64), at) > 0) | (length > COLD)
        members.append(rows[np.repeat(hot, length) & (mark == 0)])
        for g in range(2, COLD + 1):
            first = at[(length == g) & ~hot]
            if len(first):
                block = first[:, None] + np.arange(g)
                i, j = np.triu_indices(g, 1)
                x, y = rows[block[:, i].ravel()], rows[block[:, j].ravel()]
                pairs.append(np.stack([x["k"], y["k"], np.maximum(x["need"], y["need"]), x["band"]], 1).astype(np.int64))
    out = []
    if pairs:
        p = np.concatenate(pairs)
        p, agree = np.unique(p[p[:, 0] != p[:, 1]], axis=0, return_counts=True)
        out.append(pd.DataFrame({"kind": 0, "a": p[:, 0], "b": p[:, 1], "agree": agree, "need": p[:, 2], "band": p[:, 3]}))
    if members:
        m = np.concatenate(members)
        out.append(pd.DataFrame({"kind": 1, "a": m["k"], "b": m["sig"].view(np.int64) if m["sig"].flags.c_contiguous else m["sig"].astype(np.int64), "agree": 1, "need": m["need"].astype(np.int64), "band": m["band"].astype(np.int64)}))
    return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in _FOUND.split(", ")})


def _family_edges(found: DataFrame) -> DataFrame:
    hot = found.where("kind = 1").select(F.col("a").alias("k"), F.col("b").alias("sig"), "need", "band")
    often = hot.groupBy("sig").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("k", "band").orderBy(F.col("n").desc(), "sig"))
    kept = hot.join(often, "sig").withColumn("rank", rank).where("rank >= need").select("sig", "k")
    centre = kept.groupBy("sig").agg(F.min("k").alias("c"))
    stars = kept.join(centre, "sig").where("k <> c").select(F.col("c").alias("a"), F.col("k").alias("b"), F.lit(True).alias("star"))
    count = hot.groupBy("k", "band").agg(F.count("*").alias("h"))
    pairs = found.where("kind = 0").groupBy("a", "b", "band").agg(F.sum("agree").alias("agree"), F.max("need").alias("need"))
    # what two sets share under hot signatures is not counted here
    pairs = pairs.join(count.select(F.col("k").alias("a"), "band", F.col("h").alias("ha")), ["a", "band"], "left").join(count.select(F.col("k").alias("b"), "band", F.col("h").alias("hb")), ["b", "band"], "left")
    zero = F.lit(0)
    pairs = pairs.where(F.col("agree") >= F.greatest(F.lit(1), F.col("need") - F.least(F.coalesce("ha", zero), F.coalesce("hb", zero))))
    return pairs.select("a", "b", F.lit(False).alias("star")).union(stars).distinct()


def _families(described: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes n, f1, f2, rep; what may link a, b, star (a is the centre); families node, root)."""
    spark = described.sparkSession
    key = ["n", "f1", "f2"]
    classes = materialize(described.where("n > 0").groupBy(*key).agg(F.min("k").alias("rep")), "classes")
    total = described.agg(F.coalesce(F.sum("parts"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(partitions(spark), -(-int(total) // BUCKET))
    one = described.where("parts > 0").join(classes.withColumnRenamed("rep", "k"), ["k", *key], "left_semi")  # a class's signatures travel once
    found = (
        one.select("k", "sig", "need", "band")
        .mapInArrow(lambda it: _deal(it, buckets), "bucket long, rows binary, hot binary, members binary")
        .groupBy("bucket").applyInPandas(_candidates, _FOUND)
    )
    edges = materialize(_family_edges(materialize(found, "candidates")), "may_link")
    return classes, edges, connected_components(edges)


def _chunks(docs: Column, shingles: Column) -> Column:
    return F.ceil(F.greatest(docs / TILE_DOCS, shingles / TILE_SHINGLES)).cast("long")


def _numbers(n: Column) -> Column:
    return F.explode(F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>")))


def _first_tiles(classes: DataFrame, edges: DataFrame, families: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(seats k, row, tile, side; stars c, k, n of families too large for a tile; their pairs a, b).  No stars and pairs
    if there is no such family."""
    member = families.join(classes.select(F.col("rep").alias("node"), "n"), "node")
    roots = families.select(F.col("root").alias("node"), "root").distinct().join(classes.select(F.col("rep").alias("node"), "n"), "node")
    m = materialize(member.unionByName(roots).select(F.col("node").alias("k"), F.col("root").alias("f"), "n"), "members")
    size = m.groupBy("f").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles"))
    wide = materialize(size.where((F.col("docs") > TILE_DOCS) | (F.col("shingles") > TILE_SHINGLES)).select("f"), "large_families")
    small = m.join(wide, "f", "left_anti").select("k", F.lit(0).cast("long").alias("row"), F.col("f").cast("string").alias("tile"), F.lit(0).alias("side"))
    if wide.isEmpty():
        return small, None, None
    inside = edges.join(m.join(wide, "f").select(F.col("k").alias("a"), F.col("n").alias("_n")), "a")
    outer = inside.where("star").select(F.col("a").alias("c"), F.col("b").alias("k"))
    centres = inside.where("star").select(F.col("a").alias("c"), F.col("a").alias("k"))
    stars = materialize(outer.union(centres).distinct().join(m.select("k", "n"), "k").select("c", "k", "n"), "stars")
    tile = lambda i: F.concat_ws(":", F.lit("s"), F.col("c").cast("string"), i.cast("string")).alias("tile")
    lead = stars.where("k <> c").withColumn("i", F.row_number().over(Window.partitionBy("k").orderBy("c"))).where(F.col("i") <= LEADS).select("c", "k", "n")
    count = lead.groupBy("c").agg(_chunks(F.count("*"), F.sum("n")).alias("chunks"))
    own = lead.join(count, "c").select("k", F.lit(0).cast("long").alias("row"), tile(F.pmod(F.xxhash64("k"), F.col("chunks"))), F.lit(0).alias("side"))
    centre = count.select("c", _numbers(F.col("chunks")).alias("i")).select(F.col("c").alias("k"), F.expr(f"i div {SEATS}").alias("row"), tile(F.col("i")), F.lit(0).alias("side"))
    return small.union(own).union(centre), stars, inside.where("NOT star").select("a", "b")


def _second_tiles(stars: DataFrame, pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Seats for what the first tiles left open; found: node, root."""
    root = found.select(F.col("node").alias("k"), F.col("root").alias("r"))
    m = stars.join(root, "k", "left").select("c", "k", "n", F.coalesce("r", "k").alias("r"))
    parts = m.groupBy("c", "r").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles"))
    whole = parts.groupBy("c").agg(F.max_by("r", F.struct("docs", "r")).alias("main"), F.count("*").alias("roots"), F.sum("docs").alias("docs"), F.sum("shingles").alias("shingles"), F.max(F.struct("docs", "r", "shingles")).alias("top"))
    other = lambda c: F.col(c) - F.col(f"top.{c}")
    grid = whole.where("roots > 1").select("c", "main", _chunks(F.col("docs"), F.col("shingles")).alias("high"), _chunks(other("docs"), other("shingles")).alias("wide"))
    d = m.join(grid, "c")
    at = lambda n: F.pmod(F.xxhash64("k"), F.col(n))
    tile = lambda i, j: F.concat_ws(":", F.lit("b"), F.col("c").cast("string"), i.cast("string"), j.cast("string")).alias("tile")
    every = d.select("c", "k", at("high").alias("i"), _numbers(F.col("wide")).alias("j")).select("k", F.expr(f"j div {SEATS}").alias("row"), tile(F.col("i"), F.col("j")), F.lit(0).alias("side"))
    rest = d.where("r <> main").select("c", "k", at("wide").alias("j"), _numbers(F.col("high")).alias("i")).select("k", F.expr(f"i div {SEATS}").alias("row"), tile(F.col("i"), F.col("j")), F.lit(1).alias("side"))
    side = lambda k: root.select(F.col("k").alias(k), F.col("r").alias(f"r{k}"))
    p = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b").distinct()
    single = p.select(F.explode(F.array("a", "b")).alias("k"), F.lit(0).cast("long").alias("row"), F.concat_ws(":", F.lit("p"), F.col("a").cast("string"), F.col("b").cast("string")).alias("tile"), F.lit(0).alias("side"))
    return every.union(rest).union(single)


def _links(keyed: DataFrame, seats: DataFrame, n: int, percent: int) -> DataFrame:
    """a, b: links found in the tiles, as (set, smallest set that it is connected with there).  seats: a written table."""
    some = keyed.join(seats.select("k").distinct(), "k", "left_semi")  # ids are few or sorted; only their texts travel
    listed = seats.groupBy("k", "row").agg(F.collect_list(F.struct("tile", "side")).alias("seats"))
    return (
        some.join(listed, "k").select("k", "text", "seats")
        .mapInArrow(lambda it: _seat(it, n), "tile string, side int, k long, set binary")
        .groupBy("tile").applyInPandas(lambda pdf: _link(pdf, percent), "a long, b long")
    )


_SEATED = pa.schema([("tile", pa.string()), ("side", pa.int32()), ("k", pa.int64()), ("set", pa.binary())])


def _seat(batches, n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, off in text_blocks(batch.column(1)):
            sets = shingle_sets(tokenize(data, off, SPACES, lower=True), n)
            rows = [(t["tile"], t["side"], k, s) for k, seats, x in zip(batch.column(0).slice(i, j - i).to_pylist(), batch.column(2).slice(i, j - i).to_pylist(), sets, strict=True) if len(x) for s in [pack(x)] for t in seats]
            total = np.cumsum([len(r[3]) for r in rows]) // BATCH
            for _, part in split_by_bucket(total):
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*[rows[r] for r in part], strict=True), _SEATED, strict=True)], schema=_SEATED)


def _bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """Parity bitmaps: bit (hash mod width) flips for each element, so differing bits never outnumber differing elements."""
    width = 512
    while width < min(16384, 2 * max(len(x) for x in sets)):
        width *= 2
    out = np.zeros((len(sets), width // 64), _U)
    for r, x in enumerate(sets):
        odd = (np.bincount((x & _U(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8)
        out[r] = np.packbits(odd, bitorder="little").view(_U)
    return out


def link_tile(k: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Label of each set within the tile: smallest k it is connected with by links found here."""
    order = np.argsort([len(x) for x in sets], kind="stable")
    k, side, sets = k[order], side[order], [sets[i] for i in order]
    size = np.array([len(x) for x in sets], np.int64)
    bits = _bitmaps(sets)
    two = bool(side.any())
    label = k.copy()
    for i in range(len(sets)):
        top = int(np.searchsorted(size, size[i] * 100 // percent, "right"))
        j = np.arange(i + 1, top)
        j = j[(label[j] != label[i]) & ((side[j] != side[i]) if two else True)]
        if not len(j):
            continue
        both = size[i] + size[j]
        bound = (both - np.bitwise_count(bits[j] ^ bits[i]).sum(1, dtype=np.int64)) // 2
        j = j[100 * bound >= percent * (both - bound)]
        x = sets[i]
        for c in j.tolist():
            if label[c] == label[i]:
                continue
            y = sets[c]
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            common = int(np.count_nonzero(y[at] == x))
            if 100 * common >= percent * (len(x) + len(y) - common):
                low, high = sorted((label[i], label[c]))
                label[label == high] = low
    out = np.empty_like(label)
    out[order] = label
    return out


def _link(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    k = pdf.k.to_numpy()
    label = link_tile(k, pdf.side.to_numpy(), [np.frombuffer(x, _U) for x in pdf.set], percent)
    return pd.DataFrame({"a": k, "b": label})[k != label]


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of `docs`; similarity of percent / 100 or more links."""
    bands = Bands(percent)
    own = F.xxhash64(F.lit("no id"), "text")
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), own).alias("k"), F.isnull("doc_id").alias("nameless"), "text")
    described = materialize(keyed.mapInArrow(lambda it: _describe(it, n, bands), "k long, nameless boolean, n long, f1 long, f2 long, parts long, sig array<long>, need array<short>, band array<short>"), "described")
    classes, edges, families = _families(described)
    seats, stars, pairs = _first_tiles(classes, edges, families)
    seats = materialize(seats, "seats")
    found = connected_components(_links(keyed, seats, n, percent))
    if stars is not None:
        open_seats = materialize(_second_tiles(stars, pairs, found), "open")
        if not open_seats.isEmpty():
            # components of components: links between their roots, then a step from old root to new
            roots = found.select(F.col("node").alias("k"), F.col("root").alias("r"))
            more = _links(keyed, open_seats, n, percent)
            for end in ("a", "b"):
                more = more.join(roots, more[end] == roots["k"], "left").withColumn(end, F.coalesce("r", end)).drop("k", "r")
            joined = connected_components(more)
            further = joined.select(F.col("node").alias("root"), F.col("root").alias("new"))
            found = found.join(further, "root", "left").select("node", F.coalesce("new", "root").alias("root")).union(joined)
    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("n", "f1", "f2", F.coalesce("root", "rep").alias("c"))
    out = described.select("k", "nameless", "n", "f1", "f2").join(named, ["n", "f1", "f2"], "left")
    out = out.select(F.when(~F.col("nameless"), F.col("k")).alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("c", "k").alias("component_id"))
    if described.where("nameless").isEmpty():
        return out
    # a component may be named after a key that is no id
    named = out.groupBy("component_id").agg(F.min("doc_id").alias("name"))
    return out.join(named, "component_id").select("doc_id", "n_shingles", F.col("name").alias("component_id"))


def op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=4, percent=85)


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[x.i:x.i + 3], ' ')) AS g FROM d, unnest(range(1, greatest(2, len(w) - 2))) AS x(i) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id
  JOIN n AS na ON na.doc_id = a.doc_id JOIN n AS nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), e AS (
  SELECT a, b FROM l UNION SELECT b, a FROM l
), r(v, c) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.v WHERE r.c < e.b
), m AS (
  SELECT v, min(c) AS c FROM r GROUP BY v
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.v = d.doc_id
"""
