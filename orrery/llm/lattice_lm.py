"""Operator 12: likelihood of texts over subword lattices.

A word (after a mark for its start) is a path through the pieces of an existing
vocabulary; all its segmentations count, so its probability is the sum over all
paths of the product of piece weights, by a forward recursion in log space.  A
word of the training texts is also one piece of its own: one more path, from the
mark to the end.

1. Words are counted over all training texts (tasks add up their own first).
   The count c of a word gives its own path (c - d) / N; the discount d follows
   from the numbers of words seen once and twice.
2. What the discounts leave, d for every distinct word, is for the vocabulary's
   pieces.  Their weights start from the vocabulary's scores and are fitted to
   that mass: each round is a forward and a backward pass over all distinct
   words, and one sum per piece and task goes on.
3. Every distinct word of the corpus gets its log probability once.  Frequent
   words (at most DICTIONARY of them, by a count that their histogram gives) are
   broadcast; the others are joined, as counts per document.
4. A text's score adds up its words and one end.

The vocabularies at hand are those of byte-pair merges, whose scores are ranks
of merges; a rank r starts as a weight proportional to 1 / (r + 10).  Bytes are
pieces, so every text has a probability above 0, and all probabilities add up to
1 at most.

Defined cases: NULL and empty texts have only their end; a NULL doc_id is not
held out; repeated rows count and are scored each by itself; without training
texts only the vocabulary's scores are left (N = 0); of a word longer than SPELL
bytes, the segmentations that cut it at every multiple of SPELL bytes count, so
memory and time stay in proportion.  Words are looked up by 64-bit hashes.  Other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialize
from ._text import _BYTE, _LOWER, _ODD, SPACES, _power_tables, text_blocks, tokenize

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ROUNDS = 4
#: Bytes of words in a block of lattices, and of a word that are spelled at a time.
BLOCK, SPELL = 1 << 17, 1 << 12
#: Most words in the broadcast dictionary (24 bytes each), and distinct words that a task holds.
DICTIONARY = 1 << 20
HELD = 1 << 20
#: Stands for the start of a word; no byte of UTF-8.
MARK = 0xFF
_LN10 = math.log(10)


def _ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (length[i] numbers) for each i, in one array."""
    return np.repeat(first - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


# --- the vocabulary ------------------------------------------------------------------------------------------------


def _keys(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(running sums, inverse powers): the key of data[s:e] is (sums[e] - sums[s]) * inverse[s] + e - s."""
    power, inverse = _power_tables(_ODD, len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=total[1:])
    return total, inverse


@dataclass
class Pieces:
    """Piece i has key[i] (sorted) and length[i]; lengths: those that occur; seen: a filter by the keys' first 20 bits."""

    key: np.ndarray
    length: np.ndarray
    start: np.ndarray

    def __post_init__(self):
        self.lengths = np.unique(self.length).tolist()
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.key >> np.uint64(44)).astype(np.int64)] = True

    @property
    def end(self) -> int:
        """The number of the text's end, which is one more piece."""
        return len(self.key)


def read_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """(pieces, their starting weights) of a sentencepiece model; a byte without a piece comes last."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranks: dict[bytes, float] = {}
    last = model.get_piece_size()
    for i in range(last):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        text, score = model.id_to_piece(i), model.get_score(i)
        piece = b"".join(bytes([MARK]) if c == "▁" else c.encode() for c in text)
        if MARK not in piece[1:]:  # pieces of several marks are in no word
            ranks[piece] = min(-score, last)
    for b in range(256):
        ranks.setdefault(bytes([b]), last)
    weights = 1 / (np.array(list(ranks.values())) + 10)
    return list(ranks), weights


def index_pieces(pieces: list[bytes], weights: np.ndarray) -> Pieces:
    data = np.frombuffer(b"".join(pieces), np.uint8)
    length = np.array([len(p) for p in pieces])
    total, inverse = _keys(data)
    at = np.cumsum(length) - length
    key = (total[at + length] - total[at]) * inverse[at] + length.astype(np.uint64)
    order = np.argsort(key)
    start = np.append(weights[order], weights.max())  # the end starts like the most frequent piece
    return Pieces(key[order], length[order], np.log(start / start.sum()))


# --- lattices ------------------------------------------------------------------------------------------------------


@dataclass
class Lattice:
    """Edges of the lattices of many words, by the distance of their end from the word's start.

    Word i has nodes first[i] .. last[i]; edge e goes from source[e] to target[e] with piece[e]; edges of one target
    stand together, from `run`; level k has runs cut[k] .. cut[k + 1]."""

    first: np.ndarray
    last: np.ndarray
    source: np.ndarray
    target: np.ndarray
    piece: np.ndarray
    run: np.ndarray
    cut: np.ndarray


def lattice(data: np.ndarray, length: np.ndarray, pieces: Pieces) -> Lattice:
    """Of words that stand one after the other in `data`, each beginning with MARK."""
    end = np.cumsum(length)
    start = end - length
    word = np.repeat(np.arange(len(length)), length)
    rest = np.repeat(end, length) - np.arange(len(data))
    total, inverse = _keys(data)
    sources, sizes, ids = [], [], []
    at = np.arange(len(data))
    for k in pieces.lengths:
        at = at[rest[at] >= k]
        if not len(at):
            break
        key = (total[at + k] - total[at]) * inverse[at] + np.uint64(k)
        maybe = np.flatnonzero(pieces.seen[(key >> np.uint64(44)).astype(np.int64)])
        found = np.minimum(np.searchsorted(pieces.key, key[maybe]), len(pieces.key) - 1)
        hit = pieces.key[found] == key[maybe]
        sources.append(at[maybe[hit]])
        ids.append(found[hit])
        sizes.append(np.full(int(hit.sum()), k))
    source, size, piece = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sources, sizes, ids))
    level = source + size - start[word[source]]
    target = source + size + word[source]  # node numbers: one more per word than bytes
    order = np.lexsort((target, level))
    source, level, target, piece = (source + word[source])[order], level[order], target[order], piece[order]
    run = np.flatnonzero(np.append(True, target[1:] != target[:-1])) if len(target) else np.zeros(0, np.int64)
    cut = np.searchsorted(level[run], np.arange(1, (level[-1] if len(level) else 0) + 2))
    first = start + np.arange(len(length))
    return Lattice(first, first + length, source, target, piece, run, cut)


def _levels(x: Lattice) -> Iterator[tuple[slice, np.ndarray]]:
    """(edges, their runs' starts among them) of each level, nearest first."""
    ends = np.append(x.run, len(x.target))
    for a, b in zip(x.cut[:-1].tolist(), x.cut[1:].tolist(), strict=True):
        if b > a:
            yield slice(int(ends[a]), int(ends[b])), x.run[a:b] - ends[a]


def forward(x: Lattice, weight: np.ndarray) -> np.ndarray:
    """Log of the summed products of weights over all paths from a word's start to each node."""
    alpha = np.full(int(x.last[-1]) + 1 if len(x.last) else 0, -np.inf)
    alpha[x.first] = 0
    for edges, runs in _levels(x):
        value = alpha[x.source[edges]] + weight[x.piece[edges]]
        most = np.maximum.reduceat(value, runs)
        safe = np.where(np.isfinite(most), most, 0)
        total = np.add.reduceat(np.exp(value - np.repeat(safe, np.diff(np.append(runs, len(value))))), runs)
        with np.errstate(divide="ignore"):
            alpha[x.target[edges][runs]] = safe + np.log(total)
    return alpha


def expected(x: Lattice, weight: np.ndarray, alpha: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """How often each piece is used, over all paths in proportion to their probability; a word counts count[i] times."""
    share = np.zeros(len(alpha))
    share[x.last] = count
    out = np.zeros(size)
    for edges, _ in reversed(list(_levels(x))):
        source, target, piece = x.source[edges], x.target[edges], x.piece[edges]
        with np.errstate(invalid="ignore"):
            part = np.nan_to_num(np.exp(alpha[source] + weight[piece] - alpha[target])) * share[target]
        np.add.at(share, source, part)
        out += np.bincount(piece, part, size)
    return out


def _word_blocks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, bytes, lengths) of spelled parts of words: a word after its mark, or SPELL bytes of a longer one at a time.

    A block has about BLOCK bytes (a lattice takes some hundred bytes for each), so a row's parts may lie in several."""
    for i, j, data, off in text_blocks(column):
        parts = np.maximum(1, -(-np.diff(off) // SPELL))
        row = np.repeat(np.arange(j - i), parts)
        k = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = off[row] + k * SPELL
        length = np.minimum(off[row + 1], start + SPELL) - start
        total = np.cumsum(length + (k == 0))
        a = 0
        while a < len(row):
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + BLOCK, "right")))
            marked = k[a:b] == 0
            size = length[a:b] + marked
            out = np.empty(int(size.sum()), np.uint8)
            inside = np.ones(len(out), bool)
            inside[(np.cumsum(size) - size)[marked]] = False
            out[~inside] = MARK
            out[inside] = data[start[a] : start[b - 1] + length[b - 1]]
            yield i + row[a:b], out, size
            a = b


# --- counting, fitting and scoring ---------------------------------------------------------------------------------

_COUNTED = pa.schema([("h", pa.int64()), ("word", pa.binary()), ("c", pa.int64()), ("n", pa.int64())])


class _Counter:
    """Distinct words of a task: hash, training count, count, and their bytes."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.parts, self.size = [], 0

    def add(self, h, c, n, data, length):
        self.parts.append((h, c, n, data, length))
        self.size += len(h)

    def compact(self):
        h, c, n, data, length = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        own, at, which = np.unique(h, return_index=True, return_inverse=True)
        begin = np.cumsum(length) - length
        data = data[_ranges(begin[at], length[at])]
        self.clear()
        self.add(own, np.bincount(which, c).astype(np.int64), np.bincount(which, n).astype(np.int64), data, length[at])

    def batch(self) -> pa.RecordBatch:
        h, c, n, data, length = self.parts[0]
        offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(h), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), words, pa.array(c), pa.array(n)], schema=_COUNTED)


def _count(batches) -> Iterator[pa.RecordBatch]:
    """(learn boolean, text) -> words with their counts; a word comes once per task, unless it has very many."""
    counter = _Counter()
    for batch in batches:
        learn = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
        for i, j, data, off in text_blocks(batch.column(1)):
            words = tokenize(data, off, SPACES, lower=True)
            if not len(words.hash):
                continue
            own, at, which = np.unique(words.hash, return_index=True, return_inverse=True)
            length = words.end[at] - words.start[at]
            used = np.repeat(learn[i:j], words.counts())
            counter.add(own, np.bincount(which, used).astype(np.int64), np.bincount(which), _LOWER[data[_ranges(words.start[at], length)]], length)
            if counter.size > HELD or sum(len(p[3]) for p in counter.parts) > 32 * HELD:
                counter.compact()
                if counter.size > HELD // 2 or len(counter.parts[0][3]) > 16 * HELD:
                    yield counter.batch()
                    counter.clear()
    if counter.parts:
        counter.compact()
        yield counter.batch()


def _expect(batches, shared) -> Iterator[pa.RecordBatch]:
    """Words -> expected uses of each piece, one sum per task."""
    pieces, weight = shared.value
    total = np.zeros(len(weight))
    for batch in batches:
        for _, data, length in _word_blocks(batch.column(0)):
            x = lattice(data, length, pieces)
            total += expected(x, weight, forward(x, weight), np.ones(len(length)), len(weight))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["piece", "uses"])


def _word_scores(batches, shared, model) -> Iterator[pa.RecordBatch]:
    """(h, word, c, n) -> (h, c, n, lp): log10 of a word's probability."""
    pieces, weight = shared.value
    for batch in batches:
        ln = np.zeros(batch.num_rows)
        for row, data, length in _word_blocks(batch.column(1)):
            x = lattice(data, length, pieces)
            np.add.at(ln, row, forward(x, weight)[x.last])
        yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in (0, 2, 3)], pa.array(model.log10(ln, batch.column(2).to_numpy()))], names=["h", "c", "n", "lp"])


@dataclass
class Model:
    """tokens N, types V (both with the end), texts (uses of the end), discount d; weights of the pieces and the end."""

    tokens: int
    types: int
    texts: int
    discount: float
    weight: np.ndarray

    def log10(self, lattice_ln: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 of (c - d) / N + d V / N * (the lattice's probability)."""
        if not self.tokens:
            return lattice_ln / _LN10
        with np.errstate(divide="ignore"):
            own = np.log(np.maximum(count - self.discount, 0) / self.tokens)
        return np.logaddexp(own, math.log(self.discount * self.types / self.tokens) + lattice_ln) / _LN10

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.tokens + self.types + 1))


@dataclass
class Trained:
    model: Model
    words: DataFrame  # h, c, n, lp of every distinct word


def fit(docs: DataFrame, learn, path: str = VOCABULARY, rounds: int = ROUNDS) -> Trained:
    """Counts the words of all texts of `docs` and fits the model to those where the boolean column `learn` holds."""
    spark = docs.sparkSession
    pieces = index_pieces(*read_pieces(path))
    texts = docs.where(learn).count()
    kind = "h long, word binary, c long, n long"
    words = materialize(docs.select(learn.alias("learn"), "text").mapInArrow(_count, kind).groupBy("h", "word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "words")
    known = F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), *[F.count_if(c).alias(a) for c, a in ((F.col("c") > 0, "types"), (F.col("c") == 1, "once"), (F.col("c") == 2, "twice"))]
    s = words.agg(*known).first()
    discount = (s["once"] + 1) / (s["once"] + 2 * s["twice"] + 2)
    model = Model(s["tokens"] + texts, s["types"] + (texts > 0), texts, discount, pieces.start)
    for _ in range(rounds if s["types"] else 0):
        shared = spark.sparkContext.broadcast((pieces, model.weight))
        uses = words.where("c > 0").select("word").mapInArrow(lambda it, shared=shared: _expect(it, shared), "piece int, uses double")
        got = uses.groupBy("piece").agg(F.sum("uses").alias("uses")).toArrow()
        total = np.full(len(model.weight), 1e-2)
        total[got.column("piece").to_numpy()] += got.column("uses").to_numpy()
        total[pieces.end] += 1
        model.weight = np.log(total / total.sum())
        shared.destroy()
    shared = spark.sparkContext.broadcast((pieces, model.weight))
    return Trained(model, materialize(words.mapInArrow(lambda it: _word_scores(it, shared, model), "h long, c long, n long, lp double"), "word_scores"))


def _frequent(words: DataFrame, most: int) -> tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(smallest count, (sorted hashes, training counts, lp)) of the most frequent words, at most `most`."""
    class_ = F.floor(F.log2("n") * 8).cast("int")
    sizes = sorted(((r["k"], r["size"], r["least"]) for r in words.groupBy(class_.alias("k")).agg(F.count("*").alias("size"), F.min("n").alias("least")).collect()), reverse=True)
    total, least = 0, 1 << 62
    for _, size, low in sizes:
        if total + size > most:
            break
        total, least = total + size, low
    got = words.where(F.col("n") >= least).select("h", "c", "lp").toArrow()
    h = got.column("h").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(h)
    return least, (h[order], *[got.column(c).to_numpy()[order] for c in ("c", "lp")])


def _add_up(batches, model, shared, end_lp: float) -> Iterator[pa.RecordBatch]:
    """Documents -> sums over their end and frequent words, and their other words with their times."""
    h, c, lp = shared.value
    base = model.base(c)
    for batch in batches:
        for i, j, data, off in text_blocks(batch.column(batch.num_columns - 1)):
            words = tokenize(data, off, SPACES, lower=True)
            docs, doc = j - i, words.doc()
            pos = np.minimum(np.searchsorted(h, words.hash), max(len(h) - 1, 0))
            hit = h[pos] == words.hash if len(h) else np.zeros(len(words.hash), bool)
            pos, whose = pos[hit], doc[hit]
            known = np.bincount(whose, c[pos] > 0, docs).astype(np.int64) + (model.texts > 0)
            sums = [np.bincount(whose, x[pos], docs) + e for x, e in ((base, float(model.base(np.array(model.texts)))), (lp, end_lp))]
            rest, at = words.hash[~hit], doc[~hit]
            order = np.lexsort((rest, at))
            rest, at = rest[order], at[order]
            new = np.flatnonzero(np.append(True, (rest[1:] != rest[:-1]) | (at[1:] != at[:-1]))) if len(rest) else np.zeros(0, np.int64)
            times = np.diff(np.append(new, len(rest)))
            cuts = pa.array(np.searchsorted(at[new], np.arange(docs + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (rest[new].view(np.int64), times.astype(np.int64))]
            own = [batch.column(k).slice(i, docs) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(words.counts() + 1, pa.int64()), pa.array(known), *[pa.array(x) for x in sums], *lists],
                names=[*batch.schema.names[:-1], "n_tokens", "n_known", "base_score", "score", "_rest", "_times"],
            )


def score(docs: DataFrame, trained: Trained, columns: list[str], dictionary: int = DICTIONARY) -> DataFrame:
    """The named columns, n_tokens, n_known, train_tokens, base_score and score, a row per row of `docs`."""
    model, words = trained.model, trained.words
    least, frequent = _frequent(words, dictionary)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    end_lp = float(model.log10(model.weight[-1:], np.array([model.texts]))[0])
    kept = docs.select(*columns, "text")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + ["n_tokens long, n_known long, base_score double, score double, _rest array<long>, _times array<long>"])
    sums = kept.mapInArrow(lambda it: _add_up(it, model, shared, end_lp), schema)
    sums = materialize(sums.withColumn("_row", F.monotonically_increasing_id()), "sums")
    each = sums.select("_row", F.explode(F.arrays_zip("_rest", "_times")).alias("x")).select("_row", F.col("x._rest").alias("h"), F.col("x._times").alias("t"))
    one = F.log10((F.col("c") + 1) / F.lit(float(model.tokens + model.types + 1)))
    rare = each.join(words.where(F.col("n") < least), "h").groupBy("_row").agg(F.sum(F.col("t") * (F.col("c") > 0).cast("long")).alias("_k"), F.sum(F.col("t") * one).alias("_b"), F.sum(F.col("t") * F.col("lp")).alias("_s"))
    plus = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    joined = sums.drop("_rest", "_times").join(rare, "_row", "left")
    return joined.select(*columns, "n_tokens", plus("n_known", "_k"), F.lit(model.tokens).cast("long").alias("train_tokens"), plus("base_score", "_b"), plus("score", "_s"))


def op12_lattice_lm(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", held_out().alias("held_out"), "text")
    return score(docs, fit(docs, ~F.col("held_out")), ["doc_id", "held_out"])
