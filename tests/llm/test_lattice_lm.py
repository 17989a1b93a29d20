"""Lattice likelihoods against sums over all segmentations, one by one."""

import collections
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orrery.llm import lattice_lm

PIECES = [b"\xff" + p for p in (b"", b"a", b"ab", b"the", b"t", "é".encode())] + [b"a", b"b", b"c", b"ab", b"bc", b"abc", b"he", b"h", b"e", b"t", "é".encode(), "é".encode()[:1], "é".encode()[1:]]


def segmentations(word):
    if not word:
        yield ()
    for p in PIECES:
        if word.startswith(p):
            for rest in segmentations(word[len(p) :]):
                yield (p, *rest)


def small():
    weights = np.array([1 / (i + 2) for i in range(len(PIECES))])
    pieces = lattice_lm.index_pieces(PIECES, weights)
    at = {}
    for i, p in enumerate(PIECES):  # where a piece stands after sorting by key
        alone = lattice_lm.lattice(np.frombuffer(p, np.uint8), np.array([len(p)]), pieces)
        at[p] = int(alone.piece[(alone.target - alone.source) == len(p)][0])
        assert math.isclose(math.exp(pieces.start[at[p]]), weights[i] / (weights.sum() + weights.max()))
    return pieces, at


def test_forward_and_expected_uses_against_all_paths():
    pieces, at = small()
    words = ["a", "abc", "the", "ababab", "éa", "cab", "hehe", "thea", "tt"]
    data = [b"\xff" + w.encode() for w in words]
    x = lattice_lm.lattice(np.frombuffer(b"".join(data), np.uint8), np.array([len(d) for d in data]), pieces)
    weight = pieces.start
    alpha = lattice_lm.forward(x, weight)
    counts = np.arange(1.0, len(words) + 1)
    uses = collections.Counter()
    for i, d in enumerate(data):
        paths = [(math.exp(sum(weight[at[p]] for p in s)), s) for s in segmentations(d)]
        total = sum(p for p, _ in paths)
        assert math.isclose(math.exp(alpha[x.last[i]]), total)
        for p, s in paths:
            for piece in s:
                uses[at[piece]] += counts[i] * p / total
    got = lattice_lm.expected(x, weight, alpha, counts, len(weight))
    assert np.allclose(got, [uses[i] for i in range(len(weight))])
    none = lattice_lm.lattice(np.frombuffer(b"\xffz\xffa", np.uint8), np.array([2, 2]), pieces)  # z is in no piece
    end = lattice_lm.forward(none, weight)[none.last]
    assert end[0] == -np.inf and end[1] > -10


def test_vocabulary_covers_every_word():
    names, weights = lattice_lm.read_pieces(lattice_lm.VOCABULARY)
    pieces = lattice_lm.index_pieces(names, weights)
    assert len(set(names)) == len(names) > 30000 and all(bytes([b]) in names for b in range(256))
    words = ["the", "Ω≈ç√", "\U0001f600\U0001f600", "x" * 3000, "日本語", "a▁b"]
    for _, data, length in lattice_lm._word_blocks(pa.array([w.encode() for w in words])):
        x = lattice_lm.lattice(data, length, pieces)
        assert np.isfinite(lattice_lm.forward(x, pieces.start)[x.last]).all()


@pytest.mark.parametrize(("block", "spell"), [(1 << 17, 1 << 12), (40, 1 << 12), (40, 7), (1, 3)])
def test_blocks_of_words_hold_all_their_bytes(monkeypatch, block, spell):
    monkeypatch.setattr(lattice_lm, "BLOCK", block)
    monkeypatch.setattr(lattice_lm, "SPELL", spell)
    words = [b"a", b"the", "é".encode() * 9, b"x" * 5000, b"yz" * 7, b"q"]
    got = [b""] * len(words)
    for row, data, length in lattice_lm._word_blocks(pa.array(words)):
        assert length.max() <= spell + 1 and len(data) == length.sum() and (len(data) <= block or len(length) == 1)
        for r, a, n in zip(row.tolist(), (np.cumsum(length) - length).tolist(), length.tolist(), strict=True):
            got[r] += data[a : a + n].tobytes()
    assert got == [b"\xff" + w for w in words]


def test_a_giant_word_takes_time_in_proportion(spark):
    start = time.time()
    docs = spark.createDataFrame([(1, "the " + "ab" * 300_000), (2, "漢字" * 100_000), (3, "the end")], "doc_id long, text string")
    got = {r.doc_id: r for r in lattice_lm.score(docs, lattice_lm.fit(docs, F.lit(True), rounds=2), ["doc_id"]).collect()}
    assert got[1].n_tokens == 3 and got[2].n_tokens == 2 and all(math.isfinite(r.score) for r in got.values()) and time.time() - start < 120


def documents(seed=2, n=70):
    rng = random.Random(seed)
    syllables = ["th", "er", "ing", "an", "é", "ß", "tion", "q9"]
    vocab = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice([w, w.upper(), w.title()]) for w in rng.choices(vocab, [1 / (k + 1) for k in range(60)], k=rng.randrange(1, 40)))) for i in range(n)]
    return [*rows, (None, "the er an"), (3, rows[3][1]), (1001, None), (1002, ""), (1003, " \t\n"), (1004, "x" * 5000 + " the"), (1005, "the " * 20000), (1006, "a\x0bb c É")]


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


@pytest.mark.parametrize(("dictionary", "held"), [(1 << 20, 1 << 20), (5, 40), (0, 1)])
def test_query(spark, tmp_path, monkeypatch, dictionary, held):
    monkeypatch.setattr(lattice_lm, "HELD", held)
    monkeypatch.setattr(lattice_lm.score, "__defaults__", (dictionary,))
    monkeypatch.setattr(lattice_lm, "BLOCK", 500)
    rows = documents()
    spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, word string, h int, c int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = collections.defaultdict(list)
    for r in lattice_lm.op12_lattice_lm(spark, str(tmp_path)).collect():
        got[r.doc_id].append(r)
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    learned = [words_of(t) for i, t in rows if not out(i)]
    count = collections.Counter(w for ws in learned for w in ws)
    total, types = sum(count.values()) + len(learned), len(count) + 1
    trained = lattice_lm.fit(spark.createDataFrame(rows, "doc_id long, text string").withColumn("learn", ~lattice_lm.held_out()), F.col("learn"))
    pieces = lattice_lm.index_pieces(*lattice_lm.read_pieces(lattice_lm.VOCABULARY))
    m = trained.model
    assert (m.tokens, m.types, m.texts) == (total, types, len(learned))
    assert math.isclose(np.exp(m.weight).sum(), 1)

    def token(w):
        d = b"\xff" + w.encode()
        x = lattice_lm.lattice(np.frombuffer(d, np.uint8), np.array([len(d)]), pieces)
        return math.log10(max(count[w] - m.discount, 0) / total + m.discount * types / total * math.exp(lattice_lm.forward(x, m.weight)[-1]))

    cache = {w: token(w) for w in {w for _, t in rows for w in words_of(t) if len(w) < 1000}}
    end = math.log10((len(learned) - m.discount) / total + m.discount * types / total * math.exp(m.weight[-1]))
    for i, t in rows:
        ws = words_of(t)
        for r in got[i]:
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(i), len(ws) + 1, sum(count[w] > 0 for w in ws) + 1, total)
            assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (total + types + 1)) for w in ws) + math.log10((len(learned) + 1) / (total + types + 1)), rel_tol=1e-9)
            if all(w in cache for w in ws):
                assert math.isclose(r.score, end + sum(cache[w] for w in ws), rel_tol=1e-9)
            assert r.score < 0 and math.isfinite(r.score)
    assert sum(map(len, got.values())) == len(rows)


def test_fitting_raises_the_likelihood_and_probabilities_add_up(spark):
    docs = spark.createDataFrame(documents(), "doc_id long, text string")
    pieces = lattice_lm.index_pieces(*lattice_lm.read_pieces(lattice_lm.VOCABULARY))
    words = [b"\xff" + w.encode() for w in sorted({w for _, t in documents() for w in words_of(t)})]
    x = lattice_lm.lattice(np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words]), pieces)
    fitted = []
    for rounds in (0, 1, 2, 4):
        weight = lattice_lm.fit(docs, F.lit(True), rounds=rounds).model.weight
        fitted.append(lattice_lm.forward(x, weight)[x.last].sum())
    assert fitted == sorted(fitted) and fitted[-1] > fitted[0] + 10
    small_pieces, _ = small()
    weight = small_pieces.start
    # all words of up to 6 letters of an alphabet that the small vocabulary spells
    words = [b"\xff" + "".join(w).encode() for n in range(1, 7) for w in itertools.product("abc", repeat=n)]
    x = lattice_lm.lattice(np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words]), small_pieces)
    assert np.exp(lattice_lm.forward(x, weight)[x.last]).sum() + math.exp(weight[-1]) < 1


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    none = lattice_lm.fit(docs, F.lit(True))
    assert lattice_lm.score(docs, none, ["doc_id"]).collect() == []
    some = spark.createDataFrame([(1, "the er"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in lattice_lm.score(some, lattice_lm.fit(some, F.lit(False)), ["doc_id"]).collect()}
    assert got[1].n_known == 0 and got[1].train_tokens == 0 and got[1].score < got[2].score < 0
