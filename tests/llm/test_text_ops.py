"""Word-based operators against brute force on small, awkward tables."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orrery.llm import decontaminate, jaccard_join, mixing, substring_dedup
from orrery.llm._text import PUNCTUATION, SPACES, grams, sliding_min, text_blocks, tokenize

WORDS = "the of and zu ein été señor x1 42 don't A-b Über 漢字 \U0001f600 qu'il".split()


def make_docs(seed=1, n=120):
    rng = random.Random(seed)
    passage = " ".join(rng.choice(WORDS) + str(i) for i in range(45))
    docs = []
    for i in range(n):
        words = [rng.choice(WORDS) + (str(rng.randrange(60)) if rng.random() < 0.8 else "") for _ in range(rng.choice((0, 1, 3, 5, 19, 20, 21, 60, 150)))]
        text = "".join(w + rng.choice((" ", "\n", "\t", "  ", "  ")) for w in words)
        if i % 5 == 0:
            text += " " + passage
        docs.append((i, text))
    docs += [(1000 + i, docs[i][1]) for i in range(0, n, 3)]  # exact copies
    for i in range(0, n, 4):  # near copies
        w = docs[i][1].split(" ")
        if len(w) > 30:
            w[rng.randrange(len(w))] = "changed"
        docs.append((2000 + i, " ".join(w).upper() if i % 8 == 0 else " ".join(w)))
    long = [rng.choice(WORDS) + str(rng.randrange(5000)) for _ in range(30000)]
    docs += [(3000, None), (3001, ""), (3002, " \n\t "), (3003, "a " * 70), (3004, "  "), (3005, " ".join(long)), (3006, " ".join(long[:20000])), (3007, "x" * 300000 + " y")]
    return docs


def frame(spark, rows):
    """Extra columns with names that operators use inside, NULLs, a repeated row and a NULL id."""
    rows = [*rows, rows[0], (None, rows[0][1])]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return d.withColumns({c: F.lit(None).cast("string") for c in ("k", "_k", "_h", "n", "c0", "spans", "found", "size", "bucket", "tile", "set", "copies")})


def ascii_words(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_tokenizer_against_regex():
    import pyarrow as pa

    rows = [t for _, t in make_docs()]
    for sep, pattern, lower in ((SPACES, r"[^\x20\x09-\x0D]+", False), (PUNCTUATION, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)):
        for i, j, data, off in text_blocks(pa.array(rows, pa.string())):
            w = tokenize(data, off, sep, lower)
            raw = data.tobytes()
            for r in range(i, j):
                low = re.sub("[A-Z]", lambda m: m[0].lower(), rows[r] or "") if lower else rows[r] or ""
                got = [raw[a:b].decode() for a, b in zip(w.start[w.ptr[r - i] : w.ptr[r - i + 1]], w.end[w.ptr[r - i] : w.ptr[r - i + 1]], strict=True)]
                assert [x.lower() if lower and x.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), x) if lower else x for x in got] == re.findall(pattern, low)


def test_grams_and_sliding_min():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 500, dtype=np.uint64)
    h[100:120] = h[300:320]
    g = grams(h, 20)
    assert g[100] == g[300] and len(np.unique(g)) == len(g) - 1
    for width in (1, 2, 3, 7, 16, 17):
        assert (sliding_min(h, width) == [h[i : i + width].min() for i in range(len(h) - width + 1)]).all()


def brute_removed(rows, window=20):
    seen, out = set(), {}
    for key in sorted(rows, key=lambda k: (k[0] is not None, k[0])):
        w = ascii_words(rows[key])
        gone = set()
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            if g in seen:
                gone.update(range(i, i + window))
            seen.add(g)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[key[0]] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substring_dedup(spark, monkeypatch):
    rows = make_docs()
    want = brute_removed({(d, "t"): t for d, t in [*rows, (None, rows[0][1])]})
    got = substring_dedup.substring_dedup(frame(spark, rows)).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id], r.doc_id
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_substring_dedup_small_groups_and_empty(spark):
    rows = make_docs(seed=7, n=60)
    want = brute_removed({(d, "t"): t for d, t in rows}, window=5)
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), window=5, prefix=2, digest_only=True)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()} == want
    assert substring_dedup.substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def spans_of_hands(rows, window, prefix, buckets):
    """The operator's steps in this process: removed words by document."""
    import pandas as pd
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([0] * len(rows)), pa.array([t for _, t in rows])], names=["_k", "_h", "text"])
    runs = [r for b in substring_dedup._anchor_runs([batch], window, prefix) for r in b.to_pylist()]
    count = {}
    for r in runs:
        for x, n in zip(r["anchor"], r["times"], strict=True):
            count[x] = count.get(x, 0) + n
    lists = {r["_k"]: [x for x in r["anchor"] if count[x] > 1] for r in runs}
    some = [(i, t, lists[i]) for i, t in rows if lists.get(i)]
    asked = pa.RecordBatch.from_arrays(
        [pa.array([i for i, _, _ in some]), pa.array([0] * len(some)), pa.array([t for _, t, _ in some]), pa.array([x for _, _, x in some], pa.list_(pa.int64())), pa.array([[count[y] for y in x] for _, _, x in some], pa.list_(pa.int64()))],
        names=list("abcde"),
    )
    packed = pd.concat([b.to_pandas() for b in substring_dedup._windows([asked], window, prefix, buckets)])
    gone = {i: set() for i, _ in rows}
    for _, group in packed.groupby("bucket"):
        for r in substring_dedup._repeats(group.drop(columns="bucket").assign(bucket=0)[packed.columns], window).itertuples():
            gone[r[1]].update(range(r.s, r.e))
    return gone


@pytest.mark.parametrize(("flush", "values"), [(1 << 19, None), (1, None), (500, 3), (1 << 19, 1)])
def test_suffixes_are_told_apart_by_their_words(monkeypatch, flush, values):
    real = substring_dedup.grams
    if values:  # hashes of several words collide
        monkeypatch.setattr(substring_dedup, "grams", lambda h, n: real(h, n) % np.uint64(values))
    monkeypatch.setattr(substring_dedup, "FLUSH", flush)
    rows = [(i, t) for i, t in make_docs(seed=5, n=40) if t and len(t) < 100000]
    want = brute_removed({(i, "t"): t for i, t in rows}, window=6)
    got = spans_of_hands(rows, 6, 2, 5)
    assert {i: len(g) for i, g in got.items()} == {i: w[1] for i, w in want.items()}


def test_suffix_tree_against_sorting():
    rng = np.random.default_rng(2)
    for top in (2, 300, 2**31):
        word = rng.integers(0, top, 400).astype(np.uint32)
        word[200:260] = word[20:80]
        at = np.arange(381)
        order, lcp = substring_dedup.suffix_tree(word, at, at, 20)
        path = [tuple(word[i : i + 20]) for i in at]
        assert order.tolist() == sorted(at.tolist(), key=lambda i: (path[i], i))
        for n, (a, b) in enumerate(itertools.pairwise(order)):
            assert lcp[n + 1] == next((c for c in range(20) if path[a][c] != path[b][c]), 20)


def test_substring_dedup_keeps_repeated_rows_that_occur_nowhere_else(spark):
    only, anonymous, other = (" ".join(f"{name}{i}" for i in range(60)) for name in ("only", "anonymous", "other"))
    rows = [(7, only)] * 3 + [(None, anonymous)] * 3 + [(8, other)] * 2 + [(9, other + " end")] * 2 + [(10, anonymous)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.substring_dedup(d).collect())
    assert got == [(0, 60, 0, anonymous)] * 3 + [(7, 60, 0, only)] * 3 + [(8, 60, 0, other)] * 2 + [(9, 61, 60, "end")] * 2 + [(10, 60, 60, "")]


def test_substring_dedup_of_thousands_of_equal_rows(spark, monkeypatch):
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(400))
    monkeypatch.setattr(substring_dedup, "COPIES", 700)
    d = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    more = spark.createDataFrame([(4, "new " + text), (4, "new " + text), (5, text + " one"), (6, text)], "doc_id long, text string")
    start = time.time()
    got = substring_dedup.substring_dedup(d.unionByName(more), digest_only=True).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed, r["count"]) for r in got) == [(0, 400, 0, 20_000), (4, 401, 400, 2), (5, 401, 400, 1), (6, 400, 400, 1)]
    assert time.time() - start < 150


def brute_components(rows, n, percent):
    sets = {}
    for d, t in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in ascii_words(t)]
        sets[d] = frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_jaccard_components(spark, n, percent):
    rows = make_docs(seed=3)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    for k in range(60):  # a family around the threshold
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"n{k}_{rng.randrange(99)}"
        rows.append((5000 + k, " ".join(w[: rng.randrange(70, 91)])))
    want = brute_components(rows, n, percent)
    got = jaccard_join.jaccard_components(frame(spark, rows), n, percent).collect()
    null = [r for r in got if r.doc_id is None]
    # the NULL row is a copy of the first document
    assert len(got) == len(rows) + 2 and null[0].component_id == want[rows[0][0]][1]
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r.doc_id


def test_jaccard_rows_without_ids_are_linked_by_their_texts(spark):
    text = lambda k: " ".join(f"w{k}_{i}" for i in range(30))
    rows = [(None, text(k)) for k in range(60)] + [(None, text(0)), (5, text(1) + " end"), (6, text(2)), (7, "end " + text(2)), (None, text(3) + " end"), (None, None), (None, ""), (42, None)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 4, 85).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == sorted([(5, 5), (6, 6), (7, 6), (42, 42), (0, 5), (0, 6)] + [(0, 0)] * 62)


def test_members_of_hot_signatures_are_spread_over_buckets(monkeypatch):
    rng = np.random.default_rng(1)
    shared = rng.integers(1, 2**62, 20)
    load = np.zeros(200, np.int64)
    for task in range(8):
        k = np.repeat(np.arange(task * 4000, (task + 1) * 4000), 20)
        sig = np.tile(shared, 4000)
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, len(k) + 1, 20), pa.int32()), pa.array(x)) for x in (sig, np.ones(len(sig), np.int16), np.zeros(len(sig), np.int16))]
        monkeypatch.setattr(jaccard_join, "CHUNK", 1 << 7)
        for out in jaccard_join._deal(iter([pa.RecordBatch.from_arrays([pa.array(k[::20]), *lists], names=["k", "sig", "need", "band"])]), len(load)):
            for bucket, members in zip(out.column("bucket").to_pylist(), out.column("members").to_pylist(), strict=True):
                load[bucket] += len(members) // jaccard_join._ROW.itemsize
    assert load.sum() == 640_000 and load.max() < 2 * load.mean()


def test_jaccard_tiles_of_large_families(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(300):
        w = base[: rng.randrange(60, 121)]
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(50)}"
        rows.append((k, " ".join(w)))
    monkeypatch.setattr(jaccard_join, "TILE_DOCS", 16)
    want = brute_components(rows, 3, 85)
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert jaccard_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_stars_of_several_groups(spark, monkeypatch, seed):
    rng = random.Random(seed)
    groups = [[f"g{g}_{i}" if i > 25 else f"shared{i}" for i in range(70)] for g in range(5)]
    rows = []
    for k in range(400):
        w = list(groups[rng.randrange(5)])
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(9)}"
        rows.append((k, " ".join(w[: rng.randrange(60, 71)])))
    rows += [(1000 + k, " ".join([f"shared{i}" for i in range(26)] + [f"own{k}_{i}" for i in range(rng.randrange(3, 20))])) for k in range(120)]
    monkeypatch.setattr(jaccard_join, "TILE_DOCS", 24)
    monkeypatch.setattr(jaccard_join, "SEATS", 3)
    want = brute_components(rows, 2, 80)
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 2, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_seats_grow_with_the_documents_of_a_large_family(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE_DOCS", 16)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    seats = {}
    for n in (600, 2400):
        rows = []
        for k in range(n):
            w = list(base)
            for _ in range(3):
                w[rng.randrange(len(w))] = f"n{k}_{rng.randrange(10**6)}"
            rows.append((k, " ".join(w)))
        d = spark.createDataFrame(rows, "doc_id long, text string")
        bands = jaccard_join.Bands(80)
        keyed = d.selectExpr("doc_id AS k", "false AS nameless", "text")
        described = keyed.mapInArrow(lambda it, bands=bands: jaccard_join._describe(it, 3, bands), "k long, nameless boolean, n long, f1 long, f2 long, parts long, sig array<long>, need array<short>, band array<short>")
        classes, edges, families = jaccard_join._families(described)
        first, stars, pairs = jaccard_join._first_tiles(classes, edges, families)
        found = jaccard_join.connected_components(jaccard_join._links(keyed, first, 3, 80))
        seats[n] = first.count() + jaccard_join._second_tiles(stars, pairs, found).count()
    assert seats[2400] < 6 * seats[600] and seats[2400] < 40 * 2400


def test_need_of_very_large_sets_fits():
    for percent in (60, 80, 85):
        bands = jaccard_join.Bands(percent)
        for n in (1, 50, 3000, 10**7):
            assert all(bands.edges[b] <= n * percent / 100 + 1 or b == bands.home(n) for b in bands.schemes(n))
            assert bands.home(max(1, -(-n * percent // 100))) in bands.schemes(n)
    x = np.sort(np.random.default_rng(1).integers(0, 2**63, 3_000_000, dtype=np.uint64))
    sigs, needs, homes = jaccard_join.signatures([x], jaccard_join.Bands(80))
    assert len(sigs[0]) == len(needs[0]) == len(homes[0]) and 1 <= needs[0].min() <= needs[0].max() <= jaccard_join.MOST_NEED


def test_components(spark):
    from orrery.llm.components import connected_components

    rng = random.Random(3)
    cases = [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 200)], [(rng.randrange(80), rng.randrange(80)) for _ in range(50)], [(5, 5), (2, 1), (1, 2), (1, 2)], [(-(2**63), 2**63 - 1), (7, 2**63 - 1)]]
    for edges in cases:
        parent = {x: x for e in edges for x in e}

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        got = connected_components(spark.createDataFrame([*edges, (None, 1)], "a long, b long"))
        assert {r.node: r.root for r in got.collect()} == {x: find(x) for x in parent if find(x) != x}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_hits(rows, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[s : s + window]), set()).add(i)
    out = {}
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in wins}:
            for s in range(len(w) - size + 1):
                ids = wins.get(tuple(w[s : s + size]))
                if ids:
                    hit.update(range(s, s + size))
                    found |= ids
        ids = sorted(str(x) for x in found if x is not None)
        out[d] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize(("bits", "places"), [(27, 1 << 17), (6, 3)])
def test_decontaminate(spark, monkeypatch, bits, places):
    monkeypatch.setattr(decontaminate, "PLACES", places)
    rows = make_docs(seed=4)
    words = [t.split() for _, t in rows if t and len(t.split()) > 40][:6]
    items = [(i, " ".join(w[3 : 3 + 13 + i])) for i, w in enumerate(words)] + [(20, "the"), (21, "Ein, zu"), (22, None), (23, "..."), (24, " ".join(words[0][3:16])), (None, " ".join(words[1][:15]))]
    want = brute_hits([*rows, (None, rows[0][1])], items)
    d = decontaminate.decontaminate(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), max_bits=bits)
    for r in d.collect():
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want[r.doc_id], r.doc_id
    kept = decontaminate.drop_contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), max_bits=bits)
    assert kept.columns == frame(spark, rows).columns
    assert {r.doc_id for r in kept.collect()} == {k for k, v in want.items() if not v[4]}
    spans = decontaminate.decontaminate(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), max_bits=bits, with_spans=True)
    assert all(x.n_hit == len({i for a, b in zip(x.begin or [], x.end or [], strict=True) for i in range(a, b)}) and x.n_items == len(x["items"]) for x in spans.collect())
    none = decontaminate.decontaminate(frame(spark, rows), spark.createDataFrame([], "item_id long, text string"))
    assert none.where("contaminated OR n_hit > 0").count() == 0


def test_decontaminate_repeated_and_giant_items(spark):
    rng = random.Random(12)
    giant = [f"g{rng.randrange(400)}" for _ in range(5000)]
    rows = [(0, " ".join(giant[100:160])), (1, " ".join(giant[4960:])), (2, "plain words only"), (3, "x " + " ".join(giant[511:530]) + " y"), (4, " ".join(giant))]
    items = [(7, " ".join(giant[200:230]))] * 20000 + [(8, " ".join(giant)), (8, " ".join(giant)), (9, " ".join(giant[200:230]))]
    want = brute_hits(rows, set(items))
    got = decontaminate.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), max_bits=12).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == want


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        left, free = total - sum(capped.values()), [s for s in order if s not in capped]
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if target[s] > 3 * sizes[s]]
        if not over:
            return capped | target
        capped |= {s: 3 * sizes[s] for s in over}


def test_mixing(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, rng.choice(["a", "b", "é", "\U0001f600", "zz", None, "tiny"] if i % 40 == 0 else ["a", "b", "zz"]), "w " * rng.choice((0, 1, 2, 7, 30, 31, 200))) for i in range(700)]
    rows += [(900, None, None), (901, "a", ""), (None, "b", "x y"), (5, rows[5][1], rows[5][2])]
    monkeypatch.setattr(mixing, "RANKED", 20)
    d = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumns({c: F.lit(1) for c in ("size", "bucket", "target", "extra", "h")})
    got = mixing.mix_sources(d).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
    want = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s, t in want.items():
        assert 0 <= t - taken[s] < 2, (s, t, taken[s])  # lengths of one word are left in every source here
    again = mixing.mix_sources(d.repartition(3)).collect()
    assert sorted((r.doc_id or -1, r["size"], r.taken) for r in got) == sorted((r.doc_id or -1, r["size"], r.taken) for r in again)
    assert mixing.mix_sources(d.limit(0)).count() == 0


def test_knapsack_against_all_subsets():
    rng = random.Random(2)
    for _ in range(200):
        lengths = rng.sample(range(1, 40), 4)
        counts = [rng.randrange(0, 4) for _ in lengths]
        budget = rng.randrange(0, 120)
        best = max(sum(a * b for a, b in zip(lengths, x, strict=True)) for x in itertools.product(*[range(c + 1) for c in counts]) if sum(a * b for a, b in zip(lengths, x, strict=True)) <= budget)
        got = mixing.knapsack(lengths, counts, budget)
        assert all(g <= c for g, c in zip(got, counts, strict=True)) and sum(a * b for a, b in zip(lengths, got, strict=True)) == best


def best_sum(lengths, counts, budget):
    sums = {0}
    for a, c in zip(lengths, counts, strict=True):
        sums = {s + a * k for s in sums for k in range(c + 1) if s + a * k <= budget}
    return max(sums)


@pytest.mark.parametrize("first", [1, 8, 1 << 14])
def test_budgets_are_filled_as_well_as_any_choice_can(monkeypatch, first):
    monkeypatch.setattr(mixing, "FIRST_BUDGET", first)
    rng = random.Random(first)
    cases = [([22500, 22501, 28000], [1, 1, 1], 45001), ([3, 4], [2, 2], 8), ([1000, 1001], [10**6, 10**6], 999_999_001), ([7], [5], 20), ([], [], 9), ([6, 10, 15], [1, 1, 1], 30)]
    for _ in range(150):
        lengths = rng.sample(range(1, 60), rng.randrange(1, 6))
        cases.append((lengths, [rng.randrange(1, 7) for _ in lengths], rng.randrange(0, 500)))
    for lengths, counts, budget in cases:
        got = mixing.fill_budget(lengths, counts, budget)
        total = sum(a * b for a, b in zip(lengths, got, strict=True))
        assert all(0 <= g <= c for g, c in zip(got, counts, strict=True))
        want = budget if budget > 10**6 else best_sum(lengths, counts, budget)
        assert total == want, (lengths, counts, budget, total, want)


def test_budget_of_many_long_documents():
    rng = random.Random(3)
    lengths = rng.sample(range(2000, 60000), 3000)
    counts = [rng.randrange(1, 10**6) for _ in lengths]
    budget = sum(a * b for a, b in zip(lengths, counts, strict=True)) * 3 // 7
    got = mixing.fill_budget(lengths, counts, budget)
    assert sum(a * b for a, b in zip(lengths, got, strict=True)) == budget and all(0 <= g <= c for g, c in zip(got, counts, strict=True))


@pytest.mark.parametrize("budget", [1_000_000_007, 999_999_999, 123_456_789, 1_999_999_999, 19_998, 40_001])
def test_budget_of_two_long_lengths(budget):
    start = time.time()
    size, have = [19_999, 20_001], [50_000, 50_000]
    a, b = mixing.fill_budget(size, have, budget)
    got = 19_999 * a + 20_001 * b
    assert 0 <= a <= 50_000 and 0 <= b <= 50_000 and got <= budget and time.time() - start < 60
    # 40,001 words hold at most two documents; 1,999,999,999 leave nothing between; others have an exact sum
    assert got == {19_998: 0, 40_001: 40_000, 1_999_999_999: 1_999_980_001}.get(budget, budget)


def test_residues_and_listed_sums_against_the_table_of_sums():
    rng = random.Random(8)
    exact = 0
    for _ in range(300):
        lengths = sorted(rng.sample(range(1, 60), rng.randrange(1, 5)), reverse=True)
        counts = [rng.randrange(0, 7) for _ in lengths]
        budget = rng.randrange(0, sum(a * b for a, b in zip(lengths, counts, strict=True)) + 5)
        of = lambda taken: sum(a * b for a, b in zip(lengths, taken, strict=True))  # noqa: B023, E731
        want = of(mixing.knapsack(lengths, counts, budget))
        listed = mixing.few_choices(lengths, counts, budget)
        assert of(listed) == want and all(0 <= x <= c for x, c in zip(listed, counts, strict=True))
        found = mixing.by_residues(lengths, counts, budget)
        if found is not None:
            exact += 1
            assert of(found) == budget == want and all(0 <= x <= c for x, c in zip(found, counts, strict=True))
    assert exact > 15


def test_mixing_of_one_row_that_repeats(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED", 64)
    rows = [(None, "a", "one two three")] * 5000 + [(i, "b", "w " * (i % 5)) for i in range(400)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert len(got) == len(rows)
    a = [r for r in got if r.source == "a"]
    assert len(a) == 5000 and 0 <= a[0].target - sum(r.taken for r in a) < 3 and {r.taken for r in a} <= {0, 3, 6, 9}


def test_suffixes_are_sorted_in_few_bytes_each():
    import tracemalloc

    import numpy as np

    from orrery.llm.substring_dedup import suffix_tree

    rng = np.random.default_rng(1)
    n = 1 << 17
    word = rng.integers(0, 1 << 17, n + 20).astype(np.uint32)
    word[n // 2 : n // 2 + 5000] = word[:5000]
    at = np.arange(n)
    tracemalloc.start()
    order, lcp = suffix_tree(word, at, at, 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 * n
    assert (lcp == 20).sum() == 5000 - 19
    for i in np.flatnonzero(lcp)[:200]:
        a, b = word[order[i - 1] : order[i - 1] + 20].tolist(), word[order[i] : order[i] + 20].tolist()
        assert a <= b and a[: lcp[i]] == b[: lcp[i]] and (lcp[i] == 20 or a[lcp[i]] != b[lcp[i]])
