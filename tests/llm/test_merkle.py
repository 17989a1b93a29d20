"""Merkle manifest against a tree of lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from orrery.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes, arity):
    """(last node, for each node the other hashes of its runs from below: before and after it)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            first = a // arity * arity
            run = nodes[first : first + arity]
            paths[i].append(("".join(run[: a - first]), "".join(run[a - first + 1 :])))
        nodes = [H(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
        at = [a // arity for a in at]
    return nodes[0], paths


def brute(rows, arity=2):
    def leaf(row):
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], arity) for g in order]
    root, tops = tree([t[0] for t in trees], arity) if trees else (None, [])
    out = []
    for g, (sub, paths), top in zip(order, trees, tops, strict=True):
        for (_, _, own, r), path in zip(sorted(groups[g], key=lambda x: x[:3]), paths, strict=True):
            folded = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                folded = leaf((*r[:3], r[3] + 1, r[4]))
            for before, after in path + top:
                folded = H(before, folded, after)
            out.append((r[0], own, sub, root, H(*[b + a for b, a in path + top]), folded, folded == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, hash string, _g int, _row int"


def rows_of(n):
    langs = ["en"] * 5 + ["de", "zh", None, "", "é"]
    return [(i, f"src{i % 3}" if i % 4 else None, langs[i * 7 % 10], i * 3 if i % 5 else None, "text é " * (i % 6) if i % 9 else None) for i in range(n)]


@pytest.mark.parametrize(("rows", "levels"), [(rows_of(150), 2), (rows_of(1), 7), (rows_of(9), 7)], ids=["many", "one", "few"])
def test_query(spark, tmp_path, monkeypatch, rows, levels):
    if len(rows) > 100:
        rows = [*rows, *[(None, None, "en", 4, "same")] * 5, *[(3, "a", "en", 1, "other")] * 2, (2**63 - 1, None, None, 2**63 - 1, ""), (10**6, "s", "solo", 2, "alone " * 50000)]
    monkeypatch.setattr(merkle.Rollup.__init__, "__defaults__", (2, levels))
    monkeypatch.setattr(merkle.manifest, "__defaults__", (2, levels))
    monkeypatch.setattr(merkle, "RANGE", 20)
    spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted([tuple(r) for r in merkle.op11_merkle_manifest(spark, str(tmp_path)).collect()], key=repr)
    assert got == brute(rows)


def test_other_arity_and_an_empty_table(spark):
    rows = rows_of(70)
    d = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    leaf = merkle.leaf_hash([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    out = merkle.manifest(d, leaf, F.col("lang"), F.col("doc_id"), [F.col("doc_id")], arity=3, levels=2)
    got = sorted((r.doc_id, r.leaf, r.subroot, r.root, H(*[p.before + p.after for p in r.path])) for r in out.collect())
    assert got == sorted(x[:5] for x in brute(rows, 3))
    assert all(out.select((merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok")).toPandas().ok)
    assert merkle.manifest(d.limit(0), leaf, F.col("lang"), F.col("doc_id"), [F.col("doc_id")]).collect() == []
