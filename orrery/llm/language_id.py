"""Operator 1: language ID by sparse multinomial logistic regression.

Features are TF-IDF weighted character n-grams (1 to 3 letters, hashed into a
fixed number of slots).  Document frequencies are counted over all labelled
training documents.  The classifier is fitted on a bounded sample of them
(`max_sample`, spread over the languages; rows are drawn by a hash of id and
text, and rows that are alike count once) with follow-the-regularised-leader and
elastic-net penalties: each of SHARDS shards trains in its own task, the weights
are averaged.  A tenth of the sample is kept out of that, and sets the
temperature that calibrates the scores.  Every whole text is then predicted.

Up to FANOUT labels are classes of one model.  More are the leaves of a tree: the
numbers of the sorted labels, written to the base FANOUT, are read digit by digit,
each node being a model of its own that is trained on its rows and calibrated.  A
prediction follows the best child down, and its score is the product of the
probabilities on its way.  So no model has more than FANOUT classes, however many
labels there are.  Weights are broadcast sparse; the penalty leaves few per class.

Defined cases: a NULL text, or one without a letter, gets `und` with score 0, as
does every text if nothing was learned; a NULL doc_id counts as held out, so it
is never learned from; repeated rows get repeated predictions; very long texts
are read in pieces; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import materialize

UND = "und"
SLOTS = 1 << 15
PIECE = 1 << 18
SHARDS = 4
MAX_SAMPLE = 8000
FANOUT = 400
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(slots, counts) of the whole text's n-grams; None if it has no letter."""
    if not text:
        return None
    letters, total, any_letter = _letters(), np.zeros(SLOTS, np.int64), False
    for a in range(0, len(text), PIECE):
        cp = np.frombuffer(text[max(0, a - 2) : a + PIECE].lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        word = letters[cp]
        any_letter = any_letter or bool(word.any())
        cp = np.where(word, cp, 32)
        keep = np.ones(len(cp), bool)
        keep[1:] = word[1:] | word[:-1]
        cp = np.concatenate([[np.uint64(32)], cp[keep], [np.uint64(32)]])
        h = cp
        for n in (1, 2, 3):
            if n > 1:
                h = h[:-1] * np.uint64(0x100000001B3) + cp[n - 1 :]
            slot = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(49)
            total += np.bincount(slot.astype(np.int64), minlength=SLOTS)
    if not any_letter:
        return None
    at = np.flatnonzero(total)
    return at, total[at]


def features(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    got = gram_counts(text)
    if got is None:
        return None
    v = (1 + np.log(got[1])) * idf[got[0]]
    return got[0], v / np.sqrt(v @ v)


def _document_frequency(batches) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for t in batch.column(0):
            got = gram_counts(t.as_py())
            if got:
                total[got[0]] += 1
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])


def _featurise(batches, idf) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, slots, values = [], [], []
        for r, t in enumerate(batch.column(2)):
            got = features(t.as_py(), idf.value)
            if got:
                keep.append(r)
                slots.append(got[0].astype(np.int32))
                values.append(got[1].astype(np.float32))
        if keep:
            take = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(slots, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], names=["part", "y", "slot", "value"]
            )


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, seed: int) -> np.ndarray:
    """Weights (slots x classes) after EPOCHS passes in seeded orders."""
    out = np.zeros((SLOTS, classes))
    if not rows:
        return out
    used, own = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True)
    local = np.split(own, np.cumsum([len(r[1]) for r in rows])[:-1])
    z, n = np.zeros((len(used), classes)), np.zeros((len(used), classes))

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for r in rng.permutation(len(rows)):
            y, _, v = rows[r]
            slot = local[r]
            zs, ns = z[slot], n[slot]
            w = weights(zs, ns)
            s = v @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = np.outer(v, p)
            step = (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA
            z[slot] = zs + g - step * w
            n[slot] = ns + g * g
    out[used] = weights(z, n)
    return out


def _train(pdf: pd.DataFrame, classes: dict[int, int] | int) -> pd.DataFrame:
    """One node's rows of one shard; classes: of each node, or of the only one."""
    pdf = pdf.sort_values("order")
    node = int(pdf.node.iloc[0])
    rows = [(int(y), np.asarray(s), np.asarray(v, float)) for y, s, v in zip(pdf.y, pdf.slot, pdf.value, strict=True)]
    w = ftrl(rows, classes if isinstance(classes, int) else classes[node], int(pdf.part.iloc[0]))
    slot, cls = np.nonzero(w)
    return pd.DataFrame({"node": node, "slot": slot, "cls": cls, "w": w[slot, cls]})


class Node:
    """A model of some classes: weights by slot, and a temperature."""

    def __init__(self, classes: int, slot: np.ndarray, cls: np.ndarray, w: np.ndarray):
        self.classes, self.temperature = classes, 1.0
        order = np.lexsort((cls, slot))
        self.ptr, self.cls, self.w = np.searchsorted(slot[order], np.arange(SLOTS + 1)), cls[order], w[order].astype(np.float32)

    def scores(self, slot: np.ndarray, v: np.ndarray) -> np.ndarray:
        first, length = self.ptr[slot], self.ptr[slot + 1] - self.ptr[slot]
        at = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        return np.bincount(self.cls[at], np.repeat(v, length) * self.w[at], self.classes)

    def best(self, slot: np.ndarray, v: np.ndarray) -> tuple[int, float]:
        s = self.scores(slot, v) / self.temperature
        p = np.exp(s - s.max())
        k = int(p.argmax())
        return k, float(p[k] / p.sum())


def tree_levels(labels: int, fanout: int) -> int:
    levels = 1
    while fanout**levels < labels:
        levels += 1
    return levels


def tree_path(number: Column, levels: int, fanout: int) -> Column:
    """(node, y) of a label on each level; a node's number is (level, leading digits) in one long."""
    out = []
    for k in range(levels):
        below = fanout ** (levels - 1 - k)
        lead = F.floor(number / F.lit(below * fanout))
        out.append(F.struct((F.lit(k << 48) + lead).cast("long").alias("node"), F.pmod(F.floor(number / F.lit(below)), F.lit(fanout)).cast("int").alias("y")))
    return F.array(*out)


def tell(model: dict, slot: np.ndarray, v: np.ndarray) -> tuple[str, float]:
    """(language, probability)."""
    lead, p = 0, 1.0
    for k in range(model["levels"]):
        node = model["nodes"].get((k << 48) + lead)
        digit, q = node.best(slot, v) if node else (0, 1.0)
        lead, p = lead * model["fanout"] + digit, p * q
    return model["langs"][min(lead, len(model["langs"]) - 1)], p


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """Minimises the negative log-likelihood by golden section over log T.

    Labels are smoothed by 1 / (rows + 2), so separable rows don't drive T to 0."""
    if not len(y):
        return 1.0
    smooth = 1 / (len(y) + 2)

    def loss(t: float) -> float:
        s = scores / np.exp(t)
        s = s - s.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(1)) - (1 - smooth) * s[np.arange(len(y)), y] - smooth * s.mean(1)))

    a, b, g = -5.0, 5.0, (5**0.5 - 1) / 2
    for _ in range(60):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _number(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def draw_sample(known: DataFrame, count: dict[str, int], max_sample: int, seed: int) -> DataFrame:
    """lang, number, text, _draw: at most max_sample rows (or one per label, if there are more labels), at most an even
    share of each language; `count` is about how many different rows each has; number: a language's place in `count`.

    A row's number comes from its id and text.  Twice the share is let through by number, so what meets in a
    language's task is small; there the lowest numbers stay, each once."""
    share = max(1, max_sample // len(count))
    scale = 1 << 30
    # a local table, whose size the planner sees: it is broadcast if that is small
    numbers = [min(scale, 2 * scale * share // max(1, n) + 1) for n in count.values()]
    quota = known.sparkSession.createDataFrame(pa.table({"lang": pa.array(list(count), pa.string()), "number": pa.array(range(len(count)), pa.int64()), "quota": pa.array(numbers, pa.int64())}))
    some = known.select("lang", "text", _number(seed).alias("_draw")).join(quota, "lang").where(F.pmod("_draw", F.lit(scale)) < F.col("quota"))
    one = some.dropDuplicates(["lang", "_draw"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_draw"))
    return one.withColumn("_rank", rank).where(F.col("_rank") <= share).drop("_rank", "quota")


def fit(docs: DataFrame, trains: Column, max_sample: int = MAX_SAMPLE, seed: int = 1, fanout: int = FANOUT) -> dict:
    """The model: languages, idf, tree of nodes.  `trains` picks the rows that may be learned from.

    What reaches the driver: a count per label, SLOTS frequencies, the weights that are not 0, a tenth of the sample."""
    spark = docs.sparkSession
    known = docs.where(trains & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = known.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct(_number(seed)).alias("different"))
    count = {r["lang"]: r for r in counted.collect()}
    langs = sorted(count)
    levels = tree_levels(len(langs), fanout)
    model = {"langs": langs, "idf": np.ones(SLOTS), "levels": levels, "fanout": fanout, "nodes": {}}
    if not langs:
        return model
    freq = known.select("text").mapInArrow(_document_frequency, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(SLOTS)
    df[[r.slot for r in freq]] = [r.n for r in freq]
    model["idf"] = np.log((1 + sum(r["n"] for r in count.values())) / (1 + df)) + 1
    drawn = draw_sample(known, {k: count[k]["different"] for k in langs}, max_sample, seed)
    idf = spark.sparkContext.broadcast(model["idf"])
    spread = F.pmod(F.xxhash64(F.lit(seed + 1), "_draw"), F.lit(10 * SHARDS)).cast("int")
    part = F.when(spread < SHARDS, F.lit(-1)).otherwise(F.pmod(spread, F.lit(SHARDS)))
    rows = drawn.select(part.alias("part"), F.col("number").cast("int").alias("y"), "text").mapInArrow(lambda it: _featurise(it, idf), "part int, y int, slot array<int>, value array<float>")
    rows = materialize(rows.withColumn("order", F.xxhash64("slot", "value")), "sample")
    each = rows.withColumn("_p", F.explode(tree_path(F.col("y"), levels, fanout))).select("part", "order", "slot", "value", "_p.node", "_p.y")
    # a node's last digit may reach less far than fanout
    classes = {r["node"]: r["c"] for r in each.groupBy("node").agg((F.max("y") + 1).alias("c")).collect()}
    if levels == 1:
        classes = {0: len(langs)}
    shards = each.where("part >= 0").groupBy("node", "part").applyInPandas(lambda pdf: _train(pdf, classes), "node long, slot long, cls long, w double")
    found = shards.groupBy("node", "slot", "cls").agg((F.sum("w") / SHARDS).alias("w")).toPandas()
    by = dict(iter(found.groupby("node")))
    none = found[:0]
    model["nodes"] = {k: Node(c, *(by.get(k, none)[x].to_numpy() for x in ("slot", "cls", "w"))) for k, c in classes.items()}
    kept = each.where("part < 0").orderBy("order").select("node", "y", "slot", "value").toPandas()
    for k, own in kept.groupby("node"):
        scores = np.array([model["nodes"][k].scores(np.asarray(s), np.asarray(v, float)) for s, v in zip(own.slot, own.value, strict=True)])
        model["nodes"][k].temperature = temperature(scores, own.y.to_numpy())
    return model


def _predict(batches, shared) -> Iterator[pa.RecordBatch]:
    m = shared.value
    for batch in batches:
        names, scores = [], []
        for t in batch.column(batch.num_columns - 1):
            got = features(t.as_py(), m["idf"]) if m["langs"] else None
            if got is None:
                names.append(UND)
                scores.append(0.0)
                continue
            name, p = tell(m, *got)
            names.append(name)
            scores.append(p)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], "lang_pred", "score"]
        )


def predict(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """`keep` columns plus lang_pred and score for every row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, F.col("text").alias("_text_of_prediction")).mapInArrow(lambda it: _predict(it, shared), f"{fields}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: dict, above_chance: float = 0.05) -> DataFrame:
    """The rows of `docs`, with all their columns, whose language is told; a NULL `lang` becomes the language found.

    Told means: a letter at least, and a score that lies `above_chance` of the way from chance (1 / languages, which a
    text of unknown letters has) to 1.  Texts of one or two common words pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at, lang = names.index("text"), names.index("lang") if "lang" in names else -1
    chance = 1 / max(1, len(model["langs"]))
    least = chance + above_chance * (1 - chance)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one = pa.RecordBatch.from_arrays([batch.column(at)], names=["text"])
            (told,) = _predict([one], shared)
            ok = [n != UND and s >= least for n, s in zip(told.column(0).to_pylist(), told.column(1).to_pylist(), strict=True)]
            columns = [pc.coalesce(c, told.column(0)) if i == lang else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pa.array(ok, pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*names)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", held_out().alias("held_out"))
    return predict(docs, fit(docs, ~F.col("held_out")), ["doc_id", "held_out"])
