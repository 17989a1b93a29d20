"""Operator 2: mixing sources to target weights by subset-sum budget fitting.

Sources in code point order (NULL last) weigh 5, 2, 1, 5, ... and share all words
of the corpus; a target stops at `max_repeats` times its source's size, and the
excess is reshared by weight.  A source takes whole passes over its documents
while they fit its target.  The rest is a subset sum over documents counted by
exact length, solved to the best sum that any choice of documents has:

1. An even share of each length is taken, which leaves less than the sum of the
   distinct lengths.
2. Bounded-knapsack dynamic programming fills that: first over residues modulo the
   shortest length (a cell per residue, whatever the budget), then over sums.  The
   latter starts with a short budget, longer documents being taken before it, and
   widens until the sum is exact or the budget is all that was left.
3. Where no exact sum was found, more and more of the even share is given back to
   the dynamic program.  A best solution differs from the even share by at most
   twice the longest length in documents, so the search ends there.

An exact sum can't be bettered, so stopping at it loses nothing.  Few documents
(up to FEW choices of counts) are settled by listing their sums.  Tables of sums
hold MOST_BUDGET words at most; longer documents are then taken before, so a best
sum is no longer certain where no choice is exact, documents are many, and some are
longer than that.  Which documents of a length are taken is a seeded order.

Only (source, length) counts meet in a source's task, never its documents.  Rows
that are alike (id, source, text) are counted before they are ranked, and the
documents of one (source, length) are ranked in hash buckets of about RANKED
rows, so neither a source nor a repeated row that holds a third of all rows
meets in one task.

Defined cases: a NULL or wordless text has size 0 and takes 0 words; a NULL
source is a source of its own; repeated rows are separate documents; if all
documents are empty all targets are 0; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import materialize
from ._text import SPACES, text_blocks

WEIGHTS = (5, 2, 1)
RANKED = 1024
#: Budget that dynamic programming starts with, and how it widens.
FIRST_BUDGET, WIDEN, MOST_BUDGET = 1 << 14, 8, 1 << 22
#: Choices of counts that are listed; residues and lengths of the table of residues.
FEW, RESIDUES, MOST_LENGTHS = 1 << 16, 1 << 20, 12


def _count_words(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, off in text_blocks(batch.column(2)):
            inside = np.empty(len(data) + 1, bool)
            inside[0] = False
            np.logical_not(SPACES[data], out=inside[1:])
            first = inside[1:] & ~inside[:-1]
            heads = off[:-1][off[:-1] < off[1:]]
            first[heads] = inside[1:][heads]
            at = np.flatnonzero(first)
            size = np.diff(np.searchsorted(at, off, "left"))
            same = [batch.column(c).slice(i, j - i) for c in (0, 1, 3)]
            yield pa.RecordBatch.from_arrays([*same, pa.array(size, pa.int64())], names=["doc_id", "source", "text_hash", "size"])


def source_targets(sizes: DataFrame, max_repeats: int = 3) -> DataFrame:
    """source, source_size, target: one row per source (so the windows here run over the short table of sources)."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    t = total.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeats)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    t = (
        t.withColumn("all", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("capped", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("sharing", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("all") - F.col("capped")) / F.col("sharing"))
    )
    # sources below the first one whose cap holds the level are capped; all others share what is left
    level = F.first(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return t.withColumn("final", level).select("source", "source_size", F.coalesce(F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight")), F.col("cap").cast("double")).alias("target"))


def knapsack(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length give the largest sum that does not exceed the budget.

    A bit per reachable sum, and per sum the first step that reached it."""
    mask = (1 << (budget + 1)) - 1
    reach, steps = 1, []
    first = np.zeros(budget + 1, np.int32)
    for i, (length, count) in enumerate(zip(lengths, counts, strict=True)):
        count = min(count, budget // length) if length > 0 else 0
        k = 1
        while count > 0 and not reach >> budget & 1:
            k = min(k, count)
            new = (reach << (length * k)) & mask & ~reach
            if new:
                bits = np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), np.uint8)
                first[np.flatnonzero(np.unpackbits(bits, bitorder="little"))] = len(steps)
                steps.append((i, k))
                reach |= new
            count -= k
            k *= 2
    at, taken = reach.bit_length() - 1, [0] * len(lengths)
    while at:  # the sum before a step was reached by an earlier one
        i, k = steps[first[at]]
        taken[i] += k
        at -= lengths[i] * k
    return taken


def _fill_budget(size: list[int], free: list[int], budget: int, width: int) -> list[int]:
    """Documents of each length (longest first in the lists): the longest ones until `width` is left, then a knapsack."""
    out, left = [0] * len(size), budget
    for i, (length, count) in enumerate(zip(size, free, strict=True)):
        if left <= width:
            break
        out[i] = min(count, (left - width) // length)
        left -= out[i] * length
    for i, k in enumerate(knapsack(size, [c - x for c, x in zip(free, out, strict=True)], left)):
        out[i] += k
    return out


def few_choices(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """The same as knapsack(), by listing the sums of all choices."""
    sums = np.zeros(1, np.int64)
    for length, count in zip(lengths, counts, strict=True):
        sums = (sums[:, None] + length * np.arange(count + 1)).ravel()
    at = int(np.where(sums <= budget, sums, -1).argmax())
    taken = []
    for count in reversed(counts):
        at, k = divmod(at, count + 1)
        taken.append(k)
    return taken[::-1]


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[..., i - width + 1 : i + 1], shorter at the start; by doubling."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[..., step:] = np.minimum(out[..., step:], out[..., :-step].copy())
        have += step
    return out


def by_residues(lengths: list[int], counts: list[int], budget: int) -> list[int] | None:
    """Counts with the exact sum, or None if none was found: the least sum of each residue modulo the last length, from the
    other lengths (the MOST_LENGTHS with most documents), filled up with documents of the last one."""
    m = lengths[-1]
    if m > RESIDUES or budget < 0:
        return None
    none = np.int64(1 << 61)
    least = np.full(m, none)
    least[0] = 0
    some = sorted(sorted(range(len(lengths) - 1), key=lambda i: -counts[i])[:MOST_LENGTHS])
    before = []
    for i in some:
        length, d = lengths[i], lengths[i] % m
        cycle = m // math.gcd(d, m) if d else 1
        most = min(counts[i], cycle - 1, budget // length)
        before.append((least, most))
        if most <= 0:
            continue
        # residues along each cycle of steps, twice around, so that a window never wraps
        path = (np.arange(m // cycle)[:, None] + np.arange(2 * cycle) * d) % m
        climb = length * np.arange(2 * cycle, dtype=np.int64)
        low = (_window_min(least[path] - climb, most + 1) + climb)[:, cycle:]
        after = least.copy()
        after[path[:, cycle:]] = np.minimum(none, low)
        least = after
    r = budget % m
    if least[r] > budget or (budget - int(least[r])) // m > counts[-1]:
        return None
    taken = [0] * len(lengths)
    taken[-1] = (budget - int(least[r])) // m
    at = int(least[r])
    for i, (earlier, most) in zip(reversed(some), reversed(before), strict=True):
        k = np.arange(max(0, most) + 1)
        left = at - k * lengths[i]
        k = int(k[(left >= 0) & (earlier[left % m] == left)][0])
        taken[i] = k
        at -= k * lengths[i]
    return taken


def fill_budget(size: list[int], count: list[int], budget: int) -> list[int]:
    """How many documents of each length (positive, distinct) give the best sum that does not exceed the budget."""
    order = sorted(range(len(size)), key=lambda i: -size[i])
    unit = math.gcd(*size) if size else 1
    length, have, goal = [size[i] // unit for i in order], [count[i] for i in order], budget // unit
    total = sum(a * b for a, b in zip(length, have, strict=True))
    goal = min(goal, total)
    share = [c * goal // total for c in have] if total else []
    best, best_sum, given = [0] * len(order), 0, 0
    summed = lambda x: sum(a * b for a, b in zip(length, x, strict=True))
    if total and math.prod(c + 1 for c in have) <= FEW:
        best = few_choices(length, have, goal)
        best_sum = total = 0  # no choice is better
    while total and best_sum < goal:
        base = [max(0, x - given) for x in share]
        left = goal - summed(base)
        more = by_residues(length, [c - b for c, b in zip(have, base, strict=True)], left)
        if more:
            best = [b + m for b, m in zip(base, more, strict=True)]
            break
        width = FIRST_BUDGET
        while best_sum < goal:
            more = _fill_budget(length, [c - b for c, b in zip(have, base, strict=True)], left, width)
            got = goal - left + summed(more)
            if got > best_sum:
                best, best_sum = [b + m for b, m in zip(base, more, strict=True)], got
            if width >= min(left, MOST_BUDGET):
                break
            width *= WIDEN
        if given > 2 * length[0] or not any(base):
            break
        given = max(1, WIDEN * given)
    out = [0] * len(order)
    for i, x in zip(order, best, strict=True):
        out[i] = x
    return out


def fill_source(size: np.ndarray, count: np.ndarray, total: int, target: float, max_repeats: int) -> tuple[int, np.ndarray]:
    """(whole passes, extra documents of each length) whose words come nearest to the target from below."""
    extra = np.zeros(len(size), np.int64)
    if total <= 0:
        return 0, extra
    words = int(target + 1e-6)
    passes = min(max_repeats, words // total)
    rest = words - passes * total
    if passes < max_repeats and rest > 0:
        at = np.flatnonzero(size > 0)
        extra[at] = fill_budget(size[at].tolist(), count[at].tolist(), rest)
    return passes, extra


def _fill(pdf: pd.DataFrame, max_repeats: int) -> pd.DataFrame:
    pdf = pdf.sort_values("size")
    passes, extra = fill_source(pdf["size"].to_numpy(), pdf["count"].to_numpy(), int(pdf.source_size.iloc[0]), float(pdf.target.iloc[0]), max_repeats)
    return pdf.assign(passes=passes, extra=extra)[["source", "size", "count", "source_size", "target", "passes", "extra"]]


def mix_documents(docs: DataFrame, seed: int = 1, max_repeats: int = 3) -> DataFrame:
    """doc_id, source, text_hash (xxhash64), size, source_size, target, n, passes, more: of the n rows that are alike,
    `more` are taken passes + 1 times and the others `passes` times."""
    texts = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("text_hash"))
    sizes = texts.mapInArrow(_count_words, "doc_id long, source string, text_hash long, size long")
    alike = materialize(sizes.groupBy("doc_id", "source", "text_hash", "size").agg(F.count("*").alias("n")), "sizes")
    counted = alike.groupBy("source", "size").agg(F.sum("n").alias("count"))
    targets = source_targets(counted.select("source", (F.col("size") * F.col("count")).alias("size")), max_repeats)
    plan = (
        counted.alias("a").join(targets.alias("b"), F.expr("a.source <=> b.source")).select("a.source", "size", "count", "source_size", "target")
        .groupBy("source").applyInPandas(lambda pdf: _fill(pdf, max_repeats), "source string, size long, count long, source_size long, target double, passes int, extra long")
    )
    plan = materialize(plan, "plan")
    h = F.xxhash64(F.lit(seed), F.col("s.doc_id"), F.col("s.text_hash"))
    rows = (
        alike.alias("s").join(plan.alias("p"), F.expr("s.source <=> p.source AND s.size = p.size"))
        .select("s.doc_id", "s.source", "s.text_hash", "s.size", "source_size", "target", "n", "passes", "extra", "count", h.alias("h"))
        .withColumn("bucket", F.floor(F.pmod(F.col("h"), F.lit(1 << 30)) * F.ceil(F.col("count") / RANKED) / F.lit(1 << 30)))
    )
    some = (F.col("extra") > 0) & (F.col("extra") < F.col("count"))
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    part = (
        rows.where(some).groupBy("source", "size", "bucket").agg(F.sum("n").alias("m"), F.first("extra").alias("x"))
        .select("source", "size", "bucket", (F.col("x") - F.coalesce(F.sum("m").over(before), F.lit(0))).alias("open"))
    )
    within = Window.partitionBy("source", "size", "bucket").orderBy("h", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.where(some).withColumn("ahead", F.coalesce(F.sum("n").over(within), F.lit(0)))
    left = F.greatest(F.lit(0), F.least(F.col("n"), F.col("open") - F.col("ahead")))
    chosen = ranked.alias("r").join(part.alias("t"), F.expr("r.source <=> t.source AND r.size = t.size AND r.bucket = t.bucket")).select("r.*", "t.open").withColumn("more", left)
    whole = rows.where(~some).withColumn("more", F.when(F.col("extra") > 0, F.col("n")).otherwise(0))
    return chosen.unionByName(whole, allowMissingColumns=True).select("doc_id", "source", "text_hash", "size", "source_size", "target", "n", "passes", "more")


def mix_sources(docs: DataFrame, seed: int = 1, max_repeats: int = 3) -> DataFrame:
    """doc_id, source, text_hash, size, source_size, target, copies, taken for every row of `docs`."""
    one = F.explode(F.expr(f"sequence(0L, (n - 1) div {RANKED})"))
    number = F.explode(F.expr(f"sequence(part * {RANKED} + 1, least(n, (part + 1) * {RANKED}))"))
    rows = mix_documents(docs, seed, max_repeats).withColumn("part", one).withColumn("number", number)
    copies = (F.col("passes") + (F.col("number") <= F.col("more")).cast("int")).cast("int")
    return rows.select("doc_id", "source", "text_hash", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def op2_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")
