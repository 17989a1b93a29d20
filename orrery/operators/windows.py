"""Ordered computations: running means, outliers, chunks, days, histories."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType
from pyspark.sql.window import Window

from .joins import with_next


def centered_mean(df: DataFrame, by: list[str], order: str, value: str, width: int = 7) -> DataFrame:
    """Mean of the rows around each; at the start the window shrinks on both sides, at the end by truncation."""
    half = width // 2
    w = Window.partitionBy(*by).orderBy(order)
    d = df.withColumns({"_i": F.row_number().over(w) - 1, "_a": F.collect_list(F.struct(F.lit(0).alias("z"), F.col(value).alias("v"))).over(w.rowsBetween(-half, half))})
    # fewer than `half` rows before: as many after
    kept = F.when(F.col("_i") < half, F.slice("_a", 1, F.least(2 * F.col("_i") + 1, F.size("_a")).cast("int"))).otherwise(F.col("_a"))
    values = F.filter(F.transform(kept, lambda s: s["v"]), lambda v: v.isNotNull())
    return d.withColumn("mean", F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), F.size(values))).drop("_i", "_a")


def _leave_one_out(sample: np.ndarray, x: np.ndarray, group: np.ndarray, half: int) -> np.ndarray:
    """Whether, for some left-out value of the centred window of `sample` (NaN: none; windows end with the group), |median
    - x| >= 3 population deviations of the rest.

    Leaving a value out moves the median to one of three places, which depends only on whether the value lies below, in
    or above the middle of the sorted window; and the deviation of the rest is least for the values farthest out.  So
    six values decide: the two ends of each part."""
    out = np.zeros(len(x), bool)
    place = np.arange(len(x)) + half * (group + 1)  # groups stand `half` empty places apart
    padded = np.full(len(x) + half * (int(group[-1]) + 2) if len(x) else 0, np.nan)
    padded[place] = sample
    for a in range(0, len(x), 4096):
        of = slice(a, a + 4096)
        s = np.sort(np.lib.stride_tricks.sliding_window_view(padded, 2 * half + 1)[place[of] - half], axis=1)  # NaNs last
        n = (~np.isnan(s)).sum(1) - 1  # of the rest
        row, rest = np.arange(len(s)), np.maximum(n, 1)
        at = lambda i: s[row, np.clip(i, 0, 2 * half)]  # noqa: B023, E731
        lo, hi = (n - 1) // 2, n // 2
        origin = at(lo)
        d = np.where(np.isnan(s), 0.0, s - origin[:, None])
        total, squares = d.sum(1), (d * d).sum(1)
        bad = np.zeros(len(s), bool)
        # which value goes: those at lo or before, at hi or before, and after
        for first, last in ((0 * n, lo), (lo + 1, hi), (hi + 1, n)):
            median = (at(np.where(lo < first, lo, lo + 1)) + at(np.where(hi < first, hi, hi + 1))) / 2
            off = (median - x[of]) ** 2
            for gone in (first, last):
                v = at(gone) - origin
                mean = (total - v) / rest
                spread = np.maximum(0.0, (squares - v * v) / rest - mean * mean)
                bad |= (first <= last) & (off >= 9 * spread)
        out[of] = bad & (n >= 1)
    return out


def _outliers(value: np.ndarray, group: np.ndarray, half: int) -> np.ndarray:
    first = _leave_one_out(value, value, group, half)
    return first | _leave_one_out(np.where(first, np.nan, value), value, group, half)


def _stream_outliers(batches: Iterator[pa.RecordBatch], value: str, half: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows of many groups (_i numbers a group's rows from 1) -> the same rows with `outlier`.

    A row's verdict depends on rows up to 2 * half away, so tables of some thousand rows are judged with so many rows
    before and after them; no group is held as a whole."""
    held, known = None, 0  # rows not yet passed on, after `known` that were

    def judge(t: pa.Table, last: bool) -> tuple[pa.Table | None, int]:
        nonlocal known
        number = t.column("_i").to_numpy()
        x = pc.cast(t.column(value), pa.float64()).to_numpy(zero_copy_only=False).astype(float)
        flag = _outliers(x, np.cumsum(np.append(False, number[1:] == 1)), half)
        ready = len(x) if last else max(known, len(x) - 2 * half)
        out = t.slice(known, ready - known).append_column("outlier", pa.array(flag[known:ready], mask=np.isnan(x[known:ready])))
        keep = max(0, ready - 2 * half)
        known = ready - keep
        return out.drop_columns(["_i"]), keep

    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows - known >= rows:
            out, keep = judge(held.combine_chunks(), False)
            yield from out.to_batches()
            held = held.slice(keep)
    if held is not None:
        yield from judge(held.combine_chunks(), True)[0].to_batches()


def outlier_flag(df: DataFrame, by: list[str], order: str, value: str, width: int = 61, rows: int = 1 << 15) -> DataFrame:
    """`outlier`: two passes over centred windows; rows flagged first are no sample of the second pass.  NULL where
    the value is.

    Both passes run over the rows of a sorted partition as they come, `rows` at a time."""
    half = width // 2
    numbered = df.withColumn("_i", F.row_number().over(Window.partitionBy(*by).orderBy(order)))
    return numbered.mapInArrow(lambda it: _stream_outliers(it, value, half, rows), StructType([*df.schema.fields, StructField("outlier", BooleanType())]))


def log_edges(df: DataFrame, by: list[str], order: str, energy: str) -> DataFrame:
    """delta_minus, delta_plus to the geometric mid-points; at the ends the neighbouring ratio is repeated."""
    w = Window.partitionBy(*by).orderBy(order)
    e, before, after = F.col(energy), F.lag(energy).over(w), F.lead(energy).over(w)
    d = df.withColumns({"_p": before, "_n": after})
    down = F.sqrt(F.coalesce(F.col("_p") * e, e * e * e / F.col("_n")))
    up = F.sqrt(F.coalesce(F.col("_n") * e, e * e * e / F.col("_p")))
    return d.withColumns({"delta_minus": F.abs(e - F.least(down, up)), "delta_plus": F.abs(F.greatest(down, up) - e)}).drop("_p", "_n")


def chunk(df: DataFrame, by: list[str], order: str, n: int, offset_us: int, ts: str) -> DataFrame:
    """Rows numbered in whole chunks of n (an incomplete tail is dropped); epoch_us: first row's time + offset."""
    w = Window.partitionBy(*by).orderBy(order)
    d = df.withColumn("chunk", F.floor((F.row_number().over(w) - 1) / n))
    c = Window.partitionBy(*by, "chunk")
    return d.withColumns({"_n": F.count("*").over(c), "epoch_us": F.min(F.unix_micros(F.col(ts).cast("timestamp"))).over(c) + offset_us}).where(F.col("_n") == n).drop("_n")


def deinterleave(df: DataFrame, by: list[str], order: str, slots: DataFrame, n: int = 10) -> DataFrame:
    """The k-th row of each n holds slot k (slots: slot, name); block and slot name are added."""
    k = F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1
    d = df.withColumn("_k", k).withColumns({"block": F.floor(F.col("_k") / n), "slot": (F.col("_k") % n).cast("int")})
    return d.drop("_k").join(slots, "slot")


def persist_last(df: DataFrame, key: str, to: Column, values: list[str], flag: str, freeze: int) -> DataFrame:
    """A series continued to key `to` by repeating its last row, with the freeze bit set."""
    last = df.agg(F.max(F.struct(key, *values, flag)).alias("l"))
    more = last.select(F.explode(F.when(F.col(f"l.{key}") < to, F.sequence(F.col(f"l.{key}") + 1, to)).otherwise(F.array().cast("array<bigint>"))).alias(key), *[F.col(f"l.{c}").alias(c) for c in values], F.col(f"l.{flag}").bitwiseOR(F.lit(freeze)).alias(flag))
    return df.select(key, *values, flag).unionByName(more)


def extend_history(base_x: float, base_y: float, new: DataFrame, x: str, y: str) -> DataFrame:
    """Values at the new nodes' positions from the line through the last base node and the nearest nodes; a row
    whose node has a successor is interpolated between the base node and it at its own place, the last is copied."""
    w = Window.orderBy(x)
    d = new.withColumns({"_x1": F.lead(x).over(w), "_y1": F.lead(y).over(w)})
    line = base_y + (F.col("_y1") - base_y) * F.try_divide(F.col(x) - base_x, F.col("_x1") - base_x)
    return d.withColumns({"value": F.when(F.col("_x1").isNull(), F.col(y)).otherwise(line), "source": F.when(F.col("_x1").isNull(), "direct").otherwise("interpolated")}).drop("_x1", "_y1")


def new_day(df: DataFrame, by: list[str], order: str, night: Column) -> DataFrame:
    """`day` counts the falls of the night flag."""
    w = Window.partitionBy(*by).orderBy(order)
    d = df.withColumn("_night", night)
    d = d.withColumn("_fall", F.when(F.lag("_night").over(w) & ~F.col("_night"), 1).otherwise(0))
    return d.withColumn("day", F.sum("_fall").over(w)).drop("_night", "_fall")


def rotate_origin(df: DataFrame, by: list[str], angle: str, offset: Column, ties: list[str] | None = None) -> DataFrame:
    """Angles turned by -offset, numbered from the smallest, equal ones by `ties`.  Decimal angles are turned
    exactly (a double a bit below a full turn would come last instead of first)."""
    d = df.withColumn(angle, F.pmod(F.col(angle) - offset, F.lit(360)))
    return d.withColumn("bin", F.row_number().over(Window.partitionBy(*by).orderBy(angle, *(ties or []))) - 1)


def one_per_day(df: DataFrame, ts: str, value: str, hour: float = 20.0, ties: list[str] | None = None) -> DataFrame:
    """The measurement nearest to the hour of each day (the first on ties, of equal times the first by `ties`);
    zero values are dropped before."""
    t = F.col(ts).cast("timestamp")
    off = F.abs(F.unix_micros(t) - F.unix_micros(F.date_trunc("day", t)) - int(hour * 3600e6))
    d = df.where(F.col(value) != 0).withColumn("day", F.to_date(t)).withColumn("_o", off)
    return d.withColumn("_n", F.row_number().over(Window.partitionBy("day").orderBy("_o", ts, *(ties or [])))).where("_n = 1").drop("_n", "_o")


def gated_candidates(df: DataFrame, by: list[str], factor: float, seed: float, few: int = 4) -> DataFrame:
    """Per epoch the first candidate (epoch, points, density), from the most points down (then from the least
    density), whose density is positive and below factor * mean of the last three accepted.  The first one of fewer than
    `few` points ends the search: it need only be positive, and if it is not, the epoch has none.

    The only sequential step: one group's candidates in time order (a day's, not a table's)."""
    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        history, rows = [seed] * 3, []
        for _, g in pdf.sort_values("epoch", kind="stable").groupby("epoch", sort=True):
            limit = factor * sum(history[-3:]) / 3
            ok = g[((g.density > 0) & (g.density < limit)) | (g.points < few)].sort_values(["points", "density"], ascending=[False, True])
            if len(ok) and ok.density.iloc[0] > 0:
                rows.append(ok.iloc[0])
                history.append(float(ok.density.iloc[0]))
        return pd.DataFrame(rows, columns=pdf.columns)

    return df.groupBy(*by).applyInPandas(pick, df.schema)


def even_spacing_check(df: DataFrame, t_us: Column, slack_us: int = 1000) -> DataFrame:
    """half_us: half the first spacing of the instants; raises when half spacings spread by the slack or more."""
    d = with_next(df.select(t_us.alias("t")).distinct(), "t", {"_n": "t"}, 86400e6).withColumn("h", (F.col("_n") - F.col("t")) / 2)
    g = d.agg(F.max("h").alias("a"), F.min("h").alias("b"), F.min_by("h", "t").alias("h"))
    return g.select(F.when(F.col("a") - F.col("b") >= slack_us, F.raise_error(F.lit("instants are not evenly spaced")).cast("double")).otherwise(F.col("h")).alias("half_us"))


def line_statistics(x0: Column, y0: Column, x1: Column, y1: Column, a: Column, b: Column, n: int) -> tuple[Column, Column]:
    """Mean and population deviation of the line through two samples at n even steps over [a, b]."""
    slope = F.try_divide(y1 - y0, x1 - x0)
    slope = F.coalesce(slope, F.lit(0.0))
    mean = y0 + slope * ((a + b) / 2 - x0)
    return mean, F.abs(slope) * (b - a) * (((n + 1) / (12.0 * (n - 1))) ** 0.5)
