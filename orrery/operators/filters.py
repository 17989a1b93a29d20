"""Row filters, masks and small projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def slice_energy(df: DataFrame, lo: float, hi: float, col: str = "energy") -> DataFrame:
    """Lo <= energy < hi."""
    return df.where((F.col(col) >= lo) & (F.col(col) < hi))


def slice_energy_bins(df: DataFrame, first: int, last: int, col: str = "energy") -> DataFrame:
    """P5: bins first to last of the distinct energies, counted from 1, both kept; last may be one past the end."""
    if first >= last:
        raise ValueError("the first bin must be below the last")
    bins = df.select(col).distinct().withColumn("_bin", F.row_number().over(Window.orderBy(col)))
    return df.join(bins.where(F.col("_bin").between(first, last)).select(col), col, "left_semi")


def drop_dead_pointings(df: DataFrame, key: str) -> DataFrame:
    """Drops a pointing all of whose exposures are 0."""
    alive = df.groupBy(key).agg(F.max(F.coalesce(F.col("exposure") != 0, F.lit(False))).alias("_a")).where("_a").select(key)
    return df.join(alive, key, "left_semi")


#: Fixed roles of sweep bins (first, last)
SWEEP_BINS = {"coarse": (1, 62), "fine": (63, 71)}


def select_bins(df: DataFrame, role: str, col: str = "bin") -> DataFrame:
    """P7"""
    return df.where(F.col(col).between(*SWEEP_BINS[role]))


def drop_gaps(df: DataFrame, col: str, marker: float) -> DataFrame:
    """Keeps values below the gap marker."""
    return df.where(F.col(col) < marker)


def window_select(df: DataFrame, col: str, t0, t1) -> DataFrame:
    """Closed interval."""
    return df.where(F.col(col).between(t0, t1))


def good_time(df: DataFrame, flags: str, mask: int, night: Column, night_quota: int, by: list[str], order: str) -> DataFrame:
    """P10: adds `good`: no active flag is set, and fewer than night_quota night rows came before in its group."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum(F.when(night, 1).otherwise(0)).over(before), F.lit(0))
    return df.withColumn("good", (F.col(flags).bitwiseAND(F.lit(mask)) == 0) & (earlier < night_quota))


def bad_angle(flags: str, enabled: list[bool]) -> Column:
    """Any of the flag planes (bits) that the configuration enables."""
    mask = sum(1 << i for i, on in enumerate(enabled) if on)
    return F.col(flags).bitwiseAND(F.lit(mask)) != 0


def drop_unexposed(df: DataFrame) -> DataFrame:
    """P12"""
    return df.where("exposure <> 0")


def valid_event(df: DataFrame, sector: str, step: str, apd: str) -> DataFrame:
    """Sector, step and detector known, detector number 1 to 24."""
    return df.where(F.col(sector).isNotNull() & F.col(step).isNotNull() & F.col(apd).between(1, 24))


def has_valid_row(df: DataFrame, day: str, d0, d1, sentinels: list[str]) -> bool:
    """Whether any row of the day range has no sentinel set (NULL) in the columns."""
    return bool(df.where(F.col(day).between(d0, d1)).where(" AND ".join(f"{c} IS NOT NULL" for c in sentinels)).limit(1).count())


def fresh_enough(df: DataFrame, day: str, end: Column, buffer_days: int) -> DataFrame:
    """One row, `fresh`: the last date is at or after end + buffer."""
    return df.agg((F.max(day) >= F.date_add(end, buffer_days)).alias("fresh"))


def collapse_axis(df: DataFrame, keys: list[str], direction: list[str]) -> DataFrame:
    """Exposure summed and directions averaged over an axis."""
    return df.groupBy(*keys).agg(F.sum("exposure").alias("exposure"), *[F.avg(c).alias(c) for c in direction])


def mask_negative_moments(df: DataFrame, populations: list[str], bit: int) -> DataFrame:
    """Columns <p>_density, <p>_txx, <p>_tyy, <p>_tzz, <p>_speed: a negative density or diagonal term voids the
    population; a void core, halo or total voids `total`; the flag bit is set."""
    names = ["density", "txx", "tyy", "tzz"]
    bad = {p: F.coalesce(F.greatest(*[F.coalesce(F.col(f"{p}_{n}") < 0, F.lit(False)).cast("int") for n in names]) > 0, F.lit(False)) for p in populations}
    anything = bad[populations[0]]
    for p in populations[1:]:
        anything = anything | bad[p]
    out = {}
    for p in populations:
        void = anything if p == "total" else bad[p]
        for n in [*names, "speed"]:
            out[f"{p}_{n}"] = F.when(~void, F.col(f"{p}_{n}"))
    out["flags"] = F.when(anything, F.col("flags").bitwiseOR(F.lit(bit))).otherwise(F.col("flags"))
    return df.withColumns(out)


def flag_unphysical(df: DataFrame, epoch: str, value: str, threshold: float, bit: int) -> DataFrame:
    """Sets a bit on all rows of an epoch that has a value over the threshold."""
    high = df.groupBy(epoch).agg(F.max(F.coalesce(F.col(value) > threshold, F.lit(False))).alias("_h"))
    return df.join(high, epoch).withColumn("flags", F.when(F.col("_h"), F.col("flags").bitwiseOR(F.lit(bit))).otherwise(F.col("flags"))).drop("_h")
