"""Combination, survival correction and background handling of sky maps.

A map is a long table of cells.  Columns (any that a map lacks may be missing):
cell keys, intensity, stat, sys, sys_minus, sys_plus, bg, bg_stat, bg_sys,
exposure, survival, obs_us (observation time in microseconds), flags.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _seen(extra: Column | None = None) -> Column:
    ok = F.col("intensity").isNotNull() & (F.coalesce(F.col("exposure"), F.lit(0.0)) > 0)
    return ok & extra if extra is not None else ok


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def _all_or_null(value: Column, needed: Column) -> Column:
    """value, if every seen row has `needed`."""
    return F.when(F.bool_and(F.when(_seen(), needed.isNotNull())), value)


def weighted_time_mean(time_us: Column, weight: Column) -> Column:
    """Mean instant; NULL times weigh nothing."""
    w = F.when(time_us.isNotNull(), weight)
    return F.round(_ratio(F.sum(w * time_us), F.sum(w))).cast("long")


def flag_or(flags: Column) -> Column:
    """A7"""
    return F.bit_or(flags)


def combine_unweighted(maps: DataFrame, cell: list[str]) -> DataFrame:
    """A1: plain mean of the maps that see a cell; both errors sqrt(sum of squares) / n; exposure is summed and
    flags are joined over all maps."""
    ok = _seen()
    n = F.sum(F.when(ok, 1.0))
    cols = set(maps.columns)
    out = [
        _ratio(F.sum(F.when(ok, F.col("intensity"))), n).alias("intensity"),
        *[_ratio(F.sqrt(F.sum(F.when(ok, F.col(c) * F.col(c)))), n).alias(c) for c in ("stat", "sys") if c in cols],
        F.sum(F.when(ok, F.col("exposure"))).alias("exposure"), flag_or(F.col("flags")).alias("flags"), F.sum(F.when(ok, 1).otherwise(0)).alias("n_maps"),
    ]
    if "survival" in cols:
        out.append(_all_or_null(_ratio(F.sum(F.when(ok, F.col("survival"))), n), F.col("survival")).alias("survival"))
    return maps.groupBy(*cell).agg(*out)


def combine_exposure_weighted(maps: DataFrame, cell: list[str]) -> DataFrame:
    """A2: mean weighted by exposure; stat sqrt(sum (stat w)^2) / W, sys sum(sys w) / W.  A background has its own
    mask, and where there is one the exposure given is that of the background's rows."""
    ok, w = _seen(), F.col("exposure")
    total = F.sum(F.when(ok, w))
    cols = set(maps.columns)
    out = [
        _ratio(F.sum(F.when(ok, F.col("intensity") * w)), total).alias("intensity"),
        _ratio(F.sqrt(F.sum(F.when(ok, F.pow(F.col("stat") * w, 2)))), total).alias("stat"),
        *[_ratio(F.sum(F.when(ok, F.col(c) * w)), total).alias(c) for c in ("sys",) if c in cols],
        *[_all_or_null(_ratio(F.sum(F.when(ok, F.col(c) * w)), total), F.col(c)).alias(c) for c in ("sys_minus", "sys_plus") if c in cols],
        flag_or(F.col("flags")).alias("flags"),
    ]
    if "obs_us" in cols:
        out.append(weighted_time_mean(F.col("obs_us"), F.when(ok, w)).alias("obs_us"))
    if "bg" in cols:
        seen_bg = F.col("bg").isNotNull() & (F.coalesce(w, F.lit(0.0)) > 0)
        bg_total = F.sum(F.when(seen_bg, w))
        out += [
            _ratio(F.sum(F.when(seen_bg, F.col("bg") * w)), bg_total).alias("bg"),
            _ratio(F.sqrt(F.sum(F.when(seen_bg, F.pow(F.col("bg_stat") * w, 2)))), bg_total).alias("bg_stat"),
            _ratio(F.sum(F.when(seen_bg, F.col("bg_sys") * w)), bg_total).alias("bg_sys"),
            bg_total.alias("exposure"),
        ]
    else:
        out.append(total.alias("exposure"))
    return maps.groupBy(*cell).agg(*out)


def combine_uncertainty_weighted(maps: DataFrame, cell: list[str]) -> DataFrame:
    """A3: mean weighted by 1 / stat^2 (a stat of 0 adds nothing); stat sqrt(1 / sum of weights); sys and time are
    weighted by exposure."""
    ok = _seen(F.col("stat").isNotNull() & (F.abs(F.col("stat")) < float("inf")))
    w, inverse = F.col("exposure"), F.try_divide(F.lit(1.0), F.col("stat") * F.col("stat"))
    weights = F.sum(F.when(ok, inverse))
    total = F.sum(F.when(ok, w))
    out = [
        _ratio(F.sum(F.when(ok, F.col("intensity") * inverse)), weights).alias("intensity"), F.sqrt(_ratio(F.lit(1.0), weights)).alias("stat"),
        *[_ratio(F.sum(F.when(ok, F.col(c) * w)), total).alias(c) for c in ("sys",) if c in maps.columns],
        total.alias("exposure"), flag_or(F.col("flags")).alias("flags"),
    ]
    if "obs_us" in maps.columns:
        out.append(weighted_time_mean(F.col("obs_us"), F.when(ok, w)).alias("obs_us"))
    return maps.groupBy(*cell).agg(*out)


def assert_maps_match(maps: DataFrame, cell: list[str], columns: list[str]) -> DataFrame:
    """A4: the maps; reading them raises unless each descriptive column has one value per cell over all maps (NULL
    equals NULL).  The check is a subquery of the plan: one aggregation, and one row of flags."""
    null = F.lit("\0null")
    varied = maps.groupBy(*cell).agg(*[(F.min(F.coalesce(F.col(c).cast("string"), null)) != F.max(F.coalesce(F.col(c).cast("string"), null))).alias(f"_varies_{c}") for c in columns])
    wrong = F.array_compact(F.array(*[F.when(F.bool_or(f"_varies_{c}"), F.lit(c)) for c in columns]))
    names = varied.agg(F.array_join(wrong, ", ")).scalar()
    return maps.where(F.when(names != "", F.raise_error(F.concat(F.lit("maps differ in "), names)).cast("boolean")).otherwise(F.lit(True)))


_COMBINATIONS: dict[str, Callable[[DataFrame, list[str]], DataFrame]] = {
    "unweighted": combine_unweighted, "exposure": combine_exposure_weighted, "uncertainty": combine_uncertainty_weighted,
}


def register_combination(name: str, combine: Callable[[DataFrame, list[str]], DataFrame]) -> None:
    """a named strategy for combine()."""
    _COMBINATIONS[name] = combine


def combine(name: str, maps: DataFrame, cell: list[str]) -> DataFrame:
    return _COMBINATIONS[name](maps, cell)


def combine_two_stage(maps: DataFrame, cell: list[str], sensor: str) -> DataFrame:
    """A5: by uncertainty within a sensor, then by exposure across sensors."""
    return combine_exposure_weighted(combine_uncertainty_weighted(maps, [*cell, sensor]), cell)


def project_to_sky(pset: DataFrame, keys: list[str]) -> DataFrame:
    """Survival of a pixel, weighted by exposure; rows (p, exposure, in_view, flags) of directions in view.
    A flag counts only where its exposure is not 0."""
    v = pset.where("in_view")
    return v.groupBy(*keys).agg(
        _ratio(F.sum(F.col("p") * F.col("exposure")), F.sum("exposure")).alias("survival"), F.sum("exposure").alias("exposure"), F.bit_or(F.when(F.col("exposure") != 0, F.col("flags")).otherwise(0)).alias("flags")
    )


def correct_survival(maps: DataFrame, survival: DataFrame, keys: list[str]) -> DataFrame:
    """Intensity, errors and background divided by the pixel's survival; its flags replace the map's."""
    s = survival.select(*keys, F.col("survival").alias("_p"), F.col("flags").alias("_flags"))
    j = maps.join(s, keys, "left")
    divided = [c for c in ("intensity", "stat", "sys", "sys_minus", "sys_plus", "bg", "bg_stat", "bg_sys") if c in maps.columns]
    return j.select(*[F.try_divide(F.col(c), F.col("_p")).alias(c) if c in divided else F.col("_flags").alias(c) if c == "flags" else F.col(c) for c in maps.columns])


def subtract_background(rates: DataFrame) -> DataFrame:
    """A10: rate - bg; stat errors in quadrature; the background's systematic error."""
    return rates.withColumns({"intensity": F.col("rate") - F.col("bg"), "stat": F.sqrt(F.col("stat") * F.col("stat") + F.col("bg_stat") * F.col("bg_stat")), "sys": F.col("bg_sys")})
