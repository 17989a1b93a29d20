"""Spectra, moments, light curves and solar-rotation products."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType
from pyspark.sql.window import Window

from .joins import interp_join, range_join


def look_average(df: DataFrame, keys: list[str], value: str, weight: Column, floor: float) -> DataFrame:
    """Values raised to the floor, weighted mean over detectors, then plain mean over sectors."""
    one = df.groupBy(*keys, "sector").agg(F.try_divide(F.sum(F.greatest(F.col(value), F.lit(floor)) * weight), F.sum(F.when(F.col(value).isNotNull(), weight))).alias(value))
    return one.groupBy(*keys).agg(F.avg(value).alias(value))


def spectrum_1d(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of psd sin(pa) delta (degrees); NULLs are skipped."""
    return df.groupBy(*keys).agg(F.sum(F.col("psd") * F.sin(F.radians("pa")) * F.radians("delta")).alias("spectrum"))


def inward_outward(df: DataFrame, epoch: str, energy: str, reference: float) -> DataFrame:
    """Half-range sums (below and from 90 degrees, factor 2 delta); `inward` is the larger half at the reference energy."""
    term = F.col("psd") * F.sin(F.radians("pa")) * F.radians(F.col("delta") * 2)
    h = df.groupBy(epoch, energy).agg(F.sum(F.when(F.col("pa") < 90, term)).alias("low"), F.sum(F.when(F.col("pa") >= 90, term)).alias("high"))
    label = h.where(F.col(energy) == reference).select(epoch, (F.col("low") >= F.col("high")).alias("_in"))
    j = h.join(label, epoch, "left")
    return j.select(epoch, energy, F.when(F.col("_in"), F.col("low")).otherwise(F.col("high")).alias("inward"), F.when(F.col("_in"), F.col("high")).otherwise(F.col("low")).alias("outward"))


#: Fixed: sectors of 30 that enter moments
MOMENT_SECTORS = 28


def moments(df: DataFrame, epoch: str) -> DataFrame:
    """Density, velocity, tensor (xx, xy, yy, xz, yz, zz) and heat flux of psd over cells with speed v, direction
    (ux, uy, uz) and weight w; NULL where the density is not positive.  Two passes: about the mean velocity."""
    d = df.where(F.col("sector") < MOMENT_SECTORS).withColumn("_fw", F.col("psd") * F.col("w"))
    v = {c: F.col("v") * F.col(f"u{c}") for c in "xyz"}
    first = d.groupBy(epoch).agg(F.sum("_fw").alias("density"), *[F.sum(F.col("_fw") * v[c]).alias(f"_f{c}") for c in "xyz"])
    first = first.where("density > 0").select(epoch, "density", *[(F.col(f"_f{c}") / F.col("density")).alias(f"v{c}") for c in "xyz"])
    j = d.join(first, epoch).withColumns({f"_c{c}": v[c] - F.col(f"v{c}") for c in "xyz"})
    c2 = F.col("_cx") * F.col("_cx") + F.col("_cy") * F.col("_cy") + F.col("_cz") * F.col("_cz")
    second = [F.sum(F.col("_fw") * F.col(f"_c{a}") * F.col(f"_c{b}")).alias(f"t{a}{b}") for a, b in ("xx", "xy", "yy", "xz", "yz", "zz")]
    second += [(0.5 * F.sum(F.col("_fw") * c2 * F.col(f"_c{c}"))).alias(f"q{c}") for c in "xyz"]
    out = j.groupBy(epoch).agg(*[F.first(c).alias(c) for c in ("density", "vx", "vy", "vz")], *second)
    return df.select(epoch).distinct().join(out, epoch, "left")


def group_mean_std(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean and sample deviation (NULL for one row)."""
    return df.groupBy(key).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def mean_std_good(df: DataFrame, keys: list[str], good: Column, values: list[str]) -> DataFrame:
    """Mean and population deviation over good rows."""
    return df.groupBy(*keys).agg(*[f(F.when(good, F.col(c))).alias(f"{c}_{n}") for c in values for f, n in ((F.avg, "mean"), (F.stddev_pop, "std"))])


def sum_good_histograms(df: DataFrame, keys: list[str], good: Column, bins: int, mask: int, flags: dict[str, int]) -> DataFrame:
    """Per bin counts, exposure (period * spins / bins) and flags (masked) of good rows; how often each named flag
    occurs, over all rows."""
    exposure = F.col("period") * F.col("spins") / bins
    agg = [F.sum(F.when(good, F.col("counts"))).alias("counts"), F.sum(F.when(good, exposure)).alias("exposure"), F.bit_or(F.when(good, F.col("flag_bits").bitwiseAND(F.lit(mask)))).alias("flag_bits")]
    return df.groupBy(*keys).agg(*agg, *[F.count_if(F.col("flag_bits").bitwiseAND(F.lit(bit)) != 0).alias(n) for n, bit in flags.items()])


def rebin_spin(df: DataFrame, keys: list[str], angle: str, n: int, flagged: Column) -> DataFrame:
    """N bins (lo, hi] of the spin; flagged rows weigh nothing."""
    b = F.pmod(F.ceil(F.col(angle) / (360.0 / n)) - 1, F.lit(n)).cast("int")
    w = F.when(flagged, 0).otherwise(1)
    return df.groupBy(*keys, b.alias("bin")).agg(F.sum(F.col("counts") * w).alias("counts"), F.sum(F.col("exposure") * w).alias("exposure"))


def counts_to_flux(df: DataFrame, calibration: Column) -> DataFrame:
    """Flux and its error, NULL without exposure."""
    e = F.col("exposure") * calibration
    return df.withColumns({"flux": F.try_divide(F.col("counts").cast("double"), e), "flux_sigma": F.try_divide(F.sqrt(F.col("counts").cast("double")), e)})


def rebin_lightcurve(df: DataFrame, keys: list[str], bin_col: str, per: int, masked: Column) -> DataFrame:
    """Sky background taken off, exposure-weighted means of blocks of `per` bins (masked ones weigh 0), then the
    block's own background taken off (columns flux, sky, exposure, bin_background)."""
    w = F.when(masked, 0.0).otherwise(F.col("exposure"))
    g = df.groupBy(*keys, F.floor(F.col(bin_col) / per).alias("block"))
    return g.agg((F.try_divide(F.sum((F.col("flux") - F.col("sky")) * w), F.sum(w)) - F.avg("bin_background")).alias("flux"), F.sum(w).alias("exposure"))


def circular_mean(df: DataFrame, keys: list[str], order: str, angle: str) -> DataFrame:
    """Mean of angles unwrapped along the order, back on the circle.  Decimal angles are added exactly and divided
    once, so the mean is the double nearest to the true one, in whatever order they come."""
    w = Window.partitionBy(*keys).orderBy(order)
    step = F.col(angle) - F.lag(angle).over(w)
    turns = F.when(step > 180, -360).when(step < -180, 360).otherwise(0)
    d = df.withColumn("_t", F.coalesce(turns, F.lit(0))).withColumn("_u", F.col(angle) + F.sum("_t").over(w))
    kind = df.schema[angle].dataType
    units = 10 ** kind.scale if isinstance(kind, DecimalType) else 1
    mean = F.try_divide((F.sum("_u") * units).cast("double"), F.count("_u") * units)
    # taken to within half a turn of 0 first, so a mean is the same double from whichever side it was unwrapped
    near = mean - 360 * F.round(mean / 360)
    return d.groupBy(*keys).agg(((near + 360) % 360).alias(angle))


def rotation_mean(df: DataFrame, number: Column, value: str, grid: DataFrame, at: str, distance: Column | None = None, fill: float | None = None) -> DataFrame:
    """Means by whole rotation number, which stand at that number, interpolated to the grid; `distance` (au) scales
    values by its square.  A fill value counts as one more sample, at the grid's end, where that lies past the data; grid
    points past the last sample are then flagged as `filled`.  Raises when read, unless the means reach from the grid's
    start to its end."""
    v = F.col(value) * distance * distance if distance is not None else F.col(value)
    seen = df.select(number.cast("double").alias("_at"), v.cast("double").alias(value))
    last, start, end = seen.agg(F.max("_at")).scalar(), grid.agg(F.min(at)).scalar(), grid.agg(F.max(at)).scalar()
    past = F.lit(False)
    if fill is not None:
        past = F.col(at) > last
        seen = seen.unionByName(grid.agg(F.max(at).cast("double").alias("_at")).where(F.col("_at") > last).select("_at", F.lit(float(fill)).alias(value)))
    m = seen.groupBy(F.floor("_at").cast("double").alias("_x")).agg(F.avg(value).alias(value))
    d = interp_join(grid, F.col(at), m, "_x", value, 1.0)
    short = (m.agg(F.min("_x")).scalar() > start) | (m.agg(F.max("_x")).scalar() < end)
    checked = F.when(F.coalesce(short, F.lit(True)), F.raise_error(F.lit("the data do not cover the grid")).cast("double")).otherwise(F.col(f"{value}_at"))
    return d.withColumns({"filled": past, f"{value}_at": checked})


def anchor_profile(df: DataFrame, keys: list[str], lat: str, value: str, anchor: Column) -> DataFrame:
    """A latitude profile scaled so that its equator equals the anchor."""
    equator = F.max(F.when(F.col(lat) == 0, F.col(value))).over(Window.partitionBy(*keys))
    return df.withColumn("scaled", F.try_divide(F.col(value), equator) * anchor)


def split_rates(df: DataFrame) -> DataFrame:
    """Charge exchange = total - photo; errors add."""
    return df.withColumns({"cx": F.col("total") - F.col("photo"), "cx_sigma": F.col("total_sigma") + F.col("photo_sigma")})


def photoion_mean(flux: DataFrame, windows: DataFrame, profile: DataFrame, rate: Callable[[Column], Column] = lambda v: v, start: Callable[[Column], Column] = lambda cr: cr, daily: DataFrame | None = None, width: float = 1.0) -> DataFrame:
    """Windows (cr, t0, t1), any intervals, both ends included; flux and daily (t, value; daily: flux itself).  Where
    more than two daily values lie inside, the mean and sample deviation of their rates; else the rate of the flux on the
    line between the mean (t, value) of the rotations before and after, at the window's middle, without a deviation.
    start(cr) is where a rotation begins.  Raises when read if the rotation after has two values or less then; without
    any before the result is NULL.  Times a latitude profile (lat, share)."""
    w = windows.select(F.col("cr"), F.col("t0").cast("double").alias("t0"), F.col("t1").cast("double").alias("t1"))

    def inside(values: DataFrame, a: Column, b: Column, *agg: Column) -> DataFrame:
        spans = w.select("cr", a.cast("double").alias("a"), b.cast("double").alias("b"))
        return range_join(values.select("t", "value"), F.col("t"), spans, F.col("a"), F.col("b"), width, closed="both").groupBy("cr").agg(*agg)

    own = inside(flux if daily is None else daily, F.col("t0"), F.col("t1"), F.count("*").alias("n"), F.avg(rate(F.col("value"))).alias("mean"), F.stddev_samp(rate(F.col("value"))).alias("std"))
    cr = F.col("cr")
    side = lambda i, k: inside(flux, start(cr + i), start(cr + i + 1), F.count("*").alias(f"n{k}"), F.avg("t").alias(f"t{k}_"), F.avg("value").alias(f"v{k}_"))
    m = w.join(own, "cr", "left").join(side(-1, 0), "cr", "left").join(side(1, 1), "cr", "left")
    share = F.try_divide((F.col("t0") + F.col("t1")) / 2 - F.col("t0_"), F.col("t1_") - F.col("t0_"))
    between = rate(F.col("v0_") + (F.col("v1_") - F.col("v0_")) * share)
    enough = F.coalesce(F.col("n") > 2, F.lit(False))
    none = F.raise_error(F.lit("no values in the rotation after, to interpolate with")).cast("double")
    photo = F.when(enough, F.col("mean")).when(F.coalesce(F.col("n1"), F.lit(0)) <= 2, none).otherwise(between)
    m = m.select("cr", photo.alias("photo"), F.when(enough, F.col("std")).alias("photo_sigma"))
    grid = profile.agg(F.collect_list(F.struct("lat", "share"))).scalar()  # a latitude grid: short
    return m.select("cr", "photo", "photo_sigma", F.explode(grid).alias("g")).select("cr", F.col("g.lat").alias("lat"), (F.col("photo") * F.col("g.share")).alias("photo"), "photo_sigma")


def invert_curve(df: DataFrame, rate: str, curve: list[tuple[float, float]]) -> DataFrame:
    """Speed of the curve point (speed, rate) nearest to the row's rate, and the density rate / point's rate; a rate
    below the curve raises.  The curve is a short configuration list."""
    points = F.array(*[F.struct(F.lit(float(r)).alias("r"), F.lit(float(v)).alias("v")) for v, r in curve])
    best = F.array_min(F.transform(points, lambda p: F.struct(F.abs(p["r"] - F.col(rate)).alias("d"), p["v"].alias("v"), p["r"].alias("r"))))
    low = min(r for _, r in curve)
    return df.withColumn("_b", F.when(F.col(rate) < low, F.raise_error(F.lit("rate below the curve")).cast("struct<d:double,v:double,r:double>")).otherwise(best)).withColumns({"speed": F.col("_b.v"), "density": F.col(rate) / F.col("_b.r")}).drop("_b")


def invariant(df: DataFrame, order: str, value: str, n: int) -> DataFrame:
    """Mean of the last n rotations."""
    return df.orderBy(F.col(order).desc()).limit(n).agg(F.avg(value).alias("invariant"))


def daily_sigma_clip(df: DataFrame, day: str, total: str, low: float, high: float) -> DataFrame:
    """`clipped`: outside the day's mean - low deviations to mean + high; a negative number turns a side off."""
    w = Window.partitionBy(day)
    m, s = F.avg(total).over(w), F.stddev_pop(total).over(w)
    d = df.withColumns({"_m": m, "_s": s})
    below = F.lit(False) if low < 0 else F.col(total) < F.col("_m") - low * F.col("_s")
    above = F.lit(False) if high < 0 else F.col(total) > F.col("_m") + high * F.col("_s")
    return d.withColumn("clipped", below | above).drop("_m", "_s")


def median_in_window(df: DataFrame, keys: list[str], t_us: Column, value: str, empty: float = 90.0) -> DataFrame:
    """Median from 0.5 up to (not at) 22.5 hours after the first sample, rounded half to even; `empty` if there is none."""
    d = df.withColumn("_t", t_us).withColumn("_s", F.min("_t").over(Window.partitionBy(*keys)))
    inside = (F.col("_t") >= F.col("_s") + int(0.5 * 3600e6)) & (F.col("_t") < F.col("_s") + int(22.5 * 3600e6))
    return d.groupBy(*keys).agg(F.coalesce(F.bround(F.median(F.when(inside, F.col(value)))), F.lit(empty)).alias("median"))


def chunk_mean_rate(df: DataFrame, keys: list[str], rate: str, sigma: str) -> DataFrame:
    """Mean over the sweeps of a chunk; error sqrt(sum s^2) / n."""
    return df.groupBy(*keys).agg(F.avg(rate).alias(rate), (F.sqrt(F.sum(F.col(sigma) * F.col(sigma))) / F.count("*")).alias(sigma))


def vdf(rate: Column, energy: Column, factor: Column, efficiency: Column, mass_per_charge: float = 1.0) -> Column:
    """4 pi (m/q) rate / (E G efficiency), the geometric factor G in km^2 (given in cm^2)."""
    return F.try_divide(4 * 3.141592653589793 * mass_per_charge * rate, energy * (factor * 1e-10) * efficiency)


def differential_flux(rate: Column, energy: Column, factor: Column, efficiency: Column) -> Column:
    """A46"""
    return F.try_divide(rate, energy * factor * efficiency) / 1e10


def peak_window(df: DataFrame, keys: list[str], bin_col: str, value: str, half: int, bins: int) -> DataFrame:
    """Rows within `half` bins of the largest mean, the peak moved in from the edges (bins 0 to bins - 1)."""
    m = df.groupBy(*keys, bin_col).agg(F.avg(value).alias("_m"))
    peak = m.groupBy(*keys).agg(F.max_by(bin_col, F.struct("_m", -F.col(bin_col))).alias("_p"))
    peak = peak.withColumn("peak", F.greatest(F.lit(half), F.least(F.lit(bins - 1 - half), F.col("_p")))).drop("_p")
    return df.join(peak, keys).where(F.abs(F.col(bin_col) - F.col("peak")) <= half)


def peak_speed(df: DataFrame, keys: list[str], bin_col: str, rate: str, voltage: str, speed: Callable[[Column], Column], half: int = 4, bins: int = 62) -> DataFrame:
    """Rate-weighted mean of speed(voltage) around the peak.  Rates and voltages are averaged over sweeps first (NULLs
    left out); then bins without a mean, of a negative rate or of no positive voltage are left out.  NULL without any."""
    mean = df.groupBy(*keys, F.col(bin_col).alias("_bin")).agg(F.avg(rate).alias("_rate"), F.avg(voltage).alias("_voltage"))
    w = peak_window(mean.where("_rate IS NOT NULL"), keys, "_bin", "_rate", half, bins)
    good = w.where("_rate >= 0 AND _voltage > 0")
    got = good.groupBy(*keys).agg(F.try_divide(F.sum(speed(F.col("_voltage")) * F.col("_rate")), F.sum("_rate")).alias("speed"))
    return df.select(*keys).distinct().join(got, keys, "left")


def block_velocity(df: DataFrame, by: list[str], order: str, n: int, components: list[str], flags: str) -> DataFrame:
    """Mean vector of n rows (NULL if any is NULL), flags joined."""
    d = df.withColumn("block", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1) / n))
    mean = [F.when(F.count(c) == F.count("*"), F.avg(c)).alias(c) for c in components]
    return d.groupBy(*by, "block").agg(*mean, F.bit_or(flags).alias(flags))


def electron_density(n: Column, alpha: Column) -> Column:
    """A50"""
    return n * (1 + 2 * alpha)


def epoch_half_width(df: DataFrame, epoch: str, energies: int, spins: int, sectors: int) -> DataFrame:
    """Half of settle * (energies / spins) * sectors + acquisition (microseconds), in nanoseconds."""
    total = F.sum("settle") * (energies / spins) * sectors + F.sum("acquisition")
    return df.groupBy(epoch).agg((total / 2 * 1000).cast("long").alias("half_ns"))


def second_peak(df: DataFrame, keys: list[str], energy: str, counts: str, background: str) -> DataFrame:
    """Peak of counts less twice the background (not below 0) on the way up from 1.5 times the main peak's energy,
    from the first rise on, up to 4 times; `error` tells why there is none.  Also the window from three bins before to
    one after."""
    d = df.withColumn("_res", F.greatest(F.lit(0.0), F.col(counts) - 2 * F.col(background)))
    main = d.groupBy(*keys).agg(F.max_by(energy, F.struct(counts, -F.col(energy))).alias("_e0"))
    w = Window.partitionBy(*keys).orderBy(energy)
    d = d.withColumns({"_before": F.lag("_res").over(w), "_i": F.row_number().over(w)}).join(main, keys)
    d = d.withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    far = (F.col(energy) >= 1.5 * F.col("_e0")) & (F.col(energy) <= 4 * F.col("_e0"))
    rise = F.min(F.when(far & (F.col("_res") > F.col("_before")), F.col(energy))).over(Window.partitionBy(*keys))
    d = d.withColumn("_rise", rise)
    ok = far & (F.col(energy) >= F.col("_rise"))
    g = d.groupBy(*keys).agg(F.max(F.when(ok, F.struct(F.col("_res"), -F.col(energy), F.col("_i"), F.col("_n")))).alias("p"), F.first("_e0").alias("main_energy"))
    i = F.col("p._i")
    error = F.when(F.col("p").isNull(), "no rise").when((i <= 3) | (i >= F.col("p._n")), "at the edge")
    return g.select(*keys, "main_energy", i.alias("peak_bin"), F.when(error.isNull(), i - 3).alias("first_bin"), F.when(error.isNull(), i + 1).alias("last_bin"), error.alias("error"))


def top_per_group(words: DataFrame, event: str, order: str, included: str) -> DataFrame:
    """Per detector group that the event's rule includes (array column `included`; NULL: no rule) the word with the
    highest signal (low gain counts 20 times) among unsaturated ones (adc below 2047), the first by `order` of equal
    ones.  An event is void (no rows) if an included group has none."""
    ok = words.where((F.col("adc") < 2047) & F.array_contains(included, F.col("group"))).withColumn("signal", F.col("adc") * F.when(F.col("low_gain"), 20).otherwise(1))
    best = ok.groupBy(event, "group").agg(F.max_by(F.struct("signal", "address", "adc", "low_gain", included), F.struct(F.col("signal"), -F.col(order))).alias("w")).select(event, "group", "w.*")
    have = best.groupBy(event).agg(F.count("*").alias("n"), F.first(F.size(included)).alias("m")).where("n = m").select(event)
    return best.join(have, event, "left_semi")


def event_energies(best: DataFrame, gain: DataFrame, event: str, delta: Column, prime: Column, cosine: Column) -> DataFrame:
    """T4: energies cosine * (adc * a + b) of the selected words: of the groups of the two roles (columns of best) and
    their total (gain: low_gain, address, a, b)."""
    e = best.join(gain, ["low_gain", "address"]).withColumn("_e", cosine * (F.col("adc") * F.col("a") + F.col("b")))
    role = lambda g: F.sum(F.when(F.col("group") == g, F.col("_e")))
    return e.groupBy(event).agg(role(delta).alias("e_delta"), role(prime).alias("e_prime"), F.sum("_e").alias("total"))


def nearest_index(df: DataFrame, target: Column, x: str) -> DataFrame:
    """T5: one row: the nearest value of x and the following one."""
    d = df.withColumn("_next", F.lead(x).over(Window.orderBy(x)))
    return d.agg(F.min_by(F.struct(F.col(x).alias("nearest"), F.col("_next").alias("following")), F.struct(F.abs(F.col(x) - target), F.col(x))).alias("r")).select("r.*")
