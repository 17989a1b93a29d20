"""Scalar expressions on Columns: vectors, angles, sky pixels, times, flags, closed-form physics.

Vectors are triples of Columns.  A missing value is NULL; a division by zero gives NULL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Vector = tuple[Column, Column, Column]

# fixed values
ELECTRON_CHARGE, PROTON_MASS, BOLTZMANN = 1.602176634e-19, 1.67262192369e-27, 1.380649e-23
ROTATION_DAYS, FIRST_ROTATION_JD = 27.2753, 2398167.329
DEADTIME_S = 183.7e-9


def num(c: str | float | Column) -> Column:
    if isinstance(c, Column):
        return c.cast("double")
    return F.col(c).cast("double") if isinstance(c, str) else F.lit(float(c))


def safe_divide(a, b) -> Column:
    """M1: NULL where the denominator is 0."""
    return F.try_divide(num(a), num(b))


# M2
def vector(*cs) -> Vector:
    return tuple(num(c) for c in cs)


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vector, b: Vector) -> Vector:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def unit_vector(a: Vector) -> Vector:
    n = norm(a)
    return tuple(F.try_divide(c, n) for c in a)


def clamp(c: Column, low: float, high: float) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def pitch_angle(v: Vector, b: Vector) -> Column:
    """M3: degrees between two directions."""
    return F.degrees(F.acos(clamp(dot(unit_vector(v), unit_vector(b)), -1.0, 1.0)))


def gyrophase(v: Vector, b: Vector) -> Column:
    """M4: angle about the field, from the axis across it and y; NULL where the field is along y."""
    zero, one = F.lit(0.0), F.lit(1.0)
    across = unit_vector(cross((zero, one, zero), b))
    third = unit_vector(cross(b, across))
    return F.pmod(F.degrees(F.atan2(dot(v, across), dot(v, third))), F.lit(360.0))


def rotate(v: Vector, matrix) -> Vector:
    """M5: matrix (3 x 3 numbers or Columns) times vector."""
    return tuple(sum((num(m) * c for m, c in zip(row[1:], v[1:], strict=True)), num(row[0]) * v[0]) for row in matrix)


def turn_about_x(degrees: float) -> list[list[float]]:
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return [[1.0, 0.0, 0.0], [0.0, c, -s], [0.0, s, c]]


def sector_vector(declination: Column, inclination: Column) -> Vector:
    """M6: unit vector of azimuth `declination` and polar angle `inclination` (degrees)."""
    d, i = F.radians(declination), F.radians(inclination)
    return F.sin(i) * F.cos(d), F.sin(i) * F.sin(d), F.cos(i)


def look_vector(elevation: Column, azimuth: Column) -> Vector:
    e, a = F.radians(elevation), F.radians(azimuth)
    return F.cos(e) * F.cos(a), F.cos(e) * F.sin(a), F.sin(e)


def reverse(v: Vector) -> Vector:
    """A particle moves against the direction in which it is seen."""
    return tuple(-c for c in v)


def speed_from_energy(energy_ev, mass_kg: float = PROTON_MASS, charges: float = 1.0) -> Column:
    """M7: km/s."""
    return F.sqrt(2 * num(energy_ev) * charges * ELECTRON_CHARGE / mass_kg) / 1000


def energy_from_speed(speed_km_s, mass_kg: float = PROTON_MASS, charges: float = 1.0) -> Column:
    v = num(speed_km_s) * 1000
    return v * v * mass_kg / (2 * charges * ELECTRON_CHARGE)


def shift_velocity(v: Vector, wind: Vector) -> Vector:
    return tuple(a - b for a, b in zip(v, wind, strict=True))


def flow_to_look_angles(v: Vector) -> tuple[Column, Column]:
    """M8: (azimuth, elevation) in degrees from which a flow comes."""
    return F.degrees(F.atan2(-v[0], -v[1])), F.degrees(F.asin(clamp(F.try_divide(-v[2], norm(v)), -1.0, 1.0)))


def thermal_speed(temperature_k, mass_kg: float = PROTON_MASS) -> Column:
    """M9: km/s."""
    return F.sqrt(num(temperature_k) * BOLTZMANN / mass_kg) / 1000


def temperature(thermal_km_s, mass_kg: float = PROTON_MASS) -> Column:
    v = num(thermal_km_s) * 1000
    return v * v * mass_kg / BOLTZMANN


def deadtime_factor(rate) -> Column:
    """M10"""
    return 1 / (1 + DEADTIME_S * num(rate))


def mass_per_charge(energy_per_charge, tof, volts_kv: float = 15.0, loss_kv: float = 0.0, k: float = 1.692e-5) -> Column:
    """(E/q + post-acceleration - loss) tof^2 k."""
    t = num(tof)
    return (num(energy_per_charge) + volts_kv - loss_kv) * t * t * k


def event_mass(energy, tof, coefficients) -> Column:
    """exp of c0 + c1 e + c2 t + c3 e t + c4 e^2 + c5 t^3, e and t logarithms."""
    e, t = F.ln(num(energy)), F.ln(num(tof))
    c = [num(x) for x in coefficients]
    return F.exp(c[0] + c[1] * e + c[2] * t + c[3] * e * t + c[4] * e * e + c[5] * t * t * t)


def mass_from_ssd(ssd_energy, energy_per_nucleon) -> Column:
    return safe_divide(ssd_energy, energy_per_nucleon)


def double_power_law(x, a1, b1, a2, b2, gamma) -> Column:
    """M12"""
    first, second, g = num(a1) * F.pow(num(x), num(b1)), num(a2) * F.pow(num(x), num(b2)), num(gamma)
    return F.pow(F.pow(first, g) + F.pow(second, g), 1 / g)


#: Fixed limits of (e_prime, delta_e) by range
CHARGE_LIMITS = {2: (0.2, 860.0, 0.1, 430.0), 3: (1.0, 4300.0, 0.2, 860.0), 4: (1.0, 4300.0, 1.0, 4300.0)}


def charge_from_de(detector_range: Column, e_prime: Column, delta_e: Column, curves: Column) -> Column:
    """Charge between the two bracketing curves, in logarithms.

    curves: array<struct<delta, charge>> evaluated at e_prime, sorted by delta; NULL outside the range's limits."""
    inside = F.lit(False)
    for n, (p0, p1, d0, d1) in CHARGE_LIMITS.items():
        inside = inside | ((detector_range == n) & e_prime.between(p0, p1) & delta_e.between(d0, d1))
    below = F.size(F.filter(curves, lambda c: c["delta"] < delta_e))
    upper = F.greatest(F.lit(1), F.least(F.size(curves) - 1, below))
    lo, hi = F.get(curves, upper - 1), F.get(curves, upper)
    slope = F.ln(hi["charge"] / lo["charge"]) / F.ln(hi["delta"] / lo["delta"])
    return F.when(inside, lo["charge"] * F.pow(delta_e / lo["delta"], slope))


def lonlat_vector(lon: Column, lat: Column) -> Vector:
    return F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)


def great_circle(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Radians between two directions."""
    return F.acos(clamp(dot(lonlat_vector(lon1, lat1), lonlat_vector(lon2, lat2)), -1.0, 1.0))


def spherical_coords(v: Vector) -> tuple[Column, Column, Column]:
    """(radius, longitude in [0, 2 pi), latitude); zeros where a direction is not defined."""
    r = norm(v)
    lon = F.when((v[0] == 0) & (v[1] == 0), 0.0).otherwise(F.pmod(F.atan2(v[1], v[0]), F.lit(2 * math.pi)))
    return r, lon, F.when(r == 0, 0.0).otherwise(F.asin(clamp(F.try_divide(v[2], r), -1.0, 1.0)))


def spin_to_sky(lon0: Column, lat0: Column, spin: Column, theta: Column) -> tuple[Column, Column]:
    """(lon, lat) of the point at `spin` (from north, growing to lower longitudes) on a circle of radius theta."""
    c0, s0 = F.cos(lat0), F.sin(lat0)
    lat = F.asin(clamp(s0 * F.cos(theta) + c0 * F.sin(theta) * F.cos(spin), -1.0, 1.0))
    east = F.atan2(-F.sin(spin) * F.sin(theta), F.cos(theta) * c0 - F.sin(theta) * s0 * F.cos(spin))
    return F.pmod(lon0 + east, F.lit(2 * math.pi)), lat


def sky_to_spin(lon0: Column, lat0: Column, lon: Column, lat: Column) -> tuple[Column, Column]:
    """(theta, spin): the inverse."""
    d = lon - lon0
    north = F.sin(lat) * F.cos(lat0) - F.cos(lat) * F.sin(lat0) * F.cos(d)
    return great_circle(lon0, lat0, lon, lat), F.pmod(F.atan2(-F.cos(lat) * F.sin(d), north), F.lit(2 * math.pi))


def rect_pixel(lon: Column, lat: Column, step: float) -> Column:
    """Row-major number of a step x step degree cell, from (0, -90)."""
    columns, rows = round(360 / step), round(180 / step)
    x = F.least(F.lit(columns - 1), F.floor(F.pmod(lon, F.lit(360.0)) / step))
    y = F.least(F.lit(rows - 1), F.floor((lat + 90) / step))
    return (y * columns + x).cast("long")


def healpix_ring(lon: Column, lat: Column, nside: int) -> Column:
    """Ring-scheme pixel of a direction in degrees (Gorski et al. 2005)."""
    z = F.sin(F.radians(lat))
    za = F.abs(z)
    t = F.pmod(F.radians(lon) * 2 / math.pi, F.lit(4.0))
    a, b = nside * (0.5 + t), nside * z * 0.75
    jp, jm = F.floor(a - b), F.floor(a + b)
    ring = nside + 1 + jp - jm
    ip = F.pmod(F.floor((jp + jm - nside + 2 - F.pmod(ring, F.lit(2))) / 2), F.lit(4 * nside))
    belt = 2 * nside * (nside - 1) + (ring - 1) * 4 * nside + ip
    frac, height = t - F.floor(t), nside * F.sqrt(3 * (1 - za))
    cap = F.floor(frac * height) + F.floor((1 - frac) * height) + 1
    ic = F.pmod(F.floor(t * cap), 4 * cap)
    polar = F.when(z > 0, 2 * cap * (cap - 1) + ic).otherwise(12 * nside * nside - 2 * cap * (cap + 1) + ic)
    return F.when(za <= 2 / 3, belt).otherwise(polar).cast("long")


def julian_date(ts: Column) -> Column:
    return F.unix_micros(ts) / 86400e6 + 2440587.5


def rotation_number(jd: Column) -> Column:
    """Solar rotation number with its fraction."""
    return (jd - FIRST_ROTATION_JD) / ROTATION_DAYS + 1


def rotation_start(number: Column) -> Column:
    """Julian date at which a rotation starts."""
    return (number - 1) * ROTATION_DAYS + FIRST_ROTATION_JD


def cr_of_timestamp(ts: Column) -> Column:
    """Rotation of an instant, cut to a whole number."""
    return rotation_number(julian_date(ts)).cast("long")


def tt2000_to_ts(ns: Column) -> Column:
    """Nanoseconds since 2000-01-01T11:58:55.816 to a timestamp (microseconds)."""
    return F.timestamp_micros(F.floor(ns / 1000) + 946727935816000)


def yday_to_ts(year: Column, day: Column, hour: Column | None = None) -> Column:
    first = F.make_timestamp(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return F.timestamp_micros(F.unix_micros(first) + ((day - 1) * 86400000000 + (hour if hour is not None else F.lit(0)) * 3600000000).cast("long"))


def decimal_year(ts: Column) -> Column:
    a = F.unix_micros(F.date_trunc("year", ts))
    b = F.unix_micros(F.date_trunc("year", F.add_months(F.date_trunc("year", ts), 12).cast("timestamp")))
    return F.year(ts) + (F.unix_micros(ts) - a) / (b - a)


def flag_set(flags: Column, bit: int, when: Column) -> Column:
    """M17"""
    return F.when(when, flags.bitwiseOR(F.lit(bit))).otherwise(flags)


def flag_has(flags: Column, bit: int) -> Column:
    return flags.bitwiseAND(F.lit(bit)) != 0


def flag_translate(flags: Column, pairs: dict[int, int]) -> Column:
    out = F.lit(0)
    for old, new in pairs.items():
        out = flag_set(out, new, flag_has(flags, old))
    return out


def unpack_bits(word: Column, layout: list[tuple[str, int]]) -> list[Column]:
    """Fields (name, width) from the lowest bit up."""
    out, at = [], 0
    for name, width in layout:
        out.append(F.shiftright(word, at).bitwiseAND(F.lit((1 << width) - 1)).alias(name))
        at += width
    return out


#: Fixed layout of a pulse word, lowest bits first
PULSE_WORD = [("adc", 11), ("overflow", 1), ("address", 6), ("low_gain", 1), ("last", 1)]


def decode_linear(value: Column, low: float, high: float, bits: int) -> Column:
    """Undoes the linear coding of [low, high] into n bits."""
    a = (2**bits - 1) / (high - low)
    return (value + low * a) / a


def decode_linear_std(variance: Column, low: float, high: float, bits: int) -> Column:
    return F.sqrt(variance) / ((2**bits - 1) / (high - low))


def threshold_flag(value: Column, threshold: float) -> Column:
    """1 from the threshold on; a negative threshold turns it off."""
    return F.lit(0) if threshold < 0 else F.when(value >= threshold, 1).otherwise(0)


def relative_diff_flag(a: Column, b: Column, threshold: float) -> Column:
    return threshold_flag(F.coalesce(F.try_divide(F.abs(a - b), a + b), F.lit(0.0)), threshold)


def cx_cross_section(kev: Column) -> Column:
    """Charge-exchange cross-section in cm^2 (Swaczyna et al. 2025); fixed coefficients."""
    a1, a2, a3, a4, a5, a6, a7, a8 = 4.8569, 21.906, 31.487, 0.12018, 4.1402e-6, 3.7524, 8.8476e-12, 6.1091
    return 1e-16 * a1 * F.ln(a2 / kev + a3) / (1 + a4 * kev + a5 * F.pow(kev, F.lit(a6)) + a7 * F.pow(kev, F.lit(a8)))


def energy_flux(n: Column, v: Column, alpha: Column) -> Column:
    """Energy flux in erg / s / cm^2 of n per cm^3 at v km/s with an alpha share (Le Chat et al. 2012)."""
    mass, helium, gravity = 1.67262192369e-24, 6.6446573357e-24, 1.3271244e26 / 6.957e10
    speed = v * 1e5
    return n * (mass + alpha * helium) * speed * (0.5 * speed * speed + gravity)


def photoion_from_f107(flux: Column) -> Column:
    """Photoionization rate from the 10.7 cm flux; fixed coefficients."""
    return -2.9819e-8 + 2.416e-8 * F.pow(flux, F.lit(0.4017))


def density_1au(density: Column, distance_au: Column) -> Column:
    """An observed density scaled to 1 au: it falls with the square of the distance."""
    return density * distance_au * distance_au


#: Count limits and the variance below each
COUNT_LIMITS = [32, 64, 128, 256, 1024, 2048, 3072, 5120, 9216, 17408, 33792]
COUNT_VARIANCES = [0, 0.25, 1.25, 5.25, 21.25, 85.25, 341.25, 1365.25, 5461.25, 21845.25, 87381.25]


def count_weight(counts: Column, duration: Column) -> Column:
    """Relative error of a compressed count."""
    variance = F.lit(349525.25)
    for limit, value in reversed(list(zip(COUNT_LIMITS, COUNT_VARIANCES, strict=True))):
        variance = F.when(counts < limit / F.greatest(F.lit(0.1), 1 - 1e-9 * limit / duration), F.lit(float(value))).otherwise(variance)
    return F.when(counts <= 1.5, F.lit(0.8165)).otherwise(F.sqrt(variance + counts) / counts)


def let(value: Column, body) -> Column:
    """body(value) with value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _triple(v: Vector) -> Column:
    return F.struct(*[c.alias(n) for c, n in zip(v, "xyz", strict=True)])


def _parts(s: Column) -> Vector:
    return s["x"], s["y"], s["z"]


def rotate_tensor_to_field(t: list[Column], b: Vector) -> Column:
    """struct<parallel, perpendicular, ratio> (perpendicular: mean; ratio >= 1) of a tensor (xx, xy, yy, xz, yz,
    zz) in a field-aligned frame."""
    rows = [(t[0], t[1], t[3]), (t[1], t[2], t[4]), (t[3], t[4], t[5])]

    def form(v: Vector) -> Column:
        return dot(v, tuple(dot(row, v) for row in rows))

    def across(s: Column) -> Column:
        u = _parts(s)
        a = [F.abs(c) for c in u]
        least = F.least(*a)
        e = (F.when(a[0] == least, 1.0).otherwise(0.0), F.when((a[0] != least) & (a[1] == least), 1.0).otherwise(0.0), F.when((a[0] != least) & (a[1] != least), 1.0).otherwise(0.0))
        return let(_triple(cross(u, e)), lambda c: F.struct(s.alias("u"), _triple(unit_vector(_parts(c))).alias("p")))

    def values(s: Column) -> Column:
        u, p = _parts(s["u"]), _parts(s["p"])
        return let(
            F.struct(form(u).alias("par"), form(p).alias("f1"), form(cross(u, p)).alias("f2")),
            lambda f: F.struct(
                (f["par"] * 1e4).alias("parallel"), ((f["f1"] + f["f2"]) * 5e3).alias("perpendicular"),
                F.when((f["f1"] > 0) & (f["f2"] > 0), F.greatest(f["f1"] / f["f2"], f["f2"] / f["f1"])).otherwise(0.0).alias("ratio"),
            ),
        )

    return let(let(_triple(unit_vector(b)), across), values)


def symmetric_eigenvalues(t: list[Column]) -> tuple[Column, Column, Column]:
    """Eigenvalues of (xx, xy, yy, xz, yz, zz), largest first, by the trigonometric closed form."""
    xx, xy, yy, xz, yz, zz = t
    mean = (xx + yy + zz) / 3
    p2 = (xx - mean) * (xx - mean) + (yy - mean) * (yy - mean) + (zz - mean) * (zz - mean) + 2 * (xy * xy + xz * xz + yz * yz)
    p = F.sqrt(p2 / 6)
    a, b, c = (xx - mean), (yy - mean), (zz - mean)
    det = a * (b * c - yz * yz) - xy * (xy * c - yz * xz) + xz * (xy * yz - b * xz)
    phi = F.acos(clamp(F.coalesce(F.try_divide(det, 2 * p * p * p), F.lit(0.0)), -1.0, 1.0)) / 3
    high = mean + 2 * p * F.cos(phi)
    low = mean + 2 * p * F.cos(phi + 2 * math.pi / 3)
    return high, 3 * mean - high - low, low


def principal_temperature(t: list[Column]) -> tuple[Column, Column, Column]:
    """(parallel, perpendicular, ratio): parallel is the eigenvalue farthest from the mean; NULL if any is
    negative or all are 0."""
    high, mid, low = symmetric_eigenvalues(t)
    mean = (high + mid + low) / 3
    first = (high - mean) >= (mean - low)
    par = F.when(first, high).otherwise(low)
    other = F.when(first, low).otherwise(high)
    ok = (low >= 0) & (high > 0)
    perp = F.sqrt(F.when(ok, mid * other))
    return F.when(ok, par), perp, F.when(ok, safe_divide(par, perp))


def erfc_argument(x: Column) -> Column:
    """The rational form's variable."""
    return 1 / (1 + 0.5 * x)


def erfc(x: Column, t: Column | None = None) -> Column:
    """Complementary error function of x >= 0 by a rational form (relative error below 1.2e-7); t: `erfc_argument(x)` as a
    column of its own, since it is repeated ten times."""
    t = erfc_argument(x) if t is None else t
    poly = F.lit(0.17087277)
    for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        poly = poly * t + c
    return t * F.exp(-x * x + poly)


def with_density_truncation(df: DataFrame, name: str, density: Column, speed: Column, parallel: Column, perpendicular: Column, energy_range: Column) -> DataFrame:
    """A halo density divided by its scale, kept within 1 to 5; NULL for temperatures above 1e8.  The scale is the
    factor by which a density integrated above `energy_range` (eV) misses its low energies, for a drifting Maxwellian.

    A DataFrame, in steps: as one expression the error function repeats its argument so often that the JVM does not
    compile the row's method."""
    ev_speed, per_ev, root = 593.097, 11600.0, 0.88623
    mean = (parallel + 2 * perpendicular) / 3
    use = (parallel > 1e4) & (perpendicular > 1e4) & (energy_range > 5) & (mean < 1e7)
    side = lambda sign: (ev_speed * F.sqrt("_from") + sign * F.col("_speed")) / ev_speed
    d = df.withColumns({"_use": use, "_density": F.when((parallel <= 1e8) & (perpendicular <= 1e8), density), "_kelvin": F.when(use, mean), "_from": F.when(use, energy_range), "_speed": speed})
    d = d.withColumns({"_v0": side(1), "_v1": side(-1)})
    d = d.withColumns({f"_q{i}": per_ev * F.col(f"_v{i}") * F.col(f"_v{i}") / F.col("_kelvin") for i in (0, 1)})
    d = d.withColumns({f"_s{i}": F.sqrt(f"_q{i}") for i in (0, 1)})
    d = d.withColumns({f"_t{i}": erfc_argument(F.col(f"_s{i}")) for i in (0, 1)})
    d = d.withColumns({f"_e{i}": F.when(F.col(f"_s{i}") < 9, erfc(F.col(f"_s{i}"), F.col(f"_t{i}"))).otherwise(0.0) for i in (0, 1)})
    one = [F.try_divide(F.lit(root), F.col(f"_s{i}") * F.exp(-F.col(f"_q{i}")) + root * F.col(f"_e{i}")) for i in (0, 1)]
    d = d.withColumn("_scale", 0.5 * (one[0] + one[1]))
    d = d.withColumn(name, F.col("_density") / F.when(F.col("_use"), clamp(F.col("_scale"), 1.0, 5.0)).otherwise(1.0))
    return d.drop("_use", "_density", "_kelvin", "_from", "_speed", "_scale", *[f"_{c}{i}" for c in "vqste" for i in (0, 1)])


def fit_parameters_to_moments(p: list[Column], mass_over_k: float) -> dict[str, Column]:
    """Temperatures, angles, velocity (km/s), density of a quadratic log-density fit.

    p: coefficients of x^2, y^2, z^2, xy, xz, yz, x, y, z and the constant; mass_over_k scales exponents."""
    alpha = F.atan2(p[5], p[4])
    beta = F.atan2(p[3], p[4] * F.sin(alpha))
    across = F.when(beta == 0, safe_divide(1.0, p[0])).otherwise(safe_divide(1.0, p[0] - F.try_divide(p[3] * p[4], p[5])))
    along = F.when(beta == 0, safe_divide(1.0, p[2])).otherwise(safe_divide(1.0, p[0] + p[1] + p[2] - 2 / across))
    minors = [
        [p[1] * p[2] - p[5] * p[5], p[5] * p[4] - p[3] * p[2], p[3] * p[5] - p[1] * p[4]],
        [p[5] * p[4] - p[3] * p[2], p[0] * p[2] - p[4] * p[4], p[4] * p[3] - p[0] * p[5]],
        [p[3] * p[5] - p[1] * p[4], p[4] * p[3] - p[0] * p[5], p[0] * p[1] - p[3] * p[3]],
    ]
    det = p[0] * minors[0][0] + p[3] * minors[0][1] + p[4] * minors[0][2]
    v = [F.coalesce(F.try_divide(-(p[6] * m[0] + p[7] * m[1] + p[8] * m[2]), det), F.lit(0.0)) for m in minors]
    drift = p[0] * v[0] * v[0] + p[1] * v[1] * v[1] + p[2] * v[2] * v[2] + p[3] * v[0] * v[1] + p[4] * v[0] * v[2] + p[5] * v[1] * v[2]
    bad = (along < 0) | (drift < 0) | (drift > 1e13)
    density = F.when(bad, 0.0).otherwise(across * F.sqrt(along) / math.pow(mass_over_k / math.pi, 1.5) * F.exp(p[9] + mass_over_k * drift))
    out = {"alpha": alpha, "beta": beta, "t_parallel": along, "t_perpendicular": across, "density": density}
    out |= {f"v{n}": c * 1e-5 for n, c in zip("xyz", v, strict=True)}
    return {k: F.when(p[9] == 0, 0.0).otherwise(c) for k, c in out.items()}


def log_value_floor(psd: Column) -> Column:
    """Logarithm with a floor; rows of psd <= 0 give NULL (to be dropped)."""
    return F.when(psd > 1e-35, F.ln(psd)).when(psd > 0, F.lit(-80.6))
