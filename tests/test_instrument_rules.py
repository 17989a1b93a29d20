"""Instrument rules retyped as small loops, and edges that the driver's tables do not have."""

import datetime as dt
import itertools
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.operators import fits, histograms, joins, spectra, windows


def test_geometric_factor_of_three_eras(spark):
    rng = np.random.default_rng(1)
    second, third = dt.date(2025, 11, 24), dt.date(2026, 1, 29)
    days = [dt.date(2025, 11, 23), second, dt.date(2026, 1, 28), third, dt.date(2026, 5, 1)]
    rows = [(days[int(rng.integers(5))], *(int(rng.integers(n)) for n in (4, 24, 5, 4, 24, 5))) for _ in range(3000)]
    rows += [(third, None, 1, 1, 1, 1, 1), (third, 3, 1, 1, None, 1, 1), (days[0], None, 1, 1, 1, 1, 1)]
    d = spark.createDataFrame(rows, "day date, h int, s int, e int, ah int, a_s int, ae int")
    got = d.select("*", histograms.reduced_factor(*[F.col(c) for c in ("h", "s", "e", "ah", "a_s", "ae", "day")], F.lit(second), F.lit(third)).alias("reduced")).collect()

    def rule(day, h, s, e, ah, a_s, ae):
        if h is None or ah is None:
            return False
        if day < second:
            return h > ah
        if day < third:
            return False
        if h != ah:
            return h > ah
        if s % 12 != a_s % 12:
            return s % 12 > a_s % 12
        return e > ae

    assert all(r.reduced == rule(*r[:7]) for r in got) and 0 < sum(r.reduced for r in got) < len(got)


def test_intensity_of_rates(spark):
    rates = spark.createDataFrame([(1, 2, 100.0, 4.0), (2, 2, 100.0, 4.0), (2, 3, None, 4.0)], "step int, azimuth int, rate double, energy double")
    factors = spark.createDataFrame([(1, 2, 2.0, 1.0), (2, 2, 4.0, 0.0), (2, 3, 1.0, 1.0)], "step int, azimuth int, full double, reduced double")
    eff = spark.createDataFrame([(1, 2, 0.5), (2, 2, 0.25), (2, 3, 1.0)], "step int, azimuth int, efficiency double")
    for reduced, want in ((F.lit(False), {(1, 2): 25.0, (2, 2): 25.0, (2, 3): None}), (F.lit(True), {(1, 2): 50.0, (2, 2): None, (2, 3): None})):
        got = histograms.rate_to_intensity(rates, factors, eff, reduced, ["step", "azimuth"], ["step", "azimuth"])
        assert {(r.step, r.azimuth): r.intensity for r in got.collect()} == want


def test_polar_elevations_are_overwritten_by_parity(spark):
    rng = np.random.default_rng(2)
    elevation = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 11, 10, 9, 8, 7, 6, 5, 4, 3, 2, 1]  # of azimuths 1 to 24
    half_spin = {(ep, en): int(rng.integers(5)) for ep in range(2) for en in range(3)}
    data = rng.integers(1, 100, (2, 3, 24, 24)).astype(float)  # both halves of the spin hold values
    rebinned = np.zeros((2, 3, 24, 13))
    for a in range(24):
        rebinned[:, :, :, elevation[a]] += data[:, :, :, a]
    for (ep, en), h in half_spin.items():
        first, second = slice(0, 12), slice(12, 24)
        for pole, source, target in ((0, first, second), (12, second, first)) if h % 2 == 0 else ((0, second, first), (12, first, second)):
            rebinned[ep, en, target, pole] = rebinned[ep, en, source, pole]
    rows = [(ep, en, half_spin[ep, en], s, a + 1, float(data[ep, en, s, a])) for ep, en, s, a in itertools.product(range(2), range(3), range(24), range(24))]
    rows += [(9, 9, None, 3, 1, 5.0), (9, 9, None, 15, 1, 7.0)]
    d = spark.createDataFrame(rows, "epoch int, step int, half_spin int, sector int, azimuth int, v double")
    angles = spark.createDataFrame([(a + 1, e) for a, e in enumerate(elevation)], "azimuth int, elevation int")
    got = histograms.azimuth_to_elevation(d, ["epoch", "step", "half_spin"], angles, "half_spin", 0, 12, 12, "v").collect()
    assert len(got) == 2 * 3 * 24 * 13 + 2 and {(r.sector, r.v) for r in got if r.epoch == 9} == {(3, 5.0), (15, 7.0)}
    assert all(r.v == rebinned[r.epoch, r.step, r.sector, r.elevation] for r in got if r.epoch < 9)


def test_counts_by_pitch_angle_and_gyrophase(spark):
    rng = np.random.default_rng(3)
    rows = [(float(p), None if rng.random() < 0.2 else float(g), None if rng.random() < 0.1 else float(i), int(c)) for p, g, i, c in zip(rng.uniform(0, 180, 200), rng.uniform(0, 360, 200), rng.uniform(1, 9, 200), rng.integers(0, 2, 200), strict=True)]
    rows += [(None, 5.0, 1.0, 1), (180.0, 359.9, 2.0, 0)]
    pa, pd, gy, gd = [20.0, 90.0, 160.0], [20.0, 30.0, 20.0], [45.0, 200.0, 300.0], [45.0, 50.0, 20.0]
    of = lambda x, cs, ds: next((i for i, (c, d) in enumerate(zip(cs, ds, strict=True)) if c - d <= x < c + d), len(cs) - 1)
    want = {}
    for p, g, i, c in rows:
        if p is not None and i is not None:
            for key in [(of(p, pa, pd), None)] + ([(of(p, pa, pd), of(g, gy, gd))] if g is not None else []):
                want.setdefault(key, []).append((i, c))
    d = spark.createDataFrame([(1, *r) for r in rows], "k int, pa double, gyro double, intensity double, counts int")
    got = {(r.pa_bin, r.gyro_bin): r for r in histograms.hist_pa_gyro_counts(d, ["k"], pa, pd, gy, gd).collect()}
    assert set(got) == set(want)
    for key, cell in want.items():
        mean, counts = np.mean([x[0] for x in cell]), sum(x[1] for x in cell)
        assert got[key].intensity == pytest.approx(mean) and got[key].sigma == (pytest.approx(mean / math.sqrt(counts)) if counts else None)


def rotation_mean_of(samples, grid, fill):
    """(values, filled); samples in time order."""
    samples, last = list(samples), samples[-1][0]
    filled = [fill is not None and g > last for g in grid]
    if fill is not None and last < grid[-1]:
        samples.append((grid[-1], fill))
    by = {}
    for n, v in samples:
        by.setdefault(math.floor(n), []).append(v)
    x = sorted(by)
    if x[0] > grid[0] or x[-1] < grid[-1]:
        raise ValueError("not covered")
    return np.interp(grid, x, [np.mean(by[k]) for k in x]), filled


@pytest.mark.parametrize(("grid", "fill"), [([5.0, 5.5, 6.2, 8.0, 9.0], None), ([5.5, 9.0, 12.0, 14.0], 0.04), ([6.0, 8.0, 9.0, 10.0], 0.04), ([5.0, 9.9], 0.04), ([4.9, 8.0], 0.04), ([5.0, 12.0], None), ([5.0, 9.5], None), ([6.0, 12.5], 0.04)])
def test_rotation_means(spark, grid, fill):
    rng = np.random.default_rng(4)
    samples = sorted((float(n), float(v)) for n, v in zip([5.3, *rng.uniform(5, 9.6, 30), 9.7], rng.uniform(1, 5, 32), strict=True))
    d = spark.createDataFrame(samples, "n double, v double")
    got = spectra.rotation_mean(d, F.col("n"), "v", spark.createDataFrame([(g,) for g in grid], "g double"), "g", fill=fill)
    try:
        values, filled = rotation_mean_of(samples, grid, fill)
    except ValueError:
        with pytest.raises(Exception, match="do not cover"):
            got.collect()
        return
    rows = sorted(got.collect(), key=lambda r: r.g)
    assert [r.v_at for r in rows] == pytest.approx(list(values)) and [r.filled for r in rows] == filled


def test_photoion_of_windows_anywhere(spark):
    flux = [(t + 0.0, 10 * t + k) for k, t in enumerate((1.1, 1.5, 1.9, 2.05, 2.4, 2.75, 3.5, 4.2, 4.5, 4.9))]
    daily = [(t, v + 1) for t, v in flux] + [(2.3, 50.0)]
    w = [(2, 1.95, 2.75), (3, 3.1, 3.9), (1, 5.0, 6.0)]  # off whole numbers, ends included; one point inside; none, before any
    rate = lambda v: v * v
    args = (spark.createDataFrame([(-30, 0.5), (0, 1.0)], "lat int, share double"), rate)
    d = lambda rows: spark.createDataFrame(rows, "t double, value double")
    win = lambda rows: spark.createDataFrame(rows, "cr long, t0 double, t1 double")
    got = {(r.cr, r.lat): r for r in spectra.photoion_mean(d(flux), win(w), *args, daily=d(daily)).collect()}
    own = [v * v for t, v in daily if 1.95 <= t <= 2.75]
    assert len(own) == 4 and got[2, 0].photo == pytest.approx(np.mean(own)) and got[2, 0].photo_sigma == pytest.approx(np.std(own, ddof=1))
    mean = lambda a, b: np.mean([x for x in flux if a <= x[0] <= b], axis=0)
    (t0, v0), (t1, v1) = mean(2, 3), mean(4, 5)
    want = (v0 + (v1 - v0) * (3.5 - t0) / (t1 - t0)) ** 2
    assert got[3, 0].photo == pytest.approx(want) and got[3, -30].photo == pytest.approx(want / 2) and got[3, 0].photo_sigma is None
    assert got[1, 0].photo is None  # the rotation after has values, the one before has none
    empty = [x for x in flux if x[0] < 3]  # two rotations in a row without values
    with pytest.raises(Exception, match="no values in the rotation after"):
        spectra.photoion_mean(d(empty), win([(3, 3.0, 4.0), (4, 4.0, 5.0)]), *args).collect()


def test_gate_stops_at_the_first_short_candidate(spark):
    rows = [("d", 1, 9, 500.0), ("d", 1, 5, 90.0), ("d", 2, 9, 400.0), ("d", 2, 3, -1.0), ("d", 2, 2, 5.0), ("d", 3, 6, -2.0), ("d", 3, 3, 900.0), ("d", 4, 5, 600.0), ("d", 5, 2, 0.0), ("d", 6, 4, None)]
    d = spark.createDataFrame(rows, "day string, epoch int, points int, density double")
    got = sorted((r.epoch, r.points, r.density) for r in windows.gated_candidates(d, ["day"], 1.85, 100.0).collect())
    # epoch 2: the candidate of 3 points is negative and ends the search; 3: short ones need only be positive; 4: below 1.85 * 363
    assert got == [(1, 5, 90.0), (3, 3, 900.0), (4, 5, 600.0)]


def brute_outliers(values, half):
    def once(sample):
        out = []
        for i, x in enumerate(values):
            win = [v for v in sample[max(0, i - half) : i + half + 1] if v is not None]
            out.append(x is not None and any(abs(np.median(rest) - x) >= 3 * np.std(rest) for rest in ([*win[:k], *win[k + 1 :]] for k in range(len(win))) if rest))
        return out

    first = once(values)
    second = once([None if f else v for f, v in zip(first, values, strict=True)])
    return [None if v is None else a or b for a, b, v in zip(first, second, values, strict=True)]


@pytest.mark.parametrize("rows", [1 << 15, 40, 1])
def test_outliers_against_all_leave_one_outs(spark, rows):
    rng = np.random.default_rng(5)
    groups = {g: [None if rng.random() < 0.1 else float(np.round(v, 2)) for v in rng.standard_t(2, n)] for g, n in enumerate((1, 2, 3, 7, 30, 120, 0, 61))}
    groups[20], groups[21] = [2.5] * 9, [None, None]
    d = spark.createDataFrame([(g, i, v, "x") for g, vs in groups.items() for i, v in enumerate(vs)], "g int, i int, v double, more string").repartition(2)
    got = windows.outlier_flag(d, ["g"], "i", "v", 11, rows)
    assert got.columns == ["g", "i", "v", "more", "outlier"]
    by = {(r.g, r.i): r.outlier for r in got.collect()}
    want = {(g, i): o for g, vs in groups.items() for i, o in enumerate(brute_outliers(vs, 5))}
    assert by == want and 5 < sum(o is True for o in want.values()) < len(want) / 2


def test_power_laws_of_many_cells_at_once():
    rng = np.random.default_rng(6)
    cells, size = 400, rng.integers(0, 30, 400)
    cell = np.repeat(np.arange(cells), size)
    e = np.exp(rng.uniform(-1, 3, len(cell)))
    a, g = rng.uniform(0.5, 5, cells), rng.uniform(0.2, 3, cells)
    f = a[cell] * e ** -g[cell] * rng.normal(1, 0.05, len(cell))
    s = 0.05 * np.abs(f) + 1e-6
    f[rng.random(len(cell)) < 0.05] = np.nan
    s[rng.random(len(cell)) < 0.002] = 0.0
    got = fits.fit_power_laws(cell, cells, e, f, s)
    fitted = 0
    for c in range(cells):
        own = cell == c
        alone = np.array(fits.fit_power_law(e[own], f[own], s[own]))
        assert np.allclose(alone, got[c], rtol=1e-9, equal_nan=True)
        fine = own & np.isfinite(f)
        if np.isnan(got[c, 0]):
            assert fine.sum() < 2 or (s[fine] == 0).any()
            continue
        fitted += 1
        cost = lambda p, q: (((f - p * e**-q)[fine] / s[fine]) ** 2).sum()  # noqa: B023, E731
        best = cost(*got[c, :2])
        assert all(best <= cost(got[c, 0] * x, got[c, 1] * y) + 1e-9 * best + 1e-15 for x in (0.999, 1.001) for y in (0.999, 1.001))
        assert got[c, 4] == pytest.approx(best / max(1, fine.sum() - 2), rel=1e-6, abs=1e-15)
    assert fitted > 300


def test_sky_proximity_at_poles_and_across_zero(spark):
    rng = np.random.default_rng(7)
    points = [(float(a), float(b)) for a, b in zip(rng.uniform(0, 360, 600), np.degrees(np.arcsin(rng.uniform(-1, 1, 600))), strict=True)]
    points += [(0.0, 90.0), (123.0, -90.0), (359.99, 0.0), (0.01, 0.0), (-0.5, 89.9), (180.0, 89.5), (700.0, 10.0)]
    sources = [(10.0, 89.0, 3.0), (359.5, 0.0, 1.0), (0.2, -45.0, 5.0), (200.0, -88.5, 1.6), (90.0, 30.0, 0.0), (90.0, 60.0, 25.0), (45.0, 0.0, 0.3), (300.0, 20.0, 95.0), (12.0, -5.0, -1.0)]

    def near(a, b):
        for sa, sb, rad in sources[:-2] if small else sources:
            la, lb, ma, mb = map(math.radians, (a, b, sa, sb))
            h = math.sin((lb - mb) / 2) ** 2 + math.cos(lb) * math.cos(mb) * math.sin((la - ma) / 2) ** 2
            if rad > 0 and math.degrees(2 * math.asin(math.sqrt(min(1, h)))) <= rad:
                return True
        return False

    p = spark.createDataFrame([(i, *x) for i, x in enumerate(points)] + [(9999, None, 1.0)], "id int, lon double, lat double")
    for small in (True, False):
        s = spark.createDataFrame(sources[:-2] if small else sources, "slon double, slat double, radius double")
        for size in (2.0, 7.0):
            d = joins.sky_proximity(p, "lon", "lat", s, "id", size)
            got = {r.id: r.near for r in d.collect()}
            assert got == {i: near(*x) for i, x in enumerate(points)} | {9999: False}
    assert "NestedLoop" not in d._jdf.queryExecution().executedPlan().toString()


def test_radii_are_raised_to_the_edges_of_their_groups(spark):
    radii = [0.5, 0.5, 0.9, 1.0, 2.2, 3.0, 3.7, 5.0]
    edges = np.linspace(min(radii) - 1e-6, max(radii) + 1e-6, 12)
    want = sorted(float(edges[np.digitize(r, edges)]) for r in radii)
    got = joins.grouped_radii(spark.createDataFrame([(r,) for r in radii], "radius double")).collect()
    assert sorted(r.radius for r in got) == pytest.approx(want) and max(want) > 5.0


def test_sky_cells_bound_the_candidates(spark):
    rng = np.random.default_rng(8)
    place = lambda n: [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(0, 360, n), np.degrees(np.arcsin(rng.uniform(-1, 1, n))), strict=True))]
    p = spark.createDataFrame(place(2000), "id int, lon double, lat double")
    s = spark.createDataFrame([(a, b, 1.0) for _, a, b in place(2000)], "slon double, slat double, radius double")
    band, cell = joins.sky_cell(F.col("lon"), F.col("lat"), 2.0)
    most = p.select(band.alias("b"), cell.alias("c")).groupBy("b", "c").count().agg(F.max("count")).first()[0]
    # a cell of 2 degrees holds about a ten-thousandth of the sky
    assert most < 12 and joins.sky_proximity(p, "lon", "lat", s, "id").where("near").count() > 100


def bilinear_of(xs, ys, v, lon, lat):
    x = (lon - xs[0]) % 360 + xs[0]
    i = max(k for k in range(len(xs)) if xs[k] <= x)
    x1 = xs[i + 1] if i + 1 < len(xs) else xs[0] + 360
    j = min(max(k for k in range(len(ys)) if ys[k] <= lat), len(ys) - 2)
    a, b, n = (x - xs[i]) / (x1 - xs[i]), (lat - ys[j]) / (ys[j + 1] - ys[j]), (i + 1) % len(xs)
    return (1 - a) * (1 - b) * v[i][j] + a * (1 - b) * v[n][j] + (1 - a) * b * v[i][j + 1] + a * b * v[n][j + 1]


def test_bilinear_on_uneven_axes(spark):
    rng = np.random.default_rng(9)
    xs, ys = [3.0, 10.0, 50.0, 51.0, 200.0, 340.0], [-90.0, -20.0, -5.0, 0.5, 60.0, 90.0]
    v = rng.uniform(0, 9, (6, 6)).tolist()
    asked = [(float(a), float(b)) for a, b in zip(rng.uniform(-400, 800, 300), rng.uniform(-90, 90, 300), strict=True)] + [(x, y) for x in xs for y in ys] + [(0.0, 0.0), (359.9, 90.0), (2.9, -90.0)]
    grid = spark.createDataFrame([(x, y, v[i][j]) for i, x in enumerate(xs) for j, y in enumerate(ys)], "glon double, glat double, v double")
    left = spark.createDataFrame([(i, *x) for i, x in enumerate(asked)] + [(-1, None, 1.0), (-2, 1.0, None)], "id int, a double, b double")
    d = joins.uneven_bilinear_join(left, F.col("a"), F.col("b"), grid, "v", 20.0)
    got = {r.id: r.v_at for r in d.collect()}
    assert d.columns == ["id", "a", "b", "v_at"] and got.pop(-1) is None and got.pop(-2) is None
    assert [got[i] for i in range(len(asked))] == pytest.approx([bilinear_of(xs, ys, v, *x) for x in asked])
    with pytest.raises(Exception, match="outside the table"):
        joins.uneven_bilinear_join(left, F.col("a"), F.col("b") / 2 + 80, grid, "v", 20.0).collect()
    hole = joins.uneven_bilinear_join(left, F.col("a"), F.col("b"), grid.where("glon <> 50 OR glat <> 0.5"), "v", 20.0)
    holes = {r.id for r in hole.collect() if r.id >= 0 and r.v_at is None}
    assert holes and all(0 <= abs(asked[i][1]) <= 60 for i in holes)


def test_nearest_join_in_linear_time(spark):
    day = F.lit("2024-01-01").cast("timestamp")
    at = lambda c: F.timestamp_micros(F.unix_micros(day) + c)
    left = spark.range(16_000).select("id", at(F.col("id") * 15_000).alias("ts"))
    right = spark.range(16_000).select(at(F.col("id") * 15_000 + 7_000).alias("ts"), F.col("id").cast("double").alias("v"))
    start = time.time()
    got = joins.nearest_join(left, right, "ts", ["v"], 60_000_000).where(F.col("v") == F.greatest(F.lit(0), F.col("id"))).count()
    assert got == 16_000 and time.time() - start < 60
