"""Edge cases on tiny frames, plan shapes and invariances."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.functions import expr as X
from orrery.operators import catalog, filters, fits, histograms, joins, maps, spectra, windows


def t(s):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nearest_join_ties_gaps_and_tolerance(spark):
    left = spark.createDataFrame([(i, t(s)) for i, s in enumerate((0, 10, 15, 100, 200))], "id int, ts timestamp")
    right = spark.createDataFrame([(t(10), 1.0), (t(20), 2.0), (t(14), None), (t(130), 3.0)], "ts timestamp, v double")
    d = joins.nearest_join(left, right, "ts", ["v"], 30_000_000)
    # 15 lies half-way between 10 and 20: the earlier one; a NULL row is never nearest; exactly the tolerance is kept
    assert {r.id: r.v for r in d.collect()} == {0: 1.0, 1: 1.0, 2: 1.0, 3: 3.0, 4: None}
    assert "NestedLoop" not in plan_of(d) and "Cartesian" not in plan_of(d)


def test_interval_mean_owner_null_and_boundary(spark):
    left = spark.createDataFrame([(0, 0), (1, 15), (2, 100), (3, 200)], "k long, t long")
    right = spark.createDataFrame([(t(0), 1.0), (t(9), 3.0), (t(10), 5.0), (t(195), None), (t(201), 4.0)], "ts timestamp, v double")
    base = int(t(0).replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    d = joins.interval_mean_join(left, right, "k", F.col("t") * 1000000 + base, 10_000_000, "ts", ["v"])
    # 9 is in the windows of 0 and 15 and belongs to the earlier; 10 is past the end of window 0; a NULL poisons
    assert {r.k: r.v for r in d.collect()} == {0: 2.0, 1: 5.0, 2: None, 3: None}
    assert "NestedLoop" not in plan_of(d)


def cell(spark, rows):
    return spark.createDataFrame(rows, "cell int, intensity double, stat double, sys double, exposure double, flags int")


def test_combining_one_map_is_the_identity(spark):
    m = cell(spark, [(1, 5.0, 0.5, 0.1, 2.0, 3), (2, 7.0, 0.7, 0.2, 4.0, 4)])
    for name in ("unweighted", "exposure", "uncertainty"):
        rows = {r.cell: r for r in maps.combine(name, m, ["cell"]).collect()}
        assert rows[1].intensity == pytest.approx(5.0) and rows[2].stat == pytest.approx(0.7) and rows[2].flags == 4


def test_combination_masks_missing_cells(spark):
    m = cell(spark, [(1, None, 0.5, 0.1, 2.0, 1), (1, 7.0, 0.7, 0.2, 0.0, 2), (2, None, None, None, None, 4), (3, 6.0, 0.0, 0.1, 1.0, 0), (3, 8.0, 2.0, 0.1, 1.0, 8)])
    rows = {r.cell: r for r in maps.combine_uncertainty_weighted(m, ["cell"]).collect()}
    assert rows[1].intensity is None and rows[1].flags == 3 and rows[2].intensity is None
    assert rows[3].intensity == pytest.approx(8.0) and rows[3].stat == pytest.approx(2.0)  # an error of 0 adds nothing
    checked = maps.assert_maps_match(m, ["cell"], ["flags"])  # nothing runs yet
    with pytest.raises(Exception, match="maps differ in flags"):
        checked.collect()
    assert maps.assert_maps_match(m, ["cell"], ["cell"]).count() == m.count()
    plan = plan_of(maps.combine_exposure_weighted(m, ["cell"]))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_power_law_recovers_known_fit(spark):
    e = np.geomspace(0.5, 20, 23)
    f = 2 * e**-1.5
    a, g, sa, sg, chi = fits.fit_power_law(e, f, 0.2 * f)
    assert a == pytest.approx(2, rel=1e-6) and g == pytest.approx(1.5, rel=1e-6) and chi < 1e-9 and sa > 0 and sg > 0
    rows = [("good", float(x), float(y), float(0.2 * y)) for x, y in zip(e, f, strict=True)]
    rows += [("rising", float(x), float(2 * x**0.8), 0.1) for x in e] + [("one", 1.0, 2.0, 0.1), ("zero", 1.0, 0.0, 0.0), ("zero", 2.0, 0.0, 0.0)]
    rows += [("null", 1.0, None, 0.1)]
    d = spark.createDataFrame(rows, "c string, energy double, intensity double, sigma double").withColumns({"exposure": F.lit(1.0), "obs_us": F.lit(5).cast("long"), "flags": F.lit(1)})
    got = {r.c: r for r in fits.power_law_fit(d, ["c"]).collect()}
    assert got["good"].gamma == pytest.approx(1.5, rel=1e-6)
    assert got["rising"].gamma is None and got["one"].a is None and got["zero"].a is None and got["null"].gamma is None
    assert got["good"].exposure == 23 and got["one"].flags == 1


def test_group_fits_isolate_failures(spark):
    d = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 5.0), (3, -1.0)], "k long, v double")

    def fitter(p):
        if len(p) < 2 and p.v.iloc[0] > 0:
            raise RuntimeError("no")
        return None if p.v.iloc[0] < 0 else {"m": p.v.mean()}

    got = {r.k: (r.m, r.fit_flag) for r in fits.run_group_fits(d, "k", fitter, "m double").collect()}
    assert got[1] == (1.5, 0) and got[2][1] == 1 and got[3][1] == 2


def test_angles_degenerate_field(spark):
    one = spark.range(1)
    v, up, x = X.vector(1, 0, 0), X.vector(0, 1, 0), X.vector(1, 0, 0)
    r = one.select(X.pitch_angle(v, x).alias("p"), X.gyrophase(v, up).alias("g"), X.safe_divide(1, 0).alias("d"), X.erfc(F.lit(0.5)).alias("e")).first()
    assert r.p == pytest.approx(0.0) and r.g is None and r.d is None and r.e == pytest.approx(math.erfc(0.5), rel=1e-6)


def test_spin_round_trip(spark):
    d = spark.createDataFrame([(1.7, 0.3, 2.0, 0.7), (0.2, -0.9, 5.0, 1.2)], "l double, b double, s double, th double")
    lon, lat = X.spin_to_sky(F.col("l"), F.col("b"), F.col("s"), F.col("th"))
    th, s = X.sky_to_spin(F.col("l"), F.col("b"), lon, lat)
    for r in d.select("s", "th", s.alias("s2"), th.alias("th2")).collect():
        assert r.s2 == pytest.approx(r.s) and r.th2 == pytest.approx(r.th)


def test_principal_temperature_against_eigenvalues(spark):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(20):
        a = rng.normal(size=(3, 3))
        m = a @ a.T
        w = np.sort(np.linalg.eigvalsh(m))
        par = w[2] if w[2] - w.mean() >= w.mean() - w[0] else w[0]
        rows.append(tuple(float(x) for x in (m[0, 0], m[0, 1], m[1, 1], m[0, 2], m[1, 2], m[2, 2], par)))
    d = spark.createDataFrame(rows, "xx double, xy double, yy double, xz double, yz double, zz double, par double")
    got, _, _ = X.principal_temperature([F.col(c) for c in ("xx", "xy", "yy", "xz", "yz", "zz")])
    for r in d.select("par", got.alias("g")).collect():
        assert r.g == pytest.approx(r.par, rel=1e-6)


def test_histogram_keeps_rows_without_gyrophase_in_one_product(spark):
    d = spark.createDataFrame([(180.0, None, 2.0), (179.0, 10.0, 4.0), (None, 5.0, 9.0), (10.0, 350.0, None)], "pa double, gyro double, intensity double").withColumns({"sig_minus": F.lit(1.0), "sig_plus": F.lit(2.0), "k": F.lit(1)})
    rows = histograms.hist_pa_gyro(d, ["k"], 6, 4).collect()
    flat = [r for r in rows if r.gyro_bin is None]
    assert len(flat) == 1 and flat[0].pa_bin == 5 and flat[0].intensity == 3.0 and flat[0].n == 2
    assert [r.intensity for r in rows if r.gyro_bin is not None] == [4.0]


def test_outliers_and_centered_mean(spark):
    values = [10.0 + (i % 3) * 0.1 for i in range(40)]
    values[17] = 500.0
    d = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "g int, i int, v double")
    assert [r.i for r in windows.outlier_flag(d, ["g"], "i", "v", 21).where("outlier").collect()] == [17]
    m = {r.i: r.mean for r in windows.centered_mean(d, ["g"], "i", "v").collect()}
    assert m[0] == values[0] and m[1] == pytest.approx(np.mean(values[:3])) and m[39] == pytest.approx(np.mean(values[36:]))


def test_filters_reject_bad_ranges(spark):
    d = spark.range(10).select(F.col("id").cast("double").alias("energy"))
    with pytest.raises(ValueError):
        filters.slice_energy_bins(d, 3, 3)
    assert filters.slice_energy_bins(d, 9, 11).count() == 2


def test_bad_day_at_the_edges_of_intervals(spark):
    iv = spark.createDataFrame([(1, 0, 10), (2, 10, 20), (3, 30, 40)], "id int, a long, b long")
    bad = spark.createDataFrame([(10,), (40,)], "d long")
    got = joins.anti_bad_days(iv, F.col("a"), F.col("b"), bad, F.col("d"), 5, "id")
    assert sorted(r.id for r in got.collect()) == [1, 3]


def test_calibration_before_the_first_raises(spark):
    left, cal = spark.createDataFrame([(5,)], "t long"), spark.createDataFrame([(7, 1.0)], "c long, v double")
    with pytest.raises(Exception, match="no calibration"):
        joins.asof_calibration(left, F.col("t"), cal, F.col("c"), ["v"], 10).collect()


def test_catalog_decisions_do_not_depend_on_partitions(spark):
    rows = [(k % 7, f"d{k % 3}", k) for k in range(200)]
    d = spark.createDataFrame(rows, "start_date int, descriptor string, version int")
    a = catalog.latest_version(d.repartition(1), ["start_date", "descriptor"], "version").collect()
    b = catalog.latest_version(d.repartition(13), ["start_date", "descriptor"], "version").collect()
    assert sorted(a) == sorted(b) and len(a) == 21


def test_second_peak_cases(spark):
    shape = {1: 1, 2: 9, 3: 100, 4: 20, 5: 5, 6: 7, 7: 30, 8: 6, 9: 2, 10: 1}
    d = spark.createDataFrame([("a", float(e), float(c), 0.0) for e, c in shape.items()] + [("b", float(e), float(200 - e), 0.0) for e in range(1, 11)], "k string, e double, c double, bg double")
    got = {r.k: r for r in spectra.second_peak(d, ["k"], "e", "c", "bg").collect()}
    assert got["a"].peak_bin == 7 and got["a"].first_bin == 4 and got["a"].last_bin == 8 and got["a"].error is None
    assert got["b"].error == "no rise"


def expected_local_fit(points, centre, low, high, near_high, near_low):
    """The value, or None; the rule as the instrument's description states it."""
    energies = sorted(e for e, _ in points)
    inside = [(e, v) for e, v in points if low * centre < e < high * centre]
    if len(energies) < 2 or len(inside) < 2:
        return None
    es = [e for e, _ in inside]
    near, sides = min(abs(e / centre - 1) for e in es), min(es) < centre < max(es)
    top, second = energies[-1] in es, energies[1] in es
    if not ((top and near < near_high) or (second and (near < near_low or sides)) or (not top and not second and sides)):
        return None
    slope, c = np.polyfit(np.log(es), np.log([v for _, v in inside]), 1)
    return math.exp(c + slope * math.log(centre))


def test_local_fit_cases(spark):
    cases = [
        [(8.0, 1000.0), (12.5, 10.0)], [(8.1, 32.0), (10 / 0.9, 256.0)], [(5.9, 9.0), (6.1, 50.0), (13.9, 50.0), (14.1, 9.0)],
        [(5.9, 9.0), (13.9, 50.0)], [(6.0, 9.0), (14.0, 50.0)],  # too few inside, bounds are open
        [(7.0, 5.0), (8.1, 4.0), (8.3, 3.0)], [(7.0, 5.0), (8.0, 4.0), (8.1, 3.0)],  # the top is inside: near enough or not
        [(1.0, 9.0), (2.0, 8.0), (9.0, 5.0), (9.5, 4.0), (30.0, 1.0)],  # neither end inside, one side only
        [(1.0, 9.0), (2.0, 8.0), (9.0, 5.0), (10.5, 4.0), (30.0, 1.0)], [(6.5, 9.0), (8.9, 8.0), (30.0, 1.0)], [(6.5, 9.0), (8.5, 8.0), (30.0, 1.0)],
        [(7.0, 5.0), (13.0, 0.0), (13.5, 2.0)],
    ]
    rng = np.random.default_rng(4)
    cases += [[(float(e), float(v)) for e, v in zip(rng.uniform(3, 20, n), rng.uniform(0.1, 9, n), strict=True)] for n in rng.integers(1, 9, 150)]
    d = spark.createDataFrame([(i, e, v) for i, c in enumerate(cases) for e, v in c], "k int, energy double, psd double")
    got = {r.k: r.psd for r in fits.log_local_fit(d, ["k"], [10.0]).collect()}
    seen = 0
    for i, c in enumerate(cases):
        want = expected_local_fit([(e, v) for e, v in c if v > 0], 10.0, 0.6, 1.4, 0.18, 0.12)
        seen += want is not None
        assert got.get(i) == (None if want is None else pytest.approx(want, rel=1e-6)), c
    assert 20 < seen < len(cases) - 20
    assert got[0] == pytest.approx(100) and got[1] == pytest.approx(128) and got[2] == pytest.approx(50)


def test_words_of_included_groups_only(spark):
    two = ["L1A14", "L2A"]
    cases = {  # event: (group, address, adc, low gain) in order, included groups
        "high": ([("L1A14", 10, 1, False), ("L1A14", 11, 2, False), ("L2A", 15, 3, False)], two),
        "low": ([("L1A14", 10, 2, True), ("L1A14", 11, 1, True), ("L2A", 15, 3, False)], two),
        "20 over 19": ([("L1A14", 10, 1, True), ("L1A14", 11, 19, False), ("L2A", 15, 3, False)], two),
        "20 under 21": ([("L1A14", 10, 1, True), ("L1A14", 11, 21, False), ("L2A", 15, 3, False)], two),
        "saturated": ([("L1A14", 10, 2047, False), ("L1A14", 11, 1, False), ("L2A", 15, 3, False)], two),
        "first of equal": ([("L1A14", 11, 1, True), ("L1A14", 10, 20, False), ("L2A", 15, 3, False)], two),
        "other group": ([("L1A14", 10, 5, False), ("L2A", 15, 3, False), ("L3A", 16, 900, False)], two),
        "void": ([("L1A14", 10, 2047, False), ("L1A14", 11, 2047, False), ("L2A", 15, 1, False)], two),
        "no rule": ([("L1A14", 10, 1, False)], None),
    }
    rows = [(ev, n, *w, inc) for ev, (words, inc) in cases.items() for n, w in enumerate(words)]
    d = spark.createDataFrame(rows, "ev string, no int, `group` string, address int, adc int, low_gain boolean, included array<string>")
    best = spectra.top_per_group(d, "ev", "no", "included")
    got = {}
    for r in best.collect():
        got.setdefault(r.ev, {})[r.group] = r.address
    assert got == {"high": {"L1A14": 11, "L2A": 15}, "low": {"L1A14": 10, "L2A": 15}, "20 over 19": {"L1A14": 10, "L2A": 15}, "20 under 21": {"L1A14": 11, "L2A": 15}, "saturated": {"L1A14": 11, "L2A": 15}, "first of equal": {"L1A14": 11, "L2A": 15}, "other group": {"L1A14": 10, "L2A": 15}}
    gain = spark.createDataFrame([(lg, a, 2.0, 1.0) for lg in (True, False) for a in (10, 11, 15, 16)], "low_gain boolean, address int, a double, b double")
    e = {r.ev: r for r in spectra.event_energies(best, gain, "ev", F.get("included", F.lit(0)), F.get("included", F.lit(1)), F.lit(0.5)).collect()}
    assert (e["other group"].e_delta, e["other group"].e_prime, e["other group"].total) == (5.5, 3.5, 9.0)


def test_peak_speed_of_mean_spectrum(spark):
    rng = np.random.default_rng(6)
    rate, volt = rng.normal(5, 4, (5, 20)), rng.uniform(1, 9, (5, 20))
    rate[:, 7] += 30
    rate[:, 9] = -3.0
    volt[:, 5] = 0.0
    rate[2, 8] = np.nan
    rows = [("a", b, None if np.isnan(rate[s, b]) else float(rate[s, b]), float(volt[s, b])) for s in range(5) for b in range(20)] + [("none", b, None, 1.0) for b in range(20)]
    m, v = np.nanmean(rate, 0), volt.mean(0)
    w = [b for b in range(3, 12) if m[b] >= 0 and v[b] > 0]
    want = sum(m[b] * math.sqrt(v[b]) for b in w) / sum(m[b] for b in w)
    d = spark.createDataFrame(rows, "k string, b int, rate double, v double")
    got = {r.k: r.speed for r in spectra.peak_speed(d, ["k"], "b", "rate", "v", F.sqrt, 4, 20).collect()}
    assert 9 not in w and 5 not in w and got == {"a": pytest.approx(want), "none": None}


def test_median_window_is_open_at_its_end(spark):
    h = 3600 * 10**6
    d = spark.createDataFrame([(1, 0, 5.0), (1, h // 2, 1.0), (1, 22 * h, 4.0), (1, 22 * h + h // 2, 99.0), (2, 0, 7.0)], "k int, t long, v double")
    assert {r.k: r["median"] for r in spectra.median_in_window(d, ["k"], F.col("t"), "v").collect()} == {1: 2.0, 2: 90.0}  # 2.5 to even


def test_nearest_join_of_equal_instants(spark):
    right = spark.createDataFrame([(t(s), v) for s, v in ((0, 5.0), (0, 3.0), (10, 2.0), (10, 8.0), (10, 4.0), (40, 1.0))], "ts timestamp, v double")
    left = spark.createDataFrame([(i, t(s)) for i, s in enumerate((0, 3, 5, 7, 10, 12, 25, 60))], "id int, ts timestamp")
    got = {r.id: r.v for r in joins.nearest_join(left, right, "ts", ["v"], 15_000_000).collect()}
    # at or after: the first of equal instants; before: the last one; half-way: the earlier instant
    assert got == {0: 3.0, 1: 5.0, 2: 5.0, 3: 2.0, 4: 2.0, 5: 8.0, 6: 8.0, 7: None}


def test_bilinear_edges(spark):
    grid = [(a, d, 10.0 * a + d) for a in range(4) for d in range(2, 6)]
    g = spark.createDataFrame(grid, "gx long, gy long, v double")
    asked = [(0.0, 2.0), (45.0, 2.5), (315.0, 3.0), (-45.0, 3.0), (360.0, 5.0), (90.0, 5.0), (90.0, 5.001), (90.0, 1.0), (135.0, 0.0), (10.0, 99.0)]
    left = spark.createDataFrame([(i, *x) for i, x in enumerate(asked)], "id int, a double, d double")
    got = {r.id: r.v_at for r in joins.bilinear_join(left, F.col("a"), F.col("d"), g, 90.0, 4, 1.0, 2, 5, "v").collect()}
    want = [2.0, 7.5, 18.0, 18.0, 5.0, 15.0, 0.0, 6.0, 0.0, 0.0]
    assert [got[i] for i in range(len(want))] == pytest.approx(want)
    hole = joins.bilinear_join(left.where("id = 1"), F.col("a"), F.col("d"), g.where("gx <> 1 OR gy <> 3"), 90.0, 4, 1.0, 2, 5, "v")
    assert hole.first().v_at is None


def test_next_row_by_buckets_equals_one_window(spark):
    rng = np.random.default_rng(9)
    at = sorted({int(x) for x in rng.integers(-5000, 5000, 300)} | {10**9})
    d = spark.createDataFrame([(k, x, f"v{x}") for k in ("a", "b") for x in at[:: 1 if k == "a" else 7]], "k string, at long, v string").repartition(4)
    got = joins.with_next(d, "at", {"next_at": "at", "next_v": "v"}, 100, ["k"])
    for k, step in (("a", 1), ("b", 7)):
        rows = sorted((r.at, r.next_at, r.next_v) for r in got.where(F.col("k") == k).collect())
        assert rows == [(x, y, None if y is None else f"v{y}") for x, y in zip(at[::step], [*at[::step][1:], None], strict=True)]


def test_time_joins_have_no_single_partition_over_rows(spark):
    left = spark.range(1000).select(F.col("id").alias("t"))
    cal = spark.range(0, 1000, 10).select(F.col("id").alias("c"), F.col("id").cast("double").alias("v"), F.lit(1).alias("f"))
    for d in (joins.asof_calibration(left, F.col("t"), cal, F.col("c"), ["v"], 100), joins.flags_around(left, F.col("t"), cal, F.col("c"), "f", 100)):
        # only aggregates and the first rows of buckets meet in one task
        plan = plan_of(d).splitlines()
        assert not any("NestedLoop" in x for x in plan)
        alone = [i for i, x in enumerate(plan) if "Exchange SinglePartition" in x]
        assert alone and all("Aggregate" in plan[i + 1] for i in alone)


def test_range_join_open_ends_and_rows_beyond(spark):
    rng = np.random.default_rng(2)
    ranges = [(i, int(a), int(a + w)) for i, (a, w) in enumerate(zip(rng.integers(0, 500, 40), rng.integers(0, 60, 40), strict=True))] + [(100, None, 50), (101, 450, None), (102, None, None)]
    xs = [int(x) for x in rng.integers(-300, 900, 200)]
    got = joins.range_join(spark.createDataFrame([(x,) for x in xs], "x long"), F.col("x"), spark.createDataFrame(ranges, "i int, a long, b long"), F.col("a"), F.col("b"), 37)
    want = sorted((x, i) for x in xs for i, a, b in ranges if (a is None or a <= x) and (b is None or x < b))
    assert sorted((r.x, r.i) for r in got.collect()) == want
    empty = spark.createDataFrame([(None,)], "x long")
    assert joins.range_join(empty, F.col("x"), spark.createDataFrame(ranges, "i int, a long, b long"), F.col("a"), F.col("b"), 37).count() == 0
    none = spark.createDataFrame([], "i int, a long, b long")
    assert joins.range_join(spark.range(3), F.col("id"), none, F.col("a"), F.col("b"), 5, "left").count() == 3


def test_velocities_shift(spark):
    got = spark.range(1).select(*X.shift_velocity((F.lit(3.0), F.lit(2.0), F.lit(1.0)), (F.lit(1.0), F.lit(5.0), F.lit(1.0)))).first()
    assert tuple(got) == (2.0, -3.0, 0.0)
