"""Spectra, light curves, rotation products and fits."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import fits as FIT
from ..operators import joins as J
from ..operators import spectra as S
from .base import query, r, table
from .histograms import _ROT, rotations

_SPEC = "s AS (SELECT year(l_shipdate)*12+month(l_shipdate) AS epoch, l_quantity AS energy, l_linenumber AS detector, l_suppkey % 30 AS sector, l_extendedprice AS psd, l_tax AS bg, l_discount FROM lineitem)"


def _spectrum(spark, sf):
    return table(spark, sf, "lineitem").select(
        (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("epoch"), F.col("l_quantity").alias("energy"), F.col("l_linenumber").alias("detector"), (F.col("l_suppkey") % 30).alias("sector"),
        F.col("l_extendedprice").alias("psd"), F.col("l_tax").alias("bg"), "l_discount",
    )


@query("a25_look_average", f"""
WITH {_SPEC}, a AS (SELECT epoch, energy, sector, sum(greatest(psd*1.0471975, 20000)*(detector+1))/sum(detector+1) AS v FROM s GROUP BY ALL) SELECT epoch, energy, round(avg(v), 5) AS psd FROM a GROUP BY ALL""")
def a25(spark, sf):
    d = S.look_average(_spectrum(spark, sf).withColumn("psd", F.col("psd") * 1.0471975), ["epoch", "energy"], "psd", F.col("detector") + 1, 20000.0)
    return d.select("epoch", "energy", r(F.col("psd"), "psd", 5))


_PA = "p AS (SELECT epoch, energy, psd, (detector-1)*25.7 AS pa, 12.85 AS delta FROM s)"


@query("a26_a27_spectra", f"""
WITH {_SPEC}, {_PA}, h AS (SELECT epoch, energy, sum(psd*sin(radians(pa))*radians(delta)) AS f, coalesce(sum(psd*sin(radians(pa))*radians(delta*2)) FILTER (pa < 90), -1) AS lo, coalesce(sum(psd*sin(radians(pa))*radians(delta*2)) FILTER (pa >= 90), -1) AS hi FROM p GROUP BY ALL),
k AS (SELECT epoch, CASE WHEN lo=-1 OR hi=-1 THEN NULL ELSE lo >= hi END AS i FROM h WHERE energy=25)
SELECT epoch, energy, round(f, 4) AS spectrum, round(nullif(CASE WHEN i THEN lo ELSE hi END, -1), 4) AS inward, round(nullif(CASE WHEN i THEN hi ELSE lo END, -1), 4) AS outward FROM h LEFT JOIN k USING (epoch)""")
def a26(spark, sf):
    p = _spectrum(spark, sf).select("epoch", "energy", "psd", ((F.col("detector") - 1) * 25.7).alias("pa"), F.lit(12.85).alias("delta"))
    d = S.spectrum_1d(p, ["epoch", "energy"]).join(S.inward_outward(p, "epoch", "energy", 25.0), ["epoch", "energy"])
    return d.select("epoch", "energy", r(F.col("spectrum"), "spectrum"), r(F.col("inward"), "inward"), r(F.col("outward"), "outward"))


@query("a28_moments", f"""
WITH {_SPEC}, c AS (SELECT epoch, psd*1e-6*0.01 AS fw, sqrt(energy)*cos(radians(sector*12))*cos(radians(detector*20-80)) AS x, sqrt(energy)*sin(radians(sector*12))*cos(radians(detector*20-80)) AS y, sqrt(energy)*sin(radians(detector*20-80)) AS z FROM s WHERE sector < 28),
m AS (SELECT epoch, sum(fw) AS n, sum(fw*x)/sum(fw) AS vx, sum(fw*y)/sum(fw) AS vy, sum(fw*z)/sum(fw) AS vz FROM c GROUP BY epoch)
SELECT epoch, round(n, 6) AS density, round(any_value(vx), 6) AS vx, round(any_value(vz), 6) AS vz, round(sum(fw*(x-vx)*(x-vx)), 6) AS txx, round(sum(fw*(y-vy)*(z-vz)), 6) AS tyz,
 round(0.5*sum(fw*((x-vx)*(x-vx)+(y-vy)*(y-vy)+(z-vz)*(z-vz))*(x-vx)), 6) AS qx FROM c JOIN m USING (epoch) GROUP BY epoch, n""")
def a28(spark, sf):
    el, az = F.radians(F.col("detector") * 20 - 80), F.radians(F.col("sector") * 12)
    c = _spectrum(spark, sf).withColumns({"v": F.sqrt("energy"), "ux": F.cos(az) * F.cos(el), "uy": F.sin(az) * F.cos(el), "uz": F.sin(el), "w": F.lit(0.01), "psd": F.col("psd") * 1e-6})
    return S.moments(c, "epoch").select("epoch", *[r(F.col(k), k, 6) for k in ("density", "vx", "vz", "txx", "tyz", "qx")])


@query("a29_a30_group_statistics", """
SELECT o_custkey, round(avg(o_totalprice), 7) AS mean, round(stddev_samp(o_totalprice), 4) AS std, round(avg(o_totalprice) FILTER (o_orderkey % 3 <> 0), 7) AS good_mean, round(stddev_pop(o_totalprice) FILTER (o_orderkey % 3 <> 0), 4) AS good_std FROM orders GROUP BY 1""")
def a29(spark, sf):
    o = table(spark, sf, "orders")
    g = S.mean_std_good(o, ["o_custkey"], F.col("o_orderkey") % 3 != 0, ["o_totalprice"])
    return S.group_mean_std(o, "o_custkey", "o_totalprice").join(g, "o_custkey").select("o_custkey", r(F.col("mean"), "mean", 7), r(F.col("std"), "std"), r(F.col("o_totalprice_mean"), "good_mean", 7), r(F.col("o_totalprice_std"), "good_std"))


@query("a31_a32_a33_histogram_sums", """
WITH e AS (SELECT ts::DATE AS day, minute(ts) AS bin, event_id, event_id & 15 AS flag_bits, value FROM events)
SELECT day::VARCHAR AS day, bin, sum(CASE WHEN event_id % 5 <> 0 THEN 1 END)::BIGINT AS counts, round(sum(CASE WHEN event_id % 5 <> 0 THEN value*4/60 END), 6) AS exposure, bit_or(CASE WHEN event_id % 5 <> 0 THEN flag_bits & 6 END)::BIGINT AS flag_bits, count(*) FILTER (flag_bits & 1 <> 0) AS night,
 round(CASE WHEN sum(CASE WHEN event_id % 5 <> 0 THEN value END) > 0 THEN sum(CASE WHEN event_id % 5 <> 0 THEN 1 END)/sum(CASE WHEN event_id % 5 <> 0 THEN value*4/60 END)/2 END, 6) AS flux FROM e GROUP BY day, bin""")
def a31(spark, sf):
    e = table(spark, sf, "events").select(F.to_date("ts").cast("string").alias("day"), F.minute("ts").alias("bin"), "event_id", F.col("event_id").bitwiseAND(F.lit(15)).alias("flag_bits"), F.lit(1).alias("counts"), F.col("value").alias("period"), F.lit(4).alias("spins"))
    g = S.sum_good_histograms(e, ["day", "bin"], F.col("event_id") % 5 != 0, 60, 6, {"night": 1})
    return S.counts_to_flux(g, F.lit(2.0)).select("day", "bin", "counts", r(F.col("exposure"), "exposure", 6), "flag_bits", "night", r(F.col("flux"), "flux", 6))


@query("a32_a34_a35_rebin", """
WITH e AS (SELECT user_id, event_id, (event_id*7.3) % 360 AS angle, value, event_id % 11 = 0 AS bad FROM events),
a AS (SELECT user_id, ((ceil(angle/45)::BIGINT-1) % 8 + 8) % 8 AS bin, sum(CASE WHEN bad THEN 0 ELSE 1 END)::BIGINT AS counts FROM e GROUP BY 1, 2)
SELECT 'spin' AS op, user_id, bin::BIGINT AS bin, round(counts, 4) AS v FROM a
UNION ALL SELECT 'curve', user_id, (event_id//20)::BIGINT, round(CASE WHEN sum(CASE WHEN bad THEN 0 ELSE value END)=0 THEN NULL ELSE sum((angle-1)*CASE WHEN bad THEN 0 ELSE value END)/sum(CASE WHEN bad THEN 0 ELSE value END) - 0.5 END, 4) FROM e GROUP BY user_id, event_id//20
UNION ALL SELECT 'mean', user_id, 0, round(((avg(((event_id*0.37) % 30)-15 ) % 360)+360) % 360, 4) FROM e GROUP BY user_id""")
def a32(spark, sf):
    # angles are decimals, as multiples of 7.3 and 0.37 are: no sum of them depends on its order
    e = table(spark, sf, "events").withColumns({"angle": F.pmod(F.col("event_id") * F.lit(Decimal("7.3")), F.lit(360)), "counts": F.lit(1), "exposure": F.col("value"), "bad": F.col("event_id") % 11 == 0, "sky": F.lit(1), "bin_background": F.lit(0.5)})
    a = S.rebin_spin(e, ["user_id"], "angle", 8, F.col("bad")).select(F.lit("spin").alias("op"), "user_id", F.col("bin").cast("long").alias("bin"), r(F.col("counts"), "v"))
    b = S.rebin_lightcurve(e.withColumn("flux", F.col("angle")), ["user_id"], "event_id", 20, F.col("bad")).select(F.lit("curve").alias("op"), "user_id", F.col("block").alias("bin"), r(F.col("flux"), "v"))
    wrapped = e.withColumn("angle", F.pmod(F.pmod(F.col("event_id") * F.lit(Decimal("0.37")), F.lit(30)) - 15, F.lit(360)))
    # unwrapped from the first row on, which may lie below or above 0: the mean is the same on the circle
    c = S.circular_mean(wrapped, ["user_id"], "event_id", "angle").select(F.lit("mean").alias("op"), "user_id", F.lit(0).cast("long").alias("bin"), r(F.col("angle"), "v"))
    return a.unionByName(b).unionByName(c)


@query("a36_rotation_mean", """
WITH o AS (SELECT (epoch_us(o_orderdate)/86400e6+2440587.5-2398167.329)/27.2753+1 AS n, o_totalprice*1.1*1.1 AS v FROM orders), b AS (SELECT floor(min(n)) AS a, max(n) AS z FROM o),
g AS (SELECT a+i*0.5 AS g, z FROM b, range(0, 211) AS t(i)), m AS (SELECT floor(n) AS x, avg(v) AS y FROM (SELECT * FROM o UNION ALL SELECT a+105, 0.04 FROM b WHERE z < a+105) GROUP BY 1),
s AS (SELECT x, y, lead(x) OVER (ORDER BY x) AS x1, lead(y) OVER (ORDER BY x) AS y1 FROM m)
SELECT round(g, 4) AS g, round(CASE WHEN x1 IS NULL THEN y ELSE y+(y1-y)*(g-x)/(x1-x) END, 4) AS v, g > z AS filled FROM g ASOF JOIN s ON g >= x""")
def a36(spark, sf):
    o = table(spark, sf, "orders").select(X.rotation_number(X.julian_date(F.col("o_orderdate").cast("timestamp"))).alias("n"), F.col("o_totalprice").alias("v"))
    grid = spark.range(211).select((o.agg(F.floor(F.min("n"))).scalar() + F.col("id") * 0.5).alias("g"))
    d = S.rotation_mean(o, F.col("n"), "v", grid, "g", F.lit(1.1), 0.04)
    return d.select(r(F.col("g"), "g"), r(F.col("v_at"), "v"), "filled")


@query("a37_a38_a50_profiles", """
WITH p AS (SELECT o_custkey % 10 AS cr, o_custkey % 7 - 3 AS lat, sum(o_totalprice) AS v, sum(o_orderkey % 100)::DOUBLE AS photo FROM orders GROUP BY 1, 2), e AS (SELECT cr, max(v) FILTER (lat=0) AS e FROM p GROUP BY cr)
SELECT cr, lat, round(v/e*5, 6) AS scaled, round(v-photo, 2) AS cx, round(photo*0.1+2, 4) AS cx_sigma, round(photo*(1+2*0.04), 4) AS electrons FROM p JOIN e USING (cr)""")
def a37(spark, sf):
    p = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 10).alias("cr"), (F.col("o_custkey") % 7 - 3).alias("lat")).agg(F.sum("o_totalprice").alias("total"), F.sum(F.col("o_orderkey") % 100).cast("double").alias("photo"))
    d = S.anchor_profile(p, ["cr"], "lat", "total", F.lit(5.0)).withColumns({"total_sigma": F.lit(2.0), "photo_sigma": F.col("photo") * 0.1})
    return S.split_rates(d).select("cr", "lat", r(F.col("scaled"), "scaled", 6), r(F.col("cx"), "cx", 2), r(F.col("cx_sigma"), "cx_sigma"), r(S.electron_density(F.col("photo"), F.lit(0.04)), "electrons"))


@query("a39_photoion_mean", f"""
WITH rot AS ({_ROT}), sparse AS (SELECT cr, y, cr % 5 = 3 AND cr+2 <= (SELECT max(cr) FROM rot) AS few FROM rot),
f AS (SELECT cr+d AS t, y*(1+d) AS value FROM sparse, (VALUES (0.1), (0.35), (0.6), (0.85)) AS x(d) WHERE NOT few OR d = 0.6), w AS (SELECT cr, cr+0.3 AS t0, cr+1.3 AS t1 FROM rot),
own AS (SELECT cr, count(*) AS n, avg(value*value*1e-12) AS m, stddev_samp(value*value*1e-12) AS s FROM w JOIN f ON t >= t0 AND t <= t1 GROUP BY cr),
p AS (SELECT cr, avg(t) AS t, avg(value) AS v FROM w JOIN f ON t >= cr-1 AND t <= cr GROUP BY cr), q AS (SELECT cr, avg(t) AS t, avg(value) AS v FROM w JOIN f ON t >= cr+1 AND t <= cr+2 GROUP BY cr)
SELECT cr, lat, round(share*CASE WHEN n > 2 THEN m ELSE pow(p.v+(q.v-p.v)*(cr+0.8-p.t)/(q.t-p.t), 2)*1e-12 END, 6) AS photo, round(CASE WHEN n > 2 THEN s END, 6) AS photo_sigma
FROM w LEFT JOIN own USING (cr) LEFT JOIN p USING (cr) LEFT JOIN q USING (cr), (VALUES (-30, 0.8), (0, 1.0), (30, 0.8)) AS g(lat, share)""")
def a39(spark, sf):
    rot = rotations(spark, sf)
    # four points per rotation, but one in some
    few = (F.col("cr") % 5 == 3) & (F.col("cr") + 2 <= rot.agg(F.max("cr")).scalar())
    flux = rot.select("cr", "y", F.explode(F.when(few, F.array(F.lit(0.6))).otherwise(F.array(*[F.lit(x) for x in (0.1, 0.35, 0.6, 0.85)]))).alias("d"))
    flux = flux.select((F.col("cr") + F.col("d")).alias("t"), (F.col("y") * (1 + F.col("d"))).alias("value"))
    windows = rot.select("cr", (F.col("cr") + 0.3).alias("t0"), (F.col("cr") + 1.3).alias("t1"))
    profile = spark.createDataFrame([(-30, 0.8), (0, 1.0), (30, 0.8)], "lat int, share double")
    d = S.photoion_mean(flux, windows, profile, lambda v: v * v * 1e-12)
    return d.select("cr", "lat", r(F.col("photo"), "photo", 6), r(F.col("photo_sigma"), "photo_sigma", 6))


CURVE = [(300.0 + 25 * i, 50000.0 + 12345.6 * i) for i in range(20)]


@query("a40_a41_wind", f"""
WITH c(v, k) AS (VALUES {", ".join(f"({v}::DOUBLE, {k}::DOUBLE)" for v, k in CURVE)}), m AS (SELECT cr, y, arg_min(struct_pack(v := v, k := k), abs(k-y)) AS b FROM ({_ROT}), c GROUP BY ALL)
SELECT cr, b.v AS speed, round(y/b.k, 6) AS density, (SELECT round(avg(y), 4) FROM (SELECT y FROM m ORDER BY cr DESC LIMIT 13)) AS invariant FROM m""")
def a40(spark, sf):
    rot = rotations(spark, sf)
    inv = S.invariant(rot, "cr", "y", 13).scalar()
    return S.invert_curve(rot, "y", CURVE).select("cr", "speed", r(F.col("density"), "density", 6), r(inv, "invariant"))


@query("a42_a43_daily", """
WITH d AS (SELECT event_id, user_id, ts::DATE AS day, value, epoch_us(ts) AS t, min(epoch_us(ts)) OVER (PARTITION BY user_id) AS s FROM events), c AS (SELECT event_id, user_id, value < avg(value) OVER w - 1.2*stddev_pop(value) OVER w OR value > avg(value) OVER w + 1.5*stddev_pop(value) OVER w AS clipped FROM d WINDOW w AS (PARTITION BY day)),
m AS (SELECT user_id, coalesce(round_even(median(CASE WHEN t >= s+1800000000 AND t < s+81000000000 THEN value END), 0), 90) AS median FROM d GROUP BY user_id)
SELECT event_id, clipped, median FROM c JOIN m USING (user_id)""")
def a42(spark, sf):
    ev = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    m = S.median_in_window(ev, ["user_id"], F.unix_micros(F.col("ts").cast("timestamp")), "value")
    return S.daily_sigma_clip(ev, "day", "value", 1.2, 1.5).join(m, "user_id").select("event_id", "clipped", F.col("median").cast("double").alias("median"))


@query("a44_a45_a46_rates", """
WITH c AS (SELECT l_orderkey//50 AS chunk, l_linenumber AS bin, avg(l_extendedprice) AS rate, sqrt(sum(l_tax*l_tax))/count(*) AS sigma FROM lineitem GROUP BY 1, 2)
SELECT chunk::BIGINT AS chunk, bin, round(rate, 6) AS rate, round(sigma, 8) AS sigma, round(4*pi()*2*rate/((bin*100.0)*(0.01*1e-10)*0.3)*1e-15, 4) AS vdf, round(rate/((bin*100.0)*0.01*0.3)/1e10*1e6, 6) AS flux FROM c""")
def a44(spark, sf):
    li = table(spark, sf, "lineitem").select(F.floor(F.col("l_orderkey") / 50).alias("chunk"), F.col("l_linenumber").alias("bin"), F.col("l_extendedprice").alias("rate"), F.col("l_tax").alias("sigma"))
    d = S.chunk_mean_rate(li, ["chunk", "bin"], "rate", "sigma")
    e, g, eff = F.col("bin") * 100.0, F.lit(0.01), F.lit(0.3)
    return d.select("chunk", "bin", r(F.col("rate"), "rate", 6), r(F.col("sigma"), "sigma", 8), r(S.vdf(F.col("rate"), e, g, eff, 2.0) * 1e-15, "vdf"), r(S.differential_flux(F.col("rate"), e, g, eff) * 1e6, "flux", 6))


@query("a48_t1_peaks", f"""
WITH {_SPEC}, s2 AS (SELECT epoch, (energy-1)::INTEGER AS b, psd*(detector-3) AS rate, energy+detector AS voltage FROM s), m AS (SELECT epoch, b, avg(rate) AS m, avg(voltage) AS v FROM s2 GROUP BY ALL), p AS (SELECT epoch, greatest(4, least(45, arg_max(b, m))) AS peak FROM (SELECT * FROM m ORDER BY b) GROUP BY epoch),
w AS (SELECT epoch, sum(sqrt(v)*m)/sum(m) AS speed FROM m JOIN p USING (epoch) WHERE abs(b-peak) <= 4 AND m >= 0 GROUP BY epoch)
SELECT epoch, peak, count(*) AS n, round(any_value(speed), 6) AS speed FROM s2 JOIN p USING (epoch) LEFT JOIN w USING (epoch) WHERE abs(b-peak) <= 4 GROUP BY ALL""")
def a48(spark, sf):
    d = _spectrum(spark, sf).select("epoch", (F.col("energy") - 1).cast("int").alias("b"), (F.col("psd") * (F.col("detector") - 3)).alias("rate"), (F.col("energy") + F.col("detector")).alias("voltage"))
    n = S.peak_window(d, ["epoch"], "b", "rate", 4, 50).groupBy("epoch", "peak").agg(F.count("*").alias("n"))
    v = S.peak_speed(d, ["epoch"], "b", "rate", "voltage", F.sqrt, 4, 50)
    return n.join(v, "epoch").select("epoch", "peak", "n", r(F.col("speed"), "speed", 6))


@query("a51_epoch_half_width", f"""
WITH {_SPEC} SELECT epoch, trunc((sum(l_discount*1000)*(24/2.0)*30+sum(energy*100))/2*1000)::BIGINT//1000000 AS half_ms FROM s GROUP BY epoch""")
def a51(spark, sf):
    d = _spectrum(spark, sf).withColumns({"settle": F.col("l_discount") * 1000, "acquisition": F.col("energy") * 100})
    return S.epoch_half_width(d, "epoch", 24, 2, 30).select("epoch", F.expr("half_ns div 1000000").alias("half_ms"))


@query("t2_second_peak", f"""
WITH {_SPEC}, c AS (SELECT epoch, energy, sum(psd) AS counts, greatest(0, sum(psd)-2*sum(psd*bg)) AS res FROM s GROUP BY 1, 2),
m AS (SELECT *, first_value(energy) OVER (PARTITION BY epoch ORDER BY counts DESC, energy) AS e0, lag(res) OVER (PARTITION BY epoch ORDER BY energy) AS before, row_number() OVER (PARTITION BY epoch ORDER BY energy) AS i, count(*) OVER (PARTITION BY epoch) AS n FROM c),
w AS (SELECT *, energy >= 1.5*e0 AND energy <= 4*e0 AS far, min(CASE WHEN energy >= 1.5*e0 AND energy <= 4*e0 AND res > before THEN energy END) OVER (PARTITION BY epoch) AS rise FROM m),
p AS (SELECT epoch, any_value(e0) AS main_energy, arg_max(struct_pack(i := i, n := n), struct_pack(r := res, e := -energy)) FILTER (far AND energy >= rise) AS p FROM w GROUP BY epoch)
SELECT epoch, main_energy, p.i AS peak_bin, CASE WHEN p.i > 3 AND p.i < p.n THEN p.i-3 END AS first_bin, CASE WHEN p.i > 3 AND p.i < p.n THEN p.i+1 END AS last_bin, CASE WHEN p IS NULL THEN 'no rise' WHEN p.i <= 3 OR p.i >= p.n THEN 'at the edge' END AS error FROM p""")
def t2(spark, sf):
    d = _spectrum(spark, sf).groupBy("epoch", "energy").agg(F.sum("psd").alias("counts"), (F.sum(F.col("psd") * F.col("bg"))).alias("back"))
    return S.second_peak(d, ["epoch"], "energy", "counts", "back")


@query("t3_t4_event_words", """
WITH w AS (SELECT l_orderkey AS ev, (l_suppkey % 4)::INTEGER AS g, l_linenumber*1000000+l_partkey AS no, (l_partkey % 5)::INTEGER AS address, (40*l_quantity)::INTEGER AS adc, l_linestatus='F' AS low FROM lineitem), r AS (SELECT ev, list(DISTINCT g) AS gs FROM w GROUP BY ev),
x AS (SELECT ev, CASE WHEN list_contains(gs, 1) AND list_contains(gs, 2) AND NOT list_contains(gs, 3) THEN [1, 2] WHEN list_contains(gs, 2) AND list_contains(gs, 3) THEN [2, 3] WHEN list_contains(gs, 0) THEN [0] END AS inc FROM r),
b AS (SELECT w.*, inc, adc*CASE WHEN low THEN 20 ELSE 1 END AS signal, row_number() OVER (PARTITION BY ev, g ORDER BY adc*CASE WHEN low THEN 20 ELSE 1 END DESC, no) AS n FROM w JOIN x USING (ev) WHERE adc < 2047 AND list_contains(inc, g)),
k AS (SELECT *, 0.9::DOUBLE*(adc*(0.1::DOUBLE*address)+CASE WHEN low THEN 2 ELSE 1 END) AS e FROM b WHERE n=1), v AS (SELECT ev FROM k GROUP BY ev, len(inc) HAVING count(*)=len(inc))
SELECT ev, round(sum(CASE WHEN g=inc[1] THEN e END), 6) AS e_delta, round(sum(CASE WHEN g=inc[2] THEN e END), 6) AS e_prime, round(sum(e), 6) AS total FROM k WHERE ev IN (SELECT ev FROM v) GROUP BY ev""")
def t3(spark, sf):
    w = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("ev"), (F.col("l_suppkey") % 4).cast("int").alias("group"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("no"), (F.col("l_partkey") % 5).cast("int").alias("address"), (F.col("l_quantity") * 40).cast("int").alias("adc"), (F.col("l_linestatus") == "F").alias("low_gain"))
    rules = {"near": ([1, 2], [3]), "far": ([2, 3], []), "single": ([0], [])}
    events = J.set_rule_join(w.groupBy("ev").agg(F.collect_set("group").alias("groups")), "groups", [{"name": n, "include": a, "exclude": b} for n, (a, b) in rules.items()])
    included = F.lit(None).cast("array<int>")
    for name, (groups, _) in rules.items():
        included = F.when(F.col("rule") == name, F.array(*[F.lit(g) for g in groups])).otherwise(included)
    gain = w.select("address", "low_gain").distinct().select("address", "low_gain", (F.col("address") * 0.1).alias("a"), F.when(F.col("low_gain"), 2.0).otherwise(1.0).alias("b"))
    best = S.top_per_group(w.join(events.select("ev", included.alias("included")), "ev"), "ev", "no", "included")
    d = S.event_energies(best, gain, "ev", F.get("included", F.lit(0)), F.get("included", F.lit(1)), F.lit(0.9))
    return d.select("ev", r(F.col("e_delta"), "e_delta", 6), r(F.col("e_prime"), "e_prime", 6), r(F.col("total"), "total", 6))


@query("t5_nearest_index", f"""
WITH n AS (SELECT cr, lead(cr) OVER (ORDER BY cr) AS nx FROM ({_ROT})) SELECT arg_min(cr, abs(cr-1920.4)) AS nearest, arg_min(nx, abs(cr-1920.4)) AS following FROM n""")
def t5(spark, sf):
    return S.nearest_index(rotations(spark, sf), F.lit(1920.4), "cr")


@query("a52_log_local_fit", f"""
WITH {_SPEC}, g AS (SELECT epoch, detector, sector//3 AS slot, energy, psd FROM s WHERE psd > 0), o AS (SELECT epoch, detector, slot, max(energy) AS top, max(energy) FILTER (n = 2) AS second FROM (SELECT *, row_number() OVER (PARTITION BY epoch, detector, slot ORDER BY energy) AS n FROM g) GROUP BY 1, 2, 3),
c(bin, centre) AS (VALUES (0, 3.0), (1, 8.0), (2, 20.0), (3, 44.0)), p AS (SELECT epoch, detector, slot, bin, centre, count(*) AS n, regr_slope(ln(psd), ln(energy)) AS m, regr_intercept(ln(psd), ln(energy)) AS b, var_pop(ln(energy)) AS spread, min(abs(energy/centre-1)) AS near, min(energy) < centre AND max(energy) > centre AS sides FROM g, c WHERE energy > 0.6*centre AND energy < 1.4*centre GROUP BY epoch, detector, slot, bin, centre),
x AS (SELECT p.*, top > 0.6*centre AND top < 1.4*centre AS has_top, second > 0.6*centre AND second < 1.4*centre AS has_second FROM p JOIN o USING (epoch, detector, slot))
SELECT epoch, detector, slot, bin, n, round(CASE WHEN n >= 2 AND spread > 1e-12 AND ((has_top AND near < 0.18) OR (has_second AND (near < 0.12 OR sides)) OR (NOT has_top AND NOT has_second AND sides)) THEN exp(b+m*ln(centre)) END, 4) AS psd FROM x""")
def a52(spark, sf):
    d = _spectrum(spark, sf).withColumn("slot", F.expr("sector div 3"))
    return FIT.log_local_fit(d, ["epoch", "detector", "slot"], [3.0, 8.0, 20.0, 44.0], near_high=0.18, near_low=0.12).select("epoch", "detector", "slot", "bin", "n", r(F.col("psd"), "psd"))


@query("a53_power_law_fit", f"""
WITH RECURSIVE {_SPEC}, d AS (SELECT epoch//12 AS epoch, energy AS e, avg(psd/energy/energy)/100 AS f, 0.2*avg(psd/energy/energy)/100 AS s, sum(bg) AS w, bit_or(detector)::BIGINT AS flags FROM s GROUP BY 1, 2),
r(epoch, k, a, g) AS (SELECT epoch, 0, exp(regr_intercept(ln(f), ln(e))), -regr_slope(ln(f), ln(e)) FROM d GROUP BY epoch
 UNION ALL SELECT epoch, k+1, a+(h22*b1-h12*b2)/(h11*h22-h12*h12), g+(h11*b2-h12*b1)/(h11*h22-h12*h12) FROM (
  SELECT r.epoch, k, a, g, sum(x*x) AS h11, sum(x*y) AS h12, sum(y*y) AS h22, sum(x*z) AS b1, sum(y*z) AS b2 FROM (
   SELECT r.epoch, k, a, g, pow(e, -g)/s AS x, -a*ln(e)*pow(e, -g)/s AS y, (f-a*pow(e, -g))/s AS z FROM r JOIN d ON d.epoch=r.epoch WHERE k < 40) AS r GROUP BY r.epoch, k, a, g)),
v AS (SELECT r.epoch, a, g, sum(pow(pow(e, -g)/s, 2)) AS h11, sum(-a*ln(e)*pow(pow(e, -g)/s, 2)) AS h12, sum(pow(a*ln(e)*pow(e, -g)/s, 2)) AS h22, sum(pow((f-a*pow(e, -g))/s, 2))/greatest(1, count(*)-2) AS chi2, sum(w) AS exposure, bit_or(flags) AS flags FROM r JOIN d ON d.epoch=r.epoch WHERE k = 40 GROUP BY r.epoch, a, g)
SELECT epoch, CASE WHEN g > 0 AND isfinite(g) THEN round(a, 5) END AS a, CASE WHEN g > 0 AND isfinite(g) THEN round(g, 5) END AS gamma, CASE WHEN g > 0 AND isfinite(g) THEN round(sqrt(h11/(h11*h22-h12*h12)), 5) END AS sigma_gamma,
 CASE WHEN g > 0 AND isfinite(g) THEN round(chi2, 5) END AS chi2, CASE WHEN isfinite(g) THEN round(sqrt(h22/(h11*h22-h12*h12)), 5) END AS sigma_a, round(exposure, 4) AS exposure, epoch::BIGINT*1000000 AS obs_us, flags FROM v""")
def a53(spark, sf):
    d = _spectrum(spark, sf).groupBy(F.expr("epoch div 12").alias("epoch"), "energy").agg((F.avg(F.col("psd") / F.col("energy") / F.col("energy")) / 100).alias("intensity"), F.sum("bg").alias("exposure"), F.bit_or("detector").alias("flags"))
    d = d.withColumns({"sigma": F.col("intensity") * 0.2, "obs_us": F.col("epoch").cast("long") * 1000000})
    return FIT.power_law_fit(d, ["epoch"]).select("epoch", *[r(F.col(c), c, 5) for c in ("a", "gamma", "sigma_gamma", "chi2", "sigma_a")], r(F.col("exposure"), "exposure"), "obs_us", F.col("flags").cast("long").alias("flags"))


def _line(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    return li.select("p_brand", (F.col("l_extendedprice") / 1000).alias("y"), F.col("l_quantity").alias("x"), (F.col("l_tax") + 1).alias("w"))


_LINE = "d AS (SELECT p_brand, l_extendedprice/1000 AS y, l_quantity AS x, l_tax+1 AS w FROM lineitem JOIN part ON l_partkey=p_partkey)"


@query("a54_grouped_wls", f"""
WITH {_LINE}, s AS (SELECT p_brand, sum(w) AS s0, sum(w*x) AS sx, sum(w*x*x) AS sxx, sum(w*y) AS sy, sum(w*x*y) AS sxy FROM d GROUP BY 1), b AS (SELECT p_brand, (s0*sxy-sx*sy)/(s0*sxx-sx*sx) AS b, (sy*sxx-sx*sxy)/(s0*sxx-sx*sx) AS a FROM s)
SELECT p_brand, round(any_value(a), 6) AS a, round(any_value(b), 6) AS b, round(sum(w*(y-a-b*x)*(y-a-b*x)), 3) AS chi2 FROM d JOIN b USING (p_brand) GROUP BY p_brand""")
def a54(spark, sf):
    d = FIT.grouped_wls(_line(spark, sf), ["p_brand"], F.col("y"), [F.lit(1.0), F.col("x")], F.col("w"))
    return d.select("p_brand", r(F.get("coefficients", F.lit(0)), "a", 6), r(F.get("coefficients", F.lit(1)), "b", 6), r(F.col("chi2"), "chi2", 3))


@query("a55_a56_fit_quality", f"""
WITH {_LINE}, s AS (SELECT p_brand, count(*) AS n, sum(x) AS sx, sum(x*x) AS sxx, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_r2(y, x) AS r2 FROM d GROUP BY 1),
i AS (SELECT *, sxx/(n*sxx-sx*sx) AS i00, -sx/(n*sxx-sx*sx) AS i01, n/(n*sxx-sx*sx) AS i11 FROM s), m AS (SELECT p_brand, any_value(i01) AS i01, any_value(i11) AS i11, any_value(r2) AS r2, sum(e) AS m00, sum(e*x) AS m01, sum(e*x*x) AS m11 FROM (SELECT *, pow((y-a-b*x)/(1-(i00+2*i01*x+i11*x*x)), 2) AS e FROM d JOIN i USING (p_brand)) GROUP BY p_brand)
SELECT p_brand, round(r2, 6) AS r2, round(1e6*(i01*i01*m00+2*i01*i11*m01+i11*i11*m11), 6) AS var_b FROM m""")
def a55(spark, sf):
    d, x = _line(spark, sf), [F.lit(1.0), F.col("x")]
    fit = FIT.grouped_wls(d, ["p_brand"], F.col("y"), x, F.lit(1.0))
    c, q = FIT.hc3(d, fit, ["p_brand"], F.col("y"), x), FIT.r_squared(d, fit, ["p_brand"], F.col("y"), x)
    return c.join(q, "p_brand").select("p_brand", r(F.col("r2"), "r2", 6), r(1e6 * F.get("covariance", F.lit(3)), "var_b", 6))


@query("a57_ionization_profile", """
WITH c AS (SELECT l_suppkey AS k, l_linenumber-1 AS i, avg(l_discount) AS v FROM lineitem GROUP BY 1, 2), p AS (SELECT k, j, sum(v*(i+1)*(j+0.5))*2+0.1 AS c FROM c, range(0, 3) AS t(j) WHERE i < 4 GROUP BY 1, 2)
SELECT k, lat, round(sum(c*pow(sin(radians(lat)), j)), 6) AS rate FROM p, (VALUES (-60), (0), (60)) AS l(lat) GROUP BY k, lat""")
def a57(spark, sf):
    c = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("k"), (F.col("l_linenumber") - 1).alias("i")).agg(F.avg("l_discount").alias("value"))
    m = c.select("i").distinct().withColumn("j", F.explode(F.array(*[F.lit(j) for j in range(3)]))).withColumn("m", (F.col("i") + 1) * (F.col("j") + 0.5))
    powers = {lat: [float(np.sin(np.radians(lat)) ** j) for j in range(3)] for lat in (-60, 0, 60)}
    return FIT.ionization_profile(c, m, "k", 4, 2.0, 0.1, powers).select("k", "lat", r(F.col("rate"), "rate", 6))


def _mean_fit(pdf):
    if len(pdf) < 3:
        raise ValueError("too few rows")
    return {"mean": float(pdf["value"].mean()), "n": len(pdf)} if pdf["value"].mean() > 20 else None


@query("f1_run_group_fits", """
SELECT user_id, CASE WHEN count(*) >= 3 AND avg(value) > 20 THEN round(avg(value), 9) END AS mean, CASE WHEN count(*) < 3 THEN 1 WHEN avg(value) <= 20 THEN 2 ELSE 0 END AS fit_flag FROM events GROUP BY user_id""")
def f1(spark, sf):
    d = FIT.run_group_fits(table(spark, sf, "events").select("user_id", "value"), "user_id", _mean_fit, "mean double, n long")
    return d.select("user_id", r(F.col("mean"), "mean", 9), "fit_flag")


@query("f2_registered_combination", """
SELECT l_partkey AS cell, max(l_extendedprice) AS intensity FROM lineitem GROUP BY 1""")
def f2(spark, sf):
    from ..operators import maps as M

    M.register_combination("brightest", lambda maps, cell: maps.groupBy(*cell).agg(F.max("intensity").alias("intensity")))
    return M.combine("brightest", table(spark, sf, "lineitem").select(F.col("l_partkey").alias("cell"), F.col("l_extendedprice").alias("intensity")), ["cell"])
