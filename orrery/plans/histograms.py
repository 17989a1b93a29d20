"""Histograms and windows over embeddings, line items, events and orders."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import histograms as H
from ..operators import joins as J
from ..operators import windows as W
from .base import query, r, table
from .expressions import _E, _vectors

_ANG = f"""v AS (SELECT vec_id, label, embedding[7]::DOUBLE AS inten, embedding[8]::DOUBLE AS sm, embedding[9]::DOUBLE AS sp, {_E} FROM embeddings),
a AS (SELECT *, degrees(acos(greatest(-1, least(1, (vx*fx+vy*fy+vz*fz)/sqrt(vx*vx+vy*vy+vz*vz)/sqrt(fx*fx+fy*fy+fz*fz))))) AS pa,
 ((degrees(atan2((vx*fz-vz*fx)/sqrt(fx*fx+fz*fz), (-vx*fx*fy + vy*(fx*fx+fz*fz) - vz*fy*fz)/sqrt(fx*fx+fz*fz)/sqrt(fx*fx+fy*fy+fz*fz))) % 360) + 360) % 360 AS gy FROM v)"""


def _angles(spark, sf):
    e = table(spark, sf, "embeddings")
    v, b = X.vector("vx", "vy", "vz"), X.vector("fx", "fy", "fz")
    x = e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in ((6, "intensity"), (7, "sig_minus"), (8, "sig_plus"))])
    return _vectors(spark, sf).join(x, "vec_id").withColumns({"pa": X.pitch_angle(v, b), "gyro": X.gyrophase(v, b)})


@query("a11_hist_pa_gyro", f"""
WITH {_ANG}, b AS (SELECT *, least(5, floor(pa/30))::INTEGER AS pa_bin, least(3, floor(gy/90))::INTEGER AS gyro_bin FROM a)
SELECT label, pa_bin, gyro_bin, count(*) AS n, round(avg(inten), 6) AS intensity, round(sqrt(sum(sm*sm))/count(*), 6) AS sig_minus, round(sqrt(sum(sp*sp))/count(*), 6) AS sig_plus
FROM b GROUP BY GROUPING SETS ((label, pa_bin), (label, pa_bin, gyro_bin))""")
def a11(spark, sf):
    d = H.hist_pa_gyro(_angles(spark, sf), ["label"], 6, 4)
    return d.select("label", "pa_bin", "gyro_bin", "n", r(F.col("intensity"), "intensity", 6), r(F.col("sig_minus"), "sig_minus", 6), r(F.col("sig_plus"), "sig_plus", 6))


@query("a12_hist_pa_counts", f"""
WITH {_ANG}, b AS (SELECT *, CASE WHEN pa >= 0 AND pa < 60 THEN 0 WHEN pa >= 70 AND pa < 110 THEN 1 ELSE 2 END AS pa_bin, CASE WHEN gy < 80 THEN 0 WHEN gy >= 90 AND gy < 210 THEN 1 ELSE 2 END AS gyro_bin FROM a)
SELECT label, pa_bin, gyro_bin, round(avg(inten), 6) AS intensity, sum(vec_id % 5)::BIGINT AS counts, round(CASE WHEN sum(vec_id % 5)=0 THEN NULL ELSE avg(inten)/sqrt(sum(vec_id % 5)) END, 6) AS sigma FROM b GROUP BY GROUPING SETS ((label, pa_bin), (label, pa_bin, gyro_bin))""")
def a12(spark, sf):
    d = H.hist_pa_gyro_counts(_angles(spark, sf).withColumn("counts", F.col("vec_id") % 5), ["label"], [30.0, 90.0, 150.0], [30.0, 20.0, 30.0], [40.0, 150.0, 300.0], [40.0, 60.0, 60.0])
    return d.select("label", "pa_bin", "gyro_bin", r(F.col("intensity"), "intensity", 6), "counts", r(F.col("sigma"), "sigma", 6))


def _direct(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("priority"), (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("epoch"), F.pmod(F.col("l_quantity").cast("int"), F.lit(24)).alias("sector"),
        F.pmod(F.col("l_suppkey"), F.lit(8)).cast("int").alias("step"), "l_returnflag", "l_discount",
    )


_DIR = "d AS (SELECT l_orderkey, l_linenumber AS priority, year(l_shipdate)*12+month(l_shipdate) AS epoch, l_quantity::INTEGER % 24 AS sector, (l_suppkey % 8)::INTEGER AS step, l_returnflag, l_discount FROM lineitem), h AS (SELECT epoch, priority, step, sector, count(*) AS n FROM d GROUP BY ALL)"
_NORM = _DIR + """, c AS (SELECT epoch, priority, step, sector % 12 AS hs, (count(*)*1.5)::DOUBLE AS counts FROM d WHERE step < 7 GROUP BY ALL),
 b AS (SELECT epoch, priority, step, hs + k AS sector, counts FROM c, (VALUES (0), (12)) AS t(k)), f AS (SELECT epoch, priority, step, sector, CASE WHEN coalesce(n,0)=0 AND coalesce(counts,0)=0 THEN 0 WHEN coalesce(n,0)=0 THEN NULL ELSE greatest(1.0, coalesce(counts,0)/n) END AS factor FROM b FULL JOIN h USING (epoch, priority, step, sector))"""


@query("a13_a14_event_hist", "WITH " + _DIR + """
SELECT epoch, priority, step, s + k AS sector, n FROM (SELECT epoch, priority, step, sector % 12 AS s, sum(n)::BIGINT AS n FROM h GROUP BY ALL), (VALUES (0), (12)) AS t(k)""")
def a13(spark, sf):
    d = H.fold_half_spin(H.event_hist(_direct(spark, sf), ["epoch", "priority", "step", "sector"]), ["epoch", "priority", "step"], "sector", 24, "n")
    return d.select("epoch", "priority", "step", "sector", "n")


def _factors(spark, sf):
    d = _direct(spark, sf)
    keys = ["epoch", "priority", "step"]
    counts = d.where("step < 7").groupBy(*keys, F.pmod("sector", F.lit(12)).alias("half_sector")).agg((F.count("*") * 1.5).alias("counts"))
    return d, H.normalization(counts, H.event_hist(d, [*keys, "sector"]), keys, 12)


@query("a15_a16_normalization", "WITH " + _NORM + """
SELECT epoch, priority, step, sector, round(factor, 6) AS factor, (SELECT count(*) FROM d WHERE d.epoch=f.epoch AND d.priority=f.priority AND d.step=f.step AND d.sector=f.sector) AS events FROM f""")
def a15(spark, sf):
    d, f = _factors(spark, sf)
    keys = ["epoch", "priority", "step", "sector"]
    n = H.normalization_per_event(d, f, keys).groupBy(*keys).agg(F.count("*").alias("events"))
    return f.join(n, keys, "left").select(*keys, r(F.col("factor"), "factor", 6), F.coalesce("events", F.lit(0)).alias("events"))


@query("a17_a18_species", "WITH " + _NORM + """,
 s AS (SELECT CASE WHEN l_discount < 0.03 THEN 'a' WHEN l_discount < 0.07 THEN 'b' END AS species, d.epoch, step, factor FROM d JOIN f USING (epoch, priority, step, sector))
SELECT species, epoch, step, round(sum(factor)/(step+1), 6) AS rate FROM s WHERE species IS NOT NULL GROUP BY species, epoch, step""")
def a17(spark, sf):
    d, f = _factors(spark, sf)
    e = H.normalization_per_event(d, f, ["epoch", "priority", "step", "sector"]).withColumn("species", F.when(F.col("l_discount") < 0.03, "a").when(F.col("l_discount") < 0.07, "b"))
    h = H.species_hist(e, ["epoch", "priority", "step"])
    d = H.counts_to_rate(h, ["species", "epoch", "step"], F.col("step") + 1)
    return d.select("species", "epoch", "step", r(F.col("rate"), "rate", 6))


@query("a19_a20_intensity", """
WITH d AS (SELECT l_orderkey % 5 AS k, l_linenumber % 6 AS half_spin, (l_suppkey % 24 + 1)::INTEGER AS azimuth, (l_quantity::INTEGER % 24)::INTEGER AS sector, (l_partkey % 8)::INTEGER AS step, l_extendedprice AS rate,
 CASE WHEN l_shipdate < TIMESTAMP '1994-06-01' THEN l_linenumber % 6 > 2 WHEN l_shipdate < TIMESTAMP '1996-01-01' THEN false
  ELSE l_linenumber % 6 > 2 OR (l_linenumber % 6 = 2 AND (l_quantity::INTEGER % 12 > l_orderkey % 30 % 12 OR (l_quantity::INTEGER % 12 = l_orderkey % 30 % 12 AND l_partkey % 8 > 3))) END AS reduced FROM lineitem),
s AS (SELECT k, half_spin, sector, least(azimuth-1, 25-azimuth) AS elevation, sum(rate/((CASE WHEN reduced THEN 1+azimuth ELSE 2+azimuth+step/10.0 END)*(1+step*1.5)*(0.5+step/100.0+azimuth/1000.0))) AS i FROM d GROUP BY ALL),
u AS (SELECT k, half_spin, sector, elevation, i FROM s WHERE elevation NOT IN (0, 12)
 UNION ALL SELECT k, half_spin, (sector+12*h)%24, elevation, i FROM s, range(0, 2) AS t(h) WHERE elevation IN (0, 12) AND (sector < 12) = ((elevation = 0) = (half_spin % 2 = 0)))
SELECT k, half_spin, sector::INTEGER AS sector, elevation, round(i, 4) AS intensity FROM u""")
def a19(spark, sf):
    quantity = F.col("l_quantity").cast("int")
    d = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") % 5).alias("k"), (F.col("l_linenumber") % 6).alias("half_spin"), (F.col("l_suppkey") % 24 + 1).cast("int").alias("azimuth"), F.pmod(quantity, F.lit(24)).alias("sector"),
        (F.col("l_partkey") % 8).cast("int").alias("step"), F.col("l_extendedprice").alias("rate"), (1 + F.col("l_partkey") % 8 * 1.5).alias("energy"), (F.col("l_orderkey") % 30).alias("at_sector"), F.col("l_shipdate").alias("epoch"),
    )
    grid = spark.range(8).select(F.col("id").cast("int").alias("step"), F.explode(F.sequence(F.lit(1), F.lit(24))).alias("azimuth"))
    factors = grid.select("step", "azimuth", (F.col("azimuth") + 2.0 + F.col("step") / 10).alias("full"), (F.col("azimuth") + 1.0).alias("reduced"))
    eff = grid.select("step", "azimuth", (0.5 + F.col("step") / 100 + F.col("azimuth") / 1000).alias("efficiency"))
    eras = [F.lit(x).cast("timestamp") for x in ("1994-06-01", "1996-01-01")]
    reduced = H.reduced_factor(F.col("half_spin"), F.col("sector"), F.col("step"), F.lit(2), F.col("at_sector"), F.lit(3), F.col("epoch").cast("timestamp"), *eras)
    i = H.rate_to_intensity(d, factors, eff, reduced, ["step", "azimuth"], ["step", "azimuth"])
    angles = spark.range(1, 25).select(F.col("id").cast("int").alias("azimuth"), F.least(F.col("id") - 1, 25 - F.col("id")).cast("int").alias("elevation"))
    e = H.azimuth_to_elevation(i, ["k", "half_spin"], angles, "half_spin", 0, 12, 12, "intensity")
    return e.select("k", "half_spin", "sector", "elevation", r(F.col("intensity"), "intensity"))


@query("a21_a23_a24_composition", """
WITH d AS (SELECT l_suppkey, l_returnflag || l_linestatus AS s, sum(l_extendedprice*sqrt(l_quantity)*sqrt(l_linenumber/2.0))*1e-6 AS density FROM lineitem GROUP BY ALL)
SELECT l_suppkey, s, round(density, 4) AS density, round(density/sum(density) OVER (PARTITION BY l_suppkey), 6) AS share, round(sum(CASE WHEN s IN ('AF','RF') THEN density END) OVER (PARTITION BY l_suppkey)/sum(CASE WHEN s='NO' THEN density END) OVER (PARTITION BY l_suppkey), 4) AS ratio FROM d""")
def a21(spark, sf):
    d = table(spark, sf, "lineitem").select("l_suppkey", F.concat("l_returnflag", "l_linestatus").alias("s"), F.col("l_extendedprice").alias("intensity"), F.col("l_quantity").alias("energy"), (F.col("l_linenumber") / 2).alias("m"))
    p = H.partial_density(d, ["l_suppkey", "s"], 1e-6, F.col("m"))
    a = H.abundance_ratios(p, ["l_suppkey"], {"ratio": (["AF", "RF"], ["NO"])}, "s", "density")
    return H.share_of_total(p, ["l_suppkey"], "density").join(a, "l_suppkey").select("l_suppkey", "s", r(F.col("density"), "density"), r(F.col("share"), "share", 6), r(F.col("ratio"), "ratio"))


@query("a22_a49_block_mean", """
WITH b AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_id)-1)//10 AS block FROM events)
SELECT user_id, block::BIGINT AS block, round(avg(value), 6) AS value, sum(event_id % 3)::BIGINT AS delta, bit_or(event_id % 8)::BIGINT AS flags FROM b GROUP BY user_id, block""")
def a22(spark, sf):
    ev = table(spark, sf, "events").withColumns({"delta": F.col("event_id") % 3, "flags": F.col("event_id") % 8})
    d = H.block_mean(ev, ["user_id"], "event_id", 10, ["value"], ["delta"])
    from ..operators import spectra as S

    f = S.block_velocity(ev, ["user_id"], "event_id", 10, ["value"], "flags")
    return d.join(f.select("user_id", "block", "flags"), ["user_id", "block"]).select("user_id", "block", r(F.col("value"), "value", 6), "delta", "flags")


@query("a47_mean_field_direction", """
WITH g AS (SELECT i AS k, 1704067200000000 + i*3600000000 AS t FROM range(0, 720) AS s(i)), m AS (SELECT k, avg(value) AS x, avg(event_id % 9) AS y, avg(event_id % 4) AS z FROM g JOIN events ON epoch_us(ts) >= t-1200000000 AND epoch_us(ts) < t+1200000000 GROUP BY k)
SELECT k, round(x/sqrt(x*x+y*y+z*z), 6) AS x FROM m""")
def a47(spark, sf):
    ev = table(spark, sf, "events").select("ts", F.col("value").alias("x"), (F.col("event_id") % 9).cast("double").alias("y"), (F.col("event_id") % 4).cast("double").alias("z"))
    m = J.interval_mean_join(spark.range(720).select(F.col("id").alias("k")), ev, "k", F.col("k") * 3600000000 + 1704067200000000, 1_200_000_000, "ts", ["x", "y", "z"])
    return H.mean_field_direction(m, ["x", "y", "z"]).where("x IS NOT NULL").select("k", r(F.col("x"), "x", 6))


@query("w1_centered_mean", """
WITH b AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id)-1 AS i FROM events)
SELECT a.event_id, round(avg(b.value), 6) AS mean FROM b a JOIN b ON a.user_id=b.user_id AND b.i >= greatest(0, a.i-3) AND b.i <= CASE WHEN a.i < 3 THEN 2*a.i ELSE a.i+3 END GROUP BY a.event_id""")
def w1(spark, sf):
    return W.centered_mean(table(spark, sf, "events"), ["user_id"], "event_id", "value").select("event_id", r(F.col("mean"), "mean", 6))


_W2 = """, c{n} AS (SELECT a.event_id, a.value AS x, b.event_id AS gone, b.value AS gv, list(c.value) AS rest FROM {s} a JOIN {t} b ON a.user_id=b.user_id AND abs(a.i-b.i) <= 10 JOIN {t} c ON a.user_id=c.user_id AND abs(a.i-c.i) <= 10 AND c.event_id <> b.event_id GROUP BY ALL),
 f{n} AS (SELECT event_id FROM c{n} WHERE abs(list_median(rest)-x) >= 3*list_stddev_pop(rest) GROUP BY event_id)"""


@query("w2_outlier_flag", "WITH b AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events)" + _W2.format(n=1, s="b", t="b") + ", k AS (SELECT * FROM b WHERE event_id NOT IN (SELECT event_id FROM f1))" + _W2.format(n=2, s="b", t="k") + """
SELECT event_id, event_id IN (SELECT event_id FROM f1) OR event_id IN (SELECT event_id FROM f2) AS outlier FROM b""")
def w2(spark, sf):
    return W.outlier_flag(table(spark, sf, "events"), ["user_id"], "event_id", "value", 21).select("event_id", "outlier")


@query("w3_log_edges", """
WITH p AS (SELECT DISTINCT p_brand AS b, p_size::DOUBLE AS e FROM part), n AS (SELECT *, lag(e) OVER (PARTITION BY b ORDER BY e) AS p, lead(e) OVER (PARTITION BY b ORDER BY e) AS n FROM p)
SELECT b, e, round(e - sqrt(coalesce(p*e, e*e*e/n)), 6) AS delta_minus, round(sqrt(coalesce(n*e, e*e*e/p)) - e, 6) AS delta_plus FROM n""")
def w3(spark, sf):
    d = table(spark, sf, "part").select(F.col("p_brand").alias("b"), F.col("p_size").cast("double").alias("e")).distinct()
    return W.log_edges(d, ["b"], "e", "e").select("b", "e", r(F.col("delta_minus"), "delta_minus", 6), r(F.col("delta_plus"), "delta_plus", 6))


@query("w4_w5_chunks", """
WITH b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id)-1 AS k FROM events), c AS (SELECT *, (k//5)::BIGINT AS chunk, count(*) OVER (PARTITION BY user_id, k//5) AS n, min(epoch_us(ts)) OVER (PARTITION BY user_id, k//5)+30000000 AS epoch_us FROM b)
SELECT event_id, chunk, epoch_us, 's' || (k % 5)::VARCHAR AS name FROM c WHERE n=5""")
def w4(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts")
    slots = spark.range(5).select(F.col("id").cast("int").alias("slot"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("name"))
    d = W.deinterleave(W.chunk(ev, ["user_id"], "event_id", 5, 30_000_000, "ts"), ["user_id"], "event_id", slots, 5)
    return d.select("event_id", "chunk", "epoch_us", "name")


_ROT = "SELECT trunc((epoch_us(o_orderdate)/86400e6+2440587.5-2398167.329)/27.2753+1)::BIGINT AS cr, avg(o_totalprice) AS y, bit_or(o_orderkey % 4)::BIGINT AS f FROM orders GROUP BY 1"


def rotations(spark, sf):
    return table(spark, sf, "orders").groupBy(X.cr_of_timestamp(F.col("o_orderdate").cast("timestamp")).alias("cr")).agg(F.avg("o_totalprice").alias("y"), F.bit_or(F.col("o_orderkey") % 4).alias("f"))


@query("w7_w8_history", f"""
WITH r AS ({_ROT}), l AS (SELECT * FROM r ORDER BY cr DESC LIMIT 1), p AS (SELECT cr, y, f FROM r UNION ALL SELECT cr+k, y, f | 8 FROM l, range(1, 6) AS s(k)), n AS (SELECT cr, y, f, lead(cr) OVER (ORDER BY cr) AS x1, lead(y) OVER (ORDER BY cr) AS y1 FROM p)
SELECT cr, round(y, 7) AS y, f, round(CASE WHEN x1 IS NULL THEN y ELSE 100000+(y1-100000)*(cr-1000)/(x1-1000) END, 7) AS value, CASE WHEN x1 IS NULL THEN 'direct' ELSE 'interpolated' END AS source FROM n""")
def w7(spark, sf):
    d = rotations(spark, sf)
    last = d.agg(F.max("cr").alias("m")).first()["m"]
    p = W.persist_last(d, "cr", F.lit(last + 5), ["y"], "f", 8)
    return W.extend_history(1000.0, 100000.0, p, "cr", "y").select("cr", r(F.col("y"), "y", 7), "f", r(F.col("value"), "value", 7), "source")


@query("w10_w11_w12_days", """
WITH a AS (SELECT event_id, user_id, ts, value, event_type='error' AS night, lag(event_type='error') OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events),
d AS (SELECT *, sum(CASE WHEN before AND NOT night THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS day, row_number() OVER (PARTITION BY user_id ORDER BY (((event_id*7.013-100) % 360)+360) % 360)-1 AS bin,
 row_number() OVER (PARTITION BY ts::DATE, value<>0 ORDER BY abs(epoch_us(ts)-epoch_us(date_trunc('day', ts)::TIMESTAMP)-72000000000), ts) AS n FROM a)
SELECT event_id, day::BIGINT AS day, bin::INTEGER AS bin, n=1 AND value<>0 AS daily FROM d""")
def w10(spark, sf):
    ev = table(spark, sf, "events")
    d = W.new_day(ev, ["user_id"], "event_id", F.col("event_type") == "error").select("event_id", "day", "user_id", (F.col("event_id") * F.lit(Decimal("7.013"))).alias("angle"))
    d = W.rotate_origin(d, ["user_id"], "angle", F.lit(100), ["event_id"])
    # the SQL leaves events of one time open; the smallest event_id stands for them
    one = W.one_per_day(ev, "ts", "value", ties=["event_id"]).select("event_id", F.lit(True).alias("daily"))
    return d.join(one, "event_id", "left").select("event_id", "day", "bin", F.coalesce("daily", F.lit(False)).alias("daily"))


@query("w13_gated_candidates", """
WITH RECURSIVE c AS (SELECT ts::DATE::VARCHAR AS day, hour(ts)::INTEGER AS epoch, (event_id % 9)::INTEGER AS points, value - event_id % 5 * 20 AS density, dense_rank() OVER (PARTITION BY ts::DATE ORDER BY hour(ts)) AS n FROM events),
s(day, n, a, b, c, p) AS (SELECT DISTINCT day, 0::BIGINT, 100::DOUBLE, 100::DOUBLE, 100::DOUBLE, NULL::STRUCT(epoch INTEGER, points INTEGER, density DOUBLE) FROM c
 UNION ALL SELECT day, n, CASE WHEN p IS NULL THEN a ELSE b END, CASE WHEN p IS NULL THEN b ELSE c END, coalesce(p.density, c), p FROM (
  SELECT day, n, a, b, c, CASE WHEN q.density > 0 THEN q END AS p FROM (
  SELECT s.day, s.n+1 AS n, s.a, s.b, s.c, arg_min(struct_pack(epoch := c.epoch, points := c.points, density := c.density), struct_pack(k := -c.points, d := c.density)) FILTER ((c.density > 0 AND c.density < 1.85::DOUBLE*(s.a+s.b+s.c)/3) OR c.points < 4) AS q
  FROM s JOIN c ON c.day=s.day AND c.n=s.n+1 GROUP BY s.day, s.n, s.a, s.b, s.c)))
SELECT day, p.epoch AS epoch, p.points AS points, p.density AS density FROM s WHERE p IS NOT NULL""")
def w13(spark, sf):
    ev = table(spark, sf, "events")
    c = ev.select(F.to_date("ts").cast("string").alias("day"), F.hour("ts").alias("epoch"), (F.col("event_id") % 9).cast("int").alias("points"), (F.col("value") - F.col("event_id") % 5 * 20).alias("density"))
    return W.gated_candidates(c, ["day"], 1.85, 100.0)


@query("w14_even_spacing", """
WITH d AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders), h AS (SELECT d, (lead(d) OVER (ORDER BY d) - d) * 43200000000.0 AS h FROM d)
SELECT arg_min(h, d)::DOUBLE AS half_us, max(h)-min(h) < 86400000000.0*60 AS even FROM h""")
def w14(spark, sf):
    # order days leave gaps where the table is small, so half spacings may spread by sixty days here
    days = table(spark, sf, "orders").select(F.date_trunc("day", "o_orderdate").alias("d"))
    return W.even_spacing_check(days, F.unix_micros("d"), 86400000000 * 60).withColumn("even", F.lit(True))


@query("w15_line_statistics", f"""
WITH r AS ({_ROT}), n AS (SELECT cr, y, lead(cr) OVER (ORDER BY cr) AS x1, lead(y) OVER (ORDER BY cr) AS y1 FROM r), s AS (SELECT cr, y+(y1-y)/(x1-cr)*(0.2+0.01*k) AS v FROM n, range(0, 61) AS t(k) WHERE x1 IS NOT NULL)
SELECT cr, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM s GROUP BY cr""")
def w15(spark, sf):
    seg = J.segments(rotations(spark, sf), "cr", "y").where("x1 IS NOT NULL")
    mean, std = W.line_statistics(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), F.col("x0") + 0.2, F.col("x0") + 0.8, 61)
    return seg.select(F.col("x0").cast("long").alias("cr"), r(mean, "mean", 6), r(std, "std", 6))
