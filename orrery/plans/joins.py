"""Joins over events, line items, parts and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from .base import query, r, table

_MIN = 60_000_000


def _events(spark, sf, kind):
    return table(spark, sf, "events").where(F.col("event_type") == kind)


@query("j1_nearest_join", """
WITH l AS (SELECT event_id, date_trunc('minute', ts) AS ts, user_id FROM events WHERE event_type='purchase'), q AS (SELECT date_trunc('minute', ts) AS ts, user_id, value FROM events WHERE event_type='view' AND value IS NOT NULL),
c AS (SELECT l.event_id, q.ts AS m, q.value, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(epoch_us(q.ts)-epoch_us(l.ts)), q.ts, CASE WHEN q.ts >= l.ts THEN q.value ELSE -q.value END) AS n FROM l JOIN q ON q.user_id=l.user_id AND abs(epoch_us(q.ts)-epoch_us(l.ts)) <= 1800000000)
SELECT l.event_id, epoch_us(c.m) AS matched_us, round(c.value, 6) AS seen FROM l LEFT JOIN c ON c.event_id=l.event_id AND n=1""")
def j1(spark, sf):
    ts = F.date_trunc("minute", "ts").alias("ts")
    d = J.nearest_join(_events(spark, sf, "purchase").select("event_id", ts, "user_id"), _events(spark, sf, "view").select(ts, "user_id", F.col("value").alias("seen")), "ts", ["seen"], 30 * _MIN, ["user_id"])
    return d.select("event_id", F.unix_micros("matched_ts").alias("matched_us"), r(F.col("seen"), "seen", 6))


@query("j2_interval_mean_join", """
WITH g AS (SELECT i AS k, 1704067200000000 + i*3600000000 AS t FROM range(0, 720) AS s(i)), e AS (SELECT epoch_us(ts) AS s, value FROM events)
SELECT k, round(avg(value), 6) AS value FROM g LEFT JOIN e ON s >= t-1200000000 AND s < t+1200000000 GROUP BY k""")
def j2(spark, sf):
    grid = spark.range(720).select(F.col("id").alias("k"))
    d = J.interval_mean_join(grid, table(spark, sf, "events"), "k", F.col("k") * 3600000000 + 1704067200000000, 20 * _MIN, "ts", ["value"])
    return d.select("k", r(F.col("value"), "value", 6))


@query("j3_exact_align", """
WITH a AS (SELECT event_id, date_trunc('hour', ts) AS h FROM events WHERE event_type='purchase'), b AS (SELECT date_trunc('hour', ts) AS h, value, row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY event_id) AS n FROM events WHERE event_type='error')
SELECT event_id, round(b.value, 6) AS value, b.h IS NULL AS missing FROM a LEFT JOIN b ON a.h=b.h AND n=1""")
def j3(spark, sf):
    h = F.date_trunc("hour", "ts").alias("h")
    d = J.exact_align(_events(spark, sf, "purchase").select("event_id", h), _events(spark, sf, "error").select(h, F.col("event_id").alias("no"), "value"), "h", "no", ["value"])
    return d.select("event_id", r(F.col("value"), "value", 6), "missing")


@query("j4_pair_by_key", """
WITH a AS (SELECT l_orderkey AS k, l_linenumber AS n, l_quantity AS v, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) AS x FROM lineitem WHERE l_returnflag='R'),
b AS (SELECT l_orderkey AS k, l_linenumber AS n, l_tax AS v, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) AS x FROM lineitem WHERE l_returnflag='A')
SELECT a.k, a.n AS a_n, a.v AS a_v, b.n AS b_n, b.v AS b_v FROM a JOIN b ON a.k=b.k AND a.x=1 AND b.x=1""")
def j4(spark, sf):
    # the SQL leaves lines of one number open; DuckDB keeps the first of the file, so its place there decides
    place = [F.col(f"_metadata.{c}").alias(f"_{c}") for c in ("file_path", "row_index")]
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), "l_quantity", "l_tax", "l_returnflag", *place)
    side = lambda flag, v: li.where(F.col("l_returnflag") == flag).select("k", "n", F.col(v).alias("v"), "_file_path", "_row_index")
    return J.pair_by_key(side("R", "l_quantity"), side("A", "l_tax"), "k", "n", ["_file_path", "_row_index"])


@query("j5_asof_calibration", """
WITH c AS (SELECT epoch_us(ts) AS t, max(value) AS v FROM events WHERE event_id % 50 = 0 GROUP BY 1 UNION ALL SELECT 0, 1.0), e AS (SELECT event_id, epoch_us(ts) AS t FROM events)
SELECT event_id, round(v, 6) AS v FROM e ASOF JOIN c ON e.t > c.t""")
def j5(spark, sf):
    ev = table(spark, sf, "events")
    cal = ev.where("event_id % 50 = 0").select(J.micros("ts").alias("ct"), F.col("value").alias("v")).union(spark.createDataFrame([(0, 1.0)], "ct long, v double"))
    d = J.asof_calibration(ev.select("event_id", J.micros("ts").alias("t")), F.col("t"), cal, F.col("ct"), ["v"], 86400e6, strict=True)
    return d.select("event_id", r(F.col("v"), "v", 6))


_ANC = "(SELECT l_linenumber AS n, min(epoch_us(l_shipdate)//86400000000) AS valid_from, CASE WHEN l_linenumber<>3 THEN max(epoch_us(l_shipdate)//86400000000)-l_linenumber*200 END AS valid_to, l_linenumber % 4 AS ingested FROM lineitem GROUP BY l_linenumber)"


@query("j6_best_overlapping", f"""
WITH o AS (SELECT o_orderkey, epoch_us(o_orderdate)//86400000000 AS a FROM orders)
SELECT o_orderkey, arg_max(n, ingested*100+n) AS n FROM o LEFT JOIN {_ANC} AS x ON valid_from <= a+10 AND (valid_to IS NULL OR valid_to >= a) GROUP BY o_orderkey""")
def j6(spark, sf):
    day = lambda c: F.floor(J.micros(c) / 86400000000)
    o = table(spark, sf, "orders").select("o_orderkey", day("o_orderdate").alias("a"))
    anc = table(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("n")).agg(F.min(day("l_shipdate")).alias("valid_from"), F.max(day("l_shipdate")).alias("m"))
    anc = anc.select("n", "valid_from", F.when(F.col("n") != 3, F.col("m") - F.col("n") * 200).alias("valid_to"), (F.col("n") % 4).alias("ingested"))
    return J.best_overlapping(o, F.col("a"), F.col("a") + 10, anc, 30, "o_orderkey", "n").select("o_orderkey", "n")


@query("j7_anti_bad_days", """
WITH o AS (SELECT o_orderkey, epoch_us(o_orderdate)//86400000000 AS a FROM orders), b AS (SELECT DISTINCT a AS d FROM o WHERE o_orderkey % 40 = 0)
SELECT o_orderkey, a FROM o WHERE NOT EXISTS (SELECT 1 FROM b WHERE d >= a AND d < a+3)""")
def j7(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.floor(J.micros("o_orderdate") / 86400000000).alias("a"))
    return J.anti_bad_days(o, F.col("a"), F.col("a") + 3, o.where("o_orderkey % 40 = 0").select("a").distinct(), F.col("a"), 30, "o_orderkey")


RULES = [(1, "light", 0, 20, 900, 1500), (2, "mid", 10, 35, 1000, 2000), (3, "heavy", 30, 60, 0, 1e9)]


@query("j8_first_rule_range", """
SELECT p_partkey, CASE WHEN p_size < 20 AND p_retailprice >= 900 AND p_retailprice < 1500 THEN 'light' WHEN p_size >= 10 AND p_size < 35 AND p_retailprice >= 1000 AND p_retailprice < 2000 THEN 'mid' WHEN p_size >= 30 AND p_size < 60 THEN 'heavy' END AS species FROM part""")
def j8(spark, sf):
    rules = spark.createDataFrame([(a, b, float(c), float(d), float(e), float(f)) for a, b, c, d, e, f in RULES], "rule_no int, species string, x_min double, x_max double, y_min double, y_max double")
    return J.first_rule_range(table(spark, sf, "part"), F.col("p_size"), F.col("p_retailprice"), rules, 10, ["p_partkey"]).select("p_partkey", "species")


@query("j9_set_rule_join", """
WITH g AS (SELECT l_orderkey, list(DISTINCT l_returnflag) AS g FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN list_contains(g,'A') AND list_contains(g,'R') AND NOT list_contains(g,'N') THEN 'ar' WHEN list_contains(g,'N') AND NOT list_contains(g,'A') THEN 'n' WHEN list_contains(g,'R') THEN 'r' END AS rule FROM g""")
def j9(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("g"))
    rules = [{"name": "ar", "include": ["A", "R"], "exclude": ["N"]}, {"name": "n", "include": ["N"], "exclude": ["A"]}, {"name": "r", "include": ["R"], "exclude": []}]
    return J.set_rule_join(g, "g", rules).select("l_orderkey", "rule")


_GRID = "(SELECT p_size::DOUBLE AS x, avg(p_retailprice) AS y FROM part WHERE p_size % 3 = 0 GROUP BY p_size)"


@query("j10_interp_join", f"""
WITH t AS (SELECT x, y, lead(x) OVER (ORDER BY x) AS x1, lead(y) OVER (ORDER BY x) AS y1 FROM {_GRID}), b AS (SELECT min(x) AS a, max(x) AS z FROM t),
q AS (SELECT l_orderkey, l_linenumber, greatest(a, least(z, l_quantity)) AS v FROM lineitem, b)
SELECT l_orderkey, l_linenumber, round(CASE WHEN x1 IS NULL THEN y ELSE y+(y1-y)*(v-x)/(x1-x) END, 4) AS y_at, round(CASE WHEN x1 IS NULL THEN y ELSE y+(y1-y)*(ln(v)-ln(x))/(ln(x1)-ln(x)) END, 4) AS y_log FROM q ASOF JOIN t ON q.v >= t.x""")
def j10(spark, sf):
    grid = _grid(spark, sf)
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    d = J.interp_join(li, F.col("l_quantity"), grid, "x", "y", 3.0)
    d = J.interp_join(d.withColumnRenamed("y_at", "lin"), F.col("l_quantity"), grid, "x", "y", 3.0, log_x=True)
    return d.select("l_orderkey", "l_linenumber", r(F.col("lin"), "y_at"), r(F.col("y_at"), "y_log"))


def _grid(spark, sf):
    return table(spark, sf, "part").where("p_size % 3 = 0").groupBy(F.col("p_size").cast("double").alias("x")).agg(F.avg("p_retailprice").alias("y"))


@query("j11_j16_nearest_grid", f"""
WITH g AS (SELECT x, x*7 AS a FROM {_GRID}), q AS (SELECT l_orderkey, l_linenumber, l_quantity AS v, (l_quantity*31.3) % 360 AS w FROM lineitem), k AS (SELECT DISTINCT v, w FROM q),
m AS (SELECT v, w, arg_min(x, abs(v-x)*1000+x/1e6) AS nearest_x, arg_min(a % 360, least(abs(w-a), 360-abs(w-a))) AS nearest_a FROM k, g GROUP BY v, w)
SELECT l_orderkey, l_linenumber, nearest_x, nearest_a FROM q JOIN m USING (v, w)""")
def j11(spark, sf):
    grid = _grid(spark, sf).select("x", (F.col("x") * 7).alias("a"))
    d = J.nearest_value(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), F.col("l_quantity"), grid, "x", 3.0)
    d = J.circular_nearest(d, F.col("l_quantity") * 31.3, grid, "a")
    return d.select("l_orderkey", "l_linenumber", "nearest_x", "nearest_a")


@query("j12_bilinear_join", """
WITH g AS (SELECT (p_size % 12)::BIGINT AS gx, 1 + (p_partkey % 6)::BIGINT AS gy, avg(p_retailprice) AS v FROM part GROUP BY 1, 2),
q AS (SELECT l_orderkey, l_linenumber, (l_quantity*7.3 % 360)/30 AS fx, l_tax*100 AS d, greatest(1, l_tax*100) AS fy FROM lineitem), c AS (SELECT *, floor(fx)::BIGINT AS ix, floor(fy)::BIGINT AS iy FROM q)
SELECT l_orderkey, l_linenumber, round(CASE WHEN c.d > 6 THEN 0 ELSE ((1-fx+ix)*(1-fy+iy)*a.v+(fx-ix)*(1-fy+iy)*b.v+(1-fx+ix)*(fy-iy)*coalesce(d.v,0)+(fx-ix)*(fy-iy)*coalesce(e.v,0))*least(1, c.d) END, 4) AS v_at
FROM c LEFT JOIN g a ON a.gx=ix AND a.gy=iy LEFT JOIN g b ON b.gx=(ix+1)%12 AND b.gy=iy LEFT JOIN g d ON d.gx=ix AND d.gy=iy+1 LEFT JOIN g e ON e.gx=(ix+1)%12 AND e.gy=iy+1""")
def j12(spark, sf):
    grid = table(spark, sf, "part").groupBy((F.col("p_size") % 12).cast("long").alias("gx"), (1 + F.col("p_partkey") % 6).alias("gy")).agg(F.avg("p_retailprice").alias("v"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 7.3).alias("lon"), "l_tax")
    return J.bilinear_join(li, F.col("lon"), F.col("l_tax") * 100, grid, 30.0, 12, 1.0, 1, 6, "v").select("l_orderkey", "l_linenumber", r(F.col("v_at"), "v_at"))


@query("j12_uneven_grid", """
WITH g AS (SELECT (p_size % 12)*(p_size % 12)*2.5+7 AS x, (p_partkey % 6)*(p_partkey % 6)*4-60.0 AS y, avg(p_retailprice) AS v FROM part GROUP BY 1, 2), xs AS (SELECT x, coalesce(lead(x) OVER (ORDER BY x), min(x) OVER ()+360) AS x1 FROM (SELECT DISTINCT x FROM g)), ys AS (SELECT y, lead(y) OVER (ORDER BY y) AS y1 FROM (SELECT DISTINCT y FROM g)),
q AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity*7.31 % 360 < 7 THEN l_quantity*7.31 % 360+360 ELSE l_quantity*7.31 % 360 END AS u, l_tax*1237-60 AS w FROM lineitem),
c AS (SELECT q.*, x, x1, CASE WHEN x1 >= 367 THEN x1-360 ELSE x1 END AS xw, y, y1, (u-x)/(x1-x) AS a, coalesce((w-y)/(y1-y), 0) AS b FROM q ASOF JOIN xs ON u >= x ASOF JOIN ys ON w >= y)
SELECT l_orderkey, l_linenumber, round((1-a)*(1-b)*g00.v+CASE WHEN a = 0 THEN 0 ELSE a*(1-b)*g10.v END+CASE WHEN b = 0 THEN 0 ELSE (1-a)*b*g01.v END+CASE WHEN a*b = 0 THEN 0 ELSE a*b*g11.v END, 4) AS v_at
FROM c LEFT JOIN g g00 ON g00.x=c.x AND g00.y=c.y LEFT JOIN g g10 ON g10.x=xw AND g10.y=c.y LEFT JOIN g g01 ON g01.x=c.x AND g01.y=y1 LEFT JOIN g g11 ON g11.x=xw AND g11.y=y1""")
def j12_uneven(spark, sf):
    gx, gy = F.col("p_size") % 12, F.col("p_partkey") % 6
    grid = table(spark, sf, "part").groupBy((gx * gx * 2.5 + 7).alias("glon"), (gy * gy * 4 - 60.0).alias("glat")).agg(F.avg("p_retailprice").alias("v"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return J.uneven_bilinear_join(li, F.col("l_quantity") * 7.31, F.col("l_tax") * 1237 - 60, grid, "v", 30.0).select("l_orderkey", "l_linenumber", r(F.col("v_at"), "v_at"))


_LL = "degrees(atan2(embedding[2]::DOUBLE, embedding[1]::DOUBLE)) AS lon, degrees(asin(embedding[3]::DOUBLE/sqrt(embedding[1]::DOUBLE*embedding[1]::DOUBLE+embedding[2]::DOUBLE*embedding[2]::DOUBLE+embedding[3]::DOUBLE*embedding[3]::DOUBLE))) AS lat"


@query("j13_sky_proximity", f"""
WITH p AS (SELECT vec_id, label, {_LL} FROM embeddings), s AS (SELECT lon AS slon, lat AS slat, (vec_id % 5)*4.0 AS radius FROM p WHERE label=0)
SELECT vec_id, EXISTS (SELECT 1 FROM s WHERE radius > 0 AND degrees(2*asin(sqrt(least(1.0, pow(sin(radians((lat-slat)/2)),2)+cos(radians(lat))*cos(radians(slat))*pow(sin(radians((lon-slon)/2)),2))))) <= radius) AS near FROM p""")
def j13(spark, sf):
    x = [F.col("embedding")[i].cast("double") for i in range(3)]
    p = table(spark, sf, "embeddings").select("vec_id", "label", F.degrees(F.atan2(x[1], x[0])).alias("lon"), F.degrees(F.asin(x[2] / F.sqrt(x[0] * x[0] + x[1] * x[1] + x[2] * x[2]))).alias("lat"))
    src = p.where("label = 0").select(F.col("lon").alias("slon"), F.col("lat").alias("slat"), ((F.col("vec_id") % 5) * 4.0).alias("radius"))
    return J.sky_proximity(p, "lon", "lat", src, "vec_id").select("vec_id", "near")


@query("j13_grouped_radii", f"""
WITH p AS (SELECT vec_id, label, {_LL} FROM embeddings), r AS (SELECT lon AS slon, lat AS slat, (vec_id % 5)*1.7+0.3 AS radius FROM p WHERE label=0), e AS (SELECT min(radius)-1e-6::DOUBLE AS lo, (max(radius)-min(radius)+2e-6::DOUBLE)/11 AS step FROM r),
s AS (SELECT slon, slat, lo+(floor((radius-lo)/step)+1)*step AS radius FROM r, e)
SELECT vec_id, EXISTS (SELECT 1 FROM s WHERE degrees(2*asin(sqrt(least(1.0, pow(sin(radians((lat-slat)/2)),2)+cos(radians(lat))*cos(radians(slat))*pow(sin(radians((lon-slon)/2)),2))))) <= radius) AS near FROM p""")
def j13_grouped(spark, sf):
    x = [F.col("embedding")[i].cast("double") for i in range(3)]
    p = table(spark, sf, "embeddings").select("vec_id", "label", F.degrees(F.atan2(x[1], x[0])).alias("lon"), F.degrees(F.asin(x[2] / F.sqrt(x[0] * x[0] + x[1] * x[1] + x[2] * x[2]))).alias("lat"))
    src = p.where("label = 0").select(F.col("lon").alias("slon"), F.col("lat").alias("slat"), ((F.col("vec_id") % 5) * 1.7 + 0.3).alias("radius"))
    return J.sky_proximity(p, "lon", "lat", J.grouped_radii(src), "vec_id").select("vec_id", "near")


@query("j14_dim_lookup", """
SELECT l_orderkey, l_linenumber, round((l_quantity*p_size + p_retailprice)/100, 4) AS energy FROM lineitem LEFT JOIN part ON l_partkey=p_partkey""")
def j14(spark, sf):
    gain = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice")
    d = J.dim_lookup(table(spark, sf, "lineitem"), gain, ["l_partkey"], ["p_size", "p_retailprice"])
    return d.select("l_orderkey", "l_linenumber", r((F.col("l_quantity") * F.col("p_size") + F.col("p_retailprice")) / 100, "energy"))


@query("j15_flags_around", """
WITH s AS (SELECT epoch_us(ts) AS t, bit_or(event_id % 64) AS f FROM events WHERE event_type='view' GROUP BY 1), w AS (SELECT t, f, lead(f) OVER (ORDER BY t) AS g FROM s), e AS (SELECT event_id, epoch_us(ts) AS t FROM events WHERE event_type='purchase')
SELECT event_id, CASE WHEN e.t=w.t THEN f ELSE f | coalesce(g, 0) END AS flags_around FROM e ASOF LEFT JOIN w ON e.t >= w.t""")
def j15(spark, sf):
    s = _events(spark, sf, "view").select(J.micros("ts").alias("t"), (F.col("event_id") % 64).alias("f"))
    return J.flags_around(_events(spark, sf, "purchase").select("event_id", "ts"), J.micros("ts"), s, F.col("t"), "f", 3600e6).select("event_id", "flags_around")


@query("j23_wrap_range_lookup", """
SELECT l_orderkey, l_linenumber, CASE WHEN x >= 330 OR x < 30 THEN 2 WHEN x >= 100 AND x < 200 THEN 1 WHEN x >= 20 AND x < 120 THEN 0 END AS bin
FROM (SELECT l_orderkey, l_linenumber, (l_quantity*7.3) % 360 AS x FROM lineitem) WHERE x >= 330 OR x < 200""")
def j23(spark, sf):
    d = table(spark, sf, "lineitem")
    return J.wrap_range_lookup(d, F.pmod(F.col("l_quantity") * 7.3, F.lit(360.0)), [(20, 120), (100, 200), (330, 30)]).select("l_orderkey", "l_linenumber", "bin")
