"""Filters, descriptors and catalogue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import descriptors as D
from ..operators import catalog as C
from ..operators import filters as P
from .base import query, r, table


def _li(spark, sf):
    return table(spark, sf, "lineitem")


_DESC = "concat('h90-', CASE WHEN o_orderkey % 3 = 0 THEN 'spx' || lpad((o_custkey % 10)::VARCHAR, 2, '0') || '14' ELSE 'ena' END, CASE WHEN o_orderkey % 5 = 0 THEN 'Raw' ELSE '' END, '-', CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE 'h' END, '-hf-nsp-full-hae-', CASE WHEN o_orderkey % 2 = 0 THEN '4deg' ELSE 'nside8' END, '-', CASE o_orderkey % 4 WHEN 0 THEN '1mo' WHEN 1 THEN '3mo' WHEN 2 THEN '6mo' ELSE '1yr' END)"


@query("p1_p2_p3_descriptors", f"""
WITH d AS (SELECT o_orderkey, {_DESC} AS d FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN d END AS again, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 3 = 0 THEN regexp_extract(d, 'spx(..)', 1)::INTEGER END AS range_lo,
 CASE WHEN o_orderkey % 7 <> 0 THEN CASE WHEN o_orderkey % 5 = 0 THEN 'Raw' ELSE '' END END AS suffix,
 CASE WHEN o_orderkey % 7 <> 0 THEN round(CASE o_orderkey % 4 WHEN 0 THEN 365.25/12 WHEN 1 THEN 365.25/4 WHEN 2 THEN 365.25/2 ELSE 365.25 END, 4) END AS days FROM d""")
def p1(spark, sf):
    k = F.col("o_orderkey")
    quantity = F.when(k % 3 == 0, F.concat(F.lit("spx"), F.lpad((F.col("o_custkey") % 10).cast("string"), 2, "0"), F.lit("14"))).otherwise("ena")
    duration = F.when(k % 4 == 0, "1mo").when(k % 4 == 1, "3mo").when(k % 4 == 2, "6mo").otherwise("1yr")
    text = F.concat(F.lit("h90-"), quantity, F.when(k % 5 == 0, "Raw").otherwise(""), F.lit("-"), F.when(k % 7 == 0, "x").otherwise("h"), F.lit("-hf-nsp-full-hae-"), F.when(k % 2 == 0, "4deg").otherwise("nside8"), F.lit("-"), duration)
    d = table(spark, sf, "orders").select("o_orderkey", D.parse_descriptor(text).alias("p"))
    return d.select("o_orderkey", F.when(F.col("p").isNotNull(), D.format_descriptor(F.col("p"))).alias("again"), F.col("p.range_lo").alias("range_lo"), F.col("p.suffix").alias("suffix"), r(D.descriptor_duration(F.col("p")), "days"))


@query("p4_p7_p8_p9_slices", """
SELECT 'p4' AS op, count(*) AS n, round(sum(l_quantity), 2) AS q FROM lineitem WHERE l_quantity >= 10 AND l_quantity < 20
UNION ALL SELECT 'p5', count(*), round(sum(l_quantity), 2) FROM lineitem WHERE l_quantity IN (SELECT l_quantity FROM (SELECT DISTINCT l_quantity FROM lineitem) ORDER BY 1 LIMIT 5 OFFSET 2)
UNION ALL SELECT 'p7', count(*), round(sum(l_quantity), 2) FROM lineitem WHERE l_quantity*1.5 BETWEEN 63 AND 71
UNION ALL SELECT 'p8', count(*), round(sum(l_quantity), 2) FROM lineitem WHERE l_tax < 0.05
UNION ALL SELECT 'p9', count(*), round(sum(l_quantity), 2) FROM lineitem WHERE l_quantity BETWEEN 10 AND 20
UNION ALL SELECT 'p12', count(*), round(sum(l_quantity), 2) FROM lineitem WHERE l_discount <> 0
UNION ALL SELECT 'p13', count(*), round(sum(l_quantity), 2) FROM lineitem WHERE l_quantity BETWEEN 1 AND 24""")
def p4(spark, sf):
    li = _li(spark, sf)
    parts = {
        "p4": P.slice_energy(li, 10, 20, "l_quantity"), "p5": P.slice_energy_bins(li, 3, 7, "l_quantity"), "p7": P.select_bins(li.withColumn("bin", F.col("l_quantity") * 1.5), "fine").drop("bin"),
        "p8": P.drop_gaps(li, "l_tax", 0.05), "p9": P.window_select(li, "l_quantity", 10, 20), "p12": P.drop_unexposed(li.withColumn("exposure", F.col("l_discount"))).drop("exposure"),
        "p13": P.valid_event(li, "l_linenumber", "l_suppkey", "l_quantity"),
    }
    out = None
    for name, d in parts.items():
        one = d.agg(F.lit(name).alias("op"), F.count("*").alias("n"), r(F.sum("l_quantity"), "q", 2))
        out = one if out is None else out.unionByName(one)
    return out


@query("p6_p16_pointings", """
WITH e AS (SELECT l_orderkey, l_linenumber % 3 AS bin, CASE WHEN l_discount > 0.05 THEN l_quantity ELSE 0 END AS exposure, l_tax FROM lineitem), a AS (SELECT l_orderkey FROM e GROUP BY 1 HAVING max(exposure) <> 0)
SELECT l_orderkey, bin, round(sum(exposure), 2) AS exposure, round(avg(l_tax), 6) AS direction FROM e WHERE l_orderkey IN (SELECT l_orderkey FROM a) GROUP BY 1, 2""")
def p6(spark, sf):
    e = _li(spark, sf).select("l_orderkey", (F.col("l_linenumber") % 3).alias("bin"), F.when(F.col("l_discount") > 0.05, F.col("l_quantity")).otherwise(0.0).alias("exposure"), "l_tax")
    d = P.collapse_axis(P.drop_dead_pointings(e, "l_orderkey"), ["l_orderkey", "bin"], ["l_tax"])
    return d.select("l_orderkey", "bin", r(F.col("exposure"), "exposure", 2), r(F.col("l_tax"), "direction", 6))


@query("p10_p11_good_time", """
SELECT event_id, (event_id & 6) = 0 AND coalesce(sum(CASE WHEN event_type='error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 3 AS good, (event_id & 5) <> 0 AS bad_angle FROM events""")
def p10(spark, sf):
    d = P.good_time(table(spark, sf, "events"), "event_id", 6, F.col("event_type") == "error", 3, ["user_id"], "event_id")
    return d.select("event_id", "good", P.bad_angle("event_id", [True, False, True, False]).alias("bad_angle"))


@query("p14_p15_fresh", """
SELECT max(ts::DATE) >= DATE '2024-01-20' + 5 AS fresh, (SELECT count(*) > 0 FROM events WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-06' AND value IS NOT NULL AND props IS NOT NULL) AS valid FROM events""")
def p14(spark, sf):
    ev = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    import datetime as dt

    ok = P.has_valid_row(ev, "day", dt.date(2024, 1, 5), dt.date(2024, 1, 6), ["value", "props"])
    return P.fresh_enough(ev, "day", F.lit(dt.date(2024, 1, 20)), 5).select("fresh", F.lit(ok).alias("valid"))


@query("p17_mask_negative_moments", """
WITH b AS (SELECT c_custkey, c_acctbal < 0 AS core, c_nationkey-3 < 0 AS halo FROM customer)
SELECT c.c_custkey, round(CASE WHEN NOT core THEN c_acctbal END, 2) AS core, round(CASE WHEN NOT halo THEN 7.5::DOUBLE END, 2) AS halo, round(CASE WHEN NOT (core OR halo) THEN c_acctbal*2 END, 2) AS total, CASE WHEN core OR halo THEN 9 ELSE 1 END AS flags FROM customer c JOIN b USING (c_custkey)""")
def p17(spark, sf):
    c = table(spark, sf, "customer")
    one = F.lit(1.0)
    cols = {}
    for p, first, speed in (("core", F.col("c_acctbal"), F.col("c_acctbal")), ("halo", F.col("c_nationkey") - 3, F.lit(7.5)), ("total", one, F.col("c_acctbal") * 2)):
        cols |= {f"{p}_density": first, f"{p}_txx": one, f"{p}_tyy": one, f"{p}_tzz": one, f"{p}_speed": speed}
    d = P.mask_negative_moments(c.withColumns(cols | {"flags": F.lit(1)}), ["core", "halo", "total"], 8)
    return d.select("c_custkey", r(F.col("core_speed"), "core", 2), r(F.col("halo_speed"), "halo", 2), r(F.col("total_speed"), "total", 2), "flags")


@query("p18_flag_unphysical", """
SELECT l_orderkey, l_linenumber, CASE WHEN max(l_quantity) OVER (PARTITION BY l_orderkey) > 45 THEN l_linenumber | 16 ELSE l_linenumber END AS flags FROM lineitem""")
def p18(spark, sf):
    d = P.flag_unphysical(_li(spark, sf).withColumn("flags", F.col("l_linenumber")), "l_orderkey", "l_quantity", 45, 16)
    return d.select("l_orderkey", "l_linenumber", "flags")


_CAT = "SELECT l_shipdate::DATE AS start_date, l_returnflag || l_linestatus AS descriptor, l_linenumber AS version, l_suppkey % 5 AS parent, l_quantity FROM lineitem"


def _catalog(spark, sf):
    return _li(spark, sf).select(F.to_date("l_shipdate").alias("start_date"), F.concat("l_returnflag", "l_linestatus").alias("descriptor"), F.col("l_linenumber").alias("version"), (F.col("l_suppkey") % 5).alias("parent"), "l_quantity")


@query("w6_latest_version", f"""
SELECT start_date::VARCHAR AS start_date, descriptor, version, parent, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY start_date, descriptor ORDER BY version DESC, parent DESC, l_quantity DESC) AS n FROM ({_CAT})) WHERE n=1""")
def w6(spark, sf):
    return C.latest_version(_catalog(spark, sf), ["start_date", "descriptor"], "version").select(F.col("start_date").cast("string").alias("start_date"), "descriptor", "version", "parent", "l_quantity")


@query("j17_j18_u2_inputs", f"""
WITH c AS ({_CAT}), a AS (SELECT start_date FROM c WHERE descriptor IN ('AF', 'RF') GROUP BY 1 HAVING count(DISTINCT descriptor)=2),
p AS (SELECT start_date, descriptor, list_sort(list(DISTINCT parent)) AS p FROM c GROUP BY 1, 2), s AS (SELECT start_date FROM p GROUP BY 1 HAVING count(DISTINCT p)=1)
SELECT start_date::VARCHAR AS start_date, 'all' AS what FROM a UNION ALL SELECT start_date::VARCHAR, 'same' FROM s UNION ALL SELECT start_date::VARCHAR, 'common' FROM a""")
def j17(spark, sf):
    c = _catalog(spark, sf)
    a = C.require_all_inputs(c, ["AF", "RF"]).withColumn("what", F.lit("all"))
    s = C.same_parent_set(c.withColumnRenamed("descriptor", "map_id"), "start_date").withColumn("what", F.lit("same"))
    every = a.union(s).union(C.intersect_keys(c, ["AF", "RF"], "start_date").withColumn("what", F.lit("common")))
    return every.select(F.col("start_date").cast("string").alias("start_date"), "what")


@query("j19_needs_processing", """
WITH c AS (SELECT l_orderkey AS k, list_sort(list(DISTINCT l_suppkey % 7)) AS i FROM lineitem GROUP BY 1), e AS (SELECT l_orderkey AS k, list(DISTINCT l_suppkey % 7) AS p, (l_orderkey % 3)::INTEGER AS major, max(l_linenumber) AS minor FROM lineitem WHERE l_linenumber < 4 GROUP BY 1)
SELECT k, i AS inputs_list, 2 AS major, CASE WHEN e.major=2 THEN minor+1 ELSE 1 END AS minor FROM (SELECT k, array_to_string(i, ',') AS i, i AS ii FROM c) LEFT JOIN e USING (k) WHERE NOT coalesce(list_has_all(p, ii) AND e.major=2, false)""")
def j19(spark, sf):
    li = _li(spark, sf).withColumns({"k": F.col("l_orderkey"), "s": F.col("l_suppkey") % 7})
    cand = li.groupBy("k").agg(F.sort_array(F.collect_set("s")).alias("inputs"))
    have = li.where("l_linenumber < 4").groupBy("k").agg(F.collect_set("s").alias("parents"), F.max("l_linenumber").alias("minor")).withColumn("major", (F.col("k") % 3).cast("int"))
    return C.needs_processing(cand, have, "k", 2).select("k", F.array_join(F.col("inputs").cast("array<string>"), ",").alias("inputs_list"), "major", "minor")


@query("j20_prefer_level", """
SELECT l_orderkey, l_linenumber, l_returnflag <> 'R' AS preliminary FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) AS n FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber)=1)) WHERE n=1""")
def j20(spark, sf):
    first = _li(spark, sf).groupBy("l_orderkey", F.col("l_returnflag").alias("level")).agg(F.min("l_linenumber").alias("l_linenumber"))
    return C.prefer_level(first, "l_orderkey", ["R", "N", "A"]).select("l_orderkey", "l_linenumber", "preliminary")


_REP = "SELECT o_custkey AS id, min(o_orderdate) AS start_utc, min(o_orderdate) + INTERVAL 1 HOUR AS end_utc FROM orders GROUP BY 1"


@query("j21_j22_pointings", f"""
WITH r AS ({_REP}), n AS (SELECT *, lead(start_utc) OVER (ORDER BY id) AS nx FROM r) SELECT id, end_utc AS start, nx AS stop, coalesce(nx > TIMESTAMP '1995-06-01' AND nx < TIMESTAMP '1996-06-01', false) AS inside FROM n""")
def j21(spark, sf):
    day = F.col("o_orderdate").cast("timestamp")
    rep = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.min(day).alias("start_utc")).withColumn("end_utc", F.col("start_utc") + F.expr("INTERVAL 1 HOUR"))
    inside = C.repoints_in_rotation(rep, F.lit("1995-06-01").cast("timestamp"), F.lit("1996-06-01").cast("timestamp")).select("id", F.lit(True).alias("inside"))
    return C.pointing_range(rep).join(inside, "id", "left").select("id", "start", F.col("end").alias("stop"), F.coalesce("inside", F.lit(False)).alias("inside"))


@query("j24_forced_targets", """
WITH r AS (SELECT o_custkey AS id, min(epoch_us(o_orderdate)//86400000000) AS d FROM orders GROUP BY 1), l AS (SELECT o_custkey AS id, o_orderkey, (epoch_us(o_orderdate)//86400000000)//27 AS cr FROM orders WHERE o_orderdate + INTERVAL 1500 DAY >= DATE '2001-01-01')
SELECT DISTINCT 'l3_map' AS product, id FROM l UNION SELECT 'l3_spectrum', r.id FROM r JOIN l ON r.d//27 = l.cr""")
def j24(spark, sf):
    o = table(spark, sf, "orders").withColumn("d", F.floor(F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 86400000000))
    rep = o.groupBy(F.col("o_custkey").alias("id")).agg(F.min("d").alias("day"))
    line = lambda name, body: F.concat(F.lit(name + " "), body)
    pointing, rotation = F.concat(F.lit("repoint"), F.col("o_custkey").cast("string")), F.concat(F.lit("cr"), F.floor(F.col("d") / 27).cast("string"))
    # each order asks for its customer's pointing, for a product that is not made, and for its day's rotation
    targets = F.explode(F.array(line("l3_map", pointing), line("l9_none", F.concat(pointing, F.lit("9, cr1"))), line("l3_spectrum", rotation)))
    lines = o.select(targets.alias("target"), F.date_add(F.to_date("o_orderdate"), 1500).alias("ignore_after"))
    return C.forced_targets(lines, F.lit("2001-01-01").cast("date"), rep, 27.0, ["l3_map", "l3_spectrum"])


@query("w9_first_changed", """
WITH n AS (SELECT o_custkey AS k, sum(o_totalprice) AS v FROM orders GROUP BY 1) SELECT min(k) AS first_k FROM n WHERE k % 17 = 16""")
def w9(spark, sf):
    new = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.sum("o_totalprice").alias("v"))
    return C.first_changed(new.withColumn("v", F.when(F.col("k") % 17 == 16, F.col("v") * 1.01).otherwise(F.col("v") * (1 + 1e-7))), new, "k", ["v"])


@query("u1_u3_u4_sets", """
WITH a AS (SELECT l_linenumber, l_orderkey FROM lineitem WHERE l_returnflag <> 'R'), b AS (SELECT l_linenumber, l_orderkey FROM lineitem WHERE l_returnflag='R')
SELECT 'u1' AS op, priority, count(*) AS n FROM (SELECT l_linenumber AS priority FROM a UNION ALL SELECT l_linenumber+7 FROM b) GROUP BY 2
UNION ALL SELECT 'u3', l_linenumber, count(*) FROM (SELECT l_linenumber FROM b UNION ALL SELECT l_linenumber FROM a WHERE l_orderkey NOT IN (SELECT l_orderkey FROM b)) GROUP BY 2
UNION ALL SELECT 'u4', 0, count(*) FROM (SELECT l_orderkey FROM b UNION SELECT l_orderkey FROM a)
UNION ALL SELECT 'minus', 0, count(*) FROM (SELECT l_orderkey FROM b EXCEPT ALL SELECT l_orderkey FROM a)""")
def u1(spark, sf):
    li = _li(spark, sf).select(F.col("l_linenumber").alias("priority"), "l_orderkey", "l_returnflag")
    a, b = li.where("l_returnflag <> 'R'"), li.where("l_returnflag = 'R'")
    count = lambda d, op: d.groupBy("priority").agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), "priority", "n")
    out = count(C.stack_priorities(a, b, ["l_orderkey"], 7), "u1").unionByName(count(C.override_by_key(a, b, ["l_orderkey"]), "u3"))
    ka, kb = a.select("l_orderkey"), b.select("l_orderkey")
    for op, d in (("u4", C.keys_union(kb, ka)), ("minus", C.missing_parents(kb, ka))):
        out = out.unionByName(d.agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), F.lit(0).alias("priority"), "n"))
    return out
