"""Map combination over line items: part = cell, return flag = map, price = intensity, quantity = exposure."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import maps as M
from .base import query, r, table


def cells(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("cell"), F.col("l_returnflag").alias("map_id"), F.when(F.col("l_tax") == 0, None).otherwise(F.col("l_extendedprice")).alias("intensity"), F.col("l_discount").alias("stat"),
        F.col("l_tax").alias("sys"), (F.col("l_quantity") - 1).alias("exposure"), F.col("l_linenumber").alias("flags"), F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("obs_us"),
        (F.col("l_quantity") / 50).alias("survival"), F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice") / 10).alias("bg"), (F.col("l_discount") * 2).alias("bg_stat"), (F.col("l_tax") * 3).alias("bg_sys"),
    )


_CELLS = """WITH m AS (SELECT l_partkey AS cell, l_returnflag AS map_id, CASE WHEN l_tax=0 THEN NULL ELSE l_extendedprice END AS intensity, l_discount AS stat, l_tax AS sys, l_quantity-1 AS exposure,
 l_linenumber AS flags, epoch_us(l_shipdate) AS obs_us, l_quantity/50 AS survival, CASE WHEN l_discount>0.02 THEN l_extendedprice/10 END AS bg, l_discount*2 AS bg_stat, l_tax*3 AS bg_sys FROM lineitem),
 k AS (SELECT *, intensity IS NOT NULL AND exposure > 0 AS ok, bg IS NOT NULL AND exposure > 0 AS okb FROM m) """


@query("a1_combine_unweighted", _CELLS + """
SELECT cell, round(avg(intensity) FILTER (ok), 7) AS intensity, round(sqrt(sum(stat*stat) FILTER (ok))/(count(*) FILTER (ok)), 6) AS stat,
 round(sqrt(sum(sys*sys) FILTER (ok))/(count(*) FILTER (ok)), 6) AS sys, round(sum(exposure) FILTER (ok), 2) AS exposure, bit_or(flags) AS flags FROM k GROUP BY cell""")
def a1(spark, sf):
    d = M.combine_unweighted(cells(spark, sf), ["cell"])
    return d.select("cell", r(F.col("intensity"), "intensity", 7), r(F.col("stat"), "stat", 6), r(F.col("sys"), "sys", 6), r(F.col("exposure"), "exposure", 2), "flags")


@query("a2_combine_exposure_weighted", _CELLS + """
SELECT cell, round(sum(intensity*exposure) FILTER (ok)/sum(exposure) FILTER (ok), 2) AS intensity, round(sqrt(sum((stat*exposure)*(stat*exposure)) FILTER (ok))/sum(exposure) FILTER (ok), 6) AS stat,
 round(sum(sys*exposure) FILTER (ok)/sum(exposure) FILTER (ok), 6) AS sys, round(sum(exposure) FILTER (okb), 2) AS exposure, bit_or(flags) AS flags,
 round(sum(bg*exposure) FILTER (okb)/sum(exposure) FILTER (okb), 2) AS bg, round(sqrt(sum((bg_stat*exposure)*(bg_stat*exposure)) FILTER (okb))/sum(exposure) FILTER (okb), 6) AS bg_stat,
 round(sum(obs_us::DOUBLE*exposure) FILTER (ok)/sum(exposure) FILTER (ok)/1e6, 0) AS obs_s FROM k GROUP BY cell""")
def a2(spark, sf):
    d = M.combine_exposure_weighted(cells(spark, sf), ["cell"])
    return d.select("cell", r(F.col("intensity"), "intensity", 2), r(F.col("stat"), "stat", 6), r(F.col("sys"), "sys", 6), r(F.col("exposure"), "exposure", 2), "flags", r(F.col("bg"), "bg", 2), r(F.col("bg_stat"), "bg_stat", 6), r(F.col("obs_us") / 1e6, "obs_s", 0))


@query("a3_combine_uncertainty_weighted", _CELLS + """
SELECT cell, round(sum(intensity/(stat*stat)) FILTER (ok AND stat<>0)/sum(1/(stat*stat)) FILTER (ok AND stat<>0), 2) AS intensity, round(sqrt(1/sum(1/(stat*stat)) FILTER (ok AND stat<>0)), 6) AS stat,
 round(sum(sys*exposure) FILTER (ok)/sum(exposure) FILTER (ok), 6) AS sys, round(sum(exposure) FILTER (ok), 2) AS exposure, bit_or(flags) AS flags FROM k GROUP BY cell""")
def a3(spark, sf):
    d = M.combine_uncertainty_weighted(cells(spark, sf), ["cell"])
    return d.select("cell", r(F.col("intensity"), "intensity", 2), r(F.col("stat"), "stat", 6), r(F.col("sys"), "sys", 6), r(F.col("exposure"), "exposure", 2), "flags")


@query("a4_a5_combine_two_stage", _CELLS + """,
 s AS (SELECT cell, map_id, sum(intensity/(stat*stat)) FILTER (ok AND stat<>0)/sum(1/(stat*stat)) FILTER (ok AND stat<>0) AS intensity, sqrt(1/sum(1/(stat*stat)) FILTER (ok AND stat<>0)) AS stat, sum(exposure) FILTER (ok) AS exposure, bit_or(flags) AS flags FROM k GROUP BY ALL)
SELECT cell, round(sum(intensity*exposure) FILTER (intensity IS NOT NULL AND exposure>0)/sum(exposure) FILTER (intensity IS NOT NULL AND exposure>0), 2) AS intensity,
 round(sqrt(sum((stat*exposure)*(stat*exposure)) FILTER (intensity IS NOT NULL AND exposure>0))/sum(exposure) FILTER (intensity IS NOT NULL AND exposure>0), 6) AS stat, bit_or(flags) AS flags FROM s GROUP BY cell""")
def a5(spark, sf):
    maps = cells(spark, sf).drop("bg", "bg_stat", "bg_sys", "obs_us").withColumn("lon", F.pmod(F.col("cell") * 7, F.lit(360)))
    d = M.combine_two_stage(M.assert_maps_match(maps, ["cell"], ["lon"]), ["cell"], "map_id")
    return d.select("cell", r(F.col("intensity"), "intensity", 2), r(F.col("stat"), "stat", 6), "flags")


@query("a6_a7_time_and_flags", _CELLS + """
SELECT map_id, round(sum(obs_us::DOUBLE*exposure)/sum(exposure)/1e6, 0) AS mean_s, bit_or(flags) AS flags FROM k GROUP BY map_id""")
def a6(spark, sf):
    d = cells(spark, sf).groupBy("map_id").agg(M.weighted_time_mean(F.col("obs_us"), F.col("exposure")).alias("t"), M.flag_or(F.col("flags")).alias("flags"))
    return d.select("map_id", r(F.col("t") / 1e6, "mean_s", 0), "flags")


_SKY = "SELECT vec_id, (floor((degrees(asin(embedding[3]::DOUBLE/sqrt(embedding[1]::DOUBLE*embedding[1]::DOUBLE+embedding[2]::DOUBLE*embedding[2]::DOUBLE+embedding[3]::DOUBLE*embedding[3]::DOUBLE)))+90)/30)*12 + floor(((degrees(atan2(embedding[2]::DOUBLE, embedding[1]::DOUBLE))+360)%360)/30))::BIGINT AS pixel, label, embedding[7]::DOUBLE*embedding[7]::DOUBLE AS exposure, abs(embedding[8]::DOUBLE) AS p FROM embeddings"


@query("a8_project_to_sky", f"""
WITH s AS ({_SKY}) SELECT pixel, round(sum(p*exposure)/sum(exposure), 6) AS survival, round(sum(exposure), 6) AS exposure, bit_or(label) AS flags FROM s WHERE label <> 0 GROUP BY pixel""")
def a8(spark, sf):
    d = M.project_to_sky(_psets(spark, sf), ["pixel"])
    return d.select("pixel", r(F.col("survival"), "survival", 6), r(F.col("exposure"), "exposure", 6), "flags")


def _psets(spark, sf):
    e = table(spark, sf, "embeddings")
    x = [F.col("embedding")[i].cast("double") for i in range(8)]
    _, lon, lat = X.spherical_coords((x[0], x[1], x[2]))
    return e.select(X.rect_pixel(F.degrees(lon), F.degrees(lat), 30.0).alias("pixel"), F.abs(x[7]).alias("p"), (x[6] * x[6]).alias("exposure"), F.col("label").alias("flags"), (F.col("label") != 0).alias("in_view"))


@query("a9_correct_survival", _CELLS + """,
 s AS (SELECT cell, sum(survival*exposure)/nullif(sum(exposure), 0) AS p, bit_or(CASE WHEN exposure<>0 THEN flags ELSE 0 END) AS f FROM m GROUP BY cell)
SELECT cell, map_id, round(sum(intensity*1.0471975/nullif(p, 0)), 4) AS intensity, round(sum(stat/nullif(p, 0)), 7) AS stat, bit_or(f) AS flags FROM m LEFT JOIN s USING (cell) GROUP BY cell, map_id""")
def a9(spark, sf):
    c = cells(spark, sf).withColumn("intensity", F.col("intensity") * 1.0471975)
    s = M.project_to_sky(c.select("cell", F.col("survival").alias("p"), "exposure", "flags", F.lit(True).alias("in_view")), ["cell"])
    d = M.correct_survival(c, s, ["cell"]).groupBy("cell", "map_id").agg(F.sum("intensity").alias("i"), F.sum("stat").alias("s"), F.bit_or("flags").alias("flags"))
    return d.select("cell", "map_id", r(F.col("i"), "intensity", 4), r(F.col("s"), "stat", 7), "flags")


@query("a10_subtract_background", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice - l_extendedprice*l_tax, 4) AS intensity, round(sqrt(l_discount*l_discount+l_tax*l_tax), 6) AS stat, round(l_tax/2, 6) AS sys FROM lineitem""")
def a10(spark, sf):
    d = table(spark, sf, "lineitem").withColumns({"rate": F.col("l_extendedprice"), "bg": F.col("l_extendedprice") * F.col("l_tax"), "stat": F.col("l_discount"), "bg_stat": F.col("l_tax"), "bg_sys": F.col("l_tax") / 2})
    return M.subtract_background(d).select("l_orderkey", "l_linenumber", r(F.col("intensity"), "intensity"), r(F.col("stat"), "stat", 6), r(F.col("sys"), "sys", 6))
