"""Scalar expressions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from .base import query, r, table

_E = ", ".join(f"embedding[{i}]::DOUBLE AS {n}" for i, n in enumerate(("vx", "vy", "vz", "fx", "fy", "fz"), 1))


def _vectors(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(("vx", "vy", "vz", "fx", "fy", "fz"))])


@query("m1_m2_vectors", f"""
WITH v AS (SELECT vec_id, {_E} FROM embeddings)
SELECT vec_id, round(vx*fx+vy*fy+vz*fz, 6) AS dot, round(vy*fz-vz*fy, 6) AS cross_x, round(sqrt(vx*vx+vy*vy+vz*vz), 6) AS norm,
 round(vx/sqrt(vx*vx+vy*vy+vz*vz), 6) AS unit_x, round(CASE WHEN fy=0 THEN NULL ELSE vy/fy END, 4) AS ratio FROM v""")
def m1_m2_vectors(spark, sf):
    v, b = X.vector("vx", "vy", "vz"), X.vector("fx", "fy", "fz")
    return _vectors(spark, sf).select("vec_id", r(X.dot(v, b), "dot", 6), r(X.cross(v, b)[0], "cross_x", 6), r(X.norm(v), "norm", 6), r(X.unit_vector(v)[0], "unit_x", 6), r(X.safe_divide("vy", "fy"), "ratio"))


@query("m3_m4_m5_angles", f"""
WITH v AS (SELECT vec_id, {_E} FROM embeddings)
SELECT vec_id, round(degrees(acos(greatest(-1, least(1, (vx*fx+vy*fy+vz*fz)/sqrt(vx*vx+vy*vy+vz*vz)/sqrt(fx*fx+fy*fy+fz*fz))))), 4) AS pitch,
 round(((degrees(atan2((vx*fz-vz*fx)/sqrt(fx*fx+fz*fz), (-vx*fx*fy + vy*(fx*fx+fz*fz) - vz*fy*fz)/sqrt(fx*fx+fz*fz)/sqrt(fx*fx+fy*fy+fz*fz))) % 360) + 360) % 360, 4) AS gyro,
 round(vy*cos(radians(30)) - vz*sin(radians(30)), 6) AS turned_y FROM v""")
def m3_m4_m5_angles(spark, sf):
    v, b = X.vector("vx", "vy", "vz"), X.vector("fx", "fy", "fz")
    return _vectors(spark, sf).select("vec_id", r(X.pitch_angle(v, b), "pitch"), r(X.gyrophase(v, b), "gyro"), r(X.rotate(v, X.turn_about_x(30))[1], "turned_y", 6))


@query("m6_m8_look_angles", f"""
WITH v AS (SELECT vec_id, {_E} FROM embeddings)
SELECT vec_id, round(sin(radians(90+vy*90))*cos(radians(vx*180)), 6) AS sector_x, round(-cos(radians(vy*90))*sin(radians(vx*180)), 6) AS look_y,
 round(degrees(atan2(-vx, -vy)), 4) AS azimuth, round(degrees(asin(-vz/sqrt(vx*vx+vy*vy+vz*vz))), 4) AS elevation FROM v""")
def m6_m8_look_angles(spark, sf):
    v = X.vector("vx", "vy", "vz")
    az, el = X.flow_to_look_angles(v)
    return _vectors(spark, sf).select(
        "vec_id", r(X.sector_vector(v[0] * 180, 90 + v[1] * 90)[0], "sector_x", 6), r(X.reverse(X.look_vector(v[1] * 90, v[0] * 180))[1], "look_y", 6), r(az, "azimuth"), r(el, "elevation")
    )


@query("m7_m9_m10_speeds", """
SELECT l_orderkey, l_linenumber, round(sqrt(2*l_extendedprice*1.602176634e-19/1.67262192369e-27)/1000, 4) AS speed,
 round((l_quantity*1000)*(l_quantity*1000)*1.67262192369e-27/(2*1.602176634e-19), 6) AS energy, round(sqrt(l_extendedprice*1.380649e-23/1.67262192369e-27)/1000, 6) AS thermal,
 round((l_quantity*1000)*(l_quantity*1000)*1.67262192369e-27/1.380649e-23, 4) AS kelvin, round(1/(1+183.7e-9*l_extendedprice), 8) AS deadtime FROM lineitem""")
def m7_m9_m10_speeds(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", r(X.speed_from_energy("l_extendedprice"), "speed"), r(X.energy_from_speed("l_quantity"), "energy", 6), r(X.thermal_speed("l_extendedprice"), "thermal", 6),
        r(X.temperature("l_quantity"), "kelvin"), r(X.deadtime_factor("l_extendedprice"), "deadtime", 8),
    )


@query("m11_m12_masses", """
SELECT l_orderkey, l_linenumber, round((l_quantity+15-0)*l_linenumber*l_linenumber*1.692e-5, 8) AS m_q,
 round(exp(0.1 + 0.2*ln(l_quantity) + 0.3*ln(l_linenumber+1) + 0.01*ln(l_quantity)*ln(l_linenumber+1) + 0.02*ln(l_quantity)*ln(l_quantity) + 0.03*ln(l_linenumber+1)*ln(l_linenumber+1)*ln(l_linenumber+1)), 6) AS mass,
 round(CASE WHEN l_discount=0 THEN NULL ELSE l_tax/l_discount END, 6) AS ssd,
 round(pow(pow(2*pow(l_quantity, 0.5), 3) + pow(0.3*pow(l_quantity, 0.9), 3), 1/3.0), 6) AS law,
 round(CASE WHEN l_quantity BETWEEN 0.2 AND 860 AND l_tax*1000 BETWEEN 0.1 AND 430 THEN
   CASE WHEN l_tax*1000 <= 40 THEN 1*pow(l_tax*1000/10, ln(2.0)/ln(4.0)) ELSE 2*pow(l_tax*1000/40, ln(3.0/2)/ln(90.0/40)) END END, 6) AS charge FROM lineitem""")
def m11_m12_masses(spark, sf):
    curves = F.array(*[F.struct(F.lit(float(d)).alias("delta"), F.lit(float(c)).alias("charge")) for d, c in ((10, 1), (40, 2), (90, 3))])
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", r(X.mass_per_charge("l_quantity", "l_linenumber"), "m_q", 8), r(X.event_mass("l_quantity", F.col("l_linenumber") + 1, [0.1, 0.2, 0.3, 0.01, 0.02, 0.03]), "mass", 6),
        r(X.mass_from_ssd("l_tax", "l_discount"), "ssd", 6), r(X.double_power_law("l_quantity", 2, 0.5, 0.3, 0.9, 3), "law", 6), r(X.charge_from_de(F.lit(2), F.col("l_quantity"), F.col("l_tax") * 1000, curves), "charge", 6),
    )


@query("m13_sky_angles", f"""
WITH v AS (SELECT vec_id, {_E} FROM embeddings), a AS (SELECT *, vx*3 AS l0, vy AS b0, vz*3 AS l1, fx AS b1 FROM v)
SELECT vec_id, round(acos(greatest(-1, least(1, cos(b0)*cos(l0)*cos(b1)*cos(l1)+cos(b0)*sin(l0)*cos(b1)*sin(l1)+sin(b0)*sin(b1)))), 6) AS angle,
 round(asin(sin(b0)*cos(0.7)+cos(b0)*sin(0.7)*cos(l1)), 6) AS sky_lat,
 round(((atan2(-cos(b1)*sin(l1-l0), sin(b1)*cos(b0)-cos(b1)*sin(b0)*cos(l1-l0)) % (2*pi())) + 2*pi()) % (2*pi()), 5) AS spin,
 round(asin(vz/sqrt(vx*vx+vy*vy+vz*vz)), 6) AS lat FROM a""")
def m13_sky_angles(spark, sf):
    l0, b0, l1, b1 = F.col("vx") * 3, F.col("vy"), F.col("vz") * 3, F.col("fx")
    return _vectors(spark, sf).select(
        "vec_id", r(X.great_circle(l0, b0, l1, b1), "angle", 6), r(X.spin_to_sky(l0, b0, l1, F.lit(0.7))[1], "sky_lat", 6), r(X.sky_to_spin(l0, b0, l1, b1)[1], "spin", 5), r(X.spherical_coords(X.vector("vx", "vy", "vz"))[2], "lat", 6)
    )


@query("m14_sky_pixels", f"""
WITH v AS (SELECT vec_id, {_E} FROM embeddings),
p AS (SELECT vec_id, (degrees(atan2(vy, vx)) + 360) % 360 AS lon, degrees(asin(vz/sqrt(vx*vx+vy*vy+vz*vz))) AS lat FROM v),
q AS (SELECT *, sin(radians(lat)) AS z, (radians(lon)*2/pi()) % 4 AS t FROM p),
e AS (SELECT *, floor(8*(0.5+t) - 8*z*0.75) AS jp, floor(8*(0.5+t) + 8*z*0.75) AS jm, t-floor(t) AS f, 8*sqrt(3*(1-abs(z))) AS h FROM q),
c AS (SELECT *, 9+jp-jm AS ring, floor(f*h)+floor((1-f)*h)+1 AS cap FROM e)
SELECT vec_id, (floor((lat+90)/4)*90 + floor(lon/4))::BIGINT AS rect,
 (CASE WHEN abs(z) <= 2/3.0 THEN 112 + (ring-1)*32 + ((floor((jp+jm-8+2-(ring::BIGINT % 2))/2)::BIGINT % 32) + 32) % 32
   WHEN z > 0 THEN 2*cap*(cap-1) + floor(t*cap)::BIGINT % (4*cap)::BIGINT ELSE 768 - 2*cap*(cap+1) + floor(t*cap)::BIGINT % (4*cap)::BIGINT END)::BIGINT AS healpix FROM c""")
def m14_sky_pixels(spark, sf):
    _, lon, lat = X.spherical_coords(X.vector("vx", "vy", "vz"))
    d = _vectors(spark, sf).select("vec_id", F.degrees(lon).alias("lon"), F.degrees(lat).alias("lat"))
    return d.select("vec_id", X.rect_pixel(F.col("lon"), F.col("lat"), 4.0).alias("rect"), X.healpix_ring(F.col("lon"), F.col("lat"), 8).alias("healpix"))


@query("m15_m16_times", """
WITH o AS (SELECT o_orderkey, o_orderdate AS t, epoch_us(o_orderdate)/86400e6 + 2440587.5 AS jd FROM orders)
SELECT o_orderkey, round((jd-2398167.329)/27.2753+1, 6) AS rotation, trunc((jd-2398167.329)/27.2753+1)::BIGINT AS cr,
 round((floor((jd-2398167.329)/27.2753+1)-1)*27.2753+2398167.329, 4) AS started,
 round(year(t) + (epoch_us(t)-epoch_us(date_trunc('year', t)::TIMESTAMP))/(epoch_us((date_trunc('year', t) + INTERVAL 1 YEAR)::TIMESTAMP)-epoch_us(date_trunc('year', t)::TIMESTAMP))::DOUBLE, 6) AS year,
 make_timestamp(946727935816000 + o_orderkey*1000) AS tt, date_trunc('year', t)::TIMESTAMP + (dayofyear(t)-1)::INTEGER * INTERVAL 1 DAY AS day FROM o""")
def m15_m16_times(spark, sf):
    t = F.col("o_orderdate").cast("timestamp")
    jd = X.julian_date(t)
    return table(spark, sf, "orders").select(
        "o_orderkey", r(X.rotation_number(jd), "rotation", 6), X.cr_of_timestamp(t).alias("cr"), r(X.rotation_start(F.floor(X.rotation_number(jd))), "started"), r(X.decimal_year(t), "year", 6),
        X.tt2000_to_ts(F.col("o_orderkey") * 1000000).alias("tt"), X.yday_to_ts(F.year(t), F.dayofyear(t)).alias("day"),
    )


@query("m17_m18_m20_flags", """
SELECT event_id, (CASE WHEN event_type='error' THEN (event_id & 255) | 4 ELSE event_id & 255 END)::BIGINT AS flagged, (event_id & 2) <> 0 AS has,
 (CASE WHEN event_id & 1 <> 0 THEN 16 ELSE 0 END | CASE WHEN event_id & 2 <> 0 THEN 8 ELSE 0 END)::INTEGER AS translated,
 (event_id*97 & 2047)::BIGINT AS adc, (event_id*97 >> 12 & 63)::BIGINT AS address, (event_id*97 >> 18 & 1)::BIGINT AS low_gain,
 CASE WHEN value >= 50 THEN 1 ELSE 0 END AS hot, CASE WHEN abs(value-40)/(value+40) >= 0.5 THEN 1 ELSE 0 END AS apart FROM events""")
def m17_m18_m20_flags(spark, sf):
    low = F.col("event_id").bitwiseAND(F.lit(255))
    word = {c: w for c, w in zip(("adc", "overflow", "address", "low_gain", "last"), X.unpack_bits(F.col("event_id") * 97, X.PULSE_WORD), strict=True)}
    return table(spark, sf, "events").select(
        "event_id", X.flag_set(low, 4, F.col("event_type") == "error").cast("long").alias("flagged"), X.flag_has(F.col("event_id"), 2).alias("has"), X.flag_translate(F.col("event_id"), {1: 16, 2: 8}).alias("translated"),
        *[word[c].cast("long") for c in ("adc", "address", "low_gain")], X.threshold_flag(F.col("value"), 50).alias("hot"), X.relative_diff_flag(F.col("value"), F.lit(40.0), 0.5).alias("apart"),
    )


@query("m19_m21_m22_closed_forms", """
SELECT l_orderkey, l_linenumber, round((l_quantity + -5*(255/15.0))/(255/15.0), 6) AS decoded, round(sqrt(l_tax)/(255/15.0), 8) AS decoded_std,
 round(1e16*1e-16*4.8569*ln(21.906/l_quantity+31.487)/(1+0.12018*l_quantity+4.1402e-6*pow(l_quantity,3.7524)+8.8476e-12*pow(l_quantity,6.1091)), 6) AS cx,
 round(l_quantity*(1.67262192369e-24+l_discount*6.6446573357e-24)*(400*1e5)*(0.5*(400*1e5)*(400*1e5)+1.3271244e26/6.957e10), 6) AS flux,
 round(1e8*(-2.9819e-8+2.416e-8*pow(l_extendedprice/1000+60, 0.4017)), 6) AS photo, round(l_quantity*(1+l_tax)*(1+l_tax), 6) AS density,
 round(CASE WHEN l_quantity <= 1.5 THEN 0.8165 ELSE sqrt(CASE WHEN l_quantity < 32/greatest(0.1, 1-1e-9*32/0.001) THEN 0 ELSE 0.25 END + l_quantity)/l_quantity END, 6) AS weight FROM lineitem""")
def m19_m21_m22_closed_forms(spark, sf):
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", r(X.decode_linear(q, -5, 10, 8), "decoded", 6), r(X.decode_linear_std(F.col("l_tax"), -5, 10, 8), "decoded_std", 8), r(1e16 * X.cx_cross_section(q), "cx", 6),
        r(X.energy_flux(q, F.lit(400.0), F.col("l_discount")), "flux", 6), r(1e8 * X.photoion_from_f107(F.col("l_extendedprice") / 1000 + 60), "photo", 6), r(X.density_1au(q, 1 + F.col("l_tax")), "density", 6),
        r(X.count_weight(q, F.lit(0.001)), "weight", 6),
    )


@query("m23_tensor_to_field", f"""
WITH v AS (SELECT vec_id, {_E} FROM embeddings), b AS (SELECT *, sqrt(fx*fx+fy*fy+fz*fz) AS n, 2+vx AS xx, vy AS xy, 3+vz AS yy, 0.1 AS xz, 0.2 AS yz, 4.0 AS zz FROM v),
q AS (SELECT *, (fx*fx*xx+fy*fy*yy+fz*fz*zz+2*(fx*fy*xy+fx*fz*xz+fy*fz*yz))/(n*n) AS par FROM b)
SELECT vec_id, round(par*1e4, 3) AS parallel, round((xx+yy+zz-par)/2*1e4, 3) AS perpendicular FROM q""")
def m23_tensor_to_field(spark, sf):
    t = [F.col("vx") + 2, F.col("vy"), F.col("vz") + 3, F.lit(0.1), F.lit(0.2), F.lit(4.0)]
    d = _vectors(spark, sf).select("vec_id", X.rotate_tensor_to_field(t, X.vector("fx", "fy", "fz")).alias("t"))
    return d.select("vec_id", r(F.col("t.parallel"), "parallel", 3), r(F.col("t.perpendicular"), "perpendicular", 3))


@query("m24_principal_temperature", f"""
WITH v AS (SELECT vec_id, {_E} FROM embeddings), t AS (SELECT vec_id, 2+vx AS xx, vy AS xy, 3+vz AS yy, 0.1::DOUBLE AS xz, 0.2::DOUBLE AS yz, 4.0::DOUBLE AS zz FROM v), m AS (SELECT *, (xx+yy+zz)/3 AS m FROM t),
p AS (SELECT *, sqrt((pow(xx-m, 2)+pow(yy-m, 2)+pow(zz-m, 2)+2*(xy*xy+xz*xz+yz*yz))/6) AS p, (xx-m)*((yy-m)*(zz-m)-yz*yz)-xy*(xy*(zz-m)-yz*xz)+xz*(xy*yz-(yy-m)*xz) AS d FROM m),
e AS (SELECT vec_id, m, m+2*p*cos(acos(greatest(-1, least(1, d/(2*p*p*p))))/3) AS hi, m+2*p*cos(acos(greatest(-1, least(1, d/(2*p*p*p))))/3+2*pi()/3) AS lo FROM p), o AS (SELECT vec_id, hi, 3*m-hi-lo AS mid, lo, hi-m >= m-lo AS f FROM e),
r AS (SELECT vec_id, CASE WHEN lo >= 0 AND hi > 0 THEN CASE WHEN f THEN hi ELSE lo END END AS par, CASE WHEN lo >= 0 AND hi > 0 THEN sqrt(mid*CASE WHEN f THEN lo ELSE hi END) END AS perp FROM o)
SELECT vec_id, round(par, 6) AS parallel, round(perp, 6) AS perpendicular, round(CASE WHEN perp = 0 THEN NULL ELSE par/perp END, 6) AS ratio FROM r""")
def m24_principal_temperature(spark, sf):
    t = [F.col("vx") + 2, F.col("vy"), F.col("vz") + 3, F.lit(0.1), F.lit(0.2), F.lit(4.0)]
    par, perp, ratio = X.principal_temperature(t)
    return _vectors(spark, sf).select("vec_id", r(par, "parallel", 6), r(perp, "perpendicular", 6), r(ratio, "ratio", 6))


def _side(sign: str) -> str:
    """SQL of one side of the density scale (M25), by the same rational form as the library's."""
    s = f"sqrt(11600.0::DOUBLE*pow((593.097::DOUBLE*sqrt(er){sign}400.0::DOUBLE)/593.097::DOUBLE, 2)/mean)"
    t = f"(1/(1+0.5*{s}))"
    poly = "0.17087277::DOUBLE"
    for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        poly = f"({c}::DOUBLE+{t}*{poly})"
    return f"0.88623::DOUBLE/({s}*exp(-{s}*{s})+0.88623::DOUBLE*CASE WHEN {s} < 9 THEN {t}*exp(-{s}*{s}+{poly}) ELSE 0 END)"


@query("m25_m26_moments", f"""
WITH q AS (SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS q, l_quantity/50::DOUBLE+1 AS a, l_quantity/40::DOUBLE+1.5 AS b, l_tax::DOUBLE+2 AS c, 0.1::DOUBLE AS d, 0.2::DOUBLE AS e, 0.3::DOUBLE AS f, l_discount::DOUBLE AS g, 0.2::DOUBLE AS h, 0.1::DOUBLE AS i, l_quantity*1e5::DOUBLE AS par, l_quantity*9e4::DOUBLE AS perp, l_linenumber*10::DOUBLE AS er FROM lineitem),
m AS (SELECT *, atan2(f, e) AS alpha, a*(b*c-f*f)+d*(f*e-d*c)+e*(d*f-b*e) AS det, (par+2*perp)/3 AS mean FROM q),
n AS (SELECT *, atan2(d, e*sin(alpha)) AS beta, 0.5*({_side("+")}+{_side("-")}) AS scale FROM m),
k AS (SELECT *, CASE WHEN beta=0 THEN 1/a ELSE 1/(a-d*e/f) END AS across FROM n)
SELECT l_orderkey, l_linenumber, round(CASE WHEN beta=0 THEN 1/c ELSE 1/(a+b+c-2/across) END, 6) AS t_parallel, round(across, 6) AS t_perpendicular,
 round(-(g*(b*c-f*f)+h*(f*e-d*c)+i*(d*f-b*e))/det*100000/100000, 6) AS vx, round(q/CASE WHEN par > 1e4 AND perp > 1e4 AND er > 5 AND mean < 1e7 THEN greatest(1, least(5, scale)) ELSE 1 END, 6) AS density FROM k""")
def m25_m26_moments(spark, sf):
    q = F.col("l_quantity")
    p = [q / 50 + 1, q / 40 + 1.5, F.col("l_tax") + 2, F.lit(0.1), F.lit(0.2), F.lit(0.3), F.col("l_discount"), F.lit(0.2), F.lit(0.1), F.lit(1.0)]
    m = X.fit_parameters_to_moments(p, 3.3e-4)
    li = X.with_density_truncation(table(spark, sf, "lineitem"), "cut", q, F.lit(400.0), q * 1e5, q * 9e4, F.col("l_linenumber") * 10.0)
    return li.select("l_orderkey", "l_linenumber", r(m["t_parallel"], "t_parallel", 6), r(m["t_perpendicular"], "t_perpendicular", 6), r(m["vx"] * 1e5, "vx", 6), r(F.col("cut"), "density", 6))


@query("m27_log_floor", """
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount > 1e-35 THEN ln(l_discount) ELSE -80.6 END, 6) AS ln_psd FROM lineitem WHERE l_discount > 0""")
def m27_log_floor(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", r(X.log_value_floor(F.col("l_discount")), "ln_psd", 6)).where("ln_psd IS NOT NULL")
