"""Time, range and nearest-neighbour joins.

Spark has no range or as-of join; a bare range condition is a nested loop.  Here
a range becomes an equi-join on buckets, and nearness a window within buckets, so
plans hold only shuffled (or, by size, broadcast) hash joins and sorts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def micros(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def range_join(left: DataFrame, x: Column, ranges: DataFrame, lo: Column, hi: Column, width: float, how: str = "inner", by: list[str] | None = None, closed: str = "left", ends: DataFrame | None = None) -> DataFrame:
    """Rows of left with rows of ranges where lo <= x < hi (closed='both': <= hi; an open end is NULL).

    Ranges, the short side, are repeated once per bucket of `width` that they touch, so width should be about a usual
    range.  Rows of left beyond all ends look in the outermost bucket, where open ranges are.  The ends come from the
    ranges (or from `ends`: one row a, b, where that is cheaper), by a subquery of the same plan; left is read once."""
    by = by or []
    cut = ranges.withColumns({"_lo": lo, "_hi": hi})
    if ends is None:
        ends = cut.agg(F.min(F.coalesce("_lo", "_hi")).cast("double").alias("a"), F.max(F.coalesce("_hi", "_lo")).cast("double").alias("b"))
    a, b = (F.coalesce(ends.select(c).scalar(), F.lit(0.0)) for c in "ab")
    bucket = lambda c: F.floor(c.cast("double") / width)
    first, last = bucket(F.coalesce("_lo", a)), bucket(F.coalesce("_hi", b))
    cut = cut.withColumn("_bucket", F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
    asked = left.withColumn("_x", x).withColumn("_bucket", F.when(F.col("_x").isNotNull(), bucket(F.greatest(a, F.least(b, F.col("_x"))))))
    upper = F.col("_x") <= F.col("_hi") if closed == "both" else F.col("_x") < F.col("_hi")
    on = (asked["_bucket"] == cut["_bucket"]) & (F.col("_lo").isNull() | (F.col("_x") >= F.col("_lo"))) & (F.col("_hi").isNull() | upper)
    for c in by:
        on = on & (asked[c] == cut[c])
    out = asked.join(cut, on, how)
    drop = [asked["_bucket"], asked["_x"]] if how in ("left_anti", "left_semi") else [asked["_bucket"], cut["_bucket"], F.col("_x"), F.col("_lo"), F.col("_hi"), *[cut[c] for c in by]]
    return out.drop(*drop)


def ends_of(table: DataFrame, x: Column) -> DataFrame:
    return table.agg(F.min(x).cast("double").alias("a"), F.max(x).cast("double").alias("b"))


def with_next(table: DataFrame, at: str, columns: dict[str, str], width: float, by: list[str] | None = None) -> DataFrame:
    """Adds columns of the next row by `at` (numeric, unique per `by`): {new name: column}; NULL for the last row.

    The next row is looked for within buckets of `width`; a bucket's last row takes the first one of the next bucket
    that has rows, and only those first rows (one per bucket) are ordered together."""
    by = by or []
    own = Window.partitionBy(*by, "_k").orderBy(at)
    d = table.withColumn("_k", F.floor(F.col(at).cast("double") / width)).withColumn("_next", F.lead(F.struct(*[F.col(c).alias(n) for n, c in columns.items()])).over(own))
    first = d.groupBy(*by, "_k").agg(F.min_by(F.struct(*[F.col(c).alias(n) for n, c in columns.items()]), at).alias("_f"))
    after = first.select(*by, "_k", F.lead("_f").over(Window.partitionBy(*by).orderBy("_k")).alias("_after"))
    d = d.join(after, [*by, "_k"], "left").withColumn("_next", F.coalesce("_next", "_after"))
    return d.select(*table.columns, *[F.col(f"_next.{n}").alias(n) for n in columns])


def nearest_join(left: DataFrame, right: DataFrame, ts: str, values: list[str], tolerance_us: int, by: list[str] | None = None) -> DataFrame:
    """For each row of left the values of the nearest row of right; ties go to the earlier one, and a distance
    over the tolerance gives NULL.  Rows of right with a NULL value are not considered.  Of right rows at one instant,
    ordered by their values, the first one counts at or after the row of left, the last one before it.  Adds `matched_ts`.

    Right is repeated in three buckets of the tolerance's width, so groups are small and need no other key."""
    by = by or []
    width = max(1, tolerance_us)
    good = right.where(" AND ".join(f"{c} IS NOT NULL" for c in [ts, *values])).select(*by, micros(ts).alias("_t"), F.struct(micros(ts).alias("t"), *[F.col(c) for c in values]).alias("_r"))
    near = good.withColumn("_b", F.explode(F.array(*[F.floor(F.col("_t") / width) + d for d in (-1, 0, 1)])))
    rows = left.select(F.struct(*[F.col(c) for c in left.columns]).alias("_l"), *by, micros(ts).alias("_t"))
    both = rows.withColumn("_b", F.floor(F.col("_t") / width)).withColumn("_r", F.lit(None)).unionByName(near.withColumn("_l", F.lit(None)), allowMissingColumns=True)
    # of one instant, rows of left come first; what follows is what came last in the opposite order, so both frames only grow
    order = [F.col("_t"), F.col("_l").isNull(), F.col("_r")]
    seen = lambda w: F.last("_r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    bucket = Window.partitionBy(*by, "_b")
    j = both.withColumn("_p", seen(bucket.orderBy(*order))).withColumn("_n", seen(bucket.orderBy(*[c.desc() for c in order]))).where("_l IS NOT NULL")
    dp, dn = F.col("_t") - F.col("_p.t"), F.col("_n.t") - F.col("_t")
    pick = F.when(F.col("_n").isNull() | (dp <= dn), F.col("_p")).otherwise(F.col("_n"))
    pick = F.when(F.abs(pick["t"] - F.col("_t")) <= tolerance_us, pick)
    j = j.withColumn("_m", pick)
    return j.select("_l.*", F.timestamp_micros("_m.t").alias("matched_ts"), *[F.col(f"_m.{c}").alias(c) for c in values])


def interval_mean_join(left: DataFrame, right: DataFrame, key: str, t_us: Column, half_us: int, right_ts: str, values: list[str]) -> DataFrame:
    """Means of right over [t - half, t + half) for each row of left (unique `key`); NULL when empty or when a value
    inside is NULL.  A sample in several windows belongs to the earliest one (ties: smaller key)."""
    w = 2 * half_us
    windows = left.select(F.col(key), t_us.alias("_t")).withColumn("_b", F.explode(F.array_distinct(F.array(F.floor((F.col("_t") - half_us) / w), F.floor((F.col("_t") + half_us - 1) / w)))))
    samples = right.select(micros(right_ts).alias("_s"), *values).withColumn("_id", F.struct(F.col("_s"), *[F.col(c) for c in values])).withColumn("_b", F.floor(F.col("_s") / w))
    hit = samples.join(windows, "_b").where((F.col("_s") >= F.col("_t") - half_us) & (F.col("_s") < F.col("_t") + half_us))
    owned = hit.groupBy("_id").agg(F.min(F.struct("_t", F.col(key).alias("k"))).alias("o"), F.count_distinct(F.col(key)).alias("_w"), F.count("*").alias("_c"))
    # equal samples count as often as they occur
    owned = owned.withColumn("_times", F.col("_c") / F.col("_w"))
    means = owned.groupBy(F.col("o.k").alias(key)).agg(*[F.when(F.count(F.col(f"_id.{c}")) == F.count("*"), F.sum(F.col(f"_id.{c}") * F.col("_times")) / F.sum("_times")).alias(c) for c in values])
    return left.join(means, key, "left")


def exact_align(left: DataFrame, right: DataFrame, on: str, order: str, values: list[str]) -> DataFrame:
    """The first row of right (by `order`) at the same instant; `missing` where there is none."""
    first = right.withColumn("_n", F.row_number().over(Window.partitionBy(on).orderBy(order))).where("_n = 1").select(on, *values, F.lit(True).alias("_found"))
    return left.join(first, on, "left").withColumn("missing", F.col("_found").isNull()).drop("_found")


def pair_by_key(a: DataFrame, b: DataFrame, key: str, order: str, ties: list[str] | None = None) -> DataFrame:
    """Inner join in which the last duplicate (by `order`) of each side wins; of several last ones the first by
    `ties` (columns that are not returned)."""
    ties = ties or []

    def last(d: DataFrame, side: str) -> DataFrame:
        kept = d.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc(), *ties))).where("_n = 1").drop("_n")
        return kept.select(key, *[F.col(c).alias(f"{side}_{c}") for c in d.columns if c not in (key, *ties)])

    return last(a, "a").join(last(b, "b"), key)


def asof_intervals(table: DataFrame, t: Column, values: list[str], width: float, by: list[str] | None = None) -> DataFrame:
    """A dated table as validity intervals _from, _until (NULL: open); of equal times the last value stands."""
    by = by or []
    one = table.withColumn("_from", t).groupBy(*by, "_from").agg(*[F.max(c).alias(c) for c in values])
    return with_next(one, "_from", {"_until": "_from"}, width, by)


def asof_calibration(left: DataFrame, t: Column, cal: DataFrame, cal_t: Column, values: list[str], width: float, strict: bool = False) -> DataFrame:
    """Values of the latest calibration at or before t (strict: before t).  Rows without one raise when read."""
    shift = 1 if strict else 0
    got = range_join(left, t - shift, asof_intervals(cal, cal_t, values, width), F.col("_from"), F.col("_until"), width, "left", ends=ends_of(cal, cal_t))
    first = values[0]
    return got.withColumn(first, F.when(F.col("_from").isNull(), F.raise_error(F.lit("no calibration before this time")).cast("double")).otherwise(F.col(first))).drop("_from", "_until")


def best_overlapping(left: DataFrame, a: Column, b: Column, ancillary: DataFrame, width: float, key: str, value: str) -> DataFrame:
    """Of ancillary rows (valid_from, valid_to or NULL, ingested, value) that overlap [a, b] the latest ingested.

    Buckets end where the ancillary rows do: what reaches further meets in the last one."""
    top = ancillary.agg(F.max(F.greatest("valid_from", F.coalesce("valid_to", "valid_from")))).scalar()
    spread = lambda d, x, y: d.withColumn("_d", F.explode(F.sequence(F.floor(F.least(x, top) / width), F.floor(F.least(y, top) / width))))
    days = spread(left.withColumns({"_a": a, "_b": b}), F.col("_a"), F.col("_b"))
    anc = spread(ancillary, F.col("valid_from"), F.greatest("valid_from", F.coalesce("valid_to", top)))
    hit = days.join(anc, "_d").where((F.col("valid_from") <= F.col("_b")) & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("_a"))))
    best = hit.groupBy(key).agg(F.max_by(value, F.struct("ingested", value)).alias(value))
    return left.join(best, key, "left")


def anti_bad_days(intervals: DataFrame, start: Column, end: Column, bad: DataFrame, at: Column, width: float, key: str) -> DataFrame:
    """Intervals that hold no bad instant (start <= bad < end)."""
    hit = range_join(bad.select(at.alias("_at")), F.col("_at"), intervals.withColumns({"_s": start, "_e": end}).select(key, "_s", "_e"), F.col("_s"), F.col("_e"), width)
    return intervals.join(hit.select(key).distinct(), key, "left_anti")


def first_rule_range(df: DataFrame, x: Column, y: Column, rules: DataFrame, width: float, key: list[str]) -> DataFrame:
    """Species of the first rule (rule_no) with x_min <= x < x_max and y_min <= y < y_max; else NULL."""
    d = df.withColumns({"_rx": x, "_ry": y})
    hit = range_join(d, F.col("_rx"), rules, F.col("x_min"), F.col("x_max"), width).where((F.col("_ry") >= F.col("y_min")) & (F.col("_ry") < F.col("y_max")))
    first = hit.groupBy(*key).agg(F.min_by("species", "rule_no").alias("species"))
    return df.join(first, key, "left")


def set_rule_join(df: DataFrame, groups: str, rules: list[dict]) -> DataFrame:
    """The first rule whose `include` groups are all there and whose `exclude` groups are not.  Rules are a short
    configuration list, so they are part of the expression."""
    out = F.lit(None)
    for rule in reversed(rules):
        have = F.size(F.array_except(F.array(*[F.lit(g) for g in rule["include"]]), F.col(groups))) == 0 if rule["include"] else F.lit(True)
        lack = ~F.arrays_overlap(F.array(*[F.lit(g) for g in rule["exclude"]]), F.col(groups)) if rule["exclude"] else F.lit(True)
        out = F.when(have & lack, F.lit(rule["name"])).otherwise(out)
    return df.withColumn("rule", out)


def segments(table: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Neighbouring nodes of a table: x0, y0, x1, y1 (the last node has NULL x1) and the table's ends."""
    by = by or []
    w = Window.partitionBy(*by).orderBy(x)
    t = table.groupBy(*by, x).agg(F.first(y).alias(y)) if by else table.select(x, y).dropDuplicates([x])
    every = Window.partitionBy(*by)
    return t.select(*by, F.col(x).cast("double").alias("x0"), F.col(y).cast("double").alias("y0"), F.lead(x).over(w).cast("double").alias("x1"), F.lead(y).over(w).cast("double").alias("y1"), F.max(x).over(every).cast("double").alias("_top"), F.min(x).over(every).cast("double").alias("_bottom"))


def interp_join(left: DataFrame, at: Column, table: DataFrame, x: str, y: str, width: float, log_x: bool = False, by: list[str] | None = None) -> DataFrame:
    """Piecewise linear value of the table at `at`, constant beyond its ends (log_x: linear in the logarithm)."""
    d = left.withColumn("_q", at.cast("double"))
    ends = ends_of(table, F.col(x))
    if not by:
        d = d.withColumn("_q", F.greatest(ends.select("a").scalar(), F.least(ends.select("b").scalar(), F.col("_q"))))
    got = range_join(d, F.col("_q"), segments(table, x, y, by), F.col("x0"), F.col("x1"), width, "left", by, ends=ends)
    f = (lambda c: F.ln(c)) if log_x else (lambda c: c)
    share = F.try_divide(f(F.col("_q")) - f(F.col("x0")), f(F.col("x1")) - f(F.col("x0")))
    value = F.when(F.col("x1").isNull(), F.col("y0")).otherwise(F.col("y0") + (F.col("y1") - F.col("y0")) * share)
    return got.withColumn(f"{y}_at", value).drop("x0", "x1", "y0", "y1", "_q", "_top", "_bottom")


def nearest_cells(table: DataFrame, x: str) -> DataFrame:
    """Each node's cell (lo, hi] of points nearest to it; a point half-way belongs to the lower node."""
    t = table.select(F.col(x).cast("double").alias("node")).distinct()
    w = Window.orderBy("node")
    return t.select("node", ((F.lag("node").over(w) + F.col("node")) / 2).alias("lo"), ((F.lead("node").over(w) + F.col("node")) / 2).alias("hi"))


def nearest_value(left: DataFrame, at: Column, grid: DataFrame, x: str, width: float, log: bool = False) -> DataFrame:
    """The grid value nearest to `at` (log: in ratio); ties go to the lower one."""
    f = F.ln if log else (lambda c: c)
    g = grid.select(f(F.col(x).cast("double")).alias("_g"), F.col(x).alias("_v"))
    cells = nearest_cells(g, "_g").join(g, F.col("node") == F.col("_g")).select("lo", "hi", "_v")
    # cells are open below and closed above: negate to get lo <= x < hi
    d = left.withColumn("_q", -f(at.cast("double")))
    return range_join(d, F.col("_q"), cells, -F.col("hi"), -F.col("lo"), width, "left").withColumnRenamed("_v", f"nearest_{x}").drop("_q", "lo", "hi")


def circular_nearest(left: DataFrame, at: Column, grid: DataFrame, x: str, width: float = 5.0) -> DataFrame:
    """Nearest grid angle on the circle; ties go to the lower one."""
    tripled = grid.select(F.explode(F.array(*[F.col(x).cast("double") + d for d in (-360.0, 0.0, 360.0)])).alias("_a"))
    got = nearest_value(left.withColumn("_angle", F.pmod(at.cast("double"), F.lit(360.0))), F.col("_angle"), tripled, "_a", width)
    return got.withColumn(f"nearest_{x}", F.pmod(F.col("nearest__a"), F.lit(360.0))).drop("nearest__a", "_angle")


def bilinear_join(left: DataFrame, angle: Column, distance: Column, grid: DataFrame, step_angle: float, nodes: int, step_distance: float, least: int, most: int, value: str) -> DataFrame:
    """Bilinear value at (angle, distance) on a regular grid (gx, gy, value): angles gx * step, gx from 0 to nodes - 1
    and around; distances gy * step, gy from `least` (above 0) to `most`.  Beyond the largest distance the value is 0;
    below the least one it is the value there, scaled by the distance.  A hole in the grid gives NULL."""
    low, high = least * step_distance, most * step_distance
    d = left.withColumns({"_fx": F.pmod(angle, F.lit(nodes * step_angle)) / step_angle, "_d": distance.cast("double")})
    d = d.withColumn("_fy", F.greatest(F.lit(low), F.col("_d")) / step_distance)
    d = d.withColumns({"_ix": F.floor("_fx"), "_iy": F.floor("_fy")})
    out, total = d, F.lit(0.0)
    for k, (dx, dy) in enumerate(((0, 0), (1, 0), (0, 1), (1, 1))):
        corner = grid.select(F.col("gx").alias(f"_x{k}"), F.col("gy").alias(f"_y{k}"), F.col(value).cast("double").alias(f"_v{k}"))
        out = out.join(corner, (F.pmod(F.col("_ix") + dx, F.lit(nodes)) == F.col(f"_x{k}")) & (F.col("_iy") + dy == F.col(f"_y{k}")), "left")
        wx = F.col("_fx") - F.col("_ix") if dx else 1 - F.col("_fx") + F.col("_ix")
        wy = F.col("_fy") - F.col("_iy") if dy else 1 - F.col("_fy") + F.col("_iy")
        total = total + F.when(wx * wy == 0, 0.0).otherwise(wx * wy * F.col(f"_v{k}"))
    scaled = F.when(F.col("_d") < low, total * F.col("_d") / low).otherwise(total)
    return out.withColumn(f"{value}_at", F.when(F.col("_d") > high, 0.0).otherwise(scaled)).select(*left.columns, f"{value}_at")


def uneven_bilinear_join(left: DataFrame, lon: Column, lat: Column, grid: DataFrame, value: str, width: float = 10.0) -> DataFrame:
    """J12 on a table (glon, glat, value) whose axes have any spacing: bilinear value at (lon, lat).  Longitudes go around;
    a latitude outside the table raises when read, one that is NULL gives NULL, as does a hole in the table.

    The nodes of each axis are located by a range join (width: a usual spacing); the four corners of a cell stand
    together in one row, so a point meets one row of the table."""
    def axis(c: str, i: str, around: bool) -> DataFrame:
        nodes = grid.select(F.col(c).cast("double").alias("x0")).where("x0 IS NOT NULL").distinct()
        w = Window.orderBy("x0")  # one row per node of an axis
        end = F.lead("x0").over(w)
        return nodes.select("x0", (F.coalesce(end, F.first("x0").over(w) + 360.0) if around else end).alias("x1"), (F.row_number().over(w) - 1).alias(i))

    across, up = axis("glon", "_i", True), axis("glat", "_j", False)
    n = across.agg(F.count("*")).scalar()
    node = grid.select(F.col("glon").cast("double").alias("_a"), F.col("glat").cast("double").alias("_b"), F.col(value).cast("double").alias("_v"))
    node = node.join(across.select(F.col("x0").alias("_a"), "_i"), "_a").join(up.select(F.col("x0").alias("_b"), "_j"), "_b").select("_i", "_j", "_v")
    cell = node.withColumnRenamed("_v", "_v00")
    for di, dj in ((1, 0), (0, 1), (1, 1)):
        i = F.pmod(F.col("_i") - di, n) if di else F.col("_i")
        cell = cell.join(node.select(i.cast("int").alias("_i"), (F.col("_j") - dj).alias("_j"), F.col("_v").alias(f"_v{di}{dj}")), ["_i", "_j"], "full")
    low, high = (up.agg(end("x0")).scalar() for end in (F.min, F.max))
    first = across.agg(F.min("x0")).scalar()
    y = F.when((lat < low) | (lat > high), F.raise_error(F.lit("a latitude outside the table")).cast("double")).otherwise(lat.cast("double"))
    d = left.withColumns({"_qx": F.pmod(lon.cast("double") - first, F.lit(360.0)) + first, "_qy": y})
    d = range_join(d, F.col("_qx"), across, F.col("x0"), F.col("x1"), width, "left").withColumnsRenamed({"x0": "_x0", "x1": "_x1"})
    d = range_join(d, F.col("_qy"), up, F.col("x0"), F.col("x1"), width, "left").withColumnsRenamed({"x0": "_y0", "x1": "_y1"})
    d = d.join(cell, ["_i", "_j"], "left")
    sx = F.try_divide(F.col("_qx") - F.col("_x0"), F.col("_x1") - F.col("_x0"))
    sy = F.coalesce(F.try_divide(F.col("_qy") - F.col("_y0"), F.col("_y1") - F.col("_y0")), F.lit(0.0))
    total = F.lit(0.0)
    for di, dj in ((0, 0), (1, 0), (0, 1), (1, 1)):
        weight = (sx if di else 1 - sx) * (sy if dj else 1 - sy)
        total = total + F.when(weight == 0, 0.0).otherwise(weight * F.col(f"_v{di}{dj}"))
    known = F.col("_qx").isNotNull() & F.col("_qy").isNotNull()
    return d.withColumn(f"{value}_at", F.when(known, total)).select(*left.columns, f"{value}_at")


def sky_cell(lon: Column, lat: Column, size: float) -> tuple[Column, Column]:
    """(band, cell within it) of about size x size degrees: a band of latitude has as many cells as fit around it."""
    band = F.floor(lat / size)
    cells = cells_around(band, size)
    return band, F.least(cells - 1, F.floor(F.pmod(lon, F.lit(360.0)) / 360.0 * cells))


def cells_around(band: Column, size: float) -> Column:
    widest = F.when(band >= 0, band * size).otherwise((band + 1) * size)  # the edge next to the equator
    return F.greatest(F.lit(1), F.floor(360.0 * F.cos(F.radians(F.least(F.lit(90.0), F.abs(widest)))) / size)).cast("long")


def sky_proximity(points: DataFrame, lon: str, lat: str, catalog: DataFrame, key: str, size: float = 2.0) -> DataFrame:
    """`near`: whether a source (slon, slat, radius; degrees, radius <= 0: off) lies within its radius.

    Sources are repeated in the cells of sky that they reach (cells of `size` degrees, about a usual radius): in
    longitude a cap of radius r around latitude b reaches asin(sin r / cos b) either way, and all around where it holds
    a pole.  So a point meets only sources a cell or their radius away."""
    r, b, slack = F.col("radius"), F.col("slat"), 1e-9
    top = F.lit(90.0)
    bands = F.sequence(F.floor(F.greatest(-top, b - r - slack) / size), F.floor(F.least(top, b + r + slack) / size))
    pole = F.abs(b) + r + slack >= 90
    reach = F.when(pole, 360.0).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(r)) / F.cos(F.radians(b))))) + slack)
    src = catalog.where("radius > 0 AND slon IS NOT NULL AND slat IS NOT NULL").select("slon", "slat", "radius", reach.alias("_w"), F.explode(bands).alias("_b"))
    src = src.withColumn("_n", cells_around(F.col("_b"), size))
    at = lambda x: F.floor(x / 360.0 * F.col("_n"))
    src = src.withColumns({"_c0": at(F.col("slon") - F.col("_w")), "_c1": at(F.col("slon") + F.col("_w"))})
    whole = F.col("_c1") - F.col("_c0") + 1 >= F.col("_n")
    cells = F.when(whole, F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).otherwise(F.transform(F.sequence("_c0", "_c1"), lambda c: F.pmod(c, F.col("_n"))))
    src = src.withColumn("_c", F.explode(cells)).select("slon", "slat", "radius", "_b", "_c")
    band, cell = sky_cell(F.col(lon), F.col(lat), size)
    p = points.select(key, lon, lat, band.alias("_b"), cell.alias("_c"))
    half = F.pow(F.sin(F.radians((F.col(lat) - F.col("slat")) / 2)), 2) + F.cos(F.radians(lat)) * F.cos(F.radians("slat")) * F.pow(F.sin(F.radians((F.col(lon) - F.col("slon")) / 2)), 2)
    hit = p.join(src, ["_b", "_c"]).where(F.degrees(2 * F.asin(F.sqrt(F.least(F.lit(1.0), half)))) <= F.col("radius")).select(key).distinct()
    return points.join(hit.withColumn("near", F.lit(True)), key, "left").withColumn("near", F.coalesce("near", F.lit(False)))


def grouped_radii(catalog: DataFrame, groups: int = 10, slack: float = 1e-6) -> DataFrame:
    """A catalog's radii raised to the upper edges of equal intervals between the smallest and the largest (groups + 1
    of them, with a slack at both ends), as the instrument team's masks have them."""
    low = catalog.agg(F.min("radius") - slack).scalar()
    step = (catalog.agg(F.max("radius") + slack).scalar() - low) / (groups + 1)
    return catalog.withColumn("radius", low + (F.floor((F.col("radius") - low) / step) + 1) * step)


def dim_lookup(df: DataFrame, dim: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Calibration by several keys; the planner broadcasts the table if it is small enough."""
    return df.join(dim.select(*keys, *values), keys, "left")


def flags_around(left: DataFrame, t: Column, series: DataFrame, at: Column, flags: str, width: float) -> DataFrame:
    """Flags of the records before and after t joined; only the equal one where there is one; the last beyond the end."""
    s = series.withColumn("_from", at).groupBy("_from").agg(F.bit_or(flags).alias("_f0"))
    s = with_next(s, "_from", {"_until": "_from", "_f1": "_f0"}, width)
    got = range_join(left.withColumn("_t", t), F.col("_t"), s, F.col("_from"), F.col("_until"), width, "left", ends=ends_of(series, at))
    value = F.when(F.col("_t") == F.col("_from"), F.col("_f0")).otherwise(F.col("_f0").bitwiseOR(F.coalesce("_f1", F.lit(0))))
    return got.withColumn("flags_around", value).drop("_from", "_until", "_f0", "_f1", "_t")


def wrap_range_lookup(df: DataFrame, lon: Column, bins: list[tuple[float, float]]) -> DataFrame:
    """Number of the last bin [a, b) that holds a longitude (a > b: across 360); rows in none are dropped.  Bins
    are a short configuration list."""
    out = F.lit(None).cast("int")
    for i, (a, b) in enumerate(bins):
        inside = (lon >= a) & (lon < b) if a <= b else (lon >= a) | (lon < b)
        out = F.when(inside, F.lit(i)).otherwise(out)
    return df.withColumn("bin", out).where("bin IS NOT NULL")
