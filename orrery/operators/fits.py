"""Regressions by group."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def log_local_fit(df: DataFrame, keys: list[str], centres: list[float], low: float = 0.6, high: float = 1.4, near_high: float = 0.18, near_low: float = 0.12) -> DataFrame:
    """Per group and energy bin the value at the centre of the log-log line through the points (energy, psd > 0)
    strictly inside (low, high) times the centre; NULL unless two points are there and one of these holds:

    * the group's highest energy is inside, and a point lies within near_high (a share of the centre),
    * its second lowest energy is inside, and a point lies within near_low or points lie on both sides,
    * neither is inside, and points lie on both sides."""
    near = F.filter(F.array(*[F.struct(F.lit(i).alias("bin"), F.lit(float(c)).alias("centre")) for i, c in enumerate(centres)]), lambda b: (F.col("energy") > low * b["centre"]) & (F.col("energy") < high * b["centre"]))
    points = df.where("psd > 0").select(*keys, "energy", "psd")
    d = points.withColumn("_b", F.explode(near)).select(*keys, "_b.*", "energy", "psd")
    x, y, s = F.ln("energy"), F.ln("psd"), F.col("energy") / F.col("centre")
    g = d.groupBy(*keys, "bin", "centre").agg(F.count("*").alias("n"), F.regr_slope(y, x).alias("_m"), F.regr_intercept(y, x).alias("_c"), F.min(s).alias("_lo"), F.max(s).alias("_hi"), F.min(F.abs(s - 1)).alias("_near"))
    first_two = points.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("energy"))).where("_n <= 2")
    second = first_two.groupBy(*keys).agg(F.max(F.when(F.col("_n") == 2, F.col("energy"))).alias("_second"))
    ends = points.groupBy(*keys).agg(F.max("energy").alias("_top")).join(second, keys)
    inside = lambda c: (F.col(c) > low * F.col("centre")) & (F.col(c) < high * F.col("centre"))
    top, second, both = inside("_top"), F.coalesce(inside("_second"), F.lit(False)), (F.col("_lo") < 1) & (F.col("_hi") > 1)
    ok = (F.col("n") >= 2) & ((top & (F.col("_near") < near_high)) | (second & ((F.col("_near") < near_low) | both)) | (~top & ~second & both))
    return g.join(ends, keys).select(*keys, "bin", "n", F.when(ok, F.exp(F.col("_c") + F.col("_m") * F.ln("centre"))).alias("psd"))


def fit_power_laws(cell: np.ndarray, cells: int, energy: np.ndarray, flux: np.ndarray, sigma: np.ndarray, steps: int = 60) -> np.ndarray:
    """(A, gamma, sigma_A, sigma_gamma, chi2 / dof) of flux = A energy^-gamma per cell, by damped Gauss-Newton steps from
    the log-log line, for all cells at once, with both parameters kept in [0, 1000]; NaNs where one cannot be fitted.
    Row i belongs to cell[i], rising.

    A step is a handful of sums per cell; cells that have settled leave."""
    out = np.full((cells, 5), np.nan)
    ok = np.isfinite(energy) & np.isfinite(flux) & np.isfinite(sigma) & ~((flux == 0) & (sigma == 0))
    cell, e, f, s = cell[ok], energy[ok], flux[ok], sigma[ok]
    total = lambda who, x: np.bincount(who, x, cells)
    up = f > 0
    with np.errstate(all="ignore"):
        x, y, who = np.log(e[up]), np.log(f[up]), cell[up]
        n = total(who, np.ones(len(who)))
        mx, my = total(who, x) / n, total(who, y) / n
        sxx, sxy = total(who, (x - mx[who]) ** 2), total(who, (x - mx[who]) * (y - my[who]))
        slope = sxy / sxx
        fine = (n >= 2) & (sxx > 1e-24 * np.maximum(1, mx * mx)) & (total(cell, ~(s > 0)) == 0) & np.isfinite(slope)
        a, g = np.clip(np.exp(my - slope * mx), 0, 1000), np.clip(-slope, 0, 1000)
    keep = fine[cell]
    cell, e, f, s = cell[keep], e[keep], f[keep], s[keep]
    log_e = np.log(e)

    def model(who, le, sig, a, g):
        m = np.exp(-g[who] * le) / sig
        return m, -a[who] * le * m

    def cost_of(who, le, fl, sig, a, g):
        return total(who, (fl / sig - a[who] * np.exp(-g[who] * le) / sig) ** 2)

    cost, damp, active = cost_of(cell, log_e, f, s, a, g), np.full(cells, 1e-3), fine.copy()
    who, le, fl, sig = cell, log_e, f, s
    with np.errstate(all="ignore"):
        for _ in range(steps):
            stay = active[who]
            if not stay.all():
                who, le, fl, sig = who[stay], le[stay], fl[stay], sig[stay]
            if not len(who):
                break
            ja, jg = model(who, le, sig, a, g)
            r = fl / sig - a[who] * ja
            haa, hag, hgg = total(who, ja * ja), total(who, ja * jg), total(who, jg * jg)
            ba, bg = total(who, ja * r), total(who, jg * r)
            daa, dgg = haa * (1 + damp), hgg * (1 + damp)
            # a parameter that would leave its bounds stays there, and the other one moves alone
            held_a, held_g = ((a <= 0) & (ba < 0)) | ((a >= 1000) & (ba > 0)), ((g <= 0) & (bg < 0)) | ((g >= 1000) & (bg > 0))
            free = ~held_a & ~held_g
            off = np.where(free, hag, 0.0)
            det = daa * dgg - off * off
            step_a, step_g = np.where(held_a, 0.0, (dgg * ba - off * bg) / det), np.where(held_g, 0.0, (daa * bg - off * ba) / det)
            ta, tg = np.clip(a + step_a, 0, 1000), np.clip(g + step_g, 0, 1000)
            lost = active & ~(np.isfinite(ta) & np.isfinite(tg))
            fine &= ~lost
            active &= ~lost
            new = cost_of(who, le, fl, sig, ta, tg)
            better = active & (new <= cost * (1 + 1e-11))  # sums differ by rounding where the last digits are settled
            done = better & (np.abs(ta - a) <= 1e-12 * np.maximum(1e-12, a)) & (np.abs(tg - g) <= 1e-12 * np.maximum(1e-12, g))
            a, g, cost = np.where(better, ta, a), np.where(better, tg, g), np.where(better, np.minimum(new, cost), cost)
            damp = np.where(better, damp / 10, np.where(active, damp * 10, damp))
            active &= ~done & (damp <= 1e12)
        ja, jg = model(cell, log_e, s, a, g)
        haa, hag, hgg = total(cell, ja * ja), total(cell, ja * jg), total(cell, jg * jg)
        det = haa * hgg - hag * hag
        fine &= np.isfinite(det) & (det > 0)
        dof = np.maximum(1, total(cell, np.ones(len(cell))) - 2)
        got = np.stack([a, g, np.sqrt(hgg / det), np.sqrt(haa / det), cost / dof], 1)
    out[fine] = got[fine]
    return out


def fit_power_law(energy: np.ndarray, flux: np.ndarray, sigma: np.ndarray, steps: int = 60) -> tuple[float, ...]:
    """The fit of one cell."""
    return tuple(fit_power_laws(np.zeros(len(energy), np.int64), 1, energy, flux, sigma, steps)[0].tolist())


def power_law_fit(df: DataFrame, keys: list[str]) -> DataFrame:
    """A fit per cell over its energies (columns energy, intensity, sigma, exposure, obs_us, flags).  A negative or
    zero-bounded index voids A, gamma, sigma_gamma and chi2 (sigma_A is kept); exposure is summed, times are weighted by
    it, flags are joined.  A cell holds one row per energy, so its arrays are short."""
    w = F.when(F.col("obs_us").isNotNull(), F.col("exposure"))
    rows = F.collect_list(F.struct(F.coalesce("energy", F.lit(float("nan"))).alias("e"), F.coalesce("intensity", F.lit(float("nan"))).alias("i"), F.coalesce("sigma", F.lit(float("nan"))).alias("s")))
    g = df.groupBy(*keys).agg(rows.alias("_r"), F.sum("exposure").alias("exposure"), F.round(F.try_divide(F.sum(F.col("obs_us") * w), F.sum(w))).cast("long").alias("obs_us"), F.bit_or("flags").alias("flags"))

    @F.pandas_udf("a double, gamma double, sigma_a double, sigma_gamma double, chi2 double")
    def fit(e: pd.Series, i: pd.Series, s: pd.Series) -> pd.DataFrame:
        cell = np.repeat(np.arange(len(e)), e.str.len())
        flat = [np.concatenate([*x, np.zeros(0)]).astype(float) for x in (e, i, s)]
        return pd.DataFrame(fit_power_laws(cell, len(e), *flat), columns=["a", "gamma", "sigma_a", "sigma_gamma", "chi2"])

    d = g.withColumn("_f", fit(F.col("_r.e"), F.col("_r.i"), F.col("_r.s")))
    fine = F.col("_f.gamma") > 0
    null = lambda c: F.when(~F.isnan(F.col(f"_f.{c}")), F.col(f"_f.{c}"))
    return d.select(*keys, *[F.when(fine, null(c)).alias(c) for c in ("a", "gamma", "sigma_gamma", "chi2")], null("sigma_a").alias("sigma_a"), "exposure", "obs_us", "flags")


def grouped_wls(df: DataFrame, keys: list[str], y: Column, x: list[Column], weight: Column, ridge: float = 0.0) -> DataFrame:
    """Weighted least squares per group: coefficients (array) and chi2.  Spark sums X'WX and X'Wy; only those
    sums, one row per group, are solved in Python.  `ridge` is added to the diagonal."""
    k = len(x)
    d = df.select(*keys, y.cast("double").alias("_y"), weight.cast("double").alias("_w"), *[c.cast("double").alias(f"_x{i}") for i, c in enumerate(x)])
    sums = [F.sum(F.col("_w") * F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_h{i}_{j}") for i in range(k) for j in range(i, k)]
    sums += [F.sum(F.col("_w") * F.col(f"_x{i}") * F.col("_y")).alias(f"_g{i}") for i in range(k)]
    g = d.groupBy(*keys).agg(*sums, F.sum(F.col("_w") * F.col("_y") * F.col("_y")).alias("_yy"), F.count("*").alias("n"))
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    packed = g.select(*keys, F.array(*[F.col(f"_h{i}_{j}") for i, j in upper]).alias("_h"), F.array(*[F.col(f"_g{i}") for i in range(k)]).alias("_g"), "_yy", "n")

    @F.pandas_udf("coefficients array<double>, inverse array<double>, chi2 double")
    def solve(h: pd.Series, g: pd.Series, yy: pd.Series) -> pd.DataFrame:
        out = []
        for a, b, c in zip(h, g, yy, strict=True):
            m = np.zeros((k, k))
            for (i, j), v in zip(upper, a, strict=True):
                m[i, j] = m[j, i] = v
            b = np.asarray(b, float)
            if not (np.isfinite(m).all() and np.isfinite(b).all()):
                out.append((None, None, None))
                continue
            inv = np.linalg.pinv(m + ridge * np.eye(k), hermitian=True)
            beta = inv @ b
            out.append((beta.tolist(), inv.ravel().tolist(), max(0.0, float(c - 2 * beta @ b + beta @ m @ beta))))
        return pd.DataFrame(out, columns=["coefficients", "inverse", "chi2"])

    return packed.withColumn("_s", solve("_h", "_g", "_yy")).select(*keys, "n", "_s.*")


def _prediction(x: list[Column]) -> Column:
    return sum((F.get("coefficients", F.lit(i)) * c for i, c in enumerate(x[1:], 1)), F.get("coefficients", F.lit(0)) * x[0])


def hc3(df: DataFrame, fit: DataFrame, keys: list[str], y: Column, x: list[Column]) -> DataFrame:
    """Heteroscedastic covariance (row-major array) of an unweighted fit: sums of x x' r^2 / (1 - h)^2 between the
    inverses; leverages h are cut at 0.9999."""
    k = len(x)
    j = df.join(fit, keys)
    residual = y.cast("double") - _prediction(x)
    lever = sum((x[a] * x[b] * F.get("inverse", F.lit(a * k + b)) for a in range(k) for b in range(k)), F.lit(0.0))
    d = j.withColumn("_s", F.pow(residual / (1 - F.least(F.lit(0.9999), lever)), 2))
    g = d.groupBy(*keys).agg(F.first("inverse").alias("_inv"), F.array(*[F.sum(x[a] * x[b] * F.col("_s")) for a in range(k) for b in range(k)]).alias("_m"))

    def sandwich(a: int, b: int) -> Column:
        return sum((F.get("_inv", F.lit(a * k + p)) * F.get("_m", F.lit(p * k + q)) * F.get("_inv", F.lit(q * k + b)) for p in range(k) for q in range(k)), F.lit(0.0))

    return g.select(*keys, F.array(*[sandwich(a, b) for a in range(k) for b in range(k)]).alias("covariance"))


def r_squared(df: DataFrame, fit: DataFrame, keys: list[str], y: Column, x: list[Column]) -> DataFrame:
    """1 - SSR / SST; NULL where SST is not positive."""
    v = y.cast("double")
    g = df.join(fit, keys).groupBy(*keys).agg(F.sum(F.pow(v - _prediction(x), 2)).alias("_r"), (F.var_pop(v) * F.count(v)).alias("_t"))
    return g.select(*keys, F.when(F.col("_t") > 0, 1 - F.col("_r") / F.col("_t")).alias("r2"))


def ionization_profile(coefficients: DataFrame, matrix: DataFrame, key: str, k: int, scale: float, shift: float, powers: dict[int, list[float]]) -> DataFrame:
    """Coefficients (key, i, value) times a matrix (i, j, m) over the first k, affine, then a polynomial in the sine
    of latitude: {latitude: weights of j}."""
    p = coefficients.where(F.col("i") < k).join(matrix, "i").groupBy(key, "j").agg((F.sum(F.col("value") * F.col("m")) * scale + shift).alias("c"))
    w = F.array(*[F.struct(F.lit(lat).alias("lat"), F.array(*[F.lit(float(x)) for x in ws]).alias("w")) for lat, ws in powers.items()])
    return p.select(key, "j", "c", F.explode(w).alias("g")).groupBy(key, F.col("g.lat").alias("lat")).agg(F.sum(F.col("c") * F.get("g.w", F.col("j").cast("int"))).alias("rate"))


def run_group_fits(df: DataFrame, key: str, fitter: Callable[[pd.DataFrame], dict | None], fields: str, bad: Callable[[dict], bool] | None = None) -> DataFrame:
    """a user's fitter per group -> a row of `fields` and `fit_flag` (0 good, 1 FIT_ERROR, 2 BAD_FIT).  What a group
    raises becomes NULLs and a flag; it never fails the job.  Groups must fit a task (chunks of a few sweeps)."""
    names = [f.split()[0] for f in fields.split(",")]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        row: dict = dict.fromkeys(names)
        flag = 0
        try:
            got = fitter(pdf.drop(columns=[key]))
            if got is None:
                flag = 2
            else:
                row |= {n: got.get(n) for n in names}
                flag = 2 if bad and bad(got) else 0
        except Exception:  # a chunk that cannot be fitted is a result, not a failure
            row, flag = dict.fromkeys(names), 1
        return pd.DataFrame([{key: pdf[key].iloc[0], **row, "fit_flag": flag}])

    kind = df.schema[key].dataType.simpleString()
    return df.groupBy(key).applyInPandas(one, f"{key} {kind}, {fields}, fit_flag int")
