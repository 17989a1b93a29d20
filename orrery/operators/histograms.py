"""Angular and event histograms and what is derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def even_bin(angle: Column, full: float, n: int) -> Column:
    """Bin of [0, full] in n equal parts; the end belongs to the last one."""
    return F.least(F.lit(n - 1), F.floor(angle / (full / n))).cast("int")


def hist_pa_gyro(df: DataFrame, keys: list[str], n_pa: int, n_gyro: int) -> DataFrame:
    """Mean intensity and errors sqrt(sum s^2) / n by pitch angle (gyro_bin NULL) and by pitch angle and gyrophase,
    in one aggregation over grouping sets.  Columns pa, gyro, intensity, sig_minus, sig_plus.

    Rows without pitch angle or intensity are left out; those without gyrophase only of the second product."""
    d = df.where("pa IS NOT NULL AND intensity IS NOT NULL").withColumns({"pa_bin": even_bin(F.col("pa"), 180.0, n_pa), "gyro_bin": F.when(F.col("gyro").isNotNull(), F.least(F.lit(n_gyro - 1), F.floor(F.pmod("gyro", F.lit(360.0)) / (360.0 / n_gyro))).cast("int"))})
    n = F.count("*")
    agg = [F.grouping("gyro_bin").alias("_g"), F.avg("intensity").alias("intensity"), *[(F.sqrt(F.sum(F.col(c) * F.col(c))) / n).alias(c) for c in ("sig_minus", "sig_plus")], n.alias("n")]
    one = [F.col(c) for c in (*keys, "pa_bin")]
    got = d.groupingSets([one, [*one, F.col("gyro_bin")]], *one, F.col("gyro_bin")).agg(*agg)
    return got.where("_g = 1 OR gyro_bin IS NOT NULL").drop("_g")


def centred_bin(angle: Column, centres: list[float], half: list[float]) -> Column:
    """First bin with centre - half <= angle < centre + half; the last one for the rest."""
    out = F.lit(len(centres) - 1)
    for i in reversed(range(len(centres))):
        out = F.when((angle >= centres[i] - half[i]) & (angle < centres[i] + half[i]), F.lit(i)).otherwise(out)
    return out


def hist_pa_gyro_counts(df: DataFrame, keys: list[str], centres: list[float], half: list[float], gyro_centres: list[float], gyro_half: list[float]) -> DataFrame:
    """Mean value by configured bins of pitch angle (gyro_bin NULL) and by pitch angle and gyrophase, in one
    aggregation; error mean / sqrt(sum of counts), NULL without counts.

    Rows without pitch angle or intensity are left out; those without gyrophase only of the second product."""
    d = df.where("pa IS NOT NULL AND intensity IS NOT NULL").withColumns({"pa_bin": centred_bin(F.col("pa"), centres, half), "gyro_bin": F.when(F.col("gyro").isNotNull(), centred_bin(F.col("gyro"), gyro_centres, gyro_half))})
    one = [F.col(c) for c in (*keys, "pa_bin")]
    g = d.groupingSets([one, [*one, F.col("gyro_bin")]], *one, F.col("gyro_bin")).agg(F.grouping("gyro_bin").alias("_g"), F.avg("intensity").alias("intensity"), F.sum("counts").alias("counts"))
    return g.where("_g = 1 OR gyro_bin IS NOT NULL").drop("_g").withColumn("sigma", F.try_divide(F.col("intensity"), F.nullif(F.sqrt("counts"), F.lit(0.0))))


def event_hist(df: DataFrame, keys: list[str]) -> DataFrame:
    """A13"""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def fold_half_spin(df: DataFrame, keys: list[str], sector: str, sectors: int, value: str) -> DataFrame:
    """A sector and the one half a spin away are summed; both get the sum."""
    half = sectors // 2
    g = df.groupBy(*keys, F.pmod(F.col(sector), F.lit(half)).alias("_s")).agg(F.sum(value).alias(value))
    return g.withColumn(sector, F.explode(F.array(F.col("_s"), F.col("_s") + half))).drop("_s")


def normalization(counts: DataFrame, hist: DataFrame, keys: list[str], half: int) -> DataFrame:
    """Counts (keys, half_sector) hold for both halves of a spin; factor max(1, counts / hist); 0 where both are 0,
    NULL where events are missing.  hist: keys, sector, n."""
    both = counts.select(*keys, F.explode(F.array(F.col("half_sector"), F.col("half_sector") + half)).alias("sector"), "counts")
    j = both.join(hist, [*keys, "sector"], "full")
    c, n = F.coalesce(F.col("counts"), F.lit(0.0)), F.coalesce(F.col("n"), F.lit(0))
    return j.select(*keys, "sector", F.when((n == 0) & (c == 0), 0.0).when(n == 0, None).otherwise(F.greatest(F.lit(1.0), c / n)).alias("factor"))


def normalization_per_event(events: DataFrame, factors: DataFrame, keys: list[str]) -> DataFrame:
    """Each event's factor; 0 where its group has none."""
    return events.join(factors.withColumn("_has", F.lit(True)), keys, "left").withColumn("factor", F.when(F.col("_has"), F.col("factor")).otherwise(0.0)).drop("_has")


def species_hist(events: DataFrame, keys: list[str]) -> DataFrame:
    """Factors summed per species and cell (events already have `species`; NULL ones are left out)."""
    return events.where("species IS NOT NULL").groupBy("species", *keys).agg(F.sum("factor").alias("counts"))


def counts_to_rate(hist: DataFrame, keys: list[str], acquisition_s: Column) -> DataFrame:
    """Summed over priorities, per second of acquisition."""
    return hist.groupBy(*keys).agg(F.try_divide(F.sum("counts"), F.first(acquisition_s)).alias("rate"))


def reduced_factor(half_spin: Column, sector: Column, step: Column, at_half_spin: Column, at_sector: Column, at_step: Column, epoch: Column, second_era: Column, third_era: Column) -> Column:
    """Whether the reduced geometric factor holds.  Before the second era: from the half spin after the switch on; in the
    second era never; from the third on: once (half spin, sector within its half of 12, step) is past the switch, compared
    in that order.  Where something is NULL, it does not."""
    where = lambda h, s, e: F.struct(h.cast("double").alias("h"), F.pmod(s, F.lit(12)).cast("double").alias("s"), e.cast("double").alias("e"))
    known = at_half_spin.isNotNull() & at_sector.isNotNull() & at_step.isNotNull() & half_spin.isNotNull() & sector.isNotNull() & step.isNotNull()
    past = known & (where(half_spin, sector, step) > where(at_half_spin, at_sector, at_step))
    return F.coalesce(F.when(epoch < second_era, half_spin > at_half_spin).when(epoch < third_era, False).otherwise(past), F.lit(False))


def rate_to_intensity(rates: DataFrame, factors: DataFrame, efficiency: DataFrame, reduced: Column, factor_on: list[str], efficiency_on: list[str]) -> DataFrame:
    """Rate / (geometric factor * energy * efficiency); factors (full, reduced) and efficiencies by their keys
    (steps and azimuths)."""
    j = rates.join(factors, factor_on).join(efficiency, efficiency_on)
    g = F.when(reduced, F.col("reduced")).otherwise(F.col("full"))
    return j.withColumn("intensity", F.try_divide(F.col("rate"), g * F.col("energy") * F.col("efficiency")))


def azimuth_to_elevation(df: DataFrame, keys: list[str], angles: DataFrame, half_spin: str, low: int, high: int, half: int, value: str) -> DataFrame:
    """Azimuth bins summed into elevations (angles: azimuth, elevation).  `keys` hold the half spin, of which a cell's
    energy step has one.  At the two polar elevations one half of the sectors overwrites the other: at `low` the first
    half does in even half spins and the second in odd ones, at `high` the other way round.  Without a half spin nothing
    is overwritten."""
    g = df.join(angles, "azimuth").groupBy(*keys, "sector", "elevation").agg(F.sum(value).alias(value))
    even = F.pmod(F.col(half_spin), F.lit(2)) == 0
    first = F.when(F.col("elevation") == low, even).when(F.col("elevation") == high, ~even)  # the first half is the source
    source = F.coalesce((F.col("sector") < half) == first, F.lit(True))
    other = F.pmod(F.col("sector") + half, F.lit(2 * half)).cast(df.schema["sector"].dataType)
    to = F.when(first.isNull(), F.array("sector")).otherwise(F.array(F.col("sector"), other))
    return g.where(source).withColumn("sector", F.explode(to))


def partial_density(df: DataFrame, keys: list[str], constant: float, mass_per_charge: Column) -> DataFrame:
    """Constant * sum of intensity sqrt(E/q) sqrt(m/q); NULLs are skipped."""
    return df.groupBy(*keys).agg((constant * F.sum(F.col("intensity") * F.sqrt("energy") * F.sqrt(mass_per_charge))).alias("density"))


def block_mean(df: DataFrame, by: list[str], order: str, n: int, means: list[str], sums: list[str]) -> DataFrame:
    """Means of n consecutive rows (the last block may be shorter); `sums` (deltas) are added up."""
    d = df.withColumn("block", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1) / n))
    return d.groupBy(*by, "block").agg(*[F.avg(c).alias(c) for c in means], *[F.sum(c).alias(c) for c in sums])


def abundance_ratios(df: DataFrame, keys: list[str], ratios: dict[str, tuple[list[str], list[str]]], species: str, value: str) -> DataFrame:
    """{name: (species above, species below)}"""
    total = lambda names: F.sum(F.when(F.col(species).isin(names), F.col(value)))
    return df.groupBy(*keys).agg(*[F.try_divide(total(a), total(b)).alias(n) for n, (a, b) in ratios.items()])


def share_of_total(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A state's share of its element's total."""
    return df.withColumn("share", F.try_divide(F.col(value), F.sum(value).over(Window.partitionBy(*keys))))


def mean_field_direction(means: DataFrame, columns: list[str]) -> DataFrame:
    """Unit vector of a mean field; NULL where a component is."""
    n = F.sqrt(sum((F.col(c) * F.col(c) for c in columns[1:]), F.col(columns[0]) * F.col(columns[0])))
    return means.withColumn("_n", n).withColumns({c: F.try_divide(F.col(c), F.col("_n")) for c in columns}).drop("_n")
