"""Map descriptors: `sensor-quantity[range][suffix]-species-frame-survival-spin-coord-grid-duration`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed pattern of a whole descriptor; its groups in order
PATTERN = (
    r"^(hic|h45|h90|l090|l105|l075|ulc|u45|u90|ilo)-(ena|spxnbs|spx|isn)([0-9]{4})?([a-zA-Z]*)-(h|o)-(sf|hf|hk)-(sp|nsp)-"
    r"(ram|anti|full)-([a-zA-Z0-9]*)-(2deg|4deg|6deg|nside8|nside16)-([0-9]+(?:mo|yr))$"
)
FIELDS = ["sensor", "quantity", "range", "suffix", "species", "frame", "survival", "spin", "coord", "grid", "duration"]


def parse_descriptor(c: Column) -> Column:
    """Struct of the fields (range as range_lo, range_hi); NULL if the text is no descriptor."""
    part = {f: F.regexp_extract(c, PATTERN, i) for i, f in enumerate(FIELDS, 1)}
    digits = F.nullif(part.pop("range"), F.lit(""))
    fields = [v.alias(k) for k, v in part.items()]
    fields += [F.substring(digits, 1, 2).cast("int").alias("range_lo"), F.substring(digits, 3, 2).cast("int").alias("range_hi")]
    return F.when(c.rlike(PATTERN), F.struct(*fields))


def format_descriptor(s: Column) -> Column:
    """The inverse; the species is always written `h`, range numbers with two digits."""
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    span = F.coalesce(F.concat(two(s["range_lo"]), two(s["range_hi"])), F.lit(""))
    return F.concat_ws("-", s["sensor"], F.concat(s["quantity"], span, s["suffix"]), F.lit("h"), s["frame"], s["survival"], s["spin"], s["coord"], s["grid"], s["duration"])


def descriptor_duration(s: Column) -> Column:
    """Days of the duration; any other duration raises."""
    d = s["duration"]
    bad = F.raise_error(F.concat(F.lit("no duration in the map descriptor: "), d)).cast("double")
    return F.when(d.isNull(), None).when(d == "1mo", 365.25 / 12).when(d == "3mo", 365.25 / 4).when(d == "6mo", 365.25 / 2).when(d.isin("1yr", "12mo"), 365.25).otherwise(bad)
