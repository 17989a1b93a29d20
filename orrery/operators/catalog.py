"""What to build: catalogues of files, lineage, versions, rotations and pointings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .joins import with_next


def latest_version(catalog: DataFrame, key: list[str], version: str) -> DataFrame:
    """The row of the highest version of each key (an aggregation, so it is combined before the shuffle)."""
    row = F.struct(F.col(version), *[F.col(c) for c in catalog.columns if c not in (*key, version)])
    return catalog.groupBy(*key).agg(F.max(row).alias("_r")).select(*key, "_r.*")


def require_all_inputs(catalog: DataFrame, dependencies: list[str], key: str = "start_date") -> DataFrame:
    """Keys for which every dependency (descriptor) exists."""
    have = catalog.where(F.col("descriptor").isin(dependencies)).groupBy(key).agg(F.count_distinct("descriptor").alias("n"))
    return have.where(F.col("n") == len(set(dependencies))).select(key)


def same_parent_set(maps: DataFrame, key: str) -> DataFrame:
    """Keys whose maps (map_id, parent) all list the same parents."""
    each = maps.groupBy(key, "map_id").agg(F.sort_array(F.collect_set("parent")).alias("p"))
    return each.groupBy(key).agg(F.count_distinct("p").alias("n")).where("n = 1").select(key)


def needs_processing(candidates: DataFrame, existing: DataFrame, key: str, major: int) -> DataFrame:
    """Candidates (key, inputs array) not yet built from all their inputs in this major version, with the minor
    version to give: one more than the last, or 1.  existing: key, parents array, major, minor."""
    last = existing.groupBy(key).agg(F.max_by(F.struct("parents", "major", "minor"), F.struct("major", "minor")).alias("e"))
    j = candidates.join(last, key, "left")
    done = (F.size(F.array_except("inputs", "e.parents")) == 0) & (F.col("e.major") == major)
    return j.where(~F.coalesce(done, F.lit(False))).select(key, "inputs", F.lit(major).alias("major"), F.when(F.col("e.major") == major, F.col("e.minor") + 1).otherwise(1).alias("minor"))


def prefer_level(inputs: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Per key the row of the first level in `order`; `preliminary` marks all but the first level."""
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("level"))
    d = inputs.withColumn("_rank", rank).where("_rank > 0")
    d = d.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("_rank"))).where("_n = 1")
    return d.withColumn("preliminary", F.col("_rank") > 1).drop("_n", "_rank")


#: Ids in a bucket of the search for the next pointing.
IDS = 1024


def pointing_range(repoints: DataFrame) -> DataFrame:
    """A pointing lasts from the end of its own repointing to the start of the next (by id, unique)."""
    return with_next(repoints, "id", {"end": "start_utc"}, IDS).select("id", F.col("end_utc").alias("start"), "end")


def repoints_in_rotation(repoints: DataFrame, t0: Column, t1: Column) -> DataFrame:
    """Pointings whose next repointing starts strictly inside the window."""
    d = with_next(repoints, "id", {"_next_start": "start_utc"}, IDS)
    return d.where((F.col("_next_start") > t0) & (F.col("_next_start") < t1)).drop("_next_start")


def forced_targets(lines: DataFrame, now: Column, repoints: DataFrame, rotation_days: float, supported: list[str]) -> DataFrame:
    """Operator-supplied lines `level_descriptor repointN, crM, ... [ignore-after date]` (columns target, ignore_after):
    live lines only; a rotation stands for the pointings whose next repointing starts in it.  repoints: id, day (number
    of the next repointing's start)."""
    p = lines.where(F.col("ignore_after").isNull() | (F.col("ignore_after") >= now))
    p = p.select(F.regexp_extract("target", r"^(\S+)\s", 1).alias("product"), F.explode(F.split(F.regexp_extract("target", r"^\S+\s+(.*)$", 1), r",\s*")).alias("t"))
    p = p.where(F.col("product").isin(supported))
    direct = p.where("t LIKE 'repoint%'").select("product", F.regexp_extract("t", r"(\d+)", 1).cast("long").alias("id"))
    rotations = p.where("t LIKE 'cr%'").select("product", F.regexp_extract("t", r"(\d+)", 1).cast("long").alias("cr"))
    numbered = repoints.withColumn("cr", F.floor(F.col("day") / rotation_days)).select("id", "cr")
    # a rotation is asked for once, however many lines name it; products and rotations are few, so pointings stay put
    asked = F.broadcast(rotations.distinct())
    return direct.unionByName(numbered.join(asked, "cr").select("product", "id")).distinct()


def first_changed(old: DataFrame, new: DataFrame, key: str, columns: list[str], rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """One row: the first key whose columns differ; else the one after the shorter table's end if lengths differ;
    else NULL."""
    o = old.select(key, *[F.col(c).alias(f"_o_{c}") for c in columns])
    j = o.join(new.select(key, *columns), key)
    differs = F.lit(False)
    for c in columns:
        a, b = F.col(f"_o_{c}"), F.col(c)
        differs = differs | (a.isNull() != b.isNull()) | F.coalesce(F.abs(a - b) > atol + rtol * F.abs(b), F.lit(False))
    changed = j.where(differs).agg(F.min(key).alias("changed")).withColumn("grown", F.lit(None).cast("long"))
    both = old.select(F.col(key).alias("a"), F.lit(None).cast("long").alias("b")).unionByName(new.select(F.lit(None).cast("long").alias("a"), F.col(key).alias("b")))
    ends = both.agg(F.max("a").alias("a"), F.max("b").alias("b")).select(F.lit(None).cast("long").alias("changed"), F.when(F.col("a") != F.col("b"), F.least("a", "b") + 1).alias("grown"))
    return changed.unionByName(ends).agg(F.coalesce(F.max("changed"), F.max("grown")).alias(f"first_{key}"))


def intersect_keys(catalog: DataFrame, descriptors: list[str], key: str) -> DataFrame:
    """Keys common to all descriptors."""
    out = None
    for d in descriptors:
        keys = catalog.where(F.col("descriptor") == d).select(key)
        out = keys if out is None else out.intersect(keys)
    return out


def override_by_key(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new replace those of old with the same key."""
    return new.unionByName(old.join(new.select(*key).distinct(), key, "left_anti"))


def keys_union(*tables: DataFrame) -> DataFrame:
    """U4"""
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    return out.distinct()


def missing_parents(inputs: DataFrame, parents: DataFrame) -> DataFrame:
    """U4: inputs that are not among the parents."""
    return inputs.exceptAll(parents)


def stack_priorities(a: DataFrame, b: DataFrame, columns: list[str], shift: int) -> DataFrame:
    """Two aligned sources on one priority axis; b's priorities follow after `shift`."""
    return a.select("priority", *columns).unionByName(b.select((F.col("priority") + shift).alias("priority"), *columns))
