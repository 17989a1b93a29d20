"""Unbounded forms of interval means and latest versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_interval_mean(events: DataFrame, ts: str, value: str, width: str = "1 hour", lateness: str = "10 minutes", by: list[str] | None = None) -> DataFrame:
    """ST1: means over tumbling windows of event time; rows later than the lateness are dropped (append mode)."""
    keys = [F.window(ts, width), *[F.col(c) for c in by or []]]
    g = events.withWatermark(ts, lateness).groupBy(*keys).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
    return g.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *(by or []), "mean", "n")


def without_replays(records: DataFrame, ts: str, key: list[str], lateness: str = "1 hour") -> DataFrame:
    """Records sent again within the lateness are dropped."""
    return records.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(key)


class LatestTable:
    """Newest record per key under `path`, in `parts` parts by hash of the key.

    Batch n writes only the parts that it touches (data/n/part=..) and then a list of which batch holds each part
    (parts/n), which makes it the current state; so a batch that fails changes nothing, and one that is replayed writes
    the same again.  What neither this list nor the one before names is deleted."""

    def __init__(self, path: str, key: list[str], version: str, columns: list[str], parts: int = 64):
        self.path, self.key, self.version, self.parts = path, key, version, parts
        self.rest = [c for c in columns if c not in (*key, version)]

    def _newest(self, d: DataFrame) -> DataFrame:
        return d.groupBy(*self.key).agg(F.max(F.struct(self.version, *self.rest)).alias("_r")).select(*self.key, "_r.*")

    def _exists(self, spark: SparkSession, path: str) -> bool:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

    def _delete(self, spark: SparkSession, path: str) -> None:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)

    def held(self, spark: SparkSession, batch: int) -> dict[int, int]:
        """{part: batch that holds it} after a batch: `parts` entries at most."""
        if batch < 0 or not self._exists(spark, f"{self.path}/parts/{batch}/_SUCCESS"):
            return {}
        return {r["part"]: r["batch"] for r in spark.read.schema("part int, batch long").parquet(f"{self.path}/parts/{batch}").collect()}

    def read(self, spark: SparkSession, batch: int) -> DataFrame | None:
        """The table after a batch; None if it is empty."""
        return self._read(spark, self.held(spark, batch))

    def _read(self, spark: SparkSession, held: dict[int, int]) -> DataFrame | None:
        folders = [f"{self.path}/data/{b}/part={p}" for p, b in held.items()]
        return spark.read.parquet(*folders).select(*self.key, self.version, *self.rest) if folders else None

    def merge(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        part = F.pmod(F.xxhash64(*self.key), F.lit(self.parts)).cast("int").alias("part")
        new = self._newest(batch).persist()
        before = self.held(spark, number - 1)
        touched = {r["part"] for r in new.select(part).distinct().collect()}
        if touched:
            old = self._read(spark, {p: b for p, b in before.items() if p in touched})
            merged = new if old is None else self._newest(old.unionByName(new))
            merged.select(part, *self.key, self.version, *self.rest).repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/data/{number}")
        new.unpersist()
        now = before | dict.fromkeys(touched, number)
        spark.createDataFrame(sorted(now.items()), "part int, batch long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/parts/{number}")
        oldest = self.held(spark, number - 2)
        for p, b in oldest.items():
            if before.get(p) != b:
                self._delete(spark, f"{self.path}/data/{b}/part={p}")
        self._delete(spark, f"{self.path}/parts/{number - 2}")


def stream_latest_version(records: DataFrame, path: str, checkpoint: str, key: list[str], version: str, parts: int = 64):
    """ST2: keeps the newest record of each key in a LatestTable under `path`.  Returns the started query."""
    table = LatestTable(path, key, version, records.columns, parts)
    return records.writeStream.foreachBatch(table.merge).option("checkpointLocation", checkpoint).outputMode("append").start()
