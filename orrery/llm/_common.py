"""Scratch tables and column helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a NULL document id inside joins and orders; it sorts before every real id.
NULL_ID = -(2**63)

_own_root: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only in local mode (tests) where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    if not _own_root:
        _own_root.append("file://" + tempfile.mkdtemp(prefix="spark-scratch-"))
    return _own_root[0]


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write `df` as Parquet into the shared scratch folder and read it back, which cuts lineage.

    The files survive the loss of executors.  They stay until they are discarded or the folder is cleared."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(written: DataFrame) -> None:
    """Deletes the files of a materialized table that nothing reads any more."""
    spark = written.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(written._scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def id_or_sentinel(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("long"), F.lit(NULL_ID))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
