"""Reading calibration tables, settings and products; writing products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType


def read_lookup_csv(spark: SparkSession, path: str, schema: str | StructType, header: bool = False, columns: list[int] | None = None) -> DataFrame:
    """A comma-separated table with `#` comments; `columns` picks columns by position (the schema names those)."""
    if columns is None:
        return spark.read.csv(path, schema=schema, header=header, comment="#")
    named = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = ", ".join(f"_c{i} string" for i in range(max(columns) + 1))
    d = spark.read.csv(path, schema=raw, header=header, comment="#", enforceSchema=True)
    return d.select(*[F.trim(f"_c{i}").try_cast(f.dataType).alias(f.name) for i, f in zip(columns, named, strict=True)])


def read_lookup_matrix(spark: SparkSession, path: str, width: int) -> DataFrame:
    """A matrix file as (line, column, value).  Lines are numbered in file order, so the file must be one partition."""
    d = spark.read.csv(path, schema=", ".join(f"_c{i} double" for i in range(width)), comment="#")
    lines = d.select(F.monotonically_increasing_id().alias("line"), F.array(*[f"_c{i}" for i in range(width)]).alias("v"))
    return lines.select("line", F.posexplode("v").alias("column", "value"))


def read_table_dat(spark: SparkSession, path: str, columns: dict[str, tuple[int, str]]) -> DataFrame:
    """A white-space table with `#` comments: {name: (position, type)}; unreadable fields are NULL."""
    lines = spark.read.text(path).where("trim(value) <> '' AND NOT ltrim(value) LIKE '#%'").select(F.split(F.trim("value"), r"\s+").alias("f"))
    return lines.select(*[F.get("f", F.lit(i)).try_cast(t).alias(n) for n, (i, t) in columns.items()])


def read_settings_json(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """S3: one row of nested settings."""
    return spark.read.json(path, schema=schema, multiLine=True)


def settings_grid(settings: DataFrame, field: str, name: str) -> DataFrame:
    """A settings array as a dimension table (idx, name)."""
    return settings.select(F.posexplode(field).alias("idx", name))


def null_fill(df: DataFrame, fills: dict[str, float]) -> DataFrame:
    """A sentinel becomes NULL, in numeric columns only."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.withColumns({c: F.when(F.col(c) != F.lit(v), F.col(c)) for c, v in fills.items() if isinstance(kinds[c], NumericType)})


def null_out_of_range(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Values outside [min, max] become NULL."""
    return df.withColumns({c: F.when(F.col(c).between(a, b), F.col(c)) for c, (a, b) in ranges.items()})


def declared(df: DataFrame, schema: str | StructType, fill: dict[str, float] | None = None) -> DataFrame:
    """The columns of the schema, cast to their declared width, NULLs replaced by fill values."""
    s = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def one(f) -> Column:
        c = F.col(f.name)
        return (F.coalesce(c, F.lit(fill[f.name])) if fill and f.name in fill else c).cast(f.dataType).alias(f.name)

    return df.select(*[one(f) for f in s])


def write_product(df: DataFrame, path: str, schema: str | StructType, fill: dict[str, float] | None = None, partition: list[str] | None = None) -> None:
    """Declared columns as Parquet, partitioned by product and date."""
    d = declared(df, schema, fill)
    if partition:
        d = d.repartition(*partition)
        d.write.partitionBy(*partition).parquet(path)
    else:
        d.write.parquet(path)


def product_attributes(product: str, parents: DataFrame, data_type: str, start: Column, end: Column) -> DataFrame:
    """One row: parents without repeats, split into science and ancillary files, covered dates, type."""
    names = lambda kind: F.sort_array(F.array_distinct(F.collect_list(F.when(F.col("kind") == kind, F.col("file")))))
    return parents.agg(F.lit(product).alias("product"), names("science").alias("science"), names("ancillary").alias("ancillary"), F.min(start).alias("start_date"), F.max(end).alias("end_date"), F.lit(data_type).alias("data_type"))


def lineage_rows(attributes: DataFrame) -> DataFrame:
    return attributes.select(F.col("product").alias("child"), F.explode(F.concat("science", "ancillary")).alias("parent"))


#: Fixed pattern of product file names: descriptor, date, repointing, version
FILE_NAME = r"_([a-z0-9-]+)_(\d{8})(?:-repoint(\d{5}))?_v(\d{3})\."


def named_parts(name: Column) -> list[Column]:
    got = [F.nullif(F.regexp_extract(name, FILE_NAME, i), F.lit("")) for i in range(1, 5)]
    return [got[0].alias("descriptor"), F.to_date(got[1], "yyyyMMdd").alias("start_date"), got[2].cast("int").alias("repointing"), got[3].cast("int").alias("version")]


def read_partitioned_by_name(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files with the key that their names carry."""
    d = spark.read.parquet(path)
    return d.select("*", *named_parts(F.col("_metadata.file_name")))
