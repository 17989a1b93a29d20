"""Corpus pipeline: language, near copies, benchmark passages, secrets, source mix.

Every stage takes (spark, docs, sf_dir), reads all rows that the one before kept,
and returns the columns of `docs`; the last one adds `copy` (a document that the
mix takes k times has k rows).  Rows may hold NULLs in any column; a stage's
defined cases are those of the operator that it calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.llm import decontaminate, jaccard_join, language_id, mixing, secrets
from orrery.llm._common import discard, materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is told to be in a language of the corpus (a score above chance), with the language filled
    in where it was NULL; the model learns from the labelled rows of `docs`."""
    return language_id.keep_known(docs, language_id.fit(docs, F.lit(True)))


def with_row_keys(docs: DataFrame) -> DataFrame:
    """Adds _key, a long that tells documents apart, and _shared.

    The key is the doc_id where one row has it.  Rows without an id, or with one that repeats (_shared), get a hash of
    id and text, above 2^62, so only rows of equal id and text have one key.  Repeated ids are few: their table is
    written first, so the planner sees its size and joins it without moving the texts."""
    ids = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("doc_id").alias("_id"), F.lit(True).alias("_again"))
    repeated = materialize(ids, "repeated_ids")
    d = docs.join(repeated, docs["doc_id"] == repeated["_id"], "left")
    shared = F.isnull("doc_id") | F.coalesce("_again", F.lit(False))
    own = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return d.select(*[docs[c] for c in docs.columns], F.when(shared, own).otherwise(F.col("doc_id")).alias("_key"), shared.alias("_shared"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8): that with the smallest doc_id.

    Rows of equal id and text are one document; a row whose id is NULL or repeats stands for itself, and stays in a
    group only if all of the group are like that."""
    keyed = with_row_keys(docs)
    found = jaccard_join.jaccard_components(keyed.select(F.col("_key").alias("doc_id"), "text"), n=5, percent=80)
    stay = found.where("doc_id = component_id").select(F.col("doc_id").alias("_key")).distinct()
    kept = keyed.join(stay, "_key", "left_semi")
    first = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64(*docs.columns)))
    once = kept.where("_shared").withColumn("_row", first).where("_row = 1")
    return kept.where("NOT _shared").select(*docs.columns).unionByName(once.select(*docs.columns))


def no_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    return secrets.redact(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.  Decisions come back by document (doc_id, source, text): of its rows,
    `more` are taken once more than the others."""
    same = lambda text_hash: [F.coalesce("doc_id", F.lit(0)).alias("_d"), F.isnull("doc_id").alias("_dn"), F.coalesce("source", F.lit("")).alias("_s"), F.isnull("source").alias("_sn"), text_hash.alias("_t")]
    key = ["_d", "_dn", "_s", "_sn", "_t"]
    took = mixing.mix_documents(docs).where("passes > 0 OR more > 0").select(*same(F.col("text_hash")), F.col("n").alias("_n"), F.col("passes").alias("_passes"), F.col("more").alias("_more"))
    names = docs.columns
    joined = docs.select(*names, *same(F.xxhash64("text"))).join(took, key)
    # only where some of several equal rows are taken once more does a row's number matter
    row = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(*names)))
    part = (F.col("_more") > 0) & (F.col("_more") < F.col("_n"))
    one = joined.where(~part).withColumn("_times", F.col("_passes") + (F.col("_more") > 0).cast("int"))
    some = joined.where(part).withColumn("_row", row).withColumn("_times", F.col("_passes") + (F.col("_row") <= F.col("_more")).cast("int"))
    times = lambda d: d.where("_times > 0").select(*names, F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("copy"))
    return times(one).unionByName(times(some))


STAGES = [
    ("language_id", known_language),
    ("near_copies", one_of_each_group),
    ("decontamination", no_benchmark_passages),
    ("secrets", no_secrets),
    ("mixing", mixed_sources),
]

#: The first stage is a trained model, so no SQL stands for the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if read is not None:
            discard(read)  # what this stage has read
        read = docs
    return STAGES[-1][1](spark, docs, sf_dir)
