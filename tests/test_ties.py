"""Ties and decimal angles: what must not depend on the order of rows, tasks or sums; joins that must not multiply."""

import threading
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from orrery.operators import catalog as C
from orrery.operators import windows as W
from orrery.plans import registry


def test_mean_angle_on_half_a_digit(spark, tmp_path):
    # a user whose mean is 358.13875 exactly: sums of doubles fall a bit below
    ids = [681, 8084, 8207, 9329, 10261, 11684, 12737, 13085, 13715, 13731, 14948, 17322, 17750, 20634, 20949, 23434, 26832, 26874, 30354, 30610, 31257, 32649, 32759, 35354, 37179, 37623, 41722, 43188, 44336, 45121, 46214, 49131, 49859, 50524, 51253, 51674, 53078, 53224, 54128, 55407, 55902, 59194, 59957, 61577, 62938, 63564, 64729, 67225, 68012, 68051, 70917, 71272, 74473, 78356, 83045, 86115, 86253, 89711, 91951, 93719, 95105, 96693, 98769, 99195]
    spark.createDataFrame([(i, 14, 1.0) for i in ids], "event_id long, user_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = registry.QUERIES["a32_a34_a35_rebin"](spark, str(tmp_path)).where("op = 'mean'").first()["v"]
    c = duckdb.connect()
    c.execute(f"create view events as from '{tmp_path}/events.parquet/*.parquet'")
    want = c.sql(f"select v from ({registry.ORACLE_SQL['a32_a34_a35_rebin']}) where op = 'mean'").fetchall()[0][0]
    assert got == want == 358.1388


def test_pairs_of_tied_lines_take_the_first_of_the_file(spark, tmp_path):
    # each order has lines of one number in two files; Spark reads the larger file, the second one, first
    n = 300
    c = duckdb.connect()
    (tmp_path / "lineitem.parquet").mkdir()
    for p, times in ((0, 1), (1, 20)):
        c.execute(f"copy (select k AS l_orderkey, 1 AS l_linenumber, (p*1000+x)::DOUBLE AS l_quantity, (p*1000+x)::DOUBLE AS l_tax, f AS l_returnflag from range({p}, {p + 1}) a(p), range({times}) d(x), range({n}) b(k), (values ('R'), ('A')) e(f) order by x, k, f) to '{tmp_path}/lineitem.parquet/part-{p}.parquet'")
    got = registry.QUERIES["j4_pair_by_key"](spark, str(tmp_path))
    assert got.columns == ["k", "a_n", "a_v", "b_n", "b_v"]
    assert {tuple(x) for x in got.collect()} == {(k, 1, 0.0, 1, 0.0) for k in range(n)}


@pytest.mark.parametrize("ids", [[5, 3, 9], [9, 5, 3]])
def test_daily_measurement_of_equal_times(spark, ids):
    d = spark.createDataFrame([(i, "2024-01-01 20:00:01", 1.0) for i in ids], "event_id long, ts string, value double").repartition(1)
    d = d.withColumn("ts", F.col("ts").cast("timestamp"))
    assert [x["event_id"] for x in W.one_per_day(d, "ts", "value", ties=["event_id"]).collect()] == [3]


def test_equal_angles_are_numbered_by_event(spark):
    # 360,000 events later the angle is the same; doubles differ in their last digits
    ids = [e + more for e in range(40) for more in (0, 360_000, 720_000)]
    d = spark.createDataFrame([(1, i) for i in ids], "user_id long, event_id long").withColumn("angle", F.col("event_id") * F.lit(Decimal("7.013")))
    got = [x["event_id"] for x in W.rotate_origin(d, ["user_id"], "angle", F.lit(100), ["event_id"]).orderBy("bin").collect()]
    assert got == sorted(ids, key=lambda e: ((7013 * e - 100_000) % 360_000, e))


def test_many_lines_of_one_rotation(spark):
    # 200,000 lines name the rotation of 100,000 pointings: asked for once, not 20,000,000,000 times
    lines = spark.range(200_000).select(F.lit("l3_map cr5, repoint7").alias("target"), F.lit(None).cast("date").alias("ignore_after"))
    repoints = spark.range(100_000).select("id", F.lit(140).alias("day"))
    late = threading.Timer(100, spark.sparkContext.cancelAllJobs)
    late.start()
    try:
        assert C.forced_targets(lines, F.lit("2001-01-01").cast("date"), repoints, 27.0, ["l3_map"]).count() == 100_000
    finally:
        late.cancel()


def test_density_scale_computes_each_step_once(spark, sf_dir):
    # two sides, each with one error function and one exponential of its own; nothing is repeated by nesting
    plan = registry.QUERIES["m25_m26_moments"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.upper().count("EXP(") <= 8 and 0 < plan.upper().count("SQRT(") <= 8
