"""Readers, writers and streams, round trips in a temporary folder."""

import datetime as dt

from pyspark.sql import functions as F

from orrery.sources import tables as S
from orrery.streaming import streams


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("# note\n1,2.5,x\n2,,y\n")
    d = S.read_lookup_csv(spark, str(tmp_path / "a.csv"), "i int, v double, s string")
    assert [tuple(r) for r in d.collect()] == [(1, 2.5, "x"), (2, None, "y")]
    d = S.read_lookup_csv(spark, str(tmp_path / "a.csv"), "s string, i int", columns=[2, 0])
    assert [tuple(r) for r in d.collect()] == [("x", 1), ("y", 2)]
    (tmp_path / "m.csv").write_text("1,2\n3,4\n")
    assert sorted((r.line, r.column, r.value) for r in S.read_lookup_matrix(spark, str(tmp_path / "m.csv"), 2).collect()) == [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)]
    (tmp_path / "b.dat").write_text("# head\n  2024  12   3.5 z\n2025 1 bad q\n\n")
    d = S.read_table_dat(spark, str(tmp_path / "b.dat"), {"y": (0, "int"), "v": (2, "double")})
    assert [tuple(r) for r in d.collect()] == [(2024, 3.5), (2025, None)]
    (tmp_path / "c.json").write_text('{"grid": [1.5, 2.5],\n "limits": {"low": 3}}')
    s = S.read_settings_json(spark, str(tmp_path / "c.json"), "grid array<double>, limits struct<low:int>")
    assert s.first().limits.low == 3 and [tuple(r) for r in S.settings_grid(s, "grid", "x").collect()] == [(0, 1.5), (1, 2.5)]


def test_missing_values_and_products(spark, tmp_path):
    d = spark.createDataFrame([(1, -1e31, 5.0, "a"), (2, 2.0, 50.0, "b")], "id int, v double, w double, s string")
    n = S.null_out_of_range(S.null_fill(d, {"v": -1e31, "s": 0}), {"w": (0.0, 10.0)})
    assert [tuple(r) for r in n.orderBy("id").collect()] == [(1, None, 5.0, "a"), (2, 2.0, None, "b")]
    out = str(tmp_path / "sky_x_map-a_20240102-repoint00012_v003.parquet")
    S.write_product(n, out, "id smallint, v float", {"v": -1e31})
    back = S.read_partitioned_by_name(spark, out).orderBy("id")
    assert [r.v for r in back.collect()] == [float(spark.range(1).select(F.lit(-1e31).cast("float")).first()[0]), 2.0]
    S.write_product(n, str(tmp_path / "p"), "id smallint, v float, s string", partition=["s"])
    assert spark.read.parquet(str(tmp_path / "p")).where("s = 'a'").count() == 1
    parents = spark.createDataFrame([("f1", "science"), ("f1", "science"), ("k1", "ancillary")], "file string, kind string").withColumn("d", F.lit(dt.date(2024, 1, 1)))
    a = S.product_attributes("prod", parents, "L3", F.col("d"), F.col("d"))
    r = a.first()
    assert r.science == ["f1"] and r.ancillary == ["k1"] and S.lineage_rows(a).count() == 2
    parts = spark.range(1).select(*S.named_parts(F.lit("sky_hi_map-a_20240102-repoint00012_v003.cdf"))).first()
    assert (parts.descriptor, parts.start_date, parts.repointing, parts.version) == ("map-a", dt.date(2024, 1, 2), 12, 3)


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(minutes=m), float(m)) for m in (0, 30, 59, 60, 600)]
    spark.createDataFrame(rows, "ts timestamp, value double").write.parquet(str(src))
    st = spark.readStream.schema("ts timestamp, value double").parquet(str(src))
    q = streams.stream_interval_mean(st, "ts", "value").writeStream.format("memory").queryName("means").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r.start: r["mean"] for r in spark.sql("select * from means").collect()}
    assert got == {base: (0 + 30 + 59) / 3, base + dt.timedelta(hours=1): 60.0}


def test_latest_version_stream(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    w = lambda r: spark.createDataFrame(r, "k int, v int, s string").coalesce(1).write.mode("append").parquet(str(src))
    st = lambda: spark.readStream.schema("k int, v int, s string").parquet(str(src))
    table = streams.LatestTable(str(out), ["k"], "v", ["k", "v", "s"], 8)
    want, written = {}, []
    batches = [[(k, 1, f"a{k}") for k in range(40)], [(1, 2, "c"), (2, 0, "old")], [(1, 3, "d")], [(99, 1, "new"), (5, 9, "e"), (5, 8, "less")]]
    for n, rows in enumerate(batches):
        w(rows)
        q = streams.stream_latest_version(st(), str(out), str(tmp_path / "check"), ["k"], "v", 8)
        q.processAllAvailable()
        q.stop()
        for k, v, x in rows:
            want[k] = max(want.get(k, (v, x)), (v, x))
        assert {r.k: (r.v, r.s) for r in table.read(spark, n).collect()} == want
        written.append(len([p for p in (out / "data" / str(n)).iterdir() if p.name.startswith("part=")]))
    # a batch writes the parts that it touches; what no list names any more is gone
    assert written[0] == 8 and written[1] <= 2 and written[2] == 1 and written[3] <= 2
    assert not table.held(spark, 0) and len(table.held(spark, 3)) == 8
    left = {(int(b.name), int(p.name[5:])) for b in (out / "data").iterdir() for p in b.iterdir() if p.name.startswith("part=")}
    assert left == {(b, p) for n in (2, 3) for p, b in table.held(spark, n).items()}
    table.merge(spark.createDataFrame(batches[3], "k int, v int, s string"), 3)  # a replayed batch
    assert {r.k: (r.v, r.s) for r in table.read(spark, 3).collect()} == want


def test_stream_without_replays(spark, tmp_path):
    src = tmp_path / "in"
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(minutes=m), k) for m, k in ((0, 1), (1, 1), (2, 2), (3, 1), (4, 3))]
    spark.createDataFrame(rows, "ts timestamp, k int").write.parquet(str(src))
    st = spark.readStream.schema("ts timestamp, k int").parquet(str(src))
    q = streams.without_replays(st, "ts", ["k"]).writeStream.format("memory").queryName("once").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.k for r in spark.sql("select k from once").collect()) == [1, 2, 3]
