from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scriptorium.sources import files as S
from scriptorium.streaming import restart, windows


def test_restartable_upsert(spark, tmp_path):
    schema = StructType().add("k", "integer").add("v", "string")
    src, to, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    spark.createDataFrame([(1, "a"), (2, "b")], schema).coalesce(1).write.parquet(src)
    assert restart.load_new_files(spark, src, schema, to, ["k"], ck) == 1
    spark.createDataFrame([(2, "B"), (3, "c")], schema).coalesce(1).write.mode("append").parquet(src)
    assert restart.load_new_files(spark, src, schema, to, ["k"], ck) == 1
    assert restart.load_new_files(spark, src, schema, to, ["k"], ck) == 0
    assert sorted(map(tuple, restart.merged(spark, to, schema, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "c")]
    assert spark.read.parquet(restart.compact(spark, to, schema, ["k"], str(tmp_path / "whole"))).count() == 3


def test_stream_and_table_windows_agree(spark, sf, tmp_path):
    e = spark.read.parquet(f"{sf}/events.parquet")
    e.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "e"))
    st = windows.counted(spark.readStream.schema(e.schema).parquet(str(tmp_path / "e")))
    q = st.writeStream.format("memory").queryName("w").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("w").collect())) == sorted(map(tuple, windows.counted(e).collect()))


def test_csv_and_listing(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    (d / "a_toc.csv").write_text("level,label\n1,One\nx,Bad\n")
    (d / "toc_b.csv").write_text("level,label\n2,Two\n")
    (d / "other.csv").write_text("level,label\n3,No\n")
    schema = StructType().add("level", "integer").add("label", "string")
    got = S.toc_files(spark, str(d), schema)
    assert sorted((r.level or 0, r.label) for r in got.collect()) == [(0, "Bad"), (1, "One"), (2, "Two")] and sum(r._bad is not None for r in got.collect()) == 1
    assert S.listing(spark, str(d), "*.csv").count() == 3


def test_pairs_and_merge(spark):
    p = lambda *x: spark.createDataFrame([(v,) for v in x], "path string")
    assert [r.number for r in S.pairs_by_number(p("/in/01a.csv", "/in/x.csv"), p("/f/01b.csv", "/f/02.csv")).collect()] == ["01"]
    raw = spark.createDataFrame([("1", "w", "a"), ("2", "w", "b")], "number string, word string, raw string")
    fix = spark.createDataFrame([("1", "w", "A"), ("2", "z", "Z")], "number string, word string, fix string")
    assert sorted((r.word, r.number, r.raw, r.fix) for r in S.merge_pairs(raw, fix).collect()) == [("w", "1", "a", "A"), ("z", "2", None, "Z")]
    assert spark.range(1).select(S.metadata_dates(F.lit("D:20240102030405")).cast("string").alias("t"), S.metadata_dates(F.lit("bad")).alias("u")).first()[:] == ("2024-01-02 03:04:05", None)
