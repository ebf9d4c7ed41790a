from datetime import datetime as D

from scriptorium.operators import references as R


def rows(df):
    return sorted((r.row_id, r.kind) for r in df.collect())


def test_orphans_edges(spark):
    refs = spark.createDataFrame(
        [(1, D(2024, 1, 5), 1, "a", "x"), (2, D(2024, 1, 5), 1, "late", "x"), (3, D(2024, 1, 5), 1, "gone", "x"), (4, D(2024, 1, 5), None, "a", "x"), (5, None, 1, "a", "x"), (6, D(2024, 3, 1), 1, "late", "x"), (6, D(2024, 3, 1), 1, "late", "x"), (7, D(2024, 1, 20), 1, "late", "x"), (8, D(2024, 1, 1), 2, "a", "x")],
        "row_id long, ts timestamp, k1 long, k2 string, kind2 string",
    )
    parents = spark.createDataFrame(
        [(1, "a", D(2023, 1, 1), True), (1, "a", D(2025, 1, 1), True), (1, "late", D(2024, 1, 20), True), (1, "gone", D(2023, 1, 1), False), (None, "a", D(2020, 1, 1), True), (2, "a", None, True)],
        "k1 long, k2 string, ts timestamp, live boolean",
    )
    assert rows(R.orphans(refs, parents, ["k1", "k2"], ranges=3, salts=2)) == [(2, "late"), (3, "deleted"), (4, "missing"), (5, "late"), (8, "deleted")]


def test_orphans_empty(spark):
    refs = spark.createDataFrame([(1, D(2024, 1, 5), 1)], "row_id long, ts timestamp, k1 long")
    parents = spark.createDataFrame([], "k1 long, ts timestamp, live boolean")
    assert rows(R.orphans(refs, parents, ["k1"])) == [(1, "missing")]
    assert rows(R.orphans(refs.limit(0), parents, ["k1"])) == []


def test_hot_key(spark):
    refs = spark.range(3000).selectExpr("id as row_id", "timestamp'2024-01-05' as ts", "if(id % 3 = 0, 7, id) as k1")
    parents = spark.range(0, 3000, 2).selectExpr("id as k1", "timestamp'2024-01-01' as ts", "true as live")
    want = sorted(i for i in range(3000) if (7 if i % 3 == 0 else i) % 2)
    assert [x for x, _ in rows(R.orphans(refs, parents, ["k1"]))] == want


def test_labels(spark):
    got = spark.createDataFrame([("  Xi ",), ("",), (None,)], "l string").select(R.trimmed_label(__import__("pyspark.sql.functions", fromlist=["col"]).col("l")).alias("l")).collect()
    assert [r.l for r in got] == ["xi", "", None]


def test_other_columns(spark):
    refs = spark.createDataFrame([(1, D(2024, 1, 5), 1, "x", False)], "row_id long, ts timestamp, k1 long, kind string, live boolean")
    parents = spark.createDataFrame([(2, D(2023, 1, 1), True, "y", 5)], "k1 long, ts timestamp, live boolean, kind string, row_id long")
    got = R.orphans(refs, parents, ["k1"])
    assert got.columns.count("kind") == 1 and rows(got) == [(1, "missing")]
