from collections import defaultdict

from scriptorium.llm import frequency as F2


def test_postings_edges_and_union(spark):
    rows = [("a", 0, 1, 1), ("a", 0, 1, 1), ("a", 1, 1, None), ("a", 0, 200, 5), ("b", 0, None, 1), ("", 0, 3, 1), ("  ", 0, 4, 1), (None, 0, 5, 1), ("c", 0, -3, 1)]
    df = spark.createDataFrame(rows, "term string, space int, id long, occurrences long")
    got = {r.term: (r.occurrences, r.records) for r in F2.frequencies(F2.postings(df)).collect()}
    assert got == {"a": (8, 3), "b": (1, 1), "c": (1, 1)}
    half = F2.postings(df.where("id = 1")), F2.postings(df.where("id is null or id <> 1"))
    assert {r.term: (r.occurrences, r.records) for r in F2.frequencies(F2.union(*half)).collect()} == got
    m = {r.term: (r.rare, r.common) for r in F2.marked(F2.frequencies(F2.postings(df)), 9, 0.3).collect()}
    assert m == {"a": (False, True), "b": (True, False), "c": (True, False)}
    assert F2.frequencies(F2.postings(df.limit(0))).count() == 0


def test_hot_term(spark):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', concat('t', id % 97)) as term", "0 as space", "id", "1L as occurrences")
    want = defaultdict(int)
    for i in range(30_000):
        want["hot" if i % 3 == 0 else f"t{i % 97}"] += 1
    assert {r.term: r.records for r in F2.frequencies(F2.postings(df)).collect()} == dict(want)
