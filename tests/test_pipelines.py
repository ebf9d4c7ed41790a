import io
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scriptorium import __main__ as cli
from scriptorium import api
from scriptorium.functions import text as T
from scriptorium.operators import layout as L
from scriptorium.operators import parsers as A
from scriptorium.operators import pipelines as J
from scriptorium.operators import reports as R
from scriptorium.operators import store as M
from scriptorium.operators import vectors as V
from scriptorium.sources import documents as D
from scriptorium.sources import files as S
from scriptorium.sources import sheets


def test_sections_run_over_pages(spark):
    """An entry that goes on on the next page is one entry."""
    c = spark.createDataFrame([(1, 4, "kåla – time that moves\nwithout"), (1, 5, "an end.\nrasa – taste."), (1, 6, None), (1, 9, "dharma – duty."), (2, 4, "x – y.")], "book_id int, page_number int, page_content string")
    b = spark.createDataFrame([(1, "[4,7)", "[9,9]"), (2, None, "bad")], "book_id int, glossary_pages string, verse_pages string")
    assert [(r.book_id, r.term, r.description, r.entry_order) for r in J.book_glossaries(c, b).orderBy("entry_order").collect()] == [(1, "kåla", "time that moves without an end.", 1), (1, "rasa", "taste.", 2)]
    v = spark.createDataFrame([(1, 9, "padma 1.2 . . . . 12,\n.... 13\nyad yad ....... 7")], "book_id int, page_number int, page_content string")
    assert sorted(map(tuple, J.book_verses(v, b).collect())) == [(1, "padma 1.2", 12), (1, "padma 1.2", 13), (1, "yad yad", 7)]
    assert J.book_glossaries(c.limit(0), b).count() == 0


@pytest.mark.parametrize(
    "lines,want",
    [
        ("a ..... 5", [("a", 5)]),
        ("a  5, 6", [("a", 5), ("a", 6)]),
        ("a ... 5,\n.. 7", [("a", 5), ("a", 7)]),
        ("ab\n.... 3", [("ab", 3)]),
        ("a ... 5,\nb ... 6", [("b", 6)]),
        ("a ... 5,", [("a", 5)]),
        ("Verse Index\nA\n12", []),
        ("12 ... 4\nrasa 2.3 ... 4", [("rasa 2.3", 4)]),
        ("", []),
    ],
)
def test_verse_lines(lines, want):
    assert A.parse_verses(lines) == want


def test_reports(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (2, "c"), (4, "d"), (None, "e"), (3, None)], "k int, v string")
    assert tuple(R.run_counters(old, new, ["k"]).first()) == (1, 1, 2, 1)
    rows = spark.createDataFrame([("a", "a"), ("åb", "ṛb"), ("c", None), (None, None)], "old string, new string")
    assert R.change_counters(rows, "old", "new", {"with_a": "å"}).first().asDict() == {"total": 4, "changed": 1, "unchanged": 2, "failed": 1, "with_a": 1}
    assert tuple(R.outcome(rows, F.col("new").isNotNull()).first()) == (4, 2, 2)
    assert R.breakdown(rows.limit(0), ["old"]).count() == 0


def test_last_row_wins_and_append(spark):
    old = spark.createDataFrame([(1, "a", "x")], "k int, v string, w string")
    new = spark.createDataFrame([(1, "b", 2), (1, "c", 1), (2, "d", 1)], "k int, v string, at int")
    got = {r.k: (r.v, r.w) for r in M.upsert(old, new, ["k"], "at").collect()}
    assert got == {1: ("b", "x"), 2: ("d", None)}
    assert {r.k: r.v for r in M.upsert(old, new.coalesce(1), ["k"]).collect()}[1] == "c"
    assert M.append(old.select("k", "v"), spark.createDataFrame([(3, "z")], "k int, v string"), ["k"]).count() == 2
    with pytest.raises(ValueError):
        M.append(old.select("k", "v"), spark.createDataFrame([(1, "z")], "k int, v string"), ["k"])


def test_quantiles_of_a_hot_key(spark):
    import numpy as np

    r = np.random.default_rng(1)
    rows = [("hot", float(round(x, 2))) for x in r.normal(size=900)] + [("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {x.k: x for x in L.robust(df, "k", "v").collect()}
    v = np.array([b for a, b in rows if a == "hot"])
    assert abs(got["hot"].median - np.median(v)) < 1e-9 and abs(got["hot"].p05 - np.quantile(v, 0.05)) < 1e-9 and abs(got["hot"].mad - np.median(abs(v - np.median(v)))) < 1e-9
    assert (got["two"].median, got["one"].mad, got["hot"].n) == (1.5, 0.0, 900) and "none" not in got


def test_block_mode_and_rectangles(spark):
    b = spark.createDataFrame([(1, 0, "top", 0.0, 10.0, 100.0), (1, 2, "b ", 50.0, 60.0, 100.0), (1, 1, "a", 50.0, 55.0, 100.0), (1, 3, "foot", 80.0, 99.0, 100.0), (1, 4, " ", 60.0, 61.0, 100.0)], "page_id int, block_no int, text string, y0 double, y1 double, page_h double")
    assert L.body_blocks(b, F.lit(20.0), F.lit(90.0)).first().text == "a\nb"
    p = spark.createDataFrame([(1, 100.0, 10.0, 90.0), (2, 100.0, 10.0, 5.0), (3, 100.0, 97.0, 5.0), (4, 100.0, None, None)], "page_id int, page_h double, header double, footer double")
    assert [(r.top, r.bottom) for r in L.content_rect(p).orderBy("page_id").collect()] == [(10.0, 90.0), (10.0, 95.0), (0.0, 100.0), (0.0, 100.0)]
    m = spark.createDataFrame([(1, 90, 1.0), (2, 0, -1.0), (3, 180, 1.0), (4, None, None)], "page_id int, rotation int, flip double")
    assert [r.mode for r in L.block_mode(m).orderBy("page_id").collect()] == ["blocks", "blocks", "clip", "clip"]


def test_vectors_in_blocks(spark):
    import numpy as np

    x = np.random.default_rng(2).normal(size=(300, 8))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 9)
    np.fill_diagonal(s, -9)
    q = df.where("vec_id % 50 = 0")
    for block in (4096, 2):
        got = {(r.vec_id, r.place): r.neighbour for r in V.top_k_all(df, q, 4, block=block).collect()}
        assert got == {(i, k + 1): j for i in range(0, 300, 50) for k, j in enumerate(np.lexsort((np.arange(300), -s[i]))[:4])}
    assert V.top_k_all(df, q.limit(0), 4).count() == 0


def test_summary_cleaning(spark):
    df = spark.createDataFrame([("  a \t b\n\n\n\n c  \n ",), (None,), ("",), ("\n\n",)], "x string")
    assert [r[0] for r in df.select(T.clean_summary(F.col("x"))).collect()] == ["a b\n\nc", "", "", ""]
    assert T.default_name("report", {"glyph": "ä", "font": None}, "20250101") == "report_glyph_ä_20250101.csv"


def workbook(rows):
    cells = "".join(f'<row r="{i}">' + "".join(f'<c r="{chr(65 + j)}{i}" t="inlineStr"><is><t>{v}</t></is></c>' for j, v in enumerate(r) if v) + "</row>" for i, r in enumerate(rows, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{cells}</sheetData></worksheet>')
    return out.getvalue()


def test_documents(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook([("pdf_name", "title"), ("x.pdf", "X"), ("", ""), ("", "no name"), ("y.pdf", "")]))
    (tmp_path / "b.xlsx").write_bytes(b"no workbook")
    kind = StructType().add("pdf_name", "string").add("title", "string")
    got = D.parsed(D.files(spark, str(tmp_path), "*.xlsx"), lambda b: D.sheet_rows(b, required="pdf_name"), kind).collect()
    assert sorted((r.status, r.pdf_name, r.title) for r in got if r.status == "success") == [("success", "x.pdf", "X"), ("success", "y.pdf", None)]
    assert [r.error is not None for r in got if r.status == "error"] == [True]
    (tmp_path / "c.pdf").write_bytes(b"%PDF-1.4 /Title (The \\(Sea\\)) /CreationDate (D:20240102030405Z)")
    (tmp_path / "d.pdf").write_bytes(b"none")
    info = D.metadata(D.files(spark, str(tmp_path)), D.pdf_info, ["Title", "CreationDate"])
    assert {r.file_name: (r.status, r.Title) for r in info.collect()} == {"c.pdf": ("success", "The (Sea)"), "d.pdf": ("error", None)}
    assert tuple(D.summary(info).first()) == (2, 1, 1)
    assert [r.t for r in info.select(S.metadata_date_text(F.col("CreationDate")).alias("t")).collect() if r.t] == ["2024-01-02 03:04:05"]
    tasks = spark.createDataFrame([("a", 1, "t1"), ("a", 2, "t2"), ("b", 1, "t3")], "pdf_name string, page_number int, target string")
    done = D.rendered(tasks, lambda n, p: bytes([p]) if n == "a" else 1 / 0, spark.createDataFrame([("t1",)], "path string")).collect()
    assert sorted((r.target, r.status[:7]) for r in done) == [("t2", "success"), ("t3", "error: ")]
    texts = spark.createDataFrame([(1, "a"), (2, None), (3, "bb")], "k int, x string")
    assert {r.k: r.result for r in D.called(texts, "k", "x", lambda t: [len(v) for v in t], "int").collect()} == {1: 1, 2: None, 3: 2}
    assert all(r.result is None for r in D.called(texts, "k", "x", lambda t: 1 / 0, "int").collect())


def test_sheets(spark, tmp_path):
    (tmp_path / "s.csv").write_text('Books - Sheet1\nBook Id,Book Summary\n1,"One  summary"\nx,Bad\n,None\n3,\n')
    assert sorted((r.book_id or 0, r.value, r.outcome) for r in sheets.summaries(spark, str(tmp_path / "s.csv")).collect()) == [(0, "Bad", "error"), (0, "None", "skipped"), (1, "One summary", "update"), (3, "", "skipped")]
    (tmp_path / "t.csv").write_text("Book ID,The book title\n7, Sea \n")
    assert [tuple(r) for r in sheets.titles(spark, str(tmp_path / "t.csv")).collect()] == [(7, "Sea", "update")]
    with pytest.raises(ValueError):
        sheets.titles(spark, str(tmp_path / "s.csv"))
    assert sheets.round_trip(spark, str(tmp_path / "tabs"))


def test_connection(spark):
    assert S.connection({"DATABASE_URL": "postgresql://u:p%40x@h:6/db"}) == {"url": "jdbc:postgresql://h:6/db", "user": "u", "password": "p@x"}
    assert S.connection({"DB_NAME": "d"}) == {"url": "jdbc:postgresql://localhost:5432/d"}
    with pytest.raises(ValueError):
        S.connection({})
    assert S.reachable(spark) and not S.reachable(spark, url="jdbc:none")


def test_names_and_command_line(spark, sf, capsys, tmp_path):
    api.register_views(spark, sf)
    api.register_functions(spark)
    assert spark.sql("select page_label(' ', 4) a, clean_value('  ') b, code_point('ā') c, description_complete('x.') d").first()[:] == ("4", None, "U+0101", True)
    assert spark.sql("select count(*) from content").first()[0] > 0
    assert cli.main([]) == 0 and "content_search" in capsys.readouterr().out
    assert cli.main(["nothing"]) == 2
    assert cli.main(["book_listing", "--data", sf, "--book-id", "41", "--out", str(tmp_path / "o"), "--format", "csv"]) == 0
    assert spark.read.csv(str(tmp_path / "o"), header=True).count() == 1
    assert cli.main(["book_listing", "--data", sf, "--dry-run"]) == 0


def test_import_sequences(spark):
    files = spark.createDataFrame([("a.pdf", 2), ("b.pdf", 1), ("old.pdf", 9)], "pdf_name string, number_of_pages int")
    books = spark.createDataFrame([(5, "old.pdf", 9)], "book_id int, pdf_name string, number_of_pages int")
    labels = spark.createDataFrame([("a.pdf", 1, " "), ("a.pdf", 2, "ii")], "pdf_name string, page_number int, page_label string")
    marks = spark.createDataFrame([("b.pdf", 1, " One ", 1, 0)], "pdf_name string, toc_level int, toc_label string, page_number int, place int")
    first = J.import_first(files, books, labels, marks)
    assert sorted((r.book_id, r.pdf_name) for r in first["book"].collect()) == [(6, "a.pdf"), (7, "b.pdf")]
    assert sorted((r.book_id, r.page_number, r.page_label) for r in first["page_map"].collect()) == [(6, 1, "1"), (6, 2, "ii")]
    assert first["render"].count() == 3 and first["bookmarks"].first().toc_label == "One"
    toc = spark.createDataFrame([(1, 5, 1, "Old", "1", None, None)], "toc_id long, book_id int, toc_level int, toc_label string, page_label_raw string, page_number int, parent_toc_id long")
    sheet = spark.createDataFrame([(5, 0, 1, "New", "1"), (5, 1, 2, "Sub", "2")], "book_id int, place int, toc_level int, toc_label string, page_label_raw string")
    got = J.import_second(books, labels.selectExpr("5 as book_id", "page_number", "page_label"), toc, {"toc": sheet})["toc"]
    assert [(r.toc_id, r.toc_label, r.parent_toc_id) for r in got.orderBy("toc_id").collect()] == [(2, "New", None), (3, "Sub", 2)]
