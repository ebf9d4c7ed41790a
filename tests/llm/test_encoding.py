import pytest

from scriptorium.llm import encoding as E

GOOD = ["kāliya dhṛti ṣaṭ", "käma sädhu dåñöi", "él niño – “señor”", "Ñ ®o √D ∂a µ SÃO £4 ½"]


def through(s, *readers):
    for r in readers:
        s = "".join(bytes([b]).decode(r, "replace").replace("�", chr(b)) for b in s.encode("utf-8"))
    return s


@pytest.mark.parametrize("reader", ["cp1252", "latin-1", "mac_roman", "cp437", "cp1251"])
@pytest.mark.parametrize("s", ["ā", "ṛṣ", "é", "“ñ”", "ä"])
def test_readings_round_trip(reader, s):
    assert s in [b for _, b in E.readings(through(s, reader))]
    if reader in ("cp1252", "latin-1"):
        assert s in [b for _, b in E.readings(through(s, reader, reader))]


def rows(spark, texts):
    return spark.createDataFrame([("t", i, 0, s, "page", t) for i, (s, t) in enumerate(texts)], "src_table string, row_id long, ts long, source long, field string, text string")


def test_find_and_repair(spark):
    texts = [(1, g) for g in GOOD] * 12 + [(2, GOOD[0])] * 3
    bad = [(2, through(GOOD[0], "cp1252")), (2, "a " + through("ā", "latin-1")), (3, through("käma sädhu", "cp437")), (3, through("ṛṣi", "cp1252", "cp1252")), (4, "k�ma"), (5, "käma sädhu".encode("cp1252").decode("cp1251")), (2, through("dhṛti", "cp1252").replace("\x9d", "")), (None, through("él", "mac_roman"))]
    df = rows(spark, texts + bad + [(1, None), (1, ""), (None, "ascii"), (1, "шритика гуждева"), (1, "é" * 20_000)])
    wrong = E.wrong_runs(E.scan(df))
    ids = {r.row_id for r in wrong.collect()}
    assert ids == set(range(len(texts), len(texts) + len(bad)))
    done = {r.row_id: r.repaired for r in E.repair(df, wrong).collect()}
    n = len(texts)
    assert done[n] == GOOD[0] and done[n + 1] == "a ā" and done[n + 2] == "käma sädhu" and done[n + 3] == "ṛṣi" and done[n + 5] == "käma sädhu" and done[n + 7] == "él"


def test_empty(spark):
    assert E.wrong_runs(E.scan(rows(spark, [(1, "x")]).limit(0))).count() == 0


def test_long_runs_are_judged_whole(spark):
    """Damaged text without a space, far longer than any buffer and not cut at a sequence."""
    long = "ṛṣiśāṁñḥ" * 90
    texts = [(1, g) for g in GOOD] * 12 + [(2, GOOD[0])] * 3
    bad = [(2, through(long, "latin-1")), (2, "x " + through(long + "ā", "cp1252") + " y")]
    df = rows(spark, texts + bad)
    wrong = E.wrong_runs(E.scan(df))
    n = len(texts)
    assert {r.row_id for r in wrong.collect()} == {n, n + 1}
    done = {r.row_id: r.repaired for r in E.repair(df, wrong).collect()}
    assert done[n] == long and done[n + 1] == "x " + long + "ā y"


def test_a_source_of_any_size_is_a_few_signatures(spark):
    """The EM meets signatures, not runs: a hot source brings a bounded number of rows."""
    e = E._Evidence({"ā": 0.5, "é": 0.5})
    runs = [through("ā" * (1 + i % 3) + "é" * (i % 4), "cp1252") for i in range(500)]
    assert len({e.signature(r) for r in runs}) <= len(set(runs)) <= 12
    df = rows(spark, [(1, GOOD[0])] * 20 + [(1, through("ā", "cp1252") + " b")] * 300 + [(2, "Ã")])
    assert len({r.row_id for r in E.wrong_runs(E.scan(df)).collect()}) >= 300
