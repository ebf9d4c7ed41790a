"""Page types, layout, parsers and table changes, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contents as C
from ..operators import layout as L
from ..operators import pages as P
from ..operators import parsers as X
from ..operators import store as M
from ..tables import load
from . import library, texts
from . import views as V
from .views import BASE


def _core(s, d):
    return C.core_range(C.effective_start(V.toc(s, d), V.page_map(s, d)), V.page_map(s, d))


def _types(s, d):
    return P.classify(V.content(s, d), _core(s, d), V.book(s, d).select("book_id", "toc_pages"))


def _blocks(s, d):
    """Line items laid out as blocks of pages."""
    return load(s, d, "lineitem").select(F.col("l_orderkey").alias("page_id"), F.col("l_linenumber").cast("int").alias("block_no"), F.col("l_quantity").alias("x0"), (F.col("l_extendedprice") % 700).alias("y0"))


def _images(s, d):
    b = _blocks(s, d)
    return b.select("page_id", "x0", "y0", (F.col("x0") + 20).alias("x1"), (F.col("y0") + 300).alias("y1"))


def _norms(s, d):
    li = load(s, d, "lineitem")
    return li.select((F.col("l_suppkey") % 20).cast("int").alias("book_id"), (F.col("l_discount") / 2).alias("header_norm"), (1 - F.col("l_tax")).alias("footer_norm"))


def _spans(s, d):
    """Words of the pages as spans of lines."""
    c = V.content(s, d).where("page_content is not null")
    line = c.select(F.col("content_id").alias("page_id"), F.posexplode(F.split("page_content", "\n")).alias("line_no", "line"))
    return line.select("page_id", "line_no", F.lit(0).alias("span_no"), F.col("line").alias("text"), (F.col("line_no") * 12.0).alias("y0"), F.lit(600.0).alias("page_h"), F.lit("Serif").alias("font"))


def _new_glossary(s, d):
    g = V.glossary(s, d)
    return g.where("description is null").select("book_id", "term", F.concat(F.lit("new "), "term").alias("description")).unionByName(g.where("book_id = 41").select((F.col("book_id") + 1000).alias("book_id"), "term", "description")).groupBy("book_id", "term").agg(F.max("description").alias("description"))


def _old_glossary(s, d):
    return V.glossary(s, d).groupBy("book_id", "term").agg(F.max("description").alias("description"))


def _pages(s, d, rest):
    return V.page_map(s, d).where(f"page_number % 2 = {rest}").select("book_id", ((F.col("page_number") + 1) / 2).cast("int").alias("page"), F.lit(rest).alias("scan"))


QUERIES = {
    "page_types": _types,
    "page_type_counts": lambda s, d: P.breakdown(_types(s, d)),
    "page_type_changes": lambda s, d: P.changes(_types(s, d), V.page_map(s, d), V.book(s, d), "Core"),
    "quadrant_counts": lambda s, d: L.quadrants(_blocks(s, d), 50.0, 700.0),
    "two_columns": lambda s, d: L.columns(_blocks(s, d), 50.0),
    "image_pages": lambda s, d: L.image_coverage(_images(s, d), (0.0, 0.0, 50.0, 700.0)).withColumn("image_page", P.image_page(F.col("coverage"), F.col("largest"), F.col("images"))),
    "reading_order": lambda s, d: L.reading_order(_blocks(s, d)).select("page_id", "block_no", F.col("place").cast("long").alias("place")),
    "region_body": lambda s, d: L.region(_spans(s, d), "body", F.lit(24.0), F.lit(240.0)),
    "region_header": lambda s, d: L.region(_spans(s, d), "header", F.lit(24.0), F.lit(240.0)),
    "region_footer": lambda s, d: L.region(L.without_fonts(_spans(s, d)), "footer", F.lit(24.0), F.lit(240.0)),
    "robust_statistics": lambda s, d: L.robust(_norms(s, d), "book_id", "header_norm").select("book_id", *[F.round(c, 6).alias(c) for c in ("median", "mad", "p05", "p95")], "n"),
    "page_boundaries": lambda s, d: L.boundaries(_norms(s, d)),
    "split_pages": lambda s, d: L.split_pages(V.page_map(s, d).select(F.col("book_id").alias("doc"), F.col("page_number").alias("page"), F.when(F.col("page_number") % 3 == 0, 400.0).otherwise(800.0).alias("w"), F.lit(600.0).alias("h"))),
    "odd_even_interleave": lambda s, d: L.interleave(_pages(s, d, 1), _pages(s, d, 0)).select("book_id", "page", "scan", F.col("place").cast("long").alias("place")),
    "glossary_entries": lambda s, d: X.glossaries(load(s, d, "documents").select(F.col("doc_id").alias("id"), "text")),
    "verse_entries": lambda s, d: X.verses(load(s, d, "documents").select(F.col("doc_id").alias("id"), "text")),
    "json_props": lambda s, d: load(s, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k")),
    "batch_answers": lambda s, d: X.batch_answers(load(s, d, "events").select(F.concat(F.lit('{"custom_id": "e'), F.col("event_id"), F.lit('", "response": {"status_code": '), F.when(F.col("event_id") % 9 == 0, 500).otherwise(200), F.lit(', "body": "{\\"output_text\\": \\"'), F.col("event_type"), F.lit('\\"}"}'), F.when(F.col("event_id") % 7 == 0, "").otherwise("}")).alias("value"))).where("custom_id is not null or failed"),
    "html_render": lambda s, d: X.html(_spans(s, d).withColumn("size", F.when(F.col("line_no") == 0, 15).otherwise(10)).withColumn("bold", F.col("line_no") == 1), "text", "size", "bold").select("page_id", "line_no", "html"),
    "glossary_upsert": lambda s, d: M.upsert(_old_glossary(s, d), _new_glossary(s, d), ["book_id", "term"]),
    "glossary_insert_missing": lambda s, d: M.insert_missing(_old_glossary(s, d), _new_glossary(s, d), ["book_id", "term"]),
    "toc_replace": lambda s, d: M.replace_groups(V.toc(s, d).select("toc_id", "book_id", "toc_label"), V.toc(s, d).where("book_id = 41").select((F.col("toc_id") + 1_000_000).alias("toc_id"), "book_id", F.upper("toc_label").alias("toc_label")), ["book_id"]),
    "toc_page_sync": lambda s, d: M.update(V.toc(s, d).select("toc_id", "page_number"), V.toc(s, d).where("page_number is null").select("toc_id", F.lit(0).alias("n")), "toc_id", "page_number", "n"),
    "insert_ids": lambda s, d: M.with_ids(V.toc(s, d), V.glossary(s, d).select("glossary_id", "term"), "toc_id", ["glossary_id"]).select(F.col("toc_id").cast("long").alias("toc_id"), "glossary_id"),
}

_BLK = "SELECT l_orderkey AS page_id, CAST(l_linenumber AS INTEGER) AS block_no, l_quantity AS x0, l_extendedprice % 700 AS y0 FROM lineitem"
_SPAN = "SELECT content_id AS page_id, i - 1 AS line_no, string_split(page_content, chr(10))[i] AS text, (i - 1) * 12.0 AS y0 FROM c_content, unnest(range(1, len(string_split(page_content, chr(10))) + 1)) AS r(i) WHERE page_content IS NOT NULL"
_NG = "SELECT book_id, term, max(description) AS description FROM (SELECT book_id, term, concat('new ', term) AS description FROM c_glossary WHERE description IS NULL UNION ALL SELECT book_id + 1000, term, description FROM c_glossary WHERE book_id = 41) GROUP BY ALL"
_OG = "SELECT book_id, term, max(description) AS description FROM c_glossary GROUP BY ALL"

_HEAD, _TAIL = library.ORACLE["core_page_range"].split(" SELECT b.book_id, f.s AS core_start")
_TYPES = (
    _HEAD
    + ", core AS MATERIALIZED (SELECT b.book_id, f.s AS core_start" + _TAIL + ")"
    + ", rg AS (SELECT book_id, CASE WHEN lo > 0 AND hi >= lo THEN lo END AS lo, CASE WHEN lo > 0 AND hi >= lo THEN hi END AS hi FROM (" + texts.ORACLE["range_parse"][len(BASE):] + "))"
    + ", sc AS (SELECT *, " + " + ".join(texts._POINTS) + " AS pub FROM (SELECT book_id, page_number, page_content AS text, " + ", ".join(f"{v} AS {k}" for k, v in texts._stats("page_content").items()) + " FROM c_content))"
    + ", ty AS (SELECT sc.book_id, page_number, text, coalesce(pub, 0) AS pub, coalesce(page_number BETWEEN lo AND hi, false) AS inr, core_start IS NOT NULL AND core_end IS NOT NULL AS b, "
    + "length(regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g')) <= 5 AND len(regexp_extract_all(coalesce(text, ''), '\\S+')) <= 2 AS em, "
    + "CASE WHEN coalesce(page_number BETWEEN lo AND hi, false) THEN 'Table of Contents' WHEN core_start IS NULL OR core_end IS NULL THEN 'Core' WHEN page_number < core_start THEN 'Prefix' WHEN page_number <= core_end THEN 'Core' ELSE 'Postfix' END AS ot "
    + "FROM sc LEFT JOIN core ON core.book_id = sc.book_id LEFT JOIN rg ON rg.book_id = sc.book_id)"
    + ", pt AS (SELECT book_id, page_number, CASE WHEN em THEN 'Empty' WHEN pub >= 6 AND NOT inr THEN 'Publisher Info' ELSE ot END AS page_type, CASE WHEN em THEN 'high' WHEN pub >= 6 AND NOT inr THEN CASE WHEN pub >= 9 THEN 'high' ELSE 'medium' END WHEN inr THEN 'high' WHEN b THEN 'medium' ELSE 'low' END AS confidence, "
    + "CAST(CASE WHEN em THEN 9 WHEN pub >= 6 AND NOT inr THEN pub WHEN inr THEN 10 WHEN b THEN 6 ELSE 3 END AS DOUBLE) AS score, ot AS original_type FROM ty)"
)

ORACLE = {
    "page_types": _TYPES + " SELECT * FROM pt",
    "page_type_counts": _TYPES + " SELECT page_type, count(*) AS n FROM pt GROUP BY page_type",
    "page_type_changes": _TYPES + " SELECT pt.book_id, pt.page_number, pt.page_type FROM pt JOIN c_map m ON m.book_id = pt.book_id AND m.page_number = pt.page_number WHERE m.page_type = 'Core' AND pt.page_type <> 'Core'",
    "glossary_upsert": BASE + f"SELECT coalesce(o.book_id, n.book_id) AS book_id, coalesce(o.term, n.term) AS term, coalesce(n.description, o.description) AS description FROM ({_OG}) o FULL JOIN ({_NG}) n ON o.book_id IS NOT DISTINCT FROM n.book_id AND o.term IS NOT DISTINCT FROM n.term",
    "glossary_insert_missing": BASE + f"SELECT * FROM ({_NG}) n WHERE NOT EXISTS (SELECT 1 FROM ({_OG}) o WHERE o.book_id = n.book_id AND o.term = n.term)",
    "toc_replace": BASE + "SELECT toc_id, book_id, toc_label FROM c_toc WHERE book_id <> 41 UNION ALL SELECT toc_id + 1000000, book_id, upper(toc_label) FROM c_toc WHERE book_id = 41",
    "toc_page_sync": BASE + "SELECT toc_id, coalesce(page_number, 0) AS page_number FROM c_toc",
    "insert_ids": BASE + "SELECT (SELECT max(toc_id) FROM c_toc) + row_number() OVER (ORDER BY glossary_id) AS toc_id, glossary_id FROM c_glossary",
    "quadrant_counts": f"SELECT page_id, count(*) FILTER (WHERE y0 < 350 AND x0 < 25) AS top_left, count(*) FILTER (WHERE y0 < 350 AND x0 >= 25) AS top_right, count(*) FILTER (WHERE y0 >= 350 AND x0 < 25) AS bottom_left, count(*) FILTER (WHERE y0 >= 350 AND x0 >= 25) AS bottom_right FROM ({_BLK}) GROUP BY page_id",
    "two_columns": f"SELECT page_id, count(*) AS blocks, count(*) >= 10 AND count(*) FILTER (WHERE x0 < 25) / count(*) >= 0.3 AND count(*) FILTER (WHERE x0 >= 25) / count(*) >= 0.3 AS two_columns FROM ({_BLK}) GROUP BY page_id",
    "image_pages": f"SELECT *, CASE WHEN largest >= 0.9 AND images <= 2 THEN 'high' WHEN coverage >= 0.9 THEN 'high' WHEN coverage >= 0.75 THEN 'medium' END AS image_page FROM (SELECT page_id, round(sum(s), 6) AS coverage, round(max(s), 6) AS largest, count(*) AS images FROM (SELECT page_id, greatest(0, least(x0 + 20, 50) - greatest(x0, 0)) * greatest(0, least(y0 + 300, 700) - greatest(y0, 0)) / 35000 AS s FROM ({_BLK})) WHERE s >= 0.01 GROUP BY page_id)",
    "reading_order": f"SELECT page_id, block_no, row_number() OVER (PARTITION BY page_id ORDER BY round_even(y0 / 5, 0) * 5, x0, block_no) AS place FROM ({_BLK})",
    "region_body": BASE + f"SELECT page_id, string_agg(text, chr(10) ORDER BY line_no) AS text FROM ({_SPAN}) WHERE y0 >= 24 AND y0 < 240 GROUP BY page_id",
    "region_header": BASE + f"SELECT page_id, string_agg(text, chr(10) ORDER BY line_no) AS text FROM ({_SPAN}) WHERE y0 < 24 GROUP BY page_id",
    "region_footer": BASE + f"SELECT page_id, string_agg(text, chr(10) ORDER BY line_no) AS text FROM ({_SPAN}) WHERE y0 >= 240 GROUP BY page_id",
    "robust_statistics": "WITH v AS (SELECT CAST(l_suppkey % 20 AS INTEGER) AS book_id, l_discount / 2 AS v FROM lineitem), m AS (SELECT book_id, median(v) AS m, quantile_cont(v, 0.05) AS a, quantile_cont(v, 0.95) AS b, count(v) AS n FROM v GROUP BY 1) SELECT v.book_id, round(any_value(m), 6) AS median, round(median(abs(v - m)), 6) AS mad, round(any_value(a), 6) AS p05, round(any_value(b), 6) AS p95, any_value(n) AS n FROM v JOIN m ON m.book_id = v.book_id GROUP BY v.book_id",
    "split_pages": BASE + "SELECT book_id AS doc, (page_number - 1) * 2 + h AS new_page, CASE WHEN w > 600 AND h = 2 THEN w / 2 ELSE 0.0::DOUBLE END AS x0, CASE WHEN w <= 600 AND h = 1 THEN 300.0::DOUBLE ELSE 0.0::DOUBLE END AS y0 FROM (SELECT *, CASE WHEN page_number % 3 = 0 THEN 400.0::DOUBLE ELSE 800.0::DOUBLE END AS w FROM c_map), (VALUES (1), (2)) x(h)",
    "odd_even_interleave": BASE + "SELECT book_id, page, scan, row_number() OVER (PARTITION BY book_id ORDER BY page * 2 + CASE WHEN scan = 1 THEN 0 ELSE 1 END) AS place FROM (SELECT book_id, CAST(floor((page_number + 1) / 2) AS INTEGER) AS page, page_number % 2 AS scan FROM c_map)",
    "json_props": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "batch_answers": "SELECT CASE WHEN event_id % 7 <> 0 THEN concat('e', event_id) END AS custom_id, CASE WHEN event_id % 7 <> 0 AND event_id % 9 <> 0 THEN event_type END AS answer, event_id % 7 = 0 OR event_id % 9 = 0 AS failed FROM events",
    "html_render": BASE + f"SELECT page_id, CAST(line_no AS INTEGER) AS line_no, CASE WHEN line_no = 0 THEN concat('<h1>', text, '</h1>') WHEN line_no = 1 THEN concat('<p><b>', text, '</b></p>') ELSE concat('<p>', text, '</p>') END AS html FROM ({_SPAN})",
}
