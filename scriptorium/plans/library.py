"""Search, quality and contents queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contents as C
from ..operators import quality as Q
from ..operators import search as S
from . import views as V
from .views import BASE

_PATTERNS = ["chapter", "verse", "index", "song"]

QUERIES = {
    "content_search": lambda s, d: S.search_content(V.content(s, d), V.book(s, d), V.page_map(s, d), "silence"),
    "book_search": lambda s, d: S.search_books(V.book(s, d), "garden").select("book_id", "pdf_name", "original_book_title", "english_book_title"),
    "book_listing": lambda s, d: S.list_books(V.book(s, d)).select("book_id", "pdf_name", "original_book_title", "number_of_pages"),
    "book_by_name": lambda s, d: S.books_by_name(V.book(s, d), "book41.pdf"),
    "page_lookup": lambda s, d: S.page_text(V.content(s, d), 41, 3),
    "verse_locations": lambda s, d: S.verse_locations(V.verse_index(s, d), V.book(s, d), "verse 1"),
    "render_tasks": lambda s, d: S.render_tasks(V.page_map(s, d), V.book(s, d), restart=102),
    "render_audit": lambda s, d: S.render_audit(V.page_map(s, d), V.content(s, d).where("page_content is not null")),
    "character_contexts": lambda s, d: S.character_contexts(V.content(s, d), "à"),
    "word_page_counts": lambda s, d: S.word_page_counts(V.content(s, d), ["wisdom", "silence", "chapter", "kåñ"]),
    # Every third page counts as cleaned.
    "cleaning_work": lambda s, d: S.cleaning_work(V.content(s, d).withColumn("ai_page_content", F.when(F.col("page_number") % 3 == 0, F.trim("page_content"))), 2).select("content_id"),
    "resume_worklist": lambda s, d: S.resume_points(V.content(s, d), V.page_map(s, d)),
    "toc_page_candidates": lambda s, d: Q.candidates(V.toc(s, d), V.page_map(s, d)).select("toc_id", "book_id", "page_number", "map_page"),
    "toc_unmatched": lambda s, d: Q.unmatched(V.toc(s, d), V.page_map(s, d)).select("toc_id", "book_id", "page_label_raw"),
    "toc_match_rate": lambda s, d: Q.match_rate(V.toc(s, d), V.page_map(s, d)),
    "toc_mismatches": lambda s, d: Q.mismatches(V.toc(s, d), V.page_map(s, d)),
    "toc_already_correct": lambda s, d: Q.already_correct(V.toc(s, d), V.page_map(s, d)),
    "toc_page_updates": lambda s, d: Q.updates(V.toc(s, d), V.page_map(s, d)),
    "toc_blank_labels": lambda s, d: Q.blank_labels(V.toc(s, d)),
    "toc_label_patterns": lambda s, d: Q.unusual_labels(V.toc(s, d)),
    "toc_special_labels": lambda s, d: Q.special_labels(V.toc(s, d)),
    "toc_stats": lambda s, d: Q.toc_stats(V.toc(s, d)),
    "page_map_stats": lambda s, d: Q.page_map_stats(V.page_map(s, d)),
    # Every fourth book counts as not yet typed: all its pages have the type of the load.
    "only_primary_books": lambda s, d: Q.only_type(V.page_map(s, d).withColumn("page_type", F.when(F.col("book_id") % 4 == 1, "Primary").otherwise(F.col("page_type")))),
    # Labels of the pages that were extracted, in lower case, against the stored ones.
    "label_diagnosis": lambda s, d: Q.label_diagnosis(V.page_map(s, d), V.page_map(s, d).join(V.content(s, d).select("book_id", "page_number"), ["book_id", "page_number"], "left_semi").select("book_id", "page_number", F.lower("page_label").alias("page_label"))),
    "toc_parents": lambda s, d: C.parents_by_level(V.toc(s, d)),
    "toc_parents_monotonic": lambda s, d: C.parents_monotonic(V.toc(s, d)),
    "toc_combined_labels": lambda s, d: C.combined_labels(V.toc(s, d)),
    "toc_effective_start": lambda s, d: C.effective_start(V.toc(s, d), V.page_map(s, d)).select("toc_id", "start_page", "method"),
    "toc_page_ranges": lambda s, d: C.page_ranges(C.effective_start(V.toc(s, d), V.page_map(s, d)), V.book(s, d).select("book_id", "number_of_pages")),
    "core_page_range": lambda s, d: C.core_range(C.effective_start(V.toc(s, d), V.page_map(s, d)), V.page_map(s, d)),
    "toc_backfill": lambda s, d: C.backfill(V.toc(s, d)).where("new_label is not null"),
    "toc_backfill_errors": lambda s, d: C.backfill(V.toc(s, d)).where("new_label is null").select("toc_id", "book_id", "toc_level"),
    "toc_fuzzy_sections": lambda s, d: C.fuzzy_sections(V.toc(s, d), _PATTERNS).select("toc_id", "matched"),
    "toc_orphans": lambda s, d: C.orphans(V.toc(s, d)),
    "toc_validation": lambda s, d: C.validation(V.toc(s, d), C.effective_start(V.toc(s, d), V.page_map(s, d))),
}

_BLANK = "(page_label_raw IS NULL OR trim(page_label_raw, ' ') = '')"
_CAND = "SELECT t.*, m.page_number AS map_page FROM c_toc t JOIN c_map m ON t.book_id = m.book_id AND trim(t.page_label_raw, ' ') = trim(m.page_label, ' ')"
_START = """,
ex AS (SELECT book_id, trim(page_label, ' ') AS l, max(page_number) AS x FROM c_map WHERE trim(page_label, ' ') <> '' GROUP BY ALL),
lo AS (SELECT book_id, lower(trim(page_label, ' ')) AS l, min(page_number) AS y FROM c_map WHERE trim(page_label, ' ') <> '' GROUP BY ALL),
rs AS MATERIALIZED (SELECT t.*, CASE WHEN trim(t.page_label_raw, ' ') <> '' THEN coalesce(ex.x, lo.y) END AS resolved FROM c_toc t LEFT JOIN ex ON ex.book_id = t.book_id AND ex.l = trim(t.page_label_raw, ' ') LEFT JOIN lo ON lo.book_id = t.book_id AND lo.l = lower(trim(t.page_label_raw, ' '))),
w1 AS (SELECT r.toc_id AS top, c.toc_id, c.resolved, lpad(CAST(c.toc_id AS VARCHAR), 12, '0') AS path FROM rs r JOIN rs c ON c.parent_toc_id = r.toc_id),
w2 AS (SELECT w1.top, c.toc_id, c.resolved, concat(w1.path, '/', lpad(CAST(c.toc_id AS VARCHAR), 12, '0')) AS path FROM w1 JOIN rs c ON c.parent_toc_id = w1.toc_id),
w3 AS (SELECT w2.top, c.toc_id, c.resolved, concat(w2.path, '/', lpad(CAST(c.toc_id AS VARCHAR), 12, '0')) AS path FROM w2 JOIN rs c ON c.parent_toc_id = w2.toc_id),
ds AS (SELECT top, min_by(resolved, path) AS sub FROM (SELECT * FROM w1 UNION ALL SELECT * FROM w2 UNION ALL SELECT * FROM w3) WHERE resolved > 0 GROUP BY top),
st AS MATERIALIZED (SELECT toc_id, book_id, toc_level, toc_label, page_label_raw, parent_toc_id, CAST(CASE WHEN resolved > 0 THEN resolved ELSE coalesce(sub, 0) END AS INTEGER) AS start_page, CASE WHEN resolved > 0 THEN 'own' WHEN sub IS NOT NULL THEN 'descendant' ELSE 'none' END AS method FROM rs LEFT JOIN ds ON top = toc_id)
"""
_HIT = ", ".join(f"CASE WHEN contains(lower(toc_label), '{p}') THEN '{p}' END" for p in _PATTERNS)

ORACLE = {
    k: BASE + v
    for k, v in {
        "content_search": "SELECT c.book_id, coalesce(english_book_title, original_book_title) AS title, c.page_number, page_label, CAST(length(page_content) AS INTEGER) AS chars FROM c_content c JOIN c_book b ON b.book_id = c.book_id LEFT JOIN c_map m ON m.book_id = c.book_id AND m.page_number = c.page_number WHERE page_content ILIKE '%silence%'",
        "book_search": "SELECT book_id, pdf_name, original_book_title, english_book_title FROM c_book WHERE original_book_title ILIKE '%garden%' OR english_book_title ILIKE '%garden%' OR pdf_name ILIKE '%garden%'",
        "book_listing": "SELECT book_id, pdf_name, original_book_title, number_of_pages FROM c_book",
        "book_by_name": "SELECT book_id FROM c_book WHERE pdf_name = 'book41.pdf'",
        "page_lookup": "SELECT page_content FROM c_content WHERE book_id = 41 AND page_number = 3",
        "verse_locations": "SELECT v.book_id, pdf_name, verse_name, page_number FROM c_verse v JOIN c_book b ON b.book_id = v.book_id WHERE verse_name ILIKE '%verse 1%'",
        "render_tasks": "SELECT m.book_id, pdf_name, page_number, page_label FROM c_map m JOIN c_book b ON b.book_id = m.book_id WHERE m.book_id >= 102",
        "render_audit": "SELECT e.book_id, e.n AS expected, coalesce(a.n, 0) AS actual, CASE WHEN a.n IS NULL THEN 'missing' WHEN a.n < e.n THEN 'partial' ELSE 'complete' END AS state FROM (SELECT book_id, count(*) AS n FROM c_map GROUP BY 1) e LEFT JOIN (SELECT book_id, count(*) AS n FROM c_content WHERE page_content IS NOT NULL GROUP BY 1) a ON a.book_id = e.book_id",
        "character_contexts": "SELECT book_id, page_number, substr(page_content, greatest(instr(page_content, 'à') - 20, 1), instr(page_content, 'à') - greatest(instr(page_content, 'à') - 20, 1) + 20) AS context FROM c_content WHERE contains(page_content, 'à')",
        "word_page_counts": "SELECT word, count(*) FILTER (WHERE page_content ILIKE concat('%', word, '%')) AS pages FROM c_content, (VALUES ('wisdom'), ('silence'), ('chapter'), ('kåñ')) w(word) GROUP BY word",
        "cleaning_work": "SELECT content_id FROM c_content WHERE page_content <> '' AND page_number >= 2 AND (page_number % 3 <> 0 OR trim(page_content, ' ') = '')",
        "resume_worklist": "SELECT m.book_id, max(l.last_page) AS last_page, count(*) FILTER (WHERE c.book_id IS NULL) AS missing FROM c_map m LEFT JOIN c_content c ON c.book_id = m.book_id AND c.page_number = m.page_number AND c.page_content <> '' LEFT JOIN (SELECT book_id, max(page_number) AS last_page FROM c_content WHERE page_content <> '' GROUP BY 1) l ON l.book_id = m.book_id GROUP BY m.book_id",
        "toc_page_candidates": f"SELECT toc_id, book_id, page_number, map_page FROM ({_CAND})",
        "toc_unmatched": f"SELECT toc_id, book_id, page_label_raw FROM c_toc t WHERE NOT {_BLANK} AND NOT EXISTS (SELECT 1 FROM c_map m WHERE m.book_id = t.book_id AND trim(m.page_label, ' ') = trim(t.page_label_raw, ' '))",
        "toc_match_rate": f"SELECT t.book_id, count(t.toc_id) AS entries, count(m.page_number) AS matched, count(t.toc_id) - count(m.page_number) AS unmatched FROM c_toc t LEFT JOIN c_map m ON t.book_id = m.book_id AND trim(t.page_label_raw, ' ') = trim(m.page_label, ' ') WHERE NOT {_BLANK} GROUP BY t.book_id",
        "toc_mismatches": f"SELECT toc_id, book_id, page_number, map_page FROM ({_CAND}) WHERE page_number <> map_page",
        "toc_already_correct": f"SELECT toc_id, book_id, page_number FROM ({_CAND}) WHERE page_number = map_page",
        "toc_page_updates": f"SELECT toc_id, book_id, page_number AS old_page, map_page AS new_page FROM ({_CAND}) WHERE page_number IS DISTINCT FROM map_page",
        "toc_blank_labels": f"SELECT book_id, count(*) AS blank FROM c_toc WHERE {_BLANK} GROUP BY book_id",
        "toc_label_patterns": f"SELECT page_label_raw, count(*) AS n, string_agg(DISTINCT CAST(book_id AS VARCHAR), ', ' ORDER BY CAST(book_id AS VARCHAR)) AS books FROM c_toc WHERE NOT {_BLANK} AND NOT regexp_matches(page_label_raw, '^[0-9]+$') AND NOT regexp_matches(page_label_raw, '^[ivxlcdm]+$') GROUP BY 1 ORDER BY n DESC, page_label_raw LIMIT 20",
        "toc_special_labels": f"SELECT toc_id, book_id, page_label_raw FROM c_toc WHERE NOT {_BLANK} AND (regexp_matches(page_label_raw, '[^a-zA-Z0-9ivxlcdm\\-.]') OR length(page_label_raw) > 10 OR regexp_matches(page_label_raw, '\\s'))",
        "toc_stats": f"SELECT count(*) AS total, count(page_number) AS with_page, count(*) - count(page_number) AS without_page, count(*) FILTER (WHERE {_BLANK}) AS blank_label FROM c_toc",
        "page_map_stats": "SELECT count(*) AS total, count(DISTINCT page_label) AS labels, count(*) FILTER (WHERE page_label IS NULL OR trim(page_label, ' ') = '') AS blank_label FROM c_map",
        "only_primary_books": "SELECT book_id FROM (SELECT book_id, CASE WHEN book_id % 4 = 1 THEN 'Primary' ELSE page_type END AS page_type FROM c_map) GROUP BY book_id HAVING count(DISTINCT page_type) = 1 AND max(page_type) = 'Primary'",
        "label_diagnosis": "SELECT * FROM (SELECT coalesce(s.book_id, e.book_id) AS book_id, coalesce(s.page_number, e.page_number) AS page_number, s.l AS stored_label, e.l AS pdf_label, CASE WHEN s.l IS NULL THEN 'MISSING_IN_DB' WHEN e.l IS NULL THEN 'MISSING_IN_PDF' WHEN s.l <> e.l THEN 'MISMATCH' END AS issue FROM (SELECT book_id, page_number, coalesce(trim(page_label, ' '), '') AS l FROM c_map) s FULL JOIN (SELECT book_id, page_number, coalesce(trim(lower(page_label), ' '), '') AS l FROM c_map m WHERE EXISTS (SELECT 1 FROM c_content c WHERE c.book_id = m.book_id AND c.page_number = m.page_number)) e ON s.book_id = e.book_id AND s.page_number = e.page_number) WHERE issue IS NOT NULL",
        "toc_parents": "SELECT c.toc_id, c.book_id, c.toc_level, CASE WHEN c.toc_level > 1 AND p.toc_level = c.toc_level - 1 THEN p.toc_id END AS parent_toc_id FROM c_toc c LEFT JOIN LATERAL (SELECT max_by(toc_level, toc_id) AS toc_level, max(toc_id) AS toc_id FROM c_toc q WHERE q.book_id = c.book_id AND q.toc_id < c.toc_id AND q.toc_level < c.toc_level) p ON true",
        "toc_parents_monotonic": "SELECT c.toc_id, c.book_id, greatest(c.toc_level, 1) AS level, (SELECT max(q.toc_id) FROM c_toc q WHERE q.book_id = c.book_id AND q.toc_id < c.toc_id AND greatest(q.toc_level, 1) < greatest(c.toc_level, 1)) AS parent_toc_id FROM c_toc c",
        "toc_combined_labels": f", h AS (SELECT *, last_value(CASE WHEN toc_level = 1 THEN toc_id END IGNORE NULLS) OVER (PARTITION BY book_id ORDER BY toc_id) AS head FROM c_toc), g AS (SELECT *, toc_level = 2 AND {_BLANK} AND head IS NOT NULL AS merged FROM h), p AS (SELECT head, string_agg(toc_label, ' - ' ORDER BY toc_id) AS more FROM g WHERE merged GROUP BY head) SELECT toc_id, book_id, toc_level, CASE WHEN p.head IS NOT NULL THEN toc_label || coalesce(' - ' || more, ' - ') ELSE toc_label END AS toc_label FROM g LEFT JOIN p ON p.head = g.toc_id WHERE NOT merged",
        "toc_effective_start": _START + "SELECT toc_id, start_page, method FROM st",
        "toc_page_ranges": _START + ", e AS (SELECT a.toc_id, a.book_id, a.start_page, CASE WHEN a.start_page > 0 THEN coalesce((SELECT min_by(b.start_page, b.toc_id) FROM st b WHERE b.book_id = a.book_id AND coalesce(b.parent_toc_id, -1) = coalesce(a.parent_toc_id, -1) AND b.toc_level = a.toc_level AND b.toc_id > a.toc_id AND b.start_page > a.start_page) - 1, (SELECT min_by(b.start_page, b.toc_id) FROM st b WHERE b.book_id = a.book_id AND b.toc_level < a.toc_level AND b.toc_id > a.toc_id AND b.start_page > a.start_page) - 1, k.number_of_pages) END AS end_page FROM st a LEFT JOIN c_book k ON k.book_id = a.book_id) SELECT toc_id, book_id, start_page, CAST(end_page AS INTEGER) AS end_page, CAST(CASE WHEN end_page IS NULL THEN 0 ELSE greatest(0, end_page - start_page + 1) END AS INTEGER) AS page_count FROM e",
        "core_page_range": _START + ", f AS (SELECT book_id, min_by(start_page, (toc_level, toc_id)) AS s FROM st WHERE start_page > 0 GROUP BY 1), x AS (SELECT st.book_id, min(start_page) - 1 AS e FROM st JOIN f ON f.book_id = st.book_id WHERE start_page > s AND (toc_label ILIKE '%appendix%' OR toc_label ILIKE '%index%' OR toc_label ILIKE '%glossary%') GROUP BY 1), l AS (SELECT book_id, max(page_number) AS m FROM c_map WHERE trim(page_label, ' ') <> '' GROUP BY 1) SELECT b.book_id, f.s AS core_start, CAST(CASE WHEN f.s IS NOT NULL THEN coalesce(nullif(x.e, 0), l.m) END AS INTEGER) AS core_end FROM c_book b LEFT JOIN f ON f.book_id = b.book_id LEFT JOIN x ON x.book_id = b.book_id LEFT JOIN l ON l.book_id = b.book_id",
        "toc_backfill": f"SELECT t.toc_id, t.book_id, t.toc_level, c.new_label FROM c_toc t JOIN (SELECT parent_toc_id, book_id, min_by(page_label_raw, toc_id) AS new_label FROM c_toc WHERE NOT {_BLANK} GROUP BY ALL) c ON c.parent_toc_id = t.toc_id AND c.book_id = t.book_id WHERE {_BLANK}",
        "toc_backfill_errors": f"SELECT toc_id, book_id, toc_level FROM c_toc t WHERE {_BLANK} AND NOT EXISTS (SELECT 1 FROM c_toc c WHERE c.parent_toc_id = t.toc_id AND c.book_id = t.book_id AND NOT (c.page_label_raw IS NULL OR trim(c.page_label_raw, ' ') = ''))",
        "toc_fuzzy_sections": f"SELECT * FROM (SELECT toc_id, concat_ws(',', {_HIT}) AS matched FROM c_toc) WHERE matched <> ''",
        "toc_orphans": "SELECT toc_id, book_id, parent_toc_id FROM c_toc t WHERE parent_toc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM c_toc p WHERE p.toc_id = t.parent_toc_id AND p.book_id = t.book_id)",
        "toc_validation": _START + f"SELECT book_id, count(*) AS total, count(*) FILTER (WHERE toc_level = 1) AS level_one, count(*) FILTER (WHERE {_BLANK}) AS no_label, count(*) FILTER (WHERE method = 'own') AS own_page, count(*) FILTER (WHERE method = 'descendant') AS computed_page, count(*) FILTER (WHERE parent_toc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM c_toc p WHERE p.toc_id = st.parent_toc_id AND p.book_id = st.book_id)) AS orphaned FROM st GROUP BY book_id",
    }.items()
}
