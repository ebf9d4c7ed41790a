"""Lookups, reports, block layout, text helpers and import sequences, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import transliteration as T
from ..operators import contents as C
from ..operators import extracts as E
from ..operators import layout as L
from ..operators import pages as P
from ..operators import parsers as A
from ..operators import pipelines as J
from ..operators import reports as R
from ..operators import search as S
from ..operators import store as M
from ..operators import vectors as N
from ..tables import current, load
from . import library, texts
from . import views as V
from .views import BASE


def _damaged(s, d):
    """Terms as they are once transliterated letters were taken for signs of legacy fonts."""
    return V.glossary(s, d).select("glossary_id", "book_id", F.translate("term", "ṛṣṅṁḍ", "®ß∫µ∂").alias("term"))


def _errors(s, d):
    return _damaged(s, d).select("glossary_id", "book_id", "term", F.explode(X.term_errors(F.col("term"))).alias("e")).select("glossary_id", "book_id", "term", "e.pattern", "e.corrected", F.when(F.length("e.pattern") == 1, "character").otherwise("pattern").alias("error_type"))


def _core(s, d):
    return C.core_range(C.effective_start(V.toc(s, d), V.page_map(s, d)), V.page_map(s, d))


def _bank(s, d):
    return V.word_bank(s, d).select("word_id", F.col("program_fixed").alias("old"), T.fix_word(T.map_glyphs(F.col("raw_word"))).alias("new"))


def _page_sizes(s, d):
    """Pages of the page map with a rotation, a flip and bounds made up from their numbers."""
    m = V.page_map(s, d)
    n = F.col("page_number")
    return m.select(
        "book_id", "page_number", (F.col("book_id").cast("long") * 100_000 + n).alias("page_id"), (F.when(n % 7 == 0, 90).when(n % 7 == 1, 270).otherwise(0)).alias("rotation"), F.when(n % 11 == 0, -1.0).otherwise(1.0).alias("flip"),
        F.lit(600.0).alias("page_h"), F.when(n % 5 == 0, None).otherwise(24.0).alias("header"), F.when(n % 3 == 0, 560.0).when(n % 3 == 1, 36.0).otherwise(590.0 + n % 20).alias("footer"),
    )


def _spans(s, d):
    """Lines of pages as spans in several fonts and sizes."""
    c = V.content(s, d).where("page_content is not null")
    line = c.select("book_id", "page_number", F.col("content_id").alias("page_id"), F.posexplode(F.split("page_content", "\n")).alias("line_no", "text"))
    n = F.col("line_no")
    font = F.when(n % 6 == 0, "AARitu").when(n % 6 == 1, "Serif-Bold").when(n % 6 == 2, "Sanskrit 99").otherwise("Serif")
    return line.select("book_id", "page_number", "page_id", "line_no", F.lit(0).alias("span_no"), "text", (n * 12.0).alias("y0"), (n * 12.0 + 10).alias("y1"), F.lit(600.0).alias("page_h"), font.alias("font"), F.when(n == 0, 15).when(n % 6 == 1, 13).otherwise(10).alias("size"))


def _blocks(s, d):
    return _spans(s, d).select("page_id", F.col("line_no").alias("block_no"), "text", F.floor(F.col("y0") / 24).cast("double").alias("y0"), "y1", "page_h")


def _modes(s, d):
    n = F.col("page_number")
    c = V.content(s, d).where("page_content is not null").select(F.col("content_id").alias("page_id"), F.when(n % 7 == 0, 90).otherwise(0).alias("rotation"), F.when(n % 11 == 0, -1.0).otherwise(1.0).alias("flip"))
    return L.block_mode(c)


def _full_types(s, d):
    """Page types of books with ranges of all kinds and pictures on some pages."""
    n = F.col("page_number")
    b = V.book(s, d).select("book_id", "toc_pages", F.when(F.col("book_id") % 2 == 0, F.lit("[6,9)")).alias("glossary_pages"), F.when(F.col("book_id") % 3 == 0, F.lit("[8,11]")).alias("verse_pages"))
    images = V.page_map(s, d).where(n % 4 == 0).select("book_id", "page_number", F.when(n % 8 == 0, 0.95).otherwise(0.8).alias("coverage"), F.when(n % 8 == 0, 0.95).otherwise(0.5).alias("largest"), F.lit(2).cast("long").alias("images"))
    return P.classify(V.content(s, d), _core(s, d), b, images)


def _fresh(s, d):
    """Rows of an upsert: every second page again, some as they are, some new, some without a key."""
    m = V.page_map(s, d)
    n = F.col("page_number")
    return m.select(F.when(n % 9 == 0, None).otherwise(F.col("book_id")).alias("book_id"), F.when(n % 4 == 0, n + 100_000).otherwise(n).alias("page_number"), F.when(n % 2 == 0, F.col("page_label")).otherwise(F.lit("new")).alias("page_label"))


def _labelled(s, d):
    return V.page_map(s, d).select("book_id", "page_number", "page_label")


def _vectors(s, d):
    v = current(s, d, "glossary_embeddings", ["glossary_id", "embedding"])
    return v.where((F.size("embedding") == 96) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x)) & F.exists("embedding", lambda x: x != 0))


def _import_files(s, d):
    """Every book of the page map as a file; those of even number are known already."""
    b = V.book(s, d)
    return b.select("pdf_name", "number_of_pages"), b.where("book_id % 2 = 0").select("book_id", "pdf_name", "number_of_pages")


def _first(s, d):
    files, known = _import_files(s, d)
    names = V.book(s, d).select("book_id", "pdf_name")
    labels = V.page_map(s, d).join(names, "book_id").select("pdf_name", "page_number", "page_label")
    marks = V.toc(s, d).join(names, "book_id").select("pdf_name", "toc_level", "toc_label", "page_number", F.col("toc_id").alias("place"))
    return J.import_first(files, known, labels, marks)


def _second(s, d):
    toc = V.toc(s, d)
    sheet = toc.where("book_id % 3 = 0").select("book_id", F.col("toc_id").alias("place"), "toc_level", F.trim("toc_label").alias("toc_label"), "page_label_raw")
    return J.import_second(V.book(s, d), _labelled(s, d), toc, {"toc": sheet, "pages": _labelled(s, d).where("page_number % 2 = 0").withColumn("page_label", F.trim("page_label"))})


QUERIES = {
    "book_by_id": lambda s, d: S.book_by_id(V.book(s, d), 41).select("book_id", "pdf_name", "original_book_title", "english_book_title", "number_of_pages", "edition", "toc_pages", "glossary_pages"),
    "books_chosen": lambda s, d: S.chosen(V.book(s, d), book_id=[41, 102, 105, 7], english_book_title=None, toc_pages=[]).select("book_id", "pdf_name"),
    "glyphs_chosen": lambda s, d: S.chosen(V.glyph_words(s, d), glyph="ä", font_name=None).select("id", "font_name", "glyph"),
    "pages_of_type": lambda s, d: S.pages_of_type(V.page_map(s, d), "Core").select("book_id", "page_number"),
    "content_in_books": lambda s, d: S.search_content(V.content(s, d), V.book(s, d), V.page_map(s, d), "wisdom", [41, 102]).select("book_id", "page_number", "chars"),
    "book_listing_limited": lambda s, d: S.list_books(V.book(s, d), 5).select("book_id", "original_book_title"),
    "without_placeholders": lambda s, d: S.without_placeholders(V.book(s, d).select("book_id", F.when(F.col("book_id") % 4 == 0, F.concat(F.lit("[TO BE ADDED] "), "pdf_name")).when(F.col("book_id") % 4 == 1, None).otherwise(F.col("original_book_title")).alias("title")), "title"),
    "files_by_name_or_stem": lambda s, d: S.by_name_or_stem(V.book(s, d).select(F.when(F.col("book_id") % 3 == 0, F.concat(F.upper(F.regexp_replace("pdf_name", r"\.pdf$", "")), F.lit(".txt"))).when(F.col("book_id") % 3 == 1, F.concat(F.lit("x"), "pdf_name")).otherwise(F.col("pdf_name")).alias("pdf_name")), V.book(s, d)),
    "page_worklist": lambda s, d: S.page_worklist(V.book(s, d), 3),
    "valid_pages": lambda s, d: S.valid_pages(V.content(s, d).select("book_id", (F.col("page_number") * 2 - 5).alias("page_number")), V.book(s, d)),
    "page_number_labels": lambda s, d: S.numbers_to_labels(V.content(s, d).select("book_id", "page_number"), V.page_map(s, d)),
    "toc_roots": lambda s, d: C.roots(V.toc(s, d)),
    "toc_item_exact": lambda s, d: C.item_by_label(V.toc(s, d).withColumn("toc_label", F.when(F.col("toc_id") % 10 == 0, "Contents").otherwise(F.col("toc_label"))), "Contents").select("book_id", "toc_id", "toc_level"),
    "toc_item_like": lambda s, d: C.item_by_label(V.toc(s, d), "chapter", exact=False).select("book_id", "toc_id", "toc_level"),
    "toc_nested": lambda s, d: C.nested(V.toc(s, d)),
    "toc_messages": lambda s, d: C.validation_messages(C.validation(V.toc(s, d), C.effective_start(V.toc(s, d), V.page_map(s, d)))),
    "core_summary": lambda s, d: C.core_summary(_core(s, d)),
    "toc_error_report": lambda s, d: R.grouped_report(C.backfill(V.toc(s, d)).where("new_label is null"), "book_id", "toc_id", ["toc_id", "toc_level"]),
    "damaged_term_errors": lambda s, d: _errors(s, d).select("glossary_id", "pattern", "corrected", "error_type"),
    "term_error_breakdown": lambda s, d: R.breakdown(_errors(s, d), ["error_type", "pattern", "book_id"], 20),
    "term_error_samples": lambda s, d: R.error_samples(_errors(s, d).withColumn("at", F.struct("glossary_id", "pattern")), "term", "at").select("term", "pattern", "corrected"),
    "word_bank_changes": lambda s, d: R.change_counters(_bank(s, d), "old", "new", {"with_n": "ñ", "with_a": "å", "with_r": "ṛ"}),
    "word_bank_examples": lambda s, d: R.change_examples(_bank(s, d), "word_id", "old", "new"),
    "extraction_summary": lambda s, d: R.outcome(load(s, d, "documents"), F.length("text") > 0),
    "upsert_counters": lambda s, d: R.run_counters(_labelled(s, d), _fresh(s, d), ["book_id", "page_number"]),
    "fix_report": lambda s, d: R.fix_report(T.corrections(texts._words(s, d))),
    "ending_examples": lambda s, d: R.endings_examples(V.glossary(s, d), X.ending(F.col("description")), "glossary_id", "description"),
    "description_complete": lambda s, d: V.glossary(s, d).select("glossary_id", X.complete(F.col("description")).alias("complete")),
    "glyph_totals": lambda s, d: R.glyph_totals(V.glyph_words(s, d)),
    "font_top5": lambda s, d: texts.G.top(V.glyph_words(s, d), "font_name"),
    "glyph_contexts": lambda s, d: texts.G.char_contexts(V.content(s, d), texts.ALLOWED),
    "distinct_fonts": lambda s, d: V.glyph_words(s, d).select("font_name").distinct(),
    "character_languages": lambda s, d: R.character_languages(E.contexts(V.content(s, d), "content_id", "page_content", "à"), ["déjà", "voilà", "à la", "là"], ["naïve", "naïf"]),
    "sample_words_mapped": lambda s, d: V.glyph_words(s, d).select("id", F.array_join(T.map_words(F.col("sample_words"), T.SAMPLE_PAIRS), "|").alias("words")),
    "ambiguous_words_mapped": lambda s, d: current(s, d, "ambiguous_diacritic_words", ["id", "word"]).select("id", F.element_at(T.map_words(F.array("word"), T.WORD_PAIRS), 1).alias("word")),
    "clean_summaries": lambda s, d: load(s, d, "documents").select("doc_id", F.md5(X.clean_summary(F.col("text"))).alias("text")),
    "verse_texts": lambda s, d: load(s, d, "documents").where("text is not null").select("doc_id", F.md5(X.verse_lines(F.col("text"))).alias("text")),
    "word_contexts": lambda s, d: V.content(s, d).select("content_id", F.explode(X.word_contexts(F.col("page_content"), "ñ")).alias("word")),
    "safe_values": lambda s, d: V.page_map(s, d).select("book_id", "page_number", X.safe_string(F.col("page_label")).alias("label"), X.clean_value(F.col("page_type")).alias("type"), X.preview(X.safe_string(F.col("page_label")), 3).alias("short"), X.thousands(F.col("page_number") * 1000).alias("thousands")),
    "line_cleaning": lambda s, d: V.toc(s, d).select("toc_id", X.clean_list_line(F.concat(F.lit("• "), F.coalesce("toc_label", F.lit("")), F.lit(" ......  x"))).alias("line")),
    "image_types": lambda s, d: V.page_map(s, d).select("book_id", "page_number", X.image_extension(F.unhex(F.element_at(F.array(*[F.lit(h) for h in ("FFD8FFE000", "89504E470D0A1A0A", "474946383961", "524946460000000057454250", "00")]), (F.col("page_number") % 5 + 1).cast("int")))).alias("extension")),
    "thumbnail_sizes": lambda s, d: load(s, d, "part").select("p_partkey", *[c.alias(k) for k, c in L.thumbnail(F.col("p_size") * 40, F.col("p_size") * 20 + 100).items()]),
    "block_bodies": lambda s, d: L.body_blocks(_blocks(s, d), F.lit(1.0), F.lit(300.0)),
    "page_modes": lambda s, d: _modes(s, d),
    "page_extracts": lambda s, d: L.extract(_modes(s, d).select("page_id", "mode"), _spans(s, d), _spans(s, d).select("page_id", F.col("line_no").alias("block_no"), "text", "y0", "y1", "page_h"), F.lit(12.0), F.lit(240.0)),
    "page_extract_facts": lambda s, d: L.with_book(V.content(s, d).select("book_id", "page_number", F.col("page_content").alias("text")), V.book(s, d).where("book_id % 5 <> 0").select("book_id", "original_book_title", "english_book_title", F.when(F.col("book_id") % 2 == 0, 24.0).alias("header_height"), F.lit(560.0).alias("footer_height"))).drop("content"),
    "content_rects": lambda s, d: L.content_rect(_page_sizes(s, d)).select("book_id", "page_number", "top", "bottom"),
    "edge_texts": lambda s, d: L.edge_texts(_spans(s, d), F.lit(0.05), F.lit(0.3), 2.0),
    "page_texts_without_fonts": lambda s, d: L.page_content(_spans(s, d), _modes(s, d).select("page_id", F.lit(12.0).alias("top"), F.lit(480.0).alias("bottom"))),
    "font_prefix_excluded": lambda s, d: L.without_fonts(_spans(s, d), [], ["AARitu", "AATripti"]).groupBy("font").agg(F.count("*").alias("n")),
    "batch_texts": lambda s, d: L.batch_texts(_spans(s, d), V.content(s, d).select(F.col("content_id").alias("page_id"), "page_number"), 2, 4),
    "font_ranking": lambda s, d: L.font_ranking(_spans(s, d)),
    "font_sizes": lambda s, d: L.font_sizes(_spans(s, d)),
    "sampled_fonts": lambda s, d: L.sampled_fonts(_spans(s, d), V.book(s, d), 4),
    "largest_pages": lambda s, d: L.largest_page(load(s, d, "part").select((F.col("p_partkey") % 50).alias("doc"), F.col("p_size").alias("w"), F.col("p_retailprice").alias("h"))),
    "dominant_heights": lambda s, d: L.dominant_height(load(s, d, "part").select((F.col("p_partkey") % 40).alias("book_id"), (F.col("p_size") % 7 + F.col("p_partkey") % 3 / 100).alias("page_h"))).select("book_id", F.round("height", 6).alias("height")),
    "full_page_types": _full_types,
    "page_reclassification": lambda s, d: J.reclassify(V.content(s, d), _core(s, d), V.book(s, d).select("book_id", "toc_pages"), V.page_map(s, d).withColumn("page_type", F.when(F.col("book_id") % 4 == 1, "Primary").otherwise(F.col("page_type")))),
    "html_styles": lambda s, d: _spans(s, d).select("page_id", "line_no", A.styled(F.col("text"), F.when(F.col("line_no") % 5 == 0, 2).when(F.col("line_no") % 5 == 1, 18).otherwise(0), F.col("font")).alias("html")),
    "html_books": lambda s, d: J.html_books(_spans(s, d).select("book_id", "page_number", "line_no", "text", "size", F.lit(0).alias("flags"), "font", F.when(F.col("line_no") == 3, "data:image/png;base64,AA==").alias("image")), V.book(s, d).where("book_id % 2 = 0")),
    "book_glossary_entries": lambda s, d: J.book_glossaries(V.content(s, d), V.book(s, d).select("book_id", F.lit("[1,9)").alias("glossary_pages"))),
    "book_verse_entries": lambda s, d: J.book_verses(V.content(s, d), V.book(s, d).select("book_id", F.lit("[1,9]").alias("verse_pages"))),
    "page_pipeline": lambda s, d: J.transliterate_pages(_spans(s, d), V.content(s, d).where("page_number % 2 = 0").select("book_id", "page_number", "page_content"), V.content(s, d).select("book_id", "page_number"))[1],
    "core_content": lambda s, d: J.core_content(_spans(s, d), V.page_map(s, d), F.lit(12.0), F.lit(480.0)),
    "import_books": lambda s, d: _first(s, d)["book"].select("book_id", "pdf_name", "number_of_pages"),
    "import_page_map": lambda s, d: _first(s, d)["page_map"].select("book_id", "page_number", "page_label"),
    "import_contents": lambda s, d: _second(s, d)["toc"].select("toc_id", "book_id", "toc_level", "toc_label", "parent_toc_id"),
    "import_page_labels": lambda s, d: _second(s, d)["page_map"],
    "vector_topk_all": lambda s, d: N.top_k_all(load(s, d, "embeddings"), load(s, d, "embeddings").where("vec_id % 50 = 0"), 5).select("vec_id", "neighbour", "place"),
    "vector_topk_terms": lambda s, d: N.with_rows(N.top_k_all(_vectors(s, d), _vectors(s, d).where("glossary_id % 50 = 0"), 3, "glossary_id"), V.glossary(s, d).select("glossary_id", "term"), "glossary_id").select("glossary_id", "neighbour", "place", "term"),
    "vector_upsert": lambda s, d: M.upsert(load(s, d, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("first")), load(s, d, "embeddings").where("vec_id % 3 = 0").select((F.col("vec_id") * 2).alias("vec_id"), (F.col("embedding")[0].cast("double") + 1).alias("first")), ["vec_id"]),
}

_SP = "sp AS MATERIALIZED (SELECT *, line_no * 12.0::DOUBLE AS y0, line_no * 12.0::DOUBLE + 10 AS y1, CASE line_no % 6 WHEN 0 THEN 'AARitu' WHEN 1 THEN 'Serif-Bold' WHEN 2 THEN 'Sanskrit 99' ELSE 'Serif' END AS font, CASE WHEN line_no = 0 THEN 15 WHEN line_no % 6 = 1 THEN 13 ELSE 10 END AS size FROM (SELECT book_id, page_number, content_id AS page_id, i - 1 AS line_no, string_split(page_content, chr(10))[i] AS text FROM c_content, unnest(range(1, len(string_split(page_content, chr(10))) + 1)) AS r(i) WHERE page_content IS NOT NULL))"
_SPANS = ", " + _SP + " "
_MODE = "CASE WHEN page_number % 7 = 0 OR page_number % 11 = 0 THEN 'blocks' ELSE 'clip' END"
_DT = ", t AS (SELECT glossary_id, book_id, translate(term, 'ṛṣṅṁḍ', '®ß∫µ∂') AS term FROM c_glossary), er AS MATERIALIZED (SELECT *, CASE WHEN length(pattern) = 1 THEN 'character' ELSE 'pattern' END AS error_type FROM (" + " UNION ALL ".join(f"SELECT glossary_id, book_id, term, '{a}' AS pattern, replace(term, '{a}', '{b}') AS corrected FROM t WHERE contains(term, '{a}')" for a, b in X.ERRORS) + ")) "
_BANK = f", b AS MATERIALIZED (SELECT word_id, program_fixed AS old, {texts._fixed('m')} AS new FROM (SELECT word_id, program_fixed, {texts._map('raw_word')} AS m FROM c_bank)) "
_END = "CASE WHEN description IS NULL OR trim(description, ' ') = '' THEN 'empty' WHEN l = '.' THEN 'full stop' WHEN l IN ('?', '!') THEN 'other mark' WHEN l IN (')', ']') THEN 'bracket' WHEN l IN (',', ';', ':') THEN 'open mark' WHEN regexp_matches(l, '[0-9]') THEN 'digit' ELSE 'letter' END"
_STRIP = "regexp_replace(text, '^\\s+|\\s+$', '', 'g')"
_NEST = ", n0 AS (SELECT toc_id, book_id, CAST(toc_id AS VARCHAR) AS tree FROM c_toc)" + "".join(
    f", n{i + 1} AS MATERIALIZED (SELECT t.toc_id, t.book_id, concat(CAST(t.toc_id AS VARCHAR), CASE WHEN k.kids IS NOT NULL THEN concat('(', k.kids, ')') ELSE '' END) AS tree FROM c_toc t LEFT JOIN (SELECT c.parent_toc_id AS p, c.book_id AS b, string_agg(n.tree, ',' ORDER BY c.toc_id) AS kids FROM c_toc c JOIN n{i} n ON n.toc_id = c.toc_id WHERE c.parent_toc_id IS NOT NULL GROUP BY 1, 2) k ON k.p = t.toc_id AND k.b IS NOT DISTINCT FROM t.book_id)"
    for i in range(4)
)
_DELIM = r" \n\r\t.,;:!?()\[\]{}"
_CTX = f", w AS (SELECT book_id, page_number, unnest(regexp_extract_all(page_content, '[^{_DELIM}]+')) AS word, generate_subscripts(regexp_extract_all(page_content, '[^{_DELIM}]+'), 1) AS pos FROM c_content), h AS MATERIALIZED (SELECT book_id, page_number, pos, word, unnest(regexp_extract_all(word, '[^{texts.ALLOWED}]')) AS char FROM w)"
_COS = "round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9)"


def _core_sql() -> str:
    return library.ORACLE["core_page_range"]


def _only(kind: str) -> str:
    return f", om AS (SELECT book_id, page_number, CASE WHEN book_id % 4 = 1 THEN '{kind}' ELSE page_type END AS page_type FROM c_map), ol AS (SELECT book_id FROM om GROUP BY book_id HAVING count(DISTINCT page_type) = 1 AND max(page_type) = '{kind}')"


def _pairs(pairs) -> str:
    return f"'{''.join(a for a, _ in pairs)}', '{''.join(b for _, b in pairs)}'"


def _oracle() -> dict[str, str]:
    from .layouts import _TYPES

    plain = {
        "book_by_id": "SELECT book_id, pdf_name, original_book_title, english_book_title, number_of_pages, CAST(NULL AS VARCHAR) AS edition, toc_pages, CAST(NULL AS VARCHAR) AS glossary_pages FROM c_book WHERE book_id = 41",
        "books_chosen": "SELECT book_id, pdf_name FROM c_book WHERE book_id IN (41, 102, 105, 7)",
        "glyphs_chosen": "SELECT id, font_name, glyph FROM c_glyph WHERE glyph = 'ä'",
        "pages_of_type": "SELECT book_id, page_number FROM c_map WHERE page_type = 'Core'",
        "content_in_books": "SELECT c.book_id, c.page_number, CAST(length(page_content) AS INTEGER) AS chars FROM c_content c JOIN c_book b ON b.book_id = c.book_id WHERE page_content ILIKE '%wisdom%' AND c.book_id IN (41, 102)",
        "book_listing_limited": "SELECT book_id, original_book_title FROM c_book ORDER BY original_book_title, book_id LIMIT 5",
        "without_placeholders": "SELECT * FROM (SELECT book_id, CASE WHEN book_id % 4 = 0 THEN concat('[TO BE ADDED] ', pdf_name) WHEN book_id % 4 = 1 THEN NULL ELSE original_book_title END AS title FROM c_book) WHERE NOT coalesce(starts_with(title, '[TO BE ADDED]'), false)",
        "files_by_name_or_stem": ", f AS (SELECT CASE book_id % 3 WHEN 0 THEN concat(upper(regexp_replace(pdf_name, '\\.pdf$', '')), '.txt') WHEN 1 THEN concat('x', pdf_name) ELSE pdf_name END AS pdf_name FROM c_book) SELECT f.pdf_name, coalesce(a.book_id, b.book_id) AS book_id FROM f LEFT JOIN c_book a ON a.pdf_name = f.pdf_name LEFT JOIN c_book b ON lower(regexp_replace(b.pdf_name, '\\.[^.]*$', '')) = lower(regexp_replace(f.pdf_name, '\\.[^.]*$', ''))",
        "page_worklist": "SELECT book_id, CAST(unnest(range(3, number_of_pages + 1)) AS INTEGER) AS page_number FROM c_book WHERE number_of_pages >= 3",
        "valid_pages": "SELECT DISTINCT c.book_id, page_number * 2 - 5 AS page_number FROM c_content c JOIN c_book b ON b.book_id = c.book_id WHERE page_number * 2 - 5 BETWEEN 1 AND number_of_pages",
        "page_number_labels": "SELECT c.book_id, c.page_number, page_label FROM c_content c LEFT JOIN c_map m ON m.book_id = c.book_id AND m.page_number = c.page_number",
        "toc_roots": "SELECT toc_id, book_id, toc_level, toc_label FROM c_toc WHERE parent_toc_id IS NULL",
        "toc_item_exact": "SELECT book_id, toc_id, toc_level FROM c_toc WHERE toc_id % 10 = 0 OR toc_label = 'Contents' QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY toc_level, toc_id) = 1",
        "toc_item_like": "SELECT book_id, toc_id, toc_level FROM c_toc WHERE toc_label ILIKE '%chapter%' QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY toc_level, toc_id) = 1",
        "toc_nested": _NEST + " SELECT n.* FROM n4 n JOIN c_toc t ON t.toc_id = n.toc_id WHERE t.parent_toc_id IS NULL",
        "damaged_term_errors": _DT + "SELECT glossary_id, pattern, corrected, error_type FROM er",
        "term_error_breakdown": _DT + " UNION ALL ".join(f"SELECT * FROM (SELECT '{c}' AS kind, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM er GROUP BY 2 ORDER BY n DESC, value LIMIT 20)" for c in ("error_type", "pattern", "book_id")),
        "term_error_samples": _DT + "SELECT term, pattern, corrected FROM (SELECT * FROM er WHERE term IS NOT NULL QUALIFY row_number() OVER (PARTITION BY term ORDER BY glossary_id, pattern) = 1) ORDER BY glossary_id, pattern LIMIT 10",
        "word_bank_changes": _BANK + ", c AS (SELECT *, new IS NULL AND old IS NOT NULL AS failed, NOT (new IS NULL AND old IS NOT NULL) AND old IS DISTINCT FROM new AS changed FROM b) SELECT count(*) AS total, count(*) FILTER (WHERE changed) AS changed, count(*) FILTER (WHERE NOT changed AND NOT failed) AS unchanged, count(*) FILTER (WHERE failed) AS failed, "
        + ", ".join(f"count(*) FILTER (WHERE changed AND coalesce(contains(lower(old), '{m}'), false)) AS {k}" for k, m in (("with_n", "ñ"), ("with_a", "å"), ("with_r", "ṛ"))) + " FROM c",
        "word_bank_examples": _BANK + "SELECT * FROM b WHERE old IS DISTINCT FROM new ORDER BY word_id LIMIT 10",
        "upsert_counters": ", o AS (SELECT book_id, page_number, page_label FROM c_map), n AS (SELECT CASE WHEN page_number % 9 = 0 THEN NULL ELSE book_id END AS book_id, CASE WHEN page_number % 4 = 0 THEN page_number + 100000 ELSE page_number END AS page_number, CASE WHEN page_number % 2 = 0 THEN page_label ELSE 'new' END AS page_label FROM c_map) SELECT count(*) FILTER (WHERE n.book_id IS NOT NULL AND o.book_id IS NULL) AS inserted, count(*) FILTER (WHERE o.book_id IS NOT NULL AND coalesce(n.page_label, o.page_label) IS DISTINCT FROM o.page_label) AS updated, count(*) FILTER (WHERE o.book_id IS NOT NULL AND coalesce(n.page_label, o.page_label) IS NOT DISTINCT FROM o.page_label) AS unchanged, count(*) FILTER (WHERE n.book_id IS NULL) AS skipped FROM n LEFT JOIN o ON o.book_id = n.book_id AND o.page_number = n.page_number",
        "fix_report": texts._PAGE_WORDS + texts._JUDGED + " SELECT class AS part, row_number() OVER (PARTITION BY class ORDER BY n DESC, word) AS place, word, corrected, n FROM jw WHERE word <> corrected QUALIFY place <= 10 UNION ALL SELECT 'review', row_number() OVER (ORDER BY n DESC, word) AS place, word, corrected, n FROM jw WHERE confidence < 0.90 QUALIFY place <= 20",
        "ending_examples": f"SELECT glossary_id, {_END} AS ending, right(rtrim(description, ' '), 20) AS tail, row_number() OVER (PARTITION BY {_END} ORDER BY glossary_id) AS place FROM (SELECT *, right(rtrim(description, ' '), 1) AS l FROM c_glossary) QUALIFY place <= 20",
        "description_complete": "SELECT glossary_id, coalesce(right(rtrim(description, ' '), 1) IN ('.', ']', ')'), false) AS complete FROM c_glossary",
        "glyph_totals": "SELECT count(*) AS records, CAST(sum(occurrence_count) AS BIGINT) AS occurrences, count(DISTINCT font_name) AS fonts, count(DISTINCT glyph) AS glyphs FROM c_glyph",
        "font_top5": "SELECT font_name, CAST(sum(occurrence_count) AS BIGINT) AS total FROM c_glyph GROUP BY font_name ORDER BY total DESC NULLS LAST, font_name LIMIT 5",
        "glyph_contexts": _CTX + ", n AS (SELECT book_id, char, count(*) AS n FROM h GROUP BY ALL), p AS (SELECT book_id, char, string_agg(CAST(page_number AS VARCHAR), ',' ORDER BY page_number) AS pages FROM (SELECT DISTINCT book_id, char, page_number FROM h QUALIFY dense_rank() OVER (PARTITION BY book_id, char ORDER BY page_number) <= 20) GROUP BY ALL), f AS (SELECT book_id, char, word, min((page_number, pos)) AS a FROM h GROUP BY ALL), c AS (SELECT book_id, char, string_agg(word, ' ' ORDER BY k) AS contexts FROM (SELECT *, row_number() OVER (PARTITION BY book_id, char ORDER BY a, word) AS k FROM f) WHERE k <= 20 GROUP BY ALL) SELECT n.book_id, n.char, n, pages, contexts FROM n JOIN p ON p.book_id = n.book_id AND p.char = n.char JOIN c ON c.book_id = n.book_id AND c.char = n.char",
        "distinct_fonts": "SELECT DISTINCT font_name FROM c_glyph",
        "character_languages": ", x AS (SELECT unnest(regexp_extract_all(page_content, '[^\\r\\n]{0,30}à[^\\r\\n]{0,30}')) AS context FROM c_content) SELECT count(*) AS total, count(*) FILTER (WHERE regexp_matches(context, '[āīūṛṝḷḹṅñṭḍṇśṣṁṃḥ]')) AS sanskrit, count(*) FILTER (WHERE regexp_matches(lower(context), 'déjà|voilà|à la|là')) AS french, count(*) FILTER (WHERE regexp_matches(lower(context), 'naïve|naïf')) AS english FROM x",
        "sample_words_mapped": f"SELECT id, array_to_string([translate(w, {_pairs(T.SAMPLE_PAIRS)}) FOR w IN sample_words], '|') AS words FROM c_glyph",
        "safe_values": "SELECT book_id, page_number, coalesce(trim(page_label, ' '), '') AS label, nullif(trim(page_type, ' '), '') AS type, left(coalesce(trim(page_label, ' '), ''), 3) AS short, format('{:,}', page_number * 1000) AS thousands FROM c_map",
        "line_cleaning": "SELECT toc_id, trim(regexp_replace(regexp_replace(regexp_replace(concat('• ', coalesce(toc_label, ''), ' ......  x'), '^[\\s•·▪◦*\\-–—]+', ''), '\\.{3,}|…', '…', 'g'), '\\s+', ' ', 'g'), ' ') AS line FROM c_toc",
        "image_types": "SELECT book_id, page_number, CASE page_number % 5 WHEN 0 THEN 'jpeg' WHEN 1 THEN 'png' WHEN 2 THEN 'gif' WHEN 3 THEN 'webp' ELSE 'png' END AS extension FROM c_map",
        "word_contexts": f"SELECT content_id, unnest(regexp_extract_all(page_content, '[^{_DELIM}]*ñ[^{_DELIM}]*')) AS word FROM c_content",
        "block_bodies": _SPANS + f"SELECT page_id, string_agg({_STRIP}, chr(10) ORDER BY floor(y0 / 24), line_no) AS text FROM sp WHERE floor(y0 / 24) >= 1 AND y1 <= 300 AND {_STRIP} <> '' GROUP BY page_id",
        "page_modes": f"SELECT content_id AS page_id, CASE WHEN page_number % 7 = 0 THEN 90 ELSE 0 END AS rotation, CASE WHEN page_number % 11 = 0 THEN -1.0 ELSE 1.0 END AS flip, {_MODE} AS mode FROM c_content WHERE page_content IS NOT NULL",
        "page_extracts": _SPANS + f", m AS (SELECT content_id AS page_id, {_MODE} AS mode FROM c_content WHERE page_content IS NOT NULL), a AS (SELECT page_id, string_agg(text, chr(10) ORDER BY line_no) AS text FROM sp WHERE y0 >= 12 AND y0 < 240 GROUP BY page_id), b AS (SELECT page_id, string_agg({_STRIP}, chr(10) ORDER BY y0, line_no) AS text FROM sp WHERE y0 >= 12 AND y1 <= 240 AND {_STRIP} <> '' GROUP BY page_id) SELECT m.page_id, mode, coalesce(CASE WHEN mode = 'clip' THEN a.text ELSE b.text END, '') AS text FROM m LEFT JOIN a ON a.page_id = m.page_id LEFT JOIN b ON b.page_id = m.page_id",
        "page_extract_facts": "SELECT c.book_id, original_book_title AS book_title, english_book_title AS english_title, page_number, 'body' AS extraction_type, CAST(CASE WHEN b.book_id IS NOT NULL AND page_content IS NOT NULL THEN length(page_content) ELSE 0 END AS INTEGER) AS content_length, b.book_id IS NOT NULL AND c.book_id % 2 = 0 AS header_available, b.book_id IS NOT NULL AS footer_available, b.book_id IS NOT NULL AND page_content IS NOT NULL AS extraction_successful FROM c_content c LEFT JOIN (SELECT * FROM c_book WHERE book_id % 5 <> 0) b ON b.book_id = c.book_id",
        "content_rects": "SELECT book_id, page_number, CASE WHEN h >= b THEN 0.0 ELSE h END AS top, CASE WHEN h >= b THEN 600.0 ELSE b END AS bottom FROM (SELECT *, CASE WHEN f > 300 THEN f ELSE 600 - f END AS b FROM (SELECT book_id, page_number, CASE WHEN page_number % 5 = 0 THEN 0.0::DOUBLE ELSE 24.0 END AS h, CASE page_number % 3 WHEN 0 THEN 560.0::DOUBLE WHEN 1 THEN 36.0 ELSE 590.0 + page_number % 20 END AS f FROM c_map))",
        "edge_texts": _SPANS + "SELECT page_id, coalesce(string_agg(trim(text, ' '), ' | ' ORDER BY line_no) FILTER (WHERE y0 < 32 AND trim(text, ' ') <> ''), '') AS header_text, coalesce(string_agg(trim(text, ' '), ' | ' ORDER BY line_no) FILTER (WHERE y0 >= 178 AND trim(text, ' ') <> ''), '') AS footer_text FROM sp GROUP BY page_id",
        "page_texts_without_fonts": _SPANS + "SELECT page_id, string_agg(text, chr(10) ORDER BY line_no) AS text FROM sp WHERE line_no % 6 NOT IN (0, 2) AND y0 >= 12 AND y0 < 480 GROUP BY page_id",
        "font_prefix_excluded": _SPANS + "SELECT font, count(*) AS n FROM sp WHERE font <> 'AARitu' GROUP BY font",
        "batch_texts": _SPANS + "SELECT c.content_id AS page_id, c.page_number, coalesce(t.text, '') AS text FROM c_content c LEFT JOIN (SELECT page_id, string_agg(text, chr(10) ORDER BY line_no) AS text FROM sp WHERE y0 < 600 GROUP BY page_id) t ON t.page_id = c.content_id WHERE c.page_number BETWEEN 2 AND 4",
        "font_ranking": _SPANS + ", k AS (SELECT book_id, font, CASE WHEN regexp_matches(text, '[\\x{0900}-\\x{097F}]') THEN 'dev' WHEN regexp_matches(text, '[āīūṛṝṣśṅñṁḥḍṭṇḷ]') THEN 'iast' WHEN regexp_matches(text, '[äåçéëïöüìùòà]') THEN 'legacy' ELSE 'other' END AS kind FROM sp WHERE trim(text, ' ') <> '') SELECT book_id, font, count(*) AS spans, " + ", ".join(f"count(*) FILTER (WHERE kind = '{x}') AS {x}" for x in ("dev", "iast", "legacy", "other")) + " FROM k GROUP BY book_id, font",
        "font_sizes": _SPANS + ", q AS (SELECT * FROM sp WHERE trim(text, ' ') <> ''), a AS (SELECT book_id, font, string_agg(concat(size, ':', n), ' ' ORDER BY size) AS sizes FROM (SELECT book_id, font, size, count(*) AS n FROM q GROUP BY ALL) GROUP BY ALL), f AS (SELECT book_id, font, text, min((page_id, line_no)) AS o FROM q GROUP BY ALL), b AS (SELECT book_id, font, string_agg(text, ' | ' ORDER BY k) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY book_id, font ORDER BY o, text) AS k FROM f) WHERE k <= 5 GROUP BY ALL) SELECT a.book_id, a.font, sizes, samples FROM a JOIN b ON b.book_id = a.book_id AND b.font = a.font",
        "sampled_fonts": _SPANS + "SELECT DISTINCT sp.book_id, font FROM sp JOIN c_book b ON b.book_id = sp.book_id WHERE (page_number - 1) % greatest(1, CAST(floor(number_of_pages / 4) AS INTEGER)) = 0",
        "html_styles": _SPANS + "SELECT page_id, CAST(line_no AS INTEGER) AS line_no, concat(CASE WHEN b THEN '<b>' ELSE '' END, CASE WHEN i THEN '<i>' ELSE '' END, text, CASE WHEN i THEN '</i>' ELSE '' END, CASE WHEN b THEN '</b>' ELSE '' END) AS html FROM (SELECT *, line_no % 5 = 1 OR line_no % 6 = 1 AS b, line_no % 5 IN (0, 1) AS i FROM sp)",
        "html_books": _SPANS + "SELECT book_id, page_number, concat('<html><head><meta charset=\"utf-8\"/><meta name=\"book\" content=\"', book_id, '\"/><meta name=\"page\" content=\"', page_number, '\"/></head><body>', chr(10), string_agg(CASE WHEN line_no = 3 THEN '<img src=\"data:image/png;base64,AA==\"/>' WHEN size > 14 THEN concat('<h1>', t, '</h1>') WHEN size > 12 THEN concat('<h2>', t, '</h2>') ELSE concat('<p>', t, '</p>') END, chr(10) ORDER BY line_no), chr(10), '</body></html>') AS html FROM (SELECT *, CASE WHEN font = 'Serif-Bold' THEN concat('<b>', text, '</b>') ELSE text END AS t FROM sp) WHERE book_id NOT IN (SELECT book_id FROM c_book WHERE book_id % 2 = 0) GROUP BY book_id, page_number",
        "page_pipeline": _SPANS + f", r AS (SELECT book_id, page_number, {texts._map('text')} AS m FROM (SELECT book_id, page_number, string_agg(text, chr(10) ORDER BY line_no) AS text FROM sp WHERE line_no % 6 NOT IN (0, 2) AND y0 < 600 GROUP BY book_id, page_number)), n AS (SELECT book_id, page_number, CASE WHEN m = '' THEN '' ELSE array_to_string([{texts._fixed('t')} FOR t IN regexp_extract_all(m, '{texts._TOKEN}')], '') END AS fixed FROM r) SELECT c.book_id, c.page_number, CASE WHEN c.page_number % 2 = 0 AND page_content <> '' THEN page_content ELSE coalesce(fixed, CASE WHEN c.page_number % 2 = 0 THEN page_content END) END AS page_content FROM c_content c LEFT JOIN n ON n.book_id = c.book_id AND n.page_number = c.page_number WHERE c.page_number % 2 = 0 OR n.book_id IS NOT NULL",
        "core_content": _SPANS + f"SELECT sp.book_id, sp.page_number, {texts._map('string_agg(text, chr(10) ORDER BY line_no)')} AS page_content FROM sp JOIN c_map m ON m.book_id = sp.book_id AND m.page_number = sp.page_number WHERE page_type = 'Core' AND y0 >= 12 AND y0 < 480 GROUP BY sp.book_id, sp.page_number",
        "import_books": "SELECT (SELECT max(book_id) FROM c_book WHERE book_id % 2 = 0) + row_number() OVER (ORDER BY pdf_name) AS book_id, pdf_name, number_of_pages FROM c_book WHERE book_id % 2 = 1",
        "import_page_map": ", f AS (SELECT book_id AS old, (SELECT max(book_id) FROM c_book WHERE book_id % 2 = 0) + row_number() OVER (ORDER BY pdf_name) AS book_id FROM c_book WHERE book_id % 2 = 1) SELECT f.book_id, page_number, coalesce(nullif(trim(page_label, ' '), ''), CAST(page_number AS VARCHAR)) AS page_label FROM c_map m JOIN f ON f.old = m.book_id",
        "import_contents": ", n AS MATERIALIZED (SELECT (SELECT max(toc_id) FROM c_toc) + row_number() OVER (ORDER BY book_id, toc_id) AS toc_id, book_id, toc_level, trim(toc_label, ' ') AS toc_label FROM c_toc WHERE book_id % 3 = 0) SELECT toc_id, book_id, toc_level, toc_label, parent_toc_id FROM c_toc WHERE NOT coalesce(book_id % 3 = 0, false) UNION ALL SELECT c.toc_id, c.book_id, c.toc_level, c.toc_label, CASE WHEN c.toc_level > 1 AND p.toc_level = c.toc_level - 1 THEN p.toc_id END FROM n c LEFT JOIN LATERAL (SELECT max_by(toc_level, toc_id) AS toc_level, max(toc_id) AS toc_id FROM n q WHERE q.book_id = c.book_id AND q.toc_id < c.toc_id AND q.toc_level < c.toc_level) p ON true",
        "import_page_labels": "SELECT book_id, page_number, CASE WHEN page_number % 2 = 0 THEN coalesce(nullif(trim(page_label, ' '), ''), page_label) ELSE page_label END AS page_label FROM c_map",
        "vector_topk_terms": f", v AS MATERIALIZED (SELECT glossary_id, embedding FROM {V.current_sql('glossary_embeddings')} WHERE len(embedding) = 96 AND len([x FOR x IN embedding IF x IS NULL OR isnan(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0) SELECT k.glossary_id, neighbour, place, g.term FROM (SELECT a.glossary_id, b.glossary_id AS neighbour, row_number() OVER (PARTITION BY a.glossary_id ORDER BY {_COS} DESC, b.glossary_id) AS place FROM v a JOIN v b ON b.glossary_id <> a.glossary_id WHERE a.glossary_id % 50 = 0 QUALIFY place <= 3) k JOIN c_glossary g ON g.glossary_id = neighbour",
    }
    bare = {
        "ambiguous_words_mapped": f"SELECT id, translate(word, {_pairs(T.WORD_PAIRS)}) AS word FROM {V.current_sql('ambiguous_diacritic_words')}",
        "extraction_summary": "SELECT count(*) AS total, count(*) FILTER (WHERE length(text) > 0) AS successful, count(*) - count(*) FILTER (WHERE length(text) > 0) AS failed FROM documents",
        "clean_summaries": "SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g'), '\\n\\s*\\n\\s*\\n+', concat(chr(10), chr(10)), 'g'), '[^\\S\\n]+', ' ', 'g'), '(?m)^ +| +$', '', 'g'), '^\\n+|\\n+$', '', 'g')) AS text FROM documents",
        "verse_texts": "SELECT doc_id, md5(array_to_string([regexp_replace(x, '\\s+$', '') FOR x IN string_split_regex(regexp_replace(text, '(?:\\.\\s*){3,}', '.....', 'g'), '\\r\\n|\\r|\\n')], chr(10))) AS text FROM documents WHERE text IS NOT NULL",
        "thumbnail_sizes": "SELECT p_partkey, CAST(greatest(1, round(w * s)) AS INTEGER) AS width, CAST(greatest(1, round(h * s)) AS INTEGER) AS height, greatest(1, round(w * s)) < 400 OR greatest(1, round(h * s)) < 400 AS sharpen FROM (SELECT *, least(1.0::DOUBLE, 400.0::DOUBLE / greatest(w, h)) AS s FROM (SELECT p_partkey, p_size * 40 AS w, p_size * 20 + 100 AS h FROM part))",
        "largest_pages": "SELECT p_partkey % 50 AS doc, max(p_size) AS w, max(p_retailprice) AS h FROM part GROUP BY 1",
        "dominant_heights": "WITH p AS (SELECT p_partkey % 40 AS book_id, p_size % 7 + (p_partkey % 3) / 100 AS h FROM part), n AS (SELECT book_id, round(h, 1) AS r, count(*) AS c FROM p GROUP BY ALL), m AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY c DESC, r) = 1) SELECT p.book_id, round(median(h), 6) AS height FROM p JOIN m ON m.book_id = p.book_id AND m.r = round(h, 1) GROUP BY p.book_id",
        "core_summary": f"SELECT count(*) AS books, count(*) FILTER (WHERE ok) AS analysed, CAST(coalesce(sum(n), 0) AS BIGINT) AS core_pages, round(avg(n), 4) AS average, round(count(*) FILTER (WHERE ok) * 100 / count(*), 4) AS rate FROM (SELECT *, coalesce(core_start <> 0 AND core_end <> 0, false) AS ok, CASE WHEN core_start <> 0 AND core_end <> 0 THEN core_end - core_start + 1 END AS n FROM ({_core_sql()}))",
        "toc_messages": f"WITH v AS MATERIALIZED ({library.ORACLE['toc_validation']}) SELECT book_id, 'no entries of the first level' AS message FROM v WHERE level_one = 0 UNION ALL SELECT book_id, 'entries without a label' FROM v WHERE no_label > 0 UNION ALL SELECT book_id, 'entries whose parent is missing' FROM v WHERE orphaned > 0 UNION ALL SELECT book_id, 'entries without a page' FROM v WHERE own_page + computed_page < total",
        "toc_error_report": f"WITH e AS MATERIALIZED ({library.ORACLE['toc_backfill_errors']}) SELECT book_id AS book, -1 AS item, 0 AS part, concat('Book ', coalesce(CAST(book_id AS VARCHAR), '-'), ': ', count(*), ' unresolved') AS line FROM e GROUP BY book_id UNION ALL SELECT book_id, toc_id, 0, concat('  toc_id: ', toc_id) FROM e UNION ALL SELECT book_id, toc_id, 1, concat('  toc_level: ', coalesce(CAST(toc_level AS VARCHAR), '-')) FROM e",
        "vector_topk_all": f"SELECT a.vec_id, b.vec_id AS neighbour, row_number() OVER (PARTITION BY a.vec_id ORDER BY {_COS} DESC, b.vec_id) AS place FROM embeddings a JOIN embeddings b ON b.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0 QUALIFY place <= 5",
        "vector_upsert": "SELECT coalesce(o.vec_id, n.vec_id) AS vec_id, coalesce(n.first, o.first) AS first FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first FROM embeddings) o FULL JOIN (SELECT vec_id * 2 AS vec_id, CAST(embedding[1] AS DOUBLE) + 1 AS first FROM embeddings WHERE vec_id % 3 = 0) n ON n.vec_id = o.vec_id",
        "full_page_types": _TYPES
        + ", u AS (SELECT *, coalesce(book_id % 3 = 0 AND page_number BETWEEN 8 AND 11, false) AS vin, coalesce(book_id % 2 = 0 AND page_number BETWEEN 6 AND 8, false) AS gin FROM ty), w AS (SELECT *, CASE WHEN vin THEN 'Verse Index' WHEN gin THEN 'Glossary' ELSE ot END AS t2, inr OR vin OR gin AS anyr FROM u), xi AS (SELECT w.*, CASE WHEN t2 = 'Core' AND m.book_id IS NOT NULL THEN CASE WHEN w.page_number % 8 = 0 THEN 'high' ELSE 'medium' END END AS im FROM w LEFT JOIN (SELECT * FROM c_map WHERE page_number % 4 = 0) m ON m.book_id = w.book_id AND m.page_number = w.page_number)"
        + " SELECT book_id, page_number, CASE WHEN em THEN 'Empty' WHEN pub >= 6 AND NOT anyr THEN 'Publisher Info' WHEN im IS NOT NULL THEN 'Image Page' ELSE t2 END AS page_type, CASE WHEN em THEN 'high' WHEN pub >= 6 AND NOT anyr THEN CASE WHEN pub >= 9 THEN 'high' ELSE 'medium' END WHEN im IS NOT NULL THEN im WHEN anyr THEN 'high' WHEN b THEN 'medium' ELSE 'low' END AS confidence, CAST(CASE WHEN em THEN 9 WHEN pub >= 6 AND NOT anyr THEN pub WHEN im IS NOT NULL THEN 8 WHEN anyr THEN 10 WHEN b THEN 6 ELSE 3 END AS DOUBLE) AS score, t2 AS original_type FROM xi",
        "page_reclassification": _TYPES + _only("Primary") + " SELECT pt.book_id, pt.page_number, pt.page_type FROM pt JOIN om ON om.book_id = pt.book_id AND om.page_number = pt.page_number WHERE pt.book_id IN (SELECT book_id FROM ol) AND om.page_type = 'Primary' AND pt.page_type <> 'Primary'",
    }
    return {k: BASE + v for k, v in plain.items()} | bare


ORACLE = _oracle()
