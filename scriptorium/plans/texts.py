"""Transliteration, label, glyph and vector queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import text as X
from ..functions import transliteration as T
from ..operators import glyphs as G
from ..operators import vectors as N
from ..tables import load
from . import views as V
from .views import BASE


def _words(s, d):
    return T.words_of(V.content(s, d), "page_content").groupBy("word").agg(F.count("*").alias("n"))


def _label_lines(s, d):
    return V.content(s, d).select("content_id", F.element_at(F.split(F.trim("page_content"), "\n"), -1).alias("footer"))


def _query(s, d):
    return [float(x) for x in load(s, d, "embeddings").where("vec_id = 0").select("embedding").first()[0]]


ALLOWED = r"\x00-\x7fāīūṛṝṣśṅñṁḥḍṭṇḷĀĪŪṚṢŚṄÑṀḤḌṬṆ“”‘’—–"

QUERIES = {
    "charmap_fix": lambda s, d: V.content(s, d).select("content_id", T.map_glyphs(F.col("page_content")).alias("text")),
    "charmap_counts": lambda s, d: V.content(s, d).agg(*[F.sum(T.glyph_count(F.col("page_content"), g)).alias(f"g{i}") for i, (g, _) in enumerate(T.PAIRS)]).select(F.inline(F.array(*[F.struct(F.lit(g).alias("glyph"), F.col(f"g{i}").alias("n")) for i, (g, _) in enumerate(T.PAIRS)]))),
    "fix_pages": lambda s, d: V.content(s, d).select("content_id", T.fix_text(F.col("page_content")).alias("text")),
    "word_rules": lambda s, d: V.word_bank(s, d).select("word_id", T.fix_a(T.fix_n(F.lower("raw_word"))).alias("fixed")),
    "word_corrections": lambda s, d: T.corrections(_words(s, d)),
    "page_fix_stats": lambda s, d: T.page_statistics(V.content(s, d), "content_id", "page_content"),
    "word_bank_update": lambda s, d: V.word_bank(s, d).select("word_id", T.fix_word(T.map_glyphs(F.col("raw_word"))).alias("new_value"), "program_fixed").where("not (new_value <=> program_fixed)").select("word_id", "new_value"),
    "word_bank_coverage": lambda s, d: V.word_bank(s, d).agg(F.count("*").alias("total"), F.count("raw_word").alias("raw"), F.count("program_fixed").alias("program"), F.count("ai_fixed").alias("ai")),
    "range_parse": lambda s, d: V.book(s, d).select("book_id", "toc_pages", L.range_bounds(F.col("toc_pages"))[0].alias("lo"), L.range_bounds(F.col("toc_pages"))[1].alias("hi")),
    "range_format": lambda s, d: V.book(s, d).select("book_id", L.format_range(F.concat(F.col("book_id").cast("string"), F.lit("-"), (F.col("book_id") + 5).cast("string"))).alias("formatted")),
    "page_label_extract": lambda s, d: _label_lines(s, d).select("content_id", L.label_of(F.col("footer")).alias("label")),
    "text_statistics": lambda s, d: V.content(s, d).where("page_content is not null").select("content_id", *[c.alias(k) for k, c in X.statistics(F.col("page_content")).items()]),
    "publisher_score": lambda s, d: load(s, d, "documents").where("text is not null").select("doc_id", X.publisher_score(F.col("text")).alias("score")).withColumn("confidence", X.confidence(F.col("score"))),
    "glossary_term_errors": lambda s, d: V.glossary(s, d).select("glossary_id", F.explode(X.term_errors(F.col("term"))).alias("e")).select("glossary_id", "e.pattern", "e.corrected"),
    "description_endings": lambda s, d: V.glossary(s, d).groupBy(X.ending(F.col("description")).alias("ending")).agg(F.count("*").alias("n")),
    "glyph_words": lambda s, d: G.glyph_words(V.content(s, d)),
    "glyph_summary": lambda s, d: G.glyph_summary(V.glyph_words(s, d)),
    "glyph_top5": lambda s, d: G.top(V.glyph_words(s, d), "glyph"),
    "char_glyphs": lambda s, d: G.char_glyphs(V.content(s, d), ALLOWED).withColumn("codepoint", X.code_point(F.col("char"))),
    "ambiguous_words": lambda s, d: G.ambiguous_words(V.content(s, d)),
    "ambiguous_words_in_order": lambda s, d: G.ambiguous_words_in_order(V.content(s, d)),
    "font_profile": lambda s, d: G.script_profile(V.content(s, d)),
    "vector_topk": lambda s, d: N.top_k(load(s, d, "embeddings"), _query(s, d), 10).select("vec_id", F.round("similarity", 5).alias("similarity")),
    "vector_missing": lambda s, d: N.pending(V.glossary(s, d).select("glossary_id"), load(s, d, "glossary_embeddings").select("glossary_id").distinct(), "glossary_id"),
    "vector_lengths": lambda s, d: N.wrong_length(load(s, d, "glossary_embeddings").select("glossary_id", "embedding"), 96, "glossary_id", "embedding").distinct(),
}


def _map(c: str) -> str:
    for a, b in T.DIGRAPHS:
        c = f"replace({c}, '{a}', '{b}')"
    return f"translate({c}, '{''.join(a for a, _ in T.PAIRS)}', '{''.join(b for _, b in T.PAIRS)}')"


def _rules(w: str) -> str:
    c = f"replace(replace({w}, 'jñ', chr(1)), 'ñc', chr(2))"
    c = f"regexp_replace({c}, '([aāiīuūṛeēoō])ñj', concat('\\1', chr(3)), 'g')"
    c = f"replace(replace(replace(replace({c}, 'ñ', 'ṣ'), chr(1), 'jñ'), chr(2), 'ñc'), chr(3), 'ñj')"
    for a, b in T.A_RULES:
        c = f"regexp_replace({c}, '{a}', '{b.replace('$', chr(92))}', 'g')"
    return c


def _cased(fixed: str, word: str) -> str:
    """Case of a word on its corrected form."""
    letters = f"regexp_replace({word}, '[^\\p{{L}}]', '', 'g')"
    at = f"length(regexp_replace(substr({fixed}, 1, i), '[^\\p{{L}}]', '', 'g'))"
    one = f"CASE WHEN NOT regexp_matches(c, '\\p{{L}}') OR {at} > length({letters}) THEN c WHEN substr({letters}, {at}, 1) = lower(substr({letters}, {at}, 1)) THEN lower(c) ELSE upper(c) END"
    mixed = f"array_to_string([{one} FOR c, i IN string_split({fixed}, '')], '')"
    return f"CASE WHEN {letters} = lower({letters}) THEN lower({fixed}) WHEN {letters} = upper({letters}) THEN upper({fixed}) WHEN {letters} = upper({letters}[1]) || lower({letters}[2:]) THEN upper({fixed}[1]) || lower({fixed}[2:]) ELSE {mixed} END"


def _fixed(word: str) -> str:
    return f"CASE WHEN regexp_matches({word}, '[ñÑåÅ]') THEN {_cased('(' + _rules(f'lower({word})') + ')', word)} ELSE {word} END"


_SPACE = r"\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_TOKEN = rf"(?s)[{T.LETTERS}\-]+|[{_SPACE}]+|[^{_SPACE}\p{{L}}\p{{M}}\p{{Nd}}\p{{Nl}}\p{{Pc}}]+|\p{{Nd}}+|."


def _n(pattern: str) -> str:
    return f"CAST(len(regexp_extract_all({{t}}, '{pattern}')) AS BIGINT)"


def _stats(t: str) -> dict[str, str]:
    lines = f"[trim(x, ' ') FOR x IN string_split_regex({t}, '\\r?\\n')]"
    titled = f"[x FOR x IN {lines} IF length(x) BETWEEN 3 AND 80 AND regexp_matches(x, '^([A-Z][A-Za-z'']*\\s*)+$')]"
    out = {k: _n(p).format(t=t) if "{" not in p else f"CAST(len(regexp_extract_all({t}, '{p}')) AS BIGINT)" for k, p in (("words", r"\S+"), ("numbers", "[0-9]+"), ("urls", X.URL), ("mails", X.MAIL), ("phones", X.PHONE))}
    out["titles"] = f"CAST(len({titled}) AS BIGINT)"
    out["caps"] = f"CAST(len([x FOR x IN {titled} IF regexp_matches(x, '^[A-Z'' ]+$')]) AS BIGINT)"
    return out


_S = _stats("text")
_POINTS = (
    [f"CASE WHEN regexp_matches(text, '(?i){p}') THEN 3 ELSE 0 END" for p in X.PUBLISHER]
    + [f"CASE WHEN regexp_matches(text, '(?i){X.OTHER}') THEN -2 ELSE 0 END"]
    + [f"CASE WHEN {c} THEN {n} ELSE 0 END" for c, n in (("urls >= 3", 2), ("mails >= 1", 1), ("phones >= 3", 2), ("words <= 250 AND urls + mails + phones >= 5", 3), ("numbers >= 30 AND words <= 500", 2), ("titles >= 8", 2), ("caps >= 4", 1), ("contains(lower(text), 'license') AND contains(lower(text), 'creative')", 2))]
)
_ERR = " UNION ALL ".join(f"SELECT glossary_id, '{a}' AS pattern, replace(term, '{a}', '{b}') AS corrected FROM c_glossary WHERE contains(term, '{a}')" for a, b in X.ERRORS)
_W = G.WORD.replace("'", "''")
_GL = f"[{G.GLYPHS + G.UPPER}]"
_HIT = f", w AS (SELECT book_id, page_number, unnest(regexp_extract_all(page_content, '{_W}')) AS word, generate_subscripts(regexp_extract_all(page_content, '{_W}'), 1) AS pos FROM c_content), h AS (SELECT book_id, page_number, pos, word, unnest(list_distinct(regexp_extract_all(word, '{_GL}'))) AS glyph FROM w WHERE regexp_matches(word, '{_GL}'))"
_LABEL = "coalesce(" + ", ".join(f"CASE WHEN x{i} <> '' AND length(x{i}) <= 20 AND (regexp_matches(regexp_replace(x{i}, '[\\-._]', '', 'g'), '^[0-9]{{1,10}}$') OR regexp_matches(regexp_replace(x{i}, '[\\-._]', '', 'g'), '(?i)^[ivxlcdm]{{1,15}}$') OR regexp_matches(regexp_replace(x{i}, '[\\-._]', '', 'g'), '^[0-9A-Za-z]{{1,10}}$')) THEN x{i} END" for i in range(6)) + ", '')"
_XS = ", ".join(f"replace(coalesce(regexp_extract(footer, '(?i){s}', 1), ''), ' ', '') AS x{i}" for i, s in enumerate(L.SHAPES))

_PAGE_WORDS = f", pw AS MATERIALIZED (SELECT content_id, word FROM (SELECT content_id, unnest(regexp_extract_all({_map('page_content')}, '{_TOKEN}')) AS word FROM c_content) WHERE regexp_matches(word, '^[{T.LETTERS}\\-]+$'))"
_JUDGED = (
    f", dw AS MATERIALIZED (SELECT word, count(*) AS n, CAST(len(regexp_extract_all(lower(word), 'ñ')) AS INTEGER) AS qn, CAST(len(regexp_extract_all(lower(word), 'å')) AS INTEGER) AS qa, {_fixed('word')} AS corrected FROM pw GROUP BY word)"
    + ", cw AS (SELECT *, CASE WHEN qn > 0 AND qa > 0 THEN 'BOTH' WHEN qn > 1 THEN 'MULTIPLE_N' WHEN qa > 1 THEN 'MULTIPLE_A' WHEN qn = 1 THEN 'SINGLE_N' WHEN qa = 1 THEN 'SINGLE_A' ELSE 'CLEAN' END AS class, contains(regexp_replace(lower(corrected), 'jñ|ñc|ñj', '', 'g'), 'ñ') OR contains(lower(corrected), 'å') AS error,"
    + f" CAST(CASE WHEN abs(length(corrected) - length(word)) > 2 THEN 1 ELSE 0 END + len(regexp_extract_all(regexp_replace(lower(corrected), '[{T.IAST}]', '', 'g'), '\\p{{L}}')) AS INTEGER) AS warnings FROM dw)"
    + ", jw AS MATERIALIZED (SELECT *, warnings > 0 AS warning, round(CASE class WHEN 'CLEAN' THEN 1.0::DOUBLE WHEN 'SINGLE_N' THEN 0.99 WHEN 'SINGLE_A' THEN 0.99 ELSE 0.95 END * CASE WHEN error THEN 0.7::DOUBLE ELSE 1.0 END * CASE WHEN warnings > 0 THEN 0.9::DOUBLE ELSE 1.0 END, 6) AS confidence FROM cw)"
)
_TAGGED = "CASE WHEN word <> corrected THEN concat_ws(' ', " + ", ".join(f"CASE WHEN contains(lower(word), '{a}') AND contains(lower(corrected), '{b}') THEN '{a}→{b}' END" for a, b in T.TAGS) + ") ELSE '' END AS tags"
_CLASSES = ", ".join(f"count(*) FILTER (WHERE class = '{k}') AS {k.lower()}" for k in ("CLEAN", "SINGLE_N", "SINGLE_A", "BOTH", "MULTIPLE_N", "MULTIPLE_A"))

ORACLE = {
    k: BASE + v
    for k, v in {
        "charmap_fix": f"SELECT content_id, {_map('page_content')} AS text FROM c_content",
        "charmap_counts": "SELECT glyph, CAST(sum(length(page_content) - length(replace(page_content, glyph, ''))) AS BIGINT) AS n FROM c_content, (VALUES " + ", ".join(f"('{g}')" for g, _ in T.PAIRS) + ") g(glyph) GROUP BY glyph",
        "word_rules": f"SELECT word_id, {_rules('lower(raw_word)')} AS fixed FROM c_bank",
        "fix_pages": f"SELECT content_id, CASE WHEN page_content = '' THEN '' ELSE array_to_string([{_fixed('t')} FOR t IN regexp_extract_all({_map('page_content')}, '{_TOKEN}')], '') END AS text FROM c_content",
        "word_bank_update": f"SELECT word_id, v AS new_value FROM (SELECT word_id, program_fixed, {_fixed('m')} AS v FROM (SELECT word_id, program_fixed, {_map('raw_word')} AS m FROM c_bank)) WHERE v IS DISTINCT FROM program_fixed",
        "word_corrections": _PAGE_WORDS + _JUDGED + f" SELECT word, n, class, corrected, {_TAGGED}, error, warning, warnings, confidence, confidence < 0.90 AS review FROM jw",
        "page_fix_stats": _PAGE_WORDS + _JUDGED + f" SELECT content_id, count(*) AS words, count(*) FILTER (WHERE pw.word <> corrected) AS corrected, {_CLASSES}, count(*) FILTER (WHERE confidence < 0.90) AS review, count(*) FILTER (WHERE error) AS errors FROM pw JOIN jw ON jw.word = pw.word GROUP BY content_id",
        "word_bank_coverage": "SELECT count(*) AS total, count(raw_word) AS raw, count(program_fixed) AS program, count(ai_fixed) AS ai FROM c_bank",
        "range_parse": "SELECT book_id, toc_pages, CASE WHEN lo > 0 AND hi >= lo THEN lo END AS lo, CASE WHEN lo > 0 AND hi >= lo THEN hi END AS hi FROM (SELECT book_id, toc_pages, try_cast(regexp_extract(toc_pages, '([0-9]+)\\s*,', 1) AS INTEGER) AS lo, CAST(try_cast(regexp_extract(toc_pages, ',\\s*([0-9]+)', 1) AS INTEGER) - CASE WHEN toc_pages LIKE '%)' THEN 1 ELSE 0 END AS INTEGER) AS hi FROM c_book)",
        "range_format": "SELECT book_id, concat('[', book_id, ',', book_id + 6, ')') AS formatted FROM c_book",
        "page_label_extract": f"SELECT content_id, CASE WHEN footer IS NULL THEN '' ELSE {_LABEL} END AS label FROM (SELECT content_id, footer, {_XS} FROM (SELECT content_id, string_split(trim(page_content, ' '), chr(10))[-1] AS footer FROM c_content))",
        "text_statistics": "SELECT content_id, " + ", ".join(f"{v} AS {k}" for k, v in _stats("page_content").items()) + " FROM c_content WHERE page_content IS NOT NULL",
        "publisher_score": "SELECT doc_id, score, CASE WHEN score >= 9 THEN 'high' WHEN score >= 6 THEN 'medium' WHEN score >= 4 THEN 'low' ELSE 'very_low' END AS confidence FROM (SELECT doc_id, " + " + ".join(_POINTS) + " AS score FROM (SELECT doc_id, text, " + ", ".join(f"{v} AS {k}" for k, v in _S.items()) + " FROM documents WHERE text IS NOT NULL))",
        "glossary_term_errors": _ERR,
        "description_endings": "SELECT CASE WHEN description IS NULL OR trim(description, ' ') = '' THEN 'empty' WHEN l = '.' THEN 'full stop' WHEN l IN ('?', '!') THEN 'other mark' WHEN l IN (')', ']') THEN 'bracket' WHEN l IN (',', ';', ':') THEN 'open mark' WHEN regexp_matches(l, '[0-9]') THEN 'digit' ELSE 'letter' END AS ending, count(*) AS n FROM (SELECT description, right(rtrim(description, ' '), 1) AS l FROM c_glossary) GROUP BY 1",
        "glyph_words": _HIT + ", p AS (SELECT DISTINCT book_id, glyph, page_number FROM h), p2 AS (SELECT book_id, glyph, string_agg(CAST(page_number AS VARCHAR), ',' ORDER BY page_number) AS pages FROM (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY book_id, glyph ORDER BY page_number) <= 20) GROUP BY ALL), f AS (SELECT book_id, glyph, word, min((page_number, pos)) AS a FROM h GROUP BY ALL), f2 AS (SELECT book_id, glyph, string_agg(word, ',' ORDER BY k) AS words FROM (SELECT *, row_number() OVER (PARTITION BY book_id, glyph ORDER BY a, word) AS k FROM f) WHERE k <= 50 GROUP BY ALL) SELECT h.book_id, h.glyph, count(*) AS n, any_value(p2.pages) AS pages, any_value(f2.words) AS words FROM h JOIN p2 ON p2.book_id = h.book_id AND p2.glyph = h.glyph JOIN f2 ON f2.book_id = h.book_id AND f2.glyph = h.glyph GROUP BY h.book_id, h.glyph",
        "glyph_summary": ", k AS (SELECT DISTINCT font_name, glyph, unicode_codepoint, unnest(sample_words) AS w FROM c_glyph), n AS (SELECT font_name, glyph, unicode_codepoint, count(*) AS n_words, array_to_string(list_sort(list(w)), '|') AS words FROM k WHERE w IS NOT NULL GROUP BY ALL) SELECT g.font_name, g.glyph, g.unicode_codepoint, CAST(sum(occurrence_count) AS BIGINT) AS total, count(DISTINCT book_id) AS books, coalesce(array_to_string(list_sort(list_distinct(list(book_id))), ','), '') AS book_ids, coalesce(any_value(n_words), 0) AS n_words, coalesce(any_value(words), '') AS words FROM c_glyph g LEFT JOIN n ON n.font_name IS NOT DISTINCT FROM g.font_name AND n.glyph IS NOT DISTINCT FROM g.glyph AND n.unicode_codepoint IS NOT DISTINCT FROM g.unicode_codepoint GROUP BY 1, 2, 3",
        "glyph_top5": "SELECT glyph, CAST(sum(occurrence_count) AS BIGINT) AS total FROM c_glyph GROUP BY glyph ORDER BY total DESC NULLS LAST, glyph LIMIT 5",
        "char_glyphs": f"SELECT book_id, char, count(*) AS n, count(DISTINCT page_number) AS pages, min(page_number) AS first_page, concat('U+', lpad(printf('%X', unicode(char)), 4, '0')) AS codepoint FROM (SELECT book_id, page_number, unnest(regexp_extract_all(page_content, '[^{ALLOWED}]')) AS char FROM c_content) GROUP BY book_id, char",
        "ambiguous_words": f", w AS (SELECT book_id, unnest(regexp_extract_all(page_content, '{_W}')) AS whole FROM c_content), v AS (SELECT book_id, unnest(CASE WHEN len([p FOR p IN string_split(whole, '-') IF regexp_matches(p, '[åñÅÑ]')]) > 0 THEN [p FOR p IN string_split(whole, '-') IF regexp_matches(p, '[åñÅÑ]')] ELSE [whole] END) AS word FROM w WHERE regexp_matches(whole, '[åñÅÑ]')), x AS (SELECT book_id, word, unnest(list_distinct(regexp_extract_all(lower(word), '[åñ]'))) AS diacritic FROM v), n AS MATERIALIZED (SELECT diacritic, word, count(*) AS n, array_to_string(list_sort(list_distinct(list(book_id))), ',') AS books FROM x GROUP BY ALL) SELECT * FROM n a WHERE NOT EXISTS (SELECT 1 FROM n b WHERE b.diacritic = a.diacritic AND b.word <> a.word AND length(b.word) >= 3 AND contains(a.word, b.word))",
        "ambiguous_words_in_order": f", w AS (SELECT book_id, page_number, content_id, unnest(regexp_extract_all(page_content, '{_W}')) AS whole, generate_subscripts(regexp_extract_all(page_content, '{_W}'), 1) AS pos FROM c_content), p AS (SELECT book_id, page_number, content_id, pos, unnest(string_split(whole, '-')) AS word, generate_subscripts(string_split(whole, '-'), 1) AS part FROM w WHERE regexp_matches(whole, '[åñÅÑ]')), v AS (SELECT book_id, word, row_number() OVER (ORDER BY book_id NULLS FIRST, page_number NULLS FIRST, content_id NULLS FIRST, pos, part) AS place FROM p), x AS MATERIALIZED (SELECT book_id, word, place, unnest(list_distinct(regexp_extract_all(lower(word), '[åñ]'))) AS diacritic FROM v), f AS MATERIALIZED (SELECT diacritic, word, min(place) AS opened FROM x GROUP BY ALL), c AS (SELECT a.diacritic, a.word, min(b.opened) AS cut FROM f a JOIN f b ON b.diacritic = a.diacritic AND b.word <> a.word AND contains(b.word, a.word) GROUP BY ALL) SELECT diacritic, word, count(*) AS n, array_to_string(list_sort(list_distinct(list(book_id))), ',') AS books FROM x LEFT JOIN c USING (diacritic, word) WHERE cut IS NULL OR place < cut GROUP BY diacritic, word",
        "font_profile": ", w AS (SELECT book_id, unnest(regexp_split_to_array(page_content, '\\s+')) AS w FROM c_content), c AS (SELECT book_id, count(*) AS words, count(*) FILTER (WHERE regexp_matches(w, '[\\x{0900}-\\x{097F}]')) AS dev, count(*) FILTER (WHERE NOT regexp_matches(w, '[\\x{0900}-\\x{097F}]') AND regexp_matches(w, '[āīūṛṝṣśṅñṁḥḍṭṇḷ]')) AS iast, count(*) FILTER (WHERE NOT regexp_matches(w, '[\\x{0900}-\\x{097F}āīūṛṝṣśṅñṁḥḍṭṇḷ]') AND regexp_matches(w, '[äåçéëïöüìùòà]')) AS legacy FROM w WHERE w <> '' GROUP BY book_id) SELECT *, CASE WHEN dev / words >= 0.05 AND dev > iast AND dev > legacy THEN 'devanagari' WHEN iast / words >= 0.03 AND legacy / words <= 0.01 THEN 'unicode_iast' WHEN legacy / words >= 0.01 AND legacy >= iast THEN 'legacy_glyph' ELSE 'plain_latin' END AS profile FROM c",
        "vector_topk": "SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 5) AS similarity FROM embeddings ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)) DESC, vec_id LIMIT 10",
        "vector_missing": "SELECT glossary_id FROM c_glossary WHERE glossary_id NOT IN (SELECT glossary_id FROM glossary_embeddings)",
        "vector_lengths": "SELECT DISTINCT glossary_id, CAST(coalesce(len(embedding), 0) AS INTEGER) AS length FROM glossary_embeddings WHERE embedding IS NULL OR len(embedding) <> 96",
    }.items()
}
