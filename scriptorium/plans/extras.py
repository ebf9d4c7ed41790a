"""Outlines, manifests and small extracts, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import next_label, range_bounds
from ..functions.unicode import nfc, sort_key
from ..operators import extracts as X
from ..operators import hierarchy as H
from ..tables import load
from . import views as V
from .corpus import _WALK, _links
from .views import BASE

QUERIES = {
    "toc_outline": lambda s, d: X.outline(H.resolve(_links(s, d)), V.toc(s, d).select(F.col("toc_id").alias("node"), F.col("toc_label").alias("label"))).select(F.col("node").alias("toc_id"), "root", "depth", "line"),
    "page_label_fallback": lambda s, d: V.page_map(s, d).select("book_id", "page_number", next_label(F.col("page_label"), F.col("page_number")).alias("label")),
    "page_label_changes": lambda s, d: X.label_changes(V.page_map(s, d).select("book_id", "page_number", F.trim("page_label").alias("page_label")), V.page_map(s, d)),
    "separator_counts": lambda s, d: X.separator_counts(load(s, d, "documents"), "doc_id", "text"),
    "legacy_contexts": lambda s, d: X.contexts(V.content(s, d), "content_id", "page_content", "à"),
    "distinct_images": lambda s, d: X.distinct_images(V.content(s, d).where("page_content is not null").select("book_id", "page_number", F.encode("page_content", "UTF-8").alias("data"))).select("book_id", "md5", "page_number", "uses", "bytes"),
    "section_manifest": lambda s, d: X.section_manifest(V.book(s, d), *range_bounds(F.col("toc_pages"))),
    "histogram_mode": lambda s, d: X.histogram_mode(load(s, d, "lineitem").select((F.col("l_suppkey") % 20).cast("int").alias("book_id"), F.col("l_quantity").alias("v")), "book_id", "v"),
    "embedding_texts": lambda s, d: X.embedding_texts(V.glossary(s, d), load(s, d, "glossary_embeddings")),
    "devanagari_share": lambda s, d: X.devanagari_share(V.content(s, d)),
    "normalised_terms": lambda s, d: V.glossary(s, d).select("glossary_id", nfc("term").alias("nfc"), sort_key("term").alias("sort_key")),
}
_DASH = "contains(x, ' – ') OR contains(x, ' — ')"
ORACLE = {
    "toc_outline": _WALK + "SELECT e.toc_id, path[1] AS root, CAST(len(path) AS BIGINT) AS depth, concat(repeat('  ', len(path) - 1), c.toc_label) AS line FROM e JOIN cur c ON c.toc_id = e.toc_id WHERE state IN ('root', 'lost') AND len(path) <= 5",
    "page_label_fallback": BASE + "SELECT book_id, page_number, coalesce(nullif(trim(page_label, ' '), ''), CAST(page_number AS VARCHAR)) AS label FROM c_map",
    "page_label_changes": BASE + "SELECT book_id, page_number, coalesce(trim(page_label, ' '), '') AS new_label, page_label AS old_label FROM c_map WHERE coalesce(page_label, '') <> coalesce(trim(page_label, ' '), '')",
    "separator_counts": f"SELECT doc_id, count(*) AS lines, count(*) FILTER (WHERE {_DASH}) AS long_dash, count(*) FILTER (WHERE contains(x, ' - ')) AS short_dash, count(*) FILTER (WHERE contains(x, ': ')) AS colon, count(*) FILTER (WHERE x = upper(x) AND regexp_matches(x, '[A-Z]')) AS caps FROM (SELECT * FROM (SELECT doc_id, i, string_split(text, chr(10))[i] AS x FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS r(i)) WHERE trim(x, ' ') <> '' QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i) <= 50) GROUP BY doc_id",
    "legacy_contexts": BASE + "SELECT content_id, unnest(regexp_extract_all(page_content, '[^\\r\\n]{0,30}à[^\\r\\n]{0,30}')) AS context FROM c_content",
    "distinct_images": BASE + "SELECT book_id, md5(page_content) AS md5, min(page_number) AS page_number, count(*) AS uses, CAST(min(strlen(page_content)) AS INTEGER) AS bytes FROM c_content WHERE page_content IS NOT NULL GROUP BY 1, 2",
    "section_manifest": BASE + "SELECT book_id, CAST(unnest(CASE toc_pages WHEN '[1,4)' THEN [1, 2, 3] WHEN '[2,5]' THEN [2, 3, 4, 5] WHEN '(1,6)' THEN [1, 2, 3, 4, 5] ELSE [] END) AS INTEGER) AS page_number FROM c_book WHERE number_of_pages >= CASE toc_pages WHEN '[1,4)' THEN 3 WHEN '[2,5]' THEN 5 WHEN '(1,6)' THEN 5 ELSE 0 END",
    "histogram_mode": "WITH v AS (SELECT CAST(l_suppkey % 20 AS INTEGER) AS book_id, l_quantity AS v FROM lineitem), r AS (SELECT book_id, min(v) AS lo, max(v) AS hi FROM v GROUP BY 1), b AS (SELECT v.book_id, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / 60)), 59) END AS INTEGER) AS bin FROM v JOIN r ON r.book_id = v.book_id), n AS (SELECT book_id, bin, count(*) AS n FROM b GROUP BY ALL) SELECT book_id, bin, n FROM n QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY n DESC, bin) = 1",
    "embedding_texts": BASE + "SELECT glossary_id, book_id, concat_ws(': ', term, description) AS text FROM c_glossary WHERE glossary_id NOT IN (SELECT glossary_id FROM glossary_embeddings)",
    "devanagari_share": BASE + ", g AS (SELECT book_id, page_number, count(*) AS words, count(*) FILTER (WHERE regexp_matches(w, '[\\x{0900}-\\x{097F}]')) AS dev FROM (SELECT book_id, page_number, unnest(regexp_split_to_array(page_content, '\\s+')) AS w FROM c_content) WHERE w <> '' GROUP BY 1, 2) SELECT *, round(dev / words, 6) AS share FROM g ORDER BY share DESC, book_id, page_number LIMIT 10",
}
