"""Queries over the corpus tables that need no text processing: references and hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hierarchy, references
from ..tables import current, current_sql, load


def label_references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    toc = current(spark, sf_dir, "table_of_contents", ["toc_id", "book_id", "page_label_raw", "created_at"])
    label = references.trimmed_label(F.col("page_label_raw"))
    refs = toc.select(F.lit("table_of_contents").alias("src_table"), F.col("toc_id").alias("row_id"), F.col("created_at").alias("ts"), F.col("book_id").cast("long").alias("k1"), label.alias("k2")).where("k2 <> ''")
    pages = current(spark, sf_dir, "page_map", ["book_id", "page_number", "page_label", "created_at", "deleted_at"])
    parents = pages.select(F.col("book_id").cast("long").alias("k1"), references.trimmed_label(F.col("page_label")).alias("k2"), F.col("created_at").alias("ts"), F.col("deleted_at").isNull().alias("live"))
    return refs, parents


def vector_references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    emb = current(spark, sf_dir, "glossary_embeddings", ["glossary_id", "created_at"])
    refs = emb.select(F.lit("glossary_embeddings").alias("src_table"), F.col("glossary_id").alias("row_id"), F.col("created_at").alias("ts"), F.col("glossary_id").alias("k1"), F.lit("").alias("k2"))
    glossary = current(spark, sf_dir, "glossary", ["glossary_id", "created_at"])
    parents = glossary.select(F.col("glossary_id").alias("k1"), F.lit("").alias("k2"), F.col("created_at").alias("ts"), F.lit(True).alias("live"))
    return refs, parents


def _orphans(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parts = [label_references(spark, sf_dir), vector_references(spark, sf_dir)]
    # Read from the files' footers.
    rows = [sum(load(spark, sf_dir, t).count() for t in both) for both in (("table_of_contents", "page_map"), ("glossary_embeddings", "glossary"))]
    found = [references.orphans(r, p, ["k1", "k2"], ranges=references.ranges_for(n)) for (r, p), n in zip(parts, rows)]
    return found[0].unionByName(found[1]), parts[0][0].unionByName(parts[1][0])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir)[0].select("src_table", "row_id")


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References and orphans per table and month of the referring row."""
    return references.by_period(*_orphans(spark, sf_dir))


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = current(spark, sf_dir, "table_of_contents", ["toc_id", "book_id", "toc_level", "parent_toc_id"])
    return t.select(F.col("toc_id").alias("node"), F.col("parent_toc_id").alias("parent"), F.col("book_id").cast("long").alias("scope"), F.col("toc_level").alias("level"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = _links(spark, sf_dir)
    return hierarchy.problems(hierarchy.resolve(links), links.select("node", "level")).select(F.col("node").alias("toc_id"), "problem")


def p6_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry with its path, depth, root and number of descendants."""
    r = hierarchy.resolve(_links(spark, sf_dir), paths=True)
    n = hierarchy.descendants(r).groupBy("ancestor").agg(F.count("*").alias("descendants"))
    return r.join(n, F.col("node") == F.col("ancestor"), "left").select(
        F.col("node").alias("toc_id"), "root", "depth", "state", F.array_join(F.col("path").cast("array<string>"), "/").alias("path"), F.coalesce("descendants", F.lit(0).cast("long")).alias("descendants")
    )


def p6_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.descendants(hierarchy.resolve(_links(spark, sf_dir), paths=True))


QUERIES = {"p3_found": p3_found, "p3_report": p3_report, "p6_found": p6_found, "p6_paths": p6_paths, "p6_descendants": p6_descendants}

_WS = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _trim(c: str) -> str:
    return rf"lower(regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g'))"


_P3 = f"""
SELECT 'table_of_contents' AS src_table, t.toc_id AS row_id, t.created_at AS ts, p.since IS NOT NULL AS late, p.k IS NOT NULL AS known
FROM {current_sql("table_of_contents")} t
LEFT JOIN (SELECT book_id, {_trim("page_label")} AS k, min(CASE WHEN deleted_at IS NULL THEN created_at END) AS since
           FROM {current_sql("page_map")} GROUP BY ALL) p ON p.book_id = t.book_id AND p.k = {_trim("t.page_label_raw")}
WHERE {_trim("t.page_label_raw")} <> '' AND NOT coalesce(p.since <= t.created_at, false)
UNION ALL
SELECT 'glossary_embeddings', e.glossary_id, e.created_at, g.created_at IS NOT NULL, g.glossary_id IS NOT NULL
FROM {current_sql("glossary_embeddings")} e LEFT JOIN {current_sql("glossary")} g ON g.glossary_id = e.glossary_id
WHERE NOT coalesce(g.created_at <= e.created_at, false)
"""

_WALK = f"""
WITH RECURSIVE cur AS MATERIALIZED {current_sql("table_of_contents")},
l AS MATERIALIZED (SELECT c.toc_id, c.toc_level, c.parent_toc_id, p.toc_id AS up FROM cur c LEFT JOIN cur p ON p.toc_id = c.parent_toc_id AND p.book_id IS NOT DISTINCT FROM c.book_id),
w AS (SELECT toc_id, toc_level, [toc_id] AS path, up, parent_toc_id AS stored, false AS looped FROM l
      UNION ALL
      SELECT w.toc_id, w.toc_level, list_prepend(l.toc_id, w.path), l.up, l.parent_toc_id, coalesce(list_contains(w.path, l.up), false)
      FROM w JOIN l ON l.toc_id = w.up WHERE NOT w.looped AND w.up <> w.toc_id),
e AS (SELECT *, CASE WHEN up IS NULL AND stored IS NULL THEN 'root' WHEN up IS NULL THEN 'lost' WHEN up = toc_id THEN 'cycle' ELSE 'below_cycle' END AS state
      FROM w WHERE up IS NULL OR looped OR up = toc_id)
"""

ORACLE = {
    "p3_found": f"SELECT src_table, row_id FROM ({_P3})",
    "p3_report": f"""
SELECT a.src_table, a.period, a.refs, coalesce(b.orphans, 0) AS orphans, coalesce(b.missing, 0) AS missing, coalesce(b.deleted, 0) AS deleted, coalesce(b.late, 0) AS late FROM
(SELECT src_table, period, count(*) AS refs FROM (
  SELECT 'table_of_contents' AS src_table, strftime(created_at, '%Y-%m') AS period FROM {current_sql("table_of_contents")} WHERE {_trim("page_label_raw")} <> ''
  UNION ALL SELECT 'glossary_embeddings', strftime(created_at, '%Y-%m') FROM {current_sql("glossary_embeddings")}) GROUP BY ALL) a
LEFT JOIN (SELECT src_table, strftime(ts, '%Y-%m') AS period, count(*) AS orphans, count(*) FILTER (WHERE NOT known) AS missing,
  count(*) FILTER (WHERE known AND NOT late) AS deleted, count(*) FILTER (WHERE late) AS late FROM ({_P3}) GROUP BY ALL) b
ON a.src_table = b.src_table AND a.period IS NOT DISTINCT FROM b.period""",
    "p6_found": _WALK + """
SELECT toc_id, 'lost_parent' AS problem FROM l WHERE parent_toc_id IS NOT NULL AND up IS NULL
UNION ALL SELECT toc_id, state FROM e WHERE state IN ('cycle', 'below_cycle')
UNION ALL SELECT toc_id, 'level' FROM e WHERE state = 'root' AND toc_level <> len(path)""",
    "p6_paths": _WALK + """
, d AS (SELECT unnest(path[:-2]) AS a FROM e WHERE state IN ('root', 'lost'))
SELECT toc_id, CASE WHEN state IN ('root', 'lost') THEN path[1] END AS root, CASE WHEN state IN ('root', 'lost') THEN CAST(len(path) AS BIGINT) END AS depth, state,
  CASE WHEN state IN ('root', 'lost') THEN array_to_string(path, '/') END AS path, coalesce(n, 0) AS descendants
FROM e LEFT JOIN (SELECT a, count(*) AS n FROM d GROUP BY a) ON a = toc_id""",
    "p6_descendants": _WALK + """
SELECT path[i] AS ancestor, toc_id AS descendant, CAST(len(path) - i AS BIGINT) AS distance
FROM e, unnest(range(1, len(path))) AS r(i) WHERE state IN ('root', 'lost')""",
}
