"""Tables of contents: parents from levels, page resolution, sections and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .nearest import key_of, next_larger

def _nearest_above(toc: DataFrame) -> DataFrame:
    """toc_id, above, at: the nearest entry of the book before it with a smaller level, and that level."""
    rows = toc.select(F.col("toc_id").alias("id"), key_of("book_id").alias("key"), (-F.col("toc_id")).alias("pos"), (-F.col("toc_level")).cast("double").alias("value"), F.lit(True).alias("asks"), F.lit(True).alias("gives"))
    return next_larger(rows).select(F.col("id").alias("_id"), (-F.col("found")).alias("above"), (-F.col("larger")).cast("int").alias("at"))


def parents_by_level(toc: DataFrame) -> DataFrame:
    """Parent in file order: the nearest entry before it of the level just above, unless an entry
    of a still higher level came in between. Level 1 and entries without a level have none."""
    above = _nearest_above(toc.where("toc_level is not null"))
    t = toc.select("toc_id", "book_id", "toc_level")
    return t.join(above, F.col("toc_id") == F.col("_id"), "left").select("toc_id", "book_id", "toc_level", F.when((F.col("toc_level") > 1) & (F.col("at") == F.col("toc_level") - 1), F.col("above")).alias("parent_toc_id"))


def parents_monotonic(toc: DataFrame) -> DataFrame:
    """Parent: the nearest entry before it with a smaller level (levels under 1 or missing count as 1)."""
    t = toc.select("toc_id", "book_id", F.greatest(F.col("toc_level"), F.lit(1)).alias("toc_level"))
    return t.join(_nearest_above(t), F.col("toc_id") == F.col("_id"), "left").select("toc_id", "book_id", F.col("toc_level").alias("level"), F.col("above").alias("parent_toc_id"))


def combined_labels(toc: DataFrame) -> DataFrame:
    """Level-2 entries without a page label are appended to the level-1 entry before them."""
    no_page = F.coalesce(F.trim("page_label_raw"), F.lit("")) == ""
    merges = F.coalesce((F.col("toc_level") == 2) & no_page, F.lit(False))
    top = F.coalesce(F.col("toc_level") == 1, F.lit(False))
    rows = toc.select(F.col("toc_id").alias("id"), key_of("book_id").alias("key"), (-F.col("toc_id")).alias("pos"), F.when(top, 1.0).otherwise(0.0).alias("value"), merges.alias("asks"), top.alias("gives"))
    heads = next_larger(rows.where("asks or gives")).where("found is not null").select(F.col("id").alias("_id"), (-F.col("found")).alias("_head"))
    t = toc.join(heads, F.col("toc_id") == F.col("_id"), "left")
    # As many parts as the entry's label is to have.
    parts = t.where("_head is not null").groupBy(F.col("_head").alias("_h")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("toc_id", "toc_label"))), lambda x: x["toc_label"]), " - ").alias("_more"))
    return t.where("_head is null").join(parts, F.col("toc_id") == F.col("_h"), "left").select("toc_id", "book_id", "toc_level", F.when(F.col("_more").isNotNull(), F.concat("toc_label", F.lit(" - "), "_more")).otherwise(F.col("toc_label")).alias("toc_label"))


def resolve_labels(toc: DataFrame, page_map: DataFrame) -> DataFrame:
    """Adds resolved: the page of the entry's trimmed label (the last page with it), else the first
    page whose label is the same ignoring case, else NULL."""
    p = page_map.select("book_id", F.trim("page_label").alias("l"), "page_number").where("l <> ''")
    exact = p.groupBy(F.col("book_id").alias("xb"), F.col("l").alias("xl")).agg(F.max("page_number").alias("x"))
    loose = p.groupBy(F.col("book_id").alias("yb"), F.lower("l").alias("yl")).agg(F.min("page_number").alias("y"))
    t = toc.withColumn("_l", F.coalesce(F.trim("page_label_raw"), F.lit("")))
    return (
        t.join(exact, (F.col("book_id") == F.col("xb")) & (F.col("_l") == F.col("xl")), "left")
        .join(loose, (F.col("book_id") == F.col("yb")) & (F.lower("_l") == F.col("yl")), "left")
        .withColumn("resolved", F.when(F.col("_l") != "", F.coalesce("x", "y")))
        .drop("_l", "xb", "xl", "x", "yb", "yl", "y")
    )


def effective_start(toc: DataFrame, page_map: DataFrame, depth: int = 3) -> DataFrame:
    """Start page of every entry: its own label's, else that of its first descendant (in id order,
    at most ``depth`` levels down, before its siblings' descendants) that resolves, else 0."""
    r = resolve_labels(toc, page_map).select("toc_id", "book_id", "toc_level", "toc_label", "parent_toc_id", "resolved")
    own = F.when(F.col("resolved") > 0, F.col("resolved"))
    # From the leaves up: the first resolved page at or below a node, by levels of depth.
    best = r.select("toc_id", "parent_toc_id", own.alias("page"))
    below = best.select("toc_id", F.lit(None).cast("int").alias("sub"))
    for _ in range(depth):
        up = best.join(below, "toc_id").select(F.col("parent_toc_id").alias("toc_id"), F.struct(F.col("toc_id").alias("i"), F.coalesce("page", "sub").alias("p")).alias("s")).where("s.p is not null")
        below = best.select("toc_id").join(up.groupBy("toc_id").agg(F.min("s").alias("m")), "toc_id", "left").select("toc_id", F.col("m.p").alias("sub"))
    method = F.when(own.isNotNull(), "own").when(F.col("sub").isNotNull(), "descendant").otherwise("none")
    return r.join(below, "toc_id").select("toc_id", "book_id", "toc_level", "toc_label", "parent_toc_id", F.coalesce(own, F.col("sub"), F.lit(0)).alias("start_page"), method.alias("method"))


def page_ranges(starts: DataFrame, totals: DataFrame) -> DataFrame:
    """Start, end and number of pages. The end is the page before the next sibling (or else the
    next entry of a higher level) that starts later, else the book's last page.

    Siblings are the entries of one parent and level, in id order. Entries without such a sibling
    ask, for each level of theirs, those of higher levels."""
    s = materialise(starts.select("toc_id", "book_id", "toc_level", "parent_toc_id", "start_page"))
    at = s.where("start_page > 0")
    value, yes, no = F.col("start_page").cast("double"), F.lit(True), F.lit(False)
    sib = next_larger(at.select(F.col("toc_id").alias("id"), key_of("book_id", "parent_toc_id", "toc_level").alias("key"), F.col("toc_id").alias("pos"), value.alias("value"), yes.alias("asks"), yes.alias("gives")))
    sib = materialise(sib.select("id", "larger"))
    rest = at.join(sib.where("larger is null").select(F.col("id").alias("_id")), F.col("toc_id") == F.col("_id"), "left_semi")
    # One row for each level of a book that asks.
    levels = rest.select(F.col("book_id").alias("_b"), F.col("toc_level").alias("_l")).distinct()
    asks = rest.select(F.col("toc_id").alias("id"), key_of("book_id", "toc_level").alias("key"), F.col("toc_id").alias("pos"), value.alias("value"), yes.alias("asks"), no.alias("gives"))
    gives = at.join(levels, F.expr("book_id <=> _b and toc_level < _l")).select(F.col("toc_id").alias("id"), key_of("_b", "_l").alias("key"), F.col("toc_id").alias("pos"), value.alias("value"), no.alias("asks"), yes.alias("gives"))
    high = next_larger(asks.unionByName(gives)).select("id", "larger")
    nearest = sib.where("larger is not null").unionByName(high.where("larger is not null")).select(F.col("id").alias("_id"), F.col("larger").cast("int").alias("_next"))
    t = s.join(nearest, F.col("toc_id") == F.col("_id"), "left").join(totals, "book_id", "left")
    end = F.when(F.col("start_page") > 0, F.coalesce(F.col("_next") - 1, F.col("number_of_pages")))
    return t.select("toc_id", "book_id", "start_page", end.alias("end_page"), F.when(end.isNull(), 0).otherwise(F.greatest(F.lit(0), end - F.col("start_page") + 1)).alias("page_count"))


def core_range(starts: DataFrame, page_map: DataFrame) -> DataFrame:
    """First page of the first entry (by level and id) that has one, to the page before the
    earliest appendix, index or glossary after it, else the last labelled page."""
    s = starts.where("start_page > 0")
    first = s.groupBy("book_id").agg(F.min(F.struct("toc_level", "toc_id", "start_page")).alias("m")).select("book_id", F.col("m.start_page").alias("core_start"))
    end = s.where(F.col("toc_label").ilike("%appendix%") | F.col("toc_label").ilike("%index%") | F.col("toc_label").ilike("%glossary%")).join(first, "book_id").where("start_page > core_start").groupBy("book_id").agg((F.min("start_page") - 1).alias("e"))
    last = page_map.where(F.trim("page_label") != "").groupBy("book_id").agg(F.max("page_number").alias("m"))
    return page_map.select("book_id").distinct().join(first, "book_id", "left").join(end, "book_id", "left").join(last, "book_id", "left").select("book_id", "core_start", F.when(F.col("core_start").isNotNull(), F.coalesce(F.when(F.col("e") != 0, F.col("e")), F.col("m"))).alias("core_end"))


def backfill(toc: DataFrame) -> DataFrame:
    """Blank labels with the label of the direct child of lowest id that has one; NULL: none has.

    One pass: a label filled in here doesn't fill another."""
    blank = F.coalesce(F.trim("page_label_raw"), F.lit("")) == ""
    child = toc.where(~blank & F.col("parent_toc_id").isNotNull()).groupBy(F.col("parent_toc_id").alias("p"), F.col("book_id").alias("b")).agg(F.min_by("page_label_raw", "toc_id").alias("new_label"))
    return toc.where(blank).join(child, (F.col("toc_id") == F.col("p")) & (F.col("book_id") == F.col("b")), "left").select("toc_id", "book_id", "toc_level", "new_label")


def fuzzy_sections(toc: DataFrame, patterns: list[str]) -> DataFrame:
    """Entries whose label contains any of the patterns, with those it contains."""
    hit = F.filter(F.array(*[F.lit(p) for p in patterns]), lambda p: F.contains(F.lower("toc_label"), F.lower(p)))
    return toc.select("toc_id", "book_id", "toc_level", "toc_label", F.array_join(hit, ",").alias("matched")).where("matched <> ''")


def orphans(toc: DataFrame) -> DataFrame:
    """Entries whose parent isn't an entry of their book."""
    ids = toc.select(F.col("toc_id").alias("p"), F.col("book_id").alias("b"))
    return toc.where("parent_toc_id is not null").join(ids, (F.col("parent_toc_id") == F.col("p")) & (F.col("book_id") == F.col("b")), "left_anti").select("toc_id", "book_id", "parent_toc_id")


def validation(toc: DataFrame, starts: DataFrame) -> DataFrame:
    """Per book: entries, top level, without label, with a page of their own or a descendant's,
    orphans."""
    o = orphans(toc).select("toc_id", F.lit(1).alias("_o"))
    t = toc.join(starts.select("toc_id", "method"), "toc_id").join(o, "toc_id", "left")
    return t.groupBy("book_id").agg(
        F.count("*").alias("total"), F.count_if(F.col("toc_level") == 1).alias("level_one"), F.count_if(F.coalesce(F.trim("page_label_raw"), F.lit("")) == "").alias("no_label"),
        F.count_if(F.col("method") == "own").alias("own_page"), F.count_if(F.col("method") == "descendant").alias("computed_page"), F.count("_o").alias("orphaned"),
    )


def roots(toc: DataFrame) -> DataFrame:
    """Entries without a parent, in order."""
    return toc.where("parent_toc_id is null").select("toc_id", "book_id", "toc_level", "toc_label").orderBy("toc_id")


def item_by_label(toc: DataFrame, label: str, exact: bool = True) -> DataFrame:
    """Per book the first entry, by level and id, whose label is the given one or contains it
    ignoring case."""
    hit = F.col("toc_label") == label if exact else F.col("toc_label").ilike(f"%{label}%")
    first = toc.where(hit).groupBy("book_id").agg(F.min(F.struct("toc_level", "toc_id", "toc_label")).alias("m"))
    return first.select("book_id", F.col("m.toc_id").alias("toc_id"), F.col("m.toc_level").alias("toc_level"), F.col("m.toc_label").alias("toc_label"))


def nested(toc: DataFrame, depth: int = 5) -> DataFrame:
    """Every top entry with all below it, down to a depth, as one text: an id and, in brackets, its
    children in id order. Built from below, level by level; an entry holds its own descendants."""
    t = toc.select("toc_id", "book_id", "parent_toc_id")
    have = t.select("toc_id", "book_id", F.col("toc_id").cast("string").alias("tree"))
    for _ in range(depth - 1):
        kids = t.where("parent_toc_id is not null").join(have.select(F.col("toc_id").alias("_t"), "tree"), F.col("toc_id") == F.col("_t")).groupBy(F.col("parent_toc_id").alias("_p"), F.col("book_id").alias("_b"))
        kids = kids.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("toc_id", "tree"))), lambda x: x["tree"]), ",").alias("_kids"))
        have = materialise(t.join(kids, F.expr("toc_id = _p and book_id <=> _b"), "left").select("toc_id", "book_id", F.concat(F.col("toc_id").cast("string"), F.when(F.col("_kids").isNotNull(), F.concat(F.lit("("), "_kids", F.lit(")"))).otherwise("")).alias("tree")))
    return have.join(t.where("parent_toc_id is null").select("toc_id"), "toc_id", "left_semi")


def core_summary(ranges: DataFrame) -> DataFrame:
    """Books, those with a core range, its pages, their average and the rate of success."""
    ok = F.col("core_start").isNotNull() & F.col("core_end").isNotNull() & (F.col("core_start") != 0) & (F.col("core_end") != 0)
    pages = F.when(ok, F.col("core_end") - F.col("core_start") + 1)
    return ranges.agg(F.count("*").alias("books"), F.count_if(ok).alias("analysed"), F.coalesce(F.sum(pages), F.lit(0).cast("long")).alias("core_pages"), F.round(F.avg(pages), 4).alias("average"), F.round(F.when(F.count("*") > 0, F.count_if(ok) * 100 / F.count("*")).otherwise(0.0), 4).alias("rate"))


def validation_messages(validated: DataFrame) -> DataFrame:
    """One row for each finding about a book: validated is the result of ``validation``."""
    found = [("no entries of the first level", F.col("level_one") == 0), ("entries without a label", F.col("no_label") > 0), ("entries whose parent is missing", F.col("orphaned") > 0), ("entries without a page", F.col("own_page") + F.col("computed_page") < F.col("total"))]
    return validated.select("book_id", F.explode(F.filter(F.array(*[F.when(c, F.lit(m)) for m, c in found]), lambda x: x.isNotNull())).alias("message"))
