"""Geometry of spans and blocks on pages: regions, images, columns and text boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise

# Parts of names of fonts that hold Devanagari.
DEVANAGARI_FONTS = ["devanagari", "sanskrit", "hindi", "bengali", "mangal", "siddhanta", "chandas", "aaritu", "narad", "kruti"]
BODY = 0.65  # least share of the page that is body


def region(spans: DataFrame, part: str, header: Column, footer: Column) -> DataFrame:
    """Text of the ``body``, ``header`` or ``footer`` of every page from spans (page_id, line_no,
    span_no, text, y0, page_h). Bounds are heights on the page; NULL or 0 as footer is its end."""
    top = F.coalesce(header, F.lit(0.0))
    end = F.when(F.coalesce(footer, F.lit(0.0)) <= 0, F.col("page_h")).otherwise(footer)
    y = F.col("y0")
    keep = {"body": (y >= top) & (y < end), "header": (y < top) & (top > 0), "footer": (y >= end) & (end < F.col("page_h"))}[part]
    s = spans.where(keep & F.col("text").isNotNull())
    lines = s.groupBy("page_id", "line_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span_no", "text"))), lambda x: x["text"]), "").alias("line"))
    return lines.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("text"))


def reading_order(blocks: DataFrame) -> DataFrame:
    """Place of every block in reading order: rows of five points, then from the left."""
    w = W.partitionBy("page_id").orderBy(F.bround(F.col("y0") / 5) * 5, "x0", "block_no")
    return blocks.withColumn("place", F.row_number().over(w))


def without_fonts(spans: DataFrame, parts: list[str] = DEVANAGARI_FONTS, starts: list[str] = ()) -> DataFrame:
    """Spans whose font's name has none of the parts, in any case, and none of the beginnings."""
    font = F.coalesce("font", F.lit(""))
    kept = spans.where(~F.lower(font).rlike("|".join(parts))) if parts else spans
    for x in starts:
        kept = kept.where(~font.startswith(x))
    return kept


def quadrants(blocks: DataFrame, width: float, height: float) -> DataFrame:
    """Blocks per page and quadrant, by their centres (x0, y0 here)."""
    q = F.concat(F.when(F.col("y0") < height / 2, "top").otherwise("bottom"), F.lit("_"), F.when(F.col("x0") < width / 2, "left").otherwise("right"))
    return blocks.groupBy("page_id").agg(*[F.count_if(q == k).alias(k) for k in ("top_left", "top_right", "bottom_left", "bottom_right")])


def image_coverage(images: DataFrame, page: tuple[float, float, float, float], least: float = 0.01) -> DataFrame:
    """Share of the page's area under images: total, largest and how many, those under ``least``
    left out. images: page_id, x0, y0, x1, y1."""
    x0, y0, x1, y1 = page
    w = F.greatest(F.lit(0.0), F.least(F.col("x1"), F.lit(x1)) - F.greatest(F.col("x0"), F.lit(x0)))
    h = F.greatest(F.lit(0.0), F.least(F.col("y1"), F.lit(y1)) - F.greatest(F.col("y0"), F.lit(y0)))
    share = w * h / ((x1 - x0) * (y1 - y0))
    return images.withColumn("_s", share).where(F.col("_s") >= least).groupBy("page_id").agg(F.round(F.sum("_s"), 6).alias("coverage"), F.round(F.max("_s"), 6).alias("largest"), F.count("*").alias("images"))


def columns(blocks: DataFrame, width: float) -> DataFrame:
    """Whether a page has two columns: ten blocks at least and three tenths of them on each side."""
    left = F.count_if(F.col("x0") < width / 2)
    n = F.count("*")
    return blocks.groupBy("page_id").agg(n.alias("blocks"), ((n >= 10) & (left / n >= 0.3) & ((n - left) / n >= 0.3)).alias("two_columns"))


def quantiles(counts: DataFrame, key: str, value: str, shares: dict[str, float]) -> DataFrame:
    """counts: key, value, _n (how often). Per key the quantiles (linear between neighbours) of the
    named shares, and n.

    Values are ranked in slices of the order of (key, value) and the slices' sums added up, so the
    values of one key may lie in many tasks."""
    parts = max(1, counts.sparkSession.sparkContext.defaultParallelism)
    cut = materialise(counts.where(F.col(value).isNotNull()).select(key, value, "_n").repartitionByRange(parts, key, value).withColumn("_p", F.spark_partition_id()))
    slices = cut.groupBy(key, "_p").agg(F.sum("_n").alias("_s"))
    # One row per key and slice.
    slices = slices.select(F.col(key).alias("_k"), F.col("_p").alias("_q"), F.coalesce(F.sum("_s").over(W.partitionBy(key).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("_b"), F.sum("_s").over(W.partitionBy(key)).alias("_all"))
    inside = F.sum("_n").over(W.partitionBy(key, "_p").orderBy(value))
    r = cut.withColumn("_in", inside).join(slices, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_p") == F.col("_q"))).withColumn("_upto", F.col("_b") + F.col("_in"))
    at = {k: F.lit(q) * (F.col("_all") - 1) for k, q in shares.items()}
    low = [F.min(F.when(F.col("_upto") > F.floor(c), F.col(value))).alias(f"_l{k}") for k, c in at.items()]
    high = [F.min(F.when(F.col("_upto") > F.ceil(c), F.col(value))).alias(f"_h{k}") for k, c in at.items()]
    got = r.groupBy(key).agg(F.max("_all").alias("_all"), *low, *high)
    return got.select(key, *[(F.col(f"_l{k}") + (F.col(f"_h{k}") - F.col(f"_l{k}")) * (c - F.floor(c))).alias(k) for k, c in at.items()], F.col("_all").alias("n"))


def counted(values: DataFrame, key: str, value: str) -> DataFrame:
    """Different values of every key with how often they occur: combined before they are shuffled."""
    return values.groupBy(key, value).agg(F.count("*").alias("_n"))


def robust(values: DataFrame, key: str, value: str) -> DataFrame:
    """Median, median absolute deviation and the 5th and 95th percentile (linear) per key."""
    counts = materialise(counted(values, key, value))
    med = materialise(quantiles(counts, key, value, {"median": 0.5, "p05": 0.05, "p95": 0.95}))
    off = counts.join(med.select(F.col(key).alias("_k"), "median"), F.col(key).eqNullSafe(F.col("_k"))).groupBy(key, F.abs(F.col(value) - F.col("median")).alias("off")).agg(F.sum("_n").alias("_n"))
    mad = quantiles(off, key, "off", {"mad": 0.5}).select(F.col(key).alias("_k"), "mad")
    return med.join(mad, F.col(key).eqNullSafe(F.col("_k"))).select(key, "median", "p05", "p95", "n", "mad")


def densest(counts: DataFrame, key: str, value: str) -> DataFrame:
    """counts: key, value, _n, eps (of the key). Per key the first window of width eps (by its upper
    edge) with most values: its largest and smallest value and how many it holds.

    A window lies in two neighbouring cells of that width, so a key is cut into cells, each with the
    one before it."""
    scaled = counts.withColumn("_v", F.col(value) / F.col("eps"))
    cell = F.floor("_v")
    both = scaled.withColumn("_cell", F.explode(F.array(cell, cell + 1)))
    w = W.partitionBy(key, "_cell").orderBy("_v").rangeBetween(-1, 0)
    n = both.withColumn("_m", F.sum("_n").over(w)).withColumn("_lo", F.min(value).over(w)).where(cell == F.col("_cell"))
    best = n.groupBy(key).agg(F.max_by(F.struct(value, "_lo", "_m"), F.struct(F.col("_m"), -F.col("_v"))).alias("b"))
    return best.select(key, F.col(f"b.{value}").alias("hi"), F.col("b._lo").alias("lo"), F.col("b._m").alias("members"))


def boundaries(pages: DataFrame, body: float = BODY) -> DataFrame:
    """Header and footer of every book as shares of the page's height.

    pages: book_id, header_norm, footer_norm. Where two fifths of the pages agree within three
    deviations, the header is the largest of theirs and the footer the smallest; else percentiles.
    The body is then widened to ``body``."""

    def side(value: str) -> DataFrame:
        v = pages.select("book_id", F.col(value).alias("v")).where("v is not null")
        s = materialise(robust(v, "book_id", "v").withColumn("eps", F.when(F.col("mad") == 0, 0.002).otherwise(3 * F.col("mad"))))
        d = densest(counted(v, "book_id", "v").join(s.select("book_id", "eps"), "book_id"), "book_id", "v")
        stable = (F.col("members") >= F.greatest(F.lit(3), F.floor(F.col("n") * 0.03))) & (F.col("members") / F.col("n") >= 0.4)
        edge = F.when(stable, F.col("hi") if value == "header_norm" else F.col("lo")).otherwise(F.col("p95") if value == "header_norm" else F.col("p05"))
        return s.join(d, "book_id").select("book_id", edge.alias(value[:6]))

    b = side("header_norm").join(side("footer_norm"), "book_id")
    small = F.col("footer") - F.col("header") < body
    nh = F.greatest(F.lit(0.0), F.least(F.col("header"), F.col("footer") - body))
    nf = F.greatest(F.col("footer"), F.least(F.lit(1.0), nh + body))
    clamp = lambda c: F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), c)), 6)
    return b.select("book_id", clamp(F.when(small, nh).otherwise(F.col("header"))).alias("header"), clamp(F.when(small, nf).otherwise(F.col("footer"))).alias("footer"))


def split_pages(pages: DataFrame) -> DataFrame:
    """Two halves of every double page: right half after left half of a wide page, upper after
    lower of a tall one. pages: doc, page, w, h."""
    wide = F.col("w") > F.col("h")
    half = F.explode(F.array(F.lit(1), F.lit(2))).alias("half")
    p = pages.select("doc", "page", "w", "h", half)
    return p.select("doc", ((F.col("page") - 1) * 2 + F.col("half")).alias("new_page"), F.when(wide & (F.col("half") == 2), F.col("w") / 2).otherwise(0.0).alias("x0"), F.when(~wide & (F.col("half") == 1), F.col("h") / 2).otherwise(0.0).alias("y0"))


def interleave(odd: DataFrame, even: DataFrame, page: str = "page") -> DataFrame:
    """Odd and even pages, scanned apart, in one order; the longer one's rest at the end."""
    a = odd.withColumn("_o", F.col(page) * 2)
    b = even.withColumn("_o", F.col(page) * 2 + 1)
    return a.unionByName(b).withColumn("place", F.row_number().over(W.partitionBy("book_id").orderBy("_o"))).drop("_o")


def block_mode(pages: DataFrame) -> DataFrame:
    """pages: page_id, rotation, flip (the matrix's fourth number). Adds mode: ``blocks`` for pages
    that are turned by a quarter or upside down, else ``clip``. NULL is not turned."""
    return pages.withColumn("mode", F.when(F.coalesce(F.col("rotation").isin(90, 270) | (F.col("flip") == -1.0), F.lit(False)), "blocks").otherwise("clip"))


def body_blocks(blocks: DataFrame, header: Column, footer: Column) -> DataFrame:
    """Body text of pages read block by block: blocks (page_id, block_no, text, y0, y1, page_h) that
    begin below the header and end above the footer, from the top; those level with each other in
    the order of the file. A footer that is NULL or 0 is the page's end; blank blocks are left out."""
    top = F.coalesce(header, F.lit(0.0))
    end = F.when(F.coalesce(footer, F.lit(0.0)) <= 0, F.col("page_h")).otherwise(footer)
    kept = blocks.where((F.col("y0") >= top) & (F.col("y1") <= end)).withColumn("text", F.regexp_replace("text", r"^\s+|\s+$", "")).where("text <> ''")
    # As many blocks as the page has.
    order = F.array_sort(F.collect_list(F.struct("y0", "block_no", "text")))
    return kept.groupBy("page_id").agg(F.array_join(F.transform(order, lambda x: x["text"]), "\n").alias("text"))


def extract(pages: DataFrame, spans: DataFrame, blocks: DataFrame, header: Column, footer: Column) -> DataFrame:
    """Body text of every page in the mode it needs; '' where nothing is found. pages: with mode."""
    ids = lambda m: pages.where(F.col("mode") == m).select("page_id")
    clip = region(spans.join(ids("clip"), "page_id", "left_semi"), "body", header, footer)
    turned = body_blocks(blocks.join(ids("blocks"), "page_id", "left_semi"), header, footer)
    return pages.select("page_id", "mode").join(clip.unionByName(turned), "page_id", "left").withColumn("text", F.coalesce("text", F.lit("")))


def with_book(texts: DataFrame, books: DataFrame, kind: str = "body") -> DataFrame:
    """texts: book_id, page_number, text. Adds the book's titles and heights, which of the heights are
    there, the text's length and whether it was extracted (its book is known and text isn't NULL)."""
    b = books.select("book_id", "original_book_title", "english_book_title", "header_height", "footer_height", F.lit(True).alias("_known"))
    ok = F.coalesce("_known", F.lit(False)) & F.col("text").isNotNull()
    return texts.join(b, "book_id", "left").select(
        "book_id", F.col("original_book_title").alias("book_title"), F.col("english_book_title").alias("english_title"), "page_number", F.lit(kind).alias("extraction_type"), F.when(ok, F.col("text")).alias("content"),
        F.when(ok, F.length("text")).otherwise(0).alias("content_length"), F.col("header_height").isNotNull().alias("header_available"), F.col("footer_height").isNotNull().alias("footer_available"), ok.alias("extraction_successful"),
    )


def content_rect(pages: DataFrame) -> DataFrame:
    """pages: page_id, page_h, header, footer. Adds top and bottom of the content: a footer beyond half
    of the page is a place, a smaller one a height from the bottom. Where nothing would be left, and
    for missing values, the page's own edge."""
    header, footer = F.coalesce("header", F.lit(0.0)), F.coalesce("footer", F.lit(0.0))
    bottom = F.when(footer > F.col("page_h") * 0.5, footer).otherwise(F.col("page_h") - footer)
    bad = header >= bottom
    return pages.withColumn("top", F.when(bad, 0.0).otherwise(header)).withColumn("bottom", F.when(bad, F.col("page_h")).otherwise(bottom))


def edge_texts(spans: DataFrame, header: Column, footer: Column, margin: float = 0.0) -> DataFrame:
    """Per page the lines above the header and below the footer (shares of the height), joined by a
    bar; pages without such lines have ''."""
    h = F.col("page_h")
    top = F.greatest(F.lit(0.0), F.least(h, header * h)) + margin
    end = F.greatest(F.lit(0.0), F.greatest(F.lit(0.0), F.least(h, footer * h)) - margin)
    line = F.struct("line_no", "span_no", F.trim("text").alias("t"))
    joined = lambda keep: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(keep & (F.trim("text") != ""), line))), lambda x: x["t"]), " | ")
    return spans.groupBy("page_id").agg(joined(F.col("y0") < top).alias("header_text"), joined(F.col("y0") >= end).alias("footer_text"))


def page_content(spans: DataFrame, rect: DataFrame, exclude: bool = True) -> DataFrame:
    """Text of pages inside their content rectangle (page_id, top, bottom), without spans in fonts of
    Devanagari where ``exclude`` is set."""
    s = without_fonts(spans) if exclude else spans
    inside = s.join(rect.select("page_id", "top", "bottom"), "page_id").where("y0 >= top and y0 < bottom")
    return region(inside, "body", F.lit(0.0), F.lit(None).cast("double"))


def batch_texts(spans: DataFrame, pages: DataFrame, first: int, last: int) -> DataFrame:
    """Text of every page of a range, '' where it has none. pages: page_id, page_number."""
    p = pages.where(F.col("page_number").between(first, last)).select("page_id", "page_number")
    t = region(spans.join(p.select("page_id"), "page_id", "left_semi"), "body", F.lit(0.0), F.lit(None).cast("double"))
    return p.join(t, "page_id", "left").withColumn("text", F.coalesce("text", F.lit("")))


def font_ranking(spans: DataFrame) -> DataFrame:
    """Per book and font the spans of each script class and in all, in descending order of Devanagari,
    transliteration, legacy signs and all."""
    t = F.col("text")
    kind = F.when(t.rlike("[ऀ-ॿ]"), "dev").when(t.rlike("[āīūṛṝṣśṅñṁḥḍṭṇḷ]"), "iast").when(t.rlike("[äåçéëïöüìùòà]"), "legacy").otherwise("other")
    n = spans.where(F.trim("text") != "").groupBy("book_id", "font").agg(F.count("*").alias("spans"), *[F.count_if(kind == k).alias(k) for k in ("dev", "iast", "legacy", "other")])
    return n.orderBy("book_id", F.desc("dev"), F.desc("iast"), F.desc("legacy"), F.desc("spans"), "font")


def font_sizes(spans: DataFrame, most: int = 5) -> DataFrame:
    """Per book and font a histogram of sizes and the first different sample texts, at most ``most``.
    spans: book_id, page_id, line_no, font, size, text."""
    key = ["book_id", "font"]
    s = spans.where(F.trim("text") != "")
    sizes = s.groupBy(*key, "size").agg(F.count("*").alias("n")).groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("size", "n"))), lambda x: F.concat(x["size"].cast("string"), F.lit(":"), x["n"].cast("string"))), " ").alias("sizes"))
    first = s.groupBy(*key, "text").agg(F.min(F.struct("page_id", "line_no")).alias("at")).withColumn("k", F.row_number().over(W.partitionBy(*key).orderBy("at", "text"))).where(F.col("k") <= most)
    samples = first.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), " | ").alias("samples"))
    return sizes.join(samples, key)


def sampled_fonts(spans: DataFrame, totals: DataFrame, pages: int = 20) -> DataFrame:
    """Fonts of evenly spaced pages of every book, about ``pages`` of them. spans: book_id,
    page_number, font; totals: book_id, number_of_pages."""
    step = F.greatest(F.lit(1), F.floor(F.col("number_of_pages") / pages).cast("int"))
    return spans.join(totals.select("book_id", "number_of_pages"), "book_id").where((F.col("page_number") - 1) % step == 0).where("font is not null").select("book_id", "font").distinct()


def largest_page(pages: DataFrame) -> DataFrame:
    """The size all pages of a document are brought to: doc, w, h."""
    return pages.groupBy("doc").agg(F.max("w").alias("w"), F.max("h").alias("h"))


def dominant_height(pages: DataFrame) -> DataFrame:
    """pages: book_id, page_h. Median of the heights that round to the book's most frequent one (the
    lower of two), to which shares of the height are applied."""
    n = pages.where("page_h is not null").groupBy("book_id", F.round("page_h", 1).alias("_r")).agg(F.count("*").alias("_c"))
    mode = n.groupBy("book_id").agg(F.max(F.struct("_c", (-F.col("_r")).alias("_m"))).alias("_x")).select("book_id", (-F.col("_x._m")).alias("_r"))
    near = pages.select("book_id", "page_h", F.round("page_h", 1).alias("_r")).join(mode, ["book_id", "_r"])
    return quantiles(counted(near, "book_id", "page_h"), "book_id", "page_h", {"height": 0.5}).select("book_id", "height")


def thumbnail(width: Column, height: Column, box: int = 400) -> dict[str, Column]:
    """Size of a picture that fits into a square box, never larger than it was, and whether it is so
    small that it is to be sharpened."""
    scale = F.least(F.lit(1.0), F.lit(float(box)) / F.greatest(width, height))
    w, h = F.greatest(F.lit(1), F.round(width * scale).cast("int")), F.greatest(F.lit(1), F.round(height * scale).cast("int"))
    return {"width": w, "height": h, "sharpen": (w < 400) | (h < 400)}
