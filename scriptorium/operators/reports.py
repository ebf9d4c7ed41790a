"""Summaries of what a step found or changed; each is computed from the step's own result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def breakdown(errors: DataFrame, by: list[str], top: int | None = None) -> DataFrame:
    """How many errors there are by each of the columns: kind (the column's name), value, n; most
    frequent first, ties by value; at most ``top`` of each."""
    out = None
    for c in by:
        n = errors.groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")).select(F.lit(c).alias("kind"), "value", "n")
        if top:
            n = n.orderBy(F.desc("n"), "value").limit(top)
        out = n if out is None else out.unionByName(n)
    return out


def error_samples(errors: DataFrame, term: str, order: str, most: int = 10) -> DataFrame:
    """The first different terms with an error, each with its first error."""
    first = errors.groupBy(term).agg(F.min_by(F.struct(*[c for c in errors.columns if c != term]), order).alias("_e"))
    return first.select(term, "_e.*").orderBy(order).limit(most)


def change_counters(rows: DataFrame, old: str, new: str, marks: dict[str, str] | None = None) -> DataFrame:
    """total, changed, unchanged and failed (the new value is NULL but the old isn't) rows, and the
    changed ones whose old value has each of the marks."""
    failed = F.col(new).isNull() & F.col(old).isNotNull()
    changed = ~failed & ~F.col(old).eqNullSafe(F.col(new))
    each = [F.count_if(changed & F.coalesce(F.lower(F.col(old)).contains(m), F.lit(False))).alias(k) for k, m in (marks or {}).items()]
    return rows.agg(F.count("*").alias("total"), F.count_if(changed).alias("changed"), F.count_if(~changed & ~failed).alias("unchanged"), F.count_if(failed).alias("failed"), *each)


def change_examples(rows: DataFrame, key: str, old: str, new: str, most: int = 10) -> DataFrame:
    """The first changed rows by key."""
    return rows.where(~F.col(old).eqNullSafe(F.col(new))).select(key, old, new).orderBy(key).limit(most)


def outcome(rows: DataFrame, ok) -> DataFrame:
    """Rows in all, successful and failed ones; a condition that is NULL is a failure."""
    good = F.count_if(F.coalesce(ok, F.lit(False)))
    return rows.agg(F.count("*").alias("total"), good.alias("successful"), (F.count("*") - good).alias("failed"))


def run_counters(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """What an upsert of new into old does: rows inserted, updated, left as they are and skipped (a
    key that is NULL). Repeated keys of new count once."""
    rest = [c for c in new.columns if c not in keys]
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    one = new.where(~null).dropDuplicates(keys)
    o = old.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"_o_{c}") for c in rest], F.lit(1).alias("_old"))
    j = one.join(o, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)], "left")
    same = F.lit(True)
    for c in rest:
        same = same & F.coalesce(F.col(c), F.col(f"_o_{c}")).eqNullSafe(F.col(f"_o_{c}"))
    there, no = F.col("_old").isNotNull(), F.lit(False)
    each = j.select(there.alias("there"), same.alias("same"), no.alias("skipped")).unionByName(new.where(null).select(no.alias("there"), no.alias("same"), F.lit(True).alias("skipped")))
    return each.agg(F.count_if(F.expr("not there and not skipped")).alias("inserted"), F.count_if(F.expr("there and not same")).alias("updated"), F.count_if(F.expr("there and same")).alias("unchanged"), F.count_if("skipped").alias("skipped"))


def fix_report(corrections: DataFrame, top: int = 10, flagged: int = 20) -> DataFrame:
    """part, place, word, corrected, n: the most frequent corrected words of every class and the words
    to be reviewed, each list bounded. corrections: of transliteration.corrections."""
    c = corrections.where(F.col("word") != F.col("corrected"))
    w = W.partitionBy("class").orderBy(F.desc("n"), "word")
    best = c.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top).select(F.col("class").alias("part"), "place", "word", "corrected", "n")
    odd = corrections.where("review").orderBy(F.desc("n"), "word").limit(flagged).withColumn("place", F.row_number().over(W.orderBy(F.desc("n"), "word")))
    return best.unionByName(odd.select(F.lit("review").alias("part"), "place", "word", "corrected", "n"))


def grouped_report(errors: DataFrame, book: str, item: str, fields: list[str]) -> DataFrame:
    """Lines of a text report by book: place, line. A book's heading gives its number of errors; every
    error has its fields one under the other."""
    head = errors.groupBy(book).agg(F.count("*").alias("_n")).select(F.col(book).alias("book"), F.lit(-1).cast("long").alias("item"), F.lit(0).alias("part"), F.concat(F.lit("Book "), F.coalesce(F.col(book).cast("string"), F.lit("-")), F.lit(": "), F.col("_n").cast("string"), F.lit(" unresolved")).alias("line"))
    each = F.posexplode(F.array(*[F.concat(F.lit(f"  {f}: "), F.coalesce(F.col(f).cast("string"), F.lit("-"))) for f in fields]))
    body = errors.select(F.col(book).alias("book"), F.col(item).cast("long").alias("item"), each.alias("part", "line"))
    return head.unionByName(body)


def endings_examples(rows: DataFrame, ending, key: str, text: str, most: int = 20) -> DataFrame:
    """The first rows by key of each class of ending, at most ``most``."""
    w = W.partitionBy("ending").orderBy(key)
    return rows.select(key, ending.alias("ending"), F.right(F.rtrim(text), F.lit(20)).alias("tail")).withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)


def glyph_totals(records: DataFrame) -> DataFrame:
    """Records, occurrences, fonts and glyphs in all."""
    return records.agg(F.count("*").alias("records"), F.sum("occurrence_count").alias("occurrences"), F.count_distinct("font_name").alias("fonts"), F.count_distinct("glyph").alias("glyphs"))


def character_languages(contexts: DataFrame, french: list[str], english: list[str]) -> DataFrame:
    """Of the contexts of a character: all, those with letters of transliteration, and those with
    French or English words that have the character by right."""
    low = F.lower("context")
    any_of = lambda words: F.count_if(low.rlike("|".join(words)))
    return contexts.agg(F.count("*").alias("total"), F.count_if(F.col("context").rlike("[āīūṛṝḷḹṅñṭḍṇśṣṁṃḥ]")).alias("sanskrit"), any_of(french).alias("french"), any_of(english).alias("english"))
