"""Corpus relations: snapshots, coverage, index rules, cross-source fidelity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import best_line_ratio, near_in_length
from ..functions.text import clean_lines

#: Marks that conversions tend to drop.
MARKS = "๏๚๛ฯๆ।॥۔؟،؛ﷺ«»„…、。，「」『』《》！？；："


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """``doc_id, change``: added, removed, edited (same id, other text) or renamed (same text, new id)."""
    a = old.select(F.col("doc_id").alias("id_a"), F.sha2("text", 256).alias("h_a"))
    b = new.select(F.col("doc_id").alias("id_b"), F.sha2("text", 256).alias("h_b"))
    both = a.join(b, F.col("id_a") == F.col("id_b"), "full_outer")
    gone = both.where("id_b is null").select("h_a").distinct()
    added = both.where("id_a is null")
    renamed = added.select("id_b", "h_b").join(gone, F.col("h_b") == gone["h_a"], "left_semi").select(F.col("id_b").alias("doc_id"), F.lit("renamed").alias("change"))
    plain = both.select(
        F.coalesce("id_a", "id_b").alias("doc_id"),
        F.when(F.col("id_a").isNull(), "added").when(F.col("id_b").isNull(), "removed").when(F.col("h_a") != F.col("h_b"), "edited").alias("change"),
    ).where("change is not null")
    return plain.join(renamed.select("doc_id"), "doc_id", "left_anti").unionByName(renamed)


def mark_drops(source: DataFrame, copy: DataFrame, marks: str = MARKS, key: str = "doc_id", rendered: frozenset | set = frozenset()) -> DataFrame:
    """``key, mark, n_source, n_copy, ok`` for every mark of the source: ``ok`` unless the copy has fewer.

    Marks in ``rendered`` stand for what a renderer draws itself; they need not
    be in the copy.  One row for each document is joined, with its counts.
    """
    def counts(df, name):
        n = [(F.length("text") - F.length(F.replace("text", F.lit(m)))).cast("long") for m in marks]
        return df.select(key, F.array(*n).alias(name))

    both = counts(source, "s").join(counts(copy, "c"), key)
    rows = both.select(key, F.inline(F.arrays_zip(F.array(*map(F.lit, marks)).alias("mark"), F.col("s").alias("n_source"), F.col("c").alias("n_copy"))))
    ok = (F.col("n_copy") >= F.col("n_source")) | F.col("mark").isin(list(rendered))
    return rows.where("n_source > 0").withColumn("ok", ok)


def is_body(line: Column, script: str | None = None, min_length: int = 12) -> Column:
    """A line of text proper: long enough, no page number, and mostly in the work's script if one is given (a class)."""
    good = (F.length(line) >= min_length) & ~line.rlike(r"^\W*[0-9]{1,4}\W*$")
    if script is None:
        return good
    letters = F.regexp_count(line, F.lit(r"\p{L}"))
    return good & (letters > 0) & (2 * F.regexp_count(line, F.lit(script)) >= letters)


def line_ratios(base: DataFrame, other: DataFrame, script: str | None = None, min_length: int = 12) -> DataFrame:
    """``page_id, line, ratio`` of every body line of ``base(page_id, text)`` against the same page of ``other``.

    Pages are joined whole, as arrays of lines; lines of very different
    length are left out before any is compared.
    """
    ours = base.select("page_id", clean_lines(F.col("text")).alias("lines"))
    theirs = other.select("page_id", clean_lines(F.col("text")).alias("others"))
    rows = ours.join(theirs, "page_id").select("page_id", F.explode("lines").alias("line"), "others").where(is_body(F.col("line"), script, min_length))
    return rows.select("page_id", "line", best_line_ratio("line", near_in_length(F.col("line"), F.col("others"))).alias("ratio"))


def agreement(ratios: DataFrame, *key: str, high: float = 0.8) -> DataFrame:
    """``body_lines, high_share, mean, flagged`` of ``ratios(ratio)`` by key; without a key one row, zeros if there are no lines."""
    ok = (F.col("ratio") >= high).cast("double")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return ratios.groupBy(*key).agg(
        F.count("*").alias("body_lines"),
        zero(F.bround(F.avg(ok), 4)).alias("high_share"),
        zero(F.bround(F.avg("ratio"), 4)).alias("mean"),
        F.count_if(F.col("ratio") < high).alias("flagged"),
    )


def flagged_lines(ratios: DataFrame, high: float = 0.8) -> DataFrame:
    """Lines to look at: ``page_id, ratio`` (two places) and ``line``."""
    return ratios.where(F.col("ratio") < high).select("page_id", F.bround("ratio", 2).alias("ratio"), "line")


def pick_base(pages: DataFrame, letters: str) -> DataFrame:
    """The engine with the least noise over the pages that all engines have; of equal ones the last by name."""
    n_engines = pages.select("engine").distinct().count()
    shared = pages.groupBy("page_id").agg(F.countDistinct("engine").alias("n")).where(F.col("n") == n_engines).select("page_id")
    found = noise(pages.join(shared, "page_id"), letters)
    return found.agg(F.max_by("engine", F.struct(-F.col("noise"), "engine")).alias("engine"), F.min("noise").alias("noise"))


def witness_lines(a: DataFrame, b: DataFrame, count_a, count_b) -> DataFrame:
    """``line_no, n_a, n_b`` of lines of two witnesses ``(line_no, text)`` whose counts differ, or that one of them lacks."""
    x, y = (df.select("line_no", f(F.col("text")).alias(n)) for df, f, n in ((a, count_a, "n_a"), (b, count_b, "n_b")))
    return x.join(y, "line_no", "full_outer").where("not n_a <=> n_b")


def coverage(stated: DataFrame, actual: DataFrame) -> DataFrame:
    """Stated ``(locale, n)`` against actual: ``locale, problem`` (unknown, missing, duplicate, mismatch)."""
    counts = actual.groupBy("locale").agg(F.count("*").alias("have"))
    claimed = stated.groupBy("locale").agg(F.sum("n").alias("n"), F.count("*").alias("times"))
    problem = (
        F.when(F.col("have").isNull(), "unknown").when(F.col("n").isNull(), "missing")
        .when(F.col("times") > 1, "duplicate").when(F.col("n") != F.col("have"), "mismatch")
    )
    return claimed.join(counts, "locale", "full_outer").select("locale", problem.alias("problem")).where("problem is not null")


#: Fixed values of the index schema: keys, patterns, constants.
INDEX_KEYS = ["path", "locale", "title", "author", "language", "year", "source", "source_url", "license", "yearNumeric", "sizeBytes", "wordCount"]
OPTIONAL_KEYS = [
    "year_note", "source_note", "selection_note", "language_note", "edition_note", "translator", "title_translit",
    "title_en", "author_translit", "text_quality", "sacred_text", "writing-mode",
]
LICENSE = "Public domain in the United States"
TAG_PATTERN = "^[a-z]{2,3}(-[A-Za-z]{2,4})*$"
INDEX_RULES = {
    "MS-3": "path is null or not path rlike '^books/[^/]+/[^/]+/.+[.]md$'",
    "MS-4": f"locale is null or language is null or not locale rlike '{TAG_PATTERN}' or not language rlike '{TAG_PATTERN}'",
    "MS-5": "coalesce(length(title), 0) = 0 or coalesce(length(author), 0) = 0 or coalesce(length(source), 0) = 0",
    "MS-6": "year is null or not year rlike '^(c[.] )?[0-9]{1,4}( (BCE|CE))?(-[0-9]{1,4})?$' or yearNumeric is null or yearNumeric not between -3000 and 1928",
    "MS-7": "source_url is null or not source_url like 'https://%'",
    "MS-8": f"license is null or license <> '{LICENSE}'",
    "MS-9": "coalesce(sizeBytes, -1) < 0 or coalesce(wordCount, -1) < 0",
    "MS-10": "text_quality not in ('noisy', 'alpha') or sacred_text not in ('recovered-text', 'sole-witness') or `writing-mode` not in ('vertical-rl', 'horizontal-tb')",
}


def index_violations(records: DataFrame) -> DataFrame:
    """``path, rule`` for every rule that a record breaks; ``records(path, record map<string,string>)``, values as text.

    MS-1 is a required key that is missing, MS-2 one that the schema does not
    know; the other rules look at the values, numbers as far as they are any.
    """
    numbers = ("yearNumeric", "sizeBytes", "wordCount")
    value = lambda k: F.try_element_at("record", F.lit(k))
    typed = [(value(k).try_cast("long") if k in numbers else value(k)).alias(k) for k in INDEX_KEYS[1:] + OPTIONAL_KEYS]
    keys = F.map_keys("record")
    rows = records.select(
        "path",
        *typed,
        (F.size(F.array_except(F.array(*map(F.lit, INDEX_KEYS[1:])), keys)) > 0).alias("_missing"),
        (F.size(F.array_except(keys, F.array(*map(F.lit, INDEX_KEYS + OPTIONAL_KEYS)))) > 0).alias("_more"),
    )
    checks = [F.when(F.col("path").isNull() | F.col("_missing"), F.lit("MS-1")), F.when(F.col("_more"), F.lit("MS-2"))]
    checks += [F.when(F.expr(c), F.lit(k)) for k, c in INDEX_RULES.items()]
    return rows.select("path", F.explode(F.array(*checks)).alias("rule")).where("rule is not null")


def index_header(records: DataFrame) -> DataFrame:
    """The header of an index of ``records(path, locale)``: ``book_count, locale_count, locales`` (sorted)."""
    locales = F.array_sort(F.collect_set("locale"))
    return records.agg(F.count("*").alias("book_count"), locales.alias("locales")).select("book_count", F.size("locales").alias("locale_count"), "locales")


def index_headers(records: DataFrame) -> DataFrame:
    """``name, locales, book_count, locale_count`` of several indexes with ``records(name, locale)``.

    Records are counted by locale first; one with several stands twice in
    ``locales``, which is enough to see that it is repeated.
    """
    counts = records.groupBy("name", "locale").agg(F.count("*").alias("n"))
    locales = F.array_sort(F.flatten(F.collect_list(F.array_repeat("locale", F.least("n", F.lit(2)).cast("int")))))
    return counts.groupBy("name").agg(locales.alias("locales"), F.sum("n").alias("book_count"), F.count("locale").alias("locale_count"))


def header_violations(headers: DataFrame) -> DataFrame:
    """MS-11 over ``name, locales array, book_count, locale_count``: repeated or malformed locales, negative or missing counts."""
    twice = F.size(F.array_distinct("locales")) != F.size("locales")
    odd = F.exists("locales", lambda x: ~x.rlike(TAG_PATTERN))
    wrong = (F.coalesce("book_count", F.lit(-1)) < 0) | (F.coalesce("locale_count", F.lit(-1)) < 0)
    return headers.where(F.coalesce(twice | odd, F.lit(True)) | wrong).select("name", F.lit("MS-11").alias("rule"))


def one_each(docs: DataFrame, key: str, order: str) -> DataFrame:
    """Rows after the first of their key: a uniqueness constraint's violations.  The first ones are an aggregate, so no key is gathered."""
    first = docs.groupBy(key).agg(F.min(order).alias("_first"))
    return docs.join(first, key).where(F.col(order) > F.col("_first")).drop("_first").select(docs.columns)


def noise(pages: DataFrame, letters: str) -> DataFrame:
    """Share of characters that are neither space, digit nor in the class, by engine; 1 without text."""
    clean = F.regexp_replace("text", r"\s", "")
    parts = pages.select("engine", F.length(clean).alias("n"), F.length(F.regexp_replace(clean, f"[0-9{letters}]", "")).alias("odd"))
    return parts.groupBy("engine").agg((F.sum("odd") / F.nullif(F.sum("n"), F.lit(0))).alias("s")).select("engine", F.coalesce("s", F.lit(1.0)).alias("noise"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
