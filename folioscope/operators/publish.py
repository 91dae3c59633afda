"""What is published of a corpus: its index, counts that documents state of it, the changes between snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import token_count, year_number

# Fields in the order of the index, phrases that state a quantity, the index's name.
FIELDS = [
    "title", "title_translit", "title_en", "author", "author_translit", "language", "year", "year_note", "translator",
    "source", "source_url", "source_note", "selection_note", "edition_note", "language_note", "license", "writing-mode",
]
PHRASES = [
    (r"([0-9]+)\s+languages\b", "languages"),
    (r"([0-9]+)\s+locales\b", "locales"),
    (r"([0-9]+)\s+books\b", "books"),
    (r"([0-9]+)\s+individual\s+works\b", "books"),
    (r"([0-9]+)\s+markdown\s+files\b", "books"),
    (r"([0-9]+)\s+language\s+families\b", "families"),
    (r"([0-9]+)\s+beyond\s+modern\s+English\b", "beyond_english"),
]


def record_fields(path: Column, locale: Column, header: Column, size: Column, body: Column) -> Column:
    """A book's fields as JSON pairs: fixed fields, then the header's other keys in order, then year, size and words; missing ones are left out."""
    known = F.array(*map(F.lit, FIELDS))
    have = F.map_keys(header)
    keys = F.concat(F.filter(known, lambda k: F.array_contains(have, k)), F.array_sort(F.array_except(have, known)))
    text = lambda x: F.substring(F.to_json(F.array(x)), F.lit(2), F.length(F.to_json(F.array(x))) - 2)
    pairs = F.transform(keys, lambda k: F.concat(text(k), F.lit(": "), text(F.element_at(header, k))))
    year = year_number(F.coalesce(F.try_element_at(header, F.lit("year")), F.lit("")))
    numbers = F.array_compact(
        F.array(
            F.concat(F.lit('"yearNumeric": '), year.cast("string")),
            F.concat(F.lit('"sizeBytes": '), size.cast("string")),
            F.concat(F.lit('"wordCount": '), token_count(body).cast("string")),
        )
    )
    first = F.array(F.concat(F.lit('"path": '), text(path)), F.concat(F.lit('"locale": '), text(locale)))
    return F.concat(first, pairs, numbers)


def record_json(path: Column, locale: Column, header: Column, size: Column, body: Column) -> Column:
    """A book's record as one line of JSON."""
    return F.concat(F.lit("{"), F.array_join(record_fields(path, locale, header, size, body), ", "), F.lit("}"))


def derived_counts(books: DataFrame, coverage: DataFrame | None = None) -> DataFrame:
    """``quantity, n`` of ``books(locale)``: books, locales, languages (their first subtag), locales beyond modern English.

    With the rows of a ``coverage`` table, also the families in it, named up to
    a comma; -1 if it has no rows.
    """
    language = F.substring_index("locale", "-", 1)
    english = (language == "en") | F.col("locale").isin("ang", "enm")
    one = books.agg(
        F.count("*").alias("books"),
        F.countDistinct("locale").alias("locales"),
        F.countDistinct(language).alias("languages"),
        F.countDistinct(F.when(~english, F.col("locale"))).alias("beyond_english"),
    )
    quantities = ("books", "locales", "languages", "beyond_english")
    counts = one.select(F.inline(F.array(*[F.struct(F.lit(q).alias("quantity"), F.col(q).alias("n")) for q in quantities])))
    if coverage is None:
        return counts
    n = F.countDistinct(F.trim(F.substring_index("family", ",", 1)))
    return counts.unionByName(coverage.agg(F.lit("families").alias("quantity"), F.when(n > 0, n).otherwise(-1).alias("n")))


def locale_counts(books: DataFrame, coverage: DataFrame) -> DataFrame:
    """``family, locale, problem``: what is wrong with the rows ``coverage(family, locales, n)`` of ``books(locale)``.

    ``count`` if a row's number is not that of the books in its known locales,
    ``unknown`` for a locale without books, ``twice`` for one that an earlier
    row (by name) has, ``missing`` for one of the corpus that is in no row.
    """
    held = books.groupBy("locale").agg(F.count("*").alias("books"))
    rows = coverage.select("family", "n", F.explode_outer("locales").alias("locale")).join(held, "locale", "left")
    order = F.row_number().over(Window.partitionBy("locale").orderBy("family"))
    rows = rows.withColumn("again", F.col("books").isNotNull() & (order > 1))
    totals = rows.groupBy("family", "n").agg(F.coalesce(F.sum("books"), F.lit(0)).alias("held")).where("n <> held")
    parts = [
        totals.select("family", F.lit(None).cast("string").alias("locale"), F.lit("count").alias("problem")),
        rows.where("locale is not null and books is null").select("family", "locale", F.lit("unknown").alias("problem")),
        rows.where("again").select("family", "locale", F.lit("twice").alias("problem")),
        held.join(rows.select("locale").distinct(), "locale", "left_anti").select(F.lit(None).cast("string").alias("family"), "locale", F.lit("missing").alias("problem")),
    ]
    return reduce(DataFrame.unionByName, parts)


def stated_counts(docs: DataFrame, derived: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, quantity, stated, n`` of all numbers in ``docs(key, text)`` that differ from ``derived(quantity, n)``."""
    def numbers(pattern, quantity):
        found = F.regexp_extract_all("text", F.lit(pattern), 1)
        return F.transform(found, lambda x: F.struct(F.lit(quantity).alias("quantity"), x.try_cast("long").alias("stated")))

    found = F.flatten(F.array(*[numbers(p, q) for p, q in PHRASES]))
    rows = docs.select(key, F.inline(found))
    return rows.join(F.broadcast(derived), "quantity").where("stated is null or stated <> n").select(key, "quantity", "stated", "n")


def coverage_rows(docs: DataFrame, key: str = "doc_id", heading: str = "## Coverage matrix") -> DataFrame:
    """``key, family, locales, n`` of the first table under the heading; head and rule of the table are left out."""
    after = F.when(F.instr("text", heading) > 0, F.substring(F.col("text"), F.instr("text", heading) + len(heading), F.length("text")))
    table = F.regexp_extract(after, r"(?sd)(?:^|\n)((?:[ \t]*\|[^\n]*(?:\n|\z))+)", 1)
    pattern = r"^\|([^|]+)\|[^|]+\|([^|]+)\|\s*([0-9]+)\s*\|$"
    rows = docs.select(key, F.explode(F.transform(F.split(table, "\n"), lambda x: F.trim(x))).alias("line")).where(F.col("line").rlike(pattern))
    part = lambda i: F.trim(F.regexp_extract("line", pattern, i))
    names = F.filter(F.transform(F.split(part(2), ","), lambda x: F.trim(x)), lambda x: x != "")
    return rows.select(key, part(1).alias("family"), names.alias("locales"), part(3).cast("long").alias("n")).where("family not in ('Family', '---')")


def changelog(old: DataFrame, new: DataFrame) -> DataFrame:
    """``section, locale, n`` of the changes between snapshots ``(path, locale, text)``.

    Sections are added, added locale, removed, lost locale, moved (an equal text under
    a new path) and revised; a path counts once.
    """
    slim = lambda df, name: df.select("path", F.col("locale").alias(f"l_{name}"), F.sha2("text", 256).alias(f"h_{name}"))
    both = slim(old, "a").join(slim(new, "b"), "path", "full_outer")
    gone, come = both.where("l_b is null"), both.where("l_a is null")
    moves = come.groupBy("h_b").agg(F.count("*").alias("n_b")).join(gone.groupBy("h_a").agg(F.count("*").alias("n_a")), F.col("h_a") == F.col("h_b"))
    pairs = moves.select(F.col("h_b").alias("h"), F.least("n_a", "n_b").alias("times"))
    moved = come.join(pairs, F.col("h_b") == F.col("h"), "left_semi").select("l_b", F.lit("moved").alias("section"))
    before, after = (both.where(f"{c} is not null").select(F.col(c).alias("locale")).distinct() for c in ("l_a", "l_b"))
    plain = come.join(pairs, F.col("h_b") == F.col("h"), "left_anti")
    rows = [
        plain.select(F.lit("added").alias("section"), F.col("l_b").alias("locale")),
        moved.select("section", F.col("l_b").alias("locale")),
        gone.join(pairs, F.col("h_a") == F.col("h"), "left_anti").select(F.lit("removed").alias("section"), F.col("l_a").alias("locale")),
        both.where("h_a <> h_b").select(F.lit("revised").alias("section"), F.col("l_b").alias("locale")),
        after.join(before, "locale", "left_anti").select(F.lit("added locale").alias("section"), "locale"),
        before.join(after, "locale", "left_anti").select(F.lit("lost locale").alias("section"), "locale"),
    ]
    out = rows[0]
    for part in rows[1:]:
        out = out.unionByName(part)
    return out.groupBy("section", "locale").agg(F.count("*").alias("n"))


def described(header: Column) -> Column:
    """Author, title and, if the title does not hold it, the English title of a book."""
    field = lambda k: F.trim(F.coalesce(F.try_element_at(header, F.lit(k)), F.lit("")))
    title, author, english = field("title"), field("author"), field("title_en")
    label = F.concat(F.when(author != "", F.concat(author, F.lit(", "))).otherwise(""), F.lit("*"), title, F.lit("*"))
    return F.concat(label, F.when((english != "") & ~F.contains(title, english), F.concat(F.lit(" ("), english, F.lit(")"))).otherwise(""))


def changelog_rows(old: DataFrame, new: DataFrame, heading: str, least: float = 0.5) -> DataFrame:
    """``rank, key, text``: a changelog section between snapshots ``(path, locale, header, text)``, its lines in order by rank and key.

    New locales with their books, new books of other locales, books that moved
    (the same or most of the text under a new path), removed ones, locales that
    are gone, and how many books of each locale were revised; only what there
    is.  Paths are unique.
    """
    from .renames import snapshot_changes

    changes = snapshot_changes(old, new, least, key="path")
    of = lambda df, side: df.select(F.col("path").alias(side), F.col("locale").alias(f"{side}_locale"), described(F.col("header")).alias(f"{side}_label"))
    changes = changes.join(of(old, "old"), "old", "left").join(of(new, "new"), "new", "left")
    before, after = old.select("locale").distinct(), new.select("locale").distinct()
    fresh, lost = after.join(before, "locale", "left_anti"), before.join(after, "locale", "left_anti")
    added = changes.where("change = 'added'").withColumnRenamed("new_locale", "locale")
    removed, moved, edited = (changes.where(F.col("change") == c) for c in ("removed", "renamed", "edited"))
    entry = F.concat(F.lit("- **"), "locale", F.lit("**: "), "new_label")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("new", "new_label"))), lambda x: x["new_label"]), "; ")
    per_locale = added.groupBy("locale").agg(joined.alias("entries"))
    revised = edited.groupBy("new_locale").agg(F.count("*").alias("n"))
    told = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("new_locale", "n"))), lambda x: F.format_string("%s (%d)", x["new_locale"], x["n"])), ", ")
    row = lambda df, rank, key, text: df.select(F.lit(rank).alias("rank"), key.alias("key"), text.alias("text"))
    none = F.lit("")
    size = lambda df, name: df.agg(F.count("*").alias(f"{name}_books"), F.countDistinct("locale").alias(f"{name}_locales"))

    def titled(rank, entries, title):
        """The entries of a part below its heading, and a blank line behind them."""
        return entries.unionByName(
            entries.agg(F.count("*").alias("n")).where("n > 0").select(
                F.explode(F.array(F.struct(F.lit(rank).alias("rank"), F.format_string(f"### {title}\n", "n").alias("text")), F.struct(F.lit(rank + 2).alias("rank"), F.lit("").alias("text")))).alias("r")
            ).select("r.rank", F.lit("").alias("key"), "r.text")
        )

    top = size(old, "a").crossJoin(size(new, "b"))
    counts = F.format_string("%d books in %d locales, to %d books in %d.\n", "a_books", "a_locales", "b_books", "b_locales")
    parts = [
        row(top, 0, none, F.concat(F.lit(f"## {heading}\n\n"), counts)),
        titled(10, row(fresh.join(per_locale, "locale", "left"), 11, F.col("locale"), F.concat(F.lit("- **"), "locale", F.lit("**: "), F.coalesce("entries", F.lit("")))), "New locales (%d)"),
        titled(20, row(added.join(fresh, "locale", "left_anti"), 21, F.col("new"), entry), "New books in existing locales (%d)"),
        titled(30, row(moved, 31, F.col("old"), F.concat(F.lit("- `"), "old", F.lit("` is now `"), "new", F.lit("`"))), "Moved or re-attributed (%d)"),
        titled(40, row(removed, 41, F.col("old"), F.concat(F.lit("- **"), "old_locale", F.lit("**: "), "old_label")), "Removed (%d)"),
        row(lost.agg(F.array_join(F.array_sort(F.collect_set("locale")), ", ").alias("l")).where("l <> ''"), 50, none, F.concat(F.lit("Locales no longer present: "), "l", F.lit("\n"))),
        row(edited.agg(F.count("*").alias("n")).where("n > 0"), 60, none, F.concat(F.format_string("### Revised text (%d ", "n"), F.when(F.col("n") == 1, "book)\n").otherwise("books)\n"))),
        row(revised.agg(F.count("*").alias("n"), told.alias("t")).where("n > 0"), 61, none, F.concat("t", F.lit("\n"))),
        row(changes.agg(F.count("*").alias("n")).where("n = 0"), 70, none, F.lit("No change to the corpus itself in this range.\n")),
    ]
    return reduce(DataFrame.unionByName, parts)


def stale(published: DataFrame, built: DataFrame) -> DataFrame:
    """Paths of records that differ between ``(path, record)`` tables, or stand in one of them only."""
    a, b = published.select("path", F.col("record").alias("a")), built.select("path", F.col("record").alias("b"))
    return a.join(b, "path", "full_outer").where("not a <=> b").select("path")
