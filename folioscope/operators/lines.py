"""Line and block operators: explode, runs, blocks, fences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def explode_lines(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """One row for each LF-separated line: the columns to keep, ``line_no`` from 1, ``line``."""
    return docs.select(*keep, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("i", "line")).select(
        *keep, (F.col("i") + 1).alias("line_no"), "line"
    )


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it stands in it, in lambdas too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def once(value: Column) -> Column:
    """``value`` by a generator, below which the optimizer moves no filter that would work it out again."""
    return F.explode_outer(F.array(value))


def before(items: Column) -> Column:
    """An array moved on by one place: what stands before each item, null before the first; one longer."""
    return F.concat(F.transform(F.slice(items, 1, 1), lambda x: F.nullif(x, x)), items)


def after(items: Column) -> Column:
    """An array moved back by one place: what stands behind each item; one shorter."""
    return F.slice(items, 2, F.greatest(F.size(items), F.lit(1)))


def places(flags: Column) -> Column:
    """The places, from 0, of the true values of an array."""
    return F.filter(F.transform(flags, lambda x, i: F.when(x, i)), lambda i: i.isNotNull())


def runs(flags: Column) -> Column:
    """Maximal runs of true values in an array without nulls: ``array<struct<first, last>>``, places from 0."""
    no = lambda x: ~F.coalesce(x, F.lit(False))
    first = places(F.zip_with(flags, before(flags), lambda x, y: x & no(y)))
    last = places(F.zip_with(flags, after(flags), lambda x, y: x & no(y)))
    return F.arrays_zip(first.alias("first"), last.alias("last"))


def soft_wrapped(line: Column, max_line: int = 65) -> Column:
    """A short line that is no heading and has no hard break."""
    return (
        (F.trim(line) != "")
        & ~line.startswith("#")
        & (F.length(F.trim(line)) < max_line)
        & ~line.endswith("  ")
        & ~line.endswith("\\")
    )


def verse_runs(docs: DataFrame, max_line: int = 65, min_run: int = 4, min_runs: int = 3) -> DataFrame:
    """Runs of soft-wrapped verse lines of each document: ``doc_id, n_runs, max_run, flagged``; one fold over the lines."""
    state = lambda run, n, most: F.struct(run.alias("run"), n.alias("n"), most.alias("most"))
    zero = F.lit(0).cast("long")

    def close(s):
        long = s["run"] >= min_run
        return state(zero, s["n"] + F.when(long, 1).otherwise(0), F.when(long, F.greatest(s["most"], s["run"])).otherwise(s["most"]))

    step = lambda s, x: F.when(soft_wrapped(x, max_line), state(s["run"] + 1, s["n"], s["most"])).otherwise(close(s))
    found = F.aggregate(split_lines(F.col("text")), state(zero, zero, zero), step, close)
    # a generator, below which no filter is moved that would run the fold again
    rows = docs.select("doc_id", F.inline(F.array(F.struct(found.alias("f"))))).select("doc_id", "f.n", "f.most").where("n > 0")
    return rows.select("doc_id", F.col("n").alias("n_runs"), F.col("most").alias("max_run"), (F.col("n") >= min_runs).alias("flagged"))


def block_classes(docs: DataFrame, prose: int = 58, paragraph: int = 90, min_verse: int = 2) -> DataFrame:
    """Blocks of non-blank lines with their class: ``doc_id, first_line, n_lines, class``."""
    lines = docs.select("doc_id", split_lines(F.col("text")).alias("lines")).select(
        "doc_id", F.transform("lines", F.length).alias("sizes"), F.transform("lines", lambda x: F.trim(x) != "").alias("filled")
    )
    blocks = F.transform(
        runs(F.col("filled")),
        lambda r: F.struct(r["first"].alias("first"), F.slice(F.col("sizes"), r["first"] + 1, r["last"] - r["first"] + 1).alias("sizes")),
    )
    sized = lines.select("doc_id", F.inline(blocks)).withColumn("n_lines", F.size("sizes").cast("long"))
    before = F.slice("sizes", F.lit(1), F.col("n_lines").cast("int") - 1)
    mean = F.aggregate(before, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.col("n_lines") - 1, F.lit(0))
    kind = (
        F.when(F.col("n_lines") < 2, "single")
        .when(F.array_max("sizes") > paragraph, "para")
        .when(mean >= prose, "prose")
        .when(F.col("n_lines") < min_verse, "prose")
        .otherwise("verse")
    )
    return sized.select("doc_id", (F.col("first") + 1).alias("first_line"), "n_lines", kind.alias("class"))


def short_lines(docs: DataFrame, limit: int) -> DataFrame:
    """Lines under a length with the next such line: ``doc_id, line_no, next_boundary``."""
    at = F.filter(F.transform(split_lines(F.col("text")), lambda x, i: F.when(F.length(x) < limit, i + 1)), lambda i: i.isNotNull())
    pairs = F.zip_with(at, after(at), lambda x, y: F.struct(x.alias("line_no"), y.alias("next_boundary")))
    return docs.select("doc_id", F.inline(pairs))


def split_table_rows(docs: DataFrame) -> DataFrame:
    """Pipe rows outside fences whose indent differs from the row before: ``doc_id, line_no``."""
    order = Window.partitionBy("doc_id").orderBy("line_no")
    lines = explode_lines(docs, "doc_id").withColumn("fence", F.ltrim("line").startswith("```"))
    lines = lines.withColumn("inside", F.sum(F.col("fence").cast("int")).over(order) % 2 == 1)
    row = F.ltrim("line").startswith("|") & ~F.col("inside") & ~F.col("fence")
    lines = lines.withColumn("indent", F.when(row, F.length("line") - F.length(F.ltrim("line"))))
    return lines.withColumn("before", F.lag("indent").over(order)).where("before is not null and indent <> before").select("doc_id", "line_no")


def hard_breaks(text: Column) -> Column:
    """Two trailing spaces on every line that another non-blank line follows."""
    clean = F.regexp_replace(text, "[ \t]+(?=\n|$)", "")
    return F.regexp_replace(clean, "(?<=[^\n])\n(?=[^\n])", "  \n")


def versify(text: Column) -> Column:
    """A blank line between all non-blank lines."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != ""), "\n\n")


def drop_adjacent_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, text`` without lines equal to the line before, blank ones apart."""
    parts = F.split(F.col(text), "\n")
    pairs = F.zip_with(parts, before(parts), lambda x, y: F.struct(x.alias("line"), ((F.trim(x) == "") | ~F.coalesce(F.trim(y) == F.trim(x), F.lit(False))).alias("kept")))
    kept = F.filter(pairs, lambda p: p["line"].isNotNull() & p["kept"])
    return docs.select("doc_id", F.array_join(F.transform(kept, lambda p: p["line"]), "\n").alias("text"))


def heading_jumps(docs: DataFrame) -> DataFrame:
    """First heading of each document that is more than one level below the heading before it."""
    level = lambda x: F.length(F.regexp_extract(x, "^(#{1,6})[ \t]+[^ \t]", 1))
    heads = F.filter(F.transform(split_lines(F.col("text")), lambda x, i: F.struct((i + 1).alias("line_no"), level(x).alias("level"))), lambda h: h["level"] > 0)
    jumps = F.filter(F.zip_with(heads, after(heads), lambda a, b: F.when(b["level"] > a["level"] + 1, b["line_no"])), lambda n: n.isNotNull())
    return docs.select("doc_id", F.explode(F.slice(jumps, 1, 1)).alias("line_no"))
