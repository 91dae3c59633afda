"""Layout that plain texts carry in blanks and numbers: footnotes, columns, indents, formulas, counts and sequences."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A link to a note and a note in a list, as wikis render them; the underscore may be escaped.
REFERENCE = r'<sup id="cite(?:_|&#95;)ref-[^"]+" class="reference"><a href="#cite(?:_|&#95;)note-([^"]+)">[^<]*(?:<(?!/sup>)[^<]*)*?</a></sup>'
NOTE = r'(?s)<li id="cite(?:_|&#95;)note-([^"]+)">(.*?)</li>'
NOTE_LIST = r'(?s)(?:<hr\s*/?>\s*)?(?:<div class="reflist"[^>]*>\s*(?:<ol class="references">.*?</ol>\s*)?</div>|<ol class="references">.*?</ol>)'
MARKER, DEFINITION = r"\[\^([^\]]+)\](?!:)", r"(?m)^\[\^([^\]]+)\]:"


def lift_notes(units: DataFrame, unit: str = "unit", html: str = "html") -> DataFrame:
    """``unit, html``: links to notes as ``[^unit-key]``, without the lists of notes.

    A note sign around the link, or an asterisk before it, goes with it.  The
    key is that of the target, so a note that is cited twice is one.
    """
    own = F.regexp_replace(F.col(unit).cast("string"), r"([$\\])", r"\\$1")
    mark = F.concat(F.lit("[^"), own, F.lit("-$1]"))
    text = F.regexp_replace(F.col(html), F.lit(rf"<sup>[^<]{{0,4}}{REFERENCE}</sup>"), mark)
    text = F.regexp_replace(text, rf"\*\s*(?={REFERENCE})", "")
    return units.select(unit, F.regexp_replace(F.regexp_replace(text, F.lit(REFERENCE), mark), NOTE_LIST, "").alias(html))


def note_definitions(units: DataFrame, unit: str = "unit", html: str = "html") -> DataFrame:
    """``unit, n, key, note``: the notes of each unit in order, the first of each key; ``note`` is what its text span holds."""
    key, inner = (F.regexp_extract_all(F.col(html), F.lit(NOTE), F.lit(i)) for i in (1, 2))
    rows = units.select(unit, F.posexplode(F.arrays_zip(key.alias("key"), inner.alias("inner"))).alias("at", "li"))
    note = F.regexp_extract("li.inner", r'(?s)<span class="reference-text">(.*)</span>', 1)
    rows = rows.select(unit, "at", F.concat(F.col(unit).cast("string"), F.lit("-"), "li.key").alias("key"), note.alias("note"))
    first = rows.withColumn("i", F.row_number().over(Window.partitionBy(unit, "key").orderBy("at"))).where("i = 1")
    return first.select(unit, F.row_number().over(Window.partitionBy(unit).orderBy("at")).alias("n"), "key", "note")


def add_notes(units: DataFrame, notes: DataFrame, unit: str = "unit", text: str = "text") -> DataFrame:
    """``unit, text``: the notes of each unit as definitions below its text, each in one line."""
    line = F.concat(F.lit("[^"), "key", F.lit("]: "), F.trim(F.regexp_replace("note", r"\s*\n\s*", " ")))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", line.alias("line")))), lambda x: x["line"]), "\n")
    joined = units.join(notes.groupBy(unit).agg(listed.alias("_notes")), unit, "left")
    return joined.select(unit, F.concat(text, F.when(F.col("_notes").isNotNull(), F.concat(F.lit("\n"), "_notes", F.lit("\n"))).otherwise("")).alias(text))


def number_notes(units: DataFrame, book: str = "book", unit: str = "unit", text: str = "text") -> DataFrame:
    """``book, unit, text``: note keys as numbers from 1 over all units of a book, by first use; definitions without a use keep their key."""
    marks = units.select(book, unit, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(MARKER), F.lit(1))).alias("at", "key"))
    first = marks.groupBy(book, "key").agg(F.min(F.struct(unit, "at")).alias("first"))
    numbers = first.select(book, "key", F.row_number().over(Window.partitionBy(book).orderBy("first")).alias("number"))
    # a unit's pieces: each marker, and what is between
    pieces = F.regexp_extract_all(F.col(text), F.lit(r"(?s)\[\^[^\]]+\]|\[|[^\[]+"), F.lit(0))
    rows = units.select(book, unit, F.posexplode_outer(pieces).alias("at", "piece"))
    rows = rows.withColumn("key", F.nullif(F.regexp_extract("piece", r"^\[\^([^\]]+)\]$", 1), F.lit("")))
    named = rows.join(numbers, [book, "key"], "left")
    piece = F.when(F.col("number").isNotNull(), F.concat(F.lit("[^"), F.col("number").cast("string"), F.lit("]"))).otherwise(F.col("piece"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", piece.alias("piece")))), lambda x: x["piece"]), "")
    return named.groupBy(book, unit).agg(joined.alias(text))


def note_mismatches(units: DataFrame, unit: str = "unit", text: str = "text") -> DataFrame:
    """``unit, key, problem``: markers that are ``undefined`` and definitions that are ``unreferenced`` in their unit."""
    keys = lambda pattern, name: F.transform(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))), lambda k: F.struct(k.alias("key"), F.lit(name).alias("side")))
    rows = units.select(unit, F.inline(F.concat(keys(MARKER, "undefined"), keys(DEFINITION, "unreferenced"))))
    return rows.groupBy(unit, "key").agg(F.count("*").alias("n"), F.min("side").alias("problem")).where("n = 1").select(unit, "key", "problem")


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n, lines``: paragraphs between blank lines, from 1, as arrays of lines without blanks at their end."""
    parts = F.split(F.regexp_replace(F.col(text), r"(?m)[^\S\n]+$", ""), "\n\n+")
    cut = docs.select(key, F.posexplode(parts).alias("i", "part"))
    return cut.select(key, (F.col("i") + 1).alias("n"), F.filter(F.split("part", "\n"), lambda x: x != "").alias("lines")).where(F.size("lines") > 0)


def is_columnar(lines: Column) -> Column:
    """Whether all lines are indented by four blanks and one has three columns."""
    return F.forall(lines, lambda x: x.rlike(r"^\s{4,}\S")) & F.exists(lines, lambda x: x.rlike(r"^\s*\S+(?: \S+)*\s{2,}\S+(?: \S+)*\s{2,}\S"))


def column_starts(header: Column) -> Column:
    """The places, from 0, of the words of a header line that end in a full stop."""
    pieces = F.regexp_extract_all(header, F.lit(r"\S+|\s+"), F.lit(0))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    step = lambda s, x: F.struct((s["at"] + F.length(x)).alias("at"), F.when(x.rlike(r"^\S+\."), F.concat(s["starts"], F.array(s["at"]))).otherwise(s["starts"]).alias("starts"))
    return F.aggregate(pieces, zero, step, lambda s: s["starts"])


def columnar_tables(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n, kind, text``: paragraphs in order; aligned columns that follow each other become one table.

    Columns begin two places left of the header's words with a full stop, so
    that marks before a cell stay with it; short rows have empty cells.
    """
    order = Window.partitionBy(key).orderBy("n")
    cut = paragraphs(docs, key, text).withColumn("columns", is_columnar(F.col("lines")))
    begins = ~(F.col("columns") & F.coalesce(F.lag("columns").over(order), F.lit(False)))
    grouped = cut.withColumn("block", F.sum(begins.cast("int")).over(order)).groupBy(key, "block").agg(
        F.first("columns").alias("columns"), F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("n", "lines"))), lambda x: x["lines"])).alias("lines")
    )
    made = grouped.withColumn("starts", F.when(F.col("columns"), column_starts(F.get("lines", F.lit(0)))))
    bounds = made.withColumn("from", F.concat(F.array(F.lit(0)), F.transform(F.slice("starts", 2, F.greatest(F.size("starts"), F.lit(1))), lambda x: F.greatest(x - 2, F.lit(0)))))
    bounds = bounds.withColumn("till", F.concat(F.slice("from", 2, F.size("from")), F.array(F.lit(1 << 30))))
    cell = lambda line: lambda a, b: F.trim(F.regexp_replace(F.substring(line, a + 1, F.greatest(b - a, F.lit(0))), r"\s+", " "))
    row = lambda line: F.concat(F.lit("| "), F.array_join(F.zip_with("from", "till", cell(line)), " | "), F.lit(" |"))
    rows = F.transform("lines", row)
    rule = F.concat(F.lit("|"), F.expr("repeat('---|', size(starts))"))
    table = F.array_join(F.concat(F.slice(rows, 1, 1), F.array(rule), F.slice(rows, 2, F.size("lines"))), "\n")
    is_table = F.col("columns") & (F.size("starts") > 0)
    return bounds.select(key, F.col("block").cast("int").alias("n"), F.when(is_table, "table").otherwise("text").alias("kind"), F.when(is_table, table).otherwise(F.array_join("lines", "\n")).alias("text"))


def indent_paragraphs(text: Column, indent: str = "　") -> Column:
    """Paragraphs that begin with an indent character; other lines go on without a blank, headings stand alone, a blank line ends a paragraph."""
    bare = lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")

    def one(x):
        words = bare(x)
        return (
            F.when(words == "", "\n\n")
            .when(words.startswith("#"), F.concat(F.lit("\n\n"), words, F.lit("\n\n")))
            .when(x.startswith(indent), F.concat(F.lit("\n\n"), words))
            .otherwise(words)
        )

    joined = F.array_join(F.transform(F.split(text, "\n"), one), "")
    return F.regexp_replace(F.regexp_replace(joined, r"\n{3,}", "\n\n"), r"^\n+|\n+$", "")


#: What tells a formula drawn in characters: a numbered equation, a fraction bar, a definition of one letter.
DRAWN = r"(?m)^[^\S\n]*\(?[0-9]+\)[^\S\n]*[^.\n]*=|-{5,}|^[^\S\n]*[A-Za-z]'?[^\S\n]+=[^\S\n]+"


def fence_formulas(text: Column, most: int = 12) -> Column:
    """Groups of at most ``most`` lines that draw a formula, between fences, without their common indent."""
    def one(piece):
        # a piece begins with its blank line, the first one perhaps without
        blank = F.regexp_extract(piece, r"^[^\S\n]*(?:\n|$)", 0)
        group = F.substring(piece, F.length(blank) + 1, F.length(piece))
        lines = F.split(group, "\n")
        margin = F.array_min(F.transform(lines, lambda x: F.length(x) - F.length(F.ltrim(x))))
        cut = F.array_join(F.transform(lines, lambda x: F.rtrim(F.substring(x, margin + 1, F.length(x)))), "\n")
        drawn = group.contains("=") & group.rlike(DRAWN) & (F.size(lines) <= most)
        return F.when(drawn, F.concat(blank, F.lit("```\n"), cut, F.lit("\n```"))).otherwise(piece)

    return F.array_join(F.transform(F.split(text, r"\n(?=[^\S\n]*(?:\n|$))"), one), "\n")


def count_violations(found: DataFrame, declared: DataFrame, section: str = "section") -> DataFrame:
    """``section, n, low, high, problem``: sections of ``found(section, n)`` outside what ``declared(section, low, high)`` says.

    ``short`` and ``long`` for their numbers, ``missing`` if a declared section
    is not there, ``undeclared`` if one is there that is not declared.  A bound
    that is null does not bind.
    """
    both = found.select(section, "n").join(declared.select(section, "low", "high"), section, "full_outer")
    there = declared.select(section, F.lit(True).alias("said"))
    both = both.join(there, section, "left")
    problem = (
        F.when(F.col("said").isNull(), "undeclared").when(F.col("n").isNull(), "missing").when(F.col("n") < F.col("low"), "short").when(F.col("n") > F.col("high"), "long")
    )
    return both.select(section, "n", "low", "high", problem.alias("problem")).where("problem is not null")


def sequence_breaks(numbers: DataFrame, key: str = "section", place: str = "place", number: str = "number", first: int = 1) -> DataFrame:
    """``key, place, number, before, problem`` where the numbers of a section, in the order of ``place``, don't rise by one.

    ``gap`` if numbers are left out (at the start too), ``repeat`` of the one
    before, ``reset`` to the first, else ``back``.
    """
    order = Window.partitionBy(key).orderBy(place)
    before = F.lag(number).over(order)
    rows = numbers.select(key, place, F.col(number).alias("number"), before.alias("before"))
    since = F.coalesce(F.col("before"), F.lit(first - 1))
    problem = (
        F.when(F.col("number") > since + 1, "gap")
        .when(F.col("before").isNotNull() & (F.col("number") == F.col("before")), "repeat")
        .when(F.col("before").isNotNull() & (F.col("number") == first), "reset")
        .when(F.col("number") <= since, "back")
    )
    return rows.withColumn("problem", problem).where("problem is not null")


def numbered_stanzas(docs: DataFrame, pattern: str, n_lines: int | None = None, key: str = "doc_id", text: str = "text", rejoin: bool = False) -> DataFrame:
    """``key, stanza, number, stated, text, problems``: stanzas that end with a line that has their number.

    ``pattern`` has two groups, a closing line without its number and the
    number.  Numbers rise by one; one that is out of step while its neighbours
    agree is misread, and the right one stands in ``number``; where the count
    goes on from it, it is a ``jump``, from which on it holds.  Other problems:
    ``lines`` if there are not ``n_lines``, ``unclosed`` of lines behind the
    last number.  Lines get hard breaks; with ``rejoin`` all but the last are
    one line that was wrapped.  Blank lines do not count.
    """
    line_order = Window.partitionBy(key).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    rows = docs.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("i", "line")).where(F.trim("line") != "")
    number = F.when(F.col("line").rlike(pattern), F.regexp_extract("line", pattern, 2).cast("int"))
    words = F.trim(F.when(F.col("line").rlike(pattern), F.regexp_extract("line", pattern, 1)).otherwise(F.col("line")))
    rows = rows.select(key, "i", words.alias("line"), number.alias("number"))
    rows = rows.withColumn("stanza", F.coalesce(F.sum(F.col("number").isNotNull().cast("int")).over(line_order), F.lit(0)).cast("int") + 1)
    lines = F.transform(F.sort_array(F.collect_list(F.struct("i", "line"))), lambda x: x["line"])
    made = rows.groupBy(key, "stanza").agg(lines.alias("lines"), F.max("number").alias("stated"))
    order = Window.partitionBy(key).orderBy("stanza")
    off = F.col("stated") - F.col("stanza")
    made = made.withColumn("lag", F.lag(off).over(order)).withColumn("lead", F.lead(off).over(order))
    misread = F.coalesce((off != F.col("lag")) & (F.col("lag") == F.col("lead")), F.lit(False))
    made = made.withColumn("misread", misread).withColumn("number", F.when(F.col("misread"), F.col("stanza") + F.col("lag")).otherwise(F.col("stated")))
    step = F.col("number") - F.lag("number").over(order)
    jump = F.coalesce(step != 1, (F.col("stanza") == 1) & (F.col("number") != 1))
    problems = [("misread", F.col("misread")), ("jump", jump), ("unclosed", F.col("stated").isNull()), ("lines", F.lit(False) if n_lines is None else F.col("stated").isNotNull() & (F.size("lines") != n_lines))]
    named = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in problems)))
    first = F.slice("lines", F.lit(1), F.greatest(F.size("lines") - 1, F.lit(1)))
    shown = F.when(F.size("lines") > 1, F.concat(F.array_join(first, " "), F.lit("  \n"), F.element_at("lines", -1))).otherwise(F.get("lines", F.lit(0))) if rejoin else F.array_join("lines", "  \n")
    return made.select(key, "stanza", "number", "stated", F.concat(shown, F.when(F.col("number").isNotNull(), F.format_string(" (%d)", "number")).otherwise("")).alias("text"), named.alias("problems"))


def named_class(*marks: str) -> str:
    """A character class of all characters whose Unicode name has one of the marks, as ranges."""
    points = [p for p in range(0x110000) if any(m in unicodedata.name(chr(p), "") for m in marks)]
    out = []
    for p in points:
        if out and out[-1][1] == p - 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in out) + "]"


def _ranges(pattern: str) -> list[tuple[int, int]] | None:
    """The ranges of a class as :func:`named_class` writes it; none of other patterns."""
    if re.fullmatch(r"\[(?:\\x\{[0-9A-F]+\}-\\x\{[0-9A-F]+\})+\]", pattern):
        return [(int(a, 16), int(b, 16)) for a, b in re.findall(r"\\x\{(\w+)\}-\\x\{(\w+)\}", pattern)]
    return None


def _outside(ranges: list[tuple[int, int]], others: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What of sorted ranges is not in the others."""
    for lo, hi in others:
        ranges = [r for a, b in ranges for r in ((a, min(b, lo - 1)), (max(a, hi + 1), b)) if r[0] <= r[1]]
    return ranges


def halved_class(ranges: list[tuple[int, int]], low: int = 0, high: int = 0x10FFFF) -> str:
    """A class of sorted ranges that Java looks up by halves; a plain one is tried range by range at every character."""
    one = lambda a, b: f"\\x{{{a:X}}}-\\x{{{b:X}}}"
    if len(ranges) <= 2:
        return "[" + "".join(one(*r) for r in ranges) + "]"
    # characters of ASCII are told apart at once
    k = sum(b < 0x80 for _, b in ranges) if low == 0 else 0
    k = k or len(ranges) // 2
    cut = max(ranges[k][0], 0x80) if low == 0 and ranges[k - 1][1] < 0x80 else ranges[k][0]
    return f"[[{one(low, cut - 1)}&&{halved_class(ranges[:k], low, cut - 1)}][{one(cut, high)}&&{halved_class(ranges[k:], cut, high)}]]"


def accent_counts(text: Column, polytonic: str, tonos: str) -> Column:
    """``polytonic`` and ``tonos``: characters of the one class, and of the other that are not in the one."""
    first, second = _ranges(polytonic), _ranges(tonos)
    rest = f"(?:(?!{polytonic}){tonos})"
    if first and second:
        left = _outside(second, first)
        polytonic, rest = halved_class(first), halved_class(left) if left else r"(?!)"
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    return F.struct(count(polytonic).alias("polytonic"), count(rest).alias("tonos"))
