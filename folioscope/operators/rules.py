"""Document rules: every text is read once and all rules are column expressions over it.

``checked`` gives each document an array of ``(code, severity, hits)``, a hit
being ``(line, n, detail)``: the line that it begins on (0: the whole document),
how often the rule is broken there, and what breaks it.  ``issues`` has a row
for each hit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import LOCALE_BLOCKS, count_matches, script_count, text_udf
from .lines import after, before, once

# Licence remains, footer headings, tag names, coerced scalars, header keys, admission routes.
DEBRIS = [
    "Public domainPublic domainfalsefalse",
    "rule of the shorter term",
    "longest-living author of this work died in",
    "This work is in the **public domain** in the **United States** because it was published before",
    "This work was published before January 1",
]
FOOTERS = "Footnotes|External links|References|See also|Categories"
TAGS = (
    "p|div|span|table|tr|td|th|tbody|thead|tfoot|a|img|ul|ol|li|section|article|header|footer|nav|aside|figure|"
    "figcaption|strong|em|b|i|u|s|br|hr|caption|colgroup|col|small|big|font|center|sup|sub"
)
ELEMENTS = (
    "a abbr address area article aside audio b base bdi bdo blockquote body br button canvas caption cite code col "
    "colgroup data datalist dd del details dfn dialog div dl dt em embed fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hgroup hr html i iframe img input ins kbd label legend li link main map mark math menu "
    "meta meter nav noscript object ol optgroup option output p param picture pre progress q rp rt ruby s samp script "
    "section select slot small source span strong style sub summary sup table tbody td template textarea tfoot th "
    "thead time title tr track u ul var video wbr center font"
).split()
COERCED = ["y", "yes", "n", "no", "on", "off", "true", "false", "null", "~"]
REQUIRED = ["title", "author", "language", "year", "source", "license"]
ROUTES = ["recovered-text", "sole-witness"]

#: A tag as the Markdown standard has it; the name is the first group.
TAG = (
    r"</?([a-zA-Z][a-zA-Z0-9-]*)"
    r"""(?:\s+[a-zA-Z_:][a-zA-Z0-9_.:-]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'=<>`]+))?)*\s*/?>"""
)
TEMPLATE = r"\{\{[^{}\n$]{1,200}\}\}"
LEFT, RIGHT = r"\\left[\\.(\[{|]", r"\\right[\\.)\]}|]"
BROKEN = r"\\right\\\\left[\\.]"
MATH_TAG = r"<math[^>]*>|</math>"
EMPTY_CENTER = r"<center[^>]*>\s*</center>"
KNOWN_TAG = rf"(?i)<(?:{TAGS})(?:\s[^>]*)?>"
FORMULA = r"\$\$([^$\n]+)\$\$"
TRAILER = r"^\$\$ .* \$\$([.,;:!?]+[ \t]*|[ \t]+\S.*)$"
HEADING = r"(?m)^(#{1,6})\s+\S"
ENVIRONMENT = r"\{([a-z*]+)\}"
#: Ends of lines as they are counted for very long ones.
LINE_END = r"\r\n|[\n\r\x{0B}\x{0C}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"

#: Marks the start of a hit inside a text; no character, so texts lose nothing without it.
MARK = "\uffff"


def _unix(pattern: str) -> str:
    """``^`` and ``$`` at LF only, as all lines here."""
    return pattern.replace("(?m)", "(?md)")


def _nothing() -> Column:
    return F.array().cast("array<struct<line:int,n:bigint,detail:string>>")


def _hit(line, n, detail=None) -> Column:
    line, n = (x if isinstance(x, Column) else F.lit(x) for x in (line, n))
    detail = F.lit(None) if detail is None else detail
    return F.struct(line.cast("int").alias("line"), n.cast("bigint").alias("n"), detail.cast("string").alias("detail"))


def _whole(n: Column, detail=None) -> Column:
    """One hit of the whole document if ``n`` is positive."""
    return F.filter(F.array(_hit(0, n, detail)), lambda h: h["n"] > 0)


def _marked_lines(marked: Column, first: Column | int = 0, keep=None) -> Column:
    """A hit for each line that holds marks; ``keep`` judges what follows a mark in its line."""
    def count(x):
        if keep is None:
            return F.length(x) - F.length(F.replace(x, F.lit(MARK)))
        found = F.split(x, MARK)
        return F.size(F.filter(F.slice(found, 2, F.size(found)), keep))

    found = F.transform(F.split(marked, "\n"), lambda x, i: _hit(i + 1 + first, count(x)))
    return F.filter(found, lambda h: h["n"] > 0)


def hits(text: Column, pattern: str, first: Column | int = 0, keep=None) -> Column:
    """Where ``pattern`` begins, by line."""
    pattern = _unix(pattern)
    marked = F.regexp_replace(F.replace(text, F.lit(MARK)), pattern, MARK + "$0")
    return F.when(text.rlike(pattern), _marked_lines(marked, first, keep)).otherwise(_nothing())


def line_of(text: Column, position: Column) -> Column:
    """The line of a one-based position."""
    before = F.substring(text, F.lit(1), position - 1)
    return F.length(before) - F.length(F.replace(before, F.lit("\n"))) + 1


def has_debris(text: Column) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(d) for d in DEBRIS])


def balanced(formula: Column) -> Column:
    """Whether unescaped braces are as often opened as closed; a double backslash escapes nothing."""
    plain = F.regexp_replace(formula, r"\\[\\{}]", "")
    return F.length(F.replace(plain, F.lit("{"))) == F.length(F.replace(plain, F.lit("}")))


def _first_jump(levels: Column) -> Column:
    """1 if a heading is more than one level below the one before it."""
    return F.exists(F.zip_with(levels, after(levels), lambda x, y: F.coalesce(F.length(y) > F.length(x) + 1, F.lit(False))), lambda x: x).cast("int")


def counted(items: Column) -> Column:
    """Distinct items of an array in order with their numbers: ``array<struct<item, n>>``; sorted once, then runs."""
    ordered = F.array_sort(items)
    new = F.zip_with(ordered, before(ordered), lambda x, y: F.struct(x.alias("item"), (x.isNotNull() & ~x.eqNullSafe(y)).alias("new")))
    first = F.filter(F.transform(new, lambda x, i: F.struct(x["item"].alias("item"), i.alias("at"), x["new"].alias("new"))), lambda x: x["new"])
    ends = F.concat(F.transform(after(first), lambda x: x["at"]), F.array(F.size(ordered)))
    return F.filter(F.zip_with(first, ends, lambda x, e: F.struct(x["item"].alias("item"), (e - x["at"]).alias("n"))), lambda x: x["item"].isNotNull())


def _uneven(begins: Column, ends: Column) -> Column:
    """Names that begin and end unequally often, with the difference."""
    marked = F.concat(F.transform(begins, lambda x: F.struct(x.alias("name"), F.lit(1).alias("way"))), F.transform(ends, lambda x: F.struct(x.alias("name"), F.lit(2).alias("way"))))
    sums = counted(marked)
    name = lambda x: x["item"]["name"]
    paired = F.zip_with(sums, after(sums), lambda x, y: F.struct(name(x).alias("item"), F.when(name(y) == name(x), F.abs(x["n"] - y["n"])).otherwise(x["n"]).alias("n"), F.lit(True).alias("own")))
    own = F.zip_with(paired, before(sums), lambda x, y: F.struct(x["item"].alias("item"), F.when(name(y) == x["item"], 0).otherwise(x["n"]).alias("n")))
    return F.filter(own, lambda x: x["item"].isNotNull() & (x["n"] > 0))


def _each(found: Column) -> Column:
    """A hit of the whole document for each of ``found(item, n)``."""
    return F.transform(found, lambda x: _hit(0, x["n"], x["item"]))


def _script(text: Column, locale: Column, blocks: dict) -> tuple[Column, Column]:
    """Characters of the locale's blocks (null without any), and the code that they call for."""
    n = F.lit(None).cast("long")
    for name, ranges in blocks.items():
        n = F.when(locale == name, script_count(text, ranges)).otherwise(n)
    return n, F.when(n < 50, "S001").when((n < 0.05 * F.greatest(F.length(text), F.lit(1))) & (n < 500), "S002")


def checked(docs: DataFrame, *keep: str, locale: str | None = None, blocks: dict = LOCALE_BLOCKS, codes: tuple[str, ...] | None = None) -> DataFrame:
    """The columns to keep and ``checks``: all rules on the text, or those of ``codes``, with or without hits.

    ``docs`` has ``text`` with or without a header; a null text is empty.
    Rules on formulas need a ``$`` in the body or ``$$`` anywhere; those on
    scripts need the name of the locale's column.
    """
    start = F.locate("\n---\n", F.coalesce("text", F.lit("")), 5)
    headed = F.col("text").startswith("---\n") & (start > 0)
    docs = docs.select(
        *keep,
        F.coalesce("text", F.lit("")).alias("_t"),
        F.when(headed, F.substring("text", start + 5, F.length("text"))).otherwise(F.coalesce("text", F.lit(""))).alias("_b"),
        (F.col(locale) if locale else F.lit(None).cast("string")).alias("_locale"),
    )
    t, b = F.col("_t"), F.col("_b")
    ahead = line_of(t, F.length(t) - F.length(b) + 1) - 1  # lines before the body
    trimmed = F.length(F.regexp_replace(b, r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+$", ""))
    sections = F.split(t, "\n(?=## )")
    footer = lambda s: s.rlike(rf"^##\s+(?:{FOOTERS})[ \t]*(?:\n|$)") & has_debris(s)
    footed = F.array_join(F.transform(sections, lambda s: F.when(footer(s), F.concat(F.lit(MARK), s)).otherwise(s)), "\n")
    debris = F.filter(F.array(*[F.when(t.contains(d), _hit(line_of(t, F.instr(t, d)), 1, F.lit(d))) for d in DEBRIS]), lambda h: h.isNotNull())
    long = F.filter(F.transform(F.split(b, LINE_END), lambda x, i: F.when(F.length(x) > 20_000, _hit(i + 1 + ahead, 1))), lambda h: h.isNotNull())
    n, code = _script(b, F.col("_locale"), blocks)
    tags = F.regexp_extract_all(b, F.lit(KNOWN_TAG), 0)
    tags = F.transform(tags, lambda x: F.substring(x, 1, 40))
    begins, ends = (F.regexp_extract_all(b, F.lit(rf"\\{w}{ENVIRONMENT}"), 1) for w in ("begin", "end"))
    math = lambda found: F.when(b.contains("$") | t.contains("$$"), found).otherwise(_nothing())
    trailing = lambda x: x.rlike("(?sU)" + TRAILER[:-1] + r"\z") & ~F.regexp_extract(x, "(?sU)" + TRAILER[:-1] + r"\z", 1).contains("$$")
    trailers = F.filter(F.transform(F.split(t, "\n"), lambda x, i: _hit(i + 1, trailing(x).cast("int"))), lambda h: h["n"] > 0)
    unbalanced = lambda x: ~balanced(F.regexp_extract(x, "^" + FORMULA, 1))
    unknown = lambda x: ~F.lower(F.regexp_extract(x, r"^</?([a-zA-Z][a-zA-Z0-9-]*)", 1)).isin(ELEMENTS)
    rules = [
        ("W001", "error", debris),
        ("W002", "error", F.when(has_debris(t), _marked_lines(footed)).otherwise(_nothing())),
        ("M004", "error", hits(t, MATH_TAG)),
        ("H001", "warn", hits(t, EMPTY_CENTER)),
        ("B001", "error", _whole((trimmed < 100).cast("int"), trimmed)),
        ("W003", "warn", hits(t, r"(?s)(?=\{\{)(?<![$][$].{0,8})" + TEMPLATE)),
        ("S001", "error", _whole((code == "S001").cast("int"), n)),
        ("S002", "warn", _whole((code == "S002").cast("int"), n)),
        ("U001", "error", _whole(count_matches(t, r"\x{FFFD}"))),
        ("U002", "warn", _whole(count_matches(t, r"[\x{E000}-\x{F8FF}]"))),
        ("H002", "warn", _whole(_first_jump(F.regexp_extract_all(b, F.lit(_unix(HEADING)), 1)))),
        ("C001", "error", _whole(F.size(F.filter(F.split(b, "\n"), lambda x: x.startswith("```"))) % 2)),
        ("X001", "warn", _each(counted(tags))),
        ("X002", "error", hits(b, TAG, keep=unknown)),
        ("L001", "warn", F.when(F.length(b) > 20_000, F.slice(long, 1, 1)).otherwise(_nothing())),
        ("M001", "error", math(_whole(F.abs(count_matches(b, LEFT) - count_matches(b, RIGHT))))),
        ("M002", "error", math(hits(t, BROKEN))),
        ("M003", "warn", math(trailers)),
        ("M005", "error", math(hits(t, FORMULA, keep=unbalanced))),
        ("M006", "error", math(_whole(F.abs(F.size(begins) - F.size(ends))))),
        ("M007", "error", math(_each(_uneven(begins, ends)))),
    ]
    checks = [F.struct(F.lit(c).alias("code"), F.lit(s).alias("severity"), h.alias("hits")) for c, s, h in rules if codes is None or c in codes]
    return docs.select(*keep, once(F.array(*checks)).alias("checks"))


def issues(docs: DataFrame, *keep: str, **options) -> DataFrame:
    """``code, severity, line, n, detail`` of every hit, after the columns to keep."""
    found = checked(docs, *keep, **options).select(*keep, F.inline("checks"))
    return found.select(*keep, "code", "severity", F.inline("hits"))


def environment_rule(docs: DataFrame) -> DataFrame:
    """M007 in detail: ``doc_id, env, n_begin, n_end`` of environments that begin and end unequally often."""
    begins, ends = (F.regexp_extract_all("text", F.lit(rf"\\{w}{ENVIRONMENT}"), 1) for w in ("begin", "end"))
    count = lambda c, x: F.size(F.filter(c, lambda y: y == x)).cast("bigint")
    envs = F.transform(
        F.array_distinct(F.concat("b", "e")), lambda x: F.struct(x.alias("env"), count("b", x).alias("n_begin"), count("e", x).alias("n_end"))
    )
    return docs.select("doc_id", begins.alias("b"), ends.alias("e")).select("doc_id", F.inline(envs)).where("n_begin <> n_end")


def script_rules(docs: DataFrame, blocks: dict = LOCALE_BLOCKS) -> DataFrame:
    """S001 and S002: too few characters, or too small a share, in the locale's blocks."""
    n, code = _script(F.col("text"), F.col("lang"), blocks)
    counted = docs.select("doc_id", n.alias("n"), code.alias("code")).where("code is not null")
    return counted.select("doc_id", "code", F.when(F.col("code") == "S001", "error").otherwise("warn").alias("severity"), "n")


def tag_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """X001 in detail: known tags of each document by their first 40 characters: ``doc_id, tag, n``."""
    tags = F.regexp_extract_all(F.col(text), F.lit(KNOWN_TAG), 0)
    return docs.select("doc_id", F.explode(tags).alias("t")).select("doc_id", F.substring("t", 1, 40).alias("tag")).groupBy("doc_id", "tag").agg(F.count("*").alias("n"))


def unknown_tags(docs: DataFrame, text: str = "text") -> DataFrame:
    """X002 in detail: names in tag shape that are no HTML element: ``doc_id, name, n``."""
    names = F.regexp_extract_all(F.col(text), F.lit(TAG), 1)
    found = docs.select("doc_id", F.explode(names).alias("t")).select("doc_id", F.lower("t").alias("name"))
    return found.where(~F.col("name").isin(ELEMENTS)).groupBy("doc_id", "name").agg(F.count("*").alias("n"))


def encoding_rule(files: DataFrame) -> DataFrame:
    """E001 over ``doc_id, content binary``: files that are not UTF-8."""
    bad = files.where(F.col("content").isNotNull() & ~F.is_valid_utf8(F.col("content").cast("string")))
    return bad.select("doc_id", F.lit("E001").alias("code"), F.lit("error").alias("severity"), F.lit(0).alias("line"))


def header_value(header: Column, key: str) -> Column:
    """The first value of a key, without the quotes around it; null if there is none."""
    pattern = rf"(?md)^{key}:[ \t]*(.*)$"
    value = F.trim(F.regexp_extract(header, pattern, 1))
    bare = F.when((F.length(value) >= 2) & value.rlike(r"""^(["']).*\1$"""), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
    return F.when(header.rlike(pattern), bare)


def _headers(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns to keep, ``opened, closed`` and the ``header`` between the fences (empty without)."""
    raw = F.col("raw")
    end = F.locate("\n---\n", raw, 5)
    opened = F.coalesce(raw.startswith("---\n"), F.lit(False))
    closed = opened & (end > 0)
    return docs.select(*keep, opened.alias("opened"), closed.alias("closed"), F.when(closed, F.substring(raw, F.lit(5), end - 5)).otherwise("").alias("header"))


def header_rules(docs: DataFrame) -> DataFrame:
    """FM001 to FM006 over ``doc_id, raw``: ``doc_id, code, severity, line, n``."""
    h = _headers(docs, "doc_id")
    lines = F.split("header", "\n")
    value = lambda x: F.rtrim(F.regexp_extract(x, r"^[A-Za-z_][A-Za-z0-9_-]*:\s+(\S.*)$", 1))
    plain = lambda x: (value(x) != "") & ~value(x).rlike("^[\"']")
    lined = lambda cond: F.filter(F.transform(lines, lambda x, i: _hit(i + 2, cond(x).cast("int"))), lambda r: r["n"] > 0)
    year = F.trim(F.regexp_extract("header", r"(?md)^year:\s*(.+)$", 1))
    first = lambda n: F.when(n > 0, F.array(_hit(1, n))).otherwise(_nothing())
    missing = reduce(lambda a, b: a + b, [(~F.col("header").rlike(rf"(?md)^{k}:")).cast("int") for k in REQUIRED])
    inside = lambda found: F.when(F.col("closed"), found).otherwise(_nothing())
    codes = [
        ("FM001", "error", first((~F.col("opened")).cast("int"))),
        ("FM002", "error", first((F.col("opened") & ~F.col("closed")).cast("int"))),
        ("FM003", "warn", inside(first(missing))),
        ("FM004", "warn", inside(first(((year != "") & ~year.rlike('^(-*[0-9]+$|")')).cast("int")))),
        ("FM005", "error", inside(lined(lambda x: plain(x) & (value(x).contains(": ") | value(x).endswith(":"))))),
        ("FM006", "error", inside(lined(lambda x: plain(x) & F.lower(value(x)).isin(COERCED)))),
    ]
    checks = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(s).alias("severity"), f.alias("hits")) for c, s, f in codes])
    return h.select("doc_id", once(checks).alias("checks")).select("doc_id", F.inline("checks")).select("doc_id", "code", "severity", F.inline("hits")).drop("detail")


_CODE, _CITED = r"\bISO 15924 ([A-Z][a-z]{3})\b", r"\bsources/([A-Za-z0-9._-]+\.md)\b"


def route_rule(docs: DataFrame, records: DataFrame) -> DataFrame:
    """FM007 over ``doc_id, raw`` and the cited ``records(name, text)``: ``doc_id, code, severity, line, detail``.

    A document that names an admission route must name a known one and state it
    in a one-line note; that of a sole witness also names a script and cites a
    record in which script and language stand in backticks.
    """
    h = _headers(docs, "doc_id").select(
        "doc_id",
        header_value(F.col("header"), "sacred_text").alias("route"),
        header_value(F.col("header"), "source_note").alias("note"),
        F.coalesce(header_value(F.col("header"), "language"), F.lit("")).alias("locale"),
    ).where("route is not null")
    h = h.withColumn("script", F.regexp_extract("note", _CODE, 1)).withColumn("cited", F.regexp_extract("note", _CITED, 1))
    h = h.join(records.select(F.col("name").alias("cited"), F.col("text").alias("record")), "cited", "left")
    known = F.col("route").isin(ROUTES)
    noted = known & F.col("note").isNotNull()
    line = noted & ~F.col("note").rlike(r"^[>|][-+0-9]*\s*(#.*)?$")
    sole = line & (F.col("route") == "sole-witness")
    both = sole & (F.col("script") != "") & (F.col("cited") != "")
    found = both & F.col("record").isNotNull()
    quoted = lambda c: F.instr("record", F.concat(F.lit("`"), F.col(c), F.lit("`"))) > 0
    wrong = {
        "route": ~known,
        "note": known & F.col("note").isNull(),
        "block": noted & ~line,
        "unnamed": line & (F.instr(F.col("note"), F.col("route")) == 0),
        "script": sole & (F.col("script") == ""),
        "citation": sole & (F.col("cited") == ""),
        "record": both & F.col("record").isNull(),
        "record script": found & ~quoted("script"),
        "record locale": found & ((F.col("locale") == "") | ~quoted("locale")),
    }
    details = F.explode(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in wrong.items()])).alias("detail")
    rows = h.select("doc_id", details).where("detail is not null")
    return rows.select("doc_id", F.lit("FM007").alias("code"), F.lit("error").alias("severity"), F.lit(1).alias("line"), "detail")


def sole_witness_rule(docs: DataFrame) -> DataFrame:
    """FM008 over ``path, raw``: documents whose script another sole witness, first by path, has claimed: ``path, script, first_path``."""
    h = _headers(docs, "path")
    note = F.coalesce(header_value(F.col("header"), "source_note"), F.lit(""))
    claims = h.where(header_value(F.col("header"), "sacred_text") == "sole-witness").select("path", F.regexp_extract(note, _CODE, 1).alias("script")).where("script <> ''")
    first = claims.groupBy("script").agg(F.min("path").alias("first_path"))
    return claims.join(first, "script").where("path <> first_path").select("path", "script", "first_path")


def _fix_text():
    """The four mechanical fixes: footer sections with licence remains and what follows them go, a lost brace comes
    back between delimiters, punctuation behind display formulas and empty centered blocks go."""
    import re

    heading = re.compile(rf"^##\s+(?:{FOOTERS})\s*$", re.M)

    def cut(text: str) -> str:
        for m in reversed(list(heading.finditer(text))):
            section = text[m.end() :].split("\n## ", 1)[0]
            if any(d in section for d in DEBRIS):
                return text[: m.start()].rstrip() + "\n"
        return text

    def one(text):
        if text is None:
            return None
        for remains in DEBRIS:
            text = cut(text) if remains in text else text
        text = re.sub(r"\\right\\\\left(?=[\\.])", lambda m: r"\right\}\left", text)
        text = re.sub(r"^(\$\$ .* \$\$)[.,;:!?]+\s*$", r"\1", text, flags=re.M)
        return re.sub(EMPTY_CENTER, "", text)

    return text_udf(one)


fix_text = _fix_text()
