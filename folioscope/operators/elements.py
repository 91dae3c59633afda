"""HTML as a table of tokens: elements by depth, balanced blocks out or in, events and Markdown blocks.

Pages are spread, cut into tokens once, and everything after that is a
window over the tokens of a page: running depth says which closing tag belongs
to which opening one, a running maximum of their places says what lies inside
a chosen element.  No Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .markup import decode_text, html_to_markdown

#: One token: comments, scripts, styles and declarations whole, a tag, a run of text, a lone angle.
TOKEN = (
    r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<[!?][^>]*>"
    r"|</?[a-z](?:[^<>\"']+|\"[^\"]*\"|'[^']*')*>|[^<]+|<"
)
#: Elements that never have content.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
#: Tags that begin and end blocks.
HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
#: Lines that Markdown would take for the start of a block.
UNSAFE_START = r"^(?:#|>|[-+*] |[0-9]+[.)] |=|```)"

#: Bytes of pages whose tokens one task holds.
TASK_BYTES = 4 << 20

Chosen = Callable[[Column, Column], Column]


def attribute(token: Column, name: str) -> Column:
    """Value of an attribute of a tag, empty if there is none."""
    pattern = rf"(?is)^<[^\s>]+(?:\s.*?)?\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"
    return F.concat(F.regexp_extract(token, pattern, 1), F.regexp_extract(token, pattern, 2))


def has_class(token: Column, name: str) -> Column:
    """Whether a tag has a class, alone or among others."""
    return F.concat(F.lit(" "), F.regexp_replace(attribute(token, "class"), r"\s+", " "), F.lit(" ")).contains(f" {name} ")


def tokens(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key, pos, token, kind, tag``: kind is text, open, close, void or raw (comments, scripts, styles, declarations).

    Pages are spread before they are cut, so many to a task as make up
    ``TASK_BYTES``: every window over the tokens sorts what its task holds.
    """
    size = pages.agg(F.sum(F.octet_length(html))).first()[0] or 0
    spread = pages.select(key, html).repartition(-(-size // TASK_BYTES) or 1, key)
    cut = spread.select(F.col(key), F.posexplode(F.regexp_extract_all(F.col(html), F.lit(TOKEN), F.lit(0))).alias("pos", "token"))
    tag = F.lower(F.regexp_extract("token", r"^</?([A-Za-z][A-Za-z0-9:-]*)", 1))
    raw = F.col("token").rlike(r"(?is)^<(?:[!?]|script\b|style\b)")
    kind = (
        F.when(raw, "raw")
        .when(tag == "", "text")
        .when(F.col("token").startswith("</"), "close")
        .when(tag.isin(VOID) | F.col("token").endswith("/>"), "void")
        .otherwise("open")
    )
    return cut.select(key, "pos", "token", kind.alias("kind"), F.when(~raw & (tag != ""), tag).alias("tag"))


def elements(cut: DataFrame, key: str = "page_id") -> DataFrame:
    """The tokens with ``end``, the place of the closing tag of each opening one, and ``closed``.

    Depth is counted for each tag by itself, so that others left open inside do
    no harm; closing tags without an opening one have no effect.  An element
    that is never closed ends at the last closing tag of its kind behind it,
    or, if there is none, with its opening tag.
    """
    own = Window.partitionBy(key, "tag").orderBy("pos")
    step = F.when(F.col("kind") == "open", 1).when(F.col("kind") == "close", -1).otherwise(0)
    counted = cut.withColumn("sum", F.sum(step).over(own)).withColumn("low", F.least(F.min("sum").over(own), F.lit(0)))
    counted = counted.withColumn("stray", (F.col("kind") == "close") & (F.col("low") < F.coalesce(F.lag("low").over(own), F.lit(0))))
    depth = F.col("sum") - F.col("low")
    level = F.when(F.col("kind") == "open", depth).when((F.col("kind") == "close") & ~F.col("stray"), depth + 1)
    paired = Window.partitionBy(key, "tag", "level").orderBy("pos")
    last = F.max(F.when((F.col("kind") == "close") & ~F.col("stray"), F.col("pos"))).over(Window.partitionBy(key, "tag"))
    match = F.when(F.col("kind") == "open", F.lead("pos").over(paired))
    # two opening tags never follow each other on a level, unless the first is left open
    match = F.when(F.lead("kind").over(paired) == "close", match)
    out = counted.withColumn("level", level).withColumn("match", match).withColumn("last", last)
    end = F.when(F.col("kind") == "open", F.coalesce("match", F.when(F.col("last") > F.col("pos"), F.col("last")), "pos"))
    return out.select(key, "pos", "token", "kind", "tag", end.alias("end"), F.col("match").isNotNull().alias("closed"))


def inside(chosen: Column, key: str = "page_id") -> Column:
    """Whether a token lies in one of the chosen elements, tags included."""
    return F.coalesce(reach(chosen, key) >= F.col("pos"), F.lit(False))


def reach(chosen: Column, key: str = "page_id") -> Column:
    """The farthest end of the chosen elements opened so far."""
    before = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return F.max(F.when((F.col("kind") == "open") & chosen, F.col("end"))).over(before)


def _together(rows: DataFrame, *keys: str) -> DataFrame:
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]), "")
    return rows.groupBy(*keys).agg(text.alias("html"))


def strip_elements(pages: DataFrame, chosen: Chosen, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key, html`` without the elements for which ``chosen(tag, token)`` holds, and all that they nest.

    Comments, scripts, styles and declarations count as tokens of no tag.  A
    page that is null stays null, one of which nothing is left is empty; the
    key must be unique.
    """
    marked = elements(tokens(pages, key, html), key).withColumn("gone", inside(chosen(F.col("tag"), F.col("token")), key))
    # a text beside its tokens: pages without any have their row too
    left = _together(marked.where("not gone"), key)
    own = pages.select(key, F.col(html).isNull().alias("none"))
    return own.join(left, key, "left").select(key, F.when(~F.col("none"), F.coalesce("html", F.lit(""))).alias("html"))


def extract_elements(pages: DataFrame, chosen: Chosen, key: str = "page_id", html: str = "html", inner: bool = False) -> DataFrame:
    """``key, n, html``: the outermost chosen elements of each page, numbered from 1, with or without their own tags."""
    marked = elements(tokens(pages, key, html), key).withColumn("till", reach(chosen(F.col("tag"), F.col("token")), key))
    order = Window.partitionBy(key).orderBy("pos")
    begins = (F.col("kind") == "open") & F.col("till").isNotNull() & (F.coalesce(F.lag("till").over(order), F.lit(-1)) < F.col("pos"))
    held = marked.withColumn("begins", begins).withColumn("n", F.sum(F.col("begins").cast("int")).over(order)).where(F.col("till") >= F.col("pos"))
    if inner:
        held = held.withColumn("token", F.when(~F.col("begins") & ~((F.col("pos") == F.col("till")) & (F.col("kind") == "close")), F.col("token")).otherwise(""))
    return _together(held, key, "n").select(key, F.col("n").cast("int").alias("n"), "html")


def chrome(tag: Column, token: Column) -> Column:
    """Elements of a rendered wiki page that are no text: page numbers, hidden spans, notes, tables, header and licence boxes, navigation."""
    style = F.regexp_replace(attribute(token, "style"), r"\s+", "")
    some = lambda *names: F.exists(F.array(*map(F.lit, names)), lambda n: F.concat(F.lit(" "), attribute(token, "class"), F.lit(" ")).contains(F.concat(F.lit(" "), n)))
    return (
        tag.isin("table", "nav", "head")
        | (tag == "span") & (some("pagenum", "ws-noexport") | style.contains("display:none"))
        | (tag == "ul") & (attribute(token, "id") == "plainSister")
        | (tag == "sup") & has_class(token, "reference")
        | (tag == "div") & ((attribute(token, "id") == "headerContainer") | some("licenseContainer", "licensetpl", "mw-references-wrap") | has_class(token, "references"))
    )


def strip_chrome(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Pages without :func:`chrome`, and without comments, scripts, styles and declarations."""
    return strip_elements(_plain(pages, key, html), chrome, key)


def _plain(pages: DataFrame, key: str, html: str) -> DataFrame:
    raw = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<link\b[^>]*>"
    return pages.select(key, F.regexp_replace(F.col(html), raw, "").alias("html"))


def pages_to_markdown(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key, markdown``: pages without their chrome as Markdown."""
    return strip_chrome(pages, key, html).select(key, html_to_markdown(F.col("html")).alias("markdown"))


def events(pages: DataFrame, key: str = "page_id", html: str = "html", content: Chosen | None = None, skip: Chosen | None = None) -> DataFrame:
    """``key, n, kind, payload, ref``: what a page holds, in order.

    Kinds are ``line``, ``stanza`` and ``pagebreak`` of poems (``div.poem``),
    ``center``, ``heading`` (with its marks), ``item``, ``prose``, of tables
    ``divider`` (with a picture), ``dots`` or ``prose``, and ``ref``, a note of
    a reference list with its number in ``ref``.  Emphasis stands as Markdown,
    note marks as ``[number]``, white space is squeezed; character references
    are decoded.  Hidden parts, page numbers and what ``skip`` names are left
    out; with ``content`` only those elements and the notes are read.
    A paragraph ends at its closing tag or where the next block begins, an item
    with its list at the latest, so tags that are left open do no harm.  A page
    that is null or holds no text has no events.
    """
    t = elements(tokens(pages, key, html), key)
    tag, token, opens, closes = F.col("tag"), F.col("token"), F.col("kind") == "open", F.col("kind") == "close"
    order = Window.partitionBy(key).orderBy("pos")
    style = F.regexp_replace(attribute(token, "style"), r"\s+", "")
    hidden = has_class(token, "ws-noexport") | has_class(token, "pagenum") | style.rlike("visibility:hidden|display:none|color:transparent") | (tag == "head")
    if skip:
        hidden = hidden | skip(tag, token)
    poem = (tag == "div") & has_class(token, "poem")
    centre = (tag == "div") & (has_class(token, "tiInherit") | style.contains("text-align:center"))
    spans = {
        "gone": hidden, "table": tag == "table", "poem": poem, "centre": centre, "list": (tag == "ol") & has_class(token, "references"),
        "mark": (tag == "sup") & has_class(token, "reference"), "read": content(tag, token) if content else F.lit(False),
    }
    for name, chosen in spans.items():
        t = t.withColumn(f"{name}_end", reach(chosen, key))
    within = lambda name: F.coalesce(F.col(f"{name}_end") >= F.col("pos"), F.lit(False))
    t = t.select("*", *(within(name).alias(name) for name in spans))
    t = t.where(~F.col("gone") & (F.col("kind") != "raw"))
    if content:
        t = t.where(F.col("read") | F.col("list"))
    outer = lambda name: opens & F.col(name) & (F.coalesce(F.lag(f"{name}_end").over(order), F.lit(-1)) < F.col("pos"))
    # a table or a centred block is one, whatever it nests
    t = t.withColumn("one", F.col("table") | F.col("centre") & ~F.col("poem"))
    t = t.withColumn("first", outer("table") & F.coalesce(~F.lag("one").over(order) | F.lag("table").over(order), F.lit(True)) | outer("centre") & F.col("one") & ~F.col("table"))
    content_edge = content(tag, token) if content else F.lit(False)
    blocks = tag.isin("p", "li", "ul", "ol", "table", *HEADINGS) | (tag == "br") & F.col("poem") | (tag == "div") & (poem | centre | content_edge)
    edge = blocks & ~(closes & (tag == "div")) | closes & (F.col("pos") == F.col("poem_end"))
    starts = F.when(F.col("one"), F.col("first")).otherwise(edge | F.coalesce(F.lag("one").over(order), F.lit(False)))
    t = t.withColumn("part", F.sum(starts.cast("int")).over(order))

    text = decode_text(token)
    piece = (
        F.when((F.col("kind") == "text") & F.col("mark"), F.regexp_replace(text, r"[^0-9]", ""))
        .when(F.col("kind") == "text", text)
        .when(tag.isin("i", "em") & (opens | closes), "*")
        .when(tag.isin("b", "strong") & (opens | closes), "**")
        .when((tag == "br") & ~F.col("poem"), "\n")
        .when((tag == "sup") & F.col("mark") & opens, "[")
        .when((tag == "sup") & F.col("mark") & closes, "]")
    )
    item = F.coalesce(F.last(F.when(tag.isin("li", "ul", "ol"), opens & (tag == "li")), ignorenulls=True).over(order), F.lit(False))
    head = F.last(F.when(tag.isin(HEADINGS), F.when(opens, F.substring(tag, 2, 1).cast("int")).otherwise(0)), ignorenulls=True).over(order)
    t = t.select(
        key, "pos", "part", "kind", piece.alias("piece"), *(F.col(c) for c in ("table", "poem", "centre", "list")), item.alias("item"), head.alias("head"),
        (tag == "img").alias("img"), F.when(opens & (tag == "li") & F.col("list"), attribute(token, "id")).alias("ref_id"),
        F.when(closes & (tag == "p") & F.col("poem"), "stanza").when(closes & (F.col("pos") == F.col("poem_end")), "pagebreak").alias("sign"),
    )
    filled = F.col("piece").isNotNull()
    first = lambda c: F.min_by(c, F.when(filled, F.col("pos")))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(filled, F.struct("pos", "piece")))), lambda x: x["piece"]), "")
    squeezed = F.regexp_replace(F.regexp_replace(joined, r"[ \t\x{A0}]+", " "), r"^\s+|\s+$", "")
    parts = t.groupBy(key, "part").agg(
        F.min("pos").alias("pos"), squeezed.alias("payload"), *(F.coalesce(first(F.col(c)), F.lit(False)).alias(c) for c in ("poem", "centre", "list", "item")), F.bool_or("table").alias("table"),
        F.coalesce(first(F.col("head")), F.lit(0)).alias("head"), F.coalesce(F.bool_or("img"), F.lit(False)).alias("img"), F.max("ref_id").alias("ref_id"),
    )
    kind = (
        F.when(F.col("list"), "ref").when(F.col("table") & F.col("img"), "divider").when(F.col("table") & F.col("payload").rlike(r"^[\s.·•…]+$"), "dots")
        .when(F.col("table"), "prose").when(F.col("poem"), "line").when(F.col("centre"), "center").when(F.col("head") > 0, "heading").when(F.col("item"), "item").otherwise("prose")
    )
    payload = F.when(F.col("head") > 0, F.concat(F.expr("repeat('#', head)"), F.lit(" "), F.regexp_replace("payload", r"\s+", " "))).when(F.col("list"), F.regexp_replace("payload", "^[↑ ]+", "")).otherwise(F.col("payload"))
    number = F.coalesce(F.nullif(F.regexp_replace("ref_id", r"[^0-9]", ""), F.lit("")), "ref_id")
    shown = parts.where((F.col("payload") != "") | F.col("table") & F.col("img")).select(
        key, F.col("pos").cast("double").alias("pos"), kind.alias("kind"), F.when(kind != "divider", F.when(kind.isin("heading", "ref"), payload).otherwise(F.col("payload"))).alias("payload"),
        F.when(F.col("list"), number).alias("ref"),
    )
    # a closing tag begins a part, and its sign comes before the text behind it
    signs = t.where("sign is not null").select(key, (F.col("pos") - 0.5).alias("pos"), F.col("sign").alias("kind"), F.lit(None).cast("string").alias("payload"), F.lit(None).cast("string").alias("ref"))
    return shown.unionByName(signs).select(key, F.row_number().over(order).alias("n"), "kind", "payload", "ref")


def event_blocks(found: DataFrame, key: str = "page_id") -> DataFrame:
    """``key, n, kind, text``: events as Markdown blocks.

    Lines and dots run on until a stanza ends, page breaks aside, and get hard
    breaks; a first line that Markdown would take for a block is escaped.  A
    centred Roman number is a heading, an item gets its mark, a note its
    number; blocks of emphasis marks alone are left out, ``* * *`` is not.
    """
    order = Window.partitionBy(key).orderBy("n")
    # the last stanza of a page goes on behind its break
    kept = found.withColumn("next", F.lead("kind").over(order)).where((F.col("kind") != "pagebreak") & ~((F.col("kind") == "stanza") & (F.coalesce("next", F.lit("")) == "pagebreak")))
    verse = F.col("kind").isin("line", "dots")
    begins = ~(verse & F.coalesce(F.lag(verse).over(order), F.lit(False)))
    numbered = kept.withColumn("block", F.sum(begins.cast("int")).over(order)).where(~F.col("kind").isin("stanza", "divider"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("n", "payload"))), lambda x: x["payload"])
    made = numbered.groupBy(key, "block").agg(F.min_by("kind", "n").alias("kind"), lines.alias("lines"), F.first("ref").alias("ref"))
    first = F.get("lines", F.lit(0))
    roman = F.regexp_extract(first, r"^\*\*([IVXІ]+)\.?\*\*$", 1)
    text = (
        F.when(F.col("kind").isin("line", "dots"), F.concat(F.when(first.rlike(UNSAFE_START), "\\").otherwise(""), F.array_join("lines", "  \n")))
        .when((F.col("kind") == "center") & (roman != ""), F.concat(F.lit("## "), roman, F.lit(".")))
        .when(F.col("kind") == "item", F.concat(F.lit("- "), first))
        .when(F.col("kind") == "ref", F.concat(F.lit("["), F.coalesce("ref", F.lit("")), F.lit("] "), first))
        .otherwise(first)
    )
    kind = F.when(F.col("kind").isin("line", "dots"), "verse").when((F.col("kind") == "center") & (roman != ""), "heading").otherwise(F.col("kind"))
    out = made.select(key, "block", kind.alias("kind"), text.alias("text")).where((F.col("text") == "* * *") | ~F.col("text").rlike(r"^[*\s]+$"))
    return out.select(key, F.row_number().over(Window.partitionBy(key).orderBy("block")).alias("n"), "kind", "text")
