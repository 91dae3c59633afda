"""Elements by depth, events and blocks against html.parser and stated results."""

import random
import re
from html.parser import HTMLParser

from conftest import SF
from pyspark.sql import functions as F

from folioscope.operators import elements as E
from folioscope.operators.markup import html_to_markdown, numeric_entities

PAGE = (
    '<!DOCTYPE html><html><head><title>x</title></head><body><div class="prp-pages-output"><h2>The <i>Title</i></h2><div class="poem"><p>line one<br>line <b>two<br/>#three</p><p>next stanza<br>end of page</p></div>'
    '<span class="pagenum ws-pagenum" id="p2"><span>12</span></span>\n<div class="poem"><p>goes on &#1078;&#x436; &amp;#65;</p></div><div style="text-align: center"><p><b>IV.</b></p></div>'
    '<p>Some prose<sup class="reference">[<a href="#n">3</a>]</sup> here<p>second without end<table><tr><td>. . . .</td></tr></table><table><img src="x"></table>'
    "<table><tr><td>cell <table><tr><td>inner</td></tr></table> z</td></tr></table>\nloose text <ul><li>one<li>two</ul><p><b> </b></p><p>* * *</p></div>"
    '<ol class="references"><li id="cite_note-3">↑ the note <i>text</i></li></ol><script>var a="<p>no</p>";</script></body></html>'
)


def test_events_and_blocks(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "</p>stray<b>open")], "page_id long, html string")
    found = E.events(pages, content=lambda tag, token: (tag == "div") & E.has_class(token, "prp-pages-output"))
    got = [(r.kind, r.payload, r.ref) for r in found.orderBy("page_id", "n").collect()]
    assert got == [
        ("heading", "## The *Title*", None), ("line", "line one", None), ("line", "line **two", None), ("line", "#three", None), ("stanza", None, None), ("line", "next stanza", None),
        ("line", "end of page", None), ("stanza", None, None), ("pagebreak", None, None), ("line", "goes on жж &#65;", None), ("stanza", None, None), ("pagebreak", None, None),
        ("center", "**IV.**", None), ("prose", "Some prose[3] here", None), ("prose", "second without end", None), ("dots", ". . . .", None), ("divider", None, None), ("prose", "cell inner z", None),
        ("prose", "loose text", None), ("item", "one", None), ("item", "two", None), ("prose", "** **", None), ("prose", "* * *", None), ("ref", "the note *text*", "3"),
    ]
    assert [(r.n, r.kind, r.text) for r in E.event_blocks(found).orderBy("n").collect()] == [
        (1, "heading", "## The *Title*"), (2, "verse", "line one  \nline **two  \n#three"), (3, "verse", "next stanza  \nend of page  \ngoes on жж &#65;"), (4, "heading", "## IV."),
        (5, "prose", "Some prose[3] here"), (6, "prose", "second without end"), (7, "verse", ". . . ."), (8, "prose", "cell inner z"), (9, "prose", "loose text"),
        (10, "item", "- one"), (11, "item", "- two"), (12, "prose", "* * *"), (13, "ref", "[3] the note *text*"),
    ]
    assert [(r.page_id, r.payload) for r in E.events(pages.where("page_id > 1")).collect()] == [(4, "stray**open")]
    plan = E.event_blocks(found)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    verse = spark.createDataFrame([(1, 1, "line", "- dash", None), (1, 2, "line", "b", None)], "page_id int, n int, kind string, payload string, ref string")
    assert E.event_blocks(verse).first().text == "\\- dash  \nb"


class Walker(HTMLParser):
    """Headings, items and paragraphs of articles, with emphasis and breaks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.on, self.kind, self.found, self.buf = 0, "prose", [], []

    def cut(self, kind):
        text = re.sub(r"[ \t ]+", " ", "".join(self.buf)).strip()
        if text:
            self.found.append((self.kind, text))
        self.buf, self.kind = [], kind

    def handle_starttag(self, tag, attrs):
        self.on += tag == "article"
        if tag in ("p", "ul", "li", "h1"):
            self.cut({"li": "item", "h1": "heading"}.get(tag, "prose"))
        self.mark(tag)

    def mark(self, tag):
        if self.on and tag in ("b", "br"):
            self.buf.append("**" if tag == "b" else "\n")

    def handle_endtag(self, tag):
        if tag == "article":
            self.cut("prose")
            self.on -= 1
        if tag in ("p", "ul", "li", "h1"):
            self.cut("prose")
        if tag == "b":
            self.mark(tag)

    def handle_data(self, data):
        if self.on:
            self.buf.append(data)


def test_events_of_pages_against_a_parser(spark):
    # html.parser also reads names without a semicolon
    pages = spark.read.parquet(f"{SF}/pages.parquet").where(~F.col("html").rlike("&[a-z#0-9]*([^a-z#0-9;]|$)"))
    got = {}
    for r in E.events(pages, content=lambda tag, token: tag == "article").orderBy("page_id", "n").collect():
        got.setdefault(r.page_id, []).append((r.kind, r.payload.lstrip("# ") if r.kind == "heading" else r.payload))
    rows = pages.collect()
    assert len(rows) > 100
    for r in rows:
        w = Walker()
        w.feed(r.html)
        assert got[r.page_id] == [(k, t) for k, t in w.found]


def strip_by_hand(html, wanted):
    """Outermost wanted elements out; depth is counted for each tag by itself."""
    parts = re.findall(E.TOKEN, html)
    ends, stacks, last = {}, {}, {}
    for i, t in enumerate(parts):
        if m := re.match(r"</?([a-z]+)", t):
            stack = stacks.setdefault(m[1], [])
            if not t.startswith("</"):
                stack.append(i)
            elif stack:
                ends[stack.pop()], last[m[1]] = i, i
    for tag, stack in stacks.items():
        for i in stack:
            ends[i] = max(i, last.get(tag, i))
    out, till = [], -1
    for i, t in enumerate(parts):
        if i in ends and wanted(t):
            till = max(till, ends[i])
        if i > till:
            out.append(t)
    return "".join(out)


def test_balanced_elements_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        tags = ["<div>", '<div class="x y">', "</div>", "<span style='display: none'>", "</span>", "<table>", "</table>", "a", "b ", "<!-- <div> -->", "<b>", '<div title="a>b" class="x">', "</p>"]
        rows.append((i, "".join(rng.choices(tags, k=rng.randrange(0, 25)))))
    rows += [(300, None), (301, "<div class='x'>" * 400 + "deep" + "</div>" * 400 + "end"), (302, "a < b & <c"), (303, "<div class=\"x\">no end")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    x = lambda t: t.startswith("<div") and bool(re.search(r"class=[\"'](x|x y)[\"']", t))
    got = {r.page_id: r.html for r in E.strip_elements(pages, lambda tag, token: (tag == "div") & E.has_class(token, "x")).collect()}
    assert got == {i: None if h is None else strip_by_hand(h, x) for i, h in rows}
    assert got[301] == "end" and got[303] == "no end"
    parts = E.extract_elements(pages.where("page_id = 301"), lambda tag, token: tag == "div", inner=True).collect()
    assert [(r.n, r.html) for r in parts] == [(1, "<div class='x'>" * 399 + "deep" + "</div>" * 399)]
    nested = spark.createDataFrame([(1, "a<div>b<div>c</div></div>d<div>e</div><div>f")], "page_id long, html string")
    assert [r.html for r in E.extract_elements(nested, lambda tag, token: tag == "div").orderBy("n").collect()] == ["<div>b<div>c</div></div>", "<div>e</div>", "<div>"]


def test_chrome(spark):
    html = (
        '<div id="headerContainer">h<div>in</div></div><span class="pagenum ws-pagenum"><span>1</span></span>text<span style="color: red; display: none">typo</span>'
        '<ul id="plainSister"><li>s</li></ul><sup class="reference"><a>1</a></sup><table><tr><td><table></table>t</td></tr></table><div class="licenseContainer big">l</div>'
        '<div class="licensetpl">l</div><div class="mw-references-wrap mw-x"><ol><li>r</li></ol></div><div class="mw-heading"><h2>Kept</h2></div><link rel="x"/><!-- c --><style>p{}</style><span>seen &#8364;&#xD800;&amp;#66;</span>'
    )
    page = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert E.strip_chrome(page).first().html == 'text<div class="mw-heading"><h2>Kept</h2></div><span>seen &#8364;&#xD800;&amp;#66;</span>'
    assert E.pages_to_markdown(page).first().markdown == "text\n\n## Kept\n\nseen €&#xD800;&#66;"
    own = spark.createDataFrame([("&#60;b&#62; &#x1F600; &#0; &#1114112; &#x110000; & &#65",), (None,), ("plain",)], "t string")
    assert [r[0] for r in own.select(numeric_entities(F.col("t"))).collect()] == ["<b> 😀 &#0; &#1114112; &#x110000; & &#65", None, "plain"]
    assert [r[0] for r in own.select(html_to_markdown(F.col("t"))).collect()][0].startswith("<b> 😀")


def test_pages_are_spread_by_their_bytes(spark, monkeypatch):
    """No task holds the tokens of more pages than make up its share."""
    from folioscope.operators import elements as E

    monkeypatch.setattr(E, "TASK_BYTES", 1000)
    pages = spark.createDataFrame([(i, f"<article><p>{i} {'x' * 90}</p></article>") for i in range(100)], "page_id long, html string")
    found = E.events(pages, content=lambda tag, token: tag == "article")
    assert found.rdd.getNumPartitions() >= 11
    assert [(r.page_id, r.n, r.payload.split()[0]) for r in found.orderBy("page_id").collect()] == [(i, 1, str(i)) for i in range(100)]
