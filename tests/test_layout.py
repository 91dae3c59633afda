"""Footnotes, columns, indents, drawn formulas, declared counts and sequences against stated results and plain Python."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from folioscope.operators import layout as L


def ref(key, sign="1"):
    return f'<sup id="cite_ref-{key}_1-0" class="reference"><a href="#cite_note-{key}">[{sign}]</a></sup>'


def test_footnotes(spark):
    pages = [
        (1, f"a{ref('n-1')} b*{ref('x')} c<sup>*{ref('n-1', '2')}</sup> <ol class=\"references\"><li id=\"cite_note-n-1\"><span class=\"reference-text\">first\n note</span></li>"
            '<li id="cite&#95;note-x"><span class="reference-text">second <i>x</i></span></li><li id="cite_note-x"><span class="reference-text">again</span></li></ol>end'),
        (2, f'<div class="reflist"></div>kept text{ref("u")}<hr /><div class="reflist" style="x"> <ol class="references"><li id="cite_note-v"><span class="reference-text">never used</span></li></ol></div>'),
        (3, "no notes"), (4, None),
    ]
    units = spark.createDataFrame(pages, "unit int, html string")
    lifted = L.lift_notes(units)
    assert {r.unit: r.html for r in lifted.collect()} == {1: "a[^1-n-1] b[^1-x] c[^1-n-1] end", 2: "kept text[^2-u]", 3: "no notes", 4: None}
    notes = L.note_definitions(units)
    assert sorted(map(tuple, notes.collect())) == [(1, 1, "1-n-1", "first\n note"), (1, 2, "1-x", "second <i>x</i>"), (2, 1, "2-v", "never used")]
    whole = L.add_notes(lifted.withColumnRenamed("html", "text"), notes)
    texts = {r.unit: r.text for r in whole.collect()}
    assert texts[1] == "a[^1-n-1] b[^1-x] c[^1-n-1] end\n[^1-n-1]: first note\n[^1-x]: second <i>x</i>\n" and texts[3] == "no notes"
    assert {tuple(r) for r in L.note_mismatches(whole).collect()} == {(2, "2-u", "undefined"), (2, "2-v", "unreferenced")}
    books = whole.withColumn("book", F.lit("b"))
    numbered = {r.unit: r.text for r in L.number_notes(books).collect()}
    assert numbered[1] == "a[^1] b[^2] c[^1] end\n[^1]: first note\n[^2]: second <i>x</i>\n"
    assert numbered[2] == "kept text[^3]\n[^2-v]: never used\n" and numbered[3] == "no notes"


def test_columnar_tables(spark):
    text = (
        "Text before\nin two lines\n\n    Kane.     Wahine.    Keiki.\n    Kumu      Lalo       Opu  u\n      }       Wela\n\n    Ao       {Po          La\n\n"
        "    deep verse\n    without columns\n\nlast"
    )
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id int, text string")
    got = [(r.doc_id, r.n, r.kind, r.text) for r in L.columnar_tables(docs).orderBy("doc_id", "n").collect()]
    header = "    Kane.     Wahine.    Keiki."
    starts = [m.start() for m in re.finditer(r"\S+\.", header)]

    def cells(line):
        bounds, pos, out = [s - 2 for s in starts[1:]] + [len(line) + 200], 0, []
        for b in bounds:
            out.append(re.sub(r"\s+", " ", line[pos:b]).strip())
            pos = b
        return "| " + " | ".join(out) + " |"

    lines = [header, "    Kumu      Lalo       Opu  u", "      }       Wela", "    Ao       {Po          La"]
    table = "\n".join([cells(lines[0]), "|---|---|---|", *map(cells, lines[1:])])
    assert got == [(1, 1, "text", "Text before\nin two lines"), (1, 2, "table", table), (1, 3, "text", "    deep verse\n    without columns"), (1, 4, "text", "last")]


def indent_by_hand(text):
    out, held = [], []

    def flush():
        if "".join(held).strip():
            out.append("".join(held).strip())
        held.clear()

    for line in (x.rstrip() for x in text.split("\n")):
        if not line.strip():
            flush()
        elif line.lstrip().startswith("#"):
            flush()
            out.append(line.strip())
        else:
            if line.startswith("　"):
                flush()
            held.append(line.strip())
    flush()
    return "\n\n".join(out)


def fence_by_hand(text):
    lines, out, group = text.split("\n"), [], []

    def drawn(g):
        return "=" in "\n".join(g) and len(g) <= 12 and any(re.match(r"^\s*\(?\d+\)\s*[^.]*=", x) or re.search(r"-{5,}", x) or re.match(r"^\s*[A-Za-z]'?\s+=\s+", x) for x in g)

    for x in [*lines, None]:
        if x is not None and x.strip():
            group.append(x)
            continue
        if group and drawn(group):
            margin = min(len(g) - len(g.lstrip(" ")) for g in group)
            out += ["```", *(g[margin:].rstrip(" ") for g in group), "```"]
        else:
            out += group
        group = []
        if x is not None:
            out.append(x)
    return "\n".join(out)


def test_indents_and_formulas(spark):
    rng = random.Random(6)
    parts = ["　一つ目の段", "続き", "", "  ", "　　深い", "# 見出し", " # too", "end　", "x", "　"]
    texts = ["\n".join(rng.choices(parts, k=rng.randrange(0, 14))) for _ in range(200)]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(L.indent_paragraphs(F.col("t"))).collect()]
    assert got == [indent_by_hand(t) for t in texts]
    parts = ["    a = b  ", "      -----", "  (3) x + y = z", "prose here", "with = sign", "", " ", "   1) no. = x", "A' = 2", "\ttab = x"]
    texts = ["\n".join(rng.choices(parts, k=rng.randrange(0, 16))) for _ in range(300)] + ["\n".join(["a = b"] * 12), "\n".join(["a = b"] * 13)]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(L.fence_formulas(F.col("t"))).collect()]
    assert got == [fence_by_hand(t) for t in texts]


def test_counts_and_sequences(spark):
    found = spark.createDataFrame([("I", 10), ("II", 9), ("III", 17), ("V", 1)], "section string, n int")
    declared = spark.createDataFrame([("I", 10, 10), ("II", 10, 16), ("III", 10, 16), ("IV", 1, None)], "section string, low int, high int")
    assert {(r.section, r.problem) for r in L.count_violations(found, declared).collect()} == {("II", "short"), ("III", "long"), ("IV", "missing"), ("V", "undeclared")}
    numbers = [("a", i, n) for i, n in enumerate([1, 2, 4, 4, 5, 1, 2, 1, 3, 2])] + [("b", 0, 2), ("b", 1, 3), ("c", 0, 1), ("d", 0, 0)]
    rows = L.sequence_breaks(spark.createDataFrame(numbers, "section string, place int, number int")).collect()
    assert {(r.section, r.place, r.before, r.problem) for r in rows} == {
        ("a", 2, 2, "gap"), ("a", 3, 4, "repeat"), ("a", 5, 5, "reset"), ("a", 7, 2, "reset"), ("a", 8, 1, "gap"), ("a", 9, 3, "back"), ("b", 0, None, "gap"), ("d", 0, None, "back"),
    }


def test_accents(spark):
    marks = ("PSILI", "DASIA", "PERISPOMENI")
    poly, tonos = L.named_class(*marks), L.named_class("TONOS")
    texts = ["ἐν ἀρχῇ ἦν ὁ λόγος", "μονοτονικό κείμενο", "plain", "ᾶ ά ά ΐ"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(L.accent_counts(F.col("t"), poly, tonos).alias("a")).collect()
    for t, r in zip(texts, got):
        names = [unicodedata.name(c, "") for c in t]
        p = [any(m in n for m in marks) for n in names]
        assert (r.a.polytonic, r.a.tonos) == (sum(p), sum("TONOS" in n and not x for n, x in zip(names, p)))


def test_numbered_stanzas(spark):
    text = "a\nb 1\n\nc\nd\ne 2\nf 8\ng\nh 4\ni\nj 7\nk\nl 8\nm\nn 9\nrest\n"
    docs = spark.createDataFrame([(1, text), (2, "x\ny"), (3, None), (4, "p 3\nq 4")], "doc_id int, text string")
    got = [tuple(r) for r in L.numbered_stanzas(docs, r"^(.*?)\s+([0-9]+)$", n_lines=2).orderBy("doc_id", "stanza").collect()]
    assert got == [
        (1, 1, 1, 1, "a  \nb (1)", []), (1, 2, 2, 2, "c  \nd  \ne (2)", ["lines"]), (1, 3, 3, 8, "f (3)", ["misread", "lines"]), (1, 4, 4, 4, "g  \nh (4)", []), (1, 5, 7, 7, "i  \nj (7)", ["jump"]),
        (1, 6, 8, 8, "k  \nl (8)", []), (1, 7, 9, 9, "m  \nn (9)", []), (1, 8, None, None, "rest", ["unclosed"]), (2, 1, None, None, "x  \ny", ["unclosed"]),
        (4, 1, 3, 3, "p (3)", ["jump", "lines"]), (4, 2, 4, 4, "q (4)", ["lines"]),
    ]
    assert L.numbered_stanzas(docs.where("doc_id = 1"), r"^(.*?)\s+([0-9]+)$", rejoin=True).where("stanza = 2").first().text == "c d  \ne (2)"


def test_families_and_locales(spark):
    from folioscope.operators import publish as P

    books = spark.createDataFrame([(x,) for x in ["en", "en-US", "de", "de", "ang", "ko", "ja"]], "locale string")
    coverage = spark.createDataFrame([("Germanic, West", ["en", "en-US", "de"], 4), ("Germanic, Old", ["ang", "de"], 1), ("Koreanic", ["ko", "xx"], 1)], "family string, locales array<string>, n long")
    assert {tuple(r) for r in P.derived_counts(books, coverage).collect()} == {("books", 7), ("locales", 6), ("languages", 5), ("beyond_english", 3), ("families", 2)}
    assert {tuple(r) for r in P.locale_counts(books, coverage).collect()} == {("Germanic, Old", None, "count"), ("Koreanic", "xx", "unknown"), ("Germanic, West", "de", "twice"), (None, "ja", "missing")}
    assert {r.n for r in P.derived_counts(books, coverage.limit(0)).where("quantity = 'families'").collect()} == {-1}


def test_accents_by_halved_classes(spark):
    """Both classes are looked up by halves and count what the plain ones count."""
    marks = ("CIRCUMFLEX", "CEDILLA"), ("ACUTE", "GRAVE")
    classes = [L.named_class(*m) for m in marks]
    points = [chr(p) for p in range(0x20000) if not 0xD800 <= p < 0xE000]
    named = [{c for c in points if any(m in unicodedata.name(c, "") for m in own)} for own in marks]
    found = L.accent_counts(F.col("t"), *classes)
    assert "&&" in found._jc.toString()
    got = spark.createDataFrame([(c,) for c in points], "t string").select("t", found.alias("f")).where("f.polytonic + f.tonos > 0").collect()
    assert {r.t for r in got if r.f.polytonic} == named[0] and {r.t for r in got if r.f.tonos} == named[1] - named[0]
    plain = spark.createDataFrame([("a^b^",)], "t string").select(L.accent_counts(F.col("t"), "[a^]", r"\^|b").alias("f")).first().f
    assert (plain.polytonic, plain.tonos) == (3, 1)
