"""Functions and transforms on literal texts."""

import pytest
from pyspark.sql import functions as F

from folioscope.functions import text as T
from folioscope.operators import markup, publish, relations
from folioscope.operators import transforms as X


def apply(spark, column, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", column.alias("r")).orderBy("i").collect()
    return [r.r for r in rows]


def test_line_functions(spark):
    t = F.col("t")
    assert apply(spark, T.clean_lines(t), ["a  b \r\n\n　c ", "", None]) == [["a b", "c"], [], None]
    assert apply(spark, T.tidy_spaces(t), ["a  b  \nc   \nd \n\n\n\ne"]) == ["a b  \nc\nd\n\ne\n"]
    assert apply(spark, T.caps_heading(t), ["THE LEGEND OF X.", "The legend", "AB", "A" * 56]) == [True, False, False, False]
    assert apply(spark, T.foreign_share(t), ["bcd aei", "123"]) == [0.5, None]
    assert apply(spark, T.syllables(t, r"\s/:$"), ["a/b [c d] e", "", None]) == [4, 0, None]
    assert apply(spark, T.page_name(t), ["https://x/wiki/A%20B+C", "plain"]) == ["A B+C", "plain"]
    assert apply(spark, T.percent(F.lit(0.125)), ["x"]) == ["12%"]
    fixed, n = T.digit_slips(t, "9", "n")
    assert apply(spark, fixed, ["a9 9a 99a 9 a9b 19a", None]) == ["an na 99a 9 anb 19a", None]
    assert apply(spark, n, ["a9 9a 99a 9"]) == [2]


def test_exactly_one_place(spark):
    assert apply(spark, T.replace_once(F.col("t"), "old", "new"), ["an old one"]) == ["an new one"]
    for text in ("none", "old old"):
        with pytest.raises(Exception, match="places for"):
            apply(spark, T.replace_once(F.col("t"), "old", "new"), [text])


def test_transforms(spark):
    t = F.col("t")
    assert apply(spark, X.break_lines(t, "mark"), ["prose\nmark\na\n\n# h\nb  "]) == ["prose\nmark  \na  \n\n# h\nb  "]
    assert apply(spark, X.break_lines(t, "none"), ["a\nb"]) == ["a\nb"]
    assert apply(spark, X.promote_headings(t, ["One"], 2), [" One \ntwo"]) == ["## One\ntwo"]
    assert apply(spark, X.strip_line_numbers(t), ["a  12\nb 3\nc   4  "]) == ["a\nb 3\nc"]
    assert apply(spark, X.own_language(t, 0.3), ["# H b\n\naloha e ka\n\nstrict strings\n\n123"]) == ["# H b\n\naloha e ka"]
    parts = F.split(t, r"\|")
    assert apply(spark, X.merge_broken(parts), ["one two|three.|Four|five|Six"]) == ["one two three.\n\nFour five\n\nSix"]
    verses = F.transform(F.split(t, r"\|"), lambda x: F.struct(F.substring(x, 1, 1).cast("int").alias("position"), F.substring(x, 2, 99).alias("text")))
    assert apply(spark, X.couplets(verses), ["0a|1b|0c|1d|2e|0f|0 "]) == ["a\nb\n\n\nc\nd\n\ne\n\nf"]
    assert apply(spark, X.template_field(t, "yel", "9999"), ["{{x|yel = 1890|num=}}", "{{x}}"]) == ["1890", "9999"]
    assert apply(spark, X.section(t, "B"), ["## A\nx\n## B\ny\n### C\nz\n## D", "## B", "none"]) == ["y\n### C\nz", "", None]
    assert apply(spark, X.choose_variant(t, ["B", "A"]), ["## A\nx", "none"]) == ["x", "none"]


def test_templates_and_joined_words(spark):
    cases = {
        "{{Header|title=x|scan.djvu}}\n{{flag|12}}__TOC__\ntext": "text",
        "{{Header|a={{b}}}}{{verse|a line of some prose}}": "{{verse|a line of some prose}}",
        "{{open": "{{open",
    }
    assert apply(spark, X.strip_top_templates("t"), [*cases, None]) == [*cases.values(), None]
    join = X.join_attested("a-z")
    assert apply(spark, join("t"), ["wor\nds and words", "wor\nds", "wor\nds words wor ds", "a\n\nb ab", None]) == ["words and words", "wor\nds", "wor\nds words wor ds", "a\n\nb ab", None]


def test_markup(spark):
    t = F.col("t")
    page = "<h2 class='x'>A <b>bold</b>\nhead</h2><p> x <b>y</b> <i>z</i> <b>open</p><dl><dt>t</dt><dd>d</dd></dl>&lt;"
    assert apply(spark, markup.html_to_markdown(t), [page, None]) == ["## A boldhead\n\nx **y** *z* open\n\n**t**\n\nd\n\n<", None]
    strip = markup.strip_balanced("div", "ad")
    cases = {
        'a<div class="ad">b<div>c</div>d</div>e': "ae",
        'a<div class="ad">b<div>c</div>rest': "arest",
        'a<div class="ad">b': "ab",
        'a<div>b</div><div id="ad">c</div>': "a<div>b</div>",
    }
    assert apply(spark, strip("t"), [*cases, None]) == [*cases.values(), None]
    assert apply(spark, markup.numeric_entities("t"), ["&#65;&#x42; &#0; &#55296;"]) == ["AB &#0; &#55296;"]


def test_reflow(spark):
    pages = ["a line of words that is long enoug-", "h to be one.\n\nnext para\ngoes on", "12\nCHAPTER\nthis is a long line of the page\nshort\nanother line that is long again"]
    run = markup.reflow(heading="CHAPTER", drop=r"\d+$")
    got = spark.createDataFrame([(pages,), ([],), (None,)], "p array<string>").select(run("p").alias("r")).collect()
    assert [r.r for r in got] == ["a line of words that is long enough to be one.\n\nnext para goes on\n\nCHAPTER\n\nthis is a long line of the page short\n\nanother line that is long again", "", None]


def test_agreement(spark):
    base = spark.createDataFrame([(1, "the quick brown fox\njumps over it all\n12\nshort"), (2, "only here it stands"), (3, "x")], "page_id int, text string")
    other = spark.createDataFrame([(1, "the quick brown fox\njumqs ower it al1"), (3, "a line of a page")], "page_id int, text string")
    ratios = relations.line_ratios(base, other)
    got = {r.line: r.ratio for r in ratios.collect()}
    assert got["the quick brown fox"] == 1.0 and 0.7 < got["jumps over it all"] < 0.9 and len(got) == 2
    total = relations.agreement(ratios, high=0.95).first()
    assert (total.body_lines, total.high_share, total.flagged) == (2, 0.5, 1)
    assert [(r.page_id, r.line) for r in relations.flagged_lines(ratios, 0.95).collect()] == [(1, "jumps over it all")]
    empty = relations.agreement(relations.line_ratios(base.limit(0), other)).first()
    assert tuple(empty) == (0, 0.0, 0.0, 0)
    script = relations.line_ratios(spark.createDataFrame([(1, "ᎣᏏᏲ ᎣᏏᏲ ᎣᏏᏲ ᎣᏏᏲ\nGerman notes here")], base.schema), other, script=r"[\x{13A0}-\x{13FF}]")
    assert script.count() == 1


def test_pick_base(spark):
    pages = spark.createDataFrame([("a", 1, "ab1%"), ("b", 1, "ab1%"), ("b", 2, "%%%")], "engine string, page_id int, text string")
    assert tuple(relations.pick_base(pages, "a-z").first()) == ("b", 0.25)


def test_coverage_and_counts(spark):
    docs = spark.createDataFrame([(1, "53 languages and 66\n  locales, 9 books"), (2, "2 books")], "doc_id int, text string")
    derived = spark.createDataFrame([("languages", 53), ("locales", 65), ("books", 2)], "quantity string, n long")
    got = {tuple(r) for r in publish.stated_counts(docs, derived).collect()}
    assert got == {(1, "locales", 66, 65), (1, "books", 9, 2)}
    books = spark.createDataFrame([("en-GB",), ("en-US",), ("ang",), ("fr",)], "locale string")
    assert {tuple(r) for r in publish.derived_counts(books).collect()} == {("books", 4), ("locales", 4), ("languages", 3), ("beyond_english", 1)}


def test_variants(spark):
    cases = {
        "{{header|title=靜夜思}}\n<onlyinclude>\n===李太白全集===\n<poem>\n牀前看月光，\n疑是地上霜。\n</poem>\n===唐詩三百首===\n<poem>\n牀前明月光，\n疑是地上霜。\n舉頭望明月，\n低頭思故鄉。\n</poem>\n</onlyinclude>": "牀前明月光，\n疑是地上霜。\n舉頭望明月，\n低頭思故鄉。",
        '<templatestyles src="x.css" />\n<center><div class="Kaiti">\n<onlyinclude><poem>\n白日依山盡，黃河入海流。<small><small><ref>note</ref></small></small>\n欲窮千里目，更上一{{另|層|重}}樓。\n</poem></onlyinclude>\n</div></center>': "白日依山盡，黃河入海流。\n欲窮千里目，更上一層樓。",
        "{{header}}{{唐詩三百首}}\n<onlyinclude>\n<poem>\n月落烏啼霜滿天，江楓漁火對愁眠。\n姑蘇城外寒山寺，夜半鐘聲到客船。\n</poem>\n</onlyinclude>": "月落烏啼霜滿天，江楓漁火對愁眠。\n姑蘇城外寒山寺，夜半鐘聲到客船。",
    }
    assert apply(spark, X.choose_reading("唐詩三百首")("t"), [*cases, None]) == [*cases.values(), None]


def test_heads_tables_and_emphasis(spark):
    t = F.col("t")
    head, rest = X.printed_head(t, 2)
    assert apply(spark, head, ["**A**\n\n **B.** \nx", "**A**\nx"]) == ["A B", None]
    assert apply(spark, rest, ["**A**\n\n **B.** \n\nx"]) == ["x"]
    assert apply(spark, X.drop_labels(t, ["L"]), ["\nL\n\nL\nx", "x\nL"]) == ["L\nx", "x\nL"]
    assert apply(spark, X.split_emphasis("t"), ["<b>a<br>c</b><i>x</i> <b> </b>", None]) == ["<b>a</b><br><b>c</b><i>x</i>  ", None]
    assert apply(spark, X.wiki_tables("t"), ['{|\n|+ c\n|-\n| a || b\n! h\n|align="right"|x\n|}\nend']) == ["c\n\na b\n\nx\n\nend"]
    assert apply(spark, X.list_table(F.split(t, ",")), ["a,b,c,d"]) == ["|  |  |  |\n|---|---|---|\n| a | b | c |\n| d |  |  |"]


def test_text_udfs_hold_few_texts(spark):
    """UDFs of texts work on Arrow arrays, a few texts at a time, and keep nulls."""
    from pyspark.util import PythonEvalType

    from folioscope.operators import markup, rules, transforms

    for udf in (transforms.unwrap_divs, transforms.strip_top_templates, transforms.wiki_tables, transforms.split_emphasis, markup.convert_templates, rules.fix_text):
        assert udf.evalType == PythonEvalType.SQL_SCALAR_ARROW_UDF
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else f"<div>{i}</div>") for i in range(1000)], "i long, t string").coalesce(1)
    got = {r.i: r.u for r in rows.select("i", transforms.unwrap_divs("t").alias("u")).collect()}
    assert got == {i: None if i % 7 == 0 else f"\n\n{i}\n\n" for i in range(1000)}
