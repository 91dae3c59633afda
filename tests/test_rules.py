"""The rules on literal rows: what breaks each of them, what does not, and on which line."""

import pytest
from pyspark.sql import functions as F

from folioscope.functions import text as T
from folioscope.operators import relations, rules

HEAD = "---\ntitle: T\nauthor: A\nlanguage: {}\nyear: {}\nsource: S\nlicense: L\n---\n"
BODY = "word " * 30

#: code -> (text that breaks it, lines of the hits, text that does not)
CASES = {
    "M001": ("$a$ one \\left( only", [0], "$a$ \\left( and \\right)"),
    "M002": ("$a$\n\\right\\\\left.\n\\right\\\\left\\{", [2, 3], "$a$ \\right\\}\\left."),
    "M003": ("x\n$$ x $$ .\n$$ y $$,\n$$ z $$ and $$ w $$", [2, 3], "$$ x $$\n$$ x $$ \n$$x$$ ."),
    "M004": ("a\n<math\nx>b</math>", [2, 3], "<maths"),
    "M005": ("$$ {a $$\n$$ {b} $$", [1], "$$ \\{a $$ $$ {a} $$ $$ \\\\{b} $$ $$$$"),
    "M006": ("$a$ \\begin{array} alone", [0], "\\begin{array} alone"),
    "M007": ("$a$ \\begin{a} \\end{b}", [0, 0], "$a$ \\begin{a}\\end{a} \\begin{A}"),
    "W001": ("a\nb rule of the shorter term rule of the shorter term", [2], "rule of a shorter term"),
    "W002": ("a\n## References\nrule of the shorter term\n## Next", [2], "## References\nfine\n## Next\nrule of the shorter term"),
    "W003": ("a\n{{x}} {{y}}", [2], "{{x$y}} {{a\nb}} $$ {{z}}"),
    "H001": ("a\n<center> </center> <center class='x'>\n</center>", [2], "<center>a</center>"),
    "H002": ("#\n# a\n### b", [0], "# a\n## b\n# c"),
    "S001": (HEAD.format("he", 1900) + "א" * 49 + BODY, [0], HEAD.format("he", 1900) + "א" * 600),
    "S002": (HEAD.format("he", 1900) + "א" * 100 + "x" * 4900, [0], HEAD.format("en", 1900) + BODY),
    "U001": ("a � b", [0], "plain"),
    "U002": ("a  b", [0], "plain"),
    "C001": ("```\na\n```\n```", [0], "```\na\n```"),
    "X001": ("<p>a</p> <Br/> <p>", [0], "&lt;p> a < b"),
    "X002": ("a\n<iaci> </Mb >", [2], "&lt;iaci> <see 3, x> a < b <a title='<foo>'>"),
    "L001": ("a\n" + "x" * 20_001 + "\n" + "y" * 20_001, [2], "x" * 20_000),
}


def test_rules(spark):
    rows = [(f"{code} {kind}", text) for code, (bad, _, good) in CASES.items() for kind, text in (("bad", bad), ("good", good))]
    rows += [("B001 bad", "x" * 99), ("B001 good", "x" * 100 + " \n"), ("B001 headed", HEAD.format("en", 1900) + "x" * 99), ("null", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    language = F.regexp_extract("text", r"(?md)^language: (\S+)", 1)
    found = {}
    for r in rules.issues(docs.withColumn("lang", language), "doc_id", locale="lang").collect():
        found.setdefault((r.doc_id, r.code), []).append((r.line, r.n))
    for code, (_, lines, _) in CASES.items():
        assert [line for line, _ in sorted(found.get((f"{code} bad", code), []))] == lines, code
        assert (f"{code} good", code) not in found, code
    assert found["W001 bad", "W001"] == [(2, 1)] and found["W003 bad", "W003"] == [(2, 2)] and found["X002 bad", "X002"] == [(2, 2)]
    assert found["B001 bad", "B001"] == [(0, 1)] and ("B001 good", "B001") not in found and found["B001 headed", "B001"] == [(0, 1)]
    assert {c for d, c in found if d == "null"} == {"B001"}


def test_lines_count_from_the_start_of_the_file(spark):
    docs = spark.createDataFrame([("a", HEAD.format("en", 1900) + "\n" + "x" * 20_001 + "\n<iaci> �")], "doc_id string, text string")
    got = {r.code: r.line for r in rules.issues(docs, "doc_id").collect()}
    assert got == {"L001": 10, "X002": 3, "U001": 0}  # unknown tags count lines of the body


def test_fixes(spark):
    texts = {
        "a\n\n## References\nrule of the shorter term\n## Next": "a\n",
        "$$ x $$ .\n$$ y $$;;  \n$$ z $$ w": "$$ x $$ .\n$$ y $$\n$$ z $$ w",
        "\\right\\\\left. \\right\\\\left\\{ \\right\\\\leftx": "\\right\\}\\left. \\right\\}\\left\\{ \\right\\\\leftx",
        "a<center>\n</center>b": "ab",
        "## References\nfine": "## References\nfine",
    }
    rows = spark.createDataFrame([(k,) for k in texts] + [(None,)], "t string").select("t", rules.fix_text("t").alias("f")).collect()
    assert {r.t: r.f for r in rows} == texts | {None: None}


def test_header_rules(spark):
    heads = {
        "no": ("text", {("FM001", 1)}),
        "open": ("---\ntitle: T\n", {("FM002", 1)}),
        "good": (HEAD.format("en", '"c. 500"'), set()),
        "int": (HEAD.format("en", "-399"), set()),
        "year": (HEAD.format("en", "c. 500"), {("FM004", 1)}),
        "single": (HEAD.format("en", "'1800'"), {("FM004", 1)}),
        "colon": (HEAD.format("en", 1900).replace("title: T", "title: A: B"), {("FM005", 2)}),
        "coerced": (HEAD.format("No", 1900), {("FM006", 4)}),
        "quoted": (HEAD.format('"no"', 1900).replace("title: T", 'title: "A: B"'), set()),
        "missing": (HEAD.format("en", 1900).replace("license", "licence"), {("FM003", 1)}),
        "null": (None, {("FM001", 1)}),
    }
    docs = spark.createDataFrame([(k, v) for k, (v, _) in heads.items()], "doc_id string, raw string")
    got = {}
    for r in rules.header_rules(docs).collect():
        got.setdefault(r.doc_id, set()).add((r.code, r.line))
    assert got == {k: v for k, (_, v) in heads.items() if v}


def test_years_and_tokens(spark):
    years = {"c. 399 BCE": -399, "1887-1906": 1887, "c. 1280": 1280, "n.d.": None, " -399": -399, "-5": -5, None: None}
    rows = spark.createDataFrame([(k,) for k in years], "y string").select("y", T.year_number(F.col("y")).alias("n")).collect()
    assert {r.y: r.n for r in rows} == years
    assert spark.createDataFrame([("a b　c d\x1ce",)], "t string").select(T.token_count(F.col("t"))).first()[0] == 5


@pytest.mark.parametrize("strict,status", [(False, "passed"), (True, "failed")])
def test_totals(spark, strict, status):
    from folioscope.plans import reports

    docs = spark.createDataFrame([(1, BODY + "{{x}}"), (2, BODY)], "doc_id int, text string")
    assert reports.totals(docs, strict).first().asDict() == {"n_docs": 1, "n_issues": 1, "n_errors": 0, "n_warnings": 1, "n_fixable": 0, "status": status}
    assert reports.totals(docs.limit(0)).first().n_issues == 0


def test_stream_finds_what_the_batch_finds(spark, tmp_path):
    from folioscope.streaming.rules import issue_stream

    docs = spark.createDataFrame([(1, "a\n<iaci>"), (2, BODY)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "in"))
    stream = issue_stream(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("issue_test").trigger(availableNow=True).start()
    stream.awaitTermination()
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(spark.table("issue_test")) == rows(rules.issues(docs, "doc_id")) != []


def test_coverage_of_marks(spark):
    a = spark.createDataFrame([(1, "a; b; «c»"), (2, "x")], "doc_id int, text string")
    b = spark.createDataFrame([(1, "a b; c"), (3, ";")], "doc_id int, text string")
    got = {(r.mark, r.n_source, r.n_copy, r.ok) for r in relations.mark_drops(a, b, ";«»", rendered={"»"}).collect()}
    assert got == {(";", 2, 1, False), ("«", 1, 0, False), ("»", 1, 0, True)}


def test_rules_are_worked_out_once(spark):
    """No filter below the checks repeats them, and codes that are not asked for are left out."""
    from folioscope.plans import reports

    docs = spark.createDataFrame([(1, "en", "<center> </center> {{a}}")], "doc_id long, lang string, text string")
    for df in (rules.issues(docs, "doc_id"), reports.gate(docs), reports.summary_by_lang(docs), rules.header_rules(docs.withColumnRenamed("text", "raw"))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("<center[^>]*>") in (0, 2) and plan.count("FM002") in (0, 1)
    assert {r.code for r in rules.issues(docs, "doc_id", codes=("H001",)).collect()} == {"H001"}
