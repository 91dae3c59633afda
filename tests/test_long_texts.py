"""Operators on lines and rules take time in proportion to a text's lines."""

import time

import pytest
from pyspark.sql import functions as F

from folioscope.operators import lines, rules

LINE = "a short line of verse\n"
CASES = {
    "verse_runs": (LINE * 5 + "\n", lambda d: lines.verse_runs(d)),
    "dedupe_adjacent": (LINE * 2 + "other\n", lambda d: lines.drop_adjacent_repeats(d)),
    "heading_jumps": ("# One\n\ntext\n\n## Two\n\n", lambda d: lines.heading_jumps(d)),
    "block_classes": (LINE * 3 + "\n", lambda d: lines.block_classes(d)),
    "rules": ("# One\n<b>x</b>\n\\begin{array} $x$ \\end{array}\n## Two\n<i class=\"a\">\n", lambda d: rules.issues(d, "doc_id")),
}


@pytest.mark.parametrize("name", CASES)
def test_one_long_text(spark, name):
    part, run = CASES[name]
    n = 30_000 // part.count("\n")
    docs = lambda k: spark.createDataFrame([(1, part * k)], "doc_id long, text string")
    run(docs(n // 30)).collect()
    start = time.time()
    rows = run(docs(n)).collect()
    took = time.time() - start
    assert took < (20 if name == "rules" else 8), took
    if name == "verse_runs":
        assert (rows[0].n_runs, rows[0].max_run, rows[0].flagged) == (n, 5, True)
    if name == "dedupe_adjacent":
        assert rows[0].text == (LINE + "other\n") * n
    if name == "block_classes":
        assert len(rows) == n and {r["class"] for r in rows} == {"verse"}
    if name == "rules":
        assert {(r.code, r.detail, r.n) for r in rows if r.code == "X001"} == {("X001", x, n) for x in ("<b>", '<i class="a">')}


def test_counts_in_runs(spark):
    df = spark.createDataFrame([(["b", "a", "b"], ["a", "c"]), ([], []), (["x"] * 3, ["x"] * 3), (["p", "q"], ["q", "q", "r"])], "b array<string>, e array<string>")
    got = df.select(rules.counted(F.col("b")).alias("c"), rules._uneven(F.col("b"), F.col("e")).alias("u")).collect()
    assert [[tuple(x) for x in r.c] for r in got] == [[("a", 1), ("b", 2)], [], [("x", 3)], [("p", 1), ("q", 1)]]
    assert [[tuple(x) for x in r.u] for r in got] == [[("b", 2), ("c", 1)], [], [], [("p", 1), ("q", 1), ("r", 1)]]
    flags = spark.createDataFrame([([True, True, False, True],), ([],), ([False],), ([True],)], "f array<boolean>")
    assert [[tuple(x) for x in r[0]] for r in flags.select(lines.runs(F.col("f"))).collect()] == [[(0, 1), (3, 3)], [], [], [(0, 0)]]
