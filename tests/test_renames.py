"""Renames by shared lines against all pairs, taken greedily."""

import random
from collections import Counter

from folioscope.operators import renames as R


def _score(a, b):
    w = lambda t: Counter({x: n * (len(x.encode()) + 1) for x, n in Counter((t or "").split("\n")).items()})
    x, y = w(a), w(b)
    size = max(sum(x.values()), sum(y.values()))
    common = sum(min(n, y[k]) for k, n in x.items())
    return common, size


def _scores(old, new, least):
    out = {}
    for i, a in old.items():
        for j, b in new.items():
            common, size = _score(a, b)
            if common >= least * size:
                out[i, j] = R.FULL * common // size
    return out


def _greedy(scores):
    pairs, used_a, used_b = {}, set(), set()
    for (i, j), s in sorted(scores.items(), key=lambda x: (-x[1], *x[0])):
        if i not in used_a and j not in used_b:
            pairs[i, j] = s
            used_a.add(i)
            used_b.add(j)
    return pairs


def _texts(rng, n, offset):
    hot = ["", "the line of all", "* * *"]
    pool = [f"line {i} of the works, {i * 7919}" for i in range(16)]
    out = {}
    for i in range(n):
        lines = rng.sample(pool, rng.randrange(1, 12)) + rng.choices(hot, k=rng.randrange(0, 6))
        out[offset + i] = "\n".join(lines)
    return out


def test_scores_and_pairs(spark):
    rng = random.Random(9)
    old = _texts(rng, 60, 0)
    new = {1000 + i: t for i, t in enumerate(_texts(rng, 40, 0).values())}
    for i in range(20):  # reworked texts, and ties
        lines = old[i].split("\n")
        new[2000 + i] = "\n".join(lines[: len(lines) * 3 // 4 + 1] + ["a new line"])
        new[3000 + i] = new[2000 + i]
    frame = lambda d: spark.createDataFrame(list(d.items()), "doc_id long, text string").repartition(3)
    for least in (0.5, 0.8):
        want = _scores(old, new, least)
        assert len(want) > (200 if least == 0.5 else 10)
        scores = R.rename_scores(frame(old), frame(new), least)
        assert {(r.old, r.new): r.score for r in scores.collect()} == want
        assert {(r.old, r.new): r.score for r in R.best_pairs(scores).collect()} == _greedy(want)


def test_snapshot_changes(spark):
    old = {"a/kept": "x\ny", "a/edited": "one\ntwo", "a/moved": "same\ntext", "b/moved": "same\ntext", "a/reworked": "one\ntwo\nthree\nfour", "a/gone": "nothing like it", "a/empty": "", "a/null": None, "a/hot": "\n" * 50}
    new = {"a/kept": "x\ny", "a/edited": "one\nzwei", "c/moved": "same\ntext", "c/reworked": "one\ntwo\nthree\nfive", "c/new": "all its own", "c/empty": None, "c/hot": "\n" * 49 + "x"}
    frame = lambda d: spark.createDataFrame(list(d.items()), "path string, text string")
    got = {(r.change, r.old, r.new) for r in R.snapshot_changes(frame(old), frame(new), key="path").collect()}
    assert got == {
        ("edited", "a/edited", "a/edited"), ("renamed", "a/moved", "c/moved"), ("removed", "b/moved", None), ("renamed", "a/reworked", "c/reworked"), ("removed", "a/gone", None),
        ("renamed", "a/empty", "c/empty"), ("removed", "a/null", None), ("added", None, "c/new"), ("renamed", "a/hot", "c/hot"),
    }
    assert R.snapshot_changes(frame(old), frame(old), key="path").collect() == []
    none = frame({"x": "y"}).limit(0)
    assert {r.change for r in R.snapshot_changes(none, frame(new), key="path").collect()} == {"added"}


def test_changelog_section(spark, tmp_path):
    from folioscope.operators import publish
    from folioscope.sources import ordered

    book = lambda path, title, author="", english="", text="t": (path, path.split("/")[1], {"title": title, "author": author, "title_en": english}, text)
    long = "\n".join(f"line {i}" for i in range(20))
    old = [book("books/de/a/x.md", "X", "A"), book("books/de/b/y.md", "Y", "B", text=long), book("books/fr/c/z.md", "Z", "C", text="gone text"), book("books/de/d/e.md", "E", text="old\nway")]
    new = [book("books/de/a/x.md", "X", "A"), book("books/de/bb/y.md", "Y", "B", text=long + "\nmore"), book("books/ko/k/m.md", "M", "K", "Em", text="ko"), book("books/ko/k/l.md", "L (El)", "", "El", text="ko too"), book("books/de/n/n.md", "N", "N", text="new text"), book("books/de/d/e.md", "E", text="new\nway")]
    frame = lambda rows: spark.createDataFrame(rows, "path string, locale string, header map<string,string>, text string")
    out = tmp_path / "section.md"
    ordered.write_one_file(publish.changelog_rows(frame(old), frame(new), "v2"), str(out), ["rank", "key"])
    assert out.read_text() == (
        "## v2\n\n4 books in 2 locales, to 6 books in 2.\n\n### New locales (1)\n\n- **ko**: *L (El)*; K, *M* (Em)\n\n### New books in existing locales (1)\n\n- **de**: N, *N*\n\n"
        "### Moved or re-attributed (1)\n\n- `books/de/b/y.md` is now `books/de/bb/y.md`\n\n### Removed (1)\n\n- **fr**: C, *Z*\n\nLocales no longer present: fr\n\n### Revised text (1 book)\n\nde (1)\n\n"
    )
    ordered.write_one_file(publish.changelog_rows(frame(old), frame(old), "v2"), str(out), ["rank", "key"])
    assert out.read_text() == "## v2\n\n4 books in 2 locales, to 4 books in 2.\n\nNo change to the corpus itself in this range.\n\n"


def test_snapshots_keep_no_texts(spark, monkeypatch):
    """What is written between the steps are digests and weights, no texts."""
    from folioscope.operators import renames

    seen, own = [], renames.cut_lineage
    monkeypatch.setattr(renames, "cut_lineage", lambda df: seen.append(df.columns) or own(df))
    old = spark.createDataFrame([(1, "a\nb"), (2, "c"), (3, None), (4, "x\ny\nz"), (5, "same")], "doc_id long, text string")
    new = spark.createDataFrame([(1, "a\nB"), (12, "c"), (3, ""), (14, "x\ny\nw"), (5, "same"), (16, "")], "doc_id long, text string")
    got = {(r.change, r.old, r.new) for r in renames.snapshot_changes(old, new).collect()}
    assert got == {("edited", 1, 1), ("renamed", 2, 12), ("renamed", 4, 14), ("added", None, 16)}
    assert seen and not any("text" in c for c in seen)
