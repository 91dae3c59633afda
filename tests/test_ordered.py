"""One file from many tasks: manifests and anthologies, byte for byte."""

import json
import re

import pytest
from pyspark.sql import functions as F

from folioscope.operators.publish import FIELDS
from folioscope.sources import corpus, ordered


def _join(spark, parts):
    """What a file system that can concatenate does, for local files."""
    local = [p.removeprefix("file:") for p in parts]
    with open(local[0], "ab") as out:
        for p in local[1:]:
            out.write(open(p, "rb").read())
    for p in local:  # the checksum files of Hadoop's local file system know nothing of it
        crc = re.sub(r"/([^/]*)$", r"/.\1.crc", p)
        __import__("os").path.exists(crc) and __import__("os").remove(crc)


@pytest.fixture(params=["one task", "concat"])
def way(request, monkeypatch):
    if request.param == "concat":
        monkeypatch.setattr(ordered, "can_concat", lambda spark, path: True)
        monkeypatch.setattr(ordered, "concat", _join)
    return request.param


BOOKS = {
    "de/Anna A/Buch.md": '---\ntitle: "Das „Buch“"\nauthor: Anna A\nyear: "ca. 1850"\nzusatz: x: y\nquote: "a" and b\n---\n\nEin Wort und noch eins\n',
    "de/Anna A/Éude.md": "---\ntitle: Zwei\\drei\ntitle: Zwei\nyear: 300 BCE\n---\nText",
    "ko/Kim/책.md": '---\ntitle: "책\t한"\nlicense: ""\n---\n\n한 글\n',
    "en/None/plain.md": "no header at all\n",
    "ja/X/縦.md": "---\nwriting-mode: vertical\nlanguage: ja\n---\n\n縦書き の本\n",
}


def manifest_by_hand(files, fixed):
    records = []
    for path, raw in sorted(files.items()):
        header, text = {}, raw
        if m := re.match(r"---\n(.*?)\n---\n", raw, re.S):
            for line in m[1].split("\n"):
                k, v = line.split(":", 1)
                v = v.strip()
                header[k] = v[1:-1] if len(v) > 1 and v[0] == v[-1] == '"' else v
            text = raw[m.end() :]
        r = {"path": f"books/{path}", "locale": path.split("/")[0]} | {k: header[k] for k in FIELDS if k in header} | {k: header[k] for k in sorted(header) if k not in FIELDS}
        if m := re.search(r"\d{1,4}", header.get("year", "")):
            r["yearNumeric"] = int(m[0]) * (-1 if "BCE" in header["year"] else 1)
        records.append(r | {"sizeBytes": len(raw.encode()), "wordCount": len(text.split())})
    locales = sorted({r["locale"] for r in records})
    return json.dumps(fixed | {"bookCount": len(records), "localeCount": len(locales), "locales": locales, "books": records}, ensure_ascii=False, indent=2) + "\n"


def test_manifest(spark, tmp_path, way):
    fixed = {"$schema": "./x.json", "corpus": "ein \"Korpus\""}
    for path, raw in BOOKS.items():
        (tmp_path / "books" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "books" / path).write_text(raw, encoding="utf-8")
    files = corpus.read_corpus(spark, str(tmp_path / "books"))
    out = tmp_path / "manifest.json"
    for _ in range(2):  # an existing file is replaced
        ordered.write_manifest(files, str(out), fixed)
        assert out.read_text(encoding="utf-8") == manifest_by_hand(BOOKS, fixed)
    ordered.write_manifest(files.limit(0), str(out), fixed)
    assert out.read_text() == manifest_by_hand({}, fixed)
    assert {p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")} == {"books", "manifest.json"}


def test_anthology(spark, tmp_path, way):
    rows = [(1900 + i // 7, f"J{i % 3}", i, f"Title {i}", None if i % 5 == 0 else f"J{i % 3}, {1900 + i // 7}", "<b>left</b>" if i % 11 == 3 else f"one {i}\n\ntwo" if i else None) for i in range(60)]
    items = spark.createDataFrame(rows, "year int, journal string, number int, title string, cite string, text string").repartition(4)
    exclude = {"late": F.col("year") > 1907, "markup": F.col("text").rlike("<[a-zA-Z/]")}
    header = "---\nnote: {kept} of {total}, {late} late, {markup} with markup\n---\n"
    kept = [r for r in rows if r[0] <= 1907 and "<" not in (r[5] or "")]
    late = sum(r[0] > 1907 for r in rows)
    top = f"---\nnote: {len(kept)} of {len(rows)}, {late} late, {len(rows) - late - len(kept)} with markup\n---\n"

    def by_hand(section):
        blocks, before = [], None
        for r in sorted(kept, key=lambda r: r[:3]):
            if section and r[0] != before:
                blocks.append(f"# {r[0]}")
            before = r[0]
            blocks += [("## " if section else "# ") + r[3], *([f"*{r[4]}*"] if r[4] else []), *([r[5]] if r[5] else [])]
        return "\n\n".join(blocks) + "\n"

    out = tmp_path / "Anthology.md"
    order = ["year", "journal", "number"]
    ordered.write_anthology(items, str(out), order, exclude, header)
    assert out.read_text() == top + "\n" + by_hand(False)
    ordered.write_anthology(items.withColumn("part", F.col("year").cast("string")), str(out), order, exclude, "", section="part")
    assert out.read_text() == by_hand(True)
    ordered.write_anthology(items.limit(0), str(out), order, exclude, header)
    assert out.read_text() == "---\nnote: 0 of 0, 0 late, 0 with markup\n---\n\n"


def test_sections_do_not_meet_in_one_task(spark, monkeypatch):
    """Items are not dealt by their section, be there few or many sections."""
    items = spark.createDataFrame([(s, i, f"T{i}", None, "text") for s in "ab" for i in range(5)] + [(None, 9, "none", None, "t")], "s string, i long, title string, cite string, text string")
    own, found = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most in (10, 1):
            monkeypatch.setattr(ordered, "MAX_SECTIONS", most)
            rows = ordered.anthology_rows(items, ["s", "i"], {}, "{kept}", section="s")
            assert "SortMergeJoin [s#" not in rows._jdf.queryExecution().executedPlan().toString()
            found.append(sorted(map(tuple, rows.collect()), key=repr))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", own)
    assert found[0] == found[1] and len(found[0]) == 11
    assert sum("# a\n\n" in r[-1] for r in found[0]) == 1


def test_items_without_a_section_stay(spark, tmp_path, way):
    """Kept items are all there, as the header counts them; those without a section come last."""
    rows = [("b", 1, "B1", None, "x"), (None, 3, "N3", "c", "y"), ("a", 2, "A2", None, "z"), ("a", None, "A", None, "n"), (None, 2, "N2", None, None), ("a", 9, "out", None, "<b>")]
    items = spark.createDataFrame(rows, "s string, i long, title string, cite string, text string").repartition(3)
    out = tmp_path / "all.md"
    ordered.write_anthology(items, str(out), ["s", "i"], {"markup": F.col("text").contains("<")}, "{kept} of {total}", section="s")
    assert out.read_text() == "5 of 6\n# a\n\n## A2\n\nz\n\n## A\n\nn\n\n# b\n\n## B1\n\nx\n\n# \n\n## N2\n\n## N3\n\n*c*\n\ny\n"


def test_anthology_query_equals_its_sql_with_nulls(spark, tmp_path):
    import duckdb
    from folioscope import catalogue

    text = "word " * 20
    rows = [(1, text, "en", "s", 100), (2, text, None, "s", 100), (3, text, None, None, 100), (4, None, "de", "s", None), (5, text, "de", None, 100), (6, "x", None, "s", 1), (7, text, "fr", None, 99), (8, "# a " + text, None, "s", 100), (9, text, "en", "", 100)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = db.sql(catalogue.oracle_sql()["anthology_rows"]).fetchall()
    got = [tuple(r) for r in catalogue.queries()["anthology_rows"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(got) == 9
