"""Readers and writers on a small tree."""

import json

from pyspark.sql import functions as F

from folioscope.operators import publish
from folioscope.sources import corpus

HEAD = '---\ntitle: "A: B"\nauthor: X\nauthor: Y\nlanguage: en\nyear: c. 399 BCE\nzone: z\n---\n'


def tree(tmp_path):
    for path, text in {
        "books/en/x/one.md": HEAD + "\n\nsome words here\n",
        "books/fr/y/two.md": "no header",
        "books/README.md": "scaffold",
        "books/fr/y/notes.txt": "other",
    }.items():
        p = tmp_path / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text, encoding="utf-8")
    return str(tmp_path / "books")


def test_corpus(spark, tmp_path):
    rows = corpus.read_corpus(spark, tree(tmp_path))
    got = {r.path.rsplit("/", 1)[1]: r for r in corpus.index_records(rows).collect()}
    assert set(got) == {"one.md", "two.md"}
    one = got["one.md"]
    assert (one.locale, one.title, one.author, one.year_number, one.word_count) == ("en", "A: B", "Y", -399, 3)
    assert one.size_bytes == len((HEAD + "\n\nsome words here\n").encode()) and got["two.md"].title is None
    record = rows.where("path like '%one.md'").select(
        publish.record_json(F.lit("books/en/x/one.md"), F.lit("en"), corpus.header_map(F.col("raw")), F.col("size_bytes"), corpus.body(F.col("raw"))).alias("j")
    )
    want = {"path": "books/en/x/one.md", "locale": "en", "title": "A: B", "author": "Y", "language": "en", "year": "c. 399 BCE", "zone": "z", "yearNumeric": -399, "sizeBytes": one.size_bytes, "wordCount": 3}
    assert record.first().j == json.dumps(want, ensure_ascii=False)


def test_index_and_bare_mirror(spark, tmp_path):
    rows = corpus.read_corpus(spark, tree(tmp_path))
    corpus.write_index(rows, str(tmp_path / "index"))
    index = corpus.read_index(spark, str(tmp_path / "index"))
    assert [r.path for r in index.select("path").collect()] == ["books/en/x/one.md", "books/fr/y/two.md"]
    corpus.write_bare(rows, str(tmp_path / "bare"))
    assert {(r.locale, r.text) for r in spark.read.parquet(str(tmp_path / "bare")).collect()} == {("en", "some words here\n"), ("fr", "no header")}


def test_documents_with_headers(spark):
    fields = F.create_map(*map(F.lit, ["title", "A: B", "year", "1900", "note", 'say "x":']))
    raw = spark.range(1).select(corpus.with_header(fields, F.lit("body")).alias("raw"))
    assert raw.first().raw == '---\ntitle: "A: B"\nyear: 1900\nnote: "say \\"x\\":"\n---\n\nbody'
    assert raw.select(corpus.header_map(F.col("raw")).alias("h")).first().h["title"] == "A: B"


def test_pages_tables_and_encodings(spark, tmp_path):
    for path, text in {"ocr/a/p1.txt": "one", "ocr/b/p1.txt": "two", "ocr/a/_log.txt": "x"}.items():
        p = tmp_path / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    assert {tuple(r) for r in corpus.read_pages(spark, str(tmp_path / "ocr")).collect()} == {("a", "p1", "one"), ("b", "p1", "two")}
    (tmp_path / "codes.tsv").write_text("# head\nA1\tz\nA1\ta\nB2\tU+13000\n")
    assert {tuple(r) for r in corpus.read_code_table(spark, str(tmp_path / "codes.tsv")).collect()} == {("A1", "z"), ("B2", "U+13000")}
    raw = ["日本".encode("shift_jis"), "①".encode("cp932"), "ᎣᏏᏲ".encode(), b"\xff\xfe\x80", None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, c binary").select("i", corpus.decode_japanese("c").alias("t")).orderBy("i").collect()
    assert [r.t for r in rows][:2] == ["日本", "①"] and rows[4].t is None


def test_json_and_listing_sources(spark, tmp_path):
    (tmp_path / "wiki.json").write_text(json.dumps({"parse": {"title": "T", "wikitext": "== x ==", "text": "<p>x</p>"}}))
    assert [tuple(r) for r in corpus.read_wiki_pages(spark, str(tmp_path / "wiki.json")).select("title", "wikitext", "html").collect()] == [("T", "== x ==", "<p>x</p>")]
    poem = {"title": "P", "verses": [{"text": "b", "vOrder": 2, "versePosition": 1}, {"text": "a", "vOrder": 1, "versePosition": 0}]}
    (tmp_path / "poem.json").write_text(json.dumps(poem))
    got = corpus.read_poems(spark, str(tmp_path / "poem.json")).first()
    assert got.title == "P" and [(v.position, v.text) for v in got.verses] == [(0, "a"), (1, "b")]
    (tmp_path / "cdx.txt").write_text("http://x/tei-a-t1.html 2009\nhttp://x/tei-b.html 2010\nbroken\n")
    assert {tuple(r) for r in corpus.read_listing(spark, str(tmp_path / "cdx.txt")).collect()} == {("tei-a-t1", "2009"), ("tei-b", "2010")}
    (tmp_path / "lines.txt").write_text("(1) one\n(2) two\nnote\n")
    assert {tuple(r) for r in corpus.read_witness(spark, str(tmp_path / "lines.txt")).collect()} == {(1, "one"), (2, "two")}


def test_snapshots_and_page_cache(spark, tmp_path):
    rows = corpus.read_corpus(spark, tree(tmp_path))
    corpus.write_snapshot(rows, str(tmp_path / "snaps"), "v1")
    corpus.write_snapshot(rows.limit(1), str(tmp_path / "snaps"), "v2")
    assert corpus.read_snapshot(spark, str(tmp_path / "snaps"), "v1").count() == 2 and corpus.read_snapshot(spark, str(tmp_path / "snaps"), "v2").count() == 1
    pages = spark.createDataFrame([("en", "A", "x"), ("en", "A", "x"), ("fr", "A", "y")], "lang string, page string, html string")
    keyed = corpus.cache_keys(pages)
    assert keyed.select("key").distinct().count() == 2 and all(len(r.key) == 24 for r in keyed.collect())
