"""Corpus sources and sinks: Markdown trees, headers, indexes, snapshots, page directories."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import token_count, year_number, yaml_scalar


def file_path() -> Column:
    """The path of a row's file, as it is: Spark gives it as a URL."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Every Markdown file below ``path``: ``path, size_bytes, raw``; scaffold files are left out."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md").select(
        file_path().alias("path"), F.col("_metadata.file_size").alias("size_bytes"), F.col("value").alias("raw")
    )
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(~F.upper(name).isin("README.MD", "CONTRIBUTING.MD", "CHANGELOG.MD", "LICENSE.MD") & ~F.col("path").contains("/.github/"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page directories ``<engine>/<page>.txt`` as ``engine, page_id, text``; names from ``_`` on are left out."""
    parts = F.split(file_path(), "/")
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt").select(
        F.element_at(parts, -2).alias("engine"), F.regexp_replace(F.element_at(parts, -1), r"\.txt$", "").alias("page_id"), F.col("value").alias("text")
    ).where(~F.col("page_id").startswith("_"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The records of an index, as written by :func:`write_index` or as one JSON object with ``books``."""
    rows = spark.read.json(path, multiLine=True) if path.endswith(".json") else spark.read.json(path)
    return rows.select(F.inline("books")) if "books" in rows.columns else rows


def read_documents(spark: SparkSession, path: str, leave: str = "/books/") -> DataFrame:
    """Texts that describe the corpus, without the corpus itself: ``path, text``."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(file_path().alias("path"), F.col("value").alias("text"))
    return files.where(~F.col("path").contains(leave))


def read_wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """Answers of a wiki's interface as JSON files: ``title, wikitext, html``, null where an answer lacks one."""
    raw = spark.read.text(path, wholetext=True).select("value")
    get = lambda k: F.get_json_object("value", f"$.parse.{k}")
    return raw.select(get("title").alias("title"), get("wikitext").alias("wikitext"), get("text").alias("html"))


def read_poems(spark: SparkSession, path: str) -> DataFrame:
    """Poems as JSON files: ``title, verses array<struct<position, text>>`` in their order."""
    schema = "title string, verses array<struct<vOrder int, versePosition int, text string>>"
    verses = F.transform(F.array_sort("verses"), lambda v: F.struct(v["versePosition"].alias("position"), v["text"].alias("text")))
    return spark.read.json(path, schema=schema, multiLine=True).select("title", verses.alias("verses"))


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """An archive's listing, an address and a time a line: ``page, time``; other lines are left out."""
    rows = spark.read.text(path).select(F.split("value", " ").alias("c")).where(F.size("c") == 2)
    return rows.select(F.regexp_extract(F.get("c", F.lit(0)), r"([^/]+?)(?:\.html?)?$", 1).alias("page"), F.get("c", F.lit(1)).alias("time"))


def read_witness(spark: SparkSession, path: str) -> DataFrame:
    """A witness with numbered lines, ``(1) text``: ``line_no, text``."""
    pattern = r"^\(([0-9]+)\)\s*(.*)$"
    rows = spark.read.text(path).where(F.col("value").rlike(pattern))
    return rows.select(F.regexp_extract("value", pattern, 1).cast("int").alias("line_no"), F.regexp_extract("value", pattern, 2).alias("text"))


def read_code_table(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated code table with ``#`` comments; of equal codes the first value wins."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("n", "line")).where("line <> '' and line not like '#%'")
    cells = F.split("line", "\t")
    rows = lines.select("n", F.get(cells, F.lit(0)).alias("code"), F.get(cells, F.lit(1)).alias("value"))
    return rows.groupBy("code").agg(F.min_by("value", "n").alias("value"))


@F.pandas_udf(StringType())
def decode_japanese(content: pd.Series) -> pd.Series:
    """Bytes by Shift_JIS, cp932, UTF-8 in turn; what none reads is replaced."""

    def one(raw):
        for name in ("shift_jis", "cp932", "utf-8"):
            try:
                return bytes(raw).decode(name)
            except UnicodeDecodeError:
                pass
        return bytes(raw).decode("utf-8", "replace")

    return content.map(lambda x: None if x is None else one(x))


def header_block(raw: Column) -> Column:
    return F.regexp_extract(raw, r"(?s)^---\n(.*?)\n---(?:\n|$)", 1)


def body(raw: Column) -> Column:
    """What follows the header, without leading newlines."""
    return F.regexp_replace(F.regexp_replace(raw, r"(?s)^---\n.*?\n---(?:\n|$)", ""), r"^\n+", "")


def header_map(raw: Column) -> Column:
    """Header keys and values, without the double quotes around a value; of equal keys the last wins."""
    lines = F.filter(F.split(header_block(raw), "\n"), lambda x: x.rlike("^[A-Za-z_][A-Za-z0-9_-]*:"))
    value = lambda x: F.regexp_replace(F.trim(F.regexp_replace(x, "^[^:]*:", "")), r'(?s)^"(.*)"$', "$1")
    return F.aggregate(lines, F.create_map().cast("map<string,string>"), lambda m, x: _put(m, F.substring_index(x, ":", 1), value(x)))


def _put(m: Column, key: Column, value: Column) -> Column:
    """A map with one more entry, in place of one of the same key."""
    return F.map_concat(F.map_filter(m, lambda k, _: k != key), F.create_map(key, value))


def _below(part: str) -> Column:
    """A file's path from the last folder of that name on."""
    return F.concat(F.lit(f"{part}/"), F.substring_index(F.col("path"), f"/{part}/", -1))


def index_records(corpus: DataFrame) -> DataFrame:
    """One record for each file: header fields, ``year_number``, ``size_bytes``, ``word_count``."""
    h = corpus.select("path", "size_bytes", header_map(F.col("raw")).alias("h"), body(F.col("raw")).alias("body"))
    fields = ["title", "author", "language", "year", "source", "source_url", "license"]
    return h.select(
        "path",
        F.element_at(F.split("path", "/"), -3).alias("locale"),
        *[F.try_element_at("h", F.lit(f)).alias(f) for f in fields],
        year_number(F.try_element_at("h", F.lit("year"))).alias("year_number"),
        "size_bytes",
        token_count(F.col("body")).alias("word_count"),
        "h",
    ).orderBy("path")


def write_index(corpus: DataFrame, path: str, name: str = "books") -> None:
    """The index as JSON lines in the order of the paths: one record for each file below ``name``."""
    from ..operators.publish import record_json

    record = record_json(F.col("below"), F.get(F.split("below", "/"), F.lit(1)), header_map(F.col("raw")), F.col("size_bytes"), body(F.col("raw")))
    rows = corpus.withColumn("below", _below(name)).select("below", record.alias("record"))
    rows.repartitionByRange("below").sortWithinPartitions("below").select("record").write.text(path)


def write_snapshot(corpus: DataFrame, path: str, label: str) -> None:
    """A corpus under a label; other labels stay."""
    corpus.withColumn("snapshot", F.lit(label)).write.mode("append").partitionBy("snapshot").parquet(path)


def read_snapshot(spark: SparkSession, path: str, label: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("snapshot") == label).drop("snapshot")


def cache_keys(pages: DataFrame) -> DataFrame:
    """Pages with the ``key`` that a cache knows them by: of language and page, 24 hexadecimal digits."""
    return pages.withColumn("key", F.substring(F.sha2(F.concat_ws(":", "lang", "page"), 256), 1, 24))


def reuse_headers(bodies: DataFrame, corpus: DataFrame) -> DataFrame:
    """``path, raw``: new bodies ``(path, text)`` under the headers of the files that are there."""
    head = F.regexp_extract("raw", r"(?s)^(---\n.*?\n---\n)", 1)
    return bodies.join(corpus.select("path", head.alias("head")), "path", "left").select("path", F.concat(F.coalesce("head", F.lit("")), F.lit("\n"), "text").alias("raw"))


def write_bare(corpus: DataFrame, path: str) -> None:
    """Bodies without headers, by locale."""
    corpus.select(F.element_at(F.split("path", "/"), -3).alias("locale"), "path", body(F.col("raw")).alias("text")).write.partitionBy("locale").parquet(path)


def with_header(fields: Column, text: Column) -> Column:
    """A document from a map of fields and a body."""
    lines = F.transform(F.map_entries(fields), lambda e: F.concat(e["key"], F.lit(": "), yaml_scalar(e["value"])))
    return F.concat(F.lit("---\n"), F.array_join(lines, "\n"), F.lit("\n---\n\n"), text)
