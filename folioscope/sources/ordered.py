"""One file in order, written by many tasks: manifests and anthologies.

The rows are range-partitioned by their order, header and footer among them, so
that the parts, one after the other, are the file.  A file system that can
concatenate joins the parts without reading them; elsewhere one task sorts and
writes them, spilling as it must.  No row comes to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.publish import record_fields
from .corpus import _below, body, header_map


def _filesystem(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def can_concat(spark: SparkSession, path: str) -> bool:
    """Whether the file system joins files without copying them."""
    p, fs = _filesystem(spark, path)
    return fs.hasPathCapability(p, "fs.capability.paths.concat")


def concat(spark: SparkSession, parts: list[str]) -> None:
    """Append the other parts to the first."""
    jvm = spark.sparkContext._jvm
    first, fs = _filesystem(spark, parts[0])
    rest = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
    for i, name in enumerate(parts[1:]):
        rest[i] = jvm.org.apache.hadoop.fs.Path(name)
    fs.concat(first, rest)


def write_one_file(rows: DataFrame, path: str, order: list[str], text: str = "text") -> None:
    """The ``text`` of the rows as one file, a line feed behind each, sorted by ``order``; an existing file is replaced.

    The work is done beside ``path``, in a folder of the same file system.
    """
    spark = rows.sparkSession
    target, fs = _filesystem(spark, path)
    folder = f"{target.getParent()}/.{target.getName()}-{uuid.uuid4().hex}"
    many = can_concat(spark, str(target.getParent()))
    spread = rows.repartitionByRange(*order) if many else rows.repartition(1)
    try:
        spread.sortWithinPartitions(*order).select(text).write.text(folder)
        where, _ = _filesystem(spark, folder)
        found = [(s.getPath().toString(), s.getLen()) for s in fs.listStatus(where)]
        parts = sorted((int(name.rsplit("/", 1)[1].split("-")[1]), name) for name, size in found if name.rsplit("/", 1)[1].startswith("part-") and size)
        names = [name for _, name in parts]
        if len(names) > 1:
            concat(spark, names)
        fs.delete(target, False)
        if names:
            fs.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(names[0]), target)
        else:
            fs.create(target).close()
    finally:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder), True)


def _json(x: Column) -> Column:
    quoted = F.to_json(F.array(x))
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)


def manifest_rows(books: DataFrame, fixed: Mapping[str, str]) -> DataFrame:
    """``rank, path, text``: the lines of a manifest of ``books(path, locale, header, size_bytes, text)``, in order by rank and path.

    The head is an object with the ``fixed`` fields, the numbers of books and
    locales and the locales; each book is an object of the fields that it has.
    Two blanks a level, characters beyond ASCII as they are.  Paths are unique.
    """
    fields = record_fields(F.col("path"), F.col("locale"), F.col("header"), F.col("size_bytes"), F.col("text"))
    object_ = F.concat(F.lit("    {\n      "), F.array_join(fields, ",\n      "), F.lit("\n    }"))
    facts = books.agg(F.count("*").alias("n"), F.sort_array(F.collect_set("locale")).alias("locales"), F.max("path").alias("last"))
    head = F.concat(
        F.lit("{\n"), *(F.concat(F.lit(f'  "{k}": '), _json(F.lit(v)), F.lit(",\n")) for k, v in fixed.items()),
        F.format_string('  "bookCount": %d,\n  "localeCount": %d,\n  "locales": ', "n", F.size("locales")),
        F.when(F.size("locales") > 0, F.concat(F.lit("[\n    "), F.array_join(F.transform("locales", _json), ",\n    "), F.lit("\n  ]"))).otherwise("[]"),
        F.when(F.col("n") > 0, ',\n  "books": [').otherwise(',\n  "books": []'),
    )
    last = facts.select("last")
    body_rows = books.crossJoin(F.broadcast(last)).select(F.lit(1).alias("rank"), "path", F.concat(object_, F.when(F.col("path") < F.col("last"), ",").otherwise("")).alias("text"))
    ends = facts.select(F.inline(F.array(
        F.struct(F.lit(0).alias("rank"), F.lit("").alias("path"), head.alias("text")),
        F.struct(F.lit(2).alias("rank"), F.lit("").alias("path"), F.when(F.col("n") > 0, "  ]\n}").otherwise("}").alias("text")),
    )))
    return ends.unionByName(body_rows)


def as_books(corpus: DataFrame, name: str = "books") -> DataFrame:
    """``path, locale, header, size_bytes, text`` of a corpus of files; paths from the folder of that name on."""
    below = corpus.withColumn("path", _below(name))
    return below.select("path", F.get(F.split("path", "/"), F.lit(1)).alias("locale"), header_map(F.col("raw")).alias("header"), "size_bytes", body(F.col("raw")).alias("text"))


def write_manifest(corpus: DataFrame, path: str, fixed: Mapping[str, str], name: str = "books") -> None:
    """The manifest of a corpus of files as one JSON file."""
    write_one_file(manifest_rows(as_books(corpus, name), fixed), path, ["rank", "path"])


def excluded(exclude: Mapping[str, Column]) -> Column:
    """The first reason that holds for an item, null if none does."""
    return F.coalesce(*(F.when(condition, F.lit(name)) for name, condition in exclude.items()), F.lit(None).cast("string"))


#: Up to so many sections are broadcast; items are joined with more of them by their order.
MAX_SECTIONS = 10_000


def anthology_rows(items: DataFrame, order: list[str], exclude: Mapping[str, Column], header: str, section: str | None = None, nameless: bool = False) -> DataFrame:
    """``rank``, the ``order`` columns and ``text``: an anthology of ``items(title, cite, text, ...)``, in that order.

    Each item is its title as a heading, its citation in emphasis if it has one
    and its text; blocks have a blank line between them.  A ``section``, whose
    items must follow each other in ``order``, gets a heading before its first
    item, and items go a level down.  Items with a reason to ``exclude`` are
    left out and counted: ``{reason}``, ``{kept}`` and ``{total}`` in ``header``
    stand for these numbers.  Items whose ``section`` is null are in the
    anthology if ``nameless``, under a heading without a name.  ``order`` is
    unique, nulls come last.
    """
    judged = items.withColumn("reason", excluded(exclude))
    counts = judged.agg(F.count("*").alias("total"), F.count_if(F.col("reason").isNull()).alias("kept"), *(F.count_if(F.col("reason") == k).alias(f"n_{i}") for i, k in enumerate(exclude)))
    filled = F.lit(header)
    for name, column in [("total", "total"), ("kept", "kept"), *((k, f"n_{i}") for i, k in enumerate(exclude))]:
        filled = F.replace(filled, F.lit("{" + name + "}"), F.col(column).cast("string"))
    kept = judged.where("reason is null")
    key = F.struct(*order)
    # nulls last, in each column
    rank = F.struct(*(x for c in order for x in (F.col(c).isNull(), F.col(c))))
    first = kept.agg(F.min_by(key, rank).alias("_least"))
    kept = kept.crossJoin(F.broadcast(first))
    head = F.lit("")
    if section:
        kept = kept if nameless else kept.where(F.col(section).isNotNull())
        begins = kept.groupBy(section).agg(F.min_by(key, rank).alias("_first")).select("_first")
        # few sections go to the items; the items of a section never meet in one task
        if begins.limit(MAX_SECTIONS + 1).count() <= MAX_SECTIONS:
            begins = F.broadcast(begins)
        kept = kept.join(begins, key.eqNullSafe(F.col("_first")), "left")
        head = F.when(F.col("_first").isNotNull(), F.concat(F.lit("# "), F.coalesce(section, F.lit("")), F.lit("\n\n"))).otherwise("")
    mark = "## " if section else "# "
    cite = F.when(F.coalesce("cite", F.lit("")) != "", F.concat(F.lit("\n\n*"), "cite", F.lit("*"))).otherwise("")
    gap = F.when(key.eqNullSafe(F.col("_least")), "").otherwise("\n")
    block = F.concat(gap, head, F.lit(mark), "title", cite, F.when(F.coalesce("text", F.lit("")) != "", F.concat(F.lit("\n\n"), "text")).otherwise(""))
    rows = kept.select(F.lit(1).alias("rank"), *order, block.alias("text"))
    top = counts.select(F.lit(0).alias("rank"), *(F.lit(None).cast(items.schema[c].dataType).alias(c) for c in order), filled.alias("text"))
    return (top if header else top.limit(0)).unionByName(rows)


def write_anthology(items: DataFrame, path: str, order: list[str], exclude: Mapping[str, Column], header: str = "", section: str | None = None) -> None:
    """An anthology as one file, with all items that are not excluded, see :func:`anthology_rows`."""
    write_one_file(anthology_rows(items, order, exclude, header, section, nameless=True), path, ["rank", *(F.col(c).asc_nulls_last() for c in order)])
