"""Reports over several operators: the quality gate and its summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import LOCALE_BLOCKS
from ..operators import lines, publish, rules


def summary_by_lang(docs: DataFrame, **options) -> DataFrame:
    """Issues by language, code and severity: ``lang, code, severity, n_docs, n_hits``."""
    found = rules.checked(docs, "lang", **options).select("lang", F.inline("checks")).where(F.size("hits") > 0)
    hits = F.aggregate("hits", F.lit(0).cast("bigint"), lambda a, h: a + h["n"])
    return found.groupBy("lang", "code", "severity").agg(F.count("*").alias("n_docs"), F.sum(hits).alias("n_hits"))


def gate(docs: DataFrame, strict: bool = False, **options) -> DataFrame:
    """``doc_id, status`` of documents with issues: blocked by errors (by warnings too if strict), else advisory."""
    broken = lambda x: F.size(x["hits"]) > 0
    bad = F.exists("checks", lambda x: broken(x) & ((x["severity"] == "error") | F.lit(strict)))
    found = rules.checked(docs, "doc_id", **options).where(F.exists("checks", broken))
    return found.select("doc_id", F.when(bad, "blocked").otherwise("advisory").alias("status"))


def totals(docs: DataFrame, strict: bool = False, **options) -> DataFrame:
    """One row: ``n_docs, n_issues, n_errors, n_warnings, n_fixable, status``."""
    found = rules.issues(docs, "doc_id", **options)
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    fixable = F.col("code").isin("M002", "M003", "W001", "W002", "H001")
    out = found.agg(
        F.countDistinct("doc_id").alias("n_docs"),
        count(F.lit(True)).alias("n_issues"),
        count(F.col("severity") == "error").alias("n_errors"),
        count(F.col("severity") == "warn").alias("n_warnings"),
        count(fixable).alias("n_fixable"),
    )
    failed = (F.col("n_errors") > 0) | (F.lit(strict) & (F.col("n_warnings") > 0))
    return out.withColumn("status", F.when(failed, "failed").otherwise("passed"))


def file_issues(
    files: DataFrame, records: DataFrame | None = None, exempt: str | None = None, blocks: dict = LOCALE_BLOCKS, stated: DataFrame | None = None, derived: DataFrame | None = None, stale: DataFrame | None = None
) -> DataFrame:
    """``doc_id, class, code, severity, n``: everything that is wrong with ``files(doc_id, content)``, the bytes of documents.

    Class ``lint`` has E001 for bytes that are no UTF-8, which are looked at no
    further, and the rules on headers (FM001 to FM006, not where ``exempt``, a
    pattern, matches the id; FM007 with the cited ``records``), on bodies and,
    by the header's language, on scripts; ``verse`` (D1) are soft-wrapped runs,
    which only advise; ``counts`` (D3) are numbers in ``stated(doc_id, text)``
    that differ from ``derived(quantity, n)``; ``index`` (D5) the paths of
    ``stale(path)``.  A null content is an empty document; ids are strings or
    numbers, and paths count as ids.
    """
    bad = rules.encoding_rule(files).select("doc_id", "code", "severity", F.lit(1).alias("n"))
    valid = files.where(F.col("content").isNull() | F.is_valid_utf8(F.col("content").cast("string")))
    docs = valid.select("doc_id", F.coalesce(F.col("content").cast("string"), F.lit("")).alias("raw"))
    start = F.locate("\n---\n", F.col("raw"), 5)
    headed = F.col("raw").startswith("---\n") & (start > 0)
    language = rules.header_value(F.when(headed, F.substring(F.col("raw"), F.lit(5), start - 5)).otherwise(""), "language")
    texts = docs.select("doc_id", F.col("raw").alias("text"), language.alias("locale"))
    due = docs if exempt is None else docs.where(~F.col("doc_id").cast("string").rlike(exempt))
    lint = [bad, rules.header_rules(due).select("doc_id", "code", "severity", "n"), rules.issues(texts, "doc_id", locale="locale", blocks=blocks).select("doc_id", "code", "severity", "n")]
    if records is not None:
        lint.append(rules.route_rule(due, records).select("doc_id", "code", "severity", F.lit(1).alias("n")))
    bodies = docs.select("doc_id", F.when(headed, F.substring(F.col("raw"), start + 5, F.length("raw"))).otherwise(F.col("raw")).alias("text"))
    verse = lines.verse_runs(bodies).where("flagged").select("doc_id", F.lit("verse").alias("class"), F.lit("D1").alias("code"), F.lit("warn").alias("severity"), F.col("n_runs").alias("n"))
    kind = files.schema["doc_id"].dataType
    parts = [p.select(F.col("doc_id"), F.lit("lint").alias("class"), "code", "severity", F.col("n").cast("long").alias("n")) for p in lint] + [verse]
    if stated is not None:
        found = publish.stated_counts(stated, derived)
        parts.append(found.select(F.col("doc_id").cast(kind), F.lit("counts").alias("class"), F.lit("D3").alias("code"), F.lit("error").alias("severity"), F.lit(1).cast("long").alias("n")))
    if stale is not None:
        parts.append(stale.select(F.col("path").cast(kind).alias("doc_id"), F.lit("index").alias("class"), F.lit("D5").alias("code"), F.lit("error").alias("severity"), F.lit(1).cast("long").alias("n")))
    return reduce(DataFrame.unionByName, parts).groupBy("doc_id", "class", "code", "severity").agg(F.sum("n").alias("n"))


def gate_status(found: DataFrame, strict: bool = False) -> DataFrame:
    """``doc_id, status`` of :func:`file_issues`: blocked by errors, by other findings too if ``strict``, else advisory."""
    blocks = F.max((F.col("severity") == "error") | F.lit(strict))
    return found.groupBy("doc_id").agg(F.when(blocks, "blocked").otherwise("advisory").alias("status"))


def gate_summary(found: DataFrame) -> DataFrame:
    """``class, severity, n_docs, n`` of :func:`file_issues`, most serious first; none if all is well."""
    return found.groupBy("class", "severity").agg(F.countDistinct("doc_id").alias("n_docs"), F.sum("n").alias("n")).orderBy("severity", "class")
