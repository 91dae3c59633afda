"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio of trusted target against raw corpus.

Everything here is DataFrame and SQL functions.  Two passes over the texts: one
adds up the bucket counts of all n-grams of all documents (and of the trusted
ones), one scores every document against the table of ratios.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, broadcast_if_small, materialize

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Hash buckets of the two multinomials; the ratio table holds one integer for each.
BUCKETS = 1 << 15
#: Ratios are kept as integers, in thousandths of a nat, so that sums do not depend on their order.
SCALE = 1000
#: A document is kept from this mean ratio (thousandths of a nat for each n-gram) upwards.
THRESHOLD = -150
#: Added to every bucket of both multinomials.
SMOOTHING = 1


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    text = F.coalesce(text, F.lit(""))
    for space in ASCII_SPACE[1:]:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c))
    return text


def word_bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(word.cast("binary")), F.lit(buckets)).cast("int")


def pair_bucket(first: Column, second: Column, buckets: int) -> Column:
    """Bucket of two adjacent words; null if the second is missing."""
    mixed = F.crc32(first.cast("binary")) * 31 + F.crc32(second.cast("binary")) * 17 + 7
    return F.pmod(mixed, F.lit(buckets)).cast("int")


def bucket_ratios(docs: DataFrame, trusted_ids: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """log(p_target / p_raw) of every bucket, in thousandths of a nat.

    Counts the words and adjacent word pairs of all documents; the sums are
    combined in each task before the shuffle, whose rows the number of buckets
    bounds.  The result is a list of ``buckets`` integers whatever the input.
    """
    ids = trusted_ids.where("doc_id is not null").select("doc_id", F.lit(1).alias("trusted")).distinct()
    marked = docs.join(broadcast_if_small(materialize(ids, "trusted")), "doc_id", "left")
    counted = (
        marked.select(F.coalesce("trusted", F.lit(0)).alias("trusted"), words_of(F.col("text")).alias("words"))
        .select("trusted", "words", F.posexplode("words").alias("pos", "word"))
        .select(
            "trusted",
            F.explode(
                F.array(
                    word_bucket(F.col("word"), buckets),
                    pair_bucket(F.col("word"), F.get("words", F.col("pos") + 1), buckets),
                )
            ).alias("bucket"),
        )
        .where("bucket is not null")
        .groupBy("bucket")
        .agg(F.count("*").alias("n_raw"), F.sum("trusted").alias("n_target"))
        .toArrow()
    )
    raw, target = [SMOOTHING] * buckets, [SMOOTHING] * buckets
    for bucket, n_raw, n_target in zip(*(counted[c].to_pylist() for c in ("bucket", "n_raw", "n_target"))):
        raw[bucket] += n_raw
        target[bucket] += n_target
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [round(SCALE * (math.log(t) - math.log(r) + shift)) for t, r in zip(target, raw)]


def base_counts(docs: DataFrame, *carry: str) -> DataFrame:
    """The columns to carry, the counts of the base rules, and ``words``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    count = F.size("words")
    windows = F.slice(
        F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))),
        F.lit(1),
        F.greatest(count - 2, F.lit(0)),
    )
    hashed = docs.select(
        *carry,
        words_of(text).alias("words"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        F.length(without(text, ASCII_SPACE)).cast("long").alias("word_chars"),
        lines.alias("lines"),
    ).select(
        *carry,
        "words",
        "n_symbols",
        "word_chars",
        count.cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    # windows of equal words stand side by side once sorted; most texts have none and skip the sort
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = hashed.withColumn(
        "windows",
        F.when(some, F.sort_array(F.transform("windows", lambda k, i: F.struct(k.alias("k"), i.alias("p"))))),
    )
    at = F.transform(
        F.filter(
            "windows",
            lambda x, i: F.coalesce(F.get("windows", i + 1)["k"] == x["k"], F.lit(False))
            | F.coalesce(F.get("windows", i - 1)["k"] == x["k"], F.lit(False)),
        ),
        lambda x: x["p"],
    )
    covered = F.size(
        F.array_distinct(F.concat("at", F.transform("at", lambda p: p + 1), F.transform("at", lambda p: p + 2)))
    )
    return (
        ordered.withColumn("at", at)
        .withColumn("n_repeat_words", F.when(F.col("at").isNull(), 0).otherwise(covered).cast("long"))
        .select(*carry, *BASE, "words")
    )


#: The counts of the base rules, in output order.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def score_documents(docs: DataFrame, ratios: list[int]) -> DataFrame:
    """Counts and verdict of every row of ``docs(doc_id, text)``; see :func:`quality_rules`.

    The ratios of a text are added up row by row of its words within the task
    that reads it, so one row for each document is shuffled.
    """
    buckets = len(ratios)
    table = F.from_json(F.lit(json.dumps(ratios)), "array<int>")  # folded into one literal
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    key = ("doc_id", "text_hash", *BASE)
    sums = (
        base_counts(keyed, "doc_id", "text_hash")
        .select(*key, "words", F.posexplode_outer("words").alias("pos", "word"))
        .select(
            *key,
            F.when(F.col("pos") > 0, 0).otherwise(1).alias("row"),
            (
                F.coalesce(F.get(table, word_bucket(F.col("word"), buckets)), F.lit(0))
                + F.coalesce(
                    F.get(table, pair_bucket(F.col("word"), F.get("words", F.col("pos") + 1), buckets)), F.lit(0)
                )
            )
            .cast("long")
            .alias("ratio"),
        )
        .groupBy(*key)
        .agg(F.sum("row").alias("rows"), F.sum("ratio").alias("ratio_sum"))
        .withColumn("ratio_sum", F.expr("ratio_sum div rows"))
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    return sums.select(
        "doc_id",
        *BASE,
        failed.alias("base_failed"),
        (~failed & (F.col("ratio_sum") >= THRESHOLD * n_grams)).alias("kept"),
        "ratio_sum",
        F.explode(F.expr("sequence(1, rows)")).alias("copy"),
        "text_hash",
    ).drop("copy")


def trusted_documents(labels: DataFrame) -> DataFrame:
    """Ids that are labelled good and never bad or toxic; repeated labels must agree."""
    return (
        labels.groupBy("doc_id")
        .agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
        .where("doc_id is not null and q = 1 and t = 0")
        .select("doc_id")
    )


def quality_rules(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ratio_sum``.

    One row for each row of ``docs(doc_id, text)``, repeated rows included; a
    null text has no words and fails the base rule.  ``kept`` needs the base
    rule and a mean ratio of at least ``THRESHOLD``.  A null ``doc_id`` is never
    trusted but is counted and judged.  Without trusted documents the target is
    uniform.  Other columns are not carried.
    """
    slim = docs.select("doc_id", "text")
    return score_documents(slim, bucket_ratios(slim, trusted_documents(labels), buckets)).drop("text_hash")
