"""Renames between snapshots: texts that went and texts that came, matched one to one by the lines they share."""

from __future__ import annotations

import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Scores are parts of this.
FULL = 60_000


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` from the checkpoint folder of the cluster; only a local master without one makes its own."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        root = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if root is None and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(root or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()


def _weights(texts: DataFrame, key: str) -> DataFrame:
    """``id, line, weight, size``: bytes of each distinct line of a text, newline included, and of the text."""
    lines = texts.select(F.col(key).alias("id"), F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"))
    per = lines.groupBy("id", F.xxhash64("line").alias("line"), F.octet_length("line").alias("bytes")).agg(F.count("*").alias("times"))
    per = per.groupBy("id", "line").agg(F.sum((F.col("bytes") + 1) * F.col("times")).alias("weight"))
    return per.withColumn("size", F.sum("weight").over(Window.partitionBy("id")))


def rename_scores(old: DataFrame, new: DataFrame, least: float = 0.5, key: str = "doc_id") -> DataFrame:
    """``old, new, score`` of all pairs of texts that share at least ``least`` of the larger one's bytes, by whole lines.

    ``score`` is the share in parts of ``FULL``, rounded down.  Such a pair has
    one of the lines that are left of each text when its most frequent lines
    with less than ``least`` of its bytes are taken away: only by those, which
    are the rare ones, texts are brought together, so that a line of thousands
    of texts makes no pairs unless it makes up the texts.
    """
    a, b = cut_lineage(_weights(old, key)), cut_lineage(_weights(new, key))
    often = a.select("line").unionAll(b.select("line")).groupBy("line").agg(F.count("*").alias("often"))

    def rare(side):
        upto = Window.partitionBy("id").orderBy(F.desc("often"), "line").rowsBetween(Window.unboundedPreceding, 0)
        ranked = side.join(often, "line").withColumn("upto", F.sum("weight").over(upto))
        return ranked.where(F.col("upto") >= F.lit(least) * F.col("size")).select("id", "line", "size")

    left, right = rare(a).toDF("old", "line", "size_a"), rare(b).toDF("new", "line", "size_b")
    near = F.least("size_a", "size_b") >= F.lit(least) * F.greatest("size_a", "size_b")
    pairs = left.join(right, "line").where(near).select("old", "new", F.greatest("size_a", "size_b").alias("size")).distinct()
    shared = pairs.join(a.select(F.col("id").alias("old"), "line", F.col("weight").alias("w_a")), "old")
    shared = shared.join(b.select(F.col("id").alias("new"), "line", F.col("weight").alias("w_b")), ["new", "line"])
    common = shared.groupBy("old", "new", "size").agg(F.sum(F.least("w_a", "w_b")).alias("common"))
    score = F.expr(f"{FULL} * common div size")
    return common.where(F.col("common") >= F.lit(least) * F.col("size")).select("old", "new", score.alias("score"))


def best_pairs(scores: DataFrame) -> DataFrame:
    """One to one out of ``old, new, score``, as if the best pair were taken again and again (ties: least old, then least new).

    A pair that is the best one of both its sides is taken for certain, so all
    of those are taken at once; then the rest is looked at again.
    """
    rank = lambda side: F.row_number().over(Window.partitionBy(side).orderBy(F.desc("score"), "old", "new"))
    taken, left = [], cut_lineage(scores)
    while not left.isEmpty():
        best = cut_lineage(left.withColumn("i", rank("old")).withColumn("j", rank("new")).where("i = 1 and j = 1").select("old", "new", "score"))
        taken.append(best)
        left = cut_lineage(left.join(best.select("old"), "old", "left_anti").join(best.select("new"), "new", "left_anti"))
    return reduce(DataFrame.unionByName, taken) if taken else scores.limit(0)


def _digests(texts: DataFrame, key: str) -> DataFrame:
    """``key, digest`` of texts, null as empty."""
    return texts.select(key, F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))


def exact_pairs(old: DataFrame, new: DataFrame, key: str = "doc_id") -> DataFrame:
    """``old, new`` with equal ``digest``, the first by id with the first, and so on."""
    def ranked(side, name):
        slim = side.select(F.col(key).alias(name), "digest")
        return slim.withColumn("n", F.row_number().over(Window.partitionBy("digest").orderBy(name)))

    return ranked(old, "old").join(ranked(new, "new"), ["digest", "n"]).select("old", "new")


def snapshot_changes(old: DataFrame, new: DataFrame, least: float = 0.5, key: str = "doc_id") -> DataFrame:
    """``change, old, new, score`` between snapshots ``(key, text)`` with unique keys.

    ``edited`` has the key on both sides, ``renamed`` two keys of which one went
    and one came, with equal texts (score ``FULL``) or else the best share of
    lines, one to one; what is left is ``added`` or ``removed``.  Null texts are
    empty; empty texts are only ever equal to one another.  No row for texts
    that stayed the same.
    """
    # texts are told apart by their digests; only those are moved that have to be matched by lines
    before, after = _digests(old, key), _digests(new, key)
    gone = cut_lineage(before.join(after, key, "left_anti"))
    come = cut_lineage(after.join(before, key, "left_anti"))
    same = cut_lineage(exact_pairs(gone, come, key))
    filled = F.col("digest") != F.sha2(F.lit(""), 256)

    def rest(texts, side, name):
        left = side.where(filled).join(same.select(F.col(name).alias(key)), key, "left_anti").select(F.col(key).alias("_key"))
        return texts.join(left, texts[key].eqNullSafe(left["_key"]), "left_semi").select(key, "text")

    scores = rename_scores(rest(old, gone, "old"), rest(new, come, "new"), least, key)
    moved = cut_lineage(same.select("old", "new", F.lit(FULL).cast("long").alias("score")).unionByName(best_pairs(scores)))
    edited = before.withColumnRenamed("digest", "a").join(after.withColumnRenamed("digest", "b"), key).where("a <> b")
    none = F.lit(None)
    kind = old.schema[key].dataType

    def rows(df, change, before: Column, after: Column, score: Column = none):
        return df.select(F.lit(change).alias("change"), before.cast(kind).alias("old"), after.cast(kind).alias("new"), score.cast("long").alias("score"))

    return reduce(
        DataFrame.unionByName,
        [
            rows(edited, "edited", F.col(key), F.col(key)),
            rows(moved, "renamed", F.col("old"), F.col("new"), F.col("score")),
            rows(gone.join(moved.select(F.col("old").alias(key)), key, "left_anti"), "removed", F.col(key), none),
            rows(come.join(moved.select(F.col("new").alias(key)), key, "left_anti"), "added", none, F.col(key)),
        ],
    )
