"""Substring dedup by hashing the units of lines.

A text's units are its lines, cut further behind the punctuation that ends a
sentence or a clause, because a passage that two texts share mostly begins and
ends inside lines.  Units are normalised and digested, digests are grouped over
all documents, the earliest ranked occurrence of each stays, and later ones are
removed where they stand in a run of repeated units that is long enough to be a
passage.  Removals keep their offsets in the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_SHARE, broadcast_if_small, discard, every, map_rows, materialize, unused, utf8

#: Words that a run of repeated units must have to be removed: a passage of 50 words less the clauses that it cuts at either end.
MIN_WORDS = 30
#: Hash buckets of digests, by whose rows very frequent ones are found.
BUCKETS = 1 << 16
#: What is returned of a removed unit.
UNIT = ("unit", "start", "stop", "n_words", "first_doc_id", "first_unit", "cut_start", "cut_stop")
#: White space as ``str.split`` takes it.
SPACE = r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: What ends a unit: a newline, or a mark of the first class with any marks behind it and white space.
BOUNDARY = r"[.!?,;:][!-/:-@\[-`{-~]*[" + SPACE + r"]+|\n"
_BOUNDARY = re.compile(BOUNDARY)


def spans(text: str) -> Iterator[tuple[int, int, list[str], int, bool]]:
    """``start, stop, words, end, whole`` of every unit with a word.

    ``start`` and ``stop`` leave out the white space around the unit; ``end`` is
    where a cut of it ends, behind the blanks that follow in its line; ``whole``
    is 1 if the unit begins its line, plus 2 if it ends it.
    """
    at = before = 0  # the unit's first character, and that of the boundary before it
    for boundary in [*_BOUNDARY.finditer(text), None]:
        edge = boundary.end() if boundary else len(text)
        piece = text[at:edge]
        words = piece.lower().split()
        if words:
            start = at + len(piece) - len(piece.lstrip())
            stop = at + len(piece.rstrip())
            line = text.find("\n", stop, edge)
            begins = at == 0 or "\n" in text[before:start]
            yield start, stop, words, edge if line < 0 else line, begins + 2 * (line >= 0 or boundary is None)
        at, before = edge, boundary.start() if boundary else edge


def _text_hash(docs: DataFrame) -> Column:
    """A hash that tells documents of one id apart: of the text if any id is null or repeated, else 0, which costs no space."""
    again = docs.groupBy("doc_id").count().where("doc_id is null or count > 1")
    return F.lit(0).cast("long") if again.isEmpty() else F.xxhash64("text")


def _units(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, d1, d2, place, size, tail`` of every unit with a word.

    ``d1, d2`` are its digest, ``place`` its start and its number among the
    document's, ``size`` its length and words, ``tail`` the blanks behind it and
    whether it begins and ends its line; each two numbers in one.
    """
    numbers = ("start", "stop", "till", "whole", "n_words")

    def make():
        def step(rows):
            out = {k: [] for k in numbers}
            digests, n = [], []
            for blob in rows["text"]:
                before = len(digests)
                for start, stop, words, end, whole in spans(blob.decode("utf-8", "replace")):
                    for column, x in zip(out.values(), (start, stop, end, whole, len(words))):
                        column.append(x)
                    digests.append(hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest())
                n.append(len(digests) - before)
            digest = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            at = np.repeat(np.arange(len(n)), n)
            own = lambda c: pa.array(rows[c], pa.int64()).take(pa.array(at))
            unit = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            start, stop, till, whole, n_words = (np.array(out[k], np.int64) for k in numbers)
            return {
                "doc_id": own("doc_id"), "text_hash": own("text_hash"), "d1": digest[:, 0], "d2": digest[:, 1],
                "place": start << 32 | unit, "size": stop - start << 32 | n_words, "tail": till - stop << 2 | whole,
            }

        return step

    slim = docs.select(F.col("doc_id").cast("long"), _text_hash(docs).alias("text_hash"), utf8("text").alias("text"))
    return map_rows(slim, "doc_id long, text_hash long, d1 long, d2 long, place long, size long, tail long", make, chunk=256)


def _high(column: str) -> Column:
    return F.shiftright(F.col(column), 32).cast("int")


def _low(column) -> Column:
    return F.col(column).bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def _later(units: DataFrame) -> DataFrame:
    """The units of which an equal one ranks before them, each once, with ``first``, the rank of that one.

    One shuffle by digest.  Very frequent digests, of which there are fewer than
    the inverse of ``HOT_SHARE``, are found by the rows of hash buckets, and
    their first occurrence is broadcast to the rows, which stay where they are.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "place")
    most = HOT_SHARE * units.count()
    bucket = F.pmod("d1", F.lit(BUCKETS))
    full = [r["b"] for r in units.groupBy(bucket.alias("b")).count().where(F.col("count") > most).collect()]
    rest, parts = units, []
    if full:
        found = units.where(bucket.isin(full)).groupBy("d1", "d2").agg(F.min(rank).alias("first"), F.count("*").alias("times"))
        hot = F.broadcast(materialize(found.where(F.col("times") > most).drop("times"), "hotunits"))
        rest = units.join(hot, ["d1", "d2"], "left_anti")
        parts = [units.join(hot, ["d1", "d2"]).where(rank > F.col("first")).distinct()]
    order = Window.partitionBy("d1", "d2").orderBy(F.col("doc_id").isNull(), "doc_id", "text_hash", "place")
    # equal ranks are rows that repeat id and text
    same = F.lag(rank).over(order) == rank
    cold = rest.select("*", F.first(rank).over(order).alias("first"), F.coalesce(same, F.lit(False)).alias("again"))
    out = cold.where(rank > F.col("first")).where("not again").drop("again")
    for part in parts:
        out = out.unionByName(part)
    return out


def repeated_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every unit to remove: ``doc_id, text_hash`` (0 if ids are unique) and ``UNIT``.

    Offsets are code points in the original text, ``stop`` exclusive;
    ``cut_start`` and ``cut_stop`` are those of the whole run, with a newline if
    it fills its lines, else with the blanks behind it.  Rank is ``doc_id``
    (nulls last), then the text's hash, then the unit's number; the rest of a
    tie are rows that repeat both id and text, which are one document.  A unit
    is repeated if an equal one (case and white space aside) ranks before it;
    it is removed if the run of consecutive repeated units around it has
    ``min_words`` words.  Lines without words are no units and end no run; null,
    empty and blank texts and an empty table have no units.  Other columns are
    not read.
    """
    units = materialize(_units(docs), "units")
    first = F.col("first.place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    late = _later(units).select("doc_id", "text_hash", "place", "size", "tail", F.col("first.doc_id").alias("first_doc_id"), first.alias("first_unit"))
    own = ("doc_id", "text_hash")
    late = late.repartition(*own).select(
        *own, _low("place").alias("unit"), _high("place").alias("start"), (_high("place") + _high("size")).alias("stop"),
        _low("size").alias("n_words"), F.shiftright("tail", 2).cast("int").alias("blanks"), F.col("tail").bitwiseAND(F.lit(3)).alias("whole"),
        "first_doc_id", "first_unit",
    )
    late = late.withColumn("run", F.col("unit") - F.row_number().over(Window.partitionBy(*own).orderBy("unit")))
    run = Window.partitionBy(*own, "run").orderBy("unit").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = F.last("whole").over(run) >= 2
    begins = F.first("whole").over(run) % 2 == 1
    stop = F.last("stop").over(run)
    till = stop + F.last("blanks").over(run)
    return (
        late.withColumn("run_words", F.sum("n_words").over(run))
        .withColumn("cut_start", F.first("start").over(run))
        .withColumn("cut_stop", F.when(ends & begins, till + 1).when(ends, stop).otherwise(till))
        .where(F.col("run_words") >= min_words)
        .select(*own, *UNIT)
    )


def remove_units(docs: DataFrame, units: DataFrame) -> DataFrame:
    """``docs`` with the runs of ``units`` cut from ``text``; ``n_chars``, if there, follows the text.

    A run that fills its lines takes one newline with it, one inside a line
    none.  All rows stay, in all columns, whatever their names; a text without
    runs stays as it is, null included.
    """
    key, digest, cuts = unused(docs, "_id", "_hash", "_cuts")
    held = materialize(units.select("doc_id", "text_hash", "cut_start", "cut_stop").distinct(), "spans")
    gone = materialize(
        held.groupBy(F.col("doc_id").alias(key), F.col("text_hash").alias(digest)).agg(
            F.sort_array(F.collect_set(F.struct("cut_start", "cut_stop"))).alias(cuts)
        ),
        "cuts",
    )
    discard(held)
    same = docs["doc_id"].eqNullSafe(gone[key])
    if not gone.where(F.col(digest) != 0).isEmpty():  # ids that are not unique
        same = same & (F.xxhash64(docs["text"]) == gone[digest])
    keyed = docs.join(broadcast_if_small(gone), same, "left")
    text = F.col("text")
    # text between runs: from the end of one to the start of the next
    begin = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda s: s["cut_stop"]))
    end = F.concat(F.transform(cuts, lambda s: s["cut_start"]), F.array(F.length(text)))
    kept = F.array_join(
        F.transform(
            F.arrays_zip(begin.alias("b"), end.alias("e")),
            lambda p: F.substring(text, p["b"] + 1, F.greatest(p["e"] - p["b"], F.lit(0))),
        ),
        "",
    )
    changed = {"text": F.when(F.col(cuts).isNull(), text).otherwise(kept)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(cuts).isNull(), F.col("n_chars")).otherwise(F.length(kept))
    return keyed.select([changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed else x for c, x in zip(docs.columns, every(docs))])
