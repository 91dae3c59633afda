"""Source divergence audit: how far the sources of a language differ in the words they use.

Sort-based streaming.  Each task counts the terms of its documents, up to a
bounded number of counts; these are sorted by language, term, source and
document across all tasks, so that one scan of run lengths gives the document
frequency and the count of every term and source.  Ranges may end inside a
term: the runs at their borders are partial, and are added up afterwards.  A
second scan, over the kept terms alone, adds up the distances of all pairs of
sources inside a task and emits one partial distance a pair.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, discard, materialize, releasing, slices, utf8

#: Documents of a language that a kept term must be in, what is added to every count, and the unit of shares.
MIN_DOCS, ADDED, UNIT = 30, 5, 1_000_000_000
#: Terms that are reported for each source.
TOP = 50
#: Bytes of text that are read at a time, and terms of groups after which a task hands on its counts.
SLICE_BYTES, HELD = 1 << 20, 1 << 20
#: Cells of the table of terms and sources that a task holds at once, and sources compared at once.
CELLS, TILE = 1 << 20, 512
#: Parts of each language's list of sources, if it is too large to broadcast.
SALTS = 64

#: Bytes as a term has them, A-Z lower-cased; all others separate.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters, lower-cased, and of other characters beyond ASCII."""
    return text.translate(_TERM_BYTES).split()


def _counted(docs: DataFrame) -> DataFrame:
    """``key, source, doc, df, n``: documents with a term and its occurrences, for each task or ``HELD`` terms; ``doc`` is the least of the documents.

    ``key`` is the language, a null character and the term, which has none: as
    one column the two are sorted in the same order, and faster.
    """
    schema = pa.schema([("key", pa.string()), ("source", pa.string()), ("doc", pa.int64()), ("df", pa.int64()), ("n", pa.int64())])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict = {}
        held = 0

        def given():
            for (lang, source), (first, df, n) in groups.items():
                head = lang.encode() + b"\0"
                names = pa.array([head + t for t in n], pa.binary()).cast(pa.string())
                fixed = [pa.repeat(pa.scalar(v, k), len(n)) for v, k in ((source, pa.string()), (first, pa.int64()))]
                counts = [pa.array([c[t] for t in n], pa.int64()) for c in (df, n)]
                yield pa.RecordBatch.from_arrays([names, *fixed, *counts], schema=schema)
            groups.clear()

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                rows = part.to_pydict()
                for lang, source, doc, text in zip(rows["lang"], rows["source"], rows["doc"], rows["text"]):
                    if own := terms(text):
                        group = groups.setdefault((lang, source), [doc, Counter(), Counter()])
                        held -= len(group[2])
                        group[0] = doc if group[0] is None else group[0] if doc is None else min(doc, group[0])
                        group[1].update(set(own))
                        group[2].update(own)
                        held += len(group[2])
                if held > HELD:
                    yield from given()
                    held = 0
        yield from given()

    slim = docs.select(_group("lang"), _group("source"), F.col("doc_id").cast("long").alias("doc"), utf8("text").alias("text"))
    return slim.mapInArrow(run, "key string, source string, doc long, df long, n long")


def _group(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(column)


def _scanned(counted: DataFrame) -> DataFrame:
    """``lang, term, source, df, n, whole``: runs of the sorted counts; ``df`` is that of the term if the range holds all of it (``whole``)."""
    schema = pa.schema([("key", pa.string()), ("source", pa.string()), ("df", pa.int64()), ("n", pa.int64()), ("whole", pa.bool_())])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "source", "df", "n"]
        held, first = None, True  # the runs of the term being read; the first term of a range may have begun before it

        def changes(rows, columns):
            """Where one of the columns, which are sorted, changes; the first row counts."""
            new = np.zeros(rows.num_rows, bool)
            new[0] = True
            for c in columns:
                own = rows.column(c)
                new[1:] |= pc.not_equal(own[1:], own[:-1]).to_numpy(zero_copy_only=False)
            return np.flatnonzero(new)

        def summed(rows):
            at = changes(rows, names[:2])
            text = [rows.column(c).take(pa.array(at)) for c in names[:2]]
            return pa.RecordBatch.from_arrays([*text, *(pa.array(np.add.reduceat(rows.column(c).to_numpy(), at)) for c in names[2:])], names=names)

        def closed(runs, whole):
            """The finished terms of some runs, those in too few documents left out."""
            at = changes(runs, names[:1])
            size = np.diff(np.append(at, runs.num_rows))
            df = np.repeat(np.add.reduceat(runs.column("df").to_numpy(), at), size)
            ends = np.repeat(np.arange(len(at)) > 0, size) if first else np.ones(len(df), bool)
            ends &= whole
            take = pa.array(np.flatnonzero(~ends | (df >= MIN_DOCS)))
            df = pa.array(np.where(ends, df, runs.column("df").to_numpy()))
            return pa.RecordBatch.from_arrays([c.take(take) for c in (*runs.columns[:2], df, runs.column("n"), pa.array(ends))], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = summed(batch)
            if held is not None:
                rows = summed(pa.Table.from_batches([held, rows]).combine_chunks().to_batches()[0])
            last = int(changes(rows, names[:1])[-1])
            if last:
                yield closed(rows.slice(0, last), True)
                first = False
            held = rows.slice(last)
        if held is not None:  # the last term may go on in the next range
            yield closed(held, False)

    order = ["key", "source", "doc"]
    ranges = counted.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "source", "df", "n")
    runs = ranges.mapInArrow(run, "key string, source string, df long, n long, whole boolean")
    term = F.substring_index("key", "\0", -1)
    return runs.select(F.substring("key", F.lit(1), F.length("key") - F.length(term) - 1).alias("lang"), term.alias("term"), "source", "df", "n", "whole")


def kept_terms(docs: DataFrame) -> DataFrame:
    """``lang, term, source, n`` of the terms in at least ``MIN_DOCS`` documents of their language; a row of ``docs`` is a document."""
    counted = materialize(_counted(docs), "counted")
    runs = materialize(_scanned(counted), "runs")
    discard(counted)
    # at most two terms of each range are partial
    partial = runs.where("not whole").groupBy("lang", "term", "source").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))
    enough = partial.groupBy("lang", "term").agg(F.sum("df").alias("df")).where(F.col("df") >= MIN_DOCS).select("lang", "term")
    return materialize(runs.where("whole").select("lang", "term", "source", "n").union(partial.join(enough, ["lang", "term"]).select("lang", "term", "source", "n")), "kept")


def share(count: Column, total: Column, n_terms: Column) -> Column:
    """``1 + floor(UNIT * (count + ADDED) / (total + ADDED * n_terms))``, exactly."""
    wide = lambda x: x.cast("decimal(27,0)")
    above = (wide(count) + F.lit(ADDED)) * F.lit(UNIT).cast("decimal(10,0)")
    below = wide(total) + wide(n_terms) * F.lit(ADDED)
    return F.lit(1).cast("long") + F.call_function("div", above, below).cast("long")


def _distances(rows: DataFrame) -> DataFrame:
    """``lang, a, b, value`` with ``a < b``: partial distances of sources, from ``lang, term, place, p, others``.

    ``others`` has the share of a term that does not occur for every source of
    the language, by ``place``.
    """
    schema = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, term, empty, table, filled, sums = None, None, None, None, 0, {}

        def flush():
            """Add the table's rows to the sums of each pair of tiles."""
            for i in range(0, len(empty), TILE):
                for j in range(i, len(empty), TILE):
                    left, right = table[:filled, i : i + TILE], table[:filled, j : j + TILE]
                    part = np.stack([np.abs(left[:, [k]] - right).sum(0) for k in range(left.shape[1])])
                    sums[i, j] = sums[i, j] + part if (i, j) in sums else part

        def given():
            for (i, j), part in sums.items():
                a, b = np.indices(part.shape)
                a, b, value = a.ravel() + i, b.ravel() + j, part.ravel()
                ok = a < b
                if ok.any():
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), int(ok.sum())), pa.array(a[ok], pa.int32()), pa.array(b[ok], pa.int32()), pa.array(value[ok], pa.int64())], schema=schema)

        for batch in batches:
            others = batch.column("others")
            for k, (own, word, place, p) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("lang", "term", "place", "p")))):
                if lang != own or empty is None:
                    if empty is not None:
                        flush()
                        yield from given()
                    lang, term, sums, filled = own, None, {}, 0
                    empty = np.array(others[k].as_py(), np.int64)
                    table = np.empty((max(1, CELLS // len(empty)), len(empty)), np.int64)
                if term != word:
                    if filled == len(table):
                        flush()
                        filled = 0
                    table[filled] = empty
                    term, filled = word, filled + 1
                table[filled - 1, place] = p
        if empty is not None:
            flush()
            yield from given()

    return rows.mapInArrow(run, "lang string, a int, b int, value long")


def _with_sources(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``kept`` with its source's ``place`` and ``p``, and with ``others``; lists of sources beyond the broadcast limit are dealt by term."""
    lists = materialize(groups.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "none"))), lambda g: g["none"]).alias("others")), "lists")
    rows = kept.join(broadcast_if_small(groups).select("lang", "source", "place", "total", "n_terms"), ["lang", "source"])
    rows = rows.select("lang", "term", "source", "place", "n", share(F.col("n"), F.col("total"), F.col("n_terms")).alias("p"))
    salted = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted._scratch_path = lists._scratch_path
    return rows.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")).join(broadcast_if_small(salted), ["lang", "salt"]).drop("salt")


def source_divergence(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances of sources and the terms that each uses more than its language.

    Null text, lang and source count as empty.  A language keeps the terms in at
    least ``MIN_DOCS`` of its documents (rows).  With ``count`` occurrences of a
    kept term, ``N`` those of all kept terms and ``V`` kept terms, a group's
    share is ``1 + floor(UNIT * (count + ADDED) / (N + ADDED * V))``, in exact
    arithmetic.  Part ``pair`` has for each group (lang, source) every other
    source of the language and the sum of the absolute differences of shares
    over all kept terms, 0 if none is kept; part ``term`` the terms that occur
    in the group with a greater share than in the language, and the difference,
    up to rank ``top``.  Ranks run from 1 by value, falling, then by item in
    UTF-8.  Repeated rows count as often as they occur; an empty table gives no
    rows, a group without terms takes part with counts of 0.  Other columns are
    not read.
    """
    kept = kept_terms(docs)
    counts = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    n_terms = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("n").alias("lang_total"))
    known = docs.select(_group("lang"), _group("source")).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    groups = known.join(counts, ["lang", "source"], "left").join(n_terms, "lang", "left").select("lang", "source", place.alias("place"), zero("total"), zero("n_terms"), zero("lang_total"))
    groups = groups.withColumn("none", F.when(F.col("n_terms") > 0, share(F.lit(0), F.col("total"), F.col("n_terms"))))
    written = materialize(groups, "groups")

    rows = _with_sources(kept, written)
    sorted_rows = rows.select("lang", "term", "place", "p", "others").repartition("lang", "term").sortWithinPartitions("lang", "term")
    sums = _distances(sorted_rows).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.union(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = written.select("lang", "source", "place")
    pairs = names.join(names.select("lang", F.col("source").alias("item"), F.col("place").alias("other")), "lang").where(F.col("place") != F.col("other"))
    pairs = pairs.join(both.select("lang", F.col("a").alias("place"), F.col("b").alias("other"), "value"), ["lang", "place", "other"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))

    whole = broadcast_if_small(written)
    own = kept.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    used = kept.join(own, ["lang", "term"]).join(whole, ["lang", "source"])
    more = share(F.col("n"), F.col("total"), F.col("n_terms")) - share(F.col("lang_n"), F.col("lang_total"), F.col("n_terms"))
    used = used.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), more.alias("value")).where("value > 0")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    return pairs.select("*", rank).unionByName(used.select("*", rank).where(F.col("rank") <= top))
