"""Substring dedup by a logarithmic family of suffix arrays.

Bytes that repeat an earlier document are found in four steps, over blocks of a
few megabytes of text:

1. Every window of ``WIDTH`` bytes is anchored at the seed (``SEED`` bytes) in
   it with the least hash.  Equal windows have equal anchors, so a window can
   only repeat if its seed does; the distinct seeds of a block are dealt into
   buckets, and those of one block alone are out.
2. The runs of windows with one anchor whose seed repeats are cut out of the
   text, each distinct one of a block once, and dealt into buckets by seed.
3. A bucket takes its runs in order of their documents, in batches.  A batch
   gets its suffix array, is merge-scanned against all levels of the index, and
   enters it as a new level; levels of like size are merged, so that there are
   logarithmically many.
4. The windows found go back to their blocks, where they are put together.

Seeds only choose what is compared; windows are compared as bytes.  A passage
that many documents share is sent once a block, not once a document.  Blocks
are stored in buckets, and what is found of a block goes to where it lies: of
whole texts nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, materialize_bucketed, releasing, slices, utf8

#: Bytes of a string that must repeat to be removed, and of the seeds in it.
WIDTH, SEED = 50, 20
#: Bytes of text in a block; a longer document is a block of its own.
BLOCK_BYTES = 2 << 20
#: Bytes of text for each bucket of seeds and of runs, and windows in a batch of the index.
SEED_BUCKET, RUN_BUCKET, BATCH = 16 << 20, 4 << 20, 1 << 16
#: Windows that are anchored at a time, which bounds memory in long documents.
CHUNK = 1 << 18

_U = np.uint64
_MIX = [_U(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_BYTES = (np.arange(1, 257, dtype=_U) * _MIX[0]) ^ ((np.arange(1, 257, dtype=_U) * _MIX[1]) >> _U(31))
#: No document ranks behind those without id.
LAST = np.iinfo(np.int64).max


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of two neighbouring strings as one."""
    out = left * _MIX[0]
    out ^= right + (right >> _U(29))
    out *= _MIX[1]
    out ^= out >> _U(32)
    return out


def seed_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``SEED`` bytes at each place, by doubling."""
    span, parts = 1, {1: _BYTES[data]}
    while span * 2 <= SEED:
        h = parts[span]
        parts[span * 2] = _joined(h[:-span], h[span:])
        span *= 2
    h = parts[span]
    rest = SEED - span  # the two parts overlap
    return _joined(h[: len(h) - rest], h[rest:]) * _MIX[2] if rest else h * _MIX[2]


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    rest = width - span
    return np.minimum(key[: len(key) - rest], key[rest:]) if rest else key


def anchored_runs(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``start, count, seed hash, document`` of the runs of windows with one anchor; none crosses a document."""
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    mask = _U((1 << (CHUNK + WIDTH).bit_length()) - 1)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, np.int32))]
    for at in range(0, len(data) - WIDTH + 1, CHUNK):
        part = data[at : at + CHUNK + WIDTH - 1]
        n = len(part) - WIDTH + 1
        hashes = seed_hashes(part)
        key = _least(hashes & ~mask | np.arange(len(hashes), dtype=_U), WIDTH - SEED + 1)
        anchor = (key & mask).astype(np.int64)
        doc = owner[at : at + n]
        whole = np.arange(at + WIDTH, at + n + WIDTH) <= ends[doc]
        new = whole.copy()
        new[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1])
        start = np.flatnonzero(new)
        before = np.append(0, np.cumsum(whole))
        count = before[np.append(start[1:], n)] - before[start] if len(start) else start
        found.append((start + at, count, hashes[anchor[start]], doc[start]))
    return tuple(np.concatenate(x) for x in zip(*found))


class IndexFamily:
    """Windows in levels of suffix arrays: distinct strings in byte order, each with its least document.

    Batches come in order of their documents.  No string is in two levels, and
    each level is more than twice as long as the next.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, windows: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Index a batch; for each of its windows the least document with it, of the batch and all before."""
        order = np.argsort(windows, kind="stable")
        ranked = windows[order]
        new = np.append(True, ranked[1:] != ranked[:-1])
        at = np.flatnonzero(new)
        strings, low = ranked[at], np.minimum.reduceat(docs[order], at)
        fresh = np.ones(len(at), bool)
        for known, least in self.levels:
            where = np.minimum(np.searchsorted(known, strings), len(known) - 1)
            same = known[where] == strings
            low[same] = np.minimum(low[same], least[where[same]])
            fresh &= ~same
        out = np.empty(len(windows), np.int64)
        out[order] = low[np.cumsum(new) - 1]
        level = strings[fresh], low[fresh]
        while self.levels and len(self.levels[-1][0]) <= 2 * len(level[0]):
            level = self._merged(self.levels.pop(), level)
        if len(level[0]):
            self.levels.append(level)
        return out

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple:
        strings = np.concatenate([a[0], b[0]])
        order = np.argsort(strings, kind="stable")  # two sorted runs, which are merged
        return strings[order], np.concatenate([a[1], b[1]])[order]


def _blocks(docs: DataFrame) -> DataFrame:
    """``block, ids, sizes, n_bytes, text``: documents in blocks, the texts one after the other, compressed."""
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("n_bytes", pa.int64()), ("text", pa.binary())])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                text = b"".join(part.column("text").to_pylist())
                rows = [[block], [part.column("doc_id").to_pylist()], [pc.binary_length(part.column("text")).to_pylist()], [len(text)], [pa.compress(text, "zstd", asbytes=True)]]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(rows, schema)], schema=schema)
                block += 1

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    return slim.mapInArrow(run, "block long, ids array<long>, sizes array<long>, n_bytes long, text binary")


def _read(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and sizes of a block."""
    data = pa.decompress(row["text"], row["n_bytes"], "zstd", asbytes=True) if row["n_bytes"] else b""
    return np.frombuffer(data, np.uint8), np.array(row["sizes"], np.int64)


def _each(df: DataFrame, schema: str, step) -> DataFrame:
    """``mapInArrow`` over rows: ``step`` gives the rows, as tuples, for a row as a dict."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                if out := list(step(batch.slice(i, 1).to_pylist()[0])):
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def _each_bucket(df: DataFrame, schema: str, step) -> DataFrame:
    """Shuffle by ``bucket`` and apply ``step`` to all rows of each."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(rows):
            if out := list(step(rows)):
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), arrow)], schema=arrow)

        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and rows[-1]["bucket"] != row["bucket"]:
                    yield from given(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield from given(rows)

    return df.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def _distinct_seeds(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct seeds in order of bucket, the buckets, and where each bucket begins (with the end)."""
    seeds = np.unique(hashes)
    bucket = (seeds & _U(0xFFFFFF)) % _U(buckets)
    order = np.argsort(bucket, kind="stable")
    seeds, bucket = seeds[order], bucket[order]
    return seeds, bucket, np.flatnonzero(np.append(np.append(True, bucket[1:] != bucket[:-1]), True)) if len(seeds) else np.zeros(1, np.int64)


def _seeds(blocks: DataFrame, buckets: int) -> DataFrame:
    """``bucket, block, seeds``: the distinct seeds of each block, 40 bits each; that many do for a bucket, since a chance hit only costs time."""

    def step(row):
        data, sizes = _read(row)
        seeds, bucket, edge = _distinct_seeds(anchored_runs(data, sizes)[2], buckets)
        packed = (seeds >> _U(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        for a, b in zip(edge[:-1], edge[1:]):
            yield int(bucket[a]), row["block"], packed[a:b].tobytes()

    return _each(blocks.select("block", "sizes", "n_bytes", "text"), "bucket long, block long, seeds binary", step)


def _repeated_seeds(seeds: DataFrame) -> DataFrame:
    """``block, bucket, shared``: which seeds of a block, in order, are in another block too."""

    def step(rows):
        sizes = [len(r["seeds"]) // 5 for r in rows]
        packed = np.zeros((sum(sizes), 8), np.uint8)
        packed[:, :5] = np.frombuffer(b"".join(r["seeds"] for r in rows), np.uint8).reshape(-1, 5)
        value = packed.view("<u8").ravel()
        order = np.argsort(value)
        same = value[order[1:]] == value[order[:-1]]
        again = np.zeros(len(value), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        for row, part in zip(rows, np.split(again, np.cumsum(sizes)[:-1])):
            if part.any():
                yield row["block"], row["bucket"], np.packbits(part).tobytes()

    return _each_bucket(seeds, "block long, bucket long, shared binary", step)


def _runs(blocks: DataFrame, seed_buckets: int, buckets: int) -> DataFrame:
    """The distinct runs of each block whose seed is in two documents, by bucket.

    ``text, sizes`` hold the runs, ``docs`` the least document of each, ``times``
    how often it occurs, ``starts, later`` the places and whether their document
    is not the least.
    """

    def step(row):
        data, sizes = _read(row)
        start, count, hashes, doc = anchored_runs(data, sizes)
        seeds, bucket, edge = _distinct_seeds(hashes, seed_buckets)
        wanted = np.zeros(len(seeds), bool)
        first = {int(bucket[a]): (a, b) for a, b in zip(edge[:-1], edge[1:])}
        for part in row["found"] or ():
            a, b = first[part["bucket"]]
            wanted[a:b] = np.unpackbits(np.frombuffer(part["shared"], np.uint8), count=b - a)
        ids = np.array([LAST if x is None else x for x in row["ids"]], np.int64)
        by_hash = np.argsort(seeds)
        code = by_hash[np.searchsorted(seeds, hashes, sorter=by_hash)] if len(seeds) else np.zeros(0, np.int64)
        least, most = np.full(len(seeds), LAST), np.full(len(seeds), np.iinfo(np.int64).min)
        np.minimum.at(least, code, ids[doc])
        np.maximum.at(most, code, ids[doc])
        wanted |= least < most
        take = np.flatnonzero(wanted[code])
        start, count, hashes, owner = start[take], count[take], hashes[take], ids[doc[take]]
        raw, known = data.tobytes(), {}
        run = np.array([known.setdefault(raw[s : s + c + WIDTH - 1], len(known)) for s, c in zip(start.tolist(), count.tolist())], np.int64)
        if not known:
            return
        low = np.full(len(known), LAST)
        np.minimum.at(low, run, owner)
        home = np.empty(len(known), np.int64)
        home[run] = (hashes >> _U(20)) % _U(buckets)
        texts, length = list(known), np.bincount(run, minlength=len(known))
        places = np.argsort(run, kind="stable")
        edge = np.append(0, np.cumsum(length))
        order = np.argsort(home, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
            at = np.concatenate([places[edge[i] : edge[i + 1]] for i in own])
            yield (
                int(home[own[0]]), row["block"], pa.compress(b"".join(texts[i] for i in own), "zstd", asbytes=True),
                np.array([len(texts[i]) for i in own], "u1").tobytes(), low[own].astype("<i8").tobytes(), length[own].astype("<u4").tobytes(),
                start[at].astype("<u4").tobytes(), (owner[at] > low[run[at]]).tobytes(),
            )

    return _each(blocks, "bucket long, block long, text binary, sizes binary, docs binary, times binary, starts binary, later binary", step)


def _least_documents(texts: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the windows of distinct runs, one run after the other, the least document of each; and where each run begins."""
    edge = np.append(0, np.cumsum([len(t) - WIDTH + 1 for t in texts]))
    out, family = np.empty(edge[-1], np.int64), IndexFamily()
    order = np.argsort(docs, kind="stable")
    done = 0
    held = np.cumsum(np.diff(edge)[order])
    while done < len(order):
        stop = max(done + 1, int(np.searchsorted(held, (held[done - 1] if done else 0) + BATCH, "right")))
        batch = order[done:stop]
        data = np.frombuffer(b"".join(texts[i] for i in batch), np.uint8)
        size = np.array([len(texts[i]) for i in batch])
        n = size - WIDTH + 1
        at = np.repeat(np.cumsum(size) - size - (np.cumsum(n) - n), n) + np.arange(n.sum())
        windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, WIDTH)[at]).view(f"S{WIDTH}").ravel()
        where = np.repeat(edge[batch] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out[where] = family.add(windows, np.repeat(docs[batch], n))
        done = stop
    return out, edge


def _repeats(runs: DataFrame) -> DataFrame:
    """``block, starts, counts``: the windows of a block that an earlier document has, as runs."""

    def step(rows):
        known: dict[bytes, int] = {}
        for r in rows:
            r["sizes"] = np.frombuffer(r["sizes"], "u1").astype(np.int64)
            blob, at, codes = pa.decompress(r["text"], int(r["sizes"].sum()), "zstd", asbytes=True), 0, []
            for n in r["sizes"].tolist():
                codes.append(known.setdefault(blob[at : at + n], len(known)))
                at += n
            r["codes"], r["docs"], r["text"] = np.array(codes), np.frombuffer(r["docs"], "<i8"), None
        low = np.full(len(known), LAST)
        for r in rows:
            np.minimum.at(low, r["codes"], r["docs"])
        least, edge = _least_documents(list(known), low)
        for r in rows:
            times = np.frombuffer(r["times"], "<u4")
            place, later = np.frombuffer(r["starts"], "<u4").astype(np.int64), np.frombuffer(r["later"], bool)
            code, doc = np.repeat(r["codes"], times), np.repeat(r["docs"], times)
            n = edge[code + 1] - edge[code]
            own = np.repeat(np.arange(len(code)), n)
            step_in = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            hit = later[own] | (least[edge[code][own] + step_in] < doc[own])
            before = np.append(False, hit[:-1]) & (step_in > 0)
            begin = np.flatnonzero(hit & ~before)
            after = np.append(hit[1:], False) & np.append(step_in[1:] > 0, False)
            end = np.flatnonzero(hit & ~after)
            if len(begin):
                yield r["block"], (place[own[begin]] + step_in[begin]).astype("<u4").tobytes(), (end - begin + 1).astype("u1").tobytes()

    return _each_bucket(runs, "block long, starts binary, counts binary", step)


def _cut(blocks: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every document."""

    def step(row):
        data, sizes = _read(row)
        change = np.zeros(len(data) + 1, np.int64)
        for part in row["found"] or ():
            start = np.frombuffer(part["starts"], "<u4").astype(np.int64)
            np.add.at(change, start, 1)
            np.add.at(change, start + np.frombuffer(part["counts"], "u1") + (WIDTH - 1), -1)
        gone = np.cumsum(change[:-1]) > 0
        stops = np.cumsum(sizes)
        starts = stops - sizes
        edge = np.zeros(len(data) + 1, bool)
        edge[starts] = True
        edge[stops] = True
        begin = np.flatnonzero(gone & (edge[:-1] | np.append(True, ~gone[:-1])))
        end = np.flatnonzero(gone & (edge[1:] | np.append(~gone[1:], True))) + 1
        kept, left = data[~gone].tobytes(), np.append(0, np.cumsum(~gone))
        a, b = np.searchsorted(begin, starts), np.searchsorted(begin, stops)
        for doc_id, s, t, i, j in zip(row["ids"], starts.tolist(), stops.tolist(), a.tolist(), b.tolist()):
            spans = [{"start": int(x) - s, "stop": int(y) - s} for x, y in zip(begin[i:j], end[i:j])]
            yield doc_id, t - s, spans, kept[left[s] : left[t]]

    return _each(blocks, "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary", step)


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: what of each text, as UTF-8, repeats a document with a smaller id.

    A byte goes if a string of ``WIDTH`` bytes around it is also in a document
    with a smaller ``doc_id``; strings are those of the texts as given, and none
    crosses documents.  ``spans`` are the maximal removed runs, in bytes and in
    order, ``kept`` the other bytes.  Rows of one id never remove each other's
    bytes; rows without id rank behind all others, and one another's are kept.
    Null and empty texts and those under ``WIDTH`` bytes stay as they are; an
    empty table gives no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    blocks = materialize_bucketed(_blocks(docs), "blocks", "block")
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    least = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    seed_buckets, buckets = max(least, total // SEED_BUCKET), max(least, total // RUN_BUCKET)
    shared = materialize(_repeated_seeds(_seeds(blocks, seed_buckets)), "seeds")
    found = shared.groupBy("block").agg(F.collect_list(F.struct("bucket", "shared")).alias("found"))
    repeats = materialize(_repeats(_runs(blocks.join(found, "block", "left"), seed_buckets, buckets)), "repeats")
    discard(shared)
    found = repeats.groupBy("block").agg(F.collect_list(F.struct("starts", "counts")).alias("found"))
    return _cut(blocks.join(found, "block", "left"))


def suffix_array_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of :func:`repeated_bytes`."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return repeated_bytes(docs).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
