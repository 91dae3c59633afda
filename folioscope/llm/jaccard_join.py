"""N-gram Jaccard join with signature trees.

1. Every text becomes a set of hashed word shingles; equal sets form a class.
2. Blocking without loss: the hash space is cut into so many ranges that two
   linked sets agree on at least one non-empty range (their symmetric
   difference is too small to touch all).  Classes that share a range's
   content are joined into coarse components.
3. Within a coarse component a signature tree is built over its sets: nodes
   hold OR- and AND-combined bitmaps and size ranges.  A dual traversal prunes
   node pairs by the greatest overlap they can reach; leaf pairs that are not
   yet connected are compared exactly.
4. Large components are cut into chunks of sets of like size: each chunk is
   joined on its own, chunk leaders are joined next, and only members outside a
   component's largest cluster are compared against the other chunks that hold
   sizes they can link with, a block of them at a time, tiles of several chunks
   at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, connected_components, is_small, join_hot, map_rows, materialize, releasing, utf8

#: Sets of one coarse component that one task joins at once.
CHUNK = 512
#: Chunks that are compared with others together, and the bytes of sets they may have: each set is sent once for each tile.
TILE_CHUNKS = 3
TILE_BYTES = 16 << 20
#: Across chunks about so many bytes of sets are sent at most at a time; what one round has shuffled goes before the next.
ROUND_BYTES = 2 << 30
#: Bits of a signature.
BITS = 2048
LEAF, FANOUT = 8, 8

#: Texts whose shingles are counted for the blocking hint, the count that makes a shingle frequent, and how many are kept.
SAMPLE_DOCS = 10_000
FREQUENT = 3
FREQUENT_KEPT = 400_000

#: Block keys that a task holds at once, the parts that their range is cut into, and the low bytes of a key that go on:
#: within a part they tell keys apart (sets that meet by chance are compared, no more).
HELD_KEYS = 1 << 20
PARTS = 4096
KEY_BYTES = 5

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(blob: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; of the whole sequence if there are fewer words."""
    import xxhash

    words = blob.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(k, len(words))
    acc = np.full(len(h) - width + 1, np.uint64(width))
    for j in range(width):
        acc = _mix(acc * _ODD + h[j : len(h) - width + 1 + j])
    return np.unique(acc)


class Blocking:
    """Size bands and ranges for a similarity of at least ``percent`` in a hundred.

    ``common`` holds hashes of shingles known to be frequent.  Which ones it
    holds changes how many unlinked sets share a block, never whether linked
    sets do.
    """

    def __init__(self, percent: int, common: np.ndarray | None = None):
        self.percent = percent
        self.common = np.zeros(0, np.uint64) if common is None else np.sort(common)
        self.lows = [1]

    def distance(self, a: int, b: int) -> int:
        """The greatest symmetric difference of linked sets of these sizes."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def band(self, size: int) -> int:
        """A band is so wide that sets of linked sizes are in the same or in adjacent bands."""
        while self.lows[-1] <= size:
            self.lows.append(self.lows[-1] * 10_000 // self.percent**2 + 1)
        return int(np.searchsorted(self.lows, size, "right")) - 1

    def ranges(self, band: int) -> tuple[int, int]:
        """Ranges for pairs whose smaller set is in ``band``, and how many a linked pair can differ in."""
        while len(self.lows) <= band + 1:
            self.band(self.lows[-1])
        top = self.lows[band + 1] - 1
        d = self.distance(top, top * 100 // self.percent)
        return (d + 3 + d // 7 if d else 1), d

    def keys(self, s: np.ndarray) -> np.ndarray:
        """Block keys of a sorted set.  Sets that can only link with equal ones need none."""
        out = []
        own = self.band(len(s))
        value = _mix(s)
        high = s >> np.uint64(32)
        rare = np.ones(len(s), bool)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, s), len(self.common) - 1)
            rare = self.common[at] != s
        bands = [own]
        if own and -(-len(s) * self.percent // 100) < self.lows[own]:
            bands.append(own - 1)
        for band in bands:
            m, d = self.ranges(band)
            if not d:
                continue
            part = (high * np.uint64(m)) >> np.uint64(32)
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            tag = np.uint64(band) << np.uint64(32)
            key = _mix(np.add.reduceat(value, first) * _ODD + _mix(part[first] + tag + np.uint64(1)))
            telling = np.logical_or.reduceat(rare, first)
            out.append(key[telling])
            # A linked pair agrees on m - d ranges at least.  If either set has fewer that are empty or
            # hold frequent shingles only, it agrees on a telling one.  Two sets that both have as many
            # meet by their other ranges and by their prefixes, in blocks of such sets alone.
            if m - int(telling.sum()) >= m - d:
                prefix = len(s) - -(-len(s) * self.percent // 100) + 1
                out.append(_mix(key[~telling] + np.uint64(3)))
                if m - len(first) >= m - d:
                    out.append(_mix(s[:prefix] * _ODD + _mix(np.array([tag], np.uint64))[0]))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def frequent_shingles(docs: DataFrame, k: int) -> np.ndarray:
    """Shingles of at least ``FREQUENT`` texts of a sample of about ``SAMPLE_DOCS``, ``FREQUENT_KEPT`` at most.

    Only a hint for :class:`Blocking`: links don't depend on it.
    """
    n = docs.count()
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, n // SAMPLE_DOCS))) == 0)

    @releasing
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                got = [shingle_set(blob, k) for blob in batch.column(0).slice(start, 256).to_pylist()]
                yield pa.record_batch([pa.array(np.concatenate(got).view(np.int64))], names=["s"])

    counts = sample.select(utf8("text").alias("text")).mapInArrow(run, "s long").groupBy("s").count()
    top = counts.where(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "s").limit(FREQUENT_KEPT).select("s").toArrow()
    return top.column(0).to_numpy().astype(np.int64).view(np.uint64)


def _digests(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, n, d1, d2``: set size and a 128-bit digest of the set (null without shingles)."""

    def make():
        import xxhash

        def step(rows):
            n, d1, d2 = [], [], []
            for blob in rows["text"]:
                s = shingle_set(blob, k)
                raw = xxhash.xxh3_128_intdigest(s.tobytes())
                n.append(len(s))
                d1.append((raw & (1 << 63) - 1) if len(s) else None)
                d2.append((raw >> 64 & (1 << 63) - 1) if len(s) else None)
            return {"doc_id": rows["doc_id"], "n": n, "d1": d1, "d2": d2}

        return step

    return map_rows(docs.select("doc_id", utf8("text").alias("text")), "doc_id long, n long, d1 long, d2 long", make)


def _by_key(key: np.ndarray, d1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, the least set of each, and the edges (``d1, m``) from its other sets to that one."""
    order = np.argsort(key)
    key, d1 = key[order], d1[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    least = np.minimum.reduceat(d1, first)
    to = np.repeat(least, np.diff(np.r_[first, len(key)]))
    other = d1 != to
    return key[first], least, np.unique(np.stack([d1[other], to[other]], axis=1), axis=0)


def _packed(rows: list[tuple[int, bool, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows of ``part, linked, a, b``, a few hundred a batch."""
    for at in range(0, len(rows), 512):
        part, linked, a, b = zip(*rows[at : at + 512])
        yield pa.record_batch(
            [pa.array(part, pa.int32()), pa.array(linked, pa.bool_()), pa.array([x.tobytes() for x in a], pa.binary()), pa.array([x.tobytes() for x in b], pa.binary())],
            names=["part", "linked", "a", "b"],
        )


def _block_keys(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``part, linked, a, b``: block keys and their sets ``d1``, packed by parts of the keys' range, or edges (``linked``).

    Sets seen just before in the same task are skipped.  Of ``HELD_KEYS`` keys
    at a time, sets that share one are linked in place and only the least goes
    on, so a key that all sets share goes on once for so many keys.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, k))

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        blocking, seen = Blocking(percent, shared.value), set()
        keys, ids, held = [], [], 0

        def flush():
            key, least, edges = _by_key(np.concatenate(keys), np.concatenate(ids))
            part = ((key >> np.uint64(32)) * np.uint64(PARTS) >> np.uint64(32)).astype(np.int64)
            low = np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES])
            cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            rows = [(int(part[i]), False, low[i:j], least[i:j]) for i, j in zip(cut, [*cut[1:], len(part)])]
            # edges go anywhere, a few thousand together
            rows += [((int(edges[0, 0]) + n) % PARTS, True, edges[i : i + 4096, 0], edges[i : i + 4096, 1]) for n, i in enumerate(range(0, len(edges), 4096))]
            return _packed(rows)

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for blob in batch.column(0).slice(start, 256).to_pylist():
                    s = shingle_set(blob, k)
                    if not len(s):
                        continue
                    d1 = xxhash.xxh3_128_intdigest(s.tobytes()) & (1 << 63) - 1
                    if d1 in seen:
                        continue
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(d1)
                    own = blocking.keys(s)
                    keys.append(own)
                    ids.append(np.full(len(own), d1, np.int64))
                    held += len(own)
                if held >= HELD_KEYS:
                    yield from flush()
                    keys, ids, held = [], [], 0
        if held:
            yield from flush()

    return docs.select(utf8("text").alias("text")).mapInArrow(run, "part int, linked boolean, a binary, b binary")


def _block_edges(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``d1, m``: edges that connect all sets with a common block key.  Keys are shuffled once, packed, and stored nowhere."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, part = [], [], None

        def flush():
            raw = np.concatenate(keys)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, :KEY_BYTES] = raw
            return _by_key(wide.view("<u8").ravel(), np.concatenate(ids))[2]

        def made(edges):
            return pa.record_batch([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["d1", "m"])

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                for own, linked, a, b in zip(*(rows.column(c).to_pylist() for c in range(4))):
                    b = np.frombuffer(b, np.int64)
                    if linked:
                        yield made(np.stack([np.frombuffer(a, np.int64), b], axis=1))
                        continue
                    if own != part and keys:
                        yield made(flush())
                        keys, ids = [], []
                    part = own
                    keys.append(np.frombuffer(a, np.uint8).reshape(-1, KEY_BYTES))
                    ids.append(b)
        if keys:
            yield made(flush())

    dealt = _block_keys(docs, k, percent).repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "d1 long, m long").distinct()


class SignatureTree:
    """Sets in size order under nodes that hold bitmaps (OR, AND) and size ranges; level 0 are single sets."""

    def __init__(self, sets: list[np.ndarray]):
        n = len(sets)
        bits = np.zeros((n, BITS), bool)
        for i, s in enumerate(sets):
            bits[i, (s & np.uint64(BITS - 1)).astype(np.int64)] = True
        union = np.packbits(bits, axis=1)
        union = union.view(np.uint64)
        size = np.array([len(s) for s in sets], np.int64)
        self.levels = [(union, union, size, size)]
        self.width = [1]
        while len(self.levels[-1][0]) > 1:
            u, a, lo, hi = self.levels[-1]
            fan = LEAF if len(self.levels) == 1 else FANOUT
            at = np.arange(0, len(u), fan)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(u, at),
                    np.bitwise_and.reduceat(a, at),
                    np.minimum.reduceat(lo, at),
                    np.maximum.reduceat(hi, at),
                )
            )
            self.width.append(fan)

    def pairs(self, percent: int, connected) -> Iterator[tuple[int, int]]:
        """Pairs of sets (i <= j) that survive the bounds, best level by level; ``connected(i, j)`` may skip some."""
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, i, j = stack.pop()
            u, a, lo, hi = self.levels[level]
            # the sizes alone, then the bits that one side always has and the other never
            far = (lo[j] * 100 > 0) & (hi[i] * 100 < lo[j] * percent) | (hi[j] * 100 < lo[i] * percent)
            i, j = i[~far], j[~far]
            miss_i = np.bitwise_count(a[i] & ~u[j]).sum(1, dtype=np.int64)
            miss_j = np.bitwise_count(a[j] & ~u[i]).sum(1, dtype=np.int64)
            most = np.minimum(hi[i] - miss_i, hi[j] - miss_j)
            need = (lo[i] + lo[j]) * percent  # (100 + percent) * overlap must reach percent * (sizes)
            good = (100 + percent) * most >= need
            i, j = i[good], j[good]
            if level == 0:
                for x, y in zip(i.tolist(), j.tolist()):
                    if x != y:
                        yield x, y
                continue
            fan = self.width[level]
            below = len(self.levels[level - 1][0])
            step = np.arange(fan)
            ci = (i[:, None] * fan + step)[:, :, None] + np.zeros(fan, np.int64)
            cj = (j[:, None] * fan + step)[:, None, :] + np.zeros(fan, np.int64)[:, None]
            ci, cj = ci.ravel(), cj.ravel()
            ok = (ci < below) & (cj < below) & (ci <= cj)
            ci, cj = ci[ok], cj[ok]
            if level == 1:
                loose = ~connected(ci, cj)
                ci, cj = ci[loose], cj[loose]
            for at in range(0, len(ci), 4096):
                stack.append((level - 1, ci[at : at + 4096], cj[at : at + 4096]))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def link(sets: list[np.ndarray], percent: int, group: list[int] | None = None, probe: list[bool] | None = None) -> list[int]:
    """Label of every set: the least index it is connected with by links (and by equal ``group``).

    With ``probe``, only pairs of a probe and a set that is none are compared.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    root = np.arange(len(sets))

    def join(x: int, y: int) -> None:
        a, b = sorted((root[x], root[y]))
        if a != b:
            root[root == b] = a

    if group is not None:
        first: dict[int, int] = {}
        for i, g in enumerate(group):
            join(i, first.setdefault(g, i))
    place = np.array(order)
    role = np.array(probe, bool)[place] if probe is not None else None

    def connected(i, j):
        same = root[place[i]] == root[place[j]]
        return same if role is None else same | (role[i] == role[j])

    for i, j in SignatureTree([sets[p] for p in order]).pairs(percent, connected):
        x, y = order[i], order[j]
        if root[x] != root[y]:
            a, b = len(sets[x]), len(sets[y])
            if (100 + percent) * overlap(sets[x], sets[y]) >= percent * (a + b):
                join(x, y)
    return root.tolist()


def _joined(sets: DataFrame, percent: int) -> DataFrame:
    """``comp, chunk, rep, root``: the least representative each set reaches within its (comp, chunk, block) group.

    ``sets(comp, chunk, block, rep, cluster, probe, s)``; a group is streamed
    from its sorted partition and holds about ``CHUNK`` sets, or a tile of them and as many probes.
    """

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = {}, None

        def flush():
            order = sorted(held)
            reps = [rep for rep, _ in order]
            values = [held[x] for x in order]
            probes = [v[1] for v in values]
            root = link(
                [np.frombuffer(v[2], np.uint64) for v in values],
                percent,
                [v[0] for v in values],
                probes if any(probes) else None,
            )
            n = len(values)
            return pa.record_batch(
                [
                    pa.array([group[0]] * n, pa.int64()),
                    pa.array([group[1]] * n, pa.int64()),
                    pa.array(reps, pa.int64()),
                    pa.array([reps[r] for r in root], pa.int64()),
                ],
                names=["comp", "chunk", "rep", "root"],
            )

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256).to_pydict()
                for comp, chunk, block, rep, cluster, probe, s in zip(*(rows[c] for c in ("comp", "chunk", "block", "rep", "cluster", "probe", "s"))):
                    if group != (comp, chunk, block):
                        if held:
                            yield flush()
                        held, group = {}, (comp, chunk, block)
                    held.setdefault((rep, probe), (cluster, probe, s))
        if held:
            yield flush()

    dealt = sets.repartition("comp", "chunk", "block").sortWithinPartitions("comp", "chunk", "block", "rep", "probe")
    return dealt.select("comp", "chunk", "block", "rep", "cluster", "probe", "s").mapInArrow(
        run, "comp long, chunk long, rep long, root long"
    )


#: Bits for each row that a map of ids has, and for all at most.
MAP_BITS, MOST_BITS = 16, 1 << 26


def _likely(docs: DataFrame, side: DataFrame) -> DataFrame:
    """``docs`` without most of those whose ``doc_id`` is not in ``side``: a map of hashed ids goes to the texts."""
    spark = docs.sparkSession
    size = min(MOST_BITS, 1 << max(10, (MAP_BITS * side.count()).bit_length()))
    at = F.pmod(F.xxhash64("doc_id"), F.lit(size))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    found = side.select(F.shiftright(at, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(size // 64, np.int64)
    words[found.column(0).to_numpy()] = found.column(1).to_numpy()
    bits = spark.createDataFrame(pa.table({"bits": pa.array([words], pa.list_(pa.int64()))}))
    return docs.join(F.broadcast(bits), F.get("bits", F.shiftright(at, 6).cast("int")).bitwiseAND(bit) != 0, "left_semi")


def _fetch(docs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """``members`` with their shingle sets ``s``, from the texts of their representatives."""
    side = materialize(members.withColumnRenamed("rep", "doc_id"), "asked")
    columns = [c for c in side.columns if c not in ("doc_id", "s")]
    kinds = dict(side.dtypes)
    texts = docs.select("doc_id", utf8("text").alias("text"))
    if not is_small(side):
        texts = _likely(texts, side)
    picked = texts.join(broadcast_if_small(side), "doc_id")

    def make():
        import xxhash

        def step(rows):
            s = [shingle_set(blob, k) for blob in rows["text"]]
            # another row of the same id may have another text
            mine = [i for i, x in enumerate(s) if xxhash.xxh3_128_intdigest(x.tobytes()) & (1 << 63) - 1 == rows["d1"][i]]
            out = {c: [rows[c][i] for i in mine] for c in columns}
            return out | {"rep": [rows["doc_id"][i] for i in mine], "s": [s[i].tobytes() for i in mine]}

        return step

    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", rep long, s binary"
    return map_rows(picked.select("doc_id", "text", *columns), schema, make, chunk=128)


#: A chunk's number within its band takes so many bits.
CHUNK_BITS = 32


def _deal(rows: DataFrame, seed: int) -> DataFrame:
    """``rows(comp, band, rep, ...)`` with ``chunk``, one of the band's by hash, and ``chunks``, how many the component has."""
    counts = rows.groupBy("comp", "band").agg(F.count("*").alias("size")).withColumn("cut", F.ceil(F.col("size") / CHUNK))
    whole = counts.groupBy("comp").agg(F.sum("cut").alias("chunks"))
    bands = materialize(counts.join(whole, "comp"), "bands")
    dealt = join_hot(rows, bands, ["comp", "band"], "size", rows.count())
    number = F.pmod(F.xxhash64("rep", F.lit(seed)), F.col("cut")).cast("long")
    return dealt.withColumn("chunk", F.shiftleft(F.col("band").cast("long"), CHUNK_BITS) + number).drop("cut")


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs(doc_id, text)``.

    A-Z are lower-cased, words are runs between ASCII white space, the set is
    that of the distinct k-word shingles (of the whole sequence if there are
    fewer words).  Sets link when ``100 * intersection >= percent * union``;
    ``component_id`` is the least ``doc_id`` that links reach.  Null and empty
    texts have no shingles, link with nothing and are their own component.
    Rows with a null id get a null component and lend nothing to others.
    Repeated rows each give a row.  Other columns are not carried.
    """
    docs = docs.select("doc_id", "text")
    base = materialize(_digests(docs, k), "sets")
    edges = materialize(_block_edges(docs.where("doc_id is not null"), k, percent), "edges")
    coarse = connected_components(edges, "d1", "m").select(F.col("node").alias("d1"), F.col("component").alias("comp"))
    classes = base.where("d1 is not null and doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"))
    blocking = Blocking(percent)
    blocking.band(base.agg(F.max("n")).first()[0] or 1)
    band = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in blocking.lows]), lambda x: x <= F.col("n"))) - 1
    members = materialize(classes.join(coarse, "d1").select("comp", "rep", "d1", band.alias("band")), "members")
    chunked = materialize(
        _deal(members, 0).select("*", F.col("rep").alias("cluster"), F.lit(False).alias("probe"), F.lit(0).alias("block")), "chunks"
    )
    local = materialize(_joined(_fetch(docs, chunked, k), percent), "links")
    labels = local.select("rep", F.col("root").alias("component"))
    if not chunked.where("chunks > 1").isEmpty():
        labels = _across_chunks(docs, chunked, local, k, percent, blocking.lows)
    named = classes.drop("n").join(labels, "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("component"))
    return base.join(named, ["d1", "d2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def _across_chunks(docs: DataFrame, chunked: DataFrame, local: DataFrame, k: int, percent: int, lows: list[int]) -> DataFrame:
    """``rep, component`` once chunks of the same coarse component are joined too."""
    large = chunked.where("chunks > 1").drop("cluster")
    clustered = large.join(local.select("rep", F.col("root").alias("cluster")), "rep")
    # leaders first: one set for each cluster of each chunk
    leaders = materialize(clustered.where("rep = cluster").drop("chunk", "chunks"), "leaders")
    found = _joined(_fetch(docs, _deal(leaders, 1), k), percent).select("rep", "root")
    edges = materialize(local.select("rep", "root").union(found).where("rep <> root"), "edges")
    merged = connected_components(edges, "rep", "root")
    clustered = materialize(
        clustered.drop("cluster").join(merged.select(F.col("node").alias("rep"), F.col("component").alias("cluster")), "rep", "left")
        .withColumn("cluster", F.coalesce("cluster", "rep")),
        "clusters",
    )
    # what is outside a component's largest cluster is compared with the other chunks of its own and the next bands
    counts = clustered.groupBy("comp", "cluster").count()
    largest = counts.groupBy("comp").agg(
        F.max_by("cluster", F.struct("count", "cluster")).alias("main"), F.count("*").alias("clusters"), F.sum("count").alias("size")
    )
    split = materialize(largest.where("clusters > 1").drop("clusters"), "split")
    if not split.isEmpty():
        open_rows = materialize(join_hot(clustered, split, ["comp"], "size", clustered.count()), "open")
        # chunks are put together to tiles
        wides = F.array(*[F.lit(max(1, min(TILE_CHUNKS, TILE_BYTES // (8 * CHUNK * x)))) for x in [*lows[1:], lows[-1]]])
        wide = lambda at: F.get(wides, at)
        number = F.col("chunk").bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
        open_rows = open_rows.withColumn("chunk", F.shiftleft(F.col("band").cast("long"), CHUNK_BITS) + F.floor(number / wide(F.col("band"))).cast("long"))
        asking = F.count_if(F.col("cluster") != F.col("main"))
        each = open_rows.groupBy("comp", "band").agg(F.max(number + 1).alias("cut"), asking.alias("asking"), F.count("*").alias("n"))
        near = lambda a, b: F.abs(a - b) <= 1
        bands = each.groupBy("comp").agg(F.sort_array(F.collect_list(F.struct("band", "cut", "asking"))).alias("bands"), F.sum("n").alias("size"))
        placed = join_hot(open_rows, materialize(bands, "bands"), ["comp"], "size", open_rows.count())
        # blocks of a band's tiles: as many as hold the sets that ask them
        total = lambda at: F.aggregate(
            F.filter("bands", lambda x: near(x["band"], at)), F.lit(0).cast("long"), lambda a, x: a + x["asking"]
        )
        blocks = lambda at: F.greatest(F.ceil(total(at) / (CHUNK * wide(at))), F.lit(1)).cast("int")
        asked = F.filter("bands", lambda x: near(x["band"], F.col("band")))
        chunks = F.flatten(
            F.transform(
                asked,
                lambda x: F.transform(
                    F.sequence(F.lit(0).cast("long"), x["cut"] - 1),
                    lambda i: F.struct(
                        (F.shiftleft(x["band"].cast("long"), CHUNK_BITS) + i).alias("to"),
                        F.pmod(F.xxhash64(F.col("rep"), F.lit(2)), blocks(x["band"])).cast("int").alias("block"),
                        wide(x["band"]).alias("wide"),
                    ),
                ),
            )
        )
        slim = placed.drop("block", "probe", "main")
        probes = (
            placed.where("cluster <> main").drop("block", "probe", "main").select("*", F.inline(chunks)).where("to <> chunk or wide > 1")
            .drop("chunk", "bands", "wide").withColumnRenamed("to", "chunk").withColumn("probe", F.lit(True))
        )
        own = F.explode(F.sequence(F.lit(0), blocks(F.col("band")) - 1)).alias("block")
        sets = slim.select("*", own).drop("bands").withColumn("probe", F.lit(False))
        tops = F.array(*[F.lit(x).cast("long") for x in [*lows[1:], lows[-1]]])
        sent = sets.select("band").unionByName(probes.select("band")).agg(F.sum(8 * F.get(tops, F.col("band")))).first()[0] or 0
        rounds = -(-sent // ROUND_BYTES)
        for i in range(rounds):  # tiles are compared in one round
            mine = F.pmod(F.xxhash64("comp", "chunk", "block"), F.lit(rounds)) == i
            more = _joined(_fetch(docs, sets.where(mine), k).unionByName(_fetch(docs, probes.where(mine), k)), percent).select("rep", "root")
            edges = edges.union(materialize(more.where("rep <> root"), "edges"))
        merged = connected_components(edges, "rep", "root")
    return local.select("rep").join(merged, F.col("rep") == F.col("node"), "left").select(
        "rep", F.coalesce("component", "rep").alias("component")
    )
