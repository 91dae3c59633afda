"""Exact top-k inner products over norm-sorted vectors.

Vectors are rotated onto the singular directions of the whole table, so that a
few leading coordinates carry most of a product.  The table is cut into slices
by descending length.  The longest vectors give every query a k-th score that
is reached; a query goes only to the slices whose greatest length times its own
can reach that score, which are the first ones.  Within a slice candidates go
by in order of length, and one is left out when the partial product plus the
Cauchy-Schwarz bound of the residuals cannot reach the query's k-th score so
far.  What is left is scored in exact integers.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, releasing

#: Query vectors that a task holds at once.
QUERY_BLOCK = 8192
#: Rows of a slice's piece, which a task reads once for each block of queries.
PIECE_ROWS = 8192
#: Slices by length; more rows make longer slices, which have more pieces.
SLICES = 1024
#: Leading rotated coordinates that the first bound uses.
LEAD = 16
#: Rows with the greatest lengths, which give the queries their first k-th scores.
SEED_ROWS = 2048
#: Candidates scored at once, and the numbers that a block of rows may hold.
ROW_BLOCK, BLOCK_NUMBERS = 2048, 1 << 21
#: Vectors with more components are not rotated.
ROTATED = 512
#: Lengths from which bounds are not computed in floating point.
EXTREME = 1e100
LONG = np.iinfo(np.int64)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, x array<double>, length`` of every vector without null or non-finite components; no floor(256 x) is longer than ``length``."""
    x = F.col("embedding").cast("array<double>")
    good = F.col("vec_id").isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    )
    length = 256 * F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, c: a + c * c)) + F.sqrt(F.size("x"))
    return vectors.where(F.col("embedding").isNotNull() & good).select(
        F.col("vec_id").cast("long"), x.alias("x")
    ).withColumn("length", length)


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """floor(256 x) of the rows of a list column as float64, shorter vectors padded with zeros; the greatest double where it is beyond."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(flat * 256), np.finfo(float).min, np.finfo(float).max)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim))
    ends = np.cumsum(lengths)
    for i, (e, n) in enumerate(zip(ends, lengths)):
        out[i, :n] = flat[e - n : e]
    return out


def _split(batch: pa.RecordBatch, dim: int):
    step = max(1, min(ROW_BLOCK, BLOCK_NUMBERS // dim))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def _vectors(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return integers(pa.concat_arrays([batch.column("x")]), dim)


def rotation(rows: DataFrame, dim: int) -> np.ndarray | None:
    """Right singular vectors of the whole table, from its Gram matrix; ``None`` if it is too wide."""
    if dim > ROTATED:
        return None

    @releasing
    def gram(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            for part in _split(batch, dim):
                m = _vectors(part, dim)
                m = m[np.abs(m).max(1) < EXTREME]
                total += m.T @ m
        yield pa.record_batch([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], names=["at", "g"])

    summed = np.zeros(dim * dim)
    got = rows.select("x").mapInArrow(gram, "at long, g double").groupBy("at").agg(F.sum("g").alias("g")).toArrow()
    summed[got["at"].to_numpy()] = got["g"].to_numpy()
    if not np.isfinite(summed).all():
        return None
    return np.linalg.eigh(summed.reshape(dim, dim))[1][:, ::-1].copy()


class Side:
    """Vectors with their lengths, leading rotated coordinates and the lengths of the rest."""

    def __init__(self, v: np.ndarray, turn: np.ndarray | None):
        self.v = v
        extreme = np.abs(v).max(1, initial=0) >= EXTREME
        plain = np.where(extreme[:, None], 0, v)
        self.length = np.where(extreme, np.inf, np.sqrt((plain**2).sum(1)))
        turned = plain if turn is None else plain @ turn
        self.lead = turned[:, :LEAD]
        self.rest = np.where(extreme, np.inf, np.sqrt((turned[:, LEAD:] ** 2).sum(1)))


def products(a: np.ndarray, b: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b`` as 64-bit integers, clipped to their range; ``bound`` is at least their size."""
    out = np.zeros(len(a), np.int64)
    small, middle = bound < 2.0**52, (bound >= 2.0**52) & (bound < 2.0**62)
    out[small] = np.einsum("ij,ij->i", a[small], b[small]).astype(np.int64)
    if middle.any():
        # each component of a non-zero product is below the bound; of a zero vector the other may not be
        ints = lambda m: np.clip(m[middle], -(2.0**62), 2.0**62).astype(np.int64)
        out[middle] = np.einsum("ij,ij->i", ints(a), ints(b))
    for i in np.flatnonzero(~small & ~middle):
        total = sum(int(x) * int(y) for x, y in zip(a[i].tolist(), b[i].tolist()) if x and y)
        out[i] = max(LONG.min, min(LONG.max, total))
    return out


class TopK:
    """The k best candidates of every query of a block, kept while candidates go by.

    ``rows`` are the queries' own row numbers, which are no candidates for
    them; ``floor`` is a score that k candidates of each are known to reach.
    """

    def __init__(self, rows: np.ndarray, queries: Side, k: int, floor: np.ndarray):
        self.rows, self.q, self.k, self.floor = rows, queries, k, floor
        self.score = np.full((len(rows), k), LONG.min)
        self.vec = np.full((len(rows), k), -1)
        self.have = np.zeros(len(rows), np.int64)

    def kth(self) -> np.ndarray:
        """The score that a further candidate must reach."""
        own = np.where(self.have == self.k, self.score[:, -1].astype(float), -np.inf)
        return np.maximum(own, self.floor)

    def add(self, rows: np.ndarray, ids: np.ndarray, side: Side) -> None:
        """Candidates in any order; they are taken by descending length."""
        order = np.argsort(-side.length, kind="stable")
        longest = side.length[order]
        for start in range(0, len(self.rows), 256):
            s = np.arange(start, min(start + 256, len(self.rows)))
            with np.errstate(invalid="ignore", over="ignore"):
                need = self.kth()[s]
                need = need - 1e-7 * (1 + self.q.length[s] * longest[0]) if len(order) else need
                need[np.isnan(need)] = -np.inf
                s = s[~(self.q.length[s] * longest[:1] < need)] if len(order) else s[:0]
                need = need[s - start]
                if not len(s):
                    continue
                # the longest candidates come first: none beyond `reach` can matter to any of these queries
                least = (need / np.maximum(self.q.length[s], 1e-9)).min()
                reach = len(order) if not least > 0 else int(np.searchsorted(-longest, -least, "right"))
                c = order[:reach]
                bound = self.q.lead[s] @ side.lead[c].T + np.multiply.outer(self.q.rest[s], side.rest[c])
                qi, ci = np.nonzero(~(bound < need[:, None]))
                exact = None
                if 16 * len(qi) > bound.size and self.q.length[s].max() * longest[0] < 2.0**52:
                    # many are left: all products at once, which are whole numbers that doubles hold
                    exact = self.q.v[s] @ side.v[c].T
                    qi, ci = np.nonzero(exact >= need[:, None])
                    exact = exact[qi, ci].astype(np.int64)
            qi, ci = s[qi], c[ci]
            other = self.rows[qi] != rows[ci]
            qi, ci = qi[other], ci[other]
            if exact is not None:
                self._merge(qi, ids[ci], exact[other])
                continue
            with np.errstate(invalid="ignore", over="ignore"):
                size = self.q.length[qi] * side.length[ci]
            size[np.isnan(size)] = np.inf
            for at in range(0, len(qi), 1 << 15):
                part = slice(at, at + (1 << 15))
                self._merge(qi[part], ids[ci[part]], products(self.q.v[qi[part]], side.v[ci[part]], size[part]))

    def _merge(self, qi: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        touched = np.unique(qi)
        held = np.arange(self.k) < self.have[touched][:, None]
        q = np.r_[np.repeat(touched, self.have[touched]), qi]
        v = np.r_[self.vec[touched][held], vec]
        x = np.r_[self.score[touched][held], score]
        order = np.lexsort((v, ~x, q))  # ~x falls as x rises, without overflow
        q, v, x = q[order], v[order], x[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        best = place < self.k
        self.vec[q[best], place[best]], self.score[q[best], place[best]] = v[best], x[best]
        self.have[touched] = np.minimum(self.k, np.bincount(np.searchsorted(touched, q), minlength=len(touched)))

    def found(self) -> pa.RecordBatch:
        q, j = np.nonzero(np.arange(self.k) < self.have[:, None])
        return pa.record_batch([pa.array(self.rows[q]), pa.array(self.vec[q, j]), pa.array(self.score[q, j])], names=["q", "vec_id", "score"])


def _pack(**arrays: np.ndarray | None) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{k: v for k, v in arrays.items() if v is not None})
    return out.getvalue()


def _floors(queries: DataFrame, shared, dim: int, k: int) -> DataFrame:
    """``queries`` with ``floor``: the k-th score over the longest vectors of the table, negative infinity if they are too few."""

    @releasing
    def run(batches):
        box = np.load(io.BytesIO(shared.value))
        turn = box["turn"] if "turn" in box else None
        seeds = Side(box["v"], turn)
        for batch in batches:
            for part in _split(batch, dim):
                rows = part.column("row").to_numpy()
                best = TopK(rows, Side(_vectors(part, dim), turn), k, np.full(len(rows), -np.inf))
                best.add(box["rows"], box["ids"], seeds)
                names = ["row", "vec_id", "x", "length"]
                yield pa.record_batch([*(part.column(c) for c in names), pa.array(best.kth())], names=[*names, "floor"])

    return queries.select("row", "vec_id", "x", "length").mapInArrow(
        run, "row long, vec_id long, x array<double>, length double, floor double"
    )


def _search(dealt: DataFrame, shared, dim: int, k: int) -> DataFrame:
    """``q, vec_id, score``: the k best candidates of each query within each task of ``dealt``.

    A task's rows come as queries, then candidates by descending length, and
    are streamed.
    """

    @releasing
    def run(batches):
        box = np.load(io.BytesIO(shared.value))
        turn = box["turn"] if "turn" in box else None
        key, best, waiting = None, None, []

        def flush():
            if best is not None and len(best.rows):
                yield best.found()

        def begin():
            nonlocal best, waiting
            if best is None:
                rows, v, floor = (np.concatenate(x) for x in zip(*waiting)) if waiting else (np.zeros(0, np.int64), np.zeros((0, dim)), np.zeros(0))
                best, waiting = TopK(rows, Side(v, turn), k, floor), []

        for batch in batches:
            for part in _split(batch, dim):
                keys = np.stack([part.column(c).to_numpy() for c in ("slice", "piece", "block", "candidate")], 1)
                cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
                for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(keys)]):
                    here, run_ = tuple(keys[a, :3]), part.slice(a, b - a)
                    if here != key:
                        if key is not None:
                            begin()
                            yield from flush()
                        key, best, waiting = here, None, []
                    if keys[a, 3]:
                        begin()
                        if len(best.rows):
                            best.add(run_.column("row").to_numpy(), run_.column("vec_id").to_numpy(), Side(_vectors(run_, dim), turn))
                    else:
                        waiting.append((run_.column("row").to_numpy(), _vectors(run_, dim), run_.column("floor").to_numpy()))
        yield from flush()

    return dealt.mapInArrow(run, "q long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k greatest integer products of every query row over all other rows.

    ``vectors(vec_id, embedding)``; components become floor(256 x), x as
    double.  Rows whose id or vector is null, and those with a null or
    non-finite component, take no part.  Shorter vectors, empty ones too, are
    padded with zeros.  Ties go to the smaller ``vec_id``.  Rows that repeat
    an id are rows like any other: each is a candidate for the others, and each
    that is a query has a list of its own.  Scores beyond 64 bits are clipped to
    their range before they are ranked.  Fewer than k candidates give fewer
    rows; other columns are not carried.

    The vectors are written once to the shared folder, with a number for each
    row.  Queries are dealt to the pieces of the slices that they can need, in
    blocks, and a piece is read once for each block.
    """
    spark = vectors.sparkSession
    rows = usable(vectors).withColumn("query", F.coalesce(is_query, F.lit(False)))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    dim, n, n_queries = rows.agg(F.max(F.size("x")), F.count("*"), F.count_if("query")).first()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = max(dim, 1)
    turn = rotation(rows, dim)
    seeds = rows.orderBy(F.desc("length"), "row").limit(max(k + 1, min(SEED_ROWS, BLOCK_NUMBERS // dim))).select("row", "vec_id", "x").toArrow()
    shared = spark.sparkContext.broadcast(
        _pack(rows=seeds["row"].to_numpy(), ids=seeds["vec_id"].to_numpy(), v=integers(pa.concat_arrays(seeds["x"].chunks), dim), turn=turn)
    )
    # slices by falling length: their lower bounds, how many rows each holds, and its greatest length
    n_slices = min(SLICES, -(-n // PIECE_ROWS))
    cuts = []
    if n_slices > 1:
        at = [1 - (i + 1) / n_slices for i in range(n_slices - 1)]
        cuts = sorted(set(rows.agg(F.percentile_approx("length", at, 10_000)).first()[0]), reverse=True)
    # the rows of slice i are those shorter than i of the cuts
    number = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: F.col("length") < c)) if cuts else F.lit(0)
    rows = rows.withColumn("slice", number)
    held = {r["slice"]: r for r in rows.groupBy("slice").agg(F.count("*").alias("n"), F.max("length").alias("top")).collect()}
    order = sorted(held)
    pieces = {s: -(-held[s]["n"] // PIECE_ROWS) for s in order}
    asked = materialize(_floors(rows.where("query"), shared, dim, k), "queries")
    # a query needs the slices whose greatest length can reach its floor, which are the first ones
    least = F.col("floor") - 1e-6 * (1 + F.abs("floor"))
    tops = F.array(*[F.lit(float(held[s]["top"])) for s in order])
    reach = F.when(least <= 0, len(order)).otherwise(F.greatest(F.lit(1), F.size(F.filter(tops, lambda t: ~(t * F.col("length") * (1 + 1e-9) < least)))))
    asked = asked.withColumn("reach", reach)
    wanted = {r["reach"]: r["count"] for r in asked.groupBy("reach").count().collect()}
    per_block = max(1, min(QUERY_BLOCK, BLOCK_NUMBERS // dim))
    blocks = {s: -(-sum(c for need, c in wanted.items() if need > i) // per_block) for i, s in enumerate(order)}
    plan = spark.createDataFrame([(s, i, pieces[s], blocks[s]) for i, s in enumerate(order) if blocks[s]], "slice int, place int, pieces int, blocks int")
    up_to = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    mine = lambda c, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.col(c)).cast("int")
    queries = asked.withColumn("place", up_to("reach")).join(F.broadcast(plan), "place").withColumn("piece", up_to("pieces"))
    candidates = rows.join(F.broadcast(plan), "slice").withColumn("block", up_to("blocks"))
    columns = ("slice", "piece", "block", "candidate", "row", "vec_id", "x", "length", "floor")
    both = queries.withColumn("block", mine("blocks", 1)).withColumn("candidate", F.lit(0)).select(*columns).union(
        candidates.withColumn("piece", mine("pieces", 2)).withColumn("candidate", F.lit(1)).withColumn("floor", F.lit(None).cast("double")).select(*columns)
    )
    dealt = both.repartition("slice", "piece", "block").sortWithinPartitions("slice", "piece", "block", "candidate", F.desc("length"))
    found = _search(dealt, shared, dim, k)
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    ids = asked.select(F.col("row").alias("q"), F.col("vec_id").alias("query_id"))
    return ranked.join(ids, "q").select("query_id", F.col("rank").cast("int"), "vec_id", "score")
