"""Mixture-controlled packing: deficit round-robin over source queues.

In every window each queue's deficit grows by its target share of the window;
the queue gives the whole tokens of its deficit, the places left over go to the
greatest remainders, and what is owed beyond that, or was given early, is
carried to the next window.  Shares of queues that have run dry fall to the
others.  A queue's deficit before a window is its share of all tokens so far
less what it gave, so what each queue has given before any window can be
computed on its own: partitions take over exactly the deficits that the
partition before them leaves.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, releasing, slices, utf8

WINDOW = 2048
#: Tokens a window from which a source has a queue of its own; rarer ones share one, dealt among them by a second round-robin.
LEAST_QUANTUM = 1.5
#: Tokens of a queue's part, which one task lays out, and how many parts there are before they grow with the input.
PART_TOKENS, MAX_PARTS = 1 << 20, 100_000
#: Id that ends every document.
END_ID = 1
#: Bytes of text that a task encodes at once (a longer text on its own).
SLICE_BYTES = 4 << 20


def given(totals: np.ndarray, weights: np.ndarray, goals: np.ndarray) -> np.ndarray:
    """Tokens that each queue has given once ``goals`` tokens are: ``len(goals)`` x ``len(totals)`` integers.

    Queue ``s`` is owed ``min(totals[s], weights[s] * v)`` at the point ``v`` at
    which all together are owed the goal.  It gives the whole part, and the
    tokens then missing come from the greatest remainders (of equal ones, the
    first queue's).  ``weights`` are positive where ``totals`` are.
    """
    totals, goals = np.asarray(totals, np.int64), np.asarray(goals, np.int64)
    weights = np.asarray(weights, np.float64)
    live = totals > 0
    dry = np.where(live, totals / np.where(live, weights, 1), 0.0)
    order = np.argsort(dry, kind="stable")
    gone = np.r_[0, np.cumsum(totals[order])]  # tokens of the queues that are dry
    left = np.r_[np.cumsum((weights * live)[order][::-1])[::-1], 0]  # weights of the others
    ends = gone[:-1] + left[:-1] * dry[order]  # tokens given when each queue runs dry
    ends = np.maximum.accumulate(ends)
    e = np.minimum(np.searchsorted(ends, goals, "left"), len(totals) - 1)
    v = (goals - gone[e]) / np.where(left[e] > 0, left[e], 1)
    owed = np.minimum(totals, weights * live * v[:, None])
    owed[goals >= totals.sum()] = totals
    count = np.floor(owed + 1e-9).astype(np.int64)
    short = np.minimum(goals, totals.sum()) - count.sum(1)
    for i in np.flatnonzero(short < 0):  # sums of rounded weights
        for s in np.argsort(np.where(count[i] > 0, owed[i] - count[i], np.inf), kind="stable")[: -short[i]]:
            count[i, s] -= 1
            short[i] += 1
    rest = np.where(count < totals, np.round(owed - count, 6), -np.inf)
    place = np.empty_like(count)
    np.put_along_axis(place, np.argsort(-rest, 1, kind="stable"), np.arange(len(totals))[None, :], 1)
    count += place < short[:, None]
    if (count.sum(1) != np.minimum(goals, totals.sum())).any() or (count > totals).any():
        raise ArithmeticError("the queues' shares do not add up")
    return count


def _tokens(docs: DataFrame, encoder: Callable[[], Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]]) -> DataFrame:
    """``doc_id, source, h, n, ids``: 16-bit ids of every whole text with the closing id; ``h`` is a hash of id and text."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                ids, count = encode(rows.column("text"))
                doc = np.arange(len(count))
                ends = np.cumsum(count + 1)  # with the closing ids
                out = np.full(int(ends[-1]), END_ID, "<u2")
                out[np.arange(len(ids)) + np.repeat(doc, count)] = ids
                offsets = np.r_[0, 2 * ends].astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
                columns = [rows.column(c) for c in ("doc_id", "source", "h")]
                yield pa.record_batch([*columns, pa.array(count + 1, pa.int64()), packed], names=["doc_id", "source", "h", "n", "ids"])

    slim = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.xxhash64("doc_id", "text").alias("h"),
        utf8("text").alias("text"),
    )
    return slim.mapInArrow(run, "doc_id long, source string, h long, n long, ids binary")


def _shared_queue(rows: DataFrame, totals: DataFrame, weights: DataFrame | None, parts: int) -> DataFrame:
    """``rows`` of the sources that share a queue, with ``part`` and ``due``.

    Whole documents take turns: one is due when its source, given evenly, is in
    the middle of it.  A source's documents are in order of ``doc_id, h``.
    """
    side = totals.join(weights, "source") if weights is not None else totals.withColumn("weight", F.col("total").cast("double"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("doc_id", "h").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    due = (before - F.col("n") / 2) / F.col("weight")
    rows = rows.join(side, "source").withColumn("due", due)
    top = side.agg(F.max(F.col("total") / F.col("weight"))).first()[0]
    part = F.least(F.floor(F.col("due") / F.lit(float(top)) * parts), F.lit(parts - 1)).cast("int")
    return rows.withColumn("part", part).drop("total", "weight")


def pack(
    docs: DataFrame,
    encoder: Callable[[], Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]],
    window: int = WINDOW,
    targets: dict[str, float] | None = None,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: one row for each piece.

    All tokens of all rows of ``docs(doc_id, text, source)`` are packed, each
    into exactly one piece; only the last sequence can be short.  ``encoder()``
    runs in each task and returns a function from an Arrow array of UTF-8 texts
    to their 16-bit ids, one after the other, and each text's count.  A null
    text is empty and gives its closing id; null and empty sources are one
    source; equal rows are interchangeable.  An empty table gives no pieces.
    Other columns are not carried.

    ``targets`` are the sources' shares of every window, relative to each other;
    by default their shares of all tokens, so that all run dry together.
    Sources without a target, or with one of 0, follow once the others are dry,
    by their shares of all tokens.  Every source of at least ``LEAST_QUANTUM``
    tokens a window (there are fewer than a window has tokens) has its own queue
    and is in each full window within one token of its deficit; rarer ones share
    a queue, in which whole documents take turns by the same shares.

    The ids are written once to the shared folder; only the totals of the
    queues' parts, in proportion to their tokens, reach the driver.
    """
    spark = docs.sparkSession
    table = materialize(_tokens(docs, encoder), "pack")
    sums = materialize(table.groupBy("source").agg(F.sum("n").alias("total")), "packsums")
    whole = sums.agg(F.sum("total")).first()[0]
    if not whole:
        return spark.createDataFrame([], ", ".join(f"{c} long" for c in NAMES))
    unit = max(PART_TOKENS, whole // MAX_PARTS)
    wanted = {k or "": w for k, w in (targets or {}).items() if w > 0}
    if targets is None:
        all_weight = float(whole)
        own = [(r["source"], r["total"], float(r["total"])) for r in sums.where(F.col("total") * window >= LEAST_QUANTUM * whole).collect()]
    else:
        there = [(r["source"], r["total"], float(wanted[r["source"]])) for r in sums.where(F.col("source").isin(list(wanted))).collect()]
        all_weight = sum(w for _, _, w in there)
        own = [x for x in there if x[2] * window >= LEAST_QUANTUM * all_weight]
    # the rare ones' queue must not be rare itself: counts would not always grow with the windows
    own.sort(key=lambda x: (-x[2], x[0]))
    while own and 0 < (all_weight - sum(w for _, _, w in own)) * window < LEAST_QUANTUM * all_weight:
        own.pop()
    own.sort()
    named = spark.createDataFrame([(s, q, -(-t // unit)) for q, (s, t, _) in enumerate(own)], "source string, queue int, parts int")
    columns = ("queue", "part", "due", "doc_id", "h", "n", "ids")
    part = F.pmod(F.xxhash64("h"), F.col("parts")).cast("int").alias("part")
    rows = table.join(F.broadcast(named), "source").withColumn("due", F.lit(0.0)).withColumn("part", part)
    queues, tiers = [(t, w) for _, t, w in own], [0] * len(own)
    rare = sums.join(F.broadcast(named), "source", "left_anti")
    groups = [(rare, None, 0)] if targets is None else []
    if targets is not None:
        marks = spark.createDataFrame([(k, float(w)) for k, w in wanted.items()], "source string, weight double")
        groups = [(rare.join(F.broadcast(marks), "source", "left_semi"), marks, 0), (rare.join(F.broadcast(marks), "source", "left_anti"), None, 1)]
    shared = []
    for some, marks, tier in groups:
        total = some.agg(F.sum("total")).first()[0]
        if not total:
            continue
        weight = float(total) if marks is None else some.join(F.broadcast(marks), "source").agg(F.sum("weight")).first()[0]
        turn = _shared_queue(table, some, marks, -(-total // unit)).withColumn("queue", F.lit(len(queues)))
        shared.append(materialize(turn.select(*columns), "packrare"))
        queues.append((total, weight))
        tiers.append(tier)
    rows = rows.select(*columns)
    for turn in shared:
        rows = rows.union(turn)
    parts = rows.groupBy("queue", "part").agg(F.sum("n").alias("n")).collect()
    sizes = {(r["queue"], r["part"]): r["n"] for r in parts}
    base: dict[tuple[int, int], int] = {}
    filled = [0] * len(queues)
    for queue, number in sorted(sizes):
        base[queue, number] = filled[queue]
        filled[queue] += sizes[queue, number]
    discard(sums)
    totals, weights, tier = np.array([t for t, _ in queues]), np.array([w for _, w in queues]), np.array(tiers)
    first_tier = int(totals[tier == 0].sum())
    last = -(-whole // window)

    def edges_of(windows: np.ndarray) -> np.ndarray:
        """What each queue has given before each window."""
        goals = np.minimum(windows * window, whole)
        out = np.zeros((len(goals), len(totals)), np.int64)
        for t, goal in ((0, np.minimum(goals, first_tier)), (1, np.maximum(goals - first_tier, 0))):
            if (tier == t).any():
                out[:, tier == t] = given(totals[tier == t], weights[tier == t], goal)
        return out

    @releasing
    def lay(batches):
        edges = np.zeros((0, len(totals)), np.int64)
        first = 0  # window of edges[0]
        key, w, here = None, 0, 0

        def need(lo):
            nonlocal edges, first
            if lo < first or lo + 1 >= first + len(edges):
                first, edges = lo, edges_of(np.arange(lo, lo + max(8, (1 << 19) // len(totals))))

        def find(queue, at):
            """The window that holds the queue's token number ``at``."""
            lo, hi = 0, last
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if edges_of(np.array([mid]))[0, queue] <= at else (lo, mid)
            return lo

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256).to_pydict()
                out = [[] for _ in range(7)]
                for doc, queue, number, n, ids in zip(*(rows[c] for c in ("doc_id", "queue", "part", "n", "ids"))):
                    if key != (queue, number):
                        key, here = (queue, number), base[queue, number]
                        w = find(queue, here)
                    wide = np.frombuffer(ids, "<u2").astype("<u4")
                    done = 0
                    while done < n:
                        need(w)
                        i = w - first
                        stop = int(edges[i + 1, queue])
                        if stop <= here + done:
                            w += 1
                            continue
                        take = min(n - done, stop - here - done)
                        before = int((edges[i + 1, :queue] - edges[i, :queue]).sum())
                        values = (doc, done, take, zlib.crc32(wide[done : done + take].tobytes()), n, w, before + here + done - int(edges[i, queue]))
                        for column, value in zip(out, values):
                            column.append(value)
                        done += take
                    here += n
                yield pa.record_batch([pa.array(c, pa.int64()) for c in out], names=NAMES)

    dealt = rows.repartition("queue", "part").sortWithinPartitions("queue", "part", "due", "doc_id", "h", "n", "ids")
    return dealt.select("queue", "part", "doc_id", "n", "ids").mapInArrow(lay, ", ".join(f"{c} long" for c in NAMES))


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class PlainWords:
    """Ids of plain Latin words by a word-ending BPE vocabulary, many words at once.

    Covers words of ASCII and Latin-1 letters, ASCII digits and marks, which the
    tokenizer's normaliser only lower-cases.  Words with an apostrophe, which may
    start a contraction, and with ``<``, which may start a special token, are not
    plain.  Every round merges the lowest-ranked pair of every piece that still
    has one and looks up only the pairs beside a merge again.
    """

    MARKS = b"!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
    LONGEST = 96
    NONE = 1 << 30
    SLOT_BITS = 19

    def __init__(self, spec: dict):
        vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.keys = np.array([vocab[x] << 16 | vocab[y] for x, y in pairs] + [-1], dtype=np.int64)
        self.made = np.array([vocab[x + y] for x, y in pairs] + [0], dtype=np.int64)
        self.order = np.argsort(self.keys[:-1], kind="stable")
        self.sorted = self.keys[self.order]
        slots = self._slot(self.keys[:-1])
        self.first = np.full(1 << self.SLOT_BITS, len(pairs), np.int32)
        self.first[slots[::-1]] = np.arange(len(pairs), dtype=np.int32)[::-1]
        self.crowded = np.bincount(slots, minlength=1 << self.SLOT_BITS) > 1
        # printable Latin-1 bytes stand for themselves, the others for the code points from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        sign = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.inner = np.array([vocab[sign[b]] for b in range(256)], dtype=np.int64)
        self.final = np.array([vocab[sign[b] + "</w>"] for b in range(256)], dtype=np.int64)
        # a byte's kind: 0 not plain, 1 letter, 2 digit, 3 mark; row 1 for the byte after 0xC3
        self.kind = np.zeros((2, 256), np.int8)
        self.kind[0, [*range(65, 91), *range(97, 123), 0xC3]] = 1
        self.kind[0, 48:58] = 2
        self.kind[0, list(self.MARKS)] = 3
        self.kind[1, [b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = 1
        self.lower = np.tile(np.arange(256, dtype=np.uint8), (2, 1))
        self.lower[0, 65:91] += 32
        self.lower[1, [b for b in range(0x80, 0x9F) if b != 0x97]] += 32

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - self.SLOT_BITS)

    def _ranks(self, key: np.ndarray) -> np.ndarray:
        """Place of each pair among the merges, ``NONE`` for pairs that never merge."""
        slot = self._slot(key)
        rank = self.first[slot]
        hit = self.keys[rank] == key
        rest = np.flatnonzero(~hit & self.crowded[slot])
        rank[~hit] = self.NONE
        if len(rest):
            at = np.minimum(np.searchsorted(self.sorted, key[rest]), len(self.sorted) - 1)
            good = self.sorted[at] == key[rest]
            rank[rest[good]] = self.order[at[good]]
        return rank

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``ids, owner, plain`` of the words that end at ``ends`` in ``data`` (UTF-8): ids word by word, each one's word."""
        size = np.diff(ends, prepend=0)
        tail = np.r_[False, data[:-1] == 0xC3].astype(np.int8)
        kind = self.kind[tail, data]
        odd = np.r_[0, np.cumsum(kind == 0)]
        plain = (odd[ends] == odd[ends - size]) & (size <= self.LONGEST)
        word = np.repeat(np.arange(len(ends)), size)
        keep = np.flatnonzero(plain[word])
        byte, kind, word = self.lower[tail[keep], data[keep]], kind[keep], word[keep]
        if not len(keep):
            return np.zeros(0, "<u2"), word, plain
        opens = np.r_[True, (word[1:] != word[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == 2)]
        piece = np.cumsum(opens) - 1
        home = word[opens]
        symbol = np.where(np.r_[opens[1:], True], self.final[byte], self.inner[byte])

        def ranks(at: np.ndarray) -> np.ndarray:
            """Ranks of the pairs that begin at ``at``."""
            then = np.minimum(at + 1, len(symbol) - 1)
            found = self._ranks(symbol[at] << 16 | symbol[then])
            found[(piece[at] != piece[then]) | (at == then)] = self.NONE
            return found

        rank = ranks(np.arange(len(symbol)))
        done_symbol, done_piece = [], []
        while len(symbol):
            first = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(symbol)]))
            over = least == self.NONE
            done_symbol.append(symbol[over])
            done_piece.append(piece[over])
            hit = (rank == least) & ~over
            for i in np.flatnonzero(hit[1:] & hit[:-1]) + 1:  # overlapping equal pairs: the leftmost goes first
                if hit[i - 1]:
                    hit[i] = False
            symbol = np.where(hit, self.made[np.where(hit, rank, 0)], symbol)
            left = ~over
            left[1:] &= ~hit[:-1]
            symbol, piece, rank, hit = symbol[left], piece[left], rank[left], hit[left]
            hit[:-1] |= hit[1:].copy()
            again = np.flatnonzero(hit)
            rank[again] = ranks(again)
        symbol, piece = np.concatenate(done_symbol), np.concatenate(done_piece)
        order = np.argsort(piece, kind="stable")
        return symbol[order].astype("<u2"), home[piece[order]], plain


def json_encoder(path: str):
    """Texts to ids by a tokenizer file, without special tokens.

    Texts are split at ASCII white space, which the tokenizer never joins over,
    and each slice's distinct words are encoded once: plain ones by
    :class:`PlainWords`, all others by the tokenizer itself.  The file's text is
    read where the plan is made and travels with it.
    """
    with open(path, encoding="utf-8") as f:
        text = f.read()

    def encoder():
        import json
        import os

        import pyarrow.compute as pc

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(text)
        plain_words = PlainWords(json.loads(text))

        def distinct(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            """Ids of the words, one after the other, and each word's count."""
            offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
            data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
            ids, owner, plain = plain_words.encode(data, offsets[1:].astype(np.int64) - offsets[0])
            rest = np.flatnonzero(~plain)
            strings = words.take(pa.array(rest)).to_pylist()
            others = [e.ids for e in tokenizer.encode_batch_fast(strings, add_special_tokens=False)] if strings else []
            if others:
                count = [len(x) for x in others]
                ids = np.r_[ids, np.fromiter((i for x in others for i in x), np.uint16, sum(count))]
                owner = np.r_[owner, np.repeat(rest, count)]
                order = np.argsort(owner, kind="stable")
                ids, owner = ids[order], owner[order]
            return ids, np.bincount(owner, minlength=len(words))

        def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            try:
                texts = texts.cast(pa.string())
            except pa.ArrowInvalid:  # not UTF-8
                texts = pa.array([x.decode("utf-8", "replace") for x in texts.to_pylist()], pa.string())
            split = pc.ascii_split_whitespace(texts)
            coded = split.flatten().dictionary_encode()
            code = coded.indices.to_numpy()
            ids, size = distinct(coded.dictionary)
            start, count = (np.cumsum(size) - size)[code], size[code]
            ends = np.r_[0, np.cumsum(count)]
            at = np.arange(ends[-1]) + np.repeat(start - ends[:-1], count)
            lists = split.offsets.to_numpy()
            return ids[at], np.diff(ends[lists - lists[0]])

        return encode

    return encoder
