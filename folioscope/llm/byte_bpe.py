"""Byte-level BPE by replaying merges over a whole set of words at once.

The distinct words of a block of documents are laid out as one chain of
symbols.  An inverted index leads from a rank (the pairs that the rank merges)
to the positions where they stand; ranks are taken in order and each merge
touches only its positions and their neighbours.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import releasing, slices, utf8

#: Bytes of text that a task encodes at once (a longer text on its own).
SLICE_BYTES = 4 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank from a rank file (base64 token, space, rank)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def pair_index(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens that join to a token, as ``left << 32 | right`` in order, and the token's rank."""
    keys, made = [], []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                keys.append(left << 32 | right)
                made.append(rank)
    keys, made = np.array(keys, np.int64), np.array(made, np.int64)
    order = np.argsort(keys)
    return keys[order], made[order]


class MergeReplay:
    """Encodes a set of words, laid out as one chain of symbols, with an inverted index from ranks to positions.

    Ranks are taken in order; each applies its merge at all of its positions at
    once and looks up only the pairs that the merged symbols now form.
    """

    NONE = np.int64(1 << 40)
    #: Stands before the first and after the last symbol of a word; no pair holds it.
    EDGE = np.int64((1 << 31) - 1)
    SLOT_BITS = 21

    def __init__(self, ranks: dict[bytes, int], pairs: tuple[np.ndarray, np.ndarray]):
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.sorted, self.value = pairs[0], np.r_[pairs[1], self.NONE]
        self.keys = np.r_[pairs[0], -1]
        slots = self._slot(self.sorted)
        self.first = np.full(1 << self.SLOT_BITS, len(self.sorted), np.int32)
        self.first[slots] = np.arange(len(self.sorted), dtype=np.int32)
        self.crowded = np.bincount(slots, minlength=1 << self.SLOT_BITS) > 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key ^ key >> 15) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - self.SLOT_BITS)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What each pair merges to, ``NONE`` if nothing."""
        key = left << 32 | right
        slot = self._slot(key)
        at = self.first[slot]
        hit = self.keys[at] == key
        if not hit.all():
            rest = np.flatnonzero(~hit & self.crowded[slot])
            at[~hit] = len(self.sorted)
            if len(rest):
                there = np.minimum(np.searchsorted(self.sorted, key[rest]), len(self.sorted) - 1)
                good = self.sorted[there] == key[rest]
                at[rest[good]] = there[good]
        return self.value[at]

    def encode(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the (non-empty) words of these sizes in ``data``, one word after the other, and each id's word."""
        n = len(data)
        word = np.repeat(np.arange(len(size)), size)
        symbol = np.r_[self.single[data], self.EDGE]
        ends = np.cumsum(size)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1] = n
        before[ends - size] = n
        rank = np.r_[self._ranks(symbol[:n], symbol[after[:n]]), self.NONE]
        # the index: positions of the first pairs in order of their ranks, those of later pairs in lists
        order = np.argsort(rank[:n], kind="stable")
        order = order[: np.searchsorted(rank[order], self.NONE)]
        known, begin = np.unique(rank[order], return_index=True)
        index = dict(zip(known.tolist(), np.split(order, begin[1:])))
        later: dict[int, list[int]] = {}
        heap = list(index)
        while heap:
            r = heapq.heappop(heap)
            places = index.pop(r, None)
            if (new := later.pop(r, None)) is not None:
                places = np.array(sorted({*new, *(() if places is None else places.tolist())}))
            if places is None:
                continue
            places = places[rank[places] == r]
            if not len(places):
                continue
            q = after[places]
            touching = q[:-1] == places[1:]
            if touching.any():  # of overlapping pairs every other one, from the left
                at = np.arange(len(places))
                run = np.maximum.accumulate(np.where(np.r_[True, ~touching], at, 0))
                places = places[(at - run) % 2 == 0]
                q = after[places]
            s, left = after[q], before[places]
            # merges go from left to right: a pair of lower rank that comes up goes before the word's other places
            low = self._ranks(np.full(len(s), r), symbol[s]) < r
            merged = np.isin(left, q)
            low |= self._ranks(np.where(merged, r, symbol[left]), np.full(len(left), r)) < r
            if low.any():
                w = word[places]
                head = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
                earlier = np.cumsum(low) - low
                wait = earlier > np.repeat(earlier[head], np.diff(np.r_[head, len(w)]))
                later.setdefault(r, []).extend(places[wait].tolist())
                if wait.any():
                    heapq.heappush(heap, r)
                places, q = places[~wait], q[~wait]
                s = after[q]
            symbol[places] = r
            after[places] = s
            before[s] = places
            symbol[q], rank[q] = -1, self.NONE
            left = before[places]
            again = np.concatenate([places, left[left < n]])
            rank[again] = found = self._ranks(symbol[again], symbol[after[again]])
            for x, p in zip(found.tolist(), again.tolist()):
                if x < self.NONE:
                    if x not in later:
                        later[x] = []
                        heapq.heappush(heap, x)
                    later[x].append(p)
        alive = np.flatnonzero(symbol[:n] >= 0)
        return symbol[alive], word[alive]


class WordCoder:
    """Words to ids, whole tokens as such, all others by merge replay; ids to bytes."""

    def __init__(self, ranks: dict[bytes, int], pairs: tuple[np.ndarray, np.ndarray]):
        self.ranks = ranks
        self.replay = MergeReplay(ranks, pairs)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.size = np.array([len(t) for t in tokens])
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and each word's count."""
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int64)
        size = np.array([len(w) for w in words], np.int64)
        known, rest = np.flatnonzero(whole >= 0), np.flatnonzero((whole < 0) & (size > 0))
        ids, word = self.replay.encode(np.frombuffer(b"".join([words[i] for i in rest.tolist()]), np.uint8), size[rest])
        ids, word = np.concatenate([whole[known], ids]), np.concatenate([known, rest[word]])
        order = np.argsort(word, kind="stable")
        return ids[order].astype("<u4"), np.bincount(word, minlength=len(words))

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids and each id's number of bytes."""
        size = self.size[ids]
        return self.bytes[spread(self.start[ids], size)].tobytes(), size


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` with ``count`` members, for every pair of them."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + count, count)


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text of ``docs(doc_id, text)``.

    Returns ``doc_id, n_tokens long, ids_sha256, decoded_sha256`` and, if
    ``with_ids``, ``ids binary`` (little-endian unsigned 32-bit).  A null text
    is empty: 0 tokens and the digest of nothing.  Repeated rows each give a
    row; other columns are not carried.  The broadcast is the rank table and
    its pairs.  The distinct words of about ``SLICE_BYTES`` of text are encoded
    together by merge replay.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pair_index(ranks)))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        coder = WordCoder(*shared.value)
        find = regex.compile(pattern).findall
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                words, n_words = [], [0]
                for blob in rows.column("text").to_pylist():
                    words += find(blob.decode("utf-8", "replace"))
                    n_words.append(len(words))
                coded = pa.array(words, pa.string()).dictionary_encode()
                own, count = coder.encode(coded.dictionary.cast(pa.binary()).to_pylist())
                code = coded.indices.to_numpy()
                ids = own[spread((np.cumsum(count) - count)[code], count[code])]
                ends = np.r_[0, np.cumsum(count[code])][n_words]
                text, size = coder.decode(ids)
                cuts = np.r_[0, np.cumsum(size)][ends].tolist()
                packed, ends = ids.tobytes(), ends.tolist()
                each = [packed[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]
                columns = [
                    rows.column("doc_id"),
                    pa.array([len(x) // 4 for x in each], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in each], pa.string()),
                    pa.array([hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])], pa.string()),
                ]
                yield pa.record_batch(columns + [pa.array(each, pa.binary())] * with_ids, names=names)

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").select("doc_id", utf8("text").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    )
