"""Token counts by a linear longest-match automaton.

A trie holds the word-initial pieces under one root and the continuation
pieces under another.  Every state carries a failure link into the
continuation trie and the number of pieces that following the link pops, so
the greedy longest-match-first length of a word is found in one pass over its
characters; no piece is ever built.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

from pyspark.sql import DataFrame

from .common import map_rows, utf8

_SHIFT = 21  # code points fit in 21 bits


class LongestMatchAutomaton:
    """Greedy longest-match word-piece lengths.

    ``initial`` pieces may only start a word, ``continuation`` pieces only
    follow another piece.  :meth:`length` returns the number of pieces, or
    ``None`` when greedy matching cannot cover the word.
    """

    def __init__(self, initial: Iterable[str], continuation: Iterable[str]):
        self.edge: dict[int, int] = {}
        depth_first = [[], []]
        accepts = [False, False]
        for root, pieces in ((0, initial), (1, continuation)):
            for piece in pieces:
                node = root
                for ch in piece:
                    key = node << _SHIFT | ord(ch)
                    if key not in self.edge:
                        self.edge[key] = len(accepts)
                        accepts.append(False)
                        depth_first.append([])
                        depth_first[node].append((ord(ch), len(accepts) - 1))
                    node = self.edge[key]
                if node > 1:
                    accepts[node] = True
        self.fail = [-1] * len(accepts)
        self.pops = [0] * len(accepts)
        queue = deque((root, cp, child) for root in (0, 1) for cp, child in depth_first[root])
        while queue:
            parent, cp, node = queue.popleft()
            if accepts[node]:
                self.fail[node], self.pops[node] = 1, 1
            else:
                state, popped = self.fail[parent], self.pops[parent]
                while state >= 0:
                    target = self.edge.get(state << _SHIFT | cp)
                    if target is not None:
                        self.fail[node], self.pops[node] = target, popped
                        break
                    popped += self.pops[state]
                    state = self.fail[state]
            queue.extend((node, c, child) for c, child in depth_first[node])

    def length(self, word: str) -> int | None:
        edge, fail, pops = self.edge, self.fail, self.pops
        state, count = 0, 0
        for ch in word:
            cp = ord(ch)
            target = edge.get(state << _SHIFT | cp)
            while target is None:
                if fail[state] < 0:
                    return None
                count += pops[state]
                state = fail[state]
                target = edge.get(state << _SHIFT | cp)
            state = target
        while state > 1:
            if fail[state] < 0:
                return None
            count += pops[state]
            state = fail[state]
        return count


def split_marked_pieces(pieces: Iterable[str], marker: str = "▁") -> tuple[list[str], list[str]]:
    """Word-initial (marked) and continuation pieces; bracketed control and byte pieces are left out."""
    usable = [p for p in pieces if p and not (p[0] == "<" and p[-1] == ">" and len(p) > 2)]
    return [p for p in usable if p.startswith(marker)], [p for p in usable if marker not in p]


def read_pieces(model_file: str) -> list[str]:
    """The pieces of a sentence-piece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())]


def count_tokens(
    docs: DataFrame, pieces: list[str], marker: str = "▁", cache_words: int = 200_000
) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` (long) for each row of ``docs(doc_id, text)``.

    Words are the runs between ASCII white space, each read as marker + word.
    A word that greedy matching cannot cover counts as one unknown token.
    Null and empty texts count 0; repeated rows each give a row; other columns
    are not carried.  Every worker keeps the lengths of at most about
    ``cache_words`` words (more only while a single text has more); the
    broadcast is the automaton, whose size is that of the vocabulary.
    """
    shared = docs.sparkSession.sparkContext.broadcast(LongestMatchAutomaton(*split_marked_pieces(pieces, marker)))

    def make():
        automaton = shared.value
        lengths: dict[bytes, int] = {}

        def step(rows):
            words_out, tokens, unknown = [], [], []
            for blob in rows["text"]:
                words = blob.split()
                if len(lengths) > cache_words:
                    lengths.clear()
                try:
                    total = sum(map(lengths.__getitem__, words))
                except KeyError:
                    for w in set(words).difference(lengths):
                        n = automaton.length(marker + w.decode("utf-8", "replace"))
                        lengths[w] = (1 << 40) + 1 if n is None else n  # the high part counts unknown words
                    total = sum(map(lengths.__getitem__, words))
                words_out.append(len(words))
                tokens.append(total & (1 << 40) - 1)
                unknown.append(total >> 40)
            return {"doc_id": rows["doc_id"], "n_words": words_out, "n_tokens": tokens, "n_unknown": unknown}

        return step

    return map_rows(
        docs.select("doc_id", utf8("text").alias("text")),
        "doc_id long, n_words long, n_tokens long, n_unknown long",
        make,
    )
