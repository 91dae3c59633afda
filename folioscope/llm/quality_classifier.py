"""Quality classifier by co-training of two views.

One view sees a text's content (hashed words and word shapes, and classes of its
layout and marks), the other only the page's metadata (source, language and
size).  Both start from a
bounded labelled sample, hand each other their most confident pseudo-labels
over some rounds, each time out of all unlabelled documents, and are then
calibrated on held-out labels and combined.  Every document is scored with the
combined model.
"""

from __future__ import annotations

import re
import warnings
import zlib
from collections import Counter
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, discard, every, map_rows, materialize, releasing, unused, utf8

#: Labelled rows that the classifiers are fitted and calibrated on, the first of each class by hash of the id.
MAX_LABELLED = 2500
#: Hash buckets of words and of layout classes, which are the content view, and of the metadata view.
WORD_DIM, LAYOUT_DIM = 1 << 12, 1 << 9
CONTENT_DIM = WORD_DIM + LAYOUT_DIM
METADATA_DIM = 1 << 9
ROUNDS = 4
#: Gradient steps of the first fit and of each later one, which goes on from the one before.
FIRST_STEPS, STEPS = 200, 60
#: Share of the pool that a view hands over in a round.
HANDOVER = 0.05
#: Between two gradients over all pseudo-labelled documents, these are stood for by the means of so many groups a label and round.
GROUPS = 16
#: Scores are told apart by this part of a log odd, within a bound; documents of equal scores by a hash of the id.
SCORE_PARTS, SCORE_BOUND, TIES = 64, 100, 16
#: Word shares are summed in integers of this unit, so that sums don't depend on their order.
UNIT = 1 << 20
#: Share of the held-out good documents that the threshold must let pass; one may always go.
GOOD_PASS = 0.99


def word_features(word: str) -> tuple[int, int]:
    """Buckets of a word and of its shape (runs of upper, lower, digit and other characters)."""
    shape = re.sub(r"(.)\1+", r"\1", "".join("d" if c.isdigit() else "U" if c.isupper() else "l" if c.isalpha() else c for c in word))
    return zlib.crc32(word.encode()) % WORD_DIM, zlib.crc32(("\0" + shape).encode()) % WORD_DIM


def _buckets(facts, dim: int) -> list[int]:
    return sorted({zlib.crc32(f"{k}={v}".encode()) % dim for k, v in facts})


def layout_features(text: str, split: list[str]) -> list[int]:
    """Buckets of classes of a text's lines, word lengths, marks and repeated words."""
    lines = text.count("\n") + 1
    size = len(text)
    words = max(len(split), 1)
    facts = (
        ("lines", lines.bit_length()),
        ("line", (size // lines).bit_length()),
        ("word", min(size // words, 30)),
        ("bars", min(20, 40 * text.count("|") // words)),
        ("marks", min(20, 20 * text.count("!") // words)),
        ("stops", min(20, 100 * text.count(".") // words)),
        ("again", -(-20 * sum(map(eq, split, split[1:])) // words)),
    )
    return _buckets(facts, LAYOUT_DIM)


def metadata_features(lang, source, size: int) -> list[int]:
    """Buckets of what is known of a page without its text: where it is from, its language, and the class of its size."""
    half = (size * size).bit_length()  # two classes for each doubling
    return _buckets((("source", source), ("lang", lang), ("from", (source, lang)), ("size", half)), METADATA_DIM)


class Logistic:
    """Class-weighted L2 logistic regression by accelerated gradient steps."""

    @staticmethod
    def weights(y: np.ndarray, times: np.ndarray) -> np.ndarray:
        """What each row counts: the classes as much as one another."""
        share = np.clip(np.average(y, weights=times), 1e-3, 1 - 1e-3)
        return (np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) * times / times.sum()).astype(np.float32)

    def fit(
        self, x: np.ndarray, y: np.ndarray, steps: int = 200, ridge: float = 1e-4, times: np.ndarray | None = None, start: Logistic | None = None,
        shift: tuple[np.ndarray, float] | None = None,
    ) -> Logistic:
        """Weights for rows ``x`` that count ``times``, from those of ``start`` on, if given; ``shift`` is added to all gradients."""
        times = np.ones(len(y)) if times is None else times
        weight = self.weights(y, times)
        more, more_b = shift or (np.float32(0), 0.0)
        self.w, self.b = (start.w, start.b) if start else (np.zeros(x.shape[1], np.float32), 0.0)
        # the greatest curvature of the loss, by power iteration
        v, top = np.ones(x.shape[1] + 1, np.float32), 1.0
        for _ in range(12):
            v /= np.linalg.norm(v)
            z = weight * (x @ v[:-1] + v[-1])
            v = np.r_[x.T @ z, z.sum()].astype(np.float32)
            top = float(np.linalg.norm(v))
        rate = 1 / (0.3 * top + ridge)
        vw, vb = np.zeros_like(self.w), 0.0
        for _ in range(steps):
            error = weight * (1 / (1 + np.exp(-np.clip(x @ self.w + np.float32(self.b), -30, 30))) - y)
            error = error.astype(np.float32)
            vw = (0.9 * vw - rate * (x.T @ error + more + ridge * self.w)).astype(np.float32)
            vb = 0.9 * vb - rate * (float(error.sum()) + more_b)
            self.w = self.w + vw
            self.b += vb
        return self

    def gap(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, wanted: tuple[np.ndarray, float]) -> tuple[np.ndarray, float]:
        """How far ``wanted`` is from the gradient of rows ``x`` at these weights."""
        error = weight * (1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30))) - y)
        return (wanted[0] - x.T @ error).astype(np.float32), float(wanted[1] - error.sum())

    def logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w + self.b


def _features(docs: DataFrame) -> DataFrame:
    """``label, tie``, the content view as word buckets with counts and layout buckets, and the metadata view as buckets, of ``text, lang, source, size``."""

    def make():
        known: dict[str, tuple[int, int]] = {}

        def step(rows):
            out = {"label": rows["label"], "tie": rows["tie"], "buckets": [], "counts": [], "layout": [], "meta": []}
            for blob, lang, source, size in zip(rows["text"], rows["lang"], rows["source"], rows["size"]):
                text = blob.decode("utf-8", "replace")
                words = text.split()
                if len(known) > 200_000:
                    known.clear()
                for w in set(words).difference(known):
                    known[w] = word_features(w)
                counts = np.bincount(np.array([known[w] for w in words], np.int64).ravel(), minlength=WORD_DIM)
                at = np.flatnonzero(counts)
                out["buckets"].append(at.astype("<u2").tobytes())
                out["counts"].append(counts[at].astype("<u4").tobytes())
                out["layout"].append(np.array(layout_features(text, words), "<u2").tobytes())
                out["meta"].append(np.array(metadata_features(lang, source, size), "<u2").tobytes())
            return out

        return step

    return map_rows(docs, "label int, tie int, buckets binary, counts binary, layout binary, meta binary", make, chunk=64)


def _sample_features(docs: DataFrame) -> dict[str, np.ndarray]:
    """Dense features of a bounded sample of rows, fetched as index and count arrays and made dense once."""
    rows = list(_features(docs).toLocalIterator())
    content = np.zeros((len(rows), CONTENT_DIM), np.float32)
    meta = np.zeros((len(rows), METADATA_DIM), np.float32)
    for r, own, view in zip(rows, content, meta):
        counts = np.frombuffer(r["counts"], "<u4")
        own[np.frombuffer(r["buckets"], "<u2")] = counts / max(1, counts.sum())
        own[WORD_DIM + np.frombuffer(r["layout"], "<u2").astype(int)] = 1 / CONTENT_SCALE
        view[np.frombuffer(r["meta"], "<u2")] = 1
    content *= CONTENT_SCALE
    return {"label": np.array([r["label"] for r in rows], dtype=int), "content": content, "meta": meta}


#: Word shares are small; this brings them to the order of one.
CONTENT_SCALE = np.float32(20)


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The least score to keep: it rejects the largest share of bad less the share of good, within ``GOOD_PASS``.

    Between two scores that do equally well it is 0 (even odds) if that lies
    between them, else the middle.
    """
    good = np.sort(good)
    lost = np.arange(min(len(good), max(2, int((1 - GOOD_PASS) * len(good)) + 1)))
    top = good[lost]
    best = int(np.argmax((bad[:, None] < top).mean(0) - lost / len(good)))
    below = np.r_[bad[bad < top[best]], good[good < top[best]]]
    low = below.max() if len(below) else -np.inf
    return 0.0 if low < 0 <= top[best] else float(top[best] if np.isinf(low) else (low + top[best]) / 2)


VIEWS = {"content": CONTENT_DIM, "meta": METADATA_DIM}


def _sparse(rows: dict[str, list]) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row number, bucket and value of all entries of a chunk's rows, by view."""
    number = lambda column, width: np.repeat(np.arange(len(column)), [len(x) // width for x in column])
    counts = np.frombuffer(b"".join(rows["counts"]), "<u4").astype(float)
    at = number(rows["buckets"], 2)
    total = np.bincount(at, counts, len(rows["tie"]))
    meta, layout = (np.frombuffer(b"".join(rows[c]), "<u2").astype(np.int64) for c in ("meta", "layout"))
    words = np.frombuffer(b"".join(rows["buckets"]), "<u2").astype(np.int64)
    return {
        "content": (
            np.r_[at, number(rows["layout"], 2)],
            np.r_[words, WORD_DIM + layout],
            np.r_[counts / total[at], np.full(len(layout), 1 / float(CONTENT_SCALE))],
        ),
        "meta": (number(rows["meta"], 2), meta, np.ones(len(meta))),
    }


def _steps(entries, weights: dict, ties: np.ndarray) -> dict[str, np.ndarray]:
    """Each row's score by either view as an integer, ties told apart."""
    out = {}
    for v, (w, b) in weights.items():
        at, bucket, value = entries[v]
        score = np.bincount(at, w[bucket] * value, len(ties)) + b
        out[v] = np.floor(np.clip(score, -SCORE_BOUND, SCORE_BOUND) * SCORE_PARTS).astype(np.int64) * TIES + ties
    return out


def _over_pool(pool: DataFrame, past: list, work):
    """``work(rows, entries, steps, label, free, last)`` over the whole pool; its counts ``key -> n`` are summed by task, then by key.

    ``past`` holds each round's weights and, but for the last, its cuts;
    documents within the cuts of an earlier round are not free, and ``label``
    has what they were handed over as to either view (-1: not to it).
    """
    shared = pool.sparkSession.sparkContext.broadcast(past)

    @releasing
    def run(batches):
        import pyarrow as pa

        totals = Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                rows = batch.slice(start, 512).to_pydict()
                entries, ties = _sparse(rows), np.array(rows["tie"])
                free, steps = np.ones(len(ties), bool), None
                label = {v: np.full(len(ties), -1) for v in VIEWS}
                for i, (weights, cuts) in enumerate(shared.value):
                    steps = _steps(entries, weights, ties)
                    if i + 1 < len(shared.value):
                        free = _hand_over(steps, cuts, label, free)
                keys, n = work(rows, entries, steps, label, free, shared.value[-1])
                for k, x in zip(keys.tolist(), n.tolist()):
                    totals[k] += x
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array(list(totals.values()), pa.int64())], names=["key", "n"])

    return pool.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()


#: Who hands over to whom.
PUPILS = (("meta", "content"), ("content", "meta"))


def _hand_over(steps: dict, cuts: dict, label: dict, free: np.ndarray) -> np.ndarray:
    """Labels the free documents within the cuts for their pupils; those that are still free."""
    for teacher, pupil in PUPILS:
        low, high = cuts[teacher]
        label[pupil][free & (steps[teacher] <= low)] = 0
        label[pupil][free & (steps[teacher] >= high)] = 1
    for v, (low, high) in cuts.items():
        free = free & (steps[v] > low) & (steps[v] < high)
    return free


def _count_steps(rows, entries, steps, label, free, last):
    """How many free documents have a score, by view: the key is twice the score, plus 1 for the metadata view."""
    return np.unique(np.concatenate([2 * steps[v][free] + i for i, v in enumerate(VIEWS)]), return_counts=True)


def _sum_handed(rows, entries, steps, label, free, last):
    """Sums over documents handed over, by pupil, label and group: the pupil's features of those of this round, and, as the
    last group, the gradients of all documents so far at the pupil's weights.

    The key is ``((pupil * 2 + label) * (GROUPS + 1) + group) * (CONTENT_DIM + 1) + bucket``; the last bucket counts documents, or has the gradient of the bias.
    """
    weights, cuts = last
    was = {v: x.copy() for v, x in label.items()}
    _hand_over(steps, cuts, label, free)
    group = np.array([zlib.crc32(m) % GROUPS for m in rows["meta"]])
    keys, values = [], []
    for i, (_, pupil) in enumerate(PUPILS):
        at, bucket, value = entries[pupil]
        own, fresh = label[pupil], (label[pupil] >= 0) & (was[pupil] < 0)
        w, b = weights[pupil]
        error = 1 / (1 + np.exp(-np.clip(np.bincount(at, w[bucket] * value, len(own)) + b, -30, 30))) - own
        for which, place, amount, count in ((fresh, group, value, 1.0), (own >= 0, GROUPS, value * error[at], error)):
            base = ((i * 2 + own) * (GROUPS + 1) + place) * (CONTENT_DIM + 1)
            taken = which[at]
            keys += [base[at][taken] + bucket[taken], base[which] + CONTENT_DIM]
            values += [np.rint(amount[taken] * UNIT), np.rint(np.broadcast_to(count, len(own))[which] * UNIT)]
    keys, where = np.unique(np.concatenate(keys), return_inverse=True)
    return keys, np.bincount(where, np.concatenate(values), len(keys)).astype(np.int64)


def _cut(steps: np.ndarray, n: np.ndarray, n_bad: int, n_good: int) -> tuple[int, int]:
    """The scores up to which and from which on documents are handed over, as many as stated or the fewest there can be."""
    order = np.argsort(steps)
    steps, n = steps[order], np.cumsum(n[order])
    low = max(0, int(np.searchsorted(n, n_bad, "right")) - 1)
    high = min(len(steps) - 1, int(np.searchsorted(n, n[-1] - n_good, "left")) + 1)
    return int(steps[low]), max(int(steps[high]), int(steps[low]) + 1)


def held_out(label: np.ndarray) -> np.ndarray:
    """Which rows of a sample calibrate: every fourth of each class, or the last of fewer."""
    out = np.zeros(len(label), bool)
    for k in (0, 1):
        own = np.flatnonzero(label == k)
        out[own[3::4] if len(own) > 3 else own[-1:]] = True
    return out


def co_train(seed: dict[str, np.ndarray], pool: DataFrame, good: float) -> dict:
    """Weights of both views, their calibration, and the threshold; plain numbers only.

    ``pool`` has the features of all unlabelled documents; ``good`` is the
    share of good documents to hand over.
    """
    held = held_out(seed["label"])
    views = {}
    n_seed = int((~held).sum())
    # room for the means of all rounds, so that no round copies the seed
    room = {v: np.empty((n_seed + 2 * GROUPS * ROUNDS, dim), np.float32) for v, dim in VIEWS.items()}
    for v in VIEWS:
        np.compress(~held, seed[v], axis=0, out=room[v][:n_seed])
    train = {v: (room[v][:n_seed], seed["label"][~held].astype(np.float32), np.ones(n_seed)) for v in VIEWS}
    past, size, shift = [], 0, {}
    for turn in range(ROUNDS + 1):
        views = {v: Logistic().fit(x, y, STEPS if views else FIRST_STEPS, times=times, start=views.get(v), shift=shift.get(v)) for v, (x, y, times) in train.items()}
        if turn == ROUNDS:
            break
        past.append(({v: (m.w.astype(float) * (CONTENT_SCALE if v == "content" else 1), m.b) for v, m in views.items()}, None))
        found = _over_pool(pool, past, _count_steps)
        key, n = found["key"].to_numpy(), found["n"].to_numpy()
        if n.sum() < 4:
            break
        size = size or int(n.sum()) // 2
        share = max(1, int(HANDOVER * size))
        n_bad, n_good = max(1, round(share * (1 - good))), max(1, round(share * good))
        cuts = {v: _cut(key[key % 2 == i] // 2, n[key % 2 == i], n_bad, n_good) for i, v in enumerate(VIEWS)}
        past[-1] = past[-1][0], cuts
        found = _over_pool(pool, past, _sum_handed)
        key, n = found["key"].to_numpy(), found["n"].to_numpy()
        sums = np.zeros((4 * (GROUPS + 1), CONTENT_DIM + 1))
        sums[key // (CONTENT_DIM + 1), key % (CONTENT_DIM + 1)] = n / UNIT
        # the whole pool weighs at most as much as the seed
        unit = min(1.0, len(train["content"][1]) / size) if turn == 0 else unit
        for i, (v, dim) in enumerate(VIEWS.items()):
            scale = CONTENT_SCALE if v == "content" else np.float32(1)
            part = sums.reshape(2, 2, GROUPS + 1, -1)[i]
            means, gradient = part[:, :GROUPS].reshape(2 * GROUPS, -1), part[:, GROUPS]
            some = means[:, -1] > 0
            mean = means[some, :dim] / means[some, -1:] * scale
            x, y, times = train[v]
            room[v][len(x) : len(x) + len(mean)] = mean
            x, y, times = room[v][: len(x) + len(mean)], np.r_[y, (np.arange(2 * GROUPS) // GROUPS)[some]].astype(np.float32), np.r_[times, unit * means[some, -1]]
            train[v] = x, y, times
            # groups stand for their documents so that the first gradient is that of all documents, each by itself
            weight = Logistic.weights(y, times)
            each = [unit * weight[n_seed:][y[n_seed:] == k][0] / times[n_seed:][y[n_seed:] == k][0] if (y[n_seed:] == k).any() else 0.0 for k in (0, 1)]
            wanted = sum(e * g[:dim] for e, g in zip(each, gradient)) * scale, float(sum(e * g[-1] for e, g in zip(each, gradient)))
            shift[v] = views[v].gap(x[n_seed:], y[n_seed:], weight[n_seed:], wanted)
    scores = np.stack([views[v].logit(seed[v][held]) for v in ("content", "meta")], 1)
    centre, spread = scores.mean(0), np.maximum(scores.std(0), 1e-6)
    combined = Logistic().fit(((scores - centre) / spread).astype(np.float32), seed["label"][held].astype(np.float32), 400, 1e-3)
    slope = combined.w / spread
    offset = float(combined.b - (centre * slope).sum())
    scores, label = scores @ slope + offset, seed["label"][held]
    return {
        "words": views["content"].w[:WORD_DIM] * CONTENT_SCALE * slope[0],
        "layout": views["content"].w[WORD_DIM:] * slope[0],
        "meta": views["meta"].w * slope[1],
        "bias": float(offset + views["content"].b * slope[0] + views["meta"].b * slope[1]),
        "threshold": best_cut(scores[label == 1], scores[label == 0]),
    }


def _size(docs: DataFrame) -> Column:
    """The size that the page states, or else that of its text, in characters."""
    size = F.length("text")
    return F.coalesce(F.col("n_chars").cast("long"), size, F.lit(0)) if "n_chars" in docs.columns else F.coalesce(size, F.lit(0))


def fit(docs: DataFrame, labels: DataFrame) -> dict | None:
    """Fit on a bounded sample of the labelled and all unlabelled ``docs``; ``None`` if a class has under two labelled documents.

    A document is good if every label says so; ties between repeated labels
    count as bad.  Of rows that repeat an id the one with the least text is
    sampled.  Rows with null ids are neither sampled nor used.
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    here = materialize(marks.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "labels")
    order = F.xxhash64("doc_id")
    bad, good = (here.where(F.col("label") == k).orderBy(order, "doc_id").limit(MAX_LABELLED).collect() for k in (0, 1))
    n_bad = min(len(bad), max(MAX_LABELLED // 2, MAX_LABELLED - len(good)))
    chosen = docs.sparkSession.createDataFrame(bad[:n_bad] + good[: MAX_LABELLED - n_bad], here.schema)
    columns = ("label", F.pmod(order, F.lit(TIES)).cast("int").alias("tie"), utf8("text").alias("text"), "lang", "source", _size(docs).alias("size"))
    picked = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", *columns)
    once = picked.groupBy("doc_id").agg(F.min_by(F.struct(*picked.columns[1:]), F.struct("text", "lang", "source", "size")).alias("row"))
    seed = _sample_features(once.orderBy(order, "doc_id").select("row.*"))
    if min((seed["label"] == k).sum() for k in (0, 1)) < 2:
        warnings.warn(f"{len(bad)} bad and {len(good)} good labels are too few to fit on: every document is kept", stacklevel=2)
        discard(here)
        return None
    share = here.agg(F.avg("label")).first()[0]
    others = docs.where("doc_id is not null").join(broadcast_if_small(here).select("doc_id"), "doc_id", "left_anti").withColumn("label", F.lit(-1))
    pool = materialize(_features(others.select(*columns)), "pool")
    try:
        return co_train(seed, pool, share)
    finally:
        discard(pool)
        discard(here)


def classify(docs: DataFrame, model: dict | None, carry: tuple[str, ...] = ("doc_id",), cache_words: int = 200_000) -> DataFrame:
    """The columns to carry, ``score double`` (log odds of good) and ``kept boolean`` for every row.

    Reads ``text, lang, source`` and, if there, ``n_chars``; null texts are empty.  Without a model all
    scores are 0 and everything is kept.  Where a carried column has the name,
    that of the score or the verdict, which come last, gets underscores before it.
    """
    spark = docs.sparkSession
    score, kept = unused(docs.select(*(x for c, x in zip(docs.columns, every(docs)) if c in carry)), "score", "kept")
    place = {c: f"c{i}" for i, c in enumerate(carry)}  # names that a worker can have
    shared = spark.sparkContext.broadcast(model)
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def make():
        model = shared.value
        known: dict[str, float] = {}
        if model:
            weights, layout, meta = (model[k].tolist() for k in ("words", "layout", "meta"))

        def step(rows):
            scores = []
            for blob, where, whence, many in zip(rows["text"], rows["lang"], rows["source"], rows["size"]):
                if not model:
                    scores.append(0.0)
                    continue
                text = blob.decode("utf-8", "replace")
                words = text.split()
                if len(known) > cache_words:
                    known.clear()
                for w in set(words).difference(known):
                    a, b = word_features(w)
                    known[w] = weights[a] + weights[b]
                total = sum(map(known.__getitem__, words)) / max(1, 2 * len(words))
                total += sum(layout[k] for k in layout_features(text, words))
                scores.append(total + sum(meta[k] for k in metadata_features(where, whence, many)) + model["bias"])
            limit = model["threshold"] if model else 0.0
            return {c: rows[c] for c in place.values()} | {"score": scores, "kept": [s >= limit for s in scores]}

        return step

    own = {c: x for c, x in zip(docs.columns, every(docs))}
    slim = docs.select(*(own[c].alias(n) for c, n in place.items()), utf8("text").alias("text"), "lang", "source", _size(docs).alias("size"))
    schema = ", ".join([*(f"{n} {fields[c]}" for c, n in place.items()), "score double", "kept boolean"])
    return map_rows(slim, schema, make, chunk=256).toDF(*carry, score, kept)


def quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score, kept`` for every row of ``docs(doc_id, text, lang, source)``.

    Nulls in any column are values like any other, a null text is empty;
    repeated rows score alike.  An empty table gives none.  Other columns are
    not carried.
    """
    return classify(docs, fit(docs, labels))
