"""Suffix-array dedup, source audit and whitening against brute force, exact fractions and on odd rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
from conftest import SF
from pyspark.sql import functions as F


def _removed(rows, width=50):
    """What the contract of suffix-array dedup gives, string by string."""
    last = 2**63 - 1
    first = {}
    for doc, text in rows:
        b, rank = (text or "").encode(), last if doc is None else doc
        for j in range(len(b) - width + 1):
            first[b[j : j + width]] = min(first.get(b[j : j + width], last), rank)
    out = Counter()
    for doc, text in rows:
        b, rank = (text or "").encode(), last if doc is None else doc
        gone = bytearray(len(b))
        for j in range(len(b) - width + 1):
            if first[b[j : j + width]] < rank:
                gone[j : j + width] = b"\1" * width
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out[doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def _odd_texts(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 120").collect()]
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    passage = "a passage of more than fifty bytes, which several of the documents have, "
    rows += [(None, "x" * 500), (None, passage), (2000, "x" * 60), (2001, None), (2002, ""), (2003, "ä" * 100), (2004, "bä" + "ä" * 60), rows[3], (None, rows[5][1])]
    rows += [(2005, "y" * 49), (2006, "y" * 49), (2007, "y" * 50), (2008, "y" * 50), (2009, long), (2010, long[7:] + passage), (2011, "z" + passage + "\0" * 80), (2012, "\0" * 70 + passage)]
    rows += [(2013 + i, passage + str(i) * 30 + passage) for i in range(40)]
    return rows


def test_suffix_dedup(spark, monkeypatch):
    from folioscope.llm import suffix_dedup as D

    rows = _odd_texts(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit(1)).withColumn("ids", F.lit("x")).withColumn("bucket", F.lit(2))
    want = _removed(rows)
    for block in (2 << 20, 5000):  # one block, and many that share passages
        monkeypatch.setattr(D, "BLOCK_BYTES", block)
        assert Counter(map(tuple, D.suffix_array_dedup(docs.repartition(3)).collect())) == want
    spans = {r.doc_id: r for r in D.repeated_bytes(docs).where("doc_id = 2008 or doc_id = 2011").collect()}
    assert [tuple(s) for s in spans[2008].spans] == [(0, 50)] and bytes(spans[2008].kept) == b""
    assert bytes(spans[2011].kept)[:1] == b"z"
    assert D.suffix_array_dedup(docs.limit(0)).collect() == []


def _shuffled(plan):
    """The columns of each exchange of a physical plan."""
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    own = [[plan.output().apply(i).name() for i in range(plan.output().size())]] if plan.nodeName() == "Exchange" else []
    return own + [x for p in below for x in _shuffled(p)]


def test_suffix_dedup_shuffles_no_whole_text(spark, monkeypatch):
    from folioscope.llm import suffix_dedup as D

    rows, plans, written = _odd_texts(spark), [], D.materialize

    def watched(df, label):
        plans.append(df)
        return written(df, label)

    monkeypatch.setattr(D, "materialize", watched)
    monkeypatch.setattr(D, "BLOCK_BYTES", 5000)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        plans.append(D.suffix_array_dedup(docs))
        assert Counter(map(tuple, plans[-1].collect())) == _removed(rows)
        shuffled = [x for df in plans for x in _shuffled(df._jdf.queryExecution().executedPlan().initialPlan())]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert len(shuffled) >= 4 and not [x for x in shuffled if "n_bytes" in x]  # a block's own column, beside its text
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("blocks")]


def test_anchored_runs_hold_every_window_once(monkeypatch):
    from folioscope.llm import suffix_dedup as D

    rng = random.Random(3)
    texts = [bytes(rng.choices(b"ab" if i % 3 else b"abcdefgh ", k=rng.choice([0, 10, 49, 50, 51, 300, 4000]))) for i in range(40)]
    data, sizes = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])
    seeds = defaultdict(set)
    for chunk in (100, 1 << 18):
        monkeypatch.setattr(D, "CHUNK", chunk)
        got = []
        for start, count, seed, doc in zip(*(x.tolist() for x in D.anchored_runs(data, sizes))):
            assert 1 <= count <= D.WIDTH - D.SEED + 1
            got += range(start, start + count)
            for i in range(start, start + count):
                seeds[data[i : i + D.WIDTH].tobytes()].add(seed)
        edges = np.append(0, np.cumsum(sizes)).tolist()
        assert got == [i for a, b in zip(edges, edges[1:]) for i in range(a, b - D.WIDTH + 1)]
    assert all(len(s) == 1 for s in seeds.values())  # equal windows meet in one bucket


def test_index_family():
    from folioscope.llm.suffix_dedup import IndexFamily

    rng, family, known = random.Random(5), IndexFamily(), {}
    for doc in range(60):
        batch = [bytes(rng.choices(b"ab\0", k=5)) for _ in range(rng.randint(1, 40))]
        for w in batch:
            known.setdefault(w.rstrip(b"\0"), doc)
        least = family.add(np.array(batch, "S5"), np.full(len(batch), doc))
        assert least.tolist() == [known[w.rstrip(b"\0")] for w in batch]
        sizes = [len(w) for w, _ in family.levels]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:])) and sum(sizes) == len(known)


def _divergence(rows, min_docs, top):
    word = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    df, n, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        own = Counter(word.findall((text or "").translate(low)))
        df[lang].update(own.keys())
        n[lang, source].update(own)
    out = Counter()
    for lang in {g[0] for g in groups}:
        kept = [t for t, c in df[lang].items() if c >= min_docs]
        sources = sorted(s for k, s in groups if k == lang)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + math.floor(Fraction(10**9 * (counts[t] + 5), total + 5 * len(kept))) for t in kept}

        p = {s: shares(n[lang, s]) for s in sources}
        q = shares(sum((n[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            used = [(t, p[s][t] - q[t]) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", used, top)):
                for rank, (item, value) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
                    out[lang, s, part, item, value, rank] += 1
    return out


def test_source_divergence(spark, monkeypatch):
    from folioscope.llm import source_audit as A

    rows = [(r.doc_id, r.lang, r.source, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300").collect()]
    rows += [(1, None, None, "Äpfel ÄPFEL apfel x1y2  \U0001d54f"), (None, None, "s", None), (None, "", "", "apfel Z"), (3, "en", "only", ""), (3, "en", "only", ""), (4, "zz", "a", "1 2"), (5, "zz", "b", None), (8, "q\0r", "s\0", "odd name odd"), (9, "q", "r", "odd name")]
    rows += [(6, "yy", f"s{i:04}", "one " * (i % 7) + "two three") for i in range(60)] + [rows[0]] * 3 + [(7, "en", "only", "the word " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").withColumn("term", F.lit(1)).withColumn("n", F.lit(2)).withColumn("place", F.lit(0))
    for min_docs, cells, tile, slice_bytes, held in ((30, 1 << 20, 512, 1 << 20, 1 << 20), (3, 200, 7, 20_000, 500)):
        monkeypatch.setattr(A, "MIN_DOCS", min_docs)
        monkeypatch.setattr(A, "CELLS", cells)
        monkeypatch.setattr(A, "TILE", tile)
        monkeypatch.setattr(A, "SLICE_BYTES", slice_bytes)
        monkeypatch.setattr(A, "HELD", held)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000" if min_docs == 30 else "70")
        got = Counter(map(tuple, A.source_divergence(docs.repartition(5)).collect()))
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == _divergence([r[1:] for r in rows], min_docs, 50)
    monkeypatch.setattr("folioscope.llm.common.BROADCAST_BYTES", 0)  # the way of tables too large to broadcast
    assert Counter(map(tuple, A.source_divergence(docs).collect())) == got
    assert A.source_divergence(docs.limit(0)).collect() == []
    terms = A.source_divergence(docs.where("lang = 'yy'"), top=1).where("part = 'term'").groupBy("source").count().collect()
    assert all(r["count"] == 1 for r in terms)


def test_shares_are_exact(spark):
    from folioscope.llm.source_audit import share

    cases = [(0, 0, 1), (10**13, 10**16 + 7, 10**9), (3, 7, 11), (10**18, 10**18, 1)]
    df = spark.createDataFrame(cases, "c long, t long, v long").select("c", "t", "v", share(F.col("c"), F.col("t"), F.col("v")).alias("p"))
    assert {tuple(r) for r in df.collect()} == {(c, t, v, 1 + 10**9 * (c + 5) // (t + 5 * v)) for c, t, v in cases}


def test_compensated_covariance():
    from folioscope.llm import whitening as W

    rng = np.random.default_rng(1)
    x = rng.integers(-(2**20), 2**20, (150, 4)) * np.array([1, 1, 2**20, 1]) + np.array([10**12, 0, 0, 10**6])
    n, sums = len(x), [int(s) for s in x.sum(0)]
    exact = [[sum((Fraction(int(a)) - Fraction(s, n)) * (Fraction(int(b)) - Fraction(t, n)) for a, b in zip(x[:, i], x[:, j])) for j, t in enumerate(sums)] for i, s in enumerate(sums)]
    high, low = W.outer_sum(*W.centred(x, sums, n))
    part = W.add(W.outer_sum(*W.centred(x[:70], sums, n)), W.outer_sum(*W.centred(x[70:], sums, n)))
    for h, w in ((high, low), part):
        for i in range(4):
            for j in range(4):
                scale = math.sqrt(exact[i][i] * exact[j][j])
                assert abs(Fraction(float(h[i, j])) + Fraction(float(w[i, j])) - exact[i][j]) <= 1e-28 * scale
    assert W._deviation(x, sums, n) == [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x]


def test_whitening(spark):
    from folioscope.llm import whitening as W

    rng = np.random.default_rng(2)
    made = (rng.normal(size=(400, 6)) * [1, 1, 0.5, 3, 0, 1e-1] + rng.normal(size=(400, 1))).round(3)
    made[:, 1] = made[:, 0]  # no variance of its own
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(made)] + [(7, [float(v) for v in made[7]]), (None, [0.5] * 6)]
    odd = [(900, None), (901, [None] + [1.0] * 5), (902, [math.nan] * 6), (903, [math.inf] * 6), (904, [1.0]), (905, []), (906, [1e300] * 6)]
    docs = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("x", F.lit("x")).withColumn("n", F.lit(2)).withColumn("component", F.lit(1))
    got = W.whiten(docs.repartition(3)).collect()
    x = np.array([[math.floor(64 * v) + 1_000_000 for v in r[1]] for r in rows])
    n, s = len(x), x.sum(0)
    centred = np.array([[float(Fraction(int(v)) - Fraction(int(t), n)) for v, t in zip(r, s)] for r in x])
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1], vector[:, ::-1]
    k = int((value > 1e-9 * value[0]).sum())
    assert len(got) == n * k and k < 6 and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, k + 1))
    want = centred @ vector[:, :k] / np.sqrt(value[:k])
    for c in range(k):
        own = [r for r in got if r.component == c + 1]
        key = lambda t: (str(t[0]), t[1])
        a = sorted(((r.vec_id, int(r.deviation), r.whitened) for r in own), key=key)
        b = sorted(((i, sum((n * int(v) - int(t)) ** 2 for v, t in zip(z, s)), float(w)) for (i, _), z, w in zip(rows, x, want[:, c])), key=key)
        assert [t[:2] for t in a] == [t[:2] for t in b]
        p, q = np.array([t[2] for t in a]), np.array([t[2] for t in b])
        assert min(abs(p - q).max(), abs(p + q).max()) < 1e-9
        assert abs(own[0].explained - value[c] / value.sum()) < 1e-12 and own[0].identity_error < 1e-10
    for few in (docs.limit(0), docs.where("vec_id = 5"), docs.where("vec_id >= 900"), docs.where("vec_id = 7")):
        assert W.whiten(few).collect() == []
