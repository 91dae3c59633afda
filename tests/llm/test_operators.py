"""Every operator against a brute-force version on small fixtures with nulls, empty and repeated rows."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from conftest import SF
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 150").collect()]
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows += [(1000, None, None, None, None), (1001, "", "en", "s", 0), (None, "a b c d e f", "en", "s", 11), (1002, " \n\t ", "en", "s", 4)]
    rows += [(1003, long, "en", "s", len(long)), (1004, "one", "en", "s", 3), (1005, "One", "en", "s", 3), rows[3], rows[3]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("words", F.lit(1)).withColumn("n", F.lit(2))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet").union(spark.createDataFrame([(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int"))


def words(text):
    return (text or "").encode().split()


def test_token_counts(spark, docs):
    from folioscope.llm.token_count import count_tokens, read_pieces, split_marked_pieces

    pieces = read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    first, rest = map(set, split_marked_pieces(pieces))

    def greedy(w):
        n = i = 0
        while i < len(w):
            j = next((j for j in range(min(len(w), i + 40), i, -1) if w[i:j] in (rest if i else first)), None)
            if j is None:
                return 1
            i, n = j, n + 1
        return n

    got = Counter((r.doc_id, r.n_words, r.n_tokens) for r in count_tokens(docs, pieces).collect())
    want = Counter((r.doc_id, len(words(r.text)), sum(greedy("▁" + w.decode()) for w in words(r.text))) for r in docs.collect())
    assert got == want


def test_byte_bpe(spark, docs):
    import tiktoken

    from folioscope.llm.byte_bpe import encode_documents, read_ranks

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_documents(docs, ranks, public_tokenizers.PATTERN).collect())
    want = Counter()
    for r in docs.collect():
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4").tobytes()
        want[r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert got == want


def test_quality_rules(spark, docs, labels):
    from folioscope.llm import quality_rules as Q

    rows = docs.collect()
    trusted = {r.doc_id for r in Q.trusted_documents(labels).collect()}
    size = 64
    raw, target = [1] * size, [1] * size

    def buckets(text):
        h = [zlib.crc32(w) for w in words(text)]
        return [x % size for x in h] + [(31 * a + 17 * b + 7) % size for a, b in zip(h, h[1:])]

    for r in rows:
        for b in buckets(r.text):
            raw[b] += 1
            target[b] += r.doc_id in trusted
    ratios = [round(1000 * (np.log(t) - np.log(w) + np.log(sum(raw)) - np.log(sum(target)))) for t, w in zip(target, raw)]
    want = Counter()
    for r in rows:
        w, text = words(r.text), r.text or ""
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        at = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        failed = len(w) < 50 or 100 * len(at) > 50 * len(w)
        total = sum(ratios[b] for b in buckets(text))
        kept = not failed and total >= Q.THRESHOLD * max(1, 2 * len(w) - 1)
        want[r.doc_id, len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(at), failed, kept] += 1
    got = Counter(tuple(r)[:8] for r in Q.quality_rules(docs, labels, size).collect())
    assert got == want


def test_quality_classifier(spark, labels):
    from folioscope.llm.quality_classifier import classify, fit, quality_classifier

    table = spark.read.parquet(f"{SF}/documents.parquet")
    half = labels.where("doc_id % 2 = 0")
    scored = classify(table, fit(table, half)).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()  # held out
    good = [r.kept for r in scored if r.quality == 1]
    bad = [r.kept for r in scored if r.quality == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.6
    alone = quality_classifier(table.limit(0), labels)
    assert alone.collect() == []


def test_quality_classifier_rejects_junk(spark):
    from folioscope.llm.quality_classifier import best_cut, classify, fit

    good, bad = np.r_[-4.0, np.linspace(1, 5, 199)], np.r_[np.linspace(-9, -1, 40), 6]
    assert -1 < best_cut(good, bad) <= 1  # one odd good document does not set the cut
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = fit(table, marks.where("doc_id % 2 = 0"))
    scored = classify(table.join(marks.where("doc_id % 2 = 1").select("doc_id", "quality"), "doc_id"), model, ("quality",)).collect()  # held out
    good = [r.kept for r in scored if r.quality == 1]
    bad = [r.kept for r in scored if r.quality == 0]
    assert len(bad) > 200 and np.mean(good) > 0.98 and np.mean(bad) < 0.08


def test_quality_classifier_sees_every_unlabelled_document(spark, monkeypatch):
    from folioscope.llm import quality_classifier as Q

    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    calls, own = [], Q.Logistic.fit

    def fit(self, x, y, *more, times=None, **named):
        calls.append((x.shape, y, times))
        return own(self, x, y, *more, times=times, **named)

    monkeypatch.setattr(Q.Logistic, "fit", fit)
    first = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2500)
    assert Q.fit(table.join(first, "doc_id", "left_anti"), marks)  # labels of documents that have gone are replaced
    seed, pool = len(calls[0][1]), table.join(marks, "doc_id", "left_anti").count()
    share = Q.HANDOVER * pool
    for view in (0, 1):
        for turn in range(1, Q.ROUNDS + 1):
            handed = calls[2 * turn + view][2][seed:].sum() / min(1, seed / pool)
            assert 0.8 * turn * share < handed < 1.1 * turn * share
    assert Q._cut(np.array([5, 1, 3, 9]), np.array([4, 2, 1, 7]), 3, 8) == (3, 9)
    assert Q._cut(np.array([5, 1]), np.array([4, 2]), 1, 1) == (1, 5) and Q._cut(np.array([5]), np.array([4]), 1, 1) == (5, 6)


def brute_co_training(seed, rows, good, Q):
    """Co-training on dense arrays: who is handed over is read off a sorted list of all documents."""
    n = len(rows)
    dense = {"content": np.zeros((n, Q.CONTENT_DIM)), "meta": np.zeros((n, Q.METADATA_DIM))}
    for i, r in enumerate(rows):
        counts = np.frombuffer(r.counts, "<u4")
        dense["content"][i, np.frombuffer(r.buckets, "<u2")] = counts / max(1, counts.sum())
        dense["content"][i, Q.WORD_DIM + np.frombuffer(r.layout, "<u2").astype(int)] = 1 / 20
        dense["meta"][i, np.frombuffer(r.meta, "<u2")] = 1
    tie, group = np.array([r.tie for r in rows]), np.array([zlib.crc32(r.meta) % Q.GROUPS for r in rows])
    held = Q.held_out(seed["label"])
    scale = {"content": 20.0, "meta": 1.0}
    train = {v: [(x, y, 1.0) for x, y in zip(seed[v][~held], seed["label"][~held])] for v in dense}
    free, views, moved, shift = np.ones(n, bool), {}, 0, {}
    handed = {v: np.full(n, -1) for v in dense}
    unit = min(1.0, (~held).sum() / n)
    for turn in range(Q.ROUNDS + 1):
        for v in dense:
            x, y, t = (np.array(z, np.float32) for z in zip(*train[v]))
            views[v] = Q.Logistic().fit(x, y, Q.STEPS if v in views else Q.FIRST_STEPS, times=t.astype(float), start=views.get(v), shift=shift.get(v))
        if turn == Q.ROUNDS:
            break
        wanted = max(1, int(Q.HANDOVER * n))
        n_bad, n_good = max(1, round(wanted * (1 - good))), max(1, round(wanted * good))
        picked = {}
        for v in dense:
            score = dense[v] @ (views[v].w.astype(float) * scale[v]) + views[v].b
            step = np.floor(np.clip(score, -100, 100) * Q.SCORE_PARTS).astype(int) * Q.TIES + tie
            ranks = sorted(Counter(step[free].tolist()).items())
            low = high = None
            total = 0
            for value, k in ranks:
                total += k
                if low is None or total <= n_bad:
                    low = value
            total = 0
            for value, k in reversed(ranks):
                total += k
                if high is None or total <= n_good:
                    high = value
            picked[v] = np.where(step <= low, 0, np.where(step >= high, 1, -1))
        for teacher, pupil in (("meta", "content"), ("content", "meta")):
            for label in (0, 1):
                for g in range(Q.GROUPS):
                    who = free & (picked[teacher] == label) & (group == g)
                    if who.any():
                        moved += who.sum()
                        train[pupil].append((dense[pupil][who].mean(0) * scale[pupil], label, unit * who.sum()))
                handed[pupil][free & (picked[teacher] == label)] = label
            # the gradient of each document handed over so far, and what their groups' means give in its place
            x, y, t = (np.array(z) for z in zip(*train[pupil]))
            share = np.average(y, weights=t)
            class_weight = np.array([0.5 / (1 - share), 0.5 / share]) / t.sum()
            w, b = views[pupil].w.astype(float), views[pupil].b
            slope = lambda x, y, t: (class_weight[y.astype(int)] * t) * (1 / (1 + np.exp(-(x @ w + b))) - y)
            who = handed[pupil] >= 0
            own, seeds = dense[pupil][who] * scale[pupil], int((~held).sum())
            each, means = slope(own, handed[pupil][who], unit), slope(x[seeds:], y[seeds:], t[seeds:])
            shift[pupil] = (each @ own - means @ x[seeds:]).astype(np.float32), float(each.sum() - means.sum())
        free &= (picked["content"] < 0) & (picked["meta"] < 0)
    return views, moved


def test_co_training_against_dense_arrays(spark, labels):
    from folioscope.llm import quality_classifier as Q

    table = spark.read.parquet(f"{SF}/documents.parquet")
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    columns = (F.coalesce("label", F.lit(-1)).alias("label"), F.pmod(F.xxhash64("doc_id"), F.lit(Q.TIES)).cast("int").alias("tie"), F.col("text").cast("binary").alias("text"), "lang", "source", Q._size(table).alias("size"))
    rows = table.join(marks, "doc_id", "left").orderBy("doc_id").select(*columns)
    seed = Q._sample_features(rows.where("label >= 0"))
    pool = Q._features(rows.where("label < 0")).cache()
    seen, own = [], Q.Logistic.fit

    def fit(self, *args, **named):
        seen.append(self)
        return own(self, *args, **named)

    Q.Logistic.fit = fit
    try:
        model = Q.co_train(seed, pool, 0.8)
    finally:
        Q.Logistic.fit = own
    views, moved = brute_co_training(seed, pool.collect(), 0.8, Q)
    assert moved > 4 * Q.HANDOVER * pool.count()
    for got, want in zip(seen[-3:-1], (views["content"], views["meta"])):  # the last fit combines them
        assert np.corrcoef(got.w, want.w)[0, 1] > 0.999 and abs(got.b - want.b) < 0.02 * (1 + abs(want.b))
    assert set(model) == {"words", "layout", "meta", "bias", "threshold"}


def test_quality_classifier_edges(spark, labels):
    from folioscope.llm import quality_classifier as Q

    table = spark.read.parquet(f"{SF}/documents.parquet")
    long = "word " * 200_000
    odd = [(None, None, None, None, None), (90001, None, "en", "s", 3), (90002, "", None, "s", 0), (90003, " \n ", "en", None, None), (90004, long, "en", "s", len(long)), (90005, "same text", "en", "s", 9), (90005, "same text", "en", "s", 9)]
    rows = table.union(spark.createDataFrame(odd, table.schema)).withColumn("score", F.lit(1)).withColumn("kept", F.lit("x")).withColumn("_text", F.lit(2)).withColumn("a.b", F.lit(3))
    got = Q.quality_classifier(rows, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows.select("doc_id").collect())
    assert all(math.isfinite(r.score) for r in got) and len({r.score for r in got if r.doc_id == 90005}) == 1
    carried = Q.classify(rows, Q.fit(rows, labels), tuple(rows.columns))
    assert carried.columns == [*rows.columns, "_score", "_kept"]
    assert {(r.score, r.kept, r._text, r["a.b"]) for r in carried.collect()} == {(1, "x", 2, 3)}
    assert {r.kept for r in Q.classify(rows, None).collect()} == {True}
    # one row of an id is sampled, however often it is there; two labels a class do
    some = labels.where("doc_id is not null").dropDuplicates(["doc_id"])
    few = some.where("quality = 0").orderBy("doc_id").limit(2).union(some.where("quality = 1").orderBy("doc_id").limit(2))
    often = table.join(few, "doc_id", "left_semi").crossJoin(spark.range(50)).drop("id")
    taken = []
    own, Q._sample_features = Q._sample_features, lambda docs: taken.append(own(docs)) or taken[-1]
    try:
        assert Q.fit(table.union(often), few) and len(taken[0]["label"]) == 4
    finally:
        Q._sample_features = own
    assert Q.held_out(np.array([0, 1, 1, 1, 1, 1, 1, 1, 1, 0])).tolist() == [False] * 4 + [True] + [False] * 3 + [True, True]
    with pytest.warns(UserWarning):
        assert Q.fit(table, few.limit(1)) is None


def brute_tree(urls, prior, chance):
    """The tree of ``{(host, path): bad}`` by recursion: a function from host and path to template and share."""
    base = sum(urls.values()) / len(urls) if urls else 0.0
    smooth = lambda labels, above: (sum(labels) + prior * above) / (len(labels) + prior)
    cut = lambda path: [x for x in path.split("/") if x]
    domain = lambda host: ".".join(host.split(".")[-2:])

    def kl(p, q):
        return (p * math.log(p / q) if p > 0 else 0) + ((1 - p) * math.log((1 - p) / (1 - q)) if p < 1 else 0)

    def locate(host, path):
        share = base
        for same in (lambda h: domain(h) == domain(host), lambda h: h == host):
            labels = [bad for (h, _), bad in urls.items() if same(h)]
            if labels:
                share = smooth(labels, share)
        here = [(cut(p), bad) for (h, p), bad in urls.items() if h == host]
        template, segs, level = "", cut(path), 0
        while here and 0 < sum(b for _, b in here) < len(here):
            kids = defaultdict(list)
            for x, bad in here:
                kids[x[level] if level < len(x) else ""].append((x, bad))
            ended = kids.pop("", [])
            if not kids:
                break
            n, bad = sum(map(len, kids.values())), sum(b for k in kids.values() for _, b in k)
            literal = set()
            for seg, k in kids.items():
                own = sum(b for _, b in k)
                expected = (bad - own + share) / (n - len(k) + 1)
                if n == len(k) or len(k) * kl(own / len(k), expected) >= math.log(len(kids) / chance):
                    literal.add(seg)
            if level >= len(segs):
                return (template, smooth([b for _, b in ended], share) if ended else share)
            seg = segs[level]
            if seg in literal:
                here, step = kids[seg], seg
            else:
                here, step = [x for k, v in kids.items() if k not in literal for x in v], "*"
            if not here:
                return template, share
            template, share, level = f"{template}/{step}", smooth([b for _, b in here], share), level + 1
        return template, share

    return base, locate


def spam_urls(draw, n):
    """URLs whose labels depend on sections and hosts, with numbers that vary."""
    urls = {}
    while len(urls) < n:
        host = draw.choice(["a.test", "a.test", "a.test", "b.test", "shop.b.test", "spam.org.test"])
        section = draw.choice(["news", "blog", "promo", ""])
        tail = draw.choice(["", "x/", f"p{draw.randrange(4)}/"])
        k = draw.randrange(10**6)
        bad = section == "promo" and draw.random() < 0.95 or host.startswith("spam") and draw.random() < 0.9 or draw.random() < 0.05
        urls[host, f"/{section}/{tail}{k}".replace("//", "/")] = int(bad)
    return urls


def test_url_filter(spark):
    from folioscope.llm.url_filter import filter_urls

    urls = ["http://A.example.NET/en/1?x", "https://x.net", "https://x.net/a", "http://fr.org/fr/2#t", "http://example.com/de/3", None, "no scheme", "http://bad.test/spam/1", "http://example.network/a"]
    urls += [f"http://bad.test/spam/{i}" for i in range(100, 160)] + [f"http://bad.test/news/{i}" for i in range(200, 260)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("x")).withColumn("share", F.lit(1))
    marks = spark.createDataFrame([(i, 1) for i in range(100, 140)] + [(i, 0) for i in range(200, 240)] + [(None, 1), (7, None)], "url_key long, bad int")
    got = {r.page_id: r for r in filter_urls(pages, marks).collect()}
    assert len(got) == len(urls)
    assert (got[0].host, got[0].path, got[0].rule, got[0].verdict) == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[1].rule is None and got[2].verdict == "block" and got[3].rule == "org/fr/" and got[4].verdict == "block"
    assert (got[5].host, got[5].path, got[5].verdict) == ("", "", "allow") and got[6].path == "" and got[8].rule is None
    assert {got[i].verdict for i in range(9, 69)} == {"block"} and {got[i].verdict for i in range(69, 129)} == {"allow"}
    assert filter_urls(pages.limit(0), marks.limit(0)).collect() == []
    assert {r.verdict for r in filter_urls(pages.where("page_id > 8"), marks.limit(0)).collect()} == {"allow"}
    twice = filter_urls(pages.union(pages).union(spark.createDataFrame([(None, None, "x", 1)], pages.schema)), marks).collect()
    assert len(twice) == 2 * len(urls) + 1 and {(r.page_id, r.verdict) for r in twice if r.page_id is not None} == {(i, r.verdict) for i, r in got.items()}


def test_url_filter_against_a_brute_force_tree(spark):
    from folioscope.llm import url_filter as U

    draw = random.Random(5)
    urls = spam_urls(draw, 900)
    urls["deep.test", "/" + "/".join("d" * 10) + "/1"] = 1
    urls["deep.test", "/" + "/".join("d" * 10) + "/2"] = 0
    others = [(h, p) for h, p in spam_urls(draw, 300)] + [("new.b.test", "/promo/1"), ("", ""), ("a.test", "/promo/"), ("a.test", "/*/7"), ("deep.test", "/d/d")]
    labelled = spark.createDataFrame([(h, p, b) for (h, p), b in urls.items()], "host string, path string, bad int")
    base, locate = brute_tree(urls, U.PRIOR, U.CHANCE)
    asked = spark.createDataFrame([*urls, *others], "host string, path string")
    tree = U.grow(labelled)
    got = {(r.host, r.path): (r.template, r.share) for r in U.walk(asked, tree).collect()}
    assert tree.base == pytest.approx(base) and len(tree.levels) > 2
    for host, path in [*urls, *others]:
        template, share = locate(host, path)
        assert got[host, path] == (template, pytest.approx(share)), (host, path)
    # the verdicts of pages whose labels were held out follow the labels
    pages = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p) in enumerate(urls)], "page_id long, url string")
    held = [int(p.rsplit("/", 1)[1]) % 2 == 1 for _, p in urls]
    marks = spark.createDataFrame([(int(p.rsplit("/", 1)[1]), b) for (_, p), b in urls.items() if int(p.rsplit("/", 1)[1]) % 2 == 0], "url_key long, bad int")
    verdicts = {r.page_id: r.verdict for r in U.filter_urls(pages, marks).collect()}
    bad = {v: [b for i, b in enumerate(urls.values()) if held[i] and verdicts[i] == v] for v in ("block", "allow")}
    assert len(bad["block"]) > 100 and np.mean(bad["block"]) > 0.85 and np.mean(bad["allow"]) < 0.12


def test_url_filter_over_the_pages(spark):
    """Labels that follow the hosts are found on the given pages; those without any relation to URLs reject none."""
    from folioscope.llm.url_filter import filter_urls

    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    key = F.expr(r"try_cast(regexp_extract(url, '/([0-9]+)[^0-9/]*[/]?(?:[?#].*)?$', 1) as bigint)")
    named = F.col("url").rlike("spam|ads|cheap|casino|pills")
    rows = pages.select(key.alias("url_key"), F.when(named, F.pmod(F.xxhash64("url"), F.lit(10)) > 0).otherwise(F.pmod(F.xxhash64("url"), F.lit(20)) == 0).cast("int").alias("bad"))
    marks = rows.where("url_key % 2 = 0")
    out = filter_urls(pages, marks).where("rule is null").join(pages.select("page_id", named.alias("named")), "page_id").collect()
    blocked = [r.named for r in out if r.verdict == "block"]
    assert len(blocked) > 20 and np.mean(blocked) > 0.75 and np.mean([r.verdict == "block" for r in out if r.named]) > 0.6
    noise = rows.select("url_key", (F.pmod(F.xxhash64("url_key", F.lit(3)), F.lit(4)) == 0).cast("int").alias("bad"))
    assert np.mean([r.verdict == "block" for r in filter_urls(pages, noise).where("rule is null").collect()]) < 0.05


@pytest.mark.parametrize("percent,chunk", [(85, 512), (50, 3)])
def test_jaccard(spark, percent, chunk, monkeypatch):
    from folioscope.llm import jaccard_join as J

    monkeypatch.setattr(J, "CHUNK", chunk)
    rng = random.Random(3)
    texts = []
    for g in range(12):
        base = [f"v{rng.randrange(400)}" for _ in range(rng.choice([1, 3, 6, 40, 150]))]
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"v{rng.randrange(400)}"
            texts.append(" ".join(w))
    rows = list(enumerate(texts)) + [(500, None), (501, ""), (None, texts[0]), (3, texts[3])]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, percent).collect()}
    sets = {}
    for d, t in rows:
        w = words((t or "").lower())
        if d is not None:
            sets[d] = frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()
    comp = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                lo, hi = sorted((comp[a], comp[b]))
                comp = {k: lo if v == hi else v for k, v in comp.items()}
    assert got.pop(None)[1] is None
    assert got == {d: (len(sets[d]), comp[d]) for d in sets}


def test_jaccard_of_a_large_component_without_a_main_cluster(spark, monkeypatch):
    from folioscope.llm import jaccard_join as J

    monkeypatch.setattr(J, "CHUNK", 32)
    groups, own = [], J._joined

    def joined(sets, percent):
        groups.extend(r["count"] for r in sets.groupBy("comp", "chunk", "block").count().collect())
        return own(sets, percent)

    monkeypatch.setattr(J, "_joined", joined)
    draw = random.Random(2)
    heads = [[f"h{i}w{j}" for j in range(12)] for i in range(12)]
    tails = [[f"t{i}w{j}" for j in range(12)] for i in range(12)]
    texts = []
    for _ in range(700):  # parts are shared by many, but few texts are alike
        w = [*draw.choice(heads), *(f"o{draw.randrange(10**6)}" for _ in range(draw.randrange(3, 8))), *draw.choice(tails)]
        texts.append(" ".join(w))
        if draw.random() < 0.3:
            texts.append(" ".join([*w, f"o{draw.randrange(10**6)}"]))
    draw.shuffle(texts)
    sets = {d: frozenset(tuple(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)) for d, t in enumerate(texts)}
    comp, common = {d: d for d in sets}, Counter()
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            common.update((e, d) for e in holders[x])
            holders[x].append(d)
    for (a, b), n in common.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            lo, hi = sorted((comp[a], comp[b]))
            if lo != hi:
                comp = {k: lo if v == hi else v for k, v in comp.items()}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in J.jaccard_components(docs, 4, 85).collect()}
    assert got == comp and 150 < len(comp) - len(set(comp.values())) < 300
    assert len(groups) > 40 and max(groups) < 8 * 32  # no group holds a whole component


def test_jaccard_shuffles_leave_no_files(spark):
    """What a written step has shuffled goes at once; it would stay until the driver collects its garbage."""
    from pathlib import Path

    from folioscope.llm.common import materialize

    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {p for d in folders for p in Path(d).rglob("shuffle_*")}
    before = files()
    out = materialize(spark.range(1000).repartition(3, "id"), "freed")
    for _ in range(50):
        left = files() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and out.count() == 1000 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


@pytest.mark.parametrize("held", [1 << 20, 50])
def test_jaccard_blocks_are_joined_by_one_packed_shuffle(spark, held, monkeypatch):
    from folioscope.llm import jaccard_join as J

    monkeypatch.setattr(J, "HELD_KEYS", held)
    draw = random.Random(4)
    texts = [" ".join(f"v{draw.randrange(60)}" for _ in range(draw.randrange(5, 40))) for _ in range(120)]
    texts += [t + " end" for t in texts[:40]] + ["the same words in all of them " + t for t in texts[40:80]] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    import xxhash

    blocking = J.Blocking(80, J.frequent_shingles(docs, 5))
    sets = {xxhash.xxh3_128_intdigest(s.tobytes()) & (1 << 63) - 1: s for t in texts if len(s := J.shingle_set((t or "").encode(), 5))}
    holders = defaultdict(set)
    for d, s in sets.items():
        for x in blocking.keys(s).tolist():
            holders[x].add(d)

    def groups(edges):
        comp = {d: d for d in sets}
        for a, b in edges:
            lo, hi = sorted((comp[a], comp[b]))
            comp = {k: lo if v == hi else v for k, v in comp.items()}
        return comp

    edges = J._block_edges(docs, 5, 80)
    want = groups((a, min(x)) for x in holders.values() for a in x)
    assert groups(map(tuple, edges.collect())) == want and len(set(want.values())) < len(want) - 30
    # a key and its set take 13 bytes in the rows that are shuffled, and a key that many sets share goes on once
    packed = J._block_keys(docs.coalesce(1), 5, 80).where("not linked").collect()
    keys = sum(len(r.a) // J.KEY_BYTES for r in packed)
    assert sum(len(r.b) for r in packed) == 8 * keys and (held == 50 or keys == len(holders))


def test_jaccard_texts_that_nobody_asks_for_are_not_shuffled(spark, monkeypatch):
    from folioscope.llm import common
    from folioscope.llm import jaccard_join as J

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(3000)] + [(None, "none"), (7, "again 7")], "doc_id long, text string")
    side = common.materialize(docs.where("doc_id % 100 = 7").select("doc_id").distinct(), "asked")
    got = [r.doc_id for r in J._likely(docs, side).collect()]
    assert {*range(7, 3000, 100)} <= set(got) and got.count(7) == 2 and len(got) < 600
    digest = lambda t: __import__("xxhash").xxh3_128_intdigest(J.shingle_set(t.encode(), 4).tobytes()) & (1 << 63) - 1
    members = spark.createDataFrame([(i, digest(f"text {i}")) for i in range(0, 3000, 50)], "rep long, d1 long")
    whole = sorted((r.rep, bytes(r.s)) for r in J._fetch(docs, members, 4).collect())
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert sorted((r.rep, bytes(r.s)) for r in J._fetch(docs, members, 4).collect()) == whole and len(whole) == 60


def test_jaccard_across_chunks_in_rounds(spark, monkeypatch):
    """Sets are sent in rounds, all of them, so that what is on disk at once is bounded."""
    from folioscope.llm import jaccard_join as J

    monkeypatch.setattr(J, "CHUNK", 8)
    draw, texts = random.Random(5), []
    for _ in range(60):
        w = [f"h{draw.randrange(3)}w{j}" if j else "h" for j in range(2)] + ["a b c d e f g h i j k l"] + [f"o{draw.randrange(10**6)}" for _ in range(5)]
        texts += [" ".join(w), " ".join([*w, "end"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own, calls, found = J._joined, [], []
    monkeypatch.setattr(J, "_joined", lambda sets, percent: calls.append(1) or own(sets, percent))
    for most in (1 << 40, 16 << 10):
        monkeypatch.setattr(J, "ROUND_BYTES", most)
        calls.clear()
        rows = {r.doc_id: r.component_id for r in J.jaccard_components(docs, 4, 85).collect()}
        found.append((rows, len(calls)))
    assert found[0][0] == found[1][0] == {i: i - i % 2 for i in range(120)}
    assert found[0][1] == 3 and 3 < found[1][1] < 12


def test_sharding_against_a_walk_round_the_ring(spark, docs):
    """Row by row: each takes its home shard if that has room, the rest go on clockwise, in the same order."""
    from folioscope.llm import sharding as S

    many = docs.select("doc_id", "text").union(spark.createDataFrame([(None, None)] * 40 + [(7, "again")] * 25, "doc_id long, text string"))
    for n_shards in (3, 8):
        rows = []
        for r in many.collect():
            blob = (r.text or "").encode()
            cell = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:3], 16)
            rows.append((cell, zlib.crc32(blob) % S.CELL_PARTS, (r.doc_id is not None, r.doc_id or 0), len(blob) + 1, zlib.crc32(blob), r.doc_id))
        rows.sort(key=lambda r: r[:5])
        nodes = sorted((int.from_bytes(hashlib.md5(f"shard-{s}-node-{v}".encode()).digest()[:8], "big") * S.RING_CELLS >> 64, s) for s in range(n_shards) for v in range(S.VIRTUAL_NODES))
        room = [len(rows) // n_shards + (s < len(rows) % n_shards) for s in range(n_shards)]
        held, late = [0] * n_shards, []
        want = Counter()

        def put(r, shard):
            want[r[5], r[3], r[4], shard, held[shard]] += 1
            held[shard] += 1

        for r in rows:
            home = next((i for i, (p, _) in enumerate(nodes) if p >= r[0]), 0)
            if held[nodes[home][1]] < room[nodes[home][1]]:
                put(r, nodes[home][1])
            else:
                late.append((r, home))
        for r, home in late:
            step = home
            while held[nodes[step][1]] >= room[nodes[step][1]]:
                step = (step + 1) % len(nodes)
            put(r, nodes[step][1])
        got = Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in S.shard_rows(many, n_shards).collect())
        assert late and got == want


def test_sharding(spark, docs):
    from folioscope.llm.sharding import place, ring, shard_rows

    got = shard_rows(docs, 8).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    counts = {(c, p): random.Random(c * 8 + p).randrange(1, 20) for c in range(4096) for p in range(2)}

    def spread(n):
        return {(c, p, i): s for c, p, lo, hi, s, _ in place(counts, n, ring(n)) for i in range(lo, hi)}

    one, two = spread(8), spread(9)
    moved = sum(one[k] != two[k] for k in one) / len(one)
    assert 1 / 9 - 0.01 <= moved < 0.35  # limited movement
    assert shard_rows(docs.limit(0)).collect() == []


def best_of(rows, k=5):
    """``(query_id, rank, vec_id, score)`` by comparing every query row with every other row."""
    whole = {}
    for n, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[n] = i, [math.floor(Fraction(x) * 256) for x in v]
    out = Counter()
    for n, (i, v) in whole.items():
        if i % 50 == 0:
            score = lambda w: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w))))  # noqa: B023, E731
            best = sorted((-score(w), j) for m, (j, w) in whole.items() if m != n)[:k]
            out.update((i, r, j, -x) for r, (x, j) in enumerate(best, 1))
    return out


@pytest.mark.parametrize("piece,block", [(8192, 8192), (37, 3)])
def test_top_k(spark, piece, block, monkeypatch):
    from folioscope.llm import top_k as T

    monkeypatch.setattr(T, "PIECE_ROWS", piece)
    monkeypatch.setattr(T, "QUERY_BLOCK", block)
    monkeypatch.setattr(T, "SLICES", 4)
    monkeypatch.setattr(T, "SEED_ROWS", 20)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.1, 1, 3])).tolist()) for i in range(400)]
    rows += [(900, None), (901, [None] * 8), (902, [float("nan")] * 8), (903, [float("inf")] * 8), (904, []), (1000, []), (None, [1.0] * 8), (950, [2.0, 1.0])]
    rows += [(7, rows[7][1]), (50, rows[50][1]), (50, rows[51][1]), (100, rows[100][1]), (100, rows[100][1])]  # repeated ids, queries included
    rows += [(500 + i, rows[20][1]) for i in range(30)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("row", F.lit(1)).withColumn("x", F.lit("x"))
    got = Counter(tuple(r) for r in T.top_k(df, F.col("vec_id") % 50 == 0).collect())
    assert got == best_of(rows)
    assert T.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    one = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<double>")
    assert T.top_k(one, F.col("vec_id") % 50 == 0).collect() == []
    empty = spark.createDataFrame([(50, []), (51, []), (100, [])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, T.top_k(empty, F.col("vec_id") % 50 == 0).collect())) == [(50, 1, 51, 0), (50, 2, 100, 0), (100, 1, 50, 0), (100, 2, 51, 0)]


def test_top_k_of_large_components(spark):
    from folioscope.llm.top_k import top_k

    rows = [(0, [1e8, 1.0]), (1, [9e6, 0.0]), (2, [1.0, 3.0]), (50, [9e6, -2.0]), (51, [1e300, 1.0]), (52, [-1e8, 5e7]), (53, [0.0, 0.0])]
    rows += [(100, [1.7e308, 0.0]), (101, [-1.7e308, 1.0]), (150, [0.0, 1.0]), (102, [1e-300, 0.0]), (200, [3e7, 3e7]), (103, [2.0**28 + 0.5, -(2.0**28)])]
    got = Counter(tuple(r) for r in top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, k=20).collect())
    assert got == best_of(rows, 20)


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    from folioscope.llm.packing import json_encoder, pack

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = Counter()
    ids = {}
    for r in docs.collect():
        x = library.encode(r.text or "", add_special_tokens=False).ids + [1]
        want[r.doc_id, len(x)] += 1
        ids[r.doc_id] = np.array(x, "<u4")
    got = pack(docs, json_encoder(path)).collect()
    seen, windows = Counter(), defaultdict(list)
    for r in got:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        seen[r.doc_id, r.start] += 1
        windows[r.sequence_id].append((r.offset, r.length))
    covered = Counter()
    for r in got:
        covered[r.doc_id] += r.length
    assert covered == Counter({d: sum(n * t for (e, n), t in want.items() if e == d) for d, _ in want})
    last = max(windows)
    assert sorted(windows) == list(range(last + 1))
    for w, pieces in windows.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 2048 or w == last
    assert pack(docs.limit(0), json_encoder(path)).collect() == []


def round_robin(totals, weights, window):
    """Plain deficit round-robin, window by window: what each queue gives, and its deficit before it gives."""
    left, owed, out = list(totals), [0.0] * len(totals), []
    while sum(left):
        room = min(window, sum(left))
        want, share = room, [0.0] * len(left)
        before = list(left)
        while want > 1e-9:  # a queue that runs dry leaves its share to the others
            live = [s for s in range(len(left)) if before[s] - owed[s] - share[s] > 1e-9]
            if not live:
                break
            step = min([want] + [(before[s] - owed[s] - share[s]) * sum(weights[t] for t in live) / weights[s] for s in live])
            for s in live:
                share[s] += step * weights[s] / sum(weights[t] for t in live)
            want -= step
        owed = [o + x for o, x in zip(owed, share)]
        claim = list(owed)
        give = [math.floor(o + 1e-9) for o in owed]
        for s in sorted(range(len(left)), key=lambda s: (-round(owed[s] - give[s], 6) if give[s] < left[s] else math.inf, s))[: room - sum(give)]:
            give[s] += 1
        left = [x - g for x, g in zip(left, give)]
        owed = [o - g for o, g in zip(owed, give)]
        out.append((give, claim))
    return out


def test_packing_gives_what_deficit_round_robin_gives():
    from folioscope.llm.packing import given

    draw = random.Random(4)
    for case in range(30):
        size = draw.randrange(1, 9)
        totals = [draw.randrange(0, 4000) for _ in range(size)]
        weights = [float(t) for t in totals] if case % 2 else [draw.choice([1.0, 2.0, 5.0, 0.5]) for _ in totals]
        window = draw.choice([64, 100])
        rounds = round_robin(totals, weights, window)
        goals = np.minimum(np.arange(len(rounds) + 1) * window, sum(totals))
        edges = given(np.array(totals), np.array(weights), goals)
        assert (edges[0] == 0).all() and (edges[-1] == totals).all()
        for step, (give, claim) in zip(np.diff(edges, axis=0), rounds):
            assert step.tolist() == give and (abs(step - np.array(claim)) < 1 + 1e-6).all()  # each deficit is less than a token
        alone = given(np.array(totals), np.array(weights), goals[len(goals) // 2 :])
        assert (alone == edges[len(goals) // 2 :]).all()  # any window on its own


def test_packing_keeps_target_shares(spark, monkeypatch):
    from folioscope.llm import packing as P

    monkeypatch.setattr(P, "PART_TOKENS", 500)
    spaces = lambda: lambda texts: (np.concatenate([np.array([int(x) for x in t.as_py().split()], np.uint16) for t in texts] or [np.zeros(0, np.uint16)]), np.array([len(t.as_py().split()) for t in texts]))
    draw = random.Random(6)
    rows, n = [], 0
    for source, count in (("a", 120), ("b", 60), (None, 30), *((f"rare{i}", 1) for i in range(40))):
        for _ in range(count):
            rows.append((n, " ".join(str(draw.randrange(2, 999)) for _ in range(draw.randrange(0, 90) if count > 1 else 3)), source))
            n += 1
    rows += [(n, "7 " * 3000, "a"), (None, "", "a"), (None, None, "b"), (n + 1, "5", "b"), (n + 1, "5", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("queue", F.lit(1)).withColumn("part", F.lit("x"))
    size = {}
    for d, t, s in rows:
        size[s or ""] = size.get(s or "", 0) + len((t or "").split()) + 1
    whole, window = sum(size.values()), 128
    source = {d: s or "" for d, _, s in rows}
    for targets in (None, {"a": 1.0, "b": 3.0, "rare0": 0.0, "rare1": 0.001, "none": 2.0}):
        got = P.pack(docs, spaces, window, targets).collect()
        filled = defaultdict(Counter)
        for r in got:
            filled[r.sequence_id][source[r.doc_id] if r.doc_id is not None else "?"] += r.length
        assert sum(r.length for r in got) == whole and sorted(filled) == list(range(-(-whole // window)))
        assert all(sum(c.values()) == window for w, c in filled.items() if w < max(filled))
        places = defaultdict(list)
        for r in got:
            places[r.sequence_id].append((r.offset, r.length))
        assert all(sum(x for _, x in sorted(v)[:i]) == o for v in places.values() for i, (o, _) in enumerate(sorted(v)))
        share = {s: t / whole for s, t in size.items()} if targets is None else {"a": 1 / 4, "b": 3 / 4}
        end = max(filled) if targets is None else int(size["b"] / (window * 3 / 4)) - 1
        for s in ("a", "b", ""):
            for w in range(end):  # two roundings of a window's edges, and the pieces without an id
                assert abs(filled[w][s] - window * share.get(s, 0)) <= 2 + filled[w]["?"]
        rare = [r.sequence_id for r in got if source.get(r.doc_id, "").startswith("rare")]
        assert targets or max(rare) - min(rare) > 0.7 * max(filled)


def test_substring_dedup(spark):
    from folioscope.llm.substring_dedup import remove_units, repeated_units

    line = lambda n, k: " ".join(f"x{k}w{i}" for i in range(n))
    a, b, c = line(60, 1), line(20, 2), line(20, 3)
    rows = [
        (1, f"{a}\nown one", 0), (2, f"start\n{a.upper()}\nend", 0), (3, f"{b}\n{c}", 0), (4, f"head\n{b}\n{c}\ntail", 0), (5, f"{b}\nother", 0),
        (6, None, None), (7, "", 0), (None, a, 0), (1, f"{a}\nown one", 0), (8, f"{a}\nmid\n{a}", 0),
        (9, f"{b}\n \n{c}\n\nlast", 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    units = repeated_units(docs)
    assert {(r.doc_id, r.unit, r.first_doc_id) for r in units.collect()} == {(2, 1, 1), (4, 1, 3), (4, 2, 3), (None, 0, 1), (8, 0, 1), (8, 2, 1), (9, 0, 3), (9, 1, 3)}
    for r in units.collect():
        text = next(t for d, t, _ in rows if d == r.doc_id)
        assert text[r.start : r.stop].lower() in (a, b, c)
    out = Counter((r.doc_id, r.text) for r in remove_units(docs, units).collect())
    assert out[2, "start\nend"] == 1 and out[4, "head\ntail"] == 1 and out[8, "mid\n"] == 1 and out[1, f"{a}\nown one"] == 2 and out[5, f"{b}\nother"] == 1
    assert sum(out.values()) == len(rows) and out[None, ""] == 1
    assert repeated_units(docs.limit(0)).collect() == []


def brute_units(text):
    """Units with a word, character by character: (start, stop, normalised words)."""
    out, at, i = [], 0, 0
    while i <= len(text):
        edge = None
        if i == len(text):
            edge = i
        elif text[i] in ".!?,;:":
            j = i + 1
            while j < len(text) and text[j] in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
                j += 1
            edge = next((k for k in range(j, len(text)) if not text[k].isspace()), len(text)) if j < len(text) and text[j].isspace() else None
        elif text[i] == "\n":
            edge = i + 1
        if edge is None:
            i += 1
            continue
        piece = text[at:edge]
        if piece.strip():
            out.append((at + len(piece) - len(piece.lstrip()), at + len(piece.rstrip()), " ".join(piece.lower().split())))
        at, i = edge, edge + (edge == len(text))
    return out


def test_substring_dedup_against_brute_force(spark):
    from folioscope.llm.substring_dedup import remove_units, repeated_units

    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abcdefgh", k=draw.randrange(2, 7)))
    prose = lambda n: "".join(word() + draw.choice([" "] * 12 + [", ", ". ", ".\n", '." ', "\n", ",\u00a0"]) for _ in range(n))
    passages = [prose(60) for _ in range(6)]
    rows, planted = [], defaultdict(list)
    for d in range(80):
        text = prose(draw.randrange(20, 200)) + word() + " "
        if d % 3 == 0:
            k = draw.randrange(6)
            planted[k].append(d)
            text += passages[k] + prose(40)
        rows.append((d, text, "x"))
    rows += [(90, "y " * 30_000 + passages[0], "x"), (91, passages[1], "x"), (92, passages[1], "x"), (92, passages[1], "x"), (93, None, None), (94, "", "x"), (None, passages[2], "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _hash string").withColumn("_cuts", F.lit(1)).withColumn("start", F.lit(None).cast("int")).withColumn("a.b", F.lit(2))
    first, want, cuts = {}, set(), {}
    for d, text in sorted({(d, t or "") for d, t, _ in rows}, key=lambda r: (r[0] is None, r)):
        units, run = brute_units(text), []
        for n, (start, stop, key) in enumerate([*units, (None, None, None)]):
            seen = key is not None and first.setdefault(key, (d, n)) != (d, n)
            if seen:
                run.append((d, n, start, stop, len(key.split()), *first[key]))
            else:
                if sum(x[4] for x in run) >= 30:
                    want |= set(run)
                    cuts.setdefault(d, []).append((run[0][2], run[-1][3]))
                run = []
    units = repeated_units(frame)
    got = [tuple(r[c] for c in ("doc_id", "unit", "start", "stop", "n_words", "first_doc_id", "first_unit")) for r in units.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    for found in planted.values():  # the passage begins and ends inside lines in all of them
        assert set(found[1:]) <= set(cuts)
    out = remove_units(frame, units)
    assert out.columns == frame.columns and Counter(r.doc_id for r in out.collect()) == Counter(r[0] for r in rows)
    squeeze = lambda t: None if t is None else "".join(t.split())
    for r in out.collect():
        whole = next(t for d, t, _ in rows if d == r.doc_id)
        for a, b in reversed(cuts.get(r.doc_id, [])):
            whole = whole[:a] + whole[b:]
        assert squeeze(r.text) == squeeze(whole) and r._cuts == 1 and r["a.b"] == 2


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(corpus_pipeline.STAGES) == 5 and sum(r.length for r in rows) > 100_000


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """A folder of tables whose documents have null and repeated ids, null and empty texts, repeated rows and columns with clashing names."""
    folder = tmp_path_factory.mktemp("odd")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    first = docs.orderBy(F.desc("n_chars")).first()
    other = docs.where("n_chars > 900").orderBy("doc_id").first()
    rows = [(None, None, None, None, None), (None, first.text, "en", "s", 1), (None, first.text, "en", "s", 1), (9001, None, "en", None, None), (9002, "", None, "s", 0), (9003, " \n ", "en", "s", None)]
    rows += [(9004, first.text + " and more", "en", "s", 7), (9004, other.text, "de", "s", 8), (9004, other.text, "de", "s", 8), (9005, "word " * 100_000, "en", "s", 9), (None, "short one", "en", "s", 2)]
    table = docs.union(spark.createDataFrame(rows, docs.schema))
    table = table.withColumn("kept", F.lit("k")).withColumn("score", F.lit(1)).withColumn("_whole", F.lit(2)).withColumn("text_hash", F.lit(3)).withColumn("a.b", F.lit(4)).withColumn("_cuts", F.lit(5))
    table.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").union(spark.createDataFrame([(None, 1, 0), (9004, 0, None)], "doc_id long, quality int, toxic int")).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_stages_on_odd_rows(spark, odd_dir):
    import corpus_pipeline as P
    from folioscope.llm.jaccard_join import jaccard_components
    from folioscope.llm.quality_classifier import classify, fit
    from folioscope.llm.quality_rules import quality_rules

    docs, labels = (spark.read.parquet(f"{odd_dir}/{t}.parquet") for t in ("documents", "labels"))
    bag = lambda df: Counter(tuple(r) for r in df.collect())
    rows = bag(docs)
    # rules: rows go exactly if the operator rejects them, null ids and texts too
    judged = defaultdict(set)
    for r in quality_rules(docs, labels).select("doc_id", "kept").collect():
        judged[r.doc_id].add(r.kept)
    out = P.quality_rules(spark, docs, odd_dir)
    got = bag(out)
    assert out.columns == docs.columns and not got - rows
    assert got[next(k for k in rows if k[0] is None and k[1] == "short one")] == 0
    single = {k: n for k, n in rows.items() if k[0] is not None and len(judged[k[0]]) == 1}
    assert {k: n for k, n in got.items() if k in single} == {k: n for k, n in single.items() if judged[k[0]] == {True}}
    # classifier: the columns stay, whatever their names; fitted on the documents as they came in
    part = docs.where("doc_id is null or doc_id % 2 = 0")
    out = P.quality_classifier(spark, part, odd_dir)
    scored = classify(part, fit(docs, labels), ("doc_id", "text"))
    assert out.columns == docs.columns and Counter(r[0] for r in out.collect()) == Counter(r[0] for r in scored.where(F.col(scored.columns[-1])).collect())
    # near duplicates: no two kept documents link, what goes has a smaller one, ids stand for one document, rows without id stay
    out = P.near_duplicates(spark, docs, odd_dir)
    kept = out.collect()
    assert out.columns == docs.columns and not bag(out) - rows
    assert sum(r.doc_id is None for r in kept) == sum(n for k, n in rows.items() if k[0] is None)
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    component = {r.doc_id: r.component_id for r in jaccard_components(docs, k=5, percent=80).collect() if r.doc_id is not None}
    assert sorted(ids) == sorted({d for d, c in component.items() if d == c})
    if 9004 in ids:
        assert next(r.text for r in kept if r.doc_id == 9004) == min(k[1] for k in rows if k[0] == 9004)
    # repeated passages: no row goes, texts only shrink
    out = P.substring_dedup(spark, docs, odd_dir)
    assert out.columns == docs.columns and Counter(r[0] for r in out.collect()) == Counter(k[0] for k in rows.elements())
    # packing: every token of every row, in sequences of at most 2048
    packed = P.packing(spark, docs, odd_dir).collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == Counter(k[0] for k in rows.elements())
    length = Counter()
    for r in packed:
        length[r.sequence_id] += r.length
    assert max(length.values()) <= 2048
    none = docs.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, none, odd_dir).collect() == []


def test_classifier_stage_needs_no_documents_table(spark, labels, tmp_path):
    """The stage fits on what it is given; the folder has only the other tables by then."""
    import corpus_pipeline as P
    from folioscope.llm.quality_classifier import classify, fit

    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 3 > 0")
    out = P.quality_classifier(spark, docs, str(tmp_path))
    kept = classify(docs, fit(docs, labels), ("doc_id",)).where("kept")
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in kept.collect())


def test_pipeline_on_odd_rows(spark, odd_dir):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, odd_dir)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    want = Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in P.packing(spark, docs, odd_dir).collect())
    got = Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in P.run(spark, odd_dir).collect())
    assert sum(n * k[2] for k, n in got.items()) == sum(n * k[2] for k, n in want.items()) > 10_000
    assert {k[0] for k in got} == {k[0] for k in want}


EDGES = ["", None, " ", "it's we'll L'été 'S", "<|endoftext|> x", "é Ǆ İstanbul ẞß", "a\u2003b\u00a0c\x1cd", "日本語 テスト", "ÀÉÎ×÷œ", "1234 12a3", "x" * 3000, "ab" * 70, "tab\tnl\nvt\x0bcr\r\n\n", "\x00 a\x00b", "A\u0308 ô", "%%% ### a%b"]


def test_byte_bpe_words_equal_the_library():
    import numpy as np
    import public_tokenizers
    import regex
    import tiktoken
    from folioscope.llm.byte_bpe import WordCoder, pair_index, read_ranks

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = WordCoder(ranks, pair_index(ranks))
    for text in EDGES:
        words = [w.encode() for w in regex.findall(public_tokenizers.PATTERN, text or "")]
        ids, count = coder.encode(words)
        assert ids.tolist() == library.encode_ordinary(text or "")
        assert len(count) == len(words) and coder.decode(np.asarray(ids))[0] == (text or "").encode()
    draw, alphabets = random.Random(1), [b"ab", b"a", b"the anox", bytes(range(256)), "éàñüß".encode(), b"  \n", b"=-_.*#"]
    words = [bytes(draw.choices(draw.choice(alphabets), k=draw.choice([1, 2, 5, 9, 20, 70, 300]))) for _ in range(3000)]
    words += [b"a" * 99_999, b"ab" * 50_000]
    ids, count = coder.encode(words)
    for word, own in zip(words, np.split(ids, np.cumsum(count)[:-1])):
        assert own.tolist() == library._core_bpe.encode_single_piece(word)


def test_packing_encoder_equals_the_library():
    import numpy as np
    import public_tokenizers
    import pyarrow as pa
    from folioscope.llm.packing import json_encoder
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    ids, count = json_encoder(path)()(pa.array([(x or "").encode() for x in EDGES], pa.binary()))
    want = [library.encode(x or "", add_special_tokens=False).ids for x in EDGES]
    assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == want


@pytest.mark.parametrize("name", ["op6_ngram_jaccard_join", "op8_exact_top_k", "op10_substring_dedup", "op11_suffix_array_dedup", "op12_source_audit"])
def test_query_equals_its_sql(spark, name):
    import duckdb
    from folioscope.llm.queries import oracle_sql, queries

    sf_dir = "/root/testdata/sf0.001"
    with duckdb.connect() as db:
        for table in ("documents", "embeddings"):
            db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        want = db.sql(oracle_sql()[name])
        got = queries()[name](spark, sf_dir).select(*want.columns).collect()
        want = want.fetchall()
    assert sorted(map(tuple, got)) == sorted(want) and want
