"""URL filters: host and path rules, and a path-template tree for what no rule decides.

Every host has a tree, grown level by level from the distinct URLs that labels
mark.  At each node the segments whose labelled purity cannot be told from that
of their siblings are merged into one wildcard branch; the others stay.  A
template's bad share is smoothed towards that of its parent node, a host's
towards its domain's, and a domain's towards that of all labels.  The bar from
which templates are rejected is chosen on labels held out of a first tree.

DataFrame functions only.  Trees are small tables in the shared folder; pages
walk down them by joins and are themselves neither shuffled nor aggregated
while those tables are small enough to broadcast.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, discard, join_hot, materialize

#: (action, host, path prefix)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: A branch stays literal if chance gives one of a node's branches its labels with at most this probability.
CHANCE = 0.001
#: Weight, in labelled URLs, of the parent's bad share in a node's.
PRIOR = 10.0
#: Bars to choose from, as multiples of the bad share of all labels.
LIFTS = (1.25, 1.5, 2.0, 3.0, 4.0, 6.0)
#: A bar needs held-out labels that chance gives to one of the bars with at most this probability.
BAR_CHANCE = 0.05
#: One labelled URL in so many is held out.
HELD_OUT = 4
#: Levels of a tree that pages walk in one plan; deeper trees write the pages in between.
PLAN_LEVELS = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for null or without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its action; null where none does."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, rule_host, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(prefix)
        name = F.when(fits, F.lit(rule_host + prefix)).otherwise(name)
        action = F.when(fits, F.lit(act)).otherwise(action)
    return name, action


def divergence(share: Column, expected: Column) -> Column:
    """Kullback-Leibler divergence of two Bernoulli shares; ``expected`` lies between 0 and 1."""
    one = lambda p, q: F.when(p > 0, p * F.log(p / q)).otherwise(0.0)
    return one(share, expected) + one(1 - share, 1 - expected)


class Tree(NamedTuple):
    """``domains(domain, share)``, ``hosts(host, share)``, and the branches of each level.

    A branch is ``host, template, seg, to, share``: from a node by a segment to
    a node.  ``seg`` is null for the wildcard and empty where the path ends.
    """

    base: float
    domains: DataFrame
    hosts: DataFrame
    levels: list[DataFrame]

    def discard(self) -> None:
        for table in (self.domains, self.hosts, *self.levels):
            discard(table)


def _domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def _smoothed(parent: Column) -> Column:
    return (F.col("bad") + PRIOR * parent) / (F.col("n") + PRIOR)


def _enter(urls: DataFrame, tree: Tree) -> DataFrame:
    """``urls(host, path, ...)`` at the roots: with ``segs, template, share``."""
    hosts = tree.hosts.withColumnRenamed("share", "_of_host")
    domains = tree.domains.withColumnRenamed("share", "_of_domain")
    return (
        urls.withColumn("domain", _domain(F.col("host")))
        .join(_small(tree.hosts, hosts), "host", "left")
        .join(_small(tree.domains, domains), "domain", "left")
        .withColumn("share", F.coalesce("_of_host", "_of_domain", F.lit(tree.base)))
        .withColumn("segs", F.filter(F.split("path", "/"), lambda s: s != ""))
        .withColumn("template", F.lit(""))
        .drop("domain", "_of_host", "_of_domain")
    )


def _small(table: DataFrame, view: DataFrame) -> DataFrame:
    view._scratch_path = table._scratch_path
    return broadcast_if_small(view)


def _descend(urls: DataFrame, branches: DataFrame, level: int) -> DataFrame:
    """One level down; URLs at nodes without a branch for them stay."""
    seg = F.coalesce(F.get("segs", F.lit(level)), F.lit(""))
    literal = branches.where("seg is not null").select("host", "template", "seg", F.col("to").alias("_to"), F.col("share").alias("_share"))
    wild = branches.where("seg is null").select("host", "template", F.col("to").alias("_any"), F.col("share").alias("_any_share"))
    on = F.col("seg") != ""
    columns = [c for c in urls.columns if c not in ("template", "share")]
    return (
        urls.withColumn("seg", seg)
        .join(_small(branches, literal), ["host", "template", "seg"], "left")
        .join(_small(branches, wild), ["host", "template"], "left")
        .select(
            *columns,
            F.coalesce("_to", F.when(on, F.col("_any")), "template").alias("template"),
            F.coalesce("_share", F.when(on, F.col("_any_share")), "share").alias("share"),
        )
    )


def walk(urls: DataFrame, tree: Tree) -> DataFrame:
    """``urls(host, path, ...)`` with the ``template`` and its smoothed bad ``share``."""
    at = _enter(urls, tree)
    for level, branches in enumerate(tree.levels):
        at = _descend(at, branches, level)
        if level % PLAN_LEVELS == PLAN_LEVELS - 1:
            at = materialize(at, "urlwalk")
    return at.drop("segs")


def grow(urls: DataFrame) -> Tree:
    """The tree of ``urls(host, path, bad)``, distinct labelled URLs with 0 or 1 for bad.

    A node all of whose labels agree is not divided further, since no branch
    could differ, nor is one at which all paths end.  A branch of ``n`` labels stays literal if ``n`` times the
    divergence of its bad share from its siblings' (these smoothed by one label
    of the node's share) exceeds ``log(branches / CHANCE)``, which bounds the
    probability that chance does it in any of the node's branches; a node's
    only branch stays too.  Levels end when no node is divided.
    """
    n, bad = urls.agg(F.count("*"), F.sum("bad")).first()
    base = (bad or 0) / n if n else 0.0
    counts = (F.count("*").alias("n"), F.sum("bad").alias("bad"))
    hosts = urls.groupBy("host").agg(*counts).withColumn("domain", _domain(F.col("host")))
    domains = materialize(
        hosts.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).select("domain", _smoothed(F.lit(base)).alias("share")),
        "urldomain",
    )
    rooted = hosts.join(_small(domains, domains.withColumnRenamed("share", "above")), "domain")
    roots = materialize(rooted.select("host", _smoothed(F.col("above")).alias("share"), "n", "bad"), "urlhost")
    tree = Tree(base, domains, roots.select("host", "share"), [])
    tree.hosts._scratch_path = roots._scratch_path
    here = _enter(urls, tree)
    mixed = "bad > 0 and bad < n"
    nodes = roots.where(mixed).select("host", F.lit("").alias("template"), F.col("share").alias("above"))
    nodes._scratch_path = roots._scratch_path
    while True:
        level = len(tree.levels)
        open_ = here.select("host", "template", "bad", F.coalesce(F.get("segs", F.lit(level)), F.lit("")).alias("seg"))
        kids = open_.join(broadcast_if_small(nodes), ["host", "template"]).groupBy("host", "template", "above", "seg").agg(*counts)
        kids = materialize(kids, "urlkids")
        if kids.where("seg <> ''").isEmpty():
            discard(kids)
            return tree
        whole = kids.where("seg <> ''").groupBy("host", "template").agg(
            F.sum("n").alias("pn"), F.sum("bad").alias("pb"), F.count("*").alias("branches")
        )
        whole = materialize(whole, "urlsums")
        other = F.col("pn") - F.col("n")
        expected = (F.col("pb") - F.col("bad") + F.col("above")) / (other + 1)
        unlike = F.col("n") * divergence(F.col("bad") / F.col("n"), expected) >= F.log(F.col("branches") / CHANCE)
        judged = kids.join(broadcast_if_small(whole), ["host", "template"]).withColumn(
            "literal", (F.col("seg") == "") | (other == 0) | unlike
        )
        merged = judged.groupBy("host", "template", "above", F.when(F.col("literal"), F.col("seg")).alias("seg")).agg(
            F.sum("n").alias("n"), F.sum("bad").alias("bad")
        )
        to = F.when(F.col("seg") == "", F.col("template")).otherwise(F.concat("template", F.lit("/"), F.coalesce("seg", F.lit("*"))))
        branches = materialize(
            merged.select("host", "template", "seg", to.alias("to"), _smoothed(F.col("above")).alias("share"), "n", "bad"), "urlbranch"
        )
        discard(kids)
        discard(whole)
        slim = branches.select("host", "template", "seg", "to", "share")
        slim._scratch_path = branches._scratch_path
        tree.levels.append(slim)
        here = materialize(_descend(here, slim, level), "urlhere")
        nodes = branches.where(mixed).where("seg is null or seg <> ''").select("host", F.col("to").alias("template"), F.col("share").alias("above"))
        nodes._scratch_path = branches._scratch_path


def reject_bar(urls: DataFrame) -> float:
    """The bad share from which templates are rejected; infinite if no bar holds on labels held out.

    A tree is grown without a part of the labelled URLs, which are then judged
    by it.  Of ``LIFTS`` the one is taken whose rejected URLs have the labels
    that chance gives them least, by the same bound as in :func:`grow`, if that
    is under ``BAR_CHANCE``.
    """
    fold = F.pmod(F.xxhash64("host", "path"), F.lit(HELD_OUT)) == 0
    tree = grow(urls.where(~fold))
    held = walk(urls.where(fold), tree)
    bars = [tree.base * lift for lift in LIFTS]
    sums = [x for i, b in enumerate(bars) for x in (F.count_if(F.col("share") >= b).alias(f"n{i}"), F.sum(F.when(F.col("share") >= b, F.col("bad"))).alias(f"b{i}"))]
    got = held.agg(*sums).first()
    tree.discard()
    best, most = math.inf, math.log(len(bars) / BAR_CHANCE)
    for i, bar in enumerate(bars):
        n, bad = got[f"n{i}"], got[f"b{i}"] or 0
        if not 0 < tree.base < 1 or not n or bad / n <= tree.base:
            continue
        p, q = bad / n, tree.base
        gain = n * (p * math.log(p / q) + ((1 - p) * math.log((1 - p) / (1 - q)) if p < 1 else 0.0))
        if gain > most:
            best, most = bar, gain
    return best


def labelled_urls(parsed: DataFrame, labels: DataFrame) -> DataFrame:
    """``host, path, bad`` of every distinct URL whose path ends in the number of a label (an extension or slash aside).

    Repeated URLs are one observation; they are combined in the tasks that read
    them.  Labels of very frequent numbers are broadcast.
    """
    number = F.expr(r"try_cast(regexp_extract(path, '/([0-9]+)(?:[^0-9/][^/]*)?/?$', 1) as bigint)")
    urls = materialize(parsed.select("host", "path", number.alias("url_key")).where("url_key is not null").distinct(), "urls")
    marks = labels.where("url_key is not null and bad is not null").groupBy("url_key").agg(F.max("bad").alias("bad"))
    times = urls.groupBy("url_key").agg(F.count("*").alias("times"))
    known = materialize(marks.join(times, "url_key"), "urlmarks")
    return materialize(join_hot(urls, known, ["url_key"], "times", urls.count()).select("host", "path", "bad"), "labelled")


def filter_urls(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, bad_share`` for every row of ``pages(page_id, url)``.

    ``labels(url_key, bad)`` marks pages by the number in their path (the
    document that the page shows); several labels of a number count as bad if
    one is.  A rule decides where one fits; elsewhere the template does, which
    is rejected if its smoothed share of bad labels reaches the bar.  A URL
    without labels below its node has the share of the last node on its way.
    Null URLs and those without ``://`` have an empty host and path.  Repeated
    rows are judged alike; without labels, with labels that all agree, or where
    no bar holds on held-out labels, nothing is rejected; an empty table gives
    none; other columns are not carried.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = labelled_urls(parsed, labels)
    bar, tree = reject_bar(urls), grow(urls)
    name, action = rule_columns(F.col("host"), F.col("path"), rules)
    by_tree = F.when(F.col("share") >= bar, F.lit("block")).otherwise(F.lit("allow"))
    return walk(parsed, tree).select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(action, by_tree).alias("verdict"), "template", F.col("share").alias("bad_share")
    )
