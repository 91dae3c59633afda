"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark, sf_dir, model_file=None):
    from .token_count import count_tokens, read_pieces

    pieces = read_pieces(model_file or public_tokenizers.path("piece_bpe_32k.model"))
    return count_tokens(_table(spark, sf_dir, "documents"), pieces)


def op3_url_filter(spark, sf_dir):
    from .url_filter import filter_urls

    labels = _table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("url_key"),
        F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).alias("bad"),
    )
    return filter_urls(_table(spark, sf_dir, "pages"), labels)


def op4_byte_bpe(spark, sf_dir, rank_file=None):
    from .byte_bpe import encode_documents, read_ranks

    ranks = read_ranks(rank_file or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return encode_documents(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op5_quality_rules(spark, sf_dir):
    from .quality_rules import quality_rules

    return quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_ngram_jaccard_join(spark, sf_dir):
    from .jaccard_join import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents"), k=4, percent=85)


def op7_sharding(spark, sf_dir):
    from .sharding import shard_rows

    return shard_rows(_table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark, sf_dir):
    from .quality_classifier import quality_classifier

    return quality_classifier(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_exact_top_k(spark, sf_dir):
    from .top_k import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_packing(spark, sf_dir, tokenizer_file=None):
    from .packing import json_encoder, pack

    encoder = json_encoder(tokenizer_file or public_tokenizers.path("word_bpe_49k.json"))
    return pack(_table(spark, sf_dir, "documents"), encoder)


def op10_substring_dedup(spark, sf_dir):
    from .substring_dedup import repeated_units

    return repeated_units(_table(spark, sf_dir, "documents")).drop("text_hash", "cut_start", "cut_stop")


def op11_suffix_array_dedup(spark, sf_dir):
    from .suffix_dedup import suffix_array_dedup

    return suffix_array_dedup(_table(spark, sf_dir, "documents"))


def op12_source_audit(spark, sf_dir):
    from .source_audit import source_divergence

    return source_divergence(_table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark, sf_dir):
    from .whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def queries():
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


EXACT_TOP_K_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


#: White space as Python's ``str.split`` takes it, what else a unit ends with, and a unit with its end.
_SPACE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_UNIT = rf"(?s).+?(?:[.!?,;:][!-/:-@\[-`{{-~]*[{_SPACE}]+|\n|$)"

SUBSTRING_DEDUP_SQL = f"""
WITH a AS (
  SELECT doc_id, unnest(p) AS piece, unnest(range(len(p))) AS n FROM (SELECT doc_id, regexp_extract_all(text, '{_UNIT}') AS p FROM documents)
), b AS (
  SELECT doc_id, n, piece, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY n) - length(piece) AS pos,
    trim(regexp_replace(lower(piece), '[{_SPACE}]+', ' ', 'g')) AS words FROM a
), u AS (
  SELECT *, pos + length(piece) - length(regexp_replace(piece, '^[{_SPACE}]+', '')) AS start, pos + length(regexp_replace(piece, '[{_SPACE}]+$', '')) AS stop,
    length(words) - length(replace(words, ' ', '')) + 1 AS n_words, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS unit FROM b WHERE words <> ''
), f AS (
  SELECT *, first_value(doc_id) OVER w AS first_doc_id, first_value(unit) OVER w AS first_unit FROM u WINDOW w AS (PARTITION BY words ORDER BY doc_id, unit)
), late AS (
  SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS run FROM f WHERE doc_id <> first_doc_id OR unit <> first_unit
), t AS (SELECT *, sum(n_words) OVER (PARTITION BY doc_id, run) AS run_words FROM late)
SELECT doc_id, unit::INTEGER AS unit, start::INTEGER AS start, stop::INTEGER AS stop, n_words::INTEGER AS n_words,
  first_doc_id, first_unit::INTEGER AS first_unit FROM t WHERE run_words >= 30
"""

JACCARD_JOIN_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS s FROM w WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
g AS (SELECT doc_id, string_agg(s, chr(10) ORDER BY s) AS whole FROM s GROUP BY doc_id),
r AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY whole) AS rep FROM g),
c AS (SELECT s.doc_id, s.s FROM s JOIN r ON s.doc_id = r.rep AND r.doc_id = r.rep),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM c x JOIN c y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
k AS (SELECT doc_id AS node, doc_id AS low FROM r WHERE doc_id = rep UNION SELECT e.b, k.low FROM k JOIN e ON k.node = e.a WHERE k.low < e.b),
m AS (SELECT node, min(low) AS low FROM k GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.low, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN m ON m.node = r.rep
"""


SUFFIX_DEDUP_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS ord, hex(encode(coalesce(text, ''))) AS h FROM documents
), f AS (SELECT rid, ord, len(h) // 2 AS n, h, unnest(range((len(h) // 2 + 63) // 64)) AS k FROM d),
e AS (SELECT rid, ord, n, 64 * k AS base, substr(h, 128 * k + 1, 226) AS piece FROM f),
u AS (SELECT rid, ord, n, base, piece, unnest(range(64)) AS j FROM e),
w AS (SELECT rid, ord, base + j AS i, substr(piece, 2 * j + 1, 100) AS s FROM u WHERE base + j + 50 <= n),
m AS (SELECT s, min(ord) AS low FROM w GROUP BY s HAVING min(ord) < max(ord)),
p AS (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM w JOIN m USING (s) WHERE low < ord),
g AS (SELECT rid, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i) AS span FROM p),
r AS (SELECT rid, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY rid, span),
k AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS since FROM r),
c AS (
  SELECT rid, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS till,
    string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept FROM k JOIN d USING (rid) GROUP BY rid
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * till + 1), h))) AS kept_sha256
FROM d LEFT JOIN c USING (rid)
"""

SOURCE_AUDIT_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), i AS (SELECT row_number() OVER () AS rid, * FROM d),
t AS (SELECT rid, lang, source, unnest(words) AS term FROM i),
f AS (SELECT lang, term, count(DISTINCT rid) AS df FROM t GROUP BY ALL),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN f USING (lang, term) WHERE df >= 30 GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
m AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(m.total, 0) + 5 * l.v)::HUGEINT)::BIGINT AS p,
    (1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v)::HUGEINT)::BIGINT AS q
  FROM g JOIN k ON k.lang = g.lang JOIN l ON l.lang = g.lang LEFT JOIN m ON m.lang = g.lang AND m.source = g.source
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
), u AS (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM u)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_ngram_jaccard_join": JACCARD_JOIN_SQL,
        "op8_exact_top_k": EXACT_TOP_K_SQL,
        "op10_substring_dedup": SUBSTRING_DEDUP_SQL,
        "op11_suffix_array_dedup": SUFFIX_DEDUP_SQL,
        "op12_source_audit": SOURCE_AUDIT_SQL,
    }
