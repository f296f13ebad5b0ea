"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_package, table
from .license_scan import oracle_sql as _license_sql

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(fn=None, *, sql: str | None = None):
    def add(f):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return f(spark, sf_dir)
        query.__name__, query.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = query
        if sql:
            ORACLE[f.__name__] = sql
        return f
    return add(fn) if fn else add


@register
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    from .packing import pack_documents
    out = pack_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


@register
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document at 2 or fewer differing bits."""
    from .simhash import simhash_groups
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


_LEAKS_SQL = r"""
WITH low AS (SELECT row_number() OVER () AS r, doc_id AS id, text, 0 AS side FROM documents
    UNION ALL SELECT row_number() OVER (), item_id, text, 1 FROM benchmark),
w AS (SELECT r, id, side, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
items AS (SELECT id, ws, least(len(ws), 10) AS m FROM w WHERE side = 1 AND len(ws) > 0),
iw AS (SELECT DISTINCT id, m, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS g
    FROM (SELECT id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM items)),
dw AS (SELECT r, i, m, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS g
    FROM (SELECT r, ws, m, unnest(range(1, greatest(len(ws) - m + 2, 1))) AS i
          FROM w, (SELECT DISTINCT m FROM iw) WHERE side = 0)),
occ AS (SELECT r, i, dw.m, id FROM dw JOIN iw ON dw.m = iw.m AND dw.g = iw.g),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM occ) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT r, CAST(id AS VARCHAR) AS id FROM occ WHERE id IS NOT NULL) GROUP BY r)
SELECT w.id AS doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit ON hit.r = w.r LEFT JOIN named ON named.r = w.r WHERE side = 0"""


@register(sql=_LEAKS_SQL)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside occurrences of 10-word windows of the benchmark items."""
    from .decontaminate import decontaminate
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@register
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document: counts and digest of the base kinds, and all spans."""
    from .secret_scan import KINDS, scan_secrets, span_digest
    out = scan_secrets(table(spark, sf_dir, "documents"))
    count = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS[:3]]
    return out.select("doc_id", *count, F.sha2(span_digest(KINDS[:3]), 256).alias("base_sha256"),
                      span_digest(KINDS).alias("spans"))


@register
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned outside the held-out quarter."""
    from .toxicity import score_toxicity
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from preference pairs outside the held-out fifth."""
    from .quality import score_quality
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_REPEATS_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT r, i, array_to_string(list_slice(ws, i, i + 34), ' ') AS g
    FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 33, 1))) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY g) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT r, i + j AS p FROM rep, range(0, 35) t(j)),
words AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT words.r, count(*) AS n, string_agg(word, ' ' ORDER BY words.p) AS t
    FROM words LEFT JOIN gone ON gone.r = words.r AND gone.p = words.p WHERE gone.p IS NULL GROUP BY words.r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r)"""


@register(sql=_REPEATS_SQL)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document outside word sequences of 35 that occur elsewhere."""
    from .substring_dedup import remove_repeats
    out = remove_repeats(table(spark, sf_dir, "documents"), n=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register(sql="""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(e, e) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, low.component_id, v.vec_id = low.component_id AS kept
FROM v JOIN low ON low.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
""")
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.93 within a label."""
    from .embedding_dedup import embedding_groups
    return embedding_groups(table(spark, sf_dir, "embeddings"), cosine=0.93)


@register(sql=_license_sql())
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices found in every document."""
    from .license_scan import scan_licenses
    out = scan_licenses(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"),
                      F.array_join(F.transform("licenses", lambda x: x["id"]), ",").alias("licenses"))


@register
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    from .html_text import extract_text
    return extract_text(table(spark, sf_dir, "pages"))


@register
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every document, with corpus-wide counts of the links."""
    from .alignment import align_documents
    out = align_documents(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)


_WARC_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
r AS (SELECT page_id, t, max(page_id) OVER (PARTITION BY t) AS last,
    row_number() OVER (PARTITION BY t ORDER BY page_id DESC NULLS LAST) AS k, count(*) OVER (PARTITION BY t) AS c FROM p),
d AS (SELECT page_id, strlen(t)::BIGINT AS n, sha1(t) AS h, k, last FROM r)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN last END AS refers_to
FROM d"""


@register(sql=_WARC_SQL)
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as an archive of WARC records and read back from it."""
    import uuid

    from ..session import checkpoint_dir
    from .warc import read_warc, write_warc
    path = f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_warc(table(spark, sf_dir, "pages"), path)
    out = read_warc(spark, path, payloads=False)
    return out.select(F.col("source_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast("long").alias("refers_to"))


@register
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened on their 32 largest principal components."""
    from .whitening import whiten
    return whiten(table(spark, sf_dir, "embeddings"))
