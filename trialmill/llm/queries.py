"""One registered query per operator, over its whole table, and the SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from trialmill.llm import centroids, compression, gam, jaccard_join, kneser_ney, link_trust, mixing, packing, prefix_trie, quotes, sketch, token_count, warc

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
WORDS = r"'[^\x20\x09-\x0D]+'"

JACCARD_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), {WORDS}) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM w WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(doc_id, other) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(other) FROM r WHERE r.doc_id = w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
k AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS most FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(x, CAST(i // 4 * 5 + 1 AS INT), 5))::INT) >> CAST(15 - i % 4 * 5 AS INT)) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id <> most THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> most THEN most END AS refers_to
FROM k
"""

TRIE_SQL = rf"""
WITH t AS MATERIALIZED (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), c AS MATERIALIZED (
  SELECT c, c - (c % 20 + 20) % 20 AS b, xor(list_reduce(string_split(c::VARCHAR, ''), lambda a, y: list_reduce(range(8),
      lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(a, ascii(y)::BIGINT)), 4294967295), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM t)
), g AS (SELECT c.c, c.h, least(c.h, (SELECT count(*) FROM t WHERE t.c = c.b)) AS n FROM c),
u AS (
  SELECT c.c, t.i AS d, t.r, t.x FROM c JOIN t ON t.c = c.b AND t.i <= c.h
  UNION ALL SELECT g.c, t.i - g.h + g.n, t.r, t.x FROM g JOIN t ON t.c = g.c AND t.i > g.h
), p AS MATERIALIZED (
  SELECT c, d, len(regexp_extract_all(x, {WORDS})) AS w,
    sha256(string_agg(length(r) || ':' || r || length(x) || ':' || x, '|') OVER (PARTITION BY c ORDER BY d)) AS k FROM u
), e AS MATERIALIZED (SELECT c, d, k, w FROM p UNION ALL SELECT c, 0, '', 0 FROM c),
n AS MATERIALIZED (SELECT k, d, count(*) AS n, min(c) AS c, any_value(w) AS w FROM e GROUP BY k, d),
up AS MATERIALIZED (SELECT DISTINCT y.k, z.k AS parent FROM e y JOIN e z ON z.c = y.c AND z.d = y.d - 1),
kids AS MATERIALIZED (SELECT parent AS k, count(*) AS kids FROM up GROUP BY parent),
under AS (SELECT DISTINCT y.k, z.k AS lower FROM e y JOIN e z ON z.c = y.c AND z.d >= y.d),
sums AS (
  SELECT u.k, sum((kids.kids IS NULL)::INT)::BIGINT AS leaves, sum((n.n - 1) * n.w)::BIGINT AS saved
  FROM under u JOIN n ON n.k = u.lower LEFT JOIN kids ON kids.k = u.lower GROUP BY u.k
), ends AS (
  SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS s FROM e WHERE d = (SELECT max(d) FROM e f WHERE f.c = e.c) GROUP BY k
)
SELECT n.c AS conv_id, n.d AS depth, m.c AS parent_conv_id, n.n AS n_convs, coalesce(kids.kids, 0) AS n_children,
  sums.leaves AS n_leaves, sums.saved AS saved_tokens, coalesce(ends.s, sha256('')) AS ends_sha256
FROM n JOIN sums ON sums.k = n.k LEFT JOIN kids ON kids.k = n.k LEFT JOIN ends ON ends.k = n.k
LEFT JOIN up ON up.k = n.k LEFT JOIN n m ON m.k = up.parent
"""


def clusters_sql() -> str:
    """Ten rounds written out, over one row per vector and component."""
    near = """{a} AS MATERIALIZED (
  SELECT r, arg_min(c, struct_pack(d := d, c := c)) AS c, min(d) AS d FROM (
    SELECT v.r, m.c, sum((v.q - m.q) * (v.q - m.q))::BIGINT AS d FROM v JOIN {m} m ON m.i = v.i GROUP BY v.r, m.c) GROUP BY r)"""
    move = """{m} AS MATERIALIZED (
  SELECT o.c, o.i, coalesce(n.q, o.q) AS q FROM {o} o LEFT JOIN (
    SELECT a.c, v.i, floor_mean(sum(v.q)::BIGINT, count(*)) AS q FROM v JOIN {a} a ON a.r = v.r GROUP BY a.c, v.i) n ON n.c = o.c AND n.i = o.i)"""
    move = move.replace("floor_mean(sum(v.q)::BIGINT, count(*))", "((sum(v.q)::BIGINT - ((sum(v.q)::BIGINT % count(*)) + count(*)) % count(*)) // count(*))")
    steps = []
    for i in range(centroids.ROUNDS):
        steps += [near.format(a=f"a{i}", m=f"m{i}"), move.format(m=f"m{i + 1}", o=f"m{i}", a=f"a{i}")]
    last = centroids.ROUNDS
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding AS x FROM embeddings
  WHERE len(embedding) = {centroids.DIMENSIONS} AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = {centroids.DIMENSIONS}
), v AS MATERIALIZED (
  SELECT r, unnest(range({centroids.DIMENSIONS})) AS i, floor(unnest(x)::DOUBLE * 1024)::BIGINT AS q FROM e
), s AS (SELECT r, row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id)) - 1 AS c FROM e),
m0 AS MATERIALIZED (SELECT s.c, v.i, v.q FROM s JOIN v ON v.r = s.r WHERE s.c < {centroids.CLUSTERS}),
{", ".join(steps)},
{near.format(a="z", m=f"m{last}")},
g AS (SELECT c, sha256(string_agg(q::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM m{last} GROUP BY c)
SELECT e.vec_id, z.c::INT AS cluster, z.d AS distance, sum(z.d) OVER (PARTITION BY z.c)::BIGINT AS cluster_inertia,
  sum(z.d) OVER ()::BIGINT AS inertia, g.centroid_sha256
FROM z JOIN e ON e.r = z.r JOIN g ON g.c = z.c
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.words_taken(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.filtered_urls(table(spark, sf_dir, "pages"))


def op5_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.linked_conversations(table(spark, sf_dir, "conversations"))


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.held_out_scores(table(spark, sf_dir, "documents"))


def op7_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.quality_rules(table(spark, sf_dir, "documents"))


def op8_bottom_k_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(table(spark, sf_dir, "embeddings"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries():
    found = (
        op1_mixing_sources, op2_token_counts, op3_ngram_jaccard_join, op4_url_filters, op5_quotation_linking, op6_kneser_ney,
        op7_compression_bands, op8_bottom_k_sketches, op9_packing, op10_quality_classifier, op11_centroid_clustering, op12_warc,
        op13_prefix_trie, pipeline,
    )
    return {q.__name__: q for q in found}


def oracle_sql() -> dict[str, str]:
    found = {"op3_ngram_jaccard_join": JACCARD_SQL, "op11_centroid_clustering": clusters_sql(), "op12_warc": WARC_SQL, "op13_prefix_trie": TRIE_SQL}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
