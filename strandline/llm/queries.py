"""The registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bitsliced, divergence, kdtree, lloyd, mixing, ngramjoin, pieces, quality, rankbpe, suffixdedup, toxicity, urlfilter, warc
from strandline.llm.common import table


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = kdtree.usable(table(spark, sf_dir, "embeddings"))
    return kdtree.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score_toxicity(docs, model)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False).drop("text")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read_records(index, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.score_quality(docs, model)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_plan(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_sampled(docs, ids=False).select("doc_id", "n_pieces", "ids_sha256", "decoded_sha256", "lossless")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = bitsliced.quantised(table(spark, sf_dir, "embeddings"))
    return bitsliced.top_inner_products(vectors, vectors.where("vec_id % 20 = 0"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rankbpe.encode_words(table(spark, sf_dir, "documents").select("doc_id", "text"), ids=False).drop("ids")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents").select("lang", "source", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_url_filters": op2_url_filters,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_toxicity": op4_toxicity,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_warc": op6_warc,
    "op7_quality": op7_quality,
    "op8_mix_sources": op8_mix_sources,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_word_bpe": op12_word_bpe,
    "op13_source_divergence": op13_source_divergence,
}

SQL: dict[str, str] = {}

SQL["op8_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM per
), capped AS (
  -- sources by how low the level is at which they are full; the first k are full for the least k that leaves the next one open
  SELECT *, 3 * source_size AS most, 3 * source_size / weight AS full_at FROM weighed
), filled AS (
  SELECT *,
    sum(source_size) OVER () AS total,
    coalesce(sum(most) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(weight) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM capped
), level AS (
  SELECT arg_min((total - used)::DOUBLE / open_weight, full_at) FILTER (WHERE full_at > (total - used)::DOUBLE / open_weight) AS level FROM filled
), targets AS (
  SELECT source, source_size, CASE WHEN most <= weight * level THEN most::DOUBLE ELSE weight * level END AS target FROM capped, level
), rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('8:' || coalesce(d.doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE / 281474976710656 AS draw
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + (draw < rate - floor(rate))::INT))::BIGINT AS taken, (floor(rate) + (draw < rate - floor(rate))::INT)::INT AS copies FROM rated
"""

SQL["op10_exact_top_k"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), one AS (SELECT vec_id, min(v) AS v FROM v GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(c.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM one q JOIN one c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

SQL["op1_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
), g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS shared FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), link AS (SELECT a, b FROM pairs WHERE 100 * shared >= 80 * (na + nb - shared)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, c AS component_id FROM s JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) USING (doc_id)
"""

SQL["op5_suffix_dedup"] = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS w FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 99, 0))) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM again),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, span, min(i) AS lo, max(i) + 100 AS hi FROM numbered GROUP BY doc_id, span),
cut AS (SELECT doc_id, lo, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS since, hi FROM spans),
kept AS (
  SELECT d.doc_id, h, count(lo) AS n_spans, coalesce(sum(hi - lo), 0) AS n_removed, coalesce(string_agg(substr(h, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo), '') || substr(h, 2 * coalesce(max(hi), 0) + 1) AS k
  FROM d LEFT JOIN cut USING (doc_id) GROUP BY d.doc_id, h
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, n_removed::BIGINT AS n_removed, n_spans::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256 FROM kept
"""

SQL["op6_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), last AS (SELECT h, max(page_id) AS m FROM p GROUP BY h),
digest AS (
  SELECT page_id, h, array_to_string(list_transform(range(0, 32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(sha1(h), 5 * (k // 4) + 1, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31) + 1)::INT, 1)), '') AS payload_digest FROM p
)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, payload_digest, CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> m THEN m END AS refers_to
FROM digest JOIN last USING (h)
"""


def _lloyd_sql(k: int = lloyd.K, rounds: int = lloyd.ROUNDS, dims: int = lloyd.DIMS, scale: int = lloyd.SCALE, seed: int = lloyd.SEED) -> str:
    """One CTE of assignments and one of centroids a round."""
    parts = [
        f"""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1)::INT AS cluster, v AS c FROM v ORDER BY sha256('{seed}:' || vec_id) LIMIT {k})"""
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
  SELECT vec_id, any_value(v) AS v, min(struct_pack(d := d, cluster := cluster)) AS best FROM (
    SELECT vec_id, v, cluster, list_sum(list_transform(range(1, {dims} + 1), lambda j: (v[j] - c[j]) * (v[j] - c[j])))::BIGINT AS d FROM v CROSS JOIN c{i}
  ) GROUP BY vec_id
)"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.cluster, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
    SELECT cluster, list((CASE WHEN s % n < 0 THEN s // n - 1 ELSE s // n END)::BIGINT ORDER BY j) AS c FROM (
      SELECT best.cluster AS cluster, j, sum(v[j]) AS s, count(*) AS n FROM a{i} CROSS JOIN range(1, {dims} + 1) t(j) GROUP BY 1, 2
    ) GROUP BY cluster
  ) m USING (cluster)
)"""
            )
    return f"""WITH {", ".join(parts)}
SELECT vec_id, best.cluster AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.cluster))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
  count(*) OVER (PARTITION BY best.cluster) AS cluster_size, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best.cluster = c{rounds}.cluster"""


SQL["op11_centroid_clustering"] = _lloyd_sql()

SQL["op13_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
share AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (total.n + v) AS p, 1 + (1000000000 * (kept.n + 1)) // (v.n + v) AS q
  FROM total JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)
),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM share WHERE n > 0 AND p > q),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
