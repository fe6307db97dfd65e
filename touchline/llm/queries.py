"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, classifier, decontam, html, linededup, minhash, negatives, packing, quality, secret_scan, simhash, tokens, urls
from .common import table


#: The rules of the URL filter's contract.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES).drop("score", "threshold")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_components(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, scale=256, seed="2:")


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=5, percent=85)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_token_counts, op3_url_filter, op4_packing, op5_html_extraction, op6_decontamination,
        op7_simhash_near_dedup, op8_quality_rules, op9_line_dedup, op10_quality_classifier,
        op11_centroid_clustering, op12_minhash_near_dedup, op13_hard_negatives, pipeline,
    )
}

def clustering_sql(k: int, rounds: int) -> str:
    """The rounds one after the other: c<i> are the centroids before round i, a<i> what is assigned to them."""
    steps = [
        "v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS x FROM embeddings WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64)",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS INT) AS cluster, x AS c FROM v ORDER BY sha256('2:' || vec_id) LIMIT {k})",
    ]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, min((d, cluster)) AS m FROM (SELECT r, vec_id, x, cluster, CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(x, c)]) AS BIGINT) AS d FROM v, c{i}) GROUP BY r)")
        if i < rounds:
            means = f"SELECT m[2] AS cluster, i, floor(sum(x[i]) / count(*)) AS y FROM a{i}, range(1, 65) z(i) GROUP BY 1, 2"
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(any_value(n.c), any_value(o.c)) AS c FROM c{i} o LEFT JOIN (SELECT cluster, list(y ORDER BY i) AS c FROM ({means}) GROUP BY cluster) n USING (cluster) GROUP BY cluster)")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, m[2] AS cluster, m[1] AS distance, CAST(sum(m[1]) OVER (PARTITION BY m[2]) AS BIGINT) AS cluster_inertia, CAST(sum(m[1]) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string([CAST(y AS BIGINT) FOR y IN c], ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON cluster = m[2]"""


ORACLES = {
    "op9_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
keepers AS (SELECT k, min(doc_id) AS keeper FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT l.*, q.keeper IS NOT NULL AND l.doc_id <> q.keeper AS gone FROM lines l LEFT JOIN keepers q ON l.k = q.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op6_decontamination": r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents
  UNION ALL
  SELECT 'b', item_id, [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+') IF x <> ''] FROM benchmark),
k AS (SELECT DISTINCT least(len(words), 5) AS k FROM w WHERE side = 'b' AND len(words) > 0),
s AS (
  SELECT DISTINCT side, id, array_to_string(words[i:i + k - 1], ' ') AS shingle
  FROM (SELECT side, id, words, k, unnest(range(1, len(words) - k + 2)) AS i
    FROM w JOIN k ON CASE WHEN side = 'b' THEN k = least(len(words), 5) WHEN k < 3 THEN k = len(words) ELSE k <= len(words) END)),
n AS (SELECT id, count(*) AS n_shingles FROM s WHERE side = 'b' GROUP BY id),
m AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared FROM s d JOIN s b ON d.shingle = b.shingle AND d.side = 'd' AND b.side = 'b' GROUP BY 1, 2)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
FROM m JOIN n ON m.item_id = n.id WHERE n_shared >= 0.8 * n_shingles - 1e-9
""",
    "op12_minhash_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) >= 5 THEN array_to_string(words[i:i + 4], ' ') ELSE array_to_string(words, ' ') END AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(node, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON r.reached = e.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(reached) AS component_id FROM r GROUP BY node) ON node = doc_id
""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
""",
    "op11_centroid_clustering": clustering_sql(40, 5),
}
