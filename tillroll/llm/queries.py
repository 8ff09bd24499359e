"""The registered queries of the training-data operators and their SQL.

Each query reads its whole table, applies its operator with production
parameters and returns the full result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (curriculum, hard_negatives, inner_product, jaccard_join, minhash, perplexity, prefix_trie, reputation,
                          sanitise, templates, token_files, toxicity, warc)
from tillroll.llm.common import read_table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public vocabulary files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(read_table(spark, sf_dir, "pages"))


def op3_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), k=2, percent=80)


def op5_inner_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_product.search(read_table(spark, sf_dir, "embeddings"), every=100)


def op6_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.report(read_table(spark, sf_dir, "documents"))


def op7_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.judge(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(read_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)
    return token_files.read_token_files(manifest)


def op9_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curriculum.mix(read_table(spark, sf_dir, "documents"))
    return rows.withColumn("position", F.round("position", 9))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read_table(spark, sf_dir, "conversations"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(read_table(spark, sf_dir, "documents"), k=3, percent=90)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), every=100)
    return found.drop("blocks_read", "blocks_known")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_warc": op2_warc,
        "op3_perplexity": op3_perplexity,
        "op4_minhash": op4_minhash,
        "op5_inner_product": op5_inner_product,
        "op6_sanitise": op6_sanitise,
        "op7_reputation": op7_reputation,
        "op8_token_files": op8_token_files,
        "op9_templates": op9_templates,
        "op10_curriculum": op10_curriculum,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_jaccard_join": op12_jaccard_join,
        "op13_hard_negatives": op13_hard_negatives,
    }


OP4 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                      WHEN len(ws) = 1 THEN [ws[1]]
                      ELSE list_distinct([ws[i] || chr(32) || ws[i + 1] for i in range(1, len(ws))]) END AS sh
  FROM w),
n AS (SELECT doc_id, len(sh) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
df AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
x AS (SELECT e.doc_id, e.g FROM e JOIN df USING (g)),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * c >= 80 * (na.n_shingles + nb.n_shingles - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM n
      UNION SELECT r.doc_id, u.b FROM r JOIN u ON u.a = r.reach),
c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY 1)
SELECT n.doc_id, CAST(n.n_shingles AS BIGINT) AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN c USING (doc_id)
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS o, coalesce(md5(text), '') AS tie FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS k FROM s),
w AS (SELECT source, source_size, CAST(k + 1 AS DOUBLE) AS weight, 0.5 - 0.5 * k AS slope,
             CAST(3 * source_size AS DOUBLE) AS most FROM n),
f AS (SELECT *, sum(source_size) OVER () AS total,
             coalesce(sum(most) OVER (ORDER BY most / weight, source ASC NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held_before,
             sum(weight) OVER (ORDER BY most / weight, source ASC NULLS LAST
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left FROM w),
l AS (SELECT *, (CAST(total AS DOUBLE) - held_before) / weight_left AS level FROM f),
h AS (SELECT *, weight * level > most AS held FROM l),
g AS (SELECT *, max(CASE WHEN NOT held THEN level END) OVER () AS common FROM h),
t AS (SELECT source, source_size, slope,
             coalesce(CASE WHEN held THEN most ELSE least(weight * common, most) END, 0.0) AS target FROM g),
p AS (SELECT d.*, coalesce(CAST(sum(size) OVER (PARTITION BY source ORDER BY o, doc_id NULLS FIRST, tie, size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS start FROM d),
j AS (SELECT p.doc_id, p.size, p.start, t.source_size, t.target, t.slope
      FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, CAST(floor(target) AS BIGINT) AS line FROM j),
z AS (SELECT *, greatest(0, least(size, line - start)) + greatest(0, least(size, line - start - source_size))
             + greatest(0, least(size, line - start - 2 * source_size)) AS taken, least(start / target, 1.0) AS share FROM k)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN round(CASE WHEN slope = 0 THEN share
            ELSE 2 * share / ((1 - slope) + sqrt(greatest((1 - slope) * (1 - slope) + 4 * slope * share, 0))) END, 9) END AS position
FROM z
"""

OP2 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN d.page_id > f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id > f.first THEN f.first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

OP5 = r"""
WITH e AS (SELECT vec_id, min([CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding]) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

OP7 = r"""
WITH u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
r AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT doc_id, max(CASE WHEN toxic > 0 OR quality < 1 THEN 1 ELSE 0 END) AS bad FROM labels
      WHERE toxic IS NOT NULL OR quality IS NOT NULL GROUP BY 1),
h AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k,
             regexp_extract(host, '([^.]*[.])?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix
      FROM r LEFT JOIN m ON m.doc_id = r.page_id GROUP BY host),
d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY 1, 2),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY 1),
g AS (SELECT (sum(k) + 0.5::DOUBLE) / (sum(n) + 1) AS prior FROM s),
s1 AS (SELECT s.*, least(greatest(prior, 1e-6), 1 - 1e-6) AS p FROM s, g),
s2 AS (SELECT count(*) AS c, sum(n) AS n, sum(n * n)::DOUBLE AS q, sum(n * (k / n - p) * (k / n - p) / (p * (1 - p))) AS v FROM s1 WHERE n > 0),
s3 AS (SELECT least(greatest(coalesce(CASE WHEN c > 1 AND n - q / n - (c - 1) > 0 THEN (v - (c - 1)) / (n - q / n - (c - 1)) ELSE 0.1 END, 0.1), 0.001), 0.9) AS rho FROM s2),
s4 AS (SELECT suffix, (k + (1 - rho) / rho * p) / (n + (1 - rho) / rho) AS mean FROM s1, s3),
d1 AS (SELECT d.*, least(greatest(mean, 1e-6), 1 - 1e-6) AS p FROM d JOIN s4 USING (suffix)),
d2 AS (SELECT count(*) AS c, sum(n) AS n, sum(n * n)::DOUBLE AS q, sum(n * (k / n - p) * (k / n - p) / (p * (1 - p))) AS v FROM d1 WHERE n > 0),
d3 AS (SELECT least(greatest(coalesce(CASE WHEN c > 1 AND n - q / n - (c - 1) > 0 THEN (v - (c - 1)) / (n - q / n - (c - 1)) ELSE 0.1 END, 0.1), 0.001), 0.9) AS rho FROM d2),
d4 AS (SELECT domain, (k + (1 - rho) / rho * p) / (n + (1 - rho) / rho) AS mean FROM d1, d3),
h1 AS (SELECT h.*, least(greatest(mean, 1e-6), 1 - 1e-6) AS p FROM h JOIN d4 USING (domain)),
h2 AS (SELECT count(*) AS c, sum(n) AS n, sum(n * n)::DOUBLE AS q, sum(n * (k / n - p) * (k / n - p) / (p * (1 - p))) AS v FROM h1 WHERE n > 0),
h3 AS (SELECT least(greatest(coalesce(CASE WHEN c > 1 AND n - q / n - (c - 1) > 0 THEN (v - (c - 1)) / (n - q / n - (c - 1)) ELSE 0.1 END, 0.1), 0.001), 0.9) AS rho FROM h2),
h4 AS (SELECT host, n + (1 - rho) / rho AS strength, (k + (1 - rho) / rho * p) / (n + (1 - rho) / rho) AS mean FROM h1, h3),
v AS (SELECT host, CASE WHEN mean - 1.645 * sqrt(mean * (1 - mean) / (strength + 1)) > 0.25 THEN 'block' ELSE 'allow' END AS own FROM h4),
x AS (SELECT r.*, CASE
        WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM r)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' ELSE own END AS verdict
FROM x JOIN v USING (host)
"""


OP11 = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
d AS (SELECT *, md5(CAST(strlen(role) AS VARCHAR) || ':' || role || text) AS g FROM t),
o AS (SELECT conv_id, strlen(text) AS b, g,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, g) AS i FROM d),
c AS (SELECT conv_id, list_reduce([CAST(ascii(x) AS BIGINT) for x in string_split(CAST(conv_id AS VARCHAR), '')],
        lambda r, x: list_reduce([0, 0, 0, 0, 0, 0, 0, 0],
          lambda s, y: xor(s >> 1, (s & 1) * 3988292384), xor(r, x)), CAST(4294967295 AS BIGINT)) AS r
      FROM (SELECT DISTINCT conv_id FROM t)),
h AS (SELECT conv_id, xor(r, 4294967295) % 9 AS h FROM c),
r AS (SELECT h.conv_id, b, g, 0 AS part, i FROM h JOIN o ON o.conv_id = h.conv_id - h.conv_id % 5 AND i <= h
      UNION ALL SELECT h.conv_id, b, g, 1, i FROM h JOIN o ON o.conv_id = h.conv_id AND i > h),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS depth FROM r),
p AS (SELECT conv_id, depth, b, string_agg(g, '') OVER (PARTITION BY conv_id ORDER BY depth) AS k FROM n),
m AS (SELECT conv_id, depth, b, k, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p
      UNION ALL SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM n) FROM h),
x AS (SELECT k, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(b) AS b,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
      FROM m GROUP BY k),
y AS (SELECT x.*, u.conv_id AS parent_conv_id, (SELECT count(*) FROM x z WHERE z.depth = x.depth + 1 AND starts_with(z.k, x.k)) AS n_children
      FROM x LEFT JOIN x u ON u.depth = x.depth - 1 AND starts_with(x.k, u.k))
SELECT y.conv_id, CAST(y.depth AS BIGINT) AS depth, y.parent_conv_id, CAST(y.n_convs AS BIGINT) AS n_convs,
       CAST(y.n_children AS BIGINT) AS n_children, CAST(count(*) FILTER (z.n_children = 0) AS BIGINT) AS n_leaves,
       CAST(sum((z.n_convs - 1) * z.b) AS BIGINT) AS saved_tokens, y.ends_sha256
FROM y JOIN y z ON starts_with(z.k, y.k)
GROUP BY y.k, y.conv_id, y.depth, y.parent_conv_id, y.n_convs, y.n_children, y.ends_sha256
"""

OP12 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                      WHEN len(ws) < 3 THEN [array_to_string(ws, chr(32))]
                      ELSE list_distinct([ws[i] || chr(32) || ws[i + 1] || chr(32) || ws[i + 2] for i in range(1, len(ws) - 1)]) END AS sh
  FROM w),
n AS (SELECT doc_id, len(sh) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
df AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
x AS (SELECT e.doc_id, e.g FROM e JOIN df USING (g)),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * c >= 90 * (na.n_shingles + nb.n_shingles - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM n
      UNION SELECT r.doc_id, u.b FROM r JOIN u ON u.a = r.reach),
c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY 1)
SELECT n.doc_id, CAST(n.n_shingles AS BIGINT) AS n_shingles, c.component_id
FROM n JOIN c USING (doc_id)
"""

OP13 = r"""
WITH e AS (
  SELECT vec_id, min({'v': [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding],
                      'l': CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END}) AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 GROUP BY vec_id),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.r.l = c.r.l AS alike,
             CAST(list_inner_product(CAST(a.r.v AS DOUBLE[]), CAST(c.r.v AS DOUBLE[])) AS BIGINT) AS score
      FROM e a JOIN e c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": OP2, "op4_minhash": OP4, "op5_inner_product": OP5, "op7_reputation": OP7, "op10_curriculum": OP10,
            "op11_prefix_trie": OP11, "op12_jaccard_join": OP12, "op13_hard_negatives": OP13}
