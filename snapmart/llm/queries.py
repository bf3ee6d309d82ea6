"""Registered queries of this package and, where SQL can say them, oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from snapmart.llm import (
    bpe, forest, impact, jaccard, licenses, packing, periods, phrases, prefixes, secrets, suffixes, toxicity, warc,
)
from snapmart.llm.common import table


def op1_best_fit_packing(spark, sf_dir):
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                          keep=[F.crc32("ids").alias("ids_crc32")])
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_impact_topk(spark, sf_dir):
    return impact.top_k(table(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
WHERE place <= 10
"""


def op3_ftrl_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.train(docs, labels))


def op4_parity_jaccard(spark, sf_dir):
    found = jaccard.join(table(spark, sf_dir, "documents"), n=3, num=9, den=10)
    return found.select("doc_id", "n_shingles", "component_id")


def op5_radix_suffix_dedup(spark, sf_dir):
    return suffixes.digests(suffixes.remove(table(spark, sf_dir, "documents")))


def op6_chunked_warc(spark, sf_dir):
    return warc.roundtrip(table(spark, sf_dir, "pages"))


OP6_SQL = """
SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN newest END AS refers_to
FROM (SELECT *, strlen(payload) >= 1000 AND page_id < newest AS again
      FROM (SELECT page_id, payload, max(page_id) OVER (PARTITION BY payload) AS newest
            FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages)))
"""


def op7_tree_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path))


def op8_patience_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_projection_forest(spark, sf_dir):
    return forest.nearest(table(spark, sf_dir, "embeddings"))


def op10_secret_scan(spark, sf_dir):
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


def op11_prefix_token_counts(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return prefixes.digests(prefixes.count_prefixes(table(spark, sf_dir, "documents"), path), limit=512)


def op12_periodic_runs(spark, sf_dir):
    docs = periods.with_stutter(table(spark, sf_dir, "documents"))
    return periods.digests(periods.collapse(periods.find_runs(docs)))


def op13_phrase_mining(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, most=2000)


OP13_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents WHERE text IS NOT NULL)),
grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS k)),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
found AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, 2000000 * c.a // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM found) AS c
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_of AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM found))
  GROUP BY 1, 2),
kept AS (
  SELECT c.* FROM lowest AS c LEFT JOIN inner_of AS o ON o.lang = c.lang AND o.phrase = c.phrase
  WHERE o.longer IS NULL OR 100 * o.longer < 80 * c.a)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN total USING (lang)
WHERE rank <= 2000
"""


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_impact_topk": op2_impact_topk,
    "op3_ftrl_toxicity": op3_ftrl_toxicity,
    "op4_parity_jaccard": op4_parity_jaccard,
    "op5_radix_suffix_dedup": op5_radix_suffix_dedup,
    "op6_chunked_warc": op6_chunked_warc,
    "op7_tree_bpe": op7_tree_bpe,
    "op8_patience_licenses": op8_patience_licenses,
    "op9_projection_forest": op9_projection_forest,
    "op10_secret_scan": op10_secret_scan,
    "op11_prefix_token_counts": op11_prefix_token_counts,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_phrase_mining": op13_phrase_mining,
}

ORACLE: dict[str, str] = {
    "op2_impact_topk": OP2_SQL,
    "op6_chunked_warc": OP6_SQL,
    "op13_phrase_mining": OP13_SQL,
}
