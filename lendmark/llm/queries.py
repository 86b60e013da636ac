"""The dealt operators as queries on the given tables, with their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmark.llm import bpe, fingerprints, lattice, lexical, near_dups, neighbours, packing, pii, quality
from lendmark.llm import substrings, token_counts, top_inner, whitening
from lendmark.llm.shipping import ship

VOCABULARY = "byte_bpe_50k.json"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.find(docs, pii.fit(pii.labelled_sample(docs)))


def op3_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op6_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return top_inner.top_products(table(spark, sf_dir, "embeddings"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_digests(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.find(documents(spark, sf_dir))


def op9_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edit_fingerprints(documents(spark, sf_dir))
    return found.withColumns({c: F.base64(c) for c in ("fingerprint", "edited_fingerprint")})


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("query_id", "item_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_personal_data": op2_personal_data,
    "op3_multi_index_hashing": op3_multi_index_hashing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_ball_tree_top_k": op6_ball_tree_top_k,
    "op7_bpe_codec": op7_bpe_codec,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_lattice_scores": op9_lattice_scores,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_whitening": op11_whitening,
    "op12_fingerprints": op12_fingerprints,
    "op13_ranked_search": op13_ranked_search,
    "pipeline": corpus_pipeline.run,
}

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

# Pairs that share a shingle, counted, then the closure of the links.
NEAR_DUPLICATES = f"""
WITH RECURSIVE split AS (SELECT doc_id, {WORDS} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM split),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
often AS (SELECT doc_id, g FROM grams SEMI JOIN (SELECT g FROM grams GROUP BY g HAVING count(*) > 1) USING (g)),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM often a JOIN often b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
half AS (
  SELECT u, v FROM common c JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
links AS (SELECT u, v FROM half UNION ALL SELECT v, u FROM half),
reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
least_of AS (SELECT u, min(v) AS m FROM reach GROUP BY u)
SELECT doc_id, n::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, doc_id <= coalesce(m, doc_id) AS kept
FROM sizes LEFT JOIN least_of ON u = doc_id"""

REPEATED_WINDOWS = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 18), lambda p: {'p': p, 'k': array_to_string(w[p:p + 19], ' ')})) AS s
  FROM split WHERE len(w) >= 20),
again AS (
  SELECT doc_id, s.p AS p, row_number() OVER (PARTITION BY s.k ORDER BY doc_id, s.p) AS nth FROM starts),
covered AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS i FROM again WHERE nth > 1),
flat AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM split),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM flat ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id),
gone AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)"""

EXACT_TOP_K = """
WITH z AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM z q JOIN z c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
placed AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
  FROM scored)
SELECT * FROM placed WHERE rank <= 5"""

TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

RANKED_SEARCH = f"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS w FROM documents),
docs AS (SELECT *, len(w)::BIGINT AS n FROM numbered WHERE len(w) > 0),
counts AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM docs),
asked AS (
  SELECT item, item_id, term, count(*) AS times
  FROM (SELECT row_number() OVER () AS item, item_id, unnest({TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY ALL),
held AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM docs)
  SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), counts),
scored AS (
  SELECT item, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))::BIGINT AS score
  FROM held JOIN weights USING (term) JOIN asked USING (term), counts GROUP BY ALL),
placed AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM placed WHERE rank <= 20"""

ORACLES: dict[str, str] = {
    "op4_substring_dedup": REPEATED_WINDOWS,
    "op6_ball_tree_top_k": EXACT_TOP_K,
    "op8_near_duplicates": NEAR_DUPLICATES,
    "op13_ranked_search": RANKED_SEARCH,
}
