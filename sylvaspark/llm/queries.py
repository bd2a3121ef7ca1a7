"""Queries of the training-data operators over whole tables, and their SQL where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from sylvaspark.llm import balltree, classlm, fingerprints, jaccard, mixing, packing, projections, sharding, suffixdedup, toxicity, windows


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(_documents(spark, sf_dir))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classlm.perplexities(_documents(spark, sf_dir))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(_documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(_documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.repeated_spans(_documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.incremental_spans(_documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_topk_search": op3_topk_search,
        "op4_sharding": op4_sharding,
        "op5_mixing": op5_mixing,
        "op6_toxicity": op6_toxicity,
        "op7_suffix_array_dedup": op7_suffix_array_dedup,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_packing": op9_packing,
        "op10_embedding_near_dedup": op10_embedding_near_dedup,
        "pipeline": corpus_pipeline.run,
    }


TOP_K_SQL = f"""
WITH v AS (SELECT vec_id, CAST(min(embedding) AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL GROUP BY vec_id),
p AS (SELECT a.vec_id, b.vec_id AS neighbor_id, round(list_inner_product(a.e, b.e), 9) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {balltree.EVERY} = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, neighbor_id) AS INTEGER) AS rank FROM p)
SELECT vec_id, rank, neighbor_id, score FROM r WHERE rank <= {balltree.K}
"""

SHARDING_SQL = f"""
WITH d AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM documents),
x AS (SELECT doc_id, n_bytes, h, depth, h >> (32 - depth) AS prefix FROM d, (SELECT unnest(range(0, 33)) AS depth)),
s AS (SELECT *, sum(n_bytes) OVER w AS bytes, min(h) OVER w = max(h) OVER w AS one FROM x WINDOW w AS (PARTITION BY depth, prefix)),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, h ORDER BY depth) AS k FROM s WHERE bytes <= {sharding.SHARD_BYTES} OR one)
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS shard_depth, CAST(prefix AS BIGINT) AS shard_prefix, CAST(bytes AS BIGINT) AS shard_bytes FROM f WHERE k = 1
"""


_WORDS = """
t AS (SELECT doc_id, list_transform(regexp_extract_all(text, '(?:[0-9A-Za-z]|[^\\x00-\\x7F])+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)"""

JACCARD_SQL = f"""
WITH RECURSIVE {_WORDS},
g AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < {jaccard.N} THEN w ELSE list_slice(w, k, k + {jaccard.N - 1}) END AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {jaccard.N - 2}, 2))) AS k FROM t WHERE len(w) > 0)),
s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
p AS (SELECT a, b FROM o JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE common >= {jaccard.THRESHOLD} * (x.n + y.n - common)),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
c AS (SELECT a AS doc_id, b AS other FROM e UNION SELECT c.doc_id, e.b FROM c JOIN e ON e.a = c.other),
l AS (SELECT a AS doc_id, count(*) AS n_links FROM e GROUP BY a),
m AS (SELECT doc_id, min(other) AS low FROM c GROUP BY doc_id)
SELECT DISTINCT d.doc_id, least(d.doc_id, coalesce(low, d.doc_id)) AS class_id, coalesce(n_links, 0) AS n_links FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN m USING (doc_id) WHERE d.doc_id IS NOT NULL
"""

REPEATS_SQL = f"""
WITH {_WORDS},
k AS (SELECT doc_id, j, md5(array_to_string(list_slice(w, j + 1, j + {windows.LENGTH}), ' ')) AS h FROM (SELECT doc_id, w, unnest(range(0, len(w) - {windows.LENGTH - 1})) AS j FROM t WHERE len(w) >= {windows.LENGTH})),
f AS (SELECT doc_id, j, min(doc_id) OVER (PARTITION BY h) AS low FROM k),
n AS (SELECT *, CASE WHEN j > lag(j) OVER (PARTITION BY doc_id ORDER BY j) + {windows.LENGTH} THEN 1 ELSE 0 END AS new FROM f WHERE low < doc_id),
i AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY j) AS island FROM n)
SELECT doc_id, min(j) AS start_word, max(j) - min(j) + {windows.LENGTH} AS n_words, min(low) AS first_doc_id FROM i GROUP BY doc_id, island
"""

NEAR_GROUPS_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= {projections.THRESHOLD}),
c AS (SELECT a AS vec_id, b AS other FROM p UNION SELECT c.vec_id, p.b FROM c JOIN p ON p.a = c.other)
SELECT DISTINCT v.vec_id, coalesce(least(v.vec_id, low), v.vec_id) AS group_id, coalesce(low < v.vec_id, FALSE) AS is_duplicate FROM v LEFT JOIN (SELECT vec_id, min(other) AS low FROM c GROUP BY vec_id) m USING (vec_id)
"""


def oracle_sql() -> dict[str, str]:
    """The SQL is exact; operator 10 is approximate beyond what these tables hold (see its module)."""
    return {"op1_ngram_jaccard_join": JACCARD_SQL, "op3_topk_search": TOP_K_SQL, "op4_sharding": SHARDING_SQL, "op7_suffix_array_dedup": REPEATS_SQL, "op8_substring_dedup": REPEATS_SQL, "op10_embedding_near_dedup": NEAR_GROUPS_SQL}
