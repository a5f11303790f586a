"""One query per operator over the given tables, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    byte_bpe, centroids, line_dedup, merkle, minhash, mixing, ngram_join, pii, sharding, statements, syncmers, token_files, topk, toxicity,
)
from marquee.llm.common import free_names, ship_package
from marquee.session import scratch_path

#: The key of the registered query; a deployment passes its own.
PII_SECRET = "example key"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_kd_shards(spark: SparkSession, d: str) -> DataFrame:
    shards = sharding.shard(table(spark, d, "documents"), 40)
    return shards.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op2_minhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, d, "documents"), 85).drop("text_key")


def op3_segment_topk(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_k(table(spark, d, "embeddings"), lambda i: i % 50 == 0, 5)


def op4_token_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, d, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    back = token_files.read_tokens(spark, path)
    return token_files.with_starts(token_files.token_digests(back), back).drop("seq")


def op5_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, d, "documents"), ranks, public_tokenizers.PATTERN)


def op6_feistel_pii(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    found, changed = free_names(docs, "_found", "_changed")
    named = pii.pseudonymise(docs, PII_SECRET, found=found, changed=changed)
    return named.select("doc_id", F.size(found).alias("found"), F.col(changed).alias("changed"), "text")


def op7_ngram_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, table(spark, d, "labels")))


def op8_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    counted, dropped = free_names(docs, "_lines", "_dropped")
    kept = line_dedup.dedup_lines(docs, least_words=1, counted=counted, dropped=dropped)
    return kept.select("doc_id", F.col(counted).alias("lines"), F.col(dropped).alias("dropped"), "text")


def op9_source_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_words(table(spark, d, "documents")).drop("source")


def op10_closed_syncmers(spark: SparkSession, d: str) -> DataFrame:
    found = syncmers.edited_fingerprints(table(spark, d, "documents"))
    written = {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(written)


def op11_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.linked_documents(table(spark, d, "documents"), 85)


def op12_centroid_heaps(spark: SparkSession, d: str) -> DataFrame:
    return centroids.clusters_with_inertia(table(spark, d, "embeddings"), 40, 5)


def op13_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return merkle.document_manifest(table(spark, d, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_kd_shards": op1_kd_shards,
        "op2_minhash_dedup": op2_minhash_dedup,
        "op3_segment_topk": op3_segment_topk,
        "op4_token_files": op4_token_files,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_feistel_pii": op6_feistel_pii,
        "op7_ngram_toxicity": op7_ngram_toxicity,
        "op8_line_dedup": op8_line_dedup,
        "op9_source_mix": op9_source_mix,
        "op10_closed_syncmers": op10_closed_syncmers,
        "op11_ngram_jaccard": op11_ngram_jaccard,
        "op12_centroid_heaps": op12_centroid_heaps,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_segment_topk": _TOP_K,
        "op9_source_mix": _MIX,
        "op12_centroid_heaps": statements.clusters_sql(),
        "op13_merkle_manifest": statements.manifest_sql(),
    }


_TOP_K = """
WITH v AS (
    SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.n, a.vec_id AS query_id, b.vec_id AS vec_id,
           CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.n <> b.n AND len(a.q) = len(b.q)
    WHERE a.vec_id % 50 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_MIX = r"""
WITH sized AS (
    SELECT doc_id, source,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           md5(concat_ws(':', 'mix', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))) AS key
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
           2 * source_size AS most, CAST(sum(source_size) OVER () AS DOUBLE) AS whole
    FROM sources
), steps AS (
    SELECT *, most / weight AS ratio,
           (whole * 1.5::DOUBLE - CAST(coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
           / CAST(sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
    FROM weighted
), levels AS (
    SELECT arg_min(level, (ratio, source IS NULL, coalesce(source, ''))) FILTER (WHERE level < ratio) AS level FROM steps
), targets AS (
    SELECT s.source, s.source_size, least(CAST(s.most AS DOUBLE), coalesce(s.weight * l.level, CAST(s.most AS DOUBLE))) AS target
    FROM steps s CROSS JOIN levels l
), budgets AS (
    SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target) AS BIGINT) // source_size END AS epochs FROM targets
), keys AS (
    SELECT source, key, CAST(sum(size) AS BIGINT) AS words FROM sized GROUP BY source, key
), places AS (
    SELECT *, CAST(coalesce(sum(words) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM keys
), joined AS (
    SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, p.words, p.before,
           CAST(floor(b.target) AS BIGINT) - b.epochs * b.source_size AS rest
    FROM sized d
    JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
    JOIN places p ON d.source IS NOT DISTINCT FROM p.source AND d.key = p.key
)
SELECT doc_id, size, source_size, target,
       CAST(size * epochs + CASE WHEN before + words <= rest THEN size
                                 WHEN before < rest THEN size * (rest - before) // words ELSE 0 END AS BIGINT) AS taken
FROM joined
"""
