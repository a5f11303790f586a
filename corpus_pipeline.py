"""From raw documents to encoded training data in five stages.

Each stage gets the rows its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import byte_bpe, line_dedup, minhash, mixing, toxicity
from marquee.llm.common import free_names, may_contain, ship_package, text_key
from marquee.operators.lineage import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. The model learns from the labelled raw documents."""
    raw, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return toxicity.without_toxic(docs, toxicity.fit(raw, labels))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines go, but for their first occurrence; n_chars follows the text."""
    counted, dropped = free_names(docs, "_lines", "_dropped")
    kept = line_dedup.dedup_lines(docs, least_words=1, counted=counted, dropped=dropped)
    count = F.when(F.col(dropped) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", count).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id stays.

    The groups name the rows that go; a semi-join by id and text removes them. If several
    rows are equal in id and text, all stay or all go.
    """
    groups = minhash.near_duplicates(docs, 85)
    gone = stored(groups.filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")), "gone")
    # the row travels as one value, so its column names meet no others
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("own_id"), text_key().alias("own_key"))
    touched = may_contain(gone, "gone_key")(F.col("own_key"))
    same = F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_key") == F.col("gone_key"))
    kept = keyed.filter(touched).join(gone, same, "left_anti")
    return kept.unionByName(keyed.filter(~touched)).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the shares of the target weights; documents repeat as the mix asks."""
    return mixing.mix_documents(docs)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte-level BPE", encode_bytes),
]

#: Model scores and SimHash have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
