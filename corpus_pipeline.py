"""A corpus from raw documents to packed sequences, each stage on what its predecessor kept.

Stages take and return the columns of documents; the last returns the pieces of sequences. None of
the stages is plain SQL: learnt filters, similarity joins and tokenizers decide.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm import decontaminate, language, ngram_join, pack, pii
from pressloom.llm.queries import TARGETS
from pressloom.llm.shared import documents, dropped, fresh, stored, without

#: A document goes if less than this share of its n-grams belongs to any one language.
LEAST_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    return language.accepted(docs, language.learn(docs), LEAST_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the document with the smallest id stays.

    A row is known by its id and text. Those without an id are last; of equal rows one stays.
    """
    key = fresh(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = ngram_join.clusters(keyed.select(F.col(key).alias("doc_id"), "text"))
    found = found.groupBy(F.col("doc_id").alias(key), "component_id").agg(F.count("*").alias("copies"))
    named = stored(found.join(keyed.select(key, F.col("doc_id").alias("id")).distinct(), key))
    first = F.min(F.struct(F.col("id").isNull(), "id", key))[key].alias("first")
    found = stored(named.join(named.groupBy("component_id").agg(first), "component_id"))
    dropped(named)
    kept = without(keyed, found.filter(F.col(key) != F.col("first")), key)
    repeated = stored(found.filter((F.col("copies") > 1) & (F.col(key) == F.col("first"))).select(key))
    dropped(found)  # its ids are tables of their own by now
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    rest = kept.join(repeated, key, "left_semi").dropDuplicates([key])
    return without(kept, repeated, key).unionByName(rest).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of words with a benchmark item go, whatever their ids."""
    key = fresh(docs, "text_key")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    texts = keyed.select(F.col(key).alias("doc_id"), "text")
    hit = decontaminate.overlaps(texts, documents(spark, sf_dir, "benchmark")).filter("n_hit > 0")
    return without(keyed, hit.select(F.col("doc_id").alias(key)), key).select(*docs.columns)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that reveal it are replaced in the texts."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens, sources mixed evenly."""
    return pack.packed(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), TARGETS)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", sanitise),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
