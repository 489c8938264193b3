"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm import centroids, chat, decontaminate, html_text, language, ngram_join, pack, pii, quality_rules, simhash, site_quality, token_count, vector_codes
from pressloom.llm import queries_sql as sql
from pressloom.llm.shared import documents


#: Target shares of the sources in each window of sequences: equal ones.
TARGETS = {f"src{i}": 1 / 20 for i in range(20)}


def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.clusters(documents(spark, sf), 4, 85)


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality_rules.scored(documents(spark, sf))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return rows.select("doc_id", *base, "quality")


def op3_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.report(documents(spark, sf))


def op4_pack(spark: SparkSession, sf: str) -> DataFrame:
    return pack.packed(documents(spark, sf), public_tokenizers.path("byte_bpe_50k.tiktoken"), TARGETS)


def op5_chat(spark: SparkSession, sf: str) -> DataFrame:
    return chat.digests(spark, documents(spark, sf, "conversations"))


def op6_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf), documents(spark, sf, "benchmark"))


def op7_site_quality(spark: SparkSession, sf: str) -> DataFrame:
    """A document's source is its host, its language the section of the host it is in."""
    docs, labels = documents(spark, sf), documents(spark, sf, "labels")
    return site_quality.judged(docs, labels, F.col("source"), F.col("lang"))


def op8_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.identified(documents(spark, sf))


def op9_token_count(spark: SparkSession, sf: str) -> DataFrame:
    return token_count.token_counts(documents(spark, sf), public_tokenizers.path("piece_bpe_32k.model"))


def op10_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.main_texts(documents(spark, sf, "pages"))


def op11_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return centroids.clustered(documents(spark, sf, "embeddings"))


def op12_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.clusters(documents(spark, sf))


def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes.coded(documents(spark, sf, "embeddings"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_quality_rules": op2_quality_rules,
    "op3_pii": op3_pii,
    "op4_pack": op4_pack,
    "op5_chat": op5_chat,
    "op6_decontaminate": op6_decontaminate,
    "op7_site_quality": op7_site_quality,
    "op8_language": op8_language,
    "op9_token_count": op9_token_count,
    "op10_html_text": op10_html_text,
    "op11_centroids": op11_centroids,
    "op12_simhash": op12_simhash,
    "op13_vector_codes": op13_vector_codes,
}
ORACLES = {
    "op1_ngram_join": sql.ngram_join(),
    "op5_chat": sql.chat(),
    "op6_decontaminate": sql.decontaminate(),
    "op11_centroids": sql.centroids(),
    "op13_vector_codes": sql.vector_codes(),
}
