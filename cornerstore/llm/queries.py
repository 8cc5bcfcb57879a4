"""Each operator applied to its whole table, and the SQL counterpart where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cornerstore.llm import (
    binary, bpe, hamming, langid, lines, mixing, periodic, quality, sentences, simhash, spelling,
    toxicity, warc,
)
from cornerstore.llm.frames import table

BYTE_BPE = "byte_bpe_50k.json"
MIX_TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def op1_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labelled = docs.select("doc_id", "text", F.col("lang").alias("domain"))
    mixed = mixing.mix(docs, labelled, mixing.known_targets(labelled, MIX_TARGETS))
    # A language that no row has is NULL here.
    shares = [F.col("posteriors")[d].alias(f"p_{d}") for d in sorted(MIX_TARGETS)]
    return mixed.select("doc_id", "n_tokens", "domain", *shares, "rate", "copies")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "id % 50 = 0")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.label_documents(docs, langid.fit_languages(docs))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.quality_rules(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.dedup_sentences(table(spark, sf_dir, "documents"))


def op10_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary.token_positions(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents"), spelling.damaged))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic.run_digests(periodic.periodic_runs(docs, rewrite=periodic.planted))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing_sources, op2_quality_classifier, op3_nearest_neighbours, op4_toxicity, op5_simhash,
        op6_language_id, op7_bpe, op8_quality_rules, op9_substring_dedup,
        op10_token_binary, op11_warc, op12_spelling_variants, op13_periodic_runs,
    )
}

ORACLES = {"op8_quality_rules": lines.QUALITY_RULES_SQL, "op11_warc": warc.ARCHIVED_PAGES_SQL}
