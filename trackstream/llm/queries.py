"""Registered queries of the operators of this subpackage, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackstream.llm import (language_id, license_scan, line_dedup, mixing, ngram_join,
                             quality_model, quality_rules, sentencepiece_sampling, simhash,
                             spelling, spotsigs, token_alignment, token_file)
from trackstream.llm.common import documents
from trackstream.session import checkpoint_dir


def _fold(k: int):
    """crc32 of the id as text, modulo k."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")),
                  F.lit(k))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality_model.fit(docs, labels.filter(_fold(3) != 1))
    return quality_model.score(docs, model).select(
        "doc_id", (_fold(3) == 1).alias("held_out"), "score", "predicted")


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    token_file.write(documents(spark, sf_dir, "doc_id", "text"), out,
                     "word_bpe_49k.json")
    return token_file.digests(spark, out)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        "spans")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op5_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_sampling.encode_frame(
        documents(spark, sf_dir, "doc_id", "text"))
    return coded.select("doc_id", "n_pieces", "ids", F.sha2("decoded", 256).alias("decoded_sha256"),
                        F.col("text").eqNullSafe(F.col("decoded")).alias("lossless"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    model = language_id.fit(docs.filter(_fold(4) != 2))
    return language_id.predict(docs, model, ["doc_id"]).select(
        "doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return line_dedup.dedup(docs, **line_dedup.WHOLE).select(
        "doc_id", "n_lines", "n_dropped", "text")


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_next(documents(spark, sf_dir, "doc_id", "text"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir, "doc_id", "text", "source"),
                      keep=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       "component_id")


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(documents(spark, sf_dir, "doc_id", "text"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_table(documents(spark, sf_dir, "doc_id", "text"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir, "doc_id", "text")).select(
        "word", "form", "root", "n", "n_near", "form_n")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_token_file, op3_license_scan, op4_quality_rules,
    op5_sentencepiece_sampling, op6_language_id, op7_line_dedup, op8_spotsigs, op9_mixing,
    op10_simhash, op11_ngram_join, op12_token_alignment, op13_spelling_variants, pipeline)}
