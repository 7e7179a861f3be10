"""Corpus pipeline: documents -> rules -> line dedup -> near-dedup -> mix -> pieces.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
``run`` writes every stage's rows as Parquet in the shared checkpoint folder and
rereads them as the next stage's input; a stage's rows are removed once the next
stage's are written.

Edge cases, in every stage: null and empty texts, rows without an id or a source and
repeated rows take the way that the stage's operator states; texts of any length are
worked on whole; an empty table passes through as one; columns beyond those of
documents are left behind at the start, so clashing names do no harm.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackstream.llm import line_dedup, mixing, quality_rules, sentencepiece_sampling, simhash
from trackstream.llm.common import remove
from trackstream.session import checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.apply_rules(docs).filter("kept").select(*COLUMNS)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; n_chars follows the text."""
    whole = line_dedup.dedup(docs, **line_dedup.WHOLE)
    return whole.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of near copies."""
    return simhash.keep_one(docs).select(*COLUMNS)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to three times."""
    return mixing.emit(mixing.mix(docs), COLUMNS)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled pieces of each document, and whether they decode to its text."""
    coded = sentencepiece_sampling.encode_frame(docs.select(*COLUMNS))
    return coded.select("doc_id", "lang", "source", "n_pieces", "ids",
                        F.col("text").eqNullSafe(F.col("decoded")).alias("lossless"))


STAGES = [("quality rules", rules_stage), ("line dedup", lines_stage),
          ("simhash near-dedup", near_stage), ("mixing", mix_stage),
          ("sentencepiece", pieces_stage)]

#: Sampled segmentations cannot be stated in SQL; tests hold every stage against
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    at = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{at}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{at}/{k}")
        if k:
            remove(spark, f"{at}/{k - 1}")
    return docs
