"""Corpus pipeline: language ID, line dedup, near dedup, decontamination, packing.

Each stage works on what its predecessor kept; each result is written as Parquet in the shared
folder and read again, so a lost executor costs one stage at most. The first four return the
columns of ``documents``, the last the pieces of packed sequences. Null and empty texts are rejected
by the first stage as undetermined; line dedup may leave a text empty, which then stays as it is.
Repeated rows go through the stages like others until near dedup keeps one; of documents that tie for a
group's least id the least text key stays; very long texts are taken whole; an empty table gives no
pieces; further columns, whatever their names, go along to the fourth stage unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import common, op1_language_id, op3_packing, op4_near_dedup, op6_decontaminate, op8_line_dedup
from gridloom.session import Run

#: A document is rejected as of no known language below this mean probability.
MIN_LANGUAGE_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those that are undetermined, or of too low a score, go."""
    common.ship(spark)
    found = op1_language_id.language(op1_language_id.fit(docs), docs["text"].cast("string"))
    return docs.where((found["lang_pred"] != op1_language_id.UNDETERMINED) & (found["score"] >= MIN_LANGUAGE_SCORE))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that repeat an earlier one; n_chars follows the text."""
    return op8_line_dedup.deduplicated(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return op4_near_dedup.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return op6_decontaminate.decontaminated(docs, common.documents(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the token sequences."""
    return op3_packing.pack(docs, *op3_packing.tokenizer_files())


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("packing", packing)]

#: Learned models, tokens and sequences are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tables = common.documents(spark, sf_dir), Run(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        last, docs = docs, tables.table(stage(spark, docs, sf_dir), name)
        if i:
            tables.drop(last)
    return docs
