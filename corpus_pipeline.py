"""From raw documents to token ids: each stage works on all that the stage before has kept.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.llm import mixing, pii, quality, sentencepiece_codec, simhash
from leadlake.llm.common import table
from leadlake.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the boosted trees. Null and empty texts have no words and go; rows that repeat are judged alike; an empty
    table stays empty."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest ``doc_id``, for rows that repeat one of them. Rows without
    ``doc_id`` stay; null and empty texts are near copies of each other; an empty table stays empty."""
    return simhash.keep_representatives(docs)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; ``n_chars`` follows the text. Null texts stay null; rows that repeat are redacted alike."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions; a document comes once, twice or not at all. Documents without words never enter; a null source is
    a source; an empty table stays empty."""
    return mixing.mixed_documents(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix; null and empty texts have none, and each row gives one row."""
    return sentencepiece_codec.encode_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("pii_redaction", pii_redaction),
    ("source_mixing", source_mixing),
    ("sentencepiece_encoding", sentencepiece_encoding),
]
# Trees, components and vocabularies are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
