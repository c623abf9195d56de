"""Corpus pipeline: five stages from raw documents to tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``, so a lost executor costs one
stage.  Every stage but the last returns the columns of ``documents``:

1. quality rules: documents that a rule rejects go;
2. line dedup: lines that stand earlier in the corpus (equal or nearly) go,
   ``n_chars`` follows; a document may be left empty but stays;
3. SimHash near-dedup: one document of each component stays;
4. mixing: a document appears as often as its source's token target takes it;
5. SentencePiece: tokens of every document of the mix.

``ORACLE_SQL`` is None: fingerprints (XXH64) and tokens have no SQL form; the tests
hold the stages against brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsengine.llm import line_dedup, quality_rules, sentencepiece, simhash, source_mixing
from obsengine.llm.common import table, written

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece.encode_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_dedup),
    ("source_mixing", mixing),
    ("sentencepiece", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
