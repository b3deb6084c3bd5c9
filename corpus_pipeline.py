"""Training-data pipeline over ``documents``: each stage is written as Parquet and read again by the next.

1. quality rules: documents that the rules reject go;
2. toxicity: documents scored toxic go;
3. near copies: one document of each group stays;
4. secret scans: live credentials are redacted, no document goes;
5. packing: the documents' tokens, packed into sequences.

All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.common import table
from kiln.llm.minhash import keep_one_copy
from kiln.llm.packing import pack_documents
from kiln.llm.quality import keep_quality
from kiln.llm.secrets import redact_live
from kiln.llm.toxicity import drop_toxic
from kiln.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_copy(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_live(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("packing", packing),
]

#: Fitted scatter, a fitted classifier and a genetic algorithm are not SQL; tests/llm holds the brute-force checks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; what a stage wrote stays in the shared folder until the caller removes it."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
