"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, encoding."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ringsight.llm import stages
from ringsight.llm.common import documents
from ringsight.session import prepare, shared_folder

STAGES = [
    ("quality classifier", stages.quality),
    ("exact dedup", stages.exact_dedup),
    ("n-gram Jaccard join", stages.near_dedup),
    ("benchmark decontamination", stages.decontaminate),
    ("SentencePiece encoding and decoding", stages.encode),
]

#: No SQL can express learned scores, a randomised SVD or piece lattices; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written and read again."""
    prepare(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/{name.split()[0]}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
