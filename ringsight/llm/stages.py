"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> rows that stay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ringsight.llm import pieces
from ringsight.llm import quality as quality_model
from ringsight.llm.common import documents
from ringsight.llm.decontaminate import find_items
from ringsight.llm.grace_dedup import grace_dedup
from ringsight.llm.ngram_join import ngram_join


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the cut go. Learns from the labels of the documents given."""
    ranker = quality_model.train(docs, documents(spark, sf_dir, "labels"))
    scored = quality_model.with_scores(docs, ranker, name="__score")
    return scored.where(F.col("__score") >= quality_model.CUT).drop("__score")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return grace_dedup(docs)[1]


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: the one with the smallest id.

    Rows equal in id and text stay or go together.
    """
    rows = ngram_join(docs).groupBy(F.col("doc_id").alias("__id"), "th").agg(F.max("kept").alias("kept"))
    gone = rows.where("not kept").select("__id", "th")
    same = docs["doc_id"].eqNullSafe(gone["__id"]) & (F.xxhash64(F.coalesce("text", F.lit(""))) == gone["th"])
    return docs.join(gone, same, "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = find_items(docs, documents(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("__id"), "th").distinct()
    same = docs["doc_id"].eqNullSafe(found["__id"]) & (F.xxhash64(F.coalesce("text", F.lit(""))) == found["th"])
    return docs.join(found, same, "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and the text they decode to."""
    import public_tokenizers

    return pieces.encode(docs, str(public_tokenizers.path("piece_bpe_32k.model"))).withColumnRenamed("decoded", "text")
