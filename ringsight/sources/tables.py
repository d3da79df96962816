"""Typed scans and sinks."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringsight.config import DEFAULT, Settings
from ringsight.schemas import ACCOUNTS, AUDIT, AUDIT_INDEX, CLUSTERS, METRICS, TRANSACTIONS


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ACCOUNTS).parquet(path)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRANSACTIONS).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The audit log; blank lines hold no record and come back as no row."""
    lines = spark.read.schema(AUDIT).json(path)
    return lines.where(lines["txn_id"].isNotNull())


def append_audit(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").json(path)


def replace_audit(entries: DataFrame, path: str) -> None:
    """Start a new log, as each pipeline run does."""
    entries.write.mode("overwrite").json(path)


def audit_bucket(txn_id: Column, cfg: Settings = DEFAULT) -> Column:
    return F.pmod(F.xxhash64(txn_id), F.lit(cfg.audit_buckets)).cast("int")


def publish_audit(entries: DataFrame, path: str, run: str, cfg: Settings = DEFAULT) -> None:
    """Add a run's entries in the layout for lookups: partitioned by run and bucket of txn_id, sorted by ring in each file.

    A transaction is in one bucket, so its trail reads 1 / `audit_buckets` of a run's files. Files are sorted by ring, so the
    least and greatest ring of their row groups let a history skip most of the rest.
    """
    laid = entries.withColumns({"run": F.lit(run), "bucket": audit_bucket(F.col("txn_id"), cfg)})
    sorted_ = laid.repartition(cfg.audit_buckets, "bucket").sortWithinPartitions("bucket", "ring_membership", "timestamp", "txn_id")
    sorted_.write.mode("append").partitionBy("run", "bucket").parquet(path)


def read_published_audit(spark: SparkSession, path: str) -> DataFrame:
    """The entries with `run` and `bucket`."""
    return spark.read.schema(AUDIT_INDEX).parquet(path)


def write_clusters(clusters: DataFrame, path: str) -> None:
    clusters.write.mode("overwrite").parquet(path)


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CLUSTERS).parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """The fitted pipeline; its assembler carries the feature list. A missing model is reported as a missing file."""
    try:
        return PipelineModel.load(path)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or "does not exist" in str(error) or "empty collection" in str(error):
            raise FileNotFoundError(f"no model at {path}") from error
        raise
