"""Live views of the audit log and of incoming transactions, as Structured Streaming plans.

The log folder is tailed by the file source: which files were read is kept in the query's checkpoint, so nothing is read
twice and a lost executor or driver picks up where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ringsight.operators.audit import action_counts, actions_per_minute, score_histogram
from ringsight.schemas import AUDIT, TRANSACTIONS

VERSIONS = "batch long, folder string"


def tail_audit(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New log entries as they are appended."""
    reader = spark.readStream.schema(AUDIT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path).where(F.col("txn_id").isNotNull())


def tail_transactions(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(TRANSACTIONS).parquet(path)


def action_totals(entries: DataFrame) -> DataFrame:
    """Running count per action; complete output mode."""
    return action_counts(entries)


def minute_counts(entries: DataFrame, late_by: str = "1 minute") -> DataFrame:
    """Count per minute and action; a minute is final once the watermark has passed it."""
    return actions_per_minute(entries.withWatermark("timestamp", late_by))


def live_histogram(entries: DataFrame) -> DataFrame:
    return score_histogram(entries)


def ring_lookups(transactions: DataFrame, lookup: DataFrame) -> DataFrame:
    """Each incoming transaction with its account's cluster and score, or nulls: a join with the published table."""
    return transactions.join(lookup, "account_id", "left").select("txn_id", "account_id", "ring_membership", "ring_score")


def run_available(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there and stop: the batch-style trigger of a scheduled job.

    Append mode adds parquet files to `sink`. Complete results are published as versions, see `publish`.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        return writer.outputMode("append").format("parquet").option("path", sink).start()
    return writer.outputMode(mode).foreachBatch(lambda batch, number: publish(batch, number, sink)).start()


def publish(batch: DataFrame, number: int, sink: str) -> None:
    """Write a result under a folder of its own, then name it in the list of versions.

    The list only grows, and an entry appears as a whole once its data is complete: a reader finds the last complete version, never
    an empty or half-written one. A batch that is replayed after a failure finds its number in the list and changes nothing.
    """
    spark = batch.sparkSession
    known = versions(spark, sink)
    if known is not None and not known.where(F.col("batch") == number).isEmpty():
        return
    folder = f"version-{number:012d}-{uuid.uuid4().hex}"
    batch.write.parquet(f"{sink}/{folder}")
    spark.createDataFrame([(number, folder)], VERSIONS).coalesce(1).write.mode("append").json(f"{sink}/versions")


def versions(spark: SparkSession, sink: str) -> DataFrame | None:
    """(batch, folder) of the complete versions, or None before the first."""
    try:
        return spark.read.schema(VERSIONS).json(f"{sink}/versions")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def read_published(spark: SparkSession, sink: str, schema: StructType) -> DataFrame:
    """The last complete version; no rows before the first."""
    known = versions(spark, sink)
    last = None if known is None else known.agg(F.max_by("folder", "batch").alias("folder")).first()["folder"]
    if last is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{sink}/{last}")
