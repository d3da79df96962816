"""Session set-up and the one way intermediate tables are cut from their lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = 8, name: str = "ringsight") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the results depend on, plus adaptive execution for skewed joins."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read: the session's own, or a temporary one on one machine (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ringsight-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    The result has no lineage, survives lost executors, and keeps parquet's column pruning and sizes, so later joins can be
    planned from what was really written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exceeds(df: DataFrame, column: str, limit: int) -> bool:
    """Whether any value of a count column is above the limit; one number reaches the driver."""
    top = df.agg(F.max(column)).first()[0]
    return top is not None and top > limit


def hint(small: DataFrame, limit: int) -> DataFrame:
    """Broadcast a table only when its counted rows are within the limit; beyond it Spark joins by shuffle."""
    return F.broadcast(small) if small.count() <= limit else small
