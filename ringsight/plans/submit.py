"""spark-submit ringsight/plans/submit.py ACCOUNTS TRANSACTIONS OUTPUT [--checkpoint FOLDER]: the batch run on two parquet tables."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from ringsight.plans.batch import BatchRun  # noqa: E402
from ringsight.session import prepare  # noqa: E402
from ringsight.sources import tables  # noqa: E402


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Score transactions and clusters, decide, log and measure.")
    parser.add_argument("accounts")
    parser.add_argument("transactions")
    parser.add_argument("output")
    parser.add_argument("--checkpoint", help="folder that all executors share; default: spark.checkpoint.dir of the session")
    given = parser.parse_args(args)
    spark = prepare(SparkSession.builder.appName("ringsight").getOrCreate())
    if given.checkpoint:
        spark.sparkContext.setCheckpointDir(given.checkpoint)
    run = BatchRun(tables.read_accounts(spark, given.accounts), tables.read_transactions(spark, given.transactions))
    run.write(given.output)


if __name__ == "__main__":
    main()
