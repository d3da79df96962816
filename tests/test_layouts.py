"""The stratified split and the published audit layout."""

import glob
import hashlib
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from samples import START

from ringsight.config import Settings
from ringsight.operators import audit, model
from ringsight.schemas import AUDIT
from ringsight.sources import tables


def held_out(rows, percent):
    out = set()
    for label in (True, False, None):
        ids = sorted((hashlib.md5(t.encode()).hexdigest(), t) for t, x in rows if x is label)
        out |= {t for _, t in ids[: (len(ids) * percent + 50) // 100]}
    return out


@pytest.mark.parametrize("n,percent", [(1, 20), (2, 20), (3, 20), (7, 50), (40, 20), (3000, 20), (3000, 0), (50, 100)])
def test_split_is_exact_per_label(spark, n, percent):
    pick = random.Random(n)
    rows = [(f"t{k}", pick.choice([True, False, False, False, False, None])) for k in range(n)]
    df = spark.createDataFrame(rows, "txn_id string, label_fraud boolean").repartition(3)
    train, held = model.split(df, Settings(holdout_percent=percent))
    got = {r.txn_id for r in held.collect()}
    assert got == held_out(rows, percent)
    assert {r.txn_id for r in train.collect()} == {t for t, _ in rows} - got


def test_split_of_rows_without_labels_and_of_none(spark):
    df = spark.createDataFrame([(f"t{k}",) for k in range(10)], "txn_id string")
    train, held = model.split(df)
    assert held.count() == 2 and train.count() == 8
    train, held = model.split(df.limit(0))
    assert train.isEmpty() and held.isEmpty()


def test_split_keeps_rows_of_one_id_together(spark):
    df = spark.createDataFrame([("same", True)] * 7 + [(f"t{k}", True) for k in range(3)], "txn_id string, label_fraud boolean")
    train, held = model.split(df)
    ids = [{r.txn_id for r in part.collect()} for part in (train, held)]
    assert not ids[0] & ids[1]


def entries(spark, run, n):
    rows = [
        (f"t{k}", START + timedelta(seconds=k), k / n, [], f"c{k % 20:02d}" if k % 3 else None, 0.2, 0.3, "log_only", f"{run} {k}")
        for k in range(n)
    ]
    return spark.createDataFrame(rows, AUDIT)


def test_lookups_read_one_bucket(spark, tmp_path):
    path, cfg = str(tmp_path / "index"), Settings(audit_buckets=16)
    for run in ("one", "two"):
        tables.publish_audit(entries(spark, run, 400), path, run, cfg)
    log = tables.read_published_audit(spark, path)
    assert log.count() == 800
    for txn in ("t0", "t123", "none"):
        found = audit.audit_trail(log, txn, cfg)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(bucket" in plan and f"EqualTo(txn_id,{txn})" in plan
        assert [r.txn_id for r in found.collect()] == ([txn] if txn != "none" else [])
    files = glob.glob(f"{path}/run=*/bucket=*/*.parquet")
    bucket = spark.range(1).select(tables.audit_bucket(F.lit("t123"), cfg)).first()[0]
    read = log.where(F.col("bucket") == bucket).inputFiles()
    assert len(files) == 32 and len(read) == 32  # inputFiles lists before pruning; the scan reads:
    scan = audit.audit_trail(log, "t123", cfg)
    scan.collect()
    assert log.where((F.col("bucket") == bucket)).select(F.input_file_name()).distinct().count() == 2
    # a run is a partition too, and a ring is pushed to sorted files
    history = audit.cluster_history(log.where("run = 'two'"), "c07")
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ring_membership,c07)" in plan and "isnotnull(run" in plan
    assert history.count() == sum(k % 3 > 0 and k % 20 == 7 for k in range(400))
    for name in files[:3]:
        rings = [r.ring_membership for r in spark.read.parquet(name).collect()]
        assert rings == sorted(rings, key=lambda x: (x is not None, x or ""))
