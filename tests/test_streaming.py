from datetime import timedelta

from pyspark.sql import functions as F
from samples import START, account, accounts_frame, transaction, transactions_frame

from ringsight.operators import audit
from ringsight.schemas import AUDIT
from ringsight.sources import tables
from ringsight.streaming import live


def log(spark, numbers):
    rows = [
        (f"t{i}", START + timedelta(seconds=25 * i), i / 100, ["x"], None, None, i / 100, "flag_for_review" if i % 3 == 0 else "log_only", "why")
        for i in numbers
    ]
    return spark.createDataFrame(rows, AUDIT)


def run(stream, tmp_path, name, mode):
    started = live.run_available(stream, str(tmp_path / name), str(tmp_path / f"{name}-state"), mode)
    started.awaitTermination()
    return str(tmp_path / name)


def read(spark, sink, schema, mode):
    return live.read_published(spark, sink, schema) if mode == "complete" else spark.read.schema(schema).parquet(sink)


def test_tail_reads_every_entry_once_across_restarts(spark, tmp_path):
    path = str(tmp_path / "log")
    seen = []
    for part in (range(0, 10), range(10, 25)):
        tables.append_audit(log(spark, part), path)
        sink = run(live.tail_audit(spark, path, files_per_batch=2), tmp_path, "tail", "append")
        seen.append(sorted(int(r.txn_id[1:]) for r in spark.read.parquet(sink).collect()))
    assert seen == [list(range(10)), list(range(25))]


def test_live_views_equal_the_batch_views(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.append_audit(log(spark, range(100)), path)
    batch = tables.read_audit(spark, path)
    views = {
        "totals": (live.action_totals, audit.action_counts),
        "minutes": (live.minute_counts, audit.actions_per_minute),
        "bins": (live.live_histogram, audit.score_histogram),
    }
    for name, (streamed, direct) in views.items():
        sink = run(streamed(live.tail_audit(spark, path)), tmp_path, name, "complete")
        want = direct(batch)
        got = read(spark, sink, want.schema, "complete")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), name


def test_versions_are_published_whole_and_once(spark, tmp_path):
    sink, schema = str(tmp_path / "sink"), "action_taken string, decisions long"
    frame = lambda n: spark.createDataFrame([("log_only", n)], schema)
    types = frame(0).schema
    assert live.read_published(spark, sink, types).isEmpty()
    live.publish(frame(1), 0, sink)
    live.publish(frame(2), 1, sink)
    live.publish(frame(99), 1, sink)  # a replay of the same batch
    assert [r.decisions for r in live.read_published(spark, sink, types).collect()] == [2]
    assert live.versions(spark, sink).count() == 2
    # data without an entry in the list, as an interrupted batch leaves it, is not seen
    frame(3).write.parquet(f"{sink}/version-000000000002-interrupted")
    assert [r.decisions for r in live.read_published(spark, sink, types).collect()] == [2]
    live.publish(frame(4), 2, sink)
    assert [r.decisions for r in live.read_published(spark, sink, types).collect()] == [4]


def test_totals_grow_from_version_to_version(spark, tmp_path):
    path = str(tmp_path / "log")
    seen = []
    for part in (range(0, 30), range(30, 50)):
        tables.append_audit(log(spark, part), path)
        stream = live.action_totals(live.tail_audit(spark, path))
        sink = run(stream, tmp_path, "totals", "complete")
        seen.append(sum(r.decisions for r in live.read_published(spark, sink, stream.schema).collect()))
    assert seen == [30, 50]


def test_rows_behind_the_watermark_are_dropped_and_counted_once(spark, tmp_path):
    path, dropped = str(tmp_path / "log"), 0
    for part in (range(0, 40), [400], [1], [800]):  # the entry of the first minute comes after it was closed
        tables.append_audit(log(spark, part), path)
        stream = live.minute_counts(live.tail_audit(spark, path))
        query = live.run_available(stream, str(tmp_path / "late"), str(tmp_path / "late-state"))
        query.awaitTermination()
        dropped += sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    want = audit.actions_per_minute(log(spark, [*range(0, 40), 400]))
    got = spark.read.schema(want.schema).parquet(str(tmp_path / "late"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert dropped == 1


def test_minutes_are_final_behind_the_watermark(spark, tmp_path):
    path = str(tmp_path / "log")
    for part in (range(0, 40), [400]):  # the late entry moves the watermark past the first minutes
        tables.append_audit(log(spark, part), path)
        sink = run(live.minute_counts(live.tail_audit(spark, path)), tmp_path, "minutes", "append")
    want = audit.actions_per_minute(log(spark, range(0, 40)))
    got = spark.read.schema(want.schema).parquet(sink)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_ring_lookup_per_transaction(spark, tmp_path):
    path = str(tmp_path / "transactions")
    rows = [transaction("t1", "a", START), transaction("t2", "b", START), transaction("t3", "unknown", START)]
    tables.write_table(transactions_frame(spark, rows), path)
    lookup = spark.createDataFrame([("a", "c1", 0.7), ("b", "c2", None)], "account_id string, ring_membership string, ring_score double")
    sink = run(live.ring_lookups(live.tail_transactions(spark, path), lookup), tmp_path, "lookups", "append")
    got = {r.txn_id: (r.ring_membership, r.ring_score) for r in spark.read.parquet(sink).collect()}
    assert got == {"t1": ("c1", 0.7), "t2": ("c2", None), "t3": (None, None)}


def test_scans_use_the_declared_types(spark, tmp_path):
    path = str(tmp_path / "accounts")
    tables.write_table(accounts_frame(spark, [account("a"), account("b")]), path)
    back = tables.read_accounts(spark, path)
    assert back.count() == 2 and dict(back.dtypes)["created_at"] == "timestamp"
    pruned = back.where(F.col("account_id") == "a").select("kyc_verified")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(account_id), EqualTo(account_id,a)]" in plan
    assert "ReadSchema: struct<account_id:string,kyc_verified:boolean>" in plan
