from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from samples import START, accounts_frame, random_tables, transactions_frame

from ringsight.config import Settings
from ringsight.operators import audit, evaluate, fusion, model, quality
from ringsight.operators.features import extract_features
from ringsight.operators.rules import evaluate_rules
from ringsight.plans.batch import BatchRun
from ringsight.session import materialize
from ringsight.sources import tables

SMALL = Settings(trees=3, depth=3)


@pytest.fixture(scope="module")
def featured(spark):
    accounts, transactions = random_tables(4)
    a, t = accounts_frame(spark, accounts), transactions_frame(spark, transactions)
    return materialize(evaluate_rules(extract_features(t, a)), "test-features")


def test_inputs_without_rules_or_label(spark, featured):
    bare = model.prepare_data(featured.drop("triggered_rules", "label_fraud"))
    assert "label" not in bare.columns
    assert bare.agg(*[F.sum(f) for f in model.RULE_FLAGS]).first() == (0.0, 0.0, 0.0)
    with pytest.raises(ValueError):
        model.train(featured.drop("label_fraud"), SMALL)


def test_split_is_fixed_and_near_its_share(spark):
    rows = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("txn_id"), (F.col("id") % 10 == 0).alias("label_fraud"))
    train, held_out = model.split(rows)
    assert train.count() + held_out.count() == 5000
    shares = {r.label_fraud: r.share for r in rows.groupBy("label_fraud").agg(F.avg(model.is_holdout(model.holdout_cuts(rows)).cast("int")).alias("share")).collect()}
    assert shares[True] == pytest.approx(0.2, abs=0.05) and shares[False] == pytest.approx(0.2, abs=0.02)
    assert held_out.exceptAll(model.split(rows.repartition(3))[1]).isEmpty()


def test_model_round_trip_and_prediction(spark, featured, tmp_path):
    fitted = model.train(featured, SMALL)
    tables.save_model(fitted, str(tmp_path / "model"))
    loaded = tables.load_model(str(tmp_path / "model"))
    first = {r.txn_id: r for r in model.predict(featured, fitted, SMALL).collect()}
    again = {r.txn_id: r for r in model.predict(featured, loaded, SMALL).collect()}
    assert first == again and len(first) == featured.count()
    assert all(0 <= r.layer1_score <= 1 and len(r.top_features) == 2 for r in first.values())
    # a row without a z-score is scored too, and says so
    unknown = [r for r in first.values() if r.account_id == "stranger"]
    assert unknown and all(r.top_features[0].feature == "amount_zscore" and r.top_features[0].value is None for r in unknown)
    with pytest.raises(FileNotFoundError):
        tables.load_model(str(tmp_path / "nothing"))


def test_every_training_row_and_every_value_reach_the_booster(spark, monkeypatch):
    """More rows than Spark's sample for split candidates: no row is left out, and a value of one row in 15,000 has its own bin."""
    i = F.col("id")
    rows = spark.range(15_000).select(
        F.concat(F.lit("t"), i).alias("txn_id"),
        *[(F.when(i % 1500 == 7, i / 1500 + 2) if k == 0 else i % (k + 2)).cast("double").alias(c) for k, c in enumerate(model.FEATURES)],
        F.array().cast("array<string>").alias("triggered_rules"),
        (i % 1500 == 7).alias("label_fraud"),
    )
    given = {}
    fit = model.GBTClassifier.fit

    def noted(booster, cells):
        given["weight"] = cells.agg(F.sum(booster.getWeightCol())).first()[0]
        given["bins"] = cells.select("velocity_1min_bin").distinct().count()
        given["rows"], given["most"] = cells.count(), booster.getMaxBins() ** 2
        return fit(booster, cells)

    monkeypatch.setattr(model.GBTClassifier, "fit", noted)
    rows = materialize(rows, "test-training")
    training = model.split(rows)[0]
    fitted = model.train(rows, SMALL)
    assert given["weight"] == training.count() > 10_000
    assert given["rows"] < given["most"]  # Spark samples rows for its candidates beyond this
    assert given["bins"] == training.select(F.coalesce("velocity_1min", F.lit(0.0))).distinct().count() > 5
    scores = model.with_probability(rows, fitted).groupBy("label_fraud").agg(F.min("probability"), F.max("probability"))
    bounds = {r[0]: r[1:] for r in scores.collect()}
    assert bounds[False][1] < bounds[True][0]


def test_rows_with_weights_give_the_model_of_all_rows(spark):
    """The trees on bins are those that the booster grows from every row alone."""
    i = F.col("id")
    columns = [(F.hash(i, F.lit(k)) % (k + 3)).cast("double").alias(c) for k, c in enumerate(model.FEATURES)]
    labels = F.hash(i, F.lit(0)) % 3 + F.hash(i, F.lit(1)) % 4 + F.hash(i, F.lit(99)) % 3 > 1
    rows = spark.range(4000).select(F.concat(F.lit("t"), i).alias("txn_id"), *columns, F.array().cast("array<string>").alias("triggered_rules"), labels.alias("label_fraud"))
    rows = materialize(rows, "test-training")
    got = model.with_probability(rows, model.train(rows, SMALL)).select("txn_id", "probability")
    plain = model.prepare_data(model.split(rows)[0])
    assembler = model.VectorAssembler(inputCols=list(model.INPUTS), outputCol="inputs")
    booster = model.GBTClassifier(featuresCol="inputs", labelCol="label", maxIter=SMALL.trees, maxDepth=SMALL.depth, stepSize=SMALL.learning_rate, seed=SMALL.seed)
    want = model.with_probability(rows, model.PipelineModel([assembler, booster.fit(assembler.transform(plain))]))
    both = got.join(want.select("txn_id", F.col("probability").alias("other")), "txn_id")
    assert both.count() == 4000 and both.agg(F.max(F.abs(F.col("probability") - F.col("other")))).first()[0] < 1e-9


def test_blend(spark):
    df = spark.createDataFrame([(1.0, 0.2), (1.0, 0.95), (0.8, 0.5), (0.0, 0.12344)], "rule_score double, probability double")
    assert [r.s for r in df.select(model.blended_score().alias("s")).collect()] == [0.9, 0.95, 0.62, 0.0741]


def test_top_features_break_ties_by_the_later_input(spark):
    row = spark.createDataFrame([tuple(float(i == 3) for i in range(11))], ", ".join(f"{c} double" for c in model.INPUTS))
    statistics = model.input_statistics(row).scalar()
    same = row.withColumn("s", statistics).select(model.top_features(F.col("s"), [1.0] * 11).alias("t")).first().t
    assert [t.feature for t in same] == ["odd_hour_new_category_flag", "high_deviation_flag"]
    assert {t.contribution for t in same} == {"low"}


def test_top_features_are_not_interpreted_row_by_row(spark, capsys):
    names = ", ".join(f"{c} double" for c in model.INPUTS)
    row = spark.createDataFrame([tuple(float(i) for i in range(11)), (None, *[float("nan")] * 10)], names)
    statistics = row.withColumn("s", model.input_statistics(row).scalar())
    found = statistics.select(model.top_features(F.col("s"), [1.0] * 11).alias("t"))
    assert all(len(r.t) == 2 and r.t[0].feature != r.t[1].feature for r in found.collect())
    capsys.readouterr()
    found.explain("extended")
    assert "lambda" not in capsys.readouterr().out


def test_texts_name_missing_values_null(spark, capsys):
    row = spark.createDataFrame([("c1", None, ["device"], [])], "c string, n long, s array<string>, f array<string>")
    text = row.select(audit.layer2_explanation(F.lit("log_only"), F.col("c"), F.col("n"), F.col("s"), F.col("f")).alias("t"))
    assert text.first().t == "Transaction logged: account belongs to c1 (null accounts sharing device; general suspicious synchrony)."
    capsys.readouterr()
    text.explain("extended")
    assert "format_string" not in capsys.readouterr().out


def decide(spark, layer1_score, ring_score, rules=(), cluster="c1", size=3, signals=("device",), flags=()):
    layer1 = spark.createDataFrame(
        [("t1", "a1", layer1_score, list(rules), [("velocity_1hr", 1.0, "high"), ("amount_zscore", 2.0, "low")])],
        "txn_id string, account_id string, layer1_score double, triggered_rules array<string>,"
        " top_features array<struct<feature string, value double, contribution string>>",
    )
    rings = spark.createDataFrame(
        [("a1", cluster, ring_score)] if cluster else [], "account_id string, ring_membership string, ring_score double"
    )
    scored = spark.createDataFrame(
        [(cluster, size, list(signals), list(flags))] if cluster else [],
        "cluster_id string, size long, shared_signals array<string>, flags array<string>",
    )
    txns = spark.createDataFrame([("t1", "a1")], "txn_id string, account_id string")
    by_id = fusion.fuse_scores(layer1.drop("account_id"), txns, rings)
    kept = fusion.fuse_scores(layer1, txns, rings, evidence=True)
    one, two = (audit.log_entries(f, layer1, scored).drop("timestamp").first() for f in (by_id, kept))
    assert one == two
    return one


def test_decisions_and_explanations(spark):
    ring = decide(spark, 0.2, 0.6, flags=["dense_identifier_sharing"])
    assert (ring.final_score, ring.action_taken) == (0.6, "flag_for_review")
    assert ring.explanation == "Transaction flagged for review: account belongs to c1 (3 accounts sharing device; dense_identifier_sharing)."
    plain = decide(spark, 0.1, 0.1, size=1, signals=[])
    assert plain.explanation == (
        "Transaction logged: account belongs to c1 (1 accounts sharing weak proximity signals; general suspicious synchrony)."
    )
    rules = decide(spark, 0.9, 0.2, rules=["card_testing_flag"])
    assert rules.explanation == (
        "Transaction flagged for review: Triggered hard rules (card_testing_flag). "
        "Top contributing features were velocity_1hr (high), amount_zscore (low)."
    )
    alone = decide(spark, 0.5, None, cluster=None)
    assert (alone.ring_membership, alone.ring_score, alone.action_taken) == (None, None, "flag_for_review")
    assert alone.explanation.startswith("Transaction flagged for review: Suspicious behavior detected by ML model.")
    assert decide(spark, 0.4999, 0.4999).action_taken == "log_only"


def test_log_appends_and_lookups(spark, tmp_path):
    entry = spark.createDataFrame([("t1", "c1"), ("t2", "c1"), ("t3", None)], "txn_id string, ring_membership string")
    log = entry.select(
        "txn_id",
        F.timestamp_seconds(F.expr("cast(substring(txn_id, 2, 1) as int)")).alias("timestamp"),
        F.lit(0.5).alias("layer1_score"),
        F.array(F.lit("x")).alias("layer1_triggers"),
        "ring_membership",
        F.lit(None).cast("double").alias("ring_score"),
        F.lit(0.5).alias("final_score"),
        F.lit("log_only").alias("action_taken"),
        F.lit("because").alias("explanation"),
    )
    path = str(tmp_path / "log")
    tables.replace_audit(log.where("txn_id = 't9'"), path)
    tables.append_audit(log.where("txn_id < 't3'"), path)
    tables.append_audit(log.where("txn_id = 't3'"), path)
    with open(tmp_path / "log" / "more.json", "w") as f:
        f.write("\n\n")
    back = tables.read_audit(spark, path)
    assert back.count() == 3
    assert audit.audit_trail(back, "t2").first().explanation == "because"
    assert audit.audit_trail(back, "none").isEmpty()
    assert audit.cluster_history(back, "c1").count() == 2
    assert [r.txn_id for r in audit.last_decisions(back, 2).collect()] == ["t3", "t2"]
    tables.replace_audit(log.limit(1), path)
    assert tables.read_audit(spark, path).count() == 1


def labelled(spark, rows):
    return spark.createDataFrame(
        [(f"t{i}", y, s, f, None, "a1", START + timedelta(seconds=i)) for i, (y, s, f) in enumerate(rows)],
        "txn_id string, label_fraud boolean, layer1_score double, final_score double, ring_score double, account_id string,"
        " timestamp timestamp",
    )


def test_metrics_without_positives_or_flags(spark):
    rows = labelled(spark, [(False, 0.1, 0.1), (False, 0.2, 0.2)])
    assert all((r.precision, r.recall, r.f1) == (0, 0, 0) for r in evaluate.tier_metrics(rows).collect())
    assert evaluate.roc_auc(rows).first().roc_auc is None
    nobody = spark.createDataFrame([], "account_id string, is_ambiguous boolean")
    assert evaluate.ambiguous_friction(rows, nobody).first() == (0, 0, 0.0)
    assert evaluate.exemplars(rows, nobody).isEmpty()


def test_metrics(spark):
    rows = labelled(spark, [(True, 0.9, 0.9), (True, 0.5, 0.5), (True, 0.1, 0.7), (False, 0.5, 0.5), (False, 0.1, 0.6), (False, 0.1, 0.1)])
    tiers = {r.tier: r for r in evaluate.tier_metrics(rows).collect()}
    assert (tiers["review"].precision, tiers["review"].recall) == (pytest.approx(2 / 3), pytest.approx(2 / 3))
    assert (tiers["block"].precision, tiers["block"].f1) == (1.0, pytest.approx(0.5))
    assert evaluate.uplift(rows).first() == (3, 2, 1, 1)
    scores = [(r.label_fraud, r.layer1_score) for r in rows.collect()]
    wins = [(p > n) + (p == n) / 2 for y, p in scores if y for z, n in scores if not z]
    assert evaluate.roc_auc(rows).first().roc_auc == pytest.approx(sum(wins) / len(wins))
    ambiguous = spark.createDataFrame([("a1", True)], "account_id string, is_ambiguous boolean")
    assert evaluate.ambiguous_friction(rows, ambiguous).first() == (3, 2, pytest.approx(200 / 3))
    examples = {r.example: r.txn_id for r in evaluate.exemplars(rows, ambiguous).collect()}
    assert examples == {"layer1_block": "t0", "ambiguous_false_positive": "t3"}


def test_ring_recovery(spark):
    accounts = spark.createDataFrame(
        [(f"{r}{i}", True, r) for r in "xyz" for i in range(3)], "account_id string, label_ring_member boolean, ring_id string"
    )
    cluster = {"x0": "c1", "x1": "c1", "x2": "c1", "y0": "c1", "y1": "c2", "y2": "c3", "z0": "c3", "z1": "c3", "z2": "c3"}
    mapping = spark.createDataFrame(list(cluster.items()), "account_id string, cluster_id string")
    scored = spark.createDataFrame([("c1", 0.9), ("c2", 0.5), ("c3", 0.2)], "cluster_id string, ring_score double")
    got = {r.ring_id: (r.found, r.clusters, r.outcome) for r in evaluate.ring_recovery(accounts, mapping, scored).collect()}
    assert got == {"x": (3, 1, "full"), "y": (2, 2, "partial"), "z": (0, 0, "missed")}


def test_quality_checks(spark):
    accounts, transactions = random_tables(6)
    a, t = accounts_frame(spark, accounts), transactions_frame(spark, transactions)
    got = {r.name: r for r in quality.checks(a, t, fraud_rate=(0.1, 0.3), ring_accounts=6).collect()}
    assert all(r.passed for r in got.values()) and len(got) == 7
    broken = t.withColumn("status", F.lit("odd")).drop("amount")
    got = {r.name: r for r in quality.checks(a.unionByName(a.withColumn("label_ring_member", F.lit(False))), broken).collect()}
    assert not got["unknown_status"].passed and not got["missing_columns"].passed and not got["ring_and_normal"].passed
    assert quality.missing_columns(a, broken) == ["transactions.amount"]


def test_whole_run_publishes_its_tables(spark, tmp_path):
    accounts, transactions = random_tables(8)
    run = BatchRun(accounts_frame(spark, accounts), transactions_frame(spark, transactions), SMALL)
    run.write(str(tmp_path / "out"))
    log = tables.read_audit(spark, str(tmp_path / "out/audit_log"))
    assert log.count() == run.layer1.count() > 0
    assert log.where("ring_membership is null").join(run.transactions, "txn_id").where("account_id != 'stranger'").isEmpty()
    clusters = tables.read_clusters(spark, str(tmp_path / "out/clusters"))
    assert clusters.select(F.explode("member_accounts")).count() == len(accounts)
    metrics = tables.read_metrics(spark, str(tmp_path / "out/metrics")).first()
    assert metrics.total_fraud_test_set == log.join(run.transactions, "txn_id").where("label_fraud").count()
    assert spark.read.parquet(str(tmp_path / "out/evaluation")).count() == 13
